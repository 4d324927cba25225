"""Vector codes: product quantisation with exact nearest entries by slice and intersect.

Vectors are cut into parts; each part position has a codebook of at most 16 entries. To find the
nearest entry, each dimension keeps its entries' coordinates sorted, with prefix masks: bit e of
mask k tells whether entry e is among the first k. The initial radius of a part is its distance to
one entry, the one in the middle of its slice of the widest dimension; no farther entry can win. In
each dimension two binary searches select the range of coordinates within the radius, and the
difference of two prefix masks names its entries; the masks of all dimensions, ANDed, leave the
exact candidates. Only their whole distances are computed; the lowest index wins a tie.

Components are integers, floor(4096 * x), so every distance and sum is exact in any order. A round
of fitting reads the integer vectors once, adds the parts up per task, and returns one sum per
entry and dimension to the driver: 16 times the vector's length, whatever the table's size.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from latticeguard.llm.common import free_name, materialize
from latticeguard.session import release

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
#: Components are held to this size, so that a vector's squared distance stays a 64-bit integer.
LARGEST = 1 << 26
#: A label with more than this share of all rows is joined by a broadcast: there can't be more of them than its inverse.
HOT_SHARE = 0.001


def cuts(length: int, parts: int = PARTS) -> list[int]:
    """Where the parts of a vector begin, and its end."""
    return [length * p // parts for p in range(parts + 1)]


class Slices:
    """One codebook's sorted coordinates and prefix masks, one column per dimension."""

    def __init__(self, book: np.ndarray):
        self.book = np.asarray(book, np.int64)
        n, width = self.book.shape
        if n > 64:
            raise ValueError("a mask has 64 bits")
        order = np.argsort(self.book, axis=0, kind="stable")
        self.coords = np.take_along_axis(self.book, order, 0)
        bits = np.uint64(1) << order.astype(np.uint64)
        self.prefix = np.zeros((n + 1, width), np.uint64)
        np.bitwise_or.accumulate(bits, axis=0, out=self.prefix[1:])
        spread = self.coords[-1] - self.coords[0]
        self.widest = int(spread.argmax()) if width else 0
        self.middle = order

    def candidates(self, parts: np.ndarray) -> np.ndarray:
        """A mask per row of `parts`: all entries that can be nearest to it."""
        n, width = self.book.shape
        everyone = np.uint64((1 << n) - 1)
        masks = np.full(len(parts), everyone, np.uint64)
        if not width:
            return masks
        at = np.searchsorted(self.coords[:, self.widest], parts[:, self.widest])
        seed = self.middle[np.minimum(at, n - 1), self.widest]
        radius = np.ceil(np.sqrt(((parts - self.book[seed]) ** 2).sum(1).astype(np.float64))).astype(np.int64) + 1
        for d in range(width):
            low = np.searchsorted(self.coords[:, d], parts[:, d] - radius, "left")
            high = np.searchsorted(self.coords[:, d], parts[:, d] + radius, "right")
            masks &= self.prefix[high, d] & ~self.prefix[low, d]
        return masks

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry and its squared distance, per row."""
        masks = self.candidates(parts)
        index = np.zeros(len(parts), np.int64)
        least = np.full(len(parts), np.iinfo(np.int64).max)
        for e, entry in enumerate(self.book):
            rows = np.flatnonzero(masks >> np.uint64(e) & np.uint64(1))
            distance = ((parts[rows] - entry) ** 2).sum(1)
            nearer = distance < least[rows]
            index[rows[nearer]], least[rows[nearer]] = e, distance[nearer]
        return index, least


def integer_vectors(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """`vectors` without rows whose vector is null or holds null, NaN or infinite components, and with
    integer components in `vector`, held to +-LARGEST."""
    kept = vectors.where(F.col(f"`{vector}`").isNotNull() & F.forall(
        f"`{vector}`", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    scaled = F.transform(f"`{vector}`", lambda x: F.least(F.greatest(
        F.floor(F.greatest(F.least(x.cast("double") * SCALE, F.lit(2.0 ** 40)), F.lit(-(2.0 ** 40)))),
        F.lit(-LARGEST)), F.lit(LARGEST)).cast("int"))
    return kept.withColumn(vector, scaled)


def _matrix(column: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows have `length` components, and those rows as a matrix."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    fit = sizes == length
    flat = column.filter(pa.array(fit)).flatten().to_numpy(zero_copy_only=False)
    return fit, flat.astype(np.int64).reshape(int(fit.sum()), length)


def _sums(vectors: DataFrame, vector: str, books: list[np.ndarray], at: list[int]) -> dict[tuple[int, int], tuple[int, np.ndarray]]:
    """Per part and entry: how many parts it is nearest to, and their sum."""

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices = [Slices(book) for book in books]
        totals = [np.zeros((len(book), 1 + book.shape[1]), np.int64) for book in books]
        for batch in batches:
            _, rows = _matrix(batch.column(0), at[-1])
            for p, each in enumerate(slices):
                parts = rows[:, at[p]:at[p + 1]]
                index, _ = each.nearest(parts)
                totals[p][:, 0] += np.bincount(index, minlength=len(each.book))
                np.add.at(totals[p][:, 1:], index, parts)
        part, entry, place, total = [], [], [], []
        for p, t in enumerate(totals):
            used = np.flatnonzero(t[:, 0])
            part.append(np.full(used.size * t.shape[1], p))
            entry.append(np.repeat(used, t.shape[1]))
            place.append(np.tile(np.arange(t.shape[1]), used.size))
            total.append(t[used].ravel())
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(kind)) for c, kind in (
            (part, np.int32), (entry, np.int32), (place, np.int32), (total, np.int64))], ["part", "entry", "place", "total"])

    added = vectors.select(vector).mapInArrow(assigned, "part int, entry int, place int, total long")
    found: dict[tuple[int, int], dict[int, int]] = {}
    for row in added.groupBy("part", "entry", "place").agg(F.sum("total").alias("total")).collect():
        found.setdefault((row["part"], row["entry"]), {})[row["place"]] = row["total"]
    return {key: (sums[0], np.array([sums[i] for i in range(1, len(sums))], np.int64)) for key, sums in found.items()}


def fit(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", parts: int = PARTS,
        entries: int = ENTRIES, rounds: int = ROUNDS) -> list[np.ndarray]:
    """The codebooks of integer vectors, one matrix of entries per part.

    They start as the vectors of the smallest vec_ids (nulls last, ties by components) that have as many
    components as the first of them; an empty table has empty codebooks.
    """
    first = [r[0] for r in vectors.orderBy(F.col(f"`{vec_id}`").asc_nulls_last(), f"`{vector}`").limit(1).select(vector).collect()]
    if not first:
        return [np.zeros((0, 0), np.int64)] * parts
    length = len(first[0])
    alike = vectors.where(F.size(f"`{vector}`") == length)
    seeds = alike.orderBy(F.col(f"`{vec_id}`").asc_nulls_last(), f"`{vector}`").limit(entries).select(vector).collect()
    start = np.array([r[0] for r in seeds], np.int64).reshape(len(seeds), length)
    at = cuts(length, parts)
    books = [start[:, a:b].copy() for a, b in zip(at, at[1:], strict=False)]
    for _ in range(rounds):
        for (part, entry), (count, sums) in _sums(alike, vector, books, at).items():
            books[part][entry] = sums // count
    return books


def encode(vectors: DataFrame, books: list[np.ndarray], vector: str = "embedding") -> DataFrame:
    """Integer vectors with code (two hex digits a part) and error (squared distance to the coded vector).

    A vector with another number of components than the codebooks has neither. New columns get an
    underscore in front where `vectors` has their names already.
    """
    at = np.cumsum([0, *(book.shape[1] for book in books)]).tolist()

    @F.arrow_udf("code string, error long")
    def coded(column: pa.Array) -> pa.Array:
        fit_rows, rows = _matrix(column, at[-1])
        if not len(books[0]):
            fit_rows = np.zeros(len(column), bool)
        digits, errors = np.zeros((len(rows), len(books)), np.uint8), np.zeros(len(rows), np.int64)
        for p, book in enumerate(books if fit_rows.any() else []):
            index, distance = Slices(book).nearest(rows[:, at[p]:at[p + 1]])
            digits[:, p], errors = index, errors + distance
        codes = iter([row.tobytes().hex() for row in digits])
        return pa.StructArray.from_arrays([
            pa.array([next(codes) if ok else None for ok in fit_rows], pa.string()),
            pa.array(_spread(errors, fit_rows), pa.int64(), mask=~fit_rows)], ["code", "error"])

    held, code, error = (free_name(vectors, c) for c in ("coded", "code", "error"))
    return vectors.withColumn(held, coded(F.col(f"`{vector}`"))).select(
        *(F.col(f"`{c}`") for c in vectors.columns), F.col(f"{held}.code").alias(code), F.col(f"{held}.error").alias(error))


def _spread(values: np.ndarray, where: np.ndarray) -> np.ndarray:
    out = np.zeros(len(where), np.int64)
    out[where] = values
    return out


def compress(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> tuple[list[np.ndarray], DataFrame]:
    """Codebooks of a table of float vectors, and its kept rows with their integer vectors, codes and errors.

    The integer vectors and then the codes are written to the shared folder. Repeated rows are rows of
    their own; an empty table gives no rows. See `integer_vectors`, `fit` and `encode` for the rest.
    """
    whole = materialize(integer_vectors(vectors, vector), "vector-integers")
    books = fit(whole, vec_id, vector)
    coded = materialize(encode(whole, books, vector), "vector-codes")
    release(whole)
    return books, coded


def label_errors(coded: DataFrame, label: str = "label", error: str = "error", out: str = "label_error") -> DataFrame:
    """`coded` with the error summed over the rows of an equal label (nulls are one label).

    A label that holds more than HOT_SHARE of all rows is joined by a broadcast of at most 1 / HOT_SHARE
    rows; the others by a shuffle on the label, in which none of them is large.
    """
    key, total, rows = (free_name(coded, c) for c in ("_label", "_total", "_rows"))
    named = coded.withColumn(key, F.struct(F.col(f"`{label}`").alias("v")))
    sums = materialize(named.groupBy(key).agg(F.sum(f"`{error}`").alias(total), F.count(F.lit(1)).alias(rows)), "label-errors")
    n = sums.agg(F.sum(rows)).first()[0] or 0
    hot, rest = (sums.where(c).select(key, total) for c in (F.col(rows) > HOT_SHARE * n, F.col(rows) <= HOT_SHARE * n))
    marked = named.join(F.broadcast(hot.withColumnRenamed(total, "_hot")), key, "left")
    columns = [F.col(f"`{c}`") for c in coded.columns]
    found = marked.where("_hot IS NOT NULL").select(*columns, F.col("_hot").alias(out))
    cold = marked.where("_hot IS NULL").drop("_hot").join(rest, key, "left").select(*columns, F.col(total).alias(out))
    return found.unionByName(cold)


def spelt(books: list[np.ndarray]) -> str:
    """All components, in decimal, by part, entry and place, with commas between."""
    return ",".join(str(x) for book in books for x in book.ravel().tolist())
