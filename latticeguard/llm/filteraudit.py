"""Interaction audit of document filters over sorted posting lists.

Each filter's failing documents are kept as sorted posting lists: one list per part (a language),
filter and range of ids, of at most `RANGE` documents each. For every set of filters, the union of
its lists is made by a k-way merge that gallops: the list with the smallest head is copied up to the
next smallest head, which doubling steps find. For every filter and every set of others, a galloping
difference gives the documents that fail this filter and none of the set. The sizes of these
differences, summed over the ranges of a part, are all that any order of the filters needs.

Ranges are cut from rows sorted by (part, doc_id), so a part of any size is spread over many tasks,
and a task holds one batch of rows. A document is named by its place in the sorted range, so
repeated or null doc_ids are documents of their own.
"""
from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator
from itertools import combinations, permutations
from math import factorial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from latticeguard.llm.common import binary_values, materialize
from latticeguard.session import release

FILTERS = "ABCDE"
#: Filters that look at one text only; the last one looks for an equal text table-wide.
OF_TEXT = "ABCD"
SYMBOLS = b"#$%&*|"
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Documents of one range of ids.
RANGE = 4096


def text_failures(text: bytes) -> int:
    """Bits (A first) of the filters that a text, in UTF-8, fails by itself."""
    words = text.split()  # of bytes, this cuts at ASCII blanks only
    points = len(text) if text.isascii() else len(text.decode())
    capitals = len(text) - len(text.translate(None, CAPITALS))
    fails = (
        len(words) < 100,
        100 * len(set(words)) < 80 * len(words),
        100 * capitals > 10 * points,
        len(text.translate(None, SYMBOLS)) < len(text),
    )
    return sum(1 << i for i, failed in enumerate(fails) if failed)


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One narrow row a document: part, doc_id, `failed` (bits, A first), good, toxic.

    A null text is empty; a null language's part is the empty string. A document fails E if a row with a
    smaller doc_id has an equal text (by its SHA-256); one without a doc_id has no smaller one, is not
    smaller than any, and has no labels. A doc_id's labels are the union of its rows in `labels`. Neither step shuffles
    rows by text: the first doc_id of each text is found by partial aggregation, and joined by doc_id.
    """

    @F.arrow_udf(T.StructType([T.StructField("failed", T.IntegerType()), T.StructField("sha", T.BinaryType())]))
    def judged(texts: pa.Array) -> pa.Array:
        failed, digests = [], []
        for text in binary_values(texts):
            text = text or b""
            failed.append(text_failures(text))
            digests.append(hashlib.sha256(text).digest())
        return pa.StructArray.from_arrays([pa.array(failed, pa.int32()), pa.array(digests, pa.binary())], ["failed", "sha"])

    narrow = materialize(
        docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), "doc_id", judged("text").alias("t"))
        .select("part", "doc_id", "t.failed", "t.sha"), "audit-texts")
    named = narrow.where("doc_id IS NOT NULL")
    first = named.groupBy("sha").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    marked = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    copied = F.when(F.col("first").isNull(), 1 << FILTERS.index("E")).otherwise(0)
    whole = named.join(first, ["doc_id", "sha"], "left").join(marked, "doc_id", "left").select(
        "part", "doc_id", F.col("failed").bitwiseOR(copied).alias("failed"),
        F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))
    unnamed = narrow.where("doc_id IS NULL").select(
        "part", "doc_id", "failed", F.lit(False).alias("good"), F.lit(False).alias("toxic"))
    failed = materialize(whole.union(unnamed), "audit-failures")
    release(narrow)
    return failed


_POSTINGS = "part string, n long, lists array<array<int>>, good array<int>, toxic array<int>"


def postings(failed: DataFrame) -> DataFrame:
    """One row per range of ids: the documents in it and each filter's sorted list of failing places;
    `good` and `toxic` list the labelled ones."""
    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = batch.column("part").to_pylist()
            columns = [batch.column(c).to_pylist() for c in ("failed", "good", "toxic")]
            start, rows = 0, []
            while start < len(parts):
                end = start + 1
                while end < len(parts) and end - start < RANGE and parts[end] == parts[start]:
                    end += 1
                bits, good, toxic = (column[start:end] for column in columns)
                rows.append({
                    "part": parts[start], "n": end - start,
                    "lists": [[at for at, b in enumerate(bits) if b >> f & 1] for f in range(len(FILTERS))],
                    "good": [at for at, g in enumerate(good) if g], "toxic": [at for at, t in enumerate(toxic) if t]})
                start = end
            yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)

    dealt = failed.repartitionByRange("part", "doc_id").sortWithinPartitions("part", "doc_id")
    return dealt.select("part", "failed", "good", "toxic").mapInArrow(ranges, _POSTINGS)


_ARROW = pa.schema([
    ("part", pa.string()), ("n", pa.int64()), ("lists", pa.list_(pa.list_(pa.int32()))),
    ("good", pa.list_(pa.int32())), ("toxic", pa.list_(pa.int32()))])


def gallop(ids: list[int], target: int, at: int) -> int:
    """First place from `at` on whose id is not under `target`: doubling steps, then bisection."""
    step = 1
    while at + step < len(ids) and ids[at + step] < target:
        at += step
        step *= 2
    return bisect_left(ids, target, at, min(len(ids), at + step + 1))


def union(lists: list[list[int]]) -> list[int]:
    """Sorted union of k sorted lists: the list with the smallest head is copied up to the next smallest one."""
    heads = [[ids[0], k, 0] for k, ids in enumerate(lists) if ids]
    out: list[int] = []
    while len(heads) > 1:
        heads.sort()
        least, k, at = heads[0]
        following, ids = heads[1][0], lists[k]
        end = at + 1 if least == following else gallop(ids, following, at)
        out.extend(ids[at + (bool(out) and out[-1] == least):end])
        if end < len(ids):
            heads[0] = [ids[end], k, end]
        else:
            del heads[0]
    if heads:
        least, k, at = heads[0]
        out.extend(lists[k][at + (bool(out) and out[-1] == least):])
    return out


def difference(ids: list[int], others: list[int]) -> list[int]:
    """Ids of one sorted list that another lacks; both are galloped through."""
    out: list[int] = []
    at, place = 0, 0
    while at < len(ids):
        place = gallop(others, ids[at], place) if place < len(others) else place
        if place == len(others):
            out.extend(ids[at:])
            break
        if others[place] == ids[at]:
            at += 1
        else:
            end = gallop(ids, others[place], at)
            out.extend(ids[at:end])
            at = end
    return out


def shared(ids: list[int], others: list[int]) -> int:
    """How many ids two sorted lists share."""
    return len(ids) - len(difference(ids, others))


def cells(n_filters: int) -> list[tuple[int, tuple[int, ...]]]:
    """Every filter with every set of others."""
    return [(f, s) for f in range(n_filters) for size in range(n_filters)
            for s in combinations([o for o in range(n_filters) if o != f], size)]


def range_counts(lists: list[list[int]], good: list[int], toxic: list[int]) -> list[int]:
    """Per cell, the documents of a range that fail its filter and none of its set: all, good, toxic."""
    sets = {s for _, s in cells(len(lists))}
    unions = {s: union([lists[i] for i in s]) for s in sets}
    out = []
    for f, s in cells(len(lists)):
        only = difference(lists[f], unions[s])
        out += [len(only), shared(only, good), shared(only, toxic)]
    return out


def part_counts(ranges: DataFrame) -> DataFrame:
    """One row a part: its documents, and `counts` summed over its ranges (as `range_counts` orders them)."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums: dict[str, list[int]] = {}
            for row in batch.to_pylist():
                found = [row["n"], *range_counts(row["lists"], row["good"], row["toxic"])]
                before = sums.get(row["part"])
                sums[row["part"]] = found if before is None else [a + b for a, b in zip(before, found, strict=True)]
            yield pa.RecordBatch.from_pydict({"part": list(sums), "counts": list(sums.values())}, schema=pa.schema(
                [("part", pa.string()), ("counts", pa.list_(pa.int64()))]))

    each = ranges.mapInArrow(counted, "part string, counts array<long>")
    return (each.select("part", F.posexplode("counts").alias("place", "count"))
            .groupBy("part", "place").agg(F.sum("count").alias("count"))
            .groupBy("part").agg(F.array_sort(F.collect_list(F.struct("place", "count")))["count"].alias("counts")))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, with what the step's filter does there.

    kept, removed, redundant, unique_fails, good_lost, toxic_lost and shapley as the counts' names say; zeros
    are included. Parts are those of `docs`: an empty table gives no rows. Extra columns are not read. See
    `failures` for nulls and repeated rows. The work is done when the function returns; the result is
    spread from one row per part.
    """
    failed = failures(docs.select("doc_id", "text", "lang"), labels.select("doc_id", "quality", "toxic"))
    parts = materialize(part_counts(postings(failed)), "audit-parts")
    release(failed)
    n = len(FILTERS)
    place = {cell: 1 + 3 * i for i, cell in enumerate(cells(n))}  # 0 holds the part's documents
    steps = []
    for order in permutations(range(n)):
        removed = [place[f, tuple(sorted(order[:i]))] for i, f in enumerate(order)]
        name = "".join(FILTERS[f] for f in order)
        steps += [F.struct(F.lit(name).alias("filter_order"), F.lit(i + 1).alias("step"), F.lit(f).alias("f"),
                           F.array(*map(F.lit, removed[:i + 1])).alias("removed")) for i, f in enumerate(order)]

    def count(at: int | Column) -> Column:
        return F.col("counts")[at]

    weight = {cell: factorial(len(cell[1])) * factorial(n - 1 - len(cell[1])) for cell in place}
    each_filter = F.array(*(F.struct(
        count(place[f, ()]).alias("fails"), count(place[f, tuple(o for o in range(n) if o != f)]).alias("alone"),
        sum(count(place[c]) * w for c, w in weight.items() if c[0] == f).alias("shapley")) for f in range(n)))
    now = F.element_at("s.removed", -1)
    gone = F.aggregate("s.removed", F.lit(0).cast("long"), lambda total, at: total + count(at))
    return (parts.withColumn("filters", each_filter).select("part", "counts", "filters", F.explode(F.array(*steps)).alias("s"))
            .withColumn("own", F.col("filters")[F.col("s.f")])
            .select("part", "s.filter_order", "s.step", (count(0) - gone).alias("kept"), count(now).alias("removed"),
                    (F.col("own.fails") - count(now)).alias("redundant"), F.col("own.alone").alias("unique_fails"),
                    count(now + 1).alias("good_lost"), count(now + 2).alias("toxic_lost"), F.col("own.shapley").alias("shapley")))
