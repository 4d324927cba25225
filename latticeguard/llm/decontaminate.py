"""Benchmark decontamination by spaced seeds.

Texts become sequences of token hashes: lower-cased runs of Unicode letters, digits and the marks on
them; of scripts written without spaces (Han, Kana, Thai and the like), each character is a token. A spaced seed is a fixed mask over a window of tokens: positions under a 0 are
ignored, so a substituted word there does not change the window's hash. The four masks below hit
every aligned overlap that the check accepts: `MIN_MATCH` equal tokens in a stretch of which at
least `IDENTITY` is equal (tested over all error patterns of every length up to 120; a stretch of 34
or more tokens has a half of 17 or more that is accepted too, so shorter ones decide).

1. The benchmark's windows are hashed; a Bloom bitmap says which hashes can occur. It has 16 bits a
   window, so about one foreign window in 70 passes, and lies between 4 MB and 128 MB: beyond 64
   million windows more pass, and the join below still decides.
2. One pass over the documents hashes all windows, and emits only those that pass the bitmap, with
   the token hashes around them (runs of near hits share one context). The bitmap is all that is
   broadcast.
3. Spark joins the emitted hashes with the benchmark's hashes; equal diagonals of one context and
   item are one candidate. A candidate takes from its context the tokens that its own item can cover,
   and is compared token by token along its diagonal.

Items with equal tokens are joined as one. Items shorter than the shortest mask are found whole: the
same pass hashes the windows of their few lengths, and what passes the bitmap is joined with the
items by its tokens, once per document and window.
"""
from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from latticeguard.llm.common import free_name, materialize, text_key

#: 1: the token must agree; 0: it is ignored.
MASKS = ("1010011101", "1111000101", "100111011", "11110111")
SHORTEST = min(map(len, MASKS))
#: Equal tokens an overlap needs (all of them, for an item with fewer), and their least share of it.
MIN_MATCH = 13
IDENTITY = 0.8
#: Least and most bits of the Bloom bitmap, as powers of two (4 MB, 128 MB), and its bits for each hash, of which two are set.
BITMAP_POWERS = (25, 30)
BITS_PER_SEED = 16
_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)
_SECOND = np.uint64(0xC2B2AE3D27D4EB4F)
_TOKENS_AT_ONCE = 1 << 18
_KEEP = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
#: Marks belong to the letter before them (variation selectors do not change it, and separate).
_MARKS = "".join(c for c in map(chr, range(0x300, 0x1F000)) if unicodedata.category(c)[0] == "M" and not "\ufe00" <= c <= "\ufe0f")
#: Non-ASCII characters that are in no token.
_BREAK = re.compile(rf"[^\x00-\x7f\w{_MARKS}]+")
#: Thai and Lao, Myanmar, Khmer, Tai, Han, Kana, Bopomofo, Yi: no spaces between words.
_ALONE = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u1950-\u19df\u1a20-\u1aaf\u3005-\u3007\u3021-\u3029\u3031-\u312f"
                    "\u31a0-\u31bf\u31f0-\u31ff\u3400-\u4dbf\u4e00-\ua4cf\ua9e0-\ua9ff\uaa60-\uaadf\uf900-\ufaff\uff66-\uff9f"
                    "\U0001aff0-\U0001b16f\U00020000-\U0003ffff]")


def token_hashes(text: str | None) -> np.ndarray:
    """Hashes of the text's tokens; none for null."""
    text = (text or "").lower()
    if not text.isascii():
        text = _ALONE.sub(r" \g<0> ", _BREAK.sub(" ", text))
    words = text.encode().translate(_KEEP).split()
    return np.frombuffer(b"".join(map(xxhash.xxh64_digest, words)), ">u8").astype(np.uint64)


def seed_hashes(tokens: np.ndarray, mask: str) -> np.ndarray:
    """The hash under `mask` of each window that starts at 0, 1, ...; windows reach over the end of nothing."""
    n = len(tokens) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    value = np.full(n, int(mask, 2), np.uint64)
    for at, bit in enumerate(mask):
        if bit == "1":
            value = (value ^ tokens[at:at + n]) * _MULTIPLY
            value ^= value >> np.uint64(29)
    return value


def bitmap_power(seeds: int) -> int:
    """Size of the bitmap for so many hashes, as a power of two of its bits."""
    least, most = BITMAP_POWERS
    return min(most, max(least, (seeds * BITS_PER_SEED - 1).bit_length()))


def _bits(hashes: np.ndarray, power: int) -> tuple[np.ndarray, np.ndarray]:
    shift = np.uint64(64 - power)
    return hashes >> shift, (hashes * _SECOND) >> shift


def _passes(bitmap: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bitmap[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def best_overlap(doc: np.ndarray, item: np.ndarray, diagonal: int, min_match: int = MIN_MATCH,
                 identity: float = IDENTITY) -> tuple[int, int, int, int] | None:
    """(start in doc, start in item, length, equal tokens) of the overlap with most equal tokens on a diagonal.

    Item token j lies on doc token diagonal + j. None if no stretch with the wanted share of equal
    tokens has `min_match` of them (or all of the item's, if it has fewer).
    """
    low, high = max(0, -diagonal), min(len(item), len(doc) - diagonal)
    if high <= low:
        return None
    equal = item[low:high] == doc[low + diagonal:high + diagonal]
    hits = np.concatenate(([0], np.cumsum(equal)))
    score = hits * 1000 - np.arange(len(hits)) * round(identity * 1000)  # >= 0 over a stretch: enough are equal
    ahead = np.maximum.accumulate(score[::-1])[::-1]  # falls: the last end that is good enough for a start
    end = len(ahead) - np.searchsorted(ahead[::-1], score, "left") - 1
    gain = hits[end] - hits
    start = int(np.argmax(gain))
    if gain[start] < min(min_match, len(item)):
        return None
    inside = np.flatnonzero(equal[start:end[start]])
    first, last = start + int(inside[0]), start + int(inside[-1])
    return low + first + diagonal, low + first, last - first + 1, int(gain[start])


def _items(bench: DataFrame, key: str, text: str) -> DataFrame:
    """(item, copies, tokens): the smallest key of each distinct token sequence, and how many rows have it."""

    @F.arrow_udf("array<long>")
    def tokens(column: pa.Array) -> pa.Array:
        return pa.array([token_hashes(t).view(np.int64) for t in column.to_pylist()], pa.list_(pa.int64()))

    return (bench.select(F.col(key).alias("item"), tokens(F.col(text)).alias("tokens"))
            .where(F.size("tokens") > 0)
            .groupBy("tokens").agg(F.min("item").alias("item"), F.count("*").alias("copies"))
            .withColumn("content", F.xxhash64("tokens")))


def _item_seeds(items: DataFrame) -> DataFrame:
    """(hash, content, at, size): every window of every item under every mask that fits, and the item's size; a shorter
    item as a whole."""

    def seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, values in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                item = values.values.to_numpy().view(np.uint64)
                for mask in MASKS if len(item) >= SHORTEST else ("1" * len(item),):
                    found = seed_hashes(item, mask)
                    yield pa.record_batch({"hash": found.view(np.int64), "content": np.full(len(found), content),
                                           "at": np.arange(len(found)), "size": np.full(len(found), len(item))})

    return items.select("content", "tokens").mapInArrow(seeds, "hash long, content long, at long, size long")


def _bitmap(seeds: DataFrame) -> np.ndarray:
    """The Bloom bitmap of the seeds, gathered as at most 2**power / 64 words."""
    power = bitmap_power(seeds.count())
    shift = 64 - power

    @F.arrow_udf("long")
    def second(column: pa.Array) -> pa.Array:
        return pa.array((column.to_numpy().view(np.uint64) * _SECOND).view(np.int64))

    bit = F.explode(F.array(F.shiftrightunsigned("hash", shift), F.shiftrightunsigned(second("hash"), shift)))
    words = (seeds.select(bit.alias("bit")).groupBy(F.shiftright("bit", 6).alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, int(bit % 64))")).alias("bits"))).toArrow()
    bitmap = np.zeros(1 << (power - 6), np.int64)
    bitmap[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return bitmap.view(np.uint8)


def _contexts(docs: DataFrame, key: str, text: str, bitmap: np.ndarray, reach: int, short: list[int]) -> DataFrame:
    """(context, key, first, tokens, seeds): runs of windows that pass the bitmap, with `reach` tokens around.

    Without seeds: the first window of its kind in a document that passes as a whole item of one of the `short` lengths.
    """
    kind = docs.schema[key].dataType.simpleString()
    fewest = min([SHORTEST, *short])
    power = len(bitmap).bit_length() + 2
    context_type = pa.list_(pa.struct([("hash", pa.int64()), ("at", pa.int64())]))

    def found(keys: list, lengths: list[int], tokens: np.ndarray, serial: int) -> list[dict]:
        ends = np.cumsum(lengths)
        owner = np.repeat(np.arange(len(lengths)), lengths)

        def passing(mask: str) -> tuple[np.ndarray, np.ndarray]:
            hashes = seed_hashes(tokens, mask)
            one, _ = _bits(hashes, power)
            at = np.flatnonzero(_passes(bitmap, one))
            at = at[owner[at] == owner[at + len(mask) - 1]]
            at = at[_passes(bitmap, _bits(hashes[at], power)[1])]
            return at, hashes[at]

        hits = [passing(mask) for mask in MASKS]
        at = np.concatenate([a for a, _ in hits])
        hashes = np.concatenate([h for _, h in hits]).view(np.int64)
        order = np.argsort(at, kind="stable")
        at, hashes = at[order], hashes[order]
        rows = []
        if len(at):
            cuts = np.flatnonzero((np.diff(at) > reach) | (np.diff(owner[at]) != 0)) + 1
            for where, own in zip(np.split(at, cuts), np.split(hashes, cuts), strict=True):
                doc = owner[where[0]]
                begin = ends[doc] - lengths[doc]
                first, last = max(begin, where[0] - reach), min(ends[doc], where[-1] + reach + SHORTEST)
                rows.append({"context": serial + len(rows), "key": keys[doc], "first": int(first - begin),
                             "tokens": tokens[first:last].view(np.int64),
                             "seeds": [{"hash": int(h), "at": int(w - first)} for h, w in zip(own, where, strict=True)]})
        for n in short:
            at, hashes = passing("1" * n)
            order = np.lexsort((at, hashes, owner[at]))
            at, hashes = at[order], hashes[order]
            repeats = np.zeros(len(at), bool)
            repeats[1:] = (np.diff(owner[at]) == 0) & (hashes[1:] == hashes[:-1])
            for w in at[~repeats].tolist():
                doc = owner[w]
                rows.append({"context": serial + len(rows), "key": keys[doc], "first": int(w - ends[doc] + lengths[doc]),
                             "tokens": tokens[w:w + n].view(np.int64), "seeds": None})
        return rows

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        serial = TaskContext.get().partitionId() << 40
        for batch in batches:
            schema = pa.schema([("context", pa.int64()), ("key", batch.schema.field(0).type), ("first", pa.int64()),
                                ("tokens", pa.list_(pa.int64())), ("seeds", context_type)])
            keys, parts, size = [], [], 0
            for i in range(batch.num_rows):
                tokens = token_hashes(batch.column(1)[i].as_py())
                if len(tokens) >= fewest:
                    keys.append(batch.column(0)[i].as_py())
                    parts.append(tokens)
                    size += len(tokens)
                if parts and (size >= _TOKENS_AT_ONCE or i == batch.num_rows - 1):
                    rows = found(keys, [len(p) for p in parts], np.concatenate(parts), serial)
                    keys, parts, size, serial = [], [], 0, serial + len(rows)
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema)

    out = (f"context long, key {kind}, first long, tokens array<long>, seeds array<struct<hash: long, at: long>>")
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(scan, out)


_OVERLAP = ("doc_start", "item_start", "n_tokens", "n_matched")


@F.arrow_udf(T.StructType([T.StructField(name, T.LongType()) for name in _OVERLAP]))
def _verify(doc: pa.Array, item: pa.Array, diagonal: pa.Array) -> pa.Array:
    rows = []
    for d, i, shift in zip(doc, item, diagonal.to_pylist(), strict=True):
        best = best_overlap(d.values.to_numpy(), i.values.to_numpy(), shift)
        rows.append(dict(zip(_OVERLAP, best, strict=True)) if best else None)
    return pa.array(rows, pa.struct([(name, pa.int64()) for name in _OVERLAP]))


def overlaps(docs: DataFrame, bench: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
             item_text: str = "text") -> DataFrame:
    """(key, item_key, copies, doc_start, item_start, n_tokens, n_matched): contaminated documents.

    One row per document and distinct item text (named by its smallest key; `copies` rows of the
    benchmark have it): the overlap with most equal tokens, counted in tokens. Null and empty texts
    on either side match nothing; repeated document rows give one row; an empty table on either
    side gives no rows; other columns are ignored.
    """
    items = materialize(_items(bench, item_key, item_text), "decon-items")
    n = F.size("tokens")
    reach, short = items.agg(F.max(n), F.collect_set(F.when(n < SHORTEST, n))).first()
    seeds = materialize(_item_seeds(items), "decon-seeds")
    contexts = materialize(_contexts(docs, key, text, _bitmap(seeds), reach or 0, sorted(short)), "decon-contexts")
    hits = contexts.select("context", F.explode("seeds").alias("s")).select("context", "s.hash", F.col("s.at").alias("doc_at"))
    diagonals = (hits.join(seeds, "hash")
                 .select("context", "content", "size", (F.col("doc_at") - F.col("at")).alias("diagonal")).distinct())
    low = F.greatest("diagonal", F.lit(0).cast("long"))
    covered = F.slice("tokens", (low + 1).cast("int"), (F.col("diagonal") + F.col("size") - low).cast("int"))
    pairs = (diagonals.join(contexts, "context")
             .select("key", "content", covered.alias("doc_tokens"), (F.col("first") + low).alias("first"),
                     (F.col("diagonal") - low).alias("diagonal"))
             .join(items, "content"))
    checked = pairs.withColumn("v", _verify("doc_tokens", "tokens", "diagonal")).where("v IS NOT NULL").select(
        "key", "item", "copies", (F.col("v.doc_start") + F.col("first")).alias("doc_start"), "v.item_start",
        "v.n_tokens", "v.n_matched")
    if short:
        whole = contexts.where("seeds IS NULL").join(items, "tokens").select(
            "key", "item", "copies", F.col("first").alias("doc_start"), F.lit(0).cast("long").alias("item_start"),
            n.cast("long").alias("n_tokens"), n.cast("long").alias("n_matched"))
        checked = checked.unionByName(whole)
    best = F.max_by(F.struct("doc_start", "item_start", "n_tokens", "n_matched"),
                    F.struct("n_matched", -F.col("doc_start"), -F.col("item_start")))
    return (checked.groupBy("key", "item").agg(F.max("copies").alias("copies"), best.alias("b"))
            .select(F.col("key").alias(key), F.col("item").alias(item_key), "copies", "b.*"))


def drop_contaminated(docs: DataFrame, bench: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` without the documents that overlap a benchmark item, those with a null key too.

    A row is named by its key (null is one) and text, so a clean one with the same key stays. The names of the
    contaminated rows are written first, so their known size decides how the anti join runs.
    """
    gone, mark, name = free_name(docs, "gone"), free_name(docs, "gone_mark"), free_name(docs, "name")
    named = docs.select(F.struct(F.col(key).alias("key"), text_key(F.col(text)).alias("mark")).alias(name), text)
    found = materialize(overlaps(named, bench, name, text).select(f"{name}.key", f"{name}.mark").distinct()
                        .select(F.col("key").alias(gone), F.col("mark").alias(mark)), "decon-keys")
    return docs.join(found, F.col(key).eqNullSafe(F.col(gone)) & (text_key(F.col(text)) == F.col(mark)), "left_anti")
