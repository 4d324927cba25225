"""SimHash near-duplicates by multi-index hashing.

Fingerprints: one bit per position, set when it is set in more than half of the text's shingle
hashes. Equal fingerprints collapse to one row before anything else, so a group of exact copies
costs one row however large it is.

Links (at most `max_bits` differing bits) between the distinct fingerprints: the 64 bits are cut
into segments and a radius is set for each so that, by the pigeonhole principle, any two
fingerprints within reach are within the radius in at least one segment. Every fingerprint is
entered under its own value of each segment (its home) and under the values of the small Hamming
ball around it (its probes; of a pair that differs, only one side needs to probe, the one that has
the lowest differing bit clear). Rows that meet under a value are compared on all 64 bits.

A value that many fingerprints share is not expanded into pairs: within a bucket, each found
neighbour leaves the set still to be compared, so the output is a spanning forest (fewer rows than
the bucket has) of verified links. Buckets over `BLOCK` rows are cut into blocks, and each pair of
blocks is a bucket of its own, so no task ever holds an unbounded group and no link is lost.

How many segments there are follows from the number of distinct fingerprints: few wide segments need
more probes, many narrow ones more comparisons (`segments_for`). The links are the same.

The joins and shuffles are Spark's; Python sees Arrow batches of (bucket, fingerprint) integers, sorted
by bucket, and holds one batch and the bucket that it ends in.
"""
from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations, repeat
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from latticeguard.llm.common import binary_values, dealt_join, free_name, materialize, text_key
from latticeguard.llm.components import connected_components

SHINGLE = 4
MAX_BITS = 4
#: Numbers of segments to choose from.
SEGMENTS = (3, 2)
#: Comparisons of two fingerprints that cost as much as one row of the index.
COMPARED_PER_ROW = 500
SEED = 42
#: Rows of a bucket that one task compares; larger buckets are cut into pairs of blocks.
BLOCK = 32_768
#: Buckets up to this size are compared by shifted vectors over the whole partition.
SMALL = 8
_SHINGLES_AT_ONCE = 1 << 16
_ROWS_AT_ONCE = 1 << 20


def fingerprint(text: bytes | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64-bit fingerprint of UTF-8 text (A-Z lower-cased, words between ASCII white space); 0 without words.

    Shingles are `shingle` words joined by a space, repeats included; a shorter text is one shingle.
    """
    words = text.lower().split() if text else []
    if not words:
        return 0
    if len(words) < shingle:
        shingles = iter([b" ".join(words)])
        total = 1
    else:
        total = len(words) - shingle + 1
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    digests = b"".join(map(xxhash.xxh64_digest, shingles, repeat(seed)))
    bits = np.frombuffer(digests, np.uint8).reshape(-1, 8)
    ones = np.zeros(64, np.int64)
    for at in range(0, total, _SHINGLES_AT_ONCE):
        ones += np.unpackbits(bits[at:at + _SHINGLES_AT_ONCE], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > total).tobytes(), "big")


def with_fingerprint(docs: DataFrame, text: str = "text", into: str = "fp",
                     shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """`docs` with the fingerprint of `text` as a signed long in a new column."""

    @F.arrow_udf("long")
    def fp(column: pa.Array) -> pa.Array:
        values = np.array([fingerprint(t, shingle, seed) for t in binary_values(column)], np.uint64)
        return pa.array(values.view(np.int64))

    return docs.withColumn(into, fp(F.col(text)))


def segment_plan(max_bits: int, segments: int) -> list[tuple[int, int, int]]:
    """(lowest bit, width, radius) of each segment to index.

    With max_bits = segments * q + a, two values within max_bits are within q in one of the first
    a + 1 segments or within q - 1 in one of the others; radius -1 means the segment isn't needed.
    """
    q, a = divmod(max_bits, segments)
    widths = [64 // segments + (i < 64 % segments) for i in range(segments)]
    plan, low = [], 0
    for i, width in enumerate(widths):
        radius = q if i <= a else q - 1
        if radius >= 0:
            plan.append((low, width, radius))
        low += width
    return plan


def segments_for(distinct: int, max_bits: int, choices: tuple[int, ...] = SEGMENTS) -> int:
    """The cheapest number of segments for so many distinct fingerprints, spread evenly.

    A fingerprint has one row per segment and one per probe (half the ball), and meets in a segment the
    others whose value lies in its ball.
    """
    def cost(segments: int) -> float:
        rows = met = 0.0
        for _, width, radius in segment_plan(max_bits, segments):
            ball = sum(comb(width, r) for r in range(radius + 1))
            rows += (ball + 1) / 2
            met += distinct * ball / 2 ** (width + 1)
        return rows + met / COMPARED_PER_ROW

    return min(choices, key=cost)


def _entries(fps: DataFrame, max_bits: int, segments: int) -> DataFrame:
    """(bucket, fp): each fingerprint under its own value of each segment and its probes."""
    def keys(i: int, low: int, width: int, radius: int) -> Column:
        value = F.shiftrightunsigned("fp", low).bitwiseAND(F.lit((1 << width) - 1).cast("long"))
        masks = [sum(1 << b for b in bits) for r in range(1, radius + 1) for bits in combinations(range(width), r)]
        own = F.array(value)
        if masks:
            probes = F.filter(F.array(*(F.lit(m).cast("long") for m in masks)),
                              lambda m: value.bitwiseAND(m.bitwiseAND(-m)) == 0)
            own = F.concat(own, F.transform(probes, lambda m: value.bitwiseXOR(m)))
        return F.transform(own, lambda k: k.bitwiseOR(F.lit(i << 58).cast("long")))

    parts = [keys(i, *segment) for i, segment in enumerate(segment_plan(max_bits, segments))]
    return fps.select("fp", F.explode(F.concat(*parts)).alias("bucket"))


def _blocked(entries: DataFrame, block: int) -> DataFrame:
    """(bucket, pair, fp) with buckets of more than `block` rows cut into pairs of blocks."""
    hot = materialize(entries.groupBy("bucket").count().where(F.col("count") > block), "simhash-hot")
    plain = entries.withColumn("pair", F.lit(0).cast("long"))
    if hot.isEmpty():
        return plain
    n = F.ceil(F.col("count") / F.lit(block)).cast("int")
    cut = entries.join(hot, "bucket").withColumn("n", n).withColumn(
        "own", F.pmod(F.xxhash64("fp"), F.col("n")).cast("int"))
    cut = cut.select("bucket", "fp", "own", "n", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("other"))
    pair = F.least("own", "other").cast("long") * F.col("n") + F.greatest("own", "other") + 1
    return entries.join(hot, "bucket", "left_anti").withColumn("pair", F.lit(0).cast("long")).unionByName(
        cut.select("bucket", "fp", pair.alias("pair")))


def spanning_links(fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest, as two index arrays, of the links among distinct fingerprints of one bucket."""
    rest, left, right = np.arange(len(fp)), [], []
    while rest.size > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and rest.size:
            at = queue.pop()
            near = np.bitwise_count(fp[rest] ^ fp[at]) <= max_bits
            if near.any():
                found, rest = rest[near], rest[~near]
                left.append(np.full(found.size, at))
                right.append(found)
                queue.extend(found)
    none = np.zeros(0, np.int64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def bucket_links(bucket: np.ndarray, pair: np.ndarray, fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Verified links within the buckets of one partition: all of small buckets, a spanning forest of others."""
    order = np.lexsort((fp, pair, bucket))
    bucket, pair, fp = bucket[order], pair[order], fp[order]
    new = np.ones(len(fp), bool)
    new[1:] = (bucket[1:] != bucket[:-1]) | (pair[1:] != pair[:-1])
    starts = np.flatnonzero(new)
    sizes = np.diff(np.append(starts, len(fp)))
    group = np.cumsum(new) - 1
    small = sizes[group] <= SMALL
    left, right = [], []
    for shift in range(1, SMALL):
        at = np.flatnonzero((group[shift:] == group[:-shift]) & small[shift:]) if len(fp) > shift else ()
        if not len(at):
            break
        at = at[np.bitwise_count(fp[at] ^ fp[at + shift]) <= max_bits]
        left.append(fp[at])
        right.append(fp[at + shift])
    for start, size in zip(starts[sizes > SMALL], sizes[sizes > SMALL], strict=True):
        members = fp[start:start + size]
        i, j = spanning_links(members, max_bits)
        left.append(members[i])
        right.append(members[j])
    none = np.zeros(0, np.uint64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def whole_buckets(batches: Iterator[pa.RecordBatch], at_least: int) -> Iterator[list[np.ndarray]]:
    """Columns of rows sorted by the first two, `at_least` rows at a time and cut only where those change."""
    held: list[list[np.ndarray]] = []
    size = 0
    for batch in batches:
        held.append([batch.column(i).to_numpy() for i in range(batch.num_columns)])
        size += batch.num_rows
        if size >= at_least:
            columns = [np.concatenate(c) for c in zip(*held, strict=True)]
            inside = (columns[0] == columns[0][-1]) & (columns[1] == columns[1][-1])
            end = size - int(inside.sum())
            if end:
                yield [c[:end] for c in columns]
            held, size = [[c[end:] for c in columns]], size - end
    if size:
        yield [np.concatenate(c) for c in zip(*held, strict=True)]


def links(fps: DataFrame, max_bits: int = MAX_BITS, segments: int | None = None, block: int = BLOCK) -> DataFrame:
    """Edges (a, b) whose components are those of all links among the distinct fingerprints `fps.fp`.

    Without `segments`, their number is chosen by the number of fingerprints.
    """
    if segments is None:
        segments = segments_for(fps.count(), max_bits)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, pair, fp in whole_buckets(batches, _ROWS_AT_ONCE):
            a, b = bucket_links(bucket, pair, fp.view(np.uint64), max_bits)
            for at in range(0, len(a), 1 << 16):
                yield pa.record_batch({"a": a[at:at + (1 << 16)].view(np.int64),
                                       "b": b[at:at + (1 << 16)].view(np.int64)})

    entries = _blocked(_entries(fps, max_bits, segments), block)
    rows = entries.select("bucket", "pair", "fp").repartition(F.col("bucket"), F.col("pair"))
    return rows.sortWithinPartitions("bucket", "pair").mapInArrow(verify, "a long, b long")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS, segments: int | None = None, block: int = BLOCK) -> DataFrame:
    """(key, fp, component): one row per row of `docs`; component is the smallest key reachable by links.

    Null or empty text (or text without words) has fingerprint 0 and is linked like any other.
    Repeated rows and equal texts share a fingerprint, hence a component. Null keys are kept, and
    are only a component's id when it has no other. An empty table gives no rows; other columns of
    `docs` are ignored.
    """
    named = _named(docs, key, text, shingle, max_bits, segments, block)
    return named.select(F.col("key").alias(key), "fp", "component")


def _named(docs: DataFrame, key: str, text: str, shingle: int, max_bits: int, segments: int | None, block: int) -> DataFrame:
    """(key, mark, fp, component, root) of each row: `mark` stands for its text, `root` for its component where two
    have the same smallest key. A large component, or a fingerprint of many rows, is joined in many tasks."""
    ids = materialize(with_fingerprint(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), shingle=shingle)
                      .select("key", text_key(F.col("text")).alias("mark"), "fp"), "simhash-fp")
    fps = materialize(ids.groupBy("fp").agg(F.min("key").alias("least")), "simhash-distinct")
    comps = connected_components(links(fps, max_bits, segments, block))
    rooted = fps.join(comps.select(F.col("node").alias("fp"), "component"), "fp", "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component"))
    named = dealt_join(rooted, least, "root", "fp").select("fp", "component", "root")
    return dealt_join(ids, named, "fp", "key", "mark").select("key", "mark", "fp", "component", "root")


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                         max_bits: int = MAX_BITS) -> DataFrame:
    """`docs` with one row left of each component: that of its smallest key.

    The dropped keys are written first, so that Spark knows their size when it plans the anti
    join: texts are shuffled only when the keys don't fit a broadcast. Rows that repeat a kept row
    are reduced to one in a second step that touches only those. Where a key has rows with unequal
    texts, or is null, a row is named by its key and text; of unequal texts with the smallest key of
    one component one stays. Rows with a null key are no component's smallest: one of each text stays.
    """
    found = materialize(_named(docs, key, text, shingle, max_bits, None, BLOCK).select("key", "mark", "component", "root"),
                        "simhash-components")
    mark = free_name(docs, "mark")
    unclear = found.groupBy("key").agg(F.min("mark").alias("least"), F.max("mark").alias("most"))
    if unclear.where("key IS NULL OR least <> most").isEmpty():
        names, rows = ["key"], docs
        lost, stays = F.expr("key <> component"), F.expr("key = component")
    else:
        names, rows = ["key", "mark"], docs.withColumn(mark, text_key(F.col(text)))
        found = found.groupBy("key", "mark", "component", "root").agg(F.count("*").alias("copies"))
        first = found.where("key = component")
        least = first.groupBy("key", "root").agg(F.min("mark").alias("mark")).withColumn("least", F.lit(True))
        first = first.join(least, ["key", "root", "mark"], "left")
        found = found.where("key IS NULL OR key <> component").withColumn("least", F.lit(None).cast("boolean")).unionByName(
            first)
        lost = F.expr("key IS NOT NULL AND least IS NULL")
        stays = F.expr("key IS NULL OR least")
    columns = [key, mark][:len(names)]
    others = [free_name(rows, f"gone_{name}") for name in names]

    def named(table: DataFrame, kind: str) -> tuple[DataFrame, Column]:
        table = materialize(table.select(*[F.col(n).alias(o) for n, o in zip(names, others, strict=True)]), kind)
        same = [rows[c].eqNullSafe(table[o]) for c, o in zip(columns, others, strict=True)]
        return table, reduce(Column.__and__, same)

    kept = rows.join(*named(found.where(lost).select(*names).distinct(), "simhash-drop"), "left_anti")
    times = F.sum("copies") if "copies" in found.columns else F.count("*")
    again, same = named(found.where(stays).groupBy(*names).agg(times.alias("times")).where("times > 1"), "simhash-repeated")
    if not again.isEmpty():
        once = kept.join(again, same, "left_semi").dropDuplicates(columns)
        kept = kept.join(again, same, "left_anti").unionByName(once)
    return kept.drop(mark)


__all__ = ["BLOCK", "MAX_BITS", "SHINGLE", "bucket_links", "drop_near_duplicates", "fingerprint", "links",
           "near_duplicates", "segment_plan", "segments_for", "spanning_links", "whole_buckets", "with_fingerprint"]
