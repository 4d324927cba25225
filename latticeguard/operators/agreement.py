"""Pairwise agreement of orders (M14): distributed inversion counting, exact, with no pair written out.

Two orders agree on a pair of items if both put the same item first. With codes x and y of an
item's places, the pairs that agree are counted digit by digit of x: two codes differ first in one
digit, so every pair belongs to one level and one group (the digits above). In a group, rows sorted
by y are read once, with a count per digit: each row adds the rows before it that have a smaller
digit. Rows are dealt by ranges of (group, y), so ranges are equal in size however the two orders
are related; what a group's earlier ranges hold is added from the ranges' digit counts.

Rows that a level can't tell apart are summed up before they are dealt, so an item, place or score
that holds a third of all rows is one row a digit. Pairs tied in either order come from group sizes.
A level is one aggregation and one range shuffle of narrow rows; there are log(2n) / DIGIT_BITS of them.
"""
from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize, release

DIGIT_BITS = 10
#: Rows that are compared with each other at once; runs of an equal (group, y) stay together.
CHUNK = 512
_EXACT = "decimal(38,0)"


class _Range:
    """Counts one range of rows sorted by (group, y): pairs inside it, and its first and last group's digits."""

    def __init__(self, digits: int):
        self.digits = digits
        self.pairs: dict[int, int] = {}
        self.group: int | None = None
        self.first: tuple[int, np.ndarray] | None = None
        self.counts = np.zeros(digits, np.int64)

    def add(self, g: np.ndarray, y: np.ndarray, d: np.ndarray, m: np.ndarray) -> None:
        before = np.zeros(len(g), np.int64)
        held = g == self.group if self.group is not None else np.zeros(len(g), bool)
        before[held] = (np.cumsum(self.counts) - self.counts)[d[held]]
        before += ((g[:, None] == g) & (y[:, None] < y) & (d[:, None] < d)).T @ m
        for group in np.unique(g).tolist():
            mine = g == group
            self.pairs[group] = self.pairs.get(group, 0) + sum(a * b for a, b in zip(before[mine].tolist(), m[mine].tolist(), strict=True))
            if group != self.group:
                if self.group is not None and self.first is None:
                    self.first = (self.group, self.counts)
                self.group, self.counts = group, np.zeros(self.digits, np.int64)
            np.add.at(self.counts, d[mine], m[mine])

    def ends(self) -> list[tuple[int, np.ndarray]]:
        """Digit counts of the groups that other ranges may hold too."""
        out = [self.first] if self.first is not None else []
        return out + ([(self.group, self.counts)] if self.group is not None else [])


def _whole_runs(starts: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Slices of at least CHUNK rows that begin and end with runs (but for a shorter last one)."""
    cuts = [0]
    for at in starts.tolist():
        if at - cuts[-1] >= CHUNK:
            cuts.append(at)
    return list(zip(cuts, [*cuts[1:], n], strict=True)) if n else []


def _level(points: DataFrame, shift: int, above: int) -> DataFrame:
    """(s, pairs): agreeing pairs whose x codes differ first in the digit at `shift`."""
    digits = 1 << DIGIT_BITS
    rows = points.groupBy(
        F.shiftright("x", shift + DIGIT_BITS).alias("g"), "y",
        F.shiftright("x", shift).bitwiseAND(digits - 1).cast("int").alias("d")).agg(F.sum("m").alias("m"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, state, kept = TaskContext.get().partitionId(), _Range(digits), None
        for batch in batches:
            new = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("g", "y", "d", "m")]
            g, y, d, m = new if kept is None else (np.concatenate(c) for c in zip(kept, new, strict=True))
            starts = np.flatnonzero((np.diff(g) != 0) | (np.diff(y) != 0)) + 1
            whole = int(starts[-1]) if starts.size else 0  # the last run may go on in the next batch
            for a, b in _whole_runs(starts[:-1], whole):
                state.add(g[a:b], y[a:b], d[a:b], m[a:b])
            kept = [c[whole:] for c in (g, y, d, m)]
        if kept is not None and len(kept[0]):
            state.add(*kept)
        inside = [(g, -1, -1, str(n)) for g, n in state.pairs.items() if n]
        ends = [(g, part, d, str(n)) for g, counts in state.ends() for d, n in enumerate(counts.tolist())]
        yield pa.RecordBatch.from_pydict(
            dict(zip(("g", "part", "d", "n"), (list(c) for c in zip(*(inside + ends), strict=True)), strict=True))
            if inside or ends else {"g": [], "part": [], "d": [], "n": []},
            schema=pa.schema([("g", pa.int64()), ("part", pa.int32()), ("d", pa.int32()), ("n", pa.string())]))

    found = rows.repartitionByRange("g", "y").sortWithinPartitions("g", "y").mapInArrow(
        counted, "g long, part int, d int, n string").withColumn("n", F.col("n").cast(_EXACT))
    found = materialize(found, "agreement-level")
    inside = found.where("part < 0").select("g", F.col("n").alias("pairs"))
    earlier = Window.partitionBy("g", "d").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    smaller = Window.partitionBy("g", "part").orderBy("d").rowsBetween(Window.unboundedPreceding, -1)
    across = found.where("part >= 0").withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)).cast(_EXACT)) \
        .withColumn("before", F.coalesce(F.sum("before").over(smaller), F.lit(0)).cast(_EXACT)) \
        .select("g", (F.col("n") * F.col("before")).cast(_EXACT).alias("pairs"))
    out = materialize(inside.unionByName(across).groupBy(F.shiftright("g", above).cast("int").alias("s")).agg(
        F.sum("pairs").cast(_EXACT).alias("pairs")), "agreement-pairs")
    release(found)
    return out


def agreeing_pairs(points: DataFrame, largest: int) -> DataFrame:
    """(s, pairs): per system s, the weighted pairs of points that both x and y put in the same order.

    `points` has s int, x long and y long (0..largest, equal where tied) and a weight m long.
    """
    levels = max(1, -(-max(1, int(largest).bit_length()) // DIGIT_BITS))
    bits = levels * DIGIT_BITS
    whole = materialize(points.select(
        (F.col("s").cast("long") * (1 << bits) + F.col("x")).alias("x"), "y", "m"), "agreement-points")
    found = [_level(whole, at * DIGIT_BITS, (levels - 1 - at) * DIGIT_BITS) for at in range(levels)]
    release(whole)
    return reduce(DataFrame.unionByName, found).groupBy("s").agg(F.sum("pairs").cast(_EXACT).alias("pairs"))


def _pairs_of(n: Column) -> Column:
    n = n.cast(_EXACT)
    return (n * (n - 1) / 2).cast(_EXACT)


def pairwise_agreement(systems: dict[str, DataFrame], reference: DataFrame, key: str) -> DataFrame:
    """How often each system's order agrees with the reference order, over all pairs of items.

    Each frame has `key` and `rank` (ties averaged, so twice a rank is a whole number); items that one of the
    two lacks are left out. One row per system: n, comparable (pairs the reference doesn't tie), concordant,
    discordant, tied (comparable pairs that the system ties) and agreement = (concordant + tied / 2) /
    comparable, null if nothing is comparable.
    """
    names = sorted(systems)
    code = F.round(F.col("rank") * 2).cast("long")
    ref = reference.select(key, code.alias("y"))
    each = [systems[name].select(key, F.lit(i).alias("s"), code.alias("x")) for i, name in enumerate(names)]
    joined = reduce(DataFrame.unionByName, each).join(ref, key).where("x IS NOT NULL AND y IS NOT NULL")
    points = materialize(joined.groupBy("s", "x", "y").agg(F.count(F.lit(1)).alias("m")), "agreement-orders")
    largest = points.agg(F.max(F.greatest("x", "y"))).first()[0] or 0
    agreeing = agreeing_pairs(points, largest)

    def tied(*by: str) -> DataFrame:
        sizes = points.groupBy("s", *by).agg(F.sum("m").alias("c"))
        return sizes.groupBy("s").agg(F.sum(_pairs_of(F.col("c"))).cast(_EXACT).alias("t_" + "".join(by)))

    sums = points.groupBy("s").agg(F.sum("m").alias("n")).join(agreeing, "s", "left")
    for by in (("x",), ("y",), ("x", "y")):
        sums = sums.join(tied(*by), "s")
    comparable = _pairs_of(F.col("n")) - F.col("t_y")
    in_system = F.col("t_x") - F.col("t_xy")
    concordant = F.coalesce("pairs", F.lit(0).cast(_EXACT))
    name = F.element_at(F.array(*map(F.lit, names)), F.col("s") + 1)
    return sums.select(
        name.alias("system"), "n", comparable.cast(_EXACT).alias("comparable"), concordant.alias("concordant"),
        (comparable - in_system - concordant).cast(_EXACT).alias("discordant"), in_system.cast(_EXACT).alias("tied")).withColumn(
        "agreement", F.try_divide(F.col("concordant").cast("double") + F.col("tied").cast("double") / 2,
                                  F.col("comparable").cast("double")))
