"""Cell index over vectors, with exact top-k by the triangle inequality (K3).

k-means on a bounded sample gives the cells' centres; every row of the table is put into its nearest
centre's cell, with its distance to it. Cosine works on unit vectors, whose distance orders like it.
No row of a cell is nearer to a query than the query's distance to the centre less the cell's radius,
nor than the difference of the two distances to the centre. A search scores the nearest cells first,
which gives each query an upper limit for its k-th best distance; then only cells, and in them rows,
that these bounds don't rule out are joined by cell and scored exactly.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize
from .retrieval import dot, l2, norm

#: Rows that the centres are fitted on, and the most centres (a table of them goes to every task).
SAMPLE = 20_000
MOST_CELLS = 4096
ROUNDS = 8
#: Rows scored for the limit, times k.
SEEDS = 20
#: Distances are computed in floating point; bounds leave more room than that can err.
_ROOM = 1e-6


def _matrix(column: pa.Array, unit: bool) -> np.ndarray:
    rows = np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(column), -1)
    if unit:
        lengths = np.linalg.norm(rows, axis=1, keepdims=True)
        rows = rows / np.where(lengths > 0, lengths, 1.0)
    return rows


def _distances(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    squares = (rows ** 2).sum(1)[:, None] + (centres ** 2).sum(1) - 2 * rows @ centres.T
    return np.sqrt(np.maximum(squares, 0.0))


def fit_centres(sample: np.ndarray, cells: int, rounds: int = ROUNDS) -> np.ndarray:
    """Lloyd's algorithm from evenly spaced sample rows; an empty cell keeps its centre."""
    centres = sample[np.linspace(0, len(sample) - 1, min(cells, len(sample))).astype(int)].copy()
    for _ in range(rounds):
        nearest = _distances(sample, centres).argmin(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, sample)
        counts = np.bincount(nearest, minlength=len(centres))
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centres


@dataclass
class CellIndex:
    """rows: vec_id, label, embedding, cell, away (distance to the cell's centre); cells: cell, n, radius."""

    rows: DataFrame
    cells: DataFrame
    centres: np.ndarray
    metric: str

    @classmethod
    def build(cls, embeddings: DataFrame, root: str, metric: str = "cosine", cells: int | None = None) -> CellIndex:
        """Write an index of (vec_id, label, embedding) under a shared folder. Vectors are non-empty and of one length."""
        if metric not in ("cosine", "l2"):
            raise ValueError("metric must be cosine or l2")
        spark, unit = embeddings.sparkSession, metric == "cosine"
        vectors = embeddings.select("vec_id", "label", "embedding")
        n = vectors.count()
        cells = min(MOST_CELLS, max(1, round(n ** 0.5))) if cells is None else cells
        drawn = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("embedding").toArrow().column(0)
        centres = fit_centres(_matrix(drawn.combine_chunks(), unit), cells) if n else np.zeros((0, 0))

        def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                away = _distances(_matrix(batch.column("embedding"), unit), centres)
                cell = away.argmin(1)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(cell.astype(np.int32)), pa.array(away[np.arange(len(cell)), cell])],
                    names=[*batch.schema.names, "cell", "away"])

        kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in vectors.schema)
        vectors.mapInArrow(placed, f"{kinds}, cell int, away double").repartitionByRange("cell", "away").sortWithinPartitions(
            "cell", "away").write.parquet(f"{root}/rows")
        rows = spark.read.parquet(f"{root}/rows")
        rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("away").alias("radius")).write.parquet(f"{root}/cells")
        return cls(rows, spark.read.parquet(f"{root}/cells"), centres, metric)

    def _scored(self, pairs: DataFrame, queries: DataFrame) -> DataFrame:
        """Exact scores of (query_id, vec_id, label, embedding), by the same sums as a scan."""
        d = pairs.join(queries.select("query_id", "qv"), "query_id")
        score = l2(F.col("embedding"), F.col("qv")) if self.metric == "l2" else F.try_divide(
            dot(F.col("embedding"), F.col("qv")), norm(F.col("embedding")) * norm(F.col("qv")))
        return d.select("query_id", "vec_id", "label", score.alias("score")).where("score IS NOT NULL")

    def _best(self, scored: DataFrame, k: int) -> DataFrame:
        score = F.col("score").asc() if self.metric == "l2" else F.col("score").desc()
        order = Window.partitionBy("query_id").orderBy(score, F.col("vec_id").asc())
        return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    def candidates(self, queries: DataFrame, k: int) -> DataFrame:
        """(query_id, vec_id, label, embedding): rows that the bounds don't rule out of the k best."""
        spark, centres, unit = queries.sparkSession, self.centres, self.metric == "cosine"
        if not len(centres):
            return self.rows.select(F.lit(0).cast("long").alias("query_id"), "vec_id", "label", "embedding").limit(0)

        def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                away = _distances(_matrix(batch.column("qv"), unit), centres)
                n, c = away.shape
                yield pa.RecordBatch.from_arrays([
                    batch.column("query_id").take(pa.array(np.repeat(np.arange(n), c))),
                    pa.array(np.tile(np.arange(c, dtype=np.int32), n)), pa.array(away.ravel())], names=["query_id", "cell", "q_away"])

        kind = queries.schema["query_id"].dataType.simpleString()
        near = materialize(queries.select("query_id", "qv").mapInArrow(measured, f"query_id {kind}, cell int, q_away double").join(
            self.cells, "cell"), "cells-near")
        nearest = Window.partitionBy("query_id").orderBy("q_away", "cell").rowsBetween(Window.unboundedPreceding, -1)
        first = near.withColumn("before", F.coalesce(F.sum("n").over(nearest), F.lit(0))).where(F.col("before") < SEEDS * k)
        seeds = first.select("query_id", "cell").join(self.rows, "cell").drop("cell", "away")
        worst = self._best(self._scored(seeds, queries), k).where(F.col("rank") == k)
        # the cosine s of unit vectors at distance d is 1 - d * d / 2
        limit = F.col("score") if self.metric == "l2" else F.sqrt(F.greatest(2 - 2 * F.col("score"), F.lit(0.0)))
        limits = worst.select("query_id", (limit * (1 + _ROOM) + _ROOM).alias("limit"))
        kept = near.join(limits, "query_id", "left").where("limit IS NULL OR q_away - radius <= limit")
        joined = kept.select("query_id", "cell", "q_away", "limit").join(self.rows, "cell")
        return joined.where("limit IS NULL OR abs(q_away - away) <= limit").select("query_id", "vec_id", "label", "embedding")

    def search(self, queries: DataFrame, k: int = 5) -> DataFrame:
        """Exact top-k rows per query (query_id, qv): (query_id, rank, vec_id, label, score); ties by vec_id. A vector
        without direction has no cosine and is left out."""
        return self._best(self._scored(self.candidates(queries, k), queries), k).select(
            "query_id", "rank", "vec_id", "label", "score")


def centroid_queries(spark: SparkSession, centroids: list[tuple[int, list[float]]]) -> DataFrame:
    return spark.createDataFrame(centroids, "query_id int, qv array<double>")
