"""Micro-batch classification of a findings stream.

The reference has no streaming. Encode, classify and bucket are pure row
functions, so the same expressions run unchanged on a streaming DataFrame:
`readStream` over the lineitem parquet (one file here, a landing folder on a
cluster) -> per-row finding attributes -> `foreachBatch` that classifies each
micro-batch against the broadcast vulnerability table and writes it to its own
partition of a parquet table. The checkpoint lives under the session's spark.checkpoint.dir,
so a restarted query resumes where it stopped.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.inventory import ALGORITHM_BY_PART_MOD, _pick, classify, vuln_table

LINEITEM_SCHEMA = ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                   "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                   "l_linestatus string, l_shipdate timestamp_ntz")


def finding_stream(spark: SparkSession, sf_dir: str, max_files_per_trigger: int = 1) -> DataFrame:
    raw = (spark.readStream.schema(LINEITEM_SCHEMA)
           .option("pathGlobFilter", "lineitem.parquet")
           .option("maxFilesPerTrigger", max_files_per_trigger)
           .parquet(sf_dir))
    return raw.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("finding_id"),
        F.when(F.col("l_returnflag") == "N", F.lit("repo_scan")).otherwise(F.lit("tls_scan")).alias("source"),
        _pick(F.col("l_partkey") % 10, ALGORITHM_BY_PART_MOD).alias("algorithm"),
        F.col("l_shipdate").alias("discovered_at"),
    )


def run_classification(spark: SparkSession, sf_dir: str, out_path: str, checkpoint_path: str):
    """Process everything available now, append classified findings to `out_path`; returns the query."""
    vt = vuln_table(spark)

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        # a replayed batch overwrites its own folder instead of being appended twice
        classify(batch, vt).drop("family").write.mode("overwrite").parquet(f"{out_path}/batch_id={epoch_id}")

    q = (finding_stream(spark, sf_dir).writeStream.foreachBatch(write_batch)
         .option("checkpointLocation", checkpoint_path).trigger(availableNow=True).start())
    q.awaitTermination()
    return q
