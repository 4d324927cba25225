"""The corpus pipeline: each stage applies one training-data operator to all that its predecessor kept.

Every stage reads `docs` (the columns of `documents`) and returns a DataFrame; `run` writes it as
Parquet to the shared checkpoint folder and reads it again as the next stage's input. All but the
last return the columns of `documents`; the last returns the packed pieces.

Null and empty texts go in the first stage; a row with a null or empty source is judged by itself alone.
A stage decides by row: of repeated rows, one stays after near-dedup. Where a doc_id is null or shared
by unequal texts, a row is named by doc_id and text. Extra columns of `documents` are carried on,
whatever they are called, and an empty table gives no pieces.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from latticeguard.llm import decontaminate, hostquality, linededup, packing, simhash
from latticeguard.llm.common import documents, materialize, read_table, release_scratch
from latticeguard.session import release

#: SQL has neither the tokenizer nor the fingerprints' hash; tests/llm compares run() with brute force.
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the host-level rules reject go."""
    return hostquality.keep_good(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of a site are cut out of its texts; `n_chars` follows the text."""
    cut = linededup.drop_boilerplate(docs)
    return cut.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.lit(0).cast("long")))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays: the one with the smallest doc_id."""
    return simhash.drop_near_duplicates(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap a benchmark item go."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, packed into windows: one row per piece."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_stage),
    ("simhash_near_dedup", near_duplicate_stage),
    ("benchmark_decontamination", benchmark_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; what a stage has read is deleted once its successor is written."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        made = stage(spark, docs, sf_dir)
        kept = materialize(made, f"pipeline-{name}")
        release_scratch(made)
        release(docs)
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)
