"""Helpers the training-data operators share: table access, row-safe columns, scratch tables."""
from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from latticeguard.session import checkpoint_dir, materialize, release
from latticeguard.sources.tables import read_table

#: Tasks over which the rows of one key are dealt.
DEALT = 256

__all__ = ["binary_values", "checkpoint_dir", "dealt_join", "documents", "free_name", "materialize", "read_table",
           "release_scratch", "text_key", "text_or_empty", "with_scratch"]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def with_scratch(df: DataFrame, *tables: DataFrame) -> DataFrame:
    """`df`, which reads the written `tables`: `release_scratch` deletes them when `df` is no longer needed."""
    df._scratch_tables = tables
    return df


def release_scratch(df: DataFrame) -> None:
    for table in getattr(df, "_scratch_tables", ()):
        release(table)


def text_key(text: Column) -> Column:
    """96 bits that stand for a text (or for null) where rows are named by it."""
    return F.struct(F.xxhash64(text).alias("a"), F.hash(text).alias("b"))


def dealt_join(many: DataFrame, one: DataFrame, on: str, *by: str) -> DataFrame:
    """Inner join of `many` with `one`, which has at most one row per `on`; a hot key's rows are dealt out by `by`.

    `one` is repeated only for the shares that a key really has: at most `DEALT` rows a key, and never
    more than `many` has. Rows with a null key join nothing.
    """
    many = many.withColumn("_share", F.pmod(F.xxhash64(*by), F.lit(DEALT)).cast("int"))
    shares = many.select(on, "_share").distinct().join(one, on)
    return many.join(shares, [on, "_share"]).drop("_share")


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that `df` does not have yet (names compare without case, as Spark does)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted


def binary_values(column: pa.Array) -> Iterator[bytes | None]:
    """UTF-8 bytes of each text of an Arrow string column (None for null), one at a time."""
    for value in column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()):
        yield value.as_py()
