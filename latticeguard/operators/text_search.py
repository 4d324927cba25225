"""Trigram index for substring search.

Every text's distinct trigrams are postings. A term of three letters or more is looked up by its own
trigrams: rows that have all of them are candidates, which the text itself then verifies; shorter
terms have no trigram and scan the texts. Rows are indexed where they are read, a block at a time: a
posting list holds the rows of one block that have one trigram, so building shuffles nothing. A
lookup reads the few trigrams asked for and intersects each block's lists by themselves; only
candidates' texts are joined.
"""
from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

GRAM = 3


def grams(text: Column) -> Column:
    """Distinct trigrams of a text (none if it is shorter)."""
    last = F.length(text) - (GRAM - 1)
    places = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(places, lambda i: F.substring(text, i, F.lit(GRAM))))


def _posting_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One batch of (uid, hay) is a block: its distinct trigrams in order, each with the rows that have it."""
    for batch in batches:
        uids, lists = batch.column("uid").to_pylist(), defaultdict(list)
        for uid, text in zip(uids, batch.column("hay").to_pylist(), strict=True):
            for gram in {text[i:i + GRAM] for i in range(len(text) - GRAM + 1)}:
                lists[gram].append(uid - uids[0])
        held = sorted(lists)
        yield pa.RecordBatch.from_arrays(
            [pa.array(held, pa.string()), pa.array([uids[0]] * len(held), pa.int64()),
             pa.array([lists[g] for g in held], pa.list_(pa.int64()))], names=["gram", "block", "places"])


@dataclass
class TrigramIndex:
    """texts: the indexed rows with uid and hay (lower-cased text); postings: gram, block (its first uid), places (the
    uids in the block, counted from its first)."""

    texts: DataFrame
    postings: DataFrame

    @classmethod
    def build(cls, rows: DataFrame, hay: str, root: str) -> TrigramIndex:
        """Index the column `hay`, in lower case, of any rows, under a shared folder; null has no posting. Each row is one
        of its own."""
        spark = rows.sparkSession
        rows.withColumn("hay", F.lower(F.col(hay))).withColumn("uid", F.monotonically_increasing_id()).write.parquet(f"{root}/texts")
        spark.read.parquet(f"{root}/texts").where("hay IS NOT NULL").select("uid", "hay").mapInArrow(
            _posting_lists, "gram string, block long, places array<long>").write.parquet(f"{root}/postings")
        return cls.open(spark, root)

    @classmethod
    def open(cls, spark: SparkSession, root: str) -> TrigramIndex:
        return cls(spark.read.parquet(f"{root}/texts"), spark.read.parquet(f"{root}/postings"))

    def candidates(self, terms: list[str]) -> DataFrame:
        """(term, uid): rows that have all trigrams of a term."""
        spark = self.texts.sparkSession
        asked = spark.createDataFrame([(t,) for t in terms], "term string").withColumn("grams", grams(F.col("term")))
        each = asked.select("term", F.size("grams").alias("wanted"), F.explode("grams").alias("gram"))
        read = {t[i:i + GRAM] for t in terms for i in range(len(t) - GRAM + 1)}
        found = self.postings.where(F.col("gram").isin(sorted(read))).join(F.broadcast(each), "gram")
        lists = found.groupBy("term", "wanted", "block").agg(F.collect_list("places").alias("lists")).where(F.size("lists") == F.col("wanted"))
        common = F.aggregate("lists", F.get("lists", F.lit(0)), lambda kept, places: F.array_intersect(kept, places))
        return lists.select("term", "block", F.explode(common).alias("place")).select("term", (F.col("block") + F.col("place")).alias("uid"))

    def search(self, terms: tuple[str, ...]) -> DataFrame:
        """The indexed rows, with `term`, whose text contains a term, in any case. The empty term is in every text."""
        asked = sorted({t.lower() for t in terms})
        long, short = [t for t in asked if len(t) >= GRAM], [t for t in asked if len(t) < GRAM]
        found = self.candidates(long).join(self.texts, "uid").where(F.contains("hay", "term"))
        scanned = self.texts.withColumn("term", F.explode(F.array(*map(F.lit, short)).cast("array<string>"))).where(
            F.contains("hay", "term"))
        columns = ["term", *(c for c in self.texts.columns if c not in ("uid", "hay", "term"))]
        return found.select(*columns).unionByName(scanned.select(*columns))
