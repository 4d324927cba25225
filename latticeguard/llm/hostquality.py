"""Host-level quality rules.

Every document is measured by fixed rules; their failures are added up by host. A host's failure
rate is shrunk towards the rate of all hosts by a beta prior that is fitted to the hosts themselves
(method of moments), so a host with few documents is judged mostly by the prior. A host whose
shrunk rate is too high loses all its documents; of the other hosts, only documents that fail the
base rules go.

The measures need one pass over the texts, row by row in Arrow batches. Hosts are aggregated
map-side (a host with a third of the rows costs one row per task) and the table of rejected hosts
is written before it is joined back, so Spark can broadcast it when it is small and split the hot
host otherwise.
"""
from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from latticeguard.llm.common import binary_values, free_name, materialize, with_scratch

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: More of these rules' failures count against the host, not against the document itself.
MAX_SYMBOL_PERCENT = 10
MAX_DUP_LINES = 20
#: Hosts with a higher shrunk failure rate are rejected.
HOST_RATE = 0.5
#: Prior strength (in documents) when hosts don't differ, and its least value.
MAX_STRENGTH = 1000.0
MIN_STRENGTH = 2.0

_SPACE = b" \t\n\x0b\x0c\r"
_SYMBOLS = b"#*$%&|<>"
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_TYPE = pa.struct([(name, pa.int64()) for name in STATS])


def text_stats(text: bytes | None) -> tuple[int, int, int, int, int]:
    """The five measures, in the order of STATS, of UTF-8 text (words: runs without ASCII white space)."""
    if not text:
        return 0, 0, 0, 0, 0
    words = text.split()
    solid = text.translate(None, _SPACE)
    chars = len(solid.decode())
    symbols = len(solid) - len(solid.translate(None, _SYMBOLS))
    lines = [line for line in text.split(b"\n") if line.strip()]
    windows = list(zip(words, words[1:], words[2:], strict=False))
    repeated = 0
    if len(set(windows)) < len(windows):
        counts, covered = Counter(windows), 0
        for i, window in enumerate(windows):
            if counts[window] > 1:
                repeated += i + 3 - max(i, covered)
                covered = i + 3
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated


@F.arrow_udf(T.StructType([T.StructField(name, T.LongType()) for name in STATS]))
def _stats(column: pa.Array) -> pa.Array:
    rows = [dict(zip(STATS, text_stats(t), strict=True)) for t in binary_values(column)]
    return pa.array(rows, _TYPE)


def base_failed(s: str = "") -> F.Column:
    """The base rules over columns named as in STATS (with the prefix `s`)."""
    n = F.col(f"{s}n_words")
    return (n < MIN_WORDS) | (F.col(f"{s}n_repeat_words") * 100 > n * MAX_REPEAT_PERCENT)


def _failed(s: str = "") -> F.Column:
    return (base_failed(s) | (F.col(f"{s}n_symbols") * 100 > F.col(f"{s}word_chars") * MAX_SYMBOL_PERCENT)
            | (F.col(f"{s}n_dup_lines") > MAX_DUP_LINES))


def document_stats(docs: DataFrame, text: str = "text", into: str = "stats") -> DataFrame:
    """`docs` with a struct column of the five measures; null text has none of anything."""
    return docs.withColumn(into, _stats(F.col(text)))


def host_rates(measured: DataFrame, host: str, stats: str = "stats") -> DataFrame:
    """(host, docs, fails, rate): failures by host, shrunk by the beta prior fitted to all hosts.

    Rows with a null or empty host belong to no host and count nowhere.
    """
    hosts = (measured.where(f"`{host}` <> ''").groupBy(F.col(host).alias("host"))
             .agg(F.count("*").alias("docs"), F.sum(_failed(f"{stats}.").cast("long")).alias("fails")))
    hosts = hosts.withColumn("raw", F.col("fails") / F.col("docs"))
    prior = hosts.agg(F.avg("raw").alias("m"), F.var_pop("raw").alias("v")).select(
        "m", F.greatest(F.lit(MIN_STRENGTH), F.least(F.lit(MAX_STRENGTH), F.when(
            F.col("v") > 0, F.col("m") * (1 - F.col("m")) / F.col("v") - 1).otherwise(MAX_STRENGTH))).alias("strength"))
    prior = prior.select(F.struct("m", "strength")).scalar()
    return (hosts.withColumn("prior", prior)
            .select("host", "docs", "fails", ((F.col("fails") + F.col("prior.m") * F.col("prior.strength"))
                                              / (F.col("docs") + F.col("prior.strength"))).alias("rate")))


def rejected_hosts(measured: DataFrame, host: str, stats: str = "stats", limit: float = HOST_RATE) -> DataFrame:
    """(host): those whose shrunk rate is over `limit`, as a written table."""
    found = host_rates(measured, host, stats).where(F.col("rate") > limit).select("host")
    return materialize(found, "rejected-hosts")


def judge(docs: DataFrame, key: str = "doc_id", host: str = "source", text: str = "text") -> DataFrame:
    """(key, the five measures, base_failed, kept) for every row of `docs`.

    Null and empty texts have no words and fail; a row without a host is judged by the base rules
    alone; repeated rows each count and each get a row; an empty table gives no rows.
    """
    measured = materialize(document_stats(docs.select(F.col(key).alias("key"), F.col(host).alias("host"),
                                                      F.col(text).alias("text"))).drop("text"), "quality")
    bad = rejected_hosts(measured, "host").withColumn("bad", F.lit(True))
    out = measured.join(bad, "host", "left").select("key", "stats.*", "bad")
    failed = base_failed()
    return out.select(F.col("key").alias(key), *STATS, failed.alias("base_failed"),
                      (~failed & F.col("bad").isNull()).alias("kept"))


def keep_good(docs: DataFrame, host: str = "source", text: str = "text") -> DataFrame:
    """The rows of `docs` that `judge` keeps, with their columns as they were, whatever those are called.

    Every text is measured once: the rows are written with their measures, and both the hosts' rates and
    the filter read that table (`release_scratch` deletes it once the result is written). Rows with a null or
    empty host are judged by the base rules alone; null and empty texts go; of repeated rows, all stay or go.
    """
    bad_host, stats = free_name(docs, "rejected_host"), free_name(docs, "stats")
    measured = materialize(document_stats(docs, text, stats), "quality-rows")
    bad = rejected_hosts(measured, host, stats)
    good = measured.where(~base_failed(f"{stats}.")).join(
        bad.select(F.col("host").alias(bad_host)), F.col(host) == F.col(bad_host), "left_anti").drop(stats)
    return with_scratch(good, measured, bad)
