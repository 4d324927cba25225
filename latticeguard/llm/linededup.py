"""Line dedup by site-relative frequency, in DataFrame functions only.

A site's boilerplate is a line that stands on a large share of the site's own pages. Pages of a
host are counted by their content, so exact copies of one page are one page and can't turn their
own text into boilerplate. Lines are compared without surrounding blanks; blank lines never count.

Only 96-bit line keys are shuffled, never texts: lines become (host, line key, page key) rows that
are aggregated map-side, and a line that stands on every page is dealt out by its page key. What is
left per host is the list of its boilerplate keys, at most (lines per page) / ratio of them. That
table is written first, so Spark knows its size when it plans the join back: it is broadcast when
it fits, and otherwise joined with skew handling.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from latticeguard.llm.common import free_name, materialize

#: A line on more than this share of a host's pages is boilerplate.
RATIO = 0.1
#: and on at least so many of them: small hosts say nothing about a line seen once or twice.
MIN_PAGES = 4
BLANKS = " \t\r\u000b\f"


def _key(text: Column) -> Column:
    return F.struct(F.xxhash64(text).alias("a"), F.hash(text).alias("b"))


def _bare(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANKS))


def boilerplate(docs: DataFrame, host: str = "source", text: str = "text", ratio: float = RATIO,
                min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, keys): the keys of each host's boilerplate lines; hosts without any are left out."""
    rows = docs.select(F.col(host).alias("host"), F.col(text).alias("text")).where("host <> '' AND text IS NOT NULL")
    totals = rows.select("host", _key(F.col("text")).alias("page")).groupBy("host").agg(
        F.countDistinct("page").alias("total"))
    bare = F.array_distinct(F.filter(F.transform(F.split("text", "\n"), _bare), lambda x: x != ""))
    lines = rows.select("host", _key(F.col("text")).alias("page"), F.explode(F.transform(bare, _key)).alias("line"))
    counts = lines.groupBy("host", "line").agg(F.countDistinct("page").alias("pages")).where(F.col("pages") >= min_pages)
    return (counts.join(totals, "host").where(F.col("pages") > F.lit(float(ratio)) * F.col("total"))
            .groupBy("host").agg(F.collect_list("line").alias("keys")))


def drop_boilerplate(docs: DataFrame, host: str = "source", text: str = "text", ratio: float = RATIO,
                     min_pages: int = MIN_PAGES, dropped: str | None = None) -> DataFrame:
    """`docs` with boilerplate lines cut out of `text`; `dropped` names an optional count column.

    Null text stays null, empty text empty. A row with a null or empty host belongs to no site and
    keeps every line. Repeated rows count as one page and are treated alike. An empty table gives
    no rows. All columns of `docs` keep their names and order.
    """
    found = materialize(boilerplate(docs, host, text, ratio, min_pages), "boilerplate")
    site, keys, lines, kept = (free_name(docs, x) for x in ("site", "site_keys", "all_lines", "kept_lines"))
    found = found.select(F.col("host").alias(site), F.col("keys").alias(keys))
    joined = docs.join(found, F.col(host) == F.col(site), "left")
    split = joined.withColumn(lines, F.when(F.col(keys).isNotNull(), F.split(F.col(text), "\n")))
    cut = split.withColumn(kept, F.filter(lines, lambda x: ~F.array_contains(F.col(keys), _key(_bare(x)))))
    new_text = F.when(F.col(kept).isNotNull(), F.array_join(kept, "\n")).otherwise(F.col(text)).alias(text)
    columns = [new_text if c.lower() == text.lower() else F.col(f"`{c}`") for c in docs.columns]
    if dropped:
        columns.append(F.coalesce(F.size(lines) - F.size(kept), F.lit(0)).alias(dropped))
    return cut.select(*columns)
