"""Nested documents in pages (J6, O6): an asset's findings and a phase's items, a bounded number to a row.

Collecting all items of an asset or phase into one row would put an unbounded group into one task.
An exact rank cuts each group into pages first; a page is one nested, sorted row.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .planner import bucketed_row_number

PAGE = 50
#: Orders whose findings share one bucket of the rank.
ORDERS = 1024


def asset_pages(head: DataFrame, findings: DataFrame, page: int = PAGE) -> DataFrame:
    """The columns of `head` (one row per asset) with page, n_pages and `findings`, an array of at most `page`
    structs in the order of the finding's key; an asset without findings has one page with none."""
    f = findings.select("asset_id", "order_key", "line_no", "finding_id", "algorithm", "key_size", "quantum_vulnerable")
    ranked = bucketed_row_number(f.withColumn("_b", F.floor(F.col("order_key") / ORDERS)), ["asset_id"], "_b",
                                 [F.col("order_key").asc(), F.col("line_no").asc()], "_rn")
    item = F.struct(F.col("_rn").alias("place"), "finding_id", "algorithm", "key_size", "quantum_vulnerable")
    pages = ranked.groupBy("asset_id", F.floor((F.col("_rn") - 1) / page).cast("int").alias("page")).agg(
        F.array_sort(F.collect_list(item)).alias("findings"))
    n = findings.groupBy("asset_id").agg(F.ceil(F.count(F.lit(1)) / page).cast("int").alias("n_pages"))
    none = F.array().cast(pages.schema["findings"].dataType)
    return head.join(n, "asset_id", "left").join(pages, "asset_id", "left").select(
        *(f"`{c}`" for c in head.columns), (F.coalesce("page", F.lit(0)) + 1).alias("page"),
        F.coalesce("n_pages", F.lit(1)).alias("n_pages"), F.coalesce("findings", none).alias("findings"))


def plan_pages(plan: DataFrame, page: int = PAGE) -> DataFrame:
    """(phase, page, n_items of the phase, items): each phase's items in plan order, at most `page` to a row."""
    sizes = plan.groupBy("phase").agg(F.count(F.lit(1)).alias("n_items"))
    item = F.struct("rank", "asset_id", "level", "score", "reasoning")
    pages = plan.groupBy("phase", (F.floor((F.col("rank") - 1) / page) + 1).cast("int").alias("page")).agg(
        F.array_sort(F.collect_list(item)).alias("items"))
    return pages.join(sizes, "phase").select("phase", "page", "n_items", "items")
