"""Priorities under thresholds that are a table, one set of bars per deployment."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def priority_by_deployment(scored: DataFrame, bars: DataFrame, score: str = "risk_score", deployment: str = "deployment") -> DataFrame:
    """`scored` with `priority`: the highest bar of its deployment that the score reaches, else the lowest one.

    `bars` holds (deployment, priority, min_score). A deployment's few bars become one descending array, so
    that the interval join is an equi-join on the deployment: no range is compared across rows. A NaN
    score takes the lowest bar; a null score, or a deployment without bars, has no priority. Of equal bars, the
    first priority by name counts; bars without a bound or a priority are left out.
    """
    usable = bars.where("min_score IS NOT NULL AND priority IS NOT NULL")
    each = F.collect_set(F.struct((-F.col("min_score")).alias("m"), F.col("priority").alias("p")))
    sets = usable.groupBy(F.col(deployment).alias("_deployment")).agg(F.sort_array(each).alias("_bars"))
    value = F.col(score)
    reached = F.get(F.filter("_bars", lambda b: ~F.isnan(value) & (value >= -b["m"])), F.lit(0))["p"]
    priority = F.when(value.isNotNull(), F.coalesce(reached, F.element_at("_bars", -1)["p"]))
    return scored.join(sets, F.col(deployment) == F.col("_deployment"), "left").withColumn("priority", priority) \
        .drop("_deployment", "_bars")
