"""Ranks and prefix sums over a total order, without a task that holds one group.

Rows are range-partitioned by (group, order) and written once with the number of their range; only one row
per (range, group) is summed across ranges. A group with a third of all rows spreads over a third of the ranges.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm.common import materialize, partitions


def running(
    df: DataFrame,
    group: str | None,
    order: Sequence[str],
    value: Column | None = None,
    totals_with: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Add `rank` (0-based place in the group), `before` (sum of value on earlier rows of the group),
    `group_rows` and `group_value`.

    Ties in `order` are broken arbitrarily, so callers order by a key under which tied rows are alike. A null
    group is a group. `totals_with` may add columns to the small table of (range, group) totals.
    """
    n = 2 * partitions(df.sparkSession)
    made = df.withColumns({"_g": F.coalesce(F.col(group), F.lit("")) if group else F.lit(""), "_null": F.col(group).isNull() if group else F.lit(False), "_v": (F.lit(0) if value is None else value).cast("long")})
    made = materialize(made.repartitionByRange(n, "_null", "_g", *order).withColumn("_range", F.spark_partition_id()), "ranges")
    each = made.groupBy("_range", "_null", "_g").agg(F.count(F.lit(1)).alias("_n"), F.sum("_v").alias("_sum"))
    whole = Window.partitionBy("_null", "_g")
    earlier = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = each.select(
        "_range", "_null", "_g",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_n0"),
        F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_v0"),
        F.sum("_n").over(whole).alias("group_rows"),
        F.sum("_sum").over(whole).alias("group_value"),
    )
    if totals_with is not None:
        totals = totals_with(totals)
    here = Window.partitionBy("_range", "_null", "_g").orderBy(*order)
    local = made.withColumns({
        "_i": F.row_number().over(here) - 1,
        "_s": F.sum("_v").over(here.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_v"),
    })
    out = local.join(totals, ["_range", "_null", "_g"])
    return out.withColumns({"rank": F.col("_n0") + F.col("_i"), "before": F.col("_v0") + F.col("_s")}).drop("_range", "_null", "_g", "_v", "_n0", "_v0", "_i", "_s")
