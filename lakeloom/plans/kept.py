"""Views kept up to date: a row of sums for each date and group, of which only the dates that have changed are made anew.

The source is a folder of rows by date. A refresh reads the given dates' folders and replaces those dates of the view; what is reported by
longer spans is added up from the dates' rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Kept:
    """A view by the source's column `day`: its rows of given source rows, and what a reader makes of all rows."""

    day: str
    rows: Callable[[DataFrame], DataFrame]
    shown: Callable[[DataFrame], DataFrame]


def source_rows(spark: SparkSession, source: str, day: str, dates: Iterable[date] | None) -> DataFrame:
    """Rows of the dates, by the source's folders."""
    rows = spark.read.parquet(source)
    return rows if dates is None else rows.where(F.col(day).isin(*sorted(dates)))


def refresh(spark: SparkSession, view: Kept, source: str, path: str, dates: Iterable[date] | None = None) -> None:
    """Make the view's rows of the dates anew (of all, without dates); a date that the source has no rows of any more leaves the view."""
    dates = None if dates is None else set(dates)
    if dates is not None and not dates:
        return
    made = view.rows(source_rows(spark, source, view.day, dates))
    made.write.mode("overwrite").option("partitionOverwriteMode", "static" if dates is None else "dynamic").partitionBy(view.day).parquet(path)
    if dates is None:
        return
    there = {r[0] for r in source_rows(spark, source, view.day, dates).select(view.day).distinct().collect()}  # of the given dates
    jpath = spark._jvm.org.apache.hadoop.fs.Path
    for gone in dates - there:
        folder = jpath(f"{path}/{view.day}={gone.isoformat()}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def append(rows: DataFrame, source: str, day: str) -> set[date]:
    """Add rows to the source's folders and tell which dates they are of: as many as the increment has."""
    rows.write.mode("append").partitionBy(day).parquet(source)
    return {r[0] for r in rows.select(day).distinct().collect()}


def read(spark: SparkSession, view: Kept, path: str) -> DataFrame:
    return view.shown(spark.read.parquet(path))


_PLACE = ("country", "country_name", "region")


def _country_day(orders: DataFrame) -> DataFrame:
    """orders: fct_orders with its place's columns. Buyers are counted from one row for each (date, place, buyer)."""
    by, total = ["order_date", *_PLACE], F.col("total_amount_usd")
    sums = orders.groupBy(*by).agg(
        F.countDistinct("order_id").alias("orders"), F.sum(total).alias("revenue"), F.count(total).alias("n"), F.sum("net_amount_usd").alias("net"), F.sum(F.when(F.col("fraud_flagged"), total).otherwise(0.0)).alias("exposed")
    )
    buyers = orders.where("user_key IS NOT NULL").groupBy(*by, "user_key").agg(F.count(F.lit(1)).alias("n")).groupBy(*[F.col(c).alias(f"_{c}") for c in by]).agg(F.count(F.lit(1)).alias("buyers"))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]
    return sums.join(buyers, same, "left").select(*by, "orders", F.coalesce("buyers", F.lit(0).cast("long")).alias("unique_buyers"), "revenue", "n", "net", "exposed")


def _shown_country_day(rows: DataFrame) -> DataFrame:
    cents = lambda c, n=2: F.round(c + 1e-9, n)
    return rows.select(
        "order_date", *_PLACE, "orders", "unique_buyers", cents(F.col("revenue")).alias("revenue_usd"), cents(F.col("net")).alias("net_revenue_usd"),
        cents(F.try_divide("revenue", "n"), 4).alias("aov_usd"), cents(F.col("exposed")).alias("fraud_exposure_usd"),
    )


COUNTRY_DAY = Kept("order_date", _country_day, _shown_country_day)
#: A session is of one date, so a week's sessions are the sum of its dates'.
WEEKLY_FUNNEL = Kept(
    "session_date",
    lambda rows: rows.groupBy("session_date", "funnel_exit_stage").agg(F.countDistinct("session_id").alias("sessions"), F.sum("revenue_attributed_usd").alias("revenue")),
    lambda rows: rows.groupBy(F.date_trunc("week", "session_date").cast("date").alias("week_start"), "funnel_exit_stage").agg(F.sum("sessions").alias("sessions"), F.round(F.sum("revenue") + 1e-9, 2).alias("revenue_usd")),
)
