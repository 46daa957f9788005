"""Expectation suites: every column check of a suite is one aggregate of a single pass over the table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.session import stored


@dataclass(frozen=True)
class Expect:
    kind: str  # not_null, unique, in_set, between, match_regex, not_match_regex, row_count
    column: str = ""
    values: tuple = ()
    low: float | None = None
    high: float | None = None
    mostly: float = 1.0
    level: str = "critical"

    @property
    def name(self) -> str:
        return f"{self.level}:{self.kind}:{self.column or 'table'}"


def _good(e: Expect) -> Column:
    c = F.col(e.column)
    if e.kind == "in_set":
        return c.isin(*e.values)
    if e.kind == "between":
        ok = F.lit(True)
        if e.low is not None:
            ok = ok & (c >= e.low)
        if e.high is not None:
            ok = ok & (c <= e.high)
        return ok
    return c.rlike(e.values[0]) if e.kind == "match_regex" else ~c.rlike(e.values[0])


def run(df: DataFrame, suite: list[Expect]) -> DataFrame:
    """One row per expectation: name, level, seen, unexpected, success. A share of at least `mostly` must be good."""
    n = F.count(F.lit(1))
    aggs, later = [n.alias("n")], []
    for i, e in enumerate(suite):
        if e.kind == "row_count":
            continue
        if e.kind == "unique":
            later.append((i, e))
        elif e.kind == "not_null":
            aggs += [n.alias(f"s{i}"), F.count_if(F.col(e.column).isNull()).alias(f"u{i}")]
        else:
            aggs += [F.count(e.column).alias(f"s{i}"), F.count_if(F.col(e.column).isNotNull() & ~_good(e)).alias(f"u{i}")]
    one = df.agg(*aggs)
    for i, e in later:  # rows of values that are there more than once
        dup = df.where(F.col(e.column).isNotNull()).groupBy(e.column).agg(n.alias("c")).agg(F.coalesce(F.sum("c"), F.lit(0)).alias(f"s{i}"), F.coalesce(F.sum(F.when(F.col("c") > 1, F.col("c"))), F.lit(0)).alias(f"u{i}"))
        one = one.join(dup)  # one row each
    rows = []
    for i, e in enumerate(suite):
        if e.kind == "row_count":
            bad = (F.col("n") < (e.low or 0)) | (F.col("n") > (e.high if e.high is not None else 1 << 62))
            rows.append(F.struct(F.lit(e.name).alias("name"), F.lit(e.level).alias("level"), F.col("n").alias("seen"), bad.cast("long").alias("unexpected"), (~bad).alias("success")))
        else:
            s, u = F.col(f"s{i}"), F.col(f"u{i}")
            rows.append(F.struct(F.lit(e.name).alias("name"), F.lit(e.level).alias("level"), s.alias("seen"), u.alias("unexpected"), (s - u >= F.lit(e.mostly) * s).alias("success")))
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def passed(results: DataFrame) -> DataFrame:
    """success counts critical expectations only; evaluated, failed and warnings are for metrics."""
    bad = ~F.col("success")
    return results.agg((F.count_if(bad & (F.col("level") == "critical")) == 0).alias("success"), F.count(F.lit(1)).alias("evaluated"), F.count_if(bad).alias("failed"), F.count_if(bad & (F.col("level") == "warning")).alias("warnings"))


def scd2_integrity(history: DataFrame, key: str = "order_id") -> DataFrame:
    """Violations: several current versions, intervals that don't run forward, gaps in version numbers."""
    dup = history.where("is_current").groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.lit("duplicate_current").alias("check"), key)
    order = history.where("effective_to is not null and effective_from >= effective_to").select(F.lit("bad_interval").alias("check"), key)
    before = F.lag("record_version").over(Window.partitionBy(key).orderBy("record_version"))
    gap = history.withColumn("_b", before).where("_b is not null and record_version <> _b + 1").select(F.lit("version_gap").alias("check"), key)
    return dup.unionByName(order).unionByName(gap)


def negative_revenue(orders: DataFrame, key: str = "order_id", amount: str = "total_amount_usd") -> DataFrame:
    return orders.where(F.col(amount) < 0).select(key)


def several_current(users: DataFrame, key: str = "user_id_hashed") -> DataFrame:
    """Keys with more than one current row, and how many they have."""
    return users.where("is_current").groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def freshness(df: DataFrame, column: str, as_of: Column, warn_minutes: int = 30, error_minutes: int = 60) -> DataFrame:
    age = (F.unix_seconds(as_of.cast("timestamp")) - F.unix_seconds(F.max(column).cast("timestamp"))) / 60
    made = df.agg(age.alias("age_minutes"))
    return made.withColumn("state", F.when(F.col("age_minutes").isNull() | (F.col("age_minutes") > error_minutes), "error").when(F.col("age_minutes") > warn_minutes, "warn").otherwise("pass"))


def classifier_metrics(scored: DataFrame, ranges: int = 64) -> DataFrame:
    """auc, precision_at_half, recall_at_half, error and average_precision of rows (s: score, y: 0 or 1); null where nothing is to divide by.

    Rows are counted per distinct score first. Ranks are running counts over scores: within ranges of scores, and over the
    ranges' totals, which are the only rows that one task sees together. The ranges are written, so that both see the same.
    """
    by = scored.groupBy("s").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("p"))
    by = stored(by.repartitionByRange(ranges, "s").withColumn("_range", F.spark_partition_id()), "scores")
    totals = by.groupBy("_range").agg(F.sum("n").alias("_n"), F.sum("p").alias("_p"))
    below = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    totals = totals.select("_range", F.coalesce(F.sum("_n").over(below), F.lit(0)).alias("_n0"), F.coalesce(F.sum("_p").over(below), F.lit(0)).alias("_p0"), F.sum("_n").over(whole).alias("all_n"), F.sum("_p").over(whole).alias("all_p"))
    here = Window.partitionBy("_range").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    run = lambda c: F.coalesce(F.sum(c).over(here), F.lit(0))
    local = by.select("*", run("n").alias("_n1"), run("p").alias("_p1")).join(F.broadcast(totals), "_range")  # as many totals as ranges
    rank = F.col("_n0") + F.col("_n1") + (F.col("n") + 1) / 2
    above, found = F.col("all_n") - F.col("_n0") - F.col("_n1"), F.col("all_p") - F.col("_p0") - F.col("_p1")
    hot = F.col("s") >= 0.5
    t = local.agg(
        F.sum(rank * F.col("p")).alias("rs"), F.sum("p").alias("p"), F.sum("n").alias("n"), F.sum(F.when(hot, F.col("p")).otherwise(0)).alias("tp"), F.sum(F.when(hot, F.col("n")).otherwise(0)).alias("hot"),
        F.sum(F.col("p") * found / above).alias("ap"),
    )
    return t.selectExpr(
        "round(try_divide(rs - p * (p + 1) / 2.0D, p * (n - p)), 6) AS auc", "round(try_divide(tp, CAST(hot AS DOUBLE)), 6) AS precision_at_half", "round(try_divide(tp, CAST(p AS DOUBLE)), 6) AS recall_at_half",
        "round(try_divide(hot - tp + p - tp, CAST(n AS DOUBLE)), 6) AS error", "round(try_divide(ap, p), 6) AS average_precision",
    )
