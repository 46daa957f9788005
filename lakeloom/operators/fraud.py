"""Fraud scoring over each user's past, in event order: the batch form of the stateful stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.functions import constants as C
from lakeloom.functions.core import local_hour

# Signals in their order, with their weights.
SIGNALS = {"VELOCITY_SPIKE": 0.4, "GEO_HOP": 0.5, "UNUSUAL_HOUR": 0.2, "RAPID_PURCHASE": 0.35, "CART_OVERFLOW": 0.25}


def score(events: DataFrame, user: str = "user_id", ts: str = "event_ts", tie: str = "seq") -> DataFrame:
    """Add fraud_score and fraud_signals; state is reset by a gap of 15 minutes, but for the last country and time.

    Needs event_type, geo_country, product_quantity; geo_timezone is used if there.
    """
    w = Window.partitionBy(user).orderBy(ts, tie)
    past = w.rowsBetween(Window.unboundedPreceding, -1)
    at = F.unix_micros(F.col(ts).cast("timestamp"))
    df = events.withColumn("_at", at)
    df = df.withColumns({"_last": F.lag("_at").over(w), "_country": F.last(F.expr("nullif(geo_country, '')"), ignorenulls=True).over(past)})
    df = df.withColumn("_island", F.sum(F.when(F.col("_last").isNull() | (F.col("_at") - F.col("_last") >= C.SESSION_GAP_S * 1_000_000), 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    inside = Window.partitionBy(user, "_island").orderBy(ts, tie)
    df = df.withColumns({
        "_count": F.row_number().over(inside) - 1,
        "_viewed": F.max(F.when(F.col("event_type") == "product_view", F.col("_at"))).over(inside.rowsBetween(Window.unboundedPreceding, -1)),
    })
    hour = local_hour(F.col(ts).cast("timestamp"), F.col("geo_timezone") if "geo_timezone" in events.columns else F.lit(None).cast("string"))
    bought = F.col("event_type") == "purchase"
    hits = {
        "VELOCITY_SPIKE": (F.col("_count") > 20) & (F.col("_at") - F.col("_last") < 60_000_000),
        "GEO_HOP": F.col("_country").isNotNull() & (F.coalesce("geo_country", F.lit("")) != "") & (F.col("_country") != F.col("geo_country")),
        "UNUSUAL_HOUR": bought & hour.isin(2, 3),
        "RAPID_PURCHASE": bought & (F.col("_at") - F.col("_viewed") < 30_000_000),
        "CART_OVERFLOW": (F.col("event_type") == "add_to_cart") & (F.coalesce("product_quantity", F.lit(0)) > 50),
    }
    total = sum((F.when(hits[s], v).otherwise(0.0) for s, v in SIGNALS.items()), F.lit(0.0))
    named = F.array_compact(F.array(*[F.when(hits[s], F.lit(s)) for s in SIGNALS]))
    made = df.withColumns({"fraud_score": F.round(F.least(total, F.lit(1.0)), 4), "fraud_signals": named})
    return made.drop("_at", "_last", "_country", "_island", "_count", "_viewed")


def alerts(scored: DataFrame) -> DataFrame:
    return scored.where(F.col("fraud_score") >= C.FRAUD_ALERT)
