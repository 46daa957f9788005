"""Session stitching: gaps of inactivity cut a user's events into sessions; one summary row per session."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.functions import constants as C
from lakeloom.functions import core


def stitch(events: DataFrame, gap_minutes: int = C.SESSION_GAP_S // 60, user: str = "user_id_hashed", ts: str = "event_ts", tie: str = "seq") -> DataFrame:
    """Add session_no and session_id; an event `gap_minutes` or more after the one before opens a session."""
    w = Window.partitionBy(user).orderBy(ts, tie)
    before = F.lag(ts).over(w)
    opens = F.when(before.isNull() | (F.col(ts) >= before + F.expr(f"INTERVAL {gap_minutes} MINUTE")), 1).otherwise(0)
    made = events.withColumn("_opens", opens).withColumn("session_no", F.sum("_opens").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_opens")
    return made.withColumn("session_id", core.surrogate_key(F.col(user), F.col("session_no")))


def _metrics(tie: str) -> list[Column]:
    n = lambda t: F.count_if(F.col("event_type") == t)
    at = F.struct("event_ts", tie)
    price, quantity = F.coalesce("product_price_usd", F.lit(0.0)), F.coalesce("product_quantity", F.lit(0))
    bought = F.sum(F.when(F.col("event_type") == "purchase", price).otherwise(0.0))
    carted = F.sum(F.when(F.col("event_type") == "add_to_cart", price * F.when(quantity == 0, 1).otherwise(quantity)).when(F.col("event_type") == "remove_from_cart", -price).otherwise(0.0))
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    return [
        F.min("event_ts").alias("session_start_ts"), F.max("event_ts").alias("session_end_ts"), F.to_date(F.min("event_ts")).alias("session_date"),
        F.floor((micros(F.max("event_ts")) - micros(F.min("event_ts"))) / 1_000_000).alias("session_duration_s"), F.count(F.lit(1)).alias("event_count"),
        n("page_view").alias("page_views"), n("product_view").alias("product_views"), n("add_to_cart").alias("cart_adds"), n("remove_from_cart").alias("cart_removes"),
        n("search").alias("searches"), n("checkout_start").alias("checkout_attempts"), n("purchase").alias("purchases"),
        F.round(bought, 4).alias("revenue_attributed_usd"), F.round(F.greatest(carted, F.lit(0.0)), 4).alias("cart_value_usd"),
        ((n("add_to_cart") > 0) & (n("purchase") == 0)).alias("cart_abandonment"), core.funnel_stage(F.max(core.funnel_depth(F.col("event_type")))).alias("funnel_stage_reached"),
        F.min_by("device_type", at).alias("device_type"), F.min_by("geo_country", at).alias("geo_country"), F.min_by("ab_cohort", at).alias("ab_cohort"),
        F.min_by("page_referrer", at).alias("entry_referrer"), F.max_by("event_type", at).alias("exit_event_type"),
        F.max("fraud_score").alias("max_fraud_score"), (F.max("fraud_score") >= C.FRAUD_ALERT).alias("fraud_flagged"),
    ]


def summarise(stitched: DataFrame, user: str = "user_id_hashed", tie: str = "seq") -> DataFrame:
    """One row per session by map-side combinable aggregates: no session is collected."""
    return stitched.groupBy("session_id", user).agg(*_metrics(tie))
