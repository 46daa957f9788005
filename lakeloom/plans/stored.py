"""The chain of models as DataFrames, and which of them are tables.

Silver events, sessions, orders, dimensions and facts are written once and read, pruned, by whatever stands on them, so a
serving query scans the click stream at most once, and not at all once they are there. Facts and events are partitioned by
date; rebalancing before the write splits a date that is much larger than others over several files.

The SQL texts of the same models (domain.py, gold.py) aren't used here: they are what results are checked against.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.functions import constants as C
from lakeloom.functions import core
from lakeloom.operators import sessions, silver
from lakeloom.plans import domain

Get = Callable[[str], DataFrame]
TODAY = f"DATE'{domain.AS_OF}'"
BOUGHT = ("confirmed", "shipped", "delivered")


def cents(x: Column, digits: int = 2) -> Column:
    """Rounded after a nudge, so that a value on a tie rounds alike whatever the order of its sum."""
    return F.round(x + 1e-9, digits)


def since(day: str, n: int) -> Column:
    return F.col(day) >= F.date_sub(F.expr(TODAY), n)


# ---- tables


def silver_events(get: Get) -> DataFrame:
    return silver.refine(get("bronze_dup"), domain.SALT).select(
        "event_id", "user_id_hashed", "event_type", "event_ts", "ingested_at", "product_price_usd", "product_quantity", "product_sku", "device_type", "geo_country", "geo_city",
        "ab_cohort", "page_referrer", "fraud_score", "dq_flag", "geo_region", "event_date", "k", "seq",
    )


def session_rows(get: Get) -> DataFrame:
    return sessions.summarise(sessions.stitch(get("silver"), domain.GAP_MINUTES))


def attributed_orders(get: Get) -> DataFrame:
    """Each order with the latest session of its user that began in the half hour before it.

    Users' time is cut into half hours; a session is in its own and the next one, so one ordered pass over a user's half
    hour finds it, and no user's orders ever meet all of the user's sessions.
    """
    orders, visits = get("stg_orders"), get("silver_sessions")
    width = C.ATTRIBUTION_MIN * 60
    slot = lambda c: F.floor(F.unix_seconds(F.col(c).cast("timestamp")) / width)
    none = F.lit(None)
    began = visits.where("user_id_hashed is not null").select(
        "user_id_hashed", F.explode(F.array(slot("session_start_ts"), slot("session_start_ts") + 1)).alias("_slot"), F.col("session_start_ts").alias("_at"), F.lit(0).alias("_kind"),
        F.struct("session_start_ts", "session_id", "funnel_stage_reached").alias("_session"), none.cast("string").alias("order_id"),
    )
    placed = orders.where("user_id_hashed is not null").select(
        "user_id_hashed", slot("created_at").alias("_slot"), F.col("created_at").alias("_at"), F.lit(1).alias("_kind"), none.cast(began.schema["_session"].dataType).alias("_session"), "order_id"
    )
    w = Window.partitionBy("user_id_hashed", "_slot").orderBy("_at", "_kind", F.desc("_session.session_id")).rowsBetween(Window.unboundedPreceding, 0)
    met = began.unionByName(placed).withColumn("_last", F.last("_session", ignorenulls=True).over(w)).where("_kind = 1")
    near = F.col("_at") <= F.col("_last.session_start_ts") + F.expr(f"INTERVAL {C.ATTRIBUTION_MIN} MINUTE")
    found = met.where(near).select("order_id", F.col("_last.session_id").alias("attributed_session_id"), F.col("_last.funnel_stage_reached").alias("funnel_stage_reached"))
    return orders.join(found, "order_id", "left").select(*orders.columns, "attributed_session_id", "funnel_stage_reached")


def user_dimension(get: Get) -> DataFrame:
    """One current row per user, with the attributes of the user's latest event."""
    events, orders = get("silver"), get("silver_orders")
    at = F.struct("event_ts", (F.col("seq") % 1000).alias("tie"))
    base = events.where("user_id_hashed is not null").groupBy("user_id_hashed").agg(
        F.max_by("geo_country", at).alias("country"), F.max_by("geo_region", at).alias("geo_region"), F.max_by("device_type", at).alias("preferred_device"),
        F.max("event_date").alias("last_active_date"), F.min("event_date").alias("first_active_date"),
    )
    bought = events.where((F.col("event_type") == "purchase") & since("event_date", 90)).join(get("products").select(F.col("sku").alias("product_sku"), "category").where("category is not null"), "product_sku")
    liked = bought.groupBy("user_id_hashed", "category").agg(F.count(F.lit(1)).alias("n")).groupBy("user_id_hashed").agg(F.min_by("category", F.struct(-F.col("n"), "category")).alias("preferred_category"))
    recent = since("order_date", 90) & F.col("status").isin(*BOUGHT)
    spent = orders.groupBy("user_id_hashed").agg(F.sum(F.when(recent, F.col("total_amount_usd"))).alias("spent"), F.min("order_date").alias("first_order"))
    spend = F.coalesce(cents(F.col("spent")), F.lit(0.0))
    return base.join(spent, "user_id_hashed", "left").join(liked, "user_id_hashed", "left").select(
        core.surrogate_key(F.col("user_id_hashed")).alias("user_key"), "user_id_hashed", "country", "geo_region", F.coalesce("first_order", "first_active_date").alias("signup_date"), "last_active_date",
        "preferred_device", "preferred_category", core.ltv_band(spend).alias("ltv_band"), F.round(spend, 2).alias("spend_90d"), F.lit("regular").alias("user_segment"), F.lit(True).alias("is_current"),
    )


def _channels(get: Get) -> DataFrame:
    """session_id and the organic channel of the session's referrer."""
    own = get("silver_sessions").select("session_id", core.referrer_source(F.col("entry_referrer")).alias("source"), F.coalesce("ab_cohort", F.lit("none")).alias("cohort"))
    known = get("dim_channels").where("medium <> 'cpc'").select("channel_key", "source", F.coalesce("ab_cohort", F.lit("none")).alias("cohort"))
    return own.join(known, ["source", "cohort"]).select("session_id", "channel_key")


def _keys(rows: DataFrame, get: Get, user: str, country: str, session: str, day: str) -> DataFrame:
    """rows with the keys of their user, country, channel and date; -1 where there is none."""
    users = get("dim_users").select(F.col("user_id_hashed").alias("_user"), "user_key")
    places = get("dim_geography").select(F.col("country").alias("_country"), "geo_key")
    days = get("dim_date").select(F.col("full_date").alias("_day"), "date_key")
    channels = _channels(get).select(F.col("session_id").alias("_session"), "channel_key")
    for side, (own, key) in ((users, (user, "_user")), (places, (country, "_country")), (days, (day, "_day")), (channels, (session, "_session"))):
        rows = rows.join(side, F.col(own) == F.col(key), "left").drop(key)
    return rows.withColumns({k: F.coalesce(k, F.lit("-1")) for k in ("user_key", "geo_key", "channel_key")} | {"date_key": F.coalesce("date_key", F.lit(-1))})


def order_facts(get: Get) -> DataFrame:
    bought = get("silver").where("event_type = 'purchase' and product_sku is not null").select(F.concat(F.lit("o"), F.col("seq").cast("string")).alias("order_id"), "product_sku", F.coalesce("product_price_usd", F.lit(0.0)).alias("price"))
    dearest = bought.groupBy("order_id").agg(F.min_by("product_sku", F.struct(-F.col("price"), "product_sku")).alias("product_sku"))
    active = get("dim_products").where("is_active").select("product_key", F.col("sku").alias("product_sku"))
    rows = get("silver_orders").where("total_amount_usd > 0 or status <> 'cancelled'").join(dearest, "order_id", "left").join(active, "product_sku", "left")
    rows = _keys(rows, get, "user_id_hashed", "shipping_country", "attributed_session_id", "order_date")
    return rows.select(
        "order_id", "user_key", F.coalesce("product_key", F.lit("-1")).alias("product_key"), "channel_key", "geo_key", "date_key", "order_date", "total_amount_usd", "item_count", "discount_usd", "net_amount_usd",
        "order_tier", "days_consideration", "funnel_stage_reached", "attributed_session_id", "fraud_score", (F.col("fraud_score") > 0.7).alias("fraud_flagged"), "status", "payment_method", "shipping_country",
        "created_at", "updated_at",
    )


def session_facts(get: Get) -> DataFrame:
    return _keys(get("silver_sessions"), get, "user_id_hashed", "geo_country", "session_id", "session_date").select(
        "session_id", "user_key", "geo_key", "channel_key", "date_key", "session_date", "session_start_ts", "session_end_ts", "session_duration_s", "page_views", "product_views", "cart_adds", "cart_removes",
        "searches", "checkout_attempts", "purchases", "revenue_attributed_usd", "cart_value_usd", "cart_abandonment", F.col("funnel_stage_reached").alias("funnel_exit_stage"), "device_type", "max_fraud_score",
        "fraud_flagged", "ab_cohort",
    )


# ---- models computed when asked for


def first_orders(get: Get) -> DataFrame:
    return get("fct_orders").where(F.col("status").isin(*BOUGHT)).groupBy("user_key").agg(F.min("order_date").alias("first_order_date"))


def order_days(get: Get) -> DataFrame:
    """The median is exact up to a million orders a day: that is what the sketch's accuracy of a million means.

    Buyers are counted from one row for each (date, buyer), so no row is multiplied for the sake of several distinct counts.
    """
    rows = get("fct_orders").where(F.col("status").isin(*BOUGHT, "pending"))
    total, first, day = F.col("total_amount_usd"), F.col("first_order_date"), F.col("order_date")
    orders = rows.groupBy(day.alias("metric_date")).agg(
        F.countDistinct("order_id").alias("total_orders"), cents(F.sum(total)).alias("gross_revenue_usd"), cents(F.sum("net_amount_usd")).alias("net_revenue_usd"),
        cents(F.avg(total), 4).alias("avg_order_value_usd"), F.percentile_approx(total, 0.5, 1_000_000).alias("median_order_value_usd"), F.count_if("fraud_flagged").alias("flagged_fraud_orders"),
        F.round(F.coalesce(F.sum(F.when(F.col("fraud_flagged"), total)), F.lit(0.0)), 2).alias("fraud_exposure_usd"),
    )
    buyers = rows.where("user_key IS NOT NULL").groupBy("order_date", "user_key").agg(F.count(F.lit(1)).alias("n")).join(first_orders(get), "user_key", "left")
    buyers = buyers.groupBy(day.alias("_date")).agg(F.count(F.lit(1)).alias("unique_buyers"), F.count_if(first == day).alias("new_buyers"), F.count_if(first < day).alias("returning_buyers"))
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("unique_buyers", "new_buyers", "returning_buyers")]
    columns = ("total_orders", "gross_revenue_usd", "net_revenue_usd", "avg_order_value_usd", "median_order_value_usd", "flagged_fraud_orders", "fraud_exposure_usd")
    return orders.join(buyers, F.col("metric_date").eqNullSafe(F.col("_date")), "left").select("metric_date", *columns, *zero)


def session_days(get: Get) -> DataFrame:
    """Stages are counted from one row for each (date, session), visitors from one for each (date, visitor)."""
    reached = ("product_view", "add_to_cart", "checkout_start", "purchase")
    day, exit_ = F.col("session_date"), F.col("funnel_exit_stage")
    each = get("fct_sessions").groupBy("session_date", "session_id").agg(
        *[F.coalesce(F.bool_or(exit_.isin(*reached[i:])), F.lit(False)).alias(s) for i, s in enumerate(reached)],
        *[x for c in ("session_duration_s", "page_views") for x in (F.sum(c).alias(c), F.count(c).alias(f"{c}_n"))],
        F.count_if("cart_abandonment").alias("left"), F.count_if(F.col("cart_adds") > 0).alias("carted"),
    )
    mean = lambda c: F.try_divide(F.sum(c).cast("double"), F.sum(f"{c}_n"))
    sessions = each.groupBy(day.alias("metric_date")).agg(
        F.count("session_id").alias("total_sessions"), cents(mean("session_duration_s"), 4).alias("avg_session_duration_s"), cents(mean("page_views"), 4).alias("avg_page_views"),
        F.round(F.sum("left").cast("double") / F.nullif(F.sum("carted"), F.lit(0)), 6).alias("cart_abandonment_rate"), *[F.count_if(F.col(s) & F.col("session_id").isNotNull()).alias(f"{s}_sessions") for s in reached],
    )
    visitors = get("fct_sessions").where("user_key IS NOT NULL").groupBy("session_date", "user_key").agg(F.count(F.lit(1)).alias("n")).groupBy(day.alias("_date")).agg(F.count(F.lit(1)).alias("unique_visitors"))
    joined = sessions.join(visitors, F.col("metric_date").eqNullSafe(F.col("_date")), "left")
    stages = [f"{s}_sessions" for s in reached]
    return joined.select("metric_date", "total_sessions", F.coalesce("unique_visitors", F.lit(0).cast("long")).alias("unique_visitors"), "avg_session_duration_s", "avg_page_views", "cart_abandonment_rate", *stages)


def daily(get: Get) -> DataFrame:
    bought, visited = order_days(get), session_days(get)
    filled = {c: F.coalesce(c, F.lit(0).cast(t)).alias(c) for df in (bought, visited) for c, t in df.dtypes if c != "metric_date"}
    joined = bought.join(visited, "metric_date", "full").where("metric_date is not null")
    share = F.round(F.coalesce("flagged_fraud_orders", F.lit(0)) * 100.0 / F.nullif("total_orders", F.lit(0)), 6)
    converted = F.round(F.coalesce("purchase_sessions", F.lit(0)).cast("double") / F.nullif("total_sessions", F.lit(0)), 6)
    last = ("new_buyers", "returning_buyers")
    first = [filled[c] for c in bought.columns if c in filled and c not in last]
    return joined.select("metric_date", *first, share.alias("fraud_rate_pct"), *[filled[c] for c in visited.columns if c in filled], converted.alias("overall_conversion_rate"), *[filled[c] for c in last])


def order_features(get: Get) -> DataFrame:
    total, recent, quarter = F.col("total_amount_usd"), since("order_date", 30), since("order_date", 90)
    users = get("dim_users").where("is_current").select("user_key", "user_id_hashed")
    lost = (F.max("order_date") < F.date_sub(F.expr(TODAY), 30)) & (F.count_if(quarter) > 0)
    return get("fct_orders").join(users, "user_key").groupBy("user_key", "user_id_hashed").agg(
        F.count_if(recent).alias("order_count_30d"), F.count_if(quarter).alias("order_count_90d"), cents(F.avg(total), 4).alias("avg_order_value_usd"), F.max(total).alias("max_order_value_usd"),
        cents(F.sum(total)).alias("total_ltv_usd"), cents(F.avg("fraud_score"), 6).alias("avg_fraud_score"), F.round(F.count_if(F.col("discount_usd") > 0).cast("double") / F.count(F.lit(1)), 6).alias("discount_usage_rate"),
        F.count_if((F.col("status") == "refunded") & quarter).alias("refund_count_90d"), F.datediff(F.expr(TODAY), F.max("order_date")).cast("long").alias("days_since_last_order"), F.when(lost, 1).otherwise(0).alias("churned_30d"),
    )


def session_features(get: Get) -> DataFrame:
    left = F.col("funnel_exit_stage").isin("add_to_cart", "checkout_start")
    return get("fct_sessions").groupBy("user_key").agg(
        F.count_if(since("session_date", 7)).alias("session_count_7d"), F.count_if(since("session_date", 30)).alias("session_count_30d"), F.datediff(F.expr(TODAY), F.max("session_date")).cast("long").alias("days_since_last_session"),
        cents(F.avg("session_duration_s"), 4).alias("avg_session_duration_s"), cents(F.avg("page_views"), 4).alias("avg_pages_per_session"),
        F.coalesce(F.sum(F.when(since("session_date", 7), F.col("product_views"))), F.lit(0)).alias("product_view_count_7d"), cents(F.avg(F.when(left, 1.0).otherwise(0.0)), 6).alias("cart_abandonment_rate"),
    )


def top_channels(get: Get) -> DataFrame:
    named = get("fct_orders").join(get("dim_channels").select("channel_key", "channel_group"), "channel_key")
    counted = named.groupBy("user_key", "channel_group").agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy("user_key").agg(F.min_by("channel_group", F.struct(-F.col("n"), "channel_group")).alias("channel_group"))


def feature_rows(get: Get) -> DataFrame:
    users = get("dim_users").select("user_key", "preferred_category", "country")
    places = get("dim_geography").select("country", "is_gdpr_scope")
    rows = order_features(get).join(session_features(get), "user_key", "left").join(users, "user_key", "left").join(top_channels(get), "user_key", "left").join(places, "country", "left")
    zero = lambda *cs: [F.coalesce(c, F.lit(0).cast(dict(rows.dtypes)[c])).alias(c) for c in cs]
    never = lambda c: F.coalesce(c, F.lit(999)).alias(c)
    return rows.select(
        "user_id_hashed", never("days_since_last_order"), never("days_since_last_session"), *zero("session_count_7d", "session_count_30d"), "order_count_30d", "order_count_90d",
        (F.col("order_count_30d") / 4.0).alias("order_frequency_30d"),
        *zero("avg_order_value_usd", "total_ltv_usd", "max_order_value_usd", "discount_usage_rate", "cart_abandonment_rate", "avg_session_duration_s", "avg_pages_per_session", "product_view_count_7d"),
        core.encode_category(F.col("preferred_category"), C.CATEGORY_CODES).alias("preferred_category_encoded"), core.encode_category(F.col("channel_group"), C.CHANNEL_CODES).alias("channel_group_encoded"),
        *zero("avg_fraud_score"), "refund_count_90d", F.coalesce("is_gdpr_scope", F.lit(False)).cast("int").alias("is_gdpr_scope"), "churned_30d", F.lit(1).alias("is_current"),
    )


#: View name: how it is made here; TABLES are written, each with the column it is partitioned by. Products are one so that the planner sees the size
#: of rows with their hashed keys: from the size of the parts' file alone it broadcast them however many there were.
MODELS: dict[str, Callable[[Get], DataFrame]] = {
    "silver": silver_events, "sessions": session_rows, "silver_orders": attributed_orders, "dim_users": user_dimension, "fct_orders": order_facts, "fct_sessions": session_facts, "first_orders": first_orders,
    "order_days": order_days, "session_days": session_days, "agg_daily": daily, "feature_orders": order_features, "feature_sessions": session_features, "top_channel": top_channels, "features": feature_rows,
}
TABLES: dict[str, str | None] = {
    "silver": "event_date", "sessions": "session_date", "silver_orders": None, "dim_channels": None, "dim_geography": None, "dim_products": None, "dim_users": None, "fct_orders": "order_date", "fct_sessions": "session_date",
}
