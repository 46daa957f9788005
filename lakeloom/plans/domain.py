"""Commerce views over the star-schema tables: one SQL text per view, rendered for either dialect.

The tables have no click stream of the domain's shape, so its columns follow from the event's integer property k and
value by fixed rules. Every "now" is the constant AS_OF.
"""

from __future__ import annotations

from lakeloom.functions import constants as C
from lakeloom.plans.dialect import Spark

SALT = "lakeloom-demo-salt"
AS_OF = "2024-01-31"
GAP_MINUTES = 360

REFERRERS = ["https://www.google.com/search?q=x", "https://facebook.com/p", "https://l.instagram.com/", "https://www.bing.com/", "", None, "https://mail.example/newsletter", "https://blog.example/a", "https://m.fb.com/x", "https://WWW.GOOGLE.de/"]
COUNTRIES = ["US", "GB", "DE", "FR", "IN", "JP", "BR", "ZA"]
STATUSES = ["confirmed", "shipped", "delivered", "cancelled", "pending", "refunded", "archived"]
#: Tables of the driver that Spark must read for a view.
TABLES = "region nation customer supplier part orders lineitem events".split()


def _case(expr: str, table: dict, default: str) -> str:
    lit = lambda v: f"'{v}'" if isinstance(v, str) else str(v)
    return f"CASE {expr} " + " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in table.items()) + f" ELSE {default} END"


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def region_case(col: str) -> str:
    return f"CASE WHEN {col} IS NULL THEN 'UNKNOWN' " + " ".join(f"WHEN {col} IN {_in(m)} THEN '{r}'" for r, m in C.REGIONS.items()) + " ELSE 'OTHER' END"


def source_case(col: str) -> str:
    r = f"lower({col})"
    return (
        f"CASE WHEN {r} LIKE '%google%' THEN 'google' WHEN {r} LIKE '%bing%' THEN 'bing' WHEN {r} LIKE '%facebook%' OR {r} LIKE '%fb.com%' THEN 'facebook' "
        f"WHEN {r} LIKE '%instagram%' THEN 'instagram' WHEN {r} LIKE '%email%' OR {r} LIKE '%newsletter%' THEN 'email' WHEN {col} IS NULL OR trim({col}) = '' THEN 'direct' ELSE 'referral' END"
    )


def band_case(price: str, null: str) -> str:
    return f"CASE WHEN {price} IS NULL THEN '{null}' WHEN {price} < 25 THEN 'budget' WHEN {price} < 100 THEN 'mid' WHEN {price} < 300 THEN 'premium' ELSE 'luxury' END"


def tier_case(x: str, high: float = 200, mid: float = 50) -> str:
    return f"CASE WHEN {x} >= {high} THEN 'high_value' WHEN {x} >= {mid} THEN 'mid_value' ELSE 'low_value' END"


TYPE_OF = {"view": "product_view", "click": "add_to_cart", "signup": "checkout_start", "purchase": "purchase", "error": "page_view"}
DEPTH = _case("event_type", C.FUNNEL_DEPTH, "0")


def bronze(d: Spark) -> str:
    return f"""
        SELECT 'e' || CAST(event_id AS STRING) AS event_id, 'u' || CAST(user_id AS STRING) AS user_id, {_case("event_type", TYPE_OF, "'unknown'")} AS event_type,
            ts AS event_ts, ts + INTERVAL 5 SECOND AS ingested_at, value AS product_price_usd, k AS product_quantity,
            CASE WHEN k % 13 <> 0 THEN CAST(k + 1 AS STRING) END AS product_sku, {d.pick("k % 3", ["desktop", "mobile", "tablet"])} AS device_type,
            CASE WHEN k % 31 <> 0 THEN {d.pick("k % 8", COUNTRIES)} END AS geo_country, 'City' || CAST(k % 5 AS STRING) AS geo_city,
            {d.pick("k % 3", ["A", "B", None])} AS ab_cohort, k % 17 = 0 AS is_bot, k % 23 = 0 AS is_internal,
            CASE WHEN k % 19 = 0 THEN 'CRITICAL' WHEN k % 7 = 0 THEN 'WARNING' END AS dq_flag, {d.pick("k % 10", REFERRERS)} AS page_referrer,
            CAST(k % 100 AS DOUBLE) / 125 AS fraud_score, k, event_id AS seq
        FROM (SELECT *, {d.json_int("props", "k")} AS k FROM events) src"""


def bronze_dup(d: Spark) -> str:
    """Bronze with every tenth event delivered once more, half a minute later."""
    if d.name == "duck":
        return "SELECT * FROM bronze UNION ALL SELECT * REPLACE (ingested_at + INTERVAL 30 SECOND AS ingested_at) FROM bronze WHERE k % 10 = 0"
    cols = "event_id, user_id, event_type, event_ts, {}, product_price_usd, product_quantity, product_sku, device_type, geo_country, geo_city, ab_cohort, is_bot, is_internal, dq_flag, page_referrer, fraud_score, k, seq"
    again = "LATERAL VIEW explode(CASE WHEN k % 10 = 0 THEN array(0, 30) ELSE array(0) END) copies AS late"
    return f"SELECT {cols.format('ingested_at + make_interval(0, 0, 0, 0, 0, 0, late) AS ingested_at')} FROM bronze {again}"


def silver(d: Spark) -> str:
    """Latest copy of each event that is neither a bot's, internal nor critical; pseudonymous, masked, with region and date."""
    return f"""
        SELECT event_id, {d.hmac("user_id", SALT)} AS user_id_hashed, event_type, event_ts, ingested_at, product_price_usd, product_quantity, product_sku, device_type, geo_country,
            CASE WHEN geo_country IN {_in(C.GDPR_COUNTRIES)} THEN 'MASKED' ELSE geo_city END AS geo_city, ab_cohort, page_referrer, fraud_score, dq_flag,
            {region_case("geo_country")} AS geo_region, CAST(event_ts AS DATE) AS event_date, k, seq
        FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ingested_at DESC, k) AS rn FROM bronze_dup) latest
        WHERE rn = 1 AND NOT coalesce(is_bot, false) AND NOT coalesce(is_internal, false) AND coalesce(dq_flag, '') <> 'CRITICAL'"""


def stitched(d: Spark, minutes: int = GAP_MINUTES) -> str:
    """Events with the start of their session: a gap of `minutes` or more opens a new one."""
    return f"""
        SELECT *, sum(opens) OVER (PARTITION BY user_id_hashed ORDER BY event_ts, seq ROWS UNBOUNDED PRECEDING) AS session_no
        FROM (SELECT *, CASE WHEN lag(event_ts) OVER w IS NULL OR event_ts >= lag(event_ts) OVER w + INTERVAL {minutes} MINUTE THEN 1 ELSE 0 END AS opens
            FROM silver WINDOW w AS (PARTITION BY user_id_hashed ORDER BY event_ts, seq)) gaps"""


def sessions(d: Spark) -> str:
    stage = "CASE max(depth) " + " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(C.FUNNEL_STAGES)) + " END"
    n = lambda t: f"count_if(event_type = '{t}')"
    first, last = (lambda c: f"nullif(min_by(coalesce({c}, '~'), seq_key), '~')"), (lambda c: f"max_by({c}, seq_key)")
    return f"""
        SELECT {d.key("user_id_hashed", "session_no")} AS session_id, user_id_hashed,
            min(event_ts) AS session_start_ts, max(event_ts) AS session_end_ts, CAST(min(event_ts) AS DATE) AS session_date,
            {d.seconds("max(event_ts)", "min(event_ts)")} AS session_duration_s, count(*) AS event_count,
            {n("page_view")} AS page_views, {n("product_view")} AS product_views, {n("add_to_cart")} AS cart_adds, {n("remove_from_cart")} AS cart_removes,
            {n("search")} AS searches, {n("checkout_start")} AS checkout_attempts, {n("purchase")} AS purchases,
            round(coalesce(sum(CASE WHEN event_type = 'purchase' THEN product_price_usd END), CAST(0 AS DOUBLE)), 4) AS revenue_attributed_usd,
            round(greatest(coalesce(sum(CASE WHEN event_type = 'add_to_cart' THEN product_price_usd * CASE WHEN coalesce(product_quantity, 0) = 0 THEN 1 ELSE product_quantity END
                WHEN event_type = 'remove_from_cart' THEN -product_price_usd END), CAST(0 AS DOUBLE)), CAST(0 AS DOUBLE)), 4) AS cart_value_usd,
            {n("add_to_cart")} > 0 AND {n("purchase")} = 0 AS cart_abandonment, {stage} AS funnel_stage_reached,
            {first("device_type")} AS device_type, {first("geo_country")} AS geo_country, {first("ab_cohort")} AS ab_cohort,
            {first("page_referrer")} AS entry_referrer, {last("event_type")} AS exit_event_type, max(fraud_score) AS max_fraud_score, max(fraud_score) >= {C.FRAUD_ALERT} AS fraud_flagged
        FROM (SELECT *, {DEPTH} AS depth, {d.micros("event_ts")} * 1000 + seq % 1000 AS seq_key FROM stitched) s
        GROUP BY user_id_hashed, session_no"""


def silver_sessions(d: Spark) -> str:
    return "SELECT * FROM sessions WHERE session_id IS NOT NULL AND user_id_hashed IS NOT NULL"


def web_orders(d: Spark) -> str:
    """An order for every purchase event, in the shape of current order rows."""
    return f"""
        SELECT 'o' || CAST(seq AS STRING) AS order_id, user_id_hashed, {d.pick("k % 7", STATUSES)} AS status, round(product_price_usd * (1 + k % 3) + 1e-9, 2) AS total_amount_usd,
            CASE WHEN k % 4 <> 0 THEN round(product_price_usd * (k % 5) / 20 + 1e-9, 2) END AS discount_usd, CAST(1 + k % 4 AS INT) AS item_count, geo_country AS shipping_country,
            {d.pick("k % 3", ["card", "wallet", None])} AS payment_method, fraud_score, event_ts AS created_at, event_ts + INTERVAL 1 HOUR AS updated_at,
            event_ts - INTERVAL 30 HOUR AS first_cart_at, product_sku
        FROM silver WHERE event_type = 'purchase'"""


def stg_orders(d: Spark) -> str:
    return f"""
        SELECT order_id, user_id_hashed, status, total_amount_usd, coalesce(discount_usd, 0) AS discount_usd, round(total_amount_usd - coalesce(discount_usd, 0), 2) AS net_amount_usd,
            item_count, shipping_country, payment_method, coalesce(fraud_score, 0) AS fraud_score, created_at, updated_at, CAST(created_at AS DATE) AS order_date,
            {tier_case("total_amount_usd")} AS order_tier, {d.days("CAST(created_at AS DATE)", "CAST(first_cart_at AS DATE)")} AS days_consideration
        FROM web_orders WHERE status IN {_in(C.ORDER_STATUSES)}"""


def silver_orders(d: Spark) -> str:
    """Each order with the latest session of its user that began in the half hour before it."""
    return f"""
        SELECT o.*, a.session_id AS attributed_session_id, a.funnel_stage_reached
        FROM stg_orders o LEFT JOIN (
            SELECT o.order_id, s.session_id, s.funnel_stage_reached, row_number() OVER (PARTITION BY o.order_id ORDER BY s.session_start_ts DESC, s.session_id) AS rn
            FROM stg_orders o JOIN silver_sessions s ON o.user_id_hashed = s.user_id_hashed AND o.created_at >= s.session_start_ts
                AND o.created_at <= s.session_start_ts + INTERVAL {C.ATTRIBUTION_MIN} MINUTE) a ON o.order_id = a.order_id AND a.rn = 1"""


def products(d: Spark) -> str:
    """The catalogue: one row per part."""
    cost = "round(p_retailprice * (30 + p_size) / 100 + 1e-9, 2)"
    price = "CASE WHEN p_partkey % 29 <> 0 THEN p_retailprice / (1 + p_partkey % 40) END"
    return f"""
        SELECT CAST(p_partkey AS STRING) AS sku, p_name AS name, lower(trim(p_type)) AS category, p_brand AS brand, {price} AS price_usd, {cost} AS cost_usd,
            CASE WHEN {price} > 0 THEN round(({price} - {cost}) / ({price}) * 100, 2) END AS margin_pct, p_partkey % 11 <> 0 AS is_active, p_size, p_partkey
        FROM part"""


def checked_events(d: Spark) -> str:
    """Bronze events with the wire columns that suites look at; some break the rules."""
    return f"""
        SELECT *, {d.hmac("user_id", SALT)} AS user_id_hashed, CASE WHEN k % 61 <> 0 THEN concat('s', CAST(k % 97 AS STRING)) END AS session_id,
            CASE WHEN k % 53 <> 0 THEN event_id END AS raw_payload, k * 700 - 50 AS page_load_ms, CASE WHEN k % 9 <> 0 THEN 'agent' END AS user_agent
        FROM bronze_dup"""


def checked_orders(d: Spark) -> str:
    """Orders with the history columns that suites look at; some break the rules."""
    return f"""
        SELECT *, created_at AS effective_from, {d.pick("item_count", [None, "c", "u", "d", "z"])} AS cdc_op, CASE WHEN item_count <> 3 THEN item_count = 1 END AS is_current,
            item_count * 15 - 14 AS record_version, CAST(item_count - 2 AS BIGINT) AS cdc_lsn, CASE WHEN item_count <> 2 THEN updated_at END AS processed_at
        FROM stg_orders"""


VIEWS = {f.__name__: f for f in (checked_events, checked_orders, bronze, bronze_dup, silver, stitched, sessions, silver_sessions, web_orders, stg_orders, silver_orders, products)}
