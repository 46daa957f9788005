"""The expectation suites of the bronze events and the silver orders, and the tests of the gold models."""

from __future__ import annotations

from lakeloom.functions import constants as C
from lakeloom.operators.quality import Expect

# The suites' columns, sets, bounds and tolerances.
BRONZE_CRITICAL = [
    Expect("not_null", "event_id"),
    Expect("not_null", "user_id_hashed"),
    Expect("not_null", "session_id"),
    Expect("not_null", "event_ts"),
    Expect("unique", "event_id"),
    Expect("in_set", "event_type", C.EVENT_TYPES, mostly=0.999),
    Expect("not_null", "ingested_at"),
    Expect("not_null", "raw_payload"),
    Expect("row_count", low=1),
]
BRONZE_WARNING = [
    Expect("in_set", "device_type", ("desktop", "mobile", "tablet", "unknown"), mostly=0.99, level="warning"),
    Expect("between", "product_price_usd", low=0, high=50_000, mostly=0.999, level="warning"),
    Expect("between", "page_load_ms", low=0, high=60_000, mostly=0.995, level="warning"),
    Expect("row_count", low=100, high=5_000_000, level="warning"),
    Expect("match_regex", "geo_country", ("^[A-Z]{2}$",), mostly=0.98, level="warning"),
    Expect("not_null", "user_agent", mostly=0.95, level="warning"),
]
SILVER_CRITICAL = [
    Expect("not_null", "order_id"),
    Expect("not_null", "user_id_hashed"),
    Expect("not_null", "effective_from"),
    Expect("not_null", "is_current"),
    Expect("not_match_regex", "order_id", (r"^\s*$",)),
    Expect("in_set", "status", (*C.ORDER_STATUSES, "deleted")),
    Expect("in_set", "cdc_op", ("c", "u", "d", "r")),
    Expect("between", "total_amount_usd", low=0),
    Expect("between", "net_amount_usd", low=0),
    Expect("between", "discount_usd", low=0, high=100_000),
    Expect("in_set", "is_current", (True, False)),
    Expect("between", "record_version", low=1, high=50),
    Expect("row_count", low=1),
]
SILVER_WARNING = [
    Expect("between", "total_amount_usd", low=0, high=100_000, mostly=0.999, level="warning"),
    Expect("between", "item_count", low=1, high=500, mostly=0.999, level="warning"),
    Expect("between", "cdc_lsn", low=0, mostly=0.999, level="warning"),
    Expect("not_null", "processed_at", level="warning"),
    Expect("between", "fraud_score", low=0, high=1, level="warning"),
    Expect("not_null", "payment_method", mostly=0.9, level="warning"),
]
# Tests of the gold models, by model.
MODELS = {
    "fct_orders": [Expect("unique", "order_id"), *[Expect("not_null", c) for c in ("order_id", "user_key", "order_date", "total_amount_usd", "fraud_score")], Expect("between", "fraud_score", low=0, high=1), Expect("in_set", "status", C.ORDER_STATUSES)],
    "fct_sessions": [Expect("unique", "session_id"), Expect("not_null", "session_id"), Expect("not_null", "session_date"), Expect("in_set", "funnel_exit_stage", ("browse", "product_view", "add_to_cart", "checkout_start", "purchase"))],
    "dim_users": [Expect("unique", "user_key"), *[Expect("not_null", c) for c in ("user_key", "user_id_hashed", "is_current")], Expect("in_set", "ltv_band", ("bronze", "silver", "gold", "platinum"))],
    "dim_products": [*[Expect(k, c) for c in ("product_key", "sku") for k in ("unique", "not_null")], Expect("in_set", "price_band", ("budget", "mid", "premium", "luxury"))],
    "dim_date": [Expect(k, c) for c in ("date_key", "full_date") for k in ("unique", "not_null")],
    "dim_channels": [Expect("unique", "channel_key"), Expect("not_null", "channel_key"), Expect("in_set", "channel_group", ("Paid Search", "Paid Social", "Organic Social", "Email", "Direct", "Referral", "Organic Search", "Other"))],
    "dim_geography": [*[Expect(k, c) for c in ("geo_key", "country") for k in ("unique", "not_null")], Expect("in_set", "region", ("EMEA", "APAC", "AMER", "LATAM", "OTHER"))],
    "agg_daily": [Expect("unique", "metric_date"), Expect("not_null", "metric_date"), Expect("not_null", "gross_revenue_usd")],
}
# Minutes after which a silver source warns and fails.
FRESH_WARN, FRESH_ERROR = 30, 60
