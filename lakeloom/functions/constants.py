"""Fixed values that results depend on."""

# Event types that a click stream may carry.
EVENT_TYPES = ("product_view", "add_to_cart", "remove_from_cart", "checkout_start", "checkout_complete", "purchase", "search", "page_view", "wishlist_add", "wishlist_remove")
# Depth of an event type in the purchase funnel, and the stage of each depth.
FUNNEL_DEPTH = {"page_view": 0, "search": 1, "product_view": 2, "add_to_cart": 3, "remove_from_cart": 3, "wishlist_add": 3, "checkout_start": 4, "checkout_complete": 5, "purchase": 5}
FUNNEL_STAGES = ("browse", "browse", "product_view", "add_to_cart", "checkout_start", "purchase")
# Countries whose city names are masked.
GDPR_COUNTRIES = ("AT", "BE", "BG", "CY", "CZ", "DE", "DK", "EE", "ES", "FI", "FR", "GB", "GR", "HR", "HU", "IE", "IS", "IT", "LI", "LT", "LU", "LV", "MT", "NL", "NO", "PL", "PT", "RO", "SE", "SI", "SK")
# Sales region of a country.
REGIONS = {
    "AMER": ("CA", "MX", "US"),
    "APAC": ("AU", "BD", "CN", "ID", "IN", "JP", "KR", "MY", "NZ", "PH", "PK", "SG", "TH", "VN"),
    "EMEA": ("AT", "BE", "CH", "DE", "DK", "EG", "ES", "ET", "FI", "FR", "GB", "GH", "IT", "KE", "MA", "NG", "NL", "NO", "PL", "RW", "SE", "SN", "TZ", "UG", "ZA"),
    "LATAM": ("AR", "BO", "BR", "CL", "CO", "CR", "EC", "GT", "HN", "PE", "PY", "SV", "UY", "VE"),
}
# Category and channel codes of the model features.
CATEGORY_CODES = ("electronics", "clothing", "home & garden", "sports", "books", "beauty", "toys", "food", "automotive", "other")
CHANNEL_CODES = ("paid search", "paid social", "organic social", "email", "direct", "referral", "organic search", "other")
# The feature order of the churn model.
MODEL_FEATURES = (
    "days_since_last_order", "days_since_last_session", "session_count_7d", "session_count_30d", "order_count_30d", "order_count_90d", "order_frequency_30d",
    "avg_order_value_usd", "total_ltv_usd", "max_order_value_usd", "discount_usage_rate", "cart_abandonment_rate", "avg_session_duration_s",
    "avg_pages_per_session", "product_view_count_7d", "preferred_category_encoded", "channel_group_encoded", "avg_fraud_score", "refund_count_90d", "is_gdpr_scope",
)
PRICE_MIN, PRICE_MAX = 0.01, 50_000.0
SESSION_GAP_S, ATTRIBUTION_MIN, FRAUD_ALERT = 900, 30, 0.7
ORDER_STATUSES = ("pending", "confirmed", "shipped", "delivered", "cancelled", "refunded")
