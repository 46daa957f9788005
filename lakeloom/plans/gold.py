"""Gold models: dimensions, facts, daily indicators, features, serving and dashboard queries, as SQL in two dialects."""

from __future__ import annotations

from lakeloom.functions import constants as C
from lakeloom.plans.dialect import Spark
from lakeloom.plans.domain import AS_OF, _case, _in, band_case, region_case, source_case

NOW = f"DATE '{AS_OF}'"
# Country, name, region, sub-region, currency.
COUNTRY_ROWS = (
    ("US", "United States", "AMER", "Northern America", "USD"),
    ("CA", "Canada", "AMER", "Northern America", "CAD"),
    ("MX", "Mexico", "LATAM", "Central America", "MXN"),
    ("BR", "Brazil", "LATAM", "South America", "BRL"),
    ("AR", "Argentina", "LATAM", "South America", "ARS"),
    ("CO", "Colombia", "LATAM", "South America", "COP"),
    ("GB", "United Kingdom", "EMEA", "Northern Europe", "GBP"),
    ("DE", "Germany", "EMEA", "Western Europe", "EUR"),
    ("FR", "France", "EMEA", "Western Europe", "EUR"),
    ("IT", "Italy", "EMEA", "Southern Europe", "EUR"),
    ("ES", "Spain", "EMEA", "Southern Europe", "EUR"),
    ("NL", "Netherlands", "EMEA", "Western Europe", "EUR"),
    ("SE", "Sweden", "EMEA", "Northern Europe", "SEK"),
    ("NO", "Norway", "EMEA", "Northern Europe", "NOK"),
    ("DK", "Denmark", "EMEA", "Northern Europe", "DKK"),
    ("FI", "Finland", "EMEA", "Northern Europe", "EUR"),
    ("PL", "Poland", "EMEA", "Eastern Europe", "PLN"),
    ("AT", "Austria", "EMEA", "Western Europe", "EUR"),
    ("CH", "Switzerland", "EMEA", "Western Europe", "CHF"),
    ("ZA", "South Africa", "EMEA", "Southern Africa", "ZAR"),
    ("NG", "Nigeria", "EMEA", "West Africa", "NGN"),
    ("KE", "Kenya", "EMEA", "East Africa", "KES"),
    ("EG", "Egypt", "EMEA", "North Africa", "EGP"),
    ("GH", "Ghana", "EMEA", "West Africa", "GHS"),
    ("TZ", "Tanzania", "EMEA", "East Africa", "TZS"),
    ("IN", "India", "APAC", "South Asia", "INR"),
    ("CN", "China", "APAC", "East Asia", "CNY"),
    ("JP", "Japan", "APAC", "East Asia", "JPY"),
    ("AU", "Australia", "APAC", "Oceania", "AUD"),
    ("SG", "Singapore", "APAC", "Southeast Asia", "SGD"),
    ("ID", "Indonesia", "APAC", "Southeast Asia", "IDR"),
    ("TH", "Thailand", "APAC", "Southeast Asia", "THB"),
    ("MY", "Malaysia", "APAC", "Southeast Asia", "MYR"),
    ("PH", "Philippines", "APAC", "Southeast Asia", "PHP"),
    ("VN", "Vietnam", "APAC", "Southeast Asia", "VND"),
    ("KR", "South Korea", "APAC", "East Asia", "KRW"),
    ("NZ", "New Zealand", "APAC", "Oceania", "NZD"),
)
# Paid channels of the advertising feeds.
ADS = [("Google", "search brand", "set 1"), ("google", "search brand", "set 1"), ("Facebook", "spring", "set 2"), ("instagram", "spring", "set 3"), ("tiktok", "spring", "set 4")]

D0 = "CAST(0 AS DOUBLE)"
LIVE = "status NOT IN ('cancelled', 'refunded')"


def country_rows(d: Spark) -> str:
    rows = ", ".join("(" + ", ".join(f"'{v}'" for v in row) + ")" for row in COUNTRY_ROWS)
    return f"SELECT * FROM (VALUES {rows}) AS t(country, country_name, region, subregion, currency_code)"


def dim_geography(d: Spark) -> str:
    return f"""
        SELECT {d.key("o.country")} AS geo_key, o.country, coalesce(c.country_name, concat('Unknown (', o.country, ')')) AS country_name, coalesce(c.region, 'OTHER') AS region,
            coalesce(c.subregion, 'Unknown') AS subregion, o.country IN {_in(C.GDPR_COUNTRIES)} AS is_gdpr_scope, coalesce(c.currency_code, 'USD') AS currency_code
        FROM (SELECT DISTINCT geo_country AS country FROM silver WHERE geo_country IS NOT NULL AND length(geo_country) = 2) o LEFT JOIN country_rows c ON o.country = c.country"""


def dim_date(d: Spark) -> str:
    x = "full_date"
    m = "month(full_date)"
    return f"""
        SELECT {d.ymd.format(x)} AS date_key, full_date, CAST(year({x}) AS INT) AS year, CAST(quarter({x}) AS INT) AS quarter, CAST({m} AS INT) AS month, {d.month_name.format(x)} AS month_name,
            {d.iso_week.format(x)} AS week_of_year, CAST(day({x}) AS INT) AS day_of_month, {d.day_of_week.format(x)} AS day_of_week, {d.day_name.format(x)} AS day_name,
            CAST((({d.day_of_week.format(x)} + 5) % 7) + 1 AS INT) AS iso_day_of_week, {d.day_of_week.format(x)} IN (1, 7) AS is_weekend, day({x}) = 1 AS is_month_start,
            {x} = last_day({x}) AS is_month_end, {x} = last_day({x}) AND {m} % 3 = 0 AS is_quarter_end,
            CAST(CASE WHEN {m} >= 2 THEN year({x}) ELSE year({x}) - 1 END AS INT) AS fiscal_year,
            CASE WHEN {m} BETWEEN 2 AND 4 THEN 1 WHEN {m} BETWEEN 5 AND 7 THEN 2 WHEN {m} BETWEEN 8 AND 10 THEN 3 ELSE 4 END AS fiscal_quarter
        FROM ({d.series("2020-01-01", "2030-12-31")}) days"""


def dim_channels(d: Spark) -> str:
    ads = ", ".join(f"('{s}', '{c}', '{a}')" for s, c, a in ADS)
    return f"""
        SELECT {d.key("source", "medium", "coalesce(campaign, 'none')", "coalesce(ad_set, 'none')", "coalesce(ab_cohort, 'none')")} AS channel_key, source, medium, campaign, ad_set, ab_cohort,
            CASE WHEN source IN ('google', 'bing') AND medium = 'cpc' THEN 'Paid Search' WHEN source IN ('facebook', 'instagram') AND medium = 'cpc' THEN 'Paid Social'
                WHEN source IN ('facebook', 'instagram') THEN 'Organic Social' WHEN medium = 'email' THEN 'Email' WHEN source = 'direct' THEN 'Direct'
                WHEN source = 'referral' THEN 'Referral' WHEN medium = 'organic' THEN 'Organic Search' ELSE 'Other' END AS channel_group
        FROM (SELECT lower(source) AS source, 'cpc' AS medium, campaign, ad_set, CAST(NULL AS STRING) AS ab_cohort FROM (VALUES {ads}) AS t(source, campaign, ad_set)
            UNION
            SELECT source, CASE WHEN source IN ('google', 'bing') THEN 'organic' WHEN source IN ('email', 'direct') THEN source ELSE 'referral' END, CAST(NULL AS STRING), CAST(NULL AS STRING), ab_cohort
            FROM session_source) channels"""


def session_source(d: Spark) -> str:
    return f"SELECT session_id, ab_cohort, {source_case('entry_referrer')} AS source FROM silver_sessions"


def session_channel(d: Spark) -> str:
    """One organic channel row for each session."""
    return """
        SELECT s.session_id, c.channel_key FROM session_source s
        JOIN dim_channels c ON c.source = s.source AND c.medium <> 'cpc' AND coalesce(c.ab_cohort, 'none') = coalesce(s.ab_cohort, 'none')"""


def dim_products(d: Spark) -> str:
    tags = "array_join(split(category, ' '), '|')" if d.name == "spark" else "array_to_string(string_split(category, ' '), '|')"
    return f"SELECT {d.key('sku')} AS product_key, sku, name, category, brand, price_usd, cost_usd, margin_pct, is_active, {tags} AS tags, {band_case('price_usd', 'luxury')} AS price_band FROM products"


def user_spend(d: Spark) -> str:
    return f"SELECT user_id_hashed, round(sum(total_amount_usd) + 1e-9, 2) AS spend_90d FROM silver_orders WHERE order_date >= CAST({NOW} - INTERVAL 90 DAY AS DATE) AND status IN ('confirmed', 'shipped', 'delivered') GROUP BY user_id_hashed"


def preferred_category(d: Spark) -> str:
    return f"""
        SELECT user_id_hashed, category AS preferred_category FROM (
            SELECT e.user_id_hashed, p.category, row_number() OVER (PARTITION BY e.user_id_hashed ORDER BY count(*) DESC, p.category) AS rn
            FROM silver e JOIN products p ON e.product_sku = p.sku
            WHERE e.event_type = 'purchase' AND e.event_date >= CAST({NOW} - INTERVAL 90 DAY AS DATE) AND p.category IS NOT NULL
            GROUP BY e.user_id_hashed, p.category) ranked
        WHERE rn = 1"""


def dim_users(d: Spark) -> str:
    """One current row per user, with the attributes of the user's latest event."""
    last = f"{d.micros('event_ts')} * 1000 + seq % 1000"
    return f"""
        SELECT {d.key("b.user_id_hashed")} AS user_key, b.user_id_hashed, CASE WHEN b.country <> '~' THEN b.country END AS country, b.geo_region, coalesce(g.signup_date, b.first_active_date) AS signup_date, b.last_active_date,
            b.preferred_device, c.preferred_category, CASE WHEN coalesce(s.spend_90d, 0) >= 1000 THEN 'platinum' WHEN coalesce(s.spend_90d, 0) >= 300 THEN 'gold'
                WHEN coalesce(s.spend_90d, 0) >= 100 THEN 'silver' ELSE 'bronze' END AS ltv_band, round(coalesce(s.spend_90d, 0), 2) AS spend_90d, 'regular' AS user_segment, true AS is_current
        FROM (SELECT user_id_hashed, max_by(coalesce(geo_country, '~'), {last}) AS country, max_by(geo_region, {last}) AS geo_region, max_by(device_type, {last}) AS preferred_device,
                max(event_date) AS last_active_date, min(event_date) AS first_active_date FROM silver WHERE user_id_hashed IS NOT NULL GROUP BY user_id_hashed) b
        LEFT JOIN user_spend s ON b.user_id_hashed = s.user_id_hashed
        LEFT JOIN preferred_category c ON b.user_id_hashed = c.user_id_hashed
        LEFT JOIN (SELECT user_id_hashed, min(order_date) AS signup_date FROM silver_orders GROUP BY user_id_hashed) g ON b.user_id_hashed = g.user_id_hashed"""


def primary_sku(d: Spark) -> str:
    return """
        SELECT order_id, product_sku FROM (SELECT 'o' || CAST(seq AS STRING) AS order_id, product_sku,
            row_number() OVER (PARTITION BY seq ORDER BY coalesce(product_price_usd, 0) DESC, product_sku) AS rn FROM silver WHERE event_type = 'purchase' AND product_sku IS NOT NULL) x
        WHERE rn = 1"""


def fct_orders(d: Spark) -> str:
    return f"""
        SELECT o.order_id, coalesce(u.user_key, '-1') AS user_key, coalesce(p.product_key, '-1') AS product_key, coalesce(c.channel_key, '-1') AS channel_key, coalesce(g.geo_key, '-1') AS geo_key,
            coalesce(t.date_key, -1) AS date_key, o.order_date, o.total_amount_usd, o.item_count, o.discount_usd, o.net_amount_usd, o.order_tier, o.days_consideration, o.funnel_stage_reached,
            o.attributed_session_id, o.fraud_score, o.fraud_score > 0.7 AS fraud_flagged, o.status, o.payment_method, o.shipping_country, o.created_at, o.updated_at
        FROM silver_orders o LEFT JOIN dim_users u ON o.user_id_hashed = u.user_id_hashed LEFT JOIN primary_sku k ON o.order_id = k.order_id
        LEFT JOIN (SELECT * FROM dim_products WHERE is_active) p ON k.product_sku = p.sku LEFT JOIN dim_geography g ON o.shipping_country = g.country
        LEFT JOIN dim_date t ON o.order_date = t.full_date LEFT JOIN session_channel c ON o.attributed_session_id = c.session_id
        WHERE o.total_amount_usd > 0 OR o.status <> 'cancelled'"""


def fct_sessions(d: Spark) -> str:
    return """
        SELECT s.session_id, coalesce(u.user_key, '-1') AS user_key, coalesce(g.geo_key, '-1') AS geo_key, coalesce(c.channel_key, '-1') AS channel_key, coalesce(t.date_key, -1) AS date_key,
            s.session_date, s.session_start_ts, s.session_end_ts, s.session_duration_s, s.page_views, s.product_views, s.cart_adds, s.cart_removes, s.searches, s.checkout_attempts, s.purchases,
            s.revenue_attributed_usd, s.cart_value_usd, s.cart_abandonment, s.funnel_stage_reached AS funnel_exit_stage, s.device_type, s.max_fraud_score, s.fraud_flagged, s.ab_cohort
        FROM silver_sessions s LEFT JOIN dim_users u ON s.user_id_hashed = u.user_id_hashed LEFT JOIN dim_geography g ON s.geo_country = g.country
        LEFT JOIN dim_date t ON s.session_date = t.full_date LEFT JOIN session_channel c ON s.session_id = c.session_id"""


def first_orders(d: Spark) -> str:
    return "SELECT user_key, min(order_date) AS first_order_date FROM fct_orders WHERE status IN ('confirmed', 'shipped', 'delivered') GROUP BY user_key"


def order_days(d: Spark) -> str:
    return f"""
        SELECT o.order_date AS metric_date, count(DISTINCT o.order_id) AS total_orders, count(DISTINCT o.user_key) AS unique_buyers, round(sum(o.total_amount_usd) + 1e-9, 2) AS gross_revenue_usd,
            round(sum(o.net_amount_usd) + 1e-9, 2) AS net_revenue_usd, round(avg(o.total_amount_usd) + 1e-9, 4) AS avg_order_value_usd, {d.median("o.total_amount_usd")} AS median_order_value_usd,
            count_if(o.fraud_flagged) AS flagged_fraud_orders, round(coalesce(sum(CASE WHEN o.fraud_flagged THEN o.total_amount_usd END), {D0}), 2) AS fraud_exposure_usd,
            count(DISTINCT CASE WHEN f.first_order_date = o.order_date THEN o.user_key END) AS new_buyers, count(DISTINCT CASE WHEN f.first_order_date < o.order_date THEN o.user_key END) AS returning_buyers
        FROM fct_orders o LEFT JOIN first_orders f ON o.user_key = f.user_key WHERE o.status IN ('confirmed', 'shipped', 'delivered', 'pending') GROUP BY o.order_date"""


def session_days(d: Spark) -> str:
    upto = lambda *s: f"count(DISTINCT CASE WHEN funnel_exit_stage IN {_in(s)} THEN session_id END)"
    return f"""
        SELECT session_date AS metric_date, count(DISTINCT session_id) AS total_sessions, count(DISTINCT user_key) AS unique_visitors, round(avg(session_duration_s) + 1e-9, 4) AS avg_session_duration_s,
            round(avg(page_views) + 1e-9, 4) AS avg_page_views, round(CAST(count_if(cart_abandonment) AS DOUBLE) / nullif(count_if(cart_adds > 0), 0), 6) AS cart_abandonment_rate,
            {upto("product_view", "add_to_cart", "checkout_start", "purchase")} AS product_view_sessions, {upto("add_to_cart", "checkout_start", "purchase")} AS add_to_cart_sessions,
            {upto("checkout_start", "purchase")} AS checkout_start_sessions, {upto("purchase")} AS purchase_sessions
        FROM fct_sessions GROUP BY session_date"""


def agg_daily(d: Spark) -> str:
    zero = lambda a, *cs: ", ".join(f"coalesce({a}.{c}, 0) AS {c}" for c in cs)
    return f"""
        SELECT coalesce(o.metric_date, s.metric_date) AS metric_date, {zero("o", "total_orders", "unique_buyers", "gross_revenue_usd", "net_revenue_usd", "avg_order_value_usd", "median_order_value_usd", "flagged_fraud_orders", "fraud_exposure_usd")},
            round(coalesce(o.flagged_fraud_orders, 0) * CAST(100 AS DOUBLE) / nullif(o.total_orders, 0), 6) AS fraud_rate_pct,
            {zero("s", "total_sessions", "unique_visitors", "avg_session_duration_s", "avg_page_views", "cart_abandonment_rate", "product_view_sessions", "add_to_cart_sessions", "checkout_start_sessions", "purchase_sessions")},
            round(CAST(coalesce(s.purchase_sessions, 0) AS DOUBLE) / nullif(s.total_sessions, 0), 6) AS overall_conversion_rate, {zero("o", "new_buyers", "returning_buyers")}
        FROM order_days o FULL OUTER JOIN session_days s ON o.metric_date = s.metric_date WHERE coalesce(o.metric_date, s.metric_date) IS NOT NULL"""


def feature_orders(d: Spark) -> str:
    since = lambda n: f"order_date >= CAST({NOW} - INTERVAL {n} DAY AS DATE)"
    return f"""
        SELECT o.user_key, u.user_id_hashed, count_if(o.{since(30)}) AS order_count_30d, count_if(o.{since(90)}) AS order_count_90d, round(avg(o.total_amount_usd) + 1e-9, 4) AS avg_order_value_usd,
            max(o.total_amount_usd) AS max_order_value_usd, round(sum(o.total_amount_usd) + 1e-9, 2) AS total_ltv_usd, round(avg(o.fraud_score) + 1e-9, 6) AS avg_fraud_score,
            round(CAST(count_if(o.discount_usd > 0) AS DOUBLE) / nullif(count(*), 0), 6) AS discount_usage_rate, count_if(o.status = 'refunded' AND o.{since(90)}) AS refund_count_90d,
            {d.days(NOW, "max(o.order_date)")} AS days_since_last_order,
            CASE WHEN max(o.order_date) < CAST({NOW} - INTERVAL 30 DAY AS DATE) AND count_if(o.{since(90)}) > 0 THEN 1 ELSE 0 END AS churned_30d
        FROM fct_orders o JOIN dim_users u ON o.user_key = u.user_key AND u.is_current GROUP BY o.user_key, u.user_id_hashed"""


def feature_sessions(d: Spark) -> str:
    since = lambda n: f"session_date >= CAST({NOW} - INTERVAL {n} DAY AS DATE)"
    return f"""
        SELECT user_key, count_if({since(7)}) AS session_count_7d, count_if({since(30)}) AS session_count_30d, {d.days(NOW, "max(session_date)")} AS days_since_last_session,
            round(avg(session_duration_s) + 1e-9, 4) AS avg_session_duration_s, round(avg(page_views) + 1e-9, 4) AS avg_pages_per_session,
            CAST(coalesce(sum(CASE WHEN {since(7)} THEN product_views END), 0) AS BIGINT) AS product_view_count_7d,
            round(avg(CASE WHEN funnel_exit_stage IN ('add_to_cart', 'checkout_start') THEN CAST(1 AS DOUBLE) ELSE {D0} END), 6) AS cart_abandonment_rate
        FROM fct_sessions GROUP BY user_key"""


def top_channel(d: Spark) -> str:
    return """
        SELECT user_key, channel_group FROM (SELECT o.user_key, c.channel_group, row_number() OVER (PARTITION BY o.user_key ORDER BY count(*) DESC, c.channel_group) AS rn
            FROM fct_orders o JOIN dim_channels c ON o.channel_key = c.channel_key GROUP BY o.user_key, c.channel_group) x
        WHERE rn = 1"""


def features(d: Spark) -> str:
    code = lambda col, codes: _case(f"lower(coalesce({col}, 'other'))", {c: i for i, c in enumerate(codes)}, str(len(codes) - 1))
    return f"""
        SELECT o.user_id_hashed, coalesce(o.days_since_last_order, 999) AS days_since_last_order, coalesce(s.days_since_last_session, 999) AS days_since_last_session,
            coalesce(s.session_count_7d, 0) AS session_count_7d, coalesce(s.session_count_30d, 0) AS session_count_30d, o.order_count_30d, o.order_count_90d,
            CAST(o.order_count_30d AS DOUBLE) / 4 AS order_frequency_30d, coalesce(o.avg_order_value_usd, 0) AS avg_order_value_usd, coalesce(o.total_ltv_usd, 0) AS total_ltv_usd,
            coalesce(o.max_order_value_usd, 0) AS max_order_value_usd, coalesce(o.discount_usage_rate, 0) AS discount_usage_rate, coalesce(s.cart_abandonment_rate, 0) AS cart_abandonment_rate,
            coalesce(s.avg_session_duration_s, 0) AS avg_session_duration_s, coalesce(s.avg_pages_per_session, 0) AS avg_pages_per_session, coalesce(s.product_view_count_7d, 0) AS product_view_count_7d,
            {code("u.preferred_category", C.CATEGORY_CODES)} AS preferred_category_encoded, {code("c.channel_group", C.CHANNEL_CODES)} AS channel_group_encoded,
            coalesce(o.avg_fraud_score, 0) AS avg_fraud_score, o.refund_count_90d, CASE WHEN coalesce(g.is_gdpr_scope, false) THEN 1 ELSE 0 END AS is_gdpr_scope, o.churned_30d, 1 AS is_current
        FROM feature_orders o LEFT JOIN feature_sessions s ON o.user_key = s.user_key LEFT JOIN dim_users u ON o.user_key = u.user_key LEFT JOIN top_channel c ON o.user_key = c.user_key
        LEFT JOIN dim_geography g ON u.country = g.country"""


VIEWS = {
    f.__name__: f
    for f in (country_rows, dim_geography, dim_date, session_source, dim_channels, session_channel, dim_products, user_spend, preferred_category, dim_users, primary_sku, fct_orders, fct_sessions, first_orders, order_days, session_days, agg_daily, feature_orders, feature_sessions, top_channel, features)
}
assert region_case
