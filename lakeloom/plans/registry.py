"""All queries by name, each with the SQL that checks it."""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Callable, Container
from datetime import datetime
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.functions import constants as C
from lakeloom.functions import core
from lakeloom.operators import churn, fraud, ingest, merge, quality, sessions, silver, suites
from lakeloom.plans import domain, gold, kept, stored
from lakeloom.plans.dialect import DUCK, SPARK, Spark
from lakeloom.session import shared_dir
from lakeloom.session import stored as stored_rows
from lakeloom.sources import connectors, feeds
from lakeloom.sources.tables import Bookmark, SnapshotTable
from lakeloom.streaming import features, history, jobs, rotation, sinks, stateful

VIEWS = domain.VIEWS | gold.VIEWS
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
NOW = gold.NOW


def _uses(text: str, stop: Container[str] = (), dialect: Spark = DUCK) -> list[str]:
    """Views that a text needs, in an order that defines each before its use; those in stop need no others."""
    out: list[str] = []

    def visit(t: str) -> None:
        for name in VIEWS:
            if name not in out and re.search(rf"(?i)\b(from|join)\s+{name}\b", t):
                if name not in stop:
                    visit(VIEWS[name](dialect))
                if name not in out:
                    out.append(name)

    visit(text)
    return out


#: Tables written so far: by application, folder and state of its files, the path of each. Every entry can be made anew.
_WRITTEN: dict[tuple, dict[str, str]] = {}


class Lake:
    """Views over one folder of tables."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir
        self._files: tuple | None = None

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def sql(self, text: str) -> DataFrame:
        made = {*stored.MODELS, *stored.TABLES}
        views = _uses(text, made, SPARK)
        every = " ".join([text, *[VIEWS[v](SPARK) for v in views if v not in made]])
        frames = {v: self.view(v) for v in views if v in made}  # these register views of their own, so they come first
        for name in domain.TABLES:
            if re.search(rf"(?i)\b(from|join)\s+{name}\b", every):
                self.table(name).createOrReplaceTempView(name)
        for v in views:
            (frames[v] if v in frames else self.spark.sql(VIEWS[v](SPARK))).createOrReplaceTempView(v)
        return self.spark.sql(text)

    def view(self, name: str) -> DataFrame:
        return self._stored(name) if name in stored.TABLES else self._made(name)

    def _made(self, name: str) -> DataFrame:
        if name in stored.MODELS:
            return stored.MODELS[name](self.view)
        return self.sql(VIEWS[name](SPARK)) if name in stored.TABLES else self.sql(f"SELECT * FROM {name}")

    def _state(self) -> tuple:
        """Which source files there are, and when they were written, as this Lake first found them: tables made from others are not taken."""
        if self._files is not None:
            return self._files
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        root = path(self.sf_dir)
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        found = [f for t in domain.TABLES for f in fs.globStatus(path(f"{self.sf_dir}/{t}.parquet{{,/*}}"))]
        state = sorted((str(f.getPath()), f.getLen(), f.getModificationTime()) for f in found)
        self._files = (len(state), hashlib.sha256(repr(state).encode()).hexdigest())
        return self._files

    def _stored(self, name: str) -> DataFrame:
        """A table of the chain, written when it is first asked for and read from then on."""
        known = _WRITTEN.setdefault((self.spark.sparkContext.applicationId, self._state()), {})
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        done = path(f"{known[name]}/_SUCCESS") if name in known else None
        if done is None or not done.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(done):
            rows, day = self._made(name), stored.TABLES[name]
            known[name] = f"{shared_dir(self.spark)}/{name}-{uuid.uuid4().hex}"
            (rows.hint("rebalance", F.col(day)).write.partitionBy(day) if day else rows.write).parquet(known[name])
            _SCHEMAS[known[name]] = rows.schema
        schema = _SCHEMAS[known[name]]
        return self.spark.read.schema(schema).parquet(known[name]).select(*schema.names)


_SCHEMAS: dict[str, T.StructType] = {}


def oracle(text: str) -> str:
    views = _uses(text)
    return ("WITH " + ",\n".join(f"{v} AS ({VIEWS[v](DUCK)})" for v in views) + "\n" if views else "") + text


def both(name: str, text: Callable[[Spark], str]) -> None:
    """A query that is SQL in either dialect."""
    QUERIES[name] = lambda spark, sf_dir: Lake(spark, sf_dir).sql(text(SPARK))
    ORACLE[name] = oracle(text(DUCK))


def query(name: str, check: str | None):
    """A DataFrame function of a Lake, checked by SQL."""

    def add(f: Callable[[Lake], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: f(Lake(spark, sf_dir))
        if check is not None:
            ORACLE[name] = oracle(check)
        return f

    return add


def _folder(lake: Lake) -> str:
    return f"{shared_dir(lake.spark)}/lake-{uuid.uuid4().hex}"


# ---- headline indicators on the order tables


@query(
    "agg_daily_orders",
    """
    SELECT CAST(o_orderdate AS DATE) AS metric_date, count(*) AS total_orders, count(DISTINCT o_custkey) AS unique_buyers, round(sum(o_totalprice) + 1e-9, 2) AS gross_revenue_usd,
        round(sum(o_totalprice - coalesce(discount, 0)) + 1e-9, 2) AS net_revenue_usd, round(avg(o_totalprice) + 1e-9, 4) AS avg_order_value_usd, quantile_disc(o_totalprice, 0.5) AS median_order_value_usd,
        count_if(o_totalprice > 400000) AS flagged_orders, count(DISTINCT CASE WHEN first_date = CAST(o_orderdate AS DATE) THEN o_custkey END) AS new_buyers,
        count(DISTINCT CASE WHEN first_date < CAST(o_orderdate AS DATE) THEN o_custkey END) AS returning_buyers
    FROM orders LEFT JOIN (SELECT l_orderkey, sum(l_extendedprice * l_discount) AS discount FROM lineitem GROUP BY l_orderkey) d ON o_orderkey = l_orderkey
    LEFT JOIN (SELECT o_custkey AS c, min(CAST(o_orderdate AS DATE)) AS first_date FROM orders WHERE o_orderstatus IN ('F', 'O') GROUP BY o_custkey) f ON o_custkey = c
    GROUP BY CAST(o_orderdate AS DATE)""",
)
def agg_daily_orders(lake: Lake) -> DataFrame:
    """Buyers are counted from one row for each (date, customer); the median is exact up to a million orders a day."""
    orders = lake.table("orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", F.to_date("o_orderdate").alias("metric_date"))
    discount = lake.table("lineitem").groupBy("l_orderkey").agg(F.sum(F.col("l_extendedprice") * F.col("l_discount")).alias("discount"))
    joined = orders.join(discount, orders.o_orderkey == discount.l_orderkey, "left")
    sums = joined.groupBy("metric_date").agg(
        F.count(F.lit(1)).alias("total_orders"), F.round(F.sum("o_totalprice") + 1e-9, 2).alias("gross_revenue_usd"),
        F.round(F.sum(F.col("o_totalprice") - F.coalesce("discount", F.lit(0.0))) + 1e-9, 2).alias("net_revenue_usd"), F.round(F.avg("o_totalprice") + 1e-9, 4).alias("avg_order_value_usd"),
        F.percentile_approx("o_totalprice", 0.5, 1_000_000).alias("median_order_value_usd"), F.count_if(F.col("o_totalprice") > 400_000).alias("flagged_orders"),
    )
    days = orders.where("o_custkey IS NOT NULL").groupBy("o_custkey", "metric_date").agg(F.bool_or(F.col("o_orderstatus").isin("F", "O")).alias("counts"))
    first = days.where("counts").groupBy("o_custkey").agg(F.min("metric_date").alias("first_date"))
    day, start = F.col("metric_date"), F.col("first_date")
    buyers = days.join(first, "o_custkey", "left").groupBy(day.alias("_date")).agg(F.count(F.lit(1)).alias("unique_buyers"), F.count_if(start == day).alias("new_buyers"), F.count_if(start < day).alias("returning_buyers"))
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("unique_buyers", "new_buyers", "returning_buyers")]
    return sums.join(buyers, F.col("metric_date").eqNullSafe(F.col("_date")), "left").select(*sums.columns, *zero)


# ---- validation and ingest

ODD = """SELECT event_id, CASE WHEN k % 43 = 0 THEN '' WHEN k % 47 = 0 THEN NULL ELSE user_id END AS user_id, CASE WHEN k % 37 = 0 THEN 'bogus' ELSE event_type END AS event_type,
    CASE WHEN k % 41 = 0 THEN product_price_usd * 1000 + 50000 ELSE product_price_usd END AS price, geo_country, event_ts, ingested_at, device_type, page_referrer, product_sku, product_quantity, geo_city, is_bot, k, seq FROM bronze"""
FLAG = """CASE WHEN coalesce(user_id, '') = '' THEN 'CRITICAL' WHEN event_type = 'bogus' THEN 'CRITICAL' WHEN price NOT BETWEEN 0.01 AND 50000 THEN 'WARNING' WHEN geo_country IS NULL THEN 'WARNING' END"""
REASON = """CASE WHEN coalesce(user_id, '') = '' THEN 'user_id missing' WHEN event_type = 'bogus' THEN 'event_type unknown' WHEN price NOT BETWEEN 0.01 AND 50000 THEN 'price out of range' WHEN geo_country IS NULL THEN 'country missing' END"""


@query("val_event", f"SELECT event_id, {FLAG} AS dq_flag, {REASON} AS dq_message FROM ({ODD}) o")
def val_event(lake: Lake) -> DataFrame:
    dq = ingest.validation(F.col("event_id"), F.col("user_id"), F.col("event_ts"), F.col("event_type"), F.col("price"), F.col("geo_country"))
    return lake.sql(ODD).withColumn("dq", dq).select("event_id", F.col("dq.flag").alias("dq_flag"), F.col("dq.message").alias("dq_message"))


def raw_lines(lake: Lake) -> DataFrame:
    """The odd events as lines of JSON; every tenth is cut off, and times come in four spellings."""
    text = F.date_format(F.col("event_ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    stamp = F.when(F.col("k") % 4 == 0, F.concat(text, F.lit("Z"))).when(F.col("k") % 4 == 1, F.concat(text, F.lit("+02:00"))).when(F.col("k") % 4 == 2, text).otherwise("not a time")
    named = F.struct(
        "event_id", "user_id", "event_type", stamp.alias("timestamp"), F.struct(F.col("device_type").alias("type")).alias("device"), F.struct(F.col("page_referrer").alias("referrer")).alias("page"),
        F.struct(F.col("product_sku").alias("sku"), F.col("price").alias("price_usd"), F.col("product_quantity").alias("quantity")).alias("product"),
        F.struct(F.col("geo_country").alias("country"), F.col("geo_city").alias("city")).alias("geo"), F.struct("is_bot").alias("flags"),
    )
    line = F.to_json(named)
    return lake.sql(ODD).select(F.when(F.col("k") % 10 == 0, F.substring(line, 1, 40)).otherwise(line).alias("value"), "ingested_at", "event_id", "k")


@query("val_json", f"SELECT event_id, k % 10 = 0 AS malformed FROM ({ODD}) o")
def val_json(lake: Lake) -> DataFrame:
    return ingest.parse_json(raw_lines(lake)).select("event_id", "malformed")


STAMP = "CASE k % 4 WHEN 1 THEN event_ts - INTERVAL 2 HOUR WHEN 3 THEN ingested_at ELSE event_ts END"


@query("ts_parse", f"SELECT event_id, {STAMP} AS event_ts FROM ({ODD}) o WHERE k % 10 <> 0")
def ts_parse(lake: Lake) -> DataFrame:
    flat = ingest.flatten(ingest.parse_json(raw_lines(lake)).where("NOT malformed"), F.col("ingested_at").cast("timestamp"))
    return flat.select("event_id", F.col("event_ts").cast("timestamp_ntz").alias("event_ts"))


@query(
    "flatten",
    f"""SELECT event_id, user_id, event_type, device_type, page_referrer, product_sku, round(price, 4) AS price, product_quantity, geo_country, geo_city, is_bot, coalesce({FLAG}, CASE WHEN k % 4 = 3 THEN 'WARNING' END) AS dq_flag,
        CAST({STAMP} AS DATE) AS event_date, CAST(hour({STAMP}) AS INT) AS event_hour FROM ({ODD}) o WHERE k % 10 <> 0""",
)
def flatten(lake: Lake) -> DataFrame:
    flat = ingest.flatten(ingest.parse_json(raw_lines(lake)).where("NOT malformed"), F.col("ingested_at").cast("timestamp"))
    return flat.select("event_id", "user_id", "event_type", "device_type", "page_referrer", "product_sku", F.round("product_price_usd", 4).alias("price"), "product_quantity", "geo_country", "geo_city", "is_bot", "dq_flag", "event_date", "event_hour")


@query("snk_dlq", f"SELECT reason, count(*) AS n FROM (SELECT CASE WHEN k % 10 = 0 THEN 'malformed JSON' ELSE {REASON} END AS reason, k, {FLAG} AS flag FROM ({ODD}) o) x WHERE k % 10 = 0 OR flag = 'CRITICAL' GROUP BY reason")
def snk_dlq(lake: Lake) -> DataFrame:
    return ingest.split(raw_lines(lake), F.col("ingested_at").cast("timestamp"))[1].groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


# ---- silver events

@query("win_dedup_event", "SELECT event_id, ingested_at, event_type, k FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ingested_at DESC) AS rn FROM bronze_dup) x WHERE rn = 1")
def win_dedup_event(lake: Lake) -> DataFrame:
    return silver.latest_wide(lake.view("bronze_dup").select("event_id", "ingested_at", "event_type", "k"), ["event_id"], ["ingested_at"])


@query("flt_events", "SELECT event_id, dq_flag FROM bronze WHERE NOT is_bot AND NOT is_internal AND dq_flag IS DISTINCT FROM 'CRITICAL'")
def flt_events(lake: Lake) -> DataFrame:
    return silver.drop_unwanted(lake.view("bronze")).select("event_id", "dq_flag")


@query("mask_pii", f"SELECT event_id, {DUCK.hmac('user_id', domain.SALT)} AS user_id_hashed, CASE WHEN geo_country IN {domain._in(C.GDPR_COUNTRIES)} THEN 'MASKED' ELSE geo_city END AS geo_city FROM bronze")
def mask_pii(lake: Lake) -> DataFrame:
    return silver.mask(lake.view("bronze"), domain.SALT).select("event_id", "user_id_hashed", "geo_city")


@query("derive_region", f"SELECT event_id, geo_country, {domain.region_case('geo_country')} AS geo_region FROM bronze")
def derive_region(lake: Lake) -> DataFrame:
    return lake.view("bronze").select("event_id", "geo_country", core.region(F.col("geo_country")).alias("geo_region"))


@query("derive_dates", "SELECT event_id, CAST(event_ts AS DATE) AS event_date, CAST(hour(event_ts) AS INT) AS event_hour FROM bronze")
def derive_dates(lake: Lake) -> DataFrame:
    return lake.view("bronze").select("event_id", F.to_date("event_ts").alias("event_date"), F.hour("event_ts").alias("event_hour"))


@query("sel_schema", "SELECT event_id, CAST(NULL AS DOUBLE) AS geo_lat, CAST(k AS BIGINT) AS k FROM bronze")
def sel_schema(lake: Lake) -> DataFrame:
    return silver.select_schema(lake.view("bronze"), T.StructType.fromDDL("event_id STRING, geo_lat DOUBLE, k BIGINT"))


SILVER_COLS = "event_id, user_id_hashed, event_type, event_ts, geo_city, geo_region, event_date, product_price_usd"


@query("silver_events", f"SELECT {SILVER_COLS} FROM silver")
def silver_events(lake: Lake) -> DataFrame:
    return silver.refine(lake.view("bronze_dup"), domain.SALT).selectExpr(*SILVER_COLS.split(", "))


@query("join_catalog", "SELECT e.event_id, e.product_sku, p.category, p.brand, p.margin_pct FROM silver e LEFT JOIN products p ON e.product_sku = p.sku")
def join_catalog(lake: Lake) -> DataFrame:
    catalog = lake.sql("SELECT sku, category, brand, margin_pct FROM products")
    return silver.enrich(lake.sql("SELECT event_id, product_sku FROM silver"), catalog).select("event_id", "product_sku", "category", "brand", "margin_pct")


# ---- catalogue

FEED = """SELECT sku, concat('  ', name, ' ') AS name, concat(' ', upper(category), ' ') AS category, brand, CAST(price_usd AS STRING) AS price_usd, CAST(cost_usd AS STRING) AS cost_usd, '12.5' AS margin_pct,
    CASE WHEN is_active THEN 'true' ELSE 'false' END AS is_active, p_partkey AS content_hash, p_partkey % 3 AS ingested_at,
    CASE p_partkey % 3 WHEN 0 THEN '["A ", "", "b"]' WHEN 1 THEN 'no json' END AS tags FROM products UNION ALL
    SELECT sku, 'older', 'older', 'older', '-1', NULL, NULL, NULL, -1, -1, NULL FROM products WHERE p_partkey % 5 = 0"""


@query(
    "clean_catalog",
    f"""SELECT sku, name, category, price_usd, cost_usd, coalesce(margin_pct, 12.5::DOUBLE) AS margin_pct, is_active, CASE WHEN p_partkey % 3 = 0 THEN 'a|b' ELSE '' END AS tags, {domain.band_case("price_usd", "unknown")} AS price_band
    FROM (SELECT * REPLACE (trim(name) AS name) FROM products) p""",
)
def clean_catalog(lake: Lake) -> DataFrame:
    made = silver.clean_catalog(lake.sql(FEED))
    return made.select("sku", "name", "category", "price_usd", "cost_usd", "margin_pct", "is_active", F.array_join("tags", "|").alias("tags"), "price_band")


@query("win_dedup_sku", "SELECT sku, p_partkey AS content_hash FROM products")
def win_dedup_sku(lake: Lake) -> DataFrame:
    return silver.latest(lake.sql(FEED), ["sku"], [F.desc("ingested_at"), F.desc("content_hash")]).select("sku", "content_hash")


@query("catalog_report", "SELECT count(*) AS n_rows, count_if(price_usd IS NULL) AS null_price, count_if(coalesce(margin_pct, 12.5) < 0) AS negative_margin, count_if(NOT is_active) AS inactive FROM products")
def catalog_report(lake: Lake) -> DataFrame:
    return silver.catalog_report(silver.clean_catalog(lake.sql(FEED)))


@query("price_band", f"SELECT sku, {domain.band_case('price_usd', 'unknown')} AS silver_band, {domain.band_case('price_usd', 'luxury')} AS gold_band FROM products")
def price_band(lake: Lake) -> DataFrame:
    return lake.view("products").select("sku", core.price_band(F.col("price_usd")).alias("silver_band"), core.price_band(F.col("price_usd"), "luxury").alias("gold_band"))


CATALOG_NEW = "SELECT sku, CASE WHEN p_partkey % 4 = 0 THEN price_usd + 1 ELSE price_usd END AS price_usd, CASE WHEN p_partkey % 4 = 0 THEN 'changed' WHEN p_partkey % 9 <> 0 THEN sku END AS content_hash FROM products WHERE p_partkey % 10 <> 7"
CATALOG_OLD = "SELECT sku, price_usd, CASE WHEN p_partkey % 9 <> 0 THEN sku END AS content_hash FROM products WHERE p_partkey % 10 <> 3"


@query(
    "merge_catalog",
    f"""SELECT coalesce(o.sku, n.sku) AS sku, CASE WHEN o.sku IS NULL OR (n.sku IS NOT NULL AND o.content_hash IS DISTINCT FROM n.content_hash) THEN n.price_usd ELSE o.price_usd END AS price_usd,
        CASE WHEN o.sku IS NULL OR (n.sku IS NOT NULL AND o.content_hash IS DISTINCT FROM n.content_hash) THEN n.content_hash ELSE o.content_hash END AS content_hash
    FROM ({CATALOG_OLD}) o FULL OUTER JOIN ({CATALOG_NEW}) n ON o.sku = n.sku""",
)
def merge_catalog(lake: Lake) -> DataFrame:
    return merge.upsert(lake.sql(CATALOG_OLD), lake.sql(CATALOG_NEW), ["sku"], ~F.col("cur.content_hash").eqNullSafe(F.col("new.content_hash")))


@query("soft_delete", "SELECT sku, is_active AND p_partkey % 6 <> 0 AS is_active FROM products")
def soft_delete(lake: Lake) -> DataFrame:
    feed = lake.sql("SELECT CASE WHEN p_partkey % 6 <> 0 THEN sku END AS sku FROM products")
    return merge.soft_delete(lake.sql("SELECT sku, is_active FROM products"), feed)


@query("anti_not_in", "SELECT sku FROM products WHERE p_partkey % 6 = 0")
def anti_not_in(lake: Lake) -> DataFrame:
    feed = lake.sql("SELECT CASE WHEN p_partkey % 6 <> 0 THEN sku END AS sku FROM products")
    return lake.sql("SELECT sku FROM products").join(feed, "sku", "left_anti")


@query("src_rest_catalog", "SELECT sku, CAST(floor(p_partkey / 500) AS BIGINT) % 3 = 1 AS skipped FROM products WHERE p_partkey % 4 = 0 AND CAST(floor(p_partkey / 500) AS BIGINT) % 3 <> 1 UNION ALL SELECT sku, true FROM products WHERE CAST(floor(p_partkey / 500) AS BIGINT) % 3 = 1")
def src_rest_catalog(lake: Lake) -> DataFrame:
    """Two polls of the catalogue's pages. The second finds every third page as it was and skips it, and takes only products whose content is new."""
    path, page = _folder(lake), F.floor(F.col("p_partkey") / 500)
    rows = lake.sql("SELECT sku, price_usd, name, 1 AS stock, is_active, p_partkey FROM products").withColumn("page", page)
    last = rows.agg(F.max("page")).first()[0]

    def publish(price, to: str) -> DataFrame:
        listed = rows.withColumn("price_usd", price).groupBy("page").agg(F.sort_array(F.collect_list(F.struct("sku", "price_usd", "name", "stock", "is_active"))).alias("products"))  # a page has up to 500
        body = F.to_json(F.struct("products", F.when(F.col("page") < last, (F.col("page") + 1).cast("string")).alias("next_cursor")))
        listed.select(body.alias("value"), F.when(F.col("page") > 0, F.col("page").cast("string")).otherwise("first").alias("cursor")).write.partitionBy("cursor").text(to)

    other = F.when((F.col("p_partkey") % 4 == 0) & (F.col("page") % 3 != 1), -1.0).otherwise(F.col("price_usd"))
    publish(other, f"{path}/1")
    publish(F.col("price_usd"), f"{path}/2")
    first = feeds.stored_pages(lake.spark, f"{path}/1")
    second = feeds.stored_pages(lake.spark, f"{path}/2", first)
    seen = feeds.products(first).select("sku", core.content_hash(F.col("sku"), F.col("price_usd"), F.col("name"), F.col("stock"), F.col("is_active")).alias("content_hash"))
    fresh = connectors.changed_products(feeds.products(second), seen).select("sku", F.lit(False).alias("skipped"))
    left = second.where("NOT changed").select("cursor").join(first, "cursor").select(F.explode("products.sku").alias("sku"), F.lit(True).alias("skipped"))
    return fresh.unionByName(left)


_ADS_DAY = "(DATE '2024-01-01' + CAST(p_partkey % 10 AS INT))"


@query("src_ads", f"""SELECT 'facebook' AS source, CAST(p_partkey AS VARCHAR) AS ad_id, CAST(p_size % 3 AS DOUBLE) * 2 AS conversions, p_retailprice AS spend_usd, 'mobile' AS device_type, {_ADS_DAY} AS report_date FROM part WHERE p_partkey % 10 BETWEEN 2 AND 6
    UNION ALL SELECT 'google', CAST(p_partkey AS VARCHAR), 1.0, CAST(p_size * 1000 AS BIGINT) / 1e6, CASE p_size % 2 WHEN 0 THEN 'desktop' ELSE 'unknown' END, {_ADS_DAY} FROM part WHERE p_partkey % 10 BETWEEN 2 AND 6""")
def src_ads(lake: Lake) -> DataFrame:
    """Both networks' stored answers, a folder for each report date, of which five days are read."""
    part, path = lake.table("part").withColumn("day", F.expr("date_add(DATE'2024-01-01', CAST(p_partkey % 10 AS INT))")), _folder(lake)
    action = lambda kind, v: F.struct(F.lit(kind).alias("action_type"), v.cast("double").alias("value"))
    size = F.col("p_size") % 3
    common = [F.col("p_partkey").cast("string").alias("ad_id"), F.lit(1).cast("long").alias("impressions"), F.lit(1).cast("long").alias("clicks"), F.lit("US").alias("country"), "day"]
    fb = part.select(
        *common, F.lit("c").alias("campaign_name"), F.lit("s").alias("adset_name"), F.col("p_retailprice").alias("spend"), F.col("day").alias("date_start"),
        F.array(action("purchase", size), action("view", F.lit(9)), action("purchase", size)).alias("actions"), F.lit("Mobile").alias("device"),
    )
    google = part.select(
        *common, F.lit("c").alias("campaign"), F.lit("s").alias("ad_group"), (F.col("p_size") * 1000).cast("long").alias("cost_micros"), F.lit(1.0).alias("conversions"),
        F.col("day").alias("date"), F.when(F.col("p_size") % 2 == 0, "DESKTOP").otherwise("TV").alias("device"),
    )
    made = []
    for rows, schema, name in ((fb, feeds.FB, "facebook"), (google, feeds.GOOGLE, "google")):
        rows.write.partitionBy("day").json(f"{path}/{name}")
        made.append(lake.spark.read.schema(f"{schema}, day DATE").json(f"{path}/{name}").where("day BETWEEN DATE'2024-01-03' AND DATE'2024-01-07'"))
    return connectors.ads(*made).select("source", "ad_id", "conversions", "spend_usd", "device_type", "report_date")


# ---- orders: change stream and history

CHANGES = """SELECT CAST(o_orderkey AS STRING) AS order_id, CAST(o_custkey AS STRING) AS user_id, CASE v WHEN 0 THEN 'pending' WHEN 1 THEN 'confirmed' ELSE 'shipped' END AS status, o_totalprice + v AS total_amount_usd,
    CASE WHEN v = o_orderkey % 3 AND o_orderkey % 17 = 0 THEN 'd' WHEN v = 0 THEN 'c' ELSE 'u' END AS cdc_op, o_orderkey * 10 + v AS cdc_lsn, o_orderdate + make_interval(0, 0, 0, v) AS changed_at, v, o_orderkey
    FROM orders JOIN (VALUES (0), (1), (2)) AS t(v) ON v <= o_orderkey % 3"""
CHANGES_DUCK = CHANGES.replace("make_interval(0, 0, 0, v)", "to_days(v)")


def _history(lake: Lake, keep_all: bool = False) -> DataFrame:
    changes = lake.sql(CHANGES)
    body = ["order_id", "user_id", "status", "total_amount_usd", "cdc_op", "cdc_lsn", "changed_at"]
    empty = lake.spark.createDataFrame([], "order_id STRING, user_id STRING, status STRING, total_amount_usd DOUBLE, cdc_lsn BIGINT, effective_from TIMESTAMP_NTZ, effective_to TIMESTAMP_NTZ, is_current BOOLEAN, record_version INT, prev_status STRING")
    first = merge.scd2(empty, changes.where("v = 0").select(*body))
    return merge.scd2(first, changes.select(*body), keep_all=keep_all)  # the second batch replays the first one's rows


HISTORY = f"""
    SELECT order_id, CASE WHEN cdc_op = 'd' THEN 'deleted' ELSE status END AS status, total_amount_usd, cdc_lsn, changed_at, v, cdc_op,
        row_number() OVER (PARTITION BY order_id ORDER BY v) AS record_version FROM ({CHANGES_DUCK}) c"""


def _history_sql(rows: str) -> str:
    return f"""SELECT order_id, status, round(total_amount_usd, 2) AS total_amount_usd, cdc_lsn, changed_at AS effective_from, lead(changed_at) OVER w AS effective_to, lead(v) OVER w IS NULL AS is_current,
        CAST(row_number() OVER w AS INT) AS record_version, lag(status) OVER w AS prev_status FROM ({rows}) h WINDOW w AS (PARTITION BY order_id ORDER BY v)"""


def _shown(history: DataFrame) -> DataFrame:
    return history.select("order_id", "status", F.round("total_amount_usd", 2).alias("total_amount_usd"), "cdc_lsn", "effective_from", "effective_to", "is_current", "record_version", "prev_status")


query("merge_scd2", _history_sql(f"SELECT * FROM ({HISTORY}) a WHERE v = 0 OR v = (SELECT max(v) FROM ({CHANGES_DUCK}) b WHERE b.order_id = a.order_id)"))(lambda lake: _shown(_history(lake)))
query("merge_scd2_full", _history_sql(HISTORY))(lambda lake: _shown(_history(lake, keep_all=True)))
#: Faults planted in the history: a current version too many, an interval that runs backwards, a version left out.
_FAULTS = f"SELECT *, CAST(order_id AS BIGINT) % 11 AS fault FROM ({HISTORY}) h"


@query("scd2_integrity", f"""
    WITH h AS ({_FAULTS}), w AS (SELECT order_id, fault, count(*) AS n FROM h GROUP BY ALL)
    SELECT 'duplicate_current' AS "check", order_id FROM w WHERE fault = 1 AND n > 1 UNION ALL SELECT 'bad_interval', order_id FROM w WHERE fault = 2 AND n > 1 UNION ALL
    SELECT 'version_gap', order_id FROM w WHERE fault = 3 AND n > 2""")
def scd2_integrity(lake: Lake) -> DataFrame:
    """Every fault planted in the orders' whole history, and nothing of the orders without one."""
    fault, version = F.col("order_id").cast("long") % 11, F.col("record_version")
    rows = _history(lake, keep_all=True).where(~((fault == 3) & (version == 2) & ~F.col("is_current")))
    first = version == 1
    rows = rows.withColumn("is_current", F.col("is_current") | ((fault == 1) & first))
    return quality.scd2_integrity(rows.withColumn("effective_to", F.when((fault == 2) & first & F.col("effective_to").isNotNull(), F.col("effective_from")).otherwise(F.col("effective_to"))))


@query("win_dedup_cdc", f"SELECT order_id, max(cdc_lsn) AS cdc_lsn FROM ({CHANGES_DUCK}) c GROUP BY order_id")
def win_dedup_cdc(lake: Lake) -> DataFrame:
    return silver.latest(lake.sql(CHANGES), ["order_id"], [F.desc("cdc_lsn")]).select("order_id", "cdc_lsn")


_UNWRAPPED = f"""SELECT order_id, status, total_amount_usd AS total_amount, cdc_op, cdc_lsn, changed_at, cdc_op = 'd' AS deleted FROM ({CHANGES_DUCK}) c WHERE v <> 1 UNION ALL
    SELECT order_id, NULL, NULL, 't', NULL, NULL, true FROM ({CHANGES_DUCK}) c WHERE cdc_op = 'd' AND v <> 1"""


def _messages(lake: Lake) -> DataFrame:
    """Change envelopes as a bus has them: key, topic and JSON, each delete followed by a message without a value."""
    image = F.struct("order_id", "user_id", "status", F.col("total_amount_usd").alias("total_amount"))
    deleted, table = F.col("cdc_op") == "d", F.when(F.col("v") == 1, "users").otherwise("orders")
    envelope = F.to_json(F.struct(
        F.when(deleted, image).alias("before"), F.when(~deleted, image).alias("after"), F.struct(F.col("cdc_lsn").alias("lsn"), table.alias("table")).alias("source"),
        F.col("cdc_op").alias("op"), (F.unix_micros(F.col("changed_at").cast("timestamp")) / 1000).cast("long").alias("ts_ms"),
    ))
    values = F.when(deleted, F.array(envelope, F.lit(None).cast("string"))).otherwise(F.array(envelope))
    return lake.sql(CHANGES).select(F.col("order_id").alias("key"), F.concat(F.lit("prod.public."), table).alias("topic"), F.explode(values).alias("value"))


@query("src_cdc", _UNWRAPPED)
def src_cdc(lake: Lake) -> DataFrame:
    """Messages back to flat rows: deletes rewritten, tombstones kept, other tables' changes left out."""
    made = ingest.unwrap_cdc(_messages(lake), "orders", key="key", topic="topic")
    return made.select("order_id", "status", "total_amount", "cdc_op", "cdc_lsn", F.col("changed_at").cast("timestamp_ntz").alias("changed_at"), "deleted")


@query("flt_cdc_table", f"SELECT order_id, cdc_op, cdc_lsn FROM ({CHANGES_DUCK}) c WHERE v = 1 UNION ALL SELECT order_id, 't', NULL FROM ({CHANGES_DUCK}) c WHERE v = 1 AND cdc_op = 'd'")
def flt_cdc_table(lake: Lake) -> DataFrame:
    """The rows of the other table on the same bus."""
    return ingest.unwrap_cdc(_messages(lake), "users", key="key", topic="topic").select("order_id", "cdc_op", "cdc_lsn")


@query("snapshot_dbt", "SELECT CAST(c_custkey AS VARCHAR) AS id, c_mktsegment AS segment, true AS is_current FROM customer WHERE c_custkey % 4 <> 0 UNION ALL SELECT CAST(c_custkey AS VARCHAR), c_mktsegment, false FROM customer WHERE c_custkey % 4 = 0 UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'moved', true FROM customer WHERE c_custkey % 4 = 0")
def snapshot_dbt(lake: Lake) -> DataFrame:
    c = lake.table("customer")
    at = lambda day: F.lit(day).cast("timestamp_ntz")
    current = c.select(F.col("c_custkey").cast("string").alias("id"), F.col("c_mktsegment").alias("segment"), at("2024-01-01").alias("effective_from"), F.lit(None).cast("timestamp_ntz").alias("effective_to"), F.lit(True).alias("is_current"))
    new = c.select(F.col("c_custkey").cast("string").alias("id"), F.when(F.col("c_custkey") % 4 == 0, "moved").otherwise(F.col("c_mktsegment")).alias("segment"))
    return merge.scd2_apply(current, new, "id", ["segment"], at("2024-01-31")).select("id", "segment", "is_current")


OLD, NEW = "SELECT event_id, ingested_at, product_price_usd AS price FROM bronze WHERE k % 3 <> 0", "SELECT event_id, CASE WHEN k % 2 = 0 THEN ingested_at + INTERVAL 1 MINUTE ELSE ingested_at END AS ingested_at, product_price_usd + 1 AS price FROM bronze WHERE k % 5 <> 0"


@query("merge_events", f"SELECT coalesce(o.event_id, n.event_id) AS event_id, CASE WHEN o.event_id IS NULL OR n.ingested_at > o.ingested_at THEN n.ingested_at ELSE o.ingested_at END AS ingested_at, CASE WHEN o.event_id IS NULL OR n.ingested_at > o.ingested_at THEN n.price ELSE o.price END AS price FROM ({OLD}) o FULL OUTER JOIN ({NEW}) n ON o.event_id = n.event_id")
def merge_events(lake: Lake) -> DataFrame:
    return merge.upsert(lake.sql(OLD), lake.sql(NEW), ["event_id"], F.col("new.ingested_at") > F.col("cur.ingested_at"))


@query("upsert_dbt", f"SELECT coalesce(n.event_id, o.event_id) AS event_id, CASE WHEN n.event_id IS NULL THEN o.price ELSE n.price END AS price FROM ({OLD}) o FULL OUTER JOIN ({NEW}) n ON o.event_id = n.event_id")
def upsert_dbt(lake: Lake) -> DataFrame:
    return merge.upsert(lake.sql(f"SELECT event_id, price FROM ({OLD}) o"), lake.sql(f"SELECT event_id, price FROM ({NEW}) n"), ["event_id"])


# ---- sessions and fraud

SESSION_COLS = "user_id_hashed, session_start_ts, session_end_ts, session_duration_s, event_count, page_views, product_views, cart_adds, cart_removes, searches, checkout_attempts, purchases, revenue_attributed_usd, cart_value_usd, cart_abandonment, funnel_stage_reached, device_type, geo_country, ab_cohort, exit_event_type, max_fraud_score, fraud_flagged"


def _sessions_sql(minutes: int) -> str:
    return re.sub(r"FROM stitched\b", f"FROM ({domain.stitched(DUCK, minutes)}) st", domain.sessions(DUCK))


for _name, _minutes in (("session_stitch", 15), ("agg_session_metrics", 360)):
    query(_name, f"SELECT {SESSION_COLS} FROM ({_sessions_sql(_minutes)}) x")(lambda lake, m=_minutes: sessions.summarise(sessions.stitch(lake.view("silver"), m)).selectExpr(*SESSION_COLS.split(", ")))

FRAUD_SQL = """
    SELECT event_id, round(least(s1 + s2 + s3 + s4 + s5, CAST(1 AS DOUBLE)), 4) AS fraud_score,
        concat_ws(',', CASE WHEN s1 > 0 THEN 'VELOCITY_SPIKE' END, CASE WHEN s2 > 0 THEN 'GEO_HOP' END, CASE WHEN s3 > 0 THEN 'UNUSUAL_HOUR' END, CASE WHEN s4 > 0 THEN 'RAPID_PURCHASE' END, CASE WHEN s5 > 0 THEN 'CART_OVERFLOW' END) AS fraud_signals
    FROM (SELECT event_id,
            CASE WHEN n > 20 AND event_ts - before < INTERVAL 60 SECOND THEN 0.4::DOUBLE ELSE 0 END AS s1,
            CASE WHEN country IS NOT NULL AND geo_country IS NOT NULL AND country <> geo_country THEN 0.5::DOUBLE ELSE 0 END AS s2,
            CASE WHEN event_type = 'purchase' AND hour(event_ts) IN (2, 3) THEN 0.2::DOUBLE ELSE 0 END AS s3,
            CASE WHEN event_type = 'purchase' AND event_ts - viewed < INTERVAL 30 SECOND THEN 0.35::DOUBLE ELSE 0 END AS s4,
            CASE WHEN event_type = 'add_to_cart' AND product_quantity > 50 THEN 0.25::DOUBLE ELSE 0 END AS s5
        FROM (SELECT *, row_number() OVER i - 1 AS n, max(CASE WHEN event_type = 'product_view' THEN event_ts END) OVER (PARTITION BY user_id, island ORDER BY event_ts, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS viewed
            FROM (SELECT *, sum(CASE WHEN before IS NULL OR event_ts - before >= INTERVAL 15 MINUTE THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_ts, seq ROWS UNBOUNDED PRECEDING) AS island
                FROM (SELECT *, lag(event_ts) OVER (PARTITION BY user_id ORDER BY event_ts, seq) AS before,
                        last_value(geo_country IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_ts, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS country FROM bronze) a) b
            WINDOW i AS (PARTITION BY user_id, island ORDER BY event_ts, seq)) c) d"""


@query("fraud_score", FRAUD_SQL)
def fraud_score(lake: Lake) -> DataFrame:
    return fraud.score(lake.view("bronze")).select("event_id", "fraud_score", F.array_join("fraud_signals", ",").alias("fraud_signals"))


query("snk_alert", f"SELECT event_id, fraud_score FROM ({FRAUD_SQL}) x WHERE fraud_score >= 0.7")(lambda lake: fraud.alerts(fraud.score(lake.view("bronze"))).select("event_id", "fraud_score"))


@query("churn_enrich", "SELECT event_id, s AS churn_score, CASE WHEN s < 0.2 THEN 'stable' WHEN s < 0.5 THEN 'monitor' WHEN s < 0.75 THEN 'at_risk' WHEN s < 1.01 THEN 'high_churn' ELSE 'unknown' END AS churn_segment FROM bronze e LEFT JOIN (SELECT user_id, CAST(count(*) % 100 AS DOUBLE) / 100 AS s FROM bronze WHERE k % 3 = 0 GROUP BY user_id) x ON e.user_id = x.user_id")
def churn_enrich(lake: Lake) -> DataFrame:
    scores = lake.sql("SELECT user_id, CAST(count(*) % 100 AS DOUBLE) / 100 AS churn_score FROM bronze WHERE k % 3 = 0 GROUP BY user_id")
    return jobs.enrich_scores(lake.sql("SELECT event_id, user_id FROM bronze"), scores).select("event_id", "churn_score", "churn_segment")


@query("score_segment", "SELECT event_id, CASE WHEN fraud_score < 0.2 THEN 'stable' WHEN fraud_score < 0.5 THEN 'monitor' WHEN fraud_score < 0.75 THEN 'at_risk' ELSE 'high_churn' END AS segment FROM bronze")
def score_segment(lake: Lake) -> DataFrame:
    return lake.view("bronze").select("event_id", core.churn_segment(F.col("fraud_score")).alias("segment"))


@query("encode_cat", "SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 0 WHEN 1 THEN 4 WHEN 2 THEN 9 ELSE 9 END AS code FROM part")
def encode_cat(lake: Lake) -> DataFrame:
    name = F.element_at(F.array(F.lit("Electronics"), F.lit("BOOKS"), F.lit("Cars"), F.lit(None)), F.col("p_size") % 4 + 1)
    return lake.table("part").select("p_partkey", core.encode_category(name, C.CATEGORY_CODES).alias("code"))


@query("preprocess", "SELECT p_partkey, least(coalesce(p_size * 30, 999), 999) AS days_since_last_order, least(p_retailprice / 1000, CAST(1 AS DOUBLE)) AS discount_usage_rate FROM part")
def preprocess(lake: Lake) -> DataFrame:
    nan = F.when(F.col("p_partkey") < 0, F.lit(float("nan"))).otherwise(F.col("p_retailprice") / 1000)
    made = lake.table("part").select("p_partkey", (F.col("p_size") * 30).alias("days_since_last_order"), F.lit(1).alias("days_since_last_session"), nan.alias("discount_usage_rate"), F.lit(-0.5).alias("cart_abandonment_rate"))
    return silver.preprocess(made).select("p_partkey", "days_since_last_order", "discount_usage_rate")


# ---- models and serving, in SQL

for _name, _view in {
    "stg_orders": "stg_orders", "silver_sessions": "silver_sessions", "join_session_attr": "silver_orders", "dim_users": "dim_users", "dim_products": "dim_products", "dim_geography": "dim_geography",
    "dim_channels": "dim_channels", "dim_date": "dim_date", "fct_orders": "fct_orders", "fct_sessions": "fct_sessions", "agg_daily_order_kpis": "order_days", "agg_daily_sessions": "session_days", "agg_daily_final": "agg_daily",
    "agg_first_order": "first_orders", "agg_feature_orders": "feature_orders", "agg_feature_sessions": "feature_sessions", "join_feature": "features", "win_qualify": "top_channel", "win_pref_cat": "preferred_category",
    "win_primary_sku": "primary_sku", "join_spend": "user_spend",
}.items():
    both(_name, lambda d, v=_view: f"SELECT * FROM {v}")

SALES = "status NOT IN ('cancelled', 'refunded') AND order_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-25'"
D100 = "CAST(100 AS DOUBLE)"
SINCE = lambda n: f"CAST({NOW} - INTERVAL {n} DAY AS DATE)"

SQL: dict[str, Callable[[Spark], str]] = {
    "stg_clickstream": lambda d: "SELECT event_id, event_type, event_ts, product_price_usd, fraud_score > 0.7 AS fraud_flagged, dq_flag FROM silver",
    "inc_lookback": lambda d: f"SELECT session_id, session_date FROM fct_sessions WHERE session_date >= {SINCE(2)}",
    "join_channel_like": lambda d: """SELECT session_id, source FROM (SELECT s.session_id, c.source, row_number() OVER (PARTITION BY s.session_id ORDER BY c.source) AS rn FROM silver_sessions s
        LEFT JOIN (SELECT DISTINCT source FROM dim_channels) c ON lower(s.entry_referrer) LIKE concat('%', lower(c.source), '%')) x WHERE rn = 1""",
    "join_star_orders": lambda d: """SELECT o.order_id, u.ltv_band, p.category, g.region, t.fiscal_quarter, c.channel_group FROM fct_orders o LEFT JOIN dim_users u ON o.user_key = u.user_key LEFT JOIN dim_products p ON o.product_key = p.product_key
        LEFT JOIN dim_geography g ON o.geo_key = g.geo_key LEFT JOIN dim_date t ON o.date_key = t.date_key LEFT JOIN dim_channels c ON o.channel_key = c.channel_key""",
    "join_star_sessions": lambda d: """SELECT s.session_id, u.ltv_band, g.region, t.day_name, c.channel_group FROM fct_sessions s LEFT JOIN dim_users u ON s.user_key = u.user_key LEFT JOIN dim_geography g ON s.geo_key = g.geo_key
        LEFT JOIN dim_date t ON s.date_key = t.date_key LEFT JOIN dim_channels c ON s.channel_key = c.channel_key""",
    "join_full_daily": lambda d: "SELECT metric_date, o.total_orders, s.total_sessions FROM order_days o FULL OUTER JOIN session_days s USING (metric_date)",
    "join_first_order": lambda d: "SELECT o.order_id, f.first_order_date FROM fct_orders o LEFT JOIN first_orders f USING (user_key)",
    "join_geo_static": lambda d: "SELECT o.country, c.country_name FROM (SELECT DISTINCT geo_country AS country FROM silver) o LEFT JOIN country_rows c ON o.country = c.country",
    "join_dim_users": lambda d: "SELECT u.user_id_hashed, u.preferred_category, s.spend_90d FROM dim_users u LEFT JOIN user_spend s ON u.user_id_hashed = s.user_id_hashed",
    "agg_user_profile": lambda d: f"""SELECT u.user_id_hashed, u.ltv_band, u.preferred_category, u.country, g.is_gdpr_scope, u.is_current, round(sum(o.total_amount_usd) + 1e-9, 2) AS total_ltv_usd, count(o.order_id) AS order_count_90d
        FROM dim_users u LEFT JOIN fct_orders o ON u.user_key = o.user_key AND o.order_date >= {SINCE(90)} LEFT JOIN dim_geography g ON u.country = g.country WHERE u.is_current
        GROUP BY u.user_id_hashed, u.ltv_band, u.preferred_category, u.country, g.is_gdpr_scope, u.is_current""",
    "join_api_user": lambda d: f"SELECT u.user_id_hashed, count(o.order_id) AS orders FROM dim_users u LEFT JOIN fct_orders o ON u.user_key = o.user_key AND o.order_date >= {SINCE(10)} GROUP BY u.user_id_hashed",
    "agg_product": lambda d: f"""SELECT p.product_key, p.sku, p.brand, p.category, p.price_band, count(o.order_id) AS orders_30d, round(sum(o.total_amount_usd) + 1e-9, 2) AS revenue_30d_usd, count(DISTINCT o.user_key) AS unique_buyers_30d
        FROM dim_products p LEFT JOIN fct_orders o ON p.product_key = o.product_key AND o.order_date >= {SINCE(30)} GROUP BY p.product_key, p.sku, p.brand, p.category, p.price_band""",
    "join_api_product": lambda d: f"SELECT p.sku, count(o.order_id) AS orders FROM dim_products p LEFT JOIN fct_orders o ON p.product_key = o.product_key AND o.order_date >= {SINCE(10)} GROUP BY p.sku",
    "join_api_inner": lambda d: "SELECT o.order_id, p.sku, u.user_id_hashed FROM fct_orders o JOIN dim_products p ON o.product_key = p.product_key JOIN dim_users u ON o.user_key = u.user_key AND u.is_current",
    "join_mv_using": lambda d: "SELECT o.order_id, country, region FROM fct_orders o JOIN dim_geography g USING (geo_key)",
    "agg_ltv_segments": lambda d: f"SELECT ltv_band, count(*) AS user_count, round(avg(spend_90d) + 1e-9, 4) AS avg_ltv_usd, round(count(*) * {D100} / sum(count(*)) OVER (), 6) AS pct_of_total FROM dim_users WHERE is_current GROUP BY ltv_band",
    "agg_top_products": lambda d: f"""SELECT CAST(row_number() OVER (ORDER BY total_revenue_usd DESC, sku) AS BIGINT) AS rank, * FROM (SELECT p.sku, p.category, p.price_band, round(sum(o.total_amount_usd) + 1e-9, 2) AS total_revenue_usd, count(o.order_id) AS order_count,
        count(DISTINCT o.user_key) AS unique_buyers FROM fct_orders o JOIN dim_products p ON o.product_key = p.product_key WHERE {SALES} GROUP BY p.sku, p.category, p.price_band ORDER BY total_revenue_usd DESC, p.sku LIMIT 10) x""",
    "agg_price_band": lambda d: f"""SELECT p.price_band, round(sum(o.total_amount_usd) + 1e-9, 2) AS total_revenue_usd, count(o.order_id) AS order_count, round(avg(o.total_amount_usd) + 1e-9, 4) AS avg_order_value_usd,
        round(sum(o.total_amount_usd) * {D100} / sum(sum(o.total_amount_usd)) OVER (), 6) AS pct_of_revenue FROM fct_orders o JOIN dim_products p ON o.product_key = p.product_key WHERE {SALES} GROUP BY p.price_band""",
    "agg_category_trend": lambda d: f"SELECT o.order_date AS metric_date, p.category, round(sum(o.total_amount_usd) + 1e-9, 2) AS revenue_usd, count(o.order_id) AS order_count FROM fct_orders o JOIN dim_products p ON o.product_key = p.product_key WHERE {SALES} AND p.category IS NOT NULL GROUP BY o.order_date, p.category",
    "api_daily_metrics": lambda d: "SELECT metric_date, total_orders, gross_revenue_usd, total_sessions, overall_conversion_rate FROM agg_daily WHERE metric_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-15' ORDER BY metric_date",
    "api_purchase_history": lambda d: f"""SELECT o.order_id, o.order_date, o.total_amount_usd, p.sku, p.category, p.brand FROM fct_orders o JOIN dim_products p ON o.product_key = p.product_key
        WHERE o.user_key = (SELECT min(user_key) FROM dim_users WHERE is_current) AND o.order_date >= {SINCE(90)} ORDER BY o.order_date DESC, o.order_id""",
    "scalar_eq": lambda d: "SELECT order_id FROM fct_orders WHERE user_key = (SELECT max(user_key) FROM dim_users)",
    "scalar_corr": lambda d: "SELECT DISTINCT o.o_custkey, (SELECT count(*) + 1 FROM orders p WHERE p.o_custkey = o.o_custkey) AS next_version FROM orders o",
    "semi_in": lambda d: "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P' OR o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 45)",
    "mv_country_day": lambda d: f"""SELECT o.order_date, g.country, g.country_name, g.region, count(DISTINCT o.order_id) AS orders, count(DISTINCT o.user_key) AS unique_buyers, round(sum(o.total_amount_usd) + 1e-9, 2) AS revenue_usd, round(sum(o.net_amount_usd) + 1e-9, 2) AS net_revenue_usd,
        round(avg(o.total_amount_usd) + 1e-9, 4) AS aov_usd, round(sum(CASE WHEN o.fraud_flagged THEN o.total_amount_usd ELSE {gold.D0} END) + 1e-9, 2) AS fraud_exposure_usd FROM fct_orders o JOIN dim_geography g ON o.geo_key = g.geo_key GROUP BY o.order_date, g.country, g.country_name, g.region""",
    "mv_weekly_funnel": lambda d: f"SELECT {d.week('session_date')} AS week_start, funnel_exit_stage, count(DISTINCT session_id) AS sessions, round(sum(revenue_attributed_usd) + 1e-9, 2) AS revenue_usd FROM fct_sessions GROUP BY {d.week('session_date')}, funnel_exit_stage",
    "dash_country_2h": lambda d: "SELECT g.country, count(DISTINCT o.order_id) AS orders, round(sum(o.total_amount_usd) + 1e-9, 2) AS revenue_usd, round(avg(o.total_amount_usd) + 1e-9, 4) AS aov FROM fct_orders o JOIN dim_geography g ON o.geo_key = g.geo_key WHERE o.order_date = DATE '2024-01-20' AND o.updated_at >= TIMESTAMP '2024-01-20 10:00:00' GROUP BY g.country",
    "dash_funnel": lambda d: f"SELECT funnel_exit_stage, count(DISTINCT session_id) AS sessions, round(count(DISTINCT session_id) * {D100} / sum(count(DISTINCT session_id)) OVER (), 6) AS pct_of_total FROM fct_sessions WHERE session_date >= {SINCE(7)} GROUP BY funnel_exit_stage",
    "dash_fraud_hour": lambda d: "SELECT date_trunc('hour', updated_at) AS hour_bucket, count(*) FILTER (WHERE fraud_score > 0.7) AS flagged_orders, round(sum(total_amount_usd) FILTER (WHERE fraud_score > 0.7), 2) AS exposure_usd FROM fct_orders GROUP BY date_trunc('hour', updated_at) ORDER BY hour_bucket DESC LIMIT 24",
    "page": lambda d: "SELECT order_id, status, total_amount_usd FROM fct_orders WHERE user_key = (SELECT min(user_key) FROM dim_users) ORDER BY order_date DESC, order_id LIMIT 5 OFFSET 5",
    "topk": lambda d: "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20",
    "win_rank_global": lambda d: "SELECT row_number() OVER (ORDER BY n DESC, o_custkey) AS rank, o_custkey, n FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey ORDER BY n DESC, o_custkey LIMIT 25) x",
    "win_total": lambda d: f"SELECT o_orderpriority, round(count(*) * {D100} / sum(count(*)) OVER (), 6) AS pct FROM orders GROUP BY o_orderpriority",
    "win_lag": lambda d: "SELECT o_orderkey, lag(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS before FROM orders",
    "win_attr": lambda d: "SELECT order_id, attributed_session_id FROM silver_orders WHERE attributed_session_id IS NOT NULL",
    "agg_having": lambda d: "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) > 10",
    "agg_user_base": lambda d: "SELECT user_id_hashed, min(event_date) AS first_active_date, max(event_date) AS last_active_date FROM silver GROUP BY user_id_hashed",
    "agg_signup": lambda d: "SELECT user_id_hashed, min(order_date) AS signup_date FROM silver_orders GROUP BY user_id_hashed",
    "agg_pref_cat": lambda d: "SELECT e.user_id_hashed, p.category, count(*) AS n FROM silver e JOIN products p ON e.product_sku = p.sku WHERE e.event_type = 'purchase' GROUP BY e.user_id_hashed, p.category",
    "distinct": lambda d: "SELECT DISTINCT geo_country, geo_region FROM silver",
    "sort_date": lambda d: "SELECT full_date, date_key FROM dim_date ORDER BY full_date",
    "sort_case": lambda d: "SELECT ltv_band, count(*) AS n FROM dim_users GROUP BY ltv_band ORDER BY CASE ltv_band WHEN 'platinum' THEN 1 WHEN 'gold' THEN 2 WHEN 'silver' THEN 3 ELSE 4 END",
    "limit_sample": lambda d: "SELECT o_orderkey FROM orders WHERE o_totalprice > 300000 ORDER BY o_orderkey LIMIT 100",
    "union_all": lambda d: "SELECT c_custkey AS id FROM customer WHERE c_nationkey < 5 UNION ALL SELECT s_suppkey FROM supplier",
    "union_distinct": lambda d: "SELECT c_nationkey AS id FROM customer UNION SELECT s_nationkey FROM supplier",
    "generate_series": lambda d: f"SELECT count(*) AS n, min(full_date) AS first, max(full_date) AS last FROM ({d.series('2020-01-01', '2030-12-31')}) x",
    "inline_values": lambda d: "SELECT * FROM country_rows",
    "predicate_forms": lambda d: f"SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (1, 2, 3) AND o_totalprice BETWEEN 1000 AND 200000 AND {d.matches('o_orderpriority', '^[1-3]-')} AND NOT {d.matches('o_orderpriority', 'LOW')} AND o_orderstatus IN ('F', 'O') AND o_orderpriority LIKE '%H%'",
    "src_athena": lambda d: f"SELECT user_id_hashed, order_count_90d, CAST(churned_30d AS DOUBLE) AS label FROM features WHERE is_current = 1 AND days_since_last_order <= 90",
    "fn_surrogate_key": lambda d: f"SELECT c_custkey, {d.key('c_name', 'c_mktsegment', 'nullif(c_nationkey, 1)')} AS k FROM customer",
    "fn_hmac": lambda d: f"SELECT c_custkey, {d.hmac('c_name', 'x' * 80)} AS h FROM customer",
}
for _name, _text in SQL.items():
    both(_name, _text)

# ---- data quality

def _suite_sql(view: str, suite: list[quality.Expect]) -> str:
    parts = []
    for e in suite:
        c, seen, bad = e.column, f"count({e.column or 1})", ""
        if e.kind == "not_null":
            seen, bad = "count(*)", f"count_if({c} IS NULL)"
        elif e.kind == "in_set":
            members = ", ".join(f"'{v}'" if isinstance(v, str) else str(v).lower() for v in e.values)
            bad = f"count_if({c} NOT IN ({members}))"
        elif e.kind == "between":
            bad = f"count_if({' OR '.join(x for x in (f'{c} < {e.low}' if e.low is not None else '', f'{c} > {e.high}' if e.high is not None else '') if x)})"
        elif "regex" in e.kind:
            bad = f"count_if({'NOT ' if e.kind == 'match_regex' else ''}regexp_matches({c}, '{e.values[0]}'))"
        elif e.kind == "unique":
            parts.append(f"SELECT '{e.name}' AS name, '{e.level}' AS level, CAST(sum(n) AS BIGINT) AS seen, CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS unexpected, {e.mostly} AS mostly FROM (SELECT count(*) AS n FROM {view} WHERE {c} IS NOT NULL GROUP BY {c})")
            continue
        else:
            bad = f"CAST(count(*) < {e.low} OR count(*) > {e.high if e.high is not None else 1 << 62} AS BIGINT)"
        parts.append(f"SELECT '{e.name}' AS name, '{e.level}' AS level, {seen} AS seen, {bad} AS unexpected, {0 if e.kind == 'row_count' else e.mostly} AS mostly FROM {view}")
    return f"SELECT name, level, seen, unexpected, CASE WHEN mostly = 0 THEN unexpected = 0 ELSE seen - unexpected >= mostly * seen END AS success FROM ({' UNION ALL '.join(parts)}) e"


for _name, _view, _suite in (
    ("dq_bronze_critical", "checked_events", suites.BRONZE_CRITICAL), ("dq_bronze_warning", "checked_events", suites.BRONZE_WARNING),
    ("dq_orders", "checked_orders", suites.SILVER_CRITICAL + suites.SILVER_WARNING),
):
    query(_name, _suite_sql(_view, _suite))(lambda lake, v=_view, s=_suite: quality.run(lake.view(v), s))
BRONZE = suites.BRONZE_CRITICAL + suites.BRONZE_WARNING
query("dq_summary", f"SELECT count_if(NOT success AND level = 'critical') = 0 AS success, count(*) AS evaluated, count_if(NOT success) AS failed, count_if(NOT success AND level = 'warning') AS warnings FROM ({_suite_sql('checked_events', BRONZE)}) r")(
    lambda lake: quality.passed(quality.run(lake.view("checked_events"), BRONZE))
)


@query("dq_models", " UNION ALL ".join(f"SELECT '{m}' AS model, * FROM ({_suite_sql(m, s)}) r" for m, s in suites.MODELS.items()))
def dq_models(lake: Lake) -> DataFrame:
    """Every test of every gold model, one pass over each."""
    return reduce(DataFrame.unionByName, [quality.run(lake.view(m), s).select(F.lit(m).alias("model"), "*") for m, s in suites.MODELS.items()])


@query(
    "dq_freshness",
    """
    SELECT source, CASE WHEN age > 60 THEN 'error' WHEN age > 30 THEN 'warn' ELSE 'pass' END AS state FROM (
        SELECT 'silver_events' AS source, epoch(TIMESTAMP '2024-01-31 00:00:00' - max(ingested_at)) / 60 AS age FROM silver UNION ALL
        SELECT 'user_sessions', epoch(TIMESTAMP '2024-01-31 00:00:00' - max(session_end_ts)) / 60 - 100000 FROM silver_sessions UNION ALL
        SELECT 'orders', epoch(TIMESTAMP '2024-01-31 00:00:00' - max(updated_at)) / 60 + 1000000 FROM stg_orders UNION ALL
        SELECT 'product_catalog', 45 + min(p_size) % 10 FROM products) a""",
)
def dq_freshness(lake: Lake) -> DataFrame:
    """All four silver sources, each against its own load time."""
    now, minutes = F.lit("2024-01-31").cast("timestamp_ntz"), lambda m: F.expr(f"make_interval(0, 0, 0, 0, 0, {m}, 0)")
    loaded = {
        "silver_events": lake.view("silver").select(F.col("ingested_at").alias("processed_at")),
        "user_sessions": lake.view("silver_sessions").select((F.col("session_end_ts") + minutes(100_000)).alias("processed_at")),
        "orders": lake.view("stg_orders").select((F.col("updated_at") - minutes(1_000_000)).alias("processed_at")),
        "product_catalog": lake.view("products").agg(F.min("p_size").alias("p_size")).select((now - minutes("CAST(45 + p_size % 10 AS INT)")).alias("processed_at")),
    }
    return reduce(DataFrame.unionByName, [quality.freshness(df, "processed_at", now, suites.FRESH_WARN, suites.FRESH_ERROR).select(F.lit(n).alias("source"), "state") for n, df in loaded.items()])


# the rules on orders and users of which some are made to break them
query("dq_no_negative_revenue", "SELECT order_id FROM fct_orders WHERE CAST(substr(order_id, 2) AS BIGINT) % 7 = 0 AND total_amount_usd > 0")(
    lambda lake: quality.negative_revenue(lake.view("fct_orders").withColumn("total_amount_usd", F.when(F.substring("order_id", 2, 20).cast("long") % 7 == 0, -F.col("total_amount_usd")).otherwise(F.col("total_amount_usd"))))
)
_VERSIONS = "SELECT user_id_hashed, is_current FROM dim_users UNION ALL SELECT user_id_hashed, is_current FROM dim_users UNION ALL SELECT user_id_hashed, NOT is_current FROM dim_users"


@query("dq_one_current_user", f"SELECT user_id_hashed, count(*) AS n FROM ({_VERSIONS}) u WHERE is_current GROUP BY user_id_hashed HAVING count(*) > 1")
def dq_one_current_user(lake: Lake) -> DataFrame:
    """The rule on every user's row, the same row once more, and a version of it that isn't current."""
    users = lake.view("dim_users").select("user_id_hashed", "is_current")
    return quality.several_current(users.withColumn("is_current", F.explode(F.array("is_current", "is_current", ~F.col("is_current")))))


both("dq_model_keys", lambda d: " UNION ALL ".join(f"SELECT '{v}' AS model, count(*) - count(DISTINCT {k}) AS repeated, count_if({k} IS NULL) AS missing FROM {v}" for v, k in (("fct_orders", "order_id"), ("fct_sessions", "session_id"), ("dim_users", "user_key"), ("dim_products", "product_key"), ("dim_channels", "channel_key"), ("dim_geography", "geo_key"), ("dim_date", "date_key"))))


@query("model_metrics", """
    SELECT round((sum(r) FILTER (WHERE y = 1) - p * (p + 1) / 2.0) / (p * (n - p)), 6) AS auc, round(count_if(s >= 0.5 AND y = 1) / CAST(count_if(s >= 0.5) AS DOUBLE), 6) AS precision_at_half,
        round(count_if(s >= 0.5 AND y = 1) / CAST(p AS DOUBLE), 6) AS recall_at_half, round(count_if((s >= 0.5) <> (y = 1)) / CAST(n AS DOUBLE), 6) AS error,
        round(sum(CASE WHEN y = 1 THEN found / CAST(above AS DOUBLE) END) / p, 6) AS average_precision
    FROM (SELECT s, y, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0 AS r, sum(y) OVER () AS p, count(*) OVER () AS n,
        sum(y) OVER (ORDER BY s DESC) AS found, count(*) OVER (ORDER BY s DESC) AS above
        FROM (SELECT fraud_score AS s, CASE WHEN (k * 7) % 100 + k > 100 THEN 1 ELSE 0 END AS y FROM bronze) a) b GROUP BY p, n""")
def model_metrics(lake: Lake) -> DataFrame:
    return quality.classifier_metrics(lake.sql("SELECT fraud_score AS s, CASE WHEN (k * 7) % 100 + k > 100 THEN 1 ELSE 0 END AS y FROM bronze"))


# ---- views kept up to date

#: What is there in the end: all but every fifth row, and of that fifth the rows of five days, which come later.
_LATE_ORDER = "CAST(substr(order_id, 2) AS BIGINT) % 5 = 0"
_LATE_SESSION = "substr(session_id, 1, 1) IN ('0', '5', 'a')"
_MV = re.sub(r"FROM fct_orders o", f"FROM (SELECT * FROM fct_orders WHERE NOT {_LATE_ORDER} OR day(order_date) BETWEEN 10 AND 14) o", SQL["mv_country_day"](DUCK))
_FUNNEL = re.sub(r"FROM fct_sessions", f"FROM (SELECT * FROM fct_sessions WHERE NOT {_LATE_SESSION} OR day(session_date) BETWEEN 10 AND 14) s", SQL["mv_weekly_funnel"](DUCK))


def _kept_up(lake: Lake, view: kept.Kept, rows: DataFrame, late: str) -> DataFrame:
    """The view made of early rows, then refreshed by the dates that late rows are of."""
    path = _folder(lake)
    kept.append(rows.where(f"NOT {late}"), f"{path}/source", view.day)
    kept.refresh(lake.spark, view, f"{path}/source", f"{path}/view")
    dates = kept.append(rows.where(f"{late} AND day({view.day}) BETWEEN 10 AND 14"), f"{path}/source", view.day)
    kept.refresh(lake.spark, view, f"{path}/source", f"{path}/view", dates)
    return kept.read(lake.spark, view, f"{path}/view")


@query("kept_country_day", _MV)
def kept_country_day(lake: Lake) -> DataFrame:
    places = lake.view("dim_geography").select("geo_key", "country", "country_name", "region")
    return _kept_up(lake, kept.COUNTRY_DAY, lake.view("fct_orders").join(places, "geo_key"), _LATE_ORDER)


@query("kept_weekly_funnel", _FUNNEL)
def kept_weekly_funnel(lake: Lake) -> DataFrame:
    return _kept_up(lake, kept.WEEKLY_FUNNEL, lake.view("fct_sessions"), _LATE_SESSION)


#: The day that customers are looked at from, with 90 days of orders after it.
SEEN = "DATE'2001-05-01'"
CUSTOMER_FEATURES = ("days_since_last_order", "order_count_30d", "order_count_90d", "order_frequency_30d", "avg_order_value_usd", "total_ltv_usd", "max_order_value_usd", "discount_usage_rate", "refund_count_90d")
#: One label of the past (no order for 30 days, some in the 60 before), which the features tell, and one of the 90 days to come.
CHURNED = ("churned_30d", "left_90d")
#: Fewer and smaller trees than the parameters' defaults, for tables of this size.
CHURN = churn.Params(rounds=30, depth=4)


def customer_rows(lake: Lake) -> DataFrame:
    """Model rows of all customers with an order before SEEN, from orders and lines."""
    day = lambda n: F.expr(f"{SEEN} - INTERVAL {n} DAY")
    orders = lake.table("orders").select("o_orderkey", "o_custkey", "o_totalprice", F.to_date("o_orderdate").alias("at"))
    lines = lake.table("lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("lines"), F.count_if(F.col("l_discount") > 0.05).alias("cut"), F.count_if(F.col("l_returnflag") == "R").alias("back"))
    past = orders.where(F.col("at") < F.expr(SEEN)).join(lines, orders.o_orderkey == lines.l_orderkey, "left").groupBy("o_custkey").agg(
        F.datediff(F.expr(SEEN), F.max("at")).alias("days_since_last_order"), F.count_if(F.col("at") >= day(30)).alias("order_count_30d"), F.count_if(F.col("at") >= day(90)).alias("order_count_90d"),
        F.avg("o_totalprice").alias("avg_order_value_usd"), F.sum("o_totalprice").alias("total_ltv_usd"), F.max("o_totalprice").alias("max_order_value_usd"),
        F.try_divide(F.sum("cut").cast("double"), F.sum("lines")).alias("discount_usage_rate"), F.sum(F.when(F.col("at") >= day(90), F.col("back")).otherwise(0)).alias("refund_count_90d"),
    )
    later = orders.where((F.col("at") >= F.expr(SEEN)) & (F.col("at") < F.expr(f"{SEEN} + INTERVAL 90 DAY"))).select("o_custkey").distinct().withColumn("came", F.lit(1))
    rows = past.join(later, "o_custkey", "left").withColumn("order_frequency_30d", F.col("order_count_90d") / 3.0)
    labels = {"churned_30d": ((F.col("order_count_30d") == 0) & (F.col("order_count_90d") > 0)).cast("int"), "left_90d": F.col("came").isNull().cast("int")}
    return rows.withColumns(labels).withColumn("customer", F.col("o_custkey").cast("string"))


_PART = "substr(md5(concat('42:', CAST(o_custkey AS VARCHAR))), 1, 2)"


@query("model_split", f"""
    SELECT label, CASE WHEN {_PART} < 'b3' THEN 'train' WHEN {_PART} < 'da' THEN 'validation' ELSE 'test' END AS split, count(*) AS users,
        CAST(sum(CASE label WHEN 'churned_30d' THEN recent ELSE gone END) AS BIGINT) AS churned, CAST(sum(least(days, 999)) AS BIGINT) AS days, CAST(sum(returned) AS BIGINT) AS returned
    FROM (SELECT o.o_custkey, date_diff('day', max(o_orderdate), {SEEN}) AS days, sum(CASE WHEN o_orderdate >= {SEEN} - INTERVAL 90 DAY THEN coalesce(back, 0) ELSE 0 END) AS returned,
            CASE WHEN max(o_orderdate) < {SEEN} - INTERVAL 30 DAY AND max(o_orderdate) >= {SEEN} - INTERVAL 90 DAY THEN 1 ELSE 0 END AS recent,
            CASE WHEN o_custkey IN (SELECT o_custkey FROM orders WHERE o_orderdate >= {SEEN} AND o_orderdate < {SEEN} + INTERVAL 90 DAY) THEN 0 ELSE 1 END AS gone
        FROM orders o LEFT JOIN (SELECT l_orderkey, count_if(l_returnflag = 'R') AS back FROM lineitem GROUP BY l_orderkey) l ON o_orderkey = l_orderkey WHERE o_orderdate < {SEEN} GROUP BY o.o_custkey) c,
        (VALUES ('churned_30d'), ('left_90d')) n(label)
    GROUP BY ALL""")
def model_split(lake: Lake) -> DataFrame:
    """The rows that the models are trained, stopped and judged on."""
    value = lambda c: vector_to_array("x")[CUSTOMER_FEATURES.index(c)]
    found = stored_rows(customer_rows(lake), "customers")
    parts = [churn.model_rows(found, "customer", label, CUSTOMER_FEATURES).withColumn("name", F.lit(label)) for label in CHURNED]
    rows = reduce(DataFrame.unionByName, parts).groupBy(F.col("name").alias("label"), "split")
    return rows.agg(F.count(F.lit(1)).alias("users"), F.sum("label").cast("long").alias("churned"), F.sum(value("days_since_last_order")).cast("long").alias("days"), F.sum(value("refund_count_90d")).cast("long").alias("returned"))


@query("model_training", None)
def model_training(lake: Lake) -> DataFrame:
    """Churn models from orders to verdict: trained, saved, loaded again, scored on all customers, judged by part."""
    found, made = stored_rows(customer_rows(lake), "customers"), []
    for label in CHURNED:
        rows = churn.model_rows(found, "customer", label, CUSTOMER_FEATURES)
        model = churn.load(lake.spark, churn.save(churn.train(rows, CHURN), f"{_folder(lake)}-model"))
        made.append(churn.report(churn.score(rows, model), model).withColumn("label", F.lit(label)))
    return reduce(DataFrame.unionByName, made)


# ---- tables with snapshots


def _two(lake: Lake) -> tuple[SnapshotTable, int]:
    table = SnapshotTable(lake.spark, _folder(lake))
    rows = lake.sql("SELECT event_id, ingested_at, product_price_usd AS price, k FROM bronze")
    first = table.append(rows.where("k % 2 = 0"))
    table.append(rows.where("k % 2 = 1"))
    return table, first


@query("src_incremental", "SELECT event_id, k FROM bronze WHERE k % 2 = 1")
def src_incremental(lake: Lake) -> DataFrame:
    table, first = _two(lake)
    mark = Bookmark(lake.spark, f"{table.path}-bookmark")
    mark.put(first)
    table.compact()
    table.merge(lake.sql("SELECT event_id, ingested_at, -1.0D AS price, k FROM bronze WHERE k % 10 = 3"), ["event_id"])
    return table.read_between(mark.get()).select("event_id", "k")  # what the second append brought, whatever came after it


query("src_table", "SELECT event_id, k FROM bronze")(lambda lake: _two(lake)[0].read().select("event_id", "k"))
query("src_snapshots", "SELECT 1 AS snapshot_id, 'append' AS operation, 1 AS n_files UNION ALL SELECT 2, 'append', 2")(lambda lake: _two(lake)[0].snapshots().select(F.col("snapshot_id").cast("int").alias("snapshot_id"), "operation", "n_files"))


@query("snk_merge", "SELECT event_id, CASE WHEN k % 10 = 0 THEN price + 1 ELSE price END AS price FROM (SELECT event_id, product_price_usd AS price, k FROM bronze) b")
def snk_merge(lake: Lake) -> DataFrame:
    table, _ = _two(lake)
    new = lake.sql("SELECT event_id, CASE WHEN k % 10 = 0 THEN ingested_at + INTERVAL 1 HOUR ELSE ingested_at END AS ingested_at, product_price_usd + 1 AS price, k FROM bronze WHERE k % 5 = 0")
    table.merge(new, ["event_id"], F.col("new.ingested_at") > F.col("cur.ingested_at"))
    return table.read().select("event_id", "price")


@query("schema_ops", "SELECT event_id AS id, CAST(NULL AS VARCHAR) AS note FROM bronze WHERE k % 2 = 0 UNION ALL SELECT event_id, 'new' FROM bronze WHERE k % 2 = 1")
def schema_ops(lake: Lake) -> DataFrame:
    table = SnapshotTable(lake.spark, _folder(lake))
    rows = lake.sql("SELECT event_id, k FROM bronze")
    table.append(rows.where("k % 2 = 0").select("event_id"))
    table.add_column("note", "string")
    table.rename_column("event_id", "id")
    table.append(rows.where("k % 2 = 1").select(F.col("event_id").alias("id"), F.lit("new").alias("note")))
    return table.read()


@query("branch", "SELECT 'main' AS name, count(*) AS n FROM bronze WHERE k % 2 = 0 UNION ALL SELECT 'backfill', count(*) FROM bronze UNION ALL SELECT 'forwarded', count(*) FROM bronze")
def branch(lake: Lake) -> DataFrame:
    table = SnapshotTable(lake.spark, _folder(lake))
    rows = lake.sql("SELECT event_id, k FROM bronze")
    table.append(rows.where("k % 2 = 0"))
    table.branch("backfill")
    table.append(rows.where("k % 2 = 1"), branch="backfill")
    n = lambda df, name: df.agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("n"))
    before = n(table.read(), "main").unionByName(n(table.read(branch="backfill"), "backfill"))
    table.fast_forward("backfill")
    return before.unionByName(n(table.read(), "forwarded"))


@query("expiry", "SELECT count(*) AS n, 1 AS kept FROM bronze")
def expiry(lake: Lake) -> DataFrame:
    now = [0]
    table = SnapshotTable(lake.spark, _folder(lake), clock=lambda: now[0])
    rows = lake.sql("SELECT event_id, k FROM bronze")
    for part in range(3):
        table.append(rows.where(f"k % 3 = {part}"))
        now[0] += 10 * 86400
    table.compact()
    table.expire(5)
    return table.read().agg(F.count(F.lit(1)).alias("n")).withColumn("kept", F.lit(table.snapshots().count()))


@query("snk_feature", "SELECT user_id, max(event_ts) AS feature_timestamp FROM bronze GROUP BY user_id")
def snk_feature(lake: Lake) -> DataFrame:
    table = SnapshotTable(lake.spark, _folder(lake))
    rows = lake.sql("SELECT user_id, event_ts AS feature_timestamp, k FROM bronze")
    half = rows.where("k % 2 = 0")
    from pyspark.sql import Window

    w = Window.partitionBy("user_id").orderBy(F.desc("feature_timestamp"))
    table.append(half.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r"))
    connectors.feature_put(table, rows, "user_id", "feature_timestamp", within_s=0)
    return table.read().select("user_id", "feature_timestamp")


# ---- streams over replayed files


def _stream(lake: Lake) -> tuple[str, DataFrame]:
    """Raw lines as files by time of arrival, three to a batch."""
    path = _folder(lake)
    raw_lines(lake).repartitionByRange(6, "ingested_at").select("value").write.text(f"{path}/in")
    return path, connectors.file_source(lake.spark, f"{path}/in", 3)


BRONZE_OUT = f"""
    SELECT 'bronze' AS sink, event_id, coalesce({FLAG}, CASE WHEN k % 4 = 3 THEN 'WARNING' END) AS note FROM ({ODD}) o WHERE k % 10 <> 0 AND {FLAG} IS DISTINCT FROM 'CRITICAL' UNION ALL
    SELECT 'dead letters', NULL, CASE WHEN k % 10 = 0 THEN 'malformed JSON' ELSE {REASON} END FROM ({ODD}) o WHERE k % 10 = 0 OR {FLAG} = 'CRITICAL'"""


@query("stream_bronze", BRONZE_OUT)
def stream_bronze(lake: Lake) -> DataFrame:
    """Everything that both sinks hold after the replay in several batches."""
    path, stream = _stream(lake)
    table, dead = SnapshotTable(lake.spark, f"{path}/bronze"), SnapshotTable(lake.spark, f"{path}/dead")
    jobs.bronze(stream, table, dead, f"{path}/ck", f"bronze{uuid.uuid4().hex}", F.timestamp_seconds(F.lit(1706659200))).awaitTermination()
    kept = table.read().select(F.lit("bronze").alias("sink"), "event_id", F.col("dq_flag").alias("note"))
    return kept.unionByName(dead.read().select(F.lit("dead letters").alias("sink"), F.lit(None).cast("string").alias("event_id"), F.col("reason").alias("note")))


@query("late_data", f"SELECT event_id, k % 2 = 1 AS late FROM ({ODD}) o WHERE k % 10 <> 0 AND {FLAG} IS DISTINCT FROM 'CRITICAL' AND event_id NOT IN (SELECT event_id FROM bronze WHERE is_bot)")
def late_data(lake: Lake) -> DataFrame:
    """Events that arrive days after others of their time: bronze keeps them, and the next increment brings them to silver."""
    path = _folder(lake)
    lines = raw_lines(lake).repartitionByRange(4, "ingested_at")
    bronze, dead, refined = (SnapshotTable(lake.spark, f"{path}/{n}") for n in ("bronze", "dead", "silver"))
    mark = Bookmark(lake.spark, f"{path}/bookmark")
    for late in (0, 1):  # the second delivery is of the same days
        lines.where(F.col("k") % 2 == late).select("value").write.mode("append").text(f"{path}/in")
        jobs.bronze(connectors.file_source(lake.spark, f"{path}/in", 100), bronze, dead, f"{path}/ck", f"late{uuid.uuid4().hex}", F.timestamp_seconds(F.lit(1706659200))).awaitTermination()
        fresh = silver.drop_unwanted(bronze.read_between(mark.get()).withColumn("is_internal", F.lit(False))).select("event_id", "ingested_at", F.lit(late == 1).alias("late"))
        refined.merge(silver.latest(fresh, ["event_id"], [F.desc("ingested_at")]), ["event_id"], F.col("new.ingested_at") > F.col("cur.ingested_at"))
        mark.put(bronze.current_id())
    return refined.read().select("event_id", "late")


def _replay(rows: DataFrame, path: str, by: Column, batches: int = 3) -> DataFrame:
    """Rows as files in the order of `by` (microseconds), a range of it to a micro-batch, as a bus would bring them.

    A file source reads files in the order of their writing, so each range is a job of its own; as many files as have rows enough.
    """
    spark = rows.sparkSession
    count, cuts = rows.agg(F.count(F.lit(1)), F.percentile_approx(by, [k / batches for k in range(1, batches)], 1000)).first()
    files = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), count // batches // 100_000))
    place = reduce(lambda at, c: at + (by > c).cast("int"), cuts or [], F.lit(0))
    for k in range(batches):
        rows.where(place == k).repartition(files).write.mode("append").parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(path)


def _event_stream(lake: Lake, view: str, cols: str) -> tuple[str, DataFrame]:
    path = _folder(lake)
    rows = lake.sql(f"SELECT {cols} FROM {view}").withColumn("event_ts", F.col("event_ts").cast("timestamp"))
    return path, _replay(rows, f"{path}/in", F.unix_micros("event_ts"))


CLOSED = f"SELECT user_id_hashed, session_start_ts, session_end_ts, event_count, purchases, revenue_attributed_usd, funnel_stage_reached FROM ({_sessions_sql(15)}) x WHERE session_end_ts + INTERVAL 15 MINUTE <= (SELECT max(event_ts) - INTERVAL 4 HOUR FROM silver)"


@query("stream_sessions", CLOSED)
def stream_sessions(lake: Lake) -> DataFrame:
    path, events = _event_stream(lake, "silver", "user_id_hashed, event_ts, event_type, product_price_usd, product_quantity, device_type, geo_country, ab_cohort, page_referrer, fraud_score, seq")
    made = jobs.session_summaries(events).writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/ck").outputMode("append").trigger(availableNow=True).start()
    made.awaitTermination()
    ntz = lambda c: F.col(c).cast("timestamp_ntz").alias(c)
    return lake.spark.read.parquet(f"{path}/out").select("user_id_hashed", ntz("session_start_ts"), ntz("session_end_ts"), "event_count", "purchases", "revenue_attributed_usd", "funnel_stage_reached")


SESSION_VALUES = [c for c in SESSION_COLS.split(", ") if c != "user_id_hashed"]
#: Every event with its session, and the sessions that the watermark of the last batch has closed.
SESSION_RECORDS = f"""
    SELECT 'event' AS record_type, user_id_hashed, {DUCK.key("user_id_hashed", "session_no")} AS session_id, event_id, event_type, {", ".join(f"NULL AS {c}" for c in SESSION_VALUES)} FROM ({domain.stitched(DUCK, 15)}) st UNION ALL
    SELECT 'session_summary', user_id_hashed, session_id, NULL, NULL, {", ".join(SESSION_VALUES)} FROM ({_sessions_sql(15)}) x
    WHERE session_end_ts + INTERVAL 15 MINUTE <= (SELECT max(event_ts) - INTERVAL 4 HOUR FROM silver)"""


@query("stream_session_events", SESSION_RECORDS)
def stream_session_events(lake: Lake) -> DataFrame:
    """Sessions with passthrough over several micro-batches: an event leaves in its batch, a summary when its timer fires."""
    path, events = _event_stream(lake, "silver", ", ".join(["user_id_hashed", "event_ts", *stateful.SESSION_IN]))
    stateful.session_events(events).writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/ck").trigger(availableNow=True).start().awaitTermination()
    return _session_records(lake.spark.read.parquet(f"{path}/out"))


def _session_records(made: DataFrame) -> DataFrame:
    ntz = [F.col(c).cast("timestamp_ntz").alias(c) for c in ("session_start_ts", "session_end_ts")]
    return made.select("record_type", "user_id_hashed", "session_id", "event_id", "event_type", *ntz, *[c for c in SESSION_VALUES if not c.endswith("_ts")])


@query("stream_restart", SESSION_RECORDS)
def stream_restart(lake: Lake) -> DataFrame:
    """The sessions' stream, stopped after a batch was written and before it was committed, and started again: as if unbroken."""
    path, events = _event_stream(lake, "silver", ", ".join(["user_id_hashed", "event_ts", *stateful.SESSION_IN]))
    records, stopped = stateful.session_events(events), []

    def stop(number: int) -> None:
        if number == 1:
            stopped.append(number)
            raise RuntimeError("stopped between a batch and its commit")

    def run(done: Callable[[int], None] | None = None) -> None:
        sinks.exactly_once(records, f"{path}/out", f"{path}/ck", f"restart{uuid.uuid4().hex}", done=done).awaitTermination()

    try:
        run(stop)
    except StreamingQueryException:
        if not stopped:
            raise
    if not stopped:
        raise RuntimeError("the stream came to its end without being stopped")
    run()  # whatever stops this one is an error
    return _session_records(sinks.read_batches(lake.spark, f"{path}/out", records.schema, f"{path}/ck"))


@query("late_rows", """
    SELECT count_if(NOT late) AS kept, count_if(late) AS dropped FROM (SELECT event_ts + INTERVAL 4 HOUR < (SELECT max(event_ts) FROM bronze WHERE k % 5 <> 0) AS late FROM bronze WHERE k % 5 = 0) b""")
def late_rows(lake: Lake) -> DataFrame:
    """Two inputs, of which one comes when the other is through: what the watermark of the first one makes of its rows."""
    path, rows = _folder(lake), lake.sql("SELECT user_id, event_id, event_ts, k FROM bronze").withColumn("event_ts", F.col("event_ts").cast("timestamp"))
    rows.where("k % 5 <> 0").write.parquet(f"{path}/busy")
    lake.spark.createDataFrame([], rows.schema).write.parquet(f"{path}/quiet")
    read = lambda name: lake.spark.readStream.schema(rows.schema).parquet(f"{path}/{name}")
    kept = sinks.merged([read("busy"), read("quiet")]).dropDuplicatesWithinWatermark(["event_id"])
    counts = 0
    for _ in range(2):
        with sinks.watermark_policy(lake.spark, wait_for_all=False):
            q = sinks.exactly_once(kept, f"{path}/out", f"{path}/ck", f"late{uuid.uuid4().hex}")
            q.awaitTermination()
        counts += sum(n for _, _, n in sinks.late_rows(q))
        if not counts:
            rows.where("k % 5 = 0").write.mode("append").parquet(f"{path}/quiet")
    made = sinks.read_batches(lake.spark, f"{path}/out", rows.schema, f"{path}/ck").where("k % 5 = 0")
    return made.agg(F.count(F.lit(1)).alias("kept")).withColumn("dropped", F.lit(counts).cast("long"))


@query("stream_fraud", FRAUD_SQL)
def stream_fraud(lake: Lake) -> DataFrame:
    path, events = _event_stream(lake, "bronze", ", ".join(["user_id", "event_ts", *stateful.FRAUD_IN]))
    table, alerts = SnapshotTable(lake.spark, f"{path}/scores"), SnapshotTable(lake.spark, f"{path}/alerts")
    jobs.fraud_alerts(stateful.fraud_scores(events), table, alerts, f"{path}/ck", f"fraud{uuid.uuid4().hex}").awaitTermination()
    return table.read().select("event_id", "fraud_score", "fraud_signals")


#: Records of a user in order of time; one is left out if it repeats the last written one within six hours.
FEATURE_WRITES = """
    SELECT user_id, event_ts AS feature_timestamp, device_type, fast FROM (
        WITH RECURSIVE e AS (
            SELECT user_id, event_ts, device_type, product_quantity > 50 AS fast, row_number() OVER (PARTITION BY user_id ORDER BY event_ts, seq) AS i FROM bronze
        ), w AS (
            SELECT *, true AS written, device_type AS d, fast AS f, event_ts AS at FROM e WHERE i = 1 UNION ALL
            SELECT n.user_id, n.event_ts, n.device_type, n.fast, n.i, NOT n.same, CASE WHEN n.same THEN n.d ELSE n.device_type END, CASE WHEN n.same THEN n.f ELSE n.fast END, CASE WHEN n.same THEN n.at ELSE n.event_ts END
            FROM (SELECT e.*, w.d, w.f, w.at, e.device_type IS NOT DISTINCT FROM w.d AND e.fast IS NOT DISTINCT FROM w.f AND e.event_ts - w.at < INTERVAL 6 HOUR AS same FROM w JOIN e ON e.user_id = w.user_id AND e.i = w.i + 1) n
        ) SELECT * FROM w) x WHERE written"""


def _feature_stream(lake: Lake) -> tuple[str, DataFrame]:
    path, events = _event_stream(lake, "bronze", "user_id, event_ts, device_type, product_quantity > 50 AS fast")
    return path, features.without_repeats(events.withColumnRenamed("event_ts", "feature_timestamp"), "user_id", within_s=6 * 3600)


@query("stream_features", FEATURE_WRITES)
def stream_features(lake: Lake) -> DataFrame:
    """Feature records that the stream lets through over three micro-batches, as the store's offline copy has them."""
    path, records = _feature_stream(lake)
    records.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/ck").trigger(availableNow=True).start().awaitTermination()
    return lake.spark.read.parquet(f"{path}/out").withColumn("feature_timestamp", F.col("feature_timestamp").cast("timestamp_ntz"))


@query("feature_writes", "SELECT count_if(CAST(substr(user_id, 2) AS BIGINT) % 41 <> 0) AS sent, count_if(CAST(substr(user_id, 2) AS BIGINT) % 41 = 0) AS failed FROM bronze")
def feature_writes(lake: Lake) -> DataFrame:
    """A bulk write whose stand-in store refuses some users: what all tasks count, within the budget."""
    counted = features.put_records(lake.view("bronze").select("user_id", "event_ts", "device_type"), _store)
    return counted.agg(F.sum("sent").alias("sent"), F.sum("failed").alias("failed"))


def _store() -> features.Put:
    def put(record: features.Record) -> None:
        if int(record[0]["ValueAsString"][1:]) % 41 == 0:
            raise ConnectionError("refused")

    return put


@query("stream_history", _history_sql(HISTORY))
def stream_history(lake: Lake) -> DataFrame:
    """The history from a change stream that comes in four batches, up to six days out of order, and a last message that moves the watermark past all."""
    path = _folder(lake)
    rows = stored_rows(lake.sql(CHANGES).withColumn("changed_at", F.col("changed_at").cast("timestamp")).drop("v", "o_orderkey"), "changes")
    day = 86_400_000_000
    shaken = F.unix_micros("changed_at") + F.pmod(F.xxhash64("order_id", "cdc_lsn"), F.lit(6 * day))
    stream = _replay(rows, f"{path}/in", shaken, 4)
    end = rows.agg((F.max("changed_at") + F.expr("INTERVAL 30 DAY")).alias("changed_at"))
    end.select(*[F.col(c) if c == "changed_at" else F.lit(None).cast(t).alias(c) for c, t in rows.dtypes]).write.mode("append").parquet(f"{path}/in")
    made = history.versions(stream)
    sinks.exactly_once(made, f"{path}/out", f"{path}/ck", f"history{uuid.uuid4().hex}").awaitTermination()
    found = history.laid_out(sinks.read_batches(lake.spark, f"{path}/out", made.schema, f"{path}/ck"))
    return _shown(found.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("effective_from", "effective_to")}))


# ---- the rest of the inventory


@query("build_orders", f"SELECT order_id, CASE WHEN cdc_op = 'd' THEN 'deleted' ELSE status END AS status, total_amount_usd, cdc_lsn, changed_at AS effective_from, true AS is_current, 1 AS record_version FROM ({CHANGES_DUCK}) c WHERE v = 0")
def build_orders(lake: Lake) -> DataFrame:
    """First versions: change rows as current history rows."""
    empty = lake.spark.createDataFrame([], "order_id STRING, user_id STRING, status STRING, total_amount_usd DOUBLE, cdc_lsn BIGINT, effective_from TIMESTAMP_NTZ, effective_to TIMESTAMP_NTZ, is_current BOOLEAN, record_version INT, prev_status STRING")
    body = ["order_id", "user_id", "status", "total_amount_usd", "cdc_op", "cdc_lsn", "changed_at"]
    return merge.scd2(empty, lake.sql(CHANGES).where("v = 0").select(*body)).select("order_id", "status", "total_amount_usd", "cdc_lsn", "effective_from", "is_current", "record_version")


@query("feat_features", "SELECT event_id, user_id, event_type, geo_country, device_type, product_price_usd, product_quantity, fraud_score, CAST(hour(event_ts) AS INT) AS event_hour, ab_cohort FROM bronze")
def feat_features(lake: Lake) -> DataFrame:
    """The request features of a scoring call, one struct per event, opened again; the hour is the event's, not the clock's."""
    named = F.struct("user_id", "event_type", "geo_country", "device_type", "product_price_usd", "product_quantity", "fraud_score", F.hour("event_ts").alias("event_hour"), "ab_cohort")
    return lake.view("bronze").select("event_id", named.alias("request")).select("event_id", "request.*")


@query("global_counts", "SELECT (SELECT count(*) FROM bronze_dup) AS read, (SELECT count(*) FROM silver) AS kept")
def global_counts(lake: Lake) -> DataFrame:
    """Counts of a chain's steps from one run of it: observed while the rows pass, not by extra jobs."""
    from pyspark.sql import Observation

    first, last = Observation(f"read{uuid.uuid4().hex}"), Observation(f"kept{uuid.uuid4().hex}")
    rows = lake.view("bronze_dup").observe(first, F.count(F.lit(1)).alias("n"))
    silver.refine(rows, domain.SALT).observe(last, F.count(F.lit(1)).alias("n")).write.format("noop").mode("overwrite").save()
    return lake.spark.range(1).select(F.lit(first.get["n"]).alias("read"), F.lit(last.get["n"]).alias("kept"))


query("bookmark", "SELECT 2 AS snapshot_id, 0 AS fresh")(lambda lake: _marked(lake))


def _marked(lake: Lake) -> DataFrame:
    """A job's second run finds nothing new: same schema, no rows."""
    table, _ = _two(lake)
    mark = Bookmark(lake.spark, f"{table.path}-bookmark")
    table.read_between(mark.get()).write.format("noop").mode("overwrite").save()
    mark.put(table.current_id())
    return table.read_between(mark.get()).agg(F.count(F.lit(1)).cast("int").alias("fresh")).withColumn("snapshot_id", F.lit(mark.get()))


@query("compaction", "SELECT count(*) AS n, 1 AS n_files FROM bronze")
def compaction(lake: Lake) -> DataFrame:
    table, _ = _two(lake)
    table.compact()
    return table.read().agg(F.count(F.lit(1)).alias("n")).withColumn("n_files", F.lit(len(table.head()["files"])))


@query("snk_dbt_table", "SELECT sku, price_band FROM dim_products")
def snk_dbt_table(lake: Lake) -> DataFrame:
    table = SnapshotTable(lake.spark, _folder(lake))
    for _ in range(2):  # a full refresh replaces all rows
        table.overwrite(lake.sql("SELECT sku, price_band FROM dim_products"))
    return table.read()


@query("snk_dbt_inc", "SELECT metric_date, CASE WHEN metric_date >= DATE '2024-01-29' THEN total_orders ELSE -1 END AS total_orders FROM order_days")
def snk_dbt_inc(lake: Lake) -> DataFrame:
    """Incremental model: whole dates of the lookback are computed anew and merged by key."""
    table = SnapshotTable(lake.spark, _folder(lake))
    days = lake.sql("SELECT metric_date, total_orders FROM order_days")
    table.append(days.withColumn("total_orders", F.lit(-1).cast("long")))
    table.merge(days.where("metric_date >= DATE'2024-01-29'"), ["metric_date"])
    return table.read()


query("src_view", "SELECT order_id, status, total_amount_usd FROM stg_orders")(lambda lake: lake.view("stg_orders").select("order_id", "status", "total_amount_usd"))


@query("src_feature", "SELECT user_id_hashed, order_count_90d FROM features WHERE user_id_hashed = (SELECT min(user_id_hashed) FROM features)")
def src_feature(lake: Lake) -> DataFrame:
    table = SnapshotTable(lake.spark, _folder(lake))
    rows = lake.view("features")
    table.overwrite(rows.withColumn("feature_timestamp", F.lit(domain.AS_OF).cast("timestamp")))
    return connectors.feature_get(table, rows.agg(F.min("user_id_hashed")).first()[0]).select("user_id_hashed", "order_count_90d")


@query("src_csv", "SELECT churned_30d AS label, CAST(least(days_since_last_order, 999) AS DOUBLE) AS days_since_last_order, CAST(order_count_90d AS DOUBLE) AS order_count_90d, round(total_ltv_usd, 2) AS total_ltv_usd, round(least(discount_usage_rate, 1.0), 6) AS discount_usage_rate FROM features")
def src_csv(lake: Lake) -> DataFrame:
    path = _folder(lake)
    silver.preprocess(lake.view("features")).select(*C.MODEL_FEATURES, "churned_30d").write.csv(path)
    return connectors.model_csv(lake.spark, path).select("label", "days_since_last_order", "order_count_90d", F.round("total_ltv_usd", 2).alias("total_ltv_usd"), F.round("discount_usage_rate", 6).alias("discount_usage_rate"))


@query("snk_s3", "SELECT event_id, CAST(event_ts AS DATE) AS event_date, CAST(hour(event_ts) AS INT) AS event_hour FROM bronze")
def snk_s3(lake: Lake) -> DataFrame:
    """Files by hour from three micro-batches; the hours of the first half of the month are packed, and every row is read once."""
    path, events = _event_stream(lake, "bronze", "event_id, event_ts")
    rotation.rotated(events, f"{path}/out", f"{path}/ck", f"hours{uuid.uuid4().hex}", span_s=3600).awaitTermination()
    rotation.pack(lake.spark, f"{path}/out", datetime(2024, 1, 16))
    return rotation.read(lake.spark, f"{path}/out").select("event_id", "event_date", "event_hour")


HOPS = f"SELECT b.user_id, b.event_ts AS signal_ts, b.event_id AS signal_id FROM bronze b JOIN ({FRAUD_SQL}) x ON b.event_id = x.event_id WHERE x.fraud_score >= 0.7"


@query("join_stream_stream", f"SELECT s.signal_id, e.event_id FROM ({HOPS}) s JOIN bronze e ON s.user_id = e.user_id AND e.event_ts <= s.signal_ts AND e.event_ts >= s.signal_ts - INTERVAL 15 MINUTE")
def join_stream_stream(lake: Lake) -> DataFrame:
    path, events = _event_stream(lake, "bronze", "user_id, event_id, event_ts")
    hot = fraud.alerts(fraud.score(lake.view("bronze"))).select("user_id", F.col("event_ts").cast("timestamp").alias("signal_ts"), F.col("event_id").alias("signal"))
    hot.write.parquet(f"{path}/signals")
    signals = lake.spark.readStream.schema(hot.schema).parquet(f"{path}/signals")
    made = jobs.signals_with_events(signals, events).writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/ck")
    made.trigger(availableNow=True).start().awaitTermination()
    return lake.spark.read.parquet(f"{path}/out").select(F.col("signal").alias("signal_id"), "event_id")


@query(
    "lookup_remote",
    """SELECT event_id, s AS churn_score, CASE WHEN s < 0.2 THEN 'stable' WHEN s < 0.5 THEN 'monitor' WHEN s < 0.75 THEN 'at_risk' WHEN s < 1.01 THEN 'high_churn' END AS churn_segment
    FROM (SELECT event_id, CASE WHEN CAST(substr(user_id, 2) AS BIGINT) % 7 <> 0 THEN CAST(CAST(substr(user_id, 2) AS BIGINT) % 100 AS DOUBLE) / 100 END AS s FROM bronze) b""",
)
def lookup_remote(lake: Lake) -> DataFrame:
    """A lookup for each event, from a stand-in endpoint that fails for some users: those events pass with no score."""
    return jobs.lookup_scores(lake.view("bronze").select("event_id", "user_id", "event_type", "device_type"), _endpoint).select("event_id", "churn_score", "churn_segment")


def _endpoint(features: dict) -> float:
    number = int(features["user_id"][1:])
    if number % 7 == 0:
        raise ConnectionError("no answer")
    return number % 100 / 100
