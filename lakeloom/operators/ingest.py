"""Bronze ingest: parse, validate, flatten, and split raw event JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.functions import constants as C
from lakeloom.functions.core import parse_event_time

WIRE = """
event_id STRING, user_id STRING, session_id STRING, event_type STRING, timestamp STRING, search_query STRING, order_id STRING, fraud_score DOUBLE,
device STRUCT<type: STRING, os: STRING, app_version: STRING>, page STRUCT<url: STRING, referrer: STRING, load_ms: INT>,
product STRUCT<sku: STRING, category: STRING, price_usd: DOUBLE, quantity: INT>, geo STRUCT<country: STRING, city: STRING, timezone: STRING, lat: DOUBLE, lon: DOUBLE>,
flags STRUCT<is_bot: BOOLEAN, is_internal: BOOLEAN, ab_cohort: STRING>, _corrupt STRING
"""

CDC = """
before STRUCT<order_id: STRING, user_id: STRING, status: STRING, total_amount: DOUBLE, discount: DOUBLE, item_count: INT, country: STRING, payment_method: STRING>,
after STRUCT<order_id: STRING, user_id: STRING, status: STRING, total_amount: DOUBLE, discount: DOUBLE, item_count: INT, country: STRING, payment_method: STRING>,
source STRUCT<lsn: BIGINT, `table`: STRING>, op STRING, ts_ms BIGINT
"""


def parse_json(raw: DataFrame, column: str = "value") -> DataFrame:
    """raw_payload and the parsed event; an event that is no JSON object has `malformed` set.

    The event comes out of an array of one, so filters and columns behind it read what was parsed once: through a plain column
    the optimizer would carry the parser, and whatever makes the line, into each of their conditions.
    """
    e = F.from_json(column, WIRE, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    made = raw.withColumn("raw_payload", F.col(column))
    braced = F.coalesce(F.ltrim("raw_payload").startswith("{"), F.lit(False))
    made = made.select("*", F.inline(F.array(F.struct(e.alias("e"), braced.alias("_braced")))))
    return made.withColumn("malformed", F.col("e").isNull() | F.col("e._corrupt").isNotNull() | ~F.col("_braced")).drop("_braced")


def validation(event_id: Column, user_id: Column, timestamp: Column, event_type: Column, price: Column, country: Column) -> Column:
    """First failing rule as struct<flag, message>; null flag for a clean event."""
    empty = lambda c: c.isNull() | (c.cast("string") == "")
    bad = lambda flag, text: F.struct(F.lit(flag).alias("flag"), F.lit(text).alias("message"))
    return (
        F.when(empty(event_id), bad("CRITICAL", "event_id missing")).when(empty(user_id), bad("CRITICAL", "user_id missing")).when(empty(timestamp), bad("CRITICAL", "timestamp missing"))
        .when(event_type.isNull() | ~event_type.isin(*C.EVENT_TYPES), bad("CRITICAL", "event_type unknown"))
        .when(price.isNotNull() & ~price.between(C.PRICE_MIN, C.PRICE_MAX), bad("WARNING", "price out of range"))
        .when(empty(country), bad("WARNING", "country missing")).otherwise(F.struct(F.lit(None).cast("string").alias("flag"), F.lit(None).cast("string").alias("message")))
    )


def flatten(parsed: DataFrame, ingested_at: Column) -> DataFrame:
    """Flat bronze rows; an event time that doesn't parse falls back to the ingestion time and is a warning."""
    e = F.col("e")
    dq = validation(e["event_id"], e["user_id"], e["timestamp"], e["event_type"], e["product"]["price_usd"], e["geo"]["country"])
    ts = F.try_to_timestamp(e["timestamp"])
    made = parsed.withColumns({"_dq": dq, "_ts": ts, "ingested_at": ingested_at})
    return made.select(
        e["event_id"].alias("event_id"), e["user_id"].alias("user_id"), e["session_id"].alias("session_id"), e["event_type"].alias("event_type"),
        parse_event_time(e["timestamp"], F.col("ingested_at")).alias("event_ts"), "ingested_at",
        e["device"]["type"].alias("device_type"), e["device"]["os"].alias("device_os"), e["device"]["app_version"].alias("app_version"),
        e["page"]["url"].alias("page_url"), e["page"]["referrer"].alias("page_referrer"), e["page"]["load_ms"].alias("page_load_ms"),
        e["product"]["sku"].alias("product_sku"), e["product"]["category"].alias("product_category"), e["product"]["price_usd"].alias("product_price_usd"), e["product"]["quantity"].alias("product_quantity"),
        e["geo"]["country"].alias("geo_country"), e["geo"]["city"].alias("geo_city"), e["geo"]["timezone"].alias("geo_timezone"), e["geo"]["lat"].alias("geo_lat"), e["geo"]["lon"].alias("geo_lon"),
        e["flags"]["ab_cohort"].alias("ab_cohort"), e["search_query"].alias("search_query"), e["order_id"].alias("order_id"), e["fraud_score"].alias("fraud_score"),
        F.coalesce(e["flags"]["is_bot"], F.lit(False)).alias("is_bot"), F.coalesce(e["flags"]["is_internal"], F.lit(False)).alias("is_internal"),
        F.coalesce(F.col("_dq.flag"), F.when(F.col("_ts").isNull(), "WARNING")).alias("dq_flag"), F.coalesce(F.col("_dq.message"), F.when(F.col("_ts").isNull(), "timestamp unparseable")).alias("dq_message"),
        "raw_payload",
    ).withColumns({"event_date": F.to_date("event_ts"), "event_hour": F.hour("event_ts")})


def split(raw: DataFrame, ingested_at: Column, column: str = "value") -> tuple[DataFrame, DataFrame]:
    """(bronze rows, dead letters): malformed and critical events go to the dead letters with a reason."""
    parsed = parse_json(raw, column)
    flat = flatten(parsed.where(~F.col("malformed")), ingested_at)
    lost = parsed.where("malformed").select("raw_payload", F.lit("malformed JSON").alias("reason"))
    critical = F.coalesce(F.col("dq_flag") == "CRITICAL", F.lit(False))
    dead = lost.unionByName(flat.where(critical).select("raw_payload", F.col("dq_message").alias("reason")))
    return flat.where(~critical), dead


def unwrap_cdc(raw: DataFrame, table: str, column: str = "value", key: str | None = None, topic: str | None = None) -> DataFrame:
    """Flat change rows of one table: the after image, or, rewritten with `deleted`, the before image of a delete.

    With the names of the columns that hold a message's key and topic, tombstones are kept: messages without a value, on the topic whose name ends
    with the table's, become rows of the key with cdc_op `t` and nothing else. Without them they can't be told apart and go.
    """
    c = F.from_json(column, CDC)
    made = raw.where(F.col(column).isNotNull()).select(c.alias("c")).where((F.col("c.source.table") == table) & F.col("c.op").isNotNull())
    image = F.when(F.col("c.op") == "d", F.col("c.before")).otherwise(F.col("c.after"))
    flat = made.select(image.alias("i"), "c.op", "c.ts_ms", F.col("c.source.lsn").alias("lsn"))
    flat = flat.select("i.*", F.col("op").alias("cdc_op"), F.col("lsn").alias("cdc_lsn"), F.timestamp_millis("ts_ms").alias("changed_at"), (F.col("op") == "d").alias("deleted"))
    if key is None or topic is None:
        return flat
    ended = raw.where(F.col(column).isNull() & F.substring_index(topic, ".", -1).eqNullSafe(F.lit(table)))
    return flat.unionByName(ended.select(F.col(key).alias("order_id"), F.lit("t").alias("cdc_op"), F.lit(True).alias("deleted")), allowMissingColumns=True)
