"""Readers and writers at the edges: feeds, change streams, files, the message bus, the feature store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeloom.functions import constants as C
from lakeloom.functions.core import content_hash
from lakeloom.sources.tables import SnapshotTable

# Device names of the second feed.
GOOGLE_DEVICES = {"MOBILE": "mobile", "DESKTOP": "desktop", "TABLET": "tablet"}


def ads_facebook(raw: DataFrame) -> DataFrame:
    """raw: the feed's rows (schema feeds.FB). Conversions are the sum of purchase actions."""
    bought = F.aggregate(F.filter(F.coalesce("actions", F.array().cast("array<struct<action_type: string, value: double>>")), lambda a: a["action_type"] == "purchase"), F.lit(0.0), lambda s, a: s + F.coalesce(a["value"], F.lit(0.0)))
    return raw.select(
        F.lit("facebook").alias("source"), "ad_id", "campaign_name", F.col("adset_name").alias("ad_set_name"), "impressions", "clicks", F.col("spend").alias("spend_usd"),
        bought.alias("conversions"), F.col("date_start").alias("report_date"), "country", F.lower("device").alias("device_type"),
    )


def ads_google(raw: DataFrame) -> DataFrame:
    device = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for p in GOOGLE_DEVICES.items() for x in p]), F.col("device")), F.lit("unknown"))
    return raw.select(
        F.lit("google").alias("source"), "ad_id", F.col("campaign").alias("campaign_name"), F.col("ad_group").alias("ad_set_name"), "impressions", "clicks",
        (F.col("cost_micros") / 1e6).alias("spend_usd"), "conversions", F.col("date").alias("report_date"), "country", device.alias("device_type"),
    )


def ads(facebook: DataFrame, google: DataFrame) -> DataFrame:
    return ads_facebook(facebook).unionByName(ads_google(google))


def changed_products(pages: DataFrame, known: DataFrame) -> DataFrame:
    """Feed rows whose content hash is new for their sku. known: (sku, content_hash) already taken."""
    hashed = pages.withColumn("content_hash", content_hash(F.col("sku"), F.col("price_usd"), F.col("name"), F.col("stock"), F.col("is_active")))
    k = known.select(F.col("sku").alias("_s"), F.col("content_hash").alias("_h"))
    return hashed.join(k, F.col("sku").eqNullSafe(F.col("_s")) & F.col("content_hash").eqNullSafe(F.col("_h")), "left_anti")


def kafka_source(spark: SparkSession, servers: str, topic: str, group: str, max_offsets: int | None = None) -> DataFrame:
    """Value-only stream from the latest offsets, committed records only. Needs Spark's Kafka package on the class path."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).option("startingOffsets", "latest")
    reader = reader.option("kafka.group.id", group).option("kafka.isolation.level", "read_committed")
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load().select(F.col("value").cast("string").alias("value"), "timestamp")


def kafka_sink(df: DataFrame, servers: str, topic: str, checkpoint: str, acks: str = "all"):
    out = df.select(F.to_json(F.struct("*")).alias("value")).writeStream.format("kafka")
    return out.option("kafka.bootstrap.servers", servers).option("topic", topic).option("kafka.acks", acks).option("kafka.compression.type", "lz4").option("checkpointLocation", checkpoint)


def file_source(spark: SparkSession, path: str, max_files: int = 1) -> DataFrame:
    """Lines of JSON text as a stream: the bus's stand-in for replays and tests."""
    return spark.readStream.format("text").option("maxFilesPerTrigger", max_files).load(path)


def model_csv(spark: SparkSession, path: str) -> DataFrame:
    """Header-less model rows: the features in their order, then the label; a row with other than that many columns fails."""
    schema = ", ".join(f"{c} DOUBLE" for c in C.MODEL_FEATURES) + ", label INT"
    return spark.read.csv(path, schema=schema, mode="FAILFAST", enforceSchema=True)


def feature_put(table: SnapshotTable, features: DataFrame, key: str = "user_id_hashed", at: str = "feature_timestamp", within_s: int = 5) -> int:
    """Latest row per user; a row whose content equals the stored one and is at most `within_s` newer is left out."""
    body = [c for c in features.columns if c not in (key, at)]
    print_of = lambda p: F.sha2(F.concat_ws("|", *[F.coalesce(F.col(f"{p}.{c}").cast("string"), F.lit("")) for c in body]), 256)
    w = Window.partitionBy(key).orderBy(F.desc(at))
    new = features.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
    same = (print_of("new") == print_of("cur")) & (F.unix_seconds(F.col(f"new.{at}").cast("timestamp")) - F.unix_seconds(F.col(f"cur.{at}").cast("timestamp")) <= within_s)
    return table.merge(new, [key], (F.col(f"new.{at}") > F.col(f"cur.{at}")) & ~F.coalesce(same, F.lit(False)))


def feature_get(table: SnapshotTable, user: str, key: str = "user_id_hashed") -> DataFrame:
    return table.read().where(F.col(key) == user)
