"""Session settings and the folder that executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build(app: str = "lakeloom", master: str | None = None) -> SparkSession:
    """UTC, ANSI, adaptive plans with skew handling; state in RocksDB. Shuffle partitions are left to the cluster's setting."""
    b = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").config("spark.sql.adaptive.skewJoin.enabled", "true")
    b = b.config("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    return (b.master(master) if master else b).getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    made = tempfile.mkdtemp(prefix="lakeloom-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def stored(rows: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read back: their lineage is cut, and every reader sees the same."""
    path = f"{shared_dir(rows.sparkSession)}/{name}-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
