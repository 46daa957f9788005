"""A file sink by hour: files are closed by rows or by event time, and the small files of hours that are over are packed.

open/batch=<n>/ holds what micro-batch n wrote, replaced as a whole when the batch is run again. packed/pack=<m>/ holds hours packed by the
m-th packing, and packs/pack=<m>/ says, written last, which hours these are and up to which batch they go. A reader takes each hour from its
last pack and the batches after it, so a packing that stops half-way changes nothing, and a row that comes for a packed hour isn't lost.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lakeloom.streaming import sinks

#: Rows and seconds of event time after which a file is closed; bytes that a packed file should have.
ROWS, SPAN_S, TARGET = 100_000, 60, 128 << 20
_HOUR = ["event_date", "event_hour"]
_OWN = ("batch", "event_slot", "_path", "_bytes")


def rotated(stream: DataFrame, path: str, checkpoint: str, query: str, at: str = "event_ts", rows: int = ROWS, span_s: int = SPAN_S, once: bool = True) -> StreamingQuery:
    """Files under open/batch=/event_date=/event_hour=/event_slot=: no more than `rows` rows and `span_s` seconds of event time each."""

    def write(batch: DataFrame, number: int) -> None:
        slot = F.floor(F.unix_seconds(F.col(at).cast("timestamp")) / span_s)
        made = batch.withColumns({"event_date": F.to_date(at), "event_hour": F.hour(at), "event_slot": slot})
        dealt = made.hint("rebalance", *_HOUR, "event_slot")  # a slot is a task's, or several tasks' if it is large
        dealt.write.mode("overwrite").partitionBy(*_HOUR, "event_slot").option("maxRecordsPerFile", rows).parquet(f"{path}/open/batch={number}")

    return sinks.started(stream, write, checkpoint, query, once)


def _read(spark: SparkSession, folder: str, part: str) -> DataFrame | None:
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    if not fs_path(folder).getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(fs_path(f"{folder}/{part}=*/_SUCCESS")):
        return None
    return spark.read.option("mergeSchema", False).parquet(folder)


def _packs(spark: SparkSession, path: str) -> DataFrame | None:
    """Each packed hour's last pack, and the last batch in it: no more rows than there are hours."""
    packs = _read(spark, f"{path}/packs", "pack")
    return None if packs is None else packs.groupBy(*_HOUR).agg(F.max("pack").alias("last"), F.max_by("upto", "pack").alias("upto"))


def _newer(spark: SparkSession, path: str) -> DataFrame | None:
    """Rows of batches that no pack has yet, with their files and these files' sizes."""
    opened, packs = _read(spark, f"{path}/open", "batch"), _packs(spark, path)
    if opened is None:
        return None
    opened = opened.select("*", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_size").alias("_bytes"))
    if packs is None:
        return opened
    return opened.join(F.broadcast(packs), _HOUR, "left").where("upto IS NULL OR batch > upto").drop("last", "upto")


def _in_packs(spark: SparkSession, path: str) -> DataFrame | None:
    rows, packs = _read(spark, f"{path}/packed", "pack"), _packs(spark, path)
    return None if rows is None or packs is None else rows.join(F.broadcast(packs), _HOUR).where("pack = last").drop("last", "upto", "pack")


def read(spark: SparkSession, path: str) -> DataFrame:
    """Every row once, with event_date and event_hour, by which readers prune."""
    opened, packed = _newer(spark, path), _in_packs(spark, path)
    opened = None if opened is None else opened.drop(*_OWN)
    if opened is None:
        raise FileNotFoundError(f"{path}: no batch has been written")
    return opened if packed is None else opened.unionByName(packed)


def pack(spark: SparkSession, path: str, before: datetime, target: int = TARGET) -> int:
    """Pack the hours that end at or before `before` and have files outside packs, to files of about `target` bytes; how many hours these were.

    Other hours' files stay as they are. An hour that was packed before is packed anew only if rows came for it since.
    """
    rows, old = _newer(spark, path), _in_packs(spark, path)
    if rows is None:
        return 0
    ends: Column = F.expr("make_timestamp_ntz(year(event_date), month(event_date), day(event_date), event_hour, 0, 0) + INTERVAL 1 HOUR")
    over = rows.where(ends <= F.lit(before).cast("timestamp_ntz"))
    files = over.groupBy(*_HOUR, "_path").agg(F.max("_bytes").alias("bytes"), F.max("batch").alias("batch"), F.count(F.lit(1)).alias("rows"))
    hours = files.groupBy(*_HOUR).agg(F.sum("bytes").alias("bytes"), F.max("batch").alias("upto"), F.sum("rows").alias("rows"))
    hours = hours.withColumn("files", F.greatest(F.ceil(F.col("bytes") / target), F.lit(1)).cast("int")).persist()  # a row for each hour
    try:
        count, size, n = hours.agg(F.count(F.lit(1)), F.sum("bytes"), F.sum("rows")).first()
        if not count:
            return 0
        last = _packs(spark, path)
        number = 0 if last is None else last.agg(F.max("last")).first()[0] + 1
        whole = over.drop(*_OWN)
        if old is not None:
            whole = whole.unionByName(old)
        whole = whole.join(F.broadcast(hours.select(*_HOUR, "files")), _HOUR)
        body = [c for c in whole.columns if c not in (*_HOUR, "files")]
        dealt = whole.withColumn("_file", F.pmod(F.xxhash64(*body), "files")).repartition(*_HOUR, "_file").drop("_file", "files")
        # a task that gets several of an hour's files closes them by their rows
        dealt.write.mode("overwrite").partitionBy(*_HOUR).option("maxRecordsPerFile", 1 + int(1.05 * n * target / size)).parquet(f"{path}/packed/pack={number}")
        hours.select(*_HOUR, "upto").coalesce(1).write.mode("overwrite").parquet(f"{path}/packs/pack={number}")  # a row for each hour: from here on it counts
        return count
    finally:
        hours.unpersist()
