"""Sinks that survive restarts, and what a query's batches report: watermarks and rows that came too late."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

Write = Callable[[DataFrame, int], None]


def started(stream: DataFrame, write: Write, checkpoint: str, query: str, once: bool = True, every: str = "60 seconds") -> StreamingQuery:
    made = stream.writeStream.foreachBatch(write).queryName(query).option("checkpointLocation", checkpoint)
    return (made.trigger(availableNow=True) if once else made.trigger(processingTime=every)).start()


def exactly_once(stream: DataFrame, path: str, checkpoint: str, query: str, once: bool = True, done: Callable[[int], None] | None = None) -> StreamingQuery:
    """Each micro-batch is a folder of its own, batch=<number>, which is written anew as a whole.

    A batch has the same rows when it is run again after a stop between its writing and its commit, so it replaces what it wrote before.
    A new checkpoint begins with batch 0 and needs a new path. done(number) is called after a batch is written.
    """

    def write(batch: DataFrame, number: int) -> None:
        marked = batch.write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", True)  # whatever the cluster's setting
        marked.parquet(f"{path}/batch={number}")
        if done:
            done(number)

    return started(stream, write, checkpoint, query, once)


def read_batches(spark: SparkSession, path: str, schema: object, checkpoint: str | None = None) -> DataFrame:
    """What exactly_once has written. A batch that is missing where the stream has gone on without it is an error, not fewer rows.

    With the stream's checkpoint: every row of a stream that has come to its end. It is an error if the stream has committed nothing, has begun a
    batch that isn't committed, or has committed one that isn't written to its end. Without it: what there is so far, maybe nothing; only the last
    batch may be unfinished, and is left out then.
    """
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    fs = fs_path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    folders = _numbers(spark, path, "batch=")
    whole = {n for n in folders if fs.exists(fs_path(f"{path}/batch={n}/_SUCCESS"))}
    if checkpoint is None:
        want = set(range(max(folders, default=0))) | whole
    else:
        begun, committed = _numbers(spark, f"{checkpoint}/offsets"), _numbers(spark, f"{checkpoint}/commits")
        if not committed:
            raise FileNotFoundError(f"{checkpoint}: no batch has been committed")
        if max(begun, default=0) > max(committed):
            raise RuntimeError(f"{checkpoint}: batch {max(begun)} has begun and isn't committed")
        want = set(range(max(committed) + 1))
    if want - whole:
        raise FileNotFoundError(f"{path}: batches {sorted(want - whole)} are missing or not written to their ends")
    return spark.read.schema(schema).parquet(*[f"{path}/batch={n}" for n in sorted(want)]) if want else spark.createDataFrame([], schema)


def _numbers(spark: SparkSession, folder: str, prefix: str = "") -> set[int]:
    """The numbers of a folder's entries that are called <prefix><number>; none if there is no such folder."""
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in fs.listStatus(where)] if fs.exists(where) else []
    return {int(n[len(prefix) :]) for n in names if n.startswith(prefix) and n[len(prefix) :].isdigit()}


def at_least_once(stream: DataFrame, path: str, checkpoint: str, query: str, once: bool = True, done: Callable[[int], None] | None = None) -> StreamingQuery:
    """Batches are appended to one folder: cheaper to read, but a batch that is run again is there twice. Read it by read_distinct."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("append").parquet(path)
        if done:
            done(number)

    return started(stream, write, checkpoint, query, once)


def read_distinct(spark: SparkSession, path: str, key: Sequence[str]) -> DataFrame:
    return spark.read.parquet(path).dropDuplicates(list(key))


# ---- watermarks


def merged(inputs: Sequence[DataFrame], at: str = "event_ts", delay: str = "4 hours") -> DataFrame:
    """Several inputs with the same columns as one stream, each with a watermark of its own; a policy makes one of them."""
    return reduce(DataFrame.unionByName, [i.withWatermark(at, delay) for i in inputs])


@contextmanager
def watermark_policy(spark: SparkSession, wait_for_all: bool) -> Iterator[None]:
    """For queries that are started for the first time inside: which of several inputs the watermark follows (their checkpoints keep it).

    The one that is furthest on, so that an input which has gone quiet doesn't hold sessions open for ever; its rows are late once they are
    the delay behind. Or, waiting for all, the one that is furthest back; then nothing of it is lost.
    """
    key = "spark.sql.streaming.multipleWatermarkPolicy"
    before = spark.conf.get(key)
    spark.conf.set(key, "min" if wait_for_all else "max")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def late_rows(query: StreamingQuery) -> list[tuple[int, str | None, int]]:
    """(batch, its watermark, rows dropped as late) of the query's last batches."""
    return [(p["batchId"], (p["eventTime"] or {}).get("watermark"), sum(s["numRowsDroppedByWatermark"] for s in p["stateOperators"])) for p in query.recentProgress]


class LateRows(StreamingQueryListener):
    """Reports every batch of the queries it is told the names of: name, batch, watermark, rows read, rows dropped as late."""

    def __init__(self, names: Sequence[str], report: Callable[[str, int, str | None, int, int], None]) -> None:
        self.names, self.report = set(names), report

    def onQueryStarted(self, event: object) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event: object) -> None:  # noqa: N802
        p = event.progress
        if p.name in self.names:
            self.report(p.name, p.batchId, (p.eventTime or {}).get("watermark"), p.numInputRows, sum(s.numRowsDroppedByWatermark for s in p.stateOperators))

    def onQueryIdle(self, event: object) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event: object) -> None:  # noqa: N802
        pass
