"""Structured Streaming jobs: bronze ingest with dead letters, session windows, fraud alerts, score lookup."""

from __future__ import annotations

import time
from collections import OrderedDict
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.functions import constants as C
from lakeloom.functions.core import churn_segment
from lakeloom.operators import ingest, sessions
from lakeloom.sources.tables import SnapshotTable
from lakeloom.streaming.stateful import WATERMARK



def bronze(stream: DataFrame, table: SnapshotTable, dead: SnapshotTable, checkpoint: str, query: str = "bronze", ingested_at: Column | None = None, once: bool = True):
    """Both sinks are written per batch and remember (query, batch), so a replayed batch adds nothing. Late rows are kept."""

    def write(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        good, bad = ingest.split(batch, F.current_timestamp() if ingested_at is None else ingested_at)
        table.append(good, (query, number), ["event_date", "event_hour"])
        dead.append(bad, (query, number))
        batch.unpersist()

    return _run(stream.writeStream.foreachBatch(write).queryName(query), checkpoint, once)


def _run(writer, checkpoint: str, once: bool):
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="60 seconds")).start()


def session_summaries(events: DataFrame, gap: str = "15 minutes", user: str = "user_id_hashed") -> DataFrame:
    """One row per closed session, once the watermark has passed its end. events: event_ts TIMESTAMP and the event columns."""
    marked = events.withWatermark("event_ts", WATERMARK)
    return marked.groupBy(user, F.session_window("event_ts", gap)).agg(*sessions._metrics("seq")).drop("session_window")


def fraud_alerts(scored: DataFrame, table: SnapshotTable, alerts: SnapshotTable, checkpoint: str, query: str = "fraud", once: bool = True):
    def write(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        table.append(batch, (query, number))
        alerts.append(batch.where(F.col("fraud_score") >= C.FRAUD_ALERT), (query, number))
        batch.unpersist()

    return _run(scored.writeStream.foreachBatch(write).outputMode("append").queryName(query), checkpoint, once)


def enrich_scores(events: DataFrame, scores: DataFrame, user: str = "user_id") -> DataFrame:
    """Stream-static join to a scored table (user, churn_score): unknown users have a null score; summaries are passed by."""
    joined = events.join(scores.select(F.col(user).alias("_u"), "churn_score"), F.col(user) == F.col("_u"), "left").drop("_u")
    return joined.withColumn("churn_segment", churn_segment(F.col("churn_score")))


def lookup_scores(events: DataFrame, endpoint: Callable[[dict], float], user: str = "user_id", capacity: int = 50_000, ttl_s: float = 300) -> DataFrame:
    """A score from a remote endpoint for each event, batch or stream: churn_score and churn_segment.

    endpoint(features of an event) is asked once for a user while a task remembers the answer: the `capacity` users last
    seen, for `ttl_s` seconds. It fails open: without an answer, or without a user, both columns are null, and it is asked
    again at the user's next batch.
    """
    names = events.columns
    segment = F.when(F.col("churn_score").isNotNull(), churn_segment(F.col("churn_score")))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory: OrderedDict[str, tuple[float, float]] = OrderedDict()

        def score(who: str, first: dict) -> float | None:
            known = memory.get(who)
            if known and time.monotonic() <= known[1]:
                memory.move_to_end(who)
                return known[0]
            try:
                value = float(endpoint(first))
            except Exception:  # noqa: BLE001  whatever went wrong, the event goes on
                return None
            memory[who] = (value, time.monotonic() + ttl_s)
            memory.move_to_end(who)
            if len(memory) > capacity:
                memory.popitem(last=False)
            return value

        for b in batches:
            users = b.column(names.index(user)).dictionary_encode()
            places = users.indices.to_pylist()
            first = {p: i for i, p in reversed(list(enumerate(places))) if p is not None}
            found = [score(who, b.slice(first[p], 1).to_pylist()[0]) if who else None for p, who in enumerate(users.dictionary.to_pylist())]
            scores = pa.array([None if p is None else found[p] for p in places], pa.float64())
            yield pa.RecordBatch.from_arrays([*b.columns, scores], [*names, "churn_score"])

    schema = T.StructType([*events.schema.fields, T.StructField("churn_score", T.DoubleType())])
    return events.mapInArrow(look_up, schema).withColumn("churn_segment", segment)


def signals_with_events(signals: DataFrame, events: DataFrame, user: str = "user_id", within: str = "15 minutes") -> DataFrame:
    """Stream-stream join of fraud signals with the user's events of the time before them; both sides are bounded by watermarks."""
    s = signals.withWatermark("signal_ts", WATERMARK).alias("s")
    e = events.withWatermark("event_ts", WATERMARK).alias("e")
    near = F.expr(f"s.{user} = e.{user} AND e.event_ts <= s.signal_ts AND e.event_ts >= s.signal_ts - INTERVAL {within}")
    return s.join(e, near).select(f"s.{user}", "s.signal_ts", "s.signal", "e.event_id", "e.event_ts")
