"""Feature records into an online store: repeats skipped by keyed state in the stream, bulk writes under an error budget."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from lakeloom.streaming.stateful import WATERMARK, _timer, by_bucket, with_rocksdb

#: A record with the content of the last one is written again after this long.
WITHIN_S = 5.0
#: Failed records for each written one that a write may have.
BUDGET = 0.05
#: One record as a store takes it: names with values as text.
Record = list[dict[str, str]]
Put = Callable[[Record], None]


def fingerprint(columns: Sequence[str]) -> F.Column:
    """A digest of the values as they would be written; null and '' are told apart."""
    return F.sha2(F.concat_ws("\x1f", *[F.coalesce(F.concat(F.lit("="), F.col(f"`{c}`").cast("string")), F.lit("-")) for c in columns]), 256)


class RepeatFilter(StatefulProcessor):
    """Lets a user's record through unless it repeats the last one that was let through, less than `within_us` before.

    State of a user: that record's digest and time. A timer forgets it once the watermark has passed its time limit.
    """

    def __init__(self, names: list[str], within_us: int) -> None:
        self.names, self.within_us = names, within_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "digest STRING, at LONG")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:  # noqa: N802, N803
        known = self.last.get()
        before = last = tuple(known) if known else None
        out = Row(*self.names)
        for r in sorted(rows, key=lambda r: (r._us, r._digest)):
            if last and r._digest == last[0] and r._us - last[1] < self.within_us:
                continue
            last = (r._digest, r._us)
            yield out(*[getattr(r, c) for c in self.names])
        if last != before:
            self.last.update(last)
            old, new = _timer(before[1] + self.within_us) if before else None, _timer(last[1] + self.within_us)
            if old != new:
                if old is not None:
                    self.handle.deleteTimer(old)
                self.handle.registerTimer(new)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:  # noqa: N802, N803
        self.last.clear()
        return iter([])

    def close(self) -> None:
        pass


def without_repeats(records: DataFrame, key: str = "user_id_hashed", at: str = "feature_timestamp", within_s: float = WITHIN_S) -> DataFrame:
    """A stream of feature records (columns: key, at TIMESTAMP, features) without those that repeat the user's last one within the time.

    Records of a user are taken in order of time within a batch. Writes that fail later aren't undone here, as the record has passed.
    """
    with_rocksdb(records.sparkSession)
    names = records.columns
    body = [c for c in names if c not in (key, at)]
    marked = records.withWatermark(at, WATERMARK).select("*", F.unix_micros(at).alias("_us"), fingerprint(body).alias("_digest"))
    return by_bucket(marked, key, RepeatFilter(names, round(within_s * 1_000_000)), T.StructType(records.schema.fields))


def put_records(records: DataFrame, connect: Callable[[], Put], batch: int = 500) -> DataFrame:
    """sent, failed, error (one of the errors' texts, or null): a row for each `batch` records, which the tasks write as they count them.

    connect() is called once in a task. A record whose put raises counts as failed, and the next one follows. A task that is lost is run
    again and writes its records again; they carry their time, so that a store which keeps the latest is left as it was.
    """
    names = records.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        put = None
        for b in batches:
            put = put or connect()
            for lo in range(0, len(b), batch):
                sent, failed, error = 0, 0, None
                for r in b.slice(lo, batch).to_pylist():
                    try:
                        put([{"FeatureName": c, "ValueAsString": r[c] or ""} for c in names])
                        sent += 1
                    except Exception as e:  # noqa: BLE001  whatever went wrong, it is one record
                        failed, error = failed + 1, repr(e)
                yield pa.RecordBatch.from_arrays([pa.array([sent]), pa.array([failed]), pa.array([error], pa.string())], ["sent", "failed", "error"])

    return records.select(*[F.col(f"`{c}`").cast("string") for c in names]).mapInArrow(run, "sent long, failed long, error string")


class BudgetExceeded(RuntimeError):
    """More records have failed than the budget allows."""


def write(records: DataFrame, connect: Callable[[], Put], budget: float = BUDGET) -> tuple[int, int]:
    """Writes all records and gives (sent, failed) over all tasks; raises when failed passes budget * sent."""
    total = put_records(records, connect).agg(F.coalesce(F.sum("sent"), F.lit(0)).alias("sent"), F.coalesce(F.sum("failed"), F.lit(0)).alias("failed"), F.min("error").alias("error")).first()
    if total.failed > budget * total.sent:
        raise BudgetExceeded(f"{total.failed} of {total.sent + total.failed} records failed, for example: {total.error}")
    return total.sent, total.failed


def feature_sink(stream: DataFrame, connect: Callable[[], Put], checkpoint: str, query: str = "features", budget: float = BUDGET, once: bool = True):
    """Writes each micro-batch; a batch beyond the budget fails the query, which begins with that batch when it is started again."""
    made = stream.writeStream.foreachBatch(lambda batch, _: write(batch, connect, budget) and None).queryName(query).option("checkpointLocation", checkpoint)
    return (made.trigger(availableNow=True) if once else made.trigger(processingTime="5 seconds")).start()
