"""A change stream into versioned history: log numbers that come out of order are held until the watermark has passed them."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from lakeloom.streaming.stateful import _timer, by_bucket, with_rocksdb

#: A change that waits, and the last version given out.
CHANGE = "cdc_lsn LONG, at_us LONG, cdc_op STRING, user_id STRING, status STRING, total_amount_usd DOUBLE"
LAST = "record_version INT, cdc_lsn LONG, status STRING"
_FIELDS = [f.split()[0] for f in CHANGE.split(", ")]
_OUT = Row("order_id", "user_id", "status", "total_amount_usd", "cdc_lsn", "from_us", "record_version", "prev_status")


class HistoryBuilder(StatefulProcessor):
    """Versions of an order in the order of the log.

    State of an order: the changes that wait, and number, log number and status of its last version. Every waiting change has a
    timer at its time; when the watermark has passed it, all changes up to there leave as versions, by log number. Changes at or before the last
    version's log number are stale or repeated and go; a delete is a version with status `deleted`; tombstones only end a key and add none.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", CHANGE)
        self.last = handle.getValueState("last", LAST)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:  # noqa: N802, N803
        before = [tuple(c) for c in self.waiting.get()]
        known = self.last.get()
        seen, least = {c[0] for c in before}, known[1] if known else None
        fresh = {}
        for r in rows:
            if r.cdc_op in ("c", "u", "d", "r") and r.cdc_lsn not in seen and (least is None or r.cdc_lsn > least):
                fresh[r.cdc_lsn] = tuple(getattr(r, c) for c in _FIELDS)
        if fresh:
            self.waiting.put(before + list(fresh.values()))
            registered = {_timer(c[1]) for c in before}
            for t in sorted({_timer(c[1]) for c in fresh.values()} - registered):
                self.handle.registerTimer(t)
        return iter([])

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:  # noqa: N802, N803
        at = expiredTimerInfo.getExpiryTimeInMs()
        waiting = [tuple(c) for c in self.waiting.get()]
        ready = sorted(c for c in waiting if _timer(c[1]) <= at)
        rest = [c for c in waiting if _timer(c[1]) > at]
        if rest:
            self.waiting.put(rest)
        else:
            self.waiting.clear()
        known = self.last.get()
        version, lsn, before = tuple(known) if known else (0, None, None)
        for c_lsn, at_us, op, user, status, amount in ready:
            if lsn is not None and c_lsn <= lsn:
                continue  # its time is later than that of a change which the log has after it
            version, lsn, status = version + 1, c_lsn, "deleted" if op == "d" else status
            yield _OUT(key[0], user, status, amount, lsn, at_us, version, before)
            before = status
        if version:
            self.last.update((version, lsn, before))

    def close(self) -> None:
        pass


def versions(changes: DataFrame, delay: str = "7 days") -> DataFrame:
    """Versions as they are settled: order_id, user_id, status, total_amount_usd, cdc_lsn, effective_from, record_version, prev_status.

    changes: order_id, user_id, status, total_amount_usd, cdc_op, cdc_lsn and changed_at TIMESTAMP. A change that comes more than `delay`
    behind the latest one is dropped as late.
    """
    with_rocksdb(changes.sparkSession)
    marked = changes.withWatermark("changed_at", delay).select("order_id", "changed_at", F.unix_micros("changed_at").alias("at_us"), "user_id", "status", "total_amount_usd", "cdc_op", "cdc_lsn")
    schema = "order_id STRING, user_id STRING, status STRING, total_amount_usd DOUBLE, cdc_lsn LONG, from_us LONG, record_version INT, prev_status STRING"
    made = by_bucket(marked, "order_id", HistoryBuilder(), schema)
    return made.select("order_id", "user_id", "status", "total_amount_usd", "cdc_lsn", F.timestamp_micros("from_us").alias("effective_from"), "record_version", "prev_status")


def laid_out(versions: DataFrame) -> DataFrame:
    """History of versions that have been given out: each ends where the next one begins, the last one is current."""
    line = Window.partitionBy("order_id").orderBy("record_version")
    return versions.withColumns({"effective_to": F.lead("effective_from").over(line), "is_current": F.lead("record_version").over(line).isNull()})
