"""Keyed streaming operators on arbitrary state with event-time timers: sessions with passthrough, fraud scores.

Both take a user's rows of a micro-batch, put them in event order, and read and write the user's state once for them. Rows
leave in the batch that brings them. Timers are in event time: they fire when the watermark has passed them, are moved when later
events come, and a user may have several. Needs the RocksDB state store, which `with_rocksdb` sets for the session.

A processor is written for one key. A stream runs it by `by_bucket`, for all keys of a bucket together: every call to the state store
crosses a socket, so one read and one write for a bucket take the place of several for each key. Rows go to and from Python as the columns of
data frames, as the engine's rows are made cell by cell.
"""

from __future__ import annotations

import pickle
import re
from bisect import bisect_left
from collections import namedtuple
from collections.abc import Callable, Iterator, Sequence
from datetime import datetime
from functools import lru_cache
from itertools import batched
from typing import Any
from zoneinfo import ZoneInfo

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BinaryType, BooleanType, DataType, DoubleType, IntegerType, LongType, StringType, StructType, TimestampType

from lakeloom.functions import constants as C
from lakeloom.functions.core import funnel_stage, surrogate_key
from lakeloom.operators import fraud

WATERMARK = "4 hours"
GAP_US = C.SESSION_GAP_S * 1_000_000


def with_rocksdb(spark: SparkSession) -> None:
    """Arbitrary state needs a store with column families; a session that names another store keeps its own."""
    key = "spark.sql.streaming.stateStore.providerClass"
    if "HDFSBacked" in spark.conf.get(key, "HDFSBacked"):
        spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def _timer(us: int) -> int:
    """The first whole millisecond at or after a time in microseconds."""
    return -(-us // 1000)


# ---- many keys to a bucket

#: Buckets that a stream's keys are dealt to; fixed for the life of a checkpoint.
BUCKETS = 1024


class _Cell:
    """A value or list state of the key that a bucket is at."""

    def __init__(self, bucket: Bucket, name: str, many: bool) -> None:
        self.bucket, self.name, self.many = bucket, name, many

    def get(self) -> Any:
        found = self.bucket.values.get(self.name)
        return iter(found or []) if self.many else found

    def update(self, value: Any) -> None:
        self.bucket.values[self.name] = value

    put = update

    def clear(self) -> None:
        self.bucket.values.pop(self.name, None)


class Bucket(StatefulProcessor):
    """Runs a processor of one key for all keys of a bucket, which hands it their states and timers and is its handle.

    The bucket's state is one value, the states and timers of its keys (plain tuples, pickled), read and written once for a batch's rows and once
    for its timers. The engine has one timer for a bucket, at the earliest of its keys' timers; when it fires, all that the watermark has
    passed do, each key's in order of time. A key without state and timers leaves nothing.
    """

    def __init__(self, inner: StatefulProcessor, key: str) -> None:
        self.inner, self.key = inner, key

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.kept = handle.getValueState("kept", "state BINARY")
        self.values: dict = {}
        self.timers: set = set()
        self.inner.init(self)

    def getValueState(self, name: str, schema: str) -> _Cell:  # noqa: N802
        return _Cell(self, name, False)

    def getListState(self, name: str, schema: str) -> _Cell:  # noqa: N802
        return _Cell(self, name, True)

    def registerTimer(self, at: int) -> None:  # noqa: N802
        self.timers.add(at)

    def deleteTimer(self, at: int) -> None:  # noqa: N802
        self.timers.discard(at)

    def _load(self) -> tuple[int | None, dict]:
        found = self.kept.get()
        return pickle.loads(found[0]) if found else (None, {})

    def _keep(self, timer: int | None, keys: dict) -> None:
        """Write the keys, and make the earliest of their timers the bucket's, given the one that is registered."""
        first = min((min(timers) for _, timers in keys.values() if timers), default=None)
        if first != timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            if first is not None:
                self.handle.registerTimer(first)
        if keys:
            self.kept.update((pickle.dumps((first, keys), 5),))
        else:
            self.kept.clear()

    def _at(self, keys: dict, key: Any) -> None:
        self.values, timers = keys.get(key, ({}, ()))
        self.timers = set(timers)

    def _left(self, keys: dict, key: Any) -> None:
        if self.values or self.timers:
            keys[key] = (self.values, tuple(self.timers))
        else:
            keys.pop(key, None)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:  # noqa: N802, N803
        timer, keys = self._load()
        of: dict[Any, list[Row]] = {}
        for r in rows:
            of.setdefault(getattr(r, self.key), []).append(r)
        for k, own in of.items():
            self._at(keys, k)
            yield from self.inner.handleInputRows((k,), iter(own), timerValues)
            self._left(keys, k)
        self._keep(timer, keys)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:  # noqa: N802, N803
        fired, passed = expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs()
        timer, keys = self._load()
        for k in [k for k, (_, timers) in keys.items() if timers and min(timers) <= passed]:
            self._at(keys, k)
            while self.timers and min(self.timers) <= passed:
                at = min(self.timers)
                self.timers.remove(at)
                yield from self.inner.handleExpiredTimer((k,), timerValues, _Fired(at))
            self._left(keys, k)
        self._keep(None if timer == fired else timer, keys)  # the fired timer is gone by itself

    def close(self) -> None:
        self.inner.close()


class _Fired:
    def __init__(self, at: int) -> None:
        self.at = at

    def getExpiryTimeInMs(self) -> int:  # noqa: N802
        return self.at


#: Types that a frame's columns may have besides TIMESTAMP, and what stands for a null there; a column says which rows have one.
_SIMPLE: dict[DataType, tuple[Any, pa.DataType]] = {
    StringType(): ("", pa.string()), LongType(): (0, pa.int64()), IntegerType(): (0, pa.int32()), DoubleType(): (0.0, pa.float64()), BooleanType(): (False, pa.bool_()), BinaryType(): (b"", pa.binary()),
}
#: Columns whose nulls one LONG can tell.
_MARKS = 62
#: Rows of a frame that goes back to the engine.
_FRAME = 10_000


@lru_cache
def _event(names: tuple[str, ...]) -> Callable[[Sequence], Any]:
    """A maker of rows with the given names, whose values are read as fast as those of named tuples, whatever the names are."""
    plain = namedtuple("Event", [f"f{i}" for i in range(len(names))])  # noqa: PYI024
    return type("Event", (plain,), {"__slots__": (), **{n: vars(plain)[f"f{i}"] for i, n in enumerate(names)}})._make


class Frames(Bucket):
    """A bucket that takes and gives data frames. Its processor has rows with attributes, and times as microseconds, in and out.

    A frame has the columns of `names` as c0, c1, ... without nulls: the bit of a column in `nulls` says where there is one, so that
    integers stay integers and NaN stays a number.
    """

    def __init__(self, inner: StatefulProcessor, key: str, names: Sequence[str], schema: StructType) -> None:
        super().__init__(inner, key)
        self.names, self.schema = tuple(names), schema

    def _rows(self, frames: Iterator[pd.DataFrame]) -> Iterator[Any]:
        made = _event(self.names)
        for frame in frames:
            marks, columns = frame["nulls"].to_numpy(np.int64), []
            every = int(np.bitwise_or.reduce(marks)) if len(marks) else 0
            for i, name in enumerate(self.names):
                values = frame[f"c{i}"].tolist()
                if every >> i & 1:
                    for at in np.flatnonzero(marks >> i & 1).tolist():
                        values[at] = None
                columns.append(values)
            yield from map(made, zip(*columns, strict=True))

    def _frames(self, rows: Iterator[Sequence]) -> Iterator[pd.DataFrame]:
        kinds = [_SIMPLE[f.dataType][1] for f in self.schema]
        for some in batched(rows, _FRAME):
            arrays = [pa.array(column, kind) for column, kind in zip(zip(*some, strict=True), kinds, strict=True)]
            yield pa.Table.from_arrays(arrays, self.schema.names).to_pandas(types_mapper=pd.ArrowDtype)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        return self._frames(super().handleInputRows(key, self._rows(rows), timerValues))

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        return self._frames(super().handleExpiredTimer(key, timerValues, expiredTimerInfo))


def by_bucket(rows: DataFrame, key: str, processor: StatefulProcessor, schema: str | StructType, buckets: int = BUCKETS) -> DataFrame:
    """transformWithState by event time, as `rows.groupBy(key)` would have it, run for the keys of a bucket together.

    The processor finds a row's values as attributes. If all columns have simple types (_SIMPLE, and TIMESTAMP as microseconds, in and out), rows
    come and go in data frames; with any other type row by row, times as datetimes.
    """
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("bucket")
    simple = all(f.dataType in _SIMPLE or f.dataType == TimestampType() for f in [*rows.schema, *schema]) and len(rows.columns) <= _MARKS
    if not simple:
        return rows.withColumn("_bucket", bucket).groupBy("_bucket").transformWithState(Bucket(processor, key), schema, "append", "EventTime")
    col = lambda c: F.col(f"`{c}`")
    value = lambda f: F.coalesce(F.unix_micros(col(f.name)), F.lit(0)) if f.dataType == TimestampType() else F.coalesce(col(f.name), F.lit(_SIMPLE[f.dataType][0]))
    nulls = sum((F.when(col(f.name).isNull(), F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, f in enumerate(rows.schema)), F.lit(0).cast("long")).alias("nulls")
    times = [col(f.name).alias(f"t{i}") for i, f in enumerate(rows.schema) if f.dataType == TimestampType()]  # one of them has the watermark
    sent = rows.select(*times, *[value(f).alias(f"c{i}") for i, f in enumerate(rows.schema)], nulls, bucket)
    plain = StructType()
    for f in schema:
        plain = plain.add(f.name, LongType() if f.dataType == TimestampType() else f.dataType, True)
    made = sent.groupBy("bucket").transformWithStateInPandas(Frames(processor, key, rows.columns, plain), plain, "append", "EventTime")
    return made.select(*[F.timestamp_micros(col(f.name)).alias(f.name) if f.dataType == TimestampType() else col(f.name) for f in schema])


# ---- sessions

#: A session that is still open: its number, ends in event time (with seq as the tie's order), and running sums.
SESSION_STATE = (
    "no LONG, first_us LONG, first_seq LONG, last_us LONG, last_seq LONG, event_count LONG, page_views LONG, product_views LONG, cart_adds LONG, cart_removes LONG, "
    "searches LONG, checkout_attempts LONG, purchases LONG, revenue DOUBLE, carted DOUBLE, depth INT, device_type STRING, geo_country STRING, ab_cohort STRING, entry_referrer STRING, "
    "exit_event_type STRING, max_fraud_score DOUBLE"
)
SESSION_IN = ("event_id", "event_type", "product_price_usd", "product_quantity", "device_type", "geo_country", "ab_cohort", "page_referrer", "fraud_score", "seq")
_COUNTED = {"page_view": "page_views", "product_view": "product_views", "add_to_cart": "cart_adds", "remove_from_cart": "cart_removes", "search": "searches", "checkout_start": "checkout_attempts", "purchase": "purchases"}
_OF_FIRST = {"device_type": "device_type", "geo_country": "geo_country", "ab_cohort": "ab_cohort", "entry_referrer": "page_referrer"}


def opened(no: int, e: Any) -> dict:
    """A session of one event."""
    price, quantity = e.product_price_usd or 0.0, e.product_quantity or 1
    carted = {"add_to_cart": price * quantity, "remove_from_cart": -price}.get(e.event_type, 0.0)
    made = {"no": no, "first_us": e.event_us, "first_seq": e.seq, "last_us": e.event_us, "last_seq": e.seq, "event_count": 1, **dict.fromkeys(_COUNTED.values(), 0)}
    if e.event_type in _COUNTED:
        made[_COUNTED[e.event_type]] = 1
    made |= {"revenue": price if e.event_type == "purchase" else 0.0, "carted": carted, "depth": C.FUNNEL_DEPTH.get(e.event_type, 0)}
    return made | {name: getattr(e, column) for name, column in _OF_FIRST.items()} | {"exit_event_type": e.event_type, "max_fraud_score": e.fraud_score}


def joined(a: dict, b: dict) -> dict:
    """Two sessions as one: sums added, first and last by event time; the lower number stays."""
    front = a if (a["first_us"], a["first_seq"]) <= (b["first_us"], b["first_seq"]) else b
    back = a if (a["last_us"], a["last_seq"]) >= (b["last_us"], b["last_seq"]) else b
    scores = [s for s in (a["max_fraud_score"], b["max_fraud_score"]) if s is not None]
    added = {c: a[c] + b[c] for c in ("event_count", *_COUNTED.values(), "revenue", "carted")}
    ends = {"first_us": front["first_us"], "first_seq": front["first_seq"], "last_us": back["last_us"], "last_seq": back["last_seq"]}
    named = {c: front[c] for c in _OF_FIRST} | {"exit_event_type": back["exit_event_type"], "max_fraud_score": max(scores) if scores else None}
    return {"no": min(a["no"], b["no"]), **ends, **added, "depth": max(a["depth"], b["depth"]), **named}


def stitched(sessions: list[dict], events: list[Any], count: int, gap_us: int = GAP_US) -> tuple[list[dict], list[int], int]:
    """Open sessions with more events (in event order), the session number of each event, and how many sessions there were.

    An event less than a gap from a session belongs to it; one between two joins them, and the lower number stays.
    """
    numbers, sessions = [], sorted(sessions, key=lambda s: s["first_us"])
    for e in events:
        one = opened(count + 1, e)
        # sessions are a gap or more apart, so those near an event stand side by side
        lo = bisect_left(sessions, True, key=lambda s: e.event_us < s["last_us"] + gap_us)
        hi = bisect_left(sessions, True, lo, key=lambda s: e.event_us <= s["first_us"] - gap_us)
        near = sessions[lo:hi]
        if not near:
            count += 1
        else:
            one["no"] = min(s["no"] for s in near)
        for s in near:
            one = joined(s, one)
        sessions[lo:hi] = [one]
        numbers.append(one["no"])
    return sessions, numbers, count


class SessionStitcher(StatefulProcessor):
    """Every event leaves at once with the number of its session; a summary leaves when the session's gap timer fires.

    State of a user: the list of sessions that are still open (one, or more while events come out of order) and the number of
    sessions so far. Each open session has a timer a gap after its last event, which is moved when the session grows.
    """

    def __init__(self, gap_us: int = GAP_US) -> None:
        self.gap_us = gap_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sessions = handle.getListState("sessions", SESSION_STATE)
        self.count = handle.getValueState("count", "n LONG")

    def _open(self) -> list[dict]:
        return [s.asDict() if isinstance(s, Row) else dict(zip(_SESSION_FIELDS, s, strict=True)) for s in self.sessions.get()]

    def _keep(self, sessions: list[dict], timers: set[int]) -> None:
        """Write the sessions and make the timers be theirs, given those that are registered."""
        if sessions:
            self.sessions.put([tuple(s[c] for c in _SESSION_FIELDS) for s in sessions])
        else:
            self.sessions.clear()
        wanted = {_timer(s["last_us"] + self.gap_us) for s in sessions}
        for t in timers - wanted:
            self.handle.deleteTimer(t)
        for t in wanted - timers:
            self.handle.registerTimer(t)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:  # noqa: N802, N803
        events = sorted(rows, key=lambda e: (e.event_us, e.seq))
        before = self._open()
        known = self.count.get()
        sessions, numbers, count = stitched(before, events, known[0] if known else 0, self.gap_us)
        self.count.update((count,))
        self._keep(sessions, {_timer(s["last_us"] + self.gap_us) for s in before})
        for e, no in zip(events, numbers, strict=True):
            yield _SESSION_OUT("event", key[0], no, e.event_id, e.event_us, e.event_type, *[None] * len(_SUMMARY_FIELDS))

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:  # noqa: N802, N803
        at = expiredTimerInfo.getExpiryTimeInMs()
        # the watermark has passed other sessions' timers too: they are closed here, and not looked through again for each of them
        passed = max(at, timerValues.getCurrentWatermarkInMs()) if timerValues is not None else at
        before = self._open()
        closed = [s for s in before if _timer(s["last_us"] + self.gap_us) <= passed]
        # the fired timer is gone by itself
        self._keep([s for s in before if _timer(s["last_us"] + self.gap_us) > passed], {_timer(s["last_us"] + self.gap_us) for s in before} - {at})
        for s in closed:
            yield _SESSION_OUT("session_summary", key[0], s["no"], None, s["last_us"], None, *[s[c] for c in _SUMMARY_FIELDS])

    def close(self) -> None:
        pass


_SESSION_FIELDS = [f.split()[0] for f in SESSION_STATE.split(", ")]
_SUMMARY_FIELDS = [c for c in _SESSION_FIELDS if c not in ("no", "first_seq", "last_seq")]
_SESSION_OUT = Row("record_type", "user", "session_no", "event_id", "at_us", "event_type", *_SUMMARY_FIELDS)
_SUMMARY_TYPES = ", ".join(f for f in SESSION_STATE.split(", ") if f.split()[0] in _SUMMARY_FIELDS)


def session_events(events: DataFrame, user: str = "user_id_hashed", marked: bool = False) -> DataFrame:
    """Rows of two kinds: record_type 'event', every event with its session_id, and 'session_summary', one for each closed session.

    events: event_ts TIMESTAMP and SESSION_IN. Numbers, and so ids, are those of the batch form (`sessions.stitch`) where a user's
    events come in order; an event that comes late joins the sessions it lies between, or opens one with the next number.
    marked: events has a watermark already.
    """
    with_rocksdb(events.sparkSession)
    chosen = (events if marked else events.withWatermark("event_ts", WATERMARK)).select(user, "event_ts", F.unix_micros("event_ts").alias("event_us"), *SESSION_IN)
    schema = f"record_type STRING, user STRING, session_no LONG, event_id STRING, at_us LONG, event_type STRING, {_SUMMARY_TYPES}"
    made = by_bucket(chosen, user, SessionStitcher(), schema)
    at = lambda c: F.timestamp_micros(c)
    return made.select(
        "record_type", F.col("user").alias(user), surrogate_key(F.col("user"), F.col("session_no")).alias("session_id"), "event_id", at("at_us").alias("event_ts"), "event_type",
        at("first_us").alias("session_start_ts"), at("last_us").alias("session_end_ts"), F.to_date(at("first_us")).alias("session_date"),
        F.floor((F.col("last_us") - F.col("first_us")) / 1_000_000).alias("session_duration_s"), "event_count", *_COUNTED.values(),
        F.round("revenue", 4).alias("revenue_attributed_usd"), F.round(F.when(F.col("carted") < 0, 0.0).otherwise(F.col("carted")), 4).alias("cart_value_usd"),
        ((F.col("cart_adds") > 0) & (F.col("purchases") == 0)).alias("cart_abandonment"), F.when(F.col("depth").isNotNull(), funnel_stage(F.col("depth"))).alias("funnel_stage_reached"),
        *_OF_FIRST, "exit_event_type", "max_fraud_score", (F.col("max_fraud_score") >= C.FRAUD_ALERT).alias("fraud_flagged"),
    )


# ---- fraud


def local_hour(us: int, zone: str | None) -> int:
    """As functions.core.local_hour: the hour in an IANA zone; unknown and missing zones count as UTC."""
    known = isinstance(zone, str) and re.fullmatch(r"[A-Za-z]+(/[A-Za-z0-9_+\-]+)*", zone)
    return datetime.fromtimestamp(us // 1_000_000, ZoneInfo(zone if known else "UTC")).hour


#: Events since the last gap, the first and last event's time, the last country and the last product view.
FRAUD_STATE = "n LONG, started LONG, last LONG, country STRING, viewed LONG"
_FRAUD_OUT = Row("user", "event_id", "fraud_score", "fraud_signals")
FRAUD_IN = ("event_id", "event_type", "geo_country", "product_quantity", "seq")


def scored(state: tuple, events: list[Any], gap_us: int = GAP_US) -> tuple[tuple, list[tuple[float, str]]]:
    """A user's state after more events (in event order), and each event's score and signals, joined by comma."""
    n, started, last, country, viewed = state
    rules, out = fraud.SIGNALS, []
    for e in events:
        at, quantity = e.event_us, e.product_quantity or 0
        if last is None or at - last >= gap_us:  # as the timer does, which fires once the watermark has come by
            n, viewed, started = 0, None, at
        here = e.geo_country or None
        bought = e.event_type == "purchase"
        hits = {
            "VELOCITY_SPIKE": n > 20 and at - last < 60_000_000,
            "GEO_HOP": bool(country and here and country != here),
            "UNUSUAL_HOUR": bought and local_hour(at, getattr(e, "geo_timezone", None)) in (2, 3),
            "RAPID_PURCHASE": bought and viewed is not None and at - viewed < 30_000_000,
            "CART_OVERFLOW": e.event_type == "add_to_cart" and quantity > 50,
        }
        out.append((round(min(sum(v for k, v in rules.items() if hits[k]), 1.0), 4), ",".join(k for k in rules if hits[k])))
        n, last, country, started = n + 1, at, here or country, at if started is None else started
        viewed = at if e.event_type == "product_view" else viewed
    return (n, started, last, country, viewed), out


class FraudScorer(StatefulProcessor):
    """Scores every event from the user's past. A timer a gap after the last event clears the count, the session's start and the view;
    country and time stay, so that a change of country is seen across gaps. The timer is moved with every batch of the user's events."""

    def __init__(self, gap_us: int = GAP_US) -> None:
        self.gap_us = gap_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.past = handle.getValueState("past", FRAUD_STATE)
        self.timer = handle.getValueState("timer", "at LONG")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:  # noqa: N802, N803
        events = sorted(rows, key=lambda e: (e.event_us, e.seq))
        known = self.past.get()
        state, found = scored(tuple(known) if known else (0, None, None, None, None), events, self.gap_us)
        self.past.update(state)
        cleanup, old = _timer(state[2] + self.gap_us), self.timer.get()
        if old is None or cleanup > old[0]:
            if old is not None:
                self.handle.deleteTimer(old[0])
            self.handle.registerTimer(cleanup)
            self.timer.update((cleanup,))
        for e, (score, signals) in zip(events, found, strict=True):
            yield _FRAUD_OUT(key[0], e.event_id, score, signals)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:  # noqa: N802, N803
        known = self.past.get()
        if known:
            _, _, last, country, _ = known
            self.past.update((0, None, last, country, None))
        self.timer.clear()
        return iter([])

    def close(self) -> None:
        pass


def fraud_scores(events: DataFrame, user: str = "user_id") -> DataFrame:
    """user, event_id, fraud_score, fraud_signals (joined by comma) of a stream with event_ts TIMESTAMP, FRAUD_IN and perhaps geo_timezone.

    A user's events are scored in event order within a batch, and batch after batch.
    """
    with_rocksdb(events.sparkSession)
    zone = [c for c in ("geo_timezone",) if c in events.columns]
    marked = events.withWatermark("event_ts", WATERMARK).select(user, "event_ts", F.unix_micros("event_ts").alias("event_us"), *FRAUD_IN, *zone)
    made = by_bucket(marked, user, FraudScorer(), "user STRING, event_id STRING, fraud_score DOUBLE, fraud_signals STRING")
    return made.withColumnRenamed("user", user)
