"""Streams on arbitrary state: sessions with passthrough and fraud scores, their state and their timers."""

import random
import time
from datetime import datetime, timedelta
from types import SimpleNamespace

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from lakeloom.functions.core import surrogate_key
from lakeloom.operators import fraud, sessions
from lakeloom.sources.tables import SnapshotTable
from lakeloom.streaming import jobs, stateful

T0 = datetime(2024, 1, 10, 12)
MIN = 60_000_000
CLICK = "user_id_hashed string, event_ts timestamp, event_id string, event_type string, product_price_usd double, product_quantity int, device_type string, geo_country string, ab_cohort string, page_referrer string, fraud_score double, seq long"


def click(k, user, minute, kind="page_view", price=None, quantity=None, score=None):
    return (user, T0 + timedelta(minutes=minute), f"e{k}", kind, price, quantity, f"d{k % 3}", "US" if k % 2 else None, "A", f"r{k}", score, k)


class Handle:
    """A user's state and timers in memory, as the engine keeps them for one key."""

    def __init__(self):
        self.values, self.timers, self.moves = {}, set(), []

    def state(self, name):
        has = self.values
        return SimpleNamespace(get=lambda: has.get(name), update=lambda v: has.__setitem__(name, v), clear=lambda: has.pop(name, None), put=lambda v: has.__setitem__(name, v))

    def getValueState(self, name, schema):
        return self.state(name)

    def getListState(self, name, schema):
        made = self.state(name)
        return SimpleNamespace(get=lambda: iter(self.values.get(name, [])), put=made.put, clear=made.clear)

    def registerTimer(self, at):
        self.timers.add(at)
        self.moves.append(("register", at))

    def deleteTimer(self, at):
        self.timers.remove(at)
        self.moves.append(("delete", at))

    def fire(self, processor, watermark_ms):
        out = []
        for at in sorted(t for t in self.timers if t <= watermark_ms):
            if at in self.timers:  # an earlier timer may have deleted it
                self.timers.remove(at)
                out += list(processor.handleExpiredTimer(("u",), None, SimpleNamespace(getExpiryTimeInMs=lambda at=at: at)))
        return out


def started(processor):
    handle = Handle()
    processor.init(handle)
    return handle


def event(us, seq=0, kind="page_view", **more):
    given = {"event_id": f"e{seq}", "event_type": kind, "product_price_usd": None, "product_quantity": None, "device_type": None, "geo_country": None, "ab_cohort": None, "page_referrer": None, "fraud_score": None}
    return Row(event_us=us, seq=seq, **(given | more))


def test_a_timer_moves_with_its_session():
    p = stateful.SessionStitcher()
    h = started(p)
    out = list(p.handleInputRows(("u",), iter([event(5 * MIN, 1), event(0, 0)]), None))
    assert [(r.record_type, r.event_id, r.session_no) for r in out] == [("event", "e0", 1), ("event", "e1", 1)] and h.timers == {20 * 60_000}
    list(p.handleInputRows(("u",), iter([event(19 * MIN, 2, "purchase", product_price_usd=2.5)]), None))
    assert h.moves[1:] == [("delete", 20 * 60_000), ("register", 34 * 60_000)]
    list(p.handleInputRows(("u",), iter([event(34 * MIN, 3)]), None))  # a gap after the last: another session, another timer
    assert h.timers == {34 * 60_000, 49 * 60_000}
    assert h.fire(p, 33 * 60_000) == []
    (closed,) = h.fire(p, 40 * 60_000)
    assert (closed.record_type, closed.session_no, closed.event_count, closed.purchases, closed.revenue, closed.first_us, closed.last_us) == ("session_summary", 1, 3, 1, 2.5, 0, 19 * MIN)
    assert len(h.values["sessions"]) == 1 and h.timers == {49 * 60_000}
    assert [r.session_no for r in h.fire(p, 10**9)] == [2]
    assert "sessions" not in h.values and not h.timers and h.values["count"] == (2,)  # numbers go on, nothing else stays
    assert h.fire(p, 10**9) == [] and list(p.handleExpiredTimer(("u",), None, SimpleNamespace(getExpiryTimeInMs=lambda: 1))) == []


def test_a_late_event_joins_sessions():
    p = stateful.SessionStitcher()
    h = started(p)
    list(p.handleInputRows(("u",), iter([event(0, 0), event(20 * MIN, 2)]), None))
    assert len(h.timers) == 2
    (late,) = p.handleInputRows(("u",), iter([event(10 * MIN, 1)]), None)
    assert late.session_no == 1 and h.timers == {35 * 60_000}
    (closed,) = h.fire(p, 10**9)
    assert (closed.session_no, closed.event_count, closed.first_us, closed.last_us) == (1, 3, 0, 20 * MIN)


@pytest.mark.parametrize("seed", range(5))
def test_sessions_don_t_hang_on_the_order(seed):
    """Any order of arrival gives the sessions of the sorted events."""
    r = random.Random(seed)
    kinds = ["page_view", "purchase", "add_to_cart", "remove_from_cart", "search", "other"]
    events = [event(r.randint(0, 300) * MIN, k, r.choice(kinds), product_price_usd=r.choice([None, 1.5, 2.25]), product_quantity=r.choice([None, 0, 3]), fraud_score=r.choice([None, 0.25, 0.75]), device_type=f"d{k}") for k in range(40)]
    plain = stateful.stitched([], sorted(events, key=lambda e: (e.event_us, e.seq)), 0)[0]
    mixed, count = [], 0
    r.shuffle(events)
    for lo in range(0, 40, 7):
        mixed, _, count = stateful.stitched(mixed, sorted(events[lo : lo + 7], key=lambda e: (e.event_us, e.seq)), count)
    drop = lambda ss: [{k: v for k, v in s.items() if k != "no"} for s in ss]
    assert drop(mixed) == drop(plain) and len({s["no"] for s in mixed}) == len(mixed)


def replay(spark, batches, schema, path):
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{path}/in")
        time.sleep(0.02)  # files are read in the order of their times
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")


def test_session_over_batches(spark, tmp_path):
    """Four micro-batches, sessions that span two of them; every event leaves in its own batch, summaries equal the batch form's."""
    batches = [
        [click(1, "a", 0), click(2, "a", 5, "product_view", 3.0), click(3, "b", 1, "add_to_cart", 2.0, 3)],
        [click(4, "a", 12, "purchase", 9.5, 1, 0.8), click(5, "b", 14, "remove_from_cart", 2.0), click(6, "a", 60, "search")],
        [click(7, "a", 700), click(8, "b", 705)],
        [click(9, "a", 1200), click(10, None, 1201)],
    ]
    path, seen = str(tmp_path), []
    stream = replay(spark, batches, CLICK, path)
    keep = lambda df, n: seen.append((n, df.collect()))
    stateful.session_events(stream).writeStream.foreachBatch(keep).option("checkpointLocation", f"{path}/ck").trigger(availableNow=True).start().awaitTermination()
    for n, rows in enumerate(batches):
        assert sorted(r.event_id for r in dict(seen)[n] if r.record_type == "event") == sorted(e[2] for e in rows)
    every = spark.createDataFrame([e for b in batches for e in b], CLICK)
    batch = sessions.stitch(every)
    assert {r.event_id: r.session_id for _, rows in seen for r in rows if r.record_type == "event"} == {r.event_id: r.session_id for r in batch.collect()}
    got = [r for _, rows in seen for r in rows if r.record_type == "session_summary"]
    columns = [c for c in sessions.summarise(batch).columns if c not in ("session_id", "user_id_hashed")]
    want = {r.session_id: r for r in sessions.summarise(batch).collect() if r.session_end_ts + timedelta(minutes=15) <= T0 + timedelta(minutes=1201 - 240)}
    assert len(got) == len(want) == 5 and sum(r.event_count > 1 for r in got) == 2
    for r in got:
        assert [r[c] for c in columns] == [want[r.session_id][c] for c in columns]
    a = surrogate_key(F.lit("a"), F.lit(1))
    assert spark.range(1).select(a).first()[0] in want


EVENT = "user_id string, event_ts timestamp, event_id string, event_type string, geo_country string, product_quantity int, seq long"


def test_fraud_timer_clears_the_count_and_keeps_the_country():
    p = stateful.FraudScorer()
    h = started(p)
    views = [event(k * 1_000_000, k, "product_view", geo_country="FR") for k in range(22)]
    list(p.handleInputRows(("u",), iter(views), None))
    assert h.values["past"] == (22, 0, 21_000_000, "FR", 21_000_000) and h.timers == {921_000}
    (r,) = p.handleInputRows(("u",), iter([event(22_000_000, 22, "purchase", geo_country="US")]), None)
    assert (r.fraud_score, r.fraud_signals) == (1.0, "VELOCITY_SPIKE,GEO_HOP,RAPID_PURCHASE")
    assert h.moves == [("register", 921_000), ("delete", 921_000), ("register", 922_000)]
    assert h.fire(p, 922_000) == []
    assert h.values["past"] == (0, None, 22_000_000, "US", None) and not h.timers and "timer" not in h.values
    (r,) = p.handleInputRows(("u",), iter([event(923_000_000, 23, "purchase", geo_country="DE")]), None)
    assert r.fraud_signals == "GEO_HOP" and h.values["past"] == (1, 923_000_000, 923_000_000, "DE", None)


def test_an_earlier_timer_isn_t_registered():
    """A batch of late events leaves the timer where it is."""
    p = stateful.FraudScorer()
    h = started(p)
    list(p.handleInputRows(("u",), iter([event(60 * MIN, 1)]), None))
    list(p.handleInputRows(("u",), iter([event(10 * MIN, 0)]), None))
    assert h.timers == {75 * 60_000}


def test_fraud_over_batches(spark, tmp_path):
    """Scores over five micro-batches equal the batch form's, across gaps and hot users."""
    r = random.Random(2)
    rows, at = [], 0
    for k in range(300):
        at += r.choice([1, 5, 20, 1000, 4000])
        rows.append((r.choice(["hot", "hot", "u1", "u2"]), T0 + timedelta(seconds=at), f"e{k}", r.choice(["product_view", "purchase", "add_to_cart"]), r.choice(["US", "GB", None, ""]), r.choice([None, 1, 60]), k))
    path = str(tmp_path)
    stream = replay(spark, [rows[k : k + 60] for k in range(0, 300, 60)], EVENT, path)
    table, alerts = SnapshotTable(spark, f"{path}/s"), SnapshotTable(spark, f"{path}/a")
    jobs.fraud_alerts(stateful.fraud_scores(stream), table, alerts, f"{path}/ck", "fraud-batches").awaitTermination()
    want = {x.event_id: (x.fraud_score, ",".join(x.fraud_signals)) for x in fraud.score(spark.createDataFrame(rows, EVENT)).collect()}
    assert {x.event_id: (x.fraud_score, x.fraud_signals) for x in table.read().collect()} == want
    assert alerts.read().count() == sum(s >= 0.7 for s, _ in want.values())
