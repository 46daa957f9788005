"""Stateful processors run for all keys of a bucket: same rows, states and timers as key by key, with few calls to the state store."""

import math
import random
from datetime import datetime
from types import SimpleNamespace

from pyspark.sql import Row
from pyspark.sql.streaming import StatefulProcessor
from test_history_stream import DAY
from test_streams import MIN, Handle, event

from lakeloom.streaming import history, stateful


class Counted(Handle):
    def __init__(self):
        super().__init__()
        self.calls = 0

    def state(self, name):
        made = super().state(name)

        def counted(f):
            def call(*a):
                self.calls += 1
                return f(*a)

            return call

        return SimpleNamespace(**{k: counted(f) for k, f in vars(made).items()})


def run(processor, key, batches):
    """Rows of each batch and of the timers that its watermark passes, from one processor for each key and from one for all."""
    single, apart, together = {}, [], []
    handle, bucket = Counted(), stateful.Bucket(processor(), key)
    bucket.init(handle)
    for rows, watermark in batches:
        for k in dict.fromkeys(r[key] for r in rows):
            if k not in single:
                single[k] = processor(), Handle()
                single[k][0].init(single[k][1])
            p, h = single[k]
            apart += p.handleInputRows((k,), iter([r for r in rows if r[key] == k]), None)
        for k, (p, h) in single.items():
            while h.timers and min(h.timers) <= watermark:
                at = min(h.timers)
                h.timers.remove(at)
                apart += p.handleExpiredTimer((k,), None, SimpleNamespace(getExpiryTimeInMs=lambda at=at: at))
        now = SimpleNamespace(getCurrentWatermarkInMs=lambda w=watermark: w)
        together += bucket.handleInputRows((0,), iter(rows), now)
        while handle.timers and min(handle.timers) <= watermark:
            at = min(handle.timers)
            handle.timers.remove(at)
            together += bucket.handleExpiredTimer((0,), now, SimpleNamespace(getExpiryTimeInMs=lambda at=at: at))
    return apart, together, handle, single


def test_history_of_many_orders():
    r = random.Random(3)
    every = [Row(order_id=f"o{o}", cdc_lsn=10 * o + v, at_us=(o % 9 + 2 * v) * DAY, cdc_op="d" if v == 3 else "u", user_id=None, status=f"s{v}", total_amount_usd=None if v == 1 else 1.5 * v) for o in range(200) for v in range(1 + o % 4)]
    every.sort(key=lambda c: c.at_us + r.randint(0, 3) * DAY)
    cut = len(every) // 4
    batches = [(every[k * cut : (k + 1) * cut if k < 3 else None], k * 5 * 86_400_000) for k in range(4)] + [([], 10**12)]
    apart, together, handle, single = run(history.HistoryBuilder, "order_id", batches)
    assert 400 < len(together) <= len(every) and sorted(together, key=str) == sorted(apart, key=str)
    assert not handle.timers and handle.calls <= 4 * len(batches)  # key by key it was several calls for each of the 200 orders
    kept = stateful.Bucket(history.HistoryBuilder(), "order_id")
    kept.init(handle)
    assert {k: v for k, (v, _) in kept._load()[1].items()} == {k: h.values for k, (_, h) in single.items()}


def test_sessions_and_scores_of_many_users():
    r = random.Random(4)
    kinds = ["page_view", "product_view", "add_to_cart", "purchase"]
    rows = [Row(user=r.choice(["a", "b", "c", None, "hot", "hot"]), **event(k * MIN + r.randint(0, 9) * MIN, k, r.choice(kinds), product_price_usd=1.5, product_quantity=60, geo_country=r.choice(["US", "FR", None])).asDict()) for k in range(600)]
    batches = [(rows[k : k + 150], (k - 240) * 60_000) for k in range(0, 600, 150)] + [([], 10**12)]
    for processor in (stateful.SessionStitcher, stateful.FraudScorer):
        apart, together, handle, single = run(processor, "user", batches)
        assert sorted(together, key=str) == sorted(apart, key=str) and len(together) >= 600
        assert not handle.timers and set(single) == {"a", "b", "c", None, "hot"}
        assert handle.calls <= 4 * len(batches) + 2


def test_all_sessions_that_the_watermark_has_passed_close_at_once():
    """A user with many closed sessions isn't looked through again for each of their timers."""
    p = stateful.SessionStitcher()
    handle = Counted()
    p.init(handle)
    list(p.handleInputRows(("u",), iter([event(20 * k * MIN, k) for k in range(300)]), None))
    at, before = min(handle.timers), handle.calls
    handle.timers.remove(at)
    now = SimpleNamespace(getCurrentWatermarkInMs=lambda: (20 * 200 + 15) * 60_000)
    closed = list(p.handleExpiredTimer(("u",), now, SimpleNamespace(getExpiryTimeInMs=lambda: at)))
    assert [r.session_no for r in closed] == list(range(1, 202)) and handle.calls - before <= 2
    assert handle.timers == {(20 * k + 15) * 60_000 for k in range(201, 300)}


def test_values_survive_data_frames(spark, tmp_path, monkeypatch):
    """Nulls, NaN, empty texts and large integers come back as they went, in frames and row by row."""
    out_ = Row("user", "at", "_us", "n", "x", "flag", "data", "big", "before")

    class Kept(StatefulProcessor):
        """Gives rows back as they come, and a user's row before, from the state."""

        def init(self, handle):
            self.last = handle.getValueState("last", "_us LONG")

        def handleInputRows(self, key, rows, timerValues):  # noqa: N802, N803
            for r in sorted(rows, key=lambda r: r._us):
                before = self.last.get()
                self.last.update((r._us,))
                yield out_(key[0], r.at, r._us, r.n, r.x, r.flag, r.data, r.big, before and before[0])

        def close(self):
            pass

    schema = "user string, at timestamp, _us long, n int, x double, flag boolean, data binary, big long"
    at = lambda k: datetime(2024, 1, 10, 12, k // 60, k % 60, 7)
    user = lambda k: [None, "", "a", "b"][k % 4]
    rows = [(user(k), at(k), k, [None, 0, 3][k % 3], [None, math.nan, 0.0, -0.0, 1e300][k % 5], [None, True, False][k % 3], [None, b"", b"\x00x"][k % 3], [None, 2**63 - 1, -(2**53) - 1][k % 3]) for k in range(90)]
    want = {(k, repr(r), k - 4 if k >= 4 else None) for k, r in enumerate(rows)}
    for name, kinds in (("frames", None), ("rows", {})):
        if kinds is not None:
            monkeypatch.setattr(stateful, "_SIMPLE", kinds)
        path = str(tmp_path / name)
        for k in range(3):
            spark.createDataFrame(rows[30 * k : 30 * k + 30], schema).coalesce(1).write.mode("append").parquet(f"{path}/in")
        stateful.with_rocksdb(spark)
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in").withWatermark("at", "1 hour")
        made = stateful.by_bucket(stream, "user", Kept(), f"{schema}, before long", 4)
        assert made.schema.simpleString() == "struct<user:string,at:timestamp,_us:bigint,n:int,x:double,flag:boolean,data:binary,big:bigint,before:bigint>"
        made.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/ck").trigger(availableNow=True).start().awaitTermination()
        found = spark.read.parquet(f"{path}/out").collect()
        given = lambda r: repr((r.user, r.at, r._us, r.n, r.x, r.flag, None if r.data is None else bytes(r.data), r.big))
        assert len(found) == 90 and {(r._us, given(r), r.before) for r in found} == want
