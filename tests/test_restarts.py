"""Streams stopped at any point and started again, and rows that come too late."""

import os
import subprocess
import sys
import time
from datetime import datetime, timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from test_streams import CLICK, EVENT, click

from lakeloom.operators import fraud, sessions
from lakeloom.plans.registry import QUERIES
from lakeloom.sources.tables import SnapshotTable
from lakeloom.streaming import jobs, sinks, stateful

T0 = datetime(2024, 1, 10, 12)
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def replay(spark, batches, schema, path):
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{path}/in")
        time.sleep(0.02)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")


def clicks():
    return [[click(10 * b + k, f"u{k % 2}", 60 * b + 7 * k, ["page_view", "purchase"][k % 2], 1.0 * k) for k in range(8)] for b in range(6)]


def records(df):
    return sorted((r.record_type, r.session_id, r.event_id or "", r.event_count or 0, r.revenue_attributed_usd or 0.0) for r in df.collect())


def test_sessions_killed_between_batch_and_commit(spark, tmp_path):
    """A process that dies by itself (no handler runs) after writing a batch; another one goes on from the checkpoint."""
    path = str(tmp_path)
    stream = replay(spark, clicks(), CLICK, path)
    whole = stateful.session_events(stream)
    sinks.exactly_once(whole, f"{path}/unbroken", f"{path}/ck0", "sessions-unbroken").awaitTermination()
    script = f"""
import os, sys
sys.path[:0] = [{ROOT!r}, {ROOT + "/tests"!r}]
from pyspark.sql import SparkSession
from test_streams import CLICK
from lakeloom.streaming import sinks, stateful
spark = SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "8").config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false").getOrCreate()
events = spark.readStream.schema(CLICK).option("maxFilesPerTrigger", 1).parquet({path!r} + "/in")
kill = lambda number: spark._jvm.java.lang.Runtime.getRuntime().halt(9) if number == 2 else None
sinks.exactly_once(stateful.session_events(events), {path!r} + "/out", {path!r} + "/ck", "killed", done=kill).awaitTermination()
"""
    died = subprocess.run([sys.executable, "-c", script], capture_output=True, timeout=300, cwd=ROOT)
    assert died.returncode != 0 and (tmp_path / "out" / "batch=2" / "_SUCCESS").exists() and not (tmp_path / "ck" / "commits" / "2").exists()
    sinks.exactly_once(whole, f"{path}/out", f"{path}/ck", "sessions-again").awaitTermination()
    got = records(sinks.read_batches(spark, f"{path}/out", whole.schema))
    assert got == records(sinks.read_batches(spark, f"{path}/unbroken", whole.schema)) and len(got) > 48
    batch = sessions.stitch(spark.createDataFrame([e for b in clicks() for e in b], CLICK))
    assert {r[2]: r[1] for r in got if r[0] == "event"} == {r.event_id: r.session_id for r in batch.collect()}


def test_a_batch_that_isn_t_whole_isn_t_read(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/batch=0")
    spark.range(3).write.parquet(f"{tmp_path}/batch=1")
    (tmp_path / "batch=1" / "_SUCCESS").unlink()
    assert sinks.read_batches(spark, str(tmp_path), "id long").count() == 3
    assert sinks.read_batches(spark, f"{tmp_path}/none", "id long").count() == 0


def test_a_batch_that_a_later_one_stands_on_is_missed(spark, tmp_path):
    """A folder that is gone, or was never written to its end, is an error and not an empty or shorter result."""
    for k in range(3):
        spark.range(3).write.parquet(f"{tmp_path}/out/batch={k}")
    assert sinks.read_batches(spark, f"{tmp_path}/out", "id long").count() == 9
    (tmp_path / "out" / "batch=1" / "_SUCCESS").unlink()
    with pytest.raises(FileNotFoundError, match=r"batches \[1\]"):
        sinks.read_batches(spark, f"{tmp_path}/out", "id long")
    for k in (2, 0):
        (tmp_path / "out" / f"batch={k}" / "_SUCCESS").unlink()
    with pytest.raises(FileNotFoundError, match=r"batches \[0, 1\]"):  # as with a job that leaves no marks of success
        sinks.read_batches(spark, f"{tmp_path}/out", "id long")


def test_what_the_checkpoint_has_is_read_or_missed(spark, tmp_path):
    stream = replay(spark, clicks()[:3], CLICK, str(tmp_path))
    out, ck = f"{tmp_path}/out", f"{tmp_path}/ck"

    def stop(number):
        if number == 2:
            raise RuntimeError("stopped")

    read = lambda: sinks.read_batches(spark, out, CLICK, ck)
    with pytest.raises(FileNotFoundError, match="committed"):
        read()
    with pytest.raises(StreamingQueryException):
        sinks.exactly_once(stream, out, ck, "missed-1", done=stop).awaitTermination()
    with pytest.raises(RuntimeError, match="batch 2 has begun"):
        read()
    sinks.exactly_once(stream, out, ck, "missed-2").awaitTermination()
    spark.createDataFrame(clicks()[0], CLICK).write.parquet(f"{out}/batch=7")  # another checkpoint's
    assert read().count() == 24
    (tmp_path / "out" / "batch=2").rename(tmp_path / "kept")
    with pytest.raises(FileNotFoundError, match=r"batches \[2\]"):
        read()


def test_batches_are_marked_where_other_jobs_leave_no_marks(spark, tmp_path):
    stream, conf = replay(spark, clicks()[:2], CLICK, str(tmp_path)), spark._jsc.hadoopConfiguration()
    conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        sinks.exactly_once(stream, f"{tmp_path}/out", f"{tmp_path}/ck", "marked").awaitTermination()
        spark.range(3).write.parquet(f"{tmp_path}/plain")
    finally:
        conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")
    assert not (tmp_path / "plain" / "_SUCCESS").exists()
    assert sinks.read_batches(spark, f"{tmp_path}/out", CLICK).count() == sinks.read_batches(spark, f"{tmp_path}/out", CLICK, f"{tmp_path}/ck").count() == 16


@pytest.mark.parametrize("run, at", [(0, 0), (1, 1), (1, 2)])
def test_a_stop_that_stream_restart_doesn_t_make_itself_is_an_error(spark, sf, monkeypatch, run, at):
    """Before its own stop, or in the run after it; in either case some batches are written."""
    plain, runs = sinks.exactly_once, []

    def exactly_once(stream, path, checkpoint, query, once=True, done=None):
        mine, place = done or (lambda number: None), len(runs)
        runs.append(query)

        def fail(number):
            if (place, number) == (run, at):
                raise RuntimeError("a full disk")
            mine(number)

        return plain(stream, path, checkpoint, query, once, fail)

    monkeypatch.setattr(sinks, "exactly_once", exactly_once)
    with pytest.raises(StreamingQueryException, match="a full disk"):
        QUERIES["stream_restart"](spark, sf)
    assert len(runs) == run + 1


def test_stream_restart_is_stopped_or_fails(spark, sf, monkeypatch):
    plain = sinks.exactly_once
    monkeypatch.setattr(sinks, "exactly_once", lambda *a, done=None: plain(*a))
    with pytest.raises(RuntimeError, match="without being stopped"):
        QUERIES["stream_restart"](spark, sf)


@pytest.mark.parametrize("at", [0, 3])
def test_fraud_stopped_between_its_two_sinks(spark, tmp_path, at):
    path = str(tmp_path)
    rows = [(f"u{k % 2}", T0 + timedelta(seconds=40 * k), f"e{k}", "add_to_cart" if k % 3 else "product_view", "US" if k % 4 else "GB", 60 if k % 5 == 0 else 1, k) for k in range(50)]
    stream = replay(spark, [rows[k : k + 10] for k in range(0, 50, 10)], EVENT, path)
    table, alerts = SnapshotTable(spark, f"{path}/s"), SnapshotTable(spark, f"{path}/a")
    run = lambda: jobs.fraud_alerts(stateful.fraud_scores(stream), table, alerts, f"{path}/ck", "fraud-restart").awaitTermination()
    plain, stopped = alerts.append, []

    def append(batch, stream_, *more):
        if stream_[1] == at and not stopped:
            stopped.append(at)
            raise RuntimeError("stopped")
        return plain(batch, stream_, *more)

    alerts.append = append
    with pytest.raises(StreamingQueryException):
        run()
    run()
    want = {r.event_id: (r.fraud_score, ",".join(r.fraud_signals)) for r in fraud.score(spark.createDataFrame(rows, EVENT)).collect()}
    got = table.read().collect()
    assert stopped == [at] and len(got) == 50 and {r.event_id: (r.fraud_score, r.fraud_signals) for r in got} == want
    assert alerts.read().count() == sum(s >= 0.7 for s, _ in want.values())


def test_bronze_stopped_between_its_two_sinks(spark, tmp_path):
    from lakeloom.sources import connectors

    (tmp_path / "in").mkdir()
    for k in range(4):
        (tmp_path / "in" / f"{k}.txt").write_text(f"not json {k}\n" * (k + 1))
        os.utime(tmp_path / "in" / f"{k}.txt", (1_700_000_000 + k, 1_700_000_000 + k))
    table, dead = SnapshotTable(spark, str(tmp_path / "t")), SnapshotTable(spark, str(tmp_path / "d"))
    run = lambda: jobs.bronze(connectors.file_source(spark, str(tmp_path / "in")), table, dead, str(tmp_path / "ck"), "bronze-restart").awaitTermination()
    plain, stopped = dead.append, []

    def append(batch, stream_, *more):
        done = plain(batch, stream_, *more)
        if stream_[1] == 2 and not stopped:
            stopped.append(2)
            raise RuntimeError("stopped after both sinks, before the commit")
        return done

    dead.append = append
    with pytest.raises(StreamingQueryException):
        run()
    run()
    assert dead.read().count() == 1 + 2 + 3 + 4 and stopped == [2]


def test_churn_may_repeat_and_its_reader_doesn_t(spark, tmp_path):
    path = str(tmp_path)
    rows = [(f"u{k % 3}", T0 + timedelta(seconds=k), f"e{k}", "page_view", None, None, k) for k in range(30)]
    stream = replay(spark, [rows[:10], rows[10:20], rows[20:]], EVENT, path)
    scores = spark.createDataFrame([("u0", 0.1), ("u1", 0.9)], "user_id string, churn_score double")
    stopped = []

    def stop(number):
        if number == 1 and not stopped:
            stopped.append(number)
            raise RuntimeError("stopped")

    run = lambda: sinks.at_least_once(jobs.enrich_scores(stream, scores), f"{path}/out", f"{path}/ck", "churn-restart", done=stop).awaitTermination()
    with pytest.raises(StreamingQueryException):
        run()
    run()
    assert spark.read.parquet(f"{path}/out").count() == 40
    got = {r.event_id: r.churn_score for r in sinks.read_distinct(spark, f"{path}/out", ["event_id"]).collect()}
    assert got == {f"e{k}": {0: 0.1, 1: 0.9}.get(k % 3) for k in range(30)}


def test_a_quiet_input_doesn_t_hold_sessions_open(spark, tmp_path):
    """The other policy does; and what comes later than the watermark is counted, by the query and by a listener."""
    busy = [[click(k, "a", 300 * k)] for k in range(5)]
    quiet = [[click(100, "b", 0)], [click(101, "b", 1000), click(102, "c", 5), click(103, "c", 900)]]
    heard = []
    listener = sinks.LateRows(["quiet-True", "quiet-False"], lambda *a: heard.append(a))
    spark.streams.addListener(listener)
    closed = {}
    for wait in (True, False):
        path = f"{tmp_path}/{wait}"
        inputs = [replay(spark, busy, CLICK, f"{path}/busy"), replay(spark, quiet[:1], CLICK, f"{path}/quiet")]
        made = stateful.session_events(sinks.merged(inputs), marked=True)
        out, dropped = set(), 0
        for turn in (0, 1):
            with sinks.watermark_policy(spark, wait):
                q = sinks.exactly_once(made, f"{path}/out", f"{path}/ck", f"quiet-{wait}")
                q.awaitTermination()
            dropped += sum(n for _, _, n in sinks.late_rows(q))
            if turn == 0:
                out = {(r.user_id_hashed, r.session_start_ts) for r in sinks.read_batches(spark, f"{path}/out", made.schema).where("record_type = 'session_summary'").collect()}
                replay(spark, quiet[1:], CLICK, f"{path}/quiet")
        closed[wait] = out, dropped
    at = lambda m: T0 + timedelta(minutes=m)
    # the busy input's last event is at 1200: with four hours, and 15 minutes to a gap, sessions up to 945 are closed
    assert closed[False] == ({("a", at(300 * k)) for k in range(4)} | {("b", at(0))}, 2)
    assert closed[True] == (set(), 0)
    deadline = time.time() + 30
    while sum(h[4] for h in heard if h[0] == "quiet-False") < 2 and time.time() < deadline:
        time.sleep(0.2)
    spark.streams.removeListener(listener)
    assert spark.conf.get("spark.sql.streaming.multipleWatermarkPolicy") == "min"
    assert sum(h[4] for h in heard if h[0] == "quiet-False") == 2 and sum(h[3] for h in heard if h[0] == "quiet-False") == 9
    assert not any(h[4] for h in heard if h[0] == "quiet-True")
