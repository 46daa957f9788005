"""Feature records: repeats in the stream, bulk writes and their error budget."""

import os
import time
from datetime import datetime, timedelta
from types import SimpleNamespace

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import Row
from pyspark.sql import functions as F
from test_streams import Handle

from lakeloom.streaming import features

T0 = datetime(2024, 1, 10)
RECORD = "user_id_hashed string, feature_timestamp timestamp, orders long, band string"


def record(user, second, orders, band="mid"):
    return (user, T0 + timedelta(seconds=second), orders, band)


def test_repeats_within_the_time_are_skipped_across_batches(spark, tmp_path):
    batches = [
        [record("a", 0, 1), record("a", 3, 1), record("b", 0, 1, None)],  # the second repeats the first
        [record("a", 4.5, 1), record("a", 5, 1), record("b", 1, 1, "")],  # 4.5 repeats the first batch's; at 5 s its time is over; null isn't ''
        [record("a", 6, 2), record("a", 6.5, 1), record("a", 7, 1), record("b", 100_000, 1, "")],  # another content counts, and the first one again after it
    ]
    for rows in batches:
        spark.createDataFrame(rows, RECORD).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        time.sleep(0.02)
    stream = spark.readStream.schema(RECORD).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    out = features.without_repeats(stream)
    assert out.schema == stream.schema
    out.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination()
    got = sorted(((r.user_id_hashed, (r.feature_timestamp - T0).total_seconds(), r.orders, r.band) for r in spark.read.parquet(str(tmp_path / "out")).collect()), key=str)
    assert got == sorted([("a", 0.0, 1, "mid"), ("a", 5.0, 1, "mid"), ("a", 6.0, 2, "mid"), ("a", 6.5, 1, "mid"), ("b", 0.0, 1, None), ("b", 1.0, 1, ""), ("b", 100_000.0, 1, "")], key=str)


def test_state_is_forgotten():
    p = features.RepeatFilter(["x"], 5_000_000)
    h = Handle()
    p.init(h)
    row = lambda us, digest: Row(x=us, _us=us, _digest=digest)
    assert len(list(p.handleInputRows(("u",), iter([row(0, "d"), row(1, "d")]), None))) == 1 and h.timers == {5000}
    assert list(p.handleInputRows(("u",), iter([row(2, "d")]), None)) == [] and h.moves == [("register", 5000)]
    assert len(list(p.handleInputRows(("u",), iter([row(7_000_000, "d")]), None))) == 1 and h.timers == {12_000}
    h.timers.clear()
    assert list(p.handleExpiredTimer(("u",), None, SimpleNamespace())) == [] and "last" not in h.values


def refusing(every, log=None):
    """A store that refuses records whose number divides by `every`, and writes the others' numbers to a file of the task."""

    def connect():
        def put(record):
            number = int(record[0]["ValueAsString"])
            assert [f["FeatureName"] for f in record] == ["k", "v"]
            if every and number % every == 0:
                raise ConnectionError(f"refused {number}")
            if log:
                with open(f"{log}/{os.getpid()}", "a") as f:
                    f.write(f"{number} {record[1]['ValueAsString']}\n")

        return put

    return connect


def test_budget_over_all_tasks(spark, tmp_path):
    rows = spark.range(1, 1001, numPartitions=7).select(F.col("id").alias("k"), F.when(F.col("id") % 2 == 0, F.col("id") / 2).alias("v"))
    (tmp_path / "log").mkdir()
    assert features.write(rows, refusing(25, str(tmp_path / "log"))) == (960, 40)  # 4 %
    seen = dict(line.rstrip("\n").split(" ") for f in (tmp_path / "log").iterdir() for line in f.read_text().splitlines(keepends=True))
    assert len(seen) == 960 and seen["2"] == "1.0" and seen["1"] == ""
    with pytest.raises(features.BudgetExceeded, match="62 of 1000 .*refused"):
        features.write(rows, refusing(16))  # 6 %
    few = features.put_records(rows, refusing(0), batch=100).collect()
    assert sum(r.sent for r in few) == 1000 and all(r.sent <= 100 and r.error is None for r in few)
    assert features.write(rows.limit(0), refusing(1)) == (0, 0)


def test_a_stream_beyond_the_budget_fails_and_goes_on(spark, tmp_path):
    rows = spark.range(1, 101).select(F.col("id").alias("k"), F.lit("v").alias("v"))
    rows.write.parquet(str(tmp_path / "in"))
    stream = lambda: spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    with pytest.raises(StreamingQueryException, match="records failed"):
        features.feature_sink(stream(), refusing(10), str(tmp_path / "ck"), "features-a").awaitTermination()
    (tmp_path / "log").mkdir()
    features.feature_sink(stream(), refusing(50, str(tmp_path / "log")), str(tmp_path / "ck"), "features-b").awaitTermination()
    assert sum(len(f.read_text().splitlines()) for f in (tmp_path / "log").iterdir()) == 98
