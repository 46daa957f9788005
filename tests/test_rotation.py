"""Files by hour: closed by rows and event time, packed when the hour is over, read once."""

import time
from datetime import datetime, timedelta

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lakeloom.streaming import rotation, sinks

T0 = datetime(2024, 1, 10, 9)
SCHEMA = "event_id string, event_ts timestamp, note string"


def rows(lo, hi, minute):
    return [(f"e{k}", T0 + timedelta(minutes=minute(k)), "x" * 20) for k in range(lo, hi)]


def files(path, kind):
    return {str(f.relative_to(path)): f for f in (path / kind).rglob("*.parquet")}


@pytest.fixture
def written(spark, tmp_path):
    """Two batches over four hours; the second has rows of the first hour too."""
    batches = [rows(0, 300, lambda k: k * 0.4), rows(300, 520, lambda k: 120 + (k - 300) * 0.5) + rows(520, 530, lambda k: 5 + k * 0.01)]
    for b in batches:
        spark.createDataFrame(b, SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        time.sleep(0.02)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    rotation.rotated(stream, f"{tmp_path}/out", f"{tmp_path}/ck", "rotation", rows=25, span_s=600).awaitTermination()
    return tmp_path, [r for b in batches for r in b], stream


def check(spark, path, want):
    got = sorted((r.event_id, r.event_ts, r.note, r.event_date, r.event_hour) for r in rotation.read(spark, f"{path}/out").collect())
    assert got == sorted((i, t, n, t.date(), t.hour) for i, t, n in want)


def test_files_are_closed_by_rows_and_time(spark, written):
    path, want, _ = written
    check(spark, path, want)
    for name, f in files(path / "out", "open").items():
        t = pq.ParquetFile(f).read()
        times = [x.as_py().replace(tzinfo=None) for x in t.column("event_ts")]
        assert t.num_rows <= 25 and max(times) - min(times) < timedelta(seconds=600), name
        assert all(f"event_date={x.date()}/event_hour={x.hour}/" in name for x in times)


def test_packing_touches_hours_that_are_over(spark, written):
    path, want, stream = written
    out = path / "out"
    before = files(out, "open")
    assert rotation.pack(spark, f"{path}/out", T0 + timedelta(hours=2)) == 2
    check(spark, path, want)
    packed = files(out, "packed")
    assert len(packed) == 2 and {n.split("/")[3] for n in packed} == {"event_hour=9", "event_hour=10"} and sum(pq.ParquetFile(f).metadata.num_rows for f in packed.values()) == 310
    assert files(out, "open") == before  # the others' files are as they were
    assert rotation.pack(spark, f"{path}/out", T0 + timedelta(hours=2)) == 0  # nothing is new
    # rows that come for a packed hour
    late = rows(600, 610, lambda k: 70 + k * 0.01)
    spark.createDataFrame(late, SCHEMA).coalesce(1).write.mode("append").parquet(f"{path}/in")
    rotation.rotated(stream, f"{path}/out", f"{path}/ck", "rotation-late", rows=25, span_s=600).awaitTermination()
    check(spark, path, want + late)
    assert rotation.pack(spark, f"{path}/out", T0 + timedelta(hours=2)) == 1
    check(spark, path, want + late)
    assert {n.split("/")[3] for n in files(out, "packed") if "pack=1" in n} == {"event_hour=10"}


def test_packed_files_have_the_target_size(spark, tmp_path):
    big = spark.range(40_000).select(F.col("id").cast("string").alias("event_id"), F.lit(T0).cast("timestamp").alias("event_ts"), F.sha2(F.col("id").cast("string"), 256).alias("note"))
    big.repartition(16).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in")
    rotation.rotated(stream, f"{tmp_path}/out", f"{tmp_path}/ck", "rotation-size", rows=2000).awaitTermination()
    sizes = [f.stat().st_size for f in files(tmp_path / "out", "open").values()]
    target = sum(sizes) // 3
    assert len(sizes) >= 20 and rotation.pack(spark, f"{tmp_path}/out", T0 + timedelta(days=1), target) == 1
    packed = [f.stat().st_size for f in files(tmp_path / "out", "packed").values()]
    assert 3 <= len(packed) <= 4 and all(0.4 * target < s < 1.3 * target for s in packed)
    assert rotation.read(spark, f"{tmp_path}/out").select("event_id").distinct().count() == 40_000


def test_a_packing_that_stops_changes_nothing(spark, written):
    """Files of a pack that isn't in the list of packs don't count, and the next packing writes over them."""
    path, want, _ = written
    spark.createDataFrame(want[:5], SCHEMA).withColumns({"event_date": F.to_date("event_ts"), "event_hour": F.hour("event_ts")}).write.partitionBy("event_date", "event_hour").parquet(f"{path}/out/packed/pack=0")
    check(spark, path, want)
    assert rotation.pack(spark, f"{path}/out", T0 + timedelta(hours=9)) == 4
    check(spark, path, want)


def test_no_batch(spark, tmp_path):
    assert rotation.pack(spark, str(tmp_path), T0) == 0
    with pytest.raises(FileNotFoundError):
        rotation.read(spark, str(tmp_path))
    assert sinks.read_batches(spark, str(tmp_path), SCHEMA).count() == 0
