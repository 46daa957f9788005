"""The change stream's history: out of order, repeated, stale, deleted, tombstones; and the messages it comes from."""

import random
import time
from datetime import datetime, timedelta

from pyspark.sql import Row
from pyspark.sql import functions as F
from test_streams import Handle

from lakeloom.operators import ingest, merge
from lakeloom.streaming import history, sinks

DAY = 86_400_000_000


def change(lsn, day, op="u", status="s"):
    return Row(order_id="o", cdc_lsn=lsn, at_us=day * DAY, cdc_op=op, user_id="u", status=status, total_amount_usd=1.5)


def started():
    p, h = history.HistoryBuilder(), Handle()
    p.init(h)
    return p, h, lambda *rows: list(p.handleInputRows(("o",), iter(rows), None))


def test_versions_leave_in_the_order_of_the_log():
    p, h, give = started()
    assert give(change(3, 3, "d", "shipped"), change(1, 1, "c", "pending")) == [] and give(change(2, 2, status="paid"), change(2, 2, status="paid"), change(9, 9, None)) == []
    assert h.timers == {d * 86_400_000 for d in (1, 2, 3)}  # one for each change that waits
    assert [(r.record_version, r.cdc_lsn, r.status, r.prev_status) for r in h.fire(p, 2 * 86_400_000)] == [(1, 1, "pending", None), (2, 2, "paid", "pending")]
    assert give(change(2, 2, status="again"), change(1, 5)) == []  # repeated and stale: neither waits
    assert h.timers == {3 * 86_400_000}
    assert [(r.record_version, r.status, r.prev_status) for r in h.fire(p, 10**10)] == [(3, "deleted", "paid")]
    assert "waiting" not in h.values and not h.timers and h.values["last"] == (3, 3, "deleted")
    give(change(4, 8, "t"), change(5, 9, "c", "reopened"))
    assert [(r.record_version, r.status, r.prev_status) for r in h.fire(p, 10**10)] == [(4, "reopened", "deleted")]


def test_a_stream_of_shuffled_changes(spark, tmp_path):
    """Five batches in any order give the history of the batch merge."""
    r, t0, path = random.Random(7), datetime(2024, 1, 1), str(tmp_path)
    rows = []
    for o in range(25):
        for v in range(r.randint(1, 6)):
            rows.append((f"o{o}", f"u{o}", r.choice(["paid", "sent"]), float(v), "d" if v == 5 else "u" if v else "c", 10 * o + v, t0 + timedelta(days=v, minutes=o)))
    schema = "order_id string, user_id string, status string, total_amount_usd double, cdc_op string, cdc_lsn long, changed_at timestamp"
    mixed = rows + r.sample(rows, 20)
    r.shuffle(mixed)
    for k in range(0, len(mixed), len(mixed) // 4):
        spark.createDataFrame(mixed[k : k + len(mixed) // 4], schema).coalesce(1).write.mode("append").parquet(f"{path}/in")
        time.sleep(0.02)
    spark.createDataFrame([(None, None, None, None, None, None, t0 + timedelta(days=60))], schema).coalesce(1).write.mode("append").parquet(f"{path}/in")
    made = history.versions(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in"), "10 days")
    sinks.exactly_once(made, f"{path}/out", f"{path}/ck", "history-test").awaitTermination()
    found = history.laid_out(sinks.read_batches(spark, f"{path}/out", made.schema))
    columns = ["order_id", "status", "total_amount_usd", "cdc_lsn", "effective_from", "effective_to", "is_current", "record_version", "prev_status"]
    empty = spark.createDataFrame([], "order_id STRING, user_id STRING, status STRING, total_amount_usd DOUBLE, cdc_lsn BIGINT, effective_from TIMESTAMP, effective_to TIMESTAMP, is_current BOOLEAN, record_version INT, prev_status STRING")
    want = merge.scd2(empty, spark.createDataFrame(rows, schema), keep_all=True)
    assert sorted(map(tuple, found.select(columns).collect()), key=str) == sorted(map(tuple, want.select(columns).collect()), key=str)


def test_tombstones_and_rewritten_deletes(spark):
    body = lambda op, **images: '{"op": "%s", "ts_ms": 1000, "source": {"lsn": 5, "table": "orders"}%s}' % (op, "".join(f', "{k}": {{"order_id": "{v}"}}' for k, v in images.items()))  # noqa: E731, UP031
    rows = [("1", "prod.public.orders", body("c", after="1")), ("2", "prod.public.orders", body("d", before="2")), ("2", "prod.public.orders", None), ("3", "prod.public.users", None), ("4", None, None)]
    raw = spark.createDataFrame(rows, "key string, topic string, value string")
    got = sorted((r.order_id, r.cdc_op, r.deleted, r.cdc_lsn) for r in ingest.unwrap_cdc(raw, "orders", key="key", topic="topic").collect())
    assert got == [("1", "c", False, 5), ("2", "d", True, 5), ("2", "t", True, None)]
    assert ingest.unwrap_cdc(raw, "orders").where(F.col("cdc_op") == "t").count() == 0
