"""Operators on small hand-made rows: thresholds, edges, nulls."""

import hashlib
import hmac
import json
import re
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lakeloom.functions import constants as C
from lakeloom.functions import core
from lakeloom.operators import fraud, ingest, merge, quality, sessions, silver, suites
from lakeloom.plans import registry, stored
from lakeloom.sources import connectors
from lakeloom.sources.tables import Bookmark, Conflict, SnapshotTable
from lakeloom.streaming import jobs, stateful

T0 = datetime(2024, 1, 15, 14)


def one(spark, **cols):
    return spark.range(1).select(*[c.alias(n) for n, c in cols.items()]).first()


@pytest.mark.parametrize("salt", ["s", "x" * 100])
def test_hmac(spark, salt):
    values = ["user-abc", "", "é한🙂", None]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = {r.i: (r.h, r.e) for r in rows.select("i", core.hmac_sha256(F.col("v"), salt).alias("h"), core.hmac_sha256(F.col("v"), salt, empty_is_null=True).alias("e")).collect()}
    for i, v in enumerate(values):
        want = None if v is None else hmac.new(salt.encode(), v.encode(), hashlib.sha256).hexdigest()
        assert got[i] == (want, want or None if v else None)


def test_regions_and_masks(spark):
    cases = {"US": "AMER", "MX": "AMER", "GB": "EMEA", "IN": "APAC", "BR": "LATAM", "ZZ": "OTHER", None: "UNKNOWN"}
    rows = spark.createDataFrame([(c,) for c in cases], "c string").select("c", core.region(F.col("c")).alias("r"), core.masked_city(F.lit("Town"), F.col("c")).alias("m")).collect()
    assert {r.c: r.r for r in rows} == cases
    assert {r.c for r in rows if r.m == "MASKED"} == {"GB"}


def test_bands_tags_and_codes(spark):
    rows = spark.createDataFrame([(24.99, '["A ", "", "b"]', "BOOKS"), (25.0, "x", None), (299.99, None, "toys"), (300.0, "[]", "cars"), (None, '{"a":1}', "Other")], "p double, t string, c string")
    got = rows.select(core.price_band(F.col("p")).alias("b"), core.parse_tags(F.col("t")).alias("t"), core.encode_category(F.col("c"), C.CATEGORY_CODES).alias("c")).collect()
    assert [r.b for r in got] == ["budget", "mid", "premium", "luxury", "unknown"]
    assert [r.t for r in got] == [["a", "b"], [], [], [], []] and [r.c for r in got] == [4, 9, 6, 9, 9]


def test_event_times(spark):
    rows = spark.createDataFrame([("2024-06-15T10:00:00.123456Z",), ("2024-06-15T10:00:00+02:00",), ("2024-06-15T10:00:00",), ("junk",), (None,)], "t string")
    got = [r.x for r in rows.select(core.parse_event_time(F.col("t"), F.lit("2000-01-01").cast("timestamp")).cast("string").alias("x")).collect()]
    assert got == ["2024-06-15 10:00:00.123456", "2024-06-15 08:00:00", "2024-06-15 10:00:00", "2000-01-01 00:00:00", "2000-01-01 00:00:00"]


def test_local_hour_falls_back(spark):
    at = F.lit("2024-06-15 03:00:00").cast("timestamp")
    r = one(spark, a=core.local_hour(at, F.lit("America/New_York")), b=core.local_hour(at, F.lit(None).cast("string")), c=core.local_hour(at, F.lit("not a zone")))
    assert (r.a, r.b, r.c) == (23, 3, 3)


def wire(**over):
    event = {"event_id": "e", "user_id": "u", "timestamp": "2024-01-01T00:00:00Z", "event_type": "purchase", "product": {"price_usd": 1.0}, "geo": {"country": "US"}} | over
    return json.dumps(event)


def test_validation_order_and_dead_letters(spark):
    lines = [wire(), wire(event_id=""), wire(user_id=None), wire(timestamp=None), wire(event_type="x"), wire(product={"price_usd": 0.001}), wire(product={"price_usd": 50000.0}), wire(product=None), wire(geo=None), "[1]", "{", None, wire(timestamp="junk")]
    raw = spark.createDataFrame([(x,) for x in lines], "value string")
    good, dead = ingest.split(raw, F.lit("2024-01-02").cast("timestamp"))
    assert sorted(str(r.dq_flag) for r in good.collect()) == ["None"] * 3 + ["WARNING"] * 3
    assert sorted(r.reason for r in dead.collect()) == sorted(["malformed JSON"] * 3 + ["event_id missing", "user_id missing", "timestamp missing", "event_type unknown"])


def test_unwanted_rows_are_null_safe(spark):
    rows = spark.createDataFrame([(1, None, None, None), (2, True, False, None), (3, False, None, "CRITICAL"), (4, False, False, "WARNING")], "i int, is_bot boolean, is_internal boolean, dq_flag string")
    assert [r.i for r in silver.drop_unwanted(rows).collect()] == [1, 4]


def test_latest_forms_agree(spark):
    rows = spark.createDataFrame([(k % 7, k % 5, k) for k in range(60)] + [(None, 1, 2), (None, 3, 1)], "key int, at int, v int")
    a = silver.latest(rows, ["key"], [F.desc("at"), F.desc("v")])
    assert sorted(map(str, a.collect())) == sorted(map(str, silver.latest_wide(rows, ["key"], ["at", "v"]).collect()))


EVENT = "event_id string, user_id string, event_ts timestamp, event_type string, geo_country string, product_quantity int, seq long"


def scored(spark, rows):
    df = spark.createDataFrame([(f"e{i}", "u", T0 + timedelta(seconds=s), t, c, q, i) for i, (s, t, c, q) in enumerate(rows)], EVENT)
    return [(r.fraud_score, r.fraud_signals) for r in fraud.score(df).orderBy("seq").collect()]


@pytest.mark.parametrize(
    ("rows", "want"),
    [
        ([(i, "page_view", "US", 1) for i in range(22)], (0.4, ["VELOCITY_SPIKE"])),
        ([(i, "page_view", "US", 1) for i in range(21)], (0.0, [])),
        ([(0, "page_view", "US", 1), (5, "page_view", "GB", 1)], (0.5, ["GEO_HOP"])),
        ([(0, "page_view", "US", 1), (5, "page_view", "", 1), (6, "page_view", None, 1), (7, "page_view", "GB", 1)], (0.5, ["GEO_HOP"])),
        ([(13 * 3600, "purchase", "US", 1)], (0.2, ["UNUSUAL_HOUR"])),
        ([(0, "product_view", "US", 1), (20, "purchase", "US", 1)], (0.35, ["RAPID_PURCHASE"])),
        ([(0, "product_view", "US", 1), (30, "purchase", "US", 1)], (0.0, [])),
        ([(0, "add_to_cart", "US", 99)], (0.25, ["CART_OVERFLOW"])),
        ([(0, "add_to_cart", "US", 50)], (0.0, [])),
        ([(i, "page_view", "US", 1) for i in range(22)] + [(23, "add_to_cart", "GB", 60)], (1.0, ["VELOCITY_SPIKE", "GEO_HOP", "CART_OVERFLOW"])),
        ([(i, "page_view", "US", 1) for i in range(22)] + [(21 + 900, "page_view", "GB", 1)], (0.5, ["GEO_HOP"])),
    ],
)
def test_fraud_rules(spark, rows, want):
    assert scored(spark, rows)[-1] == want


def session_rows(spark, rows):
    schema = "user_id_hashed string, event_ts timestamp_ntz, event_type string, product_price_usd double, product_quantity int, device_type string, geo_country string, ab_cohort string, page_referrer string, fraud_score double, seq long"
    df = spark.createDataFrame([("u", T0 + timedelta(seconds=s), t, p, q, "mobile", None, "A", "ref", f, i) for i, (s, t, p, q, f) in enumerate(rows)], schema)
    return sessions.summarise(sessions.stitch(df)).orderBy("session_start_ts").collect()


def test_session_gap_and_metrics(spark):
    rows = [(0, "page_view", None, None, 0.1), (899, "add_to_cart", 50.0, 2, 0.7), (890, "remove_from_cart", 50.0, 3, 0.0), (899 + 900, "purchase", 29.99, 5, None), (1800, "checkout_start", None, None, None), (1801, "checkout_start", None, None, None)]
    a, b = session_rows(spark, rows)
    assert (a.event_count, a.cart_value_usd, a.cart_abandonment, a.funnel_stage_reached, a.fraud_flagged, a.session_duration_s, a.exit_event_type) == (3, 50.0, True, "add_to_cart", True, 899, "add_to_cart")
    assert (b.revenue_attributed_usd, b.purchases, b.checkout_attempts, b.funnel_stage_reached, b.geo_country, b.cart_abandonment) == (29.99, 1, 2, "purchase", None, False)
    assert session_rows(spark, [(0, "remove_from_cart", 5.0, 1, None)])[0].cart_value_usd == 0.0


HISTORY = "order_id string, status string, cdc_lsn long, effective_from timestamp, effective_to timestamp, is_current boolean, record_version int, prev_status string"


def test_history(spark):
    changes = lambda *r: spark.createDataFrame([(*x, T0 + timedelta(minutes=x[2])) for x in r], "order_id string, status string, cdc_lsn long, cdc_op string, changed_at timestamp")
    h = merge.scd2(spark.createDataFrame([], HISTORY), changes(("a", "pending", 1, "c"), ("b", "pending", 1, "c")))
    h = merge.scd2(h, changes(("a", "confirmed", 3, "u"), ("a", "shipped", 5, "u"), ("b", "x", 1, "u"), ("b", "y", 0, "u")))
    rows = {(r.order_id, r.record_version): r for r in h.collect()}
    assert set(rows) == {("a", 1), ("a", 2), ("b", 1)} and rows["a", 2].status == "shipped" and rows["a", 2].prev_status == "pending"
    assert not rows["a", 1].is_current and rows["a", 1].effective_to == rows["a", 2].effective_from and rows["b", 1].status == "pending"
    gone = merge.scd2(h, changes(("b", "pending", 9, "d")), keep_all=True).where("order_id = 'b' and is_current").first()
    assert gone.status == "deleted" and gone.record_version == 2
    assert quality.scd2_integrity(h).count() == 0
    broken = h.unionByName(h.where("is_current"))
    assert {r.check for r in quality.scd2_integrity(broken).collect()} >= {"duplicate_current"}


def test_expectations(spark):
    rows = spark.createDataFrame([(i, "v" if i % 20 else None, float(i)) for i in range(100)] + [(0, "w", None)], "id int, s string, x double")
    suite = [quality.Expect("not_null", "s", mostly=0.95), quality.Expect("unique", "id"), quality.Expect("in_set", "s", ("v",), mostly=0.9), quality.Expect("between", "x", low=0, high=98, level="warning"), quality.Expect("row_count", low=1, high=101), quality.Expect("match_regex", "s", ("^[vw]$",))]
    got = {r.name: (r.seen, r.unexpected, r.success) for r in quality.run(rows, suite).collect()}
    assert got == {"critical:not_null:s": (101, 5, True), "critical:unique:id": (101, 2, False), "critical:in_set:s": (96, 1, True), "warning:between:x": (100, 1, False), "critical:row_count:table": (101, 0, True), "critical:match_regex:s": (96, 0, True)}
    total = quality.passed(quality.run(rows, suite)).first()
    assert (total.success, total.evaluated, total.failed, total.warnings) == (False, 6, 2, 1)
    empty = quality.run(rows.where("false"), suite).where("name like '%row_count%'").first()
    assert not empty.success


def test_suites_on_known_rows(spark):
    """Each expectation of the order suites broken by a known number of rows, counted by hand."""
    good = ("o1", "u", T0, True, "pending", "c", 10.0, 9.0, 1.0, 1, 2, 5, T0, 0.5, "card")
    names = "order_id user_id_hashed effective_from is_current status cdc_op total_amount_usd net_amount_usd discount_usd record_version item_count cdc_lsn processed_at fraud_score payment_method".split()
    types = "string string timestamp boolean string string double double double int int long timestamp double string".split()
    bad = [{"order_id": " "}, {"order_id": None}, {"user_id_hashed": None}, {"effective_from": None}, {"is_current": None}, {"status": "lost"}, {"status": "deleted"}, {"cdc_op": "x"}, {"cdc_op": "r"}, {"total_amount_usd": -0.01}, {"total_amount_usd": 100_001.0}]
    bad += [{"net_amount_usd": -1.0}, {"discount_usd": 100_000.0}, {"discount_usd": 100_000.5}, {"record_version": 0}, {"record_version": 51}, {"item_count": 501}, {"item_count": 0}, {"cdc_lsn": -1}, {"processed_at": None}, {"fraud_score": 1.01}, {"payment_method": None}]
    rows = [good] + [tuple((dict(zip(names, good)) | b)[n] for n in names) for b in bad]
    df = spark.createDataFrame(rows, ", ".join(f"{n} {t}" for n, t in zip(names, types)))
    got = {r.name: (r.unexpected, r.success) for r in quality.run(df, suites.SILVER_CRITICAL + suites.SILVER_WARNING).collect()}
    n = len(rows)
    want = {"not_null:order_id": 1, "not_null:user_id_hashed": 1, "not_null:effective_from": 1, "not_null:is_current": 1, "not_match_regex:order_id": 1, "in_set:status": 1, "in_set:cdc_op": 1, "between:total_amount_usd": 1, "between:net_amount_usd": 1, "between:discount_usd": 1, "in_set:is_current": 0, "between:record_version": 2, "row_count:table": 0}
    assert {k: v[0] for k, v in got.items() if k.startswith("critical")} == {f"critical:{k}": v for k, v in want.items()}
    assert all(got[f"critical:{k}"][1] == (v == 0) for k, v in want.items())
    warned = {"between:total_amount_usd": 2, "between:item_count": 2, "between:cdc_lsn": 1, "not_null:processed_at": 1, "between:fraud_score": 1, "not_null:payment_method": 1}
    assert {k: v for k, v in got.items() if k.startswith("warning")} == {f"warning:{k}": (v, k == "not_null:payment_method" and v <= 0.1 * n) for k, v in warned.items()}


def test_integrity_finds_each_fault(spark):
    day = lambda d: T0 + timedelta(days=d)
    rows = [("ok", day(0), day(1), False, 1), ("ok", day(1), None, True, 2), ("twice", day(0), None, True, 1), ("twice", day(1), None, True, 2), ("back", day(2), day(1), False, 1), ("same", day(1), day(1), False, 1), ("gap", day(0), day(1), False, 1), ("gap", day(1), None, True, 3)]
    df = spark.createDataFrame(rows, "order_id string, effective_from timestamp, effective_to timestamp, is_current boolean, record_version int")
    assert sorted((r.check, r.order_id) for r in quality.scd2_integrity(df).collect()) == [("bad_interval", "back"), ("bad_interval", "same"), ("duplicate_current", "twice"), ("version_gap", "gap")]


def test_classifier_metrics(spark):
    rows = [(0.9, 1), (0.8, 0), (0.8, 1), (0.5, 1), (0.4, 0), (0.4, 1), (0.1, 0), (0.1, 0)]
    got = quality.classifier_metrics(spark.createDataFrame(rows, "s double, y int"), ranges=3).first()
    pairs = [(a, b) for a, y in rows if y for b, z in rows if not z]
    auc = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a, b in pairs) / len(pairs)
    ap = (1 / 1 + 2 / 3 + 3 / 4 + 4 / 6) / 4
    assert (got.auc, got.precision_at_half, got.recall_at_half, got.error, got.average_precision) == (round(auc, 6), 0.75, 0.75, 0.25, round(ap, 6))


def test_snapshot_table(spark, tmp_path):
    now = [1000]
    t = SnapshotTable(spark, str(tmp_path / "t"), clock=lambda: now[0])
    rows = lambda *r: spark.createDataFrame(r, "k int, v string")
    assert t.head() is None and t.current_id() == 0
    a = t.append(rows((1, "a"), (2, "b")), stream=("q", 0))
    assert t.append(rows((1, "a"), (2, "b")), stream=("q", 0)) == a
    b = t.append(rows((3, "c")), stream=("q", 1))
    assert t.read().count() == 3 and t.read(a).count() == 2 and t.read_between(a).first().k == 3 and t.read_between(b).count() == 0
    m = t.merge(rows((2, "B"), (4, "d")), ["k"])
    assert sorted((r.k, r.v) for r in t.read().collect()) == [(1, "a"), (2, "B"), (3, "c"), (4, "d")]
    assert {f["added"] for f in t.head()["files"]} == {b, m}, "the folder without a match is kept"
    assert t.read_between(a).count() == 1
    t.add_column("w", "double")
    t.rename_column("v", "name")
    assert t.add_column("w", "double") == t.current_id() and t.rename_column("x", "y") == t.current_id()
    assert t.read().columns == ["k", "name", "w"] and t.read(a).columns == ["k", "v"]
    t.branch("fix")
    t.overwrite(rows((9, "z")), branch="fix")
    assert t.read().count() == 4 and t.read(branch="fix").count() == 1
    t.fast_forward("fix")
    assert t.read().first().k == 9
    now[0] += 10 * 86400
    t.append(rows((10, "y")))
    t.compact()
    assert t.expire(5) and t.read().count() == 2
    mark = Bookmark(spark, str(tmp_path / "mark"))
    assert mark.get() == 0
    mark.put(7)
    mark.put(8)
    assert mark.get() == 8


def test_reads_between_survive_maintenance(spark, tmp_path):
    rows = lambda lo, hi: spark.range(lo, hi).select(F.col("id").alias("k"), (F.col("id") % 2).alias("day"))
    keys = lambda df: sorted(r.k for r in df.collect())
    for name, maintain in (("c", lambda t: t.compact()), ("m", lambda t: t.merge(rows(0, 4), ["k"])), ("a", lambda t: t.add_column("w", "int"))):
        t = SnapshotTable(spark, str(tmp_path / name))
        first = t.append(rows(0, 2), partition_by=["day"])
        t.append(rows(2, 5), partition_by=["day"])
        maintain(t)
        last = t.append(rows(5, 6), partition_by=["day"])
        assert keys(t.read_between(first)) == [2, 3, 4, 5] and keys(t.read_between(first, last - 1)) == [2, 3, 4] and keys(t.read()) == [0, 1, 2, 3, 4, 5], name
        assert all(f["parts"] == ["day"] for f in t.head()["files"])
    now = [0]
    t = SnapshotTable(spark, str(tmp_path / "e"), clock=lambda: now[0])
    first = t.append(rows(0, 1))
    t.append(rows(1, 2))
    now[0] += 10 * 86400
    t.append(rows(2, 3))
    t.expire(5)
    with pytest.raises(ValueError, match="expired"):
        t.read_between(first)


def test_two_writers(spark, tmp_path):
    """Appends that race are both kept; a merge that another commit came before raises and changes nothing."""
    path = str(tmp_path / "t")
    SnapshotTable(spark, path).append(spark.range(5))
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda k: SnapshotTable(spark, path).append(spark.range(10 * k, 10 * k + 3)), range(1, 7)))
    t = SnapshotTable(spark, path)
    assert t.read().count() == 5 + 6 * 3 and t._numbers() == list(range(1, 8))
    plain = t._write

    def slow(*given):
        SnapshotTable(spark, path).append(spark.range(100, 102))  # another writer, while this one writes
        return plain(*given)

    t._write = slow
    for change in (lambda: t.merge(spark.range(3), ["id"]), lambda: t.overwrite(spark.range(1)), t.compact):
        before = SnapshotTable(spark, path).read().count()
        with pytest.raises(Conflict):
            change()
        assert SnapshotTable(spark, path).read().count() == before + 2


def test_merge_scans_once(spark, tmp_path):
    """Jobs of a merge don't grow with the folders."""
    t = SnapshotTable(spark, str(tmp_path / "t"))
    for k in range(8):
        t.append(spark.range(10 * k, 10 * k + 10))
    parts = t._scan(t.head(), t.head()["files"])._jdf.queryExecution().executedPlan().toString()
    assert parts.count("FileScan parquet") == 1
    t.merge(spark.range(35, 45).select("id"), ["id"])
    assert sorted(r.id for r in t.read().collect()) == list(range(80)) and len(t.head()["files"]) == 7


def test_feature_store_skips_repeats(spark, tmp_path):
    t = SnapshotTable(spark, str(tmp_path / "f"))
    rows = lambda *r: spark.createDataFrame([(u, T0 + timedelta(seconds=s), x) for u, s, x in r], "user_id_hashed string, feature_timestamp timestamp, x double")
    t.append(rows(("a", 0, 1.0), ("b", 0, 1.0), ("c", 0, 1.0)))
    connectors.feature_put(t, rows(("a", 3, 1.0), ("b", 3, 2.0), ("c", 9, 1.0), ("d", 1, 5.0), ("d", 0, 4.0), ("b", -5, 9.0)))
    got = {r.user_id_hashed: (r.feature_timestamp - T0).seconds for r in t.read().collect()}
    assert got == {"a": 0, "b": 3, "c": 9, "d": 1} and connectors.feature_get(t, "d").first().x == 5.0


def test_model_csv(spark, tmp_path):
    n = len(C.MODEL_FEATURES)
    (tmp_path / "ok").mkdir()
    (tmp_path / "ok" / "a.csv").write_text(",".join(["1"] * n) + ",0\n" + ",".join(["2.5"] * n) + ",1\n")
    assert [r.label for r in connectors.model_csv(spark, str(tmp_path / "ok")).collect()] == [0, 1]
    (tmp_path / "ok" / "b.csv").write_text("1,2,3\n")
    with pytest.raises(Exception):  # noqa: B017
        connectors.model_csv(spark, str(tmp_path / "ok")).collect()


def test_bronze_stream_replays_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("\n".join([wire(event_id=f"e{i}") for i in range(5)] + ["{bad"]))
    table, dead = SnapshotTable(spark, str(tmp_path / "b")), SnapshotTable(spark, str(tmp_path / "d"))
    run = lambda: jobs.bronze(connectors.file_source(spark, str(tmp_path / "in")), table, dead, str(tmp_path / "ck"), "bronze-test").awaitTermination()
    run()
    (tmp_path / "in" / "b.txt").write_text(wire(event_id="late"))
    run()
    run()
    assert table.read().count() == 6 and dead.read().count() == 1
    jobs.bronze(connectors.file_source(spark, str(tmp_path / "in"), 10), table, dead, str(tmp_path / "ck2"), "bronze-test").awaitTermination()
    assert table.read().count() == 6, "a batch number that is in the table is not written again"


def test_fraud_stream_keeps_state_between_batches(spark, tmp_path):
    (tmp_path / "in").mkdir()
    rows = [(f"e{i}", f"u{i % 2}", T0 + timedelta(seconds=40 * i), "add_to_cart" if i % 3 else "product_view", "US" if i % 4 else "GB", 60 if i % 5 == 0 else 1, i) for i in range(40)]
    for part in range(4):
        spark.createDataFrame(rows[10 * part : 10 * part + 10], EVENT).coalesce(1).write.mode("append").parquet(str(tmp_path / "in" / f"p={part}"))
    stream = spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
    table, alerts = SnapshotTable(spark, str(tmp_path / "s")), SnapshotTable(spark, str(tmp_path / "a"))
    jobs.fraud_alerts(stateful.fraud_scores(stream), table, alerts, str(tmp_path / "ck"), "fraud-test").awaitTermination()
    want = {r.event_id: (r.fraud_score, ",".join(r.fraud_signals)) for r in fraud.score(spark.createDataFrame(rows, EVENT)).collect()}
    assert {r.event_id: (r.fraud_score, r.fraud_signals) for r in table.read().collect()} == want
    assert alerts.read().count() == sum(s >= 0.7 for s, _ in want.values())


def test_fraud_stream_takes_the_users_hour(spark, tmp_path):
    zones = ["America/New_York", "Asia/Tokyo", None, "not a zone", "Europe/Berlin"]
    rows = [(f"e{h}-{z}", f"u{h}-{z}", T0.replace(hour=h), "purchase", "US", 1, h, z) for h in (1, 2, 3, 7, 17) for z in zones]
    df = spark.createDataFrame(rows, EVENT + ", geo_timezone string")
    df.write.parquet(str(tmp_path / "in"))
    table, alerts = SnapshotTable(spark, str(tmp_path / "s")), SnapshotTable(spark, str(tmp_path / "a"))
    jobs.fraud_alerts(stateful.fraud_scores(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))), table, alerts, str(tmp_path / "ck"), "hours").awaitTermination()
    got = {r.event_id: r.fraud_signals for r in table.read().collect()}
    assert got == {r.event_id: ",".join(r.fraud_signals) for r in fraud.score(df).collect()} and set(got.values()) == {"", "UNUSUAL_HOUR"}


def test_lookup_remembers_and_fails_open(spark, tmp_path):
    log = str(tmp_path / "asked")

    def endpoint(features):
        with open(log, "a") as f:
            f.write(features["user_id"] + "\n")
        if features["user_id"] == "down":
            raise ConnectionError
        return {"a": 0.1, "b": 0.6, "c": 0.9}[features["user_id"]]

    rows = spark.createDataFrame([(i, u) for i, u in enumerate(["a", "b", "a", None, "", "down", "c", "a", "down", "b"])], "i int, user_id string").coalesce(1)
    got = {r.i: (r.churn_score, r.churn_segment) for r in jobs.lookup_scores(rows, endpoint).collect()}
    a, b, c, none = (0.1, "stable"), (0.6, "at_risk"), (0.9, "high_churn"), (None, None)
    assert [got[i] for i in range(10)] == [a, b, a, none, none, none, c, a, none, b]
    assert sorted(open(log).read().split()) == ["a", "b", "c", "down"]


def test_each_table_reads_the_events_once(spark, sf):
    """No table of the chain scans its source more than once, and models on written tables don't scan it at all."""
    lake = registry.Lake(spark, sf)
    for name in stored.TABLES:
        plan = lake._made(name)._jdf.queryExecution().executedPlan().toString()
        assert len(re.findall(r"events\.parquet\]", plan)) == (1 if name == "silver" else 0), name
    for name in ("features", "agg_daily", "fct_orders"):
        plan = lake.view(name)._jdf.queryExecution().executedPlan().toString()
        assert "events.parquet" not in plan
    assert "PartitionFilters: [isnotnull(order_date" in lake.sql("SELECT order_id FROM fct_orders WHERE order_date = DATE'2024-01-20'")._jdf.queryExecution().executedPlan().toString()


def frames(spark, **tables):
    return {n: spark.createDataFrame(rows, schema) for n, (schema, rows) in tables.items()}.__getitem__


def test_user_dimension_by_hand(spark):
    """Bands at their edges (100, 300, 1000 of spend in 90 days), the latest event's place, signup by order or first visit."""
    day = lambda n: datetime(2024, 1, 31).date() - timedelta(days=n)
    event = "user_id_hashed string, event_type string, event_ts timestamp_ntz, event_date date, product_sku string, geo_country string, geo_region string, device_type string, seq long"
    visit = lambda u, n, sku=None, country="US", seq=1: (u, "purchase" if sku else "page_view", T0.replace(hour=seq), day(n), sku, country, "AMER", "mobile", seq)
    events = [visit("a", 9, "s1"), visit("a", 8, "s1", seq=2), visit("a", 5, "s2", None, seq=3), visit("a", 91, "s3"), visit("a", 91, "s3"), visit("a", 91, "s3"), visit("b", 40), visit("c", 3, "s2"), visit("c", 3, "s1"), visit("d", 1), visit("e", 1), visit(None, 1)]
    orders = [("a", day(90), "shipped", 299.99), ("a", day(91), "shipped", 900.0), ("b", day(10), "confirmed", 300.0), ("c", day(10), "delivered", 1000.0), ("c", day(2), "cancelled", 5.0), ("d", day(1), "pending", 500.0), ("d", day(1), "confirmed", 99.99)]
    get = frames(
        spark, silver=(event, events), silver_orders=("user_id_hashed string, order_date date, status string, total_amount_usd double", orders),
        products=("sku string, category string", [("s1", "books"), ("s2", "art"), ("s3", "toys")]),
    )
    got = {r.user_id_hashed: r for r in stored.user_dimension(get).collect()}
    assert {u: (r.ltv_band, r.spend_90d) for u, r in got.items()} == {"a": ("silver", 299.99), "b": ("gold", 300.0), "c": ("platinum", 1000.0), "d": ("bronze", 99.99), "e": ("bronze", 0.0)}
    assert {u: r.preferred_category for u, r in got.items()} == {"a": "books", "b": None, "c": "art", "d": None, "e": None}
    assert {u: r.signup_date for u, r in got.items()} == {"a": day(91), "b": day(10), "c": day(10), "d": day(1), "e": day(1)}
    assert got["a"].country is None and got["a"].last_active_date == day(5) and all(r.is_current for r in got.values())
    assert got["a"].user_key == hashlib.sha256(b"a").hexdigest()


def test_order_facts_and_days_by_hand(spark):
    """Unknown keys are -1, a cancelled order without amount goes, inactive products have no key; days count each buyer once."""
    day = lambda n: datetime(2024, 1, n).date()
    order = "order_id string, user_id_hashed string, order_date date, total_amount_usd double, item_count int, discount_usd double, net_amount_usd double, order_tier string, days_consideration long, funnel_stage_reached string, attributed_session_id string, fraud_score double, status string, payment_method string, shipping_country string, created_at timestamp_ntz, updated_at timestamp_ntz"
    made = lambda i, u, n, total, status="confirmed", fraud=0.1, session=None, country="US": (f"o{i}", u, day(n), total, 1, 0.0, total, "t", 0, None, session, fraud, status, "card", country, T0, T0)
    orders = [made(1, "a", 1, 10.0, session="s1"), made(2, "a", 2, 20.0), made(3, "b", 2, 30.0, fraud=0.71), made(4, "b", 2, 0.0, "cancelled"), made(5, "b", 2, 5.0, "cancelled"), made(6, None, 2, 40.0, "pending", country="ZZ"), made(7, "b", 2, 0.0, "pending", fraud=0.7)]
    get_one = frames(
        spark, silver_orders=(order, orders), dim_users=("user_id_hashed string, user_key string", [("a", "A"), ("b", "B")]), dim_geography=("country string, geo_key string", [("US", "us")]),
        dim_date=("full_date date, date_key int", [(day(1), 1), (day(2), 2)]), dim_products=("sku string, product_key string, is_active boolean", [("x", "X", True), ("y", "Y", False)]),
        silver=("seq long, event_type string, product_sku string, product_price_usd double", [(1, "purchase", "x", 1.0), (1, "purchase", "y", 0.5), (2, "purchase", "y", 9.0), (3, "purchase", None, 9.0), (6, "page_view", "x", 1.0)]),
        silver_sessions=("session_id string, entry_referrer string, ab_cohort string", [("s1", "https://www.google.com/", None)]),
        dim_channels=("channel_key string, source string, medium string, ab_cohort string", [("paid", "google", "cpc", None), ("found", "google", "organic", None), ("cohort", "google", "organic", "A")]),
    )
    facts = stored.order_facts(get_one).cache()
    got = {r.order_id: (r.user_key, r.product_key, r.channel_key, r.geo_key, r.date_key, r.fraud_flagged) for r in facts.collect()}
    assert got == {
        "o1": ("A", "X", "found", "us", 1, False), "o2": ("A", "-1", "-1", "us", 2, False), "o3": ("B", "-1", "-1", "us", 2, True), "o5": ("B", "-1", "-1", "us", 2, False),
        "o6": ("-1", "-1", "-1", "-1", 2, False), "o7": ("B", "-1", "-1", "us", 2, False),
    }
    days = {r.metric_date: r for r in stored.order_days({"fct_orders": facts}.__getitem__).collect()}
    second = days[day(2)]
    assert (second.total_orders, second.unique_buyers, second.gross_revenue_usd, second.median_order_value_usd, second.flagged_fraud_orders, second.fraud_exposure_usd) == (4, 3, 90.0, 20.0, 1, 30.0)
    assert (second.new_buyers, second.returning_buyers, days[day(1)].new_buyers, days[day(1)].avg_order_value_usd) == (1, 1, 1, 10.0)


def test_hot_users_and_null_users(spark):
    """A third of all orders and sessions under one user, and rows without a user: each order still finds its session."""
    at = lambda m: T0 + timedelta(minutes=m)
    visits = [(f"s{k}", "hot" if k % 3 == 0 else f"u{k}", at(k), "browse") for k in range(300)] + [("n", None, at(1), "browse"), ("z1", "tie", at(5), "a"), ("z0", "tie", at(5), "b")]
    orders = [(f"o{k}", "hot" if k % 3 == 0 else f"u{k}", at(k + k % 50)) for k in range(300)] + [("on", None, at(2)), ("ot", "tie", at(35)), ("ol", "tie", at(36))]
    frames = {
        "silver_sessions": spark.createDataFrame(visits, "session_id string, user_id_hashed string, session_start_ts timestamp_ntz, funnel_stage_reached string"),
        "stg_orders": spark.createDataFrame(orders, "order_id string, user_id_hashed string, created_at timestamp_ntz"),
    }
    got = {r.order_id: r.attributed_session_id for r in stored.attributed_orders(frames.__getitem__).collect()}
    for o, u, t in orders:
        near = [(s, -ord(i[-1]), i) for i, v, s, _ in visits if u is not None and v == u and s <= t <= s + timedelta(minutes=30)]
        assert got[o] == (max(near)[2] if near else None), o
    assert got["ot"] == "z0" and got["ol"] is None and got["on"] is None


def test_stream_stream_join(spark, tmp_path):
    s = spark.createDataFrame([("u", T0, "GEO_HOP")], "user_id string, signal_ts timestamp, signal string")
    e = spark.createDataFrame([("u", "in", T0 - timedelta(minutes=5)), ("u", "old", T0 - timedelta(minutes=50)), ("v", "other", T0)], "user_id string, event_id string, event_ts timestamp")
    s.write.parquet(str(tmp_path / "s"))
    e.write.parquet(str(tmp_path / "e"))
    made = jobs.signals_with_events(spark.readStream.schema(s.schema).parquet(str(tmp_path / "s")), spark.readStream.schema(e.schema).parquet(str(tmp_path / "e")))
    made.writeStream.format("parquet").option("path", str(tmp_path / "o")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    assert [r.event_id for r in spark.read.parquet(str(tmp_path / "o")).collect()] == ["in"]


def test_kafka_is_gated(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        connectors.kafka_source(spark, "h:1", "t", "g")


def test_upsert_null_keys_and_soft_delete(spark):
    cur, new = spark.createDataFrame([(1, "a"), (None, "n")], "k int, v string"), spark.createDataFrame([(None, "N"), (2, "b")], "k int, v string")
    assert sorted((r.v for r in merge.upsert(cur, new, ["k"]).collect())) == ["N", "a", "b"]
    catalog = spark.createDataFrame([("x", True), ("y", True), ("z", False)], "sku string, is_active boolean")
    feed = spark.createDataFrame([("x",), (None,), ("z",)], "sku string")
    assert {r.sku: r.is_active for r in merge.soft_delete(catalog, feed).collect()} == {"x": True, "y": False, "z": False}
