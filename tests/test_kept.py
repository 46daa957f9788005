"""Views kept up to date: equal to a recompute, made of the changed dates only."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from lakeloom.plans import kept

ORDER = "order_date date, country string, country_name string, region string, order_id string, user_key string, total_amount_usd double, net_amount_usd double, fraud_flagged boolean"
SESSION = "session_date date, funnel_exit_stage string, session_id string, revenue_attributed_usd double"


def order(k, day, country="FR", user="u", total=10.0):
    return (date(2024, 1, day), country, country and country.lower(), "EMEA", f"o{k}", user, total, total and total - 1, k % 2 == 0)


@pytest.fixture
def folder(spark, tmp_path):
    rows = [order(k, 1 + k % 6, [None, "FR", "DE"][k % 3], [None, "u1", "u2", "u3"][k % 4], None if k % 7 == 0 else 1.5 * k) for k in range(60)]
    kept.append(spark.createDataFrame(rows, ORDER), str(tmp_path / "source"), "order_date")
    kept.refresh(spark, kept.COUNTRY_DAY, str(tmp_path / "source"), str(tmp_path / "view"))
    return tmp_path


def shown(spark, folder):
    return sorted(map(tuple, kept.read(spark, kept.COUNTRY_DAY, str(folder / "view")).collect()), key=str)


def anew(spark, folder):
    return sorted(map(tuple, kept.COUNTRY_DAY.shown(kept.COUNTRY_DAY.rows(spark.read.parquet(str(folder / "source")))).select(*kept.read(spark, kept.COUNTRY_DAY, str(folder / "view")).columns).collect()), key=str)


def test_by_hand(spark, tmp_path):
    rows = [order(1, 1, user="a", total=5.0), order(2, 1, user="a", total=7.0), order(2, 1, user="b", total=None)]
    made = kept.COUNTRY_DAY.shown(kept.COUNTRY_DAY.rows(spark.createDataFrame(rows, ORDER))).collect()
    assert [tuple(r) for r in made] == [(date(2024, 1, 1), "FR", "fr", "EMEA", 2, 2, 12.0, 10.0, 6.0, 7.0)]


def test_late_orders_change_their_dates_only(spark, folder):
    before = {p.name: sorted(f.name for f in p.iterdir()) for p in (folder / "view").iterdir() if p.is_dir()}
    late = spark.createDataFrame([order(100, 3, "FR", "u9"), order(101, 3, None, "u1"), order(102, 9, "US", "u1")], ORDER)
    dates = kept.append(late, str(folder / "source"), "order_date")
    assert dates == {date(2024, 1, 3), date(2024, 1, 9)}
    read = kept.source_rows(spark, str(folder / "source"), "order_date", dates)
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [order_date" in plan and "Filter (" not in plan  # whole folders are left out, no rows
    assert {r[0].split("order_date=")[1][:10] for r in read.select("_metadata.file_path").distinct().collect()} == {"2024-01-03", "2024-01-09"}
    kept.refresh(spark, kept.COUNTRY_DAY, str(folder / "source"), str(folder / "view"), dates)
    assert shown(spark, folder) == anew(spark, folder)
    after = {p.name: sorted(f.name for f in p.iterdir()) for p in (folder / "view").iterdir() if p.is_dir()}
    assert {d for d in after if after[d] != before.get(d)} == {"order_date=2024-01-03", "order_date=2024-01-09"}


def test_dates_that_empty_leave(spark, folder):
    """A date whose rows are gone, and none at all."""
    import shutil

    shutil.rmtree(folder / "source" / "order_date=2024-01-02")
    was = shown(spark, folder)
    kept.refresh(spark, kept.COUNTRY_DAY, str(folder / "source"), str(folder / "view"), [])
    assert shown(spark, folder) == was
    kept.refresh(spark, kept.COUNTRY_DAY, str(folder / "source"), str(folder / "view"), {date(2024, 1, 2), date(2024, 1, 4)})
    assert shown(spark, folder) == anew(spark, folder) and all(r[0] != date(2024, 1, 2) for r in shown(spark, folder))


def test_weeks_from_dates(spark, tmp_path):
    rows = [(date(2024, 1, d), s, f"s{d}{s}{k}", 0.25 * d) for d in range(1, 20) for s in ("browse", "purchase", None) for k in range(d % 3)]
    df = spark.createDataFrame(rows, SESSION)
    source, view = str(tmp_path / "s"), str(tmp_path / "v")
    kept.append(df.where("session_date <> DATE'2024-01-10'"), source, "session_date")
    kept.refresh(spark, kept.WEEKLY_FUNNEL, source, view)
    kept.refresh(spark, kept.WEEKLY_FUNNEL, source, view, kept.append(df.where("session_date = DATE'2024-01-10'"), source, "session_date"))
    want = df.groupBy(F.date_trunc("week", "session_date").cast("date").alias("w"), "funnel_exit_stage").agg(F.countDistinct("session_id"), F.round(F.sum("revenue_attributed_usd"), 2))
    assert sorted(map(tuple, kept.read(spark, kept.WEEKLY_FUNNEL, view).collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
