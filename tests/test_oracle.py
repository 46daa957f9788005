"""Every registered query against its SQL on the smallest tables."""

import os
from decimal import Decimal

import duckdb
import pytest

from lakeloom.plans import registry

TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{os.path.join(sf, t)}.parquet'")
    return con


def plain(v):
    return float(v) if isinstance(v, Decimal) else v


def same(a, b):
    return a == b or (isinstance(a, float) and isinstance(b, float) and a == pytest.approx(b, rel=1e-9, abs=1e-9))


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_query(spark, sf, duck, name):
    df = registry.QUERIES[name](spark, sf)
    cols = sorted(df.columns)
    key = lambda row: [(v is not None, str(type(v)), round(v, 6) if isinstance(v, float) else v) for v in row]
    got = sorted(([plain(r[c]) for c in cols] for r in df.collect()), key=lambda r: str(key(r)))
    if name not in registry.ORACLE:
        assert got
        return
    made = duck.sql(registry.ORACLE[name])
    assert sorted(made.columns) == cols
    at = [made.columns.index(c) for c in cols]
    want = sorted(([plain(r[i]) for i in at] for r in made.fetchall()), key=lambda r: str(key(r)))
    assert len(got) == len(want)
    for a, b in zip(got, want, strict=True):
        assert all(map(same, a, b)), (a, b)


def test_plans_stay_native(spark, sf):
    """No Python on the batch paths but for the streams, and filters and columns reach the scan."""
    for name in ("silver_events", "fraud_score", "session_stitch", "merge_scd2", "fct_orders"):
        plan = registry.QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan, name
    plan = registry.QUERIES["limit_sample"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_totalprice), GreaterThan(o_totalprice,300000.0)]" in plan and "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan


def test_daily_plans_multiply_no_rows(spark, sf):
    """Several distinct counts of a day come from pre-aggregated rows: no Expand in the plans."""
    for name in ("agg_daily_orders", "agg_daily_order_kpis", "agg_daily_sessions", "agg_daily_final"):
        plan = registry.QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert "Expand" not in plan and "HashAggregate" in plan, name
