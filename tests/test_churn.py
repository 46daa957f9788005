"""The churn model: split, early stopping, metrics of held-out users, gate, reruns."""

import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from lakeloom.operators import churn

COLUMNS = ("days_since_last_order", "order_count_90d", "discount_usage_rate", "noise")
PARAMS = churn.Params(rounds=25, depth=3)


@pytest.fixture(scope="module")
def features(spark):
    """A label that two features tell, with noise; one user in ten has a null feature, some have no label."""
    r = random.Random(3)
    rows = []
    for k in range(1500):
        days, orders = r.randint(0, 1200), r.randint(0, 12)
        p = 1 / (1 + math.exp(-(days / 150 - orders / 1.5)))
        label = None if k % 50 == 0 else int(r.random() < p)
        rows.append((f"u{k}", None if k % 10 == 0 else days, orders, r.choice([0.1, 1.7, float("nan")]), r.random(), label))
    return spark.createDataFrame(rows, "u string, days_since_last_order long, order_count_90d long, discount_usage_rate double, noise double, churned int").repartition(7)


@pytest.fixture(scope="module")
def trained(features):
    rows = churn.model_rows(features, "u", "churned", COLUMNS)
    return rows, churn.train(rows, PARAMS)


def test_split_is_of_the_user(features, trained):
    want = {}
    for (u,) in features.where("churned IS NOT NULL").select("u").collect():
        byte = hashlib.md5(f"42:{u}".encode()).hexdigest()[:2]
        want[u] = "train" if byte < "b3" else "validation" if byte < "da" else "test"
    got = {r.u: r.split for r in trained[0].collect()}
    assert got == want and 0.64 < sum(s == "train" for s in got.values()) / len(got) < 0.76
    few = features.where("u LIKE 'u1%'").select(churn.split_of(F.col("u")).alias("s"), "u").collect()
    assert all(got.get(r.u, r.s) == r.s for r in few)  # whatever else is in the table


def test_preprocessing_reaches_the_model(trained):
    first = {r.u: list(r.x) for r in trained[0].collect()}
    assert max(x[0] for x in first.values()) == 999 and {x[2] for x in first.values()} == {0.0, 0.1, 1.0}


def auc(pairs):
    good, bad = [s for s, y in pairs if y], [s for s, y in pairs if not y]
    return sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))


def test_it_stops_early_and_judges_users_it_hasn_t_seen(trained):
    rows, model = trained
    scored = churn.score(rows, model)
    report = {r.split: r for r in churn.report(scored, model).collect()}
    assert 1 <= model.getNumTrees < PARAMS.rounds  # further rounds didn't help the validation part
    for split, r in report.items():
        own = [(x.s, x.label) for x in scored.where(F.col("split") == split).collect()]
        assert r.users == len(own) and r.churned == sum(y for _, y in own) and r.rounds == model.getNumTrees
        assert r.auc == pytest.approx(auc(own), abs=1e-6)
        hot = [y for s, y in own if s >= 0.5]
        assert r.precision_at_half == pytest.approx(sum(hot) / len(hot), abs=1e-6) and r.error == pytest.approx(sum((s >= 0.5) != (y == 1) for s, y in own) / len(own), abs=1e-6)
    assert 0.8 < report["test"].auc < 0.99 and report["test"].passed
    strict = {r.split: r.passed for r in churn.report(scored, model, churn.Gate(auc=0.999)).collect()}
    assert not strict["test"]


def test_the_test_part_is_never_trained_on(trained):
    """Other labels for the test part leave the model as it is."""
    rows, model = trained
    turned = rows.withColumn("label", F.when(F.col("split") == "test", 1 - F.col("label")).otherwise(F.col("label")))
    again = churn.train(turned, PARAMS)
    assert again.toDebugString.split("\n")[1:] == model.toDebugString.split("\n")[1:]


def test_runs_and_saved_models_agree(spark, features, trained, tmp_path):
    rows, model = trained
    want = {r.u: r.s for r in churn.score(rows, model).collect()}
    again = churn.model_rows(features.repartition(3), "u", "churned", COLUMNS)
    assert {r.u: r.s for r in churn.score(again, churn.train(again, PARAMS)).collect()} == want
    kept = churn.load(spark, churn.save(model, str(tmp_path / "model")))
    assert {r.u: r.s for r in churn.score(rows, kept).collect()} == want


def test_a_label_that_nothing_tells_fails_the_gate(features):
    blind = features.withColumn("churned", (F.crc32("u") % 2).cast("int"))
    rows = churn.model_rows(blind, "u", "churned", COLUMNS)
    model = churn.train(rows, PARAMS)
    test = {r.split: r for r in churn.report(churn.score(rows, model), model).collect()}["test"]
    assert 0.3 < test.auc < 0.7 and not test.passed


def test_parts_without_both_classes(spark, trained):
    _, model = trained
    rows = spark.createDataFrame([("train", 0.2, 0.0), ("train", 0.4, 0.0)], "split string, s double, label double")
    report = {r.split: r for r in churn.report(rows, model).collect()}
    assert report["train"].auc is None and not report["train"].passed and report["test"].users == 0 and report["test"].auc is None
