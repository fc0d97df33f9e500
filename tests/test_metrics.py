"""Metric operators against brute-force Python on small fixtures."""

import random

import pytest
from pyspark.sql import functions as F

from basketry.functions.ordered import prefix_sums
from basketry.operators import churn as ch
from basketry.operators import metrics as mt


def brute_auc(y, p):
    pos = [s for s, t in zip(p, y) if t == 1]
    neg = [s for s, t in zip(p, y) if t == 0]
    tot = sum((1.0 if a > b else 0.5 if a == b else 0.0) for a in pos for b in neg)
    return tot / (len(pos) * len(neg))


def brute_ap(y, p):
    P = sum(y)
    ap = 0.0
    for s in sorted(set(p), reverse=True):
        tp = sum(1 for a, t in zip(p, y) if a >= s and t == 1)
        fp = sum(1 for a, t in zip(p, y) if a >= s and t == 0)
        pos_here = sum(1 for a, t in zip(p, y) if a == s and t == 1)
        ap += pos_here / P * tp / (tp + fp)
    return ap


@pytest.fixture()
def scored(spark):
    rnd = random.Random(7)
    rows = [(str(i), rnd.randint(0, 1), round(rnd.random(), 2)) for i in range(300)]
    return spark.createDataFrame(rows, "id string, y int, p double"), rows


def test_auc_and_ap_match_brute_force(scored):
    df, rows = scored
    y = [r[1] for r in rows]
    p = [r[2] for r in rows]
    assert mt.roc_auc(df, "y", "p").first()[0] == pytest.approx(brute_auc(y, p), abs=1e-12)
    assert mt.average_precision(df, "y", "p").first()[0] == pytest.approx(brute_ap(y, p), abs=1e-9)


def test_auc_symmetry(scored):
    df, _ = scored
    a = mt.roc_auc(df, "y", "p").first()[0]
    b = mt.roc_auc(df.withColumn("p", -F.col("p")), "y", "p").first()[0]
    assert a + b == pytest.approx(1.0)


def test_best_f1_lowest_threshold_on_ties(spark):
    df = spark.createDataFrame([(1, 0.9), (1, 0.8), (0, 0.1)], "y int, p double")
    r = mt.best_f1_threshold(df, "y", "p").first()
    # thresholds 0.8 and 0.9? F1 at 0.8 = 1.0 (both positives, no FP)
    assert r.threshold == 0.8 and r.f1 == pytest.approx(1.0, abs=1e-8)


def test_prefix_sums_exact(spark):
    rnd = random.Random(3)
    rows = [(rnd.randint(0, 2), float(i), rnd.randint(1, 5)) for i in range(500)]
    df = spark.createDataFrame(rows, "g int, o double, v int")
    out = prefix_sums(df, ["o"], ["v"], partition_cols=["g"], n_buckets=16).collect()
    for r in out:
        expect = sum(v for g, o, v in rows if g == r.g and o < r.o)
        assert r.v_before == expect


def test_ari(spark):
    df = spark.createDataFrame([(0, 1), (0, 1), (1, 0), (1, 0), (2, 2)], "a int, b int")
    assert mt.adjusted_rand(df, "a", "b").first()[0] == pytest.approx(1.0)
    df2 = spark.createDataFrame([(0, 0), (0, 1), (1, 0), (1, 1)], "a int, b int")
    assert mt.adjusted_rand(df2, "a", "b").first()[0] == pytest.approx(-0.5)


def test_classification_report(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 0), (0, 0)], "y int, yhat int")
    r = {x.label: x for x in mt.classification_report(df, "y", "yhat").collect()}
    assert r["1"].precision == 1.0 and r["1"].recall == 0.5
    assert r["accuracy"].f1 == 0.75 and r["accuracy"].support == 4


def test_stratified_split_exact_and_disjoint(spark):
    rows = [(str(i), 1 if i % 3 == 0 else 0) for i in range(1000)]
    df = spark.createDataFrame(rows, "CustomerID string, y int")
    s = ch.stratified_split(df, "y", 0.2, 42)
    counts = {(r.y, r.split): r["count"] for r in s.groupBy("y", "split").count().collect()}
    n1 = sum(1 for _, y in rows if y == 1)
    n0 = len(rows) - n1
    assert counts[(1, "test")] == int(n1 * 0.2 + 0.5)
    assert counts[(0, "test")] == int(n0 * 0.2 + 0.5)
    assert s.select("CustomerID").distinct().count() == 1000
    again = ch.stratified_split(df.repartition(5), "y", 0.2, 42)
    assert sorted(s.collect()) == sorted(again.collect())


def test_risk_tier_bins(spark):
    df = spark.createDataFrame([(0.0,), (0.3,), (0.30001,), (0.6,), (1.0,), (1.5,)], "p double")
    out = [r[0] for r in df.select(ch.risk_tier("p")).collect()]
    assert out == ["Low", "Low", "Medium", "Medium", "High", None]
