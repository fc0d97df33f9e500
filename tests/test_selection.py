"""Exact quantiles by counting, against numpy's linear interpolation."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.functions import selection as sel

PROBS = {"a": 0.0, "q1": 0.25, "m": 0.5, "q99": 0.99, "z": 1.0}


def want(values):
    v = sorted(x for x in values if x is not None and not math.isnan(x))
    if not v:
        return dict.fromkeys(PROBS)
    return {k: float(np.quantile(np.array(v), p)) for k, p in PROBS.items()}


def same(got, exp):
    return all((g is None and e is None) or g == pytest.approx(e, rel=1e-12, abs=1e-12) for g, e in zip(got.values(), exp.values(), strict=True))


@pytest.mark.parametrize("bins,small", [(1024, 20_000), (4, 0), (16, 50)])
def test_columns_of_every_kind(spark, bins, small):
    """Few counted values force the bins, and few bins many rounds."""
    rng = random.Random(4)
    n = 3000
    cols = {
        "small": [rng.randint(0, 9) for _ in range(n)],
        "tied": [5.0 if rng.random() < 0.9 else rng.random() * 1e9 for _ in range(n)],
        "spread": [rng.choice([-1, 1]) * 10 ** rng.uniform(-12, 12) for _ in range(n)],
        "const": [7] * n, "none": [None] * n,
        "gaps": [None if rng.random() < 0.3 else float("nan") if rng.random() < 0.2 else rng.gauss(0, 1) for _ in range(n)],
    }
    rows = list(zip(*[[None if x is None else float(x) for x in v] for v in cols.values()], strict=True))
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols)).repartition(5)
    [(_, got)] = sel.select_quantiles(df, list(cols), PROBS, bins=bins, small=small)
    for c, v in cols.items():
        assert same(got[c], want(v)), (c, got[c], want(v))


def test_groups_with_null_key_and_decimals(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["x", "y", None]), round(rng.uniform(0, 50), 2), i) for i in range(900)] + [("empty", None, 0)]
    df = spark.createDataFrame(rows, "g string, v double, i int").withColumn("d", F.col("v").cast("decimal(18,2)"))
    got = {g[0]: q for g, q in sel.select_quantiles(df, ["d", "i"], PROBS, by=["g"])}
    for g in ("x", "y", None, "empty"):
        assert same(got[g]["d"], want([r[1] for r in rows if r[0] == g]))
        assert same(got[g]["i"], want([r[2] for r in rows if r[0] == g]))


def test_wrong_brackets_are_moved(spark, monkeypatch):
    """The sketch only has to be near: a bad one costs scans, not exactness."""
    true = sel._sketch

    def off(values, n, probs, keys):
        rows = [r.asDict() for r in true(values, n, probs, keys)]
        for r in rows:
            r["q0"] = [float(41 + k % 2) for k in range(2 * len(probs))]
            r["q0"] = sorted(r["q0"])
        return rows

    monkeypatch.setattr(sel, "_sketch", off)
    df = spark.range(1000).select(F.col("id").cast("double").alias("v"))
    [(_, got)] = sel.select_quantiles(df, ["v"], PROBS)
    assert same(got["v"], want([float(i) for i in range(1000)]))


def test_empty_single_and_infinite(spark):
    empty = spark.createDataFrame([], "v double, g string")
    assert sel.select_quantiles(empty, ["v"], PROBS, by=["g"]) == []
    assert sel.quantile_table(empty, "v", {"p": 0.5}).collect()[0]["p"] is None
    assert sel.quantile_table(spark.createDataFrame([(3.5,)], "v double"), "v", {"p": 0.99}).first()["p"] == 3.5
    inf = spark.createDataFrame([(float("-inf"),), (1.0,), (2.0,), (float("inf"),)], "v double")
    assert sel.quantile_table(inf, "v", {"lo": 0.0, "hi": 1.0, "q": 1 / 3}).first() == (float("-inf"), float("inf"), 1.0)


def test_two_scans_and_no_sort(spark, monkeypatch):
    """Whatever the number of columns."""
    calls = []
    for name in ("_sketch", "_count"):
        f = getattr(sel, name)
        monkeypatch.setattr(sel, name, lambda *a, f=f, name=name: (calls.append(name), f(*a))[1])
    df = spark.range(5000).select(*[(F.rand(k) * 10 ** k).alias(f"c{k}") for k in range(6)])
    sel.select_quantiles(df, df.columns, PROBS)
    assert calls == ["_sketch", "_count"]
    values = sel._values(df, df.columns, [])
    rows, _ = sel._with_brackets(values, [], [()], [(0, 0, 0.1, 0.2)])
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Window" not in plan and "Join" not in plan


def test_sketch_observed_while_writing(spark):
    df = spark.range(4000).select((F.col("id") * 7 % 1000).cast("double").alias("v"), "id")
    table, seen = sel.staged_sketch(df, "observed", ["v", "id"], list(PROBS.values()))
    [(_, got)] = sel.select_quantiles(table, ["v", "id"], PROBS, sketched=seen)
    assert same(got["v"], want([float(i * 7 % 1000) for i in range(4000)]))
    assert same(got["id"], want([float(i) for i in range(4000)]))
