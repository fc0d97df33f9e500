"""Batched K-Means against numpy and Spark's evaluator."""

import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.operators import lloyd
from basketry.operators import segment as sg


@pytest.fixture(scope="module")
def cloud(spark):
    rng = np.random.default_rng(7)
    x = np.vstack([rng.normal(c, 0.6, (120, 3)) for c in ([0, 0, 0], [4, 0, 1], [0, 5, -1], [5, 5, 5])])
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double, c double").repartition(5)
    return x, df, lloyd.coordinates(df, ["a", "b", "c"])


def plain_lloyd(x, centres, max_iter=300, tol=1e-4):
    for _ in range(max_iter):
        near = ((x[:, None] - centres[None]) ** 2).sum(2).argmin(1)
        new = np.array([x[near == c].mean(0) if (near == c).any() else centres[c] for c in range(len(centres))])
        moved = np.sqrt(((new - centres) ** 2).sum(1)).max()
        centres = new
        if moved <= tol:
            break
    return centres, ((x[:, None] - centres[None]) ** 2).sum(2).min(1).sum()


def test_every_start_equals_its_own_plain_fit(cloud):
    x, _, points = cloud
    runs = [(k, s) for k in (2, 4, 7) for s in range(4)]
    sample = lloyd._sample(points)
    for f, (k, seed) in zip(lloyd.fit_starts(points, runs), runs, strict=True):
        centres, inertia = plain_lloyd(x, lloyd.plus_plus(sample, k, seed))
        assert (f.k, f.seed) == (k, seed)
        assert np.allclose(f.centres, centres, atol=1e-9) and f.inertia == pytest.approx(inertia, rel=1e-9)


def test_one_scan_an_iteration_for_all_starts(cloud, monkeypatch):
    _, _, points = cloud
    scans = []
    once = lloyd._totals
    monkeypatch.setattr(lloyd, "_totals", lambda p, sets: (scans.append(len(sets)), once(p, sets))[1])
    fits = lloyd.fit_starts(points, [(k, s) for k in range(2, 8) for s in range(5)])
    assert len(scans) == max(f.iterations for f in fits) + 1 and scans[0] == 30
    assert scans == sorted(scans, reverse=True), "settled starts leave the work"


def test_silhouettes_equal_sparks_evaluator(cloud):
    from pyspark.ml.evaluation import ClusteringEvaluator

    _, df, points = cloud
    fits = [lloyd.best(lloyd.fit_starts(points, [(k, s) for s in range(3)])) for k in (2, 4, 6)]
    got = lloyd.silhouettes(points, [f.centres for f in fits])
    for f, mine in zip(fits, got, strict=True):
        model = lloyd.as_model(df.sparkSession, f.centres)
        theirs = ClusteringEvaluator(featuresCol="features", predictionCol="prediction").evaluate(model.transform(sg.vectorise(df, ["a", "b", "c"])))
        assert mine == pytest.approx(theirs, abs=1e-9)


def test_singletons_and_few_distinct_rows(spark):
    df = spark.createDataFrame([(0.0,), (0.0,), (10.0,)], "a double")
    points = lloyd.coordinates(df, ["a"])
    [f] = lloyd.fit_starts(points, [(5, 1)])
    assert sorted(f.centres.ravel().tolist()) == [0.0, 10.0] and f.inertia == 0
    assert lloyd.silhouettes(points, [f.centres]) == [pytest.approx(2 / 3)]
    same = lloyd.coordinates(spark.createDataFrame([(3.0,)] * 4, "a double"), ["a"])
    [g] = lloyd.fit_starts(same, [(3, 0)])
    assert g.centres.tolist() == [[3.0]] and lloyd.silhouettes(same, [g.centres]) == [0.0]
    with pytest.raises(ValueError):
        lloyd.fit_starts(lloyd.coordinates(df.limit(0), ["a"]), [(2, 0)])


def test_null_rows_take_no_part(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 5.0), (3.0, 4.0)], "a double, b double")
    assert lloyd.coordinates(df, ["a", "b"]).count() == 2


def test_model_predicts_saves_and_loads(cloud):
    from pyspark.ml.clustering import KMeansModel

    _, df, points = cloud
    [f] = lloyd.fit_starts(points, [(4, 0)])
    path = os.path.join(tempfile.mkdtemp(prefix="km-"), "m")
    lloyd.as_model(df.sparkSession, f.centres).write().save(path)
    back = KMeansModel.load(path)
    assert np.allclose(back.clusterCenters(), f.centres)
    v = sg.assign_segments(sg.vectorise(df, ["a", "b", "c"]), sg.model_centres(back), ["a", "b", "c"])
    assert back.transform(v).filter(F.col("prediction") != F.col("Segment")).count() == 0


def test_sweep_prefers_the_true_number(cloud):
    _, df, _ = cloud
    scores = sg.elbow(df, ["a", "b", "c"], range(2, 7), n_init=3)
    assert sg.choose_k(scores).first()["best_k"] == 4
    inertia = [r.inertia for r in scores.orderBy("k").collect()]
    assert inertia == sorted(inertia, reverse=True)


def test_nearest_by_products_is_the_plain_nearest():
    rng = np.random.default_rng(3)
    for shift in (0.0, 1e6):
        x, c = rng.standard_normal((5_000, 3)) + shift, rng.standard_normal((7, 3)) + shift
        plain = ((x[:, None, :] - c[None, :, :]) ** 2).sum(2).argmin(1)
        origin = c.mean(0)
        assert (lloyd._nearest(x - origin, c - origin) == plain).all()
    same = np.zeros((4, 3))
    assert lloyd._nearest(same, np.zeros((3, 3))).tolist() == [0, 0, 0, 0]  # the first of equal ones
