"""Fitted-model operators: invariants rather than values."""

import datetime as dt
import os
import random
import tempfile
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.operators import attribution as at
from basketry.operators import segment as sg


@pytest.fixture(scope="module")
def blobs(spark):
    rnd = random.Random(1)
    rows = []
    for i in range(300):
        c = i % 3
        rows.append((str(i), c * 5 + rnd.gauss(0, 0.5), c * -3 + rnd.gauss(0, 0.5), rnd.gauss(0, 1)))
    return spark.createDataFrame(rows, "CustomerID string, a double, b double, c double")


def test_kmeans_best_of_n_reproducible(blobs):
    m1, c1 = sg.fit_kmeans(blobs, ["a", "b"], k=3, n_init=3, seed=5)
    m2, c2 = sg.fit_kmeans(blobs, ["a", "b"], k=3, n_init=3, seed=5)
    assert c1 == pytest.approx(c2)
    a = sorted(tuple(c) for _, c in sg.model_centres(m1))
    b = sorted(tuple(c) for _, c in sg.model_centres(m2))
    assert np.allclose(np.array(a), np.array(b), atol=1e-9)


def test_assign_matches_model(blobs):
    model, _ = sg.fit_kmeans(blobs, ["a", "b"], k=3, n_init=2, seed=1)
    mine = sg.assign_segments(blobs, sg.model_centres(model), ["a", "b"])
    theirs = model.transform(sg.vectorise(mine, ["a", "b"]))
    assert theirs.filter(F.col("prediction") != F.col("Segment")).count() == 0


def test_rank_centres_orders_by_value():
    centres = [(0, [1.0, -1.0, -1.0]), (1, [-1.0, 1.0, 1.0]), (2, [0.0, 0.0, 0.0]), (3, [0.5, -0.2, -0.1])]
    m = sg.rank_centres(centres, ["Recency", "Log_Frequency", "Log_Monetary"])
    assert m == {1: "Champions", 2: "Loyal Customers", 3: "At Risk", 0: "Lost / Inactive"}


def test_stability_of_separated_blobs(blobs):
    r = sg.stability(blobs, ["a", "b"], k=3, n_seeds=3, seed=1).first()
    assert r.pairs == 3 and r.mean_ari > 0.99 and r.stable


def test_pca_centred_and_sign_fixed(blobs):
    pcs, ev = sg.pca_2d(blobs, ["a", "b", "c"])
    means = pcs.agg(F.avg("pc1"), F.avg("pc2")).first()
    assert abs(means[0]) < 1e-9 and abs(means[1]) < 1e-9
    assert ev[0] >= ev[1] > 0


def test_shap_efficiency(spark, blobs):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    df = blobs.withColumn("label", (F.col("a") + F.col("c") > 5).cast("double"))
    feats = ["a", "b", "c"]
    model = Pipeline(stages=[VectorAssembler(inputCols=feats, outputCol="features"),
                             GBTClassifier(maxIter=8, maxDepth=3, seed=3)]).fit(df)
    leaves, weights = at.leaf_table(model, spark)
    base = at.expected_margin(leaves, weights)
    sv = at.shap_values(model, df, feats)
    margin = model.transform(df).select("CustomerID", vector_to_array("rawPrediction")[1].alias("m"))
    j = sv.join(margin, "CustomerID").collect()
    for r in j:
        total = sum(r[f"phi_{c}"] for c in feats)
        # Spark's raw prediction for logistic loss is (-m, m) with m the margin
        assert total + base == pytest.approx(r["m"], abs=1e-9)
    top = at.mean_abs_shap(model, df, feats, top=2).collect()
    assert len(top) == 2 and top[0].mean_abs_shap >= top[1].mean_abs_shap


def test_incremental_append_idempotent(spark):
    from basketry.streaming.incremental import append_new

    target = os.path.join(tempfile.mkdtemp(prefix="incr-"), "t")
    a = spark.createDataFrame([(1, "x"), (2, "y"), (2, "y"), (4, None)], "k int, v string")
    b = spark.createDataFrame([(2, "y"), (3, "z"), (4, None)], "k int, v string")
    assert append_new(a, target) == 3
    assert append_new(b, target) == 1
    assert append_new(b, target) == 0
    got = sorted((tuple(r) for r in spark.read.parquet(target).collect()), key=str)
    assert got == sorted([(1, "x"), (2, "y"), (3, "z"), (4, None)], key=str)


def test_streaming_foreach_batch(spark):
    from basketry.streaming.incremental import stream_order_lines

    base = tempfile.mkdtemp(prefix="stream-")
    landing = os.path.join(base, "landing")
    spark.createDataFrame([(1, "x"), (1, "x"), (2, "y")], "k int, v string").write.parquet(os.path.join(landing, "f1"))
    target = os.path.join(base, "t")
    stream_order_lines(spark, os.path.join(landing, "*"), target, os.path.join(base, "ckpt"), "k int, v string")
    assert spark.read.parquet(target).count() == 2


def test_jobs_end_to_end(spark):
    from basketry.config import ChurnConfig, SegmentationConfig
    from basketry.plans import jobs
    from basketry.sources.fixtures import raw_order_lines

    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("no test data")
    out = tempfile.mkdtemp(prefix="jobs-")
    etl = jobs.run_etl(spark, raw_order_lines(spark, sf), out)
    assert etl["clean_rows"] == 2968
    assert jobs.run_features(spark, out)["customers"] == 150
    seg = jobs.run_segmentation(spark, out, SegmentationConfig(n_init=2))
    assert sum(v for k, v in seg.items() if k.startswith("segment_") and k.endswith("_count")) == 150
    churn = jobs.run_churn(spark, out, ChurnConfig(n_estimators=5))
    assert churn["scored"] == 150 and 0.0 <= churn["test_roc_auc"] <= 1.0
    n_test = sum(churn[k] for k in ("tp", "fp", "tn", "fn"))
    assert n_test == jobs.read(spark, out, jobs.PREDICTIONS).filter("split = 'test'").count()
    table = lambda name: spark.read.parquet(os.path.join(out, name))
    assert table("risk_distribution").agg(F.sum("customers")).first()[0] == 150
    used = set(ChurnConfig().feature_columns)
    assert {r.feature for r in table("churn_attribution").collect()} == used
    assert table("models/churn_meta").first().churn_threshold_days == ChurnConfig().threshold_days
    keys = {r.key for r in table(jobs.RUNS).filter("kind = 'churn'").collect()}
    assert {"cv_mean_auc", "precision", "recall", "accuracy", "subsample", "test_size"} <= keys
    assert {f"shap_{c}" for c in used} <= keys
    assert table("segment_profile").count() == 4 and table("audits/clean").count() > 0

    # saved models round-trip: reloading and re-scoring gives the stored table
    from pyspark.ml import PipelineModel
    from pyspark.ml.clustering import KMeansModel

    from basketry.operators import churn as ch

    model = PipelineModel.load(os.path.join(out, "models/churn"))
    stored = jobs.read(spark, out, jobs.PREDICTIONS)
    seg = jobs.read(spark, out, jobs.SEGMENTS)
    sel, _ = ch.select_features(ch.churn_label(seg), list(ChurnConfig().feature_columns), keep=("CustomerID",))
    again = ch.score_churn(model, sel)
    assert sorted(again.collect()) == sorted(stored.drop("split").collect())
    km = KMeansModel.load(os.path.join(out, "models/kmeans"))
    assert len(km.clusterCenters()) == 4


def test_rejected_batch_leaves_the_published_table(spark):
    from basketry.operators.quality import ValidationError, validate_keyed, violation_table
    from basketry.plans.jobs import _write
    from basketry.sources.versioned import VersionedTable

    path = os.path.join(tempfile.mkdtemp(prefix="publish-"), "t")

    def check(t):
        validate_keyed(t, violation_table(t, [("negative", F.col("v") < 0)], unique="k"), "t")

    _write(spark.createDataFrame([(1, 2), (2, 3)], "k int, v int"), path, validate=check)
    for bad in ([(1, -1)], [(1, 1), (1, 2)], []):
        with pytest.raises(ValidationError):
            _write(spark.createDataFrame(bad, "k int, v int"), path, validate=check)
        assert VersionedTable(spark, path).read().count() == 2


def test_verify_count_after_append(spark):
    from basketry.sources import io as sio

    path = os.path.join(tempfile.mkdtemp(prefix="append-"), "t")
    first = sio.save_table(spark.range(5).toDF("k"), None, "overwrite", path)
    second = sio.save_table(spark.range(3).toDF("k"), None, "append", path)
    assert sio.verify_count(spark, None, second, path, before=first) == 8
    with pytest.raises(RuntimeError):
        sio.verify_count(spark, None, second, path)


def test_multiclass_report_averages(spark):
    from basketry.operators.metrics import multiclass_report

    df = spark.createDataFrame([(0, 0), (0, 0), (0, 1), (1, 1)], "y int, p int")
    r = {x.label: x for x in multiclass_report(df, "y", "p").collect()}
    assert r["macro avg"].precision == pytest.approx(0.75) and r["macro avg"].support == 4
    assert r["weighted avg"].precision == pytest.approx(0.875)
    assert r["weighted avg"].recall == pytest.approx(r["accuracy"].f1)


def test_best_iteration_patience():
    from basketry.operators.churn import best_iteration

    aucs = [(1, 0.6), (2, 0.7), (3, 0.69), (4, 0.71), (5, 0.70), (6, 0.70), (7, 0.99)]
    assert best_iteration(aucs, patience=2) == 4  # stops at 6 before seeing 7
    assert best_iteration(aucs, patience=5) == 7


def test_prefix_margins_and_refit_prefix(spark, blobs):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    df = blobs.withColumn("label", (F.col("a") + F.col("c") > 5).cast("int"))
    feats = ["a", "b", "c"]

    def fit(n):
        return Pipeline(stages=[VectorAssembler(inputCols=feats, outputCol="features"),
                                GBTClassifier(maxIter=n, maxDepth=3, seed=3, subsamplingRate=0.8)]).fit(
            df.withColumn("label", F.col("label").cast("double")))

    full, short = fit(6), fit(4)
    pm = at.prefix_margins(full, df, feats, "label").filter(F.col("k") == 4)
    mine = sorted(r.margin for r in pm.collect())
    theirs = sorted(r.m for r in short.transform(df).select(vector_to_array("rawPrediction")[1].alias("m")).collect())
    assert np.allclose(mine, theirs, atol=1e-9)  # prefix of 6 trees == refit with 4


def test_prefix_aucs_are_exact_and_send_no_row_per_margin(spark, blobs, monkeypatch):
    from basketry.config import ChurnConfig
    from basketry.operators import churn as ch
    from basketry.operators import metrics as mt

    df = blobs.withColumn("label", (F.col("a") + 3 * F.col("c") > 5).cast("int")).repartition(3)
    feats = ["a", "b", "c"]
    model = ch.fit_churn(df, feats, "label", ChurnConfig(n_estimators=5, max_depth=2), early_stopping=None)
    want = mt.roc_auc(at.prefix_margins(model, df, feats, "label"), "label", "margin", by=["k"])
    got = at.prefix_aucs(model, df, feats, "label")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert at.batch_auc(np.array([1.0, 2.0]), np.array([1.0, 3.0])) == 0.375  # a tie counts one half
    one_class = at.prefix_aucs(model, df.filter("label = 1"), feats, "label")
    assert [r["roc_auc"] for r in one_class.collect()] == [None] * 5
    monkeypatch.setattr(at, "prefix_margins", lambda *a: pytest.fail("a row for every margin"))
    assert len(ch.fit_churn(df, feats, "label", ChurnConfig(n_estimators=3, max_depth=2)).stages[-1].trees) <= 3


def test_kmeans_fit_independent_of_input_partitioning(blobs):
    a = sg.fit_kmeans(blobs.repartition(3), ["a", "b"], k=3, n_init=2, seed=9)
    b = sg.fit_kmeans(blobs.repartition(11), ["a", "b"], k=3, n_init=2, seed=9)
    assert a[1] == pytest.approx(b[1])
    ca = sorted(tuple(c) for _, c in sg.model_centres(a[0]))
    cb = sorted(tuple(c) for _, c in sg.model_centres(b[0]))
    assert np.allclose(np.array(ca), np.array(cb), atol=1e-9)
