"""Boosted trees of several models in the same passes."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.config import ChurnConfig
from basketry.operators import attribution as at
from basketry.operators import boosting as bo
from basketry.operators import churn as ch
from basketry.operators import metrics as mt

FEATURES = ["a", "b", "c"]
PLAIN = ChurnConfig(n_estimators=4, max_depth=2, subsample=1.0, colsample_bytree=1.0)


@pytest.fixture(scope="module")
def rows(spark):
    r = np.random.default_rng(3)
    x = r.normal(size=(900, 3))
    y = (x[:, 0] + x[:, 1] * x[:, 2] + r.normal(size=900) > 0.4).astype(int)
    data = [(f"c{i}", int(v), *map(float, f)) for i, (v, f) in enumerate(zip(y, x, strict=True))]
    return spark.createDataFrame(data, "CustomerID string, label int, a double, b double, c double").cache()


def margins(model, df):
    from pyspark.ml.functions import vector_to_array

    got = model.transform(df).orderBy("CustomerID").select(vector_to_array("rawPrediction")[1].alias("m")).collect()
    return np.array([r["m"] for r in got])


def test_trees_are_those_of_spark_without_drawing(spark, rows, tmp_path):
    from pyspark.ml import Pipeline, PipelineModel
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    weight = ch.class_weight(rows, "label").first()["pos_weight"]
    gbt = GBTClassifier(labelCol="label", weightCol="weight", maxIter=4, maxDepth=2, maxBins=32, stepSize=PLAIN.learning_rate, seed=1)
    theirs = Pipeline(stages=[VectorAssembler(inputCols=FEATURES, outputCol="features"), gbt]).fit(ch.with_weights(rows, "label", weight))
    mine = ch.fit_churn(rows, FEATURES, "label", PLAIN, early_stopping=None)
    assert np.allclose(margins(mine, rows), margins(theirs, rows), atol=1e-9)
    assert np.allclose(mine.stages[-1].featureImportances.toArray(), theirs.stages[-1].featureImportances.toArray())
    for (_, v, path), (_, w, other) in zip(at.leaf_table(mine, spark)[0], at.leaf_table(theirs, spark)[0], strict=True):
        assert v == pytest.approx(w) and [p[:4] for p in path] == [p[:4] for p in other]
        assert [p[4] for p in path] == pytest.approx([p[4] for p in other])  # rows of every node
    mine.write().overwrite().save(str(tmp_path / "model"))
    assert np.array_equal(margins(PipelineModel.load(str(tmp_path / "model")), rows), margins(mine, rows))


def test_folds_grow_in_the_same_passes(spark, rows):
    def jobs(folds):
        group = f"cv-{folds}"
        spark.sparkContext.setJobGroup(group, group)
        try:
            assert len(ch.cross_validate(rows, FEATURES, "label", folds, PLAIN).collect()) == folds
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    assert jobs(6) <= jobs(2) + 1


def test_a_fold_is_scored_by_a_model_of_the_other_folds(rows):
    from pyspark.ml.functions import vector_to_array

    folded = ch.stratified_folds(rows, "label", 3, PLAIN.random_state)
    got = {r["fold"]: r for r in ch.cross_validate(rows, FEATURES, "label", 3, PLAIN).collect()}
    for f in range(3):
        model = ch.fit_churn(folded.filter(F.col("fold") != f), FEATURES, "label", PLAIN, early_stopping=None)
        scored = model.transform(folded.filter(F.col("fold") == f)).withColumn("p", vector_to_array("probability")[1])
        assert got[f]["roc_auc"] == pytest.approx(mt.roc_auc(scored, "label", "p").first()["roc_auc"], abs=1e-12)
    assert got[0]["mean_auc"] == pytest.approx(np.mean([r["roc_auc"] for r in got.values()]))
    assert got[0]["std_auc"] == pytest.approx(np.std([r["roc_auc"] for r in got.values()]))


def test_drawn_rows_and_features_do_not_depend_on_partitions(rows):
    cfg = replace(PLAIN, subsample=0.8, colsample_bytree=0.6)
    one = ch.fit_churn(rows.repartition(3), FEATURES, "label", cfg, early_stopping=None)
    other = ch.fit_churn(rows.repartition(7), FEATURES, "label", cfg, early_stopping=None)
    assert np.allclose(margins(one, rows), margins(other, rows), atol=1e-9)
    assert not np.allclose(margins(one, rows), margins(ch.fit_churn(rows, FEATURES, "label", PLAIN, early_stopping=None), rows))


def test_margins_of_many_trees_and_blocks(spark, rows, monkeypatch):
    monkeypatch.setattr(bo, "CHECKPOINT", 2)  # checkpoints between trees
    cfg = replace(PLAIN, n_estimators=5)
    few = rows.withColumn("fold", F.when(F.col("CustomerID") < "c3", 0).otherwise(-1))
    fitted = bo.fit(few, FEATURES, "label", cfg, [1.5, 1.5], 600, counted=(1,))
    model = bo.as_model(spark, fitted, FEATURES, 0)
    held = few.filter("fold = 0")
    got = sorted(r["margin"] for r in fitted.held_out(spark, "label").collect())
    assert np.allclose(got, sorted(margins(model, held)), atol=1e-9)
    assert np.allclose(margins(bo.as_model(spark, fitted, FEATURES, 1, 3), rows), margins(
        bo.as_model(spark, bo.fit(few, FEATURES, "label", replace(cfg, n_estimators=3), [1.5, 1.5], 600), FEATURES, 1), rows))


def test_points_between_values():
    assert bo.split_points(np.array([2.0, 0.0, 0.0]), np.ones(3), 32).tolist() == [1.0]
    assert not len(bo.split_points(np.zeros(5), np.ones(5), 32))
    many = bo.split_points(np.arange(1000.0), np.ones(1000), 4)
    assert many.tolist() == [249.5, 499.5, 749.5]
