"""A churn model saved, loaded and checked against request tables."""

import random

import pytest
from pyspark.sql import functions as F

from basketry.config import CHURN_FEATURE_COLUMNS_CONFIGURED, ChurnConfig
from basketry.operators import churn as ch
from basketry.operators import serving as sv
from basketry.plans.queries_analytics import REQ_MAP


@pytest.fixture(scope="module")
def customers(spark):
    rng = random.Random(4)
    cols = CHURN_FEATURE_COLUMNS_CONFIGURED
    rows = [(str(i), *[rng.random() * 200 for _ in cols]) for i in range(200)]
    df = spark.createDataFrame(rows, "CustomerID string, " + ", ".join(f"{c} double" for c in cols))
    return df.withColumn("churn_label", (F.col("Frequency") + F.col("AOV") > 200).cast("int"))


def test_saved_scores_equal_scores_in_memory(spark, customers, tmp_path):
    features = list(CHURN_FEATURE_COLUMNS_CONFIGURED)
    model = ch.fit_churn(customers, features, "churn_label", ChurnConfig(n_estimators=5), early_stopping=None)
    saved = sv.load_churn_model(spark, sv.save_churn_model(spark, model, features, 0.5, 90, str(tmp_path / "churn")))
    assert saved.features == tuple(features) and len(features) == 16 and set(REQ_MAP.values()) == set(features)
    assert (saved.threshold, saved.threshold_days) == (0.5, 90)
    requests = customers.select(F.col("CustomerID").alias("customer_id"), *[F.col(v).alias(k) for k, v in reversed(REQ_MAP.items())])
    got = sorted(map(tuple, sv.score_churn_requests(saved, requests, REQ_MAP).collect()))
    want = sorted(map(tuple, ch.score_churn(model, customers, tier_from_rounded=False).collect()))
    assert got == want and len(got) == 200 and len({p for _, p, _, _ in got}) > 5
    with pytest.raises(ValueError, match="missing: aov, segment"):
        sv.score_churn_requests(saved, requests.drop("aov", "segment"), REQ_MAP)
    with pytest.raises(ValueError, match="not numeric: recency"):
        sv.score_churn_requests(saved, requests.withColumn("recency", F.lit("x")), REQ_MAP)


def test_unfinished_save_is_not_loaded(spark, customers, tmp_path):
    model = ch.fit_churn(customers, ["Frequency"], "churn_label", ChurnConfig(n_estimators=2), early_stopping=None)
    model.write().overwrite().save(str(tmp_path / "half" / "model"))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        sv.load_churn_model(spark, str(tmp_path / "half"))
