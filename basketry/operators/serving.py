"""Scoring requests from a saved churn model.

The fitted pipeline and its record (decision threshold, feature columns in the
model's order, churn definition) are written side by side and loaded together,
so a request table is always checked against the columns the model was fitted
on.  Scoring is one narrow pass over the requests."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import COL_CUSTOMER_ID as CUST
from . import churn as ch


@dataclass(frozen=True)
class SavedChurnModel:
    model: PipelineModel
    features: tuple[str, ...]
    threshold: float
    threshold_days: int


def save_churn_model(spark: SparkSession, model: PipelineModel, features: list[str], threshold: float,
                     threshold_days: int, path: str) -> str:
    """Writes ``path/model`` and then ``path/meta``; a folder without the
    record is an unfinished save and cannot be loaded."""
    model.write().overwrite().save(f"{path}/model")
    ch.model_meta(spark, threshold, features, threshold_days).coalesce(1).write.mode("overwrite").parquet(f"{path}/meta")
    return path


def load_churn_model(spark: SparkSession, path: str) -> SavedChurnModel:
    meta = spark.read.parquet(f"{path}/meta").first()
    return SavedChurnModel(PipelineModel.load(f"{path}/model"), tuple(json.loads(meta["feature_cols"])),
                           meta["threshold"], meta["churn_threshold_days"])


def model_inputs(requests: DataFrame, names: dict[str, str], features: tuple[str, ...], key: str) -> DataFrame:
    """The model's columns from a request table; ``names`` maps request
    columns to feature columns.  Raises for columns that are absent or not
    numeric, naming all of them."""
    source = {feature: column for column, feature in names.items()}
    kinds = {f.name: f.dataType for f in requests.schema.fields}
    absent = [source.get(f, f) for f in features if source.get(f, f) not in kinds]
    absent += [key] if key not in kinds else []
    if absent:
        raise ValueError(f"request columns missing: {', '.join(absent)}")
    wrong = [source.get(f, f) for f in features if not isinstance(kinds[source.get(f, f)], T.NumericType)]
    if wrong:
        raise ValueError(f"request columns not numeric: {', '.join(wrong)}")
    return requests.select(F.col(key).alias(CUST), *[F.col(source.get(f, f)).cast("double").alias(f) for f in features])


def score_churn_requests(saved: SavedChurnModel, requests: DataFrame, names: dict[str, str], key: str = "customer_id") -> DataFrame:
    """(key, churn_prob, churned, churn_risk) for every accepted request."""
    scored = ch.score_churn(saved.model, model_inputs(requests, names, saved.features, key), tier_from_rounded=False)
    return scored.select(F.col(CUST).alias(key), F.col("ChurnProb").alias("churn_prob"),
                         F.col("Churned").alias("churned"), F.col("ChurnRisk").alias("churn_risk"))
