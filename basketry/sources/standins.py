"""Deterministic stand-ins for fitted-model outputs.

Reports over segment and prediction tables are checked against SQL, which
cannot fit K-Means or boosted trees.  These stand-ins produce tables with
the same schemas from the feature matrix by fixed rules, so every report
operator can be verified exactly; the fitted models themselves are covered
by invariant tests.

* Segment: nearest of four fixed centres in standardised (Recency,
  Log_Frequency, Log_Monetary); the ids are deliberately not in rank
  order so the centre-ranking label rule is exercised.
* Churn probability: 1 / (1 + exp(-(Recency - 90) / 60)), 4 dp; predicted
  class = probability > 0.5; the true label is ``Recency > 90`` flipped for
  ids divisible by 7 (so the metrics are not trivially perfect).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import COL_CUSTOMER_ID, RFM_FEATURE_COLUMNS
from ..functions.numeric import rnd
from ..operators.churn import risk_tier
from ..operators.segment import assign_segments, label_segments, rank_centres, scale_features, scaler_params

# Fixed values: (cluster id, centre in standardised Recency, Log_Frequency,
# Log_Monetary).
STANDIN_CENTRES = [
    (2, [-0.8, 1.0, 1.0]),
    (0, [-0.4, 0.0, 0.2]),
    (3, [0.5, -0.5, -0.5]),
    (1, [1.5, -1.0, -1.0]),
]
SCALED = [f"{c}_scaled" for c in RFM_FEATURE_COLUMNS]


def standin_mapping() -> dict[int, str]:
    return rank_centres(STANDIN_CENTRES, RFM_FEATURE_COLUMNS)


def standin_segments(features: DataFrame) -> DataFrame:
    """Feature matrix + Segment + SegmentLabel (the segment results table)."""
    z = scale_features(features, RFM_FEATURE_COLUMNS, scaler_params(features))
    seg = assign_segments(z, STANDIN_CENTRES, SCALED)
    return label_segments(seg.drop(*SCALED), standin_mapping())


def standin_probability(recency_col: str = "Recency"):
    return rnd(F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.col(recency_col).cast("double") - 90.0) / 60.0)), 4)


def standin_churn(features: DataFrame) -> DataFrame:
    """The churn predictions table: CustomerID, ChurnProb, Churned (predicted
    class), ChurnRisk, plus the label ``churn_label`` used by the metrics."""
    label = (F.col("Recency") > 90).cast("int")
    flip = (F.col(COL_CUSTOMER_ID).cast("bigint") % 7) == 0
    return features.select(
        COL_CUSTOMER_ID,
        standin_probability().alias("ChurnProb"),
        F.when(flip, 1 - label).otherwise(label).alias("churn_label"),
    ).select(
        COL_CUSTOMER_ID,
        "ChurnProb",
        (F.col("ChurnProb") > 0.5).cast("int").alias("Churned"),
        risk_tier("ChurnProb").alias("ChurnRisk"),
        "churn_label",
    )
