"""Churn labelling, splitting, model fitting and scoring.

Splits are exact and stratified without a per-label window over half of
the table: rows are ordered by ``md5(id || '|' || seed)`` and ranked within
their class with the bucketed ``prefix_sums`` (4096 hash buckets).
"""

from __future__ import annotations

import json
import uuid
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import (
    CHURN_FEATURE_COLUMNS,
    CHURN_RISK_BINS,
    CHURN_RISK_LABELS,
    CHURN_THRESHOLD_DAYS,
    COL_CUSTOMER_ID,
    ChurnConfig,
)
from ..functions.numeric import rnd
from ..functions.ordered import hash_bucket, prefix_sums

CUST = COL_CUSTOMER_ID


# J1 -------------------------------------------------------------------------
def churn_label(df: DataFrame, days: int = CHURN_THRESHOLD_DAYS, out: str = "churn_label") -> DataFrame:
    return df.withColumn(out, (F.col("Recency") > F.lit(days)).cast("int"))


# J2 -------------------------------------------------------------------------
def churn_threshold(df: DataFrame, q: float = 0.9) -> DataFrame:
    """int() of the q-th (linear) percentile of AvgGap (Recency when the
    column is absent), NULLs ignored."""
    from ..functions.selection import quantile_table

    col = "AvgGap" if "AvgGap" in df.columns else "Recency"
    return quantile_table(df, col, {"p": q}).select(
        F.floor("p").cast("int").alias("threshold_days"), F.lit(col).alias("source_column")
    )


# J3 -------------------------------------------------------------------------
def select_features(df: DataFrame, cols=CHURN_FEATURE_COLUMNS, keep=(CUST,)) -> tuple[DataFrame, list[str]]:
    """Configured feature columns present in the data, NULL -> 0; returns
    the projected frame and the list used (missing ones are skipped)."""
    used = [c for c in cols if c in df.columns]
    proj = df.select(*[c for c in keep if c in df.columns], *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in used])
    return proj, used


# J4 / J7 --------------------------------------------------------------------
def _class_ranks(df: DataFrame, label: str, seed: int, key: str = CUST) -> DataFrame:
    h = F.md5(F.concat(F.col(key).cast("string"), F.lit("|"), F.lit(str(seed))))
    d = df.withColumn("__h", h).withColumn("__one", F.lit(1))
    ranked = prefix_sums(d, ["__h"], ["__one"], partition_cols=[label], bucket=hash_bucket("__h"))
    return ranked.withColumn("__rank", F.col("__one_before") + 1).drop("__one", "__one_before")


def stratified_split(df: DataFrame, label: str, test_size: float = 0.2, seed: int = 42,
                     key: str = CUST, out: str = "split") -> DataFrame:
    """Exact stratified split: within every class the first
    round_half_up(n_class * test_size) rows in md5(id|seed) order are
    'test', the rest 'train'."""
    ranked = _class_ranks(df, label, seed, key)
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("__n"))
    j = ranked.join(sizes, label, "inner")
    n_test = F.floor(F.col("__n") * F.lit(float(test_size)) + F.lit(0.5))
    return j.withColumn(out, F.when(F.col("__rank") <= n_test, "test").otherwise("train")).drop("__h", "__rank", "__n")


def stratified_folds(df: DataFrame, label: str, k: int = 5, seed: int = 42, key: str = CUST,
                     out: str = "fold") -> DataFrame:
    """Fold id 0..k-1 dealt round-robin within each class in md5 order."""
    ranked = _class_ranks(df, label, seed, key)
    return ranked.withColumn(out, ((F.col("__rank") - 1) % k).cast("int")).drop("__h", "__rank")


# J5 -------------------------------------------------------------------------
def class_weight(df: DataFrame, label: str) -> DataFrame:
    return df.agg(
        F.count_if(F.col(label) == 0).alias("negatives"),
        F.count_if(F.col(label) == 1).alias("positives"),
    ).select("negatives", "positives", F.try_divide(F.col("negatives").cast("double"), F.col("positives").cast("double")).alias("pos_weight"))


def with_weights(df: DataFrame, label: str, pos_weight: Column | float, out: str = "weight") -> DataFrame:
    w = pos_weight if isinstance(pos_weight, Column) else F.lit(float(pos_weight))
    return df.withColumn(out, F.when(F.col(label) == 1, w).otherwise(F.lit(1.0)))


# J6 -------------------------------------------------------------------------
def best_iteration(aucs: list[tuple[int, float]], patience: int) -> int:
    """Ensemble size chosen by early stopping on validation AUC: scan sizes
    1, 2, ...; stop once ``patience`` sizes pass without beating the best;
    return the best size (first one on ties)."""
    best_k, best = 0, float("-inf")
    for k, auc in sorted(aucs):
        if auc is not None and auc > best:
            best_k, best = k, auc
        elif k - best_k >= patience:
            break
    return max(best_k, 1)


def fit_churn(train: DataFrame, features: list[str], label: str = "churn_label", cfg: ChurnConfig = ChurnConfig(),
              validation_fraction: float = 0.1, early_stopping: str | None = "auc", patience: int = 20,
              max_validation_rows: int = 200_000):
    """Gradient-boosted trees with the configured depth, learning rate,
    row subsampling and per-node feature fraction (``boosting.fit``, as a
    Spark model); class weight = negatives/positives of the training rows.

    ``early_stopping="auc"`` chooses the tree count on a validation split
    carved from the TRAINING rows (never the test rows): all trees are fitted
    on the other rows, the validation AUC of every ensemble prefix is computed
    exactly in one distributed pass (``attribution.prefix_aucs``), and the size
    is chosen with ``patience`` rounds without improvement.  The delivered model
    has that many trees fitted on ALL training rows; it grows in the same
    passes, as its first trees do not depend on their number.  The split takes
    ``validation_fraction`` of the labelled rows, at most
    ``max_validation_rows``, which bounds the rows x trees table of prefix
    margins.  ``None`` fits every tree on all training rows.

    The labelled rows are written out once; the fit takes them in key order,
    so that every fit samples the same rows."""
    from ..sources.io import materialise
    from . import boosting

    spark, features = train.sparkSession, list(features)
    cw = class_weight(train, label).first()
    n = cw["negatives"] + cw["positives"]
    weight = cw["pos_weight"] or 1.0
    if early_stopping is None:
        data = materialise(train.withColumn("fold", F.lit(-1)), "churn_train")
        fitted = boosting.fit(data, features, label, cfg, [weight], n, counted=(0,))
        fitted.blocks.unpersist()
        return boosting.as_model(spark, fitted, features)
    from .attribution import prefix_aucs

    fraction = min(validation_fraction, max_validation_rows / max(n, 1))
    split = stratified_split(train, label, fraction, cfg.random_state + 1, out="__val")
    data = materialise(split.withColumn("fold", F.when(F.col("__val") == "test", 0).otherwise(-1)), "churn_train")
    fitted = boosting.fit(data, features, label, cfg, [weight, weight], n - int(n * fraction), counted=(1,))
    fitted.blocks.unpersist()
    # One row per ensemble size (bounded by the tree count).
    chosen_on = boosting.as_model(spark, fitted, features, 0)
    aucs = [(r["k"], r["roc_auc"]) for r in prefix_aucs(chosen_on, data.filter(F.col("fold") == 0), features, label).collect()]
    return boosting.as_model(spark, fitted, features, 1, best_iteration(aucs, patience))


# J13 / J14 ------------------------------------------------------------------
def risk_tier(col: str | Column, include_lowest: bool = True) -> Column:
    """Right-closed bins (0, 0.3] (0.3, 0.6] (0.6, 1] -> Low/Medium/High;
    0.0 goes to Low with ``include_lowest`` (documented deviation), values
    outside [0, 1] give NULL."""
    c = F.col(col) if isinstance(col, str) else col
    lo, m1, m2, hi = CHURN_RISK_BINS
    first = (c >= lo) if include_lowest else (c > lo)
    return (
        F.when(first & (c <= m1), F.lit(CHURN_RISK_LABELS[0]))
        .when((c > m1) & (c <= m2), F.lit(CHURN_RISK_LABELS[1]))
        .when((c > m2) & (c <= hi), F.lit(CHURN_RISK_LABELS[2]))
    )


def score_churn(model, df: DataFrame, prob_digits: int = 4, tier_from_rounded: bool = True) -> DataFrame:
    """Probability of class 1 (4 dp), predicted class (model's decision at
    0.5) and risk tier.  The batch job bins the ROUNDED probability; the
    request path bins the raw one and rounds afterwards
    (``tier_from_rounded=False``)."""
    from pyspark.ml.functions import vector_to_array

    scored = model.transform(df).withColumn("__p", vector_to_array("probability")[1])
    tier = risk_tier(rnd("__p", prob_digits)) if tier_from_rounded else risk_tier("__p")
    return scored.select(
        CUST,
        rnd("__p", prob_digits).alias("ChurnProb"),
        F.col("prediction").cast("int").alias("Churned"),
        tier.alias("ChurnRisk"),
    )


# J15 ------------------------------------------------------------------------
def risk_distribution(df: DataFrame, col: str = "ChurnRisk") -> DataFrame:
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("customers"))
    total = counts.agg(F.sum("customers").alias("total"))
    return counts.crossJoin(F.broadcast(total)).select(
        col, F.col("customers").cast("bigint"), rnd(F.col("customers") * 100.0 / F.col("total"), 1).alias("pct")
    )


# J7 -------------------------------------------------------------------------
def cross_validate(df: DataFrame, features: list[str], label: str = "churn_label", k: int = 5,
                   cfg: ChurnConfig = ChurnConfig()) -> DataFrame:
    """Stratified k-fold ROC-AUC: (fold, roc_auc) rows plus mean and
    (population) std as extra columns.  Each fold fits ``cfg.n_estimators``
    trees without early stopping (pass the early-stopped size, as the
    reference's CV model uses the chosen iteration count), with the class
    weight of its own training rows; all folds grow in the same passes."""
    from ..sources.io import materialise
    from . import boosting
    from .metrics import roc_auc

    folded = materialise(stratified_folds(df, label, k, cfg.random_state), "churn_folds")
    held = {r["fold"]: r for r in folded.groupBy("fold").agg(
        F.count_if(F.col(label) == 0).alias("neg"), F.count_if(F.col(label) == 1).alias("pos")).collect()}  # one row a fold
    rest = [tuple(sum(r[c] for g, r in held.items() if g != f) for c in ("neg", "pos")) for f in range(k)]
    weights = [(neg / pos if pos else 0.0) or 1.0 for neg, pos in rest]
    fitted = boosting.fit(folded, list(features), label, cfg, weights, min(sum(r) for r in rest))
    spark = df.sparkSession
    aucs = {r["fold"]: r["roc_auc"] for r in roc_auc(fitted.held_out(spark, label), label, "margin", by=["fold"]).collect()}
    fitted.blocks.unpersist()
    out = spark.createDataFrame([(f, aucs.get(f)) for f in range(k)], "fold int, roc_auc double")
    stats = out.agg(F.avg("roc_auc").alias("mean_auc"), F.stddev_pop("roc_auc").alias("std_auc"))
    return out.crossJoin(stats)


# J16 (gain importance) ------------------------------------------------------------
def gain_importance(model, features: list[str], spark, top: int | None = None) -> DataFrame:
    gbt = model.stages[-1] if hasattr(model, "stages") else model
    imp = gbt.featureImportances.toArray()
    rows = sorted(((c, float(imp[i])) for i, c in enumerate(features)), key=lambda t: (-t[1], t[0]))
    if top:
        rows = rows[:top]
    return spark.createDataFrame(rows, "feature string, importance double")


# J17 ------------------------------------------------------------------------
def run_record(spark, kind: str, params: dict, metrics: dict, run_id: str | None = None) -> DataFrame:
    """Experiment record as long rows ``(run_id, kind, section, key, value)``
    ready to append to a runs table."""
    rid = run_id or uuid.uuid4().hex
    rows = [(rid, kind, "param", k, json.dumps(v) if not isinstance(v, str) else v) for k, v in params.items()]
    rows += [(rid, kind, "metric", k, str(v)) for k, v in metrics.items()]
    return spark.createDataFrame(rows, "run_id string, kind string, section string, key string, value string")


# J18 ------------------------------------------------------------------------
def model_meta(spark, threshold: float, features: list[str], threshold_days: int) -> DataFrame:
    return spark.createDataFrame(
        [(float(threshold), json.dumps(list(features)), int(threshold_days), "Recency > churn_threshold_days")],
        "threshold double, feature_cols string, churn_threshold_days int, churn_definition string",
    )
