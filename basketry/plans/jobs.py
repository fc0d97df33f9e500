"""The four batch jobs: clean -> features -> segments -> churn.

Each job reads the published version of its input table(s), builds one lazy
plan, writes parquet (partitioned where reads are date-bounded), verifies the
stored row count against the count observed during the write, validates the
stored rows and then publishes them as the next version.  Tables are hand-offs on shared storage, which
also cuts lineage between jobs (a lost executor never recomputes an
upstream job).

    python -m basketry.plans.jobs all --sf-dir /root/testdata/sf0.01 --out /shared/retail
"""

from __future__ import annotations

import argparse
import json
import logging
import os
import time
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ChurnConfig, ETLConfig, SegmentationConfig
from ..operators import churn as ch
from ..operators import clean as cl
from ..operators import cohort as coh
from ..operators import metrics as mt
from ..operators import quality as q
from ..operators import segment as sg
from ..sources import io as sio
from ..sources.versioned import VersionedTable

log = logging.getLogger("basketry.jobs")

RAW, CLEAN, INVOICES, FEATURES, SEGMENTS, PREDICTIONS, RUNS = (
    "raw_transactions", "cleaned_transactions", "invoices", "customer_features", "segment_results",
    "churn_predictions", "runs",
)


def _p(out: str, name: str) -> str:
    return os.path.join(out, name)


def _write(df: DataFrame, path: str, partition_by=None, validate=None) -> int:
    """Publish the table as its next version once its rows are written,
    counted and valid; until then, and if the job dies on the way, readers
    keep the last version.  One earlier version stays for readers at work."""
    table = VersionedTable(df.sparkSession, path)
    rows = table.publish(df, "overwrite", partition_by, validate).rows
    table.expire(keep=2)
    return rows


def read(spark: SparkSession, out: str, name: str) -> DataFrame:
    """The published version of a job's table."""
    return VersionedTable(spark, _p(out, name)).read()


def _audit(report: DataFrame, out: str, name: str) -> None:
    report.write.mode("overwrite").parquet(_p(out, f"audits/{name}"))


def run_etl(spark: SparkSession, raw: DataFrame, out: str, cfg: ETLConfig = ETLConfig()) -> dict:
    """Validate and persist the raw lines (also needed for return rates),
    clean them, validate, write the cleaned table partitioned by month."""
    t0 = time.time()
    q.validate_raw(raw)
    n_raw = _write(raw, _p(out, RAW))
    raw_t = read(spark, out, RAW)
    clean = cl.clean(raw_t, cfg, validate=False)
    n_clean = _write(
        sio.with_month_partition(clean), _p(out, CLEAN), ["invoice_month"],
        lambda t: q.validate_clean(t.drop("invoice_month"), cfg),
    )
    _audit(cl.clean_audit(raw_t, cfg), out, "clean")
    return {"raw_rows": n_raw, "clean_rows": n_clean, "seconds": round(time.time() - t0, 2)}


def _validate_features(t: DataFrame) -> None:
    """The matrix as a whole, and each group of columns by its own rules."""
    q.validate_features(t)
    q.validate_rfm(t.select("CustomerID", "Recency", "Frequency", "Monetary"))
    q.validate_behavioural(t.select("CustomerID", "AOV"))
    q.validate_cohort(t.select("CustomerID", "CohortMonth", "ActiveMonths", "DaysSinceFirstPurchase"))


def run_features(spark: SparkSession, out: str) -> dict:
    t0 = time.time()
    clean = sio.prepare_clean(read(spark, out, CLEAN).drop("invoice_month"))
    raw = read(spark, out, RAW)
    from ..operators.behavioural import invoice_totals

    _write(invoice_totals(clean), _p(out, INVOICES))
    invoices = read(spark, out, INVOICES)
    feats = coh.feature_matrix(clean, raw, invoices=invoices)
    n = _write(feats, _p(out, FEATURES), validate=_validate_features)
    return {"customers": n, "seconds": round(time.time() - t0, 2)}


def run_segmentation(spark: SparkSession, out: str, cfg: SegmentationConfig = SegmentationConfig()) -> dict:
    """Standardise RFM columns, best-of-n K-Means, label clusters by ranking
    centres, write segment results, the model and a run record."""
    t0 = time.time()
    feats = read(spark, out, FEATURES)
    cols = list(cfg.rfm_columns)
    params = sg.scaler_params(feats, cols)
    z = sg.scale_features(feats, cols, params)
    scaled = [f"{c}_scaled" for c in cols]
    model, cost = sg.fit_kmeans(z, scaled, cfg.n_clusters, cfg.n_init, cfg.random_state, cfg.max_iter)
    centres = sg.model_centres(model)
    mapping = sg.rank_centres(centres, cols)
    seg = sg.label_segments(sg.assign_segments(z, centres, scaled), mapping).drop(*scaled)
    n = _write(seg, _p(out, SEGMENTS))
    stored = read(spark, out, SEGMENTS)
    sil = sg.silhouette(sg.scale_features(stored, cols, params), scaled, "Segment")
    model.write().overwrite().save(_p(out, "models/kmeans"))
    params.write.mode("overwrite").parquet(_p(out, "models/scaler"))
    sg.segment_profile(stored).write.mode("overwrite").parquet(_p(out, "segment_profile"))
    counts = {r["SegmentLabel"]: r["customers"] for r in sg.segment_distribution(stored, "SegmentLabel").collect()}
    metrics = {"silhouette_sq_euclidean": round(sil, 4), "inertia": cost, "n_customers": n,
               **{f"segment_{k}_count": v for k, v in counts.items()}}
    ch.run_record(spark, "segmentation", {"n_clusters": cfg.n_clusters, "n_init": cfg.n_init,
                                         "random_state": cfg.random_state, "rfm_columns": cols}, metrics).write.mode(
        "append").parquet(_p(out, RUNS))
    return {**metrics, "labels": mapping, "seconds": round(time.time() - t0, 2)}


def decision_metrics(test: DataFrame) -> dict:
    """Confusion counts at 0.5 and the rates that follow from them."""
    y, yhat = F.col("churn_label") == 1, F.col("prediction") == 1
    c = test.agg(
        F.count_if(y & yhat).alias("tp"), F.count_if(~y & yhat).alias("fp"),
        F.count_if(~y & ~yhat).alias("tn"), F.count_if(y & ~yhat).alias("fn"),
    ).first().asDict()
    ratio = lambda a, b: round(a / b, 4) if b else 0.0
    return {
        **c, "accuracy": ratio(c["tp"] + c["tn"], sum(c.values())), "precision": ratio(c["tp"], c["tp"] + c["fp"]),
        "recall": ratio(c["tp"], c["tp"] + c["fn"]), "f1": ratio(2 * c["tp"], 2 * c["tp"] + c["fp"] + c["fn"]),
    }


def run_churn(spark: SparkSession, out: str, cfg: ChurnConfig = ChurnConfig()) -> dict:
    """Label, stratified split, boosted trees with class weight, test
    metrics, cross-validation, scores for every customer (with the split they
    were in), risk tiers and their distribution, attribution of every
    feature, model with its threshold, and run record."""
    from pyspark.ml.functions import vector_to_array

    from ..operators.attribution import mean_abs_shap

    t0 = time.time()
    seg = read(spark, out, SEGMENTS)
    lab = ch.churn_label(seg, cfg.threshold_days)
    sel, used = ch.select_features(lab, list(cfg.feature_columns), keep=("CustomerID", "churn_label"))
    data = ch.stratified_split(sel, "churn_label", cfg.test_size, cfg.random_state)
    data = sio.materialise(data, "churn_input")
    model = ch.fit_churn(data.filter(F.col("split") == "train"), used, "churn_label", cfg)
    test = model.transform(data.filter(F.col("split") == "test")).withColumn("p", vector_to_array("probability")[1])
    auc = mt.roc_auc(test, "churn_label", "p").first()[0]
    ap = mt.average_precision(test, "churn_label", "p").first()[0]
    best = mt.best_f1_threshold(test, "churn_label", "p").first()
    scores = ch.score_churn(model, data).join(data.select("CustomerID", "split"), "CustomerID")
    n = _write(scores, _p(out, PREDICTIONS))
    model.write().overwrite().save(_p(out, "models/churn"))
    ch.model_meta(spark, best["threshold"], used, cfg.threshold_days).write.mode("overwrite").parquet(
        _p(out, "models/churn_meta"))
    ch.risk_distribution(scores).write.mode("overwrite").parquet(_p(out, "risk_distribution"))
    shap = mean_abs_shap(model, data.filter(F.col("split") == "test"), used, top=len(used))
    shap.write.mode("overwrite").parquet(_p(out, "churn_attribution"))
    chosen = replace(cfg, n_estimators=len(model.stages[-1].trees))
    cv = ch.cross_validate(data.filter(F.col("split") == "train"), used, "churn_label", cfg.cv_folds, chosen).first()
    metrics = {"test_roc_auc": round(auc, 4), "test_average_precision": round(ap, 4),
               "cv_mean_auc": round(cv["mean_auc"], 4), "cv_std_auc": round(cv["std_auc"], 4),
               "decision_threshold": round(best["threshold"], 4), "best_f1": round(best["f1"], 4),
               **decision_metrics(test), "scored": n}
    params = {"n_estimators": cfg.n_estimators, "trees_kept": chosen.n_estimators, "max_depth": cfg.max_depth,
              "learning_rate": cfg.learning_rate, "subsample": cfg.subsample,
              "colsample_bytree": cfg.colsample_bytree, "test_size": cfg.test_size,
              "churn_threshold_days": cfg.threshold_days, "features": used}
    attribution = {f"shap_{r['feature']}": r["mean_abs_shap"] for r in shap.collect()}  # one row a feature
    ch.run_record(spark, "churn", params, {**metrics, **attribution}).write.mode("append").parquet(_p(out, RUNS))
    return {**metrics, "seconds": round(time.time() - t0, 2)}


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="basketry.plans.jobs")
    ap.add_argument("job", choices=["etl", "features", "segments", "churn", "all"])
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    ap.add_argument("--out", required=True)
    ap.add_argument("--trees", type=int, default=None)
    args = ap.parse_args(argv)
    from ..session import get_spark
    from ..sources.fixtures import raw_order_lines

    spark = get_spark()
    res = {}
    if args.job in ("etl", "all"):
        res["etl"] = run_etl(spark, raw_order_lines(spark, args.sf_dir), args.out)
    if args.job in ("features", "all"):
        res["features"] = run_features(spark, args.out)
    if args.job in ("segments", "all"):
        res["segments"] = run_segmentation(spark, args.out)
    if args.job in ("churn", "all"):
        cfg = ChurnConfig(n_estimators=args.trees) if args.trees else ChurnConfig()
        res["churn"] = run_churn(spark, args.out, cfg)
    print(json.dumps(res, default=str))


if __name__ == "__main__":
    main()
