"""Registered queries for fitted models and writers (no SQL twin: the driver
records a rows-only check; invariants are in tests/test_models.py).

Models are fitted on the staged customer feature table with the configured
values of the batch jobs (300 boosted trees, 10 K-Means starts)."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..config import CHURN_FEATURE_COLUMNS, CHURN_FEATURE_COLUMNS_CONFIGURED, CHURN_THRESHOLD_DAYS, RFM_FEATURE_COLUMNS, ChurnConfig, SegmentationConfig
from ..operators import churn as ch
from ..operators import metrics as mt
from ..operators import segment as sg
from ..operators import serving as sv
from ..session import app_id
from ..sources import io as sio
from . import oracle as o
from .catalog import register
from .queries_analytics import features
from .queries_core import clean_lines, raw

SCALED = [f"{c}_scaled" for c in RFM_FEATURE_COLUMNS]
_FITS: dict = {}


def _cached(spark, sf, name, build):
    key = (app_id(spark), os.path.abspath(sf), name)
    if key not in _FITS:
        _FITS[key] = build()
    return _FITS[key]


def scaled(spark, sf):
    f = features(spark, sf)
    return sg.scale_features(f, RFM_FEATURE_COLUMNS, sg.scaler_params(f))


def kmeans_fit(spark, sf):
    cfg = SegmentationConfig()
    return _cached(
        spark, sf, "kmeans",
        lambda: sg.fit_kmeans(scaled(spark, sf), SCALED, cfg.n_clusters, cfg.n_init, cfg.random_state, cfg.max_iter),
    )


def fitted_segments(spark, sf):
    model, _ = kmeans_fit(spark, sf)
    centres = sg.model_centres(model)
    s = sg.assign_segments(scaled(spark, sf), centres, SCALED)
    return sg.label_segments(s, sg.rank_centres(centres, RFM_FEATURE_COLUMNS))


# --- H: fitted segmentation --------------------------------------------------------
@register("h2_fit_kmeans")
def h2_fit_kmeans(spark, sf):
    model, cost = kmeans_fit(spark, sf)
    centres = sg.model_centres(model)
    mapping = sg.rank_centres(centres, RFM_FEATURE_COLUMNS)
    rows = [(cid, mapping.get(cid, "Unknown"), *c, float(cost)) for cid, c in centres]
    return spark.createDataFrame(
        rows, "cluster int, label string, recency_z double, log_frequency_z double, log_monetary_z double, inertia double"
    )


@register(
    "h2_fit_checks",
    o.with_ctes(
        o.FEATURE_CTE,
        "SELECT c AS \"check\", true AS holds, (SELECT count(*) FROM features) AS customers "
        "FROM (VALUES ('every customer is in its nearest cluster'), ('every centre is the mean of its customers'), "
        "('inertia is the sum of squared distances'), ('inertia falls from k to k + 1')) v(c)",
    ),
)
def h2_fit_checks(spark, sf):
    """What must hold of the fitted clusters, recomputed from the customers'
    coordinates and the returned centres alone."""
    model, cost = kmeans_fit(spark, sf)
    centres = sg.model_centres(model)
    table = spark.createDataFrame([(i, *c) for i, c in centres], "cluster int, " + ", ".join(f"m{j} double" for j in range(len(SCALED))))
    seg = fitted_segments(spark, sf).select("CustomerID", "Segment", *SCALED)
    far = sum((F.col(c) - F.col(f"m{j}")) ** 2 for j, c in enumerate(SCALED))
    pairs = seg.join(F.broadcast(table)).withColumn("far", far)  # a row a centre
    own = pairs.groupBy("CustomerID").agg(
        F.min("far").alias("nearest"), F.min(F.when(F.col("cluster") == F.col("Segment"), F.col("far"))).alias("own"))
    one = own.agg(F.count(F.lit(1)).alias("customers"), F.max(F.col("own") - F.col("nearest")).alias("worst"), F.sum("own").alias("inertia"))
    means = seg.groupBy("Segment").agg(*[F.avg(c).alias(f"a{j}") for j, c in enumerate(SCALED)]).join(
        F.broadcast(table), F.col("Segment") == F.col("cluster"))
    apart = means.agg(F.max(F.greatest(*[F.abs(F.col(f"a{j}") - F.col(f"m{j}")) for j in range(len(SCALED))])).alias("apart"))
    falls = h9_elbow(spark, sf).withColumn("before", F.lag("inertia").over(Window.orderBy("k"))).agg(
        F.max(F.col("inertia") - F.col("before")).alias("rise"))
    r = one.crossJoin(F.broadcast(apart)).crossJoin(F.broadcast(falls))
    checks = F.array(
        F.struct(F.lit("every customer is in its nearest cluster").alias("check"), (F.col("worst") <= 1e-9).alias("holds")),
        F.struct(F.lit("every centre is the mean of its customers").alias("check"), (F.col("apart") <= 1e-3).alias("holds")),
        F.struct(F.lit("inertia is the sum of squared distances").alias("check"),
                 (F.abs(F.col("inertia") - float(cost)) <= 1e-6 * F.col("inertia")).alias("holds")),
        F.struct(F.lit("inertia falls from k to k + 1").alias("check"), (F.col("rise") < 0).alias("holds")))
    return r.select("customers", F.explode(checks).alias("c")).select("c.check", "c.holds", "customers")


@register("h4_silhouette")
def h4_silhouette(spark, sf):
    s = fitted_segments(spark, sf)
    sil = sg.silhouette(s, SCALED, "Segment")
    return spark.createDataFrame([(float(sil), "squaredEuclidean")], "silhouette double, distance string")


@register("h9_elbow")
def h9_elbow(spark, sf):
    return _cached(spark, sf, "elbow", lambda: sg.elbow(scaled(spark, sf), SCALED, range(2, 11)).cache())


@register("h10_choose_k")
def h10_choose_k(spark, sf):
    return sg.choose_k(h9_elbow(spark, sf))


@register("h11_stability")
def h11_stability(spark, sf):
    """Seeds 0-9 with the k that the silhouette sweep chooses."""
    k = h10_choose_k(spark, sf).first()["best_k"]
    return sg.stability(scaled(spark, sf), SCALED, k=k, n_seeds=10, seed=0)


def _pca(df, cols):
    pcs, ev = sg.pca_2d(df, cols)
    return pcs.withColumn("explained_pc1", F.lit(ev[0])).withColumn("explained_pc2", F.lit(ev[1]))


@register("h13_pca_2d")
def h13_pca_2d(spark, sf):
    """On recency and the logs of frequency and monetary."""
    return _pca(features(spark, sf), RFM_FEATURE_COLUMNS)


@register("h13_pca_2d_scaled")
def h13_pca_2d_scaled(spark, sf):
    """On the same three columns, standardised."""
    return _pca(scaled(spark, sf), SCALED)


def segment_split(spark, sf):
    """Rows of the segment classifier with their split, written once: a fit
    passes over them many times."""

    def build():
        s = fitted_segments(spark, sf).select("CustomerID", "Segment", *SCALED, "AOV")
        return sio.materialise(ch.stratified_split(s, "Segment", 0.2, 42), "segment_split")

    return _cached(spark, sf, "segment_split", build)


def _seg_classifier(spark, sf):
    def build():
        split = segment_split(spark, sf)
        model = sg.fit_segment_classifier(split.filter(F.col("split") == "train"), SCALED + ["AOV"], "Segment", 200, 42)
        return model, split

    return _cached(spark, sf, "seg_classifier", build)


@register("h15_segment_classifier")
def h15_segment_classifier(spark, sf):
    model, split = _seg_classifier(spark, sf)
    test = sg.vectorise(split.filter(F.col("split") == "test"), SCALED + ["AOV"])
    pred = model.transform(test)
    return mt.multiclass_report(pred.withColumn("predicted", F.col("prediction").cast("int")), "Segment", "predicted")


@register("h16_feature_importance")
def h16_feature_importance(spark, sf):
    model, _ = _seg_classifier(spark, sf)
    return sg.feature_importance(model, SCALED + ["AOV"], spark)


@register("h17_model_meta")
def h17_model_meta(spark, sf):
    model, cost = kmeans_fit(spark, sf)
    centres = sg.model_centres(model)
    sil = sg.silhouette(fitted_segments(spark, sf), SCALED, "Segment")
    return sg.model_meta(
        spark, k=len(centres), inertia=float(cost), silhouette=float(sil), columns=RFM_FEATURE_COLUMNS,
        labels=sg.rank_centres(centres, RFM_FEATURE_COLUMNS),
    )


# --- J: fitted churn model ---------------------------------------------------------------
def churn_split(spark, sf, columns):
    """Labelled rows with their split, written once a column list: fits,
    folds, scores and metrics all read them again."""

    def build():
        lab = ch.churn_label(fitted_segments(spark, sf))
        sel, used = ch.select_features(lab, columns, keep=("CustomerID", "churn_label"))
        return sio.materialise(ch.stratified_split(sel, "churn_label", 0.2, 42), "churn_split"), used

    return _cached(spark, sf, ("churn_split", tuple(columns)), build)


def churn_data(spark, sf):
    return churn_split(spark, sf, CHURN_FEATURE_COLUMNS)


def churn_model(spark, sf):
    def build():
        data, used = churn_data(spark, sf)
        cfg = ChurnConfig()
        model = ch.fit_churn(data.filter(F.col("split") == "train"), used, "churn_label", cfg)
        return model, used

    return _cached(spark, sf, "churn_gbt", build)


def churn_test(spark, sf):
    """(CustomerID, churn_label, p, prediction) of the test rows: the trees
    are walked once, every metric reads the scores."""
    from pyspark.ml.functions import vector_to_array

    def build():
        model, _ = churn_model(spark, sf)
        data, _ = churn_data(spark, sf)
        scored = model.transform(data.filter(F.col("split") == "test")).withColumn("p", vector_to_array("probability")[1])
        return sio.materialise(scored.select("CustomerID", "churn_label", "p", "prediction"), "churn_test")

    return _cached(spark, sf, "churn_test", build)


@register("j6_fit_churn")
def j6_fit_churn(spark, sf):
    test = churn_test(spark, sf)
    auc = mt.roc_auc(test, "churn_label", "p").select(F.lit("test_roc_auc").alias("metric"), F.col("roc_auc").alias("value"))
    ap = mt.average_precision(test, "churn_label", "p").select(F.lit("test_average_precision").alias("metric"), F.col("average_precision").alias("value"))
    return auc.unionByName(ap)


@register("j7_cross_validate")
def j7_cross_validate(spark, sf):
    """5-fold CV with the tree count early stopping chose for the main model
    (the reference's CV model uses the chosen iteration count)."""
    data, used = churn_data(spark, sf)
    model, _ = churn_model(spark, sf)
    k = len(model.stages[-1].trees)
    return ch.cross_validate(data.filter(F.col("split") == "train"), used, "churn_label", 5, ChurnConfig(n_estimators=k))


@register("j13_score_churn")
def j13_score_churn(spark, sf):
    model, _ = churn_model(spark, sf)
    data, _ = churn_data(spark, sf)
    return ch.score_churn(model, data)


@register("j16_gain_importance")
def j16_gain_importance(spark, sf):
    model, used = churn_model(spark, sf)
    return ch.gain_importance(model, used, spark, top=5)


@register("j16_shap_attribution")
def j16_shap_attribution(spark, sf):
    from ..operators.attribution import mean_abs_shap

    model, used = churn_model(spark, sf)
    data, _ = churn_data(spark, sf)
    return mean_abs_shap(model, data.filter(F.col("split") == "test"), used, top=5)


@register("j17_run_record")
def j17_run_record(spark, sf):
    """Settings, trees kept, ranking and decision metrics of the fit."""
    from .jobs import decision_metrics

    model, used = churn_model(spark, sf)
    cfg = ChurnConfig()
    metrics = {r["metric"]: r["value"] for r in j6_fit_churn(spark, sf).collect()}
    metrics |= decision_metrics(churn_test(spark, sf))
    params = {"n_estimators": cfg.n_estimators, "trees_kept": len(model.stages[-1].trees), "max_depth": cfg.max_depth,
              "learning_rate": cfg.learning_rate, "subsample": cfg.subsample, "colsample_bytree": cfg.colsample_bytree,
              "test_size": cfg.test_size, "churn_threshold_days": CHURN_THRESHOLD_DAYS, "features": used}
    return ch.run_record(spark, "churn", params, metrics, run_id="query")


@register("j18_model_meta")
def j18_model_meta(spark, sf):
    _, used = churn_model(spark, sf)
    best = mt.best_f1_threshold(churn_test(spark, sf), "churn_label", "p").first()["threshold"]
    # the record names the threshold the label of churn_data was made with
    return ch.model_meta(spark, best, used, CHURN_THRESHOLD_DAYS)


def saved_churn_model(spark, sf):
    """Folder of the model on all request columns, fitted and written once."""

    def build():
        data, used = churn_split(spark, sf, CHURN_FEATURE_COLUMNS_CONFIGURED)
        model = ch.fit_churn(data.filter(F.col("split") == "train"), used, "churn_label", ChurnConfig())
        path = os.path.join(sio.checkpoint_dir(spark), f"churn-model-{uuid.uuid4().hex[:12]}")
        return sv.save_churn_model(spark, model, used, 0.5, CHURN_THRESHOLD_DAYS, path)

    return _cached(spark, sf, "churn_saved", build)


@register("l18_score_churn_requests")
def l18_score_churn_requests(spark, sf):
    """Batch churn scoring of request records (validated first, DQ1) by a
    model loaded from disk, on all 16 request features."""
    from ..operators import quality as q
    from .queries_analytics import REQ_MAP

    reqs = fitted_segments(spark, sf).select(F.col("CustomerID").alias("customer_id"), *[F.col(v).alias(k) for k, v in REQ_MAP.items()])
    good, _ = q.validate_requests(reqs, "churn")
    return sv.score_churn_requests(sv.load_churn_model(spark, saved_churn_model(spark, sf)), good, REQ_MAP)


# --- A: writers and checks ------------------------------------------------------------------
@register(
    "a3_validate_raw",
    o.with_ctes(
        o.RAW_CTE,
        "SELECT count(*) AS rows, true AS required_columns_present FROM raw",
    ),
)
def a3_validate_raw(spark, sf):
    from ..operators import quality as q

    r = raw(spark, sf)
    q.validate_raw(r)
    return r.agg(F.count(F.lit(1)).alias("rows")).withColumn("required_columns_present", F.lit(True))


@register(
    "a4_save_verify",
    o.with_ctes(
        o.CLEAN_CTE,
        "SELECT strftime(InvoiceDate, '%Y-%m') AS invoice_month, count(*) AS rows, "
        "(SELECT count(*) FROM clean) AS verified_total FROM clean GROUP BY 1",
    ),
)
def a4_save_verify(spark, sf):
    """Write the cleaned lines partitioned by invoice month, verify the
    stored count equals the observed written count (A4, A5, A9, A10)."""
    path = os.path.join(sio.checkpoint_dir(spark), f"a4-{uuid.uuid4().hex[:8]}")
    written = sio.save_table(sio.with_month_partition(clean_lines(spark, sf)), None, "overwrite", path, ["invoice_month"])
    stored = sio.verify_count(spark, None, written, path)
    back = spark.read.parquet(path)
    return back.groupBy(F.col("invoice_month").cast("string").alias("invoice_month")).agg(
        F.count(F.lit(1)).alias("rows")
    ).withColumn("verified_total", F.lit(stored).cast("bigint"))


@register(
    "a8_named_tables",
    o.with_ctes(
        o.FEATURE_CTE,
        "SELECT t AS table_name, (SELECT count(*) FROM features) AS written, (SELECT count(*) FROM features) AS recorded, "
        "(SELECT count(*) FROM features) AS rows, (SELECT count(DISTINCT CustomerID) FROM features) AS customers, "
        "(SELECT sum(Frequency) FROM features)::BIGINT AS invoices FROM (VALUES ('features'), ('segments'), ('predictions')) v(t)",
    ),
)
def a8_named_tables(spark, sf):
    """Features, segments and predictions written as catalog tables, with
    statistics, and read back by name (A8, A9)."""
    from .queries_analytics import churn, segments

    mark = uuid.uuid4().hex[:8]
    f = features(spark, sf)
    tables = {"features": f, "segments": segments(spark, sf),
              "predictions": churn(spark, sf).join(f.select("CustomerID", "Frequency"), "CustomerID")}
    out = None
    for name, df in tables.items():
        at = f"a8_{name}_{mark}"
        written = sio.save_named(df, at, os.path.join(sio.checkpoint_dir(spark), at))
        one = sio.read_table(spark, at).agg(
            F.count(F.lit(1)).alias("rows"), F.count_distinct("CustomerID").alias("customers"),
            F.sum("Frequency").cast("bigint").alias("invoices"),
        ).select(F.lit(name).alias("table_name"), F.lit(written).cast("bigint").alias("written"),
                 F.lit(sio.recorded_rows(spark, at)).cast("bigint").alias("recorded"), "rows", "customers", "invoices")
        out = one if out is None else out.unionByName(one)
    return out


@register("a6_ensure_database")
def a6_ensure_database(spark, sf):
    sio.ensure_database(spark, "retail", os.path.join(sio.checkpoint_dir(spark), "warehouse", "retail.db"))
    return spark.sql("SHOW DATABASES").filter(F.col("namespace") == "retail")


@register(
    "a4_incremental_append",
    o.with_ctes(
        o.RAW_CTE,
        "SELECT DISTINCT InvoiceNo, StockCode, Description, Quantity, InvoiceDate, CAST(UnitPrice AS DOUBLE) AS UnitPrice, "
        "CustomerID, Country FROM raw",
    ),
)
def a4_incremental_append(spark, sf):
    """Two incremental loads into one table with keyed de-duplication: the
    'F' line-status part first, then ALL raw lines (overlapping the first
    load and carrying duplicate rows); the table ends up holding every
    distinct line exactly once."""
    from ..sources.versioned import VersionedTable
    from ..streaming.incremental import merge_new
    from .queries_core import doubles, tagged

    base = sio.with_month_partition(tagged(spark, sf))
    table = VersionedTable(spark, os.path.join(sio.checkpoint_dir(spark), f"incr-{uuid.uuid4().hex[:8]}"))
    merge_new(base.filter(F.col("l_linestatus") == "F").drop("l_linestatus"), table)
    merge_new(sio.with_month_partition(raw(spark, sf)), table)
    return doubles(table.read().drop("invoice_month"))


@register(
    "a9_publish_versions",
    o.with_ctes(
        o.CLEAN_CTE,
        "SELECT 1 AS version, 0 AS current, count(*) AS rows, CAST(sum(Quantity) AS BIGINT) AS quantity "
        "FROM raw_tagged WHERE LineStatus = 'F' "
        "UNION ALL SELECT 2, 0, count(*), CAST(sum(Quantity) AS BIGINT) FROM raw_tagged "
        "UNION ALL SELECT 3, 1, count(*), CAST(sum(Quantity) AS BIGINT) FROM clean",
    ),
)
def a9_publish_versions(spark, sf):
    """One table through its versions: the 'F' part of the raw lines, the 'O'
    part appended, then the cleaned lines in their place; a load whose
    validation fails in between is never seen.  Rows and quantity of every
    version, read through its manifest (A4, A9, A11)."""
    from ..operators import quality as q
    from ..sources.versioned import VersionedTable
    from .queries_core import tagged

    table = VersionedTable(spark, os.path.join(sio.checkpoint_dir(spark), f"a9-{uuid.uuid4().hex[:8]}"))
    parts = sio.with_month_partition(tagged(spark, sf))
    lines = lambda status: parts.filter(F.col("l_linestatus") == status).drop("l_linestatus")
    table.publish(lines("F"), partition_by=["invoice_month"])
    table.publish(lines("O"), "append")
    try:  # the raw lines are no clean table
        table.publish(lines("F"), partition_by=["invoice_month"], validate=lambda t: q.validate_clean(t.withColumn("Revenue", F.lit(0.0))))
    except q.ValidationError:
        pass
    table.publish(sio.with_month_partition(clean_lines(spark, sf)), partition_by=["invoice_month"])
    numbers = table.versions()
    out = None
    for n in numbers:
        one = table.read(n).agg(F.count(F.lit(1)).alias("rows"), F.sum("Quantity").cast("bigint").alias("quantity")).select(
            F.lit(n).alias("version"), F.lit(int(n == numbers[-1])).alias("current"), "rows", "quantity")
        out = one if out is None else out.unionByName(one)
    return out
