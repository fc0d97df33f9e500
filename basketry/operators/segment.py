"""Customer segmentation.

SQL-exact operators (scaling, nearest-centre assignment, labels, profiles,
box statistics, ARI) are DataFrame expressions.  Fitted models use
``pyspark.ml`` on the one-row-per-customer table, which is tiny next to the
order lines; it is cached once and every fit is a distributed job.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import COL_CUSTOMER_ID, RFM_FEATURE_COLUMNS, SEGMENT_LABELS
from ..functions.numeric import rnd

CUST = COL_CUSTOMER_ID


# H1 / H12 -------------------------------------------------------------------
def scaler_params(df: DataFrame, cols=RFM_FEATURE_COLUMNS, digits: int = 10) -> DataFrame:
    """One row: mean and POPULATION std of every column (the reference's
    scaler), rounded to ``digits`` so every engine scales identically."""
    aggs = []
    for c in cols:
        aggs += [rnd(F.avg(F.col(c).cast("double")), digits).alias(f"{c}__mean"),
                 rnd(F.stddev_pop(F.col(c).cast("double")), digits).alias(f"{c}__std")]
    return df.agg(*aggs)


def scale_features(df: DataFrame, cols=RFM_FEATURE_COLUMNS, params: DataFrame | None = None,
                   suffix: str = "_scaled") -> DataFrame:
    """Standardise ``cols`` -> ``<col>_scaled`` = (x - mean) / std (std 0 ->
    0.0).  ``params`` (one row from ``scaler_params``) is broadcast."""
    p = params if params is not None else scaler_params(df, cols)
    out = df.crossJoin(F.broadcast(p))
    for c in cols:
        std = F.col(f"{c}__std")
        out = out.withColumn(
            f"{c}{suffix}",
            F.when(std > 0, (F.col(c).cast("double") - F.col(f"{c}__mean")) / std).otherwise(F.lit(0.0)),
        )
    return out.drop(*[f"{c}__{s}" for c in cols for s in ("mean", "std")])


# H3 -------------------------------------------------------------------------
def assign_segments(df: DataFrame, centres: list[tuple[int, list[float]]], cols: list[str],
                    out: str = "Segment") -> DataFrame:
    """Nearest centre by squared Euclidean distance; ``centres`` is a list
    of (cluster id, coordinates).  Ties go to the smaller distance, then the
    smaller id (min over (distance, id) structs)."""
    dists = []
    for cid, coords in centres:
        d = None
        for c, v in zip(cols, coords):
            t = (F.col(c) - F.lit(float(v))) * (F.col(c) - F.lit(float(v)))
            d = t if d is None else d + t
        dists.append(F.struct(d.alias("d"), F.lit(int(cid)).alias("id")))
    return df.withColumn(out, F.array_min(F.array(*dists))["id"])


# H6 -------------------------------------------------------------------------
def rank_centres(centres: list[tuple[int, list[float]]], cols: list[str],
                 labels=SEGMENT_LABELS) -> dict[int, str]:
    """Map cluster ids to labels by ranking centres (in standardised space)
    on z(Monetary-like) + z(Frequency-like) - z(Recency), best first.
    ``cols`` must name the recency, frequency and monetary coordinates."""
    idx = {c: i for i, c in enumerate(cols)}
    r, f, m = idx[cols[0]], idx[cols[1]], idx[cols[2]]
    score = {cid: v[m] + v[f] - v[r] for cid, v in centres}
    ordered = sorted(score, key=lambda k: (-score[k], k))
    return {cid: labels[rank] for rank, cid in enumerate(ordered) if rank in labels}


def label_segments(df: DataFrame, mapping: dict[int, str], col: str = "Segment",
                   out: str = "SegmentLabel") -> DataFrame:
    """Dictionary lookup as a ``map`` literal expression (no join);
    unmapped ids become ``Unknown``."""
    m = F.create_map(*[x for k, v in sorted(mapping.items()) for x in (F.lit(int(k)), F.lit(v))])
    return df.withColumn(out, F.coalesce(m[F.col(col)], F.lit("Unknown")))


# H5 -------------------------------------------------------------------------
def segment_distribution(df: DataFrame, col: str = "Segment") -> DataFrame:
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("customers"))
    total = counts.agg(F.sum("customers").alias("total"))
    return counts.crossJoin(F.broadcast(total)).select(
        col, F.col("customers").cast("bigint"), rnd(F.col("customers") * 100.0 / F.col("total"), 1).alias("pct")
    )


# H7 / L8 ----------------------------------------------------------------------
def segment_profile(df: DataFrame, by: str = "SegmentLabel", dp: int = 2, share_dp: int = 1) -> DataFrame:
    """Mean Recency/Frequency/Monetary/AOV (``dp`` decimals), customer count
    and revenue share % of the INPUT (so a filtered selection gets shares
    relative to itself)."""
    g = df.groupBy(by).agg(
        F.avg("Recency").alias("r"), F.avg("Frequency").alias("f"), F.avg("Monetary").alias("m"),
        F.avg("AOV").alias("a"), F.count(F.lit(1)).alias("Count"), F.sum("Monetary").alias("rev"),
    )
    total = df.agg(F.sum("Monetary").alias("total"))
    return g.crossJoin(F.broadcast(total)).select(
        by,
        rnd("r", dp).alias("Recency"),
        rnd("f", dp).alias("Frequency"),
        rnd("m", dp).alias("Monetary"),
        rnd("a", dp).alias("AOV"),
        F.col("Count").cast("bigint"),
        rnd(F.col("rev") / F.col("total") * 100.0, share_dp).alias("RevenueShare"),
    )


# H8 -------------------------------------------------------------------------
def revenue_concentration(df: DataFrame, by: str = "SegmentLabel") -> DataFrame:
    g = df.groupBy(by).agg(F.sum("Monetary").alias("revenue"), F.count(F.lit(1)).alias("customers"))
    total = df.agg(F.sum("Monetary").alias("total"))
    return (
        g.crossJoin(F.broadcast(total))
        .select(
            by,
            rnd("revenue", 2).alias("revenue"),
            rnd(F.col("revenue") / F.col("total") * 100.0, 1).alias("revenue_pct"),
            F.col("customers").cast("bigint"),
        )
        .orderBy(F.desc("revenue"), by)
    )


# H14 ------------------------------------------------------------------------
def box_stats_all(df: DataFrame, by: str, cols: list[str], digits: int = 6) -> DataFrame:
    """Box-plot statistics per group and column: exact quartiles (linear),
    IQR, whiskers at the furthest values within 1.5 IQR of the box, outlier
    count.  Quartiles of all columns come from one selection and whiskers from
    one aggregate, so four scans whatever the number of columns; the boxes (a
    row a group) are broadcast.  Reported to ``digits`` decimals (house rule),
    whiskers are data values."""
    from ..functions.selection import select_quantiles

    found = select_quantiles(df, cols, {"q1": 0.25, "median": 0.5, "q3": 0.75}, by=[by])
    schema = T.StructType([T.StructField("__by", df.schema[by].dataType), *[
        T.StructField(f"__{k}{i}", T.DoubleType()) for i in range(len(cols)) for k in ("q1", "median", "q3")]])
    boxes = df.sparkSession.createDataFrame(
        [(g[0], *[x for c in cols for x in each[c].values()]) for g, each in found], schema)
    rows = df.select(F.col(by).alias("__g"), *[F.col(c).cast("double").alias(f"__v{i}") for i, c in enumerate(cols)])
    joined = rows.join(F.broadcast(boxes), F.col("__g") == F.col("__by"))
    aggs = []
    for i in range(len(cols)):
        v, q1, q3 = F.col(f"__v{i}"), F.col(f"__q1{i}"), F.col(f"__q3{i}")
        low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        aggs.append(F.struct(
            F.count(v).alias("n"), F.first(q1).alias("q1"), F.first(f"__median{i}").alias("median"), F.first(q3).alias("q3"),
            F.min(F.when(v >= low, v)).alias("whisker_low"), F.max(F.when(v <= high, v)).alias("whisker_high"),
            F.count_if((v < low) | (v > high)).alias("outliers"), F.lit(cols[i]).alias("measure")).alias(f"s{i}"))
    each = joined.groupBy("__g").agg(*aggs).select("__g", F.explode(F.array(*[f"s{i}" for i in range(len(cols))])).alias("s"))
    return each.filter("s.n > 0").select(
        F.col("__g").alias(by), F.col("s.measure").alias("measure"), F.col("s.n").alias("n"),
        *[rnd(x, digits).alias(k) for k, x in (("q1", F.col("s.q1")), ("median", F.col("s.median")), ("q3", F.col("s.q3")),
                                               ("iqr", F.col("s.q3") - F.col("s.q1")))],
        F.col("s.whisker_low").alias("whisker_low"), F.col("s.whisker_high").alias("whisker_high"),
        F.col("s.outliers").cast("bigint").alias("outliers"))


def box_stats(df: DataFrame, by: str, col: str, digits: int = 6) -> DataFrame:
    """``box_stats_all`` of one column."""
    return box_stats_all(df, by, [col], digits).drop("measure")


# H2 -------------------------------------------------------------------------
def vectorise(df: DataFrame, cols: list[str], out: str = "features") -> DataFrame:
    from pyspark.ml.feature import VectorAssembler

    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="keep").transform(df)


def fit_kmeans(df: DataFrame, cols: list[str], k: int = 4, n_init: int = 10, seed: int = 42,
               max_iter: int = 300, tol: float = 1e-4):
    """(model, inertia): the best of ``n_init`` K-Means starts (k-means++,
    seeds seed..seed+n-1) by inertia.  All starts share their scans
    (``lloyd.fit_starts``)."""
    from . import lloyd

    points = lloyd.coordinates(df, cols)
    top = lloyd.best(lloyd.fit_starts(points, [(k, seed + i) for i in range(n_init)], max_iter, tol))
    return lloyd.as_model(df.sparkSession, top.centres), top.inertia


def model_centres(model) -> list[tuple[int, list[float]]]:
    return [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]


# H4 / H10 -------------------------------------------------------------------
def silhouette(df: DataFrame, cols: list[str], pred: str = "Segment", measure: str = "squaredEuclidean") -> float:
    """Mean silhouette from Spark's linear-time evaluator (squared
    Euclidean or cosine).  The exact Euclidean form needs every pair of
    customers, which this library does not compute."""
    from pyspark.ml.evaluation import ClusteringEvaluator

    v = vectorise(df, cols)
    return ClusteringEvaluator(featuresCol="features", predictionCol=pred, distanceMeasure=measure).evaluate(
        v.withColumn(pred, F.col(pred).cast("int"))
    )


def elbow(df: DataFrame, cols: list[str], ks=range(2, 11), seed: int = 42, n_init: int = 10) -> DataFrame:
    """(k, inertia, silhouette) for each k (H9/H10), each the best of
    ``n_init`` starts; all starts of all k share their scans, and two more
    give every silhouette."""
    from . import lloyd

    ks = [int(k) for k in ks]
    points = lloyd.coordinates(df, cols)
    fits = lloyd.fit_starts(points, [(k, seed + i) for k in ks for i in range(n_init)])
    tops = [lloyd.best(fits[j * n_init:(j + 1) * n_init]) for j in range(len(ks))]
    scores = lloyd.silhouettes(points, [f.centres for f in tops])
    rows = [(k, f.inertia, s) for k, f, s in zip(ks, tops, scores, strict=True)]
    return df.sparkSession.createDataFrame(rows, "k int, inertia double, silhouette double")


def choose_k(scores: DataFrame) -> DataFrame:
    return scores.agg(F.max_by("k", "silhouette").alias("best_k"), F.max("silhouette").alias("silhouette"))


# H11 ------------------------------------------------------------------------
def stability(df: DataFrame, cols: list[str], k: int = 4, n_seeds: int = 10, seed: int = 0,
              threshold: float = 0.90, max_iter: int = 300, n_init: int = 10) -> DataFrame:
    """Mean pairwise adjusted Rand index of K-Means labelings over
    ``n_seeds`` seeds, each the best of ``n_init`` starts; stable when above
    ``threshold``.  All fits share their scans, and all pairs are scored in
    one grouped pass (``adjusted_rand_pairs``).  Seed i uses the starts
    ``(seed + i) * n_init ...``, which no other seed shares."""
    from . import lloyd
    from .metrics import adjusted_rand_pairs

    points = lloyd.coordinates(df, cols)
    fits = lloyd.fit_starts(points, [(k, seed * n_init + j) for j in range(n_seeds * n_init)], max_iter)
    labelled, names = points, [f"s{i}" for i in range(n_seeds)]
    for i, name in enumerate(names):
        top = lloyd.best(fits[i * n_init:(i + 1) * n_init])
        labelled = assign_segments(labelled, list(enumerate(top.centres.tolist())), points.columns, name)
    aris = adjusted_rand_pairs(labelled.select(*names), names)
    return aris.agg(F.avg("ari").alias("mean_ari"), F.count(F.lit(1)).alias("pairs")).withColumn(
        "stable", F.col("mean_ari") > threshold
    )


# H13 ------------------------------------------------------------------------
def pca_2d(df: DataFrame, cols: list[str], key: str = CUST) -> tuple[DataFrame, list[float]]:
    """Centre the columns (Spark's PCA.transform does not), project on two
    principal components with each component's sign fixed so its largest
    |loading| is positive; returns (key, pc1, pc2) and explained variance."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import vector_to_array

    means = df.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in cols])
    centred = df.crossJoin(F.broadcast(means.select(*[F.col(c).alias(f"{c}__m") for c in cols]))).select(
        key, *[(F.col(c).cast("double") - F.col(f"{c}__m")).alias(c) for c in cols]
    )
    v = vectorise(centred, cols)
    model = PCA(k=2, inputCol="features", outputCol="pc").fit(v)
    pcs = model.pc.toArray()
    signs = []
    for j in range(2):
        col = pcs[:, j]
        signs.append(1.0 if col[abs(col).argmax()] >= 0 else -1.0)
    arr = model.transform(v).select(key, vector_to_array("pc").alias("pc"))
    out = arr.select(key, (F.col("pc")[0] * signs[0]).alias("pc1"), (F.col("pc")[1] * signs[1]).alias("pc2"))
    return out, [float(x) for x in model.explainedVariance.toArray()]


# H15 / H16 ------------------------------------------------------------------
def fit_segment_classifier(train: DataFrame, cols: list[str], label: str = "Segment", n_trees: int = 200,
                           seed: int = 42, max_depth: int = 30):
    """Random forest of ``n_trees``.  The reference's trees grow without a
    limit; 30 is the largest depth Spark allows."""
    from pyspark.ml.classification import RandomForestClassifier

    v = vectorise(train, cols)
    return RandomForestClassifier(numTrees=n_trees, maxDepth=max_depth, seed=seed, labelCol=label, featuresCol="features").fit(
        v.withColumn(label, F.col(label).cast("double"))
    )


def feature_importance(model, cols: list[str], spark) -> DataFrame:
    imp = model.featureImportances.toArray()
    rows = sorted(((c, float(imp[i])) for i, c in enumerate(cols)), key=lambda t: -t[1])
    return spark.createDataFrame(rows, "feature string, importance double")


# H17 ------------------------------------------------------------------------
def model_meta(spark, **fields) -> DataFrame:
    """One-row metadata record; nested values are stored as JSON text."""
    row = {k: (json.dumps(v) if isinstance(v, (list, dict, tuple)) else v) for k, v in fields.items()}
    return spark.createDataFrame([row])
