"""Evaluation metrics as DataFrame operators (J8-J12, J10, H11 ARI).

Scores are first grouped by distinct value (pos/neg counts per score); the
running counts needed by ROC/PR quantities come from ``prefix_sums`` (exact,
bucketed — no single-task global window).  Sums that feed ratios are exact
integers; each ratio is one IEEE division so any engine gets the same bits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import rnd
from ..functions.ordered import prefix_sums


def score_counts(df: DataFrame, y: str, p: str, by: list[str] | None = None) -> DataFrame:
    """``(by..., score, pos, neg, tp, fp, P, N)`` per distinct score where
    tp/fp count rows with score >= this score (threshold semantics of a
    precision-recall curve); ``by`` evaluates several score sets at once."""
    by = list(by or [])
    g = df.groupBy(*by, F.col(p).cast("double").alias("score")).agg(
        F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) != 1).alias("neg")
    )
    totals = g.groupBy(*by).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    pre = prefix_sums(g, ["score"], ["pos", "neg"], partition_cols=by, descending=True)
    j = pre.join(totals, by, "inner") if by else pre.crossJoin(F.broadcast(totals))
    return j.select(
        *by,
        "score",
        "pos",
        "neg",
        (F.col("pos_before") + F.col("pos")).alias("tp"),
        (F.col("neg_before") + F.col("neg")).alias("fp"),
        "P",
        "N",
    )


# J8 -------------------------------------------------------------------------
def roc_auc(df: DataFrame, y: str, p: str, by: list[str] | None = None) -> DataFrame:
    """Exact ROC-AUC with ties counted one half (Mann-Whitney form):
    sum over scores of pos * (negatives strictly below + neg/2) / (P*N),
    accumulated in integers (doubled) and divided once.  With ``by``, one
    AUC per group (e.g. per ensemble size)."""
    by = list(by or [])
    s = score_counts(df, y, p, by)
    # negatives strictly below = N - fp  (fp counts negatives >= score)
    num2 = F.sum(
        F.col("pos").cast("decimal(38,0)") * (2 * (F.col("N") - F.col("fp")) + F.col("neg")).cast("decimal(38,0)")
    )
    return s.groupBy(*by).agg(num2.alias("num2"), F.first("P").alias("P"), F.first("N").alias("N")).select(
        *by,
        F.try_divide(
            F.col("num2").cast("double"), (F.lit(2.0) * F.col("P").cast("double") * F.col("N").cast("double"))
        ).alias("roc_auc"),
    )


# J9 -------------------------------------------------------------------------
def average_precision(df: DataFrame, y: str, p: str, digits: int = 10) -> DataFrame:
    """Average precision as the step sum  sum_k (R_k - R_{k-1}) * P_k  over
    distinct thresholds (not the trapezoid area)."""
    s = score_counts(df, y, p)
    return s.agg(
        rnd(F.sum(F.col("pos") * (F.col("tp") / (F.col("tp") + F.col("fp")))) / F.first("P"), digits).alias(
            "average_precision"
        )
    )


# J12 ------------------------------------------------------------------------
def pr_curve(df: DataFrame, y: str, p: str) -> DataFrame:
    """Precision/recall at every distinct score used as threshold
    (predict positive when score >= threshold)."""
    s = score_counts(df, y, p)
    return s.select(
        F.col("score").alias("threshold"),
        F.col("tp").cast("bigint"),
        F.col("fp").cast("bigint"),
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        F.try_divide(F.col("tp").cast("double"), F.col("P").cast("double")).alias("recall"),
    )


def roc_curve(df: DataFrame, y: str, p: str) -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score (no point dropping)."""
    s = score_counts(df, y, p)
    return s.select(
        F.col("score").alias("threshold"),
        F.try_divide(F.col("fp").cast("double"), F.col("N").cast("double")).alias("fpr"),
        F.try_divide(F.col("tp").cast("double"), F.col("P").cast("double")).alias("tpr"),
    )


# J11 ------------------------------------------------------------------------
def best_f1_threshold(df: DataFrame, y: str, p: str) -> DataFrame:
    """Threshold maximising F1 = 2PR/(P+R+1e-9) over the PR curve; on ties
    the lowest threshold wins.  The reference then predicts with
    ``score > threshold``; callers apply that rule to the returned value.""" 
    curve = pr_curve(df, y, p).withColumn(
        "f1", F.lit(2.0) * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall") + F.lit(1e-9))
    )
    best = F.max(F.struct("f1", (-F.col("threshold")).alias("neg_t"), "precision", "recall")).alias("b")
    return curve.agg(best).filter(F.col("b").isNotNull()).select(
        (-F.col("b.neg_t")).alias("threshold"), "b.precision", "b.recall", "b.f1"
    )


# J10 ------------------------------------------------------------------------
def confusion_matrix(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """(actual, predicted, count) for the 2x2 grid, zero cells kept."""
    spark = df.sparkSession
    grid = spark.createDataFrame([(a, b) for a in (0, 1) for b in (0, 1)], "actual int, predicted int")
    c = df.groupBy(F.col(y).cast("int").alias("actual"), F.col(yhat).cast("int").alias("predicted")).agg(
        F.count(F.lit(1)).alias("count")
    )
    return grid.join(c, ["actual", "predicted"], "left").select(
        "actual", "predicted", F.coalesce("count", F.lit(0)).cast("bigint").alias("count")
    )


def classification_report(df: DataFrame, y: str, yhat: str, digits: int = 6) -> DataFrame:
    """Per-class precision/recall/F1/support, accuracy, macro and weighted
    averages as rows ``(label, precision, recall, f1, support)``; a zero
    denominator gives 0 (the reference library's default)."""
    cm = confusion_matrix(df, y, yhat)
    one = cm.agg(
        *[
            F.sum(F.when((F.col("actual") == a) & (F.col("predicted") == b), F.col("count")).otherwise(0)).alias(
                f"c{a}{b}"
            )
            for a in (0, 1)
            for b in (0, 1)
        ]
    )

    def safe(num, den):
        return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))

    c = F.col
    p1, r1 = safe(c("c11"), c("c01") + c("c11")), safe(c("c11"), c("c10") + c("c11"))
    p0, r0 = safe(c("c00"), c("c00") + c("c10")), safe(c("c00"), c("c00") + c("c01"))
    f = lambda p, r: F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0)
    s0, s1 = c("c00") + c("c01"), c("c10") + c("c11")
    n = s0 + s1
    stats = one.select(
        p0.alias("p0"), r0.alias("r0"), f(p0, r0).alias("f0"), s0.alias("s0"),
        p1.alias("p1"), r1.alias("r1"), f(p1, r1).alias("f1"), s1.alias("s1"),
        safe(c("c00") + c("c11"), n).alias("acc"), n.alias("n"),
    )
    rows = stats.selectExpr(
        """stack(5,
          '0', p0, r0, f0, s0,
          '1', p1, r1, f1, s1,
          'accuracy', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), acc, n,
          'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n,
          'weighted avg', (p0 * s0 + p1 * s1) / n, (r0 * s0 + r1 * s1) / n, (f0 * s0 + f1 * s1) / n, n
        ) AS (label, precision, recall, f1, support)"""
    )
    return rows.select(
        "label",
        rnd("precision", digits).alias("precision"),
        rnd("recall", digits).alias("recall"),
        rnd("f1", digits).alias("f1"),
        F.col("support").cast("bigint"),
    )


# H11 ------------------------------------------------------------------------
def adjusted_rand(df: DataFrame, a: str, b: str) -> DataFrame:
    """Adjusted Rand index between two labelings from the contingency table
    (one grouped count, then marginal sums of C(n, 2) in exact integers)."""
    cont = df.groupBy(F.col(a).alias("a"), F.col(b).alias("b")).agg(F.count(F.lit(1)).alias("n"))
    comb2 = lambda x: (x * (x - 1) / 2)
    idx = cont.agg(F.sum(comb2(F.col("n"))).alias("index"), F.sum("n").alias("n"))
    sa = cont.groupBy("a").agg(F.sum("n").alias("m")).agg(F.sum(comb2(F.col("m"))).alias("sum_a"))
    sb = cont.groupBy("b").agg(F.sum("n").alias("m")).agg(F.sum(comb2(F.col("m"))).alias("sum_b"))
    one = idx.crossJoin(sa).crossJoin(sb)
    expected = F.col("sum_a") * F.col("sum_b") / comb2(F.col("n"))
    max_index = (F.col("sum_a") + F.col("sum_b")) / 2
    return one.select(
        F.when(max_index == expected, F.lit(1.0))
        .otherwise((F.col("index") - expected) / (max_index - expected))
        .alias("ari")
    )


def multiclass_report(df: DataFrame, y: str, yhat: str, digits: int = 6) -> DataFrame:
    """Per-class precision / recall / F1 / support for any number of
    classes, from one (actual, predicted) count table; plus accuracy and the
    macro and support-weighted averages."""
    cm = df.groupBy(F.col(y).cast("string").alias("a"), F.col(yhat).cast("string").alias("p")).agg(
        F.count(F.lit(1)).alias("n")
    )
    actual = cm.groupBy(F.col("a").alias("label")).agg(F.sum("n").alias("support"))
    predicted = cm.groupBy(F.col("p").alias("label")).agg(F.sum("n").alias("predicted"))
    hits = cm.filter(F.col("a") == F.col("p")).select(F.col("a").alias("label"), F.col("n").alias("tp"))
    per = (
        actual.join(predicted, "label", "full")
        .join(hits, "label", "left")
        .na.fill(0, ["support", "predicted", "tp"])
    )
    p = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("predicted").cast("double")), F.lit(0.0))
    r = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("support").cast("double")), F.lit(0.0))
    per = per.select("label", p.alias("precision"), r.alias("recall"), "support", "tp")
    per = per.withColumn(
        "f1", F.when(F.col("precision") + F.col("recall") > 0,
                     2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(0.0)
    )
    acc = per.agg(
        F.lit("accuracy").alias("label"), F.lit(None).cast("double").alias("precision"),
        F.lit(None).cast("double").alias("recall"),
        (F.sum("tp") / F.sum("support")).alias("f1"), F.sum("support").alias("support"),
    )
    cols = ["precision", "recall", "f1"]
    macro = per.agg(F.lit("macro avg").alias("label"), *[F.avg(c).alias(c) for c in cols], F.sum("support").alias("support"))
    weighted = per.agg(
        F.lit("weighted avg").alias("label"),
        *[(F.sum(F.col(c) * F.col("support")) / F.sum("support")).alias(c) for c in cols],
        F.sum("support").alias("support"),
    )
    out = per.select("label", *cols, "support")
    for part in (acc, macro, weighted):
        out = out.unionByName(part)
    return out.select(
        "label", rnd("precision", digits).alias("precision"), rnd("recall", digits).alias("recall"),
        rnd("f1", digits).alias("f1"), F.col("support").cast("bigint"),
    )


def adjusted_rand_pairs(df: DataFrame, cols: list[str]) -> DataFrame:
    """ARI for every pair of labelling columns in one pass: each row is
    unpivoted into one (pair, a, b) row per column pair (a fixed multiple of
    the rows), then contingency counts are grouped by pair."""
    pairs = [(i, j) for i in range(len(cols)) for j in range(i + 1, len(cols))]
    body = ", ".join(f"{i}, {j}, `{cols[i]}`, `{cols[j]}`" for i, j in pairs)
    long = df.selectExpr(f"stack({len(pairs)}, {body}) AS (i, j, a, b)")
    cont = long.groupBy("i", "j", "a", "b").agg(F.count(F.lit(1)).alias("n"))
    comb2 = lambda x: (x * (x - 1) / 2)
    idx = cont.groupBy("i", "j").agg(F.sum(comb2(F.col("n"))).alias("index"), F.sum("n").alias("n"))
    sa = cont.groupBy("i", "j", "a").agg(F.sum("n").alias("m")).groupBy("i", "j").agg(
        F.sum(comb2(F.col("m"))).alias("sum_a"))
    sb = cont.groupBy("i", "j", "b").agg(F.sum("n").alias("m")).groupBy("i", "j").agg(
        F.sum(comb2(F.col("m"))).alias("sum_b"))
    one = idx.join(sa, ["i", "j"]).join(sb, ["i", "j"])
    expected = F.col("sum_a") * F.col("sum_b") / comb2(F.col("n"))
    max_index = (F.col("sum_a") + F.col("sum_b")) / 2
    return one.select(
        "i", "j",
        F.when(max_index == expected, F.lit(1.0)).otherwise((F.col("index") - expected) / (max_index - expected)).alias("ari"),
    )
