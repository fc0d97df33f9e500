"""Result-table analytics (L1-L18): the dashboard's and the scoring
service's computations re-aimed as batch DataFrame queries over the
segment and prediction tables (single-customer lookups become semi-joins
with a table of requested ids)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import CHURN_RISK_LABELS, COL_CUSTOMER_ID, COL_INVOICE, COL_INVOICE_DATE, COL_REVENUE
from ..functions.numeric import month_text, rnd

CUST = COL_CUSTOMER_ID


# L1 -------------------------------------------------------------------------
def master_view(segments: DataFrame, churn: DataFrame) -> DataFrame:
    """Segment results ⟕ the three prediction columns, on the customer key."""
    return segments.join(churn.select(CUST, "ChurnProb", "ChurnRisk", "Churned"), CUST, "left")


# L2 -------------------------------------------------------------------------
def kpis(master: DataFrame) -> DataFrame:
    return master.agg(
        F.count(F.lit(1)).alias("customers"),
        rnd(F.sum("Monetary"), 2).alias("revenue"),
        rnd(F.avg("Churned") * 100.0, 1).alias("churn_rate_pct"),
    )


# L3 / L4 ----------------------------------------------------------------------
def value_counts(df: DataFrame, col: str, out: str = "customers") -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(out)).orderBy(F.desc(out), col)


def revenue_by(df: DataFrame, col: str = "SegmentLabel") -> DataFrame:
    return df.groupBy(col).agg(rnd(F.sum("Monetary"), 2).alias("Revenue"))


# L5 -------------------------------------------------------------------------
def ordered_counts(df: DataFrame, col: str = "ChurnRisk", order=tuple(CHURN_RISK_LABELS)) -> DataFrame:
    """Counts in a fixed category order; categories absent from the data
    are kept with a NULL count (reindex semantics)."""
    dim = df.sparkSession.createDataFrame(list(enumerate(order)), f"position int, {col} string")
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("Count"))
    return dim.join(counts, col, "left").select("position", col, "Count").orderBy("position")


# L6 -------------------------------------------------------------------------
def segment_options(df: DataFrame, col: str = "SegmentLabel") -> DataFrame:
    return df.select(col).where(F.col(col).isNotNull()).distinct().orderBy(col)


def select_segments(df: DataFrame, labels: list[str] | DataFrame, col: str = "SegmentLabel") -> DataFrame:
    if isinstance(labels, DataFrame):
        return df.join(labels.select(col).distinct(), col, "left_semi")
    return df.filter(F.col(col).isin(list(labels)))


# L7 -------------------------------------------------------------------------
def selection_kpis(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("customers"),
        rnd(F.avg("Recency"), 2).alias("avg_recency"),
        rnd(F.avg("Frequency"), 2).alias("avg_frequency"),
        rnd(F.avg("Monetary"), 2).alias("avg_monetary"),
    )


# L8 -------------------------------------------------------------------------
def selection_profile(df: DataFrame, col: str = "SegmentLabel", dp: int = 1) -> DataFrame:
    """Per segment: customers, mean R/F/M/AOV (``dp`` decimals) and revenue
    share relative to the selection itself (1 dp)."""
    g = df.groupBy(col).agg(
        F.count(CUST).alias("Customers"),
        F.avg("Recency").alias("r"), F.avg("Frequency").alias("f"), F.avg("Monetary").alias("m"),
        F.avg("AOV").alias("a"), F.sum("Monetary").alias("rev"),
    )
    total = g.agg(F.sum("rev").alias("total"))
    return g.crossJoin(F.broadcast(total)).select(
        col,
        F.col("Customers").cast("bigint"),
        rnd("r", dp).alias("Avg_Recency"),
        rnd("f", dp).alias("Avg_Frequency"),
        rnd("m", dp).alias("Avg_Monetary"),
        rnd("a", dp).alias("Avg_AOV"),
        rnd(F.col("rev") / F.col("total") * 100.0, 1).alias("Revenue_Share"),
    )


# L9 -------------------------------------------------------------------------
def churn_kpis(master: DataFrame) -> DataFrame:
    return master.agg(
        F.count(F.lit(1)).alias("total"),
        F.sum("Churned").cast("bigint").alias("churned"),
        F.count_if(F.col("ChurnRisk") == "High").alias("high_risk"),
        rnd(F.avg("ChurnProb") * 100.0, 1).alias("avg_prob_pct"),
    ).select(
        "total",
        "churned",
        rnd(F.col("churned") * 100.0 / F.col("total"), 1).alias("churned_pct"),
        "high_risk",
        rnd(F.col("high_risk") * 100.0 / F.col("total"), 1).alias("high_risk_pct"),
        "avg_prob_pct",
    )


# L10 ------------------------------------------------------------------------
def churn_by_segment(master: DataFrame, col: str = "SegmentLabel") -> DataFrame:
    g = master.groupBy(col).agg(
        F.count(CUST).alias("Customers"), F.sum("Churned").alias("Churned"), F.avg("ChurnProb").alias("p")
    )
    return g.select(
        col,
        F.col("Customers").cast("bigint"),
        F.col("Churned").cast("bigint"),
        rnd(F.col("Churned") / F.col("Customers") * 100.0, 1).alias("Churn_Rate"),
        rnd(F.col("p") * 100.0, 1).alias("Avg_Prob"),
    )


# L11 ------------------------------------------------------------------------
def top_risk(master: DataFrame, n: int = 100) -> DataFrame:
    """Top-n customers by churn probability (ties by id); probability shown
    in % (1 dp), revenue 2 dp.  A top-k report: orderBy + limit plans as
    TakeOrderedAndProject (n rows kept per task)."""
    return (
        master.select(CUST, "SegmentLabel", "Recency", "Frequency", "Monetary", "ChurnProb")
        .orderBy(F.desc_nulls_last("ChurnProb"), F.asc(CUST))
        .limit(n)
        .select(
            CUST,
            F.col("SegmentLabel").alias("Segment"),
            "Recency",
            "Frequency",
            rnd("Monetary", 2).alias("Historic_Revenue"),
            rnd(F.col("ChurnProb") * 100.0, 1).alias("Churn_Prob_Pct"),
        )
    )


# L12 ------------------------------------------------------------------------
def sample_n(df: DataFrame, n: int = 2000, seed: int = 42, key: str = CUST) -> DataFrame:
    """Exactly min(n, rows) rows chosen by the order of md5(key|seed) — a
    reproducible sample (``DataFrame.sample`` only approximates n)."""
    h = F.md5(F.concat(F.col(key).cast("string"), F.lit("|"), F.lit(str(seed))))
    return df.withColumn("__h", h).orderBy("__h").limit(n).drop("__h")


# L13 ------------------------------------------------------------------------
def median_of(df: DataFrame, col: str = "Monetary") -> DataFrame:
    """Exact median by distributed selection (``select_quantiles``)."""
    from ..functions.selection import quantile_table

    return quantile_table(df, col, {f"median_{col}": 0.5})


# L14 ------------------------------------------------------------------------
def customer_profile(segments: DataFrame, churn: DataFrame, ids: DataFrame) -> DataFrame:
    """Profiles for a table of requested ids (ids not found produce no row);
    snake-case names as the response contract requires."""
    req = ids.select(F.col(ids.columns[0]).cast("string").alias(CUST)).distinct()
    s = segments.join(req, CUST, "left_semi")
    return s.join(churn.select(CUST, "ChurnProb", "ChurnRisk"), CUST, "left").select(
        F.col(CUST).alias("customer_id"),
        F.col("Recency").alias("recency"),
        F.col("Frequency").alias("frequency"),
        F.col("Monetary").alias("monetary"),
        F.col("Segment").alias("segment_id"),
        F.col("SegmentLabel").alias("segment_label"),
        F.col("CohortMonth").alias("cohort_month"),
        F.col("ActiveMonths").alias("active_months"),
        F.col("ChurnProb").alias("churn_prob"),
        F.col("ChurnRisk").alias("churn_risk"),
    )


# L15 ------------------------------------------------------------------------
def customer_history(lines: DataFrame, ids: DataFrame) -> DataFrame:
    """Order lines of the requested customers, newest first, each with the
    customer's line and distinct-order counts.  The sort is a global range
    sort (no per-customer window)."""
    req = ids.select(F.col(ids.columns[0]).cast("string").alias(CUST)).distinct()
    mine = lines.join(req, CUST, "left_semi")
    summary = mine.groupBy(CUST).agg(
        F.count(F.lit(1)).alias("lines"), F.count_distinct(COL_INVOICE).alias("orders")
    )
    return mine.join(summary, CUST, "inner").orderBy(CUST, F.desc(COL_INVOICE_DATE), COL_INVOICE)


# L16 ------------------------------------------------------------------------
def customer_monthly_spend(lines: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    src = lines
    if ids is not None:
        req = ids.select(F.col(ids.columns[0]).cast("string").alias(CUST)).distinct()
        src = lines.join(req, CUST, "left_semi")
    return src.groupBy(CUST, month_text(COL_INVOICE_DATE).alias("Month")).agg(
        rnd(F.sum(COL_REVENUE), 2).alias("Revenue")
    )


# L17 ------------------------------------------------------------------------
def score_segments(requests: DataFrame, params: DataFrame, centres, mapping: dict[int, str]) -> DataFrame:
    """Batch segment scoring of requests ``(recency, frequency, monetary,
    ...)``: log1p of frequency and monetary, scaling with the STORED scaler
    parameters (one-row ``params`` from ``scaler_params``), nearest centre,
    label (``Unknown`` when the id has no label)."""
    from .segment import assign_segments, label_segments, scale_features

    cols = ["Recency", "Log_Frequency", "Log_Monetary"]
    tmp = [f"__{c}" for c in cols]
    x = requests.select(
        "*",
        F.col("recency").cast("double").alias(tmp[0]),
        F.log1p(F.col("frequency").cast("double")).alias(tmp[1]),
        F.log1p(F.col("monetary").cast("double")).alias(tmp[2]),
    )
    p = params.select(*[F.col(f"{c}__{s}").alias(f"{t}__{s}") for c, t in zip(cols, tmp) for s in ("mean", "std")])
    z = scale_features(x, tmp, p, suffix="_z")
    seg = assign_segments(z, centres, [f"{t}_z" for t in tmp], out="segment_id")
    out = label_segments(seg, mapping, col="segment_id", out="segment_label")
    return out.drop(*tmp, *[f"{t}_z" for t in tmp])
