"""Cohort features (F1-F5) and the customer feature matrix."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import COL_CUSTOMER_ID, COL_INVOICE, COL_INVOICE_DATE, COL_QUANTITY, COL_REVENUE, COL_STOCK_CODE
from ..functions.numeric import days_between, month_text

CUST = COL_CUSTOMER_ID


# F1 -------------------------------------------------------------------------
def invoice_month(df: DataFrame, date_col: str = COL_INVOICE_DATE, out: str = "InvoiceMonth") -> DataFrame:
    return df.withColumn(out, month_text(date_col))


# F2 / F4 --------------------------------------------------------------------
def cohort(df: DataFrame) -> DataFrame:
    """CohortMonth (first purchase month, ``yyyy-MM``), ActiveMonths
    (distinct purchase months), DaysSinceFirstPurchase (whole days between
    first and last line).  Months are pre-aggregated per (customer, month)
    so the distinct count is a plain count after a partial aggregate."""
    from ..functions.numeric import month_index, month_index_text

    per_month = df.groupBy(CUST, month_index(COL_INVOICE_DATE).alias("m")).agg(
        F.min(COL_INVOICE_DATE).alias("t0"), F.max(COL_INVOICE_DATE).alias("t1")
    )
    return per_month.groupBy(CUST).agg(
        month_index_text(F.min("m")).alias("CohortMonth"),
        F.count(F.lit(1)).alias("ActiveMonths"),
        F.min("t0").alias("first_ts"),
        F.max("t1").alias("last_ts"),
    ).select(
        CUST,
        "CohortMonth",
        F.col("ActiveMonths").cast("bigint"),
        days_between("first_ts", "last_ts").cast("bigint").alias("DaysSinceFirstPurchase"),
    )


# F3 -------------------------------------------------------------------------
def with_cohort(df: DataFrame) -> DataFrame:
    """Lines with their customer's cohort month, as an equi-join back to the
    one-row-per-customer table (not a window over the customer: a join lets
    AQE split a skewed customer's partition)."""
    first = df.groupBy(CUST).agg(F.min(month_text(COL_INVOICE_DATE)).alias("CohortMonth"))
    return df.withColumn("InvoiceMonth", month_text(COL_INVOICE_DATE)).join(first, CUST, "inner")


# G1 -------------------------------------------------------------------------
def feature_matrix(clean: DataFrame, raw: DataFrame | None = None, snapshot=None,
                   return_level: str = "line", invoices: DataFrame | None = None) -> DataFrame:
    """RFM ⟕ behavioural ⟕ cohort on the customer key (RFM is the base).

    Physical plan: one aggregate per customer over the lines gives weekday,
    hour, month, item and time statistics, one over the invoices the spend,
    one over (customer, SKU) the diversity; the order-dependent gaps and the
    raw-table return rate are separate branches.

    ``invoices`` (optional): a materialised ``behavioural.invoice_totals``
    table.  The gap computation reads invoice times twice (in-day window and
    per-day boundaries); from a written invoice table that is two cheap
    scans instead of two line-volume aggregations."""
    from .behavioural import fill_defaults, purchase_gaps, return_rate

    base = line_level_features(clean, snapshot, invoices)
    gaps = purchase_gaps(clean, invoices)
    returns = return_rate(raw, clean, return_level)
    out = base.join(gaps, CUST, "left").join(returns, CUST, "left")
    return fill_defaults(out).select(*FEATURE_COLUMNS)


FEATURE_COLUMNS = [
    CUST, "Recency", "Frequency", "Monetary", "Log_Frequency", "Log_Monetary", "AOV", "SpendStd",
    "PreferredDayOfWeek", "WeekendRatio", "PreferredHour", "UniqueSKUs", "TotalItems", "RepeatSKURatio",
    "AvgGap", "StdGap", "ReturnRate", "CohortMonth", "ActiveMonths", "DaysSinceFirstPurchase",
]

def line_level_features(clean: DataFrame, snapshot=None, invoices: DataFrame | None = None) -> DataFrame:
    """RFM, AOV/SpendStd, weekday/hour modes and weekend share, SKU
    diversity and cohort columns, reduced straight from the lines
    (``state.customer_features``)."""
    from . import state
    from .behavioural import invoice_totals

    orders = invoices if invoices is not None else invoice_totals(clean)
    return state.customer_features(state.line_slots(clean), orders, clean, snapshot)


def feature_matrix_joined(clean: DataFrame, raw: DataFrame | None = None, snapshot=None,
                          return_level: str = "line") -> DataFrame:
    """Reference-shaped plan: each feature group computed on its own and
    left-joined (kept to check the fused plan against)."""
    from .behavioural import behavioural_joined
    from .rfm import rfm

    r = rfm(clean, snapshot)
    b = behavioural_joined(clean, raw, return_level)
    c = cohort(clean)
    return r.join(b, CUST, "left").join(c, CUST, "left").select(*FEATURE_COLUMNS)


# G3 -------------------------------------------------------------------------
def feature_audit(clean: DataFrame, rfm_df: DataFrame, beh: DataFrame, coh: DataFrame,
                  matrix: DataFrame) -> DataFrame:
    """Stage audit as ``(stage, metric, value double)`` rows: lines,
    customers and date range of the input; size of each feature group and of
    the matrix; recency and monetary range; number of cohorts.  One global
    aggregate per table, unioned."""
    def rows(stage, df, metrics):
        agg = df.agg(*[e.cast("double").alias(m) for m, e in metrics])
        stack = ", ".join(f"'{m}', `{m}`" for m, _ in metrics)
        return agg.selectExpr(f"stack({len(metrics)}, {stack}) AS (metric, value)").select(
            F.lit(stage).alias("stage"), "metric", "value"
        )

    to_epoch_days = lambda c: F.unix_date(F.to_date(c))
    return (
        rows("load", clean, [
            ("rows", F.count(F.lit(1))),
            ("customers", F.count_distinct(CUST)),
            ("invoices", F.count_distinct(COL_INVOICE)),
            ("first_day", to_epoch_days(F.min(COL_INVOICE_DATE))),
            ("last_day", to_epoch_days(F.max(COL_INVOICE_DATE))),
        ])
        .unionByName(rows("rfm", rfm_df, [
            ("rows", F.count(F.lit(1))),
            ("recency_min", F.min("Recency")),
            ("recency_max", F.max("Recency")),
            ("monetary_min", F.min("Monetary")),
            ("monetary_max", F.max("Monetary")),
        ]))
        .unionByName(rows("behavioural", beh, [("rows", F.count(F.lit(1)))]))
        .unionByName(rows("cohort", coh, [
            ("rows", F.count(F.lit(1))),
            ("cohorts", F.count_distinct("CohortMonth")),
        ]))
        .unionByName(rows("matrix", matrix, [("rows", F.count(F.lit(1)))]))
    )
