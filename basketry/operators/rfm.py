"""Recency-frequency-monetary features."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import COL_CUSTOMER_ID, COL_INVOICE, COL_INVOICE_DATE, COL_REVENUE
from ..functions.numeric import days_between, rnd


# D1 -------------------------------------------------------------------------
def snapshot_date(df: DataFrame, date_col: str = COL_INVOICE_DATE) -> DataFrame:
    """One-row DataFrame: last line time + 1 day (time of day kept, so the
    most recent customer has Recency 1)."""
    return df.agg((F.max(date_col) + F.expr("INTERVAL 1 DAY")).alias("snapshot"))


def _snapshot_frame(df: DataFrame, snapshot) -> DataFrame:
    if snapshot is None:
        return snapshot_date(df)
    if isinstance(snapshot, DataFrame):
        return snapshot.select(F.col(snapshot.columns[0]).cast("timestamp_ntz").alias("snapshot"))
    if isinstance(snapshot, (_dt.datetime, _dt.date, str)):
        return df.sparkSession.range(1).select(F.lit(snapshot).cast("timestamp_ntz").alias("snapshot"))
    raise TypeError("snapshot must be None, a one-row DataFrame or a datetime")


def rfm_from_customer_aggregate(agg: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Finish RFM from ``(CustomerID, last_ts, n_invoices, revenue)``.
    The snapshot is one row, so it is broadcast (size bound: exactly 1)."""
    rev = F.col("revenue").cast("double")
    return agg.crossJoin(F.broadcast(snapshot)).select(
        COL_CUSTOMER_ID,
        days_between("last_ts", "snapshot").cast("bigint").alias("Recency"),
        F.col("n_invoices").cast("bigint").alias("Frequency"),
        rnd(rev, 2).alias("Monetary"),
        rnd(F.ln(F.col("n_invoices").cast("double") + 1.0), 10).alias("Log_Frequency"),
        rnd(F.log1p(rev), 4).alias("Log_Monetary"),
    )


# D2 / D3 --------------------------------------------------------------------
def rfm(df: DataFrame, snapshot=None) -> DataFrame:
    """Recency (whole days from the last purchase to the snapshot),
    Frequency (distinct invoices), Monetary (revenue, 2 dp), Log_Frequency
    = ln(1+F) (kept to 10 dp: libm implementations differ in the last bit),
    Log_Monetary = ln(1+M) from the unrounded sum, 4 dp.

    Distinct invoices are counted with Spark's two-phase distinct plan
    (partial aggregate on (customer, invoice) first), so a customer holding
    a large share of lines is still pre-aggregated on every task."""
    agg = df.groupBy(COL_CUSTOMER_ID).agg(
        F.max(COL_INVOICE_DATE).alias("last_ts"),
        F.count_distinct(COL_INVOICE).alias("n_invoices"),
        F.sum(COL_REVENUE).alias("revenue"),
    )
    return rfm_from_customer_aggregate(agg, _snapshot_frame(df, snapshot))
