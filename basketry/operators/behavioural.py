"""Behavioural features.

Skew handling: every per-customer statistic is an algebraic aggregate
(sum / count / max of a packed bigint / stddev) computed from a pre-aggregated
input, so Spark's map-side partial aggregation collapses a hot customer on
every task before the shuffle.  The only order-dependent feature, the gap
between consecutive invoices, is computed with windows partitioned by
(customer, day) plus a second, much smaller window over per-day boundaries,
so one customer's invoices are spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import (
    CANCELLATION_PREFIX,
    COL_CUSTOMER_ID,
    COL_INVOICE,
    COL_INVOICE_DATE,
    COL_QUANTITY,
    COL_REVENUE,
    COL_STOCK_CODE,
)
from ..functions.numeric import days_between, mode_key, mode_value, rnd, starts_with_prefix, weekday0

CUST = COL_CUSTOMER_ID


# shared level-1 aggregate -----------------------------------------------------
def invoice_totals(df: DataFrame) -> DataFrame:
    """One row per (customer, invoice): revenue total, first line time,
    number of lines."""
    return df.groupBy(CUST, COL_INVOICE).agg(
        F.sum(COL_REVENUE).alias("total"),
        F.min(COL_INVOICE_DATE).alias("inv_ts"),
        F.count(F.lit(1)).alias("n_lines"),
    )


# E1 -------------------------------------------------------------------------
def order_value(df: DataFrame) -> DataFrame:
    """AOV = mean invoice total, SpendStd = sample std of invoice totals
    (NULL for a single invoice), both 2 dp."""
    inv = invoice_totals(df)
    return inv.groupBy(CUST).agg(
        rnd(F.avg("total"), 2).alias("AOV"),
        rnd(F.stddev_samp(F.col("total").cast("double")), 2).alias("SpendStd"),
    )


# E2 / E3 / E4 ---------------------------------------------------------------
def temporal(df: DataFrame) -> DataFrame:
    """PreferredDayOfWeek (mode over lines, Monday = 0, smallest on ties),
    WeekendRatio (share of lines on Saturday/Sunday, 4 dp), PreferredHour
    (mode of the hour, smallest on ties).

    Lines are first counted per (customer, weekday, hour) — at most 168 rows
    per customer — then reduced per customer with ``max`` of a packed
    (count, value) key for both modes."""
    slot = df.select(
        CUST, weekday0(COL_INVOICE_DATE).alias("wd"), F.hour(COL_INVOICE_DATE).alias("hr")
    ).groupBy(CUST, "wd", "hr").agg(F.count(F.lit(1)).alias("n"))
    by_wd = slot.groupBy(CUST, "wd").agg(F.sum("n").alias("n"))
    by_hr = slot.groupBy(CUST, "hr").agg(F.sum("n").alias("n"))
    wd = by_wd.groupBy(CUST).agg(
        F.max(mode_key("n", "wd")).alias("best"),
        F.sum(F.when(F.col("wd") >= 5, F.col("n")).otherwise(0)).alias("weekend"),
        F.sum("n").alias("lines"),
    ).select(
        CUST,
        mode_value("best").alias("PreferredDayOfWeek"),
        rnd(F.col("weekend") / F.col("lines"), 4).alias("WeekendRatio"),
    )
    hr = by_hr.groupBy(CUST).agg(F.max(mode_key("n", "hr")).alias("best")).select(
        CUST, mode_value("best").alias("PreferredHour")
    )
    return wd.join(hr, CUST, "inner")


# E5 / E6 --------------------------------------------------------------------
def product_diversity(df: DataFrame) -> DataFrame:
    """UniqueSKUs, TotalItems, RepeatSKURatio = share of lines whose SKU was
    already seen = 1 - distinct SKUs / lines (closed form, no window)."""
    per_sku = df.groupBy(CUST, COL_STOCK_CODE).agg(
        F.count(F.lit(1)).alias("n"), F.sum(COL_QUANTITY).alias("q")
    )
    return per_sku.groupBy(CUST).agg(
        F.count(F.lit(1)).alias("UniqueSKUs"),
        F.sum("q").cast("bigint").alias("TotalItems"),
        rnd((F.sum("n") - F.count(F.lit(1))) / F.sum("n"), 4).alias("RepeatSKURatio"),
    )


# E7 -------------------------------------------------------------------------
def order_gaps(df: DataFrame, invoices: DataFrame | None = None) -> DataFrame:
    """Whole days between consecutive invoices of a customer, where an
    invoice's time is its first line's time: ``(CustomerID, GapDays)``.

    Exact and skew-tolerant: invoices are windowed per (customer, day) to
    find in-day predecessors; the predecessor of each day's first invoice is
    the previous active day's last invoice, found with a window over the
    per-(customer, day) boundary table (at most one row per customer-day).
    Ties in time give a gap of 0 whichever order they are taken in."""
    inv = invoices if invoices is not None else invoice_totals(df)
    inv = inv.select(CUST, COL_INVOICE, "inv_ts").withColumn("day", F.to_date("inv_ts"))
    w_day = Window.partitionBy(CUST, "day").orderBy("inv_ts", COL_INVOICE)
    inner = (
        inv.withColumn("prev_ts", F.lag("inv_ts").over(w_day))
        .filter(F.col("prev_ts").isNotNull())
        .select(CUST, days_between("prev_ts", "inv_ts").alias("GapDays"))
    )
    bounds = inv.groupBy(CUST, "day").agg(F.min("inv_ts").alias("first_ts"), F.max("inv_ts").alias("last_ts"))
    w_cust = Window.partitionBy(CUST).orderBy("day")
    across = (
        bounds.withColumn("prev_last", F.lag("last_ts").over(w_cust))
        .filter(F.col("prev_last").isNotNull())
        .select(CUST, days_between("prev_last", "first_ts").alias("GapDays"))
    )
    return inner.unionByName(across)


# E8 -------------------------------------------------------------------------
def purchase_gaps(df: DataFrame, invoices: DataFrame | None = None) -> DataFrame:
    """AvgGap, StdGap (sample; NULL with one gap) per customer, 2 dp.
    Single-invoice customers have no gap and are absent."""
    return order_gaps(df, invoices).groupBy(CUST).agg(
        rnd(F.avg("GapDays"), 2).alias("AvgGap"),
        rnd(F.stddev_samp(F.col("GapDays").cast("double")), 2).alias("StdGap"),
    )


# E9 / E10 -------------------------------------------------------------------
def return_rate(raw: DataFrame | None, customers: DataFrame | None = None, level: str = "line",
                prefix: str = CANCELLATION_PREFIX) -> DataFrame:
    """ReturnRate per customer from RAW lines (cancellations included).

    ``level="line"`` (reference): cancelled LINES / distinct invoices — can
    exceed 1.  ``level="order"``: cancelled invoices / distinct invoices.
    Raw customer ids are normalised like the cleaned ones so the two join.
    With no raw table (``raw is None``) every customer of ``customers`` gets
    0.0 (E10)."""
    if raw is None:
        if customers is None:
            raise ValueError("customers are required when raw is None")
        return customers.select(CUST).distinct().withColumn("ReturnRate", F.lit(0.0))
    from .clean import normalise_id_expr

    r = raw.filter(F.col(CUST).isNotNull()).select(
        normalise_id_expr(CUST).alias(CUST), F.col(COL_INVOICE)
    ).withColumn("is_cancel", starts_with_prefix(COL_INVOICE, prefix))
    if level == "line":
        num = F.count_if("is_cancel")
    elif level == "order":
        num = F.count_distinct(F.when(F.col("is_cancel"), F.col(COL_INVOICE)))
    else:
        raise ValueError("level must be 'line' or 'order'")
    return r.groupBy(CUST).agg(
        rnd(num / F.count_distinct(COL_INVOICE), 4).alias("ReturnRate")
    )


# E11 / E12 ------------------------------------------------------------------
FILL_DEFAULTS = {"AvgGap": 0.0, "StdGap": 0.0, "SpendStd": 0.0, "ReturnRate": 0.0}


def fill_defaults(df: DataFrame) -> DataFrame:
    return df.na.fill({k: v for k, v in FILL_DEFAULTS.items() if k in df.columns})


BEHAVIOURAL_COLUMNS = [
    CUST, "AOV", "SpendStd", "PreferredDayOfWeek", "WeekendRatio", "PreferredHour", "UniqueSKUs",
    "TotalItems", "RepeatSKURatio", "AvgGap", "StdGap", "ReturnRate",
]


def behavioural(df: DataFrame, raw: DataFrame | None = None, level: str = "line",
                invoices: DataFrame | None = None) -> DataFrame:
    """AOV/SpendStd, temporal, product, gap and return-rate groups per
    customer, NULLs filled with 0.  Line-level groups come from
    ``cohort.line_level_features``; gaps and returns
    are left-joined on the customer key (one-row-per-customer sides)."""
    from .cohort import line_level_features

    base = line_level_features(df, invoices=invoices)
    out = base.join(purchase_gaps(df, invoices), CUST, "left").join(return_rate(raw, df, level), CUST, "left")
    return fill_defaults(out).select(*BEHAVIOURAL_COLUMNS)


def behavioural_joined(df: DataFrame, raw: DataFrame | None = None, level: str = "line") -> DataFrame:
    """Reference-shaped plan: the five groups computed separately and
    left-joined (kept to check the fused plan against)."""
    out = (
        order_value(df)
        .join(temporal(df), CUST, "left")
        .join(product_diversity(df), CUST, "left")
        .join(purchase_gaps(df), CUST, "left")
        .join(return_rate(raw, df, level), CUST, "left")
    )
    return fill_defaults(out).select(*BEHAVIOURAL_COLUMNS)
