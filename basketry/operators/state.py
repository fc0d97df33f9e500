"""Customer features from mergeable partial states.

Two tables hold all that the line-level features need:

* orders: (customer, invoice, month, weekday, hour) with lines, items, revenue,
  first and last time;
* items: (customer, SKU, month) with lines.

Their measures are sums, minima and maxima, so states of disjoint sets of
lines merge by stacking their rows: a load only aggregates its own lines and
appends its states (``append_states``, partitioned by month), and the features
of all lines follow from the small tables without reading a line again.  Lines
that were already loaded must not come twice (``streaming.merge_new``).

The same reduction also runs straight on the lines: weekday, hour and month
statistics are conditional sums and bit sets of one aggregate per customer, so
no line is expanded, and every aggregate has a fixed-width buffer that is
combined before the shuffle, also for a customer with a third of all lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import COL_CUSTOMER_ID, COL_INVOICE, COL_INVOICE_DATE, COL_QUANTITY, COL_REVENUE, COL_STOCK_CODE
from ..functions.numeric import days_between, mode_key, mode_value, month_index, month_index_text, rnd, weekday0
from ..sources.versioned import VersionedTable

CUST = COL_CUSTOMER_ID
ORDER_KEYS = [CUST, COL_INVOICE, "m", "wd", "hr"]
ITEM_KEYS = [CUST, COL_STOCK_CODE, "m"]
WORD = 62  # months in a bit set


def line_slots(clean: DataFrame) -> DataFrame:
    """Every line as a state of itself."""
    return clean.select(
        CUST, COL_INVOICE, month_index(COL_INVOICE_DATE).alias("m"), weekday0(COL_INVOICE_DATE).alias("wd"),
        F.hour(COL_INVOICE_DATE).alias("hr"), F.lit(1).cast("bigint").alias("n"), F.col(COL_QUANTITY).cast("bigint").alias("q"),
        F.col(COL_REVENUE).alias("total"), F.col(COL_INVOICE_DATE).alias("t0"), F.col(COL_INVOICE_DATE).alias("t1"))


def order_states(clean: DataFrame) -> DataFrame:
    return line_slots(clean).groupBy(*ORDER_KEYS).agg(
        F.sum("n").alias("n"), F.sum("q").alias("q"), F.sum("total").alias("total"), F.min("t0").alias("t0"), F.max("t1").alias("t1"))


def item_states(clean: DataFrame) -> DataFrame:
    return clean.select(CUST, COL_STOCK_CODE, month_index(COL_INVOICE_DATE).alias("m")).groupBy(*ITEM_KEYS).agg(
        F.count(F.lit(1)).alias("n"))


def append_states(lines: DataFrame, orders: VersionedTable, items: VersionedTable) -> None:
    """Add the states of newly loaded lines; nothing stored is read."""
    orders.publish(order_states(lines), "append", ["m"])
    items.publish(item_states(lines), "append", ["m"])


def invoice_states(orders: DataFrame) -> DataFrame:
    """``behavioural.invoice_totals`` from order states."""
    return orders.groupBy(CUST, COL_INVOICE).agg(
        F.sum("total").alias("total"), F.min("t0").alias("inv_ts"), F.sum("n").alias("n_lines"))


def _span(slots: DataFrame) -> tuple[int, int, DataFrame]:
    """First and last month, and the last time as a one-row table."""
    r = slots.agg(F.min("m").alias("a"), F.max("m").alias("z"), F.max("t1").alias("last")).first()
    last = slots.sparkSession.createDataFrame([(r["last"],)], f"{COL_INVOICE_DATE} timestamp_ntz")
    return r["a"] or 0, r["z"] or 0, last


def _per_customer(slots: DataFrame, first: int, last: int) -> DataFrame:
    """One aggregate per customer over lines or order states, whose months
    run from ``first`` to ``last``."""
    words = range((last - first) // WORD + 1)
    n = F.col("n")
    count = lambda col, i: F.sum(F.when(F.col(col) == i, n).otherwise(0))
    bit = lambda w: F.bit_or(F.when(
        F.floor((F.col("m") - first) / WORD) == w, F.expr(f"shiftleft(1L, cast((m - {first}) % {WORD} as int))")).otherwise(F.lit(0)))
    per = slots.groupBy(CUST).agg(
        F.sum(n).alias("lines"), F.sum("q").alias("total_items"), F.min("t0").alias("first_ts"), F.max("t1").alias("last_ts"),
        F.min("m").alias("cohort_month"), *[count("wd", i).alias(f"wd{i}") for i in range(7)],
        *[count("hr", i).alias(f"hr{i}") for i in range(24)], *[bit(w).alias(f"months{w}") for w in words])
    most = lambda col, k: mode_value(F.greatest(*[
        F.when(F.col(f"{col}{i}") > 0, mode_key(f"{col}{i}", F.lit(i))) for i in range(k)]))
    return per.select(
        CUST, "lines", "total_items", "first_ts", "last_ts", "cohort_month", most("wd", 7).alias("day"), most("hr", 24).alias("hour"),
        (F.col("wd5") + F.col("wd6")).alias("weekend"), sum((F.bit_count(f"months{w}") for w in words), F.lit(0)).alias("months"))


def customer_features(slots: DataFrame, invoices: DataFrame, items: DataFrame, snapshot=None) -> DataFrame:
    """RFM, spend, weekday and hour modes, SKU diversity and cohort columns
    from order states (or ``line_slots``), invoices and items (any rows with
    customer and SKU).  Three aggregates by customer, joined where they are."""
    from .rfm import _snapshot_frame

    first, last, last_time = _span(slots)
    spend = invoices.groupBy(CUST).agg(
        F.count(F.lit(1)).alias("n_invoices"), F.sum("total").alias("revenue"), F.avg("total").alias("aov"),
        F.stddev_samp(F.col("total").cast("double")).alias("spend_std"))
    skus = items.groupBy(CUST, COL_STOCK_CODE).agg(F.lit(1).alias("one")).groupBy(CUST).agg(F.count(F.lit(1)).alias("unique_skus"))
    rev = F.col("revenue").cast("double")
    # the snapshot is one row
    return _per_customer(slots, first, last).join(spend, CUST).join(skus, CUST).crossJoin(F.broadcast(_snapshot_frame(last_time, snapshot))).select(
        CUST,
        days_between("last_ts", "snapshot").cast("bigint").alias("Recency"),
        F.col("n_invoices").cast("bigint").alias("Frequency"),
        rnd(rev, 2).alias("Monetary"),
        rnd(F.ln(F.col("n_invoices").cast("double") + 1.0), 10).alias("Log_Frequency"),
        rnd(F.log1p(rev), 4).alias("Log_Monetary"),
        rnd("aov", 2).alias("AOV"),
        rnd("spend_std", 2).alias("SpendStd"),
        F.col("day").alias("PreferredDayOfWeek"),
        rnd(F.col("weekend") / F.col("lines"), 4).alias("WeekendRatio"),
        F.col("hour").alias("PreferredHour"),
        F.col("unique_skus").cast("bigint").alias("UniqueSKUs"),
        F.col("total_items").cast("bigint").alias("TotalItems"),
        rnd((F.col("lines") - F.col("unique_skus")) / F.col("lines"), 4).alias("RepeatSKURatio"),
        month_index_text("cohort_month").alias("CohortMonth"),
        F.col("months").cast("bigint").alias("ActiveMonths"),
        days_between("first_ts", "last_ts").cast("bigint").alias("DaysSinceFirstPurchase"),
    )


def features_from_states(orders: DataFrame, items: DataFrame, raw: DataFrame | None = None, snapshot=None,
                         return_level: str = "line") -> DataFrame:
    """The feature matrix from states alone (``raw`` only for returns)."""
    from .behavioural import fill_defaults, purchase_gaps, return_rate
    from .cohort import FEATURE_COLUMNS
    from ..sources.io import materialise

    invoices = materialise(invoice_states(orders), "invoices")  # read for spend and gaps
    base = customer_features(orders, invoices, items, snapshot)
    out = base.join(purchase_gaps(None, invoices), CUST, "left").join(return_rate(raw, orders, return_level), CUST, "left")
    return fill_defaults(out).select(*FEATURE_COLUMNS)
