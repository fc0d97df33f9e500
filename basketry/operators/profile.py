"""Profiling operators.

Each profile is one (or a few) global aggregates whose per-task partial
results are tiny, so they scale with the input without a wide shuffle;
long-form outputs are produced with ``stack`` on the single aggregate row.
"""

from __future__ import annotations

from itertools import product

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import (
    CANCELLATION_PREFIX,
    COL_COUNTRY,
    COL_CUSTOMER_ID,
    COL_INVOICE,
    COL_INVOICE_DATE,
    COL_PRICE,
    COL_QUANTITY,
    COL_REVENUE,
)
from ..functions.numeric import days_between, month_text, rnd, starts_with_prefix

# Weekday names in calendar order (Monday first).
WEEKDAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def _stack(one_row: DataFrame, items: list[tuple[str, str]], names: tuple[str, ...]) -> DataFrame:
    """``items`` = [(sql literal/expr for first value, column name in
    one_row)] -> long form with columns ``names``."""
    body = ", ".join(f"{a}, `{b}`" for a, b in items)
    return one_row.selectExpr(f"stack({len(items)}, {body}) AS ({', '.join(names)})")


# C1 -------------------------------------------------------------------------
def missing_profile(df: DataFrame) -> DataFrame:
    """``(column, missing, pct)`` for columns with at least one NULL,
    pct = share of rows in %, 2 dp; sorted by pct descending."""
    aggs = [F.count(F.lit(1)).alias("__rows")] + [
        F.count_if(F.col(c).isNull()).alias(f"m_{i}") for i, c in enumerate(df.columns)
    ]
    one = df.agg(*aggs)
    long = _stack(one, [(f"'{c}'", f"m_{i}") for i, c in enumerate(df.columns)], ("column_name", "missing"))
    long = one.select("__rows").crossJoin(long)
    return (
        long.filter(F.col("missing") > 0)
        .select(
            "column_name",
            F.col("missing").cast("bigint"),
            rnd(F.col("missing") * 100.0 / F.col("__rows"), 2).alias("pct"),
        )
        .orderBy(F.desc("pct"), "column_name")
    )


# C2 -------------------------------------------------------------------------
def duplicate_profile(df: DataFrame) -> DataFrame:
    """``(rows, distinct_rows, duplicates, pct)``: duplicates are rows equal
    to an earlier row in every column.  Distinct rows are counted by a
    group-by on all columns (partial aggregation collapses copies per task)."""
    distinct = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("n"))
    return distinct.agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("distinct_rows")).select(
        F.col("rows").cast("bigint"),
        F.col("distinct_rows").cast("bigint"),
        (F.col("rows") - F.col("distinct_rows")).cast("bigint").alias("duplicates"),
        rnd((F.col("rows") - F.col("distinct_rows")) * 100.0 / F.col("rows"), 2).alias("pct"),
    )


# C3 -------------------------------------------------------------------------
def cancellation_profile(df: DataFrame, col: str = COL_INVOICE, prefix: str = CANCELLATION_PREFIX) -> DataFrame:
    """Counts per cancellation flag plus the rate (% of lines, 2 dp)."""
    flagged = df.select(starts_with_prefix(col, prefix).alias("IsCancelled"))
    counts = flagged.groupBy("IsCancelled").agg(F.count(F.lit(1)).alias("lines"))
    total = counts.agg(F.sum("lines").alias("total"))
    return counts.crossJoin(F.broadcast(total)).select(
        "IsCancelled",
        F.col("lines").cast("bigint"),
        rnd(F.col("lines") * 100.0 / F.col("total"), 2).alias("pct"),
    )


# C4 -------------------------------------------------------------------------
def date_span(df: DataFrame, col: str = COL_INVOICE_DATE) -> DataFrame:
    return df.agg(F.min(col).alias("earliest"), F.max(col).alias("latest")).select(
        "earliest", "latest", days_between("earliest", "latest").cast("bigint").alias("span_days")
    )


# C5 -------------------------------------------------------------------------
DESCRIBE_STATS = ["count", "mean", "std", "min", "25%", "50%", "75%", "max"]


def describe(df: DataFrame, cols: list[str] | None = None, digits: int = 6) -> DataFrame:
    """Summary statistics ``(column, statistic, value)`` for numeric
    columns: count, mean, sample std, min, exact linear-interpolated
    quartiles (``select_quantiles``: three scans for all columns), max.  Values are rounded to
    ``digits`` decimals (house rule) so engines agree."""
    from ..functions.selection import select_quantiles

    if cols is None:
        cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    [(_, quart)] = select_quantiles(df, cols, {"25%": 0.25, "50%": 0.5, "75%": 0.75}) or [((), {})]
    aggs, items = [], []
    for i, c in enumerate(cols):
        v = F.col(c).cast("double")
        stats = {"count": F.count(v), "mean": F.avg(F.col(c)), "std": F.stddev_samp(v), "min": F.min(v), "max": F.max(v),
                 **{k: F.lit(x).cast("double") for k, x in quart.get(c, {"25%": None, "50%": None, "75%": None}).items()}}
        for j, s in enumerate(DESCRIBE_STATS):
            aggs.append(rnd(stats[s], digits).alias(f"s_{i}_{j}"))
            items.append((f"'{c}', '{s}'", f"s_{i}_{j}"))
    one = df.agg(*aggs)
    body = ", ".join(f"{a}, `{b}`" for a, b in items)
    return one.selectExpr(f"stack({len(items)}, {body}) AS (column_name, statistic, value)")


# C6 -------------------------------------------------------------------------
def schema_profile(df: DataFrame) -> DataFrame:
    """``(position, column, dtype, non_null, nulls)`` — the schema with
    non-null counts from one aggregate."""
    fields = df.schema.fields
    aggs = [F.count(F.lit(1)).alias("__rows")] + [F.count(F.col(f.name)).alias(f"n_{i}") for i, f in enumerate(fields)]
    one = df.agg(*aggs)
    items = [(f"{i}, '{f.name}', '{f.dataType.simpleString()}'", f"n_{i}") for i, f in enumerate(fields)]
    body = ", ".join(f"{a}, `{b}`" for a, b in items)
    long = one.selectExpr("__rows", f"stack({len(items)}, {body}) AS (position, column_name, dtype, non_null)")
    return long.select(
        F.col("position").cast("int"),
        "column_name",
        "dtype",
        F.col("non_null").cast("bigint"),
        (F.col("__rows") - F.col("non_null")).cast("bigint").alias("nulls"),
    )


# C13 ------------------------------------------------------------------------
def valid_lines(raw: DataFrame, prefix: str = CANCELLATION_PREFIX) -> DataFrame:
    """Lines that are not cancellations and have a customer, with exact
    Revenue = Quantity x UnitPrice."""
    from .clean import revenue_expr

    inv = F.col(COL_INVOICE)
    return raw.filter((inv.isNull() | ~inv.startswith(prefix)) & F.col(COL_CUSTOMER_ID).isNotNull()).withColumn(
        COL_REVENUE, revenue_expr(COL_QUANTITY, COL_PRICE)
    )


# C7 -------------------------------------------------------------------------
def order_totals(df: DataFrame) -> DataFrame:
    return df.groupBy(COL_INVOICE).agg(rnd(F.sum(COL_REVENUE), 2).alias("order_total"))


# C8 -------------------------------------------------------------------------
def histogram(df: DataFrame, col: str, n: int, lo: float | None = None, hi: float | None = None,
              clip_lo: float | None = None, clip_hi: float | None = None) -> DataFrame:
    """Equal-width histogram: ``(bin 1..n, lower, upper, count)``; bins span
    [lo, hi] (data min/max of the — optionally clipped — values by
    default), are left-closed and the last bin is closed on both sides.
    Empty bins are kept (left join from the n-row bin dimension)."""
    from ..functions.numeric import clip as clip_expr

    v = F.col(col).cast("double")
    if clip_lo is not None or clip_hi is not None:
        v = clip_expr(v, clip_lo, clip_hi)
    vals = df.select(v.alias("v")).filter(F.col("v").isNotNull())
    bounds = vals.agg(
        (F.lit(float(lo)) if lo is not None else F.min("v")).alias("lo"),
        (F.lit(float(hi)) if hi is not None else F.max("v")).alias("hi"),
    )
    width = (F.col("hi") - F.col("lo")) / F.lit(n)
    idx = F.least(
        F.greatest(F.floor((F.col("v") - F.col("lo")) * F.lit(n) / (F.col("hi") - F.col("lo"))), F.lit(0)),
        F.lit(n - 1),
    )
    counts = (
        vals.crossJoin(F.broadcast(bounds))
        .filter((F.col("v") >= F.col("lo")) & (F.col("v") <= F.col("hi")))
        .select(F.when(F.col("hi") > F.col("lo"), idx).otherwise(F.lit(0)).cast("int").alias("b"))
        .groupBy("b")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    bins = df.sparkSession.range(n).select(F.col("id").cast("int").alias("b")).crossJoin(F.broadcast(bounds))
    return bins.join(counts, "b", "left").select(
        (F.col("b") + 1).alias("bin"),
        (F.col("lo") + F.col("b") * width).alias("lower"),
        (F.col("lo") + (F.col("b") + 1) * width).alias("upper"),
        F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count"),
    )


# C9 -------------------------------------------------------------------------
def top_n(df: DataFrame, key: str = COL_COUNTRY, measure: str = COL_REVENUE, n: int = 10) -> DataFrame:
    """Top-n keys by summed measure (ties broken by key).  orderBy + limit
    plans as TakeOrderedAndProject: each task keeps n rows."""
    return (
        df.groupBy(key)
        .agg(rnd(F.sum(measure), 2).alias("total"))
        .orderBy(F.desc("total"), F.asc(key))
        .limit(n)
    )


# C10 ------------------------------------------------------------------------
def monthly_revenue(df: DataFrame, date_col: str = COL_INVOICE_DATE, measure: str = COL_REVENUE) -> DataFrame:
    return df.groupBy(month_text(date_col).alias("YearMonth")).agg(rnd(F.sum(measure), 2).alias("revenue"))


# C11 ------------------------------------------------------------------------
def orders_by_weekday(df: DataFrame) -> DataFrame:
    """Distinct invoices per weekday name in calendar order; days without
    orders are kept with a NULL count (the reindex semantics)."""
    spark = df.sparkSession
    days = spark.createDataFrame(list(enumerate(WEEKDAY_NAMES)), "day_no int, DayOfWeek string")
    counts = (
        df.select(F.weekday(COL_INVOICE_DATE).alias("day_no"), COL_INVOICE)
        .groupBy("day_no")
        .agg(F.count_distinct(COL_INVOICE).alias("orders"))
    )
    return days.join(counts, "day_no", "left").select("day_no", "DayOfWeek", "orders").orderBy("day_no")


# C12 ------------------------------------------------------------------------
def customer_coverage(raw: DataFrame, valid: DataFrame) -> DataFrame:
    t = raw.agg(F.count_distinct(COL_CUSTOMER_ID).alias("total_customers"))
    v = valid.agg(F.count_distinct(COL_CUSTOMER_ID).alias("valid_customers"))
    return t.crossJoin(v).select(
        "total_customers",
        "valid_customers",
        rnd(F.col("valid_customers") * 100.0 / F.col("total_customers"), 1).alias("coverage_pct"),
    )


# C14 ------------------------------------------------------------------------
def clean_summary(df: DataFrame) -> DataFrame:
    return df.agg(
        F.min(COL_INVOICE_DATE).alias("first_date"),
        F.max(COL_INVOICE_DATE).alias("last_date"),
        F.count_distinct(COL_CUSTOMER_ID).alias("customers"),
        F.count_distinct(COL_INVOICE).alias("orders"),
        rnd(F.sum(COL_REVENUE), 2).alias("revenue"),
        F.count(F.lit(1)).alias("rows"),
    )


# C15 ------------------------------------------------------------------------
def correlation_matrix(df: DataFrame, cols: list[str], digits: int = 6) -> DataFrame:
    """Pearson correlation of every ordered pair of columns in long form
    ``(feature_a, feature_b, corr)``, from ONE aggregate of all distinct
    pairs (diagonal = 1.0); rounded to ``digits`` decimals."""
    aggs = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            if i < j:
                aggs.append(F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"r_{i}_{j}"))
    one = df.agg(*aggs) if aggs else df.agg(F.count(F.lit(1)).alias("__n"))
    items = []
    for (i, a), (j, b) in product(list(enumerate(cols)), repeat=2):
        if i == j:
            continue
        items.append((f"'{a}', '{b}'", f"r_{min(i, j)}_{max(i, j)}"))
    body = ", ".join(f"{x}, `{y}`" for x, y in items)
    off = one.selectExpr(f"stack({len(items)}, {body}) AS (feature_a, feature_b, corr)") if items else None
    diag = df.sparkSession.createDataFrame([(c, c, 1.0) for c in cols], "feature_a string, feature_b string, corr double")
    out = diag if off is None else off.unionByName(diag)
    return out.select("feature_a", "feature_b", rnd("corr", digits).alias("corr"))


def describe_text(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Summary of text columns ``(column_name, count, unique, top, freq)``:
    non-null count, distinct values, most frequent value (smallest on ties)
    and its frequency.  One grouped count per column (partial aggregation
    collapses a hot value on every task), then a small per-column reduce."""
    if cols is None:
        cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    out = None
    for c in cols:
        vc = df.filter(F.col(c).isNotNull()).groupBy(F.col(c).alias("v")).agg(F.count(F.lit(1)).alias("n"))
        stats = vc.agg(F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"), F.max("n").alias("freq"))
        top = vc.join(F.broadcast(stats.select("freq")), vc.n == F.col("freq")).agg(F.min("v").alias("top"))
        row = stats.crossJoin(F.broadcast(top)).select(
            F.lit(c).alias("column_name"),
            F.col("count").cast("bigint"),
            F.col("unique").cast("bigint"),
            "top",
            F.col("freq").cast("bigint"),
        )
        out = row if out is None else out.unionByName(row)
    return out
