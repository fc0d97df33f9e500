"""Cleaning operators (projections, filters, predicates) for order lines.

The full chain (``clean``) is lazy: each step is a DataFrame transform, so
Catalyst fuses the row filters into one scan-side predicate, prunes unused
columns, and the only exchanges are the de-duplication (hash on all
columns, with map-side partial aggregation collapsing duplicates before the
shuffle) and the single-row global aggregate for the quantile caps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import COL_REVENUE, COL_SOURCE_TAG, DATE_FORMATS, ETLConfig
from ..functions.numeric import starts_with_prefix, trim_all
from ..functions.selection import select_quantiles, staged_sketch


# B1 -------------------------------------------------------------------------
def drop_internal(df: DataFrame, columns=(COL_SOURCE_TAG,)) -> DataFrame:
    """Drop internal bookkeeping columns; absent columns are ignored."""
    return df.drop(*[c for c in columns if c in df.columns])


# B2 -------------------------------------------------------------------------
def parsed_date(col: str, formats: tuple[str, ...] = DATE_FORMATS):
    """Text as a zone-less timestamp: ISO forms, else the first of ``formats``
    that fits, else NULL."""
    text = F.trim(F.col(col).cast("string"))
    ways = [F.try_to_timestamp(text, F.lit(f)).cast("timestamp_ntz") for f in formats]
    return F.coalesce(text.try_cast("timestamp_ntz"), *ways)


def parse_dates(df: DataFrame, col: str, formats: tuple[str, ...] = DATE_FORMATS) -> DataFrame:
    """Parse the date column leniently (unparseable text becomes NULL) and
    drop rows whose date is NULL.  Timestamps without a time zone are used
    throughout (the source dates are zone-less wall-clock times)."""
    dtype = df.schema[col].dataType
    if isinstance(dtype, T.TimestampNTZType):
        parsed = F.col(col)
    elif isinstance(dtype, (T.TimestampType, T.DateType)):
        parsed = F.col(col).cast("timestamp_ntz")
    else:
        parsed = parsed_date(col, formats)
    return df.withColumn(col, parsed).filter(F.col(col).isNotNull())


# B3 -------------------------------------------------------------------------
def drop_null(df: DataFrame, col: str | list[str]) -> DataFrame:
    """Drop rows with a NULL in any listed column.  Written as IsNotNull
    filters (pushed to the scan); ``na.drop`` compiles to AtLeastNNonNulls,
    which is not pushed down."""
    cols = [col] if isinstance(col, str) else list(col)
    cond = None
    for c in cols:
        cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
    return df.filter(cond)


# B4 -------------------------------------------------------------------------
def normalise_id_expr(col: str):
    """Text form of an id with one trailing ``.0`` removed, then trimmed
    (removal happens before trimming, so ``"12345.0 "`` keeps its ``.0``)."""
    return trim_all(F.regexp_replace(F.col(col).cast("string"), r"\.0$", ""))


def normalise_id(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, normalise_id_expr(col))


# B5 -------------------------------------------------------------------------
def remove_cancellations(df: DataFrame, col: str, prefix: str = "C") -> DataFrame:
    """Drop lines whose invoice starts with the cancellation prefix; a NULL
    invoice is kept."""
    # Same rows as NOT coalesce(startswith, false), written so the scan can
    # take it as a pushed filter (IsNull OR NOT StringStartsWith).
    c = F.col(col).cast("string")
    return df.filter(c.isNull() | ~c.startswith(prefix))


# B6 -------------------------------------------------------------------------
def keep_positive(df: DataFrame, cols: list[str]) -> DataFrame:
    """Keep rows where every listed column is > 0 (NULL fails)."""
    cond = None
    for c in cols:
        # a NULL comparison drops the row, as false would; kept pushable
        cond = (F.col(c) > 0) if cond is None else cond & (F.col(c) > 0)
    return df.filter(cond)


# B7 -------------------------------------------------------------------------
def dedup_rows(df: DataFrame, near: tuple[str, str] | None = None) -> DataFrame:
    """Remove full-row duplicates (NULL equals NULL).

    ``near`` = (customer, invoice) deals the rows out by customer bucket and
    an eighth of its invoices (``lookup.place``) instead of by all columns.
    Copies still meet, as both follow from the row, and what is written next
    holds an invoice in one file and a customer in at most ``SPREAD``, so later
    aggregates by either are small before their shuffle."""
    if near is None:
        return df.dropDuplicates()
    from .lookup import place

    dealt = df.select("*", *place(*near))
    here = [c for c in dealt.columns if c not in df.columns]
    return dealt.repartition(*here).dropDuplicates().drop(*here)


# B8 -------------------------------------------------------------------------
def outlier_caps(df: DataFrame, cols: list[str], q: float, relative_error: float | None = None,
                 sketched: dict | None = None) -> dict[str, float | None]:
    """The q-quantile of every column, exact and linearly interpolated; all
    columns in two scans of the named columns, one with the sketch of
    ``staged_sketch`` (``select_quantiles``).  ``relative_error`` asks for an
    approximate one."""
    if relative_error is not None:
        acc = max(1, int(round(1.0 / relative_error)))
        row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), q, acc).cast("double").alias(c) for c in cols]).first()
        return row.asDict()
    [(_, caps)] = select_quantiles(df, cols, {"cap": q}, sketched=sketched) or [((), {c: {"cap": None} for c in cols})]
    return {c: caps[c]["cap"] for c in cols}


def quantile_caps(df: DataFrame, cols: list[str], q: float, relative_error: float | None = None) -> DataFrame:
    """``outlier_caps`` as a one-row table (``<col>_cap``)."""
    caps = outlier_caps(df, cols, q, relative_error)
    return df.sparkSession.createDataFrame([tuple(caps.values())], ", ".join(f"`{c}_cap` double" for c in caps))


def within_caps(caps: dict[str, float | None]) -> Column:
    """Whether no column is above its cap; without a cap nothing passes."""
    keep = F.lit(True)
    for c, cap in caps.items():
        keep = keep & (F.col(c).cast("double") <= F.lit(cap))
    return keep


def drop_outliers(df: DataFrame, cols: list[str], q: float = 0.99, relative_error: float | None = None) -> DataFrame:
    """Drop rows above the q-quantile of any listed column; all quantiles
    come from the same (pre-filter) input.  The input is staged once, since
    caps and result both read it: whatever made it (a de-duplicating shuffle)
    runs once, and the caps only scan their own columns."""
    rows, seen = staged_sketch(df, "before_outliers", cols, [q])
    return rows.filter(within_caps(outlier_caps(rows, cols, q, relative_error, seen)))


# B9 -------------------------------------------------------------------------
def revenue_expr(qty: str, price: str):
    return (F.col(qty).cast("decimal(18,0)") * F.col(price).cast("decimal(18,2)")).cast("decimal(18,2)")


def add_revenue(df: DataFrame, qty: str, price: str, out: str = COL_REVENUE) -> DataFrame:
    """Revenue = quantity x unit price as exact decimal(18,2)."""
    return df.withColumn(out, revenue_expr(qty, price))


# B10 ------------------------------------------------------------------------
def trim_strings(df: DataFrame) -> DataFrame:
    """Strip surrounding whitespace of every string column in one select."""
    return df.select(
        *[
            trim_all(f.name).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


# B14 ------------------------------------------------------------------------
def clip(df: DataFrame, col: str, lo=None, hi=None, out: str | None = None) -> DataFrame:
    from ..functions.numeric import clip as clip_expr

    return df.withColumn(out or col, clip_expr(col, lo, hi))


# B12 ------------------------------------------------------------------------
def clean(df: DataFrame, cfg: ETLConfig = ETLConfig(), validate: bool = True) -> DataFrame:
    """Full cleaning chain, in the reference's order:

    drop tag -> parse dates -> drop null customer -> normalise id ->
    drop cancellations -> keep positive -> de-duplicate -> drop outliers ->
    revenue -> trim strings -> validate.

    De-duplication runs after id normalisation and before trimming, so rows
    differing only in surrounding whitespace stay distinct.
    """
    out = (
        df.transform(drop_internal)
        .transform(lambda d: parse_dates(d, cfg.date_column))
        .transform(lambda d: drop_null(d, cfg.customer_id_column))
        .transform(lambda d: normalise_id(d, cfg.customer_id_column))
        .transform(lambda d: remove_cancellations(d, cfg.invoice_column, cfg.cancellation_prefix))
        .transform(lambda d: keep_positive(d, [cfg.quantity_column, cfg.price_column]))
        .transform(lambda d: dedup_rows(d, (cfg.customer_id_column, cfg.invoice_column)))
        .transform(
            lambda d: drop_outliers(
                d, [cfg.quantity_column, cfg.price_column], cfg.outlier_quantile, cfg.outlier_relative_error
            )
        )
        .transform(lambda d: add_revenue(d, cfg.quantity_column, cfg.price_column))
        .transform(trim_strings)
    )
    if validate:
        from .quality import validate_clean

        validate_clean(out, cfg)
    return out


def clean_rows_before_outliers(df: DataFrame, cfg: ETLConfig = ETLConfig()) -> DataFrame:
    """B1-B7 only (the input of the outlier step)."""
    return (
        df.transform(drop_internal)
        .transform(lambda d: parse_dates(d, cfg.date_column))
        .transform(lambda d: drop_null(d, cfg.customer_id_column))
        .transform(lambda d: normalise_id(d, cfg.customer_id_column))
        .transform(lambda d: remove_cancellations(d, cfg.invoice_column, cfg.cancellation_prefix))
        .transform(lambda d: keep_positive(d, [cfg.quantity_column, cfg.price_column]))
        .transform(dedup_rows)
    )


# B13 ------------------------------------------------------------------------
def clean_audit(df: DataFrame, cfg: ETLConfig = ETLConfig()) -> DataFrame:
    """Rows entering / dropped / kept per cleaning step, as one table
    ``(step_no, step, rows_in, rows_dropped, rows_out, kept_pct)``.

    Row-level steps are counted with a first-failing-reason column and one
    grouped aggregate (not one job per step); de-duplication and the
    outlier caps are set-level and counted from their own outputs.
    """
    inv, cust, qty, price, date = (
        cfg.invoice_column,
        cfg.customer_id_column,
        cfg.quantity_column,
        cfg.price_column,
        cfg.date_column,
    )
    d0 = drop_internal(df)
    dtype = d0.schema[date].dataType
    if isinstance(dtype, T.StringType):
        parsed = F.trim(F.col(date)).try_cast("timestamp_ntz")
    else:
        parsed = F.col(date).cast("timestamp_ntz")
    reason = (
        F.when(parsed.isNull(), F.lit(2))
        .when(F.col(cust).isNull(), F.lit(3))
        .when(starts_with_prefix(inv, cfg.cancellation_prefix), F.lit(5))
        .when(~(F.coalesce(F.col(qty) > 0, F.lit(False)) & F.coalesce(F.col(price) > 0, F.lit(False))), F.lit(6))
        .otherwise(F.lit(0))
    )
    row_counts = d0.select(reason.alias("reason")).groupBy("reason").count()

    pre_dedup = (
        d0.transform(lambda d: parse_dates(d, date))
        .transform(lambda d: drop_null(d, cust))
        .transform(lambda d: normalise_id(d, cust))
        .transform(lambda d: remove_cancellations(d, inv, cfg.cancellation_prefix))
        .transform(lambda d: keep_positive(d, [qty, price]))
    )
    deduped, seen = staged_sketch(dedup_rows(pre_dedup), "deduped", [qty, price], [cfg.outlier_quantile])
    caps = outlier_caps(deduped, [qty, price], cfg.outlier_quantile, cfg.outlier_relative_error, seen)
    set_counts = deduped.agg(
        F.count(F.lit(1)).alias("r7"), F.count_if(within_caps(caps)).alias("r8"),
    ).selectExpr("stack(2, 7, r7, 8, r8) AS (reason, count)")
    counts = row_counts.unionByName(set_counts)
    return audit_from_counts(counts)


AUDIT_STEPS = [
    (2, "parse_dates"),
    (3, "drop_null_customer"),
    (5, "remove_cancellations"),
    (6, "keep_positive"),
    (7, "dedup_rows"),
    (8, "drop_outliers"),
]


def audit_from_counts(counts: DataFrame) -> DataFrame:
    """Turn (reason, count) rows into the per-step audit table.  The input
    has at most ~10 rows, so the pivot to one row is a tiny aggregate."""
    spark = counts.sparkSession
    piv = counts.agg(
        F.sum(F.when(F.col("reason") < 7, F.col("count")).otherwise(0)).alias("r-1"),
        *[F.sum(F.when(F.col("reason") == r, F.col("count")).otherwise(0)).alias(f"r{r}") for r in (2, 3, 5, 6, 7, 8)]
    )
    steps = spark.createDataFrame(AUDIT_STEPS, "step_no int, step string")
    p = piv
    rows_in = (
        F.when(F.col("step_no") == 2, F.col("r-1"))
        .when(F.col("step_no") == 3, F.col("r-1") - F.col("r2"))
        .when(F.col("step_no") == 5, F.col("r-1") - F.col("r2") - F.col("r3"))
        .when(F.col("step_no") == 6, F.col("r-1") - F.col("r2") - F.col("r3") - F.col("r5"))
        .when(F.col("step_no") == 7, F.col("r-1") - F.col("r2") - F.col("r3") - F.col("r5") - F.col("r6"))
        .otherwise(F.col("r7"))
    )
    rows_out = (
        F.when(F.col("step_no") == 2, F.col("r-1") - F.col("r2"))
        .when(F.col("step_no") == 3, F.col("r-1") - F.col("r2") - F.col("r3"))
        .when(F.col("step_no") == 5, F.col("r-1") - F.col("r2") - F.col("r3") - F.col("r5"))
        .when(F.col("step_no") == 6, F.col("r-1") - F.col("r2") - F.col("r3") - F.col("r5") - F.col("r6"))
        .when(F.col("step_no") == 7, F.col("r7"))
        .otherwise(F.col("r8"))
    )
    out = steps.crossJoin(F.broadcast(p)).select(
        "step_no",
        "step",
        rows_in.cast("bigint").alias("rows_in"),
        (rows_in - rows_out).cast("bigint").alias("rows_dropped"),
        rows_out.cast("bigint").alias("rows_out"),
    )
    from ..functions.numeric import rnd

    return out.withColumn(
        "kept_pct", rnd(F.try_divide(F.col("rows_out") * 100.0, F.col("rows_in").cast("double")), 2)
    )
