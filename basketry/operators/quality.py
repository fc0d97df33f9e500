"""Validators and data-quality checks.

Every validator is ONE pass: a single global aggregate of conditional
counts (one partial aggregate per task, one row shuffled), turned into a
``(check, violations)`` table.  ``raise_if_violations`` collects that
tiny table on the driver and raises with every failed check listed, the
same "collect all errors then raise" contract as the reference.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import (
    CHURN_REQUEST_RULES,
    COL_CUSTOMER_ID,
    COL_REVENUE,
    REQUIRED_FEATURE_COLUMNS,
    RAW_COLUMNS,
    SEGMENT_REQUEST_RULES,
    ETLConfig,
)
from ..functions.numeric import starts_with_prefix


class ValidationError(ValueError):
    pass


def violation_table(df: DataFrame, checks: list[tuple[str, Column]], unique: str | None = None) -> DataFrame:
    """``checks`` = [(name, boolean Column that is TRUE on a bad row)].
    Returns ``(check string, violations bigint)`` for every check, computed
    in one aggregate.  Names are kept in the given order via ``check_no``.
    With ``unique``, check -1 counts rows minus distinct values of that column."""
    aggs = [(i, name, F.count_if(F.coalesce(cond, F.lit(False)))) for i, (name, cond) in enumerate(checks)]
    if unique is not None:
        aggs.insert(0, (-1, f"duplicate:{unique}", F.count(F.lit(1)) - F.count_distinct(F.col(unique))))
    if not aggs:
        raise ValueError("no checks given")
    one = df.agg(*[a.cast("bigint").alias(f"c{i + 1}") for i, _, a in aggs])
    stack = ", ".join(f"{i}, '{name}', c{i + 1}" for i, name, _ in aggs)
    return one.selectExpr(f"stack({len(aggs)}, {stack}) AS (check_no, check, violations)").select(
        F.col("check_no").cast("int"), "check", F.col("violations").cast("bigint")
    )


def raise_if_violations(table: DataFrame, what: str, extra_errors: list[str] | None = None) -> None:
    rows = table.filter(F.col("violations") > 0).orderBy("check_no").collect()
    errors = list(extra_errors or []) + [f"{r['check']}: {r['violations']:,}" for r in rows]
    if errors:
        raise ValidationError(f"Validation failed for {what}:\n" + "\n".join(f"  - {e}" for e in errors))


def _null_checks(df: DataFrame) -> list[tuple[str, Column]]:
    return [(f"null:{c}", F.col(c).isNull()) for c in df.columns]


# A3 -------------------------------------------------------------------------
def validate_raw(df: DataFrame, required=RAW_COLUMNS) -> None:
    """Required columns present and at least one row."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValidationError(f"Missing required columns: {missing}")
    if df.isEmpty():
        raise ValidationError("Raw data is empty")


# B11 ------------------------------------------------------------------------
def clean_checks(df: DataFrame, cfg: ETLConfig = ETLConfig()) -> DataFrame:
    checks = _null_checks(df)
    checks += [
        ("non_positive_quantity", ~(F.col(cfg.quantity_column) > 0)),
        ("non_positive_price", ~(F.col(cfg.price_column) > 0)),
        ("cancellations_remaining", starts_with_prefix(cfg.invoice_column, cfg.cancellation_prefix)),
    ]
    return violation_table(df, checks)


def validate_clean(df: DataFrame, cfg: ETLConfig = ETLConfig()) -> None:
    extra = []
    if COL_REVENUE not in df.columns:
        extra.append("Revenue column missing")
    if df.isEmpty():
        extra.append("cleaned data is empty")
    raise_if_violations(clean_checks(df, cfg), "cleaned order lines", extra)


# Uniqueness of the key is counted as rows - distinct keys in the same pass.
def _keyed_checks(df: DataFrame, key: str, rules: list[tuple[str, Column]]) -> DataFrame:
    """Violation table for a one-row-per-key table; the duplicate-key
    count (rows - distinct keys) is added as an extra check row."""
    return violation_table(df, _null_checks(df) + rules, unique=key)


# D4 -------------------------------------------------------------------------
def rfm_checks(rfm: DataFrame) -> DataFrame:
    return _keyed_checks(
        rfm,
        COL_CUSTOMER_ID,
        [
            ("negative_recency", F.col("Recency") < 0),
            ("non_positive_frequency", F.col("Frequency") <= 0),
            ("non_positive_monetary", F.col("Monetary") <= 0),
        ],
    )


# E13 ------------------------------------------------------------------------
def behavioural_checks(b: DataFrame) -> DataFrame:
    return _keyed_checks(b, COL_CUSTOMER_ID, [("non_positive_aov", F.col("AOV") <= 0)])


# F5 -------------------------------------------------------------------------
def cohort_checks(c: DataFrame) -> DataFrame:
    return _keyed_checks(
        c,
        COL_CUSTOMER_ID,
        [
            ("non_positive_active_months", F.col("ActiveMonths") <= 0),
            ("negative_days_since_first", F.col("DaysSinceFirstPurchase") < 0),
        ],
    )


# G2 -------------------------------------------------------------------------
def feature_checks(m: DataFrame) -> DataFrame:
    return _keyed_checks(m, COL_CUSTOMER_ID, [])


def validate_keyed(table: DataFrame, checks: DataFrame, what: str, required: list[str] | None = None) -> None:
    extra = []
    if required:
        missing = [c for c in required if c not in table.columns]
        if missing:
            extra.append(f"missing columns: {missing}")
    if table.isEmpty():
        extra.append("table is empty")
    raise_if_violations(checks, what, extra)


def validate_rfm(rfm: DataFrame) -> None:
    validate_keyed(rfm, rfm_checks(rfm), "RFM")


def validate_behavioural(b: DataFrame) -> None:
    validate_keyed(b, behavioural_checks(b), "behavioural features")


def validate_cohort(c: DataFrame) -> None:
    validate_keyed(c, cohort_checks(c), "cohort features")


def validate_features(m: DataFrame) -> None:
    validate_keyed(m, feature_checks(m), "feature matrix", REQUIRED_FEATURE_COLUMNS)


# DQ1 ------------------------------------------------------------------------
_OPS = {
    "ge": lambda c, b: c >= b,
    "gt": lambda c, b: c > b,
    "le": lambda c, b: c <= b,
    "lt": lambda c, b: c < b,
}


def failed_rules_expr(rules) -> Column:
    """Array of the names of the rules a row fails (NULL fails a rule)."""
    names = [
        F.when(~F.coalesce(_OPS[op](F.col(field), F.lit(bound)), F.lit(False)), F.lit(f"{field}_{op}_{bound}"))
        for field, op, bound in rules
    ]
    return F.filter(F.array(*names), lambda x: x.isNotNull())


def validate_requests(df: DataFrame, kind: str = "churn") -> tuple[DataFrame, DataFrame]:
    """Split scoring requests into (good, quarantine); the quarantine rows
    carry ``failed_rules`` (array of rule names)."""
    rules = CHURN_REQUEST_RULES if kind == "churn" else SEGMENT_REQUEST_RULES
    tagged = df.withColumn("failed_rules", failed_rules_expr(rules))
    good = tagged.filter(F.size("failed_rules") == 0).drop("failed_rules")
    bad = tagged.filter(F.size("failed_rules") > 0)
    return good, bad
