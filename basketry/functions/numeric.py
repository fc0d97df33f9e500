"""Column expressions that pin down the numeric and calendar rules.

All helpers return ``Column`` objects built from Spark SQL built-ins so they
stay inside whole-stage codegen; none of them needs Python on executors.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(col: ColumnOrName) -> Column:
    return F.col(col) if isinstance(col, str) else col


def rnd(col: ColumnOrName, n: int) -> Column:
    """House rounding rule: round the value as a decimal(28,10), HALF_UP,
    and return a double.  Rounding through a decimal removes the binary
    representation noise that makes naive ``round(double)`` disagree between
    engines on values such as 1.005."""
    return F.round(_c(col).cast("double").cast("decimal(28,10)"), n).cast("double")


def days_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Whole days between two timestamps: floor of the elapsed time over
    24 hours (23:00 -> 01:00 two days later is 1, not 2)."""
    return F.timestamp_diff("DAY", _c(start), _c(end))


def trim_all(col: ColumnOrName) -> Column:
    """Strip leading and trailing whitespace of any kind (tabs, new lines,
    spaces) — Spark's ``trim`` only removes spaces."""
    return F.regexp_replace(_c(col), r"^\s+|\s+$", "")


def weekday0(col: ColumnOrName) -> Column:
    """Day of week with Monday = 0 ... Sunday = 6."""
    return F.weekday(_c(col))


def safe_div(num: ColumnOrName, den: ColumnOrName) -> Column:
    """Division that yields NULL instead of failing on a zero divisor."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def clip(col: ColumnOrName, lo=None, hi=None) -> Column:
    """Clip a value into ``[lo, hi]`` (either bound optional)."""
    out = _c(col)
    if lo is not None:
        out = F.greatest(out, F.lit(lo))
    if hi is not None:
        out = F.least(out, F.lit(hi))
    return out


def starts_with_prefix(col: ColumnOrName, prefix: str) -> Column:
    """True when the text form of ``col`` starts with ``prefix``; a NULL
    value is treated as not matching (the reference compares the text
    ``'None'``)."""
    return F.coalesce(_c(col).cast("string").startswith(prefix), F.lit(False))


def month_text(col: ColumnOrName) -> Column:
    """Calendar month of a timestamp as ``yyyy-MM`` text."""
    return F.date_format(_c(col), "yyyy-MM")


def as_double(col: ColumnOrName) -> Column:
    return _c(col).cast("double")


# Mode with ties to the smallest value, as an algebraic max over one bigint.
# Values must lie in [0, MODE_SLOTS); counts below 2**57 keep the key exact.
MODE_SLOTS = 64


def mode_key(count: ColumnOrName, value: ColumnOrName) -> Column:
    """Pack (count, value) so that max() picks the highest count and, among
    equal counts, the smallest value.  A bigint keeps the aggregate in
    Spark's fixed-width hash aggregation (a struct buffer would force a
    sort-based aggregate)."""
    return _c(count).cast("bigint") * MODE_SLOTS + (MODE_SLOTS - 1 - _c(value).cast("bigint"))


def mode_value(key: ColumnOrName) -> Column:
    return (F.lit(MODE_SLOTS - 1) - (_c(key) % MODE_SLOTS)).cast("int")


def month_index(col: ColumnOrName) -> Column:
    """Calendar month as an integer (year * 12 + month - 1): orders like the
    month and aggregates with fixed-width (hash-aggregate) buffers."""
    return (F.year(_c(col)) * 12 + F.month(_c(col)) - 1).cast("int")


def month_index_text(col: ColumnOrName) -> Column:
    """``yyyy-MM`` text of a month index."""
    c = _c(col)
    return F.date_format(F.make_date(F.floor(c / 12).cast("int"), (c % 12 + 1).cast("int"), F.lit(1)), "yyyy-MM")
