"""Exact running totals without a single-partition window.

``Window.orderBy(x)`` with no ``partitionBy`` (or partitioned by a key that
holds half the rows, such as a binary label) moves everything through one
task.  ``prefix_sums`` computes the same "sum of everything strictly
before this row" in two levels:

1. every row gets a bucket that is monotone in the ordering (range
   boundaries from ``percentile_approx``, or a caller-supplied monotone
   bucket such as a hash prefix);
2. per-(partition, bucket) totals — at most ``n_buckets`` rows per
   partition value — are turned into bucket offsets with a small window;
3. rows are windowed per (partition, bucket), i.e. ~1/n_buckets of the data
   per task, and the offset is added.

The result is exact; only the bucket boundaries are approximate, which
affects balance, never correctness.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def quantile_bucket(df: DataFrame, order_col: str, n_buckets: int = 256) -> tuple[DataFrame, Column]:
    """Attach range boundaries (one-row, ``n_buckets - 1`` values: a fixed
    size bound, so the cross join is a broadcast of one small row) and
    return (df with ``__bounds``, bucket expression)."""
    probs = [i / n_buckets for i in range(1, n_buckets)]
    bounds = df.agg(F.percentile_approx(F.col(order_col).cast("double"), probs, 10000).alias("__bounds"))
    with_b = df.crossJoin(F.broadcast(bounds))
    bucket = F.size(F.filter(F.col("__bounds"), lambda b: b < F.col(order_col).cast("double")))
    return with_b, bucket


def prefix_sums(
    df: DataFrame,
    order_cols: list[str],
    value_cols: list[str],
    partition_cols: list[str] | None = None,
    bucket: Column | None = None,
    n_buckets: int = 256,
    descending: bool = False,
) -> DataFrame:
    """Add ``<v>_before`` (sum over rows strictly earlier in the order, within
    the partition) for every ``v`` in ``value_cols``.  Order is ascending by
    ``order_cols`` (descending when ``descending``); rows tied on all order
    columns are taken in an arbitrary but consistent order, so callers that
    need tie-free semantics pre-aggregate on the order columns first.

    ``bucket`` must be monotone non-decreasing in the order (non-increasing
    when ``descending``); by default it is derived from range boundaries of
    the first order column."""
    part = list(partition_cols or [])
    if bucket is None:
        base, bucket = quantile_bucket(df, order_cols[0], n_buckets)
        if descending:
            bucket = F.lit(n_buckets) - bucket
    else:
        base = df
        if descending:
            bucket = -bucket
    b = base.withColumn("__bucket", bucket)
    if "__bounds" in b.columns:
        b = b.drop("__bounds")
    totals = b.groupBy(*part, "__bucket").agg(*[F.sum(v).alias(f"__t_{v}") for v in value_cols])
    w_bucket = Window.partitionBy(*part).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *part,
        "__bucket",
        *[F.coalesce(F.sum(f"__t_{v}").over(w_bucket), F.lit(0)).alias(f"__o_{v}") for v in value_cols],
    )
    order = [F.col(c).desc() if descending else F.col(c).asc() for c in order_cols]
    w_row = Window.partitionBy(*part, "__bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = b.select(
        "*", *[F.coalesce(F.sum(v).over(w_row), F.lit(0)).alias(f"__l_{v}") for v in value_cols]
    )
    out = local.join(offsets, [*part, "__bucket"], "inner")
    return out.select(
        *[F.col(c) for c in b.columns if c != "__bucket"],
        *[(F.col(f"__o_{v}") + F.col(f"__l_{v}")).alias(f"{v}_before") for v in value_cols],
    )


def hash_bucket(hex_col: str | Column, digits: int = 3) -> Column:
    """Monotone bucket for an order by a lowercase hex digest: the value of
    its first ``digits`` hex characters (16**digits buckets)."""
    c = F.col(hex_col) if isinstance(hex_col, str) else hex_col
    return F.conv(F.substring(c, 1, digits), 16, 10).cast("int")


def exact_quantiles(df: DataFrame, col: str, probs: dict[str, float], by: list[str] | None = None,
                    n_buckets: int = 256) -> DataFrame:
    """Exact, linearly interpolated quantiles (the definition of Spark's
    ``percentile``, pandas' and DuckDB's ``quantile_cont``) without holding
    a value->count map for a whole group in one task.

    Values are counted per distinct value, ranked with ``prefix_sums``
    (bucketed, so a large group is spread over many tasks), and the values at
    ranks floor(h) and ceil(h), h = (n - 1) * p, are picked by a filtered
    aggregate.  Output: ``by`` columns + one column per name in ``probs``."""
    by = list(by or [])
    v = df.select(*by, F.col(col).cast("double").alias("__v")).filter(F.col("__v").isNotNull())
    g = v.groupBy(*by, "__v").agg(F.count(F.lit(1)).alias("__c"))
    ranked = prefix_sums(g, ["__v"], ["__c"], partition_cols=by, n_buckets=n_buckets)
    tot = g.groupBy(*by).agg(F.sum("__c").alias("__n"))
    j = ranked.join(tot, by, "inner") if by else ranked.crossJoin(F.broadcast(tot))
    start, stop = F.col("__c_before"), F.col("__c_before") + F.col("__c")
    aggs = [F.max("__n").alias("__n")]
    for name, p in probs.items():
        h = (F.col("__n") - 1) * F.lit(float(p))
        for tag, r in (("lo", F.floor(h)), ("hi", F.ceil(h))):
            aggs.append(F.max(F.when((start <= r) & (r < stop), F.col("__v"))).alias(f"{name}__{tag}"))
    res = j.groupBy(*by).agg(*aggs)
    out = [F.col(c) for c in by]
    for name, p in probs.items():
        h = (F.col("__n") - 1) * F.lit(float(p))
        lo, hi = F.floor(h), F.ceil(h)
        vlo, vhi = F.col(f"{name}__lo"), F.col(f"{name}__hi")
        out.append(F.when((lo == hi) | (vlo == vhi), vlo).otherwise((hi - h) * vlo + (h - lo) * vhi).alias(name))
    return res.select(*out)
