"""Lookups of requested customers on a laid-out line table.

``lay_out`` writes the lines by customer bucket, newest first for each
customer, with a small table of line and order counts beside them.  A request
table then names its buckets, at most ``BUCKETS``, and only their files are
opened; the customer sort inside them lets Parquet skip row groups as well.
A bucket is written by several tasks, so a customer with a third of all lines
fills several files and no task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import COL_CUSTOMER_ID, COL_INVOICE, COL_INVOICE_DATE
from ..sources.versioned import VersionedTable

CUST = COL_CUSTOMER_ID
BUCKETS = 256
SPREAD = 8  # tasks that share a bucket
BUCKET = "_bucket"


def bucket_of(customer: Column) -> Column:
    return F.pmod(F.xxhash64(customer), F.lit(BUCKETS)).cast("int")


def place(customer: str = CUST, invoice: str = COL_INVOICE) -> list[Column]:
    """Bucket and share of it that a line belongs to."""
    return [bucket_of(F.col(customer)).alias(BUCKET), F.pmod(F.xxhash64(invoice), F.lit(SPREAD)).alias("_share")]


def lay_out(lines: DataFrame, table: VersionedTable, counts: VersionedTable, dealt: bool = False) -> None:
    """Publish the lines by bucket and (customer, lines, orders) by bucket.
    ``dealt`` says that the lines already lie by ``place`` (cleaned lines do),
    so they are written where they are; it changes files, never rows."""
    bucket, share = place()
    keyed = lines.withColumn(BUCKET, bucket)
    if not dealt:
        keyed = keyed.repartition(F.col(BUCKET), share)
    table.publish(keyed.sortWithinPartitions(BUCKET, CUST, F.desc(COL_INVOICE_DATE), COL_INVOICE), partition_by=[BUCKET])
    per = lines.groupBy(CUST, COL_INVOICE).agg(F.count(F.lit(1)).alias("n")).groupBy(CUST).agg(
        F.sum("n").alias("lines"), F.count(F.lit(1)).alias("orders"))
    counts.publish(per.withColumn(BUCKET, bucket_of(F.col(CUST))).repartition(BUCKET).sortWithinPartitions(BUCKET, CUST),
                   partition_by=[BUCKET])


def requested(ids: DataFrame) -> DataFrame:
    return ids.select(F.col(ids.columns[0]).cast("string").alias(CUST)).filter(F.col(CUST).isNotNull()).distinct()


def rows_of(table: VersionedTable, ids: DataFrame) -> DataFrame:
    """The stored rows of the requested customers; other buckets are pruned."""
    req = requested(ids)
    wanted = [r[0] for r in req.select(bucket_of(F.col(CUST))).distinct().collect()]  # at most BUCKETS
    return table.read().filter(F.col(BUCKET).isin(wanted)).join(req, CUST, "left_semi").drop(BUCKET)


def history(table: VersionedTable, counts: VersionedTable, ids: DataFrame) -> DataFrame:
    """Order lines of the requested customers, each customer's in one
    partition and newest first, with the customer's line and order counts."""
    mine = rows_of(table, ids).join(rows_of(counts, ids), CUST)
    return mine.repartition(CUST).sortWithinPartitions(CUST, F.desc(COL_INVOICE_DATE), COL_INVOICE)
