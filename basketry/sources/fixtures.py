"""Map the shared test tables onto retail order lines.

The test data is a TPC-H-like star schema; the operators consume order
lines with the reference's eight columns.  The mapping below derives those
columns (and the defects the cleaning steps exist for) by deterministic
rules, so every engine that applies the same rules sees the same rows:

* CustomerID  — NULL when ``o_orderkey % 4 = 0``; ``<custkey>.0`` when
  ``o_orderkey % 3 = 0``; else the customer key as text.
* InvoiceNo   — ``'C' || o_orderkey`` for returned lines, else the key.
* StockCode   — the part key as text.
* Description — the part name padded with one space on each side.
* Quantity    — ``-l_quantity`` for returned lines, else ``l_quantity``.
* InvoiceDate — order date + (8 + key % 10) hours + (key % 60) minutes.
* UnitPrice   — retail price as decimal(18,2).
* Country     — nation name of the customer.
* Lines whose part key is a multiple of 100 appear twice (full-row
  duplicates).

The duplicate copies are produced with a generator (``explode`` of a
1- or 2-element sequence) instead of a UNION of the joined plan, so the
four joins run once.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import (
    COL_COUNTRY,
    COL_CUSTOMER_ID,
    COL_DESCRIPTION,
    COL_INVOICE,
    COL_INVOICE_DATE,
    COL_PRICE,
    COL_QUANTITY,
    COL_STOCK_CODE,
)

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

DUPLICATE_PART_MODULUS = 100


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one test table (``<sf_dir>/<name>.parquet``)."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def raw_order_lines(spark: SparkSession, sf_dir: str, with_part_status: bool = False) -> DataFrame:
    """Raw order lines (eight columns) derived from
    ``lineitem ⋈ orders ⋈ part ⋈ customer ⋈ nation``.

    Join strategy is left to Catalyst/AQE, but the order of the joins keeps
    the lines narrow: customers meet the orders first, so the lines are only
    dealt out for parts and for orders, with keys, quantity and return flag,
    and the nation names come last.  Orders come after parts, so that an
    order's lines lie together in what is written.
    ``with_part_status`` keeps ``l_linestatus`` for the two-part source
    (A1/A2) built on top of this mapping.
    """
    status = ["l_linestatus"] if with_part_status else []
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", F.col("l_quantity").cast("int").alias("l_quantity"),
        (F.col("l_returnflag") == F.lit("R")).alias("l_returned"), *status)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")

    placed = orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        "o_orderkey", "o_custkey", "o_orderdate", "c_nationkey")
    joined = (
        li.join(part, li.l_partkey == part.p_partkey)
        .join(placed, li.l_orderkey == placed.o_orderkey)
        .join(nation, placed.c_nationkey == nation.n_nationkey)
    )

    okey = F.col("o_orderkey")
    cust_txt = F.col("o_custkey").cast("string")
    returned = F.col("l_returned")
    qty = F.col("l_quantity")
    lines = joined.select(
        F.when(returned, F.concat(F.lit("C"), okey.cast("string")))
        .otherwise(okey.cast("string"))
        .alias(COL_INVOICE),
        F.col("l_partkey").cast("string").alias(COL_STOCK_CODE),
        F.concat(F.lit(" "), F.col("p_name"), F.lit(" ")).alias(COL_DESCRIPTION),
        F.when(returned, -qty).otherwise(qty).alias(COL_QUANTITY),
        (
            F.col("o_orderdate")
            + F.make_dt_interval(
                F.lit(0),
                (F.lit(8) + okey % 10).cast("int"),
                (okey % 60).cast("int"),
                F.lit(0),
            )
        ).alias(COL_INVOICE_DATE),
        F.col("p_retailprice").cast("decimal(18,2)").alias(COL_PRICE),
        F.when(okey % 4 == 0, F.lit(None).cast("string"))
        .when(okey % 3 == 0, F.concat(cust_txt, F.lit(".0")))
        .otherwise(cust_txt)
        .alias(COL_CUSTOMER_ID),
        F.col("n_name").alias(COL_COUNTRY),
        *status,
        F.explode(
            F.sequence(
                F.lit(1),
                F.when(F.col("l_partkey") % DUPLICATE_PART_MODULUS == 0, 2).otherwise(1),
            )
        ).alias("_copy"),
    )
    return lines.drop("_copy")


def event_order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second, sparser transaction source: each ``purchase`` event of the
    ``events`` table is one invoice with one line (quantity 1, price = the
    event value)."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return ev.filter(F.col("event_type") == "purchase").select(
        F.col("event_id").cast("string").alias(COL_INVOICE),
        F.lit("EVENT").alias(COL_STOCK_CODE),
        F.lit("purchase").alias(COL_DESCRIPTION),
        F.lit(1).alias(COL_QUANTITY),
        F.col("ts").alias(COL_INVOICE_DATE),
        F.col("value").cast("decimal(18,2)").alias(COL_PRICE),
        F.col("user_id").cast("string").alias(COL_CUSTOMER_ID),
        F.lit("ONLINE").alias(COL_COUNTRY),
    )
