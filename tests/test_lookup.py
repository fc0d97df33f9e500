"""Lookups on laid-out lines: same rows, pruned files, newest first."""

import os
import re
import tempfile

import pytest
from pyspark.sql import functions as F

from basketry.operators import lookup as lk
from basketry.operators import reports as rp
from basketry.plans import queries_core as qc
from basketry.sources.versioned import VersionedTable

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


@pytest.fixture(scope="module")
def laid(spark):
    base = tempfile.mkdtemp(prefix="lookup-")
    tables = VersionedTable(spark, f"{base}/lines"), VersionedTable(spark, f"{base}/counts")
    lines = qc.clean_lines(spark, SF)
    lk.lay_out(lines, *tables)
    return lines, tables


def test_history_equals_the_plain_plan(spark, laid):
    lines, tables = laid
    ids = lines.select("CustomerID").distinct().filter(F.pmod(F.xxhash64("CustomerID"), F.lit(5)) == 0).unionByName(
        spark.createDataFrame([("absent",), (None,)], "CustomerID string"))
    got = lk.history(*tables, ids)
    want = rp.customer_history(lines, ids)
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect())) and got.count() > 100
    spend = rp.customer_monthly_spend(lk.rows_of(tables[0], ids))
    assert sorted(spend.collect()) == sorted(rp.customer_monthly_spend(lines, ids).collect())


def test_each_customer_is_newest_first(spark, laid):
    lines, tables = laid
    got = lk.history(*tables, lines.select("CustomerID")).withColumn("p", F.spark_partition_id()).collect()
    last, home = {}, {}
    for r in got:
        assert home.setdefault(r["CustomerID"], r["p"]) == r["p"]
        assert r["InvoiceDate"] <= last.get(r["CustomerID"], r["InvoiceDate"])
        last[r["CustomerID"]] = r["InvoiceDate"]


def test_no_range_exchange_and_pruned_buckets(spark, laid):
    lines, tables = laid
    one = lines.select("CustomerID").limit(1)
    plan = lk.history(*tables, one)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "Window" not in plan
    assert len(re.findall(r"PartitionFilters: \[[^\]]*_bucket", plan)) == 2
    bucket = one.select(lk.bucket_of(F.col("CustomerID"))).first()[0]
    for t in tables:  # no other bucket's file is opened
        for folder, _, files in os.walk(t.path):
            for f in files:
                if f.endswith(".parquet") and not folder.endswith(f"_bucket={bucket}"):
                    with open(os.path.join(folder, f), "wb") as out:
                        out.write(b"broken")
    assert lk.history(*tables, one).count() > 0


def test_a_hot_customer_fills_several_files(spark):
    base = tempfile.mkdtemp(prefix="lookup-")
    tables = VersionedTable(spark, f"{base}/lines"), VersionedTable(spark, f"{base}/counts")
    lines = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("CustomerID"),
        F.format_string("i%d", F.col("id") % 500).alias("InvoiceNo"),
        F.timestamp_seconds(F.col("id") * 1000).cast("timestamp_ntz").alias("InvoiceDate"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small tasks are not put together, as if large
    try:
        lk.lay_out(lines, *tables)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    got = lk.history(*tables, spark.createDataFrame([("hot",)], "c string"))
    r = got.first()
    assert got.count() == 1000 == r["lines"] and r["orders"] == 500
    bucket = spark.range(1).select(lk.bucket_of(F.lit("hot"))).first()[0]
    folder = f"{tables[0].path}/data/_batch={tables[0].version().batches[0]}/_bucket={bucket}"
    assert sum(f.endswith(".parquet") for f in os.listdir(folder)) > 1
