"""Catalog tables: written, counted, read by name, and planned by statistics."""

import os
import tempfile

from pyspark.sql import functions as F

from basketry.sources import io as sio


def test_named_table_round_trip(spark):
    at = os.path.join(tempfile.mkdtemp(prefix="catalog-"), "t")
    assert sio.save_named(spark.range(50).withColumn("v", F.col("id") * 2), "ct_round", at) == 50
    assert sio.read_table(spark, "ct_round").agg(F.sum("v")).first()[0] == 2450
    assert sio.recorded_rows(spark, "ct_round") == 50
    assert sio.save_named(spark.range(7).withColumn("v", F.col("id")), "ct_round", at) == 7
    assert sio.read_table(spark, "ct_round").count() == 7 and sio.recorded_rows(spark, "ct_round") == 7
    assert sio.verify_count(spark, "ct_round", 7) == 7
    spark.sql("DROP TABLE ct_round")


def test_join_choice_follows_the_statistics(spark):
    """A filter that leaves few rows makes its side small enough to broadcast,
    which only column statistics can tell."""
    base = tempfile.mkdtemp(prefix="catalog-")
    rows = spark.range(40_000).select("id", F.format_string("%064d", "id").alias("text"))
    sio.save_named(rows, "ct_plain", f"{base}/plain", statistics=False)
    sio.save_named(rows, "ct_known", f"{base}/known")
    keep = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.cbo.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20k")
    spark.conf.set("spark.sql.cbo.enabled", "true")
    try:
        def plan(name):
            small = spark.table(name).filter("id < 20")
            return small.join(spark.table("ct_plain"), "id")._jdf.queryExecution().sparkPlan().toString()

        assert "BroadcastHashJoin" in plan("ct_known")
        assert "BroadcastHashJoin" not in plan("ct_plain")
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
        for t in ("ct_plain", "ct_known"):
            spark.sql(f"DROP TABLE {t}")
