"""Versioned tables: whole publishes, races, appends that prune by month."""

import os
import re
import subprocess
import sys
import tempfile
import textwrap
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from basketry.sources.versioned import ConcurrentWrite, VersionedTable
from basketry.streaming.incremental import merge_new, new_rows, stored_months

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def fresh(spark, name="t"):
    return VersionedTable(spark, os.path.join(tempfile.mkdtemp(prefix="versions-"), name))


def lines(spark, rows):
    return spark.createDataFrame(rows, "k int, v string, invoice_month string")


def test_versions_are_whole_and_stay_readable(spark):
    t = fresh(spark)
    assert not t.exists() and t.version() is None
    with pytest.raises(ValueError):
        t.read()
    assert t.publish(spark.range(10)).rows == 10
    assert t.publish(spark.range(10, 15), "append").rows == 15
    assert t.publish(spark.range(3)).number == 3
    assert [t.read(n).count() for n in t.versions()] == [10, 15, 3] and t.read().count() == 3
    with pytest.raises(ValueError):
        t.publish(spark.range(2).toDF("other"), "append")
    with pytest.raises(ValueError):
        t.read(9)


def test_empty_tables_keep_their_schema(spark):
    t = fresh(spark)
    t.publish(lines(spark, []), partition_by=["invoice_month"])
    assert t.read().count() == 0 and t.read().columns == ["k", "v", "invoice_month"]
    t.publish(lines(spark, [(1, None, None)]), "append")
    assert [tuple(r) for r in t.read().collect()] == [(1, None, None)]


def test_write_that_fails_midway_leaves_the_last_version(spark):
    t = fresh(spark)
    t.publish(spark.range(10))
    broken = spark.range(0, 1000, 1, 4).select(F.when(F.col("id") == 999, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="lost"):
        t.publish(broken)
    assert t.versions() == [1] and t.read().count() == 10


def test_killed_writer_leaves_the_last_version(spark):
    """The process dies after its rows are written, before the publish."""
    t = fresh(spark)
    t.publish(spark.range(10))
    code = f"""
        import os, sys
        sys.path.insert(0, {ROOT!r})
        from pyspark.sql import SparkSession
        from basketry.sources.versioned import VersionedTable
        s = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
        VersionedTable(s, {t.path!r}).publish(s.range(500), validate=lambda df: os._exit(9))
    """
    done = subprocess.run([sys.executable, "-c", textwrap.dedent(code)], capture_output=True, timeout=240)
    assert done.returncode == 9
    assert len(t.files.names(f"{t.path}/data")) == 2, "the dead writer's rows are on disk"
    assert t.versions() == [1] and t.read().count() == 10
    assert t.publish(spark.range(7)).number == 2 and t.read().count() == 7


def test_racing_appends_both_count(spark):
    t = fresh(spark)
    t.publish(spark.range(10))
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda i: t.publish(spark.range(i, i + 5), "append"), range(4)))
    assert t.versions() == [1, 2, 3, 4, 5] and t.read().count() == 30 and t.version().rows == 30


def test_publish_on_a_stale_version_is_refused(spark):
    t = fresh(spark)
    t.publish(spark.range(3))
    t.publish(spark.range(4))
    with pytest.raises(ConcurrentWrite):
        t.publish(spark.range(5), "append", on_version=1)
    assert t.read().count() == 4 and len(t.files.names(f"{t.path}/data")) == 2


def test_expire_keeps_shared_batches(spark):
    t = fresh(spark)
    t.publish(spark.range(2))
    t.publish(spark.range(3), "append")
    t.publish(spark.range(4))
    t.publish(spark.range(5), "append")
    assert len(t.expire(keep=2)) == 2 and t.versions() == [3, 4]
    assert t.read(3).count() == 4 and t.read(4).count() == 9


def test_merge_appends_each_key_once(spark):
    t = fresh(spark)
    first = [(1, "x", "2020-01"), (2, "y", "2020-02"), (2, "y", "2020-02"), (4, None, "2020-02"), (5, "n", None)]
    assert merge_new(lines(spark, first), t) == 4
    again = [(2, "y", "2020-02"), (3, "z", "2020-03"), (4, None, "2020-02"), (4, "", "2020-02"), (5, "n", None)]
    assert merge_new(lines(spark, again), t) == 2
    assert merge_new(lines(spark, again), t) == 0
    assert t.read().count() == 6


def test_merge_tells_nulls_apart_by_column(spark):
    t = fresh(spark)
    rows = [("a", None, "m"), (None, "a", "m")]
    batch = spark.createDataFrame(rows, "k string, v string, invoice_month string")
    assert merge_new(batch, t) == 2 and merge_new(batch, t) == 0


def test_merge_retries_after_a_race(spark, monkeypatch):
    t = fresh(spark)
    merge_new(lines(spark, [(1, "x", "2020-01")]), t)
    publish, raced = VersionedTable.publish, []

    def slow(self, df, *a, **b):
        if not raced:
            raced.append(1)
            publish(t, lines(spark, [(2, "y", "2020-01")]), "append")
        return publish(self, df, *a, **b)

    monkeypatch.setattr(VersionedTable, "publish", slow)
    assert merge_new(lines(spark, [(2, "y", "2020-01"), (3, "z", "2020-01")]), t) == 1
    assert sorted(r.k for r in t.read().collect()) == [1, 2, 3]


def test_merge_reads_only_the_batch_months(spark):
    t = fresh(spark)
    months = [f"2020-{m:02d}" for m in range(1, 13)]
    merge_new(lines(spark, [(k, "x", months[k % 12]) for k in range(240)]), t)
    batch = lines(spark, [(k, "x", "2020-03") for k in range(60)])
    plan = stored_months(batch, t, "invoice_month")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*invoice_month[^\]]*2020-03", plan)
    for folder, _, files in os.walk(t.path):  # no other month's file is opened
        for f in files:
            if f.endswith(".parquet") and "2020-03" not in folder:
                with open(os.path.join(folder, f), "wb") as out:
                    out.write(b"not parquet")
    assert new_rows(batch, t).count() == 60 - sum(k % 12 == 2 for k in range(60))
