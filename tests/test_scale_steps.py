"""Shared steps that must not grow faster than their input."""

import os

import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


@pytest.fixture
def fresh(monkeypatch):
    from basketry.plans import queries_core as qc

    monkeypatch.setattr(qc, "_STAGED", {})
    return qc


def test_lines_are_joined_once_for_all_queries(spark, fresh, monkeypatch):
    import __spark_entry__ as e

    calls, build = [], fresh.fx.raw_order_lines
    monkeypatch.setattr(fresh.fx, "raw_order_lines", lambda *a, **k: calls.append(1) or build(*a, **k))
    for name in ("a9_publish_versions", "a4_incremental_append", "b2_format_vote", "a1_read_parts"):
        e.queries()[name](spark, SF).count()
    assert len(calls) == 1


def test_cleaned_lines_are_written_once_and_lie_by_customer(spark, fresh, monkeypatch):
    from basketry.operators import lookup as lk
    from basketry.sources import io as sio

    names, write = [], sio.materialise
    monkeypatch.setattr(sio, "materialise", lambda df, name: names.append(name) or write(df, name))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        lines = fresh.clean_lines(spark, SF).select("*", F.input_file_name().alias("file"))
        assert lines.select("file").distinct().count() > 4
        bucket, share = lk.place()
        files = lines.withColumns({"b": bucket, "s": share}).groupBy("b", "s").agg(F.count_distinct("file").alias("n"))
        assert files.agg(F.max("n")).first()[0] == 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert "cleaned_transactions" not in names


def test_dedup_by_place_removes_the_same_rows(spark):
    from basketry.operators import clean as cl

    df = spark.createDataFrame([("c1", "i1", 1), ("c1", "i1", 1), ("c1", "i1", 2), (None, None, 1), (None, None, 1), ("c2", "i1", 1)],
                               "CustomerID string, InvoiceNo string, q int")
    got = cl.dedup_rows(df, ("CustomerID", "InvoiceNo"))
    assert got.columns == df.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, cl.dedup_rows(df).collect()))


def test_each_date_text_of_a_part_is_read_once(spark):
    from basketry.operators import rejects as rj

    df = spark.createDataFrame([("a", "1/2/2011 8:00")] * 50, "_source_sheet string, InvoiceDate string")
    votes = rj.vote_formats(df)
    assert "__text" in votes._jdf.queryExecution().optimizedPlan().toString()
    assert votes.first()["texts"] == 50


def test_whole_rows_merge_without_sorting(spark):
    import tempfile

    from basketry.sources.versioned import VersionedTable
    from basketry.streaming.incremental import merge_new, new_rows

    df = spark.createDataFrame([("a", None, "2011-01"), ("a", None, "2011-01"), ("b", 1, "2011-01")], "k string, n int, invoice_month string")
    table = VersionedTable(spark, tempfile.mkdtemp(prefix="merge-"))
    plan = new_rows(df, table)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and plan.count("Exchange") == 1
    assert [merge_new(df, table), merge_new(df, table)] == [2, 0]


def test_model_rows_and_scores_are_written_once(spark, monkeypatch):
    from basketry.config import CHURN_FEATURE_COLUMNS_CONFIGURED, ChurnConfig
    from basketry.operators import churn as ch
    from basketry.plans import queries_models as qm

    monkeypatch.setattr(qm, "_FITS", {})
    fits, fit = [], ch.fit_churn
    monkeypatch.setattr(ch, "fit_churn", lambda *a: fits.append(1) or fit(*a[:3], ChurnConfig(n_estimators=3, max_depth=2)))
    splits, split = [], ch.stratified_split
    monkeypatch.setattr(ch, "stratified_split", lambda df, label, size=0.2, seed=42, **k: (
        splits.append(label) if seed == 42 else None) or split(df, label, size, seed, **k))
    for query in (qm.j6_fit_churn, qm.j13_score_churn, qm.j17_run_record, qm.j18_model_meta):
        assert query(spark, SF).count() > 0
    assert len(fits) == 1 and splits == ["churn_label"]
    tables = [qm.segment_split(spark, SF), qm.churn_test(spark, SF), *(
        qm.churn_split(spark, SF, c)[0] for c in (qm.CHURN_FEATURE_COLUMNS, CHURN_FEATURE_COLUMNS_CONFIGURED))]
    for table in tables:  # read from their files, not worked out again
        plan = table._jdf.queryExecution().optimizedPlan().toString()
        assert "Window" not in plan and "Join" not in plan and "UDF" not in plan
    assert qm.churn_test(spark, SF).count() == tables[2].filter("split = 'test'").count()
