"""Date formats by vote, and a reason for everything not read."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from basketry.operators import rejects as rj

SCHEMA = "_source_sheet string, InvoiceDate string, k int"


def frame(spark, parts):
    return spark.createDataFrame([(p, t, i) for p, texts in parts.items() for i, t in enumerate(texts)], SCHEMA)


def test_each_part_elects_its_format(spark):
    df = frame(spark, {
        "day first": ["3/4/2011 8:05", "25/12/2010 10:00", "1/2/2011 9:30"],
        "month first": ["3/4/2011 8:05", "12/25/2010 10:00", "1/2/2011 9:30"],
        "iso": ["2011-03-04 08:05:00", "2011-03-05"],
        "dots": ["4.3.2011 8:05"], "nothing": ["x", None], None: ["4/13/2011"]})
    votes = {r["_source_sheet"]: (r["format"], r["fits"], r["texts"]) for r in rj.vote_formats(df).collect()}
    assert votes == {"day first": ("d/M/yyyy H:mm", 3, 3), "month first": ("M/d/yyyy H:mm", 3, 3), "iso": ("iso", 2, 2),
                     "dots": ("d.M.yyyy H:mm", 1, 1), "nothing": (None, 0, 1), None: ("M/d/yyyy", 1, 1)}
    kept, rejected = rj.split_dates(df)
    dates = {(r["_source_sheet"], r["k"]): r["InvoiceDate"] for r in kept.collect()}
    assert dates["day first", 0] == dt.datetime(2011, 4, 3, 8, 5) and dates["month first", 0] == dt.datetime(2011, 3, 4, 8, 5)
    assert {(r["InvoiceDate"], r["reason"]) for r in rejected.collect()} == {("x", rj.UNREADABLE), (None, rj.MISSING)}


def test_kept_and_rejected_are_all_that_was_read(spark):
    texts = [["1/13/2011 8:00", "13/1/2011 8:00", None, "", "  1/2/2011 8:00 ", "31/31/2011 8:00"][i % 6] for i in range(600)]
    df = frame(spark, {"a": texts, "b": texts[::-1]})
    kept, rejected = rj.split_dates(df)
    assert kept.count() + rejected.count() == df.count() == 1200
    assert kept.schema["InvoiceDate"].dataType.simpleString() == "timestamp_ntz"
    assert rejected.filter("reason = 'missing date'").count() == 200
    both = kept.select("_source_sheet", "k").unionByName(rejected.select("_source_sheet", "k"))
    assert both.distinct().count() == 1200


def test_empty_input(spark):
    kept, rejected = rj.split_dates(frame(spark, {"a": ["x"]}).limit(0))
    assert kept.count() == rejected.count() == 0


def test_unreadable_parts_are_listed(spark):
    base = tempfile.mkdtemp(prefix="parts-")
    spark.createDataFrame([("1", "s", 2)], "InvoiceNo string, StockCode string, Quantity int").write.parquet(f"{base}/good")
    os.makedirs(f"{base}/broken")
    with open(f"{base}/broken/part-0.parquet", "wb") as f:
        f.write(b"no parquet at all")
    lines, bad = rj.read_parts(spark, {"g": f"{base}/good", "b": f"{base}/broken", "m": f"{base}/missing"})
    assert lines.count() == 1 and lines.first()["_source_sheet"] == "g"
    assert {r["part"]: bool(r["reason"]) for r in bad.collect()} == {"b": True, "m": True}
    assert rj.read_parts(spark, {"g": f"{base}/good"})[1].count() == 0
    with pytest.raises(RuntimeError):
        rj.read_parts(spark, {"m": f"{base}/missing"})


def test_vote_is_one_aggregate(spark):
    df = frame(spark, {"a": ["1/2/2011"]}).withColumn("extra", F.lit(1))
    plan = rj.vote_formats(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") <= 2 and "Join" not in plan and "Generate" not in plan
