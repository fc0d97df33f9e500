"""Cleaning operators on hand-written edge rows."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from basketry.config import ETLConfig
from basketry.operators import clean as cl
from basketry.operators import quality as q

from conftest import LINE_SCHEMA

T = dt.datetime


def lines(spark, rows):
    return spark.createDataFrame(rows, LINE_SCHEMA)


def row(inv="1", sku="A", desc="x", qty=1, ts=T(2020, 1, 1, 10), price="1.00", cust="1", country="UK"):
    return (inv, sku, desc, qty, ts, Decimal(price), cust, country)


def test_normalise_id_order_of_steps(spark):
    df = spark.createDataFrame([("12345.0",), (" 12345 ",), ("12345.0 ",), (None,), ("7.05",)], "CustomerID string")
    out = [r[0] for r in cl.normalise_id(df, "CustomerID").collect()]
    # ".0" is removed before trimming, so a padded "12345.0 " keeps it.
    assert out == ["12345", "12345", "12345.0", None, "7.05"]


def test_remove_cancellations_keeps_null_invoice(spark):
    df = spark.createDataFrame([("C1",), ("1",), (None,), ("c2",)], "InvoiceNo string")
    out = sorted((r[0] or "") for r in cl.remove_cancellations(df, "InvoiceNo", "C").collect())
    assert out == ["", "1", "c2"]


def test_keep_positive_drops_zero_negative_null(spark):
    df = lines(spark, [row(qty=0), row(qty=-1), row(price="0.00"), row(qty=2)])
    df = df.union(spark.createDataFrame([row(qty=None)], LINE_SCHEMA))
    assert cl.keep_positive(df, ["Quantity", "UnitPrice"]).count() == 1


def test_parse_dates_lenient(spark):
    df = spark.createDataFrame([("2020-01-01 10:00:00",), ("bad",), (None,)], "InvoiceDate string")
    out = cl.parse_dates(df, "InvoiceDate").collect()
    assert [r[0] for r in out] == [T(2020, 1, 1, 10)]


def test_trim_all_whitespace_kinds(spark):
    df = spark.createDataFrame([("\t a b \n",), ("  ",), (None,)], "s string")
    assert [r[0] for r in cl.trim_strings(df).collect()] == ["a b", "", None]


def test_dedup_before_trim_keeps_whitespace_variants(spark):
    df = lines(spark, [row(desc="x"), row(desc="x"), row(desc=" x")])
    out = cl.clean(df, ETLConfig(), validate=False)
    # two distinct rows survive dedup, trimming then makes them equal
    assert out.count() == 2
    assert {r.Description for r in out.collect()} == {"x"}


def test_outlier_cap_drops_rows_and_uses_both_quantiles(spark):
    rows = [row(inv=str(i), qty=i, price="1.00") for i in range(1, 101)]
    df = lines(spark, rows)
    caps = cl.quantile_caps(df, ["Quantity"], 0.99).first()
    # linear interpolation between 99 and 100
    assert caps["Quantity_cap"] == pytest.approx(99.01)
    out = cl.drop_outliers(df, ["Quantity", "UnitPrice"], 0.99)
    assert out.count() == 99
    assert out.agg(F.max("Quantity")).first()[0] == 99


def test_revenue_exact_decimal(spark):
    df = lines(spark, [row(qty=3, price="0.10")])
    r = cl.add_revenue(df, "Quantity", "UnitPrice").first()["Revenue"]
    assert r == Decimal("0.30")


def test_clean_chain_and_validation(spark):
    df = lines(
        spark,
        [
            row(inv="1", cust="12345.0"),
            row(inv="C2", cust="12345"),
            row(inv="3", cust=None),
            row(inv="4", qty=-1),
        ],
    ).withColumn("_source_sheet", F.lit("s"))
    out = cl.clean(df, ETLConfig(), validate=True)
    rows = out.collect()
    assert len(rows) == 1 and rows[0].CustomerID == "12345" and "_source_sheet" not in out.columns


def test_validate_clean_fails_on_one_violation(spark):
    df = cl.add_revenue(lines(spark, [row(), row(inv="C9")]), "Quantity", "UnitPrice")
    with pytest.raises(q.ValidationError, match="cancellations_remaining"):
        q.validate_clean(df)
    df2 = cl.add_revenue(lines(spark, [row(desc=None)]), "Quantity", "UnitPrice")
    with pytest.raises(q.ValidationError, match="null:Description"):
        q.validate_clean(df2)


def test_validate_clean_empty_raises(spark):
    df = cl.add_revenue(lines(spark, []), "Quantity", "UnitPrice")
    with pytest.raises(q.ValidationError, match="empty"):
        q.validate_clean(df)


def test_clean_idempotent_except_outliers(spark):
    rows = [row(inv=str(i), qty=(i % 7) + 1, price=f"{(i % 13) + 1}.00", cust=str(i % 5)) for i in range(200)]
    once = cl.clean(lines(spark, rows), ETLConfig(outlier_quantile=1.0), validate=False)
    twice = cl.clean(once.drop("Revenue"), ETLConfig(outlier_quantile=1.0), validate=False)
    assert sorted(once.collect()) == sorted(twice.collect())


def test_clean_audit_counts(spark):
    df = lines(spark, [row(inv="1"), row(inv="1"), row(inv="C2"), row(inv="3", cust=None), row(inv="4", qty=0)])
    audit = {r.step: (r.rows_in, r.rows_dropped, r.rows_out) for r in cl.clean_audit(df).collect()}
    assert audit["drop_null_customer"] == (5, 1, 4)
    assert audit["remove_cancellations"] == (4, 1, 3)
    assert audit["keep_positive"] == (3, 1, 2)
    assert audit["dedup_rows"] == (2, 1, 1)


def test_read_transactions_skips_failing_part(spark, tmp_path):
    from basketry.sources import io as sio

    good = tmp_path / "good"
    spark.createDataFrame([("1", "A", "x", 2, "2020-01-01 10:00:00", Decimal("1.00"), "7", "UK")],
                          sio.RAW_SCHEMA).write.option("header", "true").csv(str(good))
    df = sio.read_transactions(spark, {"Sheet1": str(good), "Broken": str(tmp_path / "missing")}, fmt="csv")
    rows = df.collect()
    assert len(rows) == 1 and rows[0]._source_sheet == "Sheet1" and rows[0].Quantity == 2
    with pytest.raises(RuntimeError):
        sio.read_transactions(spark, {"Broken": str(tmp_path / "missing")}, fmt="csv")


def test_validate_raw_missing_column(spark):
    df = spark.createDataFrame([("1",)], "InvoiceNo string")
    with pytest.raises(q.ValidationError, match="Missing required columns"):
        q.validate_raw(df)


def test_parse_dates_accepts_common_texts(spark):
    from basketry.operators import clean

    texts = ["2010-12-01 08:26:00", "12/1/2010 8:26", "01-Dec-2010 08:26", "12/1/2010 8:26:05", "12/1/2010", "31/31/2010 1:00",
             "not a date", "", None, "2010-12-01x"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "k int, d string")
    got = {r.k: str(r.d) for r in clean.parse_dates(df, "d").collect()}
    assert got == {0: "2010-12-01 08:26:00", 1: "2010-12-01 08:26:00", 2: "2010-12-01 08:26:00", 3: "2010-12-01 08:26:05",
                   4: "2010-12-01 00:00:00"}
