"""Feature operators on hand-written rows, fused-vs-separate plan parity,
and independence from partitioning."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from basketry.operators import behavioural as beh
from basketry.operators import cohort as coh
from basketry.operators import rfm as rf

T = dt.datetime
SCHEMA = (
    "InvoiceNo string, StockCode string, Quantity int, InvoiceDate timestamp_ntz, "
    "CustomerID string, Revenue decimal(18,2)"
)


def frame(spark, rows):
    return spark.createDataFrame(
        [(i, s, q, t, c, Decimal(r)) for i, s, q, t, c, r in rows], SCHEMA
    )


@pytest.fixture()
def small(spark):
    return frame(
        spark,
        [
            # customer a: gap 23:00 -> 01:00 two days later = 1 day
            ("1", "A", 1, T(2020, 1, 1, 23), "a", "10.00"),
            ("1", "B", 2, T(2020, 1, 1, 23), "a", "5.00"),
            ("2", "A", 1, T(2020, 1, 3, 1), "a", "20.00"),
            # customer b: two invoices at one instant, mode ties
            ("3", "A", 1, T(2020, 1, 6, 9), "b", "1.00"),   # Monday
            ("4", "B", 1, T(2020, 1, 6, 9), "b", "2.00"),
            ("5", "C", 1, T(2020, 1, 7, 10), "b", "3.00"),  # Tuesday
            ("6", "D", 1, T(2020, 1, 7, 10), "b", "0.01"),
            # customer c: one line
            ("7", "Z", 5, T(2020, 1, 4, 12), "c", "7.00"),  # Saturday
        ],
    )


def test_rfm(small):
    out = {r.CustomerID: r for r in rf.rfm(small).collect()}
    # snapshot = 2020-01-07 10:00 + 1 day
    assert out["b"].Recency == 1
    assert out["a"].Recency == 5  # 2020-01-03 01:00 -> 2020-01-08 10:00
    assert out["a"].Frequency == 2 and out["a"].Monetary == 35.0
    assert out["c"].Frequency == 1


def test_gap_is_floor_of_24h(small):
    g = {r.CustomerID: r for r in beh.purchase_gaps(small).collect()}
    assert g["a"].AvgGap == 1.0 and g["a"].StdGap is None
    # b: invoices at t, t, t+25h, t+25h -> gaps 0, 1, 0
    assert g["b"].AvgGap == pytest.approx(0.33)
    assert "c" not in g


def test_modes_tie_to_smallest(small):
    t = {r.CustomerID: r for r in beh.temporal(small).collect()}
    assert t["b"].PreferredDayOfWeek == 0  # Monday (2) vs Tuesday (2): smallest
    assert t["b"].PreferredHour == 9
    assert t["c"].PreferredDayOfWeek == 5 and t["c"].WeekendRatio == 1.0


def test_product_diversity(small):
    p = {r.CustomerID: r for r in beh.product_diversity(small).collect()}
    assert p["a"].UniqueSKUs == 2 and p["a"].TotalItems == 4
    assert p["a"].RepeatSKURatio == pytest.approx(0.3333)
    assert 0 <= p["b"].RepeatSKURatio < 1


def test_order_value_half_cent_rounds_up(spark):
    df = frame(spark, [("1", "A", 1, T(2020, 1, 1), "x", "0.01"), ("2", "A", 1, T(2020, 1, 2), "x", "0.02")])
    r = beh.order_value(df).first()
    assert r.AOV == 0.02  # 0.015 -> HALF_UP


def test_cohort(small):
    c = {r.CustomerID: r for r in coh.cohort(small).collect()}
    assert c["a"].CohortMonth == "2020-01" and c["a"].ActiveMonths == 1
    assert c["a"].DaysSinceFirstPurchase == 1


def test_return_rate_levels(spark):
    raw = spark.createDataFrame(
        [("C1", "5.0"), ("C1", "5"), ("2", "5"), ("3", None)], "InvoiceNo string, CustomerID string"
    )
    line = beh.return_rate(raw).first()
    order = beh.return_rate(raw, level="order").first()
    assert line.CustomerID == "5" and line.ReturnRate == 1.0  # 2 cancelled lines / 2 invoices
    assert order.ReturnRate == 0.5


def test_fused_matrix_equals_joined_plan(spark, small):
    raw = small.select("InvoiceNo", "CustomerID")
    fused = sorted(coh.feature_matrix(small, raw).collect())
    joined = sorted(coh.feature_matrix_joined(small, raw).collect())
    assert fused == joined


def test_independent_of_partitioning(spark, small):
    raw = small.select("InvoiceNo", "CustomerID")
    a = sorted(coh.feature_matrix(small.repartition(1), raw).collect())
    b = sorted(coh.feature_matrix(small.repartition(64), raw.repartition(7)).collect())
    assert a == b


def test_single_customer_single_line(spark):
    df = frame(spark, [("1", "A", 1, T(2020, 1, 1), "only", "3.00")])
    m = coh.feature_matrix(df, None).first()
    assert m.Recency == 1 and m.SpendStd == 0.0 and m.AvgGap == 0.0 and m.ReturnRate == 0.0


def test_empty_input(spark):
    df = frame(spark, [])
    assert coh.feature_matrix(df, None).count() == 0


def test_constant_column_scales_to_zero(spark):
    from basketry.operators import segment as sg

    df = spark.createDataFrame([("a", 5.0, 1.0), ("b", 5.0, 3.0)], "CustomerID string, k double, v double")
    z = {r.CustomerID: r for r in sg.scale_features(df, ["k", "v"]).collect()}
    assert z["a"].k_scaled == 0.0 and z["b"].k_scaled == 0.0
    assert z["a"].v_scaled == -1.0 and z["b"].v_scaled == 1.0  # population std


def test_missing_profile_all_null_column(spark):
    from basketry.operators import profile as pf

    df = spark.createDataFrame([(1, None), (2, None), (None, None)], "a int, b string")
    rows = {r.column_name: (r.missing, r.pct) for r in pf.missing_profile(df).collect()}
    assert rows == {"b": (3, 100.0), "a": (1, 33.33)}


def test_single_row_stratum_split(spark):
    from basketry.operators import churn as ch

    df = spark.createDataFrame([("1", 1), ("2", 0), ("3", 0), ("4", 0), ("5", 0)], "CustomerID string, y int")
    s = {r.CustomerID: r.split for r in ch.stratified_split(df, "y", 0.2, 42).collect()}
    assert s["1"] == "train"  # round_half_up(1 * 0.2) = 0 test rows for that class
    assert sum(1 for v in s.values() if v == "test") == 1


def test_exact_quantiles_match_percentile(spark):
    import random

    from basketry.functions.ordered import exact_quantiles

    rnd = random.Random(11)
    rows = [(i % 3, float(rnd.randint(0, 50))) for i in range(400)]
    df = spark.createDataFrame(rows, "g int, v double")
    mine = {r.g: (r.q1, r.med, r.q9) for r in exact_quantiles(df, "v", {"q1": 0.1, "med": 0.5, "q9": 0.9}, by=["g"]).collect()}
    ref = {r.g: (r.a, r.b, r.c) for r in df.groupBy("g").agg(
        F.percentile("v", 0.1).alias("a"), F.percentile("v", 0.5).alias("b"), F.percentile("v", 0.9).alias("c")).collect()}
    for g in ref:
        assert mine[g] == pytest.approx(ref[g], abs=1e-12)


def test_describe_text_top_ties_to_smallest(spark):
    from basketry.operators import profile as pf

    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",), (None,)], "s string")
    r = pf.describe_text(df, ["s"]).first()
    assert (r["count"], r["unique"], r["top"], r["freq"]) == (5, 3, "a", 2)


def test_exact_quantile_between_equal_values_is_that_value(spark):
    from basketry.functions.ordered import exact_quantiles

    df = spark.createDataFrame([(998.9,)] * 9 + [(1.0,)], "v double")
    assert exact_quantiles(df, "v", {"q": 0.87}).first()["q"] == 998.9
