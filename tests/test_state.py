"""Feature states: any cut of the lines into loads merges to the same features."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from basketry.operators import cohort as coh
from basketry.operators import state
from basketry.plans import queries_core as qc
from basketry.sources.versioned import VersionedTable

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def tables(spark):
    base = tempfile.mkdtemp(prefix="states-")
    return VersionedTable(spark, f"{base}/orders"), VersionedTable(spark, f"{base}/items")


@pytest.mark.parametrize("cut", ["month", "rows"])
def test_loads_merge_to_the_full_run(spark, cut):
    """By time, or at random so that invoices and months are split over loads."""
    clean, raw = qc.clean_lines(spark, SF), qc.raw(spark, SF)
    part = F.when(F.col("InvoiceDate") < "1994-06-01", 0).when(F.col("InvoiceDate") < "1996-01-15", 1).otherwise(2) if cut == "month" \
        else F.pmod(F.xxhash64(*clean.columns), F.lit(3))
    orders, items = tables(spark)
    for k in range(3):
        state.append_states(clean.filter(part == k), orders, items)
    assert orders.versions() == [1, 2, 3]
    got = state.features_from_states(orders.read(), items.read(), raw)
    assert sorted(got.collect()) == sorted(coh.feature_matrix_joined(clean, raw).collect())


def test_a_load_reads_no_stored_row(spark):
    clean = qc.clean_lines(spark, SF)
    orders, items = tables(spark)
    state.append_states(clean.filter("InvoiceDate < '1995-01-01'"), orders, items)
    before = orders.version().batches
    for t in (orders, items):  # a broken store does not stop a load
        for folder, _, files in os.walk(t.path + "/data"):
            for f in files:
                if f.endswith(".parquet"):
                    os.rename(os.path.join(folder, f), os.path.join(folder, "." + f))
    state.append_states(clean.filter("InvoiceDate >= '1995-01-01'"), orders, items)
    assert orders.version().batches[:1] == before and len(orders.version().batches) == 2


def test_months_over_several_words(spark):
    """Activity 130 months apart needs three bit sets."""
    rows = [("1", "a", "s", 1, f"{2000 + m // 12}-{m % 12 + 1:02d}-03 10:00:00", 2.0) for m in (0, 1, 61, 62, 63, 130, 130)]
    lines = spark.createDataFrame([(*r, f"i{k}") for k, r in enumerate(rows)], "CustomerID string, x string, StockCode string, Quantity int, "
                                  "InvoiceDate string, Revenue double, InvoiceNo string").withColumn(
        "InvoiceDate", F.col("InvoiceDate").cast("timestamp_ntz")).withColumn("Revenue", F.col("Revenue").cast("decimal(18,2)"))
    got = coh.line_level_features(lines).first()
    assert got.ActiveMonths == 6 and got.CohortMonth == "2000-01" and got.Frequency == 7


def test_empty_states(spark):
    clean = qc.clean_lines(spark, SF).limit(0)
    got = state.features_from_states(state.order_states(clean), state.item_states(clean), None)
    assert got.count() == 0 and got.columns == coh.FEATURE_COLUMNS
