"""Physical-plan properties the design relies on (checked with explain)."""

import contextlib
import io
import os

import pytest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_cleaning_predicates_reach_the_scan(spark):
    import __spark_entry__ as e

    from basketry.operators import clean as cl
    from basketry.plans import queries_core as qc

    rows = cl.clean_rows_before_outliers(qc.raw(spark, SF))  # the part of the chain that scans the raw lines
    p = plan(rows)
    assert p.count("Exchange (") == 1
    done = plan(e.queries()["b12_clean"](spark, SF))  # caps are known and rows staged: one narrow pass
    assert not any(f"{node} (" in done for node in ("Exchange", "Window", "Sort", "BroadcastNestedLoopJoin"))
    pushed = [line for line in p.splitlines() if "PushedFilters" in line]
    assert pushed, p
    for f in ("IsNotNull(CustomerID)", "IsNotNull(InvoiceDate)", "StringStartsWith(InvoiceNo,C)",
              "GreaterThan(Quantity,0)", "GreaterThan(UnitPrice,0.00)"):
        assert any(f in line for line in pushed), f


def test_projection_is_pruned(spark):
    import __spark_entry__ as e

    p = plan(e.queries()["c9_top_countries"](spark, SF))
    schemas = [line for line in p.splitlines() if "ReadSchema" in line]
    assert schemas and all("Description" not in s and "StockCode" not in s for s in schemas), schemas


def test_feature_matrix_uses_hash_aggregation_and_expands_no_line(spark):
    from basketry.operators import cohort as coh
    from basketry.plans import queries_core as qc

    df = coh.feature_matrix(qc.clean_lines(spark, SF), qc.raw(spark, SF))
    df.write.format("noop").mode("overwrite").save()
    executed = df._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in executed
    assert "ObjectHashAggregate" not in executed
    line_part = plan(coh.line_level_features(qc.clean_lines(spark, SF), invoices=qc.invoices(spark, SF)))
    assert "Expand (" not in line_part and line_part.count("ReadSchema") == 3  # lines, SKUs, invoices


def test_no_explicit_broadcast_of_unbounded_sides(spark):
    """The fixture joins carry no broadcast hint: Spark chooses from sizes."""
    from basketry.sources.fixtures import raw_order_lines

    logical = raw_order_lines(spark, SF)._jdf.queryExecution().logical().toString()
    assert "broadcast" not in logical.lower()
