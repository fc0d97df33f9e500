"""Driver contract of __spark_entry__ (no Spark needed)."""

import re

import __spark_entry__ as e


def test_every_oracle_has_a_query():
    q, s = e.queries(), e.oracle_sql()
    assert set(s) <= set(q)
    assert len(q) >= 120 and len(s) >= 100


def test_keys_follow_inventory_ids():
    for name in e.queries():
        assert re.match(r"^(a|b|c|d|e|f|g|h|j|k|l)\d+_[a-z0-9_]+$|^dq1_[a-z_]+$|^op\d+_[a-z0-9_]+$|^pipeline$", name), name


def test_oracle_sql_is_single_statement():
    for name, sql in e.oracle_sql().items():
        body = sql.strip().rstrip(";")
        assert ";" not in body, name
        assert body.upper().startswith("WITH") or body.upper().startswith("SELECT"), name
