"""A customer holding a third of all lines: results must stay exact."""

import datetime as dt
import random
from decimal import Decimal

from basketry.operators import behavioural as beh
from basketry.operators import cohort as coh

SCHEMA = (
    "InvoiceNo string, StockCode string, Quantity int, InvoiceDate timestamp_ntz, "
    "CustomerID string, Revenue decimal(18,2)"
)


def test_hot_customer_gaps_and_matrix(spark):
    rnd = random.Random(5)
    start = dt.datetime(2021, 1, 1)
    rows = []
    inv = 0
    for c in range(40):
        for _ in range(rnd.randint(1, 8)):
            inv += 1
            t = start + dt.timedelta(hours=rnd.randint(0, 24 * 200))
            for _ in range(rnd.randint(1, 3)):
                rows.append((str(inv), f"S{rnd.randint(1, 30)}", rnd.randint(1, 5), t, f"c{c}", Decimal("1.25")))
    cold = len(rows)
    # hot customer: as many lines as all others together / 2 -> one third of the table
    while len(rows) < cold * 1.5:
        inv += 1
        t = start + dt.timedelta(minutes=rnd.randint(0, 60 * 24 * 200))
        for _ in range(rnd.randint(1, 4)):
            rows.append((str(inv), f"S{rnd.randint(1, 30)}", rnd.randint(1, 5), t, "hot", Decimal("2.50")))
    df = spark.createDataFrame(rows, SCHEMA).repartition(16)

    # brute force gaps: invoice time = first line time, sorted, floor(days)
    first = {}
    for i, _, _, t, c, _ in rows:
        first[(c, i)] = min(first.get((c, i), t), t)
    per = {}
    for (c, _), t in first.items():
        per.setdefault(c, []).append(t)
    expect = {}
    for c, ts in per.items():
        ts.sort()
        gaps = [int((b - a).total_seconds() // 86400) for a, b in zip(ts, ts[1:])]
        if gaps:
            expect[c] = sorted(gaps)
    got = {}
    for r in beh.order_gaps(df).collect():
        got.setdefault(r.CustomerID, []).append(r.GapDays)
    assert {c: sorted(v) for c, v in got.items()} == expect

    raw = df.select("InvoiceNo", "CustomerID")
    assert sorted(coh.feature_matrix(df, raw).collect()) == sorted(coh.feature_matrix_joined(df, raw).collect())
