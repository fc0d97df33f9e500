"""Registered queries: profiling, segmentation, churn metrics, lifetime
summary, result-table reports and request validation (inventory sections
C, H, J, K, L, DQ).  Model-dependent reports run on the deterministic
stand-ins of ``sources.standins``; fitted models are registered without SQL
(rows-only) at the end."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import CHURN_FEATURE_COLUMNS, CHURN_REQUEST_RULES, RFM_FEATURE_COLUMNS
from ..functions.numeric import rnd
from ..operators import churn as ch
from ..operators import clean as cl
from ..operators import cohort as coh
from ..operators import ltv
from ..operators import metrics as mt
from ..operators import profile as pf
from ..operators import quality as q
from ..operators import reports as rp
from ..operators import segment as sg
from ..sources import fixtures as fx
from ..sources import standins as si
from . import oracle as o
from .catalog import register
from .queries_core import clean_lines, doubles, raw

FEAT = o.FEATURE_CTE
C = o.CLEAN_CTE


def features(spark, sf):
    """The customer feature table written by the feature stage."""
    from .queries_core import staged

    from .queries_core import invoices

    return staged(
        spark, sf, "customer_features",
        lambda: coh.feature_matrix(clean_lines(spark, sf), raw(spark, sf), invoices=invoices(spark, sf)),
    )


def segments(spark, sf):
    """The segment-results table (stand-in segments), written once."""
    from .queries_core import staged

    return staged(spark, sf, "segment_results", lambda: si.standin_segments(features(spark, sf)))


def churn(spark, sf):
    """The churn-predictions table (stand-in scores), written once."""
    from .queries_core import staged

    return staged(spark, sf, "churn_predictions", lambda: si.standin_churn(features(spark, sf)))


def master(spark, sf):
    return rp.master_view(segments(spark, sf), churn(spark, sf))


# --- SQL twins of the stand-ins ------------------------------------------------
def _seg_sql() -> str:
    cols = RFM_FEATURE_COLUMNS
    sc = ", ".join(
        f"{o.rnd(f'avg(CAST({c} AS DOUBLE))', 10)} AS {c}__mean, {o.rnd(f'stddev_pop(CAST({c} AS DOUBLE))', 10)} AS {c}__std"
        for c in cols
    )
    z = ", ".join(
        f"CASE WHEN {c}__std > 0 THEN (CAST({c} AS DOUBLE) - {c}__mean) / {c}__std ELSE 0.0 END AS {c}_scaled"
        for c in cols
    )
    dists = []
    for cid, coords in si.STANDIN_CENTRES:
        terms = " + ".join(
            f"({c}_scaled - CAST({v!r} AS DOUBLE)) * ({c}_scaled - CAST({v!r} AS DOUBLE))" for c, v in zip(cols, coords)
        )
        dists.append((cid, f"({terms})"))
    dsel = ", ".join(f"{expr} AS d_{cid}" for cid, expr in dists)
    least = "least(" + ", ".join(f"d_{cid}" for cid, _ in dists) + ")"
    case = " ".join(f"WHEN d_{cid} = {least} THEN {cid}" for cid in sorted(c for c, _ in dists))
    # written out, so that the twin does not ask the code under test
    lab = "WHEN 0 THEN 'Loyal Customers' WHEN 1 THEN 'Lost / Inactive' WHEN 2 THEN 'Champions' WHEN 3 THEN 'At Risk'"
    fcols = "CustomerID, Recency, Frequency, Monetary, Log_Frequency, Log_Monetary, AOV, SpendStd, PreferredDayOfWeek, WeekendRatio, PreferredHour, UniqueSKUs, TotalItems, RepeatSKURatio, AvgGap, StdGap, ReturnRate, CohortMonth, ActiveMonths, DaysSinceFirstPurchase"
    return f""",
s_params AS (SELECT {sc} FROM features),
s_z AS (SELECT f.*, {z} FROM features f, s_params),
s_d AS (SELECT *, {dsel} FROM s_z),
s_scaled AS (SELECT CustomerID, {', '.join(f'{c}_scaled' for c in cols)} FROM s_z),
segments AS (
  SELECT {fcols}, CAST(CASE {case} END AS INTEGER) AS Segment,
         coalesce(CASE CASE {case} END {lab} END, 'Unknown') AS SegmentLabel
  FROM s_d
),
churn AS (
  SELECT CustomerID, ChurnProb, CAST(ChurnProb > 0.5 AS INTEGER) AS Churned,
         CASE WHEN ChurnProb >= 0 AND ChurnProb <= 0.3 THEN 'Low'
              WHEN ChurnProb > 0.3 AND ChurnProb <= 0.6 THEN 'Medium'
              WHEN ChurnProb > 0.6 AND ChurnProb <= 1 THEN 'High' END AS ChurnRisk,
         CASE WHEN CAST(CustomerID AS BIGINT) % 7 = 0 THEN 1 - lbl ELSE lbl END AS churn_label
  FROM (SELECT CustomerID,
               {o.rnd('1.0 / (1.0 + exp(-(CAST(Recency AS DOUBLE) - 90.0) / 60.0))', 4)} AS ChurnProb,
               CAST(Recency > 90 AS INTEGER) AS lbl
        FROM features)
),
master AS (
  SELECT s.*, c.ChurnProb, c.ChurnRisk, c.Churned FROM segments s LEFT JOIN churn c ON c.CustomerID = s.CustomerID
)"""


SEG = FEAT + _seg_sql()


def wseg(body: str) -> str:
    return o.with_ctes(SEG, body)


def wfeat(body: str) -> str:
    return o.with_ctes(FEAT, body)


VALID_CTE = C + r""",
valid AS (
  SELECT *, CAST(CAST(Quantity AS DECIMAL(18,0)) * UnitPrice AS DECIMAL(18,2)) AS Revenue
  FROM raw WHERE NOT coalesce(starts_with(InvoiceNo, 'C'), false) AND CustomerID IS NOT NULL
)"""


def wvalid(body: str) -> str:
    return o.with_ctes(VALID_CTE, body)


def valid(spark, sf):
    return pf.valid_lines(raw(spark, sf))


RAW_COLS = ["InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate", "UnitPrice", "CustomerID", "Country"]
RAW_TYPES = ["string", "string", "string", "int", "timestamp_ntz", "decimal(18,2)", "string", "string"]

# --- C: profiling --------------------------------------------------------------------
_missing_union = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS missing, count(*) AS n FROM raw" for c in RAW_COLS
)


@register(
    "c1_missing_profile",
    o.with_ctes(
        o.RAW_CTE,
        f"SELECT column_name, CAST(missing AS BIGINT) AS missing, {o.rnd('missing * 100.0 / n', 2)} AS pct "
        f"FROM ({_missing_union}) WHERE missing > 0",
    ),
)
def c1_missing_profile(spark, sf):
    return pf.missing_profile(raw(spark, sf))


@register(
    "c2_duplicate_profile",
    o.with_ctes(
        o.RAW_CTE,
        f"""SELECT CAST(r AS BIGINT) AS rows, CAST(d AS BIGINT) AS distinct_rows, CAST(r - d AS BIGINT) AS duplicates,
  {o.rnd('(r - d) * 100.0 / r', 2)} AS pct
FROM (SELECT (SELECT count(*) FROM raw) AS r, (SELECT count(*) FROM (SELECT DISTINCT * FROM raw)) AS d)""",
    ),
)
def c2_duplicate_profile(spark, sf):
    return pf.duplicate_profile(raw(spark, sf))


@register(
    "c3_cancellation_profile",
    o.with_ctes(
        o.RAW_CTE,
        f"""SELECT IsCancelled, CAST(lines AS BIGINT) AS lines, {o.rnd('lines * 100.0 / sum(lines) OVER ()', 2)} AS pct
FROM (SELECT coalesce(starts_with(InvoiceNo, 'C'), false) AS IsCancelled, count(*) AS lines FROM raw GROUP BY 1)""",
    ),
)
def c3_cancellation_profile(spark, sf):
    return pf.cancellation_profile(raw(spark, sf))


@register(
    "c4_date_span",
    o.with_ctes(
        o.RAW_CTE,
        f"SELECT min(InvoiceDate) AS earliest, max(InvoiceDate) AS latest, "
        f"CAST({o.days('min(InvoiceDate)', 'max(InvoiceDate)')} AS BIGINT) AS span_days FROM raw",
    ),
)
def c4_date_span(spark, sf):
    return pf.date_span(raw(spark, sf))


def _describe_sql(cols, table="raw"):
    parts = []
    for c in cols:
        v = f"CAST({c} AS DOUBLE)"
        stats = {
            "count": f"count({v})",
            "mean": f"avg({c})",
            "std": f"stddev_samp({v})",
            "min": f"min({v})",
            "25%": f"quantile_cont({v}, 0.25)",
            "50%": f"quantile_cont({v}, 0.5)",
            "75%": f"quantile_cont({v}, 0.75)",
            "max": f"max({v})",
        }
        for s in pf.DESCRIBE_STATS:
            parts.append(f"SELECT '{c}' AS column_name, '{s}' AS statistic, {o.rnd(stats[s], 6)} AS value FROM {table}")
    return " UNION ALL ".join(parts)


@register("c5_describe", o.with_ctes(o.RAW_CTE, _describe_sql(["Quantity", "UnitPrice"])))
def c5_describe(spark, sf):
    return pf.describe(raw(spark, sf), ["Quantity", "UnitPrice"])


@register("c5_describe_features", wfeat(_describe_sql(["Recency", "Frequency", "Monetary"], "features")))
def c5_describe_features(spark, sf):
    return pf.describe(features(spark, sf), ["Recency", "Frequency", "Monetary"])


TEXT_COLS = ["InvoiceNo", "StockCode", "Description", "CustomerID", "Country"]


def _describe_text_sql(cols):
    parts = []
    for c in cols:
        vc = f"(SELECT {c} AS v, count(*) AS n FROM raw WHERE {c} IS NOT NULL GROUP BY 1)"
        parts.append(
            f"SELECT '{c}' AS column_name, CAST(sum(n) AS BIGINT) AS count, CAST(count(*) AS BIGINT) AS \"unique\", "
            f"(SELECT min(v) FROM {vc} WHERE n = (SELECT max(n) FROM {vc})) AS top, CAST(max(n) AS BIGINT) AS freq FROM {vc}"
        )
    return " UNION ALL ".join(parts)


@register("c5_describe_text", o.with_ctes(o.RAW_CTE, _describe_text_sql(TEXT_COLS)))
def c5_describe_text(spark, sf):
    return pf.describe_text(raw(spark, sf), TEXT_COLS)


@register(
    "c6_schema_profile",
    o.with_ctes(
        o.RAW_CTE,
        " UNION ALL ".join(
            f"SELECT CAST({i} AS INTEGER) AS position, '{c}' AS column_name, '{t}' AS dtype, CAST(count({c}) AS BIGINT) AS non_null, "
            f"CAST(count(*) - count({c}) AS BIGINT) AS nulls FROM raw"
            for i, (c, t) in enumerate(zip(RAW_COLS, RAW_TYPES))
        ),
    ),
)
def c6_schema_profile(spark, sf):
    return pf.schema_profile(raw(spark, sf))


@register("c7_order_totals", wvalid(f"SELECT InvoiceNo, {o.rnd('sum(Revenue)', 2)} AS order_total FROM valid GROUP BY InvoiceNo"))
def c7_order_totals(spark, sf):
    return pf.order_totals(valid(spark, sf))


def _hist_sql(src: str, n: int, lo: float, hi: float) -> str:
    return f""", h_vals AS (SELECT least(greatest(CAST(v AS DOUBLE), CAST({lo!r} AS DOUBLE)), CAST({hi!r} AS DOUBLE)) AS v FROM ({src}) WHERE v IS NOT NULL),
h_b AS (SELECT min(v) AS lo, max(v) AS hi FROM h_vals),
h_c AS (
  SELECT CAST(CASE WHEN hi > lo THEN least(greatest(floor((v - lo) * {n} / (hi - lo)), 0), {n - 1}) ELSE 0 END AS INTEGER) AS b,
         count(*) AS cnt
  FROM h_vals, h_b WHERE v >= lo AND v <= hi GROUP BY 1
)
SELECT CAST(g.b + 1 AS INTEGER) AS bin, lo + g.b * ((hi - lo) / {n}) AS lower, lo + (g.b + 1) * ((hi - lo) / {n}) AS upper,
       CAST(coalesce(h_c.cnt, 0) AS BIGINT) AS count
FROM (SELECT CAST(range AS INTEGER) AS b FROM range({n})) g CROSS JOIN h_b LEFT JOIN h_c ON h_c.b = g.b"""


@register("c8_histogram_line_revenue", wvalid(_hist_sql("SELECT Revenue AS v FROM valid", 60, 0.0, 500.0)))
def c8_histogram_line_revenue(spark, sf):
    return pf.histogram(valid(spark, sf), "Revenue", 60, clip_lo=0.0, clip_hi=500.0)


@register(
    "c8_histogram_order_value",
    wvalid(_hist_sql("SELECT sum(Revenue) AS v FROM valid GROUP BY InvoiceNo", 60, 0.0, 2000.0)),
)
def c8_histogram_order_value(spark, sf):
    totals = valid(spark, sf).groupBy("InvoiceNo").agg(F.sum("Revenue").alias("v"))
    return pf.histogram(totals, "v", 60, clip_lo=0.0, clip_hi=2000.0)


@register(
    "c9_top_countries",
    wvalid(f"SELECT Country, {o.rnd('sum(Revenue)', 2)} AS total FROM valid GROUP BY Country ORDER BY total DESC, Country LIMIT 10"),
)
def c9_top_countries(spark, sf):
    return pf.top_n(valid(spark, sf), "Country", "Revenue", 10)


@register(
    "c10_monthly_revenue",
    wvalid(f"SELECT strftime(InvoiceDate, '%Y-%m') AS YearMonth, {o.rnd('sum(Revenue)', 2)} AS revenue FROM valid GROUP BY 1"),
)
def c10_monthly_revenue(spark, sf):
    return pf.monthly_revenue(valid(spark, sf))


@register(
    "c11_orders_by_weekday",
    wvalid(
        """SELECT d.day_no, d.DayOfWeek, c.orders FROM (VALUES (0, 'Monday'), (1, 'Tuesday'), (2, 'Wednesday'),
  (3, 'Thursday'), (4, 'Friday'), (5, 'Saturday'), (6, 'Sunday')) AS d(day_no, DayOfWeek)
LEFT JOIN (SELECT CAST(isodow(InvoiceDate) - 1 AS INTEGER) AS day_no, count(DISTINCT InvoiceNo) AS orders
           FROM valid GROUP BY 1) c ON c.day_no = d.day_no"""
    ),
)
def c11_orders_by_weekday(spark, sf):
    return pf.orders_by_weekday(valid(spark, sf))


@register(
    "c12_customer_coverage",
    wvalid(
        f"""SELECT t AS total_customers, v AS valid_customers, {o.rnd('v * 100.0 / t', 1)} AS coverage_pct FROM (
  SELECT (SELECT count(DISTINCT CustomerID) FROM raw) AS t, (SELECT count(DISTINCT CustomerID) FROM valid) AS v)"""
    ),
)
def c12_customer_coverage(spark, sf):
    r = raw(spark, sf)
    return pf.customer_coverage(r, pf.valid_lines(r))


@register(
    "c13_valid_lines",
    wvalid("SELECT InvoiceNo, StockCode, Quantity, CustomerID, CAST(Revenue AS DOUBLE) AS Revenue FROM valid"),
)
def c13_valid_lines(spark, sf):
    return doubles(valid(spark, sf).select("InvoiceNo", "StockCode", "Quantity", "CustomerID", "Revenue"))


@register(
    "c14_clean_summary",
    o.with_ctes(
        C,
        f"""SELECT min(InvoiceDate) AS first_date, max(InvoiceDate) AS last_date, count(DISTINCT CustomerID) AS customers,
  count(DISTINCT InvoiceNo) AS orders, {o.rnd('sum(Revenue)', 2)} AS revenue, count(*) AS rows FROM clean""",
    ),
)
def c14_clean_summary(spark, sf):
    return pf.clean_summary(clean_lines(spark, sf))


CORR_COLS = [
    "Recency", "Frequency", "Monetary", "Log_Frequency", "Log_Monetary", "AOV", "SpendStd", "PreferredDayOfWeek",
    "WeekendRatio", "PreferredHour", "UniqueSKUs", "TotalItems", "RepeatSKURatio", "AvgGap", "StdGap", "ReturnRate",
    "ActiveMonths", "DaysSinceFirstPurchase",
]


def _corr_sql(cols):
    pairs = [(i, j) for i in range(len(cols)) for j in range(i)]
    one = ", ".join(
        f"{o.rnd(f'corr(CAST({cols[i]} AS DOUBLE), CAST({cols[j]} AS DOUBLE))', 6)} AS r_{i}_{j}" for i, j in pairs
    )
    parts = [f"SELECT '{c}' AS feature_a, '{c}' AS feature_b, 1.0::DOUBLE AS corr" for c in cols]
    for i, j in pairs:
        for a, b in ((cols[i], cols[j]), (cols[j], cols[i])):
            parts.append(f"SELECT '{a}', '{b}', r_{i}_{j} FROM corrs")
    return f", corrs AS (SELECT {one} FROM features)\n" + " UNION ALL ".join(parts)


@register("c15_correlation_matrix", wfeat(_corr_sql(CORR_COLS)))
def c15_correlation_matrix(spark, sf):
    """Every numeric column of the feature table."""
    return pf.correlation_matrix(features(spark, sf), CORR_COLS)


# --- G3 feature audit ------------------------------------------------------------------
@register(
    "g3_feature_audit",
    wfeat(
        """SELECT * FROM (VALUES
  ('load', 'rows', (SELECT CAST(count(*) AS DOUBLE) FROM clean)),
  ('load', 'customers', (SELECT CAST(count(DISTINCT CustomerID) AS DOUBLE) FROM clean)),
  ('load', 'invoices', (SELECT CAST(count(DISTINCT InvoiceNo) AS DOUBLE) FROM clean)),
  ('load', 'first_day', (SELECT CAST(date_diff('day', DATE '1970-01-01', CAST(min(InvoiceDate) AS DATE)) AS DOUBLE) FROM clean)),
  ('load', 'last_day', (SELECT CAST(date_diff('day', DATE '1970-01-01', CAST(max(InvoiceDate) AS DATE)) AS DOUBLE) FROM clean)),
  ('rfm', 'rows', (SELECT CAST(count(*) AS DOUBLE) FROM f_rfm)),
  ('rfm', 'recency_min', (SELECT CAST(min(Recency) AS DOUBLE) FROM f_rfm)),
  ('rfm', 'recency_max', (SELECT CAST(max(Recency) AS DOUBLE) FROM f_rfm)),
  ('rfm', 'monetary_min', (SELECT min(Monetary) FROM f_rfm)),
  ('rfm', 'monetary_max', (SELECT max(Monetary) FROM f_rfm)),
  ('behavioural', 'rows', (SELECT CAST(count(*) AS DOUBLE) FROM f_behavioural)),
  ('cohort', 'rows', (SELECT CAST(count(*) AS DOUBLE) FROM f_cohort)),
  ('cohort', 'cohorts', (SELECT CAST(count(DISTINCT CohortMonth) AS DOUBLE) FROM f_cohort)),
  ('matrix', 'rows', (SELECT CAST(count(*) AS DOUBLE) FROM features))
) AS t(stage, metric, value)"""
    ),
)
def g3_feature_audit(spark, sf):
    from ..operators import behavioural as beh
    from ..operators import rfm as rf

    c = clean_lines(spark, sf)
    r = raw(spark, sf)
    return coh.feature_audit(c, rf.rfm(c), beh.behavioural(c, r), coh.cohort(c), coh.feature_matrix(c, r))


@register(
    "g2_validate_features",
    wfeat(
        "SELECT -1 AS check_no, 'duplicate:CustomerID' AS \"check\", count(*) - count(DISTINCT CustomerID) AS violations FROM features"
        + "".join(
            f" UNION ALL SELECT {i}, 'null:{c}', count(*) FILTER (WHERE {c} IS NULL) FROM features"
            for i, c in enumerate(
                ["CustomerID", "Recency", "Frequency", "Monetary", "Log_Frequency", "Log_Monetary", "AOV", "SpendStd",
                 "PreferredDayOfWeek", "WeekendRatio", "PreferredHour", "UniqueSKUs", "TotalItems", "RepeatSKURatio",
                 "AvgGap", "StdGap", "ReturnRate", "CohortMonth", "ActiveMonths", "DaysSinceFirstPurchase"]
            )
        )
    ),
)
def g2_validate_features(spark, sf):
    return q.feature_checks(features(spark, sf))


# --- H: segmentation (exact parts) ------------------------------------------------------
@register(
    "h1_scale_features",
    wseg("SELECT CustomerID, " + ", ".join(f"{o.rnd(f'{c}_scaled', 6)} AS {c}_scaled" for c in RFM_FEATURE_COLUMNS) + " FROM s_scaled"),
)
def h1_scale_features(spark, sf):
    f = features(spark, sf)
    z = sg.scale_features(f, RFM_FEATURE_COLUMNS, sg.scaler_params(f))
    return z.select("CustomerID", *[rnd(f"{c}_scaled", 6).alias(f"{c}_scaled") for c in RFM_FEATURE_COLUMNS])


@register("h3_assign_segments", wseg("SELECT CustomerID, Segment FROM segments"))
def h3_assign_segments(spark, sf):
    return segments(spark, sf).select("CustomerID", "Segment")


@register(
    "h5_segment_distribution",
    wseg(f"SELECT Segment, CAST(count(*) AS BIGINT) AS customers, {o.rnd('count(*) * 100.0 / sum(count(*)) OVER ()', 1)} AS pct FROM segments GROUP BY Segment"),
)
def h5_segment_distribution(spark, sf):
    return sg.segment_distribution(segments(spark, sf), "Segment")


@register("h6_label_segments", wseg("SELECT CustomerID, Segment, SegmentLabel FROM segments"))
def h6_label_segments(spark, sf):
    return segments(spark, sf).select("CustomerID", "Segment", "SegmentLabel")


@register(
    "h7_segment_profile",
    wseg(
        f"""SELECT SegmentLabel, {o.rnd('avg(Recency)', 2)} AS Recency, {o.rnd('avg(Frequency)', 2)} AS Frequency,
  {o.rnd('avg(Monetary)', 2)} AS Monetary, {o.rnd('avg(AOV)', 2)} AS AOV, CAST(count(*) AS BIGINT) AS Count,
  {o.rnd('sum(Monetary) / (SELECT sum(Monetary) FROM segments) * 100.0', 1)} AS RevenueShare
FROM segments GROUP BY SegmentLabel"""
    ),
)
def h7_segment_profile(spark, sf):
    return sg.segment_profile(segments(spark, sf))


@register(
    "h8_revenue_concentration",
    wseg(
        f"""SELECT SegmentLabel, {o.rnd('sum(Monetary)', 2)} AS revenue,
  {o.rnd('sum(Monetary) / (SELECT sum(Monetary) FROM segments) * 100.0', 1)} AS revenue_pct,
  CAST(count(*) AS BIGINT) AS customers FROM segments GROUP BY SegmentLabel ORDER BY revenue DESC, SegmentLabel"""
    ),
)
def h8_revenue_concentration(spark, sf):
    return sg.revenue_concentration(segments(spark, sf))


_ARI_SQL = """, ari_in AS (SELECT Segment AS a,
  CASE WHEN CAST(CustomerID AS BIGINT) % 10 = 0 THEN (Segment + 1) % 4 ELSE Segment END AS b FROM segments),
cont AS (SELECT a, b, count(*) AS n FROM ari_in GROUP BY a, b),
sums AS (SELECT
  (SELECT sum(n * (n - 1) / 2) FROM cont) AS idx,
  (SELECT sum(n) FROM cont) AS n,
  (SELECT sum(m * (m - 1) / 2) FROM (SELECT sum(n) AS m FROM cont GROUP BY a)) AS sa,
  (SELECT sum(m * (m - 1) / 2) FROM (SELECT sum(n) AS m FROM cont GROUP BY b)) AS sb)
SELECT CASE WHEN (sa + sb) / 2 = sa * sb / (n * (n - 1) / 2) THEN 1.0
  ELSE (idx - sa * sb / (n * (n - 1) / 2)) / ((sa + sb) / 2 - sa * sb / (n * (n - 1) / 2)) END AS ari FROM sums"""


@register("h11_adjusted_rand", o.with_ctes(SEG, _ARI_SQL))
def h11_adjusted_rand(spark, sf):
    s = segments(spark, sf)
    b = F.when(F.col("CustomerID").cast("bigint") % 10 == 0, (F.col("Segment") + 1) % 4).otherwise(F.col("Segment"))
    return mt.adjusted_rand(s.withColumn("Segment2", b), "Segment", "Segment2")


BOX_MEASURES = ["Recency", "Frequency", "Monetary"]


def _box_sql() -> str:
    long = " UNION ALL ".join(f"SELECT SegmentLabel, '{m}' AS measure, CAST({m} AS DOUBLE) AS v FROM segments" for m in BOX_MEASURES)
    return f""", long AS ({long}),
q AS (SELECT SegmentLabel, measure, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median,
  quantile_cont(v, 0.75) AS q3, count(v) AS n FROM long GROUP BY SegmentLabel, measure),
qq AS (SELECT *, q3 - q1 AS iqr FROM q)
SELECT qq.measure, qq.SegmentLabel, qq.n, {o.rnd("q1", 6)} AS q1, {o.rnd("median", 6)} AS median,
  {o.rnd("q3", 6)} AS q3, {o.rnd("iqr", 6)} AS iqr,
  min(CASE WHEN v >= q1 - 1.5 * iqr THEN v END) AS whisker_low,
  max(CASE WHEN v <= q3 + 1.5 * iqr THEN v END) AS whisker_high,
  CAST(count(*) FILTER (WHERE v < q1 - 1.5 * iqr OR v > q3 + 1.5 * iqr) AS BIGINT) AS outliers
FROM long s JOIN qq ON qq.SegmentLabel = s.SegmentLabel AND qq.measure = s.measure
GROUP BY qq.measure, qq.SegmentLabel, qq.n, q1, median, q3, iqr"""


@register("h14_box_stats", wseg(_box_sql()))
def h14_box_stats(spark, sf):
    return sg.box_stats_all(segments(spark, sf), "SegmentLabel", list(BOX_MEASURES))


_SEGZ = "(SELECT Segment, s_scaled.* FROM segments JOIN s_scaled USING (CustomerID))"
_APART = " + ".join(f"(a.{c}_scaled - b.{c}_scaled) ** 2" for c in RFM_FEATURE_COLUMNS)


@register(
    "h4_silhouette_euclidean",
    wseg(
        f"""SELECT {o.rnd("avg(s)", 6)} AS silhouette, 0.0 AS standard_error, count(*) AS rows, true AS exact FROM (
  SELECT p.CustomerID, CASE WHEN any_value(own) IS NULL THEN 0 ELSE
    (min(far) - any_value(own)) / greatest(min(far), any_value(own)) END AS s FROM (
    SELECT a.CustomerID, b.Segment, a.Segment AS mine, avg(sqrt({_APART})) AS far
    FROM {_SEGZ} a JOIN {_SEGZ} b ON a.Segment <> b.Segment GROUP BY 1, 2, 3) p
  LEFT JOIN (SELECT a.CustomerID, avg(sqrt({_APART})) AS own FROM {_SEGZ} a JOIN {_SEGZ} b
    ON a.Segment = b.Segment AND a.CustomerID <> b.CustomerID GROUP BY 1) q ON q.CustomerID = p.CustomerID GROUP BY 1)"""
    ),
)
def h4_silhouette_euclidean(spark, sf):
    """Mean Euclidean silhouette over all pairs of customers."""
    from ..operators.silhouette import euclidean_silhouette

    f = features(spark, sf)
    scaled = sg.scale_features(segments(spark, sf), RFM_FEATURE_COLUMNS, sg.scaler_params(f))
    got = euclidean_silhouette(scaled, si.SCALED, "Segment")
    return got.withColumn("silhouette", rnd("silhouette", 6))


# --- J: churn (exact parts) -------------------------------------------------------------
@register("j1_churn_label", wfeat("SELECT CustomerID, Recency, CAST(Recency > 90 AS INTEGER) AS churn_label FROM features"))
def j1_churn_label(spark, sf):
    return ch.churn_label(features(spark, sf)).select("CustomerID", "Recency", "churn_label")


@register(
    "j2_churn_threshold",
    wfeat("SELECT CAST(floor(quantile_cont(CAST(AvgGap AS DOUBLE), 0.9)) AS INTEGER) AS threshold_days, 'AvgGap' AS source_column FROM features"),
)
def j2_churn_threshold(spark, sf):
    return ch.churn_threshold(features(spark, sf))


@register(
    "j3_select_features",
    wfeat("SELECT CustomerID, " + ", ".join(f"coalesce(CAST({c} AS DOUBLE), 0.0) AS {c}" for c in CHURN_FEATURE_COLUMNS) + " FROM features"),
)
def j3_select_features(spark, sf):
    return ch.select_features(features(spark, sf))[0]


_SPLIT_SQL = """, ranked AS (
  SELECT CustomerID, churn_label,
         row_number() OVER (PARTITION BY churn_label ORDER BY md5(CustomerID || '|' || '42')) AS rk,
         count(*) OVER (PARTITION BY churn_label) AS n
  FROM churn)"""


@register(
    "j4_stratified_split",
    wseg(_SPLIT_SQL + "\nSELECT CustomerID, churn_label, CASE WHEN rk <= floor(n * 0.2 + 0.5) THEN 'test' ELSE 'train' END AS split FROM ranked"),
)
def j4_stratified_split(spark, sf):
    return ch.stratified_split(churn(spark, sf).select("CustomerID", "churn_label"), "churn_label", 0.2, 42)


@register(
    "j5_class_weight",
    wseg(
        _SPLIT_SQL
        + """, tr AS (SELECT * FROM ranked WHERE NOT rk <= floor(n * 0.2 + 0.5))
SELECT count(*) FILTER (WHERE churn_label = 0) AS negatives, count(*) FILTER (WHERE churn_label = 1) AS positives,
  CAST(count(*) FILTER (WHERE churn_label = 0) AS DOUBLE) / count(*) FILTER (WHERE churn_label = 1) AS pos_weight FROM tr"""
    ),
)
def j5_class_weight(spark, sf):
    s = ch.stratified_split(churn(spark, sf).select("CustomerID", "churn_label"), "churn_label", 0.2, 42)
    return ch.class_weight(s.filter(F.col("split") == "train"), "churn_label")


@register(
    "j7_stratified_folds",
    wseg(_SPLIT_SQL + "\nSELECT CustomerID, churn_label, CAST((rk - 1) % 5 AS INTEGER) AS fold FROM ranked"),
)
def j7_stratified_folds(spark, sf):
    return ch.stratified_folds(churn(spark, sf).select("CustomerID", "churn_label"), "churn_label", 5, 42)


_CURVE_SQL = """, sc AS (SELECT CAST(ChurnProb AS DOUBLE) AS score, count(*) FILTER (WHERE churn_label = 1) AS pos,
  count(*) FILTER (WHERE churn_label <> 1) AS neg FROM churn GROUP BY 1),
cur AS (SELECT score, pos, neg,
  sum(pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
  sum(neg) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp,
  sum(pos) OVER () AS P, sum(neg) OVER () AS N FROM sc)"""


def wcurve(body: str) -> str:
    return wseg(_CURVE_SQL + "\n" + body)


@register(
    "j8_roc_auc",
    wcurve("SELECT CAST(sum(CAST(pos AS HUGEINT) * (2 * (N - fp) + neg)) AS DOUBLE) / (2.0 * CAST(max(P) AS DOUBLE) * CAST(max(N) AS DOUBLE)) AS roc_auc FROM cur"),
)
def j8_roc_auc(spark, sf):
    return mt.roc_auc(churn(spark, sf), "churn_label", "ChurnProb")


@register(
    "j9_average_precision",
    wcurve(f"SELECT {o.rnd('sum(pos * (CAST(tp AS DOUBLE) / (tp + fp))) / max(P)', 10)} AS average_precision FROM cur"),
)
def j9_average_precision(spark, sf):
    return mt.average_precision(churn(spark, sf), "churn_label", "ChurnProb")


@register(
    "j10_classification_report",
    wseg(
        """, cm AS (SELECT
  count(*) FILTER (WHERE churn_label = 0 AND Churned = 0) AS c00, count(*) FILTER (WHERE churn_label = 0 AND Churned = 1) AS c01,
  count(*) FILTER (WHERE churn_label = 1 AND Churned = 0) AS c10, count(*) FILTER (WHERE churn_label = 1 AND Churned = 1) AS c11
  FROM churn),
st AS (SELECT *,
  coalesce(CAST(c00 AS DOUBLE) / nullif(c00 + c10, 0), 0.0) AS p0, coalesce(CAST(c00 AS DOUBLE) / nullif(c00 + c01, 0), 0.0) AS r0,
  coalesce(CAST(c11 AS DOUBLE) / nullif(c01 + c11, 0), 0.0) AS p1, coalesce(CAST(c11 AS DOUBLE) / nullif(c10 + c11, 0), 0.0) AS r1,
  c00 + c01 AS s0, c10 + c11 AS s1, c00 + c01 + c10 + c11 AS n FROM cm),
st2 AS (SELECT *, CASE WHEN p0 + r0 > 0 THEN 2 * p0 * r0 / (p0 + r0) ELSE 0.0 END AS f0,
  CASE WHEN p1 + r1 > 0 THEN 2 * p1 * r1 / (p1 + r1) ELSE 0.0 END AS f1,
  coalesce(CAST(c00 + c11 AS DOUBLE) / nullif(n, 0), 0.0) AS acc FROM st),
rep AS (
  SELECT '0' AS label, p0 AS precision, r0 AS recall, f0 AS f1, s0 AS support FROM st2
  UNION ALL SELECT '1', p1, r1, f1, s1 FROM st2
  UNION ALL SELECT 'accuracy', NULL, NULL, acc, n FROM st2
  UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n FROM st2
  UNION ALL SELECT 'weighted avg', (p0 * s0 + p1 * s1) / n, (r0 * s0 + r1 * s1) / n, (f0 * s0 + f1 * s1) / n, n FROM st2)
"""
        
        + f"SELECT label, {o.rnd('precision', 6)} AS precision, {o.rnd('recall', 6)} AS recall, {o.rnd('f1', 6)} AS f1, CAST(support AS BIGINT) AS support FROM rep"
    ),
)
def j10_classification_report(spark, sf):
    return mt.classification_report(churn(spark, sf), "churn_label", "Churned")


@register(
    "j10_confusion_matrix",
    wseg(
        """SELECT g.actual, g.predicted, CAST(coalesce(c.cnt, 0) AS BIGINT) AS count
FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) AS g(actual, predicted)
LEFT JOIN (SELECT churn_label AS actual, Churned AS predicted, count(*) AS cnt FROM churn GROUP BY 1, 2) c
  ON c.actual = g.actual AND c.predicted = g.predicted"""
    ),
)
def j10_confusion_matrix(spark, sf):
    return mt.confusion_matrix(churn(spark, sf), "churn_label", "Churned")


_PR = """, pr AS (SELECT score AS threshold, tp, fp, CAST(tp AS DOUBLE) / (tp + fp) AS precision,
  CAST(tp AS DOUBLE) / CAST(P AS DOUBLE) AS recall FROM cur)"""


@register(
    "j11_best_f1_threshold",
    wcurve(
        _PR
        + """, f AS (SELECT *, 2.0 * precision * recall / (precision + recall + 1e-9) AS f1 FROM pr)
SELECT threshold, precision, recall, f1 FROM f
WHERE f1 = (SELECT max(f1) FROM f) AND threshold = (SELECT min(threshold) FROM f WHERE f1 = (SELECT max(f1) FROM f))"""
    ),
)
def j11_best_f1_threshold(spark, sf):
    return mt.best_f1_threshold(churn(spark, sf), "churn_label", "ChurnProb")


@register(
    "j12_pr_curve",
    wcurve(_PR + "\nSELECT threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, precision, recall FROM pr"),
)
def j12_pr_curve(spark, sf):
    return mt.pr_curve(churn(spark, sf), "churn_label", "ChurnProb")


@register(
    "j12_roc_curve",
    wcurve("SELECT score AS threshold, CAST(fp AS DOUBLE) / CAST(N AS DOUBLE) AS fpr, CAST(tp AS DOUBLE) / CAST(P AS DOUBLE) AS tpr FROM cur"),
)
def j12_roc_curve(spark, sf):
    return mt.roc_curve(churn(spark, sf), "churn_label", "ChurnProb")


@register("j14_risk_tier", wseg("SELECT CustomerID, ChurnProb, Churned, ChurnRisk FROM churn"))
def j14_risk_tier(spark, sf):
    return churn(spark, sf).select("CustomerID", "ChurnProb", "Churned", "ChurnRisk")


@register(
    "j15_risk_distribution",
    wseg(f"SELECT ChurnRisk, CAST(count(*) AS BIGINT) AS customers, {o.rnd('count(*) * 100.0 / sum(count(*)) OVER ()', 1)} AS pct FROM churn GROUP BY ChurnRisk"),
)
def j15_risk_distribution(spark, sf):
    return ch.risk_distribution(churn(spark, sf))


# --- K: lifetime summary --------------------------------------------------------------------
@register(
    "k1_positive_revenue",
    o.with_ctes(
        C,
        f"""SELECT count(*) AS rows_before, count(*) FILTER (WHERE Revenue > 0) AS rows_after,
  count(*) - count(*) FILTER (WHERE Revenue > 0) AS removed,
  {o.rnd('(count(*) - count(*) FILTER (WHERE Revenue > 0)) * 100.0 / count(*)', 1)} AS removed_pct FROM clean""",
    ),
)
def k1_positive_revenue(spark, sf):
    return ltv.positive_revenue_report(clean_lines(spark, sf))


@register("k2_observation_end", o.with_ctes(C, "SELECT max(InvoiceDate) AS observation_end FROM clean"))
def k2_observation_end(spark, sf):
    return ltv.observation_end(clean_lines(spark, sf))


def _k3_sql(src: str) -> str:
    return f""", k_daily AS (SELECT CustomerID, CAST(InvoiceDate AS DATE) AS day, sum(Revenue) AS total FROM {src} WHERE Revenue > 0 GROUP BY 1, 2),
k_end AS (SELECT CAST(max(InvoiceDate) AS DATE) AS end_day FROM {src} WHERE Revenue > 0),
k_per AS (SELECT CustomerID, min(day) AS first_day, max(day) AS last_day, count(*) AS days, sum(total) AS sum_total,
  arg_min(total, day) AS first_total FROM k_daily GROUP BY CustomerID),
summary AS (
  SELECT CustomerID, CAST(days - 1 AS DOUBLE) AS frequency, CAST(date_diff('day', first_day, last_day) AS DOUBLE) AS recency,
    CAST(date_diff('day', first_day, end_day) AS DOUBLE) AS T,
    CASE WHEN days > 1 THEN {o.rnd('CAST(sum_total - first_total AS DOUBLE) / CAST(days - 1 AS DOUBLE)', 6)} ELSE 0.0 END AS monetary_value
  FROM k_per, k_end)"""


def k3_summary(lines):
    pos = ltv.positive_revenue(lines)
    return ltv.rfm_t_summary(pos, ltv.observation_end(pos))


@register("k3_rfm_t_summary", o.with_ctes(C + _k3_sql("clean"), "SELECT * FROM summary"))
def k3_rfm_t_summary(spark, sf):
    return k3_summary(clean_lines(spark, sf))


@register(
    "k4_repeat_customers",
    o.with_ctes(
        C + _k3_sql("clean"),
        f"SELECT count(*) FILTER (WHERE frequency > 0) AS repeat_customers, count(*) AS customers, "
        f"{o.rnd('count(*) FILTER (WHERE frequency > 0) * 100.0 / count(*)', 1)} AS repeat_pct FROM summary",
    ),
)
def k4_repeat_customers(spark, sf):
    return ltv.repeat_share(k3_summary(clean_lines(spark, sf)))


@register(
    "k5_frequency_monetary_corr",
    o.with_ctes(C + _k3_sql("clean"), f"SELECT {o.rnd('corr(frequency, monetary_value)', 6)} AS corr_frequency_monetary FROM summary WHERE frequency > 0"),
)
def k5_frequency_monetary_corr(spark, sf):
    return ltv.frequency_monetary_corr(k3_summary(clean_lines(spark, sf)))


# Second schema (events): purchases as single-line invoices.
EVENTS_CTE = """ev_lines AS (
  SELECT CAST(event_id AS VARCHAR) AS InvoiceNo, CAST(user_id AS VARCHAR) AS CustomerID, ts AS InvoiceDate,
         CAST(CAST(value AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS Revenue
  FROM events WHERE event_type = 'purchase')"""


def event_lines(spark, sf):
    ev = fx.event_order_lines(spark, sf)
    return cl.add_revenue(ev, "Quantity", "UnitPrice")


@register("k3_rfm_t_summary_events", o.with_ctes(EVENTS_CTE + _k3_sql("ev_lines"), "SELECT * FROM summary"))
def k3_rfm_t_summary_events(spark, sf):
    return k3_summary(event_lines(spark, sf))


@register(
    "d2_rfm_events",
    o.with_ctes(
        EVENTS_CTE,
        f""", ev_snap AS (SELECT max(InvoiceDate) + INTERVAL 1 DAY AS snapshot FROM ev_lines)
SELECT CustomerID, CAST({o.days('max(InvoiceDate)', '(SELECT snapshot FROM ev_snap)')} AS BIGINT) AS Recency,
  CAST(count(DISTINCT InvoiceNo) AS BIGINT) AS Frequency, {o.rnd('sum(Revenue)', 2)} AS Monetary,
  {o.rnd('ln(1 + CAST(count(DISTINCT InvoiceNo) AS DOUBLE))', 10)} AS Log_Frequency,
  {o.rnd('ln(1 + CAST(sum(Revenue) AS DOUBLE))', 4)} AS Log_Monetary
FROM ev_lines GROUP BY CustomerID""",
    ),
)
def d2_rfm_events(spark, sf):
    from ..operators import rfm as rf

    return rf.rfm(event_lines(spark, sf))


@register(
    "e8_purchase_gaps_events",
    o.with_ctes(
        EVENTS_CTE,
        f""", ev_inv AS (SELECT CustomerID, InvoiceNo, min(InvoiceDate) AS inv_ts FROM ev_lines GROUP BY 1, 2),
ev_gaps AS (SELECT CustomerID, {o.days('lag(inv_ts) OVER (PARTITION BY CustomerID ORDER BY inv_ts, InvoiceNo)', 'inv_ts')} AS GapDays FROM ev_inv)
SELECT CustomerID, {o.rnd('avg(GapDays)', 2)} AS AvgGap, {o.rnd('stddev_samp(CAST(GapDays AS DOUBLE))', 2)} AS StdGap
FROM ev_gaps WHERE GapDays IS NOT NULL GROUP BY CustomerID""",
    ),
)
def e8_purchase_gaps_events(spark, sf):
    from ..operators import behavioural as beh

    return beh.purchase_gaps(event_lines(spark, sf))


# --- L: reports on the result tables --------------------------------------------------------
MASTER_COLS = ["CustomerID", "Recency", "Frequency", "Monetary", "Segment", "SegmentLabel", "ChurnProb", "ChurnRisk", "Churned"]


@register("l1_master_view", wseg("SELECT " + ", ".join(MASTER_COLS) + " FROM master"))
def l1_master_view(spark, sf):
    return master(spark, sf).select(*MASTER_COLS)


@register(
    "l2_kpis",
    wseg(f"SELECT count(*) AS customers, {o.rnd('sum(Monetary)', 2)} AS revenue, {o.rnd('avg(Churned) * 100.0', 1)} AS churn_rate_pct FROM master"),
)
def l2_kpis(spark, sf):
    return rp.kpis(master(spark, sf))


@register("l3_customers_by_segment", wseg("SELECT SegmentLabel, count(*) AS customers FROM master GROUP BY 1"))
def l3_customers_by_segment(spark, sf):
    return rp.value_counts(master(spark, sf), "SegmentLabel")


@register("l4_revenue_by_segment", wseg(f"SELECT SegmentLabel, {o.rnd('sum(Monetary)', 2)} AS Revenue FROM master GROUP BY 1"))
def l4_revenue_by_segment(spark, sf):
    return rp.revenue_by(master(spark, sf))


@register(
    "l5_risk_counts",
    wseg(
        """SELECT d.position, d.ChurnRisk, c.Count FROM (VALUES (0, 'Low'), (1, 'Medium'), (2, 'High')) AS d(position, ChurnRisk)
LEFT JOIN (SELECT ChurnRisk, count(*) AS Count FROM master GROUP BY 1) c ON c.ChurnRisk = d.ChurnRisk"""
    ),
)
def l5_risk_counts(spark, sf):
    return rp.ordered_counts(master(spark, sf))


@register("l6_segment_options", wseg("SELECT DISTINCT SegmentLabel FROM master WHERE SegmentLabel IS NOT NULL"))
def l6_segment_options(spark, sf):
    return rp.segment_options(master(spark, sf))


SELECTION = ["Champions", "At Risk"]


@register(
    "l7_selection_kpis",
    wseg(
        f"SELECT count(*) AS customers, {o.rnd('avg(Recency)', 2)} AS avg_recency, {o.rnd('avg(Frequency)', 2)} AS avg_frequency, "
        f"{o.rnd('avg(Monetary)', 2)} AS avg_monetary FROM master WHERE SegmentLabel IN ('Champions', 'At Risk')"
    ),
)
def l7_selection_kpis(spark, sf):
    m = master(spark, sf)
    return rp.selection_kpis(rp.select_segments(m, SELECTION))


@register(
    "l8_selection_profile",
    wseg(
        f"""SELECT SegmentLabel, CAST(count(CustomerID) AS BIGINT) AS Customers, {o.rnd('avg(Recency)', 1)} AS Avg_Recency,
  {o.rnd('avg(Frequency)', 1)} AS Avg_Frequency, {o.rnd('avg(Monetary)', 1)} AS Avg_Monetary, {o.rnd('avg(AOV)', 1)} AS Avg_AOV,
  {o.rnd('sum(Monetary) / sum(sum(Monetary)) OVER () * 100.0', 1)} AS Revenue_Share
FROM master WHERE SegmentLabel IN ('Champions', 'At Risk') GROUP BY SegmentLabel"""
    ),
)
def l8_selection_profile(spark, sf):
    m = master(spark, sf)
    return rp.selection_profile(rp.select_segments(m, SELECTION))


@register(
    "l9_churn_kpis",
    wseg(
        f"""SELECT total, churned, {o.rnd('churned * 100.0 / total', 1)} AS churned_pct, high_risk,
  {o.rnd('high_risk * 100.0 / total', 1)} AS high_risk_pct, avg_prob_pct FROM (
  SELECT count(*) AS total, CAST(sum(Churned) AS BIGINT) AS churned, count(*) FILTER (WHERE ChurnRisk = 'High') AS high_risk,
         {o.rnd('avg(ChurnProb) * 100.0', 1)} AS avg_prob_pct FROM master)"""
    ),
)
def l9_churn_kpis(spark, sf):
    return rp.churn_kpis(master(spark, sf))


@register(
    "l10_churn_by_segment",
    wseg(
        f"""SELECT SegmentLabel, CAST(count(CustomerID) AS BIGINT) AS Customers, CAST(sum(Churned) AS BIGINT) AS Churned,
  {o.rnd('sum(Churned) / count(CustomerID) * 100.0', 1)} AS Churn_Rate, {o.rnd('avg(ChurnProb) * 100.0', 1)} AS Avg_Prob
FROM master GROUP BY SegmentLabel"""
    ),
)
def l10_churn_by_segment(spark, sf):
    return rp.churn_by_segment(master(spark, sf))


@register(
    "l11_top_risk",
    wseg(
        f"""SELECT CustomerID, SegmentLabel AS Segment, Recency, Frequency, {o.rnd('Monetary', 2)} AS Historic_Revenue,
  {o.rnd('ChurnProb * 100.0', 1)} AS Churn_Prob_Pct FROM master ORDER BY ChurnProb DESC NULLS LAST, CustomerID LIMIT 100"""
    ),
)
def l11_top_risk(spark, sf):
    return rp.top_risk(master(spark, sf), 100)


@register(
    "l12_sample_customers",
    wseg("SELECT " + ", ".join(MASTER_COLS) + " FROM master ORDER BY md5(CustomerID || '|' || '42') LIMIT 2000"),
)
def l12_sample_customers(spark, sf):
    return rp.sample_n(master(spark, sf).select(*MASTER_COLS), 2000, 42)


@register(
    "l12_sample_500",
    wseg("SELECT " + ", ".join(MASTER_COLS) + " FROM master ORDER BY md5(CustomerID || '|' || '42') LIMIT 500"),
)
def l12_sample_500(spark, sf):
    """The same report at a size below the number of customers."""
    return rp.sample_n(master(spark, sf).select(*MASTER_COLS), 500, 42)


@register("l13_median_revenue", wseg("SELECT median(CAST(Monetary AS DOUBLE)) AS median_Monetary FROM master"))
def l13_median_revenue(spark, sf):
    return rp.median_of(master(spark, sf), "Monetary")


# Requests: the customers seen in the events, and ids that no customer has.
_IDS_SQL = """, ids AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS CustomerID FROM events WHERE user_id IS NOT NULL
  UNION ALL SELECT DISTINCT 'absent-' || CAST(user_id AS VARCHAR) FROM events WHERE user_id IS NOT NULL)"""


def request_ids(spark, sf):
    ids = fx.table(spark, sf, "events").select(F.col("user_id").cast("string").alias("CustomerID")).na.drop().distinct()
    return ids.unionByName(ids.select(F.concat(F.lit("absent-"), "CustomerID").alias("CustomerID")))


@register(
    "l14_customer_profile",
    wseg(
        _IDS_SQL
        + """
SELECT s.CustomerID AS customer_id, s.Recency AS recency, s.Frequency AS frequency, s.Monetary AS monetary,
  s.Segment AS segment_id, s.SegmentLabel AS segment_label, s.CohortMonth AS cohort_month, s.ActiveMonths AS active_months,
  c.ChurnProb AS churn_prob, c.ChurnRisk AS churn_risk
FROM segments s LEFT JOIN churn c ON c.CustomerID = s.CustomerID WHERE s.CustomerID IN (SELECT CustomerID FROM ids)"""
    ),
)
def l14_customer_profile(spark, sf):
    return rp.customer_profile(segments(spark, sf), churn(spark, sf), request_ids(spark, sf))


_LOOKUPS: dict = {}


def lookup_tables(spark, sf):
    """The laid-out lines and counts, published once per session and folder."""
    import os
    import uuid

    from ..operators import lookup as lk
    from ..session import app_id
    from ..sources.io import checkpoint_dir
    from ..sources.versioned import VersionedTable

    key = (app_id(spark), os.path.abspath(sf))
    if key not in _LOOKUPS:
        base = os.path.join(checkpoint_dir(spark), f"lookup-{uuid.uuid4().hex[:8]}")
        _LOOKUPS[key] = VersionedTable(spark, f"{base}/lines"), VersionedTable(spark, f"{base}/counts")
        lk.lay_out(clean_lines(spark, sf), *_LOOKUPS[key], dealt=True)
    return _LOOKUPS[key]


@register(
    "l15_customer_history",
    wseg(
        _IDS_SQL
        + """, mine AS (SELECT * FROM clean WHERE CustomerID IN (SELECT CustomerID FROM ids)),
summ AS (SELECT CustomerID, count(*) AS lines, count(DISTINCT InvoiceNo) AS orders FROM mine GROUP BY 1)
SELECT m.CustomerID, m.InvoiceNo, m.StockCode, m.Quantity, m.InvoiceDate, CAST(m.Revenue AS DOUBLE) AS Revenue, s.lines, s.orders
FROM mine m JOIN summ s ON s.CustomerID = m.CustomerID"""
    ),
)
def l15_customer_history(spark, sf):
    """On the line table laid out by customer bucket."""
    from ..operators import lookup as lk

    h = lk.history(*lookup_tables(spark, sf), request_ids(spark, sf))
    return doubles(h.select("CustomerID", "InvoiceNo", "StockCode", "Quantity", "InvoiceDate", "Revenue", "lines", "orders"))


@register(
    "l16_customer_monthly_spend",
    wseg(
        _IDS_SQL
        + f"\nSELECT CustomerID, strftime(InvoiceDate, '%Y-%m') AS Month, {o.rnd('sum(Revenue)', 2)} AS Revenue FROM clean "
        "WHERE CustomerID IN (SELECT CustomerID FROM ids) GROUP BY 1, 2"
    ),
)
def l16_customer_monthly_spend(spark, sf):
    from ..operators import lookup as lk

    return rp.customer_monthly_spend(lk.rows_of(lookup_tables(spark, sf)[0], request_ids(spark, sf)))


def _l17_sql() -> str:
    cols = RFM_FEATURE_COLUMNS
    src = {"Recency": "CAST(recency AS DOUBLE)", "Log_Frequency": "ln(1 + CAST(frequency AS DOUBLE))",
           "Log_Monetary": "ln(1 + CAST(monetary AS DOUBLE))"}
    z = ", ".join(
        f"CASE WHEN {c}__std > 0 THEN ({src[c]} - {c}__mean) / {c}__std ELSE 0.0 END AS {c}_scaled" for c in cols
    )
    dists = []
    for cid, coords in si.STANDIN_CENTRES:
        terms = " + ".join(
            f"({c}_scaled - CAST({v!r} AS DOUBLE)) * ({c}_scaled - CAST({v!r} AS DOUBLE))" for c, v in zip(cols, coords)
        )
        dists.append(f"({terms}) AS d_{cid}")
    ids = sorted(c for c, _ in si.STANDIN_CENTRES)
    least = "least(" + ", ".join(f"d_{i}" for i in ids) + ")"
    case = " ".join(f"WHEN d_{i} = {least} THEN {i}" for i in ids)
    lab = " ".join(f"WHEN {k} THEN '{v}'" for k, v in sorted(si.standin_mapping().items()))
    return f""", req AS (SELECT CustomerID AS customer_id, Recency AS recency, Frequency AS frequency, Monetary AS monetary FROM features),
rz AS (SELECT req.*, {z} FROM req, s_params),
rd AS (SELECT *, {', '.join(dists)} FROM rz)
SELECT customer_id, recency, frequency, monetary, CAST(CASE {case} END AS INTEGER) AS segment_id,
  coalesce(CASE CASE {case} END {lab} END, 'Unknown') AS segment_label FROM rd"""


@register("l17_score_segments", wseg(_l17_sql()))
def l17_score_segments(spark, sf):
    f = features(spark, sf)
    params = sg.scaler_params(f)
    req = f.select(
        F.col("CustomerID").alias("customer_id"), F.col("Recency").alias("recency"),
        F.col("Frequency").alias("frequency"), F.col("Monetary").alias("monetary"),
    )
    return rp.score_segments(req, params, si.STANDIN_CENTRES, si.standin_mapping())


# --- DQ1: request validation -------------------------------------------------------------------
REQ_MAP = {
    "recency": "Recency", "frequency": "Frequency", "monetary": "Monetary", "aov": "AOV", "spend_std": "SpendStd",
    "unique_skus": "UniqueSKUs", "total_items": "TotalItems", "repeat_sku_ratio": "RepeatSKURatio",
    "avg_gap": "AvgGap", "std_gap": "StdGap", "weekend_ratio": "WeekendRatio",
    "preferred_day_of_week": "PreferredDayOfWeek", "active_months": "ActiveMonths",
    "days_since_first_purchase": "DaysSinceFirstPurchase", "return_rate": "ReturnRate", "segment": "Segment",
}


def churn_requests(spark, sf):
    s = segments(spark, sf)
    return s.select(F.col("CustomerID").alias("customer_id"), *[F.col(v).alias(k) for k, v in REQ_MAP.items()])


def _dq_sql() -> str:
    ops = {"ge": ">=", "gt": ">", "le": "<=", "lt": "<"}
    rules = ", ".join(
        f"CASE WHEN NOT coalesce({f} {ops[op]} {b}, false) THEN '{f}_{op}_{b}' END" for f, op, b in CHURN_REQUEST_RULES
    )
    sel = ", ".join(f"{v} AS {k}" for k, v in REQ_MAP.items())
    return f""", reqs AS (SELECT CustomerID AS customer_id, {sel} FROM segments),
tagged AS (SELECT customer_id, concat_ws(',', {rules}) AS failed_rules FROM reqs)"""


@register("dq1_quarantine", wseg(_dq_sql() + "\nSELECT customer_id, failed_rules FROM tagged WHERE failed_rules <> ''"))
def dq1_quarantine(spark, sf):
    good, bad = q.validate_requests(churn_requests(spark, sf), "churn")
    return bad.select("customer_id", F.array_join("failed_rules", ",").alias("failed_rules"))


@register(
    "dq1_accepted",
    wseg(_dq_sql() + "\nSELECT count(*) FILTER (WHERE failed_rules = '') AS accepted, count(*) FILTER (WHERE failed_rules <> '') AS quarantined FROM tagged"),
)
def dq1_accepted(spark, sf):
    t = churn_requests(spark, sf).withColumn("failed_rules", q.failed_rules_expr(CHURN_REQUEST_RULES))
    return t.agg(
        F.count_if(F.size("failed_rules") == 0).alias("accepted"), F.count_if(F.size("failed_rules") > 0).alias("quarantined")
    )
