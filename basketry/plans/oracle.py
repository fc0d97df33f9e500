"""Reference SQL (DuckDB dialect) for the registered queries.

Each statement recomputes its result from the pre-registered test tables,
independently of the Spark code: the fixture mapping and the cleaning chain
are written once as common table expressions and every query appends its
own final SELECT.  Rules shared with the Spark side: rounding through
decimal(28,10) (``rnd``), whole days via ``date_sub('day', a, b)``,
Monday-first weekday as ``isodow - 1``.
"""

from __future__ import annotations


def rnd(expr: str, n: int) -> str:
    return f"CAST(ROUND(CAST(CAST({expr} AS DOUBLE) AS DECIMAL(28,10)), {n}) AS DOUBLE)"


def days(a: str, b: str) -> str:
    return f"date_sub('day', {a}, {b})"


TRIM = r"'^\s+|\s+$'"


def trim(expr: str) -> str:
    return f"regexp_replace({expr}, {TRIM}, '', 'g')"


RAW_CTE = r"""
fx_base AS (
  SELECT
    CASE WHEN l.l_returnflag = 'R' THEN 'C' || CAST(o.o_orderkey AS VARCHAR)
         ELSE CAST(o.o_orderkey AS VARCHAR) END AS InvoiceNo,
    CAST(l.l_partkey AS VARCHAR) AS StockCode,
    ' ' || p.p_name || ' ' AS Description,
    CASE WHEN l.l_returnflag = 'R' THEN -CAST(l.l_quantity AS INTEGER)
         ELSE CAST(l.l_quantity AS INTEGER) END AS Quantity,
    o.o_orderdate + to_hours(CAST(8 + o.o_orderkey % 10 AS INTEGER))
                  + to_minutes(CAST(o.o_orderkey % 60 AS INTEGER)) AS InvoiceDate,
    CAST(p.p_retailprice AS DECIMAL(18,2)) AS UnitPrice,
    CASE WHEN o.o_orderkey % 4 = 0 THEN NULL
         WHEN o.o_orderkey % 3 = 0 THEN CAST(o.o_custkey AS VARCHAR) || '.0'
         ELSE CAST(o.o_custkey AS VARCHAR) END AS CustomerID,
    n.n_name AS Country,
    l.l_linestatus AS LineStatus,
    l.l_partkey AS PartKey
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
),
raw_tagged AS (
  SELECT * EXCLUDE (PartKey) FROM fx_base
  UNION ALL
  SELECT * EXCLUDE (PartKey) FROM fx_base WHERE PartKey % 100 = 0
),
raw AS (SELECT * EXCLUDE (LineStatus) FROM raw_tagged)"""

CLEAN_CTE = (
    RAW_CTE
    + r""",
c_notnull AS (
  SELECT * FROM raw WHERE InvoiceDate IS NOT NULL AND CustomerID IS NOT NULL
),
c_ids AS (
  SELECT InvoiceNo, StockCode, Description, Quantity, InvoiceDate, UnitPrice,
         regexp_replace(regexp_replace(CustomerID, '\.0$', ''), '^\s+|\s+$', '', 'g') AS CustomerID,
         Country
  FROM c_notnull
),
c_pos AS (
  SELECT * FROM c_ids
  WHERE NOT coalesce(starts_with(InvoiceNo, 'C'), false)
    AND coalesce(Quantity > 0, false) AND coalesce(UnitPrice > 0, false)
),
c_dedup AS (SELECT DISTINCT * FROM c_pos),
c_caps AS (
  SELECT quantile_cont(CAST(Quantity AS DOUBLE), 0.99) AS qcap,
         quantile_cont(CAST(UnitPrice AS DOUBLE), 0.99) AS pcap
  FROM c_dedup
),
c_capped AS (
  SELECT d.* FROM c_dedup d, c_caps
  WHERE CAST(d.Quantity AS DOUBLE) <= qcap AND CAST(d.UnitPrice AS DOUBLE) <= pcap
),
clean AS (
  SELECT regexp_replace(InvoiceNo, '^\s+|\s+$', '', 'g') AS InvoiceNo,
         regexp_replace(StockCode, '^\s+|\s+$', '', 'g') AS StockCode,
         regexp_replace(Description, '^\s+|\s+$', '', 'g') AS Description,
         Quantity, InvoiceDate, UnitPrice,
         regexp_replace(CustomerID, '^\s+|\s+$', '', 'g') AS CustomerID,
         regexp_replace(Country, '^\s+|\s+$', '', 'g') AS Country,
         CAST(CAST(Quantity AS DECIMAL(18,0)) * UnitPrice AS DECIMAL(18,2)) AS Revenue
  FROM c_capped
)"""
)

# Per-customer feature CTEs on top of ``clean`` (and ``raw`` for returns).
FEATURE_CTE = (
    CLEAN_CTE
    + f""",
snap AS (SELECT max(InvoiceDate) + INTERVAL 1 DAY AS snapshot FROM clean),
f_rfm AS (
  SELECT CustomerID,
         CAST({days('max(InvoiceDate)', '(SELECT snapshot FROM snap)')} AS BIGINT) AS Recency,
         CAST(count(DISTINCT InvoiceNo) AS BIGINT) AS Frequency,
         {rnd('sum(Revenue)', 2)} AS Monetary,
         {rnd('ln(1 + CAST(count(DISTINCT InvoiceNo) AS DOUBLE))', 10)} AS Log_Frequency,
         {rnd('ln(1 + CAST(sum(Revenue) AS DOUBLE))', 4)} AS Log_Monetary
  FROM clean GROUP BY CustomerID
),
f_inv AS (
  SELECT CustomerID, InvoiceNo, sum(Revenue) AS total, min(InvoiceDate) AS inv_ts
  FROM clean GROUP BY CustomerID, InvoiceNo
),
f_aov AS (
  SELECT CustomerID, {rnd('avg(total)', 2)} AS AOV,
         {rnd('stddev_samp(CAST(total AS DOUBLE))', 2)} AS SpendStd
  FROM f_inv GROUP BY CustomerID
),
f_wd AS (
  SELECT CustomerID, isodow(InvoiceDate) - 1 AS wd, count(*) AS n FROM clean GROUP BY 1, 2
),
f_wd_best AS (
  SELECT CustomerID, wd FROM (
    SELECT CustomerID, wd, row_number() OVER (PARTITION BY CustomerID ORDER BY n DESC, wd) AS rk FROM f_wd
  ) WHERE rk = 1
),
f_hr AS (
  SELECT CustomerID, hour(InvoiceDate) AS hr, count(*) AS n FROM clean GROUP BY 1, 2
),
f_hr_best AS (
  SELECT CustomerID, hr FROM (
    SELECT CustomerID, hr, row_number() OVER (PARTITION BY CustomerID ORDER BY n DESC, hr) AS rk FROM f_hr
  ) WHERE rk = 1
),
f_temporal AS (
  SELECT w.CustomerID,
         CAST(w.wd AS INTEGER) AS PreferredDayOfWeek,
         r.WeekendRatio,
         CAST(h.hr AS INTEGER) AS PreferredHour
  FROM f_wd_best w
  JOIN (SELECT CustomerID,
               {rnd('avg(CASE WHEN isodow(InvoiceDate) - 1 >= 5 THEN 1.0 ELSE 0.0 END)', 4)} AS WeekendRatio
        FROM clean GROUP BY CustomerID) r ON r.CustomerID = w.CustomerID
  JOIN f_hr_best h ON h.CustomerID = w.CustomerID
),
f_product AS (
  SELECT CustomerID,
         CAST(count(DISTINCT StockCode) AS BIGINT) AS UniqueSKUs,
         CAST(sum(Quantity) AS BIGINT) AS TotalItems,
         {rnd('(count(*) - count(DISTINCT StockCode)) / CAST(count(*) AS DOUBLE)', 4)} AS RepeatSKURatio
  FROM clean GROUP BY CustomerID
),
f_gap_rows AS (
  SELECT CustomerID,
         {days('lag(inv_ts) OVER (PARTITION BY CustomerID ORDER BY inv_ts, InvoiceNo)', 'inv_ts')} AS GapDays
  FROM f_inv
),
f_gaps AS (
  SELECT CustomerID, {rnd('avg(GapDays)', 2)} AS AvgGap,
         {rnd('stddev_samp(CAST(GapDays AS DOUBLE))', 2)} AS StdGap
  FROM f_gap_rows WHERE GapDays IS NOT NULL GROUP BY CustomerID
),
f_raw_ids AS (
  SELECT regexp_replace(regexp_replace(CustomerID, '\\.0$', ''), '^\\s+|\\s+$', '', 'g') AS CustomerID,
         InvoiceNo, coalesce(starts_with(InvoiceNo, 'C'), false) AS is_cancel
  FROM raw WHERE CustomerID IS NOT NULL
),
f_returns AS (
  SELECT CustomerID,
         {rnd('count_if(is_cancel) / CAST(count(DISTINCT InvoiceNo) AS DOUBLE)', 4)} AS ReturnRate
  FROM f_raw_ids GROUP BY CustomerID
),
f_behavioural AS (
  SELECT a.CustomerID, a.AOV, coalesce(a.SpendStd, 0.0) AS SpendStd,
         t.PreferredDayOfWeek, t.WeekendRatio, t.PreferredHour,
         p.UniqueSKUs, p.TotalItems, p.RepeatSKURatio,
         coalesce(g.AvgGap, 0.0) AS AvgGap, coalesce(g.StdGap, 0.0) AS StdGap,
         coalesce(r.ReturnRate, 0.0) AS ReturnRate
  FROM f_aov a
  LEFT JOIN f_temporal t ON t.CustomerID = a.CustomerID
  LEFT JOIN f_product p ON p.CustomerID = a.CustomerID
  LEFT JOIN f_gaps g ON g.CustomerID = a.CustomerID
  LEFT JOIN f_returns r ON r.CustomerID = a.CustomerID
),
f_cohort AS (
  SELECT CustomerID,
         min(strftime(InvoiceDate, '%Y-%m')) AS CohortMonth,
         CAST(count(DISTINCT strftime(InvoiceDate, '%Y-%m')) AS BIGINT) AS ActiveMonths,
         CAST({days('min(InvoiceDate)', 'max(InvoiceDate)')} AS BIGINT) AS DaysSinceFirstPurchase
  FROM clean GROUP BY CustomerID
),
features AS (
  SELECT r.*, b.* EXCLUDE (CustomerID), c.* EXCLUDE (CustomerID)
  FROM f_rfm r
  LEFT JOIN f_behavioural b ON b.CustomerID = r.CustomerID
  LEFT JOIN f_cohort c ON c.CustomerID = r.CustomerID
)"""
)


def with_ctes(cte: str, body: str) -> str:
    return "WITH " + cte.strip() + "\n" + body.strip()
