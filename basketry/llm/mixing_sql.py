"""DuckDB statement with the rows of ``op10_hierarchical_mixing``."""

_FILL = """
n{i} AS (SELECT {cols}, sum(cap) AS cap, any_value(w{i}) AS w FROM usable GROUP BY {cols}),
b{i} AS (SELECT n.*, p.take AS b FROM n{i} n JOIN p{i} p {on}),
f{i} AS (SELECT *, coalesce(sum(cap) OVER (PARTITION BY {par} ORDER BY cap::DOUBLE / w::DOUBLE, {cols}
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::HUGEINT AS used,
           sum(w) OVER (PARTITION BY {par} ORDER BY cap::DOUBLE / w::DOUBLE, {cols}
             ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::HUGEINT AS wleft FROM b{i}),
g{i} AS (SELECT *, cap * wleft <= w * (b - used) AS is_full FROM f{i}),
h{i} AS (SELECT *, b - coalesce(sum(CASE WHEN is_full THEN cap END) OVER (PARTITION BY {par}), 0)::HUGEINT AS rest,
           sum(CASE WHEN NOT is_full THEN w END) OVER (PARTITION BY {par})::HUGEINT AS wsum FROM g{i}),
p{j} AS (SELECT {cols}, CASE WHEN is_full THEN cap ELSE (rest * w) // wsum END::HUGEINT AS take FROM h{i})"""

_LEVELS = ["dom", "l", "s"]


def _levels() -> str:
    out = []
    for i in range(3):
        cols, par = ", ".join(_LEVELS[:i + 1]), ", ".join(_LEVELS[:i]) or "1"
        on = "ON true" if i == 0 else "USING (" + ", ".join(_LEVELS[:i]) + ")"
        out.append(_FILL.format(i=i, j=i + 1, cols=cols, par=par, on=on))
    return ",".join(out)


SQL = rf"""
WITH d AS (
  SELECT doc_id, lang, source, CASE WHEN source = 'src0' THEN 'web' ELSE 'curated' END AS dom,
         coalesce(lang, '(none)') AS l, coalesce(source, '(none)') AS s,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS n FROM documents),
e AS (SELECT * FROM d WHERE n > 0),
leaf AS (SELECT dom, l, s, sum(n)::HUGEINT AS t FROM e GROUP BY ALL),
usable AS (SELECT dom, l, s, t, (t * 2)::HUGEINT AS cap,
    CASE dom WHEN 'web' THEN 40 ELSE 60 END::HUGEINT AS w0,
    CASE l WHEN 'en' THEN 55 WHEN 'de' THEN 15 WHEN 'fr' THEN 15 WHEN 'es' THEN 15 ELSE 10 END::HUGEINT AS w1,
    10::HUGEINT AS w2 FROM leaf),
p0 AS (SELECT least(sum(cap), sum(t) * 80 // 100)::HUGEINT AS take FROM usable),{_levels()},
quota AS (SELECT dom, l, s, (take // t)::INT AS epochs, (take % t)::HUGEINT AS rest FROM p3 JOIN leaf USING (dom, l, s)),
dated AS (SELECT e.*, epochs, rest, md5('11:' || epochs || ':' || doc_id) AS h FROM e JOIN quota USING (dom, l, s)),
run AS (SELECT *, sum(n) OVER (PARTITION BY dom, l, s ORDER BY h) AS upto FROM dated),
times AS (SELECT *, epochs + CASE WHEN upto <= rest THEN 1 ELSE 0 END AS k FROM run)
SELECT doc_id, lang, source, dom AS domain, n AS n_tokens, unnest(range(0, k))::INT AS epoch FROM times WHERE k > 0
"""
