"""Registered queries of the corpus operators: each applies one operator with
production parameters to a whole table and returns its full result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, fertility, jaccard, licenses, lines, mixing, mixing_sql, negatives, private, runs, secrets, sharding, substrings, toxicity
from .common import documents

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def put(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return put


OP2_SQL = r"""
WITH w AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS words FROM documents),
s AS (SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS win
      FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM w WHERE len(words) >= 13)),
o AS (SELECT win, min(doc_id) AS lo FROM s GROUP BY win HAVING count(DISTINCT doc_id) > 1),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM s JOIN o USING (win) WHERE lo < doc_id),
g AS (SELECT doc_id, list(p) AS gone FROM c GROUP BY doc_id),
k AS (SELECT w.doc_id, words, coalesce(gone, []) AS gone FROM w LEFT JOIN g USING (doc_id))
SELECT doc_id, len(words)::BIGINT AS n_words, len(gone)::BIGINT AS n_removed,
       sha256(coalesce(array_to_string(list_filter(words, lambda x, i: NOT list_contains(gone, i)), ' '), '')) AS kept_sha256
FROM k
"""


@register("op2_super_kmer_substrings", OP2_SQL)
def op2_super_kmer_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.dedup_substrings(documents(spark, sf_dir))


OP3_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x20\x09-\x0D]+'), []) AS words FROM documents),
g AS (SELECT DISTINCT doc_id, CASE WHEN len(words) < 4 THEN array_to_string(words, ' ')
             ELSE array_to_string(words[i:i + 3], ' ') END AS s
      FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 2, 2))) AS i FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM g a JOIN g b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE 100 * c >= 85 * (x.n + y.n - c)),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT r.a AS doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(r.b) AS component_id,
       coalesce(any_value(k.n_links), 0)::BIGINT AS n_links
FROM r LEFT JOIN n ON n.doc_id = r.a
LEFT JOIN (SELECT a, count(*) AS n_links FROM l GROUP BY a) k ON k.a = r.a GROUP BY r.a
"""


@register("op3_ngram_jaccard", OP3_SQL)
def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_documents(documents(spark, sf_dir), jaccard.Similarity(shingle=4, percent=85))


@register("op5_best_fit_sharding")
def op5_best_fit_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.with_law(sharding.assign_shards(documents(spark, sf_dir), shards=8))
    return out.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


@register("op7_tokeniser_fertility")
def op7_tokeniser_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility.measure(documents(spark, sf_dir))


@register("op9_structural_secrets")
def op9_structural_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(documents(spark, sf_dir))


@register("op10_hierarchical_mixing", mixing_sql.SQL)
def op10_hierarchical_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = mixing.select_mixture(documents(spark, sf_dir), with_epoch=True)
    return chosen.select("doc_id", F.col("lang"), F.col("source"), "domain", "n_tokens", "epoch")


@register("op6_kneser_ney_toxicity")
def op6_kneser_ney_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return toxicity.score_documents(docs, toxicity.train(docs, documents(spark, sf_dir, "labels")))


@register("op8_latent_decontamination")
def op8_latent_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))


OP1_SQL = r"""
WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents),
p AS (SELECT doc_id, i, lines[i] AS x, lines[i + 1] AS y
      FROM (SELECT doc_id, lines, unnest(range(1, len(lines))) AS i FROM l WHERE len(lines) > 1)),
f AS (SELECT x, y, min({'d': doc_id, 'i': i}) AS first FROM p GROUP BY x, y HAVING count(*) > 1),
s AS (SELECT doc_id, i, lines[i] AS x FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM l)),
sf AS (SELECT x, min({'d': doc_id, 'i': i}) AS first FROM s WHERE len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) >= 8
       GROUP BY x HAVING count(*) > 1),
g AS (SELECT doc_id, unnest([i, i + 1]) AS i FROM p JOIN f USING (x, y) WHERE {'d': doc_id, 'i': i} <> first
      UNION SELECT doc_id, i FROM s JOIN sf USING (x) WHERE {'d': doc_id, 'i': i} <> first),
h AS (SELECT doc_id, list(i) AS gone FROM g GROUP BY doc_id)
SELECT l.doc_id, coalesce(len(lines), 0)::BIGINT AS n_lines, coalesce(len(gone), 0)::BIGINT AS n_removed,
       md5(coalesce(array_to_string(list_filter(lines, lambda x, i: NOT list_contains(coalesce(gone, []), i)), chr(10)), '')) AS kept_md5
FROM l LEFT JOIN h USING (doc_id)
"""


@register("op1_suffix_array_lines", OP1_SQL)
def op1_suffix_array_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.dedup_lines(documents(spark, sf_dir))
    return out.select("doc_id", "n_lines", "n_removed", F.md5("kept_text").alias("kept_md5"))


@register("op4_bootstrapped_private")
def op4_bootstrapped_private(spark: SparkSession, sf_dir: str) -> DataFrame:
    return private.find_private(documents(spark, sf_dir))


@register("op11_repair_runs")
def op11_repair_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.digest(runs.find_runs(runs.repeat_words(documents(spark, sf_dir))))


OP12_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, list_dot_product(a.q, b.q)::BIGINT AS score
      FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id, (row_number() OVER w)::INTEGER AS rank, other AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) QUALIFY row_number() OVER w <= 5
"""


@register("op12_multi_index_negatives", OP12_SQL)
def op12_multi_index_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = documents(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = vectors.select(F.col("vec_id").alias("id"), label.alias("label"), negatives.quantised("embedding").alias("v"))
    return negatives.mine(rows, F.col("id") % 100 == 0)


_VALUES = ", ".join(f"({k}, '{label}', '{passage}', {phrases!r})" for k, (label, passage, phrases) in enumerate(licenses.TEMPLATES))
_PHRASES = ", ".join(f"('{phrase}', '{label}')" for phrase, label in licenses.BASE)
OP13_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS words
  FROM documents),
w AS MATERIALIZED (SELECT r, unnest(words) AS word, unnest(range(len(words))) AS i FROM d),
t AS (SELECT k, label, string_split(passage, ' ') AS text, phrases FROM (VALUES {_VALUES}) v(k, label, passage, phrases)),
tw AS MATERIALIZED (SELECT k, len(text) AS size, unnest(text) AS word, unnest(range(len(text))) AS j FROM t),
must AS (SELECT DISTINCT k, j FROM (
  SELECT k, unnest(range(a, a + n)) AS j FROM (
    SELECT k, n, list_min(list_filter(range(len(text)), lambda a: text[a + 1:a + n] = p)) AS a
    FROM (SELECT k, text, string_split(p, ' ') AS p, len(string_split(p, ' ')) AS n FROM (SELECT k, text, unnest(phrases) AS p FROM t))))),
v AS (SELECT DISTINCT word FROM tw),
hw AS MATERIALIZED (SELECT r, i, word FROM w SEMI JOIN v USING (word)),
df AS (SELECT word, count(DISTINCT r) AS n FROM hw GROUP BY word),
rare AS (SELECT r, k, word FROM (SELECT DISTINCT r, k, word FROM hw JOIN (SELECT DISTINCT k, word FROM tw) USING (word)) JOIN df USING (word)
  QUALIFY row_number() OVER (PARTITION BY r, k ORDER BY n, word) <= 6),
o AS (SELECT r, k, i - j AS o FROM rare JOIN hw USING (r, word) JOIN tw USING (k, word) GROUP BY r, k, o HAVING count(DISTINCT word) >= 3),
fit AS (SELECT o.r, o.k, o.o, count(*) / any_value(size) AS share, count(must.j) AS held
  FROM o JOIN tw ON tw.k = o.k JOIN hw ON hw.r = o.r AND hw.i = o.o + tw.j AND hw.word = tw.word
  LEFT JOIN must ON must.k = o.k AND must.j = tw.j GROUP BY o.r, o.k, o.o),
f AS (SELECT r, label, max(share) AS share FROM fit JOIN t USING (k) JOIN (SELECT k, count(*) AS n FROM must GROUP BY k) USING (k)
  WHERE share >= 0.8 AND held = n GROUP BY r, label),
p AS (SELECT string_split(phrase, ' ') AS p, label FROM (VALUES {_PHRASES}) x(phrase, label)),
b AS (SELECT d.r, w.i, label FROM w JOIN p ON w.word = p.p[1] JOIN d USING (r) WHERE d.words[w.i + 1:w.i + len(p.p)] = p.p),
bs AS (SELECT r, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM b GROUP BY r),
al AS (SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT r, label FROM b UNION ALL SELECT r, label FROM f) GROUP BY r),
sc AS (SELECT r, max(share) AS share FROM f GROUP BY r)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
       last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0)::DOUBLE END AS score
FROM d LEFT JOIN bs USING (r) LEFT JOIN al USING (r) LEFT JOIN sc USING (r)
"""


@register("op13_positional_licenses", OP13_SQL)
def op13_positional_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digest(licenses.scan_licenses(documents(spark, sf_dir)))
