"""Operator 4 - personal data by bootstrapped contextual extraction
(DataFrames only).

Four plain patterns (email, ip, card, phone) give the seed entities.  Every
seed and every other word with a digit or an at-sign is an instance, and the
words left and right of it, alone and together, are its lexical patterns.
Rounds then score the graph of patterns and instances: a pattern's confidence
for a kind is the share of that kind among its known instances (one more added
to the total).  Unknown instances are no errors, since they are what is looked
for, but a pattern needs three known ones of the kind and these must be a
stated share of all it has.  An unknown instance of two or more confident
patterns, which must be half or more of its own patterns, has the chance that
not all of them err.  Instances above the threshold are known in the next
round, and their occurrences become further spans.

One pass reads the texts and stages narrow rows: spans and instances with
their contexts.  The rounds work on distinct (pattern, instance) edges, whose
counts are aggregated before they are shuffled, so a pattern or an identifier
that fills a third of all rows is one row per edge.  Java regular expressions
use possessive groups, so very long runs neither backtrack nor overflow.

Defined results: null and empty texts hold nothing; spans are code points, end
exclusive; repeated rows get equal results; rows with a null doc_id keep their
base spans; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Workspace

KINDS = ["email", "ip", "card", "phone"]
# a match may start where the last one ended or where its first class begins
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# what a row needs to hold any match; rows without are settled by one scan
MAYBE = r"@|[0-9]"
SPACE = r"[\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Bootstrap:
    rounds: int = 3
    min_known: int = 3
    min_confidence: float = 0.8
    min_share: float = 0.3  # of a pattern's instances known as the kind
    min_score: float = 0.95
    min_patterns: int = 2
    min_agreeing: float = 0.5  # of an instance's patterns
    reach: int = 64  # characters searched for the words beside an instance


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Doubling every second digit from the right, the digit sum ends in 0."""
    d = F.transform(F.filter(F.split(F.reverse(digits), ""), lambda x: x != ""), lambda x: x.cast("int"))
    doubled = F.transform(d, lambda x, i: F.when(i % 2 == 0, x).when(x > 4, x * 2 - 9).otherwise(x * 2))
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0


def _holds(kind: str, m: Column) -> Column:
    if kind == "ip":
        return ~F.exists(F.split(m, r"\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) > 3) | (
            F.coalesce(F.substring(F.ltrim(p, F.lit("0")), 1, 3).try_cast("int"), F.lit(0)) > 255))
    if kind == "card":
        n = F.length(_digits(m))
        return F.when(n.between(12, 19), _luhn(_digits(m))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(m)).between(9, 15)
    return F.lit(True)


def _matches(text: Column, pattern: str) -> Column:
    """array of (start, end, word) of all matches: the text between matches
    and the matches' own lengths add up to their places."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    empty = F.array().cast("array<struct<start:int,end:int,word:string>>")
    folded = F.aggregate(
        F.arrays_zip(F.slice(gaps, 1, F.size(found)).alias("gap"), found.alias("word")),
        F.struct(F.lit(0).alias("at"), empty.alias("out")),
        lambda a, x: F.struct(
            (a["at"] + F.length(x["gap"]) + F.length(x["word"])).alias("at"),
            F.concat(a["out"], F.array(F.struct(
                (a["at"] + F.length(x["gap"])).alias("start"),
                (a["at"] + F.length(x["gap"]) + F.length(x["word"])).alias("end"), x["word"].alias("word")))).alias("out")),
        lambda a: a["out"])
    return F.when(text.rlike(pattern), folded).otherwise(empty)


def base_spans(text: Column) -> Column:
    """array of (start, k, end, word), k the place of the kind, by start and k."""

    def of(k: int, kind: str) -> Column:
        kept = F.filter(_matches(text, PATTERNS[kind]), lambda m: _holds(kind, m["word"]))
        return F.transform(kept, lambda m: F.struct(
            m["start"].alias("start"), F.lit(k).alias("k"), m["end"].alias("end"), m["word"].alias("word")))

    return F.sort_array(F.concat(*[of(k, kind) for k, kind in enumerate(KINDS)]))


def _count(k: int) -> Column:
    return F.size(F.filter("base", lambda s: s["k"] == k)).cast("long").alias(f"n_{KINDS[k]}")


def joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.format_string(
        "%s:%d:%d", F.element_at(names, s["k"] + 1), s["start"], s["end"])), ",")


def _beside(text: Column, start: Column, end: Column, reach: int) -> tuple[Column, Column]:
    """Lower-cased words before and after a span, or ^ and $."""
    low = F.greatest(start - reach, F.lit(0))
    left = F.try_element_at(F.filter(F.split(F.substring(text, low + 1, start - low), SPACE), lambda x: x != ""), F.lit(-1))
    right = F.get(F.filter(F.split(F.substring(text, end + 1, F.lit(reach)), SPACE), lambda x: x != ""), F.lit(0))
    return F.lower(F.coalesce(left, F.lit("^"))), F.lower(F.coalesce(right, F.lit("$")))


def scan(docs: DataFrame, how: Bootstrap) -> DataFrame:
    """(doc_id, base, instances): the one pass over the texts.  An instance is
    (start, end, word, k, left, right); k is -1 where no base span is."""
    text = F.when(F.col("text").rlike(MAYBE), F.col("text")).otherwise(F.lit(""))
    word = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"

    def instance(start: Column, end: Column, word: Column, k: Column) -> Column:
        left, right = _beside(F.col("__text"), start, end, how.reach)
        return F.struct(start.alias("start"), end.alias("end"), word.alias("word"), k.alias("k"), left.alias("left"), right.alias("right"))

    free = F.filter(F.col("__words"), lambda w: ~F.exists(F.col("base"), lambda s: (s["start"] < w["end"]) & (w["start"] < s["end"])))
    found = F.concat(F.transform("base", lambda s: instance(s["start"], s["end"], s["word"], s["k"])),
                     F.transform(free, lambda w: instance(w["start"], w["end"], w["word"], F.lit(-1))))
    return (
        docs.select(F.col("doc_id").cast("long"), text.alias("__text"))
        .withColumn("base", base_spans(F.col("__text"))).withColumn("__words", _matches(F.col("__text"), word))
        .select("doc_id", "base", found.alias("instances"))
    )


def discover(ws: Workspace, seen: DataFrame, how: Bootstrap) -> DataFrame:
    """(word, k) of the instances that confident patterns make known."""
    patterns = F.array(F.concat(F.lit("L "), "left"), F.concat(F.lit("R "), "right"), F.concat_ws(" ", F.lit("B"), "left", "right"))
    edges = ws.stage(seen.select("word", F.explode(patterns).alias("pattern")).distinct(), "edges")
    total = ws.stage(edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")), "totals")
    degree = ws.stage(edges.groupBy("word").agg(F.count(F.lit(1)).alias("degree")), "degrees")
    seeds = seen.filter("k >= 0").groupBy("word").agg(F.min("k").alias("k"))
    known = ws.stage(seeds, "known-0")
    for i in range(how.rounds):
        hits = edges.join(known, "word").groupBy("pattern").pivot("k", list(range(len(KINDS)))).count().na.fill(0)
        of_kind = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(str(k)).alias("hits")) for k in range(len(KINDS))]))
        every = sum((F.col(str(k)) for k in range(len(KINDS))), F.lit(0))
        good = (
            hits.select("pattern", every.alias("known"), of_kind.alias("x")).select("pattern", "known", "x.*")
            .withColumn("confidence", F.col("hits") / (F.col("known") + 1))
            .filter((F.col("hits") >= how.min_known) & (F.col("confidence") >= how.min_confidence))
            .join(total, "pattern").filter(F.col("hits") >= how.min_share * F.col("n"))
        )
        new = (
            edges.join(good, "pattern").groupBy("word", "k")
            .agg((1 - F.exp(F.sum(F.log(1 - F.col("confidence"))))).alias("score"), F.count(F.lit(1)).alias("patterns"))
            .filter((F.col("score") >= how.min_score) & (F.col("patterns") >= how.min_patterns))
            .join(known, "word", "left_anti").join(degree, "word").filter(F.col("patterns") >= how.min_agreeing * F.col("degree"))
            .groupBy("word").agg(F.max_by("k", F.struct("score", -F.col("k"))).alias("k"))
        )
        longer = ws.stage(known.unionByName(new), f"known-{i + 1}")
        ws.drop(f"known-{i}")
        known = longer
    return known.join(seeds.select("word"), "word", "left_anti")


def find_private(docs: DataFrame, how: Bootstrap | None = None) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) per row."""
    how = how or Bootstrap()
    ws = Workspace(docs.sparkSession, "private")
    rows = ws.stage(scan(docs, how), "rows")
    seen = rows.filter(F.size("instances") > 0).select("doc_id", F.explode("instances").alias("x")).select("doc_id", "x.*")
    new = ws.stage(discover(ws, seen, how), "discovered")
    ws.drop("edges", "totals", "degrees", f"known-{how.rounds}")
    more = seen.filter("k < 0").drop("k").join(new, "word").groupBy("doc_id").agg(
        F.collect_set(F.struct("start", "k", "end", "word")).alias("more"))  # bounded by the document
    none = F.array().cast("array<struct<start:int,k:int,end:int,word:string>>")
    every = F.sort_array(F.concat("base", F.coalesce("more", none)))
    return rows.join(more, "doc_id", "left").select(
        "doc_id", *map(_count, range(len(KINDS))),
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(every).alias("spans"))
