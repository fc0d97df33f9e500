"""Operator 1 - line dedup on a suffix array of line IDs (DataFrames only).

Documents become sequences of line IDs.  The suffix array of all sequences is
built by prefix doubling: a suffix's rank by its first h lines and the rank of
the suffix h lines on give its rank by 2h lines.  Ranks are counts of smaller
suffixes, taken over distinct pairs (pre-aggregated before each shuffle) with
two-level prefix sums, so a line in a third of all documents is one row there.
A suffix whose rank has become its own shares no longer prefix and leaves, and
doubling ends when prefixes are ``min_lines`` long: equal ranks are then the
intervals of the array whose longest common prefix is at least that, each a
repeated run.  The least (doc_id, line) of an interval is the first copy; the
lines of all later ones go, and overlapping ones make up the maximal runs.
The first ranks, of single lines, do the same for lines of ``line_words`` words
or more: such a line is a run by itself.

Line IDs are 64-bit hashes of whole lines (between newlines).  Texts meet
their marks in place while those are few, and move once where they are many.
Defined results: a null text has no lines and an empty one has one; blank
lines are lines; a run that overlaps its own earlier copy loses its later
lines; rows that repeat doc_id and text count once and lose the same lines,
and different texts under one doc_id follow each other by their hash; rows
without doc_id are left out; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.ordered import prefix_sums

from .common import SPACE, Workspace

MIN_LINES = 2
LINE_WORDS = 8
KEY = ["doc", "copy"]  # a text: its doc_id and hash
BROADCAST_MARKS = 1_000_000  # so many line numbers (64 MB with their keys) are broadcast; with more, texts are shuffled


def _joined(suffixes: DataFrame, ahead: int) -> DataFrame:
    """(doc, copy, i, r, r2) with r2 the rank ``ahead`` lines on."""
    later = suffixes.select(*KEY, (F.col("i") - ahead).alias("i"), F.col("r").alias("r2"))
    return suffixes.join(later, [*KEY, "i"])


def double_ranks(ws: Workspace, suffixes: DataFrame, ahead: int, name: str) -> DataFrame:
    """Ranks by (r, r2) of the suffixes that share them with another one."""
    pairs = _joined(suffixes, ahead)
    counted = ws.stage(pairs.groupBy("r", "r2").agg(F.count(F.lit(1)).alias("c")).filter("c > 1"), f"{name}-pairs")
    ranked = prefix_sums(counted, ["r2"], ["c"], partition_cols=["r"]).select(
        "r", "r2", (F.col("r") + F.col("c_before")).alias("rank"))
    out = ws.stage(pairs.join(ranked, ["r", "r2"]).select(*KEY, "i", F.col("rank").alias("r")), name)
    ws.drop(f"{name}-pairs")
    return out


def repeated_runs(docs: DataFrame, min_lines: int = MIN_LINES, line_words: int = LINE_WORDS) -> tuple[Workspace, DataFrame, DataFrame]:
    """(doc, copy, i, r) of every suffix whose first ``min_lines`` lines occur
    again, r its rank among such suffixes: its place in the suffix array; and
    the same of the single lines of ``line_words`` words."""
    ws = Workspace(docs.sparkSession, "lines")
    split = F.split("text", "\n", -1)
    lines = ws.stage(
        docs.filter("doc_id is not null and text is not null").select(
            F.col("doc_id").cast("long").alias("doc"), F.xxhash64("text").alias("copy"),
            F.transform(split, lambda x: F.struct(
                F.xxhash64(x).alias("id"), (F.size(F.array_remove(F.split(x, SPACE, -1), "")) >= line_words).alias("long"))).alias("ids"))
        .groupBy(*KEY).agg(F.first("ids").alias("ids")), "ids")  # equal texts have equal ids
    each = lines.select(*KEY, F.posexplode("ids").alias("i", "x")).select(*KEY, "i", "x.id", "x.long")
    counted = ws.stage(each.groupBy("id").agg(F.count(F.lit(1)).alias("c")).filter("c > 1"), "counts")
    ranked = prefix_sums(counted, ["id"], ["c"]).select("id", F.col("c_before").alias("r"))
    single = ws.stage(each.join(ranked, "id").select(*KEY, "i", "r", "long"), "suffixes-1")
    ws.drop("counts", "ids")
    have, length = single.drop("long"), 1
    while length < min_lines:
        ahead = min(length, min_lines - length)
        longer = double_ranks(ws, have, ahead, f"suffixes-{length + ahead}")
        if length > 1:
            ws.drop(f"suffixes-{length}")
        have, length = longer, length + ahead
    return ws, have, single.filter("long").drop("long")


def _later(ws: Workspace, suffixes: DataFrame, name: str) -> DataFrame:
    """All but the first of the suffixes of a rank.  The firsts are staged, so
    that both sides of the join come from shuffles and a hot rank is split."""
    first = ws.stage(suffixes.groupBy("r").agg(F.min(F.struct(*KEY, "i")).alias("first")), name)
    return suffixes.join(first, "r").filter(F.struct(*KEY, "i") > F.col("first"))


def dedup_lines(docs: DataFrame, min_lines: int = MIN_LINES, line_words: int = LINE_WORDS) -> DataFrame:
    """(doc_id, n_lines, n_removed, kept_text) for every row with a doc_id."""
    ws, suffixes, single = repeated_runs(docs, min_lines, line_words)
    runs = _later(ws, suffixes, "first-runs").select(*KEY, F.explode(F.sequence(F.col("i"), F.col("i") + (min_lines - 1))).alias("i"))
    gone = ws.stage(
        runs.unionByName(_later(ws, single, "first-lines").select(*KEY, "i"))
        .groupBy(*KEY).agg(F.collect_set("i").alias("gone")), "gone")  # bounded by the document
    ws.drop("suffixes-1", f"suffixes-{max(1, min_lines)}", "first-runs", "first-lines")
    marks = gone.agg(F.sum(F.size("gone")).alias("n")).first()["n"] or 0
    if marks <= BROADCAST_MARKS:
        gone = F.broadcast(gone)
    lines = F.coalesce(F.split("text", "\n", -1), F.array().cast("array<string>"))
    kept = F.when(F.col("gone").isNull(), F.col("lines")).otherwise(
        F.filter("lines", lambda x, i: ~F.array_contains("gone", i)))
    return (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("doc_id is not null")
        .withColumn("hash", F.xxhash64("text"))
        .join(gone, (F.col("doc_id") == F.col("doc")) & (F.col("hash") == F.col("copy")), "left").withColumn("lines", lines)
        .select("doc_id", F.size("lines").cast("long").alias("n_lines"),
                F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
                F.array_join(kept, "\n").alias("kept_text"))
    )
