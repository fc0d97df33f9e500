"""Corpus pipeline: documents in, sharded training mix out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's ``docs``.  All stages but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from basketry.llm import decontaminate, fertility, jaccard, mixing, sharding
from basketry.llm.common import Workspace, documents

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the tokeniser-fertility rules reject go."""
    return fertility.keep_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays (five-word
    shingles, similarity 0.8 or more)."""
    return jaccard.one_per_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.clean_documents(docs, documents(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token budget of each leaf of the source tree; a document read in
    two epochs gives two rows."""
    return mixing.select_mixture(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, size, checksum, shard and slot of every remaining row."""
    return sharding.assign_shards(docs, shards=8, keep=("lang", "source"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixture", mixture),
    ("shards", shards),
]

#: SQL cannot run a tokeniser vocabulary or a singular value decomposition, so
#: the rows are tested against a brute-force version (tests/llm).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    ws = Workspace(spark, "corpus-pipeline")
    docs = documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        docs = ws.stage(stage(spark, docs, sf_dir), f"{k}-{name}")
        if k:
            ws.drop(f"{k - 1}-{STAGES[k - 1][0]}")
    return docs
