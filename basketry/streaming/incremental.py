"""Incremental loads: append only rows the target does not hold yet.

The reference's writer has an ``append`` mode meant for incremental loads;
here it is an idempotent append: the batch is de-duplicated on the key
columns and left-anti-joined against the keys already stored, so replaying
a batch (a retried task, a restarted stream) appends nothing twice.  The
same function works as a Structured Streaming ``foreachBatch`` sink, which
is how new order-line files are picked up (``readStream`` of the landing
folder with a fixed schema, ``trigger(availableNow=True)``).
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.versioned import ConcurrentWrite, VersionedTable

MOST_MONTHS = 1_200  # a batch of more months reads every partition


def _exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` holds a readable parquet table (schema resolution
    only — no rows are read)."""
    from pyspark.errors import AnalysisException

    try:
        spark.read.parquet(path).schema
        return True
    except AnalysisException:
        return False


def append_new(batch: DataFrame, target: str, keys: list[str] | None = None,
               partition_by: list[str] | None = None) -> int:
    """Append the rows of ``batch`` whose key is not in the parquet table at
    ``target`` (all columns form the key by default).  Returns rows
    appended.  The anti-join is a shuffle join on the keys (AQE turns it
    into a broadcast when the stored key set is small at run time)."""
    from ..sources.io import save_table

    spark = batch.sparkSession
    keys = list(keys or batch.columns)
    new = batch.dropDuplicates(keys)
    if _exists(spark, target):
        stored = spark.read.parquet(target).select(*keys)
        # NULL-safe key equality (a NULL key part must match a stored NULL);
        # Spark still plans <=> keys as an equi-join.
        l, r = new.alias("__new"), stored.alias("__old")
        cond = None
        for k in keys:
            c = F.col(f"__new.`{k}`").eqNullSafe(F.col(f"__old.`{k}`"))
            cond = c if cond is None else cond & c
        new = l.join(r, cond, "left_anti").select(*[F.col(f"__new.`{k}`").alias(k) for k in batch.columns])
    return save_table(new, name=None, mode="append", path=target, partition_by=partition_by)


def row_key(keys: list[str]) -> list[Column]:
    """128 bits of the key columns, NULLs told apart by their place."""
    parts = [c for k in keys for c in (F.col(f"`{k}`"), F.col(f"`{k}`").isNull())]
    return [F.xxhash64(F.lit(seed), *parts).alias(f"__key{seed}") for seed in (0, 1)]


def stored_months(batch: DataFrame, table: VersionedTable, month: str) -> DataFrame:
    """The stored rows of the batch's months: the other partitions are pruned
    before any file is opened."""
    months = [r[0] for r in batch.select(month).distinct().limit(MOST_MONTHS + 1).collect()]
    if len(months) > MOST_MONTHS:
        return table.read()
    named = F.col(month).isin([m for m in months if m is not None])
    return table.read().filter(named | F.col(month).isNull() if None in months else named)


def new_rows(batch: DataFrame, table: VersionedTable, keys: list[str] | None = None, month: str = "invoice_month") -> DataFrame:
    """The rows of ``batch``, one for each key, that ``table`` does not hold.
    The month is part of the key, so only its partitions need reading, and
    keys meet as two longs in place of all their columns."""
    keys = list(dict.fromkeys([*(keys or batch.columns), month]))
    key = ["__key0", "__key1"]
    new = batch.select("*", *row_key(keys))
    if set(keys) == set(batch.columns):  # whole rows are hashed, not sorted to keep the first of a key
        new = new.repartition(*key).dropDuplicates()
    else:
        new = new.dropDuplicates(key)
    if table.exists():
        new = new.join(stored_months(batch, table, month).select(*row_key(keys)), key, "left_anti")
    return new.select(*[f"`{c}`" for c in batch.columns])


def merge_new(batch: DataFrame, table: VersionedTable, keys: list[str] | None = None, month: str = "invoice_month",
              attempts: int = 5) -> int:
    """Append ``new_rows`` as the next version, partitioned by ``month``;
    returns rows appended.  A batch that finds another writer's version in
    its way is compared with it again, so no key is stored twice."""
    for _ in range(attempts):
        at = table.version()
        try:
            done = table.publish(new_rows(batch, table, keys, month), "append", [month], on_version=at.number if at else 0)
            return done.rows - (at.rows if at else 0)
        except ConcurrentWrite as exc:
            last = exc
    raise last


def foreach_batch_sink(target: str, keys: list[str] | None = None, partition_by: list[str] | None = None):
    """``writeStream.foreachBatch(...)`` callback performing ``append_new``."""

    def _sink(batch_df: DataFrame, batch_id: int) -> None:  # noqa: ARG001 - id unused: anti-join is idempotent
        append_new(batch_df, target, keys, partition_by)

    return _sink


def stream_order_lines(spark: SparkSession, landing_dir: str, target: str, checkpoint: str,
                       schema, fmt: str = "parquet", keys: list[str] | None = None):
    """Process every file currently in ``landing_dir`` once (availableNow)
    into ``target`` with keyed de-duplication; returns the finished query."""
    src = spark.readStream.schema(schema).format(fmt).load(landing_dir)
    q = (
        src.writeStream.foreachBatch(foreach_batch_sink(target, keys))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return q


def checkpoint_location(spark: SparkSession, name: str) -> str:
    from ..sources.io import checkpoint_dir

    return os.path.join(checkpoint_dir(spark), "streams", name)
