"""Helpers shared by the corpus operators: staged tables in the shared
folder, fixed-size bit sets, sorted group streaming and connected components."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.sources.io import checkpoint_dir

from .words import slices

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


class Workspace:
    """Intermediate tables under ``spark.checkpoint.dir`` (shared storage),
    each written once and read back: lineage is cut there, so a lost executor
    costs one stage.  ``drop`` removes tables nothing reads any more; the
    tables a returned plan reads stay until the caller calls ``close``."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _delete(self, path: str) -> None:
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)

    def drop(self, *names: str) -> None:
        for n in names:
            self._delete(self.path(n))

    def close(self) -> None:
        self._delete(self.base)


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def bit_set(df: DataFrame, slot: Column, bits: int) -> np.ndarray:
    """Bits 0..2**bits-1 with those of ``slot`` set: at most 2**bits/8 bytes
    whatever the input, so it may go to the driver and be broadcast.  Used as
    a filter that lets every member through and few others."""
    rows = (
        df.select(slot.alias("s"))
        .groupBy(F.shiftright("s", 6).alias("w"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(s & 63 as int))")).alias("b"))
        .toArrow()
    )
    out = np.zeros(max(1, 1 << (bits - 6)), dtype=np.int64)
    out[rows["w"].to_numpy()] = rows["b"].to_numpy()
    return out.view(np.uint64)


def has_bit(words: np.ndarray, slot: np.ndarray) -> np.ndarray:
    s = slot.astype(np.uint64, copy=False)
    return (words[(s >> np.uint64(6)).astype(np.int64)] >> (s & np.uint64(63))) & np.uint64(1) != 0


def sorted_groups(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Whole groups, in tables of one or more, from batches sorted by
    ``keys``; a group cut by the end of a batch waits for the next one."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        table = pa.Table.from_batches([*held, batch])
        n = table.num_rows
        differs = np.zeros(n, dtype=bool)
        for k in keys:
            col = table[k].combine_chunks()
            differs |= ~np.asarray(pc.equal(col, col[n - 1]).fill_null(False))
        last = int(np.flatnonzero(differs)[-1]) + 1 if differs.any() else 0
        if last:
            yield table.slice(0, last).combine_chunks()
        held = table.slice(last).combine_chunks().to_batches()
    if held:
        yield pa.Table.from_batches(held)


def group_starts(*columns: np.ndarray) -> np.ndarray:
    """Start of each run of equal rows, with the end appended."""
    n = len(columns[0])
    new = np.zeros(n, dtype=bool)
    if n:
        new[0] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.append(np.flatnonzero(new), n)


BLOCK_BITS = 16
RESULTS = 64  # tasks that return a table, so that each sends the driver little at a time
FLUSH = 1 << 21  # slots a task holds before it sends them


def slot_counts(df: DataFrame, slots: Callable[[pa.RecordBatch], np.ndarray], bits: int,
                at_least: tuple[int, ...] = ()) -> np.ndarray:
    """How often each of 2**bits hashed slots occurs, up to 255; or with
    ``at_least``, a bit set per threshold of the slots that reach it.

    ``slots`` gives a slice's slots, once per document.  Each task sums
    ``FLUSH`` of its own at a time and sends blocks of about 3 bytes a distinct
    slot; blocks are merged one at a time, so memory is bounded throughout.  The result is 2**bits bytes (or bits per
    threshold) whatever the input: it may go to the driver and be broadcast."""
    width = 1 << BLOCK_BITS

    def packed(total: np.ndarray) -> bytes:
        if at_least:
            return b"".join(np.packbits(total >= n, bitorder="little").tobytes() for n in at_least)
        return np.minimum(total, 255).astype(np.uint8).tobytes()

    def blocks(pending: list[np.ndarray]) -> pa.RecordBatch:
        slot, times = np.unique(np.concatenate(pending), return_counts=True)
        block = (slot >> np.uint64(BLOCK_BITS)).astype(np.int64)
        cut = group_starts(block)
        low, seen = (slot & np.uint64(width - 1)).astype(np.uint16), np.minimum(times, 255).astype(np.uint8)
        spans = list(zip(cut[:-1], cut[1:], strict=True))
        return pa.RecordBatch.from_arrays(
            [pa.array(block[cut[:-1]].astype(np.int32)), pa.array([low[a:b].tobytes() for a, b in spans], pa.binary()),
             pa.array([seen[a:b].tobytes() for a, b in spans], pa.binary())], ["block", "slot", "times"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending, held = [], 0
        for batch in batches:
            for part in slices(batch, "text"):
                pending.append(slots(part))
                held += len(pending[-1])
                if held >= FLUSH:
                    yield blocks(pending)
                    pending, held = [], 0
        if held:
            yield blocks(pending)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, np.zeros(width, np.int64)
        for batch in batches:
            for block, slot, times in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if block != now:
                    if now is not None:
                        yield pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([packed(total)])], ["block", "n"])
                    now, total = block, np.zeros(width, np.int64)
                total[np.frombuffer(slot, np.uint16)] += np.frombuffer(times, np.uint8)
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([packed(total)])], ["block", "n"])

    found = (
        df.mapInArrow(count, "block int, slot binary, times binary")
        .repartition(RESULTS, "block").sortWithinPartitions("block").mapInArrow(merge, "block int, n binary").toArrow()
    )
    each = width // 8 if at_least else width
    out = np.zeros((max(1, len(at_least)), (1 << bits) * each // width), np.uint8)
    for block, n in zip(found["block"], found["n"], strict=True):
        at = block.as_py() * each
        out[:, at:at + each] = np.frombuffer(n.as_buffer(), np.uint8).reshape(-1, each)
    del found
    pa.default_memory_pool().release_unused()  # the driver runs on for long
    return out.view(np.uint64) if at_least else out[0]


def _tangled(e: DataFrame) -> bool:
    """Whether some node hangs under two nodes, or hangs and also holds one;
    without such a node, edges a < b are stars around the least nodes."""
    ends = e.select(F.explode(F.array(F.struct(F.col("a").alias("v"), F.lit(0).alias("hangs")),
                                      F.struct(F.col("b").alias("v"), F.lit(1).alias("hangs")))).alias("x"))
    seen = ends.groupBy("x.v").agg(F.max("x.hangs").alias("hangs"), F.count(F.lit(1)).alias("n"))
    return seen.filter("hangs = 1 AND n > 1").agg(F.count(F.lit(1))).first()[0] > 0


def connected_components(ws: Workspace, edges: DataFrame, name: str) -> DataFrame:
    """(node, component) with component the smallest node reachable, for
    undirected edges (a, b) of longs.  Alternates large-star and small-star
    passes (Kiveris et al., 2014): every pass hangs nodes under smaller ones,
    rewrites at most as many edges as there were, and a hub's edges are only
    aggregated by ``min`` and joined, never gathered.  Ends when the edges
    are stars, which no further pass would change."""
    e = ws.stage(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                 .filter("a < b").distinct(), f"{name}-0")
    step = 0
    while _tangled(e):
        low = e.select(F.explode(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")),
                                         F.struct(F.col("b").alias("u"), F.col("a").alias("v")))).alias("x")).groupBy(
            F.col("x.u").alias("u")).agg(F.least(F.min("x.v"), F.min("x.u")).alias("m"))
        large = e.join(low, F.col("a") == F.col("u")).select(F.col("m").alias("a"), "b").distinct()
        low2 = large.groupBy(F.col("b").alias("u")).agg(F.min("a").alias("m"))
        small = large.join(low2, F.col("b") == F.col("u"))
        nxt = small.select(F.col("m").alias("a"), F.explode(F.array("a", "b")).alias("b")).filter("a < b").distinct()
        step += 1
        e = ws.stage(nxt, f"{name}-{step}")
        ws.drop(f"{name}-{step - 1}")
    return e.select(F.explode(F.array("a", "b")).alias("node"), F.col("a").alias("component")).distinct()


BROADCAST_IDS = 2_000_000  # so many ids (32 MB) are broadcast, more are shuffled


def without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id is not in ``ids`` (one column)."""
    ws = Workspace(docs.sparkSession, "without")
    gone = ws.stage(ids.toDF("__gone").filter("__gone is not null").distinct(), "ids")
    if gone.count() <= BROADCAST_IDS:
        gone = F.broadcast(gone)
    return docs.join(gone, F.col("doc_id") == F.col("__gone"), "left_anti")
