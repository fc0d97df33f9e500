"""Operator 5 - sharding by best-fit-decreasing bin packing.

Rows of equal text form an indivisible group.  Groups sorted by size, largest
first, enter the bin with the tightest room that still holds them, found in a
balanced tree.  For a given number of shards the least capacity that needs no
more bins is found by bisection.

Groups of equal size are interchangeable, so the packing runs on (size, count)
pairs: what a pair puts into one bin is one step, with the same outcome as
group by group.  The driver holds the pairs, at most sqrt(2 * bytes) as their
sizes differ, and the steps: each either ends a pair or leaves its bin less
room than one group, under half of what it had, so there are at most
pairs + log2(bytes) * bins.  The groups themselves stay in Spark: each gets its
rank among those of its size, and the rank falls into one step of the plan.

Spark does the work on rows: one narrow pass takes size, checksum and text
hash (texts are never shuffled), sums are pre-aggregated, and ranks and slots
are numbered inside cells whose offsets come from the cells' counts, so no
task sees a whole size or shard.  Groups with many rows or bytes meet their
shard by broadcast, the others by a shuffle of narrow rows.

No shard exceeds a given capacity, unless one row alone does.  A group larger
than a shard cannot stay whole; it alone is divided, into 64 parts for each
capacity it fills.  Defined results: a null text counts as an empty one; equal
texts, null and empty included, share a shard; repeated rows each get a slot;
an empty table gives no rows; other columns are ignored; a kept column named
like one of the result comes back as ``input_<name>``.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import accumulate, groupby

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Workspace

HOT_BYTES = 512  # a group of 1/HOT_BYTES of a shard,
HOT_ROWS = 4096  # or of 1/HOT_ROWS of all rows, meets its shard by broadcast
PARTS = 64  # a group above the capacity is cut into so many parts for each capacity it fills
RANKED = 65_536  # groups of one size that a ranking cell holds on average
CELLS = 512  # slot cells per shard
MAX_SHARDS = 4096  # bounds the plan the driver makes; more: shard in two levels


@dataclass(slots=True)
class _Node:
    key: tuple[int, int]
    rank: int
    left: _Node | None = None
    right: _Node | None = None


def _merge(a: _Node | None, b: _Node | None) -> _Node | None:
    if a is None or b is None:
        return a or b
    if a.rank < b.rank:
        a.right = _merge(a.right, b)
        return a
    b.left = _merge(a, b.left)
    return b


def _split(t: _Node | None, key: tuple[int, int]) -> tuple[_Node | None, _Node | None]:
    """Nodes below ``key`` and the others."""
    if t is None:
        return None, None
    if t.key < key:
        t.right, high = _split(t.right, key)
        return t, high
    low, t.left = _split(t.left, key)
    return low, t


class RoomTree:
    """Balanced tree (treap with hashed priorities) of (room, bin)."""

    def __init__(self) -> None:
        self.root: _Node | None = None

    def add(self, room: int, bin_: int) -> None:
        low, high = _split(self.root, (room, bin_))
        node = _Node((room, bin_), (room * 0x9E3779B1 ^ bin_ * 0x85EBCA77) * 0xC2B2AE35 & 0xFFFFFFFF)
        self.root = _merge(_merge(low, node), high)

    def take(self, size: int) -> tuple[int, int] | None:
        """Remove and return the bin with the least room of ``size`` or more."""
        low, high = _split(self.root, (size, -1))
        if high is None:
            self.root = low
            return None
        least = high
        while least.left is not None:
            least = least.left
        _, rest = _split(high, (least.key[0], least.key[1] + 1))
        self.root = _merge(low, rest)
        return least.key


Steps = list[list[tuple[int, int]]]  # for each run: (bin, how many), in turn


def fit_runs(runs: list[tuple[int, int]], capacity: int, most: int | None = None) -> Steps | None:
    """Where best fit puts each run of ``runs`` ((size, count), sizes falling),
    or None if it takes more than ``most`` bins.  A size above the capacity
    gets a bin of its own for each unit."""
    tree, bins, out = RoomTree(), 0, []
    for size, count in runs:
        steps = []
        while count:
            got = tree.take(size)
            if got is None:
                if most is not None and bins >= most:
                    return None
                got, bins = (max(capacity, size), bins), bins + 1
            room, bin_ = got
            n = min(count, room // size)  # with one unit less room the tightest bin stays the tightest
            steps.append((bin_, n))
            count -= n
            tree.add(room - n * size, bin_)
        out.append(steps)
    return out


def best_fit(sizes: list[int], capacity: int, most: int | None = None) -> list[int] | None:
    """Bin of each unit of ``sizes`` (falling), or None as ``fit_runs``."""
    return _each(fit_runs([(s, len(list(g))) for s, g in groupby(sizes)], capacity, most))


def _each(steps: Steps | None) -> list[int] | None:
    return None if steps is None else [b for run in steps for b, n in run for _ in range(n)]


def pack_runs(runs: list[tuple[int, int]], shards: int | None, capacity: int | None) -> Steps:
    """Steps of the runs.  With ``capacity``: as few bins as best fit needs.
    With ``shards``: the least capacity (to one part in 2**14 of the mean)
    for which best fit needs no more bins."""
    if not runs:
        return []
    if capacity is not None:
        return fit_runs(runs, capacity)
    total = sum(size * count for size, count in runs)
    low = max(-(-total // shards), runs[0][0])
    step = max(1, low >> 14)
    high, found = low, fit_runs(runs, low, shards)
    while found is None:
        low, high, step = high, high + step, step * 2
        found = fit_runs(runs, high, shards)
    while high - low > max(1, high >> 14):
        mid = (low + high) // 2
        got = fit_runs(runs, mid, shards)
        if got is None:
            low = mid
        else:
            high, found = mid, got
    return found


def pack(sizes: list[int], shards: int | None, capacity: int | None) -> list[int]:
    """Bin of each unit of ``sizes`` (falling), as ``pack_runs``."""
    return _each(pack_runs([(s, len(list(g))) for s, g in groupby(sizes)], shards, capacity))


def _step_of(rank: Column, ends: Column) -> Column:
    """How many of the rising ``ends`` are not above ``rank``: binary search,
    2**20 ends at most."""
    size = F.size(ends)

    def closer(low: Column, jump: Column) -> Column:
        at = low + jump
        return F.when((at <= size) & (F.get(ends, F.least(at, size) - 1) <= rank), at).otherwise(low)

    return F.aggregate(F.array(*[F.lit(1 << k) for k in range(20, -1, -1)]), F.lit(0), closer)


def _ranked(units: DataFrame, ws: Workspace, by: str, cells: Column, order: list[str], bounded: bool) -> DataFrame:
    """``units`` with ``__rank``, counted from 0 among the rows of one ``by``:
    the rank in a hash cell (``__cell``, of ``cells``) and the cells before."""
    before = Window.partitionBy(by).orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
    celled = ws.stage(units.withColumn("__cell", cells), f"ranked-{by}")
    offsets = celled.groupBy(by, "__cell").agg(F.count(F.lit(1)).alias("__n")).select(
        by, "__cell", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    if bounded:  # CELLS a shard
        offsets = F.broadcast(offsets)
    inside = Window.partitionBy(by, "__cell").orderBy(*order)
    return celled.withColumn("__at", F.row_number().over(inside)).join(offsets, [by, "__cell"]).withColumn(
        "__rank", (F.col("__before") + F.col("__at") - 1).cast("long")).drop("__before", "__at", "__cell")


def assign_shards(docs: DataFrame, shards: int | None = None, capacity: int | None = None,
                  keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) for every row, and the columns
    of ``keep``.  Give the number of ``shards`` or the ``capacity`` in bytes
    of one."""
    if (shards is None) == (capacity is None):
        raise ValueError("give either shards or capacity")
    spark = docs.sparkSession
    ws = Workspace(spark, "sharding")
    text = F.coalesce(F.col("text"), F.lit(""))
    kept = [F.col(c).alias(f"__keep{i}") for i, c in enumerate(keep)]
    rows = ws.stage(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), *kept,
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("__g1"), F.xxhash64(F.lit(7), text).alias("__g2"),
        F.monotonically_increasing_id().alias("__row"),  # written, so a rerun task reads the same
    ), "rows")
    total, n_rows = (x or 0 for x in rows.agg(F.sum("size"), F.count(F.lit(1))).first())
    each = capacity or max(1, -(-total // shards))
    if shards is None and total // each > MAX_SHARDS or shards is not None and shards > MAX_SHARDS:
        raise ValueError(f"more than {MAX_SHARDS} shards: shard within hash parts of the table")
    groups = ws.stage(rows.groupBy("__g1", "__g2").agg(F.sum("size").alias("__b"), F.count(F.lit(1)).alias("__c")), "groups")
    parts = F.when(F.col("__b") > each, F.ceil(F.col("__b") / F.lit(each)) * PARTS).otherwise(1).cast("long")
    # at most HOT_BYTES groups for each shard's bytes and HOT_ROWS others, so the side may be broadcast
    hot = F.broadcast(ws.stage(groups.filter((F.col("__b") * HOT_BYTES >= each) | (F.col("__c") * HOT_ROWS >= n_rows))
                               .select("__g1", "__g2", parts.alias("__parts")), "hot"))
    marked = rows.join(hot, ["__g1", "__g2"], "left")
    warm = marked.filter("__parts is not null").withColumn("__part", F.pmod(F.xxhash64("__row", "__g1"), F.col("__parts")))
    units = (
        groups.join(hot, ["__g1", "__g2"], "left_anti").select("__g1", "__g2", F.lit(0).cast("long").alias("__part"), F.col("__b").alias("__size"))
        .unionByName(warm.groupBy("__g1", "__g2", "__part").agg(F.sum("size").alias("__size")))
    )
    units = ws.stage(units, "units")
    runs = sorted(map(tuple, units.groupBy("__size").agg(F.count(F.lit(1))).collect()), reverse=True)  # distinct sizes
    plan = []
    for (size, count), steps in zip(runs, pack_runs(runs, shards, capacity), strict=True):
        plan.append((size, -(-count // RANKED), list(accumulate(n for _, n in steps)), [b for b, _ in steps]))
    plan = spark.createDataFrame(plan, "__size long, __cells long, __ends array<long>, __bins array<int>")
    ranked = _ranked(
        units.join(F.broadcast(plan.select("__size", "__cells")), "__size"), ws, "__size",
        F.pmod(F.xxhash64("__g1", "__g2", "__part"), F.col("__cells")), ["__g1", "__g2", "__part"], False)
    placed = ws.stage(ranked.join(F.broadcast(plan.select("__size", "__ends", "__bins")), "__size").select(
        "__g1", "__g2", "__part", F.get("__bins", _step_of(F.col("__rank"), F.col("__ends"))).alias("shard")), "placed")
    names = ["doc_id", *[f"__keep{i}" for i in range(len(keep))], "size", "text_crc32", "shard"]
    cold = marked.filter("__parts is null").join(placed, ["__g1", "__g2"])
    warm = warm.join(F.broadcast(placed.join(hot, ["__g1", "__g2"], "left_semi")), ["__g1", "__g2", "__part"])
    out = _ranked(cold.select(*names).unionByName(warm.select(*names)), ws, "shard",
                  F.pmod(F.xxhash64("doc_id"), F.lit(CELLS)), ["doc_id", "text_crc32"], True)
    ws.drop("rows", "groups", "hot", "units", "ranked-__size", "placed")
    clash = {"doc_id", "size", "text_crc32", "shard", "slot"}
    return out.select("doc_id", *[F.col(f"__keep{i}").alias(f"input_{c}" if c in clash else c) for i, c in enumerate(keep)],
                      "size", "text_crc32", "shard", F.col("__rank").alias("slot"))


def with_law(assigned: DataFrame) -> DataFrame:
    """The result in the reporting form: by bytes, so nothing grows by key."""
    return assigned.withColumn("law", F.lit("bytes")).withColumn("grown_shard", F.lit(None).cast(T.IntegerType()))
