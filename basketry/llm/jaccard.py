"""Operator 3 - n-gram Jaccard join in size-banded tiles with bitmaps.

A document's set holds the hashes of its distinct word shingles.  Two sets of
Jaccard similarity t or more share at least one of their first
n - ceil(t n) + 1 shingles in any common order.  The order used puts rare
shingles first (by steps of their counts over all documents), so most documents
share no such shingle with any other and only related ones become candidates.

1. One pass gives each document its set size and a fingerprint of its set.
   Equal sets collapse to one representative (the least doc_id), so copies
   never meet as pairs.
2. Rare-first order: a quarter of the representatives' shingles (and as many
   others as a small set's first ones need) go to buckets by hash, seven bytes
   each, and are counted there exactly; buckets grow in number with the input,
   and no table of counts is gathered.  What only one set holds ends there; the
   rest goes back to its documents, which keep their first ones.
3. Under a shared shingle, sets in order of size form a run while each size
   allows a link to the next; each hangs on its run's first.  Two sets whose
   sizes allow a link are always in one run, so connected runs enclose all
   links.
4. Each such group is cut into size bands (ratio t) and these into blocks of
   bounded volume; only tiles of equal or neighbouring bands are made, so
   each pair meets in exactly one.  In a tile a bitmap per set bounds the
   overlap from above (bits that differ are shingles that differ); every pair
   that passes is decided by exact intersection of the sorted arrays.
5. A tile returns a number of links per set, each counted with the copies of
   its partner, and links that span its components; connected components
   finish.

No pair leaves a tile: runs are linear, and a tile returns at most one link and
one number per set.  Counting the links of a group compares all its sets whose
sizes allow a link; a set is sent once for each block of its bands.  Shingles
are compared as 64-bit hashes.

Defined results: null, empty or blank texts have an empty set, no links and
their own component; texts with fewer words than a shingle have the whole
sequence as their one shingle; repeated rows share a component and count as
links; texts that share a doc_id are compared one by one and share its
component; other columns are ignored; rows without doc_id are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Workspace, bit_set, connected_components, group_starts, has_bit, sorted_groups, without
from .words import Words, batch_words, grams, mix64, slices

BUCKET = 1 << 18  # shingles counted together, on average
BUCKET_BITS = 16  # at most so many bits of a shingle name its bucket
CODE, QUARTER = 24, np.uint64(1 << 38)  # a shingle's upper 40 bits are its code; counted are those of the first quarter
CHUNK, CHUNK_SHINGLES = (1 << 16) - 1, 1 << 20  # documents whose shingles are sent together, and the shingles
LAST = 255  # the rank of shingles outside the quarter
PLAN_BYTES = 32 << 20  # a tile plan of so many bytes is broadcast, a larger one shuffled
BLOCK_SETS, BLOCK_SHINGLES = 4096, 1 << 18  # a block's volume, on average
HOT_ROWS = 4096  # classes of 1/HOT_ROWS of all rows meet them by broadcast
NODE_BITS = 24


@dataclass(frozen=True)
class Similarity:
    shingle: int = 5
    percent: int = 80

    def prefix(self, n: int) -> int:
        return n - -(-self.percent * n // 100) + 1


def shingle_sets(w: Words, k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each document."""
    g, out = grams(w.hash, k), []
    for a, b in zip(w.first[:-1], w.first[1:], strict=True):
        n = b - a
        if n >= k:
            out.append(np.unique(g[a:b - k + 1]))
        else:
            out.append(mix64(grams(w.hash[a:b], n) + np.uint64(n)) if n else np.zeros(0, np.uint64))
    return out


def _sampled(s: np.ndarray) -> int:
    """How many of the sorted hashes are in the quarter that is counted."""
    return int(np.searchsorted(s, QUARTER << np.uint64(CODE)))


def _codes(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 5, 8), dtype=np.uint8)
    out[:, :5] = np.frombuffer(data, np.uint8).reshape(-1, 5)
    return out.view(np.uint64)[:, 0]


def pack_chunk(chunk: int, sets: list[np.ndarray], heads: list[tuple[int, int, int, int]], bits: int) -> pa.RecordBatch:
    """A chunk's shingles by bucket, as codes and places of their documents,
    and a row with the documents (id, fingerprint, size, counted shingles)."""
    s = np.concatenate(sets)
    of = np.repeat(np.arange(len(sets), dtype=np.uint16), [len(x) for x in sets])
    bucket = (s & np.uint64((1 << bits) - 1)).astype(np.uint16)
    order = np.argsort(bucket, kind="stable")
    bucket, of, code = bucket[order], of[order], (s[order] >> np.uint64(CODE)).view(np.uint8).reshape(-1, 8)[:, :5]
    cut = group_starts(bucket)
    spans = list(zip(cut[:-1], cut[1:], strict=True))
    return pa.RecordBatch.from_arrays(
        [pa.array([*bucket[cut[:-1]].tolist(), chunk % (1 << bits)], pa.int32()), pa.array([chunk] * (len(spans) + 1), pa.int64()),
         pa.array([*(code[a:b].tobytes() for a, b in spans), None], pa.binary()),
         pa.array([*(of[a:b].tobytes() for a, b in spans), np.array(heads, np.int64).tobytes()], pa.binary())],
        ["bucket", "chunk", "codes", "docs"])


def shared_codes(codes: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of each part of a bucket, the places whose code occurs again in the
    bucket and the rank of each: the binary digits of its count."""
    every = np.concatenate(codes)
    order = np.argsort(every, kind="stable")
    times = np.diff(group_starts(every[order]))
    rank = np.empty(len(every), np.uint8)
    rank[order] = np.repeat(np.where(times > 1, np.frexp(times)[1], 0), times)
    out = []
    for part in np.split(rank, np.cumsum([len(c) for c in codes])[:-1]):
        at = np.flatnonzero(part)
        out.append((at, part[at]))
    return out


def first_shingles(heads: np.ndarray, of: np.ndarray, token: np.ndarray, rank: np.ndarray, sim: Similarity) -> tuple[np.ndarray, np.ndarray]:
    """(document, token) of the shared ones among each document's first
    shingles: counted ones by rank and token, those of one set only before all
    others, and then the rest."""
    counted = token < (int(QUARTER) << BUCKET_BITS)
    rank = np.where(counted, np.minimum(rank, LAST - 1), LAST)
    order = np.lexsort((token, rank, of))
    of, token, counted = of[order], token[order], counted[order]
    alone = heads[:, 3] - np.bincount(of[counted], minlength=len(heads))
    cut = group_starts(of)
    place = np.arange(len(of)) - np.repeat(cut[:-1], np.diff(cut))
    keep = ~counted | (place < (sim.prefix(heads[:, 2]) - alone)[of])
    return of[keep], token[keep]


def fingerprint(s: np.ndarray) -> int:
    m = mix64(s)
    total = np.array([m.sum(dtype=np.uint64), np.bitwise_xor.reduce(mix64(m)) if len(m) else 0, len(s)], dtype=np.uint64)
    return int(grams(total, 3).view(np.int64)[0])


def bitmaps(sets: list[np.ndarray]) -> np.ndarray:
    """A row of bits per set: shingles hashed to 2 to 4 times as many places
    as the largest set has members (256 to 65,536)."""
    width = 1 << int(np.clip(np.ceil(np.log2(2 * max(map(len, sets)) + 1)), 8, 16))
    out = np.zeros((len(sets), width), dtype=bool)
    for i, s in enumerate(sets):
        out[i, (mix64(s) & np.uint64(width - 1)).astype(np.int64)] = True
    return np.packbits(out, axis=1).view(np.uint64)


def tile_links(nodes: np.ndarray, part: np.ndarray, copies: np.ndarray, within: bool, sets: list[np.ndarray],
               percent: int) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Of the pairs of different parts (of all parts if ``within``): links that
    span the components, and per set its links, weighted by partner copies."""
    n = len(nodes)
    size = np.fromiter(map(len, sets), dtype=np.int64, count=n)
    order = np.argsort(size, kind="stable")
    node, part, copies, size = nodes[order], part[order], copies[order], size[order]
    first = np.concatenate(([0], np.cumsum(size)))
    values, ids = np.unique(np.concatenate([sets[i] for i in order]), return_inverse=True)
    bits, root, out, count = bitmaps([sets[i] for i in order]), np.arange(n), [], np.zeros(n, np.int64)
    mine = np.zeros(len(values), dtype=bool)
    for i in range(n):
        last = int(np.searchsorted(size, 100 * size[i] // percent, side="right"))
        other = np.arange(i + 1, last)
        if not within:
            other = other[part[other] != part[i]]
        if not len(other):
            continue
        apart = np.bitwise_count(bits[other] ^ bits[i]).sum(axis=1, dtype=np.int64)
        both = size[other] + size[i]
        bound = (both - apart) // 2  # at most so many in common
        other = other[(100 + percent) * bound >= percent * both]
        if not len(other):
            continue
        own = ids[first[i]:first[i + 1]]
        mine[own] = True
        if 2 * len(other) > last - i:  # most of a range: one sweep
            common = np.add.reduceat(mine[ids[first[i + 1]:first[last]]], first[i + 1:last] - first[i + 1], dtype=np.int64)[other - i - 1]
        else:
            common = np.array([np.count_nonzero(mine[ids[first[j]:first[j + 1]]]) for j in other])
        mine[own] = False
        linked = other[(100 + percent) * common >= percent * (size[other] + size[i])]
        count[i] += copies[linked].sum()
        count[linked] += copies[i]
        for j in linked[root[linked] != root[i]]:
            if root[j] != root[i]:
                out.append((int(node[i]), int(node[j])))
                root[root == root[j]] = root[i]
    back = np.empty(n, np.int64)
    back[order] = count
    return out, back


def first_tokens(source: DataFrame, classes: DataFrame, kept: Broadcast, sim: Similarity) -> DataFrame:
    """(node, fp, n, tokens) of the representatives ``classes`` (node, fp, n):
    those of a set's first shingles that another set holds, too.  ``kept`` is
    a bit set of them; a few copies it lets through come along."""
    total = classes.agg(F.sum("n")).first()[0] or 0
    bits = int(np.clip(np.ceil(np.log2(max(1, total / 4 / BUCKET))), 3, BUCKET_BITS))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, chunks, sets, heads, held = TaskContext.get().partitionId(), 0, [], [], 0
        for batch in batches:
            some = batch.filter(pa.array(has_bit(kept.value, batch.column(2).to_numpy())))
            for part in slices(some, "text"):
                for doc, s in zip(part.column(0).to_pylist(), shingle_sets(batch_words(part.column(1), lower=True), sim.shingle), strict=True):
                    if not len(s):
                        continue
                    n = _sampled(s)
                    sets.append(s[:max(n, sim.prefix(len(s)))].copy())
                    heads.append((doc, fingerprint(s), len(s), n))
                    held += len(sets[-1])
                    if held >= CHUNK_SHINGLES or len(sets) == CHUNK:
                        yield pack_chunk(task << 32 | chunks, sets, heads, bits)
                        chunks, sets, heads, held = chunks + 1, [], [], 0
        if sets:
            yield pack_chunk(task << 32 | chunks, sets, heads, bits)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in sorted_groups(batches, ["bucket"]):
            cut = group_starts(table["bucket"].to_numpy())
            for a, b in zip(cut[:-1], cut[1:], strict=True):
                rows = table.slice(a, b - a).to_pylist()
                yield pa.RecordBatch.from_pylist([{"chunk": r["chunk"], "docs": r["docs"]} for r in rows if r["codes"] is None], back)
                rows, bucket = [r for r in rows if r["codes"] is not None], rows[0]["bucket"]
                if not rows:
                    continue
                codes, out = [_codes(r["codes"]) for r in rows], []
                for row, code, (at, rank) in zip(rows, codes, shared_codes(codes), strict=True):
                    if len(at):
                        token = code[at].astype(np.int64) << BUCKET_BITS | bucket
                        out.append({"chunk": row["chunk"], "docs": np.frombuffer(row["docs"], np.uint16)[at].tobytes(),
                                    "tokens": token.tobytes(), "ranks": rank.tobytes()})
                yield pa.RecordBatch.from_pylist(out, back)
                pa.default_memory_pool().release_unused()

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in sorted_groups(batches, ["chunk"]):
            cut = group_starts(table["chunk"].to_numpy())
            for a, b in zip(cut[:-1], cut[1:], strict=True):
                rows = table.slice(a, b - a).to_pylist()
                heads = np.concatenate([np.frombuffer(r["docs"], np.int64) for r in rows if r["tokens"] is None]).reshape(-1, 4)
                rows = [r for r in rows if r["tokens"] is not None]
                if not rows:
                    continue
                of, token, rank = (np.concatenate([np.frombuffer(r[c], t) for r in rows])
                                   for c, t in (("docs", np.uint16), ("tokens", np.int64), ("ranks", np.uint8)))
                of, token = first_shingles(heads, of.astype(np.int64), token, rank, sim)
                cuts = group_starts(of)
                some = heads[of[cuts[:-1]]]
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(some[:, c]) for c in range(3)), pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(token))],
                    ["node", "fp", "n", "tokens"])

    back = pa.schema([("chunk", pa.int64()), ("docs", pa.binary()), ("tokens", pa.binary()), ("ranks", pa.binary())])
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(1 << NODE_BITS))
    packed = source.withColumn("slot", slot).mapInArrow(pack, "bucket int, chunk long, codes binary, docs binary")
    counted = packed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(count, "chunk long, docs binary, tokens binary, ranks binary")
    return counted.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(choose, "node long, fp long, n long, tokens array<long>")


def similar_documents(docs: DataFrame, sim: Similarity | None = None) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links) for every row with a doc_id."""
    sim = sim or Similarity()
    spark = docs.sparkSession
    ws = Workspace(spark, "jaccard")
    source = docs.select(F.col("doc_id").cast("long"), F.col("text")).filter("doc_id is not null")
    k, percent = sim.shingle, sim.percent

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingle_sets(batch_words(part.column(1), lower=True), k)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([fingerprint(s) for s in sets], pa.int64())], ["doc", "n", "fp"])

    members = ws.stage(source.mapInArrow(describe, "doc long, n long, fp long"), "members")
    classes = members.filter("n > 0").groupBy("fp").agg(
        F.min("doc").alias("node"), F.min("n").alias("n"), F.count(F.lit(1)).alias("copies"))
    classes = ws.stage(classes, "classes")
    kept = spark.sparkContext.broadcast(bit_set(classes, F.pmod(F.xxhash64("node"), F.lit(1 << NODE_BITS)), NODE_BITS))
    tokens = first_tokens(source, classes, kept, sim).join(classes.select("node", "fp"), ["node", "fp"]).select(
        "node", "n", F.explode("tokens").alias("token"))
    by_size = Window.partitionBy("token").orderBy("n", "node")
    apart = F.coalesce(100 * F.lag("n").over(by_size) < percent * F.col("n"), F.lit(False)).cast("int")
    chain = (
        tokens.withColumn("apart", apart).withColumn("run", F.sum("apart").over(by_size))
        .withColumn("a", F.first("node").over(Window.partitionBy("token", "run").orderBy("n", "node")))
        .filter("a <> node").select("a", F.col("node").alias("b"))
    )
    groups = connected_components(ws, chain, "chains").withColumnRenamed("component", "group")
    kept.destroy()
    wanted = spark.sparkContext.broadcast(bit_set(groups, F.pmod(F.xxhash64("node"), F.lit(1 << NODE_BITS)), NODE_BITS))

    def arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part_of = batch.filter(pa.array(has_bit(wanted.value, batch.column(2).to_numpy())))
            for part in slices(part_of, "text"):
                sets = shingle_sets(batch_words(part.column(1), lower=True), k)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([fingerprint(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())],
                    ["node", "fp", "shingles"])

    # tiles are planned on narrow rows; the arrays move once, to their tiles
    sized = groups.join(classes, "node").withColumn(
        "band", F.floor(F.log("n") / F.log(F.lit(100.0 / percent))).cast("int"))
    width = sized.groupBy("group", "band").agg(F.ceil(F.greatest(
        F.count(F.lit(1)) / F.lit(BLOCK_SETS), F.sum("n") / F.lit(BLOCK_SHINGLES))).cast("int").alias("blocks"))
    upper = width.select("group", (F.col("band") - 1).alias("band"), F.col("blocks").alias("above"))
    lower = width.select("group", (F.col("band") + 1).alias("band"), F.col("blocks").alias("below"))
    row = lambda near, x, y: F.struct(near.alias("band"), x.alias("x"), y.alias("y"))
    up_to = lambda n: F.sequence(F.lit(0), F.coalesce(n, F.lit(0)) - 1)
    own, band = F.col("block"), F.col("band")
    plan = ws.stage(
        sized.join(width, ["group", "band"]).join(upper, ["group", "band"], "left").join(lower, ["group", "band"], "left")
        .withColumn("block", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
        .select("node", "fp", "copies", "group", (band * 100003 + own).alias("part"), F.concat(
            # bands are doubled: even ones hold a band's own tiles, odd ones those with the next band
            F.transform(up_to(F.col("blocks")), lambda x: row(band * 2, F.least(own, x), F.greatest(own, x))),
            F.when(F.col("above") > 0, F.transform(up_to(F.col("above")), lambda x: row(band * 2 + 1, own, x))).otherwise(F.array()),
            F.when(F.col("below") > 0, F.transform(up_to(F.col("below")), lambda x: row(band * 2 - 1, x, own))).otherwise(F.array()),
        ).alias("tiles")), "plan")
    size = plan.agg(F.sum(64 + 24 * F.size("tiles"))).first()[0] or 0
    if size <= PLAN_BYTES:
        plan = F.broadcast(plan)
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(1 << NODE_BITS))
    tiles = (
        source.withColumn("slot", slot).mapInArrow(arrays, "node long, fp long, shingles binary")
        .join(plan, ["node", "fp"])  # exact; the bit set lets a few others through
        .withColumn("tile", F.explode("tiles"))
        .select("group", F.col("tile.band").alias("t"), F.col("tile.x").alias("x"), F.col("tile.y").alias("y"), "part", "node", "fp", "copies", "shingles")
    )
    keys = ["group", "t", "x", "y"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in sorted_groups(batches, keys):
            cut = group_starts(*(table[c].to_numpy() for c in keys))
            found, fps, counts_ = [], [], []
            for a, b in zip(cut[:-1], cut[1:], strict=True):
                tile = table.slice(a, b - a)
                _, once = np.unique(np.column_stack((tile["node"].to_numpy(), tile["fp"].to_numpy())), axis=0, return_index=True)
                tile = tile.take(once)  # a repeated row of a representative comes again
                within = tile["t"][0].as_py() % 2 == 0 and tile["x"][0] == tile["y"][0]
                links, count = tile_links(
                    tile["node"].to_numpy(), tile["part"].to_numpy(), tile["copies"].to_numpy(), within,
                    [np.frombuffer(x.as_buffer(), np.uint64) for x in tile["shingles"]], percent)
                found += links
                fps.append(tile["fp"].to_numpy()[count > 0])
                counts_.append(count[count > 0])
            fps, counts_ = np.concatenate(fps), np.concatenate(counts_)
            none = [None] * len(found), [None] * len(fps)
            yield pa.RecordBatch.from_arrays(
                [pa.array([*(a for a, _ in found), *none[1]], pa.int64()), pa.array([*(b for _, b in found), *none[1]], pa.int64()),
                 pa.array([*none[0], *fps.tolist()], pa.int64()), pa.array([*none[0], *counts_.tolist()], pa.int64())],
                ["a", "b", "fp", "links"])

    found = ws.stage(tiles.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(compare, "a long, b long, fp long, links long"), "found")
    wanted.destroy()
    labels = connected_components(ws, found.filter("a is not null").select("a", "b"), "links")
    number = found.filter("fp is not null").groupBy("fp").agg(F.sum("links").alias("links"))
    known = ws.stage(
        classes.join(number, "fp", "left").join(labels, "node", "left").select(
            "fp", "copies", F.coalesce("component", "node").alias("component"),
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links")), "known")
    rows = members.filter("n > 0").select("doc", "n", "fp")
    least = -(-members.count() // HOT_ROWS)
    hot = F.broadcast(known.filter(F.col("copies") >= least))  # HOT_ROWS at most
    return (
        rows.join(hot, "fp").unionByName(rows.join(hot, "fp", "left_anti").join(known.filter(F.col("copies") < least), "fp"))
        .select("doc", "n", "component", "links")
        .unionByName(members.filter("n = 0").select("doc", "n", F.col("doc").alias("component"), F.lit(0).cast("long").alias("links")))
        .toDF("doc_id", "n_shingles", "component_id", "n_links")
    )


def one_per_group(docs: DataFrame, sim: Similarity | None = None) -> DataFrame:
    """The rows of ``docs`` whose doc_id is the least of its component."""
    return without(docs, similar_documents(docs, sim).filter("doc_id <> component_id").select("doc_id"))
