"""Gradient-boosted trees of several models in the same passes.

A cross-validation fits as many ensembles as it has folds, of nearly the same
rows.  Here they grow together: a task keeps its rows in blocks, as places
between the split points of all models, with the margins of every model.  One
pass a level adds up the (weight, residual) histograms of all models, and the
best splits follow from their sums, which are bounded by tasks x nodes x
features x bins.  Of two siblings only the lighter one is counted, the other
is the parent's rest.

The method is that of Spark's ``GBTClassifier``: log loss on margins, the
first tree on the labels with weight 1, variance gain, candidate splits from
weighted quantiles of max(bins^2, 10,000) training rows a model, rows drawn
without replacement for every tree and features for every node.  Row order
and bags depend on the key and the parallelism alone, not on the input's
partitions.  ``as_model`` gives the trees as a Spark model.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import COL_CUSTOMER_ID, ChurnConfig
from ..session import default_parallelism
from ..sources.io import checkpoint_dir

CUST = COL_CUSTOMER_ID
BLOCK = 1 << 15  # rows worked on at a time
PART = 1 << 20  # rows of a task, at most about
CHECKPOINT = 50  # trees between two checkpoints of the margins
SPLIT_ROWS = 10_000
NO_CUT = 1 << 30


@dataclass
class Tree:
    """Nodes in heap order (root 1, children 2i and 2i + 1).  A leaf above the
    last level sends its rows left, where they meet its own value again."""

    feature: np.ndarray
    cut: np.ndarray  # places up to the cut go left
    threshold: np.ndarray
    leaf: np.ndarray
    weight: np.ndarray
    total: np.ndarray  # weighted residuals
    gain: np.ndarray
    rows: np.ndarray  # drawn rows and their weighted squared residuals,
    square: np.ndarray  # for a model that is ``counted``

    @classmethod
    def empty(cls, depth: int) -> Tree:
        n = 2 << depth
        zero = [np.zeros(n) for _ in range(6)]
        return cls(np.zeros(n, np.int64), np.full(n, NO_CUT), zero[0], np.ones(n, bool), *zero[1:])

    @property
    def value(self) -> np.ndarray:
        return self.total / np.where(self.weight > 0, self.weight, 1.0)


@dataclass
class Boosted:
    """Trees of every model (``trees[t][m]``) and the blocks with the margins
    after the last tree."""

    trees: list[list[Tree]]
    blocks: RDD
    rate: float

    def held_out(self, spark: SparkSession, label: str) -> DataFrame:
        """(fold, label, margin): every held-out row, scored by the model that
        did not see it."""

        def pack(rows):
            for _, fold, y, _, margin, _ in rows:
                for m in range(len(margin)):
                    own = fold == m
                    if own.any():
                        yield m, bytearray(y[own].astype(np.int8).tobytes()), bytearray(margin[m][own].tobytes())

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for m, y, margin in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    y = np.frombuffer(y, np.int8).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(y), m, np.int32)), pa.array(y), pa.array(np.frombuffer(margin))], ["fold", label, "margin"])

        packed = spark.createDataFrame(self.blocks.mapPartitions(pack), "fold int, y binary, margin binary")
        return packed.mapInArrow(rows, f"fold int, `{label}` int, margin double")


def split_points(values: np.ndarray, weights: np.ndarray, bins: int) -> np.ndarray:
    """Thresholds between distinct values, near equal weights apart: every
    midpoint if there are fewer than ``bins`` distinct values."""
    v, at = np.unique(values, return_inverse=True)
    if len(v) <= bins:
        return (v[:-1] + v[1:]) / 2.0
    upto = np.cumsum(np.bincount(at, weights))
    stride = upto[-1] / bins
    out, target = [], stride
    for i in range(1, len(v)):
        if abs(upto[i - 1] - target) < abs(upto[i] - target):
            out.append((v[i - 1] + v[i]) / 2.0)
            target += stride
    return np.array(out)


def _thresholds(df: DataFrame, features: list[str], label: str, models: list[float], bins: int, seed: int, rows: int):
    """Per model and feature the split points of its own training rows."""
    fraction = min(1.0, max(bins * bins, SPLIT_ROWS) / max(rows, 1))
    few = (df if fraction == 1.0 else df.sample(fraction, seed)).select("fold", label, *features).toArrow()
    fold, y, x = few["fold"].to_numpy(), few[label].to_numpy(), [few[c].to_numpy() for c in features]
    return [[split_points(c[fold != m], np.where(y[fold != m] == 1, w, 1.0), bins) for c in x] for m, w in enumerate(models)]


def _blocks(df: DataFrame, features: list[str], label: str, edges: list[np.ndarray], n_models: int, parts: int) -> RDD:
    """((task, block), fold, label, places, margins by model, leaves of the
    last tree by model)."""
    order = [CUST] if CUST in df.columns else [label, *features]
    placed = df.repartition(parts, *order).sortWithinPartitions(*order).select("fold", label, *features)
    place = np.uint8 if max(map(len, edges)) < 256 else np.uint16

    def placing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block(t: pa.Table) -> pa.RecordBatch:
            x = np.stack([np.searchsorted(e, t[c].to_numpy(), "left").astype(place) for e, c in zip(edges, features, strict=True)])
            cols = t["fold"].to_numpy().astype(np.int16), t[label].to_numpy().astype(np.int8), x
            return pa.RecordBatch.from_arrays([pa.array([c.tobytes()], pa.binary()) for c in cols], ["fold", "y", "x"])

        held, n = [], 0
        for b in batches:
            held.append(b)
            n += b.num_rows
            if n >= BLOCK:
                yield block(pa.Table.from_batches(held))
                held, n = [], 0
        if n:
            yield block(pa.Table.from_batches(held))

    def arrays(part: int, rows):
        for i, r in enumerate(rows):
            fold = np.frombuffer(bytes(r["fold"]), np.int16)
            x = np.frombuffer(bytes(r["x"]), place).reshape(len(edges), len(fold))
            yield (part, i), fold, np.frombuffer(bytes(r["y"]), np.int8) == 1, x, np.zeros((n_models, len(fold))), None

    return placed.mapInArrow(placing, "fold binary, y binary, x binary").rdd.mapPartitionsWithIndex(arrays, True)


def _down(x: np.ndarray, tree: Tree, rows: np.ndarray, levels: int) -> np.ndarray:
    """The node of every row after ``levels`` splits."""
    at = np.ones(len(rows), np.int64)
    flat, start = x.reshape(-1), tree.feature * x.shape[1]
    for _ in range(levels):
        at = 2 * at + (flat.take(start.take(at) + rows) > tree.cut.take(at))
    return at


def _drawn(block, m: int, t: int, weight: float, cfg: ChurnConfig):
    """Rows that tree ``t`` of model ``m`` learns from, their weights and
    residuals."""
    at, fold, y, _, margin, _ = block
    learns = fold != m
    if cfg.subsample < 1:
        learns = learns & (np.random.default_rng([cfg.random_state, t, m, *at]).random(len(fold), np.float32) < cfg.subsample)
    rows = np.flatnonzero(learns)
    sign = np.where(y[rows], 1.0, -1.0)
    r = sign if t == 0 else 4.0 * sign / (1.0 + np.exp(2.0 * sign * margin[m][rows]))
    return rows, np.where(sign > 0, weight, 1.0), r


def _histograms(blocks, t, level, trees, slots, weights, bin_of, bins, cfg):
    """Per model [weight or residual, counted node, feature, bin] of one task,
    before them the leaves of the last tree.  A table of two features' bins
    gives the sums of both."""
    held, leaves, n_features = {}, None, bin_of.shape[1]
    for block in blocks:
        x = block[3]
        if level == 0 and block[5] is not None:
            leaves = block[5] if leaves is None else leaves + block[5]
        for m, tree in enumerate(trees):
            n_slots = int(slots[m].max()) + 1
            if not n_slots:
                continue
            rows, w, r = _drawn(block, m, t, weights[m], cfg)
            if level:
                slot = slots[m].take(_down(x, tree, rows, level) - (1 << level))
                counted = np.flatnonzero(slot >= 0)
                rows, w, r, slot = rows[counted], w[counted], r[counted], slot[counted]
                at = slot * (bins * bins)
            else:
                at = 0
            wr = w * r
            pairs = range(0, n_features, 2)
            sums = held.setdefault(m, np.zeros((2, len(pairs), n_slots * bins * bins)))
            for p, a in enumerate(pairs):
                code = (bin_of[m, a] * bins).take(x[a].take(rows)) + at
                if a + 1 < n_features:
                    code += bin_of[m, a + 1].take(x[a + 1].take(rows))
                for s, v in enumerate((w, wr)):
                    sums[s, p] += np.bincount(code, v, n_slots * bins * bins)
    yield -1, leaves
    for m, sums in held.items():
        table = sums.reshape(2, sums.shape[1], -1, bins, bins)
        each = np.stack((table.sum(4), table.sum(3)), 2).reshape(2, -1, table.shape[2], bins)
        yield m, each.transpose(0, 2, 1, 3)[:, :, :n_features]


def _moved(blocks, t, trees, weights, counted, cfg):
    """Blocks with the margins after tree ``t`` of every model; a ``counted``
    model's [drawn rows, weighted squared residuals] of its leaves."""
    depth, step = cfg.max_depth, 1.0 if t == 0 else cfg.learning_rate
    for block in blocks:
        at, fold, y, x, margin, _ = block
        new, leaves = np.empty_like(margin), np.zeros((len(trees), 2, 1 << depth))
        every = np.arange(len(fold))
        for m, tree in enumerate(trees):
            node = _down(x, tree, every, depth)
            new[m] = margin[m] + step * tree.value.take(node)
            if m in counted:
                rows, w, r = _drawn(block, m, t, weights[m], cfg)
                leaf = node.take(rows) - (1 << depth)
                leaves[m] = np.bincount(leaf, minlength=1 << depth), np.bincount(leaf, w * r * r, 1 << depth)
        yield at, fold, y, x, new, leaves if counted else None


def _split(tree: Tree, node: int, hist: np.ndarray, points: list[np.ndarray], edges: list[np.ndarray], least: float, some: int, rng) -> bool:
    """Give ``node`` its best split, if one has a gain."""
    n_features = len(points)
    left = hist.cumsum(2)
    w, s = tree.weight[node], tree.total[node]
    wl, sl = left
    wr, sr = w - wl, s - sl
    usable = (np.arange(hist.shape[2]) < np.array([len(p) for p in points])[:, None]) & (wl > least) & (wr > least)
    if some < n_features:
        usable &= np.isin(np.arange(n_features), rng.choice(n_features, some, replace=False))[:, None]
    if not usable.any():
        return False
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(usable, sl * sl / wl + sr * sr / wr - s * s / w, -np.inf)
    j, b = np.unravel_index(int(gain.argmax()), gain.shape)
    if gain[j, b] <= 1e-12 * w:
        return False
    tree.feature[node], tree.threshold[node] = j, points[j][b]
    tree.cut[node] = np.searchsorted(edges[j], points[j][b])
    tree.leaf[node], tree.gain[node] = False, gain[j, b] / w
    tree.weight[2 * node], tree.total[2 * node] = wl[j, b], sl[j, b]
    tree.weight[2 * node + 1], tree.total[2 * node + 1] = wr[j, b], sr[j, b]
    return True


def _count(tree: Tree, leaves: np.ndarray) -> None:
    last = len(tree.leaf) // 2
    tree.rows[last:], tree.square[last:] = leaves
    for i in range(last - 1, 0, -1):
        tree.rows[i], tree.square[i] = tree.rows[2 * i:2 * i + 2].sum(), tree.square[2 * i:2 * i + 2].sum()


def fit(df: DataFrame, features: list[str], label: str, cfg: ChurnConfig, weights: list[float], rows: int,
        counted: tuple[int, ...] = ()) -> Boosted:
    """``cfg.n_estimators`` trees of one model per entry of ``weights`` (the
    weight of its positive rows).  Model m learns from the rows whose ``fold``
    is not m; ``rows`` is how many the smallest of them has.  The models in
    ``counted`` also get the drawn rows and impurities of their nodes."""
    spark, depth, bins = df.sparkSession, cfg.max_depth, cfg.max_bins
    some = max(1, math.ceil(cfg.colsample_bytree * len(features)))
    points = _thresholds(df, features, label, weights, bins, cfg.random_state, rows)
    edges = [np.unique(np.concatenate(p)) for p in zip(*points, strict=True)]
    places = max(map(len, edges)) + 1
    bin_of = np.zeros((len(weights), len(features), places), np.int64)
    for m, p in enumerate(points):
        for j, e in enumerate(edges):
            bin_of[m, j, 1:len(e) + 1] = np.searchsorted(p[j], e, "right")
    # few rows are few tasks: a pass then costs little more than its start
    parts = max(min(default_parallelism(spark), -(-rows // BLOCK)), -(-rows // PART), 1)
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(checkpoint_dir(spark))
    blocks = _blocks(df, features, label, edges, len(weights), parts).persist(StorageLevel.MEMORY_AND_DISK)
    old, grown, models = None, [], range(len(weights))
    least = [0.5 * min(1.0, w) for w in weights]

    def summed(t, level, trees, slots):
        sums = dict.fromkeys([-1, *models], 0.0)
        for m, h in blocks.mapPartitions(
                lambda b: _histograms(b, t, level, trees, slots, weights, bin_of, bins, cfg)).collect():
            if h is not None:
                sums[m] = sums[m] + h
        if level == 0 and counted and grown:
            for m in counted:
                _count(grown[-1][m], sums[-1][m])
        return sums

    for t in range(cfg.n_estimators):
        trees = [Tree.empty(depth) for _ in models]
        rngs = [np.random.default_rng([cfg.random_state, t, m]) for m in models]
        open_, before = [[1] for _ in models], [{} for _ in models]
        for level in range(depth):
            # the lighter of two siblings is counted
            count = [[i for i in o if level == 0 or (tree.weight[i], i) < (tree.weight[i ^ 1], i ^ 1)]
                     for tree, o in zip(trees, open_, strict=True)]
            if not any(count):
                break
            slots = [np.full(1 << level, -1, np.int64) for _ in models]
            for s, c in zip(slots, count, strict=True):
                s[np.array(c, np.int64) - (1 << level)] = np.arange(len(c))
            sums = summed(t, level, trees, slots)
            if old is not None:  # that pass has written the new margins
                old.unpersist()
                old = None
            for m, tree in enumerate(trees):
                now = {i: sums[m][:, k] for k, i in enumerate(count[m])}
                if level == 0:
                    tree.weight[1], tree.total[1] = sums[m][:, 0, 0].sum(1)
                now |= {i: before[m][i >> 1] - now[i ^ 1] for i in open_[m] if i not in now}
                split = [i for i in sorted(now) if _split(tree, i, now[i], points[m], edges, least[m], some, rngs[m])]
                before[m], open_[m] = now, [c for i in split for c in (2 * i, 2 * i + 1)]
        for tree in trees:
            for i in range(1, 1 << depth):
                if tree.leaf[i]:
                    tree.weight[2 * i], tree.total[2 * i] = tree.weight[i], tree.total[i]
        old, blocks = blocks, blocks.mapPartitions(
            lambda b, t=t, trees=trees: _moved(b, t, trees, weights, counted, cfg), True).persist(StorageLevel.MEMORY_AND_DISK)
        if t % CHECKPOINT == CHECKPOINT - 1:
            blocks.checkpoint()
        grown.append(trees)
    # the last margins and leaves
    summed(cfg.n_estimators, 0, [Tree.empty(depth) for _ in models], [np.full(1, -1) for _ in models])
    if old is not None:
        old.unpersist()
    return Boosted(grown, blocks, cfg.learning_rate)


def as_model(spark: SparkSession, fitted: Boosted, features: list[str], model: int = 0, size: int | None = None):
    """The first ``size`` trees of one model (all, if not given) as a Spark
    pipeline that scores, saves and loads; covers and impurities need a fit
    that ``counted`` the model."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.classification import GBTClassificationModel
    from pyspark.ml.feature import VectorAssembler

    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    ml = jvm.org.apache.spark.ml
    uid, wrap, part = ml.util.Identifiable.randomUID, jvm.java.nio.ByteBuffer.wrap, jvm.java.util.Arrays.copyOfRange
    # looked up once: every step of a class path asks the JVM
    stats_of = jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator
    leaf, inner, split_at = ml.tree.LeafNode, ml.tree.InternalNode, ml.tree.ContinuousSplit

    def root(tree: Tree):
        value, stats = tree.value, np.column_stack((tree.weight, tree.total, tree.square))
        held = gateway.new_array(jvm.double, stats.size)
        wrap(stats.astype(">f8").tobytes()).asDoubleBuffer().get(held)
        impurity = np.maximum(tree.square / np.where(tree.weight > 0, tree.weight, 1.0) - value ** 2, 0.0)

        def node(i: int):
            calculator = stats_of(part(held, 3 * i, 3 * i + 3), int(tree.rows[i]))
            if tree.leaf[i]:
                return leaf(float(value[i]), float(impurity[i]), calculator)
            split = split_at(int(tree.feature[i]), float(tree.threshold[i]))
            return inner(float(value[i]), float(impurity[i]), float(tree.gain[i]), node(2 * i), node(2 * i + 1), split, calculator)

        return node(1)

    size = size or len(fitted.trees)
    trees = gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, size)
    rates = gateway.new_array(jvm.double, size)
    for t, grown in enumerate(fitted.trees[:size]):
        trees[t] = ml.regression.DecisionTreeRegressionModel(uid("dtr"), root(grown[model]), len(features))
        rates[t] = 1.0 if t == 0 else float(fitted.rate)
    gbt = GBTClassificationModel(ml.classification.GBTClassificationModel(uid("GBTClassifier"), trees, rates, len(features), 2))
    gbt._resetUid(gbt._java_obj.uid())
    return PipelineModel([VectorAssembler(inputCols=list(features), outputCol="features"), gbt.setFeaturesCol("features")])
