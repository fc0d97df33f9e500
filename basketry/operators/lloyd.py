"""K-Means from many starts at once.

A k sweep or a stability check needs a hundred fits of the same data.  Here
all starts go through Lloyd's algorithm together: the centres of every start
travel to the tasks (k x columns numbers a start), one scan assigns each row
in all of them, and one small aggregate, a row per task and centre, gives all
new centres.  So a sweep takes as many scans as its slowest fit has
iterations, and starts that have settled drop out of the work.

Starts are drawn by k-means++ from a sample of ``SAMPLE`` rows chosen by a hash
of their values, so they depend neither on partitioning nor on row order.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.io import materialise

SAMPLE = 8_192


@dataclass
class Fit:
    k: int
    seed: int
    centres: np.ndarray
    inertia: float = float("inf")
    iterations: int = 0
    settled: bool = field(default=False, repr=False)


def coordinates(df: DataFrame, cols: list[str], name: str = "points") -> DataFrame:
    """The rows that have every column, staged as doubles: the only thing
    that the iterations read."""
    return materialise(df.select(*[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(cols)]).na.drop(), name)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])


def _sample(points: DataFrame) -> np.ndarray:
    n = points.count()
    h = F.xxhash64(*points.columns)
    share = min(1 << 30, int((1 << 30) * SAMPLE / max(n, 1)) + 1)
    few = points.filter(F.pmod(h, F.lit(1 << 30)) < share) if n > SAMPLE else points
    rows = few.limit(4 * SAMPLE).toArrow()
    x = np.column_stack([rows[c].to_numpy() for c in rows.column_names]) if rows.num_rows else np.zeros((0, len(points.columns)))
    return x[np.lexsort(x.T[::-1])]


def plus_plus(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    """k-means++: each next centre is drawn by its squared distance from the
    ones so far; fewer than ``k`` distinct rows give as many centres."""
    rng = np.random.default_rng(seed)
    at = [int(rng.integers(len(x)))]
    near = ((x - x[at[0]]) ** 2).sum(1)
    while len(at) < k and near.sum() > 0:
        at.append(int(np.searchsorted(np.cumsum(near), rng.random() * near.sum(), side="right").clip(0, len(x) - 1)))
        near = np.minimum(near, ((x - x[at[-1]]) ** 2).sum(1))
    return x[at].copy()


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The nearest centre of every row, the first of equal ones.  Rows and
    centres come moved to a common origin; a row's own norm is the same for
    every centre, so a product and the centres' norms decide."""
    far = centres @ (-2.0 * x.T) + (centres * centres).sum(1)[:, None]
    near, best = np.zeros(len(x), dtype=np.intp), far[0]
    for j in range(1, len(centres)):  # whole rows of the product at a time
        near[far[j] < best] = j
        best = np.minimum(best, far[j])
    return near


def _totals(points: DataFrame, sets: list[np.ndarray], part: int = 4_096) -> dict[tuple[int, int], np.ndarray]:
    """{(set, cluster): [rows, sum of each column, sum of squared norms, cost]}
    of one scan that assigns every row to its nearest centre in every set."""
    d = len(points.columns)
    origin = np.concatenate(sets).mean(0)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [np.zeros((len(c), d + 3)) for c in sets]
        for b in batches:
            whole = _matrix(b)
            for i in range(0, len(whole), part):
                x = whole[i:i + part]
                one = np.column_stack((np.ones(len(x)), x, (x * x).sum(1), np.zeros(len(x))))
                moved = x - origin
                for t, c in zip(total, sets, strict=True):
                    near = _nearest(moved, c - origin)
                    one[:, -1] = ((x - c[near]) ** 2).sum(1)
                    t += (near == np.arange(len(c))[:, None]).astype(np.float64) @ one
        for s, t in enumerate(total):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(t), s, np.int32)), pa.array(np.arange(len(t), dtype=np.int32)), *[pa.array(t[:, j]) for j in range(d + 3)]],
                ["s", "c", *[f"t{j}" for j in range(d + 3)]])

    schema = "s int, c int, " + ", ".join(f"t{j} double" for j in range(d + 3))
    rows = points.mapInArrow(assign, schema).groupBy("s", "c").agg(*[F.sum(f"t{j}").alias(f"t{j}") for j in range(d + 3)]).collect()
    return {(r["s"], r["c"]): np.array(r[2:], dtype=float) for r in rows}


def fit_starts(points: DataFrame, runs: list[tuple[int, int]], max_iter: int = 300, tol: float = 1e-4) -> list[Fit]:
    """One fit per (k, seed), all in the same scans.  A fit ends when no
    centre moves by more than ``tol``, or after ``max_iter`` iterations; a
    centre that loses all its rows stays where it is.  ``inertia`` belongs to
    the returned centres."""
    sample = _sample(points)
    if not len(sample):
        raise ValueError("no rows to cluster")
    fits = [Fit(k, seed, plus_plus(sample, k, seed)) for k, seed in runs]
    while open_ := [f for f in fits if f.inertia == float("inf")]:
        totals = _totals(points, [f.centres for f in open_])
        for s, f in enumerate(open_):
            t = np.array([totals[s, c] for c in range(len(f.centres))])
            if f.settled or f.iterations >= max_iter:
                f.inertia = float(t[:, -1].sum())
                continue
            new = np.where(t[:, :1] > 0, t[:, 1:-2] / np.maximum(t[:, :1], 1), f.centres)
            f.settled = bool(np.sqrt(((new - f.centres) ** 2).sum(1)).max() <= tol)
            f.centres, f.iterations = new, f.iterations + 1
    return fits


def best(fits: list[Fit]) -> Fit:
    return min(fits, key=lambda f: (f.inertia, f.seed))


def silhouettes(points: DataFrame, sets: list[np.ndarray]) -> list[float]:
    """Mean silhouette (squared Euclidean) of every set of centres, in two
    scans for all: a row's mean distance to a cluster follows from the
    cluster's size, sum and sum of squared norms.  A row alone in its cluster
    counts 0; with fewer than two clusters the result is 0."""
    totals = _totals(points, sets)
    held = [np.array([totals[s, c] for c in range(len(x))]) for s, x in enumerate(sets)]
    origin = np.concatenate(sets).mean(0)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(len(sets)), 0
        for b in batches:
            whole = _matrix(b)
            for i in range(0, len(whole), 4_096):
                x = whole[i:i + 4_096]
                n += len(x)
                norm = (x * x).sum(1)[:, None]
                for s, (centres, t) in enumerate(zip(sets, held, strict=True)):
                    size = t[:, 0]
                    if (size > 0).sum() < 2:
                        continue
                    near = _nearest(x - origin, centres - origin)
                    each = norm - 2 * x @ (t[:, 1:-2] / np.maximum(size, 1)[:, None]).T + (t[:, -2] / np.maximum(size, 1))[None, :]
                    row = np.arange(len(x))
                    own = each[row, near] * size[near] / np.maximum(size[near] - 1, 1)
                    each[:, size == 0] = np.inf
                    each[row, near] = np.inf
                    other = each.min(1)
                    top = np.maximum(own, other)
                    total[s] += np.where((size[near] > 1) & (top > 0), (other - own) / np.where(top > 0, top, 1), 0.0).sum()
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64())), pa.array([n], pa.int64())], ["t", "n"])

    parts = points.mapInArrow(score, "t array<double>, n long")
    sums = [F.sum(F.col("t")[s]).alias(f"s{s}") for s in range(len(sets))]
    r = parts.agg(F.sum("n").alias("n"), *sums).first()
    return [float(r[f"s{s}"] / r["n"]) for s in range(len(sets))]


def as_model(spark: SparkSession, centres: np.ndarray, cols_vector: str = "features"):
    """The centres as a Spark model that predicts, saves and loads."""
    from pyspark.ml.clustering import KMeansModel

    jvm = spark._jvm
    vectors = jvm.java.util.ArrayList()
    for c in centres:
        values = spark.sparkContext._gateway.new_array(jvm.double, len(c))
        for i, x in enumerate(c):
            values[i] = float(x)
        vectors.add(jvm.org.apache.spark.mllib.linalg.Vectors.dense(values))
    inner = jvm.org.apache.spark.mllib.clustering.KMeansModel(vectors)
    model = KMeansModel(jvm.org.apache.spark.ml.clustering.KMeansModel(jvm.org.apache.spark.ml.util.Identifiable.randomUID("kmeans"), inner))
    model._resetUid(model._java_obj.uid())
    return model.setFeaturesCol(cols_vector).setPredictionCol("prediction")
