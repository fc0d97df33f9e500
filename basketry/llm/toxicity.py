"""Operator 6 - toxicity from class-conditional Kneser-Ney models.

Two bigram models, of toxic and of ordinary text, share their lowest order:

    p_c(w | u) = max(n_c(u w) - D, 0) / n_c(u) + b_c(u) q_c(w)
    q_c(w)     = max(N_c(. w) - D, 0) / N_c(..) + g_c s(w)

where N_c(. w) counts the distinct words seen before w in class c, s is the
same count over both classes, and b and g are the weights discounting frees.
A rare word counts as one shared word ``rare``, so expressions seen seldom are
judged by backoff.  A document is scored by its log-likelihood ratio per word,
over the whole text and in its most toxic run of words, and a logistic curve
fitted on other labelled rows maps both to 0..1.

Counts cover every labelled training row (folds 1 to 4); a document counts once
for each of its words and pairs, so that one document's repetitions prove
nothing.  The curve is fitted on all rows of fold 4, with the counts of folds 1 to
3.  Words (and pairs of kept words) enter the model if ``fewest`` documents of
the smaller class hold them, or that share of the larger one's counts; this is
the same at every input size, so the model grows with the labelled words.  It is
gathered and broadcast whole.  Training counts are summed per task before they
are shuffled.  Scoring is one narrow pass over whole texts.

Labels choose the training rows and never enter a score; neither do language,
source or doc_id.  Defined results: null and empty texts have ratio 0 and so
the curve's value there; null labels are not used; repeated rows score alike;
without training rows of both classes all ratios are 0 and scores 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Workspace, group_starts
from .words import batch_words, mix64, slices

RARE = np.uint64(0)
_PAIR = np.uint64(0xC2B2AE3D27D4EB4F)
COUNTS = ("ordinary", "toxic", "ordinary_early", "toxic_early")  # over folds 1 to 4, and over 1 to 3


@dataclass(frozen=True)
class Training:
    fewest: int = 5  # least documents of a class a model entry is in
    discount: float = 0.75
    runs: tuple[int, ...] = (2, 8)  # words of the runs scored on their own
    broadcast_labels: int = 4_000_000  # up to so many labels are broadcast, more are shuffled
    flush: int = 2_000_000  # counts a task holds before it sends them on


def fold(doc_id: Column) -> Column:
    return (F.crc32(doc_id.cast("string").cast("binary")) % 5).cast("int")


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Rows of equal keys added up."""
    order = np.lexsort(keys[::-1])
    keys = [k[order] for k in keys]
    cut = group_starts(*keys)[:-1]
    if not len(cut):
        return keys, [c[:0] for c in counts]
    return [k[cut] for k in keys], [np.add.reduceat(c[order], cut) for c in counts]


def _counted(rows: DataFrame, width: int, entries, flush: int) -> DataFrame:
    """(k0.., and ``COUNTS``) summed over ``rows`` (text, toxic, early);
    ``entries(words, doc)`` gives key columns (two are below 2^32) and the
    word's document.  Rows cross the shuffle packed: two keys in one number, and
    a class's counts (below 2^31 documents) of early and of all rows in one."""
    names = [f"k{i}" for i in range(width)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = [np.zeros(0, np.uint64)] * width, [np.zeros(0, np.int64)] * len(COUNTS)

        def out():
            key = keys[0] if width == 1 else keys[0] << np.uint64(32) | keys[1]
            return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), *(pa.array(counts[i] | counts[i + 2] << 32) for i in (0, 1))],
                                              ["k", "c0", "c1"])

        for batch in batches:
            for part in slices(batch, "text"):
                w = batch_words(part.column(0), lower=True, plain=True)
                toxic, early = (part.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in (1, 2))
                doc = np.repeat(np.arange(part.num_rows), np.diff(w.first))
                more, owner = entries(w.hash, doc)
                more, _ = _summed([owner.astype(np.uint64), *more], [owner])  # once per document
                one, soon = (x[more[0].astype(np.int64)] for x in (toxic, early))
                k, c = _summed(more[1:], [1 - one, one, (1 - one) * soon, one * soon])
                keys, counts = _summed([np.concatenate(x) for x in zip(keys, k, strict=True)],
                                       [np.concatenate(x) for x in zip(counts, c, strict=True)])
                if len(counts[0]) > flush:
                    yield out()
                    keys, counts = [x[:0] for x in keys], [x[:0] for x in counts]
        yield out()

    low, high = (lambda c: F.col(c).bitwiseAND(F.lit((1 << 32) - 1))), (lambda c: F.shiftrightunsigned(c, 32))
    summed = rows.select("text", "toxic", "early").mapInArrow(run, "k long, c0 long, c1 long").groupBy("k").agg(
        F.sum("c0").alias("c0"), F.sum("c1").alias("c1"))
    keys = [F.col("k")] if width == 1 else [high("k"), low("k")]
    every = [*keys, low("c0"), low("c1"), high("c0"), high("c1")]
    return summed.select(*[c.alias(n) for c, n in zip(every, [*names, *COUNTS], strict=True)])


def _find(table: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Index of each value in a sorted table, or -1."""
    if not len(table):
        return np.full(len(x), -1, dtype=np.int64)
    at = np.minimum(np.searchsorted(table, x), len(table) - 1)
    return np.where(table[at] == x, at, -1)


def _pair(u: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mix64(u * _PAIR + w)


@dataclass
class Model:
    """Log ratios: of known pairs, of backing off from a word, of a word."""

    words: np.ndarray  # sorted hashes; index len(words) is the rare word
    pairs: np.ndarray  # sorted pair hashes
    pair_ratio: np.ndarray
    back: np.ndarray
    alone: np.ndarray
    curve: np.ndarray

    def word_ratios(self, h: np.ndarray, doc: np.ndarray) -> np.ndarray:
        if not len(h):
            return np.zeros(0)
        at = _find(self.words, h)
        at = np.where(at < 0, len(self.words), at)
        out = self.alone[at].copy()  # a text's first word has no word before it
        follows = np.flatnonzero(doc[1:] == doc[:-1]) + 1
        u, w = at[follows - 1], at[follows]
        known = _find(self.pairs, _pair(u.astype(np.uint64), w.astype(np.uint64)))
        out[follows] = np.where(known >= 0, self.pair_ratio[known] if len(self.pairs) else 0.0,
                                self.back[u] + self.alone[w])
        return out

    def features(self, texts: pa.Array, runs: tuple[int, ...]) -> np.ndarray:
        """Per text: mean ratio, mean ratio of its most toxic run of each
        length, log of one plus its words."""
        w = batch_words(texts, lower=True, plain=True)
        n = np.diff(w.first)
        doc = np.repeat(np.arange(len(n)), n)
        ratio = self.word_ratios(w.hash, doc)
        total = np.concatenate(([0.0], np.cumsum(ratio)))
        mean = (total[w.first[1:]] - total[w.first[:-1]]) / np.maximum(n, 1)
        out = [mean]
        for run in runs:
            best = mean.copy()  # a text shorter than a run is its own run
            at = np.flatnonzero(doc[:max(0, len(doc) - run + 1)] == doc[run - 1:]) if len(doc) >= run else np.zeros(0, np.int64)
            np.maximum.at(best, doc[at], (total[at + run] - total[at]) / run)
            out.append(best)
        return np.column_stack((*out, np.log1p(n)))

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = self.curve[0] + x @ (self.curve[1:] if len(self.curve) > 1 else np.zeros(x.shape[1]))
        return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def build_model(vocabulary: np.ndarray, word_n: np.ndarray, pairs: np.ndarray, pair_n: np.ndarray,
                before: np.ndarray, d: float) -> Model:
    """The model from counts: ``word_n`` and ``before`` (distinct words before)
    are 2 x (words + rare), ``pairs`` (first, second) indices with ``pair_n``
    2 x pairs."""
    size = len(vocabulary) + 1
    shared = before.sum(axis=0) + 1.0
    shared /= shared.sum()
    alone, back, known = [], [], []
    for c in range(2):
        total = max(1.0, before[c].sum())
        cut = np.maximum(before[c] - d, 0.0) / total
        q = cut + (1.0 - cut.sum()) * shared
        n = np.maximum(word_n[c], 1.0)
        kept = np.maximum(pair_n[c] - d, 0.0) / n[pairs[0]]
        b = np.maximum(1.0 - np.bincount(pairs[0], weights=kept, minlength=size), 1e-9)
        alone.append(np.log(q))
        back.append(np.log(b))
        known.append(np.log(kept + b[pairs[0]] * q[pairs[1]]))
    key = _pair(pairs[0].astype(np.uint64), pairs[1].astype(np.uint64))
    order = np.argsort(key)
    return Model(vocabulary, key[order], (known[1] - known[0])[order], back[1] - back[0], alone[1] - alone[0],
                 np.zeros(1))


def curve_sums(x: np.ndarray, y: np.ndarray, mean: np.ndarray, scale: np.ndarray, beta: np.ndarray) -> np.ndarray:
    """Gradient and, after it, the rows of the Hessian over some rows."""
    z = np.column_stack((np.ones(len(x)), (x - mean) / scale))
    p = 1.0 / (1.0 + np.exp(-np.clip(z @ beta, -30, 30)))
    return np.concatenate((z.T @ (y - p), ((z * (p * (1 - p) + 1e-9)[:, None]).T @ z).ravel()))


def fit_curve(rows: DataFrame, names: list[str]) -> np.ndarray:
    """Logistic regression of ``y`` on ``names`` over all rows, by Newton steps
    with a small ridge; tasks add up gradients and Hessians."""
    size = len(names) + 1

    def over(each) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            parts = [each(np.column_stack([b.column(i).to_numpy() for i in range(size - 1)]), b.column(size - 1).to_numpy().astype(float))
                     for b in batches if b.num_rows]
            if parts:
                yield pa.RecordBatch.from_arrays([pa.array([np.sum(parts, axis=0).tolist()], pa.list_(pa.float64()))], ["s"])

        got = rows.select(*names, "y").mapInArrow(run, "s array<double>").toArrow()["s"].to_pylist()
        return np.sum(np.sort(np.array(got), axis=0), axis=0) if got else np.zeros(0)  # in one order, whatever order tasks end in

    first = over(lambda x, y: np.concatenate(([len(y), y.sum()], x.sum(axis=0))))
    if not len(first) or first[1] in (0, first[0]):
        return np.zeros(size)
    n, mean = first[0], first[2:] / first[0]
    scale = np.sqrt(over(lambda x, y: ((x - mean) ** 2).sum(axis=0)) / n) + 1e-9
    beta = np.zeros(size)
    for _ in range(50):
        at = beta.copy()
        sums = over(lambda x, y, at=at: curve_sums(x, y, mean, scale, at))
        step = np.linalg.solve(sums[size:].reshape(size, size) + 1e-2 * np.eye(size), sums[:size] - 1e-2 * beta)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    slope = beta[1:] / scale
    return np.round(np.concatenate(([beta[0] - (slope * mean).sum()], slope)), 10)


def count_models(ws: Workspace, rows: DataFrame, how: Training) -> tuple[Model, Model]:
    """The models, without curves, of the counts over ``rows`` (text, toxic,
    early) and over its early ones; both have the words and pairs of all."""
    words = ws.stage(_counted(rows, 1, lambda h, doc: ([h], doc), how.flush), "words")
    total = [max(1, x or 0) for x in words.agg(*map(F.sum, COUNTS)).first()]
    share = how.fewest / min(total[:2])  # one share for both classes, or backoff would favour one
    often = (F.col("ordinary") >= share * total[0]) | (F.col("toxic") >= share * total[1])
    kept = words.filter(often).toArrow()
    h = kept["k0"].to_numpy().view(np.uint64)
    order = np.argsort(h)
    vocabulary = h[order]
    word_n = np.vstack([kept[c].to_numpy()[order] for c in COUNTS]).astype(float)
    word_n = np.column_stack((word_n, np.array(total) - word_n.sum(axis=1)))
    shared = ws.spark.sparkContext.broadcast(vocabulary)

    def pairs_of(h: np.ndarray, doc: np.ndarray):
        table = shared.value
        at = _find(table, h)
        at = np.where(at < 0, len(table), at).astype(np.uint64)
        follows = np.flatnonzero(doc[1:] == doc[:-1]) + 1
        follows = follows[at[follows - 1] + at[follows] < np.uint64(2 * len(table))]  # rare twice tells nothing
        return [at[follows - 1], at[follows]], doc[follows]

    pairs = ws.stage(_counted(rows, 2, pairs_of, how.flush), "pairs")
    before = pairs.groupBy("k1").agg(*[F.sum((F.col(c) > 0).cast("long")).alias(c) for c in COUNTS]).toArrow()  # a row per model word
    distinct = np.zeros((len(COUNTS), len(vocabulary) + 1))
    for c, name in enumerate(COUNTS):
        distinct[c, before["k1"].to_numpy()] = before[name].to_numpy()
    frequent = pairs.filter(f"k0 < {len(vocabulary)} and k1 < {len(vocabulary)}").filter(often).toArrow()
    shared.destroy()
    ends = np.vstack((frequent["k0"].to_numpy(), frequent["k1"].to_numpy()))
    pair_n = np.vstack([frequent[c].to_numpy() for c in COUNTS]).astype(float)
    whole, early = (build_model(vocabulary, word_n[i:i + 2], ends, pair_n[i:i + 2], distinct[i:i + 2], how.discount) for i in (0, 2))
    return whole, early


def train(docs: DataFrame, labels: DataFrame, how: Training | None = None) -> Model:
    """Model from the counts of all labelled rows of folds 1 to 4, and its
    curve: from the rows of fold 4, as the counts of folds 1 to 3 see them."""
    how = how or Training()
    spark = docs.sparkSession
    ws = Workspace(spark, "toxicity")
    marks = labels.filter("toxic is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.col("toxic").cast("int")).alias("toxic")).filter(fold(F.col("doc_id")) > 0)
    marks = ws.stage(marks, "labels")
    side = F.broadcast(marks) if marks.count() <= how.broadcast_labels else marks
    rows = docs.select(F.col("doc_id").cast("long"), "text").join(side, "doc_id").withColumn("early", fold(F.col("doc_id")) < 4)
    model, early = count_models(ws, rows, how)
    sent = spark.sparkContext.broadcast(early)

    names = [f"x{i}" for i in range(len(how.runs) + 2)]

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                x = sent.value.features(part.column(0), how.runs)
                yield pa.RecordBatch.from_arrays([*map(pa.array, x.T.copy()), part.column(1)], [*names, "y"])

    kinds = ", ".join(f"{n} double" for n in names) + ", y int"
    seen = ws.stage(rows.filter(~F.col("early")).select("text", "toxic").mapInArrow(features, kinds), "features")
    model.curve = fit_curve(seen, names)
    sent.destroy()
    ws.close()
    return model


def score_documents(docs: DataFrame, model: Model, how: Training | None = None) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row."""
    how = how or Training()
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                score = sent.value.scores(sent.value.features(part.column(1), how.runs))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                    ["doc_id", "held_out", "score", "predicted"])

    held = F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out")
    return docs.select(F.col("doc_id").cast("long"), "text", held).mapInArrow(
        run, "doc_id long, held_out boolean, score double, predicted int")
