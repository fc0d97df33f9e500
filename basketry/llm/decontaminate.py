"""Operator 8 - benchmark decontamination by latent semantic retrieval.

Benchmark items are the queries; every passage of every document is searched.

1. Terms: the items' words, and the ``terms`` most frequent words of all
   documents.  Document frequencies are counted over all documents, without
   words in pairs that follow each other in an item, so that an item in many
   documents keeps its weight; words outside count as the rarest.
2. A randomised SVD of the TF-IDF passages of the items and of all documents:
   tasks return A'(A X) for their passages, Spark adds the rows by term, and
   the driver orthonormalises the thin result (terms x ``rank``, bounded).
3. All texts are cut into passages of 24 and 48 words at steps of 8.  A
   passage whose weight in known terms could not reach the cosine is passed
   over (an upper bound, so none is lost); the others are projected and
   compared with all items of the block at once.
4. Every passage that reaches the cosine is checked on the words around it
   (every passage at all for an item so short and of such frequent words that
   rare words beside a copy could hide it), and the confirmed one of highest
   cosine is reported: the longest common
   subsequence must hold ``min_lcs`` of the item's words and ``min_answer`` of
   its answer (its last sentence, or column ``answer`` where there is one).

Items are taken in blocks of a fixed number, so what is broadcast stays
bounded; the document side is read in place and never shuffled.

Defined results: null and empty texts hold nothing; items without words are
never found; repeated rows are reported alike, once per (doc_id, item_id);
other columns are ignored; an empty table on either side finds nothing.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace, group_starts, without
from .words import batch_words, slices


PASSAGE = np.dtype([("doc", np.int64), ("item", np.int64), ("cosine", np.float64), ("start", np.int64), ("end", np.int64)])


@dataclass(frozen=True)
class Search:
    rank: int = 160
    passages: tuple[int, ...] = (24, 48)
    step: int = 8
    min_cosine: float = 0.2
    min_lcs: float = 0.6
    min_answer: float = 0.5
    item_weight: tuple[float, float] = (16.0, 0.016)  # of an item's passage beside a document's: at least, and by document
    terms: int = 10_000
    block_items: int = 2000
    power_steps: int = 2

    def __post_init__(self) -> None:
        if any(size % self.step for size in self.passages):
            raise ValueError("passages must be whole steps")


def _find(table: np.ndarray, x: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.full(len(x), -1, dtype=np.int64)
    at = np.minimum(np.searchsorted(table, x), len(table) - 1)
    return np.where(table[at] == x, at, -1)


def windows(first: np.ndarray, size: int, step: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, end) of the word windows of each document: every
    ``step`` words, the last one reaching the end."""
    n = np.diff(first)
    count = np.where(n > 0, 1 + np.maximum(0, -(-(n - size) // step)), 0)
    doc = np.repeat(np.arange(len(n)), count)
    inner = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    start = first[doc] + inner * step
    return doc, start, np.minimum(start + size, first[doc + 1])


def lcs(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, a bit per word of ``a``."""
    at: dict[int, int] = {}
    for i, x in enumerate(a):
        at[x] = at.get(x, 0) | 1 << i
    row = (1 << len(a)) - 1
    full = row
    for y in b:
        m = at.get(y, 0)
        if m:
            u = row & m
            row = ((row + u) | (row - u)) & full
    return len(a) - row.bit_count()


def answer_start(text: str) -> int:
    """Where the answer begins: after the last sentence end inside the text
    (the whole text if there is none)."""
    body = text.rstrip(" \t\r\n.!?;:")
    cut = max(body.rfind(c) for c in ".!?\n")
    return cut + 1


@dataclass
class Index:
    """Terms with weights and latent vectors, and the items of a block."""

    terms: np.ndarray  # sorted hashes
    weight: np.ndarray  # inverse document frequency, never 0
    unknown: float
    vectors: np.ndarray  # terms x rank, and a last row of 0 for other words
    length: np.ndarray  # of each vector
    items: np.ndarray  # items x rank, unit length
    ids: list[int]
    words: list[list[int]]
    answers: list[list[int]]
    faint: np.ndarray  # items that rare words beside a copy could hide
    posting: np.ndarray  # by term, where its items start in the next two
    holder: np.ndarray  # items with the term
    times: np.ndarray  # its places in the item


def _weights(df: np.ndarray, n: int) -> np.ndarray:
    """log(1 + n / df): positive for every word at every size."""
    n = max(n, 1)
    return np.log1p(n / np.clip(df, 1.0, n))


TASKS = 8  # input splits read by a task that returns a thin matrix, if enough tasks remain
FLUSH = 1 << 20  # different words a task holds before it sends their counts


def _few(docs: DataFrame) -> DataFrame:
    """``docs`` in fewer partitions, as each returns a matrix."""
    parts = docs.rdd.getNumPartitions()
    return docs.coalesce(max(1, min(parts, max(2 * docs.sparkSession.sparkContext.defaultParallelism, -(-parts // TASKS)))))


def _document_counts(docs: DataFrame, own: np.ndarray, pairs: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(terms, df, documents): ``own`` and the ``most`` words in most documents
    (two at least), and the documents that hold each, over all documents.  In
    ``df`` words in one of the items' word pairs (``pairs``, sorted places in
    ``own``) don't count, or an item in many documents would make its own words
    common."""
    sent = docs.sparkSession.sparkContext.broadcast((own, pairs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (table, copied), rows = sent.value, 0
        held: list[tuple[np.ndarray, ...]] = []  # (words, documents that hold each, those that count)

        def merged() -> tuple[np.ndarray, ...]:
            words, where = np.unique(np.concatenate([x[0] for x in held]), return_inverse=True)
            return words, *(np.bincount(where, np.concatenate([x[k] for x in held]), len(words)).astype(np.int64) for k in (1, 2))

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(held[0][0].view(np.int64)), *map(pa.array, held[0][1:])], ["term", "n", "df"])

        for batch in batches:
            rows += batch.num_rows
            for part in slices(batch, "text"):
                w = batch_words(part.column(0), lower=True, plain=True)
                doc = np.repeat(np.arange(part.num_rows), np.diff(w.first))
                at = _find(table, w.hash)
                first = np.flatnonzero((at[:-1] >= 0) & (at[1:] >= 0) & (doc[1:] == doc[:-1]))
                first = first[_find(copied, at[first] * len(table) + at[first + 1]) >= 0]
                own_word = np.zeros(len(at), dtype=bool)
                own_word[first] = own_word[first + 1] = True
                order = np.argsort(w.hash, kind="stable")  # and so by word and document
                if not len(order):
                    continue
                word, counts = w.hash[order], ~own_word[order]
                cut = group_starts(word, doc[order])[:-1]
                counts = np.logical_or.reduceat(counts, cut)
                first = group_starts(word[cut])
                held.append((word[cut[first[:-1]]], np.diff(first), np.add.reduceat(counts.astype(np.int64), first[:-1])))
                if sum(len(x[0]) for x in held[1:]) > FLUSH // 2:
                    held = [merged()]
                    if len(held[0][0]) > FLUSH:
                        yield out()
                        held = []
        if held:
            held = [merged()]
            yield out()
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([rows], pa.int64()), pa.array([0], pa.int64())], ["term", "n", "df"])

    ws = Workspace(docs.sparkSession, "terms")
    counted = ws.stage(_few(docs.select("text")).mapInArrow(run, "term long, n long, df long").groupBy("term").agg(
        F.sum("n").alias("n"), F.sum("df").alias("df")), "counts")
    n = int(counted.filter("term is null").agg(F.sum("n")).first()[0] or 0)
    common = counted.filter("term is not null and n > 1").orderBy(F.desc("n"), "term").limit(most).select("term").toArrow()
    terms = np.union1d(own, common["term"].to_numpy().view(np.uint64))
    wanted = docs.sparkSession.createDataFrame([(int(t),) for t in terms.view(np.int64)], "term long")
    got = counted.join(F.broadcast(wanted), "term").select("term", "df").toArrow()
    df = np.zeros(len(terms))
    df[_find(terms, got["term"].to_numpy().view(np.uint64))] = got["df"].to_numpy()
    sent.destroy()
    ws.close()
    return terms, df, n


def _product(docs: DataFrame, terms: np.ndarray, weight: np.ndarray, x: np.ndarray, size: int) -> np.ndarray:
    """A'(A X) over the passages of all documents, added up by term in Spark."""
    sent = docs.sparkSession.sparkContext.broadcast((terms, weight, x))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, w_of, basis = sent.value
        total, scaled = np.zeros(basis.shape), (basis * w_of[:, None]).astype(np.float32)
        for batch in batches:
            for part in slices(batch, "text"):
                add_product(total, batch_words(part.column(0), lower=True, plain=True), table, w_of, scaled, size)
        total *= w_of[:, None]
        hit = np.flatnonzero(np.abs(total).sum(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(list(total[hit].astype(np.float32)), pa.list_(pa.float32()))], ["term", "row"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}  # at most the terms, which are bounded
        for batch in batches:
            for t, row in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                row = row.values.to_numpy()
                total[t] = total[t] + row if t in total else row.astype(np.float64)
        keys = sorted(total)
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array([total[k] for k in keys], pa.list_(pa.float64()))],
                                         ["term", "row"])

    got = _few(docs.select("text")).mapInArrow(run, "term long, row array<float>").repartition("term").sortWithinPartitions("term", "row").mapInArrow(
        add, "term long, row array<double>").toArrow()
    sent.destroy()
    out = np.zeros(x.shape)
    for t, row in zip(got["term"].to_pylist(), got["row"], strict=True):
        out[t] = row.values.to_numpy()
    return out


def add_product(total: np.ndarray, w, terms: np.ndarray, weight: np.ndarray, scaled: np.ndarray, size: int, part: int = 1 << 13) -> None:
    """Adds A'(A X) of one slice, without the last factor ``weight``: unit
    TF-IDF rows of its passages of ``size`` words.  ``scaled``: X by term,
    times the term's weight."""
    at = _find(terms, w.hash)
    n = np.diff(w.first)
    runs = -(-n // size)
    passage = np.repeat(np.cumsum(runs) - runs, n) + (np.arange(len(at)) - np.repeat(w.first[:-1], n)) // size
    known = np.flatnonzero(at >= 0)
    at, passage = at[known], passage[known]
    if not len(at):
        return
    begin = np.flatnonzero(np.concatenate(([True], passage[1:] != passage[:-1])))
    square = np.add.reduceat(weight[at] ** 2, begin)
    ends = np.append(begin[1:], len(at))
    i = 0
    while i < len(begin):  # some passages at a time, so that their rows stay in the cache
        j = max(i + 1, int(np.searchsorted(ends, begin[i] + part, side="right")))
        t = at[begin[i]:ends[j - 1]]
        rows = np.add.reduceat(scaled[t], begin[i:j] - begin[i], axis=0) / square[i:j, None].astype(np.float32)
        order = np.argsort(t, kind="stable")
        of = np.repeat(np.arange(j - i), ends[i:j] - begin[i:j])[order]
        cut = group_starts(t[order])[:-1]
        total[t[order][cut]] += np.add.reduceat(rows[of], cut, axis=0)
        i = j


def item_product(w, terms: np.ndarray, weight: np.ndarray, x: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros(x.shape)
    add_product(out, w, terms, weight, (x * weight[:, None]).astype(np.float32), size)
    return out * weight[:, None]


def latent_basis(product, items_product, terms: int, rank: int, steps: int, seed: int = 17) -> np.ndarray:
    """Orthonormal basis of the leading right singular vectors, by randomised
    range finding with power steps.  ``product`` gives A'(A X) of the
    documents, ``items_product`` that of the items."""
    rank = min(rank, terms)
    q = np.random.RandomState(seed).standard_normal((terms, rank))
    for _ in range(steps):
        q, _ = np.linalg.qr(product(q) + items_product(q))
    return q


def build_index(docs: DataFrame, rows: list[tuple], how: Search) -> Index:
    """Index of a block of items (id, text, answer or None)."""
    texts = pa.array([t or "" for _, t, _ in rows], pa.string())
    w = batch_words(texts, lower=True, plain=True)
    own = np.unique(w.hash)
    at = _find(own, w.hash)
    inner = np.setdiff1d(np.arange(1, len(at)), w.first)  # words with one before them in their item
    terms, df, n = _document_counts(docs, own, np.unique(at[inner - 1] * len(own) + at[inner]), how.terms)
    at = _find(terms, w.hash)
    weight = _weights(df, n)
    unknown = float(np.log1p(max(n, 1)))
    size = how.passages[-1]
    share = max(how.item_weight[0], how.item_weight[1] * n)
    items_of = lambda x: share * item_product(w, terms, weight, x, size)
    product = lambda x: _product(docs, terms, weight, x, size)
    q = latent_basis(product, items_of, len(terms), how.rank, how.power_steps)
    vectors = np.vstack((q * weight[:, None], np.zeros((1, q.shape[1])))).astype(np.float32)
    summed = np.vstack([vectors[at[a:b]].sum(axis=0) if b > a else np.zeros(q.shape[1]) for a, b in zip(w.first[:-1], w.first[1:], strict=True)])
    unit = summed / np.maximum(np.linalg.norm(summed, axis=1, keepdims=True), 1e-12)
    energy = np.array([(weight[at[a:b]] ** 2).sum() for a, b in zip(w.first[:-1], w.first[1:], strict=True)])
    kept, others = how.min_lcs * energy, np.maximum(how.passages[0] - how.min_lcs * np.diff(w.first), 0) * unknown ** 2
    faint = np.flatnonzero((energy > 0) & (how.min_lcs ** 2 * energy < how.min_cosine ** 2 * (kept + others)))
    words = [w.hash[a:b].tolist() for a, b in zip(w.first[:-1], w.first[1:], strict=True)]
    answers = [x if x is not None else (t or "")[answer_start(t or ""):] for _, t, x in rows]
    a = batch_words(pa.array(answers, pa.string()), lower=True, plain=True)
    answer = [a.hash[i:j].tolist() for i, j in zip(a.first[:-1], a.first[1:], strict=True)]
    holders, times = np.unique(at * len(rows) + np.repeat(np.arange(len(rows)), np.diff(w.first)), return_counts=True)
    posting = np.searchsorted(holders, np.arange(len(terms) + 1) * len(rows))
    return Index(terms, weight, unknown, vectors, np.linalg.norm(vectors, axis=1)[:-1], unit.astype(np.float32), [int(i) for i, _, _ in rows], words, answer, faint,
                 posting, holders % len(rows), times)


def _confirm(index: Index, i: int, text: list[int], passages: np.ndarray, how: Search) -> tuple | None:
    """(cosine, lcs, answer) of the passage of highest cosine that holds item
    ``i``.  Every passage is checked, on the words around it; passed over are
    those with too few of the item's words, or inside one that failed."""
    item, answer = index.words[i], index.answers[i]
    reach, places = len(item), {}
    for k, x in enumerate(item):
        places[x] = places.get(x, 0) | 1 << k
    low, high = max(0, int(passages["start"].min()) - reach), int(passages["end"].max()) + reach
    hits = [p for p, x in enumerate(text[low:high], low) if x in places]
    held = [places[text[p]] for p in hits]
    if reduce(or_, held, 0).bit_count() < how.min_lcs * reach:
        return None
    failed: list[tuple[int, int]] = []
    for c, a, b in sorted(passages.tolist(), reverse=True):
        x, y = bisect_left(hits, a - reach), bisect_left(hits, b + reach)
        if y - x < how.min_lcs * reach or reduce(or_, held[x:y], 0).bit_count() < how.min_lcs * reach:
            continue
        if any(u <= x and y <= v for u, v in failed):
            continue
        share = lcs(item, [text[p] for p in hits[x:y]]) / max(1, reach)
        if share < how.min_lcs:
            failed.append((x, y))
            continue
        part = lcs(answer, text[max(0, a - reach):b + reach]) / max(1, len(answer))
        if part >= how.min_answer or not answer:
            return c, share, part
    return None


def holdable(w, at: np.ndarray, index: Index, how: Search) -> tuple[np.ndarray, np.ndarray, int, int]:
    """Per segment and item, whether the segment and the next one of its
    document hold the share of the item's words that ``_confirm`` asks of a
    passage and the words around it; with each document's first segment, the
    words of a segment, and the most words around a passage.  A passage and
    what is around it never reach beyond two segments."""
    around = max(map(len, index.words), default=0)
    wide = max(how.passages) + 2 * around
    n_segments = -(-np.diff(w.first) // wide)
    first = np.concatenate(([0], np.cumsum(n_segments)))
    doc = np.repeat(np.arange(len(n_segments)), np.diff(w.first))
    held = np.flatnonzero((at >= 0) & (np.diff(index.posting)[at] > 0))
    segment = first[doc[held]] + (held - w.first[doc[held]]) // wide
    later = segment > first[doc[held]]
    key = np.unique(np.concatenate((segment * len(index.terms) + at[held], (segment[later] - 1) * len(index.terms) + at[held][later])))
    segment, term = np.divmod(key, max(1, len(index.terms)))
    n = index.posting[term + 1] - index.posting[term]
    post = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n - index.posting[term], n)
    items = len(index.words)
    cover = np.bincount(np.repeat(segment, n) * items + index.holder[post], weights=index.times[post], minlength=int(first[-1]) * items)
    asked = np.array([how.min_lcs * len(x) for x in index.words])
    return cover.reshape(int(first[-1]), items) >= asked, first, wide, around


def search_slice(w, index: Index, how: Search) -> list[tuple]:
    """Confirmed (document, item, cosine, lcs, answer) of a slice.

    Only passages that with the words around them hold enough of some item's
    words are projected; the others could not be confirmed.

    Passages are runs of blocks of ``step`` words: a block is projected and
    compared with the items once, and a passage's products are its blocks' sums.
    Empty blocks after each document keep its passages out of the next one."""
    at = _find(index.terms, w.hash)
    can, first_segment, wide, around = holdable(w, at, index, how)
    some = can.any(axis=1)
    known = np.where(at >= 0, index.weight[at], 0.0)
    latent = np.where(at >= 0, index.length[at], 0.0)
    run_known, run_latent = (np.concatenate(([0.0], np.cumsum(x))) for x in (known * known, latent))
    run_all = np.concatenate(([0.0], np.cumsum(np.where(at >= 0, known * known, index.unknown ** 2))))
    longest = max(how.passages) // how.step
    n_blocks = -(-np.diff(w.first) // how.step) + longest
    first_block = np.concatenate(([0], np.cumsum(n_blocks)))
    total = int(first_block[-1])
    sizes, needed = [], np.zeros(total + 1, dtype=np.int64)
    for size in sorted(how.passages):
        doc, start, end = windows(w.first, size, how.step)
        norm = np.sqrt(np.maximum(run_all[end] - run_all[start], 1e-12))
        # the projection is no longer than the known part, nor than its terms' vectors laid end to end
        most = np.minimum(np.sqrt(np.maximum(run_known[end] - run_known[start], 0)), run_latent[end] - run_latent[start])
        segment = first_segment[doc] + np.maximum(start - w.first[doc] - around, 0) // wide
        may = np.flatnonzero(((most >= how.min_cosine * norm) | (len(index.faint) > 0)) & some[segment])
        doc, start, end, norm, segment = doc[may], start[may], end[may], norm[may], segment[may]
        block = first_block[doc] + (start - w.first[doc]) // how.step
        np.add.at(needed, block, 1)
        np.add.at(needed, block + size // how.step, -1)
        sizes.append((size // how.step, doc, start, end, norm.astype(np.float32), block, segment))
    doc_of = np.repeat(np.arange(len(n_blocks)), n_blocks)
    block_start = np.minimum(w.first[doc_of] + (np.arange(total) - first_block[doc_of]) * how.step, w.first[doc_of + 1])
    block_end = np.minimum(block_start + how.step, w.first[doc_of + 1])
    needed = (np.cumsum(needed[:-1]) > 0) & (block_end > block_start)
    words_of = np.where(block_start[:, None] + np.arange(how.step) < block_end[:, None], block_start[:, None] + np.arange(how.step), -1)
    at = np.append(at, -1)  # the last of the vectors is 0
    found = []
    for lo in range(0, total, 1024):
        high = min(total, lo + 1024 + longest)
        pick = lo + np.flatnonzero(needed[lo:high])
        if not len(pick):
            continue
        t = at[words_of[pick]]
        x = index.vectors[t[:, 0]]
        for k in range(1, how.step):
            x += index.vectors[t[:, k]]
        product = np.zeros((1024 + 2 * longest, len(index.items)), dtype=np.float32)
        product[pick - lo] = x @ index.items.T
        run, summed = 0, np.zeros((1024 + longest, len(index.items)), dtype=np.float32)
        for blocks, doc, start, end, norm, block, segment in sizes:
            for k in range(run, blocks):
                summed += product[k:k + len(summed)]
            run = blocks
            a, b = np.searchsorted(block, (lo, lo + 1024))
            near = summed[block[a:b] - lo] >= (how.min_cosine * norm[a:b])[:, None]
            near[:, index.faint] = True
            near &= can[segment[a:b]]
            r, i = np.nonzero(near)
            p, one = a + r, np.zeros(len(r), dtype=PASSAGE)
            one["doc"], one["item"], one["cosine"] = doc[p], i, summed[block[p] - lo, i] / norm[p]
            one["start"], one["end"] = start[p] - w.first[doc[p]], end[p] - w.first[doc[p]]
            found.append(one)
    every = np.concatenate(found) if found else np.zeros(0, dtype=PASSAGE)
    every = every[np.lexsort((every["item"], every["doc"]))]
    cut = group_starts(every["doc"], every["item"])
    out, text, now = [], [], -1
    for a, b in zip(cut[:-1], cut[1:], strict=True):
        d, i = int(every["doc"][a]), int(every["item"][a])
        if d != now:
            text, now = w.hash[w.first[d]:w.first[d + 1]].tolist(), d
        best = _confirm(index, i, text, every[["cosine", "start", "end"]][a:b], how)
        if best:
            out.append((d, index.ids[i], *best))
    return out


def find_leaks(docs: DataFrame, benchmark: DataFrame, how: Search | None = None, held: list | None = None) -> DataFrame:
    """(doc_id, item_id, cosine, lcs, answer) of each document and benchmark
    item it holds.  ``held`` takes the broadcast indexes, for a caller that
    destroys them once it has the result."""
    how = how or Search()
    spark = docs.sparkSession
    source = docs.select(F.col("doc_id").cast("long"), "text")
    answer = F.col("answer").cast("string") if "answer" in benchmark.columns else F.lit(None).cast("string")
    items = benchmark.filter("item_id is not null").select(F.col("item_id").cast("long"), "text", answer.alias("answer"))
    kinds = "doc_id long, item_id long, cosine double, lcs double, answer double"
    found = spark.createDataFrame([], kinds)
    blocks = max(1, -(-items.count() // how.block_items))
    for block in range(blocks):  # the query set, in blocks of a fixed expected size
        rows = sorted(map(tuple, items.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).collect()),
                      key=lambda r: (r[0], r[1] or ""))
        if not any((t or "").strip() for _, t, _ in rows):
            continue
        sent = spark.sparkContext.broadcast(build_index(source, rows, how))
        if held is not None:
            held.append(sent)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch, "text"):
                    got = search_slice(batch_words(part.column(1), lower=True, plain=True), sent.value, how)
                    ids = part.column(0).to_pylist()
                    rows = [(ids[d], *rest) for d, *rest in got]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r[k] for r in rows], t) for k, t in enumerate([pa.int64()] * 2 + [pa.float64()] * 3)],
                        ["doc_id", "item_id", "cosine", "lcs", "answer"])

        found = found.unionByName(source.mapInArrow(run, kinds))
    return found.groupBy("doc_id", "item_id").agg(*[F.max(c).alias(c) for c in ("cosine", "lcs", "answer")])


def clean_documents(docs: DataFrame, benchmark: DataFrame, how: Search | None = None) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item."""
    held: list = []
    out = without(docs, find_leaks(docs, benchmark, how, held).select("doc_id"))  # stages the ids
    for sent in held:
        sent.destroy()
    return out
