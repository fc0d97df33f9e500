"""Operator 11 - periodic run detection on a Re-Pair grammar.

A run is a stretch of consecutive words with smallest period q (words q apart
are identical) that no neighbouring word extends.  Runs of at least four
periods and six words are found through a grammar of the word ids:

1. Re-Pair: the pairs that occur most are replaced by nonterminals.  In each
   round every pair that beats the pairs overlapping it (by count, then by a
   hash) is replaced wherever it does so, until a round replaces few symbols.
   What is left of a document is halved into a balanced tree, whose nodes
   count as nonterminals that occur once.
2. A run of four periods that crosses the boundary of a nonterminal holds two
   periods on one side of it.  So each nonterminal is looked at once, at one
   of its places: every period whose last two copies end at the boundary, or
   whose first two start there, is extended to the nonterminal's ends.
3. The stretches found are translated to all places of the nonterminal and
   merged per document and period.  A run lies whole in the least node that
   holds it and crosses that node's boundary, so the maximal ones are all met.

The work is n log n a document and narrow: no shuffle, no row depends on
another, and a rerun task gives the same rows.  Documents are handled in
slices of 2 MB that share a grammar; runs do not depend on the slicing.
Memory is bounded by the slice or the longest single text.

Words compare as 64-bit hashes and stretches as polynomial hashes over them.
Defined results: a null, empty or blank text has no words and no runs; rows
that repeat a doc_id, or have none, are handled each by itself; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import group_starts
from .words import WORD_POWER, Words, batch_words, mix64, power_table, slices

FOUND = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, kept_text string"
SLICE = 2 << 20


@dataclass(frozen=True)
class Periodic:
    """A run has ``periods`` copies and ``words`` words at least."""

    periods: int = 4
    words: int = 6
    min_gain: float = 1 / 1024  # Re-Pair ends when a round replaces a smaller share of the symbols
    step: int = 1 << 20  # (nonterminal, period) pairs tested at a time

    def __post_init__(self) -> None:
        if self.periods < 4:
            raise ValueError("fewer than four periods need not leave two on one side of a boundary")


@dataclass
class Sequence:
    """Word ids of a slice with running sums of their polynomial hash."""

    ids: np.ndarray
    sums: np.ndarray
    power: np.ndarray

    @classmethod
    def of(cls, hashes: np.ndarray) -> Sequence:
        power = power_table(WORD_POWER, len(hashes) + 1)
        sums = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(mix64(hashes) * power[:len(hashes)], out=sums[1:])
        return cls(np.unique(hashes, return_inverse=True)[1].astype(np.int64), sums, power)

    def same(self, at: np.ndarray, ahead: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether the ``size`` words at ``at`` stand again ``ahead`` words on."""
        here = (self.sums[at + size] - self.sums[at]) * self.power[ahead]
        return here == self.sums[at + ahead + size] - self.sums[at + ahead]

    def reach(self, at: np.ndarray, ahead: np.ndarray, most: np.ndarray, back: bool) -> np.ndarray:
        """How many words from ``at`` on (or, ``back``, before it), ``most`` of
        them at most, stand again ``ahead`` words on."""
        low, high = np.zeros_like(most), most.copy()
        while (open_ := low < high).any():
            mid = (low + high + 1) // 2
            ok = self.same(at - mid if back else at, ahead, mid)
            low = np.where(open_ & ok, mid, low)
            high = np.where(open_ & ~ok, mid - 1, high)
        return low


def boundary_runs(seq: Sequence, lo: np.ndarray, mid: np.ndarray, hi: np.ndarray, how: Periodic) -> tuple[np.ndarray, ...]:
    """(node, start, end, period) of the runs within ``lo:hi`` that reach
    ``mid``, for nodes given by their word positions."""
    found = [(np.zeros(0, np.int64),) * 4]
    large = np.flatnonzero(hi - lo >= how.words)
    left = np.minimum((hi - lo) // how.periods, (mid - lo) // 2)[large]
    right = np.minimum((hi - lo) // how.periods, (hi - mid) // 2)[large]
    total = np.cumsum(left + right)
    i = 0
    while i < len(large):
        j = max(i + 1, int(np.searchsorted(total, (total[i - 1] if i else 0) + how.step, side="right")))
        node, k = large[i:j], slice(i, j)
        for most, ahead in ((left[k], False), (right[k], True)):
            who = np.repeat(node, most)
            q = np.arange(1, len(who) + 1) - np.repeat(np.cumsum(most) - most, most)
            at = mid[who] if ahead else mid[who] - 2 * q  # the square is at:at + 2q
            near = at if ahead else at + q - 1  # one word first, the hash of the rest later
            some = np.flatnonzero(seq.ids[near] == seq.ids[near + q])
            some = some[seq.same(at[some], q[some], q[some])]
            found += _extended(seq, who[some], q[some], at[some], lo, hi, how)
        i = j
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _extended(seq: Sequence, who: np.ndarray, q: np.ndarray, at: np.ndarray, lo: np.ndarray, hi: np.ndarray,
              how: Periodic) -> list[tuple[np.ndarray, ...]]:
    """Runs around squares, given by node and rising period.  A multiple of a
    period whose square lies in that period's run is no smallest period; the
    others of a node are logarithmically few, and each step takes one."""
    out = []
    while len(who):
        first = group_starts(who)
        lead = first[:-1]
        w, p, a = who[lead], q[lead], at[lead]
        start = a - seq.reach(a, p, a - lo[w], back=True)
        end = a + 2 * p + seq.reach(a + p, p, hi[w] - a - 2 * p, back=False)
        whole = end - start >= np.maximum(how.words, how.periods * p)
        out.append((w[whole], start[whole], end[whole], p[whole]))
        of = np.repeat(np.arange(len(lead)), np.diff(first))
        rest = (q % p[of] != 0) | (at < start[of]) | (at + 2 * q > end[of])
        rest[lead] = False
        who, q, at = who[rest], q[rest], at[rest]
    return out


def _best_pairs(sym: np.ndarray, doc: np.ndarray, fresh: int) -> tuple[np.ndarray, np.ndarray]:
    """Places whose pair occurs again and beats its neighbours, with the
    pairs' keys; in a stretch of one symbol every second place counts."""
    inside = doc[:-1] == doc[1:]
    key = np.where(inside, sym[:-1] * fresh + sym[1:], -1)
    pairs, back, count = np.unique(key, return_inverse=True, return_counts=True)
    rank = np.where((count > 1) & (pairs >= 0), (np.minimum(count, 1 << 30) << 32) + (mix64(pairs.astype(np.uint64)) >> np.uint64(32)).astype(np.int64), 0)
    strength = rank[back]
    cut = group_starts(key)
    of = np.repeat(np.arange(len(cut) - 1), np.diff(cut))
    peak = strength[cut[:-1]]
    around = np.concatenate(([0], peak, [0]))
    wins = (peak > around[:-2]) & (peak > around[2:])
    at = np.flatnonzero(wins[of] & ((np.arange(len(key)) - cut[of]) % 2 == 0))
    return at, key[at]


def pieces(seq: Sequence, first: np.ndarray, how: Periodic) -> tuple[np.ndarray, ...]:
    """(document, start, end, period) of the runs found at the nonterminals,
    at all their places."""
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    sym, start, size = seq.ids, np.arange(len(seq.ids)), np.ones(len(seq.ids), np.int64)
    fresh = int(sym.max()) + 1 if len(sym) else 1
    out = []

    def merge(at: np.ndarray, name: np.ndarray) -> None:
        nonlocal sym, start, size, doc
        sym, size = sym.copy(), size.copy()
        sym[at], size[at] = name, size[at] + size[at + 1]
        keep = np.ones(len(sym), bool)
        keep[at + 1] = False
        sym, start, size, doc = sym[keep], start[keep], size[keep], doc[keep]

    def nodes(at: np.ndarray) -> tuple[np.ndarray, ...]:
        return boundary_runs(seq, start[at], start[at + 1], start[at + 1] + size[at + 1], how)

    while len(sym) > 1:  # Re-Pair
        at, key = _best_pairs(sym, doc, fresh)
        if len(at) == 0 or len(at) < how.min_gain * len(sym):
            break
        _, one, name, times = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
        node, begin, end, period = nodes(at[one])
        if len(node):  # shift each find to all places of its nonterminal
            place = np.argsort(name, kind="stable")
            offset = np.cumsum(times) - times
            every = np.repeat(np.arange(len(node)), times[node])
            nth = np.arange(len(every)) - np.repeat(np.cumsum(times[node]) - times[node], times[node])
            where = at[place[offset[node[every]] + nth]]
            shift = start[where] - start[at[one]][node[every]]
            out.append((doc[where], begin[every] + shift, end[every] + shift, period[every]))
        merge(at, fresh + name)
        fresh += len(one)
    while True:  # halve what is left
        cut = group_starts(doc)
        inner = np.arange(len(doc)) - np.repeat(cut[:-1], np.diff(cut))
        at = np.flatnonzero((inner[:-1] % 2 == 0) & (doc[:-1] == doc[1:])) if len(doc) > 1 else np.zeros(0, np.int64)
        if len(at) == 0:
            break
        node, begin, end, period = nodes(at)
        out.append((doc[at][node], begin, end, period))
        merge(at, np.arange(fresh, fresh + len(at)))
        fresh += len(at)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 4


def maximal(doc: np.ndarray, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, ...]:
    """Stretches of one document and period that share a period's words are
    parts of one run; (document, start, end, period) by document and start."""
    order = np.lexsort((start, period, doc))
    doc, start, end, period = doc[order], start[order], end[order], period[order]
    if len(doc) == 0:
        return doc, start, end, period
    group = np.repeat(np.arange(len(g := group_starts(doc, period)) - 1), np.diff(g))
    span = int(end.max()) + 1
    reach = np.maximum.accumulate(end + group * span) - group * span
    new = np.ones(len(doc), bool)
    new[1:] = (group[1:] != group[:-1]) | (start[1:] > reach[:-1] - period[1:])
    head = np.flatnonzero(new)
    doc, start, end, period = doc[head], start[head], np.maximum.reduceat(end, head), period[head]
    order = np.lexsort((period, start, doc))
    return doc[order], start[order], end[order], period[order]


def runs_of(w: Words, how: Periodic) -> tuple[np.ndarray, ...]:
    """(document index, start, end, period) of the runs of a slice; words are
    numbered through the slice."""
    return maximal(*pieces(Sequence.of(w.hash), w.first, how))


def _collapsed(w: Words, doc: np.ndarray, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> list[bytes]:
    """Each text without the words that follow a run's first period."""
    edge = np.zeros(len(w.hash) + 1, np.int64)
    np.add.at(edge, start + period, 1)
    np.add.at(edge, end, -1)
    keep = np.cumsum(edge)[:-1] == 0
    hit = np.bincount(doc, minlength=len(w.first) - 1) > 0
    out = []
    for d in range(len(w.first) - 1):
        words = w.text_bytes(d).split()
        out.append(b" ".join(compress(words, keep[w.first[d]:w.first[d + 1]]) if hit[d] else words))
    return out


def find_runs(docs: DataFrame, how: Periodic | None = None) -> DataFrame:
    """(doc_id, n_words, runs, kept_text) per row: runs by start and period,
    in words from 0; the kept words joined by single spaces."""
    how = how or Periodic()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        struct = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                w = batch_words(part.column(1))
                doc, start, end, period = runs_of(w, how)
                offsets = np.searchsorted(doc, np.arange(part.num_rows + 1)).astype(np.int32)
                each = pa.StructArray.from_arrays([pa.array(start - w.first[doc]), pa.array(end - start), pa.array(period)],
                                                  fields=list(struct.value_type))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.diff(w.first).astype(np.int64)),
                     pa.ListArray.from_arrays(pa.array(offsets), each).cast(struct),
                     pa.array(_collapsed(w, doc, start, end, period), pa.string())],
                    ["doc_id", "n_words", "runs", "kept_text"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(scan, FOUND)


def digest(found: DataFrame) -> DataFrame:
    """The run of greatest length and checksums in place of runs and text."""
    top = F.get(F.array_sort(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("size"), r["start"].alias("start"), r["period"].alias("period"), r["length"].alias("length")))), F.lit(0))
    line: Column = F.array_join(F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"])), "")
    return found.withColumn("__top", top).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        *(F.col(f"__top.{c}").alias(c) for c in ("start", "length", "period")),
        F.expr("1000 * __top.length div __top.period").alias("exponent_milli"),
        F.sha2(line, 256).alias("runs_sha256"), F.sha2("kept_text", 256).alias("collapsed_sha256"))


def repeat_words(docs: DataFrame) -> DataFrame:
    """Input of the registered query: in the documents whose crc32 of doc_id
    ends in 0, every word from the a-th on gives way to an earlier one, so
    that the text repeats every p words; the others are as they are."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+", -1), "")
    changed = docs.select("doc_id", "text", F.when((h % 10 == 0) & (F.size(words) > 0), words).alias("__w"), F.floor(h / 10).alias("__g"))
    a = F.col("__g") % F.size("__w")
    p = 1 + F.floor((F.size("__w") - a) / (3 + F.col("__g") % 8))
    source = F.transform("__w", lambda x, i: F.element_at("__w", F.when(i < F.col("__a"), i).otherwise(
        F.col("__a") + (i - F.col("__a")) % F.col("__p")).cast("int") + 1))
    return (changed.withColumn("__a", a).withColumn("__p", p)
            .withColumn("text", F.when(F.col("__w").isNull(), F.col("text")).otherwise(F.array_join(source, " ")))
            .select("doc_id", "text"))
