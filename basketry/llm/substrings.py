"""Operator 2 - substring dedup by super-k-mer partitioning.

A window is ``k`` consecutive words of one document.  Its minimiser is the
least hash among its ``m``-word pieces, so equal windows have equal
minimisers wherever they stand.  Consecutive windows of a document that share
a minimiser travel as one packed string (a super-k-mer) to the minimiser's
bucket, where the windows of all strings are sorted and each distinct window
learns the least doc_id that holds it.  A word goes when a window over it also
starts in a document with a smaller doc_id.

Steps, each a Spark job over whole texts:
1. Which minimisers occur in two documents or more?  Tasks send compact blocks
   of hashed slots (about 3 bytes a minimiser), merged into bit sets of fixed
   size.  They may let a few others through and never hold a shared one back.
2. Super-k-mers of shared minimisers are packed, combined per slice with their
   least and greatest doc_id, and shuffled to the minimiser's bucket; sorting
   the windows there gives the least doc_id of each, exactly, on the words.
3. Places (doc_id, position, string hash) join the strings that hold a shared
   window; the join splits skewed strings.  A bit mask per place says which
   windows stand in a smaller document.
4. Marks meet their document; only texts that may have marks are shuffled.

Hot passages: a string is sent once per slice and not once per document; a
minimiser found in 255 documents or more has its windows sent one by one to buckets of
their own hash, so no bucket gathers its neighbourhood.  Runs of more than 62
windows are cut.  Tables between steps are staged in the shared folder.

Defined results: null and empty texts have no words and the digest of the
empty string; texts under k words lose nothing; rows that repeat a doc_id are
one document's copies and lose nothing to each other; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace, bit_set, has_bit, slot_counts, sorted_groups
from .words import Words, batch_words, grams, mix64, slices

K = 13
M = 5
SLOT_BITS = 28  # two tables of half as many slots, 64 MB; a minimiser must be shared in both
HOT = 255  # a minimiser in so many documents gets its windows sent singly
LONGEST = 62  # windows of a packed string; their marks fit one long
DOC_BITS = 24


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` consecutive values."""
    n = len(x) - width + 1
    if n <= 0:
        return x[:0]
    have, span = x, 1
    while span * 2 <= width:
        have = np.minimum(have[:-span], have[span:])
        span *= 2
    return np.minimum(have[:n], have[width - span:width - span + n])


def super_kmers(w: Words, k: int = K, m: int = M) -> tuple[np.ndarray, ...]:
    """Runs of consecutive windows with one minimiser: (document index, first
    word, number of windows, minimiser)."""
    doc = np.repeat(np.arange(len(w.first) - 1), np.diff(w.first))
    if len(doc) < k:
        z = np.zeros(0, dtype=np.int64)
        return z, z, z, np.zeros(0, dtype=np.uint64)
    at = np.flatnonzero(doc[:len(doc) - k + 1] == doc[k - 1:])
    value = sliding_min(grams(w.hash, m), k - m + 1)[at]
    new = np.ones(len(at), dtype=bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (value[1:] != value[:-1])
    begin = np.flatnonzero(new)
    count = np.diff(np.append(begin, len(at)))
    if len(count) and count.max() > LONGEST:  # cut long runs
        parts = -(-count // LONGEST)
        inner = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
        begin = np.repeat(begin, parts) + inner * LONGEST
        count = np.minimum(np.repeat(count, parts) - inner * LONGEST, LONGEST)
    return doc[at[begin]], at[begin], count, value[begin]


def _slots(minimiser: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A slot of the lower and one of the upper table."""
    h, half = mix64(minimiser), np.uint64(1 << (SLOT_BITS - 1))
    return h >> np.uint64(65 - SLOT_BITS), (h & (half - np.uint64(1))) + half


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.col("text")).filter("doc_id is not null")


def shared_minimisers(docs: DataFrame, k: int = K, m: int = M) -> np.ndarray:
    """Bit sets of the minimiser slots found in two documents, and in HOT."""

    def slots(part: pa.RecordBatch) -> np.ndarray:
        doc, _, _, value = super_kmers(batch_words(part.column(1)), k, m)
        _, at = np.unique(value ^ mix64(doc.astype(np.uint64)), return_index=True)  # once a document
        return np.concatenate(_slots(value[at]))

    return slot_counts(_texts(docs), slots, SLOT_BITS, (2, HOT))


def _strings(part: pa.RecordBatch, sets: np.ndarray, k: int, m: int):
    """Packed strings to send from a slice: words, document index, position in
    the document, windows, bucket and string hash."""
    w = batch_words(part.column(1))
    doc, first, count, value = super_kmers(w, k, m)
    lower, upper = _slots(value)
    keep = has_bit(sets[0], lower) & has_bit(sets[0], upper)
    doc, first, count, value = doc[keep], first[keep], count[keep], value[keep]
    single = has_bit(sets[1], lower[keep]) & has_bit(sets[1], upper[keep])
    if single.any():
        gram = grams(w.hash, k)
        spread = np.where(single, count, 1)
        inner = np.arange(int(spread.sum())) - np.repeat(np.cumsum(spread) - spread, spread)
        lone = np.repeat(single, spread)
        doc, first, count, value = (np.repeat(x, spread) for x in (doc, first, count, value))
        first, count = first + inner, np.where(lone, 1, count)
        value = np.where(lone, gram[first], value)
    # hash of the string: its words' hashes, by running sums as for words
    run = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix64(w.hash) * (np.arange(len(w.hash), dtype=np.uint64) * np.uint64(2) + np.uint64(1)))))
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix64(w.hash))))
    last = first + count + k - 1
    weighted = run[last] - run[first] - (total[last] - total[first]) * (first.astype(np.uint64) * np.uint64(2))
    digest = mix64(weighted ^ mix64(total[last] - total[first] + count.astype(np.uint64)))
    return w, doc, first, count, value, digest


def _packer(w: Words):
    """Bytes of words i..j-1 joined by single spaces."""
    size = w.end - w.start + 1
    offset = np.concatenate(([0], np.cumsum(size)))
    joined = np.full(int(offset[-1]), 0x20, dtype=np.uint8)
    solid = np.zeros(len(w.data) + 1, dtype=np.int8)
    np.add.at(solid, w.start, 1)
    np.add.at(solid, w.end, -1)
    inside = np.ones(len(joined), dtype=bool)
    inside[offset[1:] - 1] = False
    joined[inside] = w.data[np.cumsum(solid[:-1]) > 0]
    raw = joined.tobytes()
    return lambda i, j: raw[offset[i]:offset[j] - 1]


def window_owners(packed: list[bytes], lo: list[int], k: int) -> list[list[int]]:
    """For each packed string the least doc_id of each of its windows, over
    all strings given: windows are sorted and runs of equal ones counted."""
    entries: list[tuple[bytes, int, int, int]] = []
    for s, text in enumerate(packed):
        words = text.split(b" ")
        entries += [(b" ".join(words[i:i + k]), lo[s], s, i) for i in range(len(words) - k + 1)]
    entries.sort()
    out: list[list[int]] = [[0] * (text.count(b" ") + 2 - k) for text in packed]
    window, least = None, 0
    for text, doc, s, i in entries:
        if text != window:
            window, least = text, doc  # sorted: the first has the least doc_id
        out[s][i] = least
    return out


def covered_words(n: int, pos: np.ndarray, mask: np.ndarray, k: int) -> np.ndarray:
    """Which of n words lie in a marked window."""
    bits = np.unpackbits(mask.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    row, bit = np.nonzero(bits)
    start = pos[row] + bit
    start = start[start + k <= n]
    step = np.zeros(n + 1, dtype=np.int64)
    np.add.at(step, start, 1)
    np.add.at(step, start + k, -1)
    return np.cumsum(step)[:-1] > 0


def dedup_substrings(docs: DataFrame, k: int = K, m: int = M, texts: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) for every row, and the kept
    words joined by spaces as ``kept_text`` on request."""
    spark = docs.sparkSession
    ws = Workspace(spark, "substrings")
    source = _texts(docs)
    sets = spark.sparkContext.broadcast(shared_minimisers(docs, k, m))

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 4 << 20):
                w, doc, first, count, value, digest = _strings(part, sets.value, k, m)
                if not len(doc):
                    continue
                ids = part.column(0).to_numpy()[doc]
                order = np.lexsort((ids, digest, value))
                value, digest, ids = value[order], digest[order], ids[order]
                new = np.ones(len(order), dtype=bool)
                new[1:] = (value[1:] != value[:-1]) | (digest[1:] != digest[:-1])
                at = np.flatnonzero(new)
                stop = np.append(at[1:], len(order)) - 1
                text, head = _packer(w), order[at]
                packed = [text(i, j) for i, j in zip(first[head], first[head] + count[head] + k - 1, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(value[at].view(np.int64)), pa.array(digest[at].view(np.int64)), pa.array(packed, pa.binary()),
                     pa.array(ids[at]), pa.array(ids[stop])], ["mini", "digest", "packed", "lo", "hi"])

    def owners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in sorted_groups(batches, ["mini"]):
            lo, hi = table["lo"].to_numpy(), table["hi"].to_numpy()
            least = window_owners(table["packed"].to_pylist(), lo.tolist(), k)
            keep = np.fromiter((min(x) < h for x, h in zip(least, hi, strict=True)), dtype=bool, count=len(least))
            yield pa.RecordBatch.from_arrays(
                [table["mini"].combine_chunks().filter(pa.array(keep)), table["digest"].combine_chunks().filter(pa.array(keep)),
                 pa.array([x for x, y in zip(least, keep, strict=True) if y], pa.list_(pa.int64()))], ["mini", "digest", "least"])

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                w, doc, first, _, value, digest = _strings(part, sets.value, k, m)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(value.view(np.int64)), pa.array(digest.view(np.int64)), pa.array(part.column(0).to_numpy()[doc]),
                     pa.array((first - w.first[doc]).astype(np.int32))], ["mini", "digest", "doc", "pos"])

    bucketed = (
        source.mapInArrow(strings, "mini long, digest long, packed binary, lo long, hi long")
        .repartition("mini").groupBy("mini", "digest", "packed").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        .sortWithinPartitions("mini")
    )
    shared = ws.stage(bucketed.mapInArrow(owners, "mini long, digest long, least array<long>"), "shared")
    marks = ws.stage(
        source.mapInArrow(places, "mini long, digest long, doc long, pos int").join(shared, ["mini", "digest"])
        .select("doc", "pos", F.expr(
            "aggregate(transform(least, (x, i) -> if(x < doc, shiftleft(1L, i), 0L)), 0L, (a, x) -> a | x)").alias("mask"))
        .filter("mask != 0")
        .groupBy("doc").agg(F.collect_set(F.struct("pos", "mask")).alias("m"))  # bounded by the document
        .select("doc", F.col("m.pos").alias("pos"), F.col("m.mask").alias("mask")), "marks")
    ws.drop("shared")
    sets.destroy()  # both passes that read it are staged
    marked = spark.sparkContext.broadcast(
        bit_set(marks, F.pmod(F.xxhash64("doc"), F.lit(1 << DOC_BITS)), DOC_BITS))
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(1 << DOC_BITS))
    extra = ", kept_text string" if texts else ""

    def plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Results of documents without marks; the others keep their text."""
        for batch in batches:
            waits = has_bit(marked.value, batch.column(2).to_numpy())
            n, sha, kept = [], [], []
            for text, wait in zip(batch.column(1), waits, strict=True):
                found = [] if wait or not text.is_valid else text.as_buffer().to_pybytes().split()
                words = b" ".join(found)
                n.append(None if wait else len(found))
                sha.append(None if wait else hashlib.sha256(words).hexdigest())
                kept.append(None if wait else words.decode("utf-8", "replace"))
            held = pa.array(batch.column(1)).filter(pa.array(waits))
            text = pa.nulls(batch.num_rows, pa.string()) if not waits.any() else held.take(
                pa.array(np.where(waits, np.cumsum(waits) - 1, -1), mask=~waits))
            columns = [batch.column(0), text, pa.array(n, pa.int64()), pa.array(sha, pa.string())]
            yield pa.RecordBatch.from_arrays(columns + ([pa.array(kept, pa.string())] if texts else []),
                                             ["doc_id", "text", "n_words", "kept_sha256"] + (["kept_text"] if texts else []))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = {name: batch.column(i).to_pylist() for i, name in enumerate(batch.schema.names)}
            for d, text in enumerate(col["text"]):
                if col["n_words"][d] is not None:
                    continue
                words = (text or "").encode().split()
                gone = covered_words(len(words), np.asarray(col["pos"][d] or [], dtype=np.int64),
                                     np.asarray(col["mask"][d] or [], dtype=np.int64).view(np.uint64), k)
                kept = b" ".join(x for x, g in zip(words, gone, strict=True) if not g)
                col["n_words"][d], col["kept_sha256"][d] = len(words), hashlib.sha256(kept).hexdigest()
                col["n_removed"][d] = int(gone.sum())
                if texts:
                    col["kept_text"][d] = kept.decode("utf-8", "replace")
            names = ["doc_id", "n_words", "n_removed", "kept_sha256"] + (["kept_text"] if texts else [])
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(col[x], t) for x, t in zip(names, kinds)], names)  # noqa: B905

    first_pass = docs.select(F.col("doc_id").cast("long"), F.col("text"), F.coalesce(slot, F.lit(0)).alias("slot")).mapInArrow(
        plain, "doc_id long, text string, n_words long, kept_sha256 string" + extra)
    return (
        first_pass.join(marks.withColumnRenamed("doc", "doc_id"), "doc_id", "left")
        .withColumn("n_removed", F.lit(0).cast("long"))
        .mapInArrow(finish, "doc_id long, n_words long, n_removed long, kept_sha256 string" + extra)
    )
