"""Vectorised word kernel shared by the text operators.

A word is ``[^\\x20\\x09-\\x0D]+``.  ``batch_words`` hashes every word of an
Arrow batch of texts with numpy alone: a polynomial hash over the UTF-8
bytes, taken from running sums, so the cost is a few passes over the bytes
and never a Python step per word.  Nulls count as empty texts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
SEGMENT = 1 << 20  # bytes hashed at a time; bounds the per-byte temporaries
_BASE = U64(0x9E3779B97F4A7C15)
_INV = U64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_GRAM = U64(0xD6E8FEB86659FD93)
WORD_POWER = U64(0xA0761D6478BD642F)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_BYTE = mix64(np.arange(1, 257, dtype=U64) * _BASE)
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[65:91] = _BYTE[97:123]
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_NOT_ALNUM = _SPACE.copy()  # ASCII marks part words too; other characters stay in them
_NOT_ALNUM[[b for b in range(128) if not chr(b).isalnum()]] = True
_powers: dict[int, np.ndarray] = {}


def power_table(base: U64, n: int) -> np.ndarray:
    """Powers 0..n-1 (or more) of an odd base, kept for the next call."""
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        table = np.full(n, base, dtype=U64)
        table[0] = 1
        have = _powers[int(base)] = np.multiply.accumulate(table)
    return have


@dataclass
class Words:
    """Words of a batch: byte spans in ``data``, hashes, and for document d
    the word range ``first[d]:first[d + 1]``."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray
    offsets: np.ndarray

    def text_bytes(self, d: int) -> bytes:
        return self.data[self.offsets[d]:self.offsets[d + 1]].tobytes()


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string column, nulls as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    if len(column) == 0:
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return offsets - offsets[0], raw[offsets[0]:offsets[-1]]


def batch_words(column: pa.Array, lower: bool = False, plain: bool = False) -> Words:
    """Words of each text; ``lower`` hashes A-Z as a-z, and ``plain`` drops
    ASCII punctuation (it then parts words as white space does)."""
    offsets, data = utf8(column)
    n = len(data)
    solid = ~(_NOT_ALNUM if plain else _SPACE)[data]
    begin = solid.copy()
    begin[1:] &= ~solid[:-1]
    stop = solid.copy()
    stop[:-1] &= ~solid[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < n)]
    begin[cuts] = solid[cuts]  # texts abut in the buffer: a new one starts a word
    stop[cuts - 1] = solid[cuts - 1]
    start, end = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    out = np.empty(len(start), dtype=U64)
    table = _BYTE_LOWER if lower else _BYTE
    i = 0
    while i < len(start):  # segments end at word boundaries
        j = max(i + 1, int(np.searchsorted(end, start[i] + SEGMENT, side="right")))
        lo, hi = int(start[i]), int(end[j - 1])
        power = power_table(_BASE, max(SEGMENT, hi - lo) + 1)
        back = power_table(_INV, max(SEGMENT, hi - lo) + 1)
        run = np.empty(hi - lo + 1, dtype=U64)
        run[0] = 0
        np.cumsum(table[data[lo:hi]] * power[:hi - lo], out=run[1:])
        s, e = start[i:j] - lo, end[i:j] - lo
        out[i:j] = mix64((run[e] - run[s]) * back[s] + (e - s).astype(U64))
        i = j
    return Words(data, start, end, out, np.searchsorted(start, offsets), offsets)


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n consecutive entries of ``h`` (may be empty)."""
    k = len(h) - n + 1
    if k <= 0:
        return np.zeros(0, dtype=U64)
    acc = np.zeros(k, dtype=U64)
    for j in range(n):
        acc = acc * _GRAM + h[j:j + k]
    return mix64(acc)


def slices(batch: pa.RecordBatch, column: str, limit: int = 1 << 20):
    """Parts of a batch holding at most ``limit`` bytes of ``column`` (one
    longer text stands alone), so that per-word arrays stay small.  When the
    batch is done, Arrow memory that nothing holds any more is given back: a
    worker outlives its task and else keeps its largest batch's memory."""
    if batch.num_rows == 0:
        return
    col = batch.column(batch.schema.get_field_index(column))
    size = np.asarray(pc.fill_null(pc.binary_length(col), 0), dtype=np.int64)
    total, at = np.cumsum(size), 0
    while at < len(size):
        base = total[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(total, base + limit, side="right")))
        yield batch.slice(at, to - at)
        at = to
    pa.default_memory_pool().release_unused()
