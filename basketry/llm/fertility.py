"""Operator 7 - quality rules from tokeniser fertility.

A public vocabulary is applied to every word of every whole text (a word is
encoded as it stands after one space) and three measures are taken per
document: characters per token, the share of tokens that hold only a piece of
a character (byte fallback) and the entropy of the document's own tokens, as a
share of the most that so many tokens (1,024 at most) could have.  A document is kept when each
measure lies in the band of its language, or of its script where the language
has no band.  Plain text statistics are taken in the same pass.

One narrow pass: no shuffle, nothing depends on other rows, so a rerun task
gives the same rows.  Words are encoded once per slice of 4 MB, so memory is
bounded by the slice or the longest single text.

Defined results: null or empty text has no words and fails the base rule; null
language uses the script's band; repeated rows get equal results; other
columns are ignored by ``measure`` and kept as they are by ``keep_documents``.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import batch_words, grams, mix64, slices

ENTROPY_TOKENS = 1024  # natural text gains little entropy beyond so many tokens


@dataclass(frozen=True)
class Band:
    """Accepted ranges; natural prose lies well inside."""

    chars_per_token: tuple[float, float]
    max_fallback: float
    min_entropy: float


@dataclass(frozen=True)
class Rules:
    vocabulary: str = "/opt/tokenizers/byte_bpe_50k.tiktoken"
    min_words: int = 20
    max_repeat_percent: int = 30
    window: int = 8
    languages: dict[str, Band] = field(default_factory=lambda: {
        "en": Band((1.6, 8.0), 0.15, 0.50),
        "de": Band((1.5, 8.0), 0.20, 0.50),
        "fr": Band((1.4, 8.0), 0.25, 0.50),
        "es": Band((1.4, 8.0), 0.25, 0.50),
    })
    scripts: dict[str, Band] = field(default_factory=lambda: {
        "latin": Band((1.3, 9.0), 0.30, 0.45),
        "other": Band((0.3, 9.0), 0.95, 0.40),
    })


MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "kept boolean, n_tokens long, chars_per_token double, fallback_share double, token_entropy double, band string"
)
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"[#*$%&|<>]".strip(b"[]"))] = True
_encoders: dict[str, tuple] = {}


def _encoder(path: str):
    """(encoding, flag per token: its bytes are not whole characters); made
    once per Python worker."""
    if path not in _encoders:
        import tiktoken

        pattern = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        partial = np.zeros(max(ranks.values()) + 1, dtype=bool)
        for token, i in ranks.items():
            try:
                token.decode()
            except UnicodeDecodeError:
                partial[i] = True
        _encoders[path] = tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), partial
    return _encoders[path]


def _encode(enc, words: list[bytes]) -> list[list[int]]:
    """Every word whole: the encoder's merges take n log n steps."""
    return [enc.encode_ordinary(" " + w.decode("utf-8", "replace")) for w in words]


def _dup_lines(text: bytes) -> int:
    seen, n = set(), 0
    for line in text.split(b"\n"):
        if line.strip():
            if line in seen:
                n += 1
            else:
                seen.add(line)
    return n


def _per_document(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    run = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return run[first[1:]] - run[first[:-1]]


def _measure(texts: pa.Array, langs: list, rules: Rules) -> dict[str, np.ndarray]:
    enc, partial = _encoder(rules.vocabulary)
    w = batch_words(texts)
    n, k = len(w.first) - 1, rules.window
    n_words = np.diff(w.first)
    doc = np.repeat(np.arange(n), n_words)
    # code points in words: bytes that do not continue a character
    lead = np.concatenate(([0], np.cumsum((w.data & 0xC0) != 0x80, dtype=np.int64)))
    word_chars = lead[w.end] - lead[w.start]
    chars = _per_document(word_chars, w.first)
    symbols = _per_document(_SYMBOL[w.data], w.offsets)
    latin = _per_document(((w.data >= 65) & (w.data <= 90)) | ((w.data >= 97) & (w.data <= 122))
                          | ((w.data >= 0xC3) & (w.data <= 0xC9)), w.offsets)
    # words inside windows that the same text holds twice or more
    g = grams(w.hash, k)
    repeat = np.zeros(len(w.hash) + 1, dtype=np.int64)
    if len(g):
        at = np.flatnonzero(doc[:len(g)] == doc[k - 1:])
        key = g[at] ^ mix64(doc[at].astype(np.uint64) + np.uint64(1))
        _, back, count = np.unique(key, return_inverse=True, return_counts=True)
        twice = at[count[back] > 1]
        np.add.at(repeat, twice, 1)
        np.add.at(repeat, twice + k, -1)
    n_repeat = _per_document(np.cumsum(repeat)[:-1] > 0, w.first)
    # tokens: each distinct word of the slice is encoded once
    _, where, which = np.unique(w.hash, return_index=True, return_inverse=True)
    ids = _encode(enc, [w.data[w.start[i]:w.end[i]].tobytes() for i in where])
    per = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
    flat = np.fromiter((t for x in ids for t in x), dtype=np.int64, count=int(per.sum()))
    base = np.concatenate(([0], np.cumsum(per)))
    bad = np.concatenate(([0], np.cumsum(partial[flat], dtype=np.int64)))
    n_tokens = _per_document(per[which], w.first)
    n_bad = _per_document((bad[base[1:]] - bad[base[:-1]])[which], w.first)
    m = per[which]
    spread = np.repeat(base[which] - np.concatenate(([0], np.cumsum(m)[:-1])), m) + np.arange(int(m.sum()))
    pairs, times = np.unique(np.repeat(doc, m) * len(partial) + flat[spread], return_counts=True)
    owner = pairs // len(partial)
    total = np.maximum(n_tokens, 1)
    p = times / total[owner]
    bits = np.bincount(owner, weights=-p * np.log2(p), minlength=n)
    entropy = np.where(n_tokens > 1, bits / np.log2(np.clip(total, 2, ENTROPY_TOKENS)), 0.0)
    cpt, fallback = chars / total, n_bad / total
    failed = (n_words < rules.min_words) | (100 * n_repeat > rules.max_repeat_percent * n_words)
    names, kept = [], np.zeros(n, dtype=bool)
    for d in range(n):
        name = langs[d] if langs[d] in rules.languages else None
        band = rules.languages[name] if name else rules.scripts[name := "latin" if 2 * latin[d] >= chars[d] else "other"]
        names.append(name)
        kept[d] = (not failed[d] and band.chars_per_token[0] <= cpt[d] <= band.chars_per_token[1]
                   and fallback[d] <= band.max_fallback and entropy[d] >= band.min_entropy)
    dup = [_dup_lines(w.text_bytes(d)) for d in range(n)]
    return {"n_words": n_words, "word_chars": chars, "n_symbols": symbols, "n_dup_lines": np.asarray(dup, dtype=np.int64),
            "n_repeat_words": n_repeat, "base_failed": failed, "kept": kept, "n_tokens": n_tokens, "chars_per_token": cpt,
            "fallback_share": fallback, "token_entropy": entropy, "band": names}


def _columns(part: pa.RecordBatch, rules: Rules) -> dict[str, np.ndarray]:
    lang = part.column("lang").to_pylist() if "lang" in part.schema.names else [None] * part.num_rows
    return _measure(part.column("text"), lang, rules)


def measure(docs: DataFrame, rules: Rules | None = None) -> DataFrame:
    """(doc_id, the measures, base_failed, kept) for every row of ``docs``,
    which has ``doc_id``, ``text`` and perhaps ``lang``."""
    rules = rules or Rules()
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                got = _columns(part, rules)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *map(pa.array, got.values())], ["doc_id", *got])

    return docs.select(F.col("doc_id").cast("long"), F.col("text"), lang.alias("lang")).mapInArrow(
        run, f"doc_id long, {MEASURES}")


def keep_documents(docs: DataFrame, rules: Rules | None = None) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns."""
    rules = rules or Rules()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                yield part.filter(pa.array(_columns(part, rules)["kept"]))

    return docs.mapInArrow(run, docs.schema)


def entropy_bits(tokens: list[int]) -> float:
    """Plain entropy of a token list, as a share of the most possible; the
    definition the tests compare with."""
    n = len(tokens)
    if n < 2:
        return 0.0
    return -sum(c / n * math.log2(c / n) for c in (tokens.count(t) for t in set(tokens))) / math.log2(min(n, ENTROPY_TOKENS))
