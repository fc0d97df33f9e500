"""The prefix filter of the similarity join: exact at any number of shingles."""

import random

import numpy as np
import pytest

from basketry.llm import jaccard
from basketry.llm.common import bit_set
from basketry.llm.words import batch_words
from pyspark.sql import functions as F
import pyarrow as pa


@pytest.mark.parametrize("bucket, chunk", [(1 << 18, 1 << 20), (64, 500)])
def test_only_shared_first_shingles_become_tokens(spark, monkeypatch, bucket, chunk):
    """Counts do not weaken as shingles grow in number: hashed tables of fixed
    size let the first shingles of unrelated sets through once they filled."""
    monkeypatch.setattr(jaccard, "BUCKET", bucket)
    monkeypatch.setattr(jaccard, "CHUNK_SHINGLES", chunk)
    rng = random.Random(5)
    texts = [" ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(rng.choice([3, 8, 60, 300]))) for _ in range(200)]
    texts += [f"{t} more" for t in texts[:40]] + [f"{t} common words at the end of all" for t in texts[40:80]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    sim = jaccard.Similarity()
    sets = jaccard.shingle_sets(batch_words(pa.array(texts), lower=True), sim.shingle)
    token = lambda h: (int(h) >> jaccard.CODE) << jaccard.BUCKET_BITS | int(h) % (1 << bits)
    total = sum(map(len, sets))
    bits = int(np.clip(np.ceil(np.log2(max(1, total / 4 / bucket))), 3, jaccard.BUCKET_BITS))
    sent = [s[:max(jaccard._sampled(s), sim.prefix(len(s)))] for s in sets]
    times = {}
    for h in np.concatenate(sent).tolist():
        times[h] = times.get(h, 0) + 1
    want = {}
    for i, s in enumerate(sets):
        quarter = jaccard._sampled(s)
        order = sorted(sent[i].tolist(), key=lambda h: (0 if times[h] == 1 else times[h].bit_length(), token(h)) if h < 1 << 62 else (999, h))
        first = order[:sim.prefix(len(s))]
        assert quarter >= sim.prefix(len(s)) or set(sent[i].tolist()) == set(first)
        if shared := {token(h) for h in first if times[h] > 1}:
            want[i] = shared
    fps = [(i, jaccard.fingerprint(s), len(s)) for i, s in enumerate(sets)]
    classes = spark.createDataFrame(fps, "node long, fp long, n long")
    kept = spark.sparkContext.broadcast(bit_set(classes, F.pmod(F.xxhash64("node"), F.lit(1 << jaccard.NODE_BITS)), jaccard.NODE_BITS))
    got = jaccard.first_tokens(docs, classes, kept, sim).collect()
    assert {r.node: set(r.tokens) for r in got} == want and len(got) == len(want)
    assert {(r.node, r.fp, r.n) for r in got} <= set(fps)
    assert len(want) < 200 and all(len(t) <= sim.prefix(len(sets[i])) for i, t in want.items())
