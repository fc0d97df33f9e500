"""The index of op8 is fitted on every passage of every document."""

import numpy as np
import pyarrow as pa

from basketry.llm import decontaminate as d
from basketry.llm.words import batch_words


def test_index_is_fitted_on_all_documents(spark):
    """Terms and products took about 1,000 documents before."""
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{i}" for i in rng.zipf(1.4, n) if i < 400) for n in rng.integers(0, 150, 3000)] + ["", None]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(5)
    rows = [(1, "w1 w2 w399 w7 planted item words", None), (2, "another w3 w5 item w8", None)]
    how = d.Search(terms=50, rank=8)
    words = [(t or "").split() for t in texts]
    held = {}
    for w in words:
        for x in set(w):
            held[x] = held.get(x, 0) + 1
    items = [r[1].split() for r in rows]
    pairs = {p for w in items for p in zip(w, w[1:])}
    free = {}
    for w in words:
        gone = {j + k for j, p in enumerate(zip(w, w[1:])) if p in pairs for k in (0, 1)}
        for x in {x for j, x in enumerate(w) if j not in gone}:
            free[x] = free.get(x, 0) + 1
    hashed = lambda xs: batch_words(pa.array([" ".join(xs)]), lower=True, plain=True).hash.tolist()
    code = dict(zip(held | dict.fromkeys(sum(items, [])), hashed(list(held | dict.fromkeys(sum(items, [])))), strict=True))
    order = sorted((x for x in held if held[x] > 1), key=lambda x: (-held[x], np.uint64(code[x]).view(np.int64)))
    terms = sorted({code[x] for x in order[:50]} | {code[x] for x in sum(items, [])})
    index = d.build_index(docs, rows, how)
    assert index.terms.tolist() == terms
    name = {h: x for x, h in code.items()}
    n = len(texts)
    weight = np.log1p(n / np.clip([free.get(name[h], 0) for h in terms], 1, n))
    assert np.allclose(index.weight, weight)

    def gram(lists):
        out = np.zeros((len(terms), len(terms)))
        for w in lists:
            for k in range(0, len(w), 48):
                row = np.zeros(len(terms))
                for x in w[k:k + 48]:
                    if code[x] in terms:
                        row[terms.index(code[x])] += weight[terms.index(code[x])]
                square = sum(weight[terms.index(code[x])] ** 2 for x in w[k:k + 48] if code[x] in terms)
                out += np.outer(row, row) / max(square, 1e-12)
        return out

    whole = gram(words) + max(16.0, 0.016 * n) * gram(items)
    q = np.random.RandomState(17).standard_normal((len(terms), 8))
    for _ in range(2):
        q, _ = np.linalg.qr(whole @ q)
    got = index.vectors[:-1] / weight[:, None]
    assert np.allclose(got @ got.T, q @ q.T, atol=1e-4)
