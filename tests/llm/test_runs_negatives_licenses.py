"""Operators 11 to 13 against brute force and on odd inputs."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from basketry.llm import common, licenses, negatives, queries, runs
from basketry.llm.words import batch_words

TINY = "/root/testdata/sf0.001"


def brute_runs(words, periods=4, least=6):
    n, out = len(words), []
    for q in range(1, n // periods + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            size = j + q - i
            part = words[i:i + size]
            if j > i and size >= max(least, periods * q) and not any(
                    all(part[k] == part[k + r] for k in range(size - r)) for r in range(1, q)):
                out.append((i, size, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("min_gain", [0.0, 1 / 1024, 2.0])
def test_runs_equal_brute_force(min_gain):
    rng = random.Random(5)
    texts = []
    for _ in range(250):
        letters, n, words = rng.choice(["a", "ab", "abc", "abcde"]), rng.choice([0, 1, 5, 6, 12, 60, 160]), []
        while len(words) < n:
            words += [rng.choice(letters) for _ in range(rng.randint(1, 7))] * rng.randint(1, 9)
        texts.append(" ".join(words))
    w = batch_words(pa.array(texts))
    doc, start, end, period = runs.runs_of(w, runs.Periodic(min_gain=min_gain))
    found = 0
    for d, text in enumerate(texts):
        m = doc == d
        got = list(zip((start[m] - w.first[d]).tolist(), (end[m] - start[m]).tolist(), period[m].tolist()))
        assert got == brute_runs(text.split()), text
        found += len(got)
    assert found > 300


def test_runs_query_equals_brute_force(spark):
    """The registered query, its input changed as the contract says."""
    got = {r["doc_id"]: r for r in queries.QUERIES["op11_repair_runs"](spark, TINY).collect()}
    long_runs = 0
    for r in common.documents(spark, TINY).collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")
        h, n = zlib.crc32(str(r["doc_id"]).encode()), len(words)
        if h % 10 == 0 and n:
            a = (h // 10) % n
            p = 1 + (n - a) // (3 + (h // 10) % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        want = brute_runs(words)
        gone = {i for s, size, q in want for i in range(s + q, s + size)}
        top = min(want, key=lambda x: (-x[1], x[0], x[2])) if want else (None,) * 3
        g = got[r["doc_id"]]
        assert (g["n_runs"], g["start"], g["length"], g["period"]) == (len(want), *top)
        assert g["exponent_milli"] == (1000 * top[1] // top[2] if want else None)
        assert g["runs_sha256"] == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in want).encode()).hexdigest()
        assert g["collapsed_sha256"] == hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest()
        long_runs += bool(want)
    assert long_runs >= 5


ODD = "doc_id long, text string, runs string, base string, found int, n_words int, n long"


def odd_texts(spark):
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "x " * 5000), (4, "x " * 5000), (None, "a b " * 4), (5, "ü 漢字 😀 " * 4),
            (6, "Licensed under the Apache License, Version 2.0."), (6, "released under the MIT  license"), (7, "one")]
    return spark.createDataFrame([(*r, "q", "b", 1, 2, 3) for r in rows], ODD)


def test_runs_odd_inputs(spark):
    out = runs.digest(runs.find_runs(odd_texts(spark))).collect()
    by = {}
    for r in out:
        by.setdefault(r["doc_id"], []).append((r["n_runs"], r["start"], r["length"], r["period"]))
    none = (0, None, None, None)
    assert by[1] == by[2] == by[3] == by[7] == [none] and by[4] == [(1, 0, 5000, 1)] * 2
    assert by[None] == [(1, 0, 8, 2)] and by[5] == [(1, 0, 12, 3)] and by[6] == [none] * 2
    assert all(r["runs_sha256"] and r["collapsed_sha256"] for r in out)
    assert runs.find_runs(odd_texts(spark).limit(0)).count() == 0
    kept = {r["doc_id"]: r["kept_text"] for r in runs.find_runs(odd_texts(spark)).collect()}
    assert kept[4] == "x" and kept[5] == "ü 漢字 😀" and kept[None] == "a b"


def brute_negatives(rows, anchors, positives=5, negatives_=5, low=80, high=100):
    out = set()
    for a, la, va in rows:
        if a not in anchors:
            continue
        score = sorted((-int(va @ v), i, label) for i, label, v in rows if i != a)
        for s, p, _ in [x for x in score if x[2] == la][:positives]:
            near = [x for x in score if x[2] != la and low * -s <= 100 * -x[0] <= high * -s][:negatives_]
            out |= {(a, p, k + 1, x[1], -s, -x[0]) for k, x in enumerate(near)}
    return out


@pytest.mark.parametrize("kind", ["random", "clustered", "hot"])
def test_negatives_equal_brute_force(spark, kind):
    """Exact whatever the codebooks prune; one vector in a third of the rows
    fills several blocks."""
    rng = np.random.default_rng(3)
    n, dim = 900, 8
    v = rng.integers(-60, 60, (n, dim))
    if kind == "clustered":
        v = rng.integers(-200, 200, (12, dim))[rng.integers(0, 12, n)] + rng.integers(-9, 9, (n, dim))
    if kind == "hot":
        v[::3] = v[0]
    rows = [(i, int(rng.integers(0, 4)), v[i]) for i in range(n)]
    df = spark.createDataFrame([(i, label, [float(x) for x in q], "c", 1) for i, label, q in rows],
                               "id long, label long, v array<double>, cell string, score int")
    how = negatives.Mining(rows_per_cell=20, block=32, anchors=8, first_rows=64, growth=4)
    got = {tuple(r) for r in negatives.mine(df, F.col("id") % 50 == 0, how).collect()}
    assert got == brute_negatives(rows, set(range(0, n, 50)))


def test_walk_is_sorted_and_whole():
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=7), rng.normal(size=5)
    cells = list(negatives.walk(a, b, -1e9))
    sums = [a[i] + b[j] for i, j in cells]
    assert sorted(cells) == [(i, j) for i in range(7) for j in range(5)] and sums == sorted(sums, reverse=True)
    assert len(list(negatives.walk(a, b, 0.5))) == sum(s >= 0.5 for s in sums)


def test_negatives_visit_few_cells_of_clusters(spark):
    """On clustered vectors the certified walk leaves most of the index out."""
    rng = np.random.default_rng(2)
    centre = rng.integers(-300, 300, (40, 8))
    v = centre[np.arange(4000) % 40] + rng.integers(-4, 4, (4000, 8))
    df = spark.createDataFrame([(i, i % 2, [float(x) for x in q]) for i, q in enumerate(v)], "id long, label long, v array<double>")
    how = negatives.Mining(rows_per_cell=20, first_rows=64, growth=4)
    ws = common.Workspace(spark, "test")
    _, books = negatives.build_index(ws, df, 4000, 8, how)
    q = v[:1].astype(float)
    first, second = negatives._bounds(books, q)
    fifth = np.sort(v @ v[0])[-6]
    seen = [i * len(books.words[1]) + j for i, j in negatives.walk(first[0], second[0], float(fifth))]
    assert books.rows[seen].sum() < 0.25 * 4000
    ws.close()


def test_negatives_odd_inputs(spark):
    schema = "vec_id long, embedding array<float>, label int, id string, v int"
    ok = [0.5, -0.25]
    rows = [(0, ok, 1), (1, ok, 1), (1, ok, 1), (2, [0.5, -0.3], 1), (3, ok, 2), (4, [0.5], 2), (5, None, 2), (6, [float("nan"), 1.0], 2),
            (8, [float("inf"), 1.0], 2), (9, [None, 1.0], 2), (10, ok, None), (None, ok, 2), (11, [], 3)]
    df = spark.createDataFrame([(*r, "x", 9) for r in rows], schema)
    prepared = df.select(F.col("vec_id").alias("id"), "label", negatives.quantised("embedding").alias("v"))
    got = {tuple(r) for r in negatives.mine(prepared, F.col("id") % 100 == 0).collect()}
    whole = [(0, 1, np.array([128, -64])), (1, 1, np.array([128, -64])), (2, 1, np.array([128, -77])),
             (3, 2, np.array([128, -64])), (4, 2, np.array([128, 0])), (11, 3, np.array([0, 0]))]
    assert got == brute_negatives(whole, {0}) and len(got) == 3
    none = negatives.mine(prepared.limit(0), F.col("id") % 100 == 0)
    assert none.count() == 0 and none.columns == [c.split()[0] for c in negatives.RESULT.split(", ")]
    assert negatives.mine(prepared.filter("id = 3"), F.col("id") == 3).count() == 0


MIT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
       "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
       "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software")


def labels_of(spark, texts, **how):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = licenses.digest(licenses.scan_licenses(df, licenses.Scan(**how))).collect()
    return {r["doc_id"]: r for r in out}


def test_licenses_find_passages(spark):
    noise = "lorem ipsum dolor sit amet " * 30
    changed = MIT.replace("sublicense", "relicense").replace("merge", "join")  # most words in place
    no_key = MIT.replace("any person obtaining a copy", "each person who gets one copy")
    scattered = " ".join(sorted(MIT.split()))
    got = labels_of(spark, [noise + MIT + ". " + noise, noise + changed, no_key, scattered, noise,
                            "Licensed under CC BY-NC 4.0. and licensed under the Apache License, Version 2.0",
                            "This work is licensed under the GNU General Public License, version 3."])
    assert got[0]["labels"] == "mit" and got[0]["score"] == 1.0 and got[0]["base_labels"] == ""
    assert got[1]["labels"] == "mit" and 0.9 < got[1]["score"] < 1
    assert [got[k]["labels"] for k in (2, 3, 4)] == [""] * 3 and got[4]["score"] == 0
    assert got[5]["labels"] == "apache,apache-2.0,cc-by,cc-by-nc-4.0" and got[5]["n_base"] == 2
    assert got[6]["labels"] == "gpl,gpl-3.0" and got[6]["first_word"] == 6


def test_licenses_long_repetitive_text(spark):
    text = "the software " * 4000 + MIT + " the mit license" * 500
    got = labels_of(spark, [text])[0]
    assert got["labels"] == "mit" and got["n_base"] == 500 and got["first_word"] == 8000 + len(licenses.TEMPLATES[0][1].split()) + 1


def test_licenses_odd_inputs(spark):
    out = licenses.digest(licenses.scan_licenses(odd_texts(spark))).collect()
    by = {}
    for r in out:
        by.setdefault(r["doc_id"], set()).add((r["n_words"], r["n_base"], r["labels"], r["score"]))
    assert by[1] == by[2] == by[3] == {(0, 0, "", 0.0)} and by[4] == {(5000, 0, "", 0.0)} and by[None] == {(8, 0, "", 0.0)}
    assert by[5] == {(12, 0, "", 0.0)} and by[6] == {(8, 1, "apache,apache-2.0", 1.0), (5, 1, "mit", 1.0)} and len(out) == 10
    assert licenses.scan_licenses(odd_texts(spark).limit(0)).count() == 0
    assert labels_of(spark, ["Kelvin cc by", "CCé by", "ccby", "cc-by."])[3]["n_base"] == 1


def test_licenses_plan_is_native(spark):
    plan = queries.QUERIES["op13_positional_licenses"](spark, TINY)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange|Join", plan)
