"""Operator 1: repeated single lines, and texts that share a doc_id."""

import random

from basketry.llm import lines

SCHEMA = "doc_id long, text string"
LONG = "this single line has rather more than eight words in it"


def brute(rows, min_lines=2, line_words=8):
    """Later copies, in order of doc_id, of runs and of long lines."""
    texts = sorted((d, t.split("\n")) for d, t in rows)
    seen, out = set(), {}
    marks = {d: set() for d, _ in texts}
    for d, ls in texts:
        for i in range(len(ls)):
            for n in (min_lines, 1):
                run = tuple(ls[i:i + n])
                if len(run) < n or n == 1 and len(run[0].split()) < line_words:
                    continue
                if (n, run) in seen:
                    marks[d] |= set(range(i, i + n))
                seen.add((n, run))
    for d, ls in texts:
        out[d] = "\n".join(x for i, x in enumerate(ls) if i not in marks[d])
    return out


def test_single_lines_and_runs_equal_brute_force(spark):
    rng = random.Random(8)
    pool = ["", "}", "a b", "one two three four five six seven eight", LONG, LONG + " again", "x y z w v u t"]
    rows = [(d, "\n".join(rng.choice(pool + [f"unique {d} {k}"]) for k in range(rng.randint(1, 12)))) for d in range(60)]
    got = {r.doc_id: r.kept_text for r in lines.dedup_lines(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == brute(rows)


def test_one_line_documents(spark):
    rows = [(1, LONG), (2, LONG), (3, "short line"), (4, "short line")]
    got = {r.doc_id: (r.n_removed, r.kept_text) for r in lines.dedup_lines(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {1: (0, LONG), 2: (1, ""), 3: (0, "short line"), 4: (0, "short line")}


def test_two_texts_under_one_doc_id(spark):
    """Neither text loses lines that occur only in it."""
    a, b = f"{LONG} a\nfoo\nbar", f"{LONG} b\nbaz\nqux"
    rows = [(1, a), (1, b), (1, a), (2, f"{LONG} c\nfoo\nbar")]
    got = sorted((r.doc_id, r.kept_text) for r in lines.dedup_lines(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == sorted([(1, a), (1, b), (1, a), (2, f"{LONG} c")])
