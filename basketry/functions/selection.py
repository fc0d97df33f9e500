"""Exact quantiles of many columns at once, by distributed selection.

A quantile needs the values at two ranks.  Instead of sorting, the ranks are
closed in on by counting, for all columns (and groups) in the same scans:

1. one aggregate gives count, least, largest and, from a bounded sketch, a
   bracket of values around each rank;
2. one scan counts the values below and inside each bracket, which proves (or
   moves) the bracket, and of the values inside, a few in ten thousand where
   they differ, the distinct ones, or equal-width bins where a bracket holds
   many.  A bin that holds a wanted rank becomes the next bracket, until the
   rank is its least, largest or only value.

No sort, window or self-join, and nothing is shuffled but partial aggregates.
The driver only sees counts: at most ``bins`` for a bracket.  Two scans are
the rule (three with groups), of which the first can be observed while the
table is written; each further one divides what is left by up to ``bins``.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.io import materialise

BINS = 1_024
SMALL = 20_000  # values inside all brackets, up to which they are counted one by one
MOST_GROUPS = 1_000
ACCURACY = 10_000  # of the sketch: ranks are right to 1 in so many
ROUNDS = 200


@dataclass
class _Rank:
    """A wanted rank of one column and group, and what is known of it."""

    group: int
    column: int
    rank: int
    low: float
    high: float
    inside: int | None = None  # values in the bracket, once counted
    value: float | None = None

    @property
    def bracket(self) -> tuple:
        return self.group, self.column, self.low, self.high


def _middle(low: float, high: float) -> float:
    """A value between, also where the ends are infinite."""
    if math.isinf(low) or math.isinf(high):
        low, high = max(low, -1.7e308), min(high, 1.7e308)
    return low / 2 + high / 2


def _value(col: str) -> Column:
    """A column as double; NaN is no value, as NULL is none."""
    v = F.col(f"`{col}`").cast("double")
    return F.when(~F.isnan(v), v)


def _values(df: DataFrame, cols: list[str], by: list[str]) -> DataFrame:
    return df.select(*[F.col(f"`{b}`").alias(f"__b{i}") for i, b in enumerate(by)],
                     *[_value(c).alias(f"__v{i}") for i, c in enumerate(cols)])


def sketch(values: list[Column], probs: list[float]) -> list[Column]:
    """Aggregates of the first scan: of every column count, least, largest
    and a bracket for each probability.  They may also be observed while the
    table is written, which saves the scan."""
    near = [max(0.0, p - 2 / ACCURACY) for p in probs] + [min(1.0, p + 2 / ACCURACY) for p in probs]
    return [x for i, v in enumerate(values) for x in (
        F.count(v).alias(f"n{i}"), F.min(v).alias(f"lo{i}"), F.max(v).alias(f"hi{i}"), F.percentile_approx(v, near, ACCURACY).alias(f"q{i}"))]


def staged_sketch(df: DataFrame, name: str, cols: list[str], probs: list[float]) -> tuple[DataFrame, dict]:
    """``df`` as a staged table, and its sketch from the same pass."""
    seen = Observation(f"sketch-{uuid.uuid4().hex[:8]}")
    table = materialise(df.observe(seen, *sketch([_value(c) for c in cols], probs)), name)
    return table, seen.get


def _sketch(values: DataFrame, n_cols: int, probs: list[float], keys: list[str]) -> list:
    aggs = sketch([F.col(f"__v{i}") for i in range(n_cols)], probs)
    return values.groupBy(*keys).agg(*aggs).limit(MOST_GROUPS + 1).collect()


def _with_brackets(values: DataFrame, keys: list[str], groups: list[tuple], wanted: list[tuple]) -> tuple[DataFrame, list[tuple[int, int]]]:
    """Rows with the brackets of their group as columns ``__a{s}``, ``__z{s}``;
    slots (s, column), in which each group has its own bracket or none."""
    slots: list[tuple[int, int]] = []
    rows = [[] for _ in groups]
    for column in sorted({c for _, c, _, _ in wanted}):
        mine = [[w for w in wanted if w[0] == g and w[1] == column] for g in range(len(groups))]
        for k in range(max(map(len, mine))):
            slots.append((len(slots), column))
            for g, ws in enumerate(mine):
                rows[g] += list(ws[k][2:]) if k < len(ws) else [None, None]
    cols = [c for s, _ in slots for c in (f"__a{s}", f"__z{s}")]
    schema = T.StructType([T.StructField("__g", T.IntegerType()), *[values.schema[k] for k in keys],
                           *[T.StructField(c, T.DoubleType()) for c in cols]])
    if keys:  # at most MOST_GROUPS rows
        table = values.sparkSession.createDataFrame([(g, *key, *rows[g]) for g, key in enumerate(groups)], schema)
        renamed = table.select("__g", *[F.col(k).alias(f"__k{k}") for k in keys], *cols)
        same = [F.col(k).eqNullSafe(F.col(f"__k{k}")) for k in keys]
        on = same[0]
        for c in same[1:]:
            on = on & c
        return values.join(F.broadcast(renamed), on), slots
    return values.select(F.lit(0).alias("__g"), "*", *[F.lit(x).cast("double").alias(c) for c, x in zip(cols, rows[0], strict=True)]), slots


def _around(slots: list[tuple[int, int]]) -> list[Column]:
    out = []
    for s, c in slots:
        v, a, z = F.col(f"__v{c}"), F.col(f"__a{s}"), F.col(f"__z{s}")
        out += [F.count_if(v < a).alias(f"b{s}"), F.count_if((v >= a) & (v <= z)).alias(f"i{s}"),
                F.max(a).alias(f"a{s}"), F.max(z).alias(f"z{s}")]
    return out


def _count(values: DataFrame, keys: list[str], groups: list[tuple], wanted: list[tuple], bins: int | None) -> tuple[dict, dict]:
    """Of every bracket (values below, values inside), and in order (least,
    largest, count) of its distinct values or of ``bins`` equal-width bins.
    Both come from one scan; with groups the first takes one of its own."""
    rows, slots = _with_brackets(values, keys, groups, wanted)

    def cell(v: Column, a: Column, z: Column) -> Column:
        if bins is None:
            return v
        return F.coalesce(F.least(F.floor((v - a) / F.nullif(z - a, F.lit(0.0)) * bins), F.lit(bins - 1)), F.lit(0)).cast("double")

    found = F.filter(F.array(*[F.when((F.col(f"__v{c}") >= F.col(f"__a{s}")) & (F.col(f"__v{c}") <= F.col(f"__z{s}")), F.struct(
        F.lit(s).alias("s"), cell(F.col(f"__v{c}"), F.col(f"__a{s}"), F.col(f"__z{s}")).alias("cell"), F.col(f"__v{c}").alias("v")))
        for s, c in slots]), lambda x: x.isNotNull())
    around: dict[tuple, dict] = {}
    seen = None
    if keys:
        around = {r["__g"]: r.asDict() for r in rows.groupBy("__g").agg(*_around(slots)).collect()}
    else:
        seen = Observation(f"around-{uuid.uuid4().hex[:8]}")
        rows = rows.observe(seen, *_around(slots))
    counted = (
        rows.select("__g", F.explode(found).alias("x")).groupBy("__g", "x.s", "x.cell")
        .agg(F.min("x.v").alias("lo"), F.max("x.v").alias("hi"), F.count(F.lit(1)).alias("n"))
    ).collect()
    if seen is not None:
        around = {0: seen.get}
    of = dict(slots)
    bracket = lambda g, s: (g, of[s], around[g][f"a{s}"], around[g][f"z{s}"])
    sums = {bracket(g, s): (r[f"b{s}"], r[f"i{s}"]) for g, r in around.items() for s in of if r[f"a{s}"] is not None}
    cells: dict[tuple, list] = {}
    for r in counted:
        cells.setdefault(bracket(r["__g"], r["s"]), []).append((r["lo"], r["hi"], r["n"]))
    return sums, {k: sorted(v) for k, v in cells.items()}


def select_quantiles(df: DataFrame, cols: list[str], probs: dict[str, float], by: list[str] | None = None,
                     bins: int = BINS, small: int = SMALL, sketched: dict | None = None) -> list[tuple[tuple, dict[str, dict[str, float | None]]]]:
    """[(group values, {column: {name: quantile}})], linearly interpolated as
    Spark's ``percentile`` does it; None for a column without values.  ``df``
    is scanned several times, so it should be a table or cheap to make.
    ``by`` may have ``MOST_GROUPS`` groups (an error beyond).  ``sketched`` is
    the result of ``staged_sketch``, without ``by``."""
    by, names = list(by or []), list(probs)
    keys = [f"__b{i}" for i in range(len(by))]
    values = _values(df, cols, by)
    found = [sketched] if sketched is not None else _sketch(values, len(cols), [probs[n] for n in names], keys)
    if len(found) > MOST_GROUPS:
        raise ValueError(f"more than {MOST_GROUPS} groups of {by}")
    groups = [tuple(r[k] for k in keys) for r in found]
    ranks: dict[tuple[int, int, int], _Rank] = {}
    for g, r in enumerate(found):
        for c in range(len(cols)):
            for k, name in enumerate(names):
                if not r[f"n{c}"]:
                    continue
                h = (r[f"n{c}"] - 1) * probs[name]
                q = r[f"q{c}"]
                for x in (math.floor(h), math.ceil(h)):
                    ranks.setdefault((g, c, x), _Rank(g, c, x, q[k], q[len(names) + k]))
    ends = {(g, c): (r[f"lo{c}"], r[f"hi{c}"]) for g, r in enumerate(found) for c in range(len(cols))}
    for _ in range(ROUNDS):
        open_ = [r for r in ranks.values() if r.value is None]
        if not open_:
            break
        wanted = sorted({r.bracket for r in open_})
        # values that differ are few inside a bracket: the sketch's error, or what was counted there
        many = sum(r.inside if r.inside is not None else 6 / ACCURACY * found[r.group][f"n{r.column}"]
                   for r in {r.bracket: r for r in open_}.values())
        sums, cells = _count(values, keys, groups, wanted, None if many <= small else bins)
        for r in open_:
            below, n = sums[r.bracket]
            if r.rank < below:
                r.low, r.high = ends[r.group, r.column][0], r.low
                continue
            if r.rank >= below + n:
                r.low, r.high = r.high, ends[r.group, r.column][1]
                continue
            before = below
            for lo, hi, n in cells[r.bracket]:
                if r.rank < before + n:
                    if lo == hi or r.rank == before:
                        r.value = lo
                    elif r.rank == before + n - 1:
                        r.value = hi
                    elif (lo, hi) == (r.low, r.high):  # one bin holds all: halve it
                        r.high, r.inside = _middle(lo, hi), n
                    else:
                        r.low, r.high, r.inside = lo, hi, n
                    break
                before += n
    else:
        raise RuntimeError("selection did not end")
    out = []
    for g, r in enumerate(found):
        each: dict[str, dict[str, float | None]] = {}
        for c, col in enumerate(cols):
            each[col] = {}
            for name in names:
                if not r[f"n{c}"]:
                    each[col][name] = None
                    continue
                h = (r[f"n{c}"] - 1) * probs[name]
                lo, hi = math.floor(h), math.ceil(h)
                a, z = ranks[g, c, lo].value, ranks[g, c, hi].value
                each[col][name] = a if lo == hi or a == z else (hi - h) * a + (h - lo) * z
        out.append((groups[g], each))
    return out


def quantile_table(df: DataFrame, col: str, probs: dict[str, float], by: list[str] | None = None) -> DataFrame:
    """``select_quantiles`` of one column as a small table: ``by`` and one
    double per name; without ``by`` one row, also for an empty input."""
    by = list(by or [])
    got = select_quantiles(df, [col], probs, by) or ([] if by else [((), {col: dict.fromkeys(probs)})])
    schema = T.StructType([*[df.schema[b] for b in by], *[T.StructField(n, T.DoubleType()) for n in probs]])
    return df.sparkSession.createDataFrame([(*g, *q[col].values()) for g, q in got], schema)
