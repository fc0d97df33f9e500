"""Shapley tables per leaf against all coalitions of the path's features."""

import itertools
import math

import numpy as np

from basketry.operators import attribution as at

PATHS = [
    (0, 1.5, [(0, "num", 0.2, True, 0.3), (2, "cat", [0.0, 2.0], False, 0.6), (0, "num", -0.5, False, 0.8)]),
    (0, -2.0, [(1, "num", 0.0, False, 0.5)]),
    (1, 0.7, [(1, "num", 0.4, True, 0.25), (0, "num", 0.2, False, 0.7), (2, "cat", [1.0], True, 0.4)]),
    (1, 3.0, []),
]


def brute(x, weights):
    phi = np.zeros(3)
    for t, value, path in PATHS:
        feats = sorted({p[0] for p in path})
        m = len(feats)

        def worth(known):
            out = weights[t] * value
            for f, kind, param, left, ratio in path:
                goes = (x[f] <= param) if kind == "num" else (x[f] in param)
                out *= float(goes == left) if f in known else ratio
            return out

        for i in feats:
            rest = [j for j in feats if j != i]
            for size in range(m):
                w = math.factorial(size) * math.factorial(m - size - 1) / math.factorial(m)
                for s in itertools.combinations(rest, size):
                    phi[i] += w * (worth({*s, i}) - worth(set(s)))
    return phi


def test_tables_equal_all_coalitions():
    rng = np.random.default_rng(1)
    x = np.column_stack((rng.standard_normal((200, 2)), rng.integers(0, 4, 200)))
    weights = [0.5, 2.0]
    games = at.leaf_games(PATHS, weights)
    assert [table.shape for _, _, table in games] == [(4, 2), (2, 1), (8, 3)]  # cases x features, however many rows
    got = at.shap_games(x, games, 3)
    assert np.abs(got - np.array([brute(row, weights) for row in x])).max() < 1e-12
    assert (at.shap_batch(x, PATHS, weights, 3) == got).all()


def test_a_split_is_compared_once_a_tree():
    sides = at._Sides(np.array([[1.0], [3.0]]))
    first = sides.of(0, 0, "num", 2.0, True)
    assert sides.of(0, 0, "num", 2.0, True) is first and first.tolist() == [True, False]
    assert sides.of(0, 0, "num", 2.0, False).tolist() == [False, True]
