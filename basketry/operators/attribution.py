"""Shapley-value attribution for a Spark gradient-boosted-trees model.

Exact path-dependent tree SHAP, computed per leaf.  For one tree the
conditional expectation given the features in S is

    f_S(x) = sum over leaves l of  v_l * prod_{j in U_l} (a_lj(x) if j in S else r_lj)

where U_l are the distinct features split on along the path to l,
a_lj(x) in {0, 1} says whether x satisfies every split on j along that path,
and r_lj is the product of cover ratios (child count / parent count) of
those splits.  Each leaf is therefore a game over at most ``depth``
players, and its Shapley values are a weighted sum over the <= 2^(m-1)
coalitions of the other path features — evaluated for a whole batch of rows
at once with numpy (the coalition sum is read off the coefficients of a
product of linear polynomials).  Sum over trees with the ensemble weights gives the
attribution of the raw margin; Shapley efficiency holds per row:
sum_i phi_i = margin(x) - E[margin].

Execution: the model's node table is read from its saved parquet (a Spark
read), turned into a leaf table bounded by trees x 2^depth rows, broadcast,
and applied with ``mapInPandas``; the mean |phi| per feature is a Spark
aggregate.
"""

from __future__ import annotations

import math
import os
import uuid

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _gbt_stage(model):
    return model.stages[-1] if hasattr(model, "stages") else model


def leaf_table(model, spark) -> tuple[list, list[float]]:
    """Leaves of every tree: (tree, value, [(feature, kind, param, go_left,
    cover_ratio), ...]) plus the tree weights."""
    from ..sources.io import checkpoint_dir

    gbt = _gbt_stage(model)
    path = os.path.join(checkpoint_dir(spark), f"gbt-{uuid.uuid4().hex[:10]}")
    gbt.write().overwrite().save(path)
    nodes = spark.read.parquet(os.path.join(path, "data")).select(
        "treeID",
        F.col("nodeData.id").alias("id"),
        F.col("nodeData.prediction").alias("prediction"),
        F.col("nodeData.rawCount").alias("count"),
        F.col("nodeData.leftChild").alias("left"),
        F.col("nodeData.rightChild").alias("right"),
        F.col("nodeData.split.featureIndex").alias("feature"),
        F.col("nodeData.split.leftCategoriesOrThreshold").alias("cats"),
        F.col("nodeData.split.numCategories").alias("ncat"),
    )
    # Bounded by maxIter x (2^(maxDepth+1) - 1) rows: safe to bring to the driver.
    rows = nodes.collect()
    trees: dict[int, dict[int, object]] = {}
    for r in rows:
        trees.setdefault(r["treeID"], {})[r["id"]] = r
    leaves = []
    for t, nd in trees.items():
        root_id = min(nd)  # pre-order ids: root has the smallest id
        stack = [(root_id, [])]
        while stack:
            nid, path = stack.pop()
            n = nd[nid]
            if n["left"] < 0:
                leaves.append((t, float(n["prediction"]), path))
                continue
            kind = "cat" if n["ncat"] is not None and n["ncat"] > 0 else "num"
            param = list(n["cats"]) if kind == "cat" else float(n["cats"][0])
            total = float(n["count"]) or 1.0
            for child, go_left in ((n["left"], True), (n["right"], False)):
                ratio = float(nd[child]["count"]) / total
                stack.append((child, path + [(int(n["feature"]), kind, param, go_left, ratio)]))
    return leaves, [float(w) for w in gbt.treeWeights]


def _coalition_weights(m: int) -> dict[int, float]:
    return {s: math.factorial(s) * math.factorial(m - s - 1) / math.factorial(m) for s in range(m)}


def leaf_games(leaves, weights) -> list[tuple[int, list[tuple[int, list]], np.ndarray]]:
    """Per leaf (tree, [(feature, its splits on the path)], table): a row's
    Shapley values at a leaf only depend on which of the path's m features it
    satisfies, so the 2^m cases are worked out once, for any number of rows.
    Bit k of a case stands for the k-th feature."""
    games = []
    for t, value, path in leaves:
        feats = sorted({p[0] for p in path})
        m = len(feats)
        if m == 0:
            continue
        case = np.arange(1 << m)
        a = {j: (case >> k & 1).astype(float) for k, j in enumerate(feats)}
        r = {j: math.prod(cr for f, *_, cr in path if f == j) for j in feats}
        cw = _coalition_weights(m)
        table = np.zeros((1 << m, m))
        for k, i in enumerate(feats):
            # Coefficient s of prod_{j != i} (r_j + a_j t) is the sum over
            # coalitions S of size s of prod_{j in S} a_j prod_{j not in S} r_j,
            # so the weighted coalition sum costs O(m^2) instead of 2^(m-1).
            coef = [np.ones(1 << m)]
            for j in feats:
                if j == i:
                    continue
                nxt = [coef[0] * r[j]]
                for s_ in range(1, len(coef)):
                    nxt.append(coef[s_] * r[j] + coef[s_ - 1] * a[j])
                nxt.append(coef[-1] * a[j])
                coef = nxt
            acc = sum(cw[size] * c for size, c in enumerate(coef))
            table[:, k] = weights[t] * value * (a[i] - r[i]) * acc
        games.append((t, [(j, [(kind, param, go_left) for f, kind, param, go_left, _ in path if f == j]) for j in feats], table))
    return games


class _Sides:
    """Which rows of a batch go left at a split; a split of a tree is on the
    paths of many leaves and is compared once."""

    def __init__(self, x: np.ndarray):
        self.x, self.tree, self.left = x, None, {}

    def of(self, tree: int, feature: int, kind: str, param, go_left: bool) -> np.ndarray:
        if tree != self.tree:
            self.tree, self.left = tree, {}
        key = feature, kind, tuple(param) if kind == "cat" else param
        if key not in self.left:
            col = self.x[:, feature]
            self.left[key] = col <= param if kind == "num" else np.isin(col, param)
        return self.left[key] if go_left else ~self.left[key]


def shap_games(x: np.ndarray, games, n_features: int) -> np.ndarray:
    """phi (rows x features) for a batch of feature rows."""
    phi = np.zeros((n_features, x.shape[0]))
    sides = _Sides(x)
    for t, players, table in games:
        case = np.zeros(x.shape[0], dtype=np.intp)
        for k, (j, splits) in enumerate(players):
            ok = sides.of(t, j, *splits[0])
            for split in splits[1:]:
                ok = ok & sides.of(t, j, *split)
            case += ok.astype(np.intp) << k
        for k, (j, _) in enumerate(players):
            phi[j] += table[:, k][case]
    return phi.T


def shap_batch(x: np.ndarray, leaves, weights, n_features: int) -> np.ndarray:
    """``shap_games`` from the leaf table."""
    return shap_games(x, leaf_games(leaves, weights), n_features)


def expected_margin(leaves, weights) -> float:
    """E[margin] under the path-dependent (cover) distribution."""
    out = 0.0
    for t, value, path in leaves:
        p = 1.0
        for *_, cr in path:
            p *= cr
        out += weights[t] * value * p
    return out


def shap_values(model, df: DataFrame, features: list[str], key: str = "CustomerID") -> DataFrame:
    """Per-row Shapley values of the model margin: (key, phi_<feature>...)."""
    spark = df.sparkSession
    leaves, weights = leaf_table(model, spark)
    games = leaf_games(leaves, weights)
    # Bounded by trees x 2^depth leaves with 2^depth cases each; broadcast
    # (Connect sessions ship it inside the function closure instead).
    try:
        bc = spark.sparkContext.broadcast(games)
        get = lambda: bc.value
    except Exception:  # noqa: BLE001
        get = lambda: games
    nf = len(features)
    schema = f"{key} string, " + ", ".join(f"`phi_{c}` double" for c in features)

    def run(batches):
        import pandas as pd

        played = get()
        for pdf in batches:
            x = pdf[features].to_numpy(dtype=float)
            phi = shap_games(x, played, nf)
            out = pd.DataFrame(phi, columns=[f"phi_{c}" for c in features])
            out.insert(0, key, pdf[key].astype(str).to_numpy())
            yield out

    return df.select(F.col(key).cast("string").alias(key), *[F.col(c).cast("double") for c in features]).mapInPandas(
        run, schema
    )


def mean_abs_shap(model, df: DataFrame, features: list[str], key: str = "CustomerID", top: int | None = 5) -> DataFrame:
    """Mean |phi| per feature (a Spark aggregate over the per-row values),
    sorted descending; ``top`` keeps the first rows (a top-k report)."""
    sv = shap_values(model, df, features, key)
    one = sv.agg(*[F.avg(F.abs(F.col(f"phi_{c}"))).alias(c) for c in features])
    body = ", ".join(f"'{c}', `{c}`" for c in features)
    long = one.selectExpr(f"stack({len(features)}, {body}) AS (feature, mean_abs_shap)")
    out = long.orderBy(F.desc("mean_abs_shap"), "feature")
    return out.limit(top) if top else out


def tree_outputs(x: np.ndarray, leaves, n_trees: int) -> np.ndarray:
    """Raw output of every tree for a batch of rows (rows x trees): each
    row reaches exactly one leaf per tree."""
    out = np.zeros((x.shape[0], n_trees))
    sides = _Sides(x)
    for t, value, path in leaves:
        ok = np.ones(x.shape[0], dtype=bool)
        for f, kind, param, go_left, _ in path:
            ok &= sides.of(t, f, kind, param, go_left)
        out[ok, t] += value
    return out


def _prefix_rows(model, spark):
    """``(run, trees)``: ``run(x)`` gives the margins of a batch for every
    ensemble prefix (rows x trees), from the bounded leaf table."""
    leaves, weights = leaf_table(model, spark)
    n_trees = len(weights)
    payload = (leaves, np.asarray(weights))
    try:
        bc = spark.sparkContext.broadcast(payload)
        get = lambda: bc.value
    except Exception:  # noqa: BLE001
        get = lambda: payload

    def run(x: np.ndarray) -> np.ndarray:
        lv, wt = get()
        return np.cumsum(tree_outputs(x, lv, n_trees) * wt, axis=1)

    return run, n_trees


def prefix_margins(model, df: DataFrame, features: list[str], label: str) -> DataFrame:
    """``(k, margin, label)`` for every row and every ensemble size k =
    1..trees: the model margin using only its first k trees.  Rows x trees
    output, computed per Arrow batch from the bounded leaf table."""
    margins, n_trees = _prefix_rows(model, df.sparkSession)

    def run(batches):
        import pandas as pd

        ks = np.arange(1, n_trees + 1, dtype=np.int32)
        for pdf in batches:
            x = pdf[features].to_numpy(dtype=float)
            n = x.shape[0]
            yield pd.DataFrame({
                "k": np.tile(ks, n),
                "margin": margins(x).reshape(-1),
                "label": np.repeat(pdf[label].to_numpy(dtype=np.int32), n_trees),
            })

    return df.select(*[F.col(c).cast("double") for c in features], F.col(label).cast("int").alias(label)).mapInPandas(
        run, "k int, margin double, label int"
    )


def batch_auc(pos: np.ndarray, neg: np.ndarray) -> float | None:
    """Mann-Whitney AUC, ties one half: counted in integers and divided once,
    as ``metrics.roc_auc`` does."""
    if not len(pos) or not len(neg):
        return None
    neg = np.sort(neg)
    num2 = int(np.searchsorted(neg, pos, "left").sum()) + int(np.searchsorted(neg, pos, "right").sum())
    return float(num2) / (2.0 * float(len(pos)) * float(len(neg)))


def prefix_aucs(model, df: DataFrame, features: list[str], label: str) -> DataFrame:
    """``(k, roc_auc)`` for every ensemble size k = 1..trees: the AUC of
    ``prefix_margins``, exactly.  A batch sends one packed row per size and
    class, so rows x trees margins cross the shuffle once, without a row each;
    one size's margins (the validation rows, which ``fit_churn`` bounds) are
    sorted in one task."""
    margins, n_trees = _prefix_rows(model, df.sparkSession)

    def pack(batches):
        import pandas as pd

        for pdf in batches:
            m = margins(pdf[features].to_numpy(dtype=float))
            positive = pdf[label].to_numpy(dtype=np.int32) == 1
            pos, neg = (np.ascontiguousarray(m[side].T) for side in (positive, ~positive))
            yield pd.DataFrame({
                "k": np.arange(1, n_trees + 1, dtype=np.int32),
                "pos": [r.tobytes() for r in pos],
                "neg": [r.tobytes() for r in neg],
            })

    def one(pdf):
        import pandas as pd

        pos, neg = (np.frombuffer(b"".join(pdf[c]), dtype=float) for c in ("pos", "neg"))
        return pd.DataFrame({"k": pdf["k"].iloc[:1], "roc_auc": [batch_auc(pos, neg)]})

    rows = df.select(*[F.col(c).cast("double") for c in features], F.col(label).cast("int").alias(label))
    return rows.mapInPandas(pack, "k int, pos binary, neg binary").groupBy("k").applyInPandas(one, "k int, roc_auc double")
