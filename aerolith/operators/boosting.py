"""Gradient-boosted regression trees, one model per series (M1, M4).

All series are fitted in one Spark job, each in its own group: a group holds one
row per day of a series, so its size is bounded by the calendar. Features are cut
into bins once; each level of a tree sums gradients and counts per (node, feature,
bin) and takes the best split from the running sums. A missing value is a bin of its
own that is tried on both sides of every split, so each node learns where NULLs go.
Columns are sampled per tree, rows per tree.

The fitted trees are a table (a row per series, tree and node), which scores other
rows later; importance is the mean gain of a feature's splits, summing to one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Row weight added to a leaf's, bins of a feature.
LAMBDA, BINS = 1.0, 256

_NODE = [T.StructField("tree", T.IntegerType()), T.StructField("node", T.IntegerType()),
         T.StructField("feature", T.StringType()), T.StructField("threshold", T.DoubleType()),
         T.StructField("missing_left", T.BooleanType()), T.StructField("value", T.DoubleType()),
         T.StructField("gain", T.DoubleType())]


class Tree:
    """Nodes by number: the root is 1, the children of k are 2k and 2k+1."""

    def __init__(self, depth: int):
        n = 1 << (depth + 1)
        self.depth = depth
        self.feature = np.full(n, -1)
        self.threshold, self.value, self.gain = np.zeros(n), np.zeros(n), np.zeros(n)
        self.missing_left = np.zeros(n, bool)

    def route(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row."""
        node = np.ones(len(x), int)
        rows = np.arange(len(x))
        for _ in range(self.depth):
            f = self.feature[node]
            v = x[rows, np.maximum(f, 0)]
            left = np.where(np.isnan(v), self.missing_left[node], v < self.threshold[node])
            node = np.where(f < 0, node, 2 * node + ~left)
        return node

    def predict(self, x: np.ndarray) -> np.ndarray:
        return self.value[self.route(x)]


def _binned(x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Each value's bin (0: missing) and each feature's cuts; a value below a cut
    goes left."""
    codes, cuts = np.zeros(x.shape, np.int64), []
    for j, v in enumerate(x.T):
        seen = v[~np.isnan(v)]
        cut = np.unique(np.quantile(seen, np.arange(1, BINS) / BINS, method="higher")) \
            if len(seen) else np.zeros(0)
        # The last cut parts all values from the missing ones.
        cuts.append(np.append(cut, np.inf))
        codes[:, j] = np.where(np.isnan(v), 0, np.searchsorted(cut, v, "right") + 1)
    return codes, cuts


def grow(codes: np.ndarray, cuts: list[np.ndarray], gradient: np.ndarray, columns: np.ndarray,
         depth: int, rate: float) -> Tree:
    """One tree on binned rows, level by level."""
    tree, width = Tree(depth), max(map(len, cuts)) + 2
    node, mine = np.ones(len(gradient), int), codes[:, columns]
    live = np.arange(len(gradient))
    for level in range(depth + 1):
        first, nodes = 1 << level, 1 << level
        at = node[live] - first
        g = np.bincount(at, gradient[live], nodes)
        h = np.bincount(at, minlength=nodes)
        tree.value[first:2 * first] = np.where(h > 0, -rate * g / (h + LAMBDA), 0.0)
        if level == depth or not len(live):
            break
        place = ((at[:, None] * len(columns) + np.arange(len(columns))) * width + mine[live]).ravel()
        shape = (nodes, len(columns), width)
        sums = np.bincount(place, np.repeat(gradient[live], len(columns)), nodes * len(columns) * width)
        counts = np.bincount(place, minlength=nodes * len(columns) * width)
        sums, counts = sums.reshape(shape), counts.reshape(shape)
        gl = np.cumsum(sums[..., 1:-1], axis=2)
        hl = np.cumsum(counts[..., 1:-1], axis=2)
        # Missing values right, then left of every cut.
        gl = np.stack([gl, gl + sums[..., :1]])
        hl = np.stack([hl, hl + counts[..., :1]])
        gr, hr = g[:, None, None] - gl, h[:, None, None] - hl
        gain = np.where((hl > 0) & (hr > 0), gl ** 2 / (hl + LAMBDA) + gr ** 2 / (hr + LAMBDA), 0.0) \
            - (g ** 2 / (h + LAMBDA))[:, None, None]
        flat = gain.transpose(1, 0, 2, 3).reshape(nodes, -1)
        best = flat.argmax(axis=1)
        side, column, cut = np.unravel_index(best, (2, len(columns), width - 2))
        split = flat[np.arange(nodes), best] > 1e-9
        for k in np.flatnonzero(split):
            j = int(columns[column[k]])
            tree.feature[first + k], tree.threshold[first + k] = j, cuts[j][cut[k]]
            tree.missing_left[first + k], tree.gain[first + k] = side[k], flat[k, best[k]]
        live = live[split[at]]
        at = node[live] - first
        code = mine[live, column[at]]
        left = np.where(code == 0, side[at] == 1, code <= cut[at] + 1)
        node[live] = 2 * node[live] + ~left
    return tree


def boost(x: np.ndarray, y: np.ndarray, rounds: int, depth: int, rate: float, rows: float,
          columns: float, seed: int) -> tuple[float, list[Tree]]:
    """The mean of ``y`` and the trees added to it."""
    rng = np.random.default_rng(seed)
    codes, cuts = _binned(x)
    base = float(y.mean())
    fit, trees = np.full(len(y), base), []
    take = max(1, int(columns * x.shape[1]))
    for _ in range(rounds):
        kept = np.flatnonzero(rng.random(len(y)) < rows)
        chosen = np.sort(rng.permutation(x.shape[1])[:take])
        tree = grow(codes[kept], cuts, fit[kept] - y[kept], chosen, depth, rate)
        fit += tree.predict(x)
        trees.append(tree)
    return base, trees


def _table(base: float, trees: list[Tree], features: Sequence[str]) -> pd.DataFrame:
    """The nodes in use; tree 0 holds the mean."""
    rows = [(0, 1, None, None, None, base, None)]
    for t, tree in enumerate(trees, 1):
        used = [1]
        for k in used:
            j = int(tree.feature[k])
            if j < 0:
                rows.append((t, k, None, None, None, float(tree.value[k]), None))
            else:
                rows.append((t, k, features[j], float(tree.threshold[k]), bool(tree.missing_left[k]),
                             None, float(tree.gain[k])))
                used += [2 * k, 2 * k + 1]
    return pd.DataFrame(rows, columns=[f.name for f in _NODE])


def _trees(table: pd.DataFrame, features: Sequence[str], depth: int) -> tuple[float, list[Tree]]:
    names = {f: j for j, f in enumerate(features)}
    base, trees = 0.0, []
    for number, nodes in table.groupby("tree", sort=True):
        if number == 0:
            base = float(nodes["value"].iloc[0])
            continue
        tree = Tree(depth)
        for r in nodes.itertuples():
            if r.feature is None or pd.isna(r.feature):
                tree.value[r.node] = r.value
            else:
                tree.feature[r.node], tree.threshold[r.node] = names[r.feature], r.threshold
                tree.missing_left[r.node] = bool(r.missing_left)
        trees.append(tree)
    return base, trees


def fit_series(train: DataFrame, series: Sequence[str], features: Sequence[str], label: str,
               params: Mapping) -> DataFrame:
    """The trees of every series' model. Rows without a label are left out; a
    series without rows has no model."""
    rows = train.where(F.col(label).isNotNull()).select(
        *series, F.col(label).cast("double").alias("_y"),
        *(F.col(f).cast("double").alias(f) for f in features))
    schema = T.StructType([rows.schema[k] for k in series] + _NODE)
    settings = (params["rounds"], params["depth"], params["rate"], params["rows"],
                params["columns"], params["seed"])

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        # One order of rows, so that sampling does not depend on the shuffle.
        group = group.sort_values([*features, "_y"])
        x, y = group[list(features)].to_numpy(float), group["_y"].to_numpy(float)
        out = _table(*boost(x, y, *settings), features)
        for at, key in enumerate(series):
            out.insert(at, key, group[key].iloc[0])
        return out

    # A stated number of partitions, so that small groups are not put into one task.
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(tasks, *series).groupBy(*series).applyInPandas(fit, schema)


def predict_series(rows: DataFrame, trees: DataFrame, series: Sequence[str],
                   features: Sequence[str], depth: int, out: str = "yhat") -> DataFrame:
    """``rows`` with the forecast of their series' model; NULL without one. A NULL
    feature goes to the side that its node learned."""
    schema = T.StructType([*rows.schema.fields, T.StructField(out, T.DoubleType())])

    def score(left: pd.DataFrame, table: pd.DataFrame) -> pd.DataFrame:
        if not len(left):
            return pd.DataFrame(columns=schema.names)
        left = left.copy()
        if len(table):
            base, model = _trees(table, features, depth)
            x = left[list(features)].to_numpy(float)
            left[out] = base + sum(t.predict(x) for t in model)
        else:
            left[out] = np.nan
        return left

    return rows.groupBy(*series).cogroup(trees.groupBy(*series)).applyInPandas(score, schema)


def importance(trees: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``feature``, ``importancia``: mean gain of its splits, as a share."""
    mean = trees.where("feature IS NOT NULL").groupBy(*by, "feature").agg(F.avg("gain").alias("_g"))
    whole = mean.groupBy(*by).agg(F.sum("_g").alias("_t"))
    joined = mean.join(whole, list(by)) if by else mean.withColumn("_t", whole.scalar())
    return joined.select(*by, "feature", (F.col("_g") / F.col("_t")).alias("importancia"))
