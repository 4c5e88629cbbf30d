"""Boosted trees with monotone signs, grown level by level from gradient histograms.

Features are cut into bins once. A level is one pass: tasks add up gradients, Hessians and rows per (node, feature, bin) of all open nodes, Spark
sums the tasks' histograms, and the driver picks each node's split from a few thousand numbers. A split on a feature with a sign must order its
children's values, and hands the middle of the two down as a bound that all values below keep, so the sum of trees is monotone in that feature.
Scores are not stored: a pass recomputes them from the trees so far, on top of a score written every CHECKPOINT rounds.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..session import cut_lineage
from .prefix import long_values, quantiles_of_counts

c = F.col
BINS, LAMBDA, MIN_ROWS, CHECKPOINT = 32, 1.0, 50, 25


@dataclass
class Node:
    """A node of a tree: a leaf has no feature. Rows with a bin up to `bin` go left, which are values up to `threshold`."""

    value: float
    feature: int = -1
    bin: int = -1
    threshold: float = 0.0
    left: int = -1
    right: int = -1


@dataclass
class BoostedTrees:
    """Trees over filled features; the probability is the logistic of base plus the leaves' sum."""

    features: list
    fills: dict
    base: float
    trees: list = field(default_factory=list)

    def __post_init__(self):
        self.trees = [[n if isinstance(n, Node) else Node(**n) for n in t] for t in self.trees]

    def column(self, have: Sequence[str] | None = None) -> Column:
        """The probability as one expression; a feature that is missing, or no column at all, takes its fill."""
        x = [F.coalesce(c(f).cast("double"), F.lit(float(self.fills.get(f, 0.0)))) if have is None or f in have else F.lit(float(self.fills.get(f, 0.0))) for f in self.features]

        def at(tree, i):
            n = tree[i]
            return F.lit(n.value) if n.feature < 0 else F.when(x[n.feature] <= n.threshold, at(tree, n.left)).otherwise(at(tree, n.right))

        total = F.lit(self.base)
        for tree in self.trees:
            total = total + at(tree, 0)
        return 1 / (1 + F.exp(-total))

    def rows(self, spark) -> DataFrame:
        """(tree, node, feature, threshold, left, right, value): the model as a table."""
        out = [(t, i, self.features[n.feature] if n.feature >= 0 else None, n.threshold if n.feature >= 0 else None, n.left, n.right, n.value) for t, tree in enumerate(self.trees) for i, n in enumerate(tree)]
        return spark.createDataFrame(out, "tree int, node int, feature string, threshold double, left int, right int, value double")


def bin_edges(df: DataFrame, features: Sequence[str], bins: int = BINS) -> dict[str, list[float]]:
    """Inner edges of each feature: distinct quantiles; a value up to an edge is in the bin below."""
    return edges_of_counts(cut_lineage(long_values(df, features).groupBy("name", "value").agg(F.count("*").alias("n"))), features, bins)


def edges_of_counts(counts: DataFrame, features: Sequence[str], bins: int = BINS) -> dict[str, list[float]]:
    """The same from written counts (name, value, n)."""
    q = {r["name"]: r["q"] for r in quantiles_of_counts(counts.where(c("value").isNotNull() & ~F.isnan("value")), [i / bins for i in range(1, bins)]).collect()}
    top = {r["name"]: r["top"] for r in counts.groupBy("name").agg(F.max("value").alias("top")).collect()}
    return {f: sorted({float(v) for v in q.get(f, []) if v < top[f]}) for f in features}


def binned(df: DataFrame, features: Sequence[str], edges: dict, label: str) -> DataFrame:
    """(b0.., y): bin numbers of the filled features, and the label."""
    def bin_of(f):
        total = F.lit(0)
        for e in edges[f]:
            total = total + F.when(c(f).cast("double") > e, 1).otherwise(0)
        return total
    return df.where(c(label).isNotNull()).select(*[bin_of(f).cast("byte").alias(f"b{j}") for j, f in enumerate(features)], c(label).cast("double").alias("y"))


def _leaf(tree: list[Node], x: np.ndarray) -> np.ndarray:
    """The node in which each row of bins ends."""
    at = np.zeros(len(x), np.int64)
    feature, cut = np.array([n.feature for n in tree]), np.array([n.bin for n in tree])
    left, right = np.array([n.left for n in tree]), np.array([n.right for n in tree])
    while True:
        open_ = feature[at] >= 0
        if not open_.any():
            return at
        i = at[open_]
        at[open_] = np.where(x[open_, feature[i]] <= cut[i], left[i], right[i])


def _score(x: np.ndarray, start: np.ndarray, trees: list) -> np.ndarray:
    total = start.copy()
    for t in trees:
        total += np.array([n.value for n in t])[_leaf(t, x)]
    return total


def _histograms(data: DataFrame, p: int, trees: list, tree: list[Node], open_nodes: Sequence[int], width: int) -> np.ndarray:
    """Sums of gradient, Hessian and rows per open node, feature and bin."""
    place = {n: i for i, n in enumerate(open_nodes)}
    shape = (len(open_nodes), p, width, 3)

    def run(batches):
        total = np.zeros(shape)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.column_stack([batch.column(j).to_numpy() for j in range(p)]).astype(np.int64)
            y, start = batch.column(p).to_numpy(), batch.column(p + 1).to_numpy()
            mu = 1 / (1 + np.exp(-_score(x, start, trees)))
            node = np.array([place.get(i, -1) for i in range(len(tree))])[_leaf(tree, x)]
            use = node >= 0
            weights = np.column_stack([y - mu, mu * (1 - mu), np.ones(len(y))])[use]
            for j in range(p):
                slot = node[use] * width + x[use, j]
                for k in range(3):
                    total[:, j, :, k] += np.bincount(slot, weights[:, k], minlength=len(open_nodes) * width).reshape(len(open_nodes), width)
        flat = total.ravel()
        some = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(flat[some])], names=["i", "v"])

    out = np.zeros(int(np.prod(shape)))
    sums = data.mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).toArrow()  # nodes x features x bins x 3 numbers
    out[sums["i"].to_numpy()] = sums["v"].to_numpy()
    return out.reshape(shape)


def _clip(v: float, bounds: tuple[float, float]) -> float:
    return min(max(v, bounds[0]), bounds[1])


def best_split(hist: np.ndarray, signs: Sequence[int], bounds: tuple[float, float], edges: Sequence[int], min_rows: int = MIN_ROWS, ridge: float = LAMBDA):
    """(feature, bin, left value, right value) with the largest gain, the first on ties; None if no split gains or is allowed.

    hist is (feature, bin, [gradient, Hessian, rows]) of one node; values keep the node's bounds and the feature's sign."""
    best, found = 1e-12, None
    for j in range(hist.shape[0]):
        low = np.cumsum(hist[j], axis=0)
        g, h, n = low[-1]
        for s in range(edges[j]):
            gl, hl, nl = low[s]
            if nl < min_rows or n - nl < min_rows:
                continue
            gain = gl * gl / (hl + ridge) + (g - gl) ** 2 / (h - hl + ridge) - g * g / (h + ridge)
            if gain <= best * (1 + 1e-9):
                continue
            left, right = _clip(gl / (hl + ridge), bounds), _clip((g - gl) / (h - hl + ridge), bounds)
            if signs[j] * (right - left) < 0:
                continue
            best, found = gain, (j, s, left, right)
    return found


def fit(df: DataFrame, features: Sequence[str], fills: dict, label: str = "is_bad", rounds: int = K.BOOST_ROUNDS, depth: int = K.BOOST_DEPTH, step: float = K.BOOST_STEP,
        signs: dict = K.BOOST_SIGNS, bins: int = BINS, min_rows: int = MIN_ROWS, edges: dict | None = None) -> BoostedTrees:
    """Grow `rounds` trees of at most `depth` levels; fills replace missing values; edges are those of bin_edges over the filled features, if known."""
    features = list(features)
    filled = df.select(label, *[F.coalesce(c(f).cast("double"), F.lit(float(fills.get(f, 0.0)))).alias(f) for f in features])
    edges = edges or bin_edges(filled, features, bins)
    rate = filled.agg(F.avg(c(label).cast("double"))).first()[0]
    if rate is None or not 0 < rate < 1:
        return BoostedTrees(features, fills, float(np.log(max(rate or 0.0, 1e-6) / max(1 - (rate or 0.0), 1e-6))))
    base = float(np.log(rate / (1 - rate)))
    data = cut_lineage(binned(filled, features, edges, label).withColumn("start", F.lit(base)))
    direction, sizes, width = [signs.get(f, 0) for f in features], [len(edges[f]) for f in features], max(len(e) for e in edges.values()) + 1
    model, since = BoostedTrees(features, fills, base), 0
    for r in range(rounds):
        tree, bounds, open_nodes = [Node(0.0)], {0: (-np.inf, np.inf)}, [0]
        for _ in range(depth):
            hists = _histograms(data, len(features), model.trees[since:], tree, open_nodes, width)
            following = []
            for i, hist in zip(open_nodes, hists):
                split = best_split(hist, direction, bounds[i], sizes, min_rows)
                if split is None:
                    continue
                j, s, left, right = split
                lo, hi = bounds[i]
                middle = (left + right) / 2
                ends = ((lo, middle), (middle, hi)) if direction[j] > 0 else ((middle, hi), (lo, middle)) if direction[j] < 0 else ((lo, hi), (lo, hi))
                tree[i].feature, tree[i].bin, tree[i].threshold = j, s, edges[features[j]][s]
                tree[i].left, tree[i].right = len(tree), len(tree) + 1
                for value, b in zip((left, right), ends):
                    bounds[len(tree)] = b
                    following.append(len(tree))
                    tree.append(Node(float(value)))
            open_nodes = following
            if not open_nodes:
                break
        if len(tree) == 1:
            break
        for n in tree:
            n.value *= step
        model.trees.append(tree)
        if len(model.trees) - since >= CHECKPOINT and r + 1 < rounds:
            data, since = cut_lineage(_with_scores(data, len(features), model.trees[since:])), len(model.trees)
    return model


def _with_scores(data: DataFrame, p: int, trees: list) -> DataFrame:
    """data with the scores of these trees added to the start."""
    def run(batches):
        for batch in batches:
            x = np.column_stack([batch.column(j).to_numpy() for j in range(p)]).astype(np.int64).reshape(-1, p)
            start = pa.array(_score(x, batch.column(p + 1).to_numpy(), trees))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], start], names=batch.schema.names)

    return data.mapInArrow(run, data.schema)
