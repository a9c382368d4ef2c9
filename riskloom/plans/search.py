"""Random hyper-parameter search over boosted trees: one Spark task a trial.

A trial is a grid point and a fold. All trials share one matrix: features of a hash sample
of at most ``SEARCH_ROWS`` rows, cut once into quantile codes by column expressions. The
matrix is bounded by that parameter, so it is broadcast; the trials, not the rows, are what
Spark spreads, and a lost executor costs the trials that it ran.

:func:`boost` grows the trees that ``GBTClassifier`` would grow on such codes: squared
error on the gradients of the logistic loss, leaf means, the first tree on the labels
themselves. So a grid point means in the search what it means in the final fit.
"""

from __future__ import annotations

import hashlib
import itertools
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions import hash_fraction
from riskloom.operators.sampling import take_by_hash
from riskloom.session import scratch_dir

# the trial function below travels whole: executors need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SEARCH_ROWS = 10_000
FOLDS = 3
DRAWS = 40
ROUNDS = 50
BINS = 32
# fixed values of the search grid, as far as Spark's trees have the parameter
SEARCH_GRID = {
    "stepSize": [0.01, 0.1, 0.5, 1.0],
    "maxDepth": [5, 10, 15, 20],
    "minInfoGain": [0.0, 0.1, 0.5, 1.0],
    "subsamplingRate": [0.25, 0.5, 0.75, 1.0],
    "minInstancesPerNode": [1, 10, 100, 1000],
}


def draw_params(draws: int, seed: int, grid: dict[str, list] = SEARCH_GRID) -> list[dict]:
    """The first ``draws`` grid points by the MD5 of the seed and their value numbers."""

    def rank(code: tuple) -> str:
        return hashlib.md5(f"{seed}:{','.join(map(str, code))}".encode()).hexdigest()

    codes = sorted(itertools.product(*[range(len(v)) for v in grid.values()]), key=rank)
    return [{k: v[i] for (k, v), i in zip(grid.items(), code)} for code in codes[:draws]]


# --- the shared matrix ---------------------------------------------------


def binned(
    rows: DataFrame, max_rows: int, seed: int, key: str = "tx_id", bins: int = BINS
) -> DataFrame:
    """``key, label, fold, codes`` of the sample, landed: a code counts the cuts below.

    The cuts are quantiles of the sample. Folds come from another hash than the sample.
    """
    spark = rows.sparkSession
    folder = scratch_dir(spark, "search")
    fold = F.floor(hash_fraction(key, seed + 1) * FOLDS).cast("int").alias("fold")
    sample = take_by_hash(rows.select(key, "label", "features"), max_rows, key, seed)
    sample.select(
        key, F.col("label").cast("int").alias("label"), fold, vector_to_array("features").alias("x")
    ).write.parquet(f"{folder}/sample")
    landed = spark.read.parquet(f"{folder}/sample")
    first = landed.select(F.size("x").alias("n")).first()
    n = first["n"] if first else 0
    names = [f"x{i}" for i in range(n)]
    wide = landed.select(*[F.get("x", F.lit(i)).alias(c) for i, c in enumerate(names)])
    shares = [i / bins for i in range(1, bins)]
    cuts = wide.approxQuantile(names, shares, 1 / (8 * bins)) if n else []

    def code(i: int):
        edges = sorted(set(cuts[i]))
        value = F.get("x", F.lit(i))
        return F.size(F.filter(F.array(*[F.lit(c) for c in edges]), lambda c: c < value))

    codes = F.array(*[code(i) for i in range(n)]) if n else F.array().cast("array<int>")
    landed.select(key, "label", "fold", codes.alias("codes")).write.parquet(f"{folder}/codes")
    return spark.read.parquet(f"{folder}/codes")


# --- a trial -------------------------------------------------------------


@dataclass(frozen=True)
class Tree:
    """Nodes of a tree: axis -1 at a leaf; codes up to ``cut`` go left."""

    axis: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    value: np.ndarray

    def predict(self, codes: np.ndarray) -> np.ndarray:
        node = np.zeros(len(codes), dtype="int64")
        while (inner := np.flatnonzero(self.axis[node] >= 0)).size:
            at = node[inner]
            right = codes[inner, self.axis[at]] > self.cut[at]
            node[inner] = self.left[at] + right
        return self.value[node]


def _best_splits(codes, place, target, n, bins, least):
    """Per open node: gain in squared error, axis, cut and row count of the best split."""
    size = np.bincount(place, minlength=n).astype("float64")
    total = np.bincount(place, target, n)
    best = np.full(n, -np.inf)
    axis, cut = np.zeros(n, dtype="int64"), np.zeros(n, dtype="int64")
    for f in range(codes.shape[1]):
        cell = place * bins + codes[:, f]
        count = np.bincount(cell, minlength=n * bins).reshape(n, bins).cumsum(axis=1)[:, :-1]
        left = np.bincount(cell, target, n * bins).reshape(n, bins).cumsum(axis=1)[:, :-1]
        other = size[:, None] - count
        fits = (count >= least) & (other >= least)
        with np.errstate(divide="ignore", invalid="ignore"):
            kept = left**2 / count + (total[:, None] - left) ** 2 / other
        gain = np.where(fits, kept, -np.inf)
        at = gain.argmax(axis=1)
        found = gain[np.arange(n), at]
        better = found > best
        best, axis, cut = (
            np.where(better, new, old) for new, old in ((found, best), (f, axis), (at, cut))
        )
    return (best - total**2 / size) / size, axis, cut


def grow(codes, target, depth: int, min_gain: float, least: int, bins: int = BINS) -> Tree:
    """A regression tree on codes, level by level; splits by variance reduction."""
    axis, cut, left, value = [-1], [0], [0], [float(target.mean())]
    node = np.zeros(len(codes), dtype="int64")
    rows, open_nodes = np.arange(len(codes)), np.array([0])
    for _ in range(depth):
        if not len(open_nodes):
            break
        place = np.searchsorted(open_nodes, node[rows])
        n = len(open_nodes)
        gain, on, at = _best_splits(codes[rows], place, target[rows], n, bins, max(1, least))
        split = (gain > 1e-12) & (gain >= min_gain)
        first = np.cumsum(split) - split
        children = len(axis) + 2 * first
        for i in np.flatnonzero(split).tolist():
            axis[open_nodes[i]], cut[open_nodes[i]] = int(on[i]), int(at[i])
            left[open_nodes[i]] = int(children[i])
        made = 2 * int(split.sum())
        axis += [-1] * made
        cut += [0] * made
        left += [0] * made
        chosen = split[place]
        rows, place = rows[chosen], place[chosen]
        right = codes[rows, on[place]] > at[place]
        node[rows] = children[place] + right
        base = len(value)
        count = np.bincount(node[rows] - base, minlength=made)
        value += (np.bincount(node[rows] - base, target[rows], made) / np.maximum(count, 1)).tolist()
        open_nodes = np.arange(base, base + made)
        # nodes too small to be split again are closed
        open_nodes = open_nodes[count >= 2 * max(1, least)]
        rows = rows[np.isin(node[rows], open_nodes)]
    return Tree(np.array(axis), np.array(cut), np.array(left), np.array(value))


def boost(codes, label, rounds: int, params: dict, seed: int, bins: int = BINS) -> list:
    """``rounds`` (weight, tree) pairs for 0/1 labels, as gradient-boosted trees are fitted."""
    sign = np.where(label == 1, 1.0, -1.0)
    draw = np.random.default_rng(seed)
    margin, fitted = np.zeros(len(codes)), []
    for i in range(rounds):
        weight = params["stepSize"] if i else 1.0
        target = 4 * sign / (1 + np.exp(np.minimum(2 * sign * margin, 700))) if i else sign
        rate = params["subsamplingRate"]
        some = np.flatnonzero(draw.random(len(codes)) < rate) if rate < 1 else slice(None)
        if len(target[some]) == 0:
            some = slice(None)
        tree = grow(
            codes[some],
            target[some],
            params["maxDepth"],
            params["minInfoGain"],
            params["minInstancesPerNode"],
            bins,
        )
        margin += weight * tree.predict(codes)
        fitted.append((weight, tree))
    return fitted


def margins(fitted: list, codes: np.ndarray) -> np.ndarray:
    return sum((weight * tree.predict(codes) for weight, tree in fitted), np.zeros(len(codes)))


def f1_score(label: np.ndarray, flagged: np.ndarray) -> float:
    hits, said = int((flagged & (label == 1)).sum()), int(flagged.sum() + (label == 1).sum())
    return 2 * hits / said if said else 0.0


def _trials(shared, points: list[dict], rounds: int, seed: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codes, label, fold = shared.value
        for frame in frames:
            out = []
            for trial in frame["id"].tolist():
                draw, k = divmod(trial, FOLDS)
                train, test = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
                if not len(train) or not len(test):
                    out.append((draw, k, 0, len(test), 0.0))
                    continue
                fitted = boost(codes[train], label[train], rounds, points[draw], seed)
                flagged = margins(fitted, codes[test]) > 0
                out.append((draw, k, len(fitted), len(test), f1_score(label[test], flagged)))
            yield pd.DataFrame(out, columns=["draw", "fold", "n_trees", "n_rows", "f1"])

    return run


def run_trials(
    rows: DataFrame,
    points: list[dict],
    rounds: int,
    seed: int,
    max_rows: int = SEARCH_ROWS,
    key: str = "tx_id",
) -> DataFrame:
    """``draw, fold, n_trees, n_rows, f1``: one row for every point and fold, landed."""
    spark = rows.sparkSession
    # at most max_rows rows of small integers
    sample = binned(rows, max_rows, seed, key).orderBy(key).toPandas()
    codes = np.array(sample["codes"].tolist(), dtype="int64")
    matrix = (codes, sample["label"].to_numpy(), sample["fold"].to_numpy())
    shared = spark.sparkContext.broadcast(matrix)
    path = scratch_dir(spark, "trials")
    n = len(points) * FOLDS
    spark.range(0, n, 1, n).mapInPandas(
        _trials(shared, points, rounds, seed),
        "draw int, fold int, n_trees long, n_rows long, f1 double",
    ).write.parquet(path)
    return spark.read.parquet(path)
