"""Boosted trees in one go: rounds go on until patience ends, none is fitted twice.

The trees are those of Spark's ``GBTClassifier``: squared error on the gradients of the
logistic loss, weighted leaf means, the first tree on the labels themselves, splits between
quantile bins chosen by variance reduction. Spark's fit cannot be resumed nor stopped by a
rule of one's own; this one is a single barrier stage whose tasks keep their rows' bin codes,
a byte a feature, and margins for all rounds. A level of a tree costs one exchange of
histograms, through files in the shared scratch folder: of every two siblings the smaller is
counted, the other is the rest of their parent. All tasks add the same parts in the same
order, so they choose the same splits, and the dev rows among them tell when to stop. No row
comes to the driver; the trees are written by the task that reports them.

Cuts are halfway between neighbouring values, by Spark's rule for bins of equal weight. Spark
applies it to 10,000 sampled rows; here all rows count, through their quantiles, or through
each value where a feature has few.
"""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import BarrierTaskContext, cloudpickle
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.session import remove, scratch_dir

# the task functions below travel whole: executors need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# quantiles that stand for the values of a feature with many
QUANTILES = 1024
# a task has as many rows or more; what tasks tell each other grows with their square
ROWS_PER_TASK = 20_000
MAX_TASKS = 32
# gains below are rounding
LEAST_GAIN = 1e-13
# rows counted at a time: their cells stay in the processor's cache
_CHUNK = 1 << 15
_NODE = (
    "struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, "
    "rawCount: bigint, gain: double, leftChild: int, rightChild: int, "
    "split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>>"
)


def rounds_to_keep(losses: list[float], patience: int) -> tuple[int, bool]:
    """``(rounds up to the best one, whether patience ran out)`` for losses by round.

    A round is better only if its loss is less; rounds after patience ran out do not count.
    """
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            return best + 1, True
    return best + 1, False


def possible(spark: SparkSession) -> bool:
    """Whether tasks can run all at once and share files.

    Executors on demand have no barrier stages, and an object store has no files to open.
    """
    fixed = spark.conf.get("spark.dynamicAllocation.enabled", "false") != "true"
    return fixed and scratch_dir(spark, "told").startswith(("/", "file:/"))


def fit(
    estimator: GBTClassifier, train: DataFrame, dev: DataFrame, patience: int
) -> tuple[GBTClassificationModel, list[float]]:
    """The rounds up to the best one on ``dev``, and the dev losses that were looked at.

    Boosting goes on while one of the last ``patience`` rounds was the best so far, at most
    for the estimator's ``maxIter``. Rows have ``features``, ``label`` and ``weight``. Heeds
    depth, step, gain, instances, subsampling, bins and seed of the estimator. Runs jobs.
    """
    spark = train.sparkSession
    bins = estimator.getMaxBins()
    cuts = cut_points(train, bins)
    settings = Settings(
        rounds=estimator.getMaxIter(),
        patience=patience,
        depth=estimator.getMaxDepth(),
        step=estimator.getStepSize(),
        least=max(1, estimator.getMinInstancesPerNode()),
        min_gain=estimator.getMinInfoGain(),
        rate=estimator.getSubsamplingRate(),
        seed=estimator.getSeed(),
        bins=bins,
    )
    parts = [
        part.select(
            vector_to_array("features").alias("x"),
            F.col("label").cast("double").alias("label"),
            F.col("weight").cast("double").alias("weight"),
            F.lit(judging).alias("dev"),
        )
        for part, judging in ((train, False), (dev, True))
    ]
    coded = parts[0].unionByName(parts[1]).mapInArrow(
        _coder(cuts), "codes binary, label double, weight double, dev boolean"
    )
    path = scratch_dir(spark, "rounds")
    run = _boost(settings, cuts, f"{path.removeprefix('file:')}/told")
    coded.repartition(_tasks(spark, train.count())).mapInArrow(
        run, f"round int, loss double, nodes array<{_NODE}>", barrier=True
    ).write.parquet(f"{path}/grown")
    grown = spark.read.parquet(f"{path}/grown")
    # one number a round
    losses = [r["loss"] for r in grown.select("round", "loss").orderBy("round").collect()]
    kept, _ = rounds_to_keep(losses, patience)
    remove(spark, f"{path}/told")
    return _as_model(estimator, grown, kept, len(cuts)), losses


def _tasks(spark: SparkSession, rows: int) -> int:
    context = spark.sparkContext._jsc.sc()
    slots = context.maxNumConcurrentTasks(context.resourceProfileManager().defaultResourceProfile())
    return max(1, min(slots, MAX_TASKS, rows // ROWS_PER_TASK))


# --- bins ----------------------------------------------------------------


def _between(values: np.ndarray, counts: np.ndarray, bins: int) -> np.ndarray:
    """At most ``bins - 1`` cuts between the sorted values, by Spark's rule."""
    with np.errstate(invalid="ignore"):
        halfway = (values[:-1] + values[1:]) / 2
    halfway = np.where(np.isnan(halfway), values[:-1], halfway)  # between the infinities
    if len(values) <= bins:
        return halfway
    stride = counts.sum() / bins
    chosen, current, goal = [], counts[0], stride
    for i in range(1, len(values)):
        before, current = current, current + counts[i]
        if abs(before - goal) < abs(current - goal):
            chosen.append(i - 1)
            goal += stride
    return halfway[chosen]


def cut_points(rows: DataFrame, bins: int) -> list[np.ndarray]:
    """Ascending cuts of each feature, found in all rows; up to a cut goes left."""
    arrays = rows.select(vector_to_array("features").alias("x"))
    first = arrays.first()
    if first is None:
        raise ValueError("no rows to fit")
    names = [f"x{i}" for i in range(len(first["x"]))]
    wide = arrays.select(*[F.get("x", F.lit(i)).alias(c) for i, c in enumerate(names)])
    sizes = wide.agg(*[F.approx_count_distinct(c).alias(c) for c in names]).first()
    # the estimate is off by a few hundredths
    many = [c for c in names if sizes[c] > 4 * bins]
    shares = [i / QUANTILES for i in range(QUANTILES + 1)]
    found = dict(zip(many, wide.approxQuantile(many, shares, 1 / (4 * QUANTILES)) if many else []))
    out = []
    for c in names:
        if c in found:
            values, counts = np.unique(found[c], return_counts=True)
        else:
            # a row a value, some 4 * bins at most; NaN is right of every cut
            seen = wide.filter(~F.isnan(c)).groupBy(c).count().collect()
            values, counts = np.array(sorted(seen), dtype="float64").reshape(-1, 2).T
        out.append(_between(values, counts, bins))
    return out


def _coder(cuts: list[np.ndarray]):
    """Per row the numbers of its features' bins, a byte or two each."""
    kind = _code_type(cuts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(n, len(cuts))
            codes = np.empty((n, len(cuts)), dtype=kind)
            for i, c in enumerate(cuts):
                codes[:, i] = np.searchsorted(c, x[:, i])
            ends = np.arange(n + 1, dtype="int32") * codes.itemsize * len(cuts)
            packed = pa.Array.from_buffers(
                pa.binary(), n, [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(codes.tobytes())]
            )
            names = ["label", "weight", "dev"]
            yield pa.RecordBatch.from_arrays(
                [packed, *[batch.column(c) for c in names]], ["codes", *names]
            )

    return run


def _code_type(cuts: list[np.ndarray]) -> str:
    return "uint8" if max(map(len, cuts)) < 255 else "uint16"


# --- rounds --------------------------------------------------------------


@dataclass(frozen=True)
class Settings:
    rounds: int
    patience: int
    depth: int
    step: float
    least: int
    min_gain: float
    rate: float
    seed: int
    bins: int


@dataclass(frozen=True)
class Rows:
    """A task's rows, those to fit before those of dev."""

    by_row: np.ndarray  # codes, flat
    by_feature: np.ndarray  # codes of the rows to fit
    first: np.ndarray  # where a row's codes begin
    sign: np.ndarray
    weight: np.ndarray

    @property
    def fitted(self) -> int:
        return self.by_feature.shape[1]


@dataclass(frozen=True)
class Tree:
    """By node: a leaf is its own child, left of a cut that no code exceeds.

    ``sums`` has rows, weight, weighted targets and their squares.
    """

    axis: np.ndarray
    cut: np.ndarray
    child: np.ndarray
    gain: np.ndarray
    sums: np.ndarray

    @property
    def value(self) -> np.ndarray:
        return np.divide(self.sums[2], self.sums[1], out=np.zeros(len(self.axis)), where=self.sums[1] > 0)


Summed = Callable[[np.ndarray], np.ndarray]


def _summed(context: BarrierTaskContext, folder: str) -> Summed:
    """The sum of all tasks' arrays, to the last bit the same in every task.

    Tasks tell each other their parts through files, as a gathering of Spark's takes a second.
    """
    part, n, at = context.partitionId(), len(context.getTaskInfos()), 0
    if n == 1:
        return lambda array: array
    # a stage that is tried again meets in another folder
    folder = f"{folder}/{context.allGather(str(context.taskAttemptId()))[0]}"
    os.makedirs(folder, exist_ok=True)

    def run(array: np.ndarray) -> np.ndarray:
        nonlocal at
        with open(f"{folder}/new-{part}", "wb") as file:
            file.write(array.tobytes())
        os.replace(file.name, f"{folder}/{at}-{part}")
        out = np.zeros(array.size)
        for k in range(n):
            out += np.frombuffer(_awaited(f"{folder}/{at}-{k}"))
        if at:  # whoever wrote this time had read the last time
            os.remove(f"{folder}/{at - 1}-{part}")
        at += 1
        return out.reshape(array.shape)

    return run


def _awaited(path: str) -> bytes:
    """The contents of a file that another task writes; Spark ends this task if that one fails."""
    pause = 0.0002
    while True:
        try:
            with open(path, "rb") as file:
                return file.read()
        except FileNotFoundError:
            time.sleep(pause)
            pause = min(2 * pause, 0.02)


def _load(batches: Iterator[pa.RecordBatch], cuts: list[np.ndarray]) -> Rows:
    size, kind = len(cuts), np.dtype(_code_type(cuts))
    found = {False: [], True: []}
    for batch in batches:
        column = batch.column("codes")
        ends = np.frombuffer(column.buffers()[1], "int32")[column.offset : column.offset + len(column) + 1]
        codes = np.frombuffer(column.buffers()[2], "uint8")[ends[0] : ends[-1]].view(kind)
        label, weight, dev = (
            batch.column(c).to_numpy(zero_copy_only=False) for c in ("label", "weight", "dev")
        )
        for judging, parts in found.items():
            at = np.flatnonzero(dev == judging)
            parts.append((codes.reshape(-1, size)[at], label[at], weight[at]))
    every = found[False] + found[True]
    empty = (np.empty((0, size), kind), np.empty(0), np.empty(0))
    codes, label, weight = (np.concatenate(c) for c in zip(empty, *every))
    n = sum(len(p[1]) for p in found[False])
    return Rows(
        by_row=codes.ravel(),
        by_feature=np.ascontiguousarray(codes[:n].T),
        first=np.arange(len(label)) * size,
        sign=np.where(label == 1, 1.0, -1.0),
        weight=weight.astype("float64"),
    )


def _histogram(rows: Rows, node, slot, weight, pull, n_slots: int, bins: int) -> np.ndarray:
    """``(rows, weight, weighted targets) x features x slots x bins`` of this task."""
    size = len(rows.by_feature)
    width = n_slots * bins
    out = np.zeros((3, size, width))
    for start in range(0, rows.fitted, _CHUNK):
        part = slice(start, min(start + _CHUNK, rows.fitted))
        place = slot.take(node[part])
        at = np.flatnonzero(place >= 0)
        if not len(at):
            continue
        begin, w, g = place[at] * bins, weight[part][at], pull[part][at]
        for f in range(size):
            cell = begin + rows.by_feature[f, part][at]
            out[0, f] += np.bincount(cell, minlength=width)
            out[1, f] += np.bincount(cell, w, width)
            out[2, f] += np.bincount(cell, g, width)
    return out.reshape(3, size, n_slots, bins)


def _best_splits(hist: np.ndarray, least: int):
    """Per slot: gain in variance, axis, cut and row counts of the best split's sides."""
    whole = hist[:, 0].sum(axis=-1)
    left = hist.cumsum(axis=-1)[..., :-1]
    right = whole[:, None, :, None] - left
    with np.errstate(divide="ignore", invalid="ignore"):
        kept = left[2] ** 2 / left[1] + right[2] ** 2 / right[1]
    # a cut behind an empty bin is the one before it
    fits = (left[0] >= least) & (right[0] >= least) & (hist[0, ..., :-1] > 0)
    kept = np.where(fits & (left[1] > 0) & (right[1] > 0), kept, -np.inf)
    by_slot = kept.transpose(1, 0, 2).reshape(kept.shape[1], -1)
    at, every = by_slot.argmax(axis=1), np.arange(len(by_slot))
    axis, cut = np.divmod(at, kept.shape[2])
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = (by_slot[every, at] - whole[2] ** 2 / whole[1]) / whole[1]
    return gain, axis, cut, left[0, axis, every, cut], right[0, axis, every, cut]


def _grow(rows: Rows, target, drawn, s: Settings, total: Summed) -> tuple[Tree, np.ndarray]:
    """A tree on the targets of all tasks' rows, and the leaf of each row of this one.

    Rows that are not ``drawn`` go along without being counted.
    """
    weight, bins = rows.weight[: rows.fitted], s.bins
    pull = weight * target
    node = np.zeros(len(rows.sign), dtype="int32")
    axis, cut = np.zeros(1, dtype="int64"), np.full(1, bins)
    child, gains = np.zeros(1, dtype="int32"), np.full(1, -1.0)
    counted = node[: rows.fitted]
    if drawn is not None:
        counted = np.where(drawn, 0, -1)
    # the last slot is that of rows that are not drawn, whatever the number of nodes
    hist = total(_histogram(rows, counted, np.array([0, -1]), weight, pull, 1, bins))
    nodes, levels = np.zeros(1, dtype="int64"), []
    for level in range(s.depth):
        gain, on, at, n_left, n_right = _best_splits(hist, s.least)
        split = np.flatnonzero((gain > LEAST_GAIN) & (gain >= s.min_gain))
        if not len(split):
            break
        made = len(axis) + 2 * np.arange(len(split))
        parents = nodes[split]
        axis[parents], cut[parents], gains[parents] = on[split], at[split], gain[split]
        child[parents] = made
        levels.append((parents, made))
        new = 2 * len(split)
        axis, cut = np.append(axis, np.zeros(new, "int64")), np.append(cut, np.full(new, bins))
        child = np.append(child, np.arange(len(child), len(child) + new, dtype="int32"))
        gains = np.append(gains, np.full(new, -1.0))
        for start in range(0, len(node), _CHUNK):
            part = slice(start, start + _CHUNK)
            now = node[part]
            code = rows.by_row.take(rows.first[part] + axis.take(now))
            node[part] = child.take(now) + (code > cut.take(now))
        # children too small to be split again are not counted
        more = np.maximum(n_left, n_right)[split] >= 2 * s.least
        split, made = split[more], made[more]
        if level + 1 == s.depth or not len(split):
            break
        right_is_smaller = (n_right < n_left)[split]
        slot = np.full(len(axis) + 1, -1)
        slot[made + right_is_smaller] = np.arange(len(split))
        counted = node[: rows.fitted]
        if drawn is not None:
            counted = np.where(drawn, counted, len(axis))
        smaller = total(_histogram(rows, counted, slot, weight, pull, len(split), bins))
        larger = hist[:, :, split] - smaller
        swap = right_is_smaller[:, None]
        pairs = np.where(swap, larger, smaller), np.where(swap, smaller, larger)
        hist = np.stack(pairs, axis=3).reshape(3, len(rows.by_feature), -1, bins)
        nodes = np.stack([made, made + 1], axis=1).ravel()
    sums = total(_leaf_sums(node[: rows.fitted], drawn, weight, target, len(axis)))
    for parents, made in reversed(levels):
        sums[:, parents] = sums[:, made] + sums[:, made + 1]
    return Tree(axis, cut, child, gains, sums), node


def _leaf_sums(leaf, drawn, weight, target, n: int) -> np.ndarray:
    if drawn is not None:
        leaf, weight, target = leaf[drawn], weight[drawn], target[drawn]
    sums = [None, weight, weight * target, weight * target**2]
    return np.stack([np.bincount(leaf, w, n).astype("float64") for w in sums])


def _drawn(draw, n: int, rate: float, total: Summed):
    if rate >= 1:
        return None
    some = draw.random(n) < rate
    # all rows where none would be
    return some if total(np.array([float(some.sum())]))[0] else None


def boost(rows: Rows, s: Settings, total: Summed, part: int = 0) -> Iterator[tuple[float, Tree]]:
    """The dev loss and the tree of each round, as long as patience lasts."""
    draw = np.random.default_rng([s.seed, part])
    fitted = rows.fitted
    sign, dev_sign = rows.sign[:fitted], rows.sign[fitted:]
    margin, losses = np.zeros(len(rows.sign)), []
    while len(losses) < s.rounds:
        target = sign
        if losses:
            target = 4 * sign / (1 + np.exp(np.minimum(2 * sign * margin[:fitted], 700)))
        tree, leaf = _grow(rows, target, _drawn(draw, fitted, s.rate, total), s, total)
        margin += (s.step if losses else 1.0) * tree.value.take(leaf)
        weight = rows.weight[fitted:]
        lost = 2 * np.logaddexp(0, -2 * dev_sign * margin[fitted:])
        above, below = total(np.array([(weight * lost).sum(), weight.sum()]))
        losses.append(above / below)
        yield losses[-1], tree
        if rounds_to_keep(losses, s.patience)[1]:
            return


def _boost(s: Settings, cuts: list[np.ndarray], folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = BarrierTaskContext.get()
        part = context.partitionId()
        rows = _load(batches, cuts)
        for i, (loss, tree) in enumerate(boost(rows, s, _summed(context, folder), part)):
            if part == 0:
                nodes = _stored_nodes(tree, cuts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([i], pa.int32()),
                        pa.array([loss], pa.float64()),
                        pa.ListArray.from_arrays(pa.array([0, len(nodes)], pa.int32()), nodes),
                    ],
                    ["round", "loss", "nodes"],
                )

    return run


# --- the model -----------------------------------------------------------


def _stored_nodes(tree: Tree, cuts: list[np.ndarray]) -> pa.StructArray:
    """The nodes as Spark stores them."""
    n = len(tree.axis)
    own = np.arange(n, dtype="int32")
    inner = tree.child != own
    value = tree.value
    variance = np.divide(tree.sums[3], tree.sums[1], out=np.zeros(n), where=tree.sums[1] > 0)
    at = np.flatnonzero(inner)
    ends = np.append(0, np.cumsum(inner)).astype("int32")
    limits = np.array([cuts[tree.axis[i]][tree.cut[i]] for i in at], dtype="float64")
    split = {
        "featureIndex": np.where(inner, tree.axis, -1).astype("int32"),
        "leftCategoriesOrThreshold": pa.ListArray.from_arrays(ends, limits),
        "numCategories": np.full(n, -1, dtype="int32"),
    }
    stats = pa.ListArray.from_arrays(
        np.arange(n + 1, dtype="int32") * 3, np.ascontiguousarray(tree.sums[1:].T).ravel()
    )
    node = {
        "id": own,
        "prediction": value,
        "impurity": variance - value**2,
        "impurityStats": stats,
        "rawCount": tree.sums[0].astype("int64"),
        "gain": tree.gain,
        "leftChild": np.where(inner, tree.child, -1).astype("int32"),
        "rightChild": np.where(inner, tree.child + 1, -1).astype("int32"),
        "split": _struct(split),
    }
    return _struct(node)


def _struct(fields: dict) -> pa.StructArray:
    arrays = [v if isinstance(v, pa.Array) else pa.array(v) for v in fields.values()]
    return pa.StructArray.from_arrays(arrays, list(fields))


def _as_model(
    estimator: GBTClassifier, grown: DataFrame, n: int, size: int
) -> GBTClassificationModel:
    """The first ``n`` trees as Spark's own model, through the form in which it is stored.

    Everything but trees and weights is that of a model which the estimator fits to two rows.
    """
    spark = grown.sparkSession
    path = scratch_dir(spark, "trees")
    two = spark.createDataFrame(
        [(Vectors.dense([float(y)] * size), y, 1.0) for y in (0, 1)], ["features", "label", "weight"]
    )
    cheap = {estimator.maxIter: 1, estimator.maxDepth: 1, estimator.subsamplingRate: 1.0}
    estimator.copy(cheap).fit(two).write().save(f"{path}/small")
    named = {p.name: estimator.getOrDefault(p) for p in estimator.params if estimator.isSet(p)}

    about = json.loads(spark.read.text(f"{path}/small/metadata").first()["value"])
    about |= {"paramMap": named, "numTrees": n}
    text = spark.createDataFrame([(json.dumps(about),)], "value string")
    text.coalesce(1).write.text(f"{path}/whole/metadata")

    tree = spark.read.parquet(f"{path}/small/treesMetadata").first()
    each = json.loads(tree["_2"])
    each["paramMap"] = {k: named[k] for k in each["paramMap"] if k in named}
    weight = F.when(F.col("id") == 0, 1.0).otherwise(estimator.getStepSize())
    spark.range(n).select(
        F.col("id").cast("int").alias("_1"), F.lit(json.dumps(each)).alias("_2"), weight.alias("_3")
    ).write.parquet(f"{path}/whole/treesMetadata")
    grown.filter(F.col("round") < n).select(
        F.col("round").alias("treeID"), F.explode("nodes").alias("nodeData")
    ).write.parquet(f"{path}/whole/data")
    return GBTClassificationModel.load(f"{path}/whole")
