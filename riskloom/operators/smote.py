"""Synthetic minority oversampling with exact nearest neighbours.

The minority is reduced to distinct vectors with a count, so copies cost nothing,
and cut into small cells by a kd-tree whose levels are Spark aggregates. Neighbours are
searched in three steps, none of which forms all pairs:

1. within each cell, which gives every vector an upper bound on its k-th distance;
2. in the other cells whose bounding box comes closer than that bound, found by descending
   a hierarchy of boxes;
3. the k best of both.

A cell outside the bound cannot hold a nearer vector, so the result is exact. Neither
vectors nor cells come to the driver: of each level it learns whether there is another.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.sampling import TREE_SEED, take_by_hash
from riskloom.session import scratch_dir

# the task functions below travel whole: executors need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

RATIO = 0.7
NEIGHBOURS = 5
CELL_ROWS = 1024
# of a node's quartiles; a coarse one only makes cells less even
ACCURACY = 200
# levels of the box hierarchy that one join descends, so at most 2^4 boxes a visit
STRIDE = 4
# boxes of the first levels, 2^(STRIDE * level) at most, are broadcast up to this number
BROADCAST_BOXES = 1 << (3 * STRIDE)
# searches of one cell, and synthetic rows of one vector, handled by one task
VISITS_PER_TASK = 50_000
ROWS_PER_TASK = 100_000
_BLOCK = 64
_NEAR = "array<struct<d: double, x: array<double>, m: bigint>>"


def oversample(
    df: DataFrame,
    ratio: float = RATIO,
    k: int = NEIGHBOURS,
    seed: int = TREE_SEED,
    label: str = "label",
    features: str = "features",
    key: str = "tx_id",
    weight: str | None = None,
    cell_rows: int = CELL_ROWS,
    trace: bool = False,
) -> DataFrame:
    """Originals plus synthetic positives until they are ``ratio`` of the negatives.

    Each synthetic vector lies between a positive and one of its ``k`` nearest
    neighbours. Returns ``key, features, label, synthetic`` and ``weight`` if named;
    synthetic rows have no key and weight 1. With ``trace`` also ``base``, the least key
    of the positives with the vector that a synthetic one starts from, and ``reach``, the
    distance from there to the ``k``-th neighbour. Runs jobs: the neighbour search goes
    through written tables in the shared scratch folder.
    """
    weights = [weight] if weight else []
    kind = df.schema[key].dataType
    untraced = [F.lit(None).cast(kind).alias("base"), F.lit(None).cast("double").alias("reach")]
    originals = df.select(
        key, features, label, *weights, F.lit(False).alias("synthetic"), *(untraced if trace else [])
    )
    sizes = {r[label]: r["n"] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    n_min, n_maj = sizes.get(1, 0), sizes.get(0, 0)
    wanted = int(ratio * n_maj) - n_min
    if wanted <= 0:
        return originals
    if n_min <= k:
        raise ValueError(f"{n_min} positives are too few for {k} neighbours")

    spark = df.sparkSession
    folder = scratch_dir(spark, "smote")
    vector = vector_to_array(features).alias("x")
    rows = df.filter(F.col(label) == 1).select(key, vector).withColumn("pid", _pid("x"))
    rows.groupBy("pid", "x").agg(
        F.count(F.lit(1)).alias("m"), F.min(key).alias("base")
    ).write.parquet(f"{folder}/points")
    points = spark.read.parquet(f"{folder}/points")

    # synthetic rows per original: the whole part for all, one more for an exact rest
    each, rest = divmod(wanted, n_min)
    extra = take_by_hash(rows.select(key, "pid"), rest, key, seed)
    extra = extra.groupBy("pid").agg(F.count(F.lit(1)).alias("extra"))
    near = nearest(points, k, folder, cell_rows).withColumn("reach", _reach(k))
    share = F.col("m") * each + F.coalesce("extra", F.lit(0))
    bases = near.join(extra, "pid", "left").withColumn("n", share).filter(F.col("n") > 0)
    synthetic = _interpolate(bases, k, seed).select(
        F.lit(None).cast(kind).alias(key),
        array_to_vector("x").alias(features),
        F.lit(1).cast(df.schema[label].dataType).alias(label),
        *[F.lit(1.0).alias(w) for w in weights],
        F.lit(True).alias("synthetic"),
        *(["base", "reach"] if trace else []),
    )
    return originals.unionByName(synthetic)


def _pid(x: str):
    return F.md5(F.to_json(F.array(F.col(x))))


def _slots(k: int):
    """The first ``k`` neighbours of a vector; a copy is a neighbour too."""
    own = F.struct(F.lit(0.0).alias("d"), F.col("x").alias("x"), F.lit(0).cast("long").alias("m"))
    copies = F.array_repeat(own, F.least(F.col("m") - 1, F.lit(k)).cast("int"))
    others = F.flatten(
        F.transform("near", lambda o: F.array_repeat(o, F.least(o["m"], F.lit(k)).cast("int")))
    )
    return F.slice(F.concat(copies, others), 1, k)


def _reach(k: int):
    return F.element_at(_slots(k), -1)["d"]


def _interpolate(bases: DataFrame, k: int, seed: int) -> DataFrame:
    """``n`` points between each vector and its neighbours."""
    # a vector with very many synthetic rows is spread over several tasks first
    parts = F.floor((F.col("n") - 1) / ROWS_PER_TASK)
    spread = bases.select(
        "pid",
        "base",
        "reach",
        "x",
        "n",
        _slots(k)["x"].alias("slots"),
        F.explode(F.sequence(F.lit(0), parts)).alias("part"),
    ).repartition("pid", "part")
    first = F.col("part") * ROWS_PER_TASK
    last = F.least(F.col("n"), first + ROWS_PER_TASK) - 1
    drawn = spread.select("*", F.explode(F.sequence(first, last)).alias("i"))
    which = F.pmod(F.xxhash64(F.lit(seed), "pid", "i"), F.lit(k)).cast("int")
    gap = F.pmod(F.xxhash64(F.lit(seed + 1), "pid", "i"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = drawn.select(
        "base", "reach", "x", F.element_at("slots", which + 1).alias("o"), gap.alias("g")
    )
    # the gap is a column outside the lambda
    between = F.expr("zip_with(x, o, (a, b) -> a + g * (b - a))")
    return chosen.select("base", "reach", between.alias("x"))


def nearest(points: DataFrame, k: int, folder: str, cell_rows: int = CELL_ROWS) -> DataFrame:
    """The points with ``near``: the ``k`` nearest other vectors of each, nearest first."""
    spark = points.sparkSession
    if not _size(points):
        return points.withColumn("near", F.array().cast(_NEAR))
    cells = split_cells(points.select("pid", "x", "m"), folder, cell_rows)

    schema = f"pid string, x array<double>, m bigint, cell string, radius double, near {_NEAR}"
    cells.groupBy("cell").applyInPandas(_within(k), schema).write.parquet(f"{folder}/local")
    local = spark.read.parquet(f"{folder}/local")
    _visits(local, cells).write.parquet(f"{folder}/visits")
    visits = spark.read.parquet(f"{folder}/visits")
    # a much-visited cell is searched by several tasks
    tasks = visits.groupBy("cell").agg(
        F.ceil(F.count(F.lit(1)) / VISITS_PER_TASK).alias("tasks")
    )
    salt = F.pmod(F.xxhash64("pid"), F.col("tasks"))
    every_salt = F.explode(F.sequence(F.lit(0).cast("long"), F.col("tasks") - 1))
    asking = visits.join(tasks, "cell").select("cell", salt.alias("salt"), "pid", "x")
    searched = cells.join(tasks, "cell").select("cell", every_salt.alias("salt"), "x", "m")
    remote = (
        asking.groupBy("cell", "salt")
        .cogroup(searched.groupBy("cell", "salt"))
        .applyInPandas(_across(k), f"pid string, near {_NEAR}")
    )
    both = local.select("pid", "near").unionByName(remote)
    best = both.groupBy("pid").agg(
        F.slice(F.sort_array(F.flatten(F.collect_list("near"))), 1, k).alias("near")
    )
    return points.join(best, "pid")


# --- the tree ------------------------------------------------------------


def _size(points: DataFrame) -> int:
    """Components of a vector; 0 without vectors."""
    first = points.select(F.size("x").alias("n")).first()
    return first["n"] if first else 0


def _axis(i: int):
    return F.get("x", F.lit(i))


def _cuts(open_points: DataFrame, size: int, cell_rows: int) -> DataFrame:
    """``cell, axis, cut`` (``<=`` goes left) of the nodes above ``cell_rows``.

    The widest axis is taken that leaves a quarter or more on either side, which its
    quartiles tell: the median is a cut if the upper quartile lies above it, the lower
    quartile if it lies below. Where no axis has such a cut, most rows stand at one value of
    each, and the widest axis is cut at that value, or at its mean if that value is the
    greatest; both leave rows on either side.
    """
    sums = []
    for i in range(size):
        x = _axis(i)
        sums += [F.min(x).alias(f"l{i}"), F.max(x).alias(f"h{i}"), F.avg(x).alias(f"a{i}")]
        sums.append(F.percentile_approx(x, [0.25, 0.5, 0.75], ACCURACY).alias(f"q{i}"))
    nodes = open_points.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), *sums)
    options = []
    for i in range(size):
        low, middle, high = (F.get(f"q{i}", F.lit(j)) for j in range(3))
        even = (high > middle) | (low < middle)
        cut = (
            F.when(high > middle, middle)
            .when(low < middle, low)
            .when(middle < F.col(f"h{i}"), middle)
            .otherwise(F.col(f"a{i}"))
        )
        wide = F.col(f"h{i}") - F.col(f"l{i}")
        option = F.struct(
            even.cast("int").alias("even"),
            wide.alias("wide"),
            F.lit(-i).alias("order"),
            # rounding must not lift a mean to the greatest value
            F.when(cut < F.col(f"h{i}"), cut).otherwise(F.col(f"l{i}")).alias("cut"),
        )
        options.append(F.when(wide > 0, option))
    best = F.array_max(F.array(*options))
    return (
        nodes.filter(F.col("n") > cell_rows)
        .select("cell", best.alias("b"))
        .filter("b IS NOT NULL")
        .select("cell", (-F.col("b.order")).alias("axis"), F.col("b.cut").alias("cut"))
    )


def split_cells(points: DataFrame, folder: str, cell_rows: int) -> DataFrame:
    """The points with ``cell``: the path of left and right turns to their leaf.

    Every level takes one aggregation per node and one rewrite of the points whose nodes
    are still too large. The driver learns whether a level has cuts, nothing else.
    """
    spark = points.sparkSession
    size, level = _size(points), 0
    now = points.withColumn("cell", F.lit(""))
    leaves = []
    while size:
        _cuts(now, size, cell_rows).write.parquet(f"{folder}/cuts/{level}")
        cuts = spark.read.parquet(f"{folder}/cuts/{level}")
        if cuts.isEmpty():
            break
        value = F.get("x", F.col("axis"))
        turn = F.when(value > F.col("cut"), "1").otherwise("0")
        moved = now.join(cuts, "cell", "left").select(
            "pid",
            "x",
            "m",
            F.when(F.col("axis").isNull(), F.col("cell"))
            .otherwise(F.concat("cell", turn))
            .alias("cell"),
            F.col("axis").isNotNull().alias("open"),
        )
        # the level's leaves are read no more; the path of a folder holds the flag
        moved.write.partitionBy("open").parquet(f"{folder}/tree/{level}")
        schema = now.schema.add("open", "boolean")
        rows = spark.read.schema(schema).parquet(f"{folder}/tree/{level}")
        leaves.append(rows.filter("NOT open").drop("open"))
        now, level = rows.filter("open").drop("open"), level + 1
    for part in leaves:
        now = now.unionByName(part)
    now.write.parquet(f"{folder}/cells")
    return spark.read.parquet(f"{folder}/cells")


# --- the search ----------------------------------------------------------


def _visits(local: DataFrame, cells: DataFrame) -> DataFrame:
    """``cell, pid, x, radius``: every vector with the other cells that its ball meets.

    Boxes are nested by the prefixes of the cells' paths. Vectors descend from the root,
    ``STRIDE`` levels a join, into the boxes nearer than their radius.
    """
    size = _size(cells)
    ends = [f(_axis(i)).alias(f"{n}{i}") for i in range(size) for n, f in (("l", F.min), ("h", F.max))]
    boxes = cells.groupBy("cell").agg(*ends)
    depth = boxes.agg(F.max(F.length("cell"))).first()[0] or 0
    merged = [
        f(f"{n}{i}").alias(f"{n}{i}") for i in range(size) for n, f in (("l", F.min), ("h", F.max))
    ]
    out = sum(
        (
            F.pow(F.greatest(F.col(f"l{i}") - _axis(i), _axis(i) - F.col(f"h{i}"), F.lit(0.0)), 2)
            for i in range(size)
        ),
        F.lit(0.0),
    )
    here = local.select("pid", "x", "radius", F.col("cell").alias("own"), F.lit("").alias("at"))
    for level in range(STRIDE, depth + STRIDE, STRIDE):
        node = F.substring("cell", 1, level)
        nested = boxes.groupBy(node.alias("cell")).agg(*merged)
        nested = nested.withColumn("at", F.substring("cell", 1, level - STRIDE))
        if 1 << level <= BROADCAST_BOXES:
            nested = F.broadcast(nested)
        here = (
            here.join(nested, "at")
            .filter(F.sqrt(out) < F.col("radius"))
            .select("pid", "x", "radius", "own", F.col("cell").alias("at"))
        )
    return here.filter("own <> at").select(F.col("at").alias("cell"), "pid", "x", "radius")


def _search(queries: np.ndarray, x: np.ndarray, m: np.ndarray, k: int, own: bool) -> list[list]:
    """The ``k`` nearest rows of ``x`` for each query, in blocks of distances."""
    found = []
    for start in range(0, len(queries), _BLOCK):
        block = queries[start : start + _BLOCK]
        distance = np.sqrt(((block[:, None, :] - x[None, :, :]) ** 2).sum(axis=2))
        if own:
            distance[np.arange(len(block)), start + np.arange(len(block))] = np.inf
        top = min(k, len(x) - own)
        best = np.argsort(distance, axis=1, kind="stable")[:, :top]
        for row, picks in enumerate(best):
            found.append(
                [{"d": distance[row, p], "x": x[p].tolist(), "m": int(m[p])} for p in picks]
            )
    return found


def _within(k: int):
    def run(cell: pd.DataFrame) -> pd.DataFrame:
        x = np.stack(cell["x"].to_numpy())
        near = _search(x, x, cell["m"].to_numpy(), k, own=True)
        radius = [found[-1]["d"] if len(found) == k else np.inf for found in near]
        return cell.assign(radius=radius, near=near)[["pid", "x", "m", "cell", "radius", "near"]]

    return run


def _across(k: int):
    def run(visits: pd.DataFrame, cell: pd.DataFrame) -> pd.DataFrame:
        if visits.empty or cell.empty:
            return pd.DataFrame({"pid": [], "near": []})
        queries, x = np.stack(visits["x"].to_numpy()), np.stack(cell["x"].to_numpy())
        near = _search(queries, x, cell["m"].to_numpy(), k, own=False)
        return pd.DataFrame({"pid": visits["pid"].to_numpy(), "near": near})

    return run
