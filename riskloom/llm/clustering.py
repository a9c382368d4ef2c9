"""Centroid clustering with heap-ordered bounds, exact in integers.

Vectors become integers, ``floor(64 * x)``, and are cut into blocks of one Arrow batch. A
block keeps one heap a cluster. When a vector is scanned, the gap between its second
nearest and its nearest centroid is known; while the nearest has moved by no more than
``a`` and every other by no more than ``b``, with ``a + b`` below the gap, the vector
stays where it is. A cluster's accumulated drift is the sum of those ``a + b`` over the
rounds, so a vector's entry is ``gap + drift at its scan``: it never changes while the
centroids move, and the heap holds the entry that expires first at its top. A round pops
the expired entries, scans those vectors alone against all centroids, and pushes them
into the heaps of the clusters they now belong to.

Heaps are stored in heap order with their block, in a table a round below the shared
folder, so a lost executor costs a block's step. Centroids are moved by the sums of the
vectors that changed clusters; only these sums (``k`` rows) come to the driver.

Vectors that are NULL, have another number of components, or hold a NULL or non-finite
one are left out. Components beyond ``MOST`` are set to it, so that distances stay exact
64-bit numbers. Repeated rows are vectors like others; rows without id are clustered but
never the first centroids. With fewer than ``k`` vectors with ids each of them is a
centroid; without any there are no clusters and no rows. Sums beyond 64 bits are NULL.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import land, session

SIZE, SCALE, K, ROUNDS, SEED = 64, 64, 16, 3, 1
# 64 * (2 * MOST)^2 is below 2^61
MOST = 1 << 26
# entries this near to expiry are popped too: far above what rounding can do to a gap
SLACK = 1e-3

STATE = (
    "ids array<long>, v array<int>, due array<double>, at array<int>, "
    "heap_sizes array<int>, moved_at array<int>, moved_from array<int>, moved_to array<int>"
)
ASSIGNED = "vec_id long, cluster int, distance long"


@dataclass(frozen=True)
class Centres:
    """Centroids of a round and each cluster's accumulated drift."""

    points: np.ndarray
    drift: np.ndarray

    def moved(self, points: np.ndarray) -> Centres:
        gone = np.sqrt(((points - self.points) ** 2).sum(axis=1).astype("float64"))
        if len(gone) == 1:
            return Centres(points, self.drift + gone)
        # the farthest move of any other centroid
        top, second = np.sort(gone)[::-1][:2]
        others = np.where((gone == top) & (np.arange(len(gone)) == gone.argmax()), second, top)
        return Centres(points, self.drift + gone + others)


def integer_vectors(df: DataFrame, size: int = SIZE, id: str = "vec_id", vec: str = "embedding"):
    """``vec_id, v`` (array<int>) of the vectors that are kept."""
    x = F.col("x")

    def finite(c):
        value = c.cast("double")
        return value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))

    def whole(c):
        scaled = F.floor(
            F.greatest(F.least(c.cast("double") * SCALE, F.lit(float(MOST))), F.lit(-float(MOST)))
        )
        return scaled.cast("int")

    kept = df.select(F.col(id).cast("long").alias("vec_id"), F.col(vec).alias("x")).filter(
        x.isNotNull() & (F.size(x) == size) & F.forall(x, finite)
    )
    return kept.select("vec_id", F.transform(x, whole).alias("v"))


def first_centroids(vectors: DataFrame, k: int = K, seed: int = SEED) -> np.ndarray:
    """The ``k`` vectors whose keyed hashes are least; equal ids by their components."""
    draw = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    least = (
        vectors.filter("vec_id IS NOT NULL")
        .select(draw.alias("h"), "v")
        .orderBy("h", "v")
        .limit(k)
        .collect()
    )
    return np.array([r["v"] for r in least], dtype="int64")


def distances(v: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Exact squared distances, rows of ``v`` by centroids."""
    out = np.empty((len(v), len(centres)), dtype="int64")
    for j, c in enumerate(centres):
        out[:, j] = ((v - c) ** 2).sum(axis=1)
    return out


def scan(v: np.ndarray, centres: Centres) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid (ties: the smaller number) and the heap entry of each vector."""
    d = distances(v, centres.points)
    nearest = d.argmin(axis=1)
    if d.shape[1] == 1:
        return nearest, np.full(len(v), np.inf)
    two = np.sqrt(np.partition(d, 1, axis=1)[:, :2].astype("float64"))
    return nearest, two[:, 1] - two[:, 0] + centres.drift[nearest]


def _listed(values, kind: pa.DataType) -> pa.ListArray:
    """One row that holds all ``values``."""
    flat = values if isinstance(values, pa.Array) else pa.array(values, kind)
    return pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat)


def _pack(schema: pa.Schema, ids, v, heaps: list[list], moved: list[tuple]) -> pa.RecordBatch:
    entries = [e for heap in heaps for e in heap]
    columns = {
        "ids": ids,
        "v": v,
        "due": [e[0] for e in entries],
        "at": [e[1] for e in entries],
        "heap_sizes": [len(heap) for heap in heaps],
        "moved_at": [m[0] for m in moved],
        "moved_from": [m[1] for m in moved],
        "moved_to": [m[2] for m in moved],
    }
    made = [_listed(columns[f.name], f.type.value_type) for f in schema]
    return pa.RecordBatch.from_arrays(made, schema=schema)


def _values(batch: pa.RecordBatch, name: str, row: int) -> np.ndarray:
    return batch.column(name)[row].values.to_numpy(zero_copy_only=False)


def _heaps(batch: pa.RecordBatch, row: int) -> list[list]:
    entries = list(zip(_values(batch, "due", row).tolist(), _values(batch, "at", row).tolist()))
    ends = np.cumsum(_values(batch, "heap_sizes", row)).tolist()
    return [entries[a:b] for a, b in zip([0, *ends], ends)]


def step(v: np.ndarray, heaps: list[list], centres: Centres) -> list[tuple[int, int, int]]:
    """Pop what expired, scan it, push it; the moves as (vector, from, to)."""
    popped = []
    for cluster, heap in enumerate(heaps):
        limit = centres.drift[cluster] + SLACK
        while heap and heap[0][0] <= limit:
            popped.append((heapq.heappop(heap)[1], cluster))
    if not popped:
        return []
    nearest, due = scan(v[[i for i, _ in popped]], centres)
    moved = []
    for (i, before), now, key in zip(popped, nearest.tolist(), due.tolist()):
        heapq.heappush(heaps[now], (key, i))
        if now != before:
            moved.append((i, before, now))
    return moved


def _started(centres: Centres, schema: pa.Schema, dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            flat = batch.column("v").flatten()
            v = flat.to_numpy(zero_copy_only=False).astype("int64").reshape(-1, dim)
            nearest, due = scan(v, centres)
            heaps: list[list] = [[] for _ in centres.points]
            for i, (home, key) in enumerate(zip(nearest.tolist(), due.tolist())):
                heaps[home].append((key, i))
            for heap in heaps:
                heapq.heapify(heap)
            moved = [(i, -1, c) for i, c in enumerate(nearest.tolist())]
            yield _pack(schema, batch.column("vec_id"), flat, heaps, moved)

    return run


def _stepped(centres: Centres, schema: pa.Schema, dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                v = _values(batch, "v", i).astype("int64").reshape(-1, dim)
                heaps = _heaps(batch, i)
                moved = step(v, heaps, centres)
                ids, flat = batch.column("ids")[i].values, batch.column("v")[i].values
                yield _pack(schema, ids, flat, heaps, moved)

    return run


def _members(centres: Centres, schema: pa.Schema, dim: int):
    """Every vector's cluster and its exact distance to that one centroid."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                v = _values(batch, "v", i).astype("int64").reshape(-1, dim)
                sizes = _values(batch, "heap_sizes", i)
                home = np.empty(len(v), dtype="int32")
                home[_values(batch, "at", i)] = np.repeat(np.arange(len(sizes)), sizes)
                d = ((v - centres.points[home]) ** 2).sum(axis=1)
                columns = [batch.column("ids")[i].values, pa.array(home), pa.array(d)]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


def _arrow(names_and_types: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64()}
    kinds |= {f"array<{k}>": pa.list_(t) for k, t in list(kinds.items())}
    pairs = (field.strip().split(" ") for field in names_and_types.split(","))
    return pa.schema([(name, kinds[kind]) for name, kind in pairs])


def _change(state: DataFrame, k: int, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """What the moves of a round add to the clusters' sums and counts: 2k rows or fewer."""
    moves = state.filter(F.size("moved_at") > 0).select(
        "v", F.explode(F.arrays_zip("moved_at", "moved_from", "moved_to")).alias("m")
    )
    each = moves.select(
        F.slice("v", F.col("m.moved_at") * dim + 1, dim).alias("x"),
        F.explode(
            F.array(
                F.struct(F.col("m.moved_to").alias("c"), F.lit(1).cast("long").alias("s")),
                F.struct(F.col("m.moved_from").alias("c"), F.lit(-1).cast("long").alias("s")),
            )
        ).alias("e"),
    ).filter("e.c >= 0")
    total = each.groupBy(F.col("e.c").alias("c")).agg(
        F.sum("e.s").alias("n"),
        F.array(*[F.sum(F.get("x", F.lit(j)).cast("long") * F.col("e.s")) for j in range(dim)]).alias("x"),
    )
    sums, counts = np.zeros((k, dim), dtype="int64"), np.zeros(k, dtype="int64")
    for row in total.collect():
        sums[row["c"]], counts[row["c"]] = row["x"], row["n"]
    return sums, counts


@dataclass(frozen=True)
class Clustering:
    """``assigned``: vec_id, cluster, distance (squared) of every kept vector."""

    assigned: DataFrame
    centroids: np.ndarray


def cluster(
    df: DataFrame,
    k: int = K,
    rounds: int = ROUNDS,
    seed: int = SEED,
    size: int = SIZE,
    id: str = "vec_id",
    vec: str = "embedding",
) -> Clustering:
    """``rounds`` rounds of assigning and moving, then one more assignment. Runs jobs.

    A moved centroid is the componentwise floor of its vectors' mean; an empty one stays.
    """
    spark = session(df.sparkSession)
    vectors = integer_vectors(df, size, id, vec)
    points = first_centroids(vectors, k, seed)
    if not len(points):
        return Clustering(spark.createDataFrame([], ASSIGNED), points)
    centres = Centres(points, np.zeros(len(points)))
    arrow = _arrow(STATE)
    state = land(vectors.mapInArrow(_started(centres, arrow, size), STATE), "clusters")
    sums, counts = _change(state, len(points), size)
    for _ in range(rounds):
        full = counts > 0
        points = centres.points.copy()
        points[full] = sums[full] // counts[full, None]  # floors, also below zero
        centres = centres.moved(points)
        state = land(state.mapInArrow(_stepped(centres, arrow, size), STATE), "clusters")
        more, joined = _change(state, len(points), size)
        sums, counts = sums + more, counts + joined
    assigned = state.mapInArrow(_members(centres, _arrow(ASSIGNED), size), ASSIGNED)
    return Clustering(assigned, centres.points)


def with_inertia(found: Clustering) -> DataFrame:
    """Add each cluster's and the whole inertia and the hash of the final centroid."""
    spark = found.assigned.sparkSession
    rows = land(found.assigned, "cluster-members")
    sums = rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d"))
    inertia = {r["cluster"]: int(r["d"]) for r in sums.collect()}  # k rows

    def fits(total: int) -> int | None:
        return total if total < 1 << 63 else None

    facts = [
        (
            i,
            fits(inertia.get(i, 0)),
            fits(sum(inertia.values())),
            hashlib.sha256(",".join(map(str, point)).encode()).hexdigest(),
        )
        for i, point in enumerate(found.centroids.tolist())
    ]
    named = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    return rows.join(F.broadcast(spark.createDataFrame(facts, named)), "cluster")
