import hashlib
import heapq
import math

import numpy as np
import pytest

from riskloom.llm import clustering as c
from riskloom.llm.common import table

SCHEMA = "vec_id long, embedding array<double>, cluster string, v string, distance string"


def brute(rows, k, rounds, seed, size):
    kept = [
        (i, tuple(math.floor(64 * x) for x in e))
        for i, e in rows
        if e is not None
        and len(e) == size
        and all(x is not None and math.isfinite(x) for x in e)
    ]
    key = lambda r: (hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1])
    points = [list(v) for _, v in sorted((r for r in kept if r[0] is not None), key=key)[:k]]

    def far(v, p):
        return sum((a - b) ** 2 for a, b in zip(v, p))

    def nearest(v):
        return min(range(len(points)), key=lambda j: (far(v, points[j]), j))

    for _ in range(rounds):
        homes = [nearest(v) for _, v in kept]
        for j in range(len(points)):
            own = [v for (_, v), h in zip(kept, homes) if h == j]
            if own:
                points[j] = [sum(x) // len(own) for x in zip(*own)]
    out = [(i, nearest(v), far(v, points[nearest(v)])) for i, v in kept]
    return out, points


def found(spark, rows, **options):
    frame = spark.createDataFrame([(i, e, "x", "y", "z") for i, e in rows], SCHEMA)
    return c.cluster(frame.repartition(3), **options)


def key(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


@pytest.mark.parametrize("k, rounds, size", [(5, 4, 3), (16, 3, 8), (1, 2, 3), (3, 0, 2)])
def test_equals_brute_force(spark, k, rounds, size):
    draw = np.random.default_rng(k)
    rows = [(i, draw.normal(i % 4, 0.6, size).tolist()) for i in range(300)]
    rows += [(7, rows[7][1])] * 40 + [(1000 + i, [0.5] * size) for i in range(60)]
    got = found(spark, rows, k=k, rounds=rounds, size=size)
    want, points = brute(rows, k, rounds, 1, size)
    assert got.centroids.tolist() == points
    assert key(tuple(r) for r in got.assigned.collect()) == key(want)


def test_ties_go_to_the_smaller_number(spark):
    # every vector is as far from both centroids
    rows = [(1, [0.0, 1.0]), (2, [0.0, -1.0])] + [(i, [i / 4, 0.0]) for i in range(3, 20)]
    got = found(spark, rows, k=2, rounds=0, size=2)
    want, _ = brute(rows, 2, 0, 1, 2)
    assert key(tuple(r) for r in got.assigned.collect()) == key(want)


def test_rows_that_are_left_out_and_rows_without_id(spark):
    bad = [None, [], [1.0], [1.0, None], [1.0, float("nan")], [float("inf"), 0.0], [1.0] * 3]
    rows = [(i, e) for i, e in enumerate(bad)] + [(None, [0.1, 0.2]), (50, [3.0, 4.0])]
    got = found(spark, rows, k=4, rounds=3, size=2)
    assert got.centroids.shape == (1, 2)
    want, _ = brute(rows, 4, 3, 1, 2)
    assert key(tuple(r) for r in got.assigned.collect()) == key(want)
    huge = found(spark, [(1, [1e300, -1e300]), (2, [0.0, 0.0])], k=2, size=2)
    made = c.with_inertia(huge).collect()
    assert {r["distance"] for r in made} == {0}


def test_empty_table_and_only_rows_without_id(spark):
    for rows in ([], [(None, [1.0, 2.0])]):
        made = c.with_inertia(found(spark, rows, k=4, size=2))
        assert made.count() == 0 and "centroid_sha256" in made.columns


def test_only_expired_entries_are_popped():
    draw = np.random.default_rng(3)
    v = draw.integers(-50, 50, (400, 4)).astype("int64")
    start = c.Centres(v[:6].copy(), np.zeros(6))
    homes, due = c.scan(v, start)
    heaps = [[] for _ in range(6)]
    for i, (home, entry) in enumerate(zip(homes.tolist(), due.tolist())):
        heapq.heappush(heaps[home], (entry, i))
    points = start.points.copy()
    points[2] += 3
    after = start.moved(points)
    # the others are offset by the move of the third, the third by its own
    assert np.allclose(after.drift, 6.0)
    expired = sum(e[0] <= after.drift[h] + c.SLACK for h, heap in enumerate(heaps) for e in heap)
    seen = []
    scan, c.scan = c.scan, lambda x, y: (seen.append(len(x)), scan(x, y))[1]
    try:
        c.step(v, heaps, after)
    finally:
        c.scan = scan
    assert seen == [expired] and 0 < expired < len(v)
    for home, heap in enumerate(heaps):
        assert all(c.distances(v[[i]], points).argmin() == home for _, i in heap)
        assert all(heap[n] <= heap[m] for n in range(len(heap)) for m in (2 * n + 1, 2 * n + 2) if m < len(heap))


def test_whole_table(spark):
    frame = table(spark, "/root/testdata/sf0.001", "embeddings")
    rows = [(r["vec_id"], r["embedding"]) for r in frame.collect()]
    want, _ = brute(rows, c.K, c.ROUNDS, c.SEED, c.SIZE)
    made = c.with_inertia(c.cluster(frame)).collect()
    assert key((r["vec_id"], r["cluster"], r["distance"]) for r in made) == key(want)
    assert {r["inertia"] for r in made} == {sum(w[2] for w in want)}
    for r in made:
        assert r["cluster_inertia"] == sum(w[2] for w in want if w[1] == r["cluster"])
