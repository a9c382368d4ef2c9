"""Near-duplicate groups: fast similarity sketches, banding, exact verification.

A document is the set of its distinct word shingles. Its sketch is filled in rounds: in
round ``i`` every shingle is hashed to one bin with a value that grows with ``i``, and
each bin keeps its least value; bins still empty after ``SIZE`` rounds get a round of
their own, so every coordinate is filled, and two sketches agree in a coordinate with
the probability of the sets' Jaccard similarity, with the concentration of independent
coordinates. 48 bands of 6 coordinates find a pair of similarity 0.8 but for a
probability below 1e-6; all coordinates, four bits of each, then tell candidates that
agree in five standard deviations fewer than such a pair would (below 1e-6 again); every
other candidate is decided on the full sets.

Groups of copies never become pairs. Documents with equal sets are one class, folded
before the shuffle. In each bucket all classes are compared with one hub only, the class
with the most bucket mates, first where they share most buckets; links are joined to
components. What is left are the classes outside the largest component of a bucket: they
are compared with the bucket's classes of other components, by coordinates inside the
join, which puts out a pair once, in the first bucket that it shares. So no pair of a
shared bucket is left undecided unless its ends are in one component already.

Classes are named by a 128-bit digest of their set. NULL and empty texts, and texts
without words, have the empty set; they and rows with a NULL id are linked with nothing
and kept. Repeated rows are one document each, under the same id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import fresh, land, session

SHINGLE = 5
PERCENT = 80
BANDS, ROWS = 48, 6
SIZE = 4 * BANDS * ROWS  # coordinates; the bands take the first quarter
PLANES = 4  # bits of a coordinate that are kept to compare
WIDTH = SIZE // 64  # longs of a plane
SIGMAS = 5
# hash evaluations done at once
BLOCK = 4096

_M64 = (1 << 64) - 1
_GOLD = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64), on uint64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _seeds(n: int, salt: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_GOLD) + np.uint64(salt))


ROUND_SEEDS = _seeds(2 * SIZE, 1)
BAND_SEEDS = _seeds(ROWS, 2) | np.uint64(1)
PLACE_SEEDS = _seeds(64, 3) | np.uint64(1)


def shingle_set(text: str | None, k: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles, A-Z lower-cased.

    Words are runs of anything but ASCII white space; a text of fewer words is one
    shingle.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, n)
    width = min(k, n)
    total = np.full(n - width + 1, width * _GOLD & _M64, np.uint64)
    for j in range(width):
        total += mix(h[j : n - width + 1 + j]) * PLACE_SEEDS[j]
    return np.unique(mix(total))


def set_digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def sketch(shingles: np.ndarray) -> np.ndarray:
    """``SIZE`` coordinates of a non-empty set; a value is (round, 32 bits of hash)."""
    bins = np.full(SIZE, _M64, np.uint64)
    low, shift = np.uint64(0xFFFFFFFF), np.uint64(32)
    step = max(1, BLOCK // len(shingles))
    at = 0
    while at < SIZE and bins.max() == _M64:
        rounds = np.arange(at, min(at + step, SIZE), dtype=np.uint64)
        r = mix(shingles[None, :] ^ ROUND_SEEDS[rounds.astype(np.int64)][:, None])
        place = ((r >> shift) * np.uint64(SIZE)) >> shift
        value = (rounds[:, None] << shift) | (r & low)
        np.minimum.at(bins, place.ravel().astype(np.int64), value.ravel())
        at += step
    empty = np.flatnonzero(bins == _M64)  # only for sets of few shingles
    if len(empty):
        r = mix(shingles[None, :] ^ ROUND_SEEDS[SIZE + empty][:, None])
        bins[empty] = ((SIZE + empty).astype(np.uint64) << shift) | (r & low).min(axis=1)
    return bins


def band_keys(bins: np.ndarray) -> np.ndarray:
    """One 64-bit key a band, as int64."""
    rows = (mix(bins[: BANDS * ROWS].reshape(BANDS, ROWS)) * BAND_SEEDS).sum(axis=1, dtype=np.uint64)
    return mix(rows + np.arange(BANDS, dtype=np.uint64) * np.uint64(_GOLD)).view(np.int64)


def bit_planes(bins: np.ndarray) -> np.ndarray:
    """``PLANES`` bits of every coordinate, plane by plane, as int64."""
    low = mix(bins)[None, :] >> np.arange(PLANES, dtype=np.uint64)[:, None]
    return np.packbits((low & np.uint64(1)).astype(bool), axis=1).view("<i8").ravel()


def agreeing(a: Column, b: Column) -> Column:
    """Coordinates whose kept bits are equal, of two ``planes`` columns."""
    total = None
    for w in range(WIDTH):
        places = [F.lit(p * WIDTH + w) for p in range(PLANES)]
        differ = None
        for i in places:
            x = F.get(a, i).bitwiseXOR(F.get(b, i))
            differ = x if differ is None else differ.bitwiseOR(x)
        same = F.bit_count(F.bitwise_not(differ))
        total = same if total is None else total + same
    return total


def least_agreement(percent: int) -> int:
    """``SIGMAS`` standard deviations below the mean of a pair that just links."""
    j = percent / 100
    p = j + (1 - j) / 2**PLANES
    return int(SIZE * p - SIGMAS * (SIZE * p * (1 - p)) ** 0.5)


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (len(a) + len(b) - common)


def sketched(docs: DataFrame, shingle: int) -> DataFrame:
    """doc_id, text_hash, n_shingles, digest, bands; the last two NULL for no words."""
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("text_hash", pa.int64()),
            ("n_shingles", pa.int64()),
            ("digest", pa.binary()),
            ("bands", pa.list_(pa.int64())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, bands = [], [], []
            seen: dict[bytes | None, np.ndarray | None] = {None: None}
            for text in batch.column(2).to_pylist():
                found = shingle_set(text, shingle)
                sizes.append(len(found))
                digest = set_digest(found) if len(found) else None
                if digest and digest not in seen:
                    seen[digest] = band_keys(sketch(found))
                digests.append(digest)
                bands.append(seen[digest])
            columns = [batch.column(0), batch.column(1)]
            for values, field in zip((sizes, digests, bands), list(schema)[2:]):
                columns.append(pa.array(values, field.type))
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text"
    ).mapInArrow(
        run, "doc_id long, text_hash long, n_shingles long, digest binary, bands array<long>"
    )


def verified(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """``pairs`` (a, b) with ``link``, decided on the full sets. ``texts``: digest, text."""
    left = texts.select(F.col("digest").alias("a"), F.col("text").alias("ta"))
    right = texts.select(F.col("digest").alias("b"), F.col("text").alias("tb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[bytes, np.ndarray] = {}

        def of(name: bytes, text: str) -> np.ndarray:
            if name not in kept:
                if len(kept) >= 64:
                    kept.pop(next(iter(kept)))
                kept[name] = shingle_set(text, shingle)
            return kept[name]

        for batch in batches:
            a, b, ta, tb = (batch.column(k).to_pylist() for k in range(4))
            found = [
                linked(of(x, s), of(y, t), percent) for x, y, s, t in zip(a, b, ta, tb)
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array(found, pa.bool_())],
                names=["a", "b", "link"],
            )

    both = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "ta", "tb")
    return both.mapInArrow(run, "a binary, b binary, link boolean")


def components(links: DataFrame) -> DataFrame:
    """node, root (the least node reachable) for the nodes of ``links`` (a, b).

    Alternates two star steps: every node hangs its larger neighbours, then its smaller
    ones, to the least node around it; the edges shrink to stars in a logarithmic number
    of rounds. Neighbourhoods are only folded to their minimum, never gathered.
    """

    def star(edges: DataFrame, large: bool) -> DataFrame:
        if large:  # both directions
            around = edges.union(edges.select("b", "a"))
        else:
            around = edges
        least = around.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select("a", F.least("a", "m").alias("m"))
        joined = around.join(least, "a")
        if large:
            moved = joined.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
                least.select("a", F.col("m").alias("b"))
            )
        return moved.filter(F.col("a") != F.col("b")).distinct()

    def mark(edges: DataFrame) -> tuple:
        h = F.xxhash64("a", "b")
        return tuple(
            edges.agg(F.count(F.lit(1)), F.bit_xor(h), F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF)))).first()
        )

    # every edge from its larger end to its smaller
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = land(down.filter(F.col("a") != F.col("b")).distinct(), "links")
    last = mark(edges)
    while True:
        edges = land(star(star(edges, True), False), "links")
        now = mark(edges)
        if now == last:
            break
        last = now
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())


def class_links(
    members: DataFrame, texts: DataFrame, shingle: int, percent: int
) -> DataFrame | None:
    """node, root of the classes that are linked.

    ``members``: bucket, digest, n, of the buckets of several classes; ``texts``: digest,
    text, bands, planes of their classes.
    """
    if members.isEmpty():
        return None
    enough = least_agreement(percent)
    sizes_fit = lambda n, m: 100 * F.least(n, m) >= percent * F.greatest(n, m)
    planes = texts.select("digest", "planes")
    tried: list[DataFrame] = []
    roots: DataFrame | None = None

    def decide(pairs: DataFrame) -> None:
        """Verify new pairs (a, b), and join the links found to the components."""
        nonlocal roots
        if tried:
            pairs = pairs.join(reduce(DataFrame.union, tried), ["a", "b"], "left_anti")
        result = land(verified(pairs, texts.select("digest", "text"), shingle, percent), "verified")
        new = result.filter("link").select("a", "b")
        tried.append(result.select("a", "b").union(result.select("b", "a")))
        if roots is None:
            roots = land(components(new), "roots")
        elif not new.isEmpty():
            stars = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
            roots = land(components(stars.union(new)), "roots")

    def likely(pairs: DataFrame) -> DataFrame:
        left = planes.select(F.col("digest").alias("a"), F.col("planes").alias("pa"))
        right = planes.select(F.col("digest").alias("b"), F.col("planes").alias("pb"))
        both = pairs.join(left, "a").join(right, "b")
        return both.filter(agreeing(F.col("pa"), F.col("pb")) >= enough).select("a", "b")

    def root_of(rows: DataFrame, name: str, out: str) -> DataFrame:
        named = roots.select(F.col("node").alias(name), F.col("root").alias(out))
        return rows.join(named, name, "left").withColumn(out, F.coalesce(out, name))

    mates = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("mates"))
    degrees = members.join(mates, "bucket").groupBy("digest").agg(F.sum("mates").alias("degree"))
    rows = land(members.join(degrees, "digest"), "members")
    hubs = (
        rows.groupBy("bucket")
        .agg(F.max(F.struct("degree", "digest", "n")).alias("h"))
        .select("bucket", F.col("h.digest").alias("hub"), F.col("h.n").alias("hub_n"))
    )
    shared = (
        rows.join(hubs, "bucket")
        .filter((F.col("digest") != F.col("hub")) & sizes_fit("n", "hub_n"))
        .groupBy(F.col("digest").alias("a"), F.col("hub").alias("b"))
        .agg(F.count(F.lit(1)).alias("times"))
    )
    beside = land(shared, "hub-pairs")
    # each class with the hub that it shares most buckets with, then with the others
    best = beside.groupBy("a").agg(F.max_by("b", F.struct("times", "b")).alias("b"))
    decide(likely(best))
    others = root_of(root_of(beside.select("a", "b"), "a", "ra"), "b", "rb")
    decide(likely(others.filter("ra != rb").select("a", "b")))

    # classes outside the largest component of their bucket
    rooted = root_of(rows.select("bucket", "digest", "n"), "digest", "root")
    parts = rooted.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("k"))
    main = parts.groupBy("bucket").agg(
        F.max_by("root", F.struct("k", "root")).alias("main"), F.count(F.lit(1)).alias("parts")
    )
    several = main.filter("parts > 1").drop("parts")
    kept = texts.select("digest", "bands", "planes")
    left = land(rooted.join(several, "bucket").join(kept, "digest"), "left")
    outside = left.filter("root != main").alias("x")
    inside = left.alias("y")
    before = lambda side: F.filter(f"{side}.bands", lambda k: k < F.col("x.bucket"))
    crossing = outside.join(
        inside,
        (F.col("x.bucket") == F.col("y.bucket"))
        & (F.col("x.root") != F.col("y.root"))
        & ((F.col("y.root") == F.col("y.main")) | (F.col("x.digest") < F.col("y.digest")))
        & sizes_fit("x.n", "y.n")
        & (agreeing(F.col("x.planes"), F.col("y.planes")) >= enough)
        & ~F.arrays_overlap(before("x"), before("y")),
    )
    decide(crossing.select(F.col("x.digest").alias("a"), F.col("y.digest").alias("b")).distinct())
    return roots


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id, kept of every row of ``docs``.

    ``component_id`` is the least id of the row's group; ``kept`` marks it. Runs jobs.
    """
    session(docs.sparkSession)
    rows = land(sketched(docs, shingle), "sketches")
    named = rows.filter("digest IS NOT NULL AND doc_id IS NOT NULL")
    classes = land(
        named.groupBy("digest").agg(
            F.min("doc_id").alias("first_id"),
            F.min("n_shingles").alias("n"),
            F.any_value("bands").alias("bands"),
            F.count(F.lit(1)).alias("copies"),
        ),
        "classes",
    )
    banded = classes.select("digest", "n", F.explode("bands").alias("bucket"))
    # a class has a row of its own, so two rows are two classes
    shared = (
        banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("bucket")
    )
    members = land(banded.join(shared, "bucket", "left_semi"), "buckets")
    wanted = members.select("digest").distinct().join(classes.select("digest", "first_id"), "digest")
    texts = land(_class_texts(docs, wanted, shingle), "texts")
    roots = class_links(members, texts, shingle, percent)
    copies = classes.filter("copies > 1").select("digest", "first_id")
    if roots is None:
        groups = copies.select("digest", F.col("first_id").alias("component_id"))
    else:
        named_roots = roots.join(
            classes.select(F.col("digest").alias("node"), "first_id"), "node"
        )
        least = named_roots.groupBy("root").agg(F.min("first_id").alias("component_id"))
        in_links = named_roots.join(least, "root").select(
            F.col("node").alias("digest"), "component_id"
        )
        alone = copies.join(in_links, "digest", "left_anti").select(
            "digest", F.col("first_id").alias("component_id")
        )
        groups = in_links.union(alone)
    joined = rows.drop("bands").join(groups, "digest", "left")
    member = F.col("doc_id").isNotNull() & F.col("component_id").isNotNull()
    return joined.select(
        "doc_id",
        "text_hash",
        "n_shingles",
        F.when(member, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(member, F.col("component_id") == F.col("doc_id")).otherwise(True).alias("kept"),
    )


def _class_texts(docs: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """digest, text, bands, planes of the classes in ``wanted`` (digest, first_id): one text each.

    Sketches are wide, and most classes share no bucket: theirs are never shuffled whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            right, bands, planes = [], [], []
            for name, text in zip(*(batch.column(k).to_pylist() for k in range(2))):
                found = shingle_set(text, shingle)
                right.append(set_digest(found) == name)
                if right[-1]:
                    bins = sketch(found)
                    bands.append(band_keys(bins))
                    planes.append(bit_planes(bins))
            kept = batch.filter(pa.array(right, pa.bool_()))
            columns = [*kept.columns, *(pa.array(c, pa.list_(pa.int64())) for c in (bands, planes))]
            yield pa.RecordBatch.from_arrays(columns, names=["digest", "text", "bands", "planes"])

    found = docs.select(F.col("doc_id").cast("long").alias("first_id"), "text").join(
        wanted, "first_id"
    )
    # an id may stand for several texts
    checked = found.select("digest", "text").mapInArrow(
        run, "digest binary, text string, bands array<long>, planes array<long>"
    )
    return checked.groupBy("digest").agg(
        F.min("text").alias("text"),
        F.any_value("bands").alias("bands"),
        F.any_value("planes").alias("planes"),
    )


def deduplicate(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that are kept, one of each group, with their columns."""
    own, id_, hash_ = fresh(docs, "_th", "_id", "_hash")
    kept = (
        near_duplicates(docs.select("doc_id", "text"), shingle, percent)
        .filter("kept AND doc_id IS NOT NULL")
        .select(F.col("doc_id").alias(id_), F.col("text_hash").alias(hash_))
        .distinct()
    )
    hashed = docs.withColumn(own, F.xxhash64("text"))
    with_id = hashed.join(kept, (F.col("doc_id") == F.col(id_)) & (F.col(own) == F.col(hash_)))
    chosen = with_id.dropDuplicates(["doc_id", own]).drop(own, id_, hash_)
    return chosen.unionByName(docs.filter("doc_id IS NULL"))
