import zlib
from collections import defaultdict

from cases import EDGE, edge_docs, no_docs

from riskloom.llm import sharding


def check(rows, shards):
    by = defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r)
    total = sum(r["size"] for r in rows)
    largest = max(r["size"] for r in rows)
    order = []
    for shard in sorted(by):
        assert 0 <= shard < shards
        assert sorted(r["slot"] for r in by[shard]) == list(range(len(by[shard])))
        order += sorted(by[shard], key=lambda r: r["slot"])
    for shard in range(shards):
        assert abs(sum(r["size"] for r in by[shard]) - total / shards) <= largest
    ids = [(r["doc_id"] is not None, r["doc_id"] or 0) for r in order]
    assert ids == sorted(ids)


def test_edge_cases(spark):
    rows = sharding.shard_table(edge_docs(spark), shards=3).collect()
    assert len(rows) == len(EDGE)
    want = sorted((len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for _, t, *_ in EDGE)
    assert sorted((r["size"], r["text_crc32"]) for r in rows) == want
    check(rows, 3)


def test_balance_and_hot_key(spark):
    data = [(None if i % 3 == 0 else i, "x" * (i * 37 % 200)) for i in range(3000)]
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(7)
    check(sharding.shard_table(df).collect(), 8)


def test_equal_prefix_sums_of_brute_force(spark):
    data = [(i, "y" * (i * 53 % 97)) for i in range(500)]
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(5)
    start, total, want = 0, sum(len(t) + 1 for _, t in data), {}
    for i, t in data:
        want[i] = start * 8 // total
        start += len(t) + 1
    assert {r["doc_id"]: r["shard"] for r in sharding.shard_table(df).collect()} == want


def test_empty_table(spark):
    assert sharding.shard_table(no_docs(spark)).count() == 0


def test_written_shards_hold_every_row(spark, tmp_path):
    sharding.write_shards(edge_docs(spark), str(tmp_path / "out"), shards=2)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == len(EDGE) and set(back.columns) >= {"shard", "slot", "kept", "text"}
