"""Splits, subsampling, weights, oversampling."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from riskloom.operators import sampling, smote
from riskloom.session import scratch_dir


@pytest.fixture(scope="module")
def labelled(spark):
    return spark.range(5000).select(
        F.col("id").alias("tx_id"), (F.col("id") % 10 == 0).cast("int").alias("label")
    )


def test_split_proportions_hold_per_class(labelled):
    for split, shares in (
        (sampling.split_80_20, {"train": 0.8, "val": 0.2}),
        (sampling.split_90_5_5, {"train": 0.9, "dev": 0.05, "test": 0.05}),
    ):
        counts = split(labelled).groupBy("label", "split").count().collect()
        for label, size in ((0, 4500), (1, 500)):
            mine = {r["split"]: r["count"] / size for r in counts if r["label"] == label}
            assert mine == pytest.approx(shares, abs=0.04)


def test_split_needs_no_shuffle(labelled):
    plan = sampling.split_80_20(labelled)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


@pytest.mark.parametrize("cap, negatives", [(2000, 1500), (501, 1), (500, 0), (10, 0), (9999, 4500)])
def test_subsample_is_exact(labelled, cap, negatives):
    out = sampling.subsample(labelled, cap)
    counts = {r["label"]: r["count"] for r in out.groupBy("label").count().collect()}
    assert counts.get(1) == 500 and counts.get(0, 0) == negatives
    assert out.select("tx_id").distinct().count() == out.count()


def test_subsample_grows_with_the_cap(labelled):
    small = {r["tx_id"] for r in sampling.subsample(labelled, 900).collect()}
    large = {r["tx_id"] for r in sampling.subsample(labelled, 1800).collect()}
    assert small < large


def test_weights(labelled):
    got = sampling.sample_weights(labelled).groupBy("label").agg(F.avg("weight").alias("w"))
    assert {r["label"]: r["w"] for r in got.collect()} == {0: 1.0, 1: 10.0}


def minority(n=900, copies=300):
    draw = np.random.RandomState(1)
    x = draw.randn(n, 4) * np.array([1000, 1, 1, 50.0])
    x[:copies] = x[0]
    return x


@pytest.fixture(scope="module")
def unbalanced(spark):
    draw = np.random.RandomState(2)
    data = [(i, 1, v.tolist()) for i, v in enumerate(minority())]
    data += [(1000 + i, 0, v.tolist()) for i, v in enumerate(draw.randn(3000, 4))]
    df = spark.createDataFrame(data, "tx_id long, label int, a array<double>")
    return df.select("tx_id", "label", array_to_vector("a").alias("features"))


def distances(x):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    np.fill_diagonal(d, np.inf)
    return np.sort(d, axis=1)


@pytest.mark.parametrize("cell_rows", [32, 4096])
def test_neighbours_are_exact(spark, unbalanced, cell_rows):
    points = (
        unbalanced.filter("label = 1")
        .select(vector_to_array("features").alias("x"))
        .withColumn("pid", smote._pid("x"))
        .groupBy("pid", "x")
        .agg(F.count("*").alias("m"))
    )
    got = smote.nearest(points, 5, scratch_dir(spark, "near"), cell_rows).toPandas()
    assert len(got) == 601
    expected = distances(np.stack(got["x"].to_numpy()))[:, :5]
    assert np.array([[n["d"] for n in near] for near in got["near"]]) == pytest.approx(expected)


def test_oversample_target_and_segments(unbalanced):
    out = smote.oversample(unbalanced, cell_rows=64)
    counts = {(r["label"], r["synthetic"]): r["count"] for r in out.groupBy("label", "synthetic").count().collect()}
    assert counts == {(0, False): 3000, (1, False): 900, (1, True): int(0.7 * 3000) - 900}
    # every synthetic point lies on a segment to one of the five nearest rows
    x = minority()
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    np.fill_diagonal(d, np.inf)
    reach = np.sort(d, axis=1)[:, 4]
    made = out.filter("synthetic").select(vector_to_array("features").alias("v")).toPandas()
    starts, ends = np.nonzero(d <= reach[:, None] * (1 + 1e-12))
    side = x[ends] - x[starts]
    length = np.maximum((side**2).sum(axis=1), 1e-300)
    for v in np.stack(made["v"].to_numpy())[::10]:
        t = np.clip(((v - x[starts]) * side).sum(axis=1) / length, 0, 1)
        gap = np.sqrt(((x[starts] + t[:, None] * side - v) ** 2).sum(axis=1)).min()
        assert gap < 1e-6


def test_oversample_leaves_balanced_data_alone(unbalanced):
    balanced = unbalanced.filter("label = 1 OR tx_id < 1500")
    out = smote.oversample(balanced)
    assert out.count() == balanced.count() and out.filter("synthetic").count() == 0


def test_oversample_needs_more_rows_than_neighbours(unbalanced):
    with pytest.raises(ValueError):
        smote.oversample(unbalanced.filter("label = 0 OR tx_id < 4"))


def tree(spark, x, folder, cell_rows):
    rows = spark.createDataFrame([(v.tolist(), 1) for v in x], "x array<double>, m long")
    points = rows.withColumn("pid", smote._pid("x"))
    return points, smote.split_cells(points, folder, cell_rows)


def test_cells_stay_small_where_most_stand_at_the_maximum(spark, tmp_path):
    rng = np.random.default_rng(3)
    x = np.column_stack([np.where(rng.random(2000) < 0.7, 999999.0, 5.0), rng.random(2000)])
    _, cells = tree(spark, x, str(tmp_path), 64)
    sizes = [r["count"] for r in cells.groupBy("cell").count().collect()]
    assert sum(sizes) == 2000 and max(sizes) <= 64


def test_cells_stay_small_where_every_axis_has_one_common_value(spark, tmp_path):
    x, n = np.full((30, 3), 7.0), np.arange(30)
    x[n, n % 3] = n // 3 + np.where(n % 2, 8, -8.5)
    points, cells = tree(spark, np.unique(x, axis=0), str(tmp_path / "a"), 12)
    assert max(r["count"] for r in cells.groupBy("cell").count().collect()) <= 12
    got = smote.nearest(points, 3, str(tmp_path / "b"), 12).toPandas()
    expected = distances(np.stack(got["x"].to_numpy()))[:, :3]
    assert np.array([[n["d"] for n in near] for near in got["near"]]) == pytest.approx(expected)


def test_the_driver_gets_few_rows_however_many_vectors(spark, tmp_path, monkeypatch):
    """A level brings one row, and the descent two more: none of them a vector or a box."""
    rng = np.random.default_rng(4)
    brought = []
    frame = type(spark.range(1))
    for name in ("collect", "toPandas", "first", "head", "take", "isEmpty"):
        real = getattr(frame, name)

        def counted(self, *args, real=real, **named):
            out = real(self, *args, **named)
            brought.append(len(out) if isinstance(out, (list,)) or hasattr(out, "columns") else 1)
            return out

        monkeypatch.setattr(frame, name, counted)
    x = rng.random((600, 2))
    rows = spark.createDataFrame([(v.tolist(), 1) for v in x], "x array<double>, m long")
    points = rows.withColumn("pid", smote._pid("x"))
    smote.nearest(points, 5, str(tmp_path), 32)
    assert spark.read.parquet(f"{tmp_path}/cells").select("cell").distinct().count() > 18
    # calls nest, so each row may be counted several times
    assert sum(brought) < 100 and max(brought) <= 2


def test_no_vectors(spark, tmp_path):
    points, cells = tree(spark, np.empty((0, 2)), str(tmp_path / "a"), 8)
    assert cells.count() == 0 and smote.nearest(points, 2, str(tmp_path / "b"), 8).count() == 0


def test_trace_names_the_base_and_its_reach(unbalanced):
    out = smote.oversample(unbalanced, cell_rows=64, trace=True)
    assert out.filter("NOT synthetic AND (base IS NOT NULL OR reach IS NOT NULL)").count() == 0
    x = minority()
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    np.fill_diagonal(d, np.inf)
    made = out.filter("synthetic").select("base", "reach", vector_to_array("features").alias("v"))
    for r in made.collect():
        assert r["reach"] == pytest.approx(np.sort(d[r["base"]])[4])
        assert np.sqrt(((x[r["base"]] - r["v"]) ** 2).sum()) <= r["reach"] * (1 + 1e-12)
