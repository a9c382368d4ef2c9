"""Boosted trees fitted in one go, against Spark's own."""

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from riskloom.plans import boosting, training


@pytest.fixture(scope="module")
def parts(spark):
    """``(train, dev)`` on at most 32 distinct values a feature, some rows of weight 3."""
    draw = np.random.default_rng(8)
    n = 3000
    x = np.column_stack(
        [draw.integers(0, 9, n), draw.integers(0, 20, n), draw.normal(size=n).round(1).clip(-1.5, 1.5)]
    )
    z = x[:, 0] - 4 + 0.3 * (x[:, 1] > 10) * x[:, 2] + 4 * draw.normal(size=n)
    data = [
        (v.tolist(), int(y > 0), 1.0 + 2 * (i % 7 == 0), i % 4 == 0)
        for i, (v, y) in enumerate(zip(x, z))
    ]
    rows = spark.createDataFrame(data, "a array<double>, label int, weight double, dev boolean")
    rows = rows.select(array_to_vector("a").alias("features"), "label", "weight", "dev")
    return rows.filter("NOT dev"), rows.filter("dev")


@pytest.mark.parametrize("tasks", [1, 3])
def test_the_trees_are_those_of_spark(monkeypatch, parts, tasks):
    train, dev = parts
    monkeypatch.setattr(boosting, "_tasks", lambda *_: tasks)
    params = {"stepSize": 0.3, "minInstancesPerNode": 5, "minInfoGain": 0.001}
    model, losses = boosting.fit(training.booster(30, 4, params=params), train, dev, 4)
    kept, ended = training.rounds_to_keep(losses, 4)
    # patience ends the fit, to the round
    assert ended and model.getNumTrees == kept and len(losses) == kept + 4
    theirs = training.booster(len(losses), 4, params=params).fit(train)
    assert list(theirs.evaluateEachIteration(dev)) == pytest.approx(losses, abs=1e-12)
    assert list(model.evaluateEachIteration(dev)) == pytest.approx(losses[:kept], abs=1e-12)
    first = training.first_trees(theirs, kept)
    assert model.featureImportances.toArray() == pytest.approx(first.featureImportances.toArray())
    assert model.treeWeights == first.treeWeights
    assert [t.numNodes for t in model.trees] == [t.numNodes for t in first.trees]
    both = [m.transform(dev).select("rawPrediction").collect() for m in (model, first)]
    assert np.allclose(*[[r[0][1] for r in side] for side in both], atol=1e-12)


def test_the_model_is_stored_with_the_parameters_of_the_fit(parts, tmp_path):
    train, dev = parts
    estimator = training.booster(3, 2, params={"stepSize": 0.2, "subsamplingRate": 0.5})
    model, losses = boosting.fit(estimator, train, dev, 30)
    assert len(losses) == 3
    training.save_model(model, f"{tmp_path}/model")
    again = GBTClassificationModel.load(f"{tmp_path}/model")
    assert (again.getMaxIter(), again.getMaxDepth(), again.getStepSize()) == (3, 2, 0.2)
    assert again.getSubsamplingRate() == 0.5 and again.numFeatures == 3
    # half of the rows or so are behind a tree
    stats = [t._call_java("rootNode").impurityStats().rawCount() for t in again.trees]
    assert all(0.4 < n / train.count() < 0.6 for n in stats) and len(set(stats)) > 1


def test_trees_are_fitted_once(spark, tmp_path, monkeypatch):
    """70 rounds were 60 and then 70; the fit that is left lends its form to the model."""
    fits, plain = [], GBTClassifier._fit
    monkeypatch.setattr(
        GBTClassifier, "_fit", lambda self, rows: fits.append(self.getMaxIter()) or plain(self, rows)
    )
    draw = np.random.default_rng(2)
    numbers = training.encode.TREE_NUMERIC
    x = draw.normal(size=(1500, len(numbers)))
    label = (x[:, 0] + x[:, 1] * x[:, 2] + 0.1 * draw.normal(size=len(x)) > 0).astype(int)
    data = [(i, *v.tolist(), "ab"[i % 2], "x", "y", int(y)) for i, (v, y) in enumerate(zip(x, label))]
    columns = [f"{c} double" for c in numbers] + ["tx_type string", "account_type string", "country string"]
    rows = spark.createDataFrame(data, f"tx_id long, {', '.join(columns)}, label int")
    training.train_trees(spark, rows, str(tmp_path), rounds=70, depth=2, resample=False).collect()
    losses = spark.read.parquet(f"{tmp_path}/dev_losses").orderBy("round").collect()
    assert len(losses) > 60 and losses[-1]["loss"] < losses[0]["loss"]
    assert sum(fits) <= 1
    trees = training.load_pipeline(f"{tmp_path}/model").stages[-1]
    kept, _ = training.rounds_to_keep([r["loss"] for r in losses], training.PATIENCE)
    assert trees.getNumTrees == kept


def test_cuts_see_every_row(spark):
    n = 20_000
    x = F.col("id").cast("double")
    columns = [
        F.when(F.col("id") == 5, 7.0).otherwise(F.col("id") % 3),  # one row holds a value
        F.when(F.col("id") < 15_000, 0.0).otherwise(x),  # most rows hold one
        x,
        F.lit(1.0),
        F.when(F.col("id") % 2 == 0, float("nan")).otherwise(F.col("id") % 4),
        F.lit(float("nan")),
    ]
    rows = spark.range(n).select(array_to_vector(F.array(*columns)).alias("features"))
    few, heavy, even, constant, gaps, none = boosting.cut_points(rows, 8)
    assert few.tolist() == [0.5, 1.5, 4.5] and gaps.tolist() == [2.0]
    assert len(constant) == len(none) == 0
    assert 0 < heavy[0] < 15_100 and len(heavy) <= 7
    assert np.abs(even - n / 8 * np.arange(1, 8)).max() < n / 200
    with pytest.raises(ValueError):
        boosting.cut_points(rows.limit(0), 8)


def test_bins_as_spark_chooses_them():
    values, counts = np.arange(6.0), np.array([10, 1, 1, 1, 1, 10.0])
    assert boosting._between(values, counts, 6).tolist() == [0.5, 1.5, 2.5, 3.5, 4.5]
    # goals at 8, 16 and 24 of 24 rows
    assert boosting._between(values, counts, 3).tolist() == [0.5, 4.5]
    ends = boosting._between(np.array([-np.inf, np.inf]), np.ones(2), 8)
    assert ends.tolist() == [-np.inf]


def test_only_sessions_with_shared_files_and_fixed_executors(spark, monkeypatch):
    assert boosting.possible(spark)
    for folder, fits in (("file:/kept/told", True), ("hdfs://somewhere/told", False)):
        monkeypatch.setattr(boosting, "scratch_dir", lambda *_, folder=folder: folder)
        assert boosting.possible(spark) == fits
