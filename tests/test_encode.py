"""Dictionaries and encoders."""

import pytest
from conftest import rows
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskloom.operators import encode


@pytest.fixture
def train(spark):
    data = [(1, "x", 2), (2, "y", 10), (3, "y", 2), (4, "z", 2), (5, "z", None), (6, None, 10)]
    return spark.createDataFrame(data, "tx_id long, c string, n int")


def test_counts_ignore_null(train):
    got = rows(encode.value_counts(train, "c"))
    assert [(r["c"], r["n"]) for r in got] == [("x", 1), ("y", 2), ("z", 2)]


def test_top_values_and_other(train):
    top = encode.top_values(train, "c", 2)
    assert [r["c"] for r in top.collect()] == ["y", "z"]
    kept = rows(encode.keep_top(train, "c", top, "b"), "tx_id")
    assert [r["b"] for r in kept] == ["OTHER", "y", "y", "z", "z", "OTHER"]


def test_index_sorts_numbers_as_numbers(train):
    got = rows(encode.category_index(train, ["c", "n"]), "feature", "idx")
    assert [(r["feature"], r["value"], r["idx"]) for r in got] == [
        ("c", "x", 0),
        ("c", "y", 1),
        ("c", "z", 2),
        ("n", "2", 0),
        ("n", "10", 1),
    ]


def test_frequency_index_ties_unseen_and_null(spark, train):
    fitted = encode.frequency_indexer(["c"]).fit(train)
    new = spark.createDataFrame([("x",), ("y",), ("z",), ("new",), (None,)], "c string")
    got = {r["c"]: r["c_idx"] for r in fitted.transform(new).collect()}
    assert got == {"y": 0.0, "z": 1.0, "x": 2.0, "new": 3.0, None: 3.0}


def test_onehot_of_unseen_and_null_is_zero(spark, train):
    fitted = Pipeline(stages=encode.onehot_stages(["c"])).fit(train.filter("c IS NOT NULL"))
    new = spark.createDataFrame([(1, "y"), (2, "new"), (3, None)], "tx_id long, c string")
    out = fitted.transform(new)
    dense = {r["tx_id"]: r["v"] for r in out.select("tx_id", vector_to_array("c_hot").alias("v")).collect()}
    assert dense == {1: [0.0, 1.0, 0.0], 2: [0.0] * 3, 3: [0.0] * 3}
    assert [(r["tx_id"], r["idx"]) for r in rows(encode.onehot_long(out, ["c"]))] == [(1, 1)]


def test_slot_order_and_names(spark):
    data = [(float(i), "a" if i % 2 else "b") for i in range(4)]
    df = spark.createDataFrame(data, "n double, c string")
    out = encode.tree_pipeline(["n"], ["c"]).fit(df).transform(df)
    assert encode.feature_names(out) == ["n", "c_idx"]
    first = out.orderBy("n").select(vector_to_array("features").alias("v")).first()["v"]
    assert first == [0.0, 1.0]
    assert out.filter(F.col("features").isNull()).count() == 0
