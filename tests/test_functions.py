"""Column functions at their edges."""

import math

import pytest
from pyspark.sql import functions as F

from riskloom import functions as fn


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def values(spark, data, dtype, column):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(data)], f"i int, x {dtype}")
    return [r["v"] for r in df.orderBy("i").select(column.alias("v")).collect()]


def test_log1p_domain(spark):
    assert values(spark, [-1.0, -5.0, 0.0, math.e - 1], "double", fn.log1p("x")) == [
        None,
        None,
        0.0,
        pytest.approx(1.0),
    ]


def test_cyclic_time(spark):
    times = [0, 21600, 43200, 64800, 86400 * 3 + 21600, -64800]
    sin = values(spark, times, "long", fn.time_sin("x"))
    cos = values(spark, times, "long", fn.time_cos("x"))
    assert sin == pytest.approx([0, 1, 0, -1, 1, 1], abs=1e-12)
    assert cos == pytest.approx([1, 0, -1, 0, 0, 0], abs=1e-12)


def test_spline_sums_to_one_and_continues_straight(spark):
    low, high = 2.0, 7.0
    xs = [low + i / 7 for i in range(-20, 60)]
    df = spark.createDataFrame([(float(x),) for x in xs], "x double")
    table = fn.add_spline_basis(df, "x", low, high).collect()
    for row in table:
        assert sum(row[1:]) == pytest.approx(1.0)
        if low <= row["x"] <= high:
            assert min(row[1:]) >= 0
    # second differences vanish outside the edge knots
    beyond = [r for r in table if r["x"] > high + 1e-9]
    for a, b, c in zip(beyond, beyond[1:], beyond[2:]):
        assert [a[j] - 2 * b[j] + c[j] for j in range(1, 9)] == pytest.approx([0] * 8, abs=1e-9)


def test_spline_is_smooth_at_the_edges(spark):
    h = 1e-4
    df = spark.createDataFrame([(x,) for x in (-h, 0.0, h, 1 - h, 1.0, 1 + h)], "x double")
    t = fn.add_spline_basis(df, "x", 0.0, 1.0).orderBy("x").drop("x").collect()
    for j in range(8):
        assert t[2][j] - t[1][j] == pytest.approx(t[1][j] - t[0][j], abs=1e-5)
        assert t[5][j] - t[4][j] == pytest.approx(t[4][j] - t[3][j], abs=1e-5)


def test_ids_are_uuid_shaped_and_repeatable(spark):
    first = one(spark, fn.uuid_from(F.lit("alert"), F.lit(5)))
    assert first == one(spark, fn.uuid_from(F.lit("alert"), F.lit(5)))
    assert first != one(spark, fn.uuid_from(F.lit("alert"), F.lit(6)))
    assert [len(p) for p in first.split("-")] == [8, 4, 4, 4, 12]


def test_hash_fraction_is_uniform(spark):
    df = spark.range(20000).select(fn.hash_fraction("id", 7).alias("v"))
    low, high, mean = df.agg(F.min("v"), F.max("v"), F.avg("v")).first()
    assert 0 <= low and high < 1 and mean == pytest.approx(0.5, abs=0.01)


def test_uuid_shape(spark):
    good = "0d5a7ba2-11f0-4c5b-9d5a-0a1b2c3d4e5f"
    assert values(spark, [good, good[:-1], "x", None], "string", fn.as_uuid("x")) == [
        good,
        None,
        None,
        None,
    ]
