"""Metrics and thresholds against direct computation."""

import random

import pytest
from conftest import rows

from riskloom.operators import evaluate


def frame(spark, pairs):
    return spark.createDataFrame(pairs, "score double, label int")


def decided(spark, pairs):
    return spark.createDataFrame(pairs, "label int, is_fraud boolean")


def test_metrics_without_positives(spark):
    counts = evaluate.confusion(decided(spark, [(0, False), (0, False)]))
    metrics = evaluate.class_metrics(counts).first()
    assert (metrics["precision"], metrics["recall"], metrics["f1_fraud"]) == (0.0, 0.0, 0.0)
    assert metrics["accuracy"] == 1.0
    assert evaluate.auc_hard(counts).first()["auc"] == 0.5


def test_report_agrees_with_its_parts(spark):
    data = [(1, True)] * 6 + [(0, True)] * 2 + [(1, False)] * 3 + [(0, False)] * 9
    report = evaluate.evaluation_report(decided(spark, data)).first()
    assert (report["tp"], report["fp"], report["fn"], report["tn"]) == (6, 2, 3, 9)
    assert report["precision"] == pytest.approx(6 / 8)
    assert report["recall"] == pytest.approx(6 / 9)
    assert report["f1_fraud"] == pytest.approx(12 / 17)
    assert report["auc"] == pytest.approx((6 / 9 + 9 / 11) / 2)


def curve(pairs):
    out = []
    for t in sorted({s for s, _ in pairs}):
        tp = sum(1 for s, y in pairs if s >= t and y == 1)
        fp = sum(1 for s, y in pairs if s >= t and y == 0)
        out.append((t, tp, fp))
    return out


@pytest.mark.parametrize("partitions", ["2", "7", "40"])
def test_cumulative_counts(spark, partitions):
    """A third of the rows share one score; the rest crowd near zero."""
    draw = random.Random(5)
    pairs = [
        (0.25 if i % 3 == 0 else draw.random() ** 6, int(draw.random() < 0.2)) for i in range(900)
    ]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = rows(evaluate.cumulative_counts(frame(spark, pairs)), "threshold")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert [(r["threshold"], r["tp"], r["fp"]) for r in got] == curve(pairs)
    assert {r["positives"] for r in got} == {sum(y for _, y in pairs)}


def cost_by_hand(pairs, free):
    p = sum(y for _, y in pairs)
    best = None
    for t, tp, fp in curve(pairs):
        cost = p - tp if free and tp == 0 else 3 * fp + p - tp
        if best is None or cost < best[0]:
            best = (cost, t)
    return best


@pytest.mark.parametrize("free", [True, False])
@pytest.mark.parametrize("seed", range(3))
def test_cost_threshold(spark, free, seed):
    draw = random.Random(seed)
    pairs = [(round(draw.random(), 2), int(draw.random() < 0.3)) for _ in range(200)]
    row = evaluate.cost_threshold(frame(spark, pairs), free_without_hits=free).first()
    assert (row["cost"], row["threshold"]) == cost_by_hand(pairs, free)


def test_cost_when_the_top_score_is_a_false_alarm(spark):
    pairs = [(0.9, 0), (0.8, 0), (0.7, 1)]
    free = evaluate.cost_threshold(frame(spark, pairs)).first()
    plain = evaluate.cost_threshold(frame(spark, pairs), free_without_hits=False).first()
    assert (free["threshold"], free["cost"]) == (0.8, 1)
    assert (plain["threshold"], plain["cost"]) == (0.9, 4)


def test_curve_scans_the_rows_once_and_sums_by_partition(spark, tmp_path):
    draw = random.Random(9)
    # a third of the rows have one score; labels and scores may be missing
    pairs = [
        (0.5 if i % 3 == 0 else draw.choice([None, draw.random()]), draw.choice([0, 0, 1, None]))
        for i in range(3000)
    ]
    frame(spark, pairs).repartition(6).write.parquet(f"{tmp_path}/in")
    df = spark.read.parquet(f"{tmp_path}/in")
    curve = evaluate.cumulative_counts(df)
    plan = curve._jdf.queryExecution().executedPlan().toString()
    assert f"{tmp_path}/in" not in plan and "scores-" in plan
    got = {r["threshold"]: (r["tp"], r["fp"], r["positives"]) for r in curve.collect()}
    positives = sum(y == 1 for _, y in pairs)
    scores = {s for s, _ in pairs if s is not None}
    assert set(got) == scores
    for t in sorted(scores)[::50] + [0.5]:
        above = [y for s, y in pairs if s is not None and s >= t]
        assert got[t] == (above.count(1), above.count(0), positives)


def test_curve_where_only_unlabelled_rows_are_reached(spark):
    got = rows(evaluate.pr_curve(frame(spark, [(0.9, None), (0.4, 1)])), "threshold")
    assert [(r["threshold"], r["precision"]) for r in got] == [(0.4, 1.0), (0.9, 0.0)]


def test_cost_of_nothing(spark):
    assert evaluate.cost_threshold(frame(spark, [])).first() is None


def f1_by_hand(pairs):
    step = (0.95 - 0.05) / 199
    grid = [0.05 + i * step for i in range(199)] + [0.95]
    best, chosen = 0, 0.5
    for t in grid:
        tp = sum(1 for s, y in pairs if s > t and y == 1)
        flagged = sum(1 for s, _ in pairs if s > t)
        p = sum(y for _, y in pairs)
        f1 = 2 * tp / (p + flagged) if p + flagged else 0
        if f1 > best:
            best, chosen = f1, t
    return chosen, best


@pytest.mark.parametrize("seed", range(3))
def test_f1_threshold(spark, seed):
    draw = random.Random(seed)
    pairs = [(draw.random(), int(draw.random() < 0.3)) for _ in range(300)]
    # scores equal to a grid value are not above it
    pairs += [(0.05, 1), (0.95, 0), (0.05 + 7 * ((0.95 - 0.05) / 199), 1)]
    row = evaluate.f1_threshold(frame(spark, pairs)).first()
    assert (row["threshold"], row["f1"]) == pytest.approx(f1_by_hand(pairs))


def test_f1_default_without_hits(spark):
    row = evaluate.f1_threshold(frame(spark, [(0.9, 0), (0.01, 1)])).first()
    assert (row["threshold"], row["f1"]) == (0.5, 0.0)


def test_curve_without_positives(spark):
    got = rows(evaluate.pr_curve(frame(spark, [(0.2, 0), (0.4, 0)])), "threshold")
    assert [(r["precision"], r["recall"]) for r in got] == [(0.0, 1.0), (0.0, 1.0)]


def test_rows_without_score_label_or_decision_are_counted(spark):
    df = spark.createDataFrame(
        [(1, True, 0.9), (None, True, 0.8), (1, None, None), (0, False, 0.1), (0, None, 0.2)],
        "label int, is_fraud boolean, score double",
    )
    counts = evaluate.confusion(df).first()
    assert sum(counts) == 5 and counts["unjudged"] == 3
    curve = {r["threshold"]: r for r in evaluate.cumulative_counts(df).collect()}
    assert curve[0.1]["tp"] == 1 and curve[0.1]["positives"] == 2
    assert evaluate.cost_threshold(df).first()["cost"] == 1
    assert evaluate.f1_threshold(df).first()["f1"] == pytest.approx(2 / 3)
