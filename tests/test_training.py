"""Fitted models: quality, persistence, policies."""

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from riskloom import fixtures as fx
from riskloom.operators import score
from riskloom.plans import gam, search, training


@pytest.fixture(scope="module")
def fitted_gam(spark, sf_dir, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("gam"))
    tx, accounts = fx.transactions(spark, sf_dir), fx.accounts(spark, sf_dir)
    report = training.train_gam(spark, tx, accounts, out, iterations=50).first()
    return out, report


def test_gam_is_better_than_chance(spark, fitted_gam):
    out, report = fitted_gam
    assert training.rank_auc(spark.read.parquet(f"{out}/scored")) > 0.6
    assert report["tp"] + report["fn"] > 0
    assert training.load_threshold(spark, f"{out}/threshold") == report["threshold"]
    known = spark.read.parquet(f"{out}/categories")
    assert {"country", "tx_type"} <= {r["feature"] for r in known.select("feature").collect()}


def test_saved_gam_scores_alike_and_takes_unseen_categories(spark, sf_dir, fitted_gam):
    out, _ = fitted_gam
    model = training.load_pipeline(f"{out}/model")
    stored = spark.read.parquet(f"{out}/scored")
    val = spark.read.parquet(f"{out}/rows").filter("split = 'val'")
    again = score.score_model(val, model).select("tx_id", F.col("score").alias("again"))
    assert stored.join(again, "tx_id").filter("abs(score - again) > 1e-12").count() == 0
    strange = val.limit(5).withColumns(
        {"country": F.lit("ATLANTIS"), "tx_type": F.lit("new"), "tx_amount_log": F.lit(50.0)}
    )
    assert score.score_model(strange, model).filter("score BETWEEN 0 AND 1").count() == 5


def test_gam_is_fitted_on_all_training_rows(spark, tmp_path, monkeypatch):
    """A cap of 50 rows stands for one that only large tables reach."""
    take = training.sampling.subsample
    monkeypatch.setattr(training.sampling, "subsample", lambda df, *_: take(df, 50))
    draw = np.random.default_rng(4)
    data = [
        (i, i % 40, 1, "ab"[i % 2], float(v), 1_700_000_000 + 977 * i, bool(v > 80 or i % 9 == 0))
        for i, v in enumerate(draw.uniform(1, 100, 400))
    ]
    tx = spark.createDataFrame(
        data,
        "tx_id long, sender_account_id int, receiver_account_id int, tx_type string, "
        "tx_amount double, ts long, is_fraud boolean",
    )
    accounts = spark.createDataFrame(
        [(i, f"c{i}", 100.0 + 7 * i, "XYZ"[i % 3], "ST"[i % 2], None, i % 4) for i in range(40)],
        "account_id int, customer_id string, init_balance double, country string, "
        "account_type string, is_fraud boolean, tx_behavior_id int",
    )
    training.train_gam(spark, tx, accounts, f"{tmp_path}/whole", iterations=20).collect()
    known = {r["tx_id"] for r in spark.read.parquet(f"{tmp_path}/whole/rows/split=train").collect()}
    for part in ("train", "features"):
        used = spark.read.parquet(f"{tmp_path}/whole/{part}").collect()
        assert len(used) == len(known) > 250 and {r["tx_id"] for r in used} == known
    # a cap holds where it is asked for
    training.train_gam(spark, tx, accounts, f"{tmp_path}/cut", 50, 20).collect()
    assert spark.read.parquet(f"{tmp_path}/cut/train").count() < 200


def test_trees(spark, sf_dir, tmp_path):
    usable, rejected = training.tree_rows(
        fx.predictions(spark, sf_dir).drop("label"),
        fx.labelled_with_copies(spark, sf_dir),
        fx.accounts(spark, sf_dir),
    )
    assert rejected.count() > 0
    out = str(tmp_path)
    report = training.train_trees(spark, usable, out, rounds=5, depth=4).first()
    assert report["accuracy"] > 0.8
    model = training.load_pipeline(f"{out}/model")
    scored = score.score_model(usable.withColumnRenamed("label", "y"), model, "fraud_probability")
    frame = scored.select(F.col("fraud_probability").alias("score"), F.col("y").alias("label"))
    assert training.rank_auc(frame) > 0.8
    # the stored model serves the batch job as it is
    from functools import partial

    from riskloom.operators import facts
    from riskloom.plans import jobs
    from riskloom.queries import _decided
    from riskloom.sinks import writers

    writers.write_scored_json(facts.scored_payload(_decided(spark, sf_dir)), f"{out}/json")
    scorer = partial(score.score_model, model=model, output="fraud_probability")
    jobs.batch_scoring(spark, f"{out}/json", fx.accounts(spark, sf_dir), scorer, out)
    stored = spark.read.parquet(f"{out}/batch_layer/transactions")
    assert stored.count() > 800 and stored.filter("is_fraud").count() > 0

    features = spark.read.parquet(f"{out}/features")
    assert set(features.columns) == {"tx_id", "features", "label", "weight", "split"}
    # copies of a labelled transaction weigh as many rows
    assert {r["weight"] for r in features.select("weight").distinct().collect()} == {1.0, 3.0}


def test_weights_move_the_model_towards_the_positives(spark):
    data = [(float(i % 10), int(i % 10 >= 8 and i % 3 == 0)) for i in range(600)]
    df = spark.createDataFrame(data, "x double, label int")
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    from riskloom.operators.sampling import sample_weights

    rows = VectorAssembler(inputCols=["x"], outputCol="features").transform(sample_weights(df))
    plain = LogisticRegression().fit(rows)
    weighted = LogisticRegression(weightCol="weight").fit(rows)
    mean = [m.transform(rows).filter("prediction = 1").count() for m in (plain, weighted)]
    assert mean[1] > mean[0]


def test_search_draws_and_reuses_its_result(spark, sf_dir, tmp_path):
    assert len(search.draw_params(40, 1)) == 40
    assert search.draw_params(5, 1) == search.draw_params(5, 1) != search.draw_params(5, 2)
    assert search.draw_params(3, 1) == search.draw_params(9, 1)[:3]
    rows = fx.model_rows(spark, sf_dir)
    from riskloom.operators.encode import tree_pipeline

    features = tree_pipeline().fit(rows).transform(rows).select("tx_id", "features", "label")
    grid = {**{k: v[-1:] for k, v in search.SEARCH_GRID.items()}, "stepSize": [0.5, 1.0], "maxDepth": [2]}
    grid["minInstancesPerNode"], grid["minInfoGain"] = [1], [0.0]
    first = training.search(features, 2, 2, grid=grid, save_to=str(tmp_path)).collect()
    again = training.search(features, 2, 2, grid=grid, save_to=str(tmp_path)).collect()
    assert first == again and len(first) == 2
    assert first[0]["f1"] >= first[1]["f1"]
    assert all(r["n_trees"] == 6 and sum(r["fold_rows"]) == features.count() for r in first)
    stored = training.GBTClassificationModel.load(f"{tmp_path}/best")
    assert stored.getMaxDepth() == 2 and stored.getStepSize() == first[0]["stepSize"]
    # the winner goes into the final fit
    best = training.best_params(spark.createDataFrame(first), grid)
    assert best == {name: first[0][name] for name in grid}
    out = f"{tmp_path}/final"
    training.train_trees(spark, rows, out, rounds=2, resample=False, params=best)
    trees = training.load_pipeline(f"{out}/model").stages[-1]
    assert trees.getStepSize() == best["stepSize"] and trees.getMaxDepth() == 2


@pytest.mark.parametrize(
    "params",
    [
        {"stepSize": 0.5, "maxDepth": 3, "minInfoGain": 0.0, "minInstancesPerNode": 1},
        {"stepSize": 0.1, "maxDepth": 6, "minInfoGain": 0.05, "minInstancesPerNode": 10},
    ],
)
def test_trials_grow_the_trees_that_spark_grows(spark, params):
    """On few distinct values, where both cut between the same ones."""
    draw = np.random.default_rng(5)
    codes = draw.integers(0, 9, (600, 4))
    z = codes[:, 0] * 0.5 - codes[:, 1] * 0.3 + (codes[:, 2] > 4) * codes[:, 3] * 0.4
    label = (z - 1.5 + draw.normal(0, 1, 600) > 0).astype(int)
    data = [(i, [float(v) for v in c], int(y)) for i, (c, y) in enumerate(zip(codes, label))]
    rows = spark.createDataFrame(data, "tx_id long, a array<double>, label int")
    rows = rows.select("tx_id", array_to_vector("a").alias("features"), "label").coalesce(1)
    model = GBTClassifier(maxIter=6, seed=1, **params).fit(rows)
    theirs = model.transform(rows).orderBy("tx_id").select("rawPrediction").collect()
    mine = search.boost(codes, label, 6, {**params, "subsamplingRate": 1.0}, 1)
    assert np.allclose(search.margins(mine, codes), [r[0][1] for r in theirs], atol=1e-9)


def test_shared_matrix(spark):
    data = [(i, [float(i % 7), float(i)], i % 2) for i in range(500)]
    rows = spark.createDataFrame(data, "tx_id long, a array<double>, label int")
    rows = rows.select("tx_id", array_to_vector("a").alias("features"), "label")
    got = search.binned(rows, 300, 3).orderBy("tx_id").collect()
    assert len(got) == 300 and {r["fold"] for r in got} == {0, 1, 2}
    assert all(r["codes"][0] == r["tx_id"] % 7 for r in got)
    codes = [r["codes"][1] for r in got]
    assert codes == sorted(codes) and 25 <= max(codes) < search.BINS
    assert search.binned(rows.limit(0), 300, 3).count() == 0
    none = search.run_trials(rows.limit(0), search.draw_params(2, 1), 3, 1).collect()
    assert len(none) == 6 and all(r["f1"] == 0 and r["n_trees"] == 0 for r in none)


def test_patience_outlasts_a_dip():
    keep = training.rounds_to_keep
    # worse for two rounds, then better than before
    assert keep([5, 4, 4.5, 4.2, 3, 3.5, 3.2], 3) == (5, False)
    assert keep([5, 4, 4.5, 4.2, 3, 3.5, 3.2], 2) == (2, True)
    assert keep([5, 4, 4, 4, 3.9], 2) == (2, True)
    assert keep([5, 4, 4, 4, 3.9], 3) == (5, False)
    assert keep([1.0], 30) == (1, False)


def test_fit_with_patience_keeps_the_best_rounds(spark):
    draw = np.random.default_rng(8)
    x = draw.normal(size=(600, 3))
    label = ((x[:, 0] + 0.8 * draw.normal(size=600)) > 0).astype(int)
    data = [(v.tolist(), int(y), 1.0, i % 3 == 0) for i, (v, y) in enumerate(zip(x, label))]
    rows = spark.createDataFrame(data, "a array<double>, label int, weight double, dev boolean")
    rows = rows.select(array_to_vector("a").alias("features"), "label", "weight", "dev")
    train, dev = rows.filter("NOT dev"), rows.filter("dev")
    model, losses = training.fit_with_patience(train, dev, 40, 3, {"stepSize": 0.5}, patience=4)
    kept, ended = training.rounds_to_keep(losses, 4)
    assert ended and model.getNumTrees == kept < len(losses)
    # the rounds kept are the first of the longer fit, and score like them
    whole = training.booster(len(losses), 3, params={"stepSize": 0.5}).fit(train)
    assert list(model.evaluateEachIteration(dev)) == pytest.approx(losses[:kept])
    assert list(whole.evaluateEachIteration(dev)) == pytest.approx(losses)
    assert model.transform(dev).filter("probability IS NULL").count() == 0
    short, _ = training.fit_with_patience(train, dev, 3, 3, patience=4)
    assert short.getNumTrees <= 3


def test_no_fit_is_repeated_for_a_few_more_rounds(monkeypatch):
    fits = []

    class Fit:
        def __init__(self, n, ends):
            self.losses = [1 / (1 + min(i, ends)) for i in range(n)]

        def fit(self, train):
            return self

        def evaluateEachIteration(self, dev):
            return self.losses

    def fitted(best, rounds):
        def booster(n, depth, params=None):
            fits.append(n)
            return Fit(n, best - 1)

        monkeypatch.setattr(training, "booster", booster)
        monkeypatch.setattr(training, "first_trees", lambda model, n: n)
        fits.clear()
        kept, losses = training.fit_with_patience(None, None, rounds, 8, patience=30)
        return kept, len(losses), list(fits)

    # patience lasts: 920 rounds for 500, no 480 before them
    assert fitted(500, 500) == (500, 500, [60, 120, 240, 500])
    assert fitted(20, 500) == (20, 60, [60])
    assert fitted(80, 500) == (80, 120, [60, 120])
    assert fitted(300, 500) == (300, 500, [60, 120, 240, 500])
    assert fitted(70, 70) == (70, 70, [60, 70])
    assert fitted(9, 9) == (9, 9, [9])


def test_external_model_in_arrow_batches(spark):
    df = spark.createDataFrame([(i, float(i), 1.0) for i in range(10)], "tx_id long, a double, b double")
    out = score.score_external(df, lambda m: 1 / (1 + np.exp(-(m[:, 0] - m[:, 1]))), ["a", "b"])
    got = {r["tx_id"]: r["score"] for r in out.collect()}
    assert got[1] == pytest.approx(0.5) and got[9] == pytest.approx(1 / (1 + np.exp(-8)), rel=1e-6)


def test_policies_for_missing_inputs(spark):
    df = spark.createDataFrame([(1, 2.0, "x"), (2, None, "y"), (3, 1.0, None)], "tx_id long, n double, c string")
    usable, rejected = score.require(df, ["n", "c"])
    assert (usable.count(), rejected.count()) == (1, 2)
    filled, none = score.require(df, ["n", "c"], "impute")
    assert filled.filter("n IS NULL OR c IS NULL").count() == 0 and none.count() == 0
    assert filled.dtypes == df.dtypes
    strict, _ = score.require(df, ["n", "c"], "error")
    with pytest.raises(Exception, match="model input is NULL"):
        strict.collect()
    with pytest.raises(ValueError):
        score.require(df, ["n"], "guess")


def test_decisions_at_the_threshold(spark):
    df = spark.createDataFrame([(0.5,), (0.4999,), (0.5001,)], "score double")
    ge = [r["is_fraud"] for r in score.decide_ge(df, 0.5).collect()]
    gt = [r["is_fraud"] for r in score.decide_gt(df).collect()]
    assert ge == [True, False, True] and gt == [False, False, True]


def test_strict_model_on_a_batch_with_bad_events(spark, sf_dir, fitted_gam):
    """The assembler refuses NULL, yet bad events must not fail the batch."""
    from functools import partial

    from riskloom.operators.validate import parse_events
    from riskloom.schemas import GAM_NUMERIC
    from riskloom.streaming import speed

    out, _ = fitted_gam
    scorer = partial(score.score_model, model=training.load_pipeline(f"{out}/model"))
    parsed = parse_events(fx.event_json(spark, sf_dir))
    decided = speed.decide_events(parsed, fx.accounts(spark, sf_dir), scorer, 0.5, GAM_NUMERIC)
    counts = {r["reason"]: r["count"] for r in decided.groupBy("reason").count().collect()}
    assert sum(counts.values()) == 1000
    assert set(counts) == {None, "malformed", "bad_type", "missing_field", "no_account", "no_score"}
    assert decided.filter("reason IS NULL AND score IS NULL").count() == 0
    assert decided.filter("reason IS NOT NULL AND (score IS NOT NULL OR is_fraud)").count() == 0


@pytest.fixture(scope="module")
def wavy(spark):
    draw = np.random.default_rng(3)
    x = draw.random((900, 2))
    label = (draw.random(900) < 1 / (1 + np.exp(-3 * np.sin(6 * x[:, 0]) + x[:, 1]))).astype(int)
    data = [(*v.tolist(), int(y), 1.0 + i % 3) for i, (v, y) in enumerate(zip(x, label))]
    from riskloom.functions import add_spline_basis

    rows = spark.createDataFrame(data, "x double, z double, label int, weight double")
    rows = add_spline_basis(rows, "x", 0.0, 1.0).repartition(4)
    vector = array_to_vector(F.array(*[f"b{j}" for j in range(8)], "z")).alias("features")
    return rows.select(vector, "label", "weight")


def test_penalised_fit_is_the_maximum(spark, wavy):
    fit = gam.fit_penalised(wavy, [8])
    assert fit.converged and fit.rounds < 20
    frame = wavy.select(vector_to_array("features").alias("x"), "label", "weight").toPandas()
    x = np.column_stack([np.stack(frame["x"]), np.ones(len(frame))])
    y, w = frame["label"].to_numpy(), frame["weight"].to_numpy()
    p = gam.penalty(9, [8])

    def value(b):
        eta = x @ b
        return (w * (y * eta - np.logaddexp(0, eta))).sum() - b @ p @ b / 2

    best = np.append(fit.coefficients, fit.intercept)
    draw = np.random.default_rng(1)
    for size in (1e-3, 1e-1, 1.0):
        assert all(value(best + size * draw.normal(size=10)) < value(best) for _ in range(20))
    scored = score.score_model(wavy, gam.as_model(wavy, fit))
    slopes = [r["gradient"] for r in gam.score_equations(scored, fit, [8]).collect()]
    assert len(slopes) == 10 and np.abs(slopes).max() < 1e-5


def test_penalty_leaves_lines_alone_and_smooths_the_rest():
    p = gam.penalty(10, [4, 4], 2.0)
    line = np.array([1, 2, 3, 4, 9, 7, 5, 3, 0, 0, 5.0])
    assert line @ p @ line == pytest.approx(0)
    bent = np.array([0, 1, 0, 0, 0, 0, 0, 0, 0, 3, 0.0])
    # second differences of 0 1 0 0 are -2 and 1; the single coefficient counts squared
    assert bent @ p @ bent == pytest.approx(2 * (4 + 1 + 9))


def test_penalised_fit_of_separable_or_single_class_rows(spark):
    data = [([float(i > 4), 1.0], int(i > 4), 1.0) for i in range(10)]
    rows = spark.createDataFrame(data, "a array<double>, label int, weight double")
    rows = rows.select(array_to_vector("a").alias("features"), "label", "weight")
    apart = gam.fit_penalised(rows, [], 60)
    assert apart.converged and apart.coefficients[0] > 0
    one = gam.fit_penalised(rows.filter("label = 1"), [], 60)
    assert np.isfinite(one.coefficients).all() and one.intercept > 5
    with pytest.raises(ValueError):
        gam.fit_penalised(rows.limit(0), [])
