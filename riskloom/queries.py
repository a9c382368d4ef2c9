"""One query per operator, over the test tables, with results fit for comparison.

Floats are rounded, and wall-clock columns left out, so that two engines agree.
Means of two-decimal amounts are rounded to 8 places: at 6 a mean over 32 rows can
fall exactly between two roundings.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom import fixtures as fx
from riskloom.operators import (
    encode,
    enrich,
    evaluate,
    facts,
    sampling,
    score,
    smote,
    validate,
    windows,
)
from riskloom.plans import gam, jobs, search, training
from riskloom.schemas import ACCOUNT_CSV, GAM_CATEGORICAL, SCORED_TX, stored_schema
from riskloom.session import scratch_dir
from riskloom.sinks import writers
from riskloom.streaming import speed

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return df.withColumns({n: F.round(F.col(n), digits) for n in names})


# --- scans ---------------------------------------------------------------


@query
def accounts_scan(spark, d):
    return enrich.accounts_projection(fx.accounts(spark, d))


@query
def accounts_import(spark, d):
    a = fx.accounts(spark, d)
    raw = a.select(
        *[
            F.col(c.lower()).cast("string").alias(c)
            for c in ACCOUNT_CSV.fieldNames()
        ]
    )
    return facts.import_accounts(raw)


@query
def accounts_upsert(spark, d):
    """The stored accounts after an import, and one of some accounts with other balances."""
    folder = scratch_dir(spark, "upsert")
    accounts = fx.accounts(spark, d)
    writers.write_accounts(accounts, folder)
    moved = accounts.filter("account_id % 5 = 0").withColumn(
        "init_balance", F.col("init_balance") + 1000
    )
    writers.write_accounts(moved, folder)
    return spark.read.parquet(f"{folder}/batch_layer/accounts").select(accounts.columns)


@query
def accounts_first(spark, d):
    return enrich.first_account(fx.duplicated_accounts(spark, d)).drop("is_fraud")


@query
def row_count(spark, d):
    return fx.transactions(spark, d).agg(F.count(F.lit(1)).alias("n_rows"))


def _decided(spark, d):
    """Scored transactions with the speed decision as ``is_fraud`` and an alert id."""
    s = fx.scored(spark, d).withColumnRenamed("fraud_prediction", "is_fraud")
    return facts.with_alert_id(s)


def _reparsed(spark, d):
    text = facts.payload_json(facts.scored_payload(_decided(spark, d)))
    return text.select(F.from_json("value", SCORED_TX).alias("p")).select("p.*")


@query
def tx_flatten(spark, d):
    flat = facts.flatten_scored(_reparsed(spark, d))
    return rounded(flat.withColumn("tx_id", F.col("tx_id").cast("long")), "score")


@query
def pred_flatten(spark, d):
    flat = facts.undotted(facts.dotted(_reparsed(spark, d)))
    flat = flat.withColumn("tx_id", F.col("tx_id").cast("long"))
    return rounded(flat.drop("alert_id", "prediction_timestamp"), "score")


@query
def payload_json(spark, d):
    p = _reparsed(spark, d)
    out = p.select(
        F.col("tx_id").cast("long").alias("tx_id"),
        F.col("transaction.SENDER_ACCOUNT_ID").alias("sender_account_id"),
        F.col("transaction.TX_AMOUNT").alias("tx_amount"),
        "fraud_prediction",
        "score",
    )
    return rounded(out, "score")


@query
def validate_split(spark, d):
    parsed = validate.parse_events(fx.event_json(spark, d))
    return parsed.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query
def feature_payload(spark, d):
    rows = enrich.join_accounts(fx.scored(spark, d), fx.accounts(spark, d), "left")
    return rounded(facts.feature_payload(rows), "score")


# --- joins ---------------------------------------------------------------


@query
def enrich_left(spark, d):
    return enrich.join_accounts(
        fx.transactions(spark, d), fx.accounts(spark, d), "left", enrich.BATCH_ACCOUNT_COLUMNS
    )


@query
def train_join(spark, d):
    return enrich.join_accounts(fx.transactions(spark, d), fx.accounts(spark, d), "left")


@query
def enrich_inner(spark, d):
    return enrich.join_accounts(
        fx.transactions(spark, d), fx.accounts(spark, d), "inner", enrich.BATCH_ACCOUNT_COLUMNS
    )


@query
def enrich_missing(spark, d):
    missing = enrich.join_accounts(
        fx.transactions(spark, d), fx.accounts(spark, d), "left_anti"
    )
    return missing.select("tx_id", "sender_account_id")


@query
def match_label(spark, d):
    matched = enrich.match_label(fx.predictions(spark, d), fx.labelled_with_copies(spark, d))
    return rounded(matched.select("tx_id", "score", "tx_is_fraud", "n_matches"), "score")


@query
def match_pairs(spark, d):
    """The same join unfolded: one row for each pair of prediction and labelled row."""
    pairs = enrich.match_pairs(fx.predictions(spark, d), fx.labelled_with_copies(spark, d))
    return rounded(pairs.select("tx_id", "score", "tx_is_fraud"), "score")


# --- features ------------------------------------------------------------


@query
def time_features(spark, d):
    out = score.add_time_features(fx.transactions(spark, d))
    return rounded(
        out.select("tx_id", "tx_time_sin", "tx_time_cos"), "tx_time_sin", "tx_time_cos"
    )


@query
def log_features(spark, d):
    rows = enrich.join_accounts(fx.transactions(spark, d), fx.accounts(spark, d), "left")
    out = score.add_log_features(rows).select("tx_id", "tx_amount_log", "init_balance_log")
    return rounded(out, "tx_amount_log", "init_balance_log")


@query
def behavioral(spark, d):
    out = windows.add_behavioral_features(fx.transactions(spark, d)).drop("prev_ts")
    out = out.select("tx_id", *windows.FEATURES[1:])
    return rounded(out, "sender_avg_amount", "sender_std_amount", digits=8)


@query
def batch_incremental(spark, d):
    """The features of the last week of days, by a run that leaves earlier days alone."""
    day = F.date_format(F.timestamp_seconds("ts"), "yyyy-MM-dd")
    flat = fx.scored(spark, d).withColumn("dt", day)
    last = flat.agg(F.max("dt")).first()[0]
    since = str(date.fromisoformat(last) - timedelta(days=6)) if last else ""
    usable, _ = jobs.batch_features(flat, fx.accounts(spark, d), since=since)
    out = usable.select("tx_id", "dt", *windows.FEATURES[1:4])
    return rounded(out, "sender_avg_amount", digits=8)


@query
def lag_gap(spark, d):
    out = windows.add_behavioral_features(fx.transactions(spark, d))
    return out.select("tx_id", "prev_ts", "time_since_last_tx")


@query
def cnt_24h(spark, d):
    return windows.add_behavioral_features(fx.transactions(spark, d)).select(
        "tx_id", "cnt_last_24h"
    )


@query
def sender_stats(spark, d):
    out = windows.add_behavioral_features(fx.transactions(spark, d))
    out = out.select("tx_id", "sender_avg_amount", "sender_std_amount")
    return rounded(out, "sender_avg_amount", "sender_std_amount", digits=8)


@query
def spline_basis(spark, d):
    from riskloom.functions import add_spline_basis

    logged = fx.transactions(spark, d).select("tx_id", F.log1p("tx_amount").alias("x"))
    low, high = logged.agg(F.min("x"), F.max("x")).first()
    out = add_spline_basis(logged, "x", low, high).drop("x")
    return rounded(out, *out.columns[1:])


# --- categories ----------------------------------------------------------


def _joined(spark, d):
    return enrich.join_accounts(fx.transactions(spark, d), fx.accounts(spark, d), "left")


@query
def country_counts(spark, d):
    return encode.value_counts(_joined(spark, d), "country")


@query
def top_countries(spark, d):
    return encode.top_values(_joined(spark, d), "country")


@query
def country_bucket(spark, d):
    rows = _joined(spark, d)
    top = encode.top_values(rows, "country")
    return encode.keep_top(rows, "country", top, "country_bucket").select(
        "tx_id", "country_bucket"
    )


@query
def category_index(spark, d):
    return encode.category_index(_joined(spark, d))


@query
def freq_index(spark, d):
    rows = _joined(spark, d).select("tx_type", "account_type", "country")
    indexed = encode.frequency_indexer().fit(rows).transform(rows)
    return indexed.distinct()


@query
def onehot(spark, d):
    from pyspark.ml import Pipeline

    rows = _joined(spark, d)
    fitted = Pipeline(stages=encode.onehot_stages()).fit(rows.select(*GAM_CATEGORICAL))
    return encode.onehot_long(fitted.transform(rows))


@query
def assemble(spark, d):
    from pyspark.ml.functions import vector_to_array

    rows = fx.model_rows(spark, d)
    assembled = encode.tree_pipeline().fit(rows).transform(rows)
    slots = assembled.select("tx_id", vector_to_array("features").alias("v"))
    # slot 7 is a mean, and keeps the digits that means are compared at
    return slots.select(
        "tx_id", *[F.round(F.col("v")[i], 8 if i == 7 else 6).alias(f"f{i}") for i in range(11)]
    )


# --- sampling ------------------------------------------------------------


def _labelled(spark, d):
    return fx.transactions(spark, d).withColumn("label", F.col("is_fraud").cast("int"))


@query
def label_counts(spark, d):
    return evaluate.label_counts(_labelled(spark, d))


@query
def fraud_rate(spark, d):
    return rounded(evaluate.fraud_rate(_labelled(spark, d)), "fraud_rate")


@query
def split_80_20(spark, d):
    return sampling.split_80_20(fx.transactions(spark, d)).select("tx_id", "split")


@query
def split_90_5_5(spark, d):
    return sampling.split_90_5_5(fx.transactions(spark, d)).select("tx_id", "split")


# a third of the sf0.01 table, so that negatives are really cut there and above
SUBSAMPLE_ROWS = 3000


@query
def subsample(spark, d):
    return sampling.subsample(_labelled(spark, d), SUBSAMPLE_ROWS).select("tx_id", "label")


@query
def sample_weights(spark, d):
    return sampling.sample_weights(_labelled(spark, d)).select("tx_id", "weight")


# --- scores and decisions ------------------------------------------------


@query
def score_linear(spark, d):
    return rounded(fx.speed_score(fx.transactions(spark, d)).select("tx_id", "score"), "score")


def _batch_scored(spark, d):
    # windows need no account, so they come before the join
    featured = windows.add_behavioral_features(fx.scored(spark, d))
    rows = enrich.join_accounts(
        featured, fx.accounts(spark, d), "left", enrich.BATCH_ACCOUNT_COLUMNS
    )
    return fx.batch_score(rows)


@query
def score_batch(spark, d):
    out = _batch_scored(spark, d).select("tx_id", F.col("fraud_probability").alias("score"))
    return rounded(out, "score")


@query
def decide_ge(spark, d):
    tx = fx.speed_score(fx.transactions(spark, d).drop("is_fraud"))
    out = score.decide_ge(tx, fx.SPEED_THRESHOLD).select("tx_id", "score", "is_fraud")
    return rounded(out, "score")


def _batch_decided(spark, d):
    decided = score.decide_gt(_batch_scored(spark, d), score="fraud_probability")
    return facts.with_alert_id(facts.as_batch_rows(decided))


@query
def decide_gt(spark, d):
    out = _batch_decided(spark, d)
    out = out.select("tx_id", F.col("fraud_probability").alias("score"), "is_fraud")
    return rounded(out, "score")


# --- serving tables ------------------------------------------------------


@query
def alerts(spark, d):
    return facts.alerts(_decided(spark, d))


@query
def tx_fact(spark, d):
    return facts.tx_fact(_decided(spark, d))


@query
def tx_by_sender(spark, d):
    return facts.tx_by_sender(_decided(spark, d))


@query
def tx_by_receiver(spark, d):
    return facts.tx_by_receiver(_decided(spark, d))


@query
def batch_tx_fact(spark, d):
    return rounded(facts.tx_fact(_batch_decided(spark, d)), "speed_layer_score")


@query
def batch_tx_by_sender(spark, d):
    return rounded(facts.tx_by_sender(_batch_decided(spark, d)), "speed_layer_score")


@query
def batch_tx_by_receiver(spark, d):
    return rounded(facts.tx_by_receiver(_batch_decided(spark, d)), "speed_layer_score")


@query
def batch_results(spark, d):
    out = facts.batch_results(_batch_decided(spark, d)).drop("timestamp")
    out = out.withColumn("tx_id", F.col("tx_id").cast("long"))
    return rounded(out, "fraud_probability")


def _stored(spark, d, table, made):
    """A serving table as its files hold it: rows with file and place in it."""
    folder = scratch_dir(spark, "clustered")
    staged = facts.with_write_time(_decided(spark, d), F.timestamp_seconds("ts"))
    writers.write_table(made(staged), folder, table)
    return spark.read.parquet(folder).select(
        "*",
        F.col("_metadata.file_name").alias("_file"),
        F.col("_metadata.row_index").alias("_place"),
    )


def _in_order(rows, keys):
    """Whether each row's key is no less than that of the row before it in its file."""
    here = F.struct(*[F.col(k) for k in keys])
    before = F.lag(here).over(Window.partitionBy("_file").orderBy("_place"))
    return F.coalesce(before <= here, F.lit(True)).alias("in_order")


def _by_place(rows, key):
    """The number of each row among those of its key, in the order they are stored."""
    stored = Window.partitionBy(key).orderBy("_file", "_place")
    return rows.select(
        key, F.unix_timestamp("tx_timestamp").alias("ts"), "tx_id", F.row_number().over(stored).alias("nth")
    )


@query
def clustered_transactions(spark, d):
    rows = _stored(spark, d, "transactions", facts.tx_fact)
    return rows.select("tx_id", _in_order(rows, ["tx_id"]))


@query
def clustered_alerts(spark, d):
    rows = _stored(spark, d, "alerts", facts.alerts)
    return rows.select("tx_id", "alert_id", _in_order(rows, ["alert_id"]))


@query
def clustered_by_sender(spark, d):
    """Every row with its number in its sender's stored order, over all files."""
    return _by_place(
        _stored(spark, d, "transactions_by_sender", facts.tx_by_sender), "sender_account_id"
    )


@query
def clustered_by_receiver(spark, d):
    return _by_place(
        _stored(spark, d, "transactions_by_receiver", facts.tx_by_receiver), "receiver_account_id"
    )


@query
def sender_history(spark, d):
    out = windows.latest_per_key(fx.transactions(spark, d), "sender_account_id", 5)
    return out.select("sender_account_id", "tx_id", "ts", "rn")


@query
def receiver_history(spark, d):
    out = windows.latest_per_key(fx.transactions(spark, d), "receiver_account_id", 5)
    return out.select("receiver_account_id", "tx_id", "ts", "rn")


@query
def layer_compare(spark, d):
    out = _batch_decided(spark, d).withColumnRenamed("is_fraud", "is_fraud_batch")
    return evaluate.layer_compare(out)


@query
def batch_runs(spark, d):
    """The stored batch table after a full run, a daily run and that day's run again."""
    moment = F.timestamp_seconds("ts")
    folder = scratch_dir(spark, "batch-runs")
    records = _decided(spark, d)
    scored = facts.scored_payload(records, F.date_trunc("day", moment))
    day = F.substring("prediction_timestamp", 1, 10)
    last = scored.agg(F.max(day)).first()[0] or ""
    accounts = fx.accounts(spark, d)

    def run(**options):
        jobs.batch_scoring(
            spark, f"{folder}/in", accounts, fx.batch_score, folder, as_of_day=True, **options
        )

    writers.write_scored_json(scored.filter(day < last), f"{folder}/in")
    run()
    writers.write_scored_json(scored.filter(day >= last), f"{folder}/in")
    for _ in range(2):
        run(since=last)
    stored = spark.read.schema(stored_schema("batch_layer", "transactions")).parquet(
        f"{folder}/batch_layer/transactions"
    )
    out = stored.select(
        F.col("tx_id").cast("long").alias("tx_id"), "dt", "is_fraud", "speed_layer_score"
    )
    return rounded(out, "speed_layer_score")


@query
def batch_quarantine(spark, d):
    """What keeps rows from the batch model: how many lack each input."""
    _, rejected = jobs.batch_features(fx.scored(spark, d), fx.accounts(spark, d))
    each = rejected.select(F.explode("reasons").alias("reason"))
    return each.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


# --- evaluation ----------------------------------------------------------


def _judged(spark, d):
    return fx.scored(spark, d).select(
        "tx_id", "label", "score", F.col("fraud_prediction").alias("is_fraud")
    )


@query
def confusion(spark, d):
    return evaluate.confusion(_judged(spark, d))


@query
def class_metrics(spark, d):
    out = evaluate.class_metrics(evaluate.confusion(_judged(spark, d)))
    return rounded(out, *out.columns)


@query
def auc_hard(spark, d):
    return rounded(evaluate.auc_hard(evaluate.confusion(_judged(spark, d))), "auc")


@query
def pr_curve(spark, d):
    coarse = rounded(_judged(spark, d), "score", digits=3)
    return rounded(evaluate.pr_curve(coarse), "precision", "recall")


@query
def cost_threshold(spark, d):
    return rounded(evaluate.cost_threshold(_judged(spark, d)), "threshold")


@query
def f1_threshold(spark, d):
    return rounded(evaluate.f1_threshold(_judged(spark, d)), "threshold", "f1")


# --- whole paths ---------------------------------------------------------


def _speed_events(events):
    """Events as they arrive on the wire: an id and JSON text."""
    tx = fx.events_as_transactions(events)
    return tx.select("tx_id", F.to_json(enrich.event_struct()).alias("value"))


def _speed_scorer(df):
    return score.score_linear(df, fx.SPEED_INTERCEPT, fx.SPEED_TERMS)


@query
def backfill(spark, d):
    """The stream's decisions on the stored table."""
    parsed = validate.parse_events(_speed_events(fx.table(spark, d, "events")))
    decided = speed.decide_events(
        parsed, fx.accounts(spark, d), _speed_scorer, fx.SPEED_THRESHOLD
    )
    out = decided.filter(F.col("reason").isNull())
    return rounded(out.select("tx_id", "score", "is_fraud"), "score")


@query
def stream_score(spark, d):
    """The same through the stream: file source, micro-batches, staged outputs."""
    events = (
        fx.tune(spark)
        .readStream.schema(fx.SCHEMAS["events"])
        .option("pathGlobFilter", "events.parquet")
        .parquet(d)
    )
    work = scratch_dir(spark, "stream")
    running = speed.run_speed_layer(
        _speed_events(events),
        lambda: fx.accounts(spark, d),
        _speed_scorer,
        fx.SPEED_THRESHOLD,
        f"{work}/out",
        f"{work}/checkpoint",
        trigger={"availableNow": True},
    )
    running.awaitTermination()
    staged = spark.read.parquet(f"{work}/out/speed_layer/staged")
    out = staged.filter(F.col("outcome") == "scored")
    return rounded(out.select("tx_id", "score", "is_fraud"), "score")


@query
def stream_metrics(spark, d):
    """What the stream observed of itself, summed over its micro-batches."""
    events = (
        fx.tune(spark)
        .readStream.schema(fx.SCHEMAS["events"])
        .option("pathGlobFilter", "events.parquet")
        .parquet(d)
    )
    work = scratch_dir(spark, "metrics")
    speed.run_speed_layer(
        _speed_events(events),
        lambda: fx.accounts(spark, d),
        _speed_scorer,
        fx.SPEED_THRESHOLD,
        f"{work}/out",
        f"{work}/checkpoint",
        trigger={"availableNow": True},
    ).awaitTermination()
    observed = spark.read.parquet(f"{work}/out/speed_layer/metrics")
    return observed.agg(*[F.sum(c).alias(c) for c in speed.COUNTED], F.max("last_ts").alias("last_ts"))


# --- models, fitted on the whole tables by the jobs' own defaults ---


@query
def oversample(spark, d):
    """Originals and synthetic rows; these by the positive whose vector they start from.

    ``reach`` is the distance from there to the fifth neighbour, and ``between`` says that
    the row lies no farther away than that.
    """
    from pyspark.ml.functions import vector_to_array

    rows = fx.model_rows(spark, d)
    folder = scratch_dir(spark, "assembled")
    encode.tree_pipeline().fit(rows).transform(rows).select(
        "tx_id", "features", "label"
    ).write.parquet(folder)
    assembled = spark.read.parquet(folder)
    out = smote.oversample(assembled, trace=True)
    start = assembled.select(
        F.col("tx_id").alias("base"), vector_to_array("features").alias("_from")
    )
    square = F.zip_with(vector_to_array("features"), "_from", lambda a, b: (a - b) * (a - b))
    gone = F.sqrt(F.aggregate(square, F.lit(0.0), lambda s, v: s + v))
    return out.join(start, "base", "left").select(
        "tx_id",
        "label",
        "synthetic",
        "base",
        F.round("reach", 4).alias("reach"),
        (gone <= F.col("reach") * (1 + 1e-9)).alias("between"),
    )


def _class_counts(report):
    """How many rows of each class a report judged, whatever it decided."""
    hits, others = F.col("tp") + F.col("fn"), F.col("fp") + F.col("tn")
    return report.select(hits.alias("positives"), others.alias("negatives"))


@query
def gam_fit(spark, d):
    """The fit at full rounds, by what the one right fit must give.

    ``stationary``: the derivatives of the penalised likelihood, summed by column
    expressions over the stored features, are zero. ``calibrated``: with a free intercept
    the weighted mean of the fitted probabilities is the weighted share of positives.
    """
    folder = scratch_dir(spark, "gam")
    report = training.train_gam(spark, fx.transactions(spark, d), fx.accounts(spark, d), folder)
    stage = training.load_pipeline(f"{folder}/model").stages[-1]
    features = spark.read.parquet(f"{folder}/features")
    fitted = score.score_model(features, stage)
    w = F.sum("weight")
    fit, share, total, n = fitted.agg(
        F.sum(F.col("weight") * F.col("score")) / w,
        F.sum(F.col("weight") * F.col("label")) / w,
        w,
        F.count(F.lit(1)),
    ).first()
    held = gam.Fit(stage.coefficients.toArray(), stage.intercept, 0, True)
    equations = gam.score_equations(fitted, held, list(training.SPLINES.values()))
    slope, slots = equations.agg(F.max(F.abs("gradient")), F.count(F.lit(1))).first()
    return _class_counts(report).select(
        "*",
        F.lit(n).alias("n_train"),
        F.lit(slots).alias("n_coefficients"),
        F.lit(round(share, 9)).alias("train_share"),
        F.lit(slope < 1e-6 * total).alias("stationary"),
        F.lit(abs(fit - share) < 1e-7).alias("calibrated"),
    )


@query
def gbt_fit(spark, d):
    """The job at its defaults, by part sizes, a floor for the ranking and its early stop.

    ``patient``: dev was looked at for as long as patience asks, or for all rounds;
    ``best_kept``: no round that was looked at has a lower dev loss than the last kept.
    """
    usable, _ = training.tree_rows(
        fx.predictions(spark, d).drop("label"),
        fx.labelled_with_copies(spark, d),
        fx.accounts(spark, d),
    )
    folder = scratch_dir(spark, "trees")
    report = training.train_trees(spark, usable, folder)
    parts = spark.read.parquet(f"{folder}/rows").groupBy("split").count()
    sizes = {r["split"]: r["count"] for r in parts.collect()}  # three rows
    test = spark.read.parquet(f"{folder}/scored/test")
    kept = training.load_pipeline(f"{folder}/model").stages[-1].getNumTrees
    looked = spark.read.parquet(f"{folder}/dev_losses").agg(
        F.max("round"), F.min("loss"), F.max_by("loss", F.col("round") == kept)
    )
    rounds, least, last = looked.first()
    patient = rounds >= min(training.TREE_ROUNDS, kept + training.PATIENCE)
    return _class_counts(report).select(
        "*",
        *[F.lit(sizes.get(k, 0)).cast("long").alias(f"n_{k}") for k in ("train", "dev", "test")],
        F.lit(training.rank_auc(test) > 0.6).alias("ranks"),
        F.lit(patient).alias("patient"),
        F.lit(last == least).alias("best_kept"),
    )


@query
def hpo(spark, d):
    """All draws, folds and rounds of the job on its sample of the training part.

    Beside the points and the fold sizes: whether each F1 is one, is none above the best,
    and whether the best beats flagging everything.
    """
    rows = sampling.split_90_5_5(fx.model_rows(spark, d)).filter("split = 'train'")
    folder = scratch_dir(spark, "search")
    rows.write.parquet(f"{folder}/rows")
    rows = spark.read.parquet(f"{folder}/rows")
    assembled = encode.tree_pipeline().fit(rows).transform(rows)
    found = training.search(assembled.select("tx_id", "features", "label"), save_to=folder)
    best = found.agg(F.max("f1")).first()[0]
    share = rows.agg(F.avg("label")).first()[0] or 0.0
    return found.select(
        *search.SEARCH_GRID,
        *[F.get("fold_rows", F.lit(k)).alias(f"fold_{k}") for k in range(search.FOLDS)],
        "n_trees",
        F.col("f1").between(0, 1).alias("in_range"),
        (F.col("f1") <= best).alias("not_above_best"),
        F.lit(best > 2 * share / (1 + share)).alias("beats_flagging_all"),
    )
