"""The stream against the batch result, bad messages, restarts, throughput."""

import json

from conftest import rows
from pyspark.sql import functions as F

from riskloom import fixtures as fx
from riskloom.operators.enrich import join_accounts
from riskloom.operators.score import score_linear
from riskloom.operators.validate import parse_events
from riskloom.queries import QUERIES
from riskloom.sources import readers
from riskloom.streaming import speed

ACCOUNTS = (
    "account_id int, customer_id string, init_balance double, country string, "
    "account_type string, tx_behavior_id int"
)


def scorer(df):
    return score_linear(df, fx.SPEED_INTERCEPT, fx.SPEED_TERMS)


def event(sender, amount, **change):
    return json.dumps(
        {
            "SENDER_ACCOUNT_ID": sender,
            "RECEIVER_ACCOUNT_ID": 2,
            "TX_TYPE": "TRANSFER",
            "TX_AMOUNT": amount,
            "TIMESTAMP": 1717171717,
            **change,
        }
    )


def start(spark, tmp_path, accounts, **options):
    events = readers.read_events(spark, "text", f"{tmp_path}/topic")
    query = speed.run_speed_layer(
        events,
        lambda: accounts,
        scorer,
        0.5,
        f"{tmp_path}/out",
        f"{tmp_path}/checkpoint",
        trigger={"availableNow": True},
        **options,
    )
    query.awaitTermination()
    return query


def test_stream_equals_backfill(spark, sf_dir):
    stream, batch = QUERIES["stream_score"](spark, sf_dir), QUERIES["backfill"](spark, sf_dir)
    assert stream.exceptAll(batch).count() == 0 and batch.exceptAll(stream).count() == 0


def test_bad_messages_progress_and_restart(spark, tmp_path):
    accounts = spark.createDataFrame([(1, "a", 10.0, "DE", "I", 1), (1, "b", 0.0, "FR", "I", 1)], ACCOUNTS)
    topic = tmp_path / "topic"
    topic.mkdir()
    (topic / "one.txt").write_text(
        "\n".join([event(1, 500.0), "{broken", event(9, 5.0), event(1, "x"), event(1, 1.0)]) + "\n"
    )
    publish = {"format": "text", "path": f"{tmp_path}/results"}
    query = start(spark, tmp_path, accounts, publish_to=publish)
    speeds = speed.throughput(query)
    assert speeds["rows"] == 5 and speeds["rows_per_second"] > 0 and speeds["seconds_per_row"] > 0

    root = f"{tmp_path}/out/speed_layer"
    table = spark.read.parquet(f"{root}/transactions")
    assert [(r["tx_amount"], r["is_fraud"]) for r in rows(table, "tx_amount")] == [
        (1.0, False),
        (500.0, True),
    ]
    assert spark.read.parquet(f"{root}/alerts").count() == 1
    bad = rows(spark.read.parquet(f"{root}/quarantine"), "reason")
    assert [r["reason"] for r in bad] == ["bad_type", "malformed", "no_account"]
    assert spark.read.text(f"{tmp_path}/results").count() == 2

    # a restart goes on after the last file, and does not repeat the first
    (topic / "two.txt").write_text(event(1, 700.0) + "\n")
    start(spark, tmp_path, accounts)
    assert spark.read.parquet(f"{root}/transactions").count() == 3
    start(spark, tmp_path, accounts)
    assert spark.read.parquet(f"{root}/transactions").count() == 3


def test_repeated_micro_batch_overwrites_itself(spark, tmp_path):
    accounts = spark.createDataFrame([(1, "a", 10.0, "DE", "I", 1)], ACCOUNTS)
    batch = spark.createDataFrame([("k1", event(1, 500.0))], "tx_id string, value string")
    decided = speed.decide_events(parse_events(batch), accounts, scorer, 0.5)
    for _ in range(2):
        scored, rejected = speed.stage(decided, f"{tmp_path}/staged")
        speed.persist_staged(scored, rejected, str(tmp_path), "/batch_id=0")
    for name in ("transactions", "transactions_by_sender", "alerts"):
        assert spark.read.parquet(f"{tmp_path}/speed_layer/{name}").count() == 1


def test_operators_run_on_an_unbounded_frame(spark, sf_dir, tmp_path):
    """Validation, the account join and scoring are plain streaming transformations."""
    events = (
        spark.readStream.schema(fx.SCHEMAS["events"])
        .option("pathGlobFilter", "events.parquet")
        .parquet(sf_dir)
    )
    tx = fx.events_as_transactions(events).select("tx_id", "sender_account_id", "tx_amount", "ts")
    scored = fx.speed_score(join_accounts(tx, fx.accounts(spark, sf_dir), "inner"))
    assert scored.isStreaming
    query = (
        scored.select("tx_id", "score")
        .writeStream.format("parquet")
        .option("checkpointLocation", f"{tmp_path}/c")
        .trigger(availableNow=True)
        .start(f"{tmp_path}/o")
    )
    query.awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/o")
    batch = QUERIES["backfill"](spark, sf_dir)
    assert got.withColumn("score", F.round("score", 6)).exceptAll(batch.select("tx_id", "score")).count() == 0
    assert got.count() == batch.count()


def test_metrics_are_observed_while_staging(spark, sf_dir, tmp_path):
    """One look at the rows: the counts equal those of the staged table."""
    from pyspark.sql import Observation

    parsed = parse_events(fx.event_json(spark, sf_dir))
    decided = speed.decide_events(parsed, fx.accounts(spark, sf_dir), scorer, 0.52)
    seen = Observation("test")
    scored, rejected = speed.stage(decided, f"{tmp_path}/staged", seen)
    counts = seen.get
    assert counts["n_scored"] == scored.count() and counts["n_rejected"] == rejected.count() > 0
    assert counts["n_rows"] == 1000 and counts["n_flagged"] == scored.filter("is_fraud").count()
    none = Observation("none")
    speed.stage(decided.limit(0), f"{tmp_path}/none", none)
    assert [none.get[c] for c in speed.COUNTED] == [0, 0, 0, 0] and none.get["last_ts"] is None


def test_observing_leaves_the_session_fit_for_new_models(spark, tmp_path):
    """A model with its training summary takes the session along to the tasks."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector
    from pyspark.sql import Observation

    rows = spark.range(40).select(
        F.col("id").alias("tx_id"),
        F.col("id").alias("ts"),
        F.lit(None).cast("string").alias("reason"),
        (F.col("id") % 2 == 0).alias("is_fraud"),
    )
    seen = Observation("left")
    speed.stage(rows, f"{tmp_path}/staged", seen)
    assert seen.get["n_rows"] == 40 and seen.get["n_flagged"] == 20
    points = rows.select(
        array_to_vector(F.array(F.col("ts").cast("double"))).alias("features"),
        (F.col("ts") % 7 > 3).cast("int").alias("label"),
    )
    model = LogisticRegression(maxIter=2).fit(points)
    assert model.transform(points).filter("prediction >= 0").count() == 40
