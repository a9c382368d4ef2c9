"""The test tables seen as accounts and transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions import time_sin
from riskloom.operators.score import decide_ge, score_linear
from riskloom.session import tune

SPEED_THRESHOLD = 0.52
# fixed coefficients of the two stand-in scores
SPEED_INTERCEPT = -6.0
SPEED_TERMS = {"tx_amount_log": 1.2, "tx_time_sin": 0.1}
BATCH_INTERCEPT = -7.0
BATCH_TERMS = {"tx_amount_log": 1.2, "score": 1.0, "cnt_last_24h": 0.15, "_gap_log": -0.03}


SCHEMAS = {
    "events": "event_id LONG, ts TIMESTAMP_NTZ, user_id LONG, event_type STRING, value DOUBLE, "
    "props STRING",
    "customer": "c_custkey LONG, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
    "c_mktsegment STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tune(spark).read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as accounts; every 17th is left out so that some senders have none."""
    # nation has 25 rows at every scale
    nation = F.broadcast(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"))
    customer = table(spark, sf_dir, "customer").filter(F.col("c_custkey") % 17 != 0)
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").cast("int").alias("account_id"),
        F.col("c_name").alias("customer_id"),
        F.col("c_acctbal").alias("init_balance"),
        F.col("n_name").alias("country"),
        F.col("c_mktsegment").alias("account_type"),
        F.lit(None).cast("boolean").alias("is_fraud"),
        (F.col("c_custkey") % 10).cast("int").alias("tx_behavior_id"),
    )


def duplicated_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts, some with a second customer."""
    base = accounts(spark, sf_dir)
    second = base.filter(F.col("account_id") % 13 == 0).withColumn(
        "customer_id", F.concat("customer_id", F.lit("-b"))
    )
    return base.unionByName(second)


def events_as_transactions(events: DataFrame) -> DataFrame:
    """Also works on a stream of the events table."""
    k = F.get_json_object("props", "$.k").cast("int")
    return events.select(
        F.col("event_id").alias("tx_id"),
        F.col("user_id").cast("int").alias("sender_account_id"),
        ((F.col("user_id") * 7 + F.col("event_id")) % 1000).cast("int").alias(
            "receiver_account_id"
        ),
        F.col("event_type").alias("tx_type"),
        F.col("value").alias("tx_amount"),
        F.unix_timestamp("ts").alias("ts"),
        ((F.col("value") > 150) | (k >= 98)).alias("is_fraud"),
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_as_transactions(table(spark, sf_dir, "events"))


def speed_score(tx: DataFrame) -> DataFrame:
    """Add the fixed speed score; needs no account."""
    logged = tx.withColumns(
        {"tx_amount_log": F.log1p("tx_amount"), "tx_time_sin": time_sin("ts")}
    )
    return score_linear(logged, SPEED_INTERCEPT, SPEED_TERMS).drop("tx_amount_log", "tx_time_sin")


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions with ``score``, ``threshold`` and the decision ``fraud_prediction``."""
    tx = transactions(spark, sf_dir).withColumnRenamed("is_fraud", "label")
    decided = decide_ge(speed_score(tx), SPEED_THRESHOLD)
    return decided.withColumn("label", F.col("label").cast("int")).withColumnRenamed(
        "is_fraud", "fraud_prediction"
    )


def batch_score(df: DataFrame, output: str = "fraud_probability") -> DataFrame:
    """The fixed batch score over the speed score and the window features."""
    ready = df.withColumns(
        {"tx_amount_log": F.log1p("tx_amount"), "_gap_log": F.log1p("time_since_last_tx")}
    )
    return score_linear(ready, BATCH_INTERCEPT, BATCH_TERMS, output).drop("_gap_log")


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored transactions with drifted amounts: even ids by less than the matching
    tolerance, ids divisible by 11 by more."""
    drift = (
        F.when(F.col("tx_id") % 11 == 0, 1e-3).when(F.col("tx_id") % 2 == 0, 4e-7).otherwise(0.0)
    )
    return scored(spark, sf_dir).withColumn("tx_amount", F.col("tx_amount") + drift)


def labelled_with_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions, every 97th three times over."""
    tx = transactions(spark, sf_dir)
    times = F.when(F.col("tx_id") % 97 == 0, F.array(*[F.lit(i) for i in range(3)])).otherwise(
        F.array(F.lit(0))
    )
    return tx.withColumn("_copy", F.explode(times)).drop("_copy")


def event_json(spark: SparkSession, sf_dir: str, damaged: bool = True) -> DataFrame:
    """Transactions as wire JSON; a share of them damaged in three ways."""
    text = F.to_json(
        F.struct(
            F.col("sender_account_id").alias("SENDER_ACCOUNT_ID"),
            F.col("receiver_account_id").alias("RECEIVER_ACCOUNT_ID"),
            F.col("tx_type").alias("TX_TYPE"),
            F.col("tx_amount").alias("TX_AMOUNT"),
            F.col("ts").alias("TIMESTAMP"),
        )
    )
    if damaged:
        i = F.col("tx_id")
        text = (
            F.when(i % 90 == 0, F.concat(F.lit("{broken"), text))
            .when(i % 70 == 0, F.regexp_replace(text, '"TX_AMOUNT":[0-9.E-]+', '"TX_AMOUNT":"n/a"'))
            .when(i % 50 == 0, F.regexp_replace(text, '"TX_TYPE":"[a-z]+",', ""))
            .otherwise(text)
        )
    return transactions(spark, sf_dir).select("tx_id", text.alias("value"))


def model_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored, enriched and featurised rows with every model input present."""
    from riskloom.plans.jobs import batch_features

    usable, _ = batch_features(scored(spark, sf_dir), accounts(spark, sf_dir))
    return usable
