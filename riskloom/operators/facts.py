"""Projections of scored transactions onto the serving tables and outputs.

Ids come from the business key and write times are passed in, so writing a batch
again gives the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions import uuid_from
from riskloom.operators.enrich import event_struct
from riskloom.schemas import EVENT_COLUMNS, EVENT_FIELDS

ALERT_TYPE = "FRAUD"
# the partition column of stored results, passed through where it is there
DAY = "dt"
SPEED_REFERENCE = ["is_fraud_speed", "speed_layer_score", "speed_layer_treshold"]


def with_alert_id(df: DataFrame) -> DataFrame:
    """``alert_id`` for positives, NULL otherwise."""
    return df.withColumn(
        "alert_id", F.when(F.col("is_fraud"), uuid_from(F.lit("alert"), "tx_id"))
    )


def with_write_time(df: DataFrame, at: Column | None = None) -> DataFrame:
    return df.withColumn("tx_timestamp", F.current_timestamp() if at is None else at)


def as_batch_rows(df: DataFrame, score: str = "score", threshold: str = "threshold") -> DataFrame:
    """Add the speed layer's score, threshold and decision under their table names."""
    return df.withColumns(
        {
            "is_fraud_speed": F.col(score) >= F.col(threshold),
            "speed_layer_score": F.col(score),
            "speed_layer_treshold": F.col(threshold),
        }
    )


def _day(df: DataFrame) -> list[str]:
    return [DAY] if DAY in df.columns else []


def _fact(df: DataFrame, key: str | None) -> DataFrame:
    body = ["sender_account_id", "receiver_account_id", "tx_type", "tx_amount", "is_fraud"]
    extra = [c for c in SPEED_REFERENCE if c in df.columns]
    clock = [c for c in ("tx_timestamp",) if c in df.columns]
    if key is None:
        head = ["tx_id", *clock]
    else:
        head, body = [key, *clock, "tx_id"], [c for c in body if c != key]
    return df.select(*head, *body, *extra, "alert_id", *_day(df))


def tx_fact(df: DataFrame) -> DataFrame:
    return _fact(df, None)


def tx_by_sender(df: DataFrame) -> DataFrame:
    return _fact(df, "sender_account_id")


def tx_by_receiver(df: DataFrame) -> DataFrame:
    return _fact(df, "receiver_account_id")


def alerts(df: DataFrame) -> DataFrame:
    """One alert per positive decision."""
    clock = (
        [F.col("tx_timestamp").alias("alert_timestamp")] if "tx_timestamp" in df.columns else []
    )
    return df.filter("is_fraud").select(
        F.lit(ALERT_TYPE).alias("alert_type"),
        *clock,
        "alert_id",
        F.lit(True).alias("is_fraud"),
        "tx_id",
        "sender_account_id",
        "receiver_account_id",
        "tx_type",
        "tx_amount",
        *_day(df),
    )


def scored_payload(df: DataFrame, at: Column | None = None) -> DataFrame:
    """The nested result record of a scored transaction."""
    moment = F.current_timestamp() if at is None else at
    return df.select(
        F.col("tx_id").cast("string").alias("tx_id"),
        "alert_id",
        event_struct().alias("transaction"),
        F.col("is_fraud").alias("fraud_prediction"),
        "score",
        "threshold",
        F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("prediction_timestamp"),
    )


def payload_json(payload: DataFrame, output: str = "value") -> DataFrame:
    """The record as JSON text, NULL fields written out."""
    record = F.struct(*[F.col(c) for c in payload.columns])
    return payload.select(
        "tx_id", F.to_json(record, {"ignoreNullFields": "false"}).alias(output)
    )


def flatten_scored(payload: DataFrame) -> DataFrame:
    """Batch input: nested fields extracted and renamed."""
    return payload.select(
        "tx_id",
        "score",
        "threshold",
        F.col("transaction.SENDER_ACCOUNT_ID").alias("sender_id"),
        F.col("transaction.RECEIVER_ACCOUNT_ID").alias("receiver_id"),
        F.col("transaction.TX_TYPE").alias("tx_type"),
        F.col("transaction.TX_AMOUNT").alias("tx_amount"),
        F.col("transaction.TIMESTAMP").alias("timestamp"),
        *_day(payload),
    )


def as_transactions(flat: DataFrame) -> DataFrame:
    """Flattened batch input under the names the operators use."""
    return flat.withColumnsRenamed(
        {"sender_id": "sender_account_id", "receiver_id": "receiver_account_id", "timestamp": "ts"}
    )


def dotted(payload: DataFrame) -> DataFrame:
    """Result records as flat columns with dotted names (the predictions CSV)."""
    head = ["tx_id", "alert_id", "fraud_prediction", "score", "threshold", "prediction_timestamp"]
    return payload.select(
        *head, *[F.col(f"transaction.{f}").alias(f"transaction.{f}") for f in EVENT_FIELDS]
    )


def undotted(flat: DataFrame) -> DataFrame:
    """The predictions CSV under the names the operators use."""
    return flat.withColumnsRenamed(
        {f"transaction.{wire}": name for wire, name in EVENT_COLUMNS.items()}
    )


def feature_payload(df: DataFrame) -> DataFrame:
    """The nine fields sent to a batch scorer."""
    return df.select(
        "sender_account_id",
        "receiver_account_id",
        "tx_type",
        "tx_amount",
        "ts",
        "init_balance",
        "country",
        "account_type",
        "score",
    )


def batch_results(df: DataFrame, at: Column | None = None) -> DataFrame:
    """The result records of the batch layer."""
    moment = F.current_timestamp() if at is None else at
    return df.select(
        F.col("tx_id").cast("string").alias("tx_id"),
        F.col("sender_account_id").alias("sender"),
        F.col("receiver_account_id").alias("receiver"),
        F.col("tx_amount").alias("amount"),
        "fraud_probability",
        "is_fraud",
        F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("timestamp"),
        *_day(df),
    )


def import_accounts(raw: DataFrame) -> DataFrame:
    """Typed account rows from CSV text; nobody is known to be a fraudster yet."""
    return raw.select(
        F.col("ACCOUNT_ID").cast("int").alias("account_id"),
        F.col("CUSTOMER_ID").alias("customer_id"),
        F.col("INIT_BALANCE").cast("double").alias("init_balance"),
        F.col("COUNTRY").alias("country"),
        F.col("ACCOUNT_TYPE").alias("account_type"),
        F.lit(None).cast("boolean").alias("is_fraud"),
        F.col("TX_BEHAVIOR_ID").cast("int").alias("tx_behavior_id"),
    )
