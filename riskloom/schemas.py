"""Declared schemas: nothing is inferred on read."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(*fields: tuple) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields])


# --- events on the wire (fixed values: field names and order of the formats) ---
EVENT_FIELDS = [
    "SENDER_ACCOUNT_ID",
    "RECEIVER_ACCOUNT_ID",
    "TX_TYPE",
    "TX_AMOUNT",
    "TIMESTAMP",
]
EVENT = _struct(
    ("SENDER_ACCOUNT_ID", IntegerType()),
    ("RECEIVER_ACCOUNT_ID", IntegerType()),
    ("TX_TYPE", StringType()),
    ("TX_AMOUNT", DoubleType()),
    ("TIMESTAMP", LongType()),
)
# wire name -> column name used by every operator
EVENT_COLUMNS = {
    "SENDER_ACCOUNT_ID": "sender_account_id",
    "RECEIVER_ACCOUNT_ID": "receiver_account_id",
    "TX_TYPE": "tx_type",
    "TX_AMOUNT": "tx_amount",
    "TIMESTAMP": "ts",
}

ACCOUNT_CSV = _struct(
    ("ACCOUNT_ID", StringType()),
    ("CUSTOMER_ID", StringType()),
    ("INIT_BALANCE", StringType()),
    ("COUNTRY", StringType()),
    ("ACCOUNT_TYPE", StringType()),
    ("TX_BEHAVIOR_ID", StringType()),
)

SCORED_TX = _struct(
    ("tx_id", StringType()),
    ("alert_id", StringType()),
    ("transaction", EVENT),
    ("fraud_prediction", BooleanType()),
    ("score", DoubleType()),
    ("threshold", DoubleType()),
    ("prediction_timestamp", StringType()),
)

# the flattened form of SCORED_TX: nested names joined with a dot
PREDICTIONS_CSV = _struct(
    ("tx_id", StringType()),
    ("alert_id", StringType()),
    ("fraud_prediction", BooleanType()),
    ("score", DoubleType()),
    ("threshold", DoubleType()),
    ("prediction_timestamp", StringType()),
    *[(f"transaction.{f.name}", f.dataType) for f in EVENT.fields],
)

BATCH_RESULT = _struct(
    ("tx_id", StringType()),
    ("sender", IntegerType()),
    ("receiver", IntegerType()),
    ("amount", DoubleType()),
    ("fraud_probability", DoubleType()),
    ("is_fraud", BooleanType()),
    ("timestamp", StringType()),
)

# --- serving tables ---
ACCOUNTS = _struct(
    ("account_id", IntegerType()),
    ("customer_id", StringType()),
    ("init_balance", DoubleType()),
    ("country", StringType()),
    ("account_type", StringType()),
    ("is_fraud", BooleanType()),
    ("tx_behavior_id", IntegerType()),
)
ALERTS = _struct(
    ("alert_type", StringType()),
    ("alert_timestamp", TimestampType()),
    ("alert_id", StringType()),
    ("is_fraud", BooleanType()),
    ("tx_id", StringType()),
    ("sender_account_id", IntegerType()),
    ("receiver_account_id", IntegerType()),
    ("tx_type", StringType()),
    ("tx_amount", DoubleType()),
)
_FACT = [
    ("sender_account_id", IntegerType()),
    ("receiver_account_id", IntegerType()),
    ("tx_type", StringType()),
    ("tx_amount", DoubleType()),
    ("is_fraud", BooleanType()),
]
_ALERT_REF = [("alert_id", StringType())]
# "treshold" is the published column name of the batch tables
_SPEED_REF = [
    ("is_fraud_speed", BooleanType()),
    ("speed_layer_score", DoubleType()),
    ("speed_layer_treshold", DoubleType()),
]


def _fact_table(key: str | None, extra: list[tuple]) -> StructType:
    head = [("tx_id", StringType()), ("tx_timestamp", TimestampType())]
    body = _FACT
    if key is not None:
        head = [(key, IntegerType()), head[1], head[0]]
        body = [c for c in _FACT if c[0] != key]
    return _struct(*head, *body, *extra, *_ALERT_REF)


SPEED_TABLES = {
    "accounts": ACCOUNTS,
    "alerts": ALERTS,
    "transactions": _fact_table(None, []),
    "transactions_by_sender": _fact_table("sender_account_id", []),
    "transactions_by_receiver": _fact_table("receiver_account_id", []),
}
BATCH_TABLES = {
    "accounts": ACCOUNTS,
    "alerts": ALERTS,
    "transactions": _fact_table(None, _SPEED_REF),
    "transactions_by_sender": _fact_table("sender_account_id", _SPEED_REF),
    "transactions_by_receiver": _fact_table("receiver_account_id", _SPEED_REF),
}
LAYERS = {"speed_layer": SPEED_TABLES, "batch_layer": BATCH_TABLES}
# the folders below a layer's tables, and those of accounts in either layer
PARTITIONS = {"speed_layer": "batch_id", "batch_layer": "dt"}
BUCKET, ACCOUNT_BUCKETS = "bucket", 64
# the primary key of accounts
ACCOUNT_KEY = ["account_id", "customer_id"]


def partition_field(layer: str, table: str) -> StructField:
    if table == "accounts":
        return StructField(BUCKET, IntegerType(), True)
    return StructField(PARTITIONS[layer], StringType(), True)


def stored_schema(layer: str, table: str) -> StructType:
    """The columns of a stored table, its partition column last."""
    return StructType([*LAYERS[layer][table].fields, partition_field(layer, table)])


# partition key, then clustering columns: the sort order of each table's files
CLUSTERING = {
    "accounts": ["account_id", "customer_id"],
    "alerts": ["alert_id", "-alert_timestamp", "alert_type"],
    "transactions": ["tx_id", "-tx_timestamp"],
    "transactions_by_sender": ["sender_account_id", "-tx_timestamp", "tx_id"],
    "transactions_by_receiver": ["receiver_account_id", "-tx_timestamp", "tx_id"],
}

# --- model inputs ---
GAM_NUMERIC = ["tx_amount_log", "init_balance_log", "tx_time_sin", "tx_time_cos"]
GAM_CATEGORICAL = ["tx_type", "account_type", "country", "tx_behavior_id"]
TREE_NUMERIC = [
    "tx_amount_log",
    "init_balance_log",
    "tx_time_sin",
    "tx_time_cos",
    "score",
    "time_since_last_tx",
    "cnt_last_24h",
    "sender_avg_amount",
]
TREE_CATEGORICAL = ["tx_type", "account_type", "country"]
