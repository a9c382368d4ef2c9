"""Readers: CSV, JSON, tables and event streams, all with declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from riskloom.operators.facts import undotted
from riskloom.operators.validate import BAD_TYPE, VALID, coerce_events
from riskloom.schemas import (
    ACCOUNT_CSV,
    EVENT_COLUMNS,
    EVENT_FIELDS,
    PREDICTIONS_CSV,
    SCORED_TX,
)


def _csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Columns are found by header name, so their order in the file is free.

    A file of the folder whose header differs from the first one's is an error: its
    columns would be taken for others.
    """
    header = spark.read.option("header", True).csv(path).columns
    known = {f.name: f for f in schema.fields}
    actual = StructType([known.get(c, StructField(c, StringType(), True)) for c in header])
    reader = spark.read.option("header", True).option("enforceSchema", False)
    return reader.schema(actual).csv(path)


def read_accounts_csv(spark: SparkSession, path: str) -> DataFrame:
    """Account rows as text, for :func:`riskloom.operators.facts.import_accounts`."""
    return _csv(spark, path, ACCOUNT_CSV).select(*ACCOUNT_CSV.fieldNames())


def read_transactions_csv(
    spark: SparkSession, path: str, labelled: bool = True, ts_unit: str = "s"
) -> DataFrame:
    """Event columns, the label, ``status`` and ``raw``, the fields as they were read.

    Fields are read as text and coerced, so that a bad row gets a ``status`` instead
    of failing the job; a label that is neither true nor false is NULL and such a row
    ``bad_type``. Splits come from the file size, not from a row count.
    """
    wanted = [*EVENT_FIELDS, "IS_FRAUD"] if labelled else list(EVENT_FIELDS)
    text = StructType([StructField(c, StringType(), True) for c in wanted])
    rows = _csv(spark, path, text)
    raw = F.struct(
        *[F.col(c) for c in EVENT_FIELDS], F.lit(None).cast("string").alias("_corrupt")
    )
    typed = coerce_events(rows.withColumn("_e", raw), "_e", ts_unit)
    columns = [*EVENT_COLUMNS.values()]
    if labelled:
        text = F.lower(F.trim("IS_FRAUD"))
        label = F.when(text.isin("true", "1", "1.0"), True).when(
            text.isin("false", "0", "0.0"), False
        )
        bad = (F.col("status") == VALID) & F.col("is_fraud").isNull()
        typed = typed.withColumn("is_fraud", label).withColumn(
            "status", F.when(bad, BAD_TYPE).otherwise(F.col("status"))
        )
        columns.append("is_fraud")
    read = [F.col(f"_e.{c}") for c in EVENT_FIELDS] + ([F.col("IS_FRAUD")] if labelled else [])
    return typed.select(*columns, "status", F.to_json(F.struct(*read)).alias("raw"))


def read_predictions_csv(spark: SparkSession, path: str) -> DataFrame:
    """The flattened results, dotted names mapped to event columns."""
    return undotted(_csv(spark, path, PREDICTIONS_CSV).select(
        *[F.col(f"`{c}`") for c in PREDICTIONS_CSV.fieldNames()]
    ))


def read_scored_json(
    spark: SparkSession,
    path: str,
    since: str | None = None,
    until: str | None = None,
    day: bool = False,
) -> DataFrame:
    """Scored transactions. ``since``/``until`` prune the ``dt=`` folders they name.

    ``day`` keeps the name of the folder as a column ``dt``, NULL outside such folders.
    """
    rows = spark.read.schema(SCORED_TX).json(path)
    if day or since is not None or until is not None:
        partitioned = StructType([*SCORED_TX.fields, StructField("dt", StringType(), True)])
        rows = spark.read.schema(partitioned).json(path)
        if since is not None:
            rows = rows.filter(F.col("dt") >= since)
        if until is not None:
            rows = rows.filter(F.col("dt") < until)
    return rows.select(*SCORED_TX.fieldNames(), *(["dt"] if day else []))


def read_table(
    spark: SparkSession, source: str, columns: list[str] | None = None, format: str = "parquet", **options
) -> DataFrame:
    """A stored table with a pushed-down projection.

    ``format`` may name any installed connector; its options are passed along.
    """
    reader = spark.read.format(format).options(**options)
    rows = reader.load(source) if source else reader.load()
    return rows.select(*columns) if columns else rows


def read_events(
    spark: SparkSession, format: str = "kafka", path: str | None = None, **options
) -> DataFrame:
    """A stream of raw events with a text column ``value`` and a stable ``tx_id``.

    ``kafka`` starts at the earliest offset and names an event by topic, partition
    and offset. File formats (``text``, one JSON object per line) name it by content
    and file. Progress is kept in the query's checkpoint.
    """
    from riskloom.functions import uuid_from

    reader = spark.readStream.format(format)
    if format == "kafka":
        options = {"startingOffsets": "earliest", "subscribe": "transactions", **options}
        rows = reader.options(**options).load()
        key = uuid_from("topic", "partition", "offset")
        return rows.select(key.alias("tx_id"), F.col("value").cast("string").alias("value"))
    rows = reader.options(**options).load(path)
    key = uuid_from("_metadata.file_path", "value")
    return rows.select(key.alias("tx_id"), F.col("value"))

