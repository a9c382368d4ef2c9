"""Decoding events and setting invalid ones aside, without per-row exceptions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from riskloom.functions import epoch_seconds
from riskloom.schemas import EVENT_COLUMNS, EVENT_FIELDS

VALID = "valid"
MALFORMED = "malformed"
MISSING_FIELD = "missing_field"
BAD_TYPE = "bad_type"

_RAW = StructType(
    [StructField(name, StringType(), True) for name in [*EVENT_FIELDS, "_corrupt"]]
)


def _integral(raw: Column, dtype: str) -> Column:
    """Whole numbers, also when written as ``12.0``; NULL for anything else."""
    number = raw.try_cast("double")
    whole = F.when(number == F.floor(number), number.try_cast(dtype))
    return F.coalesce(raw.try_cast(dtype), whole)


def parse_events(df: DataFrame, value: str = "value", ts_unit: str = "s") -> DataFrame:
    """Decode JSON text to typed event columns plus ``status``.

    Fields are read as text first, so that a wrong type and an absent field can be
    told apart. Works the same on tables and streams; other columns pass through.
    """
    raw = F.from_json(
        F.col(value).cast("string"),
        _RAW,
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"},
    )
    return coerce_events(df.withColumn("_e", raw), "_e", ts_unit).drop("_e")


def coerce_events(df: DataFrame, struct: str, ts_unit: str = "s") -> DataFrame:
    """Cast a struct of raw text fields to the event columns and set ``status``."""
    raw = {name: F.col(f"{struct}.{name}") for name in EVENT_FIELDS}
    typed = {
        "SENDER_ACCOUNT_ID": _integral(raw["SENDER_ACCOUNT_ID"], "int"),
        "RECEIVER_ACCOUNT_ID": _integral(raw["RECEIVER_ACCOUNT_ID"], "int"),
        "TX_TYPE": raw["TX_TYPE"],
        "TX_AMOUNT": raw["TX_AMOUNT"].try_cast("double"),
        "TIMESTAMP": epoch_seconds(_integral(raw["TIMESTAMP"], "bigint"), ts_unit),
    }
    absent = _any(raw[name].isNull() for name in EVENT_FIELDS)
    uncast = _any(typed[name].isNull() for name in EVENT_FIELDS)
    out = df.withColumns({EVENT_COLUMNS[name]: typed[name] for name in EVENT_FIELDS})
    corrupt = F.col(f"{struct}._corrupt").isNotNull() | F.col(struct).isNull()
    return out.withColumn(
        "status",
        F.when(corrupt, MALFORMED)
        .when(absent, MISSING_FIELD)
        .when(uncast, BAD_TYPE)
        .otherwise(VALID),
    )


def _any(conditions) -> Column:
    result = F.lit(False)
    for condition in conditions:
        result = result | condition
    return result


def validate_split(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(valid, quarantine)``; the quarantine keeps the record and its reason."""
    valid = parsed.filter(F.col("status") == VALID).drop("status")
    quarantine = parsed.filter(F.col("status") != VALID).withColumnRenamed("status", "reason")
    return valid, quarantine
