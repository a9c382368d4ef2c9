"""Feature blocks, scores and decisions."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from riskloom.functions import linear, log1p, logistic, time_cos, time_sin

# the batch function below travels whole: executors need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BATCH_THRESHOLD = 0.5


def add_time_features(df: DataFrame, ts: str = "ts") -> DataFrame:
    return df.withColumns({"tx_time_sin": time_sin(ts), "tx_time_cos": time_cos(ts)})


def add_log_features(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"tx_amount_log": log1p("tx_amount"), "init_balance_log": log1p("init_balance")}
    )


def add_model_features(df: DataFrame) -> DataFrame:
    """Cyclic time of day and logarithmic amounts."""
    return df.transform(add_time_features).transform(add_log_features)


def require(df: DataFrame, columns: list[str], on_missing: str = "quarantine"):
    """``(usable, rejected)`` under one policy for absent model inputs.

    ``quarantine`` sets rows with a NULL input aside, with all its NULL inputs in an
    array ``reasons``; ``impute`` replaces NULL numbers with 0 and NULL text with an unseen
    category, ``error`` fails the job at the first such row.
    """
    if on_missing == "impute":
        text = {f.name for f in df.schema.fields if f.dataType.typeName() == "string"}
        filled = {
            c: F.coalesce(F.col(c), F.lit("") if c in text else F.lit(0)) for c in columns
        }
        return df.withColumns(filled), df.limit(0)
    complete = F.lit(True)
    for c in columns:
        complete = complete & F.col(c).isNotNull()
    if on_missing == "error":
        message = F.lit("model input is NULL")
        checked = F.when(complete, F.lit(True)).otherwise(
            F.raise_error(message).cast("boolean")
        )
        return df.filter(checked), df.limit(0)
    if on_missing != "quarantine":
        raise ValueError(f"unknown policy {on_missing!r}")
    absent = F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns])
    rejected = df.filter(~complete).withColumn("reasons", F.array_compact(absent))
    return df.filter(complete), rejected


def score_linear(
    df: DataFrame, intercept: float, terms: dict[str, float], output: str = "score"
) -> DataFrame:
    """Logistic score of a weighted sum of columns."""
    return df.withColumn(output, logistic(linear(intercept, terms)))


def score_model(df: DataFrame, model, output: str = "score") -> DataFrame:
    """Score with a fitted Spark ML pipeline: the probability of class 1."""
    from pyspark.ml.functions import vector_to_array

    kept = [c for c in df.columns if c != output]
    probability = vector_to_array("probability")[1].alias(output)
    return model.transform(df).select(*kept, probability)


def score_external(
    df: DataFrame, predict, features: list[str], output: str = "score"
) -> DataFrame:
    """Score with a foreign model: ``predict(numpy matrix) -> probabilities``.

    Arrow batches instead of rows; ``predict`` is shipped once per Python worker.
    """
    schema = StructType([*df.schema.fields, StructField(output, DoubleType(), True)])

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            matrix = frame[features].to_numpy(dtype="float32")
            yield frame.assign(**{output: predict(matrix)})

    return df.mapInPandas(batches, schema)


def decide_ge(df: DataFrame, threshold: float | Column | str, score: str = "score") -> DataFrame:
    """Speed decision: at or above the threshold. Adds ``is_fraud`` and ``threshold``."""
    limit = F.col(threshold) if isinstance(threshold, str) else threshold
    out = df.withColumn("threshold", F.lit(limit))
    return out.withColumn("is_fraud", F.col(score) >= F.col("threshold"))


def decide_gt(
    df: DataFrame, threshold: float = BATCH_THRESHOLD, score: str = "score"
) -> DataFrame:
    """Batch decision: strictly above the threshold."""
    return df.withColumn("is_fraud", F.col(score) > F.lit(threshold))
