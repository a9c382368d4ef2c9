"""Category counts, dictionaries and encoders.

Fit on training rows, apply anywhere: the same fitted object serves training and
scoring, so a category is treated alike in both.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.schemas import GAM_CATEGORICAL, TREE_CATEGORICAL, TREE_NUMERIC

TOP_K = 20
OTHER = "OTHER"


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def top_values(df: DataFrame, column: str, k: int = TOP_K) -> DataFrame:
    """The ``k`` most frequent values; equal counts in alphabetical order."""
    return value_counts(df, column).orderBy(F.desc("n"), F.asc(column)).limit(k)


def keep_top(df: DataFrame, column: str, top: DataFrame, output: str) -> DataFrame:
    """Keep values listed in ``top``; everything else, NULL included, is ``OTHER``.

    ``top`` has at most ``k`` rows, so broadcasting it is always safe.
    """
    listed = F.broadcast(top.select(F.col(column).alias("_kept")))
    return (
        df.join(listed, F.col(column) == F.col("_kept"), "left")
        .withColumn(output, F.coalesce("_kept", F.lit(OTHER)))
        .drop("_kept")
    )


def category_index(df: DataFrame, features: list[str] = GAM_CATEGORICAL) -> DataFrame:
    """Sorted distinct values of every feature with a 0-based index, in long form.

    One scan: the features are unpivoted and made distinct map-side, so only the
    vocabularies are shuffled. Numeric features sort as numbers.
    """
    numeric = {f.name for f in df.schema.fields if f.dataType.typeName() not in ("string",)}
    entries = [
        F.struct(
            F.lit(name).alias("feature"),
            F.col(name).cast("string").alias("value"),
            (F.col(name).cast("double") if name in numeric else F.lit(None).cast("double")).alias(
                "_order"
            ),
        )
        for name in features
    ]
    in_order = Window.partitionBy("feature").orderBy("_order", "value")
    return (
        df.select(F.inline(F.array(*entries)))
        .filter(F.col("value").isNotNull())
        .distinct()
        .withColumn("idx", F.row_number().over(in_order) - 1)
        .select("feature", "value", "idx")
    )


def frequency_indexer(features: list[str] = TREE_CATEGORICAL) -> StringIndexer:
    """Most frequent value first, ties alphabetical, unseen and NULL in an extra bucket."""
    return StringIndexer(
        inputCols=features,
        outputCols=[f"{c}_idx" for c in features],
        stringOrderType="frequencyDesc",
        handleInvalid="keep",
    )


def tree_pipeline(
    numeric: list[str] = TREE_NUMERIC, categorical: list[str] = TREE_CATEGORICAL
) -> Pipeline:
    """Index the categories and assemble the slots: numbers first, then indexes."""
    inputs = [*numeric, *[f"{c}_idx" for c in categorical]]
    return Pipeline(
        stages=[
            frequency_indexer(categorical),
            VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="error"),
        ]
    )


def onehot_stages(features: list[str] = GAM_CATEGORICAL) -> list:
    """Sorted one-hot blocks; an unseen or NULL category is the zero block."""
    indexed = [f"{c}_sorted" for c in features]
    return [
        StringIndexer(
            inputCols=features,
            outputCols=indexed,
            stringOrderType="alphabetAsc",
            handleInvalid="keep",
        ),
        OneHotEncoder(
            inputCols=indexed, outputCols=[f"{c}_hot" for c in features], dropLast=True
        ),
    ]


def onehot_long(encoded: DataFrame, features: list[str] = GAM_CATEGORICAL) -> DataFrame:
    """The hot slots of each row as ``(tx_id, feature, idx)``; a zero block has none."""
    hot = [
        F.struct(
            F.lit(c).alias("feature"),
            F.array_position(vector_to_array(f"{c}_hot"), F.lit(1.0)).alias("slot"),
        )
        for c in features
    ]
    return (
        encoded.select("tx_id", F.inline(F.array(*hot)))
        .filter(F.col("slot") > 0)
        .select("tx_id", "feature", (F.col("slot") - 1).cast("int").alias("idx"))
    )


def feature_names(encoded: DataFrame, column: str = "features") -> list[str]:
    """Slot names of an assembled vector, read from its column metadata."""
    groups = encoded.schema[column].metadata["ml_attr"]["attrs"].values()
    slots = sorted((a for group in groups for a in group), key=lambda a: a["idx"])
    return [a.get("name", str(a["idx"])) for a in slots]
