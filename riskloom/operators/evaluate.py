"""Counts, metrics and thresholds, each from one aggregated pass over the scores."""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.session import scratch_dir

FP_COST = 3
DEFAULT_THRESHOLD = 0.5
GRID = (0.05, 0.95, 200)


def label_counts(df: DataFrame, label: str = "label") -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def fraud_rate(df: DataFrame, label: str = "label") -> DataFrame:
    return df.agg(F.avg(label).alias("fraud_rate"))


def confusion(df: DataFrame, label: str = "label", predicted: str = "is_fraud") -> DataFrame:
    """One row ``tp, fp, fn, tn, unjudged``; they add up to the rows of ``df``.

    ``unjudged`` counts rows without a label or without a decision.
    """
    hit, flagged = F.col(label) == 1, F.col(predicted)
    return df.agg(
        F.count_if(hit & flagged).alias("tp"),
        F.count_if(~hit & flagged).alias("fp"),
        F.count_if(hit & ~flagged).alias("fn"),
        F.count_if(~hit & ~flagged).alias("tn"),
        F.count_if(hit.isNull() | flagged.isNull()).alias("unjudged"),
    )


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))


def _metrics() -> dict[str, Column]:
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    fraud = _ratio(2 * tp, 2 * tp + fp + fn)
    legit = _ratio(2 * tn, 2 * tn + fp + fn)
    return {
        "precision": _ratio(tp, tp + fp),
        "recall": _ratio(tp, tp + fn),
        "f1_fraud": fraud,
        "f1_legit": legit,
        "f1_macro": (fraud + legit) / 2,
        "accuracy": _ratio(tp + tn, tp + fp + fn + tn),
        # ROC area of hard decisions: the mean of the two class recalls
        "auc": (_ratio(tp, tp + fn) + _ratio(tn, tn + fp)) / 2,
    }


def _metric_columns(*names: str) -> list[Column]:
    metrics = _metrics()
    return [metrics[name].alias(name) for name in names or metrics]


def class_metrics(counts: DataFrame) -> DataFrame:
    """Precision, recall, F1 per class and macro, accuracy. Zero division gives 0."""
    return counts.select(
        *_metric_columns("precision", "recall", "f1_fraud", "f1_legit", "f1_macro", "accuracy")
    )


def auc_hard(counts: DataFrame) -> DataFrame:
    return counts.select(*_metric_columns("auc"))


def evaluation_report(
    df: DataFrame, label: str = "label", predicted: str = "is_fraud"
) -> DataFrame:
    """Counts and every metric in one row, from one pass."""
    return confusion(df, label, predicted).select(
        "tp", "fp", "fn", "tn", "unjudged", *_metric_columns())


def cumulative_counts(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """``threshold, tp, fp, positives`` at every distinct score, decision ``>=``.

    A running total over all scores would sort everything in one task. Here one pass over
    the rows makes scores distinct with counts, summed on the map side, so that a score of
    a third of the rows is one row a task; these are range-partitioned by falling score and
    written once, each with its partition. Every partition then sums on its own, and the
    partition totals, one row a partition, supply what lies above it. Runs a job here: the
    result reads the written counts. A positive without a score is never reached, but counts
    among the positives.
    """
    by_score = df.groupBy(F.col(score).cast("double").alias("threshold")).agg(
        F.count_if(F.col(label) == 1).alias("_p"), F.count_if(F.col(label) == 0).alias("_q")
    )
    falling = F.desc_nulls_last("threshold")
    path = scratch_dir(df.sparkSession, "scores")
    by_score.repartitionByRange(falling).withColumn("_part", F.spark_partition_id()).write.parquet(
        path
    )
    counts = df.sparkSession.read.parquet(path)

    above = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy("_part").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    totals = (
        counts.groupBy("_part")
        .agg(F.sum("_p").alias("_tp"), F.sum("_q").alias("_tq"))
        .select(
            "_part",
            F.coalesce(F.sum("_tp").over(above), F.lit(0)).alias("_above_p"),
            F.coalesce(F.sum("_tq").over(above), F.lit(0)).alias("_above_q"),
            F.sum("_tp").over(every).alias("positives"),
        )
    )
    within = (
        Window.partitionBy("_part")
        .orderBy(F.desc("threshold"))
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        counts.filter("threshold IS NOT NULL")
        .withColumn("_in_p", F.sum("_p").over(within))
        .withColumn("_in_q", F.sum("_q").over(within))
        .join(F.broadcast(totals), "_part")
        .select(
            "threshold",
            (F.col("_above_p") + F.col("_in_p")).alias("tp"),
            (F.col("_above_q") + F.col("_in_q")).alias("fp"),
            "positives",
        )
    )


def pr_curve(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """Precision and recall at every distinct score; recall is 1 without positives, and
    precision 0 where only rows without a label are reached."""
    tp, fp, p = F.col("tp"), F.col("fp"), F.col("positives")
    return cumulative_counts(df, score, label).select(
        "threshold",
        "tp",
        "fp",
        _ratio(tp, tp + fp).alias("precision"),
        F.when(p > 0, tp / p).otherwise(F.lit(1.0)).alias("recall"),
    )


def cost_threshold(
    df: DataFrame,
    score: str = "score",
    label: str = "label",
    fp_cost: int = FP_COST,
    free_without_hits: bool = True,
) -> DataFrame:
    """The threshold with the least ``fp_cost * FP + FN``; the lowest one on a tie.

    ``free_without_hits`` counts no false positives while no positive is reached.
    """
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("positives") - F.col("tp")
    cost = fp * fp_cost + fn
    if free_without_hits:
        cost = F.when(tp == 0, fn).otherwise(cost)
    return (
        cumulative_counts(df, score, label)
        .select("threshold", "tp", "fp", cost.alias("cost"))
        .orderBy("cost", "threshold")
        .limit(1)
    )


def f1_threshold(
    df: DataFrame,
    score: str = "score",
    label: str = "label",
    grid: tuple[float, float, int] = GRID,
) -> DataFrame:
    """The grid threshold with the best F1 of ``score > t``; the lowest one on a tie.

    Each score is placed in its grid cell once, so the work is one aggregation to at
    most ``points + 1`` rows, not one comparison per row and grid point.
    """
    low, high, points = grid
    step = (high - low) / (points - 1)
    grid_values = [low + i * step for i in range(points - 1)] + [high]
    # cells of -score are closed below, so a score equal to t falls short of t
    splits = [float("-inf"), *sorted(-t for t in grid_values), float("inf")]
    # a positive without a score is below every threshold
    placed = df.withColumn("_neg", F.coalesce(-F.col(score), F.lit(float("inf"))))
    cells = (
        Bucketizer(splits=splits, inputCol="_neg", outputCol="_cell")
        .transform(placed)
        .groupBy("_cell")
        .agg(F.count_if(F.col(label) == 1).alias("_p"), F.count(F.lit(1)).alias("_n"))
    )
    # cell c holds scores above grid value number points - 1 - c
    by_value = cells.select(
        (F.lit(points - 1) - F.col("_cell")).cast("long").alias("i"), "_p", "_n"
    )
    value = F.when(F.col("i") == points - 1, F.lit(high)).otherwise(
        F.lit(low) + F.col("i") * F.lit(step)
    )
    every = Window.orderBy("i").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    from_top = Window.orderBy(F.desc("i")).rowsBetween(Window.unboundedPreceding, 0)
    flagged, hits = F.coalesce("_n", F.lit(0)), F.coalesce("_p", F.lit(0))
    counted = (
        df.sparkSession.range(-1, points)
        .select(F.col("id").alias("i"))
        .join(F.broadcast(by_value), "i", "left")
        .withColumn("threshold", value)
        .withColumn("_positives", F.sum(hits).over(every))
        .withColumn("_tp", F.sum(hits).over(from_top))
        .withColumn("_flagged", F.sum(flagged).over(from_top))
    )
    f1 = _ratio(2.0 * F.col("_tp"), F.col("_positives") + F.col("_flagged"))
    return (
        counted.filter(F.col("i") >= 0)
        .select("threshold", f1.alias("f1"))
        .orderBy(F.desc("f1"), "threshold")
        .limit(1)
        .withColumn(
            "threshold", F.when(F.col("f1") > 0, F.col("threshold")).otherwise(DEFAULT_THRESHOLD)
        )
    )


def layer_compare(
    df: DataFrame, speed: str = "is_fraud_speed", batch: str = "is_fraud_batch"
) -> DataFrame:
    """Cross-tabulation of the two layers' decisions."""
    return df.groupBy(speed, batch).agg(F.count(F.lit(1)).alias("n"))
