"""Splits, subsampling and class weights: all fixed by a hash of the row's id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions import hash32, hash_fraction

POS_WEIGHT = 10.0
MAX_TRAIN_ROWS = 1_058_587
GAM_SEED = 42
TREE_SEED = 1212
# hash prefixes used to find an exact sample size without a global sort


def hash_split(
    df: DataFrame, parts: dict[str, float], seed: int, key: str = "tx_id", output: str = "split"
) -> DataFrame:
    """Assign each row to a named part. No shuffle; the same row always lands alike.

    The hash ignores the label, so every class is cut in the same proportions.
    """
    draw = hash_fraction(key, seed)
    edge, chain, names = 0.0, None, list(parts)
    for name in names[:-1]:
        edge += parts[name]
        test = draw < F.lit(round(edge, 12))
        chain = F.when(test, name) if chain is None else chain.when(test, name)
    last = F.lit(names[-1])
    return df.withColumn(output, last if chain is None else chain.otherwise(last))


def split_80_20(df: DataFrame, key: str = "tx_id") -> DataFrame:
    return hash_split(df, {"train": 0.8, "val": 0.2}, GAM_SEED, key)


def split_90_5_5(df: DataFrame, key: str = "tx_id") -> DataFrame:
    return hash_split(df, {"train": 0.9, "dev": 0.05, "test": 0.05}, TREE_SEED, key)


def subsample(
    df: DataFrame,
    max_rows: int = MAX_TRAIN_ROWS,
    label: str = "label",
    key: str = "tx_id",
    seed: int = GAM_SEED,
) -> DataFrame:
    """All positives, and exactly enough negatives (lowest hashes) to reach ``max_rows``."""
    return _take(df, F.col(label) == 1, F.col(label) == 0, max_rows, key, seed)


def take_by_hash(df: DataFrame, n: int, key: str = "tx_id", seed: int = GAM_SEED) -> DataFrame:
    """Exactly ``n`` rows (or all, if fewer), those with the lowest hashes."""
    return _take(df, F.lit(False), F.lit(True), n, key, seed)


def _take(
    df: DataFrame, always: Column, eligible: Column, max_rows: int, key: str, seed: int
) -> DataFrame:
    """Rows of ``always``, and the first ``eligible`` ones until there are ``max_rows``.

    No global sort: a histogram of hash prefixes, at most 65,536 rows, shows which
    prefixes are taken whole and which single one is cut. Only that one is ranked, and
    being a hash prefix it holds about 1/65,536 of the rows.
    """
    keyed = df.withColumn("_h", hash32(key, seed)).withColumn("_b", F.shiftright("_h", 16))
    histogram = keyed.groupBy("_b").agg(
        F.count_if(always).alias("_kept"), F.count_if(eligible).alias("_n")
    )
    everything = Window.orderBy("_b").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    room = F.greatest(F.lit(max_rows) - F.sum("_kept").over(everything), F.lit(0))
    left = F.greatest(room - F.coalesce(F.sum("_n").over(before), F.lit(0)), F.lit(0))
    quota = histogram.select("_b", "_n", F.least(F.col("_n"), left).alias("_take"))
    rows = keyed.join(F.broadcast(quota), "_b")
    whole = rows.filter(always | (eligible & (F.col("_take") == F.col("_n"))))
    rank = F.row_number().over(Window.partitionBy("_b").orderBy("_h", key))
    cut = (
        rows.filter(eligible & (F.col("_take") > 0) & (F.col("_take") < F.col("_n")))
        .withColumn("_rank", rank)
        .filter(F.col("_rank") <= F.col("_take"))
    )
    return whole.select(*df.columns).unionByName(cut.select(*df.columns))


def sample_weights(
    df: DataFrame, label: str = "label", positive: float = POS_WEIGHT, output: str = "weight"
) -> DataFrame:
    return df.withColumn(output, F.when(F.col(label) == 1, positive).otherwise(1.0))
