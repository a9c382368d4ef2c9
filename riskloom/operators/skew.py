"""Keeping hot keys out of single tasks, and broadcasts within a checked size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A group of this many narrow rows still sorts comfortably inside one task.
HOT_ROWS = 5_000_000
# About 100 MB of account rows; beyond it joins shuffle and AQE splits hot keys.
BROADCAST_ROWS = 1_000_000


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Whether a count proves the side small enough to broadcast.

    On a stored table the count reads file footers, no columns. A side that is not
    small is joined by a shuffle, its hot keys apart.
    """
    return df.count() <= max_rows


def hot_keys(df: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys with more than ``hot_rows`` rows: at most ``rows / hot_rows`` of them.

    Counted with map-side partial aggregation, so a hot key costs one row per task.
    """
    return df.groupBy(key).count().filter(F.col("count") > hot_rows).select(key)


def split_hot(
    df: DataFrame, key: str, hot_rows: int = HOT_ROWS
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(cold rows, hot rows, hot keys)``.

    The broadcast key list is bounded by ``rows / hot_rows``. When it turns out
    empty, adaptive execution removes the hot branch altogether.
    """
    hot = hot_keys(df, key, hot_rows)
    listed = F.broadcast(hot.select(F.col(key).alias("_hot_key")))
    same: Column = F.col(key).eqNullSafe(F.col("_hot_key"))
    return df.join(listed, same, "left_anti"), df.join(listed, same, "left_semi"), hot
