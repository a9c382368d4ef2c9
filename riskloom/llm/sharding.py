"""Contiguous shards of nearly equal bytes, by global prefix sums.

Rows are range-partitioned in a total order and landed; the sums of the partitions (as
many rows as there are partitions) give each its global offset, a window inside each
partition gives the rest. Shard ``k`` holds the rows that start in the ``k``-th of equal
cuts of all bytes, so a shard misses its target by less than one row at either end.

NULL texts count as no bytes; NULL ids come first. Repeated rows are told apart by their
place in the scan, so one key with a third of all rows still spreads over partitions.
Columns of the input with the names of result columns are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskloom.llm.common import land, shuffle_partitions

SHARDS = 8


def text_size(text: Column) -> Column:
    """UTF-8 bytes of a text and one for its separator."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def text_crc32(text: Column) -> Column:
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def balanced_shards(
    df: DataFrame, size: str, order: Sequence[str], shards: int = SHARDS
) -> DataFrame:
    """Add ``shard`` (int, from 0) and ``slot`` (long, gapless from 0 in its shard).

    ``size`` is a column of positive longs. Runs one job: the ordered rows are landed.
    """
    spark = df.sparkSession
    base = df.drop("shard", "slot").withColumn("_src", F.monotonically_increasing_id())
    ranged = base.repartitionByRange(shuffle_partitions(spark), *order, "_src")
    ordered = land(ranged.withColumn("_part", F.spark_partition_id()), "shards")

    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy()
    # one row a partition: bounded by the number of shuffle partitions
    offsets = (
        ordered.groupBy("_part")
        .agg(F.sum(size).alias("_bytes"))
        .select(
            "_part",
            F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_offset"),
            F.sum("_bytes").over(everything).alias("_total"),
        )
    )
    inside = W.partitionBy("_part").orderBy(*order, "_src")
    upto = inside.rowsBetween(W.unboundedPreceding, W.currentRow)
    start = F.col("_offset") + F.sum(size).over(upto) - F.col(size)
    cut = F.floor(start * shards / F.col("_total")).cast("int")
    placed = (
        ordered.join(F.broadcast(offsets), "_part")
        .withColumn("shard", F.least(cut, F.lit(shards - 1)))
        .drop("_offset", "_total")
    )
    # rows of a shard in the partitions before: at most partitions + shards rows
    earlier = W.partitionBy("shard").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    counts = (
        placed.groupBy("shard", "_part")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("shard", "_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_skip"))
    )
    rank = W.partitionBy("_part", "shard").orderBy(*order, "_src")
    return (
        placed.join(F.broadcast(counts), ["shard", "_part"])
        .withColumn("slot", F.col("_skip") + F.row_number().over(rank) - 1)
        .drop("_src", "_part", "_skip")
    )


def shard_table(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Where every document goes: doc_id, size, text_crc32, shard, slot; no text is moved."""
    sized = docs.select(
        "doc_id",
        text_size(F.col("text")).alias("size"),
        text_crc32(F.col("text")).alias("text_crc32"),
    )
    return balanced_shards(sized, "size", ["doc_id", "text_crc32", "size"], shards)


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """Write all columns of ``docs`` below ``path``, a folder a shard, ordered by slot."""
    sized = docs.withColumn("_size", text_size(F.col("text")))
    placed = balanced_shards(sized, "_size", ["doc_id", "_size"], shards).drop("_size")
    n = max(shards, shuffle_partitions(docs.sparkSession))
    placed.repartitionByRange(n, "shard", "slot").sortWithinPartitions("shard", "slot").write.mode(
        "overwrite"
    ).partitionBy("shard").parquet(path)
