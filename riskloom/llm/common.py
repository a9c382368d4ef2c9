"""What the text operators share: session settings, landed tables, word rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.session import scratch_dir, tune

# words are runs of anything but ASCII white space
BLANK = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# shuffle files go when the execution that made them ends
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# rows of one Arrow batch; texts are long
BATCH_ROWS = 1000


def session(spark: SparkSession) -> SparkSession:
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return session(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def land(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage, so that later passes neither recompute the rows nor depend on
    shuffle files of executors that may be lost. Those of the write are deleted with it, or
    the shuffles of a whole job would stay on disk until the driver collects its garbage.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is.

    ``lower`` is the fast way and equal for pure ASCII; ``translate`` serves the rest.
    """
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words(text: Column) -> Column:
    """The white-space separated words of a text; none for NULL."""
    found = F.split(F.coalesce(text, F.lit("")), BLANK)
    return F.filter(found, lambda w: w != "")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once for a row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def schema_with(df: DataFrame, added: str) -> T.StructType:
    """The schema of ``df`` and more fields, given as DDL."""
    return T.StructType([*df.schema.fields, *T.StructType.fromDDL(added).fields])


def fresh(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with as many underscores more as no column of ``df`` has them."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def keep_where(df: DataFrame, condition: Column) -> DataFrame:
    """The rows where ``condition`` holds, evaluated above the columns it uses.

    A filter on computed columns is otherwise pushed below them, and each of its mentions
    of a column becomes one more evaluation of what made it.
    """
    (name,) = fresh(df, "_here")
    here = df.withColumn(name, F.monotonically_increasing_id())
    return here.filter(condition & (F.col(name) >= 0)).drop(name)
