"""Writers: serving tables, JSON, CSV, result topic and fitted artefacts."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from riskloom.operators import facts
from riskloom.schemas import (
    ACCOUNT_BUCKETS,
    ACCOUNT_KEY,
    BUCKET,
    CLUSTERING,
    LAYERS,
    partition_field,
    stored_schema,
)
from riskloom.session import listed, remove, scratch_dir

BATCH_FILE_ROWS = 1_000_000
FACTS = ["transactions", "transactions_by_sender", "transactions_by_receiver", "alerts"]
STARTED, DONE = "started", "done"
RUN = "run string, state string, at timestamp, days array<string>, whole boolean"


def create_tables(spark: SparkSession, warehouse: str, layers: dict = LAYERS) -> list[str]:
    """Declare every serving table of both layers as external Parquet tables.

    Tables are declared with the folders they are written in: micro-batches of the speed
    layer, days of the batch layer, key buckets of accounts. Folders that are there are known at once, those
    of later writes after :func:`recover_tables`.
    """
    made = []
    for layer, tables in layers.items():
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
        for name, schema in tables.items():
            columns = ", ".join(
                f"{f.name} {f.dataType.simpleString()}" for f in stored_schema(layer, name).fields
            )
            folders = f"PARTITIONED BY ({partition_field(layer, name).name}) "
            spark.sql(
                f"CREATE TABLE IF NOT EXISTS {layer}.{name} ({columns}) USING parquet {folders}"
                f"LOCATION '{warehouse}/{layer}/{name}'"
            )
            made.append(f"{layer}.{name}")
    recover_tables(spark, warehouse, layers)
    return made


def recover_tables(spark: SparkSession, warehouse: str, layers: dict = LAYERS) -> None:
    """Let declared tables know the folders that were written since."""
    for layer, tables in layers.items():
        for name in tables:
            if listed(spark, f"{warehouse}/{layer}/{name}"):
                spark.sql(f"ALTER TABLE {layer}.{name} RECOVER PARTITIONS")
            spark.catalog.refreshTable(f"{layer}.{name}")


def clustered(df: DataFrame, table: str) -> DataFrame:
    """Order rows by the table's key and clustering columns.

    Range partitioning on the whole key, not a hash of its first column, lets a hot
    sender span several files; each file covers a narrow key range, so reads of one
    sender skip the others by their statistics.
    """
    order = [F.col(facts.DAY)] if facts.DAY in df.columns else []
    order += [
        F.col(c[1:]).desc() if c.startswith("-") else F.col(c).asc() for c in CLUSTERING[table]
    ]
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def write_table(
    df: DataFrame,
    path: str,
    table: str,
    mode: str = "append",
    format: str = "parquet",
    whole: bool = False,
) -> None:
    """Rows with a day go to its ``dt=`` folder; ``overwrite`` then replaces only the
    folders of the days that are written, or, with ``whole``, the table."""
    by_day(clustered(df, table), mode, whole).format(format).save(path)


def by_day(df: DataFrame, mode: str, whole: bool = False) -> DataFrameWriter:
    writer = df.write.mode(mode)
    if facts.DAY not in df.columns:
        return writer
    replaced = "static" if whole else "dynamic"
    return writer.option("partitionOverwriteMode", replaced).partitionBy(facts.DAY)


def write_accounts(accounts: DataFrame, warehouse: str, replace: bool = False) -> dict[str, int]:
    """Put accounts into both layers, keyed by account and customer; rows now stored per layer.

    A row replaces the stored one of its key, and of rows with one key the last of the input
    stays. Keys are dealt to ``ACCOUNT_BUCKETS`` folders by a hash of the account: only the
    folders of incoming keys are read, merged and rewritten, the files of others stay. With
    ``replace`` the tables hold the incoming rows alone. The merged rows are staged before
    they go to the tables, so a repeated import changes nothing. NULL keys are keys too.

    Counted from the written files' footers.
    """
    spark, stored = accounts.sparkSession, {}
    names = accounts.columns
    bucket = F.pmod(F.xxhash64(ACCOUNT_KEY[0]), F.lit(ACCOUNT_BUCKETS)).cast("int")
    # the last row of each key, folded on the map side
    last = F.max_by(F.struct(*names), F.col("_nth")).alias("_row")
    incoming = accounts.withColumn("_nth", F.monotonically_increasing_id())
    incoming = incoming.groupBy(*ACCOUNT_KEY).agg(last).select("_row.*").withColumn(BUCKET, bucket)
    staged = scratch_dir(spark, "accounts")
    incoming.write.parquet(f"{staged}/in")
    incoming = spark.read.schema(incoming.schema).parquet(f"{staged}/in")
    # at most one row a bucket
    touched = [r[0] for r in incoming.select(BUCKET).distinct().collect()]
    for layer in LAYERS:
        path = f"{warehouse}/{layer}/accounts"
        merged, there = incoming, listed(spark, path)
        if any(not n.startswith((f"{BUCKET}=", "_", ".")) for n in there):
            raise ValueError(f"{path} has files outside its {BUCKET}= folders: import them anew")
        if there and not replace:
            old = spark.read.schema(incoming.schema).parquet(path)
            same = [F.col(f"o.{k}").eqNullSafe(F.col(f"i.{k}")) for k in ACCOUNT_KEY]
            kept = old.filter(F.col(BUCKET).isin(touched)).alias("o").join(
                incoming.select(*ACCOUNT_KEY).alias("i"), same, "left_anti"
            )
            merged = incoming.unionByName(kept.select(incoming.columns))
        merged.write.parquet(f"{staged}/{layer}")
        rows = spark.read.schema(incoming.schema).parquet(f"{staged}/{layer}")
        rows.repartition(BUCKET).sortWithinPartitions(BUCKET, *CLUSTERING["accounts"]).write.mode(
            "overwrite"
        ).option("partitionOverwriteMode", "static" if replace else "dynamic").partitionBy(
            BUCKET
        ).parquet(path)
        stored[layer] = spark.read.schema(incoming.schema).parquet(path).count()
    remove(spark, staged)
    return stored


def side_by_side(spark: SparkSession, writes: list[Callable[[], None]]) -> None:
    """Run independent writes at once; one small write leaves most executors idle."""
    with ThreadPoolExecutor(len(writes)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(write)) for write in writes]
        for write in running:
            write.result()


def fan_out(
    staged: DataFrame,
    warehouse: str,
    layer: str,
    mode: str = "append",
    suffix: str = "",
    whole: bool = False,
) -> list[Callable[[], None]]:
    """The writes of a layer's three transaction tables and its alerts.

    ``staged`` should be read back from storage (decisions, ids and write time
    already fixed), so that the four tables agree and a lost executor re-reads files
    instead of scoring again.
    """
    root = f"{warehouse}/{layer}"
    outputs = {
        "transactions": facts.tx_fact(staged),
        "transactions_by_sender": facts.tx_by_sender(staged),
        "transactions_by_receiver": facts.tx_by_receiver(staged),
        "alerts": facts.alerts(staged),
    }
    return [
        partial(write_table, rows, f"{root}/{table}{suffix}", table, mode, whole=whole)
        for table, rows in outputs.items()
    ]


def write_fan_out(
    staged: DataFrame, warehouse: str, layer: str, mode: str = "append", suffix: str = ""
) -> None:
    side_by_side(staged.sparkSession, fan_out(staged, warehouse, layer, mode, suffix))


def write_scored_json(payload: DataFrame, path: str, mode: str = "append") -> None:
    """Result records as JSON lines in ``dt=`` folders of the prediction date."""
    day = F.substring("prediction_timestamp", 1, 10)
    (
        payload.withColumn("dt", day)
        .write.mode(mode)
        .option("ignoreNullFields", "false")
        .partitionBy("dt")
        .json(path)
    )


def write_batch_json(
    results: DataFrame,
    path: str,
    rows_per_file: int = BATCH_FILE_ROWS,
    mode: str = "append",
    whole: bool = False,
) -> None:
    """Batch results, at most ``rows_per_file`` to a file."""
    by_day(results, mode, whole).option("maxRecordsPerFile", rows_per_file).json(path)


# --- runs of the batch layer ----------------------------------------------


def refuse_flat(spark: SparkSession, warehouse: str, tables: list[str] = FACTS) -> None:
    """Fail where a batch table has files beside its ``dt=`` folders: Spark would not read
    them any more, or, without folders, would read them without a day."""
    for table in tables:
        path = f"{warehouse}/batch_layer/{table}"
        flat = [n for n in listed(spark, path) if not n.startswith((f"{facts.DAY}=", "_", "."))]
        if flat:
            raise ValueError(
                f"{path} has files outside its {facts.DAY}= folders, such as {flat[0]}: move them"
            )


def note_run(
    spark: SparkSession, warehouse: str, run: str, state: str, days: list[str], whole: bool
) -> None:
    """One row more in the manifest of runs."""
    row = spark.createDataFrame([(run, state, None, days, whole)], RUN)
    row.withColumn("at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(
        f"{warehouse}/batch_layer/_runs"
    )


def unfinished_runs(spark: SparkSession, warehouse: str) -> list:
    """Runs whose rows are staged but whose tables may not all be replaced, oldest first."""
    path = f"{warehouse}/batch_layer/_runs"
    if not listed(spark, path):
        return []
    notes = spark.read.schema(RUN).parquet(path)
    done = notes.filter(F.col("state") == DONE).select("run")
    return notes.filter(F.col("state") == STARTED).join(done, "run", "left_anti").orderBy("at").collect()


def drop_days(
    spark: SparkSession, rows: DataFrame, path: str, days: list[str]
) -> None:
    """Remove the folders of days that a run scored without a row for this table."""
    found = {r[0] for r in rows.select(F.col(facts.DAY).cast("string")).distinct().collect()}
    for day in days:
        if day not in found:
            remove(spark, f"{path}/{facts.DAY}={day}")


def write_predictions_csv(payload: DataFrame, path: str, mode: str = "append") -> None:
    """Flattened result records; every part file carries the header."""
    facts.dotted(payload).write.mode(mode).option("header", True).csv(path)


def publish(payload: DataFrame, format: str = "kafka", path: str | None = None, **options) -> None:
    """Send result records to a topic (or, for tests, to text files)."""
    messages = facts.payload_json(payload)
    if format == "kafka":
        options = {"topic": "results", **options}
        rows = messages.select(F.col("tx_id").alias("key"), "value")
        rows.write.format("kafka").options(**options).save()
    else:
        messages.select("value").write.format(format).mode("append").options(**options).save(path)


def write_features(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Feature vector, label and split of every training row."""
    kept = [c for c in ("tx_id", "features", "label", "weight", "split") if c in df.columns]
    df.select(*kept).write.mode(mode).parquet(path)
