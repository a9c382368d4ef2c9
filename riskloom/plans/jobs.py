"""Whole jobs, wired from operators: account import, backfill, batch scoring."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from riskloom.functions import uuid_from
from riskloom.operators import facts
from riskloom.operators.enrich import BATCH_ACCOUNT_COLUMNS, join_accounts
from riskloom.operators.score import BATCH_THRESHOLD, add_model_features, decide_gt, require
from riskloom.operators.skew import is_small
from riskloom.operators.windows import FEATURES, add_behavioral_features
from riskloom.schemas import TREE_CATEGORICAL, TREE_NUMERIC
from riskloom.session import remove, scratch_dir
from riskloom.sinks import writers
from riskloom.sources import readers
from riskloom.streaming import speed


def import_accounts(spark: SparkSession, csv_path: str, warehouse: str) -> dict[str, int]:
    """Load the account CSV into both layers; rows written per layer."""
    rows = facts.import_accounts(readers.read_accounts_csv(spark, csv_path))
    return writers.write_accounts(rows, warehouse)


def backfill(
    spark: SparkSession,
    csv_path: str,
    accounts: DataFrame,
    scorer: speed.Scorer,
    threshold: float,
    out: str,
    ts_unit: str = "s",
    inputs: Sequence[str] = (),
) -> dict[str, float]:
    """Score a transaction file with the streaming rules; returns the throughput.

    Ids follow the position in the scan, so a retried task repeats them; they are fixed
    for good in the staged table, but another split size gives other ids. Every output
    goes to the folder of this batch and replaces it, so a second run changes nothing.
    """
    start = time.time()
    rows = readers.read_transactions_csv(spark, csv_path, labelled=False, ts_unit=ts_unit)
    parsed = rows.withColumn(
        "tx_id", uuid_from(F.lit(csv_path), F.monotonically_increasing_id())
    ).withColumnRenamed("raw", "value")
    path = f"{out}/speed_layer/staged/batch_id=backfill"
    decided = speed.decide_events(parsed, accounts, scorer, threshold, inputs)
    seen = Observation("backfill")
    scored, rejected = speed.stage(decided, path, seen)
    speed.persist_staged(scored, rejected, out, "/batch_id=backfill", mode="overwrite")
    writers.write_predictions_csv(
        facts.scored_payload(scored, F.col("tx_timestamp")),
        f"{out}/predictions_csv/batch_id=backfill",
        "overwrite",
    )
    seconds = time.time() - start
    total = seen.get["n_rows"]
    return {"rows": total, "seconds": seconds, "rows_per_second": total / seconds}


def batch_features(
    flat: DataFrame,
    accounts: DataFrame,
    on_missing: str = "quarantine",
    since: str | None = None,
    as_of_day: bool | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``(usable, rejected)``: enriched transactions with all eleven model inputs.

    Windows see every transaction of a sender, before any row is set aside, and come
    before the join: they need no account. Rejected rows carry no window features, so
    finding them costs no shuffle; ``reasons`` lists the inputs they lack.

    With ``since``, only rows of that day (column ``dt``) and later come out; the rows
    before it are history for the windows, and of that only the senders that come out.
    With ``as_of_day`` mean and deviation are those known on the row's own day, otherwise
    they cover the whole history; the former is the default where ``since`` is given.
    """
    as_of = facts.DAY if (since is not None if as_of_day is None else as_of_day) else None
    if since is not None:
        fresh = F.col(facts.DAY) >= since
        senders = flat.filter(fresh).select(F.col("sender_account_id").alias("_s")).distinct()
        same = F.col("sender_account_id").eqNullSafe(F.col("_s"))
        history = flat.filter(~fresh).join(senders, same, "left_semi")
        featured = add_behavioral_features(
            history.unionByName(flat.filter(fresh)), as_of=as_of
        ).filter(fresh)
        flat = flat.filter(fresh)
    else:
        featured = add_behavioral_features(flat, as_of=as_of)
    small = is_small(accounts)

    def checked(rows: DataFrame):
        enriched = join_accounts(rows, accounts, "left", BATCH_ACCOUNT_COLUMNS, small=small)
        # window features are never NULL where the amount is present
        needed = [c for c in [*TREE_NUMERIC, *TREE_CATEGORICAL] if c not in FEATURES]
        return require(add_model_features(enriched), needed, on_missing)

    usable, _ = checked(featured)
    _, rejected = checked(flat)
    return usable, rejected


def first_day_touched(flat: DataFrame, since: str) -> str | None:
    """The earliest day before ``since`` with a row whose windows change by later folders.

    An event that arrives in a folder of ``since`` or later, but is no younger than an
    earlier folder's event of its sender, is late: that event's gap and count are others
    now. Folded to one row a sender before the join; one row comes to the driver.
    """
    fresh = F.col(facts.DAY) >= since
    late = flat.filter(fresh).groupBy(F.col("sender_account_id").alias("_s")).agg(
        F.min("ts").alias("_first")
    )
    same = F.col("sender_account_id").eqNullSafe(F.col("_s"))
    touched = flat.filter(~fresh).join(late, same).filter(F.col("ts") >= F.col("_first"))
    return touched.agg(F.min(facts.DAY)).first()[0]


def batch_scoring(
    spark: SparkSession,
    scored_json: str,
    accounts: DataFrame,
    scorer: speed.Scorer,
    out: str,
    threshold: float = BATCH_THRESHOLD,
    on_missing: str = "quarantine",
    since: str | None = None,
    rows_per_file: int = writers.BATCH_FILE_ROWS,
    as_of_day: bool | None = None,
    late: str = "rescore",
) -> None:
    """Re-score the speed layer's records with the batch model and write its tables.

    The JSON is read once, into a Parquet table in the shared scratch folder: the
    window features read their input more than once. ``scorer`` adds ``score`` of its
    own as ``fraud_probability``; the speed score stays a feature.

    All tables are written in ``dt=`` folders: the folder of the record, or, outside such
    folders, the day of its prediction. A run without ``since`` replaces the tables. With
    ``since`` (a day) it is incremental: all records are read for the windows, but only that
    day and later ones are scored, and only their folders are replaced. Events that arrive
    late, that is, below the time of an earlier folder's event of their sender, would leave
    that event with old windows: ``late="rescore"`` starts from its day instead, ``"error"``
    fails. With ``as_of_day`` (the default with ``since``) mean and deviation are those known
    on a row's day; then a full run, daily runs and repeated days all give the same tables.

    A run is noted in a manifest once its rows are staged, and again when every table has
    been replaced. The next run first finishes one that was cut off in between.
    """
    if late not in ("rescore", "error"):
        raise ValueError(f"unknown policy {late!r}")
    writers.refuse_flat(spark, out)
    finish_runs(spark, out, rows_per_file)
    landed = scratch_dir(spark, "flattened")
    records = readers.read_scored_json(spark, scored_json, day=True)
    day = F.coalesce(F.col(facts.DAY), F.substring("prediction_timestamp", 1, 10))
    flat = facts.as_transactions(facts.flatten_scored(records.withColumn(facts.DAY, day)))
    flat.write.mode("overwrite").parquet(landed)
    flat = spark.read.parquet(landed)
    if since is not None:
        first = first_day_touched(flat, since)
        if first is not None and late == "error":
            raise ValueError(f"late events change rows from {first} on; since is {since}")
        since = min(since, first or since)

    usable, rejected = batch_features(flat, accounts, on_missing, since, as_of_day)
    decided = decide_gt(scorer(usable), threshold, "fraud_probability")
    ready = facts.with_write_time(facts.with_alert_id(facts.as_batch_rows(decided)))
    run = uuid.uuid4().hex
    staged = f"{out}/batch_layer/staged/run={run}"
    ready.write.parquet(f"{staged}/scored")
    rejected.write.parquet(f"{staged}/rejected")
    scored_days = flat if since is None else flat.filter(F.col(facts.DAY) >= since)
    # one row a day
    days = sorted(r[0] for r in scored_days.select(facts.DAY).distinct().collect() if r[0])
    writers.note_run(spark, out, run, writers.STARTED, days, since is None)
    finish_runs(spark, out, rows_per_file)
    remove(spark, landed)


def finish_runs(
    spark: SparkSession, out: str, rows_per_file: int = writers.BATCH_FILE_ROWS
) -> list[str]:
    """Replace the tables' days by the staged rows of runs that are not done, oldest first.

    Repeating this changes nothing, so a run that was cut off is simply finished.
    """
    root, finished = f"{out}/batch_layer", []
    for note in writers.unfinished_runs(spark, out):
        staged = f"{root}/staged/run={note['run']}"
        scored = spark.read.parquet(f"{staged}/scored")
        rejected = spark.read.parquet(f"{staged}/rejected")
        results = facts.batch_results(scored, F.col("tx_timestamp"))
        whole, days = note["whole"], note["days"]
        writes = [
            *writers.fan_out(scored, out, "batch_layer", "overwrite", whole=whole),
            lambda: writers.write_batch_json(
                results, f"{root}/results_json", rows_per_file, "overwrite", whole
            ),
            lambda: writers.by_day(rejected, "overwrite", whole).parquet(f"{root}/quarantine"),
        ]
        writers.side_by_side(spark, writes)
        if not whole:
            emptied = {t: scored for t in [*writers.FACTS, "results_json"]}
            emptied |= {"alerts": scored.filter("is_fraud"), "quarantine": rejected}
            for table, rows in emptied.items():
                writers.drop_days(spark, rows, f"{root}/{table}", days)
        writers.note_run(spark, out, note["run"], writers.DONE, days, whole)
        remove(spark, staged)
        finished.append(note["run"])
    return finished
