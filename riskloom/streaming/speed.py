"""The speed layer: decode, enrich, score, decide, persist, publish.

One function decides for a table and for a micro-batch alike; the stream adds only
progress tracking and output folders that a repeated micro-batch overwrites.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from riskloom.operators import facts
from riskloom.operators.enrich import ACCOUNT_COLUMNS, join_accounts
from riskloom.operators.score import add_model_features, decide_ge
from riskloom.operators.validate import VALID, parse_events
from riskloom.session import apart
from riskloom.sinks import writers

Scorer = Callable[[DataFrame], DataFrame]
NO_ACCOUNT = "no_account"
NO_SCORE = "no_score"
COUNTED = ["n_rows", "n_scored", "n_rejected", "n_flagged"]
METRICS = "batch long, n_rows long, n_scored long, n_rejected long, n_flagged long, last_ts long"


def decide_events(
    parsed: DataFrame,
    accounts: DataFrame,
    scorer: Scorer,
    threshold: float,
    inputs: Sequence[str] = (),
) -> DataFrame:
    """Every event with its decision, or with the ``reason`` it has none.

    ``parsed`` comes from :func:`parse_events`. Nothing is dropped: invalid events,
    events whose sender has no account and events without one of the scorer's
    ``inputs`` keep ``reason`` and a NULL decision. They pass through the scorer with
    zeros, so that one pass serves all and a strict scorer does not fail on them.
    """
    found = accounts.withColumn("_found", F.lit(True))
    joined = join_accounts(parsed, found, "left", [*ACCOUNT_COLUMNS, "_found"])
    featured = add_model_features(joined)
    incomplete = F.lit(False)
    for name in inputs:
        incomplete = incomplete | F.col(name).isNull()
    reason = (
        F.when(F.col("status") != VALID, F.col("status"))
        .when(F.col("_found").isNull(), NO_ACCOUNT)
        .when(incomplete, NO_SCORE)
    )
    ready = featured.withColumn("reason", reason).withColumns(
        {name: F.coalesce(F.col(name), F.lit(0.0)) for name in inputs}
    )
    failed = F.col("score").isNull() | F.isnan("score")
    scored = scorer(ready).withColumn(
        "reason", F.coalesce("reason", F.when(failed, NO_SCORE))
    )
    scored = scored.withColumn("score", F.when(F.col("reason").isNull(), F.col("score")))
    return facts.with_alert_id(decide_ge(scored, threshold)).drop("_found", "status")


def stage(
    decided: DataFrame, path: str, seen: Observation | None = None
) -> tuple[DataFrame, DataFrame]:
    """Fix decisions, ids and write time in one written table; read back ``(scored, rejected)``.

    ``seen`` observes the rows while they are written: the counts of ``COUNTED`` and the
    latest event time, without a second look at anything.
    """
    done = F.col("reason").isNull()
    if seen is not None:
        decided = apart(decided).observe(
            seen,
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(done).alias("n_scored"),
            F.count_if(~done).alias("n_rejected"),
            F.count_if(done & F.col("is_fraud")).alias("n_flagged"),
            F.max("ts").alias("last_ts"),
        )
    ready = facts.with_write_time(decided).withColumn(
        "outcome", F.when(F.col("reason").isNull(), "scored").otherwise("rejected")
    )
    ready.write.mode("overwrite").partitionBy("outcome").parquet(path)
    return staged(ready, path, "scored"), staged(ready, path, "rejected")


def staged(like: DataFrame, path: str, outcome: str) -> DataFrame:
    rows = like.sparkSession.read.schema(like.schema).parquet(path)
    return rows.filter(F.col("outcome") == outcome).drop("outcome")


def persist_staged(
    scored: DataFrame,
    rejected: DataFrame,
    out: str,
    suffix: str = "",
    mode: str = "overwrite",
    publish_to: dict | None = None,
) -> None:
    """Write all speed-layer outputs of one staged batch."""
    root = f"{out}/speed_layer"
    payload = facts.scored_payload(scored, F.col("tx_timestamp"))
    quarantine = rejected.select("tx_id", "value", "reason")
    writes = [
        *writers.fan_out(scored, out, "speed_layer", mode, suffix),
        lambda: writers.write_scored_json(payload, f"{root}/scored_json{suffix}", mode),
        lambda: quarantine.write.mode(mode).parquet(f"{root}/quarantine{suffix}"),
    ]
    writers.side_by_side(scored.sparkSession, writes)
    # results are announced once they are stored
    if publish_to is not None:
        writers.publish(payload, **publish_to)


def run_speed_layer(
    events: DataFrame,
    accounts: Callable[[], DataFrame],
    scorer: Scorer,
    threshold: float,
    out: str,
    checkpoint: str,
    ts_unit: str = "s",
    inputs: Sequence[str] = (),
    publish_to: dict | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start the stream. ``events`` has ``tx_id`` and ``value``, as from ``read_events``.

    Accounts are loaded anew for every micro-batch, so new ones count at once. A
    micro-batch is evaluated once, into its staged table; the outputs are projections
    of that. After a failure the same offsets overwrite the same folders. Published
    messages are repeated in that case and carry the same ids. What was observed of a
    micro-batch is a row of the ``metrics`` table.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        path = f"{out}/speed_layer/staged/batch_id={batch_id}"
        parsed = parse_events(batch, ts_unit=ts_unit)
        decided = decide_events(parsed, accounts(), scorer, threshold, inputs)
        seen = Observation("speed")
        scored, rejected = stage(decided, path, seen)
        counts = seen.get
        row = (batch_id, *[counts[c] for c in [*COUNTED, "last_ts"]])
        batch.sparkSession.createDataFrame([row], METRICS).write.mode("overwrite").parquet(
            f"{out}/speed_layer/metrics/batch_id={batch_id}"
        )
        persist_staged(scored, rejected, out, f"/batch_id={batch_id}", publish_to=publish_to)

    return (
        events.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "5 seconds"}))
        .start()
    )


def throughput(query: StreamingQuery) -> dict[str, float]:
    """Rows, busy seconds, rows per second and mean seconds per row of a query so far."""
    busy = [p for p in query.recentProgress if p.numInputRows > 0]
    rows = sum(p.numInputRows for p in busy)
    seconds = sum(p.durationMs.get("triggerExecution", 0) for p in busy) / 1000
    return {
        "rows": rows,
        "seconds": seconds,
        "rows_per_second": rows / seconds if seconds else 0.0,
        "seconds_per_row": seconds / rows if rows else 0.0,
    }
