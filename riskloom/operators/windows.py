"""Behavioural features per sender: gap, 24-hour count, mean and deviation.

A sender with an ordinary history is served by one shuffle and one sort. A hot
sender (a payment hub may hold a third of all rows) must not land in one task, so
its history is first folded to one *tick* per second and cut into days:

* a tick group ``(sender, day)`` plus the day before holds at most 172,800 ticks,
* a day group ``(sender)`` holds one row per day of history,
* the results return to the rows by an equi-join on ``(sender, second)``, which
  the adaptive skew-join rule can split further.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from riskloom.functions import DAY, FIRST_TX_GAP
from riskloom.operators.skew import HOT_ROWS, split_hot

FEATURES = ["prev_ts", "time_since_last_tx", "cnt_last_24h", "sender_avg_amount", "sender_std_amount"]


def add_behavioral_features(
    df: DataFrame,
    sender: str = "sender_account_id",
    ts: str = "ts",
    amount: str = "tx_amount",
    tx_id: str = "tx_id",
    hot_rows: int = HOT_ROWS,
    as_of: str | None = None,
) -> DataFrame:
    """Add ``prev_ts, time_since_last_tx, cnt_last_24h, sender_avg_amount, sender_std_amount``.

    Equal timestamps are ordered by ``tx_id``; rows that share both follow each other.
    The count covers the trailing 24 hours including the row, its ties and the row exactly
    86,400 s earlier; it is 0 without a timestamp. Mean and sample deviation cover the
    sender's whole history, or, with ``as_of`` (a column such as a day), only the rows up
    to the row's own value of it, so that rows that come later change nothing.
    """
    cold, hot, _ = split_hot(df, sender, hot_rows)
    served = _by_window(cold, sender, ts, amount, tx_id, as_of).unionByName(
        _by_ticks(hot, sender, ts, amount, tx_id, as_of)
    )
    gap = F.coalesce(F.col(ts) - F.col("prev_ts"), F.lit(FIRST_TX_GAP).cast("long"))
    return served.withColumn("time_since_last_tx", gap).select(*df.columns, *FEATURES)


def _by_window(
    df: DataFrame, sender: str, ts: str, amount: str, tx_id: str, as_of: str | None
) -> DataFrame:
    whole = Window.partitionBy(sender)
    known = whole.orderBy(as_of) if as_of else whole  # up to the value, its ties included
    in_order = whole.orderBy(ts, tx_id)
    # one exchange and one sort by (sender, ts, tx_id) serve all windows
    return (
        df.withColumn("prev_ts", F.lag(ts).over(in_order))
        .withColumn("cnt_last_24h", _trailing_day(F.count(F.lit(1)), whole.orderBy(ts)))
        .withColumn("sender_avg_amount", F.avg(amount).over(known))
        .withColumn("sender_std_amount", F.stddev_samp(amount).over(known))
    )


def _trailing_day(total: Column, by_time: WindowSpec) -> Column:
    """A total over the last 24 hours, as the difference of two growing frames.

    A sliding frame is summed anew for every row, which is quadratic for a sender with
    many rows a day; frames that start at the beginning are extended row by row.
    """
    until_now = by_time.rangeBetween(Window.unboundedPreceding, 0)
    before = by_time.rangeBetween(Window.unboundedPreceding, -DAY - 1)
    return total.over(until_now) - F.coalesce(total.over(before), F.lit(0))


def _by_ticks(
    df: DataFrame, sender: str, ts: str, amount: str, tx_id: str, as_of: str | None
) -> DataFrame:
    ticks = (
        df.groupBy(F.col(sender).alias("_sender"), F.col(ts).alias("_ts"))
        # in a struct, so that a NULL id is the least, as in an ordering
        .agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct(tx_id))[tx_id].alias("_first_tx"))
        .withColumn("_day", F.col("_ts") - F.pmod(F.col("_ts"), F.lit(DAY)))
    )
    # each tick also visits the following day, so that day sees its whole trailing window
    own_and_next = F.explode(F.array(F.col("_day"), F.col("_day") + DAY))
    slot = Window.partitionBy("_sender", "_slot").orderBy("_ts")
    per_tick = (
        ticks.withColumn("_slot", own_and_next)
        .withColumn("_prev_tick", F.lag("_ts").over(slot))
        .withColumn("_cnt", _trailing_day(F.sum("_n"), slot))
        .filter(F.col("_slot") == F.col("_day"))
    )
    # a tick with no neighbour in two days looks back to the last tick of an earlier day
    days = (
        ticks.groupBy("_sender", "_day")
        .agg(F.max("_ts").alias("_last"))
        .withColumn("_earlier", F.lag("_last").over(Window.partitionBy("_sender").orderBy("_day")))
        .select(F.col("_sender").alias("_s"), F.col("_day").alias("_d"), "_earlier")
    )
    per_tick = per_tick.join(
        days, F.col("_sender").eqNullSafe(F.col("_s")) & (F.col("_day") == F.col("_d")), "left"
    ).select(
        "_sender", "_ts", "_first_tx", "_cnt", F.coalesce("_prev_tick", "_earlier").alias("_prev")
    )
    totals = _totals(df, sender, amount, as_of)
    same_value = F.col(as_of).eqNullSafe(F.col("_as_of")) if as_of else F.lit(True)
    # rows that share second and id: the first of them looks back, the others see it
    copy = F.row_number().over(Window.partitionBy(sender, ts, tx_id).orderBy(F.lit(0)))
    joined = (
        df.withColumn("_copy", copy)
        .join(
            per_tick,
            F.col(sender).eqNullSafe(F.col("_sender")) & (F.col(ts) == F.col("_ts")),
            "left",
        )
        .join(totals, F.col(sender).eqNullSafe(F.col("_who")) & same_value, "left")
    )
    first = F.col(tx_id).eqNullSafe(F.col("_first_tx")) & (F.col("_copy") == 1)
    return (
        joined.withColumn("prev_ts", F.when(first, F.col("_prev")).otherwise(F.col(ts)))
        .withColumn("cnt_last_24h", F.coalesce("_cnt", F.lit(0)).cast("long"))
        .select(
            *df.columns, "prev_ts", "cnt_last_24h", "sender_avg_amount", "sender_std_amount"
        )
    )


def _totals(df: DataFrame, sender: str, amount: str, as_of: str | None) -> DataFrame:
    """Mean and deviation of each hot sender: ``_who`` (and ``_as_of``) with the two."""
    out = ["sender_avg_amount", "sender_std_amount"]
    if not as_of:
        # one row per hot sender: bounded by rows / hot_rows
        whole = df.groupBy(F.col(sender).alias("_who"))
        return F.broadcast(
            whole.agg(F.avg(amount).alias(out[0]), F.stddev_samp(amount).alias(out[1]))
        )
    # a row per sender and value; deviations are taken from the sender's mean
    centre = df.groupBy(F.col(sender).alias("_c")).agg(F.avg(amount).alias("_mean"))
    shifted = df.join(F.broadcast(centre), F.col(sender).eqNullSafe(F.col("_c"))).select(
        F.col(sender).alias("_who"),
        F.col(as_of).alias("_as_of"),
        "_mean",
        (F.col(amount) - F.col("_mean")).alias("_d"),
    )
    upto = Window.partitionBy("_who").orderBy("_as_of")
    sums = shifted.groupBy("_who", "_as_of", "_mean").agg(
        F.count("_d").alias("_k"), F.sum("_d").alias("_s"), F.sum(F.col("_d") ** 2).alias("_q")
    )
    k, s, q = (F.sum(c).over(upto) for c in ("_k", "_s", "_q"))
    running = sums.select("_who", "_as_of", "_mean", k.alias("k"), s.alias("s"), q.alias("q"))
    spread = F.greatest((F.col("q") - F.col("s") ** 2 / F.col("k")) / (F.col("k") - 1), F.lit(0.0))
    return running.select(
        "_who",
        "_as_of",
        F.when(F.col("k") > 0, F.col("_mean") + F.col("s") / F.col("k")).alias(out[0]),
        F.when(F.col("k") > 1, F.sqrt(spread)).alias(out[1]),
    )


def latest_per_key(df: DataFrame, key: str, n: int, ts: str = "ts", tx_id: str = "tx_id") -> DataFrame:
    """The latest ``n`` rows of each key, newest first, as ``rn`` = 1..n.

    The rank filter becomes a group limit *before* the shuffle, so each map task
    sends at most ``n`` rows of a key however hot the key is.
    """
    newest = Window.partitionBy(key).orderBy(F.col(ts).desc(), F.col(tx_id).asc())
    return df.withColumn("rn", F.row_number().over(newest)).filter(F.col("rn") <= n)
