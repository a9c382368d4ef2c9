"""Joining transactions to accounts, and predictions to labelled transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.operators.skew import BROADCAST_ROWS, HOT_ROWS, is_small, split_hot

ACCOUNT_COLUMNS = ["init_balance", "country", "account_type", "tx_behavior_id"]
BATCH_ACCOUNT_COLUMNS = ["init_balance", "country", "account_type"]
AMOUNT_EPS = 1e-6
MATCH_KEYS = ["sender_account_id", "receiver_account_id", "tx_type", "ts"]
# rows of one side of a group that one task pairs with as many of the other side
PAIR_ROWS = 2_000


def accounts_projection(accounts: DataFrame) -> DataFrame:
    """The four columns the batch path reads from the account table."""
    return accounts.select("account_id", *BATCH_ACCOUNT_COLUMNS)


def first_account(accounts: DataFrame) -> DataFrame:
    """One row per account: the first customer in clustering order."""
    by_customer = Window.partitionBy("account_id").orderBy("customer_id")
    return (
        accounts.withColumn("_rn", F.row_number().over(by_customer))
        .filter(F.col("_rn") == 1)
        .drop("_rn")
    )


def join_accounts(
    tx: DataFrame,
    accounts: DataFrame,
    how: str = "left",
    columns: list[str] = ACCOUNT_COLUMNS,
    key: str = "sender_account_id",
    fan_out: bool = False,
    max_broadcast_rows: int = BROADCAST_ROWS,
    hot_rows: int = HOT_ROWS,
    small: bool | None = None,
) -> DataFrame:
    """Equi-join transactions to accounts on the sender.

    ``how`` is ``left`` (keep unmatched), ``inner`` (drop them) or ``left_anti``
    (only them). One account row per key unless ``fan_out``.

    Accounts counted as small are broadcast and the transactions are not shuffled.
    Otherwise the join shuffles on the key; the accounts of hot senders, at most
    ``rows / hot_rows`` of them, are broadcast to those senders' rows instead.

    A stream always takes the plain shuffle join there, as its senders cannot be counted.

    The count runs here, when the join is declared; pass its outcome as ``small`` to
    declare several joins for one count.
    """
    if how not in ("left", "inner", "left_anti"):
        raise ValueError(f"unsupported join type {how!r}")
    wanted = [] if how == "left_anti" else list(columns)
    if how == "left_anti":
        side = accounts.select("account_id")
    elif fan_out:
        side = accounts.select("account_id", *wanted)
    else:
        needed = dict.fromkeys(["account_id", "customer_id", *wanted])
        side = first_account(accounts.select(*needed)).select("account_id", *wanted)

    def joined(rows: DataFrame, dimension: DataFrame) -> DataFrame:
        on = F.col(key) == F.col("account_id")
        return rows.join(dimension, on, how).select(*tx.columns, *wanted)

    if small is None:
        small = is_small(accounts, max_broadcast_rows)
    if small:
        return joined(tx, F.broadcast(side))
    if fan_out or tx.isStreaming:
        # hot keys of a stream cannot be counted; the adaptive skew join splits them
        return joined(tx, side)
    cold, hot, keys = split_hot(tx, key, hot_rows)
    few = side.join(F.broadcast(keys), F.col("account_id") == F.col(key), "left_semi").distinct()
    return joined(cold, side).unionByName(joined(hot, F.broadcast(few)))


def enriched_pair(enriched: DataFrame) -> DataFrame:
    """The ``{account, transaction}`` pair as two struct columns.

    ``enriched`` was joined with ``columns=["customer_id", *ACCOUNT_COLUMNS]``.
    """
    account = F.struct(
        F.col("sender_account_id").alias("ACCOUNT_ID"),
        *[F.col(c).alias(c.upper()) for c in ["customer_id", *ACCOUNT_COLUMNS]],
    )
    return enriched.select("tx_id", account.alias("account"), event_struct().alias("transaction"))


def event_struct():
    """The wire form of an event, built from the flat columns."""
    return F.struct(
        F.col("sender_account_id").alias("SENDER_ACCOUNT_ID"),
        F.col("receiver_account_id").alias("RECEIVER_ACCOUNT_ID"),
        F.col("tx_type").alias("TX_TYPE"),
        F.col("tx_amount").alias("TX_AMOUNT"),
        F.col("ts").alias("TIMESTAMP"),
    )


def match_label(
    predictions: DataFrame,
    transactions: DataFrame,
    eps: float = AMOUNT_EPS,
    expand: bool = False,
) -> DataFrame:
    """Attach labels: equal sender, receiver, type and time, amounts within ``eps``.

    Copies of a transaction are folded into one row with a count before the
    shuffle, so a group of copies is never paired row by row: ``n_matches`` says how
    many labelled transactions each output row stands for. ``expand=True`` repeats
    the rows instead, as a plain join would.

    The tolerance becomes an equality on amount cells of width ``2 * eps``: matches lie
    in the same cell or a neighbouring one. Labelled rows visit all three.
    """
    keys = MATCH_KEYS
    cell = F.floor(F.col("tx_amount") / F.lit(2 * eps))
    labelled = (
        transactions.groupBy(*keys, "tx_amount", F.col("is_fraud").alias("tx_is_fraud"))
        .agg(F.count(F.lit(1)).alias("n_matches"))
        .withColumn("_cell", F.explode(F.array(cell - 1, cell, cell + 1)))
        .withColumnRenamed("tx_amount", "_amount")
    )
    out = (
        predictions.withColumn("_cell", cell)
        .join(labelled, [*keys, "_cell"], "inner")
        .filter(F.abs(F.col("tx_amount") - F.col("_amount")) < F.lit(eps))
        .select(*predictions.columns, "tx_is_fraud", "n_matches")
    )
    if expand:
        copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("n_matches")))
        out = out.withColumn("_copy", copies).drop("_copy", "n_matches")
    return out


def match_pairs(
    predictions: DataFrame,
    transactions: DataFrame,
    eps: float = AMOUNT_EPS,
    pair_rows: int = PAIR_ROWS,
) -> DataFrame:
    """The columns of ``predictions`` and ``tx_is_fraud``, one row for each matching pair.

    A many-to-many join on the keys of :func:`match_label` with the same tolerance, nothing
    folded. A group of ``n`` predictions and ``m`` transactions has up to ``n * m`` pairs, so
    groups with more than ``pair_rows`` rows on a side are cut on both: predictions into
    ``a`` parts and transactions into ``b``, every part of one side meeting every part of the
    other once, in a task of its own. Each row is then copied ``b`` or ``a`` times, never more
    often than the group has parts. Parts come from the rows' positions, so the inputs must
    be stored tables or repeat their rows in order. NULL keys and amounts match nothing.
    """
    cell = F.floor(F.col("tx_amount") / F.lit(2 * eps))
    keys = [*MATCH_KEYS, "_cell"]
    left = predictions.select(
        F.struct(*predictions.columns).alias("_row"),
        *MATCH_KEYS,
        "tx_amount",
        cell.alias("_cell"),
        F.monotonically_increasing_id().alias("_id"),
    )
    right = transactions.select(
        *MATCH_KEYS,
        F.col("tx_amount").alias("_amount"),
        F.col("is_fraud").alias("tx_is_fraud"),
        F.monotonically_increasing_id().alias("_id"),
        F.explode(F.array(cell - 1, cell, cell + 1)).alias("_cell"),
    )

    def large(side: DataFrame, name: str) -> DataFrame:
        # counted on the map side; at most rows / pair_rows groups are large
        return side.groupBy(*keys).count().filter(F.col("count") > pair_rows).select(
            *keys, F.ceil(F.col("count") / pair_rows).alias(name)
        )

    # parts of both sides for groups that are large on either
    parts = large(left, "_a").join(large(right, "_b"), keys, "full")
    parts = F.broadcast(parts.select(
        *keys, F.coalesce("_a", F.lit(1)).alias("_a"), F.coalesce("_b", F.lit(1)).alias("_b")
    ))

    def dealt(side: DataFrame, own: str, other: str, mine: str, theirs: str) -> DataFrame:
        one = F.lit(1).cast("long")
        n, copies = F.coalesce(own, one), F.coalesce(other, one)
        return (
            side.join(parts, keys, "left")
            .withColumn(mine, F.pmod(F.xxhash64("_id"), n))
            .withColumn(theirs, F.explode(F.sequence(F.lit(0).cast("long"), copies - 1)))
            .drop("_a", "_b", "_id")
        )

    pairs = dealt(left, "_a", "_b", "_i", "_j").join(
        dealt(right, "_b", "_a", "_j", "_i"), [*keys, "_i", "_j"]
    )
    return pairs.filter(F.abs(F.col("tx_amount") - F.col("_amount")) < F.lit(eps)).select(
        "_row.*", "tx_is_fraud"
    )
