"""Chat logs: collapse cumulative snapshots, then render what is left.

A log that stores a conversation anew after every exchange holds all its prefixes. Each
turn gets two 64-bit hashes of its number, role and text; XOR of the turns so far is a
rolling prefix hash that needs no order of summation, so a conversation with very many
turns is summed in blocks of ``BLOCK`` turn numbers, block totals first, and no task sees
more than a block; rows without a number, or under one, are of one block, however many
they are. A conversation whose last prefix hash is an inner prefix hash of
another is absorbed by it (an anti-join); of equal conversations the least id stays.

The 128 bits of both hashes, the turn number and the count of turns make up the key.

Rows without conversation id belong to no conversation and are left out; repeated rows
count once; several texts under one turn number are all part of that turn, in the order
of role and text. NULL roles and texts are rendered as empty, NULL turn numbers come
first. Marks that a role or text itself holds are made inert, so that no text can pass for
another turn; very long texts are rendered whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskloom.llm.common import land, session

BLOCK = 256
FIRST = -(1 << 62)  # stands for a turn without number

KEY = ["at", "h1", "h2", "rows"]


def turns_of(conversations: DataFrame) -> DataFrame:
    """conv_id, at, block, role, text: each distinct row once."""
    at = F.coalesce(F.col("turn").cast("long"), F.lit(FIRST))
    return (
        conversations.filter("conv_id IS NOT NULL")
        .select(
            "conv_id",
            at.alias("at"),
            F.floor(at / BLOCK).cast("long").alias("block"),
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
        )
        .distinct()
    )


def prefixes(turns: DataFrame) -> DataFrame:
    """conv_id, at, h1, h2, rows (up to that turn number), last (whether it is the end)."""
    each = turns.groupBy("conv_id", "block", "at").agg(
        F.bit_xor(F.xxhash64("at", "role", "text")).alias("h1"),
        F.bit_xor(F.xxhash64("text", "role", "at", F.lit(1))).alias("h2"),
        F.count(F.lit(1)).alias("rows"),
    )
    each = land(each, "turn-hashes")
    sums = [F.bit_xor("h1").alias("b1"), F.bit_xor("h2").alias("b2"), F.sum("rows").alias("bn")]
    blocks = each.groupBy("conv_id", "block").agg(*sums, F.max("at").alias("top"))
    before = W.partitionBy("conv_id").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy("conv_id")
    offsets = blocks.select(
        F.col("conv_id").alias("c"),
        F.col("block").alias("b"),
        F.coalesce(F.bit_xor("b1").over(before), F.lit(0)).alias("o1"),
        F.coalesce(F.bit_xor("b2").over(before), F.lit(0)).alias("o2"),
        F.coalesce(F.sum("bn").over(before), F.lit(0)).alias("on"),
        F.max("top").over(whole).alias("end"),
    )
    upto = W.partitionBy("conv_id", "block").orderBy("at").rowsBetween(W.unboundedPreceding, 0)
    inside = each.select(
        "conv_id",
        "block",
        "at",
        F.bit_xor("h1").over(upto).alias("p1"),
        F.bit_xor("h2").over(upto).alias("p2"),
        F.sum("rows").over(upto).alias("pn"),
    )
    return inside.join(
        offsets, (F.col("conv_id") == F.col("c")) & (F.col("block") == F.col("b"))
    ).select(
        "conv_id",
        "at",
        F.col("p1").bitwiseXOR(F.col("o1")).alias("h1"),
        F.col("p2").bitwiseXOR(F.col("o2")).alias("h2"),
        (F.col("pn") + F.col("on")).alias("rows"),
        (F.col("at") == F.col("end")).alias("last"),
    )


def maximal(turns: DataFrame) -> DataFrame:
    """conv_id, n_turns, status of every conversation: kept, prefix or copy.

    A conversation that is a prefix of a longer one is ``prefix``, whether or not it has
    copies; of the others, all but the least id of equal ones are ``copy``.
    """
    rolled = land(prefixes(turns), "prefixes")
    ends = rolled.filter("last")
    inner = rolled.filter(~F.col("last")).select(*KEY).distinct().withColumn("longer", F.lit(True))
    # folded before the join: equal conversations are one row
    classes = (
        ends.groupBy(*KEY)
        .agg(F.min("conv_id").alias("least"))
        .join(inner, KEY, "left")
    )
    return ends.join(classes, KEY).select(
        "conv_id",
        F.col("rows").alias("n_turns"),
        F.when(F.col("longer"), "prefix")
        .when(F.col("conv_id") == F.col("least"), "kept")
        .otherwise("copy")
        .alias("status"),
    )


def rendered_turn(role: Column, text: Column) -> Column:
    """A turn between marks. A mark's opening inside a text gets a backslash more after its
    ``<``, a mark's closing inside a role one after its ``|``; a reader takes them off."""
    inert_text = F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")
    inert_role = F.regexp_replace(role, r"\|(\\*)>", r"|\\$1>")
    return F.concat(F.lit("<|"), inert_role, F.lit("|>\n"), inert_text, F.lit("<|end|>\n"))


def render(turns: DataFrame) -> DataFrame:
    """conv_id, segment (from 0), n_turns, rendered: a conversation in pieces of ``BLOCK``
    turn numbers, to be read in the order of their segments."""
    line = F.struct("at", "role", "text")
    pieces = turns.groupBy("conv_id", "block").agg(
        F.sort_array(F.collect_list(line)).alias("lines"), F.count(F.lit(1)).alias("n_turns")
    )
    number = F.row_number().over(W.partitionBy("conv_id").orderBy("block")) - 1
    text = F.array_join(
        F.transform("lines", lambda x: rendered_turn(x["role"], x["text"])), ""
    )
    return pieces.select(
        "conv_id", "block", "n_turns", text.alias("rendered")
    ).select("conv_id", number.alias("segment"), "n_turns", "rendered")


def format_chats(conversations: DataFrame) -> DataFrame:
    """The rendered segments of the conversations that stay. Runs jobs."""
    session(conversations.sparkSession)
    turns = turns_of(conversations)
    stay = maximal(turns).filter("status = 'kept'").select("conv_id")
    return render(turns.join(stay, "conv_id", "left_semi"))
