"""Benchmark windows inside documents: a prefix-filtered, exactly verified join.

Words are runs of ASCII letters, digits and any non-ASCII characters, A-Z lower-cased. A
benchmark item is cut into windows of ``WINDOW`` consecutive words (a shorter item is one
window), and windows and documents into shingles of ``SHINGLE`` words. One pass over the
documents keeps, of all their shingles, the positions of those that some window holds.
Their counts over the whole corpus order the shingles by rarity. A document that
contains a window must contain its rarest shingle, so that shingle alone - the necessary
prefix for full containment - is joined; the window must then fit between the first and
the last word of the document (positional and length bounds), and is verified against
the shingles that stand around the match, which together spell all its words.

Shingles are compared as text, so nothing rests on hashes. All of it is DataFrame
operations. The benchmark side is broadcast only while it has at most
``BROADCAST_SHINGLES`` shingles, else joined by shuffle. Per document there are only the
rows of its matching positions, windowed in order, so very long texts can spill.

NULL and empty texts have no words and no hits; NULL items and items without words have
no windows; windows and items that repeat count once an item id. Rows with equal id and
text get equal results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskloom.llm.common import ascii_lower, fresh, land, session

WINDOW = 10
SHINGLE = 3
BROADCAST_SHINGLES = 1_000_000
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def plain_words(text: Column) -> Column:
    """The words of a text, A-Z lower-cased; none for NULL."""
    lowered = ascii_lower(F.coalesce(text, F.lit("")))
    return F.filter(F.split(lowered, NOT_WORD), lambda w: w != "")


def shingles(words: str, k: int) -> Column:
    """Texts of the k-word shingles of an array column, one a starting word."""
    count = F.greatest(F.size(words) - (k - 1), F.lit(0))
    parts = lambda w, i: [w] + [F.get(words, i + j) for j in range(1, k)]
    return F.transform(
        F.slice(words, F.lit(1), count), lambda w, i: F.concat_ws(" ", *parts(w, i))
    )


def item_windows(benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """item_id, words (of one window), size (words), k (words a shingle), grams (its shingles)."""
    worded = benchmark.select("item_id", plain_words(F.col("text")).alias("_w")).filter(
        F.size("_w") > 0
    )
    last = F.greatest(F.size("_w") - (window - 1), F.lit(1))
    cut = worded.select(
        "item_id",
        F.explode(
            F.transform(F.sequence(F.lit(1), last), lambda i: F.slice("_w", i, window))
        ).alias("words"),
    ).distinct()
    grams = F.lit(None)
    for k in range(1, shingle + 1):
        grams = F.when(F.least(F.size("words"), F.lit(shingle)) == k, shingles("words", k)).otherwise(grams)
    return cut.withColumns(
        {
            "size": F.size("words"),
            "k": F.least(F.size("words"), F.lit(shingle)),
            "grams": grams,
        }
    )


def _small(df: DataFrame, proven: bool) -> DataFrame:
    return F.broadcast(df) if proven else df


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE
) -> DataFrame:
    """doc_id, text_hash, n_words, n_hit, n_items, items (sorted texts of ids) of every row.

    Runs jobs: item windows and matching positions are landed.
    """
    session(docs.sparkSession)
    windows = land(item_windows(benchmark, window, shingle), "windows")
    # the same words in several items are one window
    distinct = windows.select("words", "size", "k", "grams").distinct()
    wanted = distinct.select("k", F.explode("grams").alias("gram")).distinct()
    lengths = [r["k"] for r in wanted.select("k").distinct().collect()]  # at most ``shingle``
    proven = wanted.count() <= BROADCAST_SHINGLES

    key = ["doc_id", "text_hash"]
    worded = docs.select(
        "doc_id", F.xxhash64("text").alias("text_hash"), plain_words(F.col("text")).alias("_w")
    )
    # a first row at place -1 stands for the document itself
    none = F.array(F.struct(F.lit(-1).alias("at"), F.lit(0).alias("k"), F.lit("").alias("gram")))
    placed = [_placed(k) for k in sorted(lengths)]
    spread = worded.select(
        *key, F.size("_w").cast("long").alias("n_words"), F.explode(F.concat(none, *placed)).alias("s")
    ).select(*key, "n_words", "s.at", "s.k", "s.gram")
    known = wanted.select("k", "gram", F.lit(True).alias("known"))
    seen = spread.join(_small(known, proven), ["k", "gram"], "left").filter(
        (F.col("at") < 0) | F.col("known")
    )
    found = land(seen.drop("known"), "shingles")
    rows = found.filter("at < 0").select(*key, "n_words")
    matches = found.filter("at >= 0").distinct()

    counts = matches.groupBy("k", "gram").agg(F.count(F.lit(1)).alias("n"))
    each = distinct.select("words", "size", "k", "grams", F.posexplode("grams").alias("offset", "gram"))
    rarest = (
        # a shingle that no document holds cannot be found
        each.join(counts, ["k", "gram"])
        .groupBy("words", "size", "k", "grams")
        .agg(F.min(F.struct("n", "offset", "gram")).alias("r"), F.count(F.lit(1)).alias("held"))
        .filter(F.col("held") == F.size("grams"))
        .select("words", "size", "k", "grams", "r.offset", "r.gram")
    )
    order = W.partitionBy(*key, "k").orderBy("at")
    reach = max(window - 1, 1)
    around = matches.withColumn(
        "near",
        F.collect_list(F.struct("at", "gram")).over(order.rowsBetween(-reach, reach)),
    )
    candidates = around.join(_small(rarest, proven), ["k", "gram"]).withColumn(
        "start", F.col("at") - F.col("offset")
    )
    bounded = candidates.filter(
        (F.col("start") >= 0) & (F.col("start") + F.col("size") <= F.col("n_words"))
    )
    end = F.col("start") + F.size("grams")
    inside = F.filter("near", lambda x: (x["at"] >= F.col("start")) & (x["at"] < end))
    hits = land(
        bounded.filter(F.transform(inside, lambda x: x["gram"]) == F.col("grams")).select(
            *key, "start", (F.col("start") + F.col("size")).alias("end"), "words"
        ),
        "hits",
    )
    # words covered by intervals that may overlap
    upto = W.partitionBy(*key).orderBy("start", "end").rowsBetween(W.unboundedPreceding, -1)
    before = F.coalesce(F.max("end").over(upto), F.lit(0))
    covered = (
        hits.select(*key, "start", "end")
        .withColumn("new", F.greatest(F.col("end") - F.greatest("start", before), F.lit(0)))
        .groupBy(*key)
        .agg(F.sum("new").cast("long").alias("n_hit"))
    )
    names = windows.select("words", F.col("item_id").cast("string").alias("item")).distinct()
    items = (
        hits.select(*key, "words")
        .distinct()
        .join(_small(names, proven), "words")
        .groupBy(*key)
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
    )
    named = ["_id", "_hash"]
    results = covered.join(
        items.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "items"),
        (F.col("doc_id").eqNullSafe(F.col("_id"))) & (F.col("text_hash") == F.col("_hash")),
    ).select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "n_hit", "items"
    )
    joined = rows.join(
        results,
        (F.col("doc_id").eqNullSafe(F.col("_id"))) & (F.col("text_hash") == F.col("_hash")),
        "left",
    ).drop(*named)
    nothing = F.array().cast("array<string>")
    return joined.select(
        *key,
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(F.coalesce("items", nothing)).cast("long").alias("n_items"),
        F.coalesce("items", nothing).alias("items"),
    )


def _placed(k: int) -> Column:
    return F.transform(
        shingles("_w", k),
        lambda g, i: F.struct(i.alias("at"), F.lit(k).alias("k"), g.alias("gram")),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` without those that hold a benchmark window."""
    id_, hash_ = fresh(docs, "_id", "_hash")
    bad = (
        contamination(docs, benchmark, window)
        .filter("n_hit > 0")
        .select(F.col("doc_id").alias(id_), F.col("text_hash").alias(hash_))
        .distinct()
    )
    same = F.col("doc_id").eqNullSafe(F.col(id_)) & (F.xxhash64("text") == F.col(hash_))
    return docs.join(bad, same, "left_anti")
