"""Documents that every text operator must bear, and plain Python definitions."""

import re

DOC_SCHEMA = "doc_id long, text string, shard string, kept string, n_words string"
LONG = " ".join(f"word{i % 997} x{i}" for i in range(30_000))
EDGE = [
    (1, "The quick brown fox jumps over the lazy dog and runs away today", "a", "b", "c"),
    (2, None, None, None, None),
    (3, "", "a", None, "c"),
    (4, " \t\n\x0b\x0c\r ", None, "b", None),
    (None, "a row without an id but with a text of its own", "a", "b", "c"),
    (5, LONG, "a", "b", "c"),
    (6, "same same\nsame same\nsame same", "a", "b", "c"),
    (6, "same same\nsame same\nsame same", "a", "b", "c"),
    (7, "Ünïcödé ÉCOLE ▁mark 日本語 😀 e\u0301 \u00a0 x\u0085y", "a", "b", "c"),
    (8, "!!! *** ||| <>", "a", "b", "c"),
]


def edge_docs(spark):
    return spark.createDataFrame(EDGE, DOC_SCHEMA)


def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
