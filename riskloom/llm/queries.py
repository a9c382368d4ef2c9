"""The queries of the text operators, over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import (
    chat,
    clustering,
    decontaminate,
    languages,
    near_dups,
    pieces,
    quality_rules,
    repair,
    rule_ensemble,
    sharding,
    token_counts,
    url_rules,
    warc,
)
from riskloom.llm.common import land, table
from riskloom.llm.sql import SQL
from riskloom.session import scratch_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

__all__ = ["QUERIES", "SQL"]


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_quality_ledger(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    return quality_rules.judge(land(quality_rules.ledger(docs).drop("text"), "ledger"))


@query
def ledger_ablation(spark, d):
    """What every rule of every policy version rejects, from the bits of a stored ledger."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    return quality_rules.ablation(land(quality_rules.ledger(docs).drop("text"), "ledger"))


@query
def op2_byte_shards(spark, d):
    placed = sharding.shard_table(table(spark, d, "documents"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op3_url_rules(spark, d):
    return url_rules.judge_urls(table(spark, d, "pages"), table(spark, d, "labels"))


@query
def op4_merge_dropout(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    model = public_tokenizers.path("piece_bpe_32k.model")
    return pieces.encode(docs, model, ids=False).drop("text")


@query
def op5_token_counts(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    counted = token_counts.count_tokens(docs, public_tokenizers.path("word_bpe_49k.json"))
    return counted.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        "n_tokens",
        token_counts.over().alias("over_limit"),
    )


@query
def op6_near_duplicates(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    return near_dups.near_duplicates(docs, shingle=4).drop("text_hash")


@query
def op7_decontamination(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    found = decontaminate.contamination(docs, table(spark, d, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query
def op8_chat_snapshots(spark, d):
    made = chat.format_chats(table(spark, d, "conversations"))
    return made.select(
        "conv_id",
        F.col("segment").cast("long").alias("segment"),
        "n_turns",
        F.octet_length("rendered").cast("long").alias("n_bytes"),
        F.sha2(F.col("rendered").cast("binary"), 256).alias("text_sha256"),
    )


@query
def op9_warc_revisits(spark, d):
    path = scratch_dir(spark, "warc")
    warc.write_archives(table(spark, d, "pages"), path)
    return warc.resolve_archives(warc.read_archives(spark, path)).drop("url")


@query
def op10_rule_ensemble(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    model = rule_ensemble.fit(docs, table(spark, d, "labels"))
    scored = rule_ensemble.with_score(docs, model)
    held = rule_ensemble.held_out(F.col("doc_id"))
    return scored.select("doc_id", held.alias("held_out"), "score", "predicted")


@query
def op11_languages(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text", "lang")
    model = languages.fit(docs, public_tokenizers.path("piece_bpe_32k.model"))
    named = languages.identify(docs.select("doc_id", "text"), model)
    held = languages.held_out(F.col("doc_id"))
    return named.select("doc_id", held.alias("held_out"), "lang_pred", "score")


@query
def op12_centroid_clusters(spark, d):
    return clustering.with_inertia(clustering.cluster(table(spark, d, "embeddings")))


@query
def op13_conversation_repair(spark, d):
    conversations = table(spark, d, "conversations")
    return repair.repair(repair.damage(conversations), conversations.select("conv_id"))


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
