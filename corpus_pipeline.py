"""A training-data pipeline over ``documents``: classify, judge, dedupe, decontaminate, encode.

Every stage takes (spark, docs, sf_dir) and returns the documents that it keeps, with
their columns; the last adds the token columns. ``run`` writes each stage's result below
the shared folder and reads it back, so that a lost executor costs one stage at most.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import decontaminate, near_dups, pieces, quality_rules, rule_ensemble
from riskloom.llm.common import fresh, keep_where, session, table
from riskloom.session import scratch_dir


def classified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble takes for good ones."""
    model = rule_ensemble.fit(docs, table(spark, sf_dir, "labels"))
    (score,) = fresh(docs, "_score")
    good = docs.withColumn(score, model.score(F.col("text")))
    return keep_where(good, F.col(score) >= rule_ensemble.THRESHOLD).drop(score)


def ruled(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the current policy of the quality rules."""
    return quality_rules.passing(docs)


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one of the least id."""
    return near_dups.deduplicate(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their pieces under merge dropout."""
    return pieces.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality classifier", classified),
    ("quality rules", ruled),
    ("near duplicates", deduplicated),
    ("benchmark decontamination", decontaminated),
    ("piece encoding", encoded),
]

# a fitted classifier and keyed merge dropout are not SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(session(spark), sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_dir(spark, f"pipeline-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
