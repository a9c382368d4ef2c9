import math

import pytest
from cases import EDGE, edge_docs, no_docs
from pyspark.sql import functions as F

from riskloom.llm import rule_ensemble as r
from riskloom.llm.common import table

SF = "/root/testdata/sf0.01"
LABELS = "doc_id long, quality int, toxic int, text string"


@pytest.fixture(scope="module")
def fitted(spark):
    return r.fit(table(spark, SF, "documents"), table(spark, SF, "labels"))


def test_held_out_accuracy(spark, fitted):
    labels = table(spark, SF, "labels").filter(r.held_out(F.col("doc_id")))
    rows = r.with_score(table(spark, SF, "documents"), fitted).join(labels, "doc_id").collect()
    right = sum(x["predicted"] == x["quality"] for x in rows)
    assert len(rows) > 50 and right / len(rows) > 0.95
    assert all(0 <= x["score"] <= 1 for x in rows)


def test_lasso_keeps_few_rules(fitted):
    assert 0 < len(fitted.weights) < 60
    assert all(rule.bounds for rule in fitted.weights)


def test_compiled_score_is_the_rule_sum(spark, fitted):
    df = edge_docs(spark)
    rows = df.select(r.statistics(F.col("text")).alias("s"), fitted.score(F.col("text")).alias("v"))
    for row in rows.collect():
        z = fitted.intercept
        for rule, weight in fitted.weights.items():
            z += weight * all(low < row["s"][k] <= high for k, low, high in rule.bounds)
        assert math.isclose(row["v"], 1 / (1 + math.exp(-z)), rel_tol=1e-9)


def test_statistics(spark):
    df = spark.createDataFrame([("Ab ab! AB|\n\nx1 ##\nx1 ##",), (None,), ("",)], "text string")
    first, *rest = [x[0].asDict() for x in df.select(r.statistics(F.col("text"))).collect()]
    assert first["n_words"] == 7 and first["word_length"] == 16 / 7
    assert first["distinct_share"] == 5 / 7 and first["dup_line_share"] == 1 / 3
    assert first["upper_share"] == 3 / 16 and first["symbol_share"] == 4 / 16
    assert first["mark_share"] == 1 / 7 and first["bar_share"] == 1 / 7
    assert all(set(x.values()) == {0.0} for x in rest)


def test_edge_cases(spark, fitted):
    rows = r.with_score(edge_docs(spark), fitted).collect()
    assert len(rows) == len(EDGE) and all(x["score"] is not None for x in rows)
    assert r.with_score(no_docs(spark), fitted).count() == 0


def test_labels_of_one_kind_or_none(spark):
    none = spark.createDataFrame([], LABELS)
    assert r.fit(edge_docs(spark), none).weights == {}
    good = spark.createDataFrame([(i, 1, 0, "x") for i in range(1, 9)] + [(None, 0, 0, "x"), (1, None, 0, "x")], LABELS)
    model = r.fit(edge_docs(spark), good)
    assert model.weights == {} and model.intercept > 0
    assert r.fit(no_docs(spark), good).weights == {}


def test_sample_is_bounded_and_without_held_out(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    everything = r.training_rows(docs, labels).count()
    assert everything == labels.filter(~r.held_out(F.col("doc_id"))).count()
    assert 60 < r.training_rows(docs, labels, max_rows=100).count() < 140
