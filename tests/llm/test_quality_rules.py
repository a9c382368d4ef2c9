from collections import Counter

from cases import edge_docs, no_docs, words
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from riskloom.llm import quality_rules as q
from riskloom.llm.common import keep_where, land
from pyspark.sql import functions as F


def expected(text):
    w, t = words(text), text or ""
    windows = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if words(x)]
    return {
        "n_words": len(w),
        "word_chars": sum(map(len, w)),
        "n_symbols": sum(c in "#*$%&|<>" for x in w for c in x),
        "n_lines": len(lines),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
    }


def test_measures_of_edge_cases(spark):
    for row in q.ledger(edge_docs(spark)).collect():
        assert {k: row[k] for k in expected(row["text"])} == expected(row["text"]), row["text"]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab \n\t#|É", max_size=60), min_size=1, max_size=20))
def test_measures_equal_brute_force(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for row in q.measure(df).collect():
        assert {k: row[k] for k in expected(row["text"])} == expected(row["text"])


def test_base_and_policy(spark):
    good = " ".join(f"word{i}" for i in range(60))
    df = spark.createDataFrame(
        [(1, good), (2, "few words"), (3, "again and " * 60), (4, good.upper()), (5, "a|b " + good)],
        "doc_id long, text string",
    )
    found = {r["doc_id"]: (r["base_failed"], r["kept"]) for r in q.judge(q.ledger(df)).collect()}
    assert found == {1: (False, True), 2: (True, False), 3: (True, False), 4: (False, False), 5: (False, True)}


def test_input_columns_with_result_names_are_replaced(spark):
    row = q.judge(q.ledger(edge_docs(spark))).filter("doc_id = 1").first()
    assert row["n_words"] == 13 and row["kept"] is False and row["shard"] == "a"


def test_empty_table(spark):
    assert q.judge(q.ledger(no_docs(spark))).count() == 0
    assert q.ablation(q.ledger(no_docs(spark))).count() == 0


def test_ablation_counts_bits(spark):
    rows = spark.createDataFrame([(0,), (1,), (3,), (3,), (2,), (4,)], "fail_bits long")
    found = {
        r["rule"]: (r["n_failed"], r["n_only"], r["n_kept"])
        for r in q.ablation(rows).filter("policy = 'base-1'").collect()
    }
    assert found == {"few_words": (3, 1, 2), "repeated_words": (3, 1, 2)}
    names = q.failures(rows.filter("fail_bits = 3").limit(1)).first()["failed_rules"]
    assert names == ["few_words", "repeated_words"]


def test_keep_where_does_not_repeat_work(spark):
    """The filter stays above the columns that it uses."""
    kept = keep_where(q.judge(q.ledger(edge_docs(spark))), F.col("kept"))
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") <= 4


def test_a_stored_ledger_is_judged_by_later_versions(spark):
    """A new version of a policy needs the bits only, not the texts."""
    lines = "\n".join([" ".join(f"word{i}" for i in range(30))] * 3)
    df = spark.createDataFrame([(1, lines), (2, "few"), (3, None)], "doc_id long, text string")
    stored = land(q.ledger(df).select("doc_id", "fail_bits"), "ledger-test")
    found = stored.select("doc_id", *[q.failed(p).alias(p) for p in ("base-1", "base-2")])
    assert sorted(map(tuple, found.collect())) == [(1, True, True), (2, True, True), (3, True, True)]
    one = spark.createDataFrame([(8,), (0,)], "fail_bits long")
    assert [tuple(r) for r in one.select(q.failed("base-1"), q.failed("base-2")).collect()] == [
        (False, True),
        (False, False),
    ]


def test_input_columns_with_work_names_stay(spark):
    df = edge_docs(spark).withColumns({c: F.lit(c) for c in ("_words", "_chars", "_lines", "_windows")})
    row = q.ledger(df).filter("doc_id = 1").first()
    assert [row[c] for c in ("_words", "_chars", "_lines", "_windows")] == ["_words", "_chars", "_lines", "_windows"]
    out = q.passing(df)
    assert out.columns == df.columns
