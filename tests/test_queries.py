"""Every query against its SQL, and the model queries against their invariants."""

import pytest
from oracle_check import connect, differences

import __spark_entry__ as entry
from conftest import SF_DIR

SQL = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    assert differences(spark, duck, SF_DIR, QUERIES[name], SQL[name]) == []


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry_returns_flagged_transactions(spark):
    out = entry.entry(spark)
    assert out.filter("is_fraud").count() == out.count() == 30
    assert {"score", "country", "cnt_last_24h"} <= set(out.columns)


def test_published_optimum(spark):
    """31 hits and one false alarm of 55 positives is the known optimum at this scale."""
    best = QUERIES["cost_threshold"](spark, SF_DIR).first()
    assert (best["threshold"], best["tp"], best["fp"], best["cost"]) == (0.519185, 31, 1, 27)


def test_known_layer_table(spark):
    table = {
        (r["is_fraud_speed"], r["is_fraud_batch"]): r["n"]
        for r in QUERIES["layer_compare"](spark, SF_DIR).collect()
    }
    assert table == {(False, False): 967, (False, True): 3, (True, False): 9, (True, True): 21}
