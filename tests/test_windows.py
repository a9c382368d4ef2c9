"""Behavioural features: edges, and both ways of computing them against brute force."""

import random
import statistics

import pytest
from conftest import rows

from riskloom.operators.windows import FEATURES, add_behavioral_features, latest_per_key

SCHEMA = "tx_id long, sender_account_id int, ts long, tx_amount double"


def brute_force(data):
    out = {}
    for tx_id, sender, ts, amount in data:
        mine = sorted((r[2], r[0], r[3]) for r in data if r[1] == sender)
        place = mine.index((ts, tx_id, amount))
        prev = mine[place - 1][0] if place else None
        amounts = [a for _, _, a in mine]
        out[tx_id] = {
            "prev_ts": prev,
            "time_since_last_tx": 999999 if prev is None else ts - prev,
            "cnt_last_24h": sum(ts - 86400 <= t <= ts for t, _, _ in mine),
            "sender_avg_amount": pytest.approx(sum(amounts) / len(amounts)),
            "sender_std_amount": pytest.approx(statistics.stdev(amounts))
            if len(amounts) > 1
            else None,
        }
    return out


def features(spark, data, **options):
    df = spark.createDataFrame(data, SCHEMA)
    out = add_behavioral_features(df, **options)
    assert out.columns == [*df.columns, *FEATURES]
    return {r["tx_id"]: {k: r[k] for k in FEATURES} for r in rows(out)}


# hot_rows=0 sends every sender the tick way, the default sends none
@pytest.mark.parametrize("hot_rows", [0, 5_000_000])
class TestEdges:
    def test_single_row(self, spark, hot_rows):
        got = features(spark, [(1, 7, 500, 12.0)], hot_rows=hot_rows)
        assert got[1] == {
            "prev_ts": None,
            "time_since_last_tx": 999999,
            "cnt_last_24h": 1,
            "sender_avg_amount": 12.0,
            "sender_std_amount": None,
        }

    def test_day_bound_is_inclusive(self, spark, hot_rows):
        data = [(1, 7, 0, 1.0), (2, 7, 86400, 1.0), (3, 7, 86401, 1.0)]
        got = features(spark, data, hot_rows=hot_rows)
        assert [got[i]["cnt_last_24h"] for i in (1, 2, 3)] == [1, 2, 2]

    def test_ties_share_the_count_and_split_the_gap(self, spark, hot_rows):
        data = [(1, 7, 100, 1.0), (3, 7, 150, 1.0), (2, 7, 150, 1.0)]
        got = features(spark, data, hot_rows=hot_rows)
        assert [got[i]["cnt_last_24h"] for i in (1, 2, 3)] == [1, 3, 3]
        assert [got[i]["time_since_last_tx"] for i in (1, 2, 3)] == [999999, 50, 0]

    def test_gap_over_many_days(self, spark, hot_rows):
        got = features(spark, [(1, 7, 10, 1.0), (2, 7, 10_000_000, 1.0)], hot_rows=hot_rows)
        assert got[2]["time_since_last_tx"] == 9_999_990
        assert got[2]["cnt_last_24h"] == 1

    def test_null_sender_is_a_sender(self, spark, hot_rows):
        data = [(1, None, 10, 1.0), (2, None, 30, 3.0), (3, 0, 20, 5.0)]
        got = features(spark, data, hot_rows=hot_rows)
        assert got[2]["time_since_last_tx"] == 20
        assert got[2]["sender_avg_amount"] == 2.0
        assert got[3]["time_since_last_tx"] == 999999


@pytest.mark.parametrize("hot_rows", [0, 60, 5_000_000])
def test_against_brute_force_with_a_hot_sender(spark, hot_rows):
    """One sender holds a third of the rows, with many ties and day crossings."""
    draw = random.Random(3)
    data = [
        (
            i,
            1 if i % 3 == 0 else draw.randrange(2, 12),
            draw.randrange(1_700_000_000, 1_700_000_000 + 5 * 86400, 97),
            draw.randrange(1, 100_000) / 100,
        )
        for i in range(450)
    ]
    assert features(spark, data, hot_rows=hot_rows) == brute_force(data)


def test_cold_senders_need_one_shuffle_and_one_sort(spark):
    data = [(i, i % 5, i * 1000, float(i)) for i in range(100)]
    out = add_behavioral_features(spark.createDataFrame(data, SCHEMA))
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    final = plan[: plan.index("Initial Plan")]
    # the hot branch is gone, and so is the anti join against an empty key list
    assert final.count("Exchange hashpartitioning") == 1
    assert final.count("Sort [") == 1
    assert "Union" not in final and "Join" not in final


def test_latest_per_key_limits_before_the_shuffle(spark):
    data = [(i, 1 if i % 3 else i, i, 1.0) for i in range(300)]
    df = spark.createDataFrame(data, SCHEMA)
    out = latest_per_key(df, "sender_account_id", 2)
    assert [r["tx_id"] for r in rows(out, "rn") if r["sender_account_id"] == 1] == [299, 298]
    plan = out._jdf.queryExecution().executedPlan().toString()
    # read bottom-up: the partial limit sits below the exchange
    assert plan.rindex("WindowGroupLimit") > plan.index("Exchange hashpartitioning")


def test_latest_per_key_breaks_ties_by_id(spark):
    df = spark.createDataFrame([(2, 1, 5, 1.0), (1, 1, 5, 1.0), (3, 1, 4, 1.0)], SCHEMA)
    got = rows(latest_per_key(df, "sender_account_id", 2), "rn")
    assert [(r["rn"], r["tx_id"]) for r in got] == [(1, 1), (2, 2)]
