"""Decoding and validating events."""

import json

import pytest
from conftest import rows

from riskloom.operators.validate import parse_events, validate_split

GOOD = {
    "SENDER_ACCOUNT_ID": 4711,
    "RECEIVER_ACCOUNT_ID": 1312,
    "TX_TYPE": "TRANSFER",
    "TX_AMOUNT": 512.75,
    "TIMESTAMP": 1717171717,
}


def parsed(spark, *texts, **options):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "tx_id long, value string")
    return rows(parse_events(df, **options), "tx_id")


def test_good_event(spark):
    (row,) = parsed(spark, json.dumps(GOOD))
    assert row["status"] == "valid"
    assert (row["sender_account_id"], row["tx_amount"], row["ts"]) == (4711, 512.75, 1717171717)


@pytest.mark.parametrize(
    "change, status",
    [
        ({"SENDER_ACCOUNT_ID": "4711"}, "valid"),
        ({"SENDER_ACCOUNT_ID": 4711.0}, "valid"),
        ({"SENDER_ACCOUNT_ID": 4711.5}, "bad_type"),
        ({"SENDER_ACCOUNT_ID": 99999999999}, "bad_type"),
        ({"TX_AMOUNT": "12.5"}, "valid"),
        ({"TX_AMOUNT": 5}, "valid"),
        ({"TX_AMOUNT": "much"}, "bad_type"),
        ({"TIMESTAMP": "noon"}, "bad_type"),
        ({"TX_TYPE": None}, "missing_field"),
        ({"EXTRA": 1}, "valid"),
    ],
)
def test_field_rules(spark, change, status):
    (row,) = parsed(spark, json.dumps({**GOOD, **change}))
    assert row["status"] == status


def test_missing_field_and_malformed_text(spark):
    short = {k: v for k, v in GOOD.items() if k != "TIMESTAMP"}
    got = parsed(spark, json.dumps(short), "{not json", "", None)
    assert [r["status"] for r in got][:2] == ["missing_field", "malformed"]
    assert all(r["status"] != "valid" for r in got)


def test_milliseconds_are_stated_not_guessed(spark):
    (row,) = parsed(spark, json.dumps({**GOOD, "TIMESTAMP": 1717171717567}), ts_unit="ms")
    assert row["ts"] == 1717171717
    with pytest.raises(ValueError):
        parsed(spark, json.dumps(GOOD), ts_unit="hours")


def test_split_loses_nothing(spark):
    texts = [json.dumps(GOOD), "{", json.dumps({**GOOD, "TX_AMOUNT": "x"})]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "tx_id long, value string")
    valid, quarantine = validate_split(parse_events(df))
    assert valid.count() == 1
    assert [(r["tx_id"], r["value"], r["reason"]) for r in rows(quarantine, "tx_id")] == [
        (1, "{", "malformed"),
        (2, texts[2], "bad_type"),
    ]
