"""Readers, writers and jobs: round trips."""

import json
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from riskloom import fixtures as fx
from riskloom import schemas
from riskloom.operators import facts
from riskloom.operators.score import score_linear
from riskloom.plans import jobs
from riskloom.queries import _decided
from riskloom.session import listed
from riskloom.sinks import writers
from riskloom.sources import readers

ACCOUNTS = """ACCOUNT_ID,CUSTOMER_ID,INIT_BALANCE,COUNTRY,ACCOUNT_TYPE,TX_BEHAVIOR_ID
1,C_1,100.5,DE,I,1
2,C_2,15000,US,B,2
3,C_3,-5,FR,I,3
"""
TRANSACTIONS = """TX_AMOUNT,SENDER_ACCOUNT_ID,RECEIVER_ACCOUNT_ID,TX_TYPE,TIMESTAMP,IS_FRAUD
512.75,1,2,TRANSFER,1717171717,True
12.5,2,1,TRANSFER,1717171800,False
12.5,2,1,TRANSFER,1717171800,False
oops,2,1,TRANSFER,1717171801,False
5.0,99,1,TRANSFER,1717171802,False
7.0,3,1,,1717171803,False
"""


@pytest.fixture
def csv(tmp_path):
    (tmp_path / "accounts.csv").write_text(ACCOUNTS)
    (tmp_path / "transactions.csv").write_text(TRANSACTIONS)
    return tmp_path


def speed_scorer(df):
    return score_linear(df, fx.SPEED_INTERCEPT, fx.SPEED_TERMS)


def test_accounts_csv_to_both_layers(spark, csv):
    written = jobs.import_accounts(spark, f"{csv}/accounts.csv", f"{csv}/w")
    assert written == {"speed_layer": 3, "batch_layer": 3}
    for layer in schemas.LAYERS:
        table = spark.read.schema(schemas.ACCOUNTS).parquet(f"{csv}/w/{layer}/accounts")
        got = rows(table.select(*schemas.ACCOUNTS.fieldNames()), "account_id")
        assert got[1] == {
            "account_id": 2,
            "customer_id": "C_2",
            "init_balance": 15000.0,
            "country": "US",
            "account_type": "B",
            "is_fraud": None,
            "tx_behavior_id": 2,
        }


def test_accounts_are_replaced_by_key(spark, tmp_path):
    def made(*data):
        full = [(i, c, b, "US", "A", None, 1) for i, c, b in data]
        return spark.createDataFrame(full, schemas.ACCOUNTS).coalesce(1)

    def files(layer):
        folder = tmp_path / layer / "accounts"
        return {f.parent.name: f.name for f in folder.glob("bucket=*/*.parquet")}

    first = [(i, f"c{i}", float(i)) for i in range(200)] + [(None, "x", 1.0), (7, None, 2.0)]
    assert writers.write_accounts(made(*first), str(tmp_path)) == {"speed_layer": 202, "batch_layer": 202}
    before = files("speed_layer")
    # a changed row, one twice, a second customer of an account, a new one, and NULL keys
    second = [(3, "c3", 30.0), (4, "c4", 40.0), (4, "c4", 41.0), (4, "d", 5.0), (900, "n", 9.0)]
    second += [(None, "x", 11.0), (7, None, 22.0)]
    for _ in range(2):
        stored = writers.write_accounts(made(*second), str(tmp_path))
        assert stored == {"speed_layer": 204, "batch_layer": 204}
    want = {(i, c): b for i, c, b in [*first, *second]}
    for layer in schemas.LAYERS:
        table = spark.read.parquet(f"{tmp_path}/{layer}/accounts")
        assert {(r["account_id"], r["customer_id"]): r["init_balance"] for r in table.collect()} == want
    touched = {
        f"bucket={r['bucket']}"
        for r in table.filter("account_id IN (3, 4, 900, 7) OR account_id IS NULL").collect()
    }
    after = files("speed_layer")
    assert {b for b in after if after[b] != before.get(b)} == touched
    assert writers.write_accounts(made(*second), str(tmp_path), replace=True)["batch_layer"] == 6
    spark.range(2).write.parquet(f"{tmp_path}/old/speed_layer/accounts")
    with pytest.raises(ValueError, match="outside its bucket= folders"):
        writers.write_accounts(made(*first), f"{tmp_path}/old")


def test_csv_columns_are_found_by_name_and_bad_rows_kept(spark, csv):
    got = rows(readers.read_transactions_csv(spark, f"{csv}/transactions.csv"), "ts", "status")
    assert got[0]["tx_amount"] == 512.75 and got[0]["is_fraud"] is True
    assert [r["status"] for r in got] == ["valid"] * 3 + ["bad_type", "valid", "missing_field"]


def test_table_projection_reaches_the_scan(spark, csv):
    jobs.import_accounts(spark, f"{csv}/accounts.csv", f"{csv}/w")
    df = readers.read_table(spark, f"{csv}/w/batch_layer/accounts", ["account_id", "country"])
    plan = df.filter("account_id = 2")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<account_id:int,country:string>" in plan
    assert "EqualTo(account_id,2)" in plan


def test_tables_are_declared_for_both_layers(spark, tmp_path):
    made = writers.create_tables(spark, str(tmp_path))
    try:
        assert len(made) == 10
        batch = spark.table("batch_layer.transactions")
        assert batch.schema == schemas.stored_schema("batch_layer", "transactions")
        assert batch.columns[-1] == "dt"
        assert spark.table("speed_layer.alerts").columns[-1] == "batch_id"
        assert spark.table("batch_layer.accounts").columns == [*schemas.ACCOUNTS.fieldNames(), "bucket"]
        assert "speed_layer_treshold" in batch.columns
        assert "speed_layer_treshold" not in spark.table("speed_layer.transactions").columns
    finally:
        for name in made:
            spark.sql(f"DROP TABLE {name}")
        spark.sql("DROP DATABASE speed_layer")
        spark.sql("DROP DATABASE batch_layer")


def test_fan_out_tables_agree_and_are_clustered(spark, sf_dir, tmp_path):
    staged = facts.with_write_time(_decided(spark, sf_dir), F.lit("2024-02-01").cast("timestamp"))
    writers.write_fan_out(staged, str(tmp_path), "speed_layer")
    read = {t: spark.read.parquet(f"{tmp_path}/speed_layer/{t}") for t in (
        "transactions", "transactions_by_sender", "transactions_by_receiver", "alerts")}
    assert {t: df.count() for t, df in read.items()} == {
        "transactions": 1000,
        "transactions_by_sender": 1000,
        "transactions_by_receiver": 1000,
        "alerts": 30,
    }
    for table, df in read.items():
        assert set(df.columns) == set(schemas.SPEED_TABLES[table].fieldNames())
    alerts, positives = read["alerts"], read["transactions"].filter("is_fraud")
    assert alerts.join(positives, ["alert_id", "tx_id"]).count() == 30
    for part in Path(f"{tmp_path}/speed_layer/transactions_by_sender").glob("*.parquet"):
        keys = [(r[0], r[1]) for r in spark.read.parquet(str(part)).select("sender_account_id", "tx_id").collect()]
        assert keys == sorted(keys)


def test_scored_json_round_trip_and_pruning(spark, sf_dir, tmp_path):
    payload = facts.scored_payload(_decided(spark, sf_dir), F.lit("2024-02-01").cast("timestamp"))
    path = f"{tmp_path}/scored"
    writers.write_scored_json(payload, path)
    back = readers.read_scored_json(spark, path)
    assert back.count() == 1000
    assert back.columns == schemas.SCORED_TX.fieldNames()
    assert payload.exceptAll(back).count() == 0
    assert readers.read_scored_json(spark, path, since="2024-02-02").count() == 0
    late = readers.read_scored_json(spark, path, since="2024-02-01", until="2024-02-02")
    assert late.count() == 1000
    assert "PartitionFilters: [isnotnull(dt" in late._jdf.queryExecution().executedPlan().toString()


def test_json_arrays_are_read_as_rows(spark, tmp_path):
    records = [{"tx_id": str(i), "score": 0.5} for i in range(3)]
    (tmp_path / "batch.json").write_text(json.dumps(records))
    assert readers.read_scored_json(spark, str(tmp_path)).count() == 3


def test_batch_json_file_size(spark, sf_dir, tmp_path):
    ready = _decided(spark, sf_dir).withColumn("fraud_probability", F.col("score"))
    writers.write_batch_json(facts.batch_results(ready), f"{tmp_path}/out", rows_per_file=300)
    sizes = [len(p.read_text().splitlines()) for p in Path(f"{tmp_path}/out").glob("*.json")]
    assert sum(sizes) == 1000 and max(sizes) <= 300
    first = json.loads(next(Path(f"{tmp_path}/out").glob("*.json")).read_text().splitlines()[0])
    assert list(first) == schemas.BATCH_RESULT.fieldNames()


def test_predictions_csv_appends_with_dotted_names(spark, sf_dir, tmp_path):
    payload = facts.scored_payload(_decided(spark, sf_dir))
    path = f"{tmp_path}/csv"
    for _ in range(2):
        writers.write_predictions_csv(payload, path)
    header = next(Path(path).glob("*.csv")).read_text().splitlines()[0]
    assert "transaction.SENDER_ACCOUNT_ID" in header
    back = readers.read_predictions_csv(spark, path)
    assert back.count() == 2000
    assert {"sender_account_id", "ts", "score"} <= set(back.columns)


def test_publish_writes_one_message_per_record(spark, sf_dir, tmp_path):
    payload = facts.scored_payload(_decided(spark, sf_dir))
    writers.publish(payload, "text", f"{tmp_path}/topic")
    lines = [line for p in Path(f"{tmp_path}/topic").glob("*.txt") for line in p.read_text().splitlines()]
    assert len(lines) == 1000
    record = json.loads(lines[0])
    assert list(record) == schemas.SCORED_TX.fieldNames()
    assert list(record["transaction"]) == schemas.EVENT_FIELDS


def test_backfill_job(spark, csv):
    jobs.import_accounts(spark, f"{csv}/accounts.csv", f"{csv}/w")
    accounts = readers.read_table(spark, f"{csv}/w/speed_layer/accounts")
    speed = jobs.backfill(
        spark, f"{csv}/transactions.csv", accounts, speed_scorer, 0.5, f"{csv}/w"
    )
    assert speed["rows"] == 6 and speed["rows_per_second"] > 0
    table = rows(spark.read.parquet(f"{csv}/w/speed_layer/transactions"), "tx_amount")
    # two equal transactions stay two, under ids of their own
    assert [r["tx_amount"] for r in table] == [12.5, 12.5, 512.75]
    assert len({r["tx_id"] for r in table}) == 3
    quarantine = rows(spark.read.parquet(f"{csv}/w/speed_layer/quarantine"), "reason")
    assert [r["reason"] for r in quarantine] == ["bad_type", "missing_field", "no_account"]
    assert '"TX_AMOUNT":"oops"' in "".join(r["value"] for r in quarantine)
    assert readers.read_predictions_csv(spark, f"{csv}/w/predictions_csv").count() == 3
    # a second run changes nothing
    jobs.backfill(spark, f"{csv}/transactions.csv", accounts, speed_scorer, 0.5, f"{csv}/w")
    again = spark.read.parquet(f"{csv}/w/speed_layer/transactions")
    assert rows(again.drop("tx_timestamp"), "tx_amount", "tx_id") == rows(
        spark.createDataFrame(table, again.schema).drop("tx_timestamp"), "tx_amount", "tx_id"
    )
    assert readers.read_predictions_csv(spark, f"{csv}/w/predictions_csv").count() == 3


def test_batch_job_on_the_speed_layers_output(spark, sf_dir, tmp_path):
    payload = facts.scored_payload(_decided(spark, sf_dir), F.lit("2024-02-01").cast("timestamp"))
    writers.write_scored_json(payload, f"{tmp_path}/scored")
    jobs.batch_scoring(
        spark,
        f"{tmp_path}/scored",
        fx.accounts(spark, sf_dir),
        fx.batch_score,
        str(tmp_path),
    )
    out = spark.read.parquet(f"{tmp_path}/batch_layer/transactions")
    assert set(out.columns) == set(schemas.stored_schema("batch_layer", "transactions").fieldNames())
    rejected = spark.read.parquet(f"{tmp_path}/batch_layer/quarantine")
    # every transaction is either scored or set aside
    assert out.count() + rejected.count() == 1000 and rejected.count() > 0
    assert rejected.filter("init_balance_log IS NOT NULL").count() == 0
    assert out.filter("is_fraud_speed IS NULL OR speed_layer_score IS NULL").count() == 0
    alerts = spark.read.parquet(f"{tmp_path}/batch_layer/alerts")
    assert alerts.count() == out.filter("is_fraud").count() > 0
    results = spark.read.schema(schemas.BATCH_RESULT).json(f"{tmp_path}/batch_layer/results_json")
    n_rows = results.count()
    assert n_rows == out.count()
    assert results.filter("is_fraud != (fraud_probability > 0.5)").count() == 0
    # writing it again gives the same rows
    jobs.batch_scoring(
        spark, f"{tmp_path}/scored", fx.accounts(spark, sf_dir), fx.batch_score, str(tmp_path)
    )
    again = spark.read.parquet(f"{tmp_path}/batch_layer/transactions")
    assert again.count() == n_rows


DAYS = ["2024-02-01", "2024-02-02", "2024-02-03"]
STORED = ("transactions", "transactions_by_sender", "alerts", "quarantine")


def _lets_through(df):
    """Scores, and keeps two window features, to compare them too."""
    kept = F.round(F.col("sender_avg_amount") + F.col("cnt_last_24h"), 6)
    return fx.batch_score(df).withColumn("speed_layer", kept).withColumn("tx_amount", kept)


class Batches:
    """Days of scored records, and the tables that batch runs make of them."""

    def __init__(self, spark, sf_dir, base, day_of=None):
        self.spark, self.base = spark, base
        self.accounts = fx.accounts(spark, sf_dir)
        self.scored = _decided(spark, sf_dir)
        low, high = self.scored.agg(F.min("ts"), F.max("ts")).first()
        third = F.floor((F.col("ts") - low) * 3 / (high + 1 - low))
        self.day_of = third if day_of is None else day_of(third)

    def add(self, k, name):
        part = self.scored.filter(self.day_of == k)
        moment = F.lit(DAYS[k]).cast("timestamp")
        writers.write_scored_json(facts.scored_payload(part, moment), f"{self.base}/{name}")

    def run(self, name, out, **options):
        args = (self.spark, f"{self.base}/{name}", self.accounts, _lets_through, f"{self.base}/{out}")
        jobs.batch_scoring(*args, **options)

    def stored(self, out, table="transactions"):
        df = self.spark.read.parquet(f"{self.base}/{out}/batch_layer/{table}")
        return rows(df.drop("tx_timestamp", "alert_timestamp"), "tx_id")


def test_full_daily_and_repeated_runs_equal_one_run(spark, sf_dir, tmp_path):
    made = Batches(spark, sf_dir, tmp_path)
    for k in range(3):
        made.add(k, "all")
    made.run("all", "whole", as_of_day=True)
    for k in range(3):
        made.add(k, "growing")
        if k == 0:
            made.run("growing", "daily", as_of_day=True)  # everything there is
        else:
            made.run("growing", "daily", since=DAYS[k])
    made.run("growing", "daily", since=DAYS[2])  # a day again
    for table in STORED:
        assert made.stored("daily", table) == made.stored("whole", table)
    assert len({r["dt"] for r in made.stored("daily")}) == 3
    assert all(r["reasons"] for r in made.stored("daily", "quarantine"))
    # declared tables read what was written, under the schema they were declared with
    names = writers.create_tables(spark, f"{tmp_path}/daily")
    try:
        table = spark.table("batch_layer.transactions")
        assert table.schema == schemas.stored_schema("batch_layer", "transactions")
        assert table.count() == len(made.stored("whole"))
        made.run("growing", "daily", since=DAYS[2], threshold=2.0)
        writers.recover_tables(spark, f"{tmp_path}/daily")
        assert spark.table("batch_layer.transactions").schema == table.schema
        assert spark.table("batch_layer.transactions").count() == len(made.stored("whole"))
        assert spark.table("batch_layer.alerts").filter(f"dt = '{DAYS[2]}'").count() == 0
    finally:
        for name in names:
            spark.sql(f"DROP TABLE {name}")
        spark.sql("DROP DATABASE speed_layer")
        spark.sql("DROP DATABASE batch_layer")
    # nothing is left staged
    assert listed(spark, f"{tmp_path}/daily/batch_layer/staged") == []


def test_late_events_are_scored_with_the_days_they_change(spark, sf_dir, tmp_path):
    # some events of the first day arrive with the third
    late = F.col("tx_id").cast("long") % 40 == 3
    made = Batches(spark, sf_dir, tmp_path, lambda third: F.when((third == 0) & late, 2).otherwise(third))
    for k in range(3):
        made.add(k, "all")
    made.run("all", "whole", as_of_day=True)
    made.add(0, "growing")
    made.add(1, "growing")
    made.run("growing", "daily", as_of_day=True)
    made.add(2, "growing")
    with pytest.raises(ValueError, match="late events change rows from 2024-02-01"):
        made.run("growing", "daily", since=DAYS[2], late="error")
    made.run("growing", "daily", since=DAYS[2])
    for table in STORED:
        assert made.stored("daily", table) == made.stored("whole", table)


def test_interrupted_runs_are_finished_and_empty_days_vanish(spark, sf_dir, tmp_path, monkeypatch):
    made = Batches(spark, sf_dir, tmp_path)
    made.add(0, "in")
    made.add(1, "in")
    made.run("in", "out", as_of_day=True)
    before = made.stored("out")

    def lost(*args, **named):
        raise RuntimeError("lost")

    # the run is cut off after some tables were replaced
    monkeypatch.setattr(writers, "write_batch_json", lost)
    with pytest.raises(RuntimeError):
        made.run("in", "out", since=DAYS[1], threshold=2.0)
    monkeypatch.undo()
    assert len(jobs.finish_runs(spark, f"{tmp_path}/out")) == 1
    assert jobs.finish_runs(spark, f"{tmp_path}/out") == []
    after = made.stored("out")
    assert [r["tx_id"] for r in after] == [r["tx_id"] for r in before]
    # nothing of the second day is above the threshold now, so its old alerts are gone
    assert not any(r["is_fraud"] for r in after if str(r["dt"]) == DAYS[1])
    assert {str(r["dt"]) for r in made.stored("out", "alerts")} == {DAYS[0]}


def test_flat_tables_are_refused(spark, sf_dir, tmp_path):
    made = Batches(spark, sf_dir, tmp_path)
    made.add(0, "in")
    spark.range(3).write.parquet(f"{tmp_path}/out/batch_layer/transactions")
    with pytest.raises(ValueError, match="outside its dt= folders"):
        made.run("in", "out")


def test_files_with_other_headers_are_an_error(spark, tmp_path):
    head = "SENDER_ACCOUNT_ID,RECEIVER_ACCOUNT_ID,TX_TYPE,TX_AMOUNT,TIMESTAMP,IS_FRAUD"
    swapped = "RECEIVER_ACCOUNT_ID,SENDER_ACCOUNT_ID,TX_TYPE,TX_AMOUNT,TIMESTAMP,IS_FRAUD"
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text(head + "\n1,2,TRANSFER,5.0,10,maybe\n")
    got = rows(readers.read_transactions_csv(spark, f"{tmp_path}/in"))
    assert got[0]["is_fraud"] is None and got[0]["status"] == "bad_type"
    (tmp_path / "in" / "b.csv").write_text(swapped + "\n1,2,TRANSFER,5.0,10,true\n")
    with pytest.raises(Exception, match="(?i)header"):
        readers.read_transactions_csv(spark, f"{tmp_path}/in").collect()
