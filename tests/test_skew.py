"""Hot keys: plans that split them, and results that do not change."""

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from riskloom.operators.enrich import match_label, match_pairs
from riskloom.operators.skew import hot_keys, is_small, split_hot
from riskloom.operators.windows import add_behavioral_features
from riskloom.session import scratch_dir


@contextmanager
def conf(spark, **settings):
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


# thresholds small enough for test data to count as skewed
SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
}


def final_plan(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan[: plan.index("Initial Plan")]


@pytest.fixture(scope="module")
def third_hot(spark):
    """30,000 rows, a third of them one sender's."""
    sender = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 500 + 100)
    return spark.range(0, 30000, 1, 8).select(
        F.col("id").alias("tx_id"),
        sender.cast("int").alias("sender_account_id"),
        (F.col("id") * 37 % (5 * 86400)).alias("ts"),
        (F.col("id") % 1000 / 10).alias("tx_amount"),
    )


def test_hot_keys_are_few_and_split_is_complete(third_hot):
    assert [r[0] for r in hot_keys(third_hot, "sender_account_id", 5000).collect()] == [7]
    cold, hot, _ = split_hot(third_hot, "sender_account_id", 5000)
    assert (cold.count(), hot.count()) == (20000, 10000)


def test_size_check(third_hot):
    assert is_small(third_hot, 30000) and not is_small(third_hot, 29999)


def test_ways_agree_for_a_hot_sender(third_hot):
    """The window way and the tick way give the same features."""
    plain = add_behavioral_features(third_hot)
    split = add_behavioral_features(third_hot, hot_rows=5000)
    same = ["tx_id", "prev_ts", "time_since_last_tx", "cnt_last_24h"]
    assert plain.select(same).exceptAll(split.select(same)).count() == 0
    both = plain.join(split.select("tx_id", F.col("sender_avg_amount").alias("a"), F.col("sender_std_amount").alias("s")), "tx_id")
    far = (F.abs(F.col("a") - F.col("sender_avg_amount")) > 1e-9) | (
        F.abs(F.col("s") - F.col("sender_std_amount")) > 1e-9
    )
    assert both.count() == 30000 and both.filter(far).count() == 0


def test_tick_groups_are_bounded(third_hot):
    """No exchange by the sender alone carries the hot sender's rows."""
    plan = final_plan(add_behavioral_features(third_hot, hot_rows=5000))
    assert "Union" in plan
    # the raw hot rows are shuffled by (sender, second)
    assert "hashpartitioning(sender_account_id" in plan and ", ts#" in plan


def test_group_of_copies_is_split_and_never_paired(spark):
    """A third of the predictions and of the labelled rows are copies of one transaction."""
    n = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))
    base = spark.range(0, 30000, 1, 8).select(
        F.col("id").alias("tx_id"),
        n.cast("int").alias("sender_account_id"),
        n.cast("int").alias("receiver_account_id"),
        F.lit("T").alias("tx_type"),
        F.lit(100).cast("long").alias("ts"),
        (n % 1000 / 10).alias("tx_amount"),
        F.repeat(F.md5(F.col("id").cast("string")), 3).alias("note"),
    )
    labelled = base.drop("tx_id", "note").withColumn("is_fraud", F.lit(True))
    with conf(spark, **SMALL):
        out = match_label(base, labelled)
        plan = final_plan(out)
    assert "skew=true" in plan
    assert out.count() == 30000
    assert out.agg(F.sum("n_matches")).first()[0] == 10000 * 10000 + 20000


class Named:
    """A session of a cluster that names its shared folder, or does not."""

    def __init__(self, folder, master="yarn"):
        self.conf = self
        self.sparkContext = self
        self.master = master
        self.folder = folder

    def get(self, key, default):
        assert key == "spark.checkpoint.dir"
        return self.folder or default


def test_scratch_folder(spark):
    first = scratch_dir(Named("s3a://shared/x/"), "part")
    assert first.startswith("s3a://shared/x/part-")
    assert first != scratch_dir(Named("s3a://shared/x/"), "part")
    with pytest.raises(ValueError):
        scratch_dir(Named(None), "part")
    assert scratch_dir(spark, "part")


@pytest.mark.parametrize("hot_rows", [0, 3])
@pytest.mark.parametrize("as_of", [None, "day"])
def test_windows_do_not_depend_on_the_switch(spark, hot_rows, as_of):
    """Repeated ids, ties, NULL times, ids, senders and amounts."""
    import random

    r = random.Random(hot_rows)
    data = [
        (
            r.choice([1, 1, 1, 2, None]),
            r.choice([None, *range(0, 400_000, 40_000)]),
            r.choice([None, 1.0, 2.5, 7.25]),
            r.choice([None, *range(40)]),
            f"d{r.randrange(3)}",
        )
        for _ in range(120)
    ]
    data += data[:20]
    df = spark.createDataFrame(
        data, "sender_account_id int, ts long, tx_amount double, tx_id long, day string"
    )

    def found(limit):
        out = add_behavioral_features(df, hot_rows=limit, as_of=as_of)
        for c in ("sender_avg_amount", "sender_std_amount"):
            out = out.withColumn(c, F.round(c, 6))
        return sorted(map(repr, out.collect()))

    assert found(hot_rows) == found(10**9)


def test_large_accounts_join_a_stream(spark, tmp_path):
    from riskloom.operators.enrich import join_accounts

    tx = spark.createDataFrame([(1, 10), (2, 11)], "tx_id long, sender_account_id int")
    tx.write.parquet(f"{tmp_path}/in")
    accounts = spark.createDataFrame(
        [(10, "a", "b")], "account_id int, customer_id string, country string"
    )
    stream = spark.readStream.schema(tx.schema).parquet(f"{tmp_path}/in")
    joined = join_accounts(stream, accounts, "left", ["country"], max_broadcast_rows=0)
    query = (
        joined.writeStream.format("memory").queryName("large_join").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    got = sorted((r["tx_id"], r["country"]) for r in spark.table("large_join").collect())
    assert got == [(1, "b"), (2, None)]


def test_no_part_of_a_large_group_holds_more_than_its_share(spark):
    one = spark.range(0, 3000, 1, 4).select(
        F.lit(1).alias("sender_account_id"),
        F.lit(2).alias("receiver_account_id"),
        F.lit("T").alias("tx_type"),
        F.lit(5).cast("long").alias("ts"),
        F.lit(1.0).alias("tx_amount"),
        F.lit(True).alias("is_fraud"),
    )
    with conf(spark, **SMALL, **{"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        out = match_pairs(one, one.limit(300), pair_rows=100)
        by_task = out.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert sum(r["count"] for r in by_task) == 900_000
    assert max(r["count"] for r in by_task) < 450_000
