"""The memory of a task doesn't grow with the input: more input makes more tasks (findings F1 to F15 and F17 to F20)."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from blockbeam import session

KEYS = ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum")


@pytest.fixture
def kept_conf(spark):
    old = {k: spark.conf.get(k, None) for k in KEYS}
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture
def tables(spark, tmp_out):
    d = tmp_out("tables")
    day = F.timestamp_seconds(F.lit(8100) * 86400 + F.col("o_orderkey") % 40 * 86400).cast("timestamp_ntz")
    orders = spark.range(5_000).withColumnRenamed("id", "o_orderkey")
    orders.select("o_orderkey", F.lit("F").alias("o_orderstatus"), F.col("o_orderkey").cast("double").alias("o_totalprice"),
                  day.alias("o_orderdate")).write.parquet(f"{d}/orders.parquet")
    lines = spark.range(15_000)
    lines.select((F.col("id") % 5_000).alias("l_orderkey"), (F.xxhash64("id") % 5000).alias("l_partkey"), F.col("id").alias("l_suppkey"),
                 F.floor(F.col("id") / 5_000).cast("int").alias("l_linenumber"), F.rand(1).alias("l_extendedprice")).write.parquet(f"{d}/lineitem.parquet")
    return d


@pytest.mark.parametrize("key", ["tx_fanout", "explode_txs", "job_receiver_raw"])
def test_tasks_follow_the_input(spark, tables, kept_conf, monkeypatch, key):
    """With a limit of 16 KB a task, small tables make several tasks; the session's four shuffle partitions aren't kept."""
    monkeypatch.setattr(session, "SCAN_BYTES", 16 << 10, raising=False)
    monkeypatch.setattr(session, "SHUFFLE_BYTES", 16 << 10, raising=False)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "1k")
    try:
        df = E.queries()[key](spark, tables)
        assert df.select(F.spark_partition_id().alias("p")).distinct().count() > 6
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.minPartitionSize")


def test_sizes_of_a_session(spark, tables, kept_conf):
    spark.conf.set(KEYS[0], "1m")
    session.apply_task_sizes(spark, 1 << 30)
    # a smaller size of the session stays; two partitions to begin with for each 8 MB of input
    assert [spark.conf.get(k) for k in KEYS] == [str(1 << 20), str(8 << 20), "256"]
    session.apply_task_sizes(spark, 1)
    assert spark.conf.get(KEYS[2]) == spark.conf.get("spark.sql.shuffle.partitions")
    assert session.stored_bytes(spark, [f"{tables}/orders.parquet", f"{tables}/none.parquet"]) > 10_000


@pytest.mark.parametrize("key", ["block_fee_reward", "block_features_nested", "snk_activity_csv_roundtrip", "receiver_frequency"])
def test_shuffles_follow_the_input(spark, tables, kept_conf, monkeypatch, key):
    """With a limit of 16 KB of a shuffle, and none of its own for scans, the widest stage has more tasks than the session's four
    shuffle partitions and the files that the tables have (findings F2 to F14, F18 and F19)."""
    monkeypatch.setattr(session, "SHUFFLE_BYTES", 16 << 10)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "1k")
    sc, group = spark.sparkContext, f"tasks of {key}"
    sc.setJobGroup(group, key)
    try:
        E.queries()[key](spark, tables).collect()
    finally:
        sc._jsc.clearJobGroup()
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.minPartitionSize")
    told = sc.statusTracker()
    stages = [told.getStageInfo(s) for j in told.getJobIdsForGroup(group) for s in told.getJobInfo(j).stageIds]
    assert max(s.numTasks for s in stages if s) > 12


@pytest.mark.parametrize("key", ["block_activity", "job_block_activity", "explode_outputs", "popularity_histogram"])
def test_more_input_makes_more_tasks(spark, tables, tmp_out, kept_conf, monkeypatch, key):
    """Three times the orders and lines make at least twice the tasks of the widest stage (findings F2, F3, F9 and F19)."""
    monkeypatch.setattr(session, "SHUFFLE_BYTES", 16 << 10)
    larger, sc = tmp_out("larger"), spark.sparkContext
    for name, order in (("orders", "o_orderkey"), ("lineitem", "l_orderkey")):
        df, copies = spark.read.parquet(f"{tables}/{name}.parquet"), spark.range(3).withColumnRenamed("id", "_copy")
        shifted = df.crossJoin(F.broadcast(copies)).withColumn(order, F.col(order) + F.col("_copy") * 5_000).drop("_copy")
        shifted.coalesce(4).write.parquet(f"{larger}/{name}.parquet")

    def widest(d):
        sc.setJobGroup(f"{key} of {d}", key)
        E.queries()[key](spark, d).collect()
        told = sc.statusTracker()
        stages = [told.getStageInfo(s) for j in told.getJobIdsForGroup(f"{key} of {d}") for s in told.getJobInfo(j).stageIds]
        return max(s.numTasks for s in stages if s)

    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "1k")
    try:
        assert widest(larger) >= 2 * widest(tables)
    finally:
        sc._jsc.clearJobGroup()
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.minPartitionSize")
