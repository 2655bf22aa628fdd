import pytest

from pyspark.sql import functions as F

from blockbeam.operators import splits as Sp


def test_chronological_split_disjoint_and_covering(spark):
    df = spark.createDataFrame([(t // 2, f"b{t:03d}") for t in range(50)], "time long, id string")
    s = Sp.chronological_split(df, ["time", "id"], 20, 7)
    counts = {r.split: r.n for r in s.groupBy("split").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert counts == {"train": 20, "valid": 7, "test": 23}
    tr_max = s.filter("split = 'train'").agg(F.max(F.struct("time", "id"))).first()[0]
    va_min = s.filter("split = 'valid'").agg(F.min(F.struct("time", "id"))).first()[0]
    assert tuple(tr_max) < tuple(va_min)
    assert Sp.except_rows(df, Sp.first_n(df, ["time", "id"], 20)).count() == 30


def test_nth_key_and_temporal_split(spark):
    df = spark.createDataFrame([(t,) for t in (10, 10, 20, 30, 40)], "t long")
    cut = df.select(Sp.nth_key(df, "t", 2).alias("c")).first().c
    assert cut == 20
    s = Sp.temporal_split(df, "t", Sp.nth_key(df, "t", 2))
    assert s.filter("split = 'train'").count() == 3
    assert df.select(Sp.nth_key(df, "t", 99, fewer="last").alias("c")).first().c == 40
    with pytest.raises(Exception, match="fewer than 99"):
        df.select(Sp.nth_key(df, "t", 99).alias("c")).collect()


def test_embargo_q4(spark):
    df = spark.createDataFrame([(t * 60, f"b{t:03d}") for t in range(20)], "time long, id string")
    s = Sp.chronological_split(df, ["time", "id"], 10, 5, embargo=180)
    got = {r.id: r.split for r in s.collect()}
    # the first non-train block is at 600 s: train rows after 600 - 180 = 420 s are embargoed
    assert got["b007"] == "train" and got["b008"] == "embargo" and got["b009"] == "embargo"
    assert got["b010"] == "valid" and got["b015"] == "test"
    assert Sp.chronological_split(df, ["time", "id"], 10, 5).filter("split = 'embargo'").count() == 0


@pytest.mark.parametrize("n", [1, 300, 999, 1000, 1700, 2000])
def test_a_far_cut_is_narrowed_down(spark, n):
    """Cuts beyond the merge bound equal a sort's: hot keys, nulls and pairs; the merge stays bounded."""
    import random

    rnd = random.Random(n)
    rows = [(None if i % 50 == 0 else 700 if i % 3 == 0 else rnd.randrange(10_000), f"b{i:04d}") for i in range(2000)]
    df = spark.createDataFrame(rows, "t long, id string").repartition(5)
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    one = df.limit(1)
    cut = one.select(Sp.nth_key(df, "t", n, distinct=False, merged=60).alias("c")).first().c
    assert cut == ordered[n - 1][0]
    pair = one.select(Sp.nth_key(df, ["t", "id"], n, distinct=False, merged=60).alias("c")).first().c
    assert tuple(pair) == ordered[n - 1]
    left, place = Sp.narrowed(df.select("t").withColumnRenamed("t", "_k"), n, 60)
    assert left.count() <= 60 and 1 <= place <= 60


def test_a_cut_beyond_all_keys(spark):
    df = spark.range(500).selectExpr("id as t")
    one = df.limit(1)
    assert one.select(Sp.nth_key(df, "t", 700, fewer="last", merged=20).alias("c")).first().c == 499
    with pytest.raises(Exception, match="fewer than"):
        one.select(Sp.nth_key(df, "t", 700, merged=20).alias("c")).collect()
