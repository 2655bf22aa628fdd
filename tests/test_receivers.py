from pyspark.sql import functions as F

from blockbeam.operators import receivers as R


def _activity(spark, rises):
    """receiver -> list of 0/1 rises; prices: close 100 at t, +1 (rise) or -1 (fall) later."""
    rows, candles, t = [], [], 0
    for rcv, flags in rises.items():
        for f in flags:
            rows.append((t, rcv, 1, 1.0, 100.0))
            candles += [(t, 100.0), (t + 60, 101.0 if f else 99.0)]
            t += 120
    act = spark.createDataFrame(rows, "t long, receiver string, n_txns int, amount double, close double")
    c = spark.createDataFrame(candles, "unix long, close double")
    return act, c


def test_exact_ratios_quirk_q1(spark):
    rises = {"r90": [1] * 9 + [0], "r80": [1] * 8 + [0] * 2, "r75": [1] * 3 + [0],
             "r70": [1] * 7 + [0] * 3, "r65": [1] * 13 + [0] * 7}
    act, c = _activity(spark, rises)
    dbl = R.hit_rates(act, c, {"r4": 60})
    got = {r.threshold: sorted(x.receiver for x in r.rs) for r in
           R.scores_by_threshold(dbl).groupBy("threshold").agg(F.collect_list(F.struct("receiver")).alias("rs")).collect()}
    # doubles: every exact ratio passes its own threshold
    assert got[0.9] == ["r90"] and got[0.65] == ["r65", "r70", "r75", "r80", "r90"]
    f32 = R.hit_rates(act, c, {"r4": 60}, float32=True)
    passed = {r.receiver for r in R.scores_by_threshold(f32).filter("threshold = 0.9").collect()}
    assert passed == set()  # single precision 0.9f < 0.9: the reference drops it


def test_popularity_and_histogram(spark):
    rows = [(t, "a") for t in range(10)] + [(t, "b") for t in range(5)] + [(0, "c")]
    act = spark.createDataFrame(rows, "t long, receiver string")
    pop = {r.receiver: r.fraction for r in R.receiver_popularity(act).collect()}
    assert pop == {"a": 1.0, "b": 0.5, "c": 0.1}
    h = R.popularity_histogram(R.receiver_popularity(act)).first()
    assert h.n_receivers == 3 and h.n_gt_0_2 == 2 and h.n_ge_0_00625 == 3


def test_coverage_empty_set_is_null_q6(spark):
    outs = spark.createDataFrame([("b1", 0, "x"), ("b1", 0, "y"), ("b2", 60, "y")],
                                 "block_id string, time long, receiver string")
    scores = spark.createDataFrame([("x", 0.8), ("y", 0.66), ("z", 0.7)], "receiver string, r4 double")
    cov = {r.block_id: r for r in R.block_coverage(outs, scores).collect()}
    assert cov["b1"].n_unique_receivers == 2
    assert cov["b1"].coverage_65 == 2 / 3 and cov["b2"].coverage_65 == 1 / 3
    assert cov["b1"].coverage_80 == 1.0 and cov["b2"].coverage_80 == 0.0
    assert cov["b1"].coverage_90 is None  # empty scored set


def test_popular_activity_semi_join(spark):
    act = spark.createDataFrame([(0, "a"), (0, "b"), (60, "a")], "t long, receiver string")
    pop = spark.createDataFrame([("a", 0.5)], "receiver string, fraction double")
    assert R.popular_activity(act, pop).count() == 2


def test_bitmap_lets_every_member_pass_and_few_others(spark):
    members = spark.range(0, 30_000, 3).selectExpr("cast(id as string) as receiver")
    df = spark.range(30_000).selectExpr("cast(id as string) as receiver", "id")
    kept = {r.id for r in R.maybe_member(df, "receiver", members, 10_000).collect()}
    assert kept >= set(range(0, 30_000, 3))
    assert len(kept) - 10_000 < 0.1 * 20_000
    # a bitmap that is too small for its members drops none of them either
    assert R.maybe_member(df, "receiver", members, 1).filter("id % 3 = 0").count() == 10_000
    assert R.maybe_member(df, "receiver", members.limit(0), 0).count() == 0


def test_coverage_prunes_pairs_before_the_shuffle(spark):
    outs = spark.createDataFrame([(f"b{i % 7}", i % 7 * 60, f"r{i % 50}") for i in range(500)], "block_id string, time long, receiver string")
    scores = spark.createDataFrame([("r1", 0.9), ("r2", 0.5), ("nobody", 0.7)], "receiver string, r4 double")
    cov = R.block_coverage(outs, scores)
    plan = cov._jdf.queryExecution().executedPlan().toString()
    assert "bitmap_construct_agg" in plan and "getbit" in plan.lower()
    got = {r.block_id: r for r in cov.collect()}
    for i in range(7):
        mine = {f"r{k % 50}" for k in range(500) if k % 7 == i}
        assert got[f"b{i}"].n_unique_receivers == len(mine)
        assert got[f"b{i}"].coverage_65 == ("r1" in mine) / 2 and got[f"b{i}"].coverage_90 == float("r1" in mine)
