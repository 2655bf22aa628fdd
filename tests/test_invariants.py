"""Invariants on the stand-in pipeline."""

from pyspark.sql import functions as F

from blockbeam.operators import chain, receivers as R
from blockbeam.plans import standins as S
from blockbeam.plans.q_receivers import features, raw, scores

SF = "/root/testdata/sf0.001"


def test_activity_sums_equal_output_sums(spark):
    outs = S.outputs(spark, SF)
    act = R.receiver_activity(outs, S.GRAIN)
    a = act.agg(F.sum("amount"), F.sum("n_txns")).first()
    o = outs.agg(F.sum("amount"), F.count(F.lit(1))).first()
    assert a[0] == o[0] and a[1] == o[1]
    blk = chain.block_summary(outs).agg(F.sum("total_amount"), F.sum("n_txns")).first()
    assert blk[0] == o[0] and blk[1] == outs.select("txid").distinct().count()


def test_ratios_within_unit_interval(spark):
    s = scores(spark, SF)
    for c in ("r30", "r1", "r2", "r3", "r4"):
        assert s.filter((F.col(c) < 0) | (F.col(c) > 1)).count() == 0
    f = features(spark, SF, 2)
    for p in (65, 70, 75, 80, 90):
        c = f"proportionOfReceiversWith{p}AccInBlock"
        assert f.filter((F.col(c) < 0) | (F.col(c) > 1)).count() == 0


def test_splits_disjoint_and_covering(spark):
    f = features(spark, SF, 2)
    assert f.select("blockId").distinct().count() == f.count()
    assert set(r.split for r in f.select("split").distinct().collect()) <= {"train", "valid", "test"}
    r = raw(spark, SF)
    cut = r.filter("split = 'train'").agg(F.max("t")).first()[0]
    assert r.filter("split = 'test'").agg(F.min("t")).first()[0] is None or \
        r.filter("split = 'test'").agg(F.min("t")).first()[0] > cut
