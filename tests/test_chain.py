from pyspark.sql import functions as F

from blockbeam.operators import chain as CH

NESTED = "block_id string, time long, txs array<struct<txid: string, outs: array<struct<amount_sat: bigint, script: string>>>>"


def _blocks(spark):
    b1 = ("b1", 125, [("cb1", [(625000000 + 1000, "aa"), (0, "bb")]),
                      ("t1", [(10 * 10 ** 8, "cc"), (5, "aa")] + [(1, f"{i:02x}") for i in range(9)]),
                      ("t2", [(7, "cc")])])
    b2 = ("b2", 170, [("cb2", [(625000000 + 5, "dd")])])
    return spark.createDataFrame([b1, b2], NESTED)


def test_nested_and_flat_agree(spark):
    blocks = _blocks(spark)
    nested = {r.block_id: r for r in CH.block_features_nested(blocks).collect()}
    outs = CH.explode_outputs(blocks)
    flat = {r.block_id: r for r in CH.block_summary(outs, subsidy=6.25).collect()}
    b1n, b1f = nested["b1"], flat["b1"]
    assert b1n.n_txns == b1f.n_txns == 3
    assert b1n.fee_reward_sat == 1000 and float(b1f.fee_reward) == 1000 / 1e8
    assert b1n.n_fanout_txs == b1f.n_fanout_txs == 1          # t1 has 11 outputs (>= 10, Q13)
    assert b1n.n_high_value_outputs == b1f.n_high_value_outputs == 1
    assert float(b1f.total_amount) * 1e8 == b1n.total_sat


def test_drop_first_tx_positional_and_join(spark):
    outs = CH.explode_outputs(_blocks(spark))
    a = CH.drop_first_tx(outs, positional=True).select("txid").distinct().collect()
    b = CH.drop_first_tx(outs.withColumn("tx_pos", F.col("tx_pos") + 7)).select("txid").distinct().collect()
    assert sorted(r.txid for r in a) == sorted(r.txid for r in b) == ["t1", "t2"]


def test_block_activity_merges_blocks_in_one_minute(spark):
    outs = CH.explode_outputs(_blocks(spark))
    act = {r.t: r for r in CH.block_activity(outs, grain=60).collect()}
    assert set(act) == {120}
    assert act[120].n_txns == 4


def test_tx_fanout(spark):
    outs = CH.explode_outputs(_blocks(spark))
    f = {r.txid: (r.n_receivers, r.n_unique_receivers) for r in CH.tx_fanout(outs).collect()}
    assert f["cb1"] == (2, 2) and f["t1"][0] == 11


def test_nested_rows_do_not_grow_with_the_data(spark):
    from blockbeam.plans.nested import ORDERS_PER_BLOCK, nested_blocks
    blocks = {}
    for sf in ("0.001", "0.01"):
        b = nested_blocks(spark, f"/root/testdata/sf{sf}").select(F.size("txs").alias("n"))
        r = b.agg(F.count(F.lit(1)).alias("blocks"), F.max("n").alias("largest")).first()
        assert r.largest <= ORDERS_PER_BLOCK
        blocks[sf] = r.blocks
    assert blocks["0.01"] > 5 * blocks["0.001"]


def test_coinbase_filter_does_not_shuffle_the_outputs(spark):
    """A block with a third of all outputs; the outputs go straight through, only possible coinbases meet the blocks."""
    from blockbeam.operators import chain

    rows = [("hot" if i % 3 == 0 else f"b{i % 40}", i // 2 % 997, i) for i in range(6000)]
    rows += [(None, 5, 1), ("b1", None, 2), ("b1", -3, 3), ("b1", -3, 4)]
    outs = spark.createDataFrame(rows, "block_id string, tx_pos long, v long").repartition(4)
    first = {}
    for b, t, _ in rows:
        if b is not None and t is not None:
            first[b] = min(first.get(b, t), t)
    got = sorted(map(tuple, chain.drop_first_tx(outs).collect()))
    assert got == sorted(r for r in rows if r[0] is not None and r[1] is not None and r[1] > first[r[0]])
    plan = chain.drop_first_tx(outs)._jdf.queryExecution().executedPlan().toString()
    # the union's first branch, which nearly all rows take, has no exchange but that of the input
    branches = plan.split("Union", 1)[1].split("SortMergeJoin")[0] if "SortMergeJoin" in plan else plan.split("Union", 1)[1]
    assert "hashpartitioning(block_id" not in branches.split("BroadcastHashJoin")[0]


def test_coinbases_of_few_blocks_take_one_pass(spark, tmp_out, monkeypatch):
    """F16: the jobs read the outputs once to drop the coinbases of few blocks, with the same rows as by the bitmap."""
    from blockbeam.operators import chain
    from blockbeam.plans import jobs

    rows = [("hot" if i % 3 == 0 else f"b{i % 40}", 86400 * (i % 9), i // 2 % 997, f"r{i % 50}", i) for i in range(3000)]
    rows += [(None, 0, 5, "r1", 1), ("b1", 0, None, "r1", 2), ("b1", 0, -3, "r2", 3), ("b1", 0, -3, "r2", 4)]
    path = tmp_out("outs")
    spark.createDataFrame(rows, "block_id string, time long, tx_pos long, receiver string, amount long").write.parquet(path)
    outs = spark.read.parquet(path)
    assert sorted(map(tuple, chain.drop_first_tx(outs, few_blocks=41).collect())) == sorted(map(tuple, chain.drop_first_tx(outs).collect()))
    plans = {n: chain.drop_first_tx(outs, few_blocks=n)._jdf.queryExecution().executedPlan().toString() for n in (40, 41)}
    assert "Union" in plans[40] and "Union" not in plans[41] and "BroadcastHashJoin" in plans[41]
    asked = []
    real = chain.drop_first_tx
    monkeypatch.setattr(chain, "drop_first_tx", lambda df, **kw: asked.append(kw["few_blocks"]) or real(df, **kw))
    candles = spark.createDataFrame([(86400 * d, 1.0 + d) for d in range(9)], "unix long, close double")
    n = jobs.receiver_raw(outs, candles, grain=86400, cut_index=3).count()
    assert asked == [chain.FEW_BLOCKS] and n == real(outs).select("time", "receiver").distinct().count()
