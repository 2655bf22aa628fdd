"""The real-input jobs, run on block files and a candle parquet written from the
stand-in tables, agree with the registered stand-in queries."""

import os

import pytest
from pyspark.sql import functions as F

from blockbeam.plans import ledger_jobs as LJ, standins as S
from blockbeam.plans.q_chain import block_activity_job
from blockbeam.plans.q_receivers import features
from blockbeam.plans.nested import fold_outputs
from blockbeam.plans.q_sources import block_dir

SF = "/root/testdata/sf0.001"
# stand-in time units; amounts in the files are cents, read back as coins of 1e8 units
STANDIN = ["--grain", "86400", "--hour", "172800", "--receiver-cut-index", str(S.RECEIVER_CUT_INDEX),
           "--train-v2", str(S.TRAIN_BLOCKS_V2), "--valid", str(S.VALID_BLOCKS), "--fanout-min", str(S.FANOUT_MIN),
           "--high-value", str(S.HIGH_VALUE * 100 / 1e8), "--missing", "drop", "--fewer", "last"]


@pytest.fixture(scope="module")
def inputs(spark):
    from blockbeam.sinks.scratch import scratch_path
    # the flat stand-in's (day, status) blocks, small at this scale; the status letter is the nonce
    nested = fold_outputs(S.outputs(spark, SF))
    blocks = block_dir(spark, nested.withColumn("nonce", F.ascii(F.substring_index("block_id", "-", -1)).cast("long")))
    cpath = scratch_path(spark, "candles.parquet")
    S.daily_candles(spark, SF).write.parquet(cpath)
    return blocks, cpath, scratch_path(spark, "ledger_out")


def test_block_activity_matches_standin(spark, inputs):
    blocks, cpath, out = inputs
    LJ.run(spark, ["block-activity", "--blocks", blocks, "--candles", cpath, "--out", out, *STANDIN])
    got = spark.read.option("header", True).option("inferSchema", True).csv(f"{out}/block_activity")
    want = block_activity_job(spark, SF)
    g = {r.block_timestamp: r for r in got.collect()}
    w = {r.block_timestamp: r for r in want.collect()}
    assert set(g) == set(w)
    for t, r in w.items():
        assert g[t].num_txns_in_block == r.num_txns_in_block
        assert g[t].btc_usd_price_24_hrs_later == r.btc_usd_price_24_hrs_later
        assert abs(g[t].total_btc_in_block * 1e6 - r.total_btc_in_block) < 1e-6 * max(1, r.total_btc_in_block)


def test_receiver_chain_and_features_match_standin(spark, inputs):
    blocks, cpath, out = inputs
    common = ["--blocks", blocks, "--candles", cpath, "--out", out, *STANDIN]
    LJ.run(spark, ["receiver-raw", *common])
    sc = LJ.run(spark, ["receiver-scores", *common])
    counts = LJ.run(spark, ["block-features", *common, "--version", "2"])
    want = features(spark, SF, 2)
    assert counts == {r.split: r["count"] for r in want.groupBy("split").count().collect()}
    cols = ["blockFloorTime", "numUniqueReceivers", "numTxnsInBlock", "proportionOfReceiversWith65AccInBlock",
            "proportionOfReceiversWith80AccInBlock", "currBitcoinPrice", "label", "split"]
    got = spark.read.parquet(f"{out}/block_features_v2").select(*cols)
    key = lambda r: tuple((v is None, v if v is not None else 0) for v in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, want.select(*cols).collect()), key=key)
    assert sc["scored"] > 0


def test_tx_listing_and_train_report(spark, inputs):
    blocks, cpath, out = inputs
    common = ["--blocks", blocks, "--candles", cpath, "--out", out, *STANDIN]
    listing = LJ.run(spark, ["tx-listing", *common])
    outs = S.outputs(spark, SF)
    assert listing["n_txns"] == outs.select("txid").distinct().count()
    assert listing["min_time"] == outs.agg(F.min("time")).first()[0]
    if not os.path.exists(f"{out}/block_features_v1".removeprefix("file:")):
        LJ.run(spark, ["receiver-raw", *common])
        LJ.run(spark, ["receiver-scores", *common])
    LJ.run(spark, ["block-features", *common, "--version", "1", "--train-v1", str(S.TRAIN_BLOCKS_V1)])
    rep = LJ.run(spark, ["train-report", *common, "--version", "1"])
    assert {k.split(":")[0] for k in rep} <= {"valid", "test"} and rep


def test_candle_compaction_and_rolling_slope(spark, tmp_out):
    from blockbeam.sources.text import ACTIVITY_COUNT_COLUMN, ACTIVITY_TIME_COLUMN
    base, out = tmp_out("runner_in"), tmp_out("runner_out")
    rows = [[60.0 * i, 1.0, 3.0, 1.5, 2.0 + i, 10.0] for i in range(5)]
    spark.createDataFrame([(str(rows[:3]),), (str(rows[2:]),)], "value string").write.text(f"{base}/payloads")
    csvs = f"{base}/csvs".removeprefix("file:")
    os.makedirs(csvs)
    with open(f"{csvs}/w1_data.csv", "w") as f:
        f.write("unix,low,high,open,close,volume,date,vol_fiat\n240,1.0,3.0,1.5,6.0,10.0,x,60.0\n300,1.0,3.0,1.5,9.0,10.0,x,90.0\n")
    with open(f"{csvs}/w1.csv", "w") as f:
        f.write("not a candle file\n")
    got = LJ.run(spark, ["candle-compaction", "--payloads", f"{base}/payloads", "--candle-csvs", f"{base}/csvs", "--out", out])
    assert got == {"rows": 6}
    t = spark.read.parquet(f"{out}/candles").orderBy("unix").collect()
    assert [r.unix for r in t] == [0, 60, 120, 180, 240, 300] and t[5].vol_fiat == 90.0

    with open(f"{base}/activity.csv".removeprefix("file:"), "w") as f:
        f.write(f"{ACTIVITY_TIME_COLUMN},{ACTIVITY_COUNT_COLUMN}\n")
        f.write("".join(f"2022-01-01 0{h}:00:00,{n}\n" for h, n in enumerate((5, 1, 4, 4, 9, 2))))
    assert LJ.run(spark, ["rolling-slope", "--activity", f"{base}/activity.csv", "--out", out]) == {"rows": 6}
    s = spark.read.option("header", True).schema("ts string, n long, slope double").csv(f"{out}/rolling_slope").orderBy("ts").collect()
    # the first row's frame is 5, 1, 4, 4 walked backwards: 4, 4, 1, 5
    assert abs(s[0].slope - 0.0) < 1e-12 and s[5].slope is None and abs(s[4].slope - 7.0) < 1e-12
