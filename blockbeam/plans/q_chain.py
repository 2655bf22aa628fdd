"""Registered queries: block, transaction and output operators (JOB-1, JOB-7,
PRJ-1..6, PRJ-10, FLT-4, AGG-2, AGG-7..12, ARR-1, SET-5, SRT-1, SRT-3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalars import epoch_seconds, floor_time
from ..operators import chain, prices
from . import standins as S
from .catalog import query
from .nested import flat_transactions, nested_blocks
from .sqlviews import ACTIVITY, BLOCKS, CANDLES, FIRSTS, NESTED_OUTS, OUTS, epoch, hours, with_

# Column names of the block-activity table (fixed values: the reference's CSV header).
ACTIVITY_COLUMNS = ("block_timestamp", "num_txns_in_block", "total_btc_in_block", "total_fee_reward",
                    "btc_usd_price_at_timestamp", "btc_usd_price_4_hrs_later", "btc_usd_price_6_hrs_later",
                    "btc_usd_price_12_hrs_later", "btc_usd_price_24_hrs_later")
ACTIVITY_OFFSETS_H = (0, 4, 6, 12, 24)


def block_activity_job(spark, sf, missing="drop"):
    """JOB-1: per-minute activity with the price now and 4, 6, 12, 24 hours later."""
    act = chain.block_activity(S.outputs(spark, sf), grain=S.GRAIN, subsidy=S.SUBSIDY)
    offs = {f"_p{h}": hours(h) for h in ACTIVITY_OFFSETS_H}
    priced = prices.with_prices(act, S.daily_candles(spark, sf), offs, time_col="t", missing=missing)
    names = dict(zip(["t", "n_txns", "total_amount", "fee_reward", *offs], ACTIVITY_COLUMNS))
    return priced.select(*[F.col(k).alias(v) for k, v in names.items()]).orderBy("block_timestamp")


_JOB1_SQL = with_(OUTS, CANDLES, FIRSTS, BLOCKS, ACTIVITY) + f"""
SELECT a.t AS block_timestamp, CAST(a.n_txns AS BIGINT) AS num_txns_in_block,
       CAST(a.total_amount AS DOUBLE) AS total_btc_in_block, CAST(a.fee_reward AS DOUBLE) AS total_fee_reward,
       c0.close AS btc_usd_price_at_timestamp, c4.close AS btc_usd_price_4_hrs_later,
       c6.close AS btc_usd_price_6_hrs_later, c12.close AS btc_usd_price_12_hrs_later,
       c24.close AS btc_usd_price_24_hrs_later
FROM act a JOIN candles c0 ON c0.unix = a.t JOIN candles c4 ON c4.unix = a.t + {hours(4)}
JOIN candles c6 ON c6.unix = a.t + {hours(6)} JOIN candles c12 ON c12.unix = a.t + {hours(12)}
JOIN candles c24 ON c24.unix = a.t + {hours(24)}
ORDER BY block_timestamp"""

query("job_block_activity", _JOB1_SQL)(block_activity_job)


@query("block_activity", with_(OUTS, FIRSTS, BLOCKS, ACTIVITY) + """
SELECT t, CAST(n_txns AS BIGINT) AS n_txns, CAST(total_amount AS DOUBLE) AS total_amount,
       CAST(fee_reward AS DOUBLE) AS fee_reward FROM act""")
def q_block_activity(spark, sf):
    """AGG-2: per day, Σ transactions, Σ amount and Σ fee reward over its blocks."""
    return chain.block_activity(S.outputs(spark, sf), grain=S.GRAIN, subsidy=S.SUBSIDY)


@query("floor_time", f"""
SELECT event_id, {epoch('ts')} - {epoch('ts')} % 60 AS t_minute,
       {epoch('ts')} - {epoch('ts')} % 3600 AS t_hour FROM events""")
def q_floor_time(spark, sf):
    """PRJ-1: event times floored to the minute and to the hour."""
    e = S.table(spark, sf, "events")
    s = epoch_seconds("ts")
    return e.select("event_id", floor_time(s, 60).alias("t_minute"), floor_time(s, 3600).alias("t_hour"))


# ------------------------------------------------------------------ nested flattening

_TXPOS_SQL = """txs AS (
  SELECT block_id, time, txid, count(*) AS n_outputs, count(DISTINCT receiver) AS n_unique_scripts,
         CAST(dense_rank() OVER (PARTITION BY block_id ORDER BY txid) - 1 AS INTEGER) AS tx_pos
  FROM outs GROUP BY block_id, time, txid)"""


@query("explode_txs", with_(NESTED_OUTS, _TXPOS_SQL) + """
SELECT block_id, time, tx_pos, txid, CAST(n_outputs AS INTEGER) AS n_outputs FROM txs""")
def q_explode_txs(spark, sf):
    """PRJ-2: nested blocks flattened to one row per transaction with its position."""
    return chain.explode_txs(nested_blocks(spark, sf)).select(
        "block_id", "time", "tx_pos", "txid", F.size("outs").alias("n_outputs"))


@query("explode_outputs", with_(NESTED_OUTS, _TXPOS_SQL) + """
SELECT o.block_id, o.time, t.tx_pos, o.txid,
       CAST(row_number() OVER (PARTITION BY o.txid ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1
            AS INTEGER) AS out_pos,
       CAST(round(o.amount * 100) AS BIGINT) AS amount_sat, o.receiver AS script,
       CAST(t.n_outputs AS INTEGER) AS n_outputs, CAST(t.n_unique_scripts AS INTEGER) AS n_unique_scripts
FROM outs o JOIN txs t USING (txid)""")
def q_explode_outputs(spark, sf):
    """PRJ-3: nested blocks flattened to one row per output, carrying its parents."""
    return chain.explode_outputs(nested_blocks(spark, sf), with_keys=False).select(
        "block_id", "time", "tx_pos", "txid", "out_pos", "amount_sat", "script", "n_outputs", "n_unique_scripts")


@query("drop_first_tx", with_(OUTS) + """
SELECT block_id, txid, receiver, CAST(amount AS DOUBLE) AS amount FROM outs o
WHERE txid > (SELECT min(txid) FROM outs i WHERE i.block_id = o.block_id)""")
def q_drop_first_tx(spark, sf):
    """PRJ-4: outputs of every transaction except each block's first (coinbase) one."""
    kept = chain.drop_first_tx(S.outputs(spark, sf))
    return kept.select("block_id", "txid", "receiver", F.col("amount").cast("double").alias("amount"))


@query("scaled_amount", with_(OUTS) + """
SELECT txid, CAST(sum(round(amount * 100)) AS BIGINT) AS amount_units,
       CAST(CAST(CAST(sum(round(amount * 100)) AS DECIMAL(28,0)) / 100000000 AS DECIMAL(28,8)) AS DOUBLE) AS coins
FROM outs GROUP BY txid""")
def q_scaled_amount(spark, sf):
    """PRJ-5: integer base units summed per transaction, then scaled to coins."""
    from ..functions.scalars import to_coins
    units = S.outputs(spark, sf).select("txid", (F.col("amount") * 100).cast("long").alias("u"))
    per_tx = units.groupBy("txid").agg(F.sum("u").alias("amount_units"))
    return per_tx.select("txid", "amount_units", to_coins("amount_units", 8).cast("double").alias("coins"))


# ------------------------------------------------------------------ per-block figures

def _blocks(spark, sf):
    return chain.block_summary(S.outputs(spark, sf), fanout_min=S.FANOUT_MIN, high_value=S.HIGH_VALUE,
                               subsidy=S.SUBSIDY)


_BLK = with_(OUTS, FIRSTS, BLOCKS)


@query("block_fee_reward", _BLK + "SELECT block_id, CAST(fee_reward AS DOUBLE) AS fee_reward FROM blocks")
def q_block_fee_reward(spark, sf):
    """PRJ-6: first output of each block's first transaction minus the subsidy."""
    return _blocks(spark, sf).select("block_id", F.col("fee_reward").cast("double").alias("fee_reward"))


@query("avg_amount_per_tx", _BLK + """
SELECT block_id, CAST(total_amount AS DOUBLE) / n_txns AS avg_amount_per_tx FROM blocks""")
def q_avg_amount_per_tx(spark, sf):
    """PRJ-10: block total divided by its transaction count."""
    return _blocks(spark, sf).select(
        "block_id", (F.col("total_amount").cast("double") / F.col("n_txns")).alias("avg_amount_per_tx"))


@query("threshold_filters", _BLK + """
SELECT block_id, CAST(n_fanout_txs AS BIGINT) AS n_fanout_txs,
       CAST(n_high_value_outputs AS BIGINT) AS n_high_value_outputs FROM blocks""")
def q_threshold_filters(spark, sf):
    """FLT-4: per block, transactions with many outputs and high-value outputs."""
    return _blocks(spark, sf).select("block_id", "n_fanout_txs", "n_high_value_outputs")


@query("block_tx_count", _BLK + "SELECT block_id, time, CAST(n_txns AS BIGINT) AS n_txns FROM blocks")
def q_block_tx_count(spark, sf):
    """AGG-8: transactions per block."""
    return _blocks(spark, sf).select("block_id", "time", "n_txns")


@query("block_total_amount", _BLK + """
SELECT block_id, CAST(total_amount AS DOUBLE) AS total_amount FROM blocks""")
def q_block_total_amount(spark, sf):
    """AGG-9: total output amount per block (exact sum)."""
    return _blocks(spark, sf).select("block_id", F.col("total_amount").cast("double").alias("total_amount"))


@query("block_fanout_tx_count", _BLK + """
SELECT block_id, CAST(n_fanout_txs AS BIGINT) AS n_fanout_txs FROM blocks""")
def q_block_fanout_tx_count(spark, sf):
    """AGG-10: transactions with at least the fan-out limit of outputs per block."""
    return _blocks(spark, sf).select("block_id", "n_fanout_txs")


@query("block_high_value_outputs", _BLK + """
SELECT block_id, CAST(n_high_value_outputs AS BIGINT) AS n_high_value_outputs FROM blocks""")
def q_block_high_value_outputs(spark, sf):
    """AGG-11: outputs at or above the high-value limit per block."""
    return _blocks(spark, sf).select("block_id", "n_high_value_outputs")


@query("block_unique_receivers", with_(OUTS) + """
SELECT block_id, time, count(DISTINCT receiver) AS n_unique_receivers FROM outs GROUP BY block_id, time""")
def q_block_unique_receivers(spark, sf):
    """AGG-7: distinct receivers per block (coinbase included)."""
    return chain.block_unique_receivers(S.outputs(spark, sf))


@query("tx_fanout", with_(OUTS) + """
SELECT txid, count(*) AS n_receivers, count(DISTINCT receiver) AS n_unique_receivers FROM outs GROUP BY txid""")
def q_tx_fanout(spark, sf):
    """AGG-12: outputs and distinct receivers per transaction."""
    return chain.tx_fanout(S.outputs(spark, sf))


@query("block_features_nested", with_(NESTED_OUTS, FIRSTS) + f"""
SELECT o.block_id, o.time, CAST(count(DISTINCT o.txid) AS INTEGER) AS n_txns,
       CAST(sum(round(o.amount * 100)) AS BIGINT) AS total_sat,
       CAST(round(f.first_amount * 100) AS BIGINT) - 625 AS fee_reward_sat,
       CAST(count(DISTINCT CASE WHEN n_out >= {S.FANOUT_MIN} THEN o.txid END) AS INTEGER) AS n_fanout_txs,
       CAST(count(*) FILTER (WHERE o.amount >= {S.HIGH_VALUE}) AS INTEGER) AS n_high_value_outputs,
       CAST(count(DISTINCT o.receiver) AS INTEGER) AS n_unique_scripts
FROM (SELECT *, count(*) OVER (PARTITION BY txid) AS n_out FROM outs) o JOIN firsts f USING (block_id)
GROUP BY o.block_id, o.time, f.first_amount""")
def q_block_features_nested(spark, sf):
    """ARR-1: per-block counts and sums computed on the nested arrays of one row."""
    return chain.block_features_nested(nested_blocks(spark, sf), fanout_min=S.FANOUT_MIN,
                                       high_value_sat=S.HIGH_VALUE * 100, subsidy_sat=625)


# ------------------------------------------------------------------ listing, order, bounds

@query("job_tx_listing", with_(NESTED_OUTS) + "SELECT DISTINCT time, txid FROM outs")
def q_job_tx_listing(spark, sf):
    """JOB-7: (time, txid) per transaction of the nested stand-in's blocks."""
    return chain.list_transactions(flat_transactions(spark, sf))


@query("order_by_time", _BLK + """
SELECT block_id, time, CAST(n_txns AS BIGINT) AS n_txns FROM blocks ORDER BY time, block_id""")
def q_order_by_time(spark, sf):
    """SRT-1: blocks in time order (ties by block id)."""
    return _blocks(spark, sf).select("block_id", "time", "n_txns").orderBy("time", "block_id")


@query("first_last_record", with_(OUTS) + """
SELECT min(time) AS min_time, arg_min(txid, (time, txid)) AS first_txid,
       max(time) AS max_time, arg_max(txid, (time, txid)) AS last_txid FROM outs""")
def q_first_last_record(spark, sf):
    """SRT-3: earliest and latest transaction by (time, txid), one distributed pass."""
    o = S.outputs(spark, sf)
    k = F.struct("time", "txid")
    return o.agg(F.min("time").alias("min_time"), F.min_by("txid", k).alias("first_txid"),
                 F.max("time").alias("max_time"), F.max_by("txid", k).alias("last_txid"))


# ------------------------------------------------------------------ SET-5

@query("receiver_coverage_arrays", with_(OUTS) + """
, scored AS (SELECT DISTINCT CAST(l_suppkey AS VARCHAR) AS receiver FROM lineitem
             WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 5000)),
n AS (SELECT count(*) AS n FROM scored)
SELECT o.block_id,
       count(DISTINCT CASE WHEN s.receiver IS NOT NULL THEN o.sup END) / NULLIF((SELECT n FROM n), 0) AS coverage
FROM (SELECT block_id, CAST(l_suppkey AS VARCHAR) AS sup FROM outs) o
LEFT JOIN scored s ON s.receiver = o.sup GROUP BY o.block_id""")
def q_receiver_coverage_arrays(spark, sf):
    """SET-5: size of (scored ∩ block receivers) ÷ size of the scored set, as a join.

    The dense receiver sets are suppliers; the scored set is suppliers with a
    balance above 5000 that receive anything.
    """
    from ..operators.receivers import block_coverage
    outs = S.outputs(spark, sf, receiver="l_suppkey")
    sup = S.table(spark, sf, "supplier").filter(F.col("s_acctbal") > 5000).select(
        F.col("s_suppkey").cast("string").alias("receiver"))
    scored = outs.select("receiver").distinct().join(sup, "receiver", "left_semi")
    cov = block_coverage(outs, scored.withColumn("r4", F.lit(1.0)), thresholds=(1.0,))
    return cov.select("block_id", F.col("coverage_100").alias("coverage"))
