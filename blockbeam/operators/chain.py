"""Block / transaction / output operators.

Two equivalent representations are supported:

* nested blocks, one row per block, as the block-file source emits them:
  ``block_id, time, txs: array<struct<txid, outs: array<struct<amount_sat, script>>>>``
  (a block is bounded by the protocol, so per-row arrays are bounded);
* flat outputs, one row per output:
  ``block_id, time, txid, tx_pos, out_pos, amount, receiver`` where ``tx_pos`` and
  ``out_pos`` are order keys (the minimum ``tx_pos`` of a block is its coinbase
  transaction, the minimum ``out_pos`` of a transaction its first output).

Every per-block figure is computed with two-level aggregations (per transaction,
then per block), each with map-side partial aggregation, so a block or minute that
holds a large share of all rows is combined before it is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.scalars import floor_time
from ..sinks.staging import staged
from .receivers import maybe_member, with_receiver_keys

# Fixed values of the reference's feature definitions (parameters here):
#   block subsidy 6.25 coins; "many outputs" >= 10 outputs; "high value" >= 10 coins;
#   minute grain 60 s.
SUBSIDY = 6.25
FANOUT_MIN_OUTPUTS = 10
HIGH_VALUE_AMOUNT = 10
MINUTE = 60

#: Blocks whose coinbases (one narrow row each) are broadcast as they are by the jobs; more of them go by a bitmap.
FEW_BLOCKS = 100_000


# ------------------------------------------------------------------ nested -> flat

def explode_txs(blocks: DataFrame) -> DataFrame:
    """PRJ-2: one row per transaction with its position in the block."""
    return blocks.select("block_id", "time", F.posexplode("txs").alias("tx_pos", "tx")).select(
        "block_id", "time", "tx_pos", F.col("tx.txid").alias("txid"), F.col("tx.outs").alias("outs"))


def explode_outputs(blocks: DataFrame, drop_first_tx: bool = False, with_keys: bool = True) -> DataFrame:
    """PRJ-3/PRJ-4/AGG-12 on nested blocks: one row per output carrying its parents.

    Adds ``n_outputs`` and ``n_unique_scripts`` of the parent transaction (computed
    on the array, no shuffle) and, with ``with_keys``, the receiver key (STR-1), for which the outputs are staged.
    """
    txs = explode_txs(blocks)
    if drop_first_tx:
        txs = txs.filter(F.col("tx_pos") > 0)
    txs = txs.withColumns({
        "n_outputs": F.size("outs"),
        "n_unique_scripts": F.size(F.array_distinct(F.transform("outs", lambda o: o["script"]))),
    })
    outs = txs.select("block_id", "time", "tx_pos", "txid", "n_outputs", "n_unique_scripts",
                      F.posexplode("outs").alias("out_pos", "o")).select(
        "block_id", "time", "tx_pos", "txid", "n_outputs", "n_unique_scripts", "out_pos",
        F.col("o.amount_sat").alias("amount_sat"), F.col("o.script").alias("script"))
    outs = outs.withColumn("amount", (F.col("amount_sat").cast(T.DecimalType(28, 0)) / F.lit(10 ** 8))
                           .cast(T.DecimalType(28, 8)))
    return with_receiver_keys(staged(outs, "outputs")) if with_keys else outs


def list_transactions(blocks: DataFrame) -> DataFrame:
    """JOB-7 listing: (time, txid) per transaction, time not floored; of nested blocks, or of a table that has a row per
    transaction already."""
    return (explode_txs(blocks) if "txs" in blocks.columns else blocks).select("time", "txid")


# ------------------------------------------------------------------ flat operators

def drop_first_tx(outs: DataFrame, positional: bool = False, few_blocks: int = 0) -> DataFrame:
    """PRJ-4: remove the outputs of each block's first (coinbase) transaction.

    ``positional``: ``tx_pos`` is a 0-based position, so a filter suffices.
    Otherwise the first order key per block is aggregated (one row per block, partial
    aggregation) and staged. A bitmap of these (block, transaction) pairs tells nearly all other outputs apart in
    the scan; they go straight through, and only those that may be a coinbase's are joined with the blocks. So the
    outputs aren't shuffled, and a block that holds a large share of them is no skewed key. That reads the outputs twice;
    up to ``few_blocks`` blocks are broadcast instead, and one pass drops their coinbases.
    """
    if positional:
        return outs.filter(F.col("tx_pos") > 0)
    known = outs.filter(F.col("block_id").isNotNull() & F.col("tx_pos").isNotNull())
    first = known.groupBy("block_id").agg(F.min("tx_pos").alias("tx_pos"))
    first = staged(first.select("block_id", "tx_pos", F.xxhash64("block_id", "tx_pos").alias("_tx")), "coinbases")
    n_blocks = first.count()
    if n_blocks <= few_blocks:
        return known.join(F.broadcast(first.select("block_id", "tx_pos")), ["block_id", "tx_pos"], "left_anti").select(outs.columns)
    told = maybe_member(known.withColumn("_tx", F.xxhash64("block_id", "tx_pos")), "_tx", first, n_blocks, keep="_maybe")
    straight = told.filter(~F.col("_maybe")).select(outs.columns)
    rest = told.filter("_maybe").select(outs.columns).join(first.select("block_id", "tx_pos"), ["block_id", "tx_pos"], "left_anti")
    return straight.unionByName(rest)


def tx_fanout(outs: DataFrame) -> DataFrame:
    """AGG-12: outputs and distinct receivers per transaction."""
    return outs.groupBy("txid").agg(F.count(F.lit(1)).alias("n_receivers"),
                                    F.count_distinct("receiver").alias("n_unique_receivers"))


def tx_summary(outs: DataFrame, high_value=HIGH_VALUE_AMOUNT) -> DataFrame:
    """Per transaction: order key, output count, total, first output, high-value outputs."""
    return outs.groupBy("block_id", "time", "txid").agg(
        F.min("tx_pos").alias("tx_pos"),
        F.count(F.lit(1)).alias("n_outputs"),
        F.sum("amount").alias("tx_amount"),
        F.min_by("amount", "out_pos").alias("first_amount"),
        F.count_if(F.col("amount") >= F.lit(high_value)).alias("n_high_value"),
    )


def block_summary(outs: DataFrame, fanout_min: int = FANOUT_MIN_OUTPUTS,
                  high_value=HIGH_VALUE_AMOUNT, subsidy: float = SUBSIDY) -> DataFrame:
    """AGG-8/9/10/11 and PRJ-6 per block, from flat outputs.

    Columns: block_id, time, n_txns, total_amount (exact decimal), fee_reward
    (first output of the first transaction minus ``subsidy``), n_fanout_txs
    (transactions with >= ``fanout_min`` outputs), n_high_value_outputs (outputs of
    >= ``high_value``; outputs, not transactions, as in the reference).
    """
    tx = tx_summary(outs, high_value)
    return tx.groupBy("block_id", "time").agg(
        F.count(F.lit(1)).alias("n_txns"),
        F.sum("tx_amount").alias("total_amount"),
        (F.min_by("first_amount", "tx_pos") - F.lit(subsidy).cast(T.DecimalType(10, 2))).alias("fee_reward"),
        F.count_if(F.col("n_outputs") >= F.lit(fanout_min)).alias("n_fanout_txs"),
        F.sum("n_high_value").alias("n_high_value_outputs"),
    )


def block_unique_receivers(outs: DataFrame) -> DataFrame:
    """AGG-7: distinct receivers per block (coinbase included)."""
    return (outs.select("block_id", "time", "receiver").distinct()
            .groupBy("block_id", "time").agg(F.count(F.lit(1)).alias("n_unique_receivers")))


def block_activity(outs: DataFrame, grain: int = MINUTE, subsidy: float = SUBSIDY) -> DataFrame:
    """AGG-2: per time bucket, Σ transactions, Σ amount, Σ fee reward over its blocks.

    Amount and fee stay exact decimals through both levels and become doubles at
    the edge.
    """
    blk = block_summary(outs, subsidy=subsidy)
    return (blk.groupBy(floor_time("time", grain).alias("t"))
            .agg(F.sum("n_txns").alias("n_txns"),
                 F.sum("total_amount").alias("total_amount"),
                 F.sum("fee_reward").alias("fee_reward"))
            .select("t", "n_txns", F.col("total_amount").cast("double").alias("total_amount"),
                    F.col("fee_reward").cast("double").alias("fee_reward")))


# ------------------------------------------------------------------ nested features

def block_features_nested(blocks: DataFrame, fanout_min: int = FANOUT_MIN_OUTPUTS,
                          high_value_sat: int = HIGH_VALUE_AMOUNT * 10 ** 8,
                          subsidy_sat: int = int(SUBSIDY * 10 ** 8)) -> DataFrame:
    """ARR-1: the per-block counts computed on the arrays of one row (no shuffle)."""
    txs = F.col("txs")
    all_amounts = F.flatten(F.transform(txs, lambda t: F.transform(t["outs"], lambda o: o["amount_sat"])))
    all_scripts = F.flatten(F.transform(txs, lambda t: F.transform(t["outs"], lambda o: o["script"])))
    return blocks.select(
        "block_id", "time",
        F.size(txs).alias("n_txns"),
        F.aggregate(all_amounts, F.lit(0).cast("long"), lambda acc, x: acc + x).alias("total_sat"),
        (F.element_at(F.element_at(txs, 1)["outs"], 1)["amount_sat"] - F.lit(subsidy_sat)).alias("fee_reward_sat"),
        F.size(F.filter(txs, lambda t: F.size(t["outs"]) >= fanout_min)).alias("n_fanout_txs"),
        F.size(F.filter(all_amounts, lambda a: a >= F.lit(high_value_sat))).alias("n_high_value_outputs"),
        F.size(F.array_distinct(all_scripts)).alias("n_unique_scripts"),
    )
