"""Nested block rows built from the stand-in tables.

Real nested rows come from the block-file source (``sources.blocks``) and are bounded by
the protocol's size limit. The nested stand-in block is bounded likewise: it holds the
orders of ``ORDERS_PER_BLOCK`` consecutive order keys (at most that many transactions of
at most seven outputs), so the number of blocks grows with the data and a row does not.
Its time is the earliest order date, its id and nonce are its height. Amounts are integer
base units (cents) and scripts are receiver strings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from . import standins as S

ORDERS_PER_BLOCK = 64


def fold_outputs(outs: DataFrame) -> DataFrame:
    """Flat outputs -> one row per block with its transactions and their outputs as arrays,
    in position order; the blocks of ``outs`` must be of bounded size."""
    cents = (F.col("amount") * 100).cast("long").alias("amount_sat")
    txs = outs.groupBy("block_id", "txid").agg(
        F.min("time").alias("time"),
        F.array_sort(F.collect_list(F.struct(F.col("out_pos").alias("k"), cents, F.col("receiver").alias("script")))).alias("_outs"))
    bare = F.transform("_outs", lambda o: F.struct(o["amount_sat"].alias("amount_sat"), o["script"].alias("script")))
    blocks = txs.groupBy("block_id").agg(
        F.min("time").alias("time"),
        F.array_sort(F.collect_list(F.struct("txid", bare.alias("outs")))).alias("txs"))
    return blocks.select("block_id", "time", "txs")


def flat_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The outputs of the nested stand-in's blocks, not folded; ``time`` is still each order's own."""
    height = F.floor(F.col("txid") / F.lit(ORDERS_PER_BLOCK)).cast("long")
    return S.outputs(spark, sf_dir).withColumn("block_id", height.cast("string"))


def flat_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per transaction of those blocks (block_id, time of the block, txid), without folding them to arrays and
    unfolding them again; a block's window holds ``ORDERS_PER_BLOCK`` transactions at most."""
    txs = flat_outputs(spark, sf_dir).groupBy("block_id", "txid").agg(F.min("time").alias("time"))
    return txs.select("block_id", F.min("time").over(W.partitionBy("block_id")).alias("time"), "txid")


def nested_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nested stand-in: block_id (the height as text), time, txs, nonce (the height)."""
    return fold_outputs(flat_outputs(spark, sf_dir)).withColumn("nonce", F.col("block_id").cast("long"))
