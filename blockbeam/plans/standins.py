"""Ledger-shaped views over the TPC-H-style test tables.

No block files or candle data ship with the test data, so the registered queries
run the ledger operators on views Spark derives from the given tables (every view
grows with them):

* time bucket ("minute")  -> one day: epoch seconds of ``o_orderdate``; grain 86400
* hour                    -> two days (172800 s), so "30 minutes" is one day
* block                   -> (o_orderdate, o_orderstatus), id ``"<epoch>-<status>"``
* transaction             -> order ``o_orderkey`` (the lowest key of a block is its coinbase)
* output                  -> lineitem row, ordered in its order by
                             (l_linenumber, l_partkey, l_suppkey, l_extendedprice)
* receiver                -> ``l_partkey`` as a string
* amount                  -> ``l_extendedprice`` as DECIMAL(18,2)
* daily candle            -> per order date: low/high = min/max(o_totalprice),
                             open/close = price of the lowest/highest o_orderkey,
                             volume = number of orders, vol_fiat = volume * close
* tick series            -> events: microseconds of ``ts`` (unique), value as y
* "many outputs" / "high value" limits -> 4 outputs / amount 50,000

Each function has an SQL twin in ``plans.sqlviews`` used by the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from ..functions.scalars import epoch_seconds, seconds_to_ntz
from ..session import stored_bytes

GRAIN = 86400
HOUR = 2 * 86400
FANOUT_MIN = 4
HIGH_VALUE = 50000
RECEIVER_CUT_INDEX = 999      # 1000th distinct day closes the receivers' training span
TRAIN_BLOCKS_V1 = 1900
TRAIN_BLOCKS_V2 = 2000
VALID_BLOCKS = 500
SUBSIDY = 6.25

LEDGER_TABLES = ("customer", "supplier", "part", "orders", "lineitem", "events")
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def table_bytes(spark: SparkSession, sf_dir: str) -> int:
    """Stored bytes of the tables that the ledger's views are made of."""
    return stored_bytes(spark, [f"{sf_dir.rstrip('/')}/{name}.parquet" for name in LEDGER_TABLES])


def outputs(spark: SparkSession, sf_dir: str, receiver: str = "l_partkey") -> DataFrame:
    """Flat outputs: block_id, time, txid, tx_pos, out_pos, amount, receiver."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", epoch_seconds("o_orderdate").alias("time"))
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    # position of the output in its transaction: a window over one order's lines (at
    # most seven); at scale it reuses the join's partitioning on the order key, and an
    # integer position keeps every later min_by a hash aggregate
    pos = F.row_number().over(Window.partitionBy("o_orderkey").orderBy(
        "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")) - 1
    return j.select(
        F.concat(F.col("time").cast("string"), F.lit("-"), F.col("o_orderstatus")).alias("block_id"),
        "time",
        F.col("o_orderkey").alias("txid"),
        F.col("o_orderkey").alias("tx_pos"),
        pos.alias("out_pos"),
        F.col("l_extendedprice").cast(T.DecimalType(18, 2)).alias("amount"),
        F.col(receiver).cast("string").alias("receiver"),
    )


def daily_candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candle table (unix, low, high, open, close, volume, date, vol_fiat), one row per day."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice",
                                             epoch_seconds("o_orderdate").alias("unix"))
    c = o.groupBy("unix").agg(
        F.min("o_totalprice").alias("low"), F.max("o_totalprice").alias("high"),
        F.min_by("o_totalprice", "o_orderkey").alias("open"),
        F.max_by("o_totalprice", "o_orderkey").alias("close"),
        F.count(F.lit(1)).cast("double").alias("volume"))
    return c.select("unix", "low", "high", "open", "close", "volume",
                    seconds_to_ntz("unix").alias("date"),
                    (F.col("volume") * F.col("close")).alias("vol_fiat"))


def hours(k: float) -> int:
    """Stand-in seconds for ``k`` hours."""
    return int(round(k * HOUR))
