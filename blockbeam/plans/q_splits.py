"""Registered queries: cuts, splits and set operations (FLT-1, FLT-5, SRT-4,
SRT-5, SET-1..4, WIN-6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalars import epoch_micros, epoch_seconds
from ..operators import splits
from ..sources import candles as C
from . import standins as S
from .catalog import query
from .q_receivers import features, raw
from .sqlviews import (BLOCKS, CANDLES, FEATURES, FIRSTS, HITS, OUTS, POP, RAW, epoch, split_sql,
                       with_)

_FEAT = with_(OUTS, CANDLES, RAW, POP, HITS, FIRSTS, BLOCKS, FEATURES)
_ORDER_DAYS = f"od AS (SELECT o_orderkey, {epoch('o_orderdate')} AS t FROM orders)"


@query("temporal_filter_split", with_(_ORDER_DAYS) + f"""
, cut AS (SELECT max(t) AS c FROM (SELECT DISTINCT t FROM od ORDER BY t LIMIT {S.RECEIVER_CUT_INDEX + 1}))
SELECT o_orderkey, t, CASE WHEN t <= (SELECT c FROM cut) THEN 'train' ELSE 'test' END AS split FROM od""")
def q_temporal_filter_split(spark, sf):
    """FLT-1: orders on or before the 1000th distinct day are train, later ones test."""
    od = S.table(spark, sf, "orders").select("o_orderkey", epoch_seconds("o_orderdate").alias("t"))
    return splits.temporal_split(od, "t", splits.nth_key(od, "t", S.RECEIVER_CUT_INDEX + 1, fewer="last"))


@query("nth_timestamp", with_(OUTS, CANDLES, RAW) + "SELECT cutoff FROM cut")
def q_nth_timestamp(spark, sf):
    """SRT-5: the 1000th smallest distinct time bucket of the receiver activity."""
    from ..operators.chain import drop_first_tx
    from ..operators.receivers import receiver_activity
    act = receiver_activity(drop_first_tx(S.outputs(spark, sf)), S.GRAIN)
    cut = splits.nth_key(act, "t", S.RECEIVER_CUT_INDEX + 1, fewer="last")
    return act.agg(F.max("t").alias("_t")).select(cut.alias("cutoff"))


@query("timestamp_ordinal", with_(_ORDER_DAYS) + """
SELECT t, row_number() OVER (ORDER BY t) - 1 AS ordinal FROM (SELECT DISTINCT t FROM od)""")
def q_timestamp_ordinal(spark, sf):
    """WIN-6: ordinal of each distinct day in sorted order."""
    od = S.table(spark, sf, "orders").select(epoch_seconds("o_orderdate").alias("t"))
    return splits.ordinal(od, "t")


@query("first_n_blocks", _FEAT + f"""
SELECT blockId, blockFloorTime FROM feat ORDER BY blockFloorTime, blockId LIMIT {S.TRAIN_BLOCKS_V2}""")
def q_first_n_blocks(spark, sf):
    """SRT-4: the first n blocks in time order (top-n)."""
    f = features(spark, sf, 2).select("blockId", "blockFloorTime")
    return splits.first_n(f, ["blockFloorTime", "blockId"], S.TRAIN_BLOCKS_V2)


@query("except_train", _FEAT + f"""
SELECT blockId, blockFloorTime, numTxnsInBlock FROM feat
EXCEPT
SELECT blockId, blockFloorTime, numTxnsInBlock FROM (
  SELECT * FROM feat ORDER BY blockFloorTime, blockId LIMIT {S.TRAIN_BLOCKS_V2})""")
def q_except_train(spark, sf):
    """SET-1: all blocks EXCEPT the training blocks."""
    f = features(spark, sf, 2).select("blockId", "blockFloorTime", "numTxnsInBlock")
    train = splits.first_n(f, ["blockFloorTime", "blockId"], S.TRAIN_BLOCKS_V2)
    return splits.except_rows(f, train)


@query("three_way_split", _FEAT + ", " + split_sql(S.TRAIN_BLOCKS_V2, S.VALID_BLOCKS) + """
SELECT split, count(*) AS n_blocks, min(blockFloorTime) AS first_time, max(blockFloorTime) AS last_time
FROM splitted GROUP BY split""")
def q_three_way_split(spark, sf):
    """SET-2: sizes and time ranges of the train / valid / test split."""
    f = features(spark, sf, 2)
    return f.groupBy("split").agg(F.count(F.lit(1)).alias("n_blocks"),
                                  F.min("blockFloorTime").alias("first_time"),
                                  F.max("blockFloorTime").alias("last_time"))


@query("distinct_timestamps", with_(OUTS, CANDLES, RAW) + "SELECT DISTINCT t FROM rawp")
def q_distinct_timestamps(spark, sf):
    """SET-3: distinct time buckets of all activity."""
    return raw(spark, sf).select("t").distinct()


_Y1998 = 883612800  # 1998-01-01 00:00:00 UTC


@query("candles_union_dedupe", with_(CANDLES) + f"""
SELECT DISTINCT * FROM (
  SELECT unix, low, high, open, close, volume, date, vol_fiat FROM candles WHERE unix <= {_Y1998}
  UNION ALL
  SELECT unix, low, high, open, close, volume, date, vol_fiat FROM candles WHERE unix >= {_Y1998})""")
def q_candles_union_dedupe(spark, sf):
    """SET-4: two candle pulls sharing an endpoint, UNION ALL, whole-row dedupe."""
    c = S.daily_candles(spark, sf)
    return C.union_dedupe([c.filter(F.col("unix") <= _Y1998), c.filter(F.col("unix") >= _Y1998)])


_FOUR_H_US = 4 * 3600 * 1_000_000


@query("time_range_filter", f"""
SELECT event_id, ts, value FROM events
WHERE epoch_us(ts) BETWEEN (SELECT min(epoch_us(ts)) FROM events)
                       AND (SELECT min(epoch_us(ts)) FROM events) + {_FOUR_H_US}""")
def q_time_range_filter(spark, sf):
    """FLT-5: events between the first event and four hours later, inclusive."""
    e = S.table(spark, sf, "events").withColumn("_u", epoch_micros("ts"))
    start = e.select(F.min("_u")).scalar()
    return e.filter(F.col("_u").between(start, start + F.lit(_FOUR_H_US))).select("event_id", "ts", "value")
