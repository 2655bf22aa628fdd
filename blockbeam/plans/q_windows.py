"""Registered queries: ordered-series windows (WIN-1 ... WIN-5, WIN-7).

Series: the events table (unique microsecond timestamps), value as y; blocks for
the lag operators. y is scaled to integer cents for exact slope sums.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalars import epoch_micros
from ..operators import windows as Wn
from . import standins as S
from .catalog import query
from .q_receivers import features
from .sqlviews import BLOCKS, CANDLES, FEATURES, FIRSTS, HITS, OUTS, POP, RAW, with_

US = 1_000_000
FRAME_4H = 4 * 3600 * US
FRAME_1H = 3600 * US

_SERIES = """s AS (SELECT event_id, epoch_us(ts) AS u, value AS y, CAST(round(value * 100) AS BIGINT) AS yc,
                          -row_number() OVER (ORDER BY epoch_us(ts)) AS x FROM events)"""


def _series(spark, sf):
    e = S.table(spark, sf, "events")
    return e.select("event_id", epoch_micros("ts").alias("u"), F.col("value").alias("y"),
                    F.round(F.col("value") * 100).cast("long").alias("yc"))


def _slope_sql(frame: str) -> str:
    n, sx, sy = f"count(*) OVER {frame}", f"sum(x) OVER {frame}", f"sum(yc) OVER {frame}"
    sxy, sxx = f"sum(x * yc) OVER {frame}", f"sum(x * x) OVER {frame}"
    num = f"CAST({n} AS HUGEINT) * {sxy} - {sx} * {sy}"
    den = f"CAST({n} AS HUGEINT) * {sxx} - {sx} * {sx}"
    return (f"CASE WHEN ({den}) <> 0 THEN CAST(CAST(({num}) AS VARCHAR) AS DOUBLE)"
            f" / CAST(CAST(({den}) AS VARCHAR) AS DOUBLE) END")


@query("rolling_slope", with_(_SERIES) + f"""
SELECT event_id, u, {_slope_sql(f"(ORDER BY u RANGE BETWEEN CURRENT ROW AND {FRAME_4H - 1} FOLLOWING)")}
       / 100 AS slope FROM s""")
def q_rolling_slope(spark, sf):
    """WIN-1: 4-hour rolling regression slope on the reversed series."""
    out = Wn.rolling_slope_reversed(_series(spark, sf), "u", "yc", FRAME_4H, tiebreak=["event_id"])
    return out.select("event_id", "u", (F.col("_slope") / 100).alias("slope"))


@query("rolling_sum", with_(_SERIES) + f"""
SELECT event_id, u, CAST(sum(CAST(y AS DECIMAL(18,2))) OVER (ORDER BY u RANGE BETWEEN CURRENT ROW AND
       {FRAME_1H - 1} FOLLOWING) AS DOUBLE) AS rolling_sum FROM s""")
def q_rolling_sum(spark, sf):
    """WIN-2: 1-hour forward rolling sum (exact decimal sum, double at the edge)."""
    s = _series(spark, sf).withColumn("_yd", F.col("y").cast("decimal(18,2)"))
    out = Wn.rolling_sum_forward(s, "u", "_yd", FRAME_1H, tiebreak=["event_id"])
    return out.select("event_id", "u", F.col("rolling_sum").cast("double").alias("rolling_sum"))


@query("rolling_endpoint_slope", with_(_SERIES) + f"""
SELECT event_id, u, (y - last_value(y) OVER (ORDER BY u RANGE BETWEEN CURRENT ROW AND {FRAME_4H - 1} FOLLOWING))
       / 14400.0 AS endpoint_slope FROM s""")
def q_rolling_endpoint_slope(spark, sf):
    """WIN-3: (current - latest in the 4-hour frame) / 14400 seconds."""
    out = Wn.rolling_endpoint_slope(_series(spark, sf), "u", "y", FRAME_4H, 14400.0, tiebreak=["event_id"])
    return out.select("event_id", "u", "endpoint_slope")


_FEAT = with_(OUTS, CANDLES, RAW, POP, HITS, FIRSTS, BLOCKS, FEATURES)
_LAG_COLS = ("numTxnsInBlock", "totalBtcAmountReceivedInBlock")


def _lags(spark, sf):
    f = features(spark, sf, 2).select("blockId", "blockFloorTime", *_LAG_COLS)
    return Wn.lags(f, ["blockFloorTime", "blockId"], list(_LAG_COLS), [1, 2, 3, 4])


@query("block_lags", _FEAT + "SELECT blockId, " + ", ".join(
    f"lag({c}, {k}) OVER (ORDER BY blockFloorTime, blockId) AS {c}_lag{k}" for c in _LAG_COLS for k in (1, 2, 3, 4))
    + " FROM feat")
def q_block_lags(spark, sf):
    """WIN-4: lags 1..4 of transaction count and amount over the block order."""
    return _lags(spark, sf).select("blockId", *[f"{c}_lag{k}" for c in _LAG_COLS for k in (1, 2, 3, 4)])


_DELTAS = {f"d_{c}_{a}_{b}": (c, a, b) for c in _LAG_COLS for a, b in ((0, 1), (1, 2), (2, 3), (3, 4))}


def _lag_name(c, k):
    return c if k == 0 else f"{c}_lag{k}"


@query("block_lag_deltas", _FEAT + ", lg AS (SELECT blockId, " + ", ".join(
    [f"{c}"for c in _LAG_COLS] + [f"lag({c}, {k}) OVER (ORDER BY blockFloorTime, blockId) AS {c}_lag{k}"
                                   for c in _LAG_COLS for k in (1, 2, 3, 4)]) + " FROM feat)\nSELECT blockId, " +
    ", ".join(f"{_lag_name(c, a)} - {_lag_name(c, b)} AS {n}" for n, (c, a, b) in _DELTAS.items()) + " FROM lg")
def q_block_lag_deltas(spark, sf):
    """WIN-5: successive differences of the lag columns."""
    lg = _lags(spark, sf)
    return lg.select("blockId", *[(F.col(_lag_name(c, a)) - F.col(_lag_name(c, b))).alias(n)
                                  for n, (c, a, b) in _DELTAS.items()])


@query("rolling_slope_rows", with_(_SERIES) + """
, s2 AS (SELECT event_id, u, u - min(u) OVER () AS xu, yc FROM s),
w AS (SELECT event_id, u, count(*) OVER r AS n, sum(xu) OVER r AS sx, sum(yc) OVER r AS sy,
             sum(CAST(xu AS HUGEINT) * yc) OVER r AS sxy, sum(CAST(xu AS HUGEINT) * xu) OVER r AS sxx
      FROM s2 WINDOW r AS (ORDER BY u, event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW))
SELECT event_id, u, CASE WHEN n = 5 AND (5 * sxx - sx * sx) <> 0 THEN
  CAST(CAST(5 * sxy - sx * sy AS VARCHAR) AS DOUBLE) / CAST(CAST(5 * sxx - sx * sx AS VARCHAR) AS DOUBLE)
  * 1000000 / 100 END AS slope_rows FROM w""")
def q_rolling_slope_rows(spark, sf):
    """WIN-7: slope of value on time (per second) over the last 5 rows."""
    s = _series(spark, sf)
    start = s.select(F.min("u")).scalar()
    s = s.withColumn("xu", F.col("u") - start)
    out = Wn.rolling_slope_rows(s, ["u", "event_id"], "xu", "yc", 5)
    return out.select("event_id", "u", (F.col("slope_rows") * 1000000 / 100).alias("slope_rows"))
