"""Registered queries: candle sources and price lookups (SRC-3, SRC-4, JN-1..5,
PRJ-7..9, PRJ-11, PRJ-12, DT-1, DT-2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalars import epoch_seconds, seconds_to_ntz, shift_time
from ..operators import prices
from ..operators.receivers import receiver_activity
from ..sinks.scratch import scratch_path
from ..sources import candles as C
from . import standins as S
from .catalog import query
from .sqlviews import CANDLES, OUTS, epoch, hours, with_

_CANDLE_COLS = "unix, low, high, open, close, volume, vol_fiat"


@query("src_candles", with_(CANDLES) + f"""
SELECT {_CANDLE_COLS}, strftime(date, '%Y-%m-%d %H:%M:%S') AS date FROM candles""")
def q_src_candles(spark, sf):
    """SRC-3: the stand-in candles written as parquet, read back by position."""
    path = scratch_path(spark, "candles.parquet")
    S.daily_candles(spark, sf).write.mode("overwrite").parquet(path)
    return C.read_candles(spark, path)


_PER_STATUS = f"""per_status AS (
  SELECT {epoch('o_orderdate')} AS unix, o_orderstatus AS status, min(o_totalprice) AS low,
         max(o_totalprice) AS high, arg_min(o_totalprice, o_orderkey) AS open,
         arg_max(o_totalprice, o_orderkey) AS close, CAST(count(*) AS DOUBLE) AS volume
  FROM orders GROUP BY 1, 2)"""


@query("candles_latest_by_key", with_(_PER_STATUS) + """
SELECT unix, arg_max(status, status) AS status, arg_max(low, status) AS low, arg_max(high, status) AS high,
       arg_max(open, status) AS open, arg_max(close, status) AS close, arg_max(volume, status) AS volume
FROM per_status GROUP BY unix""")
def q_candles_latest_by_key(spark, sf):
    """SRC-4: three candles per day (one per order status) collapse to one per key;
    the greatest status wins."""
    o = S.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice",
                                           epoch_seconds("o_orderdate").alias("unix"))
    per_status = o.groupBy("unix", F.col("o_orderstatus").alias("status")).agg(
        F.min("o_totalprice").alias("low"), F.max("o_totalprice").alias("high"),
        F.min_by("o_totalprice", "o_orderkey").alias("open"),
        F.max_by("o_totalprice", "o_orderkey").alias("close"),
        F.count(F.lit(1)).cast("double").alias("volume"))
    return C.latest_by_key(per_status, "unix", order=["status"])


@query("price_at_time", with_(OUTS, CANDLES) + f"""
SELECT a.t, a.receiver, a.n_txns, CAST(a.amount AS DOUBLE) AS amount, c.close
FROM (SELECT time - time % {S.GRAIN} AS t, receiver, count(*) AS n_txns, sum(amount) AS amount
      FROM outs GROUP BY 1, 2) a JOIN candles c ON c.unix = a.t""")
def q_price_at_time(spark, sf):
    """JN-1: receiver activity with the close at its time bucket."""
    act = receiver_activity(S.outputs(spark, sf), S.GRAIN)
    out = prices.with_prices(act, S.daily_candles(spark, sf), {"close": 0}, time_col="t", missing="drop")
    return out.select("t", "receiver", "n_txns", F.col("amount").cast("double").alias("amount"), "close")


def _block_times(spark, sf):
    return S.outputs(spark, sf).select("block_id", F.col("time").alias("t")).distinct()


_BTC = with_(OUTS, CANDLES) + ", bt AS (SELECT DISTINCT block_id, time AS t FROM outs)\n"


def _lookup_sql(offs: dict, how: str) -> str:
    sel = ", ".join(f"c_{n}.close AS {n}" for n in offs)
    joins = " ".join(f"{how} JOIN candles c_{n} ON c_{n}.unix = bt.t + ({int(v)})" for n, v in offs.items())
    return f"SELECT bt.block_id, bt.t, {sel} FROM bt {joins}"


_FUTURE = {f"p{h}": hours(h) for h in (0, 4, 6, 12, 24)}


@query("price_future_offsets", _BTC + _lookup_sql(_FUTURE, "LEFT"))
def q_price_future_offsets(spark, sf):
    """JN-2: price now and 4, 6, 12, 24 hours later per block (NULL when absent)."""
    return prices.with_prices(_block_times(spark, sf), S.daily_candles(spark, sf), _FUTURE, missing="null")


_LAGLEAD = {"p0": 0, **{f"p_m{h}": -hours(h) for h in (1, 2, 3, 4)}, "p_4later": hours(4)}


@query("price_lag_lead_offsets", _BTC + _lookup_sql(_LAGLEAD, ""))
def q_price_lag_lead_offsets(spark, sf):
    """JN-3: price now, 1..4 hours ago and 4 hours later; blocks lacking one drop."""
    return prices.with_prices(_block_times(spark, sf), S.daily_candles(spark, sf), _LAGLEAD, missing="drop")


_RECV = {"p30m": hours(0.5), "p1": hours(1), "p2": hours(2), "p3": hours(3), "p4": hours(4)}


@query("price_receiver_offsets", with_(OUTS, CANDLES) + f"""
, a AS (SELECT time - time % {S.GRAIN} AS t, receiver FROM outs GROUP BY 1, 2)
SELECT a.t, a.receiver, {", ".join(f"c_{n}.close AS {n}" for n in _RECV)}
FROM a {" ".join(f"JOIN candles c_{n} ON c_{n}.unix = a.t + {v}" for n, v in _RECV.items())}""")
def q_price_receiver_offsets(spark, sf):
    """JN-4: price 30 minutes and 1..4 hours after each (time, receiver) row."""
    act = receiver_activity(S.outputs(spark, sf), S.GRAIN).select("t", "receiver")
    return prices.with_prices(act, S.daily_candles(spark, sf), _RECV, missing="drop")


_MISS = {"p0": 0, "p4": hours(4), "p24": hours(24), "p_m4": -hours(4)}


@query("price_missing_report", _BTC + f"""
SELECT count(*) AS n_rows, {", ".join(
    f"count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM candles c WHERE c.unix = bt.t + ({v}))) AS missing_{n}"
    for n, v in _MISS.items())} FROM bt""")
def q_price_missing_report(spark, sf):
    """JN-5: how many block lookups per offset find no candle (what "error" fails on)."""
    return prices.missing_report(_block_times(spark, sf), S.daily_candles(spark, sf), _MISS)


def _label_frame(spark, sf):
    off = {"p0": 0, "p4": hours(4), **{f"p_m{h}": -hours(h) for h in (1, 2, 3, 4)}}
    return prices.with_prices(_block_times(spark, sf), S.daily_candles(spark, sf), off, missing="drop")


_LABEL_BASE = _BTC + ", lf AS (" + _lookup_sql(
    {"p0": 0, "p4": hours(4), **{f"p_m{h}": -hours(h) for h in (1, 2, 3, 4)}}, "") + ")\n"


@query("price_label", _LABEL_BASE + """
SELECT block_id, CASE WHEN p4 > p0 THEN 1 ELSE 0 END AS label FROM lf""")
def q_price_label(spark, sf):
    """PRJ-7: 1 when the price 4 hours later is strictly higher."""
    return _label_frame(spark, sf).select("block_id", prices.price_label("p4", "p0").alias("label"))


@query("price_diff", _LABEL_BASE + "SELECT block_id, p4 - p0 AS price_diff FROM lf")
def q_price_diff(spark, sf):
    """PRJ-8: price 4 hours later minus the current price."""
    return _label_frame(spark, sf).select("block_id", (F.col("p4") - F.col("p0")).alias("price_diff"))


_DELTA_NAMES = ["d_0_1", "d_1_2", "d_2_3", "d_3_4"]


@query("price_deltas", _LABEL_BASE + """
SELECT block_id, p0 - p_m1 AS d_0_1, p_m1 - p_m2 AS d_1_2, p_m2 - p_m3 AS d_2_3, p_m3 - p_m4 AS d_3_4 FROM lf""")
def q_price_deltas(spark, sf):
    """PRJ-9: four successive hourly price differences."""
    df = prices.price_deltas(_label_frame(spark, sf), ["p0", "p_m1", "p_m2", "p_m3", "p_m4"], _DELTA_NAMES)
    return df.select("block_id", *_DELTA_NAMES)


@query("rise_flags", with_(OUTS, CANDLES) + f"""
, a AS (SELECT time - time % {S.GRAIN} AS t, receiver FROM outs GROUP BY 1, 2)
SELECT a.t, a.receiver, {", ".join(f"CASE WHEN c_{n}.close > c0.close THEN 1 ELSE 0 END AS f_{n}" for n in _RECV)}
FROM a JOIN candles c0 ON c0.unix = a.t
{" ".join(f"JOIN candles c_{n} ON c_{n}.unix = a.t + {v}" for n, v in _RECV.items())}""")
def q_rise_flags(spark, sf):
    """PRJ-11: 0/1 flags, price rose (strictly) 30 minutes and 1..4 hours later."""
    act = receiver_activity(S.outputs(spark, sf), S.GRAIN).select("t", "receiver")
    looked = prices.with_prices(act, S.daily_candles(spark, sf), {"close": 0, **_RECV}, missing="drop")
    flagged = prices.rise_flags(looked, "close", {f"f_{n}": n for n in _RECV})
    return flagged.select("t", "receiver", *[f"f_{n}" for n in _RECV])


@query("candle_derived_cols", with_(CANDLES) + "SELECT unix, date, vol_fiat FROM candles")
def q_candle_derived_cols(spark, sf):
    """PRJ-12: date from unix seconds and vol_fiat = volume * close."""
    base = S.daily_candles(spark, sf).select("unix", "volume", "close")
    return C.derive_candle_columns(base).select("unix", "date", "vol_fiat")


@query("shift_time", f"""
SELECT o_orderkey, {epoch('o_orderdate')} + {hours(4)} AS t_plus_4h,
       {epoch('o_orderdate')} - {hours(1)} AS t_minus_1h FROM orders""")
def q_shift_time(spark, sf):
    """DT-1: second-offset arithmetic on epoch seconds."""
    o = S.table(spark, sf, "orders").select("o_orderkey", epoch_seconds("o_orderdate").alias("t"))
    return o.select("o_orderkey", shift_time("t", hours(4)).alias("t_plus_4h"),
                    shift_time("t", -hours(1)).alias("t_minus_1h"))


@query("epoch_to_timestamp", f"""
SELECT event_id, {epoch('ts')} AS unix, make_timestamp({epoch('ts')} * 1000000) AS ts_second,
       strptime(strftime(ts, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS parsed FROM events""")
def q_epoch_to_timestamp(spark, sf):
    """DT-2: epoch seconds -> timestamp; text -> timestamp."""
    e = S.table(spark, sf, "events").select("event_id", epoch_seconds("ts").alias("unix"),
                                           F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("txt"))
    return e.select("event_id", "unix", seconds_to_ntz("unix").alias("ts_second"),
                    F.to_timestamp_ntz("txt", F.lit("yyyy-MM-dd HH:mm:ss")).alias("parsed"))
