"""DuckDB SQL twins of ``plans.standins`` for the oracle queries.

Each constant is a list of ``name AS (...)`` common-table expressions over the
pre-registered test tables; ``with_(...)`` joins the ones a query needs.
"""

from __future__ import annotations

from .nested import ORDERS_PER_BLOCK
from .standins import FANOUT_MIN, GRAIN, HIGH_VALUE, HOUR, SUBSIDY

EPOCH = "(epoch_us({c}) // 1000000)"


def epoch(c: str) -> str:
    return EPOCH.format(c=c)


OUTS = f"""outs AS (
  SELECT CAST({epoch('o_orderdate')} AS VARCHAR) || '-' || o_orderstatus AS block_id,
         {epoch('o_orderdate')} AS time, o_orderkey AS txid, o_orderkey AS tx_pos,
         l_linenumber, l_partkey, l_suppkey, l_extendedprice,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS amount,
         CAST(l_partkey AS VARCHAR) AS receiver
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

# the nested stand-in's blocks (plans.nested): runs of order keys, timed by their earliest order
NESTED_OUTS = OUTS.replace("outs AS (", "flat AS (", 1) + f""",
outs AS (
  SELECT * EXCLUDE (block_id, time), CAST(txid // {ORDERS_PER_BLOCK} AS VARCHAR) AS block_id,
         min(time) OVER (PARTITION BY txid // {ORDERS_PER_BLOCK}) AS time FROM flat)"""

CANDLES = f"""candles AS (
  SELECT unix, low, high, open, close, volume, make_timestamp(unix * 1000000) AS date,
         volume * close AS vol_fiat
  FROM (SELECT {epoch('o_orderdate')} AS unix, min(o_totalprice) AS low, max(o_totalprice) AS high,
               arg_min(o_totalprice, o_orderkey) AS open, arg_max(o_totalprice, o_orderkey) AS close,
               CAST(count(*) AS DOUBLE) AS volume
        FROM orders GROUP BY 1))"""

# first output of each block = first output of its first transaction
FIRSTS = """firsts AS (
  SELECT block_id, amount AS first_amount FROM (
    SELECT block_id, amount, row_number() OVER (PARTITION BY block_id
           ORDER BY tx_pos, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS rn
    FROM outs) WHERE rn = 1)"""

BLOCKS = f"""blocks AS (
  SELECT b.block_id, b.time, b.n_txns, b.total_amount, f.first_amount - {SUBSIDY} AS fee_reward,
         b.n_fanout_txs, b.n_high_value_outputs
  FROM (SELECT block_id, time, count(DISTINCT txid) AS n_txns, sum(amount) AS total_amount,
               count(DISTINCT CASE WHEN n_out >= {FANOUT_MIN} THEN txid END) AS n_fanout_txs,
               count(*) FILTER (WHERE amount >= {HIGH_VALUE}) AS n_high_value_outputs
        FROM (SELECT *, count(*) OVER (PARTITION BY txid) AS n_out FROM outs) GROUP BY block_id, time) b
  JOIN firsts f USING (block_id))"""

ACTIVITY = f"""act AS (
  SELECT time - time % {GRAIN} AS t, sum(n_txns) AS n_txns, sum(total_amount) AS total_amount,
         sum(fee_reward) AS fee_reward
  FROM blocks GROUP BY 1)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def hours(k: float) -> int:
    return int(round(k * HOUR))


# ---------------------------------------------------------------- receiver pipeline
# (JOB-2 -> JOB-3): coinbase dropped, activity per (day, receiver), close, cut.
from .standins import RECEIVER_CUT_INDEX  # noqa: E402

RECV_OFFSETS = {"r30": HOUR // 2, "r1": HOUR, "r2": 2 * HOUR, "r3": 3 * HOUR, "r4": 4 * HOUR}

RAW = f"""cb AS (SELECT block_id, min(txid) AS first_tx FROM outs GROUP BY block_id),
raw AS (
  SELECT o.time - o.time % {GRAIN} AS t, o.receiver, count(*) AS n_txns, sum(o.amount) AS amount
  FROM outs o JOIN cb USING (block_id) WHERE o.txid > cb.first_tx GROUP BY 1, 2),
cut AS (SELECT max(t) AS cutoff FROM (SELECT DISTINCT t FROM raw ORDER BY t LIMIT {RECEIVER_CUT_INDEX + 1})),
rawp AS (
  SELECT r.t, r.receiver, r.n_txns, r.amount, c.close,
         CASE WHEN r.t <= (SELECT cutoff FROM cut) THEN 'train' ELSE 'test' END AS split
  FROM raw r JOIN candles c ON c.unix = r.t),
train AS (SELECT * FROM rawp WHERE split = 'train')"""

POP = """pop AS (
  SELECT receiver, count(*) AS freq,
         CAST(count(*) AS DOUBLE) / (SELECT count(DISTINCT t) FROM train) AS fraction
  FROM train GROUP BY receiver),
popular AS (SELECT receiver FROM pop WHERE fraction >= 0.00625)"""

HITS = "hits AS (\n  SELECT tr.receiver, count(*) AS n, CAST(sum(tr.amount) AS DOUBLE) AS amount,\n" + ",\n".join(
    f"         CAST(sum(CASE WHEN c_{k}.close > tr.close THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS {k}"
    for k in RECV_OFFSETS) + "\n  FROM train tr " + " ".join(
    f"JOIN candles c_{k} ON c_{k}.unix = tr.t + {v}" for k, v in RECV_OFFSETS.items()) + """
  WHERE tr.receiver IN (SELECT receiver FROM popular) GROUP BY tr.receiver)"""

FEATURES = f"""pairs AS (SELECT DISTINCT block_id, time, receiver FROM outs),
cov AS (
  SELECT p.block_id, count(*) AS n_unique,
         {", ".join(f"count(*) FILTER (WHERE h.r4 >= {t}) AS h{int(round(t * 100))}" for t in (0.9, 0.8, 0.75, 0.7, 0.65))}
  FROM pairs p LEFT JOIN hits h USING (receiver) GROUP BY p.block_id),
sizes AS (SELECT {", ".join(f"count(*) FILTER (WHERE r4 >= {t}) AS s{int(round(t * 100))}" for t in (0.9, 0.8, 0.75, 0.7, 0.65))} FROM hits),
feat AS (
  SELECT b.block_id AS blockId, b.time - b.time % {GRAIN} AS blockFloorTime,
         CAST(cv.n_unique AS INTEGER) AS numUniqueReceivers, CAST(b.n_txns AS INTEGER) AS numTxnsInBlock,
         CAST(b.fee_reward AS DOUBLE) AS blockFeeReward,
         CAST(b.total_amount AS DOUBLE) AS totalBtcAmountReceivedInBlock,
         {", ".join(f"CAST(cv.h{p} AS DOUBLE) / NULLIF((SELECT s{p} FROM sizes), 0) AS proportionOfReceiversWith{p}AccInBlock" for p in (65, 70, 75, 80, 90))},
         c0.close AS currBitcoinPrice, m1.close AS bitcoinPrice1HrAgo, m2.close AS bitcoinPrice2HrAgo,
         m3.close AS bitcoinPrice3HrAgo, m4.close AS bitcoinPrice4HrAgo,
         CAST(b.total_amount AS DOUBLE) / b.n_txns AS avgAmtOfBtcPerTxn,
         CAST(b.n_fanout_txs AS INTEGER) AS numTxnsWithMoreThan10Outputs,
         CAST(b.n_high_value_outputs AS INTEGER) AS numHighValueTxnsInBlock,
         l4.close AS bitcoinPrice4HrLater, CASE WHEN l4.close > c0.close THEN 1 ELSE 0 END AS label,
         l4.close - c0.close AS priceDiffBtw4HrLaterAndCurrPrice,
         c0.close - m1.close AS changeInBtcPriceBtwCurrAnd1HrAgo, m1.close - m2.close AS changeInBtcPriceBtw1And2HrAgo,
         m2.close - m3.close AS changeInBtcPriceBtw2And3HrAgo, m3.close - m4.close AS changeInBtcPriceBtw3And4HrAgo
  FROM blocks b JOIN cov cv USING (block_id)
  JOIN candles c0 ON c0.unix = b.time - b.time % {GRAIN}
  JOIN candles m1 ON m1.unix = b.time - b.time % {GRAIN} - {HOUR}
  JOIN candles m2 ON m2.unix = b.time - b.time % {GRAIN} - {2 * HOUR}
  JOIN candles m3 ON m3.unix = b.time - b.time % {GRAIN} - {3 * HOUR}
  JOIN candles m4 ON m4.unix = b.time - b.time % {GRAIN} - {4 * HOUR}
  JOIN candles l4 ON l4.unix = b.time - b.time % {GRAIN} + {4 * HOUR})"""


def split_sql(n_train: int, n_valid: int) -> str:
    return f"""splitted AS (
  SELECT *, CASE WHEN rn <= {n_train} THEN 'train' WHEN rn <= {n_train + n_valid} THEN 'valid' ELSE 'test' END AS split
  FROM (SELECT *, row_number() OVER (ORDER BY blockFloorTime, blockId) AS rn FROM feat))"""
