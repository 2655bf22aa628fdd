"""Registered queries: receivers, scores, coverage and the feature jobs
(AGG-1, AGG-3..6, AGG-13, AGG-14, FLT-2, FLT-3, JN-6, JN-7, PRJ-13, SRT-2,
SNK-8, JOB-2 ... JOB-5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import receivers as R
from ..sinks.staging import staged
from . import jobs as J
from . import standins as S
from .catalog import query
from .sqlviews import (BLOCKS, CANDLES, FEATURES, FIRSTS, HITS, OUTS, POP, RAW, RECV_OFFSETS, split_sql,
                       with_)

_RAW = with_(OUTS, CANDLES, RAW)
_HITS = with_(OUTS, CANDLES, RAW, POP, HITS)
_FEAT = with_(OUTS, CANDLES, RAW, POP, HITS, FIRSTS, BLOCKS, FEATURES)


def staged_outputs(spark, sf):
    """The flat outputs staged once for the multi-pass jobs (decoded blocks would be
    staged the same way): the coinbase table, the activity, the block summary and the
    coverage pairs all read this copy."""
    return staged(S.outputs(spark, sf), "outputs")


def raw(spark, sf, outs=None):
    """JOB-2 output: a price lookup and a label over the staged activity."""
    outs = staged_outputs(spark, sf) if outs is None else outs
    return J.receiver_raw(outs, S.daily_candles(spark, sf), grain=S.GRAIN,
                          cut_index=S.RECEIVER_CUT_INDEX, missing="drop", fewer="last")


def train(spark, sf, outs=None):
    return raw(spark, sf, outs).filter(F.col("split") == "train").drop("split")


def scores(spark, sf, outs=None):
    """JOB-3 output (one row per popular receiver), staged once."""
    act = train(spark, sf, outs)
    return staged(J.receiver_scores(act, S.daily_candles(spark, sf), RECV_OFFSETS, missing="drop"), "scores")


def features(spark, sf, version, outs=None):
    """The block features; the outputs are staged once for the scores and the features."""
    outs = staged_outputs(spark, sf) if outs is None else outs
    sc = scores(spark, sf, outs)
    feat = J.block_features(outs, sc, S.daily_candles(spark, sf), grain=S.GRAIN, hour=S.HOUR,
                            fanout_min=S.FANOUT_MIN, high_value=S.HIGH_VALUE, subsidy=S.SUBSIDY,
                            version=version, missing="drop")
    n_train = S.TRAIN_BLOCKS_V1 if version == 1 else S.TRAIN_BLOCKS_V2
    # one row per block; staged so the split's two cut subqueries read it once
    return J.split_features(staged(feat, "features"), n_train, S.VALID_BLOCKS)


def coverage(spark, sf, **kw):
    """JN-7 over one staged copy of the outputs."""
    outs = staged_outputs(spark, sf)
    return R.block_coverage(outs, scores(spark, sf, outs), **kw)


@query("receiver_activity", with_(OUTS) + f"""
SELECT time - time % {S.GRAIN} AS t, receiver, count(*) AS n_txns, CAST(sum(amount) AS DOUBLE) AS amount
FROM outs GROUP BY 1, 2""")
def q_receiver_activity(spark, sf):
    """AGG-1: Σ amount and output count per (time bucket, receiver)."""
    act = R.receiver_activity(S.outputs(spark, sf), S.GRAIN)
    return act.withColumn("amount", F.col("amount").cast("double"))


@query("job_receiver_raw", _RAW + """
SELECT t, receiver, n_txns, CAST(amount AS DOUBLE) AS amount, close, split FROM rawp""")
def q_job_receiver_raw(spark, sf):
    """JOB-2: receiver activity with its close, coinbase dropped, train/test cut."""
    return raw(spark, sf).withColumn("amount", F.col("amount").cast("double"))


@query("rekey_columns", _RAW + """
SELECT t, receiver, n_txns, CAST(amount AS DOUBLE) AS amount, close FROM rawp""")
def q_rekey_columns(spark, sf):
    """PRJ-13: all rows re-keyed to the text layout (t, receiver, n, amount, close)."""
    r = raw(spark, sf)
    return r.select("t", "receiver", "n_txns", F.col("amount").cast("double").alias("amount"), "close")


@query("receiver_frequency", _RAW + "SELECT receiver, count(*) AS freq FROM train GROUP BY receiver")
def q_receiver_frequency(spark, sf):
    """AGG-3: time buckets per receiver in the training span."""
    return R.receiver_frequency(train(spark, sf))


@query("receiver_popularity", with_(OUTS, CANDLES, RAW, POP) + "SELECT receiver, freq, fraction FROM pop")
def q_receiver_popularity(spark, sf):
    """AGG-4: frequency ÷ number of distinct time buckets."""
    return R.receiver_popularity(train(spark, sf))


_HIST_COLS = ["n_gt_0_2", "n_gt_0_1", "n_gt_0_05", "n_gt_0_025", "n_gt_0_0125", "n_ge_0_00625"]


@query("popularity_histogram", with_(OUTS, CANDLES, RAW, POP) + """
SELECT count(*) AS n_receivers, count(*) FILTER (WHERE fraction > 0.2) AS n_gt_0_2,
       count(*) FILTER (WHERE fraction > 0.1) AS n_gt_0_1, count(*) FILTER (WHERE fraction > 0.05) AS n_gt_0_05,
       count(*) FILTER (WHERE fraction > 0.025) AS n_gt_0_025,
       count(*) FILTER (WHERE fraction > 0.0125) AS n_gt_0_0125,
       count(*) FILTER (WHERE fraction >= 0.00625) AS n_ge_0_00625 FROM pop""")
def q_popularity_histogram(spark, sf):
    """AGG-5: receivers above each popularity fraction, one pass."""
    return R.popularity_histogram(R.receiver_popularity(train(spark, sf)))


@query("popular_receivers", with_(OUTS, CANDLES, RAW, POP) + """
SELECT receiver, fraction FROM pop WHERE fraction >= 0.00625""")
def q_popular_receivers(spark, sf):
    """FLT-2: receivers present in at least 0.625% of time buckets."""
    return R.popular_receivers(R.receiver_popularity(train(spark, sf))).select("receiver", "fraction")


@query("popular_activity", with_(OUTS, CANDLES, RAW, POP) + """
SELECT t, receiver, n_txns, CAST(amount AS DOUBLE) AS amount, close FROM train
WHERE receiver IN (SELECT receiver FROM popular)""")
def q_popular_activity(spark, sf):
    """JN-6: training activity of popular receivers (semi join)."""
    tr = train(spark, sf)
    act = R.popular_activity(tr, R.popular_receivers(R.receiver_popularity(tr)))
    return act.withColumn("amount", F.col("amount").cast("double"))


@query("receiver_hit_rates", _HITS + "SELECT * FROM hits")
def q_receiver_hit_rates(spark, sf):
    """AGG-6: n, Σ amount and the five rise ratios per popular receiver."""
    return scores(spark, sf)


@query("scores_by_threshold", _HITS + """
SELECT th.threshold, h.* FROM hits h JOIN (VALUES (0.9), (0.8), (0.75), (0.7), (0.65)) th(threshold)
ON h.r4 >= th.threshold""")
def q_scores_by_threshold(spark, sf):
    """FLT-3: one row per (threshold, receiver) with 4-hour hit rate >= threshold."""
    return R.scores_by_threshold(scores(spark, sf))


@query("job_receiver_scores", _HITS + """
SELECT th.threshold, CAST(round(th.threshold * 100) AS INTEGER) AS threshold_pct, h.*
FROM hits h JOIN (VALUES (0.9), (0.8), (0.75), (0.7), (0.65)) th(threshold) ON h.r4 >= th.threshold
ORDER BY th.threshold, h.r4 DESC""")
def q_job_receiver_scores(spark, sf):
    """JOB-3: scored receivers per threshold, best 4-hour hit rate first."""
    from ..functions.scalars import threshold_percent
    s = R.scores_by_threshold(scores(spark, sf))
    s = s.select("threshold", threshold_percent("threshold").alias("threshold_pct"),
                 *[c for c in s.columns if c != "threshold"])
    return s.orderBy("threshold", F.desc("r4"))


@query("order_by_score", _HITS + "SELECT receiver, r4 FROM hits ORDER BY r4 DESC, receiver")
def q_order_by_score(spark, sf):
    """SRT-2: receivers by 4-hour hit rate, descending."""
    return scores(spark, sf).select("receiver", "r4").orderBy(F.desc("r4"), "receiver")


@query("receiver_coverage", _FEAT + """
SELECT blockId AS block_id, numUniqueReceivers AS n_unique_receivers,
       proportionOfReceiversWith65AccInBlock AS coverage_65, proportionOfReceiversWith70AccInBlock AS coverage_70,
       proportionOfReceiversWith75AccInBlock AS coverage_75, proportionOfReceiversWith80AccInBlock AS coverage_80,
       proportionOfReceiversWith90AccInBlock AS coverage_90 FROM (
  SELECT b.block_id AS blockId, CAST(cv.n_unique AS BIGINT) AS numUniqueReceivers,
""" + ", ".join(f"CAST(cv.h{p} AS DOUBLE) / NULLIF((SELECT s{p} FROM sizes), 0) AS proportionOfReceiversWith{p}AccInBlock"
                for p in (65, 70, 75, 80, 90)) + """
  FROM blocks b JOIN cov cv USING (block_id))""")
def q_receiver_coverage(spark, sf):
    """JN-7: per block, share of each scored set present among its receivers."""
    cov = coverage(spark, sf)
    return cov.select("block_id", "n_unique_receivers", *[f"coverage_{p}" for p in (65, 70, 75, 80, 90)])


@query("coverage_ratio", _FEAT + """
SELECT b.block_id, CAST(cv.h75 AS DOUBLE) / NULLIF((SELECT s75 FROM sizes), 0) AS coverage_75
FROM blocks b JOIN cov cv USING (block_id)""")
def q_coverage_ratio(spark, sf):
    """AGG-13: members present ÷ set size for the 0.75 set (NULL when empty)."""
    cov = coverage(spark, sf, thresholds=(0.75,))
    return cov.select("block_id", "coverage_75")


_V1_COLS = ", ".join(J.FEATURES_V1)
_V2_COLS = ", ".join(J.FEATURES_V1 + J.FEATURES_V2_EXTRA)


@query("job_block_features_v1", _FEAT + ", " + split_sql(S.TRAIN_BLOCKS_V1, S.VALID_BLOCKS) +
       f"\nSELECT {_V1_COLS}, split FROM splitted")
def q_job_block_features_v1(spark, sf):
    """JOB-4: 22 feature columns per block and the train/valid/test split."""
    return features(spark, sf, 1)


@query("job_block_features_v2", _FEAT + ", " + split_sql(S.TRAIN_BLOCKS_V2, S.VALID_BLOCKS) +
       f"\nSELECT {_V2_COLS}, split FROM splitted")
def q_job_block_features_v2(spark, sf):
    """JOB-5: 26 feature columns per block and the train/valid/test split."""
    return features(spark, sf, 2)


@query("dataset_counts", _FEAT + ", " + split_sql(S.TRAIN_BLOCKS_V2, S.VALID_BLOCKS) + """
SELECT (SELECT count(DISTINCT block_id) FROM outs) AS n_blocks, (SELECT count(*) FROM outs) AS n_outputs,
       (SELECT count(*) FROM raw) AS n_receiver_rows, (SELECT count(DISTINCT t) FROM train) AS n_train_buckets,
       (SELECT count(DISTINCT receiver) FROM train) AS n_train_receivers,
       (SELECT count(*) FROM splitted WHERE split = 'train') AS n_train_blocks,
       (SELECT count(*) FROM splitted WHERE split = 'valid') AS n_valid_blocks,
       (SELECT count(*) FROM splitted WHERE split = 'test') AS n_test_blocks""")
def q_dataset_counts(spark, sf):
    """AGG-14: the global counts the reference prints, one aggregate per table."""
    from ..operators.chain import drop_first_tx
    outs = staged_outputs(spark, sf)

    def counts(df, **aggs):  # one row, one aggregate; its fields are scalars of that one subquery
        return df.agg(F.struct(*[c.alias(n) for n, c in aggs.items()])).scalar()

    act = counts(R.receiver_activity(drop_first_tx(outs), S.GRAIN), n_receiver_rows=F.count(F.lit(1)))
    tr = counts(train(spark, sf, outs), n_train_buckets=F.count_distinct("t"), n_train_receivers=F.count_distinct("receiver"))
    split = counts(features(spark, sf, 2, outs), **{f"n_{v}_blocks": F.count_if(F.col("split") == v)
                                              for v in ("train", "valid", "test")})
    o = outs.agg(F.count_distinct("block_id").alias("n_blocks"), F.count(F.lit(1)).alias("n_outputs"))
    return o.select("n_blocks", "n_outputs", act["n_receiver_rows"].alias("n_receiver_rows"),
                    *[tr[n].alias(n) for n in ("n_train_buckets", "n_train_receivers")],
                    *[split[n].alias(n) for n in ("n_train_blocks", "n_valid_blocks", "n_test_blocks")])


@query("report_rows", with_(OUTS, CANDLES, RAW, POP) + """
SELECT metric, value FROM (
  SELECT 'n_buckets' AS metric, CAST((SELECT count(DISTINCT t) FROM train) AS BIGINT) AS value
  UNION ALL SELECT 'n_receivers', CAST(count(*) AS BIGINT) FROM pop
  UNION ALL SELECT 'n_gt_0_2', CAST(count(*) FILTER (WHERE fraction > 0.2) AS BIGINT) FROM pop
  UNION ALL SELECT 'n_gt_0_1', CAST(count(*) FILTER (WHERE fraction > 0.1) AS BIGINT) FROM pop
  UNION ALL SELECT 'n_gt_0_05', CAST(count(*) FILTER (WHERE fraction > 0.05) AS BIGINT) FROM pop
  UNION ALL SELECT 'n_gt_0_025', CAST(count(*) FILTER (WHERE fraction > 0.025) AS BIGINT) FROM pop
  UNION ALL SELECT 'n_gt_0_0125', CAST(count(*) FILTER (WHERE fraction > 0.0125) AS BIGINT) FROM pop
  UNION ALL SELECT 'n_ge_0_00625', CAST(count(*) FILTER (WHERE fraction >= 0.00625) AS BIGINT) FROM pop)""")
def q_report_rows(spark, sf):
    """SNK-8: the printed receiver statistics as (metric, value) rows."""
    tr = train(spark, sf)
    hist = R.popularity_histogram(R.receiver_popularity(tr)).withColumn(
        "n_buckets", R.n_buckets(tr))
    names = ["n_buckets", "n_receivers", *_HIST_COLS]
    stack = "stack({}, {})".format(len(names), ", ".join(f"'{n}', CAST(`{n}` AS BIGINT)" for n in names))
    return hist.select(F.expr(stack).alias("metric", "value"))

