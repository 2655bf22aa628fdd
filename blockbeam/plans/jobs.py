"""End-to-end jobs (JOB-2 ... JOB-5) composed from the operators.

Each returns one DataFrame; where the reference writes several directories
(all / train / test, or train / valid / test) the rows carry a ``split`` column
and a sink can ``partitionBy("split")``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.columns import BLOCK_COLUMNS as FEATURES_V1, PRICE_CHANGES as FEATURES_V2_EXTRA
from ..functions.scalars import floor_time
from ..sinks.staging import staged
from ..operators import chain, prices, receivers as R, splits

def receiver_raw(outs: DataFrame, candles: DataFrame, *, grain: int, cut_index: int,
                 missing: str = "error", drop_coinbase: bool = True, fewer: str = "error") -> DataFrame:
    """JOB-2: coinbase dropped (quirk Q12, a parameter), Σ per (bucket, receiver), close
    at the bucket, and a train/test label cut at the (cut_index+1)-th distinct bucket."""
    kept = chain.drop_first_tx(outs, few_blocks=chain.FEW_BLOCKS) if drop_coinbase else outs
    # the activity table is the stage boundary (the reference writes it out): staged
    # once, it feeds both the cut subquery and the price lookup
    act = staged(R.receiver_activity(kept, grain), "activity")
    cutoff = splits.nth_key(act, "t", cut_index + 1, fewer=fewer)
    priced = prices.with_prices(act, candles, {"close": 0}, time_col="t", missing=missing)
    out = priced.select("t", "receiver", "n_txns", "amount", "close")
    return splits.temporal_split(out, "t", cutoff)


def receiver_scores(train_activity: DataFrame, candles: DataFrame, offsets: Mapping[str, int], *,
                    min_fraction: float = R.POPULAR_MIN_FRACTION, missing: str = "error",
                    float32: bool = False) -> DataFrame:
    """JOB-3 core: popularity -> popular receivers -> hit rates per receiver."""
    popular = R.popular_receivers(R.receiver_popularity(train_activity), min_fraction)
    act = R.popular_activity(train_activity, popular)
    return R.hit_rates(act, candles, offsets, missing=missing, float32=float32)


def block_features(outs: DataFrame, scores: DataFrame, candles: DataFrame, *, grain: int, hour: int,
                   fanout_min: int, high_value, subsidy: float, version: int = 2,
                   thresholds: Sequence[float] = R.SCORE_THRESHOLDS, missing: str = "error") -> DataFrame:
    """JOB-4 (version 1, 22 columns) / JOB-5 (version 2, 26 columns) per block."""
    blk = chain.block_summary(outs, fanout_min=fanout_min, high_value=high_value, subsidy=subsidy)
    cov = R.block_coverage(outs, scores, "r4", thresholds)
    feat = blk.join(cov, ["block_id", "time"]).withColumn("_ft", floor_time("time", grain))
    offs = {"_p0": 0, "_m1": -hour, "_m2": -2 * hour, "_m3": -3 * hour, "_m4": -4 * hour, "_l4": 4 * hour}
    feat = prices.with_prices(feat, candles, offs, time_col="_ft", missing=missing)
    cols = [
        F.col("block_id"), F.col("_ft"), F.col("n_unique_receivers").cast("int"),
        F.col("n_txns").cast("int"), F.col("fee_reward").cast("double"),
        F.col("total_amount").cast("double"),
        *[F.col(f"coverage_{p}") for p in (65, 70, 75, 80, 90)],
        F.col("_p0"), F.col("_m1"), F.col("_m2"), F.col("_m3"), F.col("_m4"),
        F.col("total_amount").cast("double") / F.col("n_txns"),
        F.col("n_fanout_txs").cast("int"), F.col("n_high_value_outputs").cast("int"),
        F.col("_l4"), prices.price_label("_l4", "_p0"), F.col("_l4") - F.col("_p0"),
    ]
    out = feat.select(*[c.alias(n) for c, n in zip(cols, FEATURES_V1)])
    if version >= 2:
        out = prices.price_deltas(out, ["currBitcoinPrice", "bitcoinPrice1HrAgo", "bitcoinPrice2HrAgo",
                                        "bitcoinPrice3HrAgo", "bitcoinPrice4HrAgo"], list(FEATURES_V2_EXTRA))
    return out


def split_features(features: DataFrame, n_train: int, n_valid: int, embargo: int = 0) -> DataFrame:
    """Train / valid / test by (blockFloorTime, blockId); ``embargo`` seconds keep
    look-ahead labels from reaching past the cut (quirk Q4)."""
    return splits.chronological_split(features, ["blockFloorTime", "blockId"], n_train, n_valid, embargo=embargo)
