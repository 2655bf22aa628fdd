"""Receiver operators: activity per time bucket, popularity, hit rates, scores,
and per-block coverage of scored receiver sets.

Global totals (the number of distinct time buckets, the size of a scored set) are
scalar subqueries (``DataFrame.scalar()``): Spark computes them once with a
distributed partial aggregate and inlines the value, with no cross join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.scalars import _key_parts, floor_time, hash160_hex
from ..sinks.staging import staged
from .prices import rise_flags, with_prices

# Fixed values of the reference (parameters here):
#   popularity tests: > 0.2, > 0.1, > 0.05, > 0.025, > 0.0125, >= 0.00625
#   popular receivers: fraction >= 0.00625
#   score thresholds on the 4-hour hit rate: 0.9, 0.8, 0.75, 0.7, 0.65
POPULARITY_TESTS = ((">", 0.2), (">", 0.1), (">", 0.05), (">", 0.025), (">", 0.0125), (">=", 0.00625))
POPULAR_MIN_FRACTION = 0.00625
SCORE_THRESHOLDS = (0.9, 0.8, 0.75, 0.7, 0.65)
# Hit-rate slots: 30 minutes, 1, 2, 3, 4 hours after the payment.
HIT_SLOTS = ("r30", "r1", "r2", "r3", "r4")


def receiver_activity(outs: DataFrame, grain: int = 60) -> DataFrame:
    """AGG-1: Σ amount and output count per (time bucket, receiver)."""
    return (outs.groupBy(floor_time("time", grain).alias("t"), "receiver")
            .agg(F.count(F.lit(1)).alias("n_txns"), F.sum("amount").alias("amount")))


def with_receiver_keys(outs: DataFrame, script: str = "script", name: str = "receiver", strict: bool = False) -> DataFrame:
    """STR-1 for a table (best a staged one: it is read three times): ``receiver_key`` of every row, with Python
    only for a dictionary of distinct scripts.

    Most scripts need built-in functions alone and go straight through. Those of the hash branch are made distinct, hashed
    once each, and joined back; the dictionary has one row per script, so a script that many outputs share is
    split like any skewed join."""
    plain, hashed, pub = _key_parts(script, strict)
    straight = outs.filter(~hashed).withColumn(name, plain)
    asked = outs.filter(hashed).withColumn("_pub", pub)
    book = staged(asked.select("_pub").distinct().withColumn("_hash", hash160_hex("_pub")), "receiver_hashes")
    found = asked.join(book, "_pub").withColumn(name, F.col("_hash")).drop("_pub", "_hash")
    return straight.unionByName(found)


def receiver_frequency(activity: DataFrame) -> DataFrame:
    """AGG-3: rows (time buckets) per receiver."""
    return activity.groupBy("receiver").agg(F.count(F.lit(1)).alias("freq"))


def n_buckets(activity: DataFrame) -> F.Column:
    """Scalar: number of distinct time buckets."""
    return activity.select(F.count_distinct("t")).scalar()


def receiver_popularity(activity: DataFrame) -> DataFrame:
    """AGG-4: receiver frequency ÷ number of distinct time buckets."""
    return receiver_frequency(activity).withColumn(
        "fraction", F.col("freq").cast("double") / n_buckets(activity).cast("double"))


def popularity_histogram(popularity: DataFrame, tests=POPULARITY_TESTS) -> DataFrame:
    """AGG-5: receivers passing each popularity test, in one pass."""
    aggs = []
    for op, x in tests:
        cond = F.col("fraction") > x if op == ">" else F.col("fraction") >= x
        aggs.append(F.count_if(cond).alias(f"n_{'gt' if op == '>' else 'ge'}_{str(x).replace('.', '_')}"))
    return popularity.agg(F.count(F.lit(1)).alias("n_receivers"), *aggs)


def popular_receivers(popularity: DataFrame, min_fraction: float = POPULAR_MIN_FRACTION) -> DataFrame:
    """FLT-2: receivers whose fraction is at least ``min_fraction``."""
    return popularity.filter(F.col("fraction") >= F.lit(min_fraction))


def popular_activity(activity: DataFrame, popular: DataFrame) -> DataFrame:
    """JN-6: activity rows of popular receivers (semi join; the right side is unique)."""
    return activity.join(popular.select("receiver"), "receiver", "left_semi")


def hit_rates(activity: DataFrame, candles: DataFrame, offsets: Mapping[str, int], *,
              now_col: str = "close", missing: str = "error", float32: bool = False) -> DataFrame:
    """AGG-6 with JN-4 and PRJ-11: per receiver n, Σ amount and the share of its
    time buckets after which the price rose, one ratio per offset.

    ``float32=True`` reproduces the reference's single-precision ratios (quirk Q1).
    """
    later = {f"_p_{k}": v for k, v in offsets.items()}
    looked = with_prices(activity, candles, later, time_col="t", missing=missing)
    flagged = rise_flags(looked, now_col, {f"_f_{k}": f"_p_{k}" for k in offsets})
    agg = flagged.groupBy("receiver").agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount"),
        *[F.sum(f"_f_{k}").alias(f"_s_{k}") for k in offsets])
    ratio_type = T.FloatType() if float32 else T.DoubleType()
    return agg.select(
        "receiver", "n", F.col("amount").cast("double").alias("amount"),
        *[(F.col(f"_s_{k}").cast(ratio_type) / F.col("n").cast(ratio_type)).cast(ratio_type).alias(k)
          for k in offsets])


def scores_by_threshold(scores: DataFrame, score_col: str = "r4",
                        thresholds: Sequence[float] = SCORE_THRESHOLDS) -> DataFrame:
    """FLT-3: one row per (threshold, receiver) with score >= threshold.

    Each receiver row generates the thresholds it passes (an array filter and
    explode), so no thresholds table is joined.
    """
    ths = F.array(*[F.lit(float(t)) for t in thresholds])
    passed = F.filter(ths, lambda th: F.col(score_col).cast("double") >= th)
    return scores.select(F.explode(passed).alias("threshold"), *scores.columns)


#: Bits of the scored receivers' bitmap for each of them, and the most buckets of ``BUCKET_BITS`` it may have (8 MB, broadcast).
BITS_EACH, BUCKET_BITS, MOST_BUCKETS = 16, 32768, 2048


def maybe_member(df: DataFrame, col: str, members: DataFrame, n_members: int, keep: str | None = None) -> DataFrame:
    """The rows of ``df`` whose ``col`` may be in the column of the same name of ``members``: a bitmap of the members' hashes, in
    buckets that are broadcast, lets every member pass and about one in ``BITS_EACH`` others (more of them if the
    bitmap had to be smaller than that). With ``keep`` all rows stay, and that column says so."""
    buckets = min(MOST_BUCKETS, max(1, -(-n_members * BITS_EACH // BUCKET_BITS)))
    bit = lambda c: F.pmod(F.xxhash64(F.lit("member"), c), F.lit(buckets * BUCKET_BITS))
    own = bit(F.col(col))
    bitmap = members.select(bit(F.col(col)).alias("_bit")).groupBy(F.floor(F.col("_bit") / BUCKET_BITS).cast("int").alias("_bucket")).agg(
        F.bitmap_construct_agg((F.col("_bit") % BUCKET_BITS)).alias("_bitmap"))
    at = (own % BUCKET_BITS).cast("int")
    byte = F.conv(F.hex(F.substring("_bitmap", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    told = df.join(F.broadcast(bitmap), F.floor(own / BUCKET_BITS).cast("int") == F.col("_bucket"), "left" if keep else "inner")
    maybe = F.getbit(byte, at % 8) == 1
    if keep:
        return told.select(*df.columns, F.coalesce(maybe, F.lit(False)).alias(keep))
    return told.filter(maybe).select(df.columns)


def block_coverage(outs: DataFrame, scores: DataFrame, score_col: str = "r4",
                   thresholds: Sequence[float] = SCORE_THRESHOLDS) -> DataFrame:
    """JN-7 + AGG-7 + AGG-13: per block, distinct receivers and, per threshold, the
    share of the receivers scoring at least that threshold that appear in the block.

    Two ways meet at the block. Distinct receivers are counted per block from all pairs. The hits come from the few
    pairs whose receiver may be a scored one: a bitmap of the scored receivers drops the others in the scan, before
    anything is shuffled, and a join with the scored receivers (one row each) decides.
    Shares of an empty scored set are NULL (quirk Q6).
    """
    scored = scores.select("receiver", F.col(score_col).cast("double").alias("_score")).filter(
        F.col("_score") >= F.lit(float(min(thresholds))))
    scored = staged(scored, "scored")
    sizes = scored.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("_score") >= F.lit(float(t))).alias(f"n_{_pct(t)}")
                                                       for t in thresholds]).first()
    pairs = outs.select("block_id", "time", "receiver")
    unique = pairs.distinct().groupBy("block_id", "time").agg(F.count(F.lit(1)).alias("n_unique_receivers"))
    hits = maybe_member(pairs, "receiver", scored, sizes["n"]).distinct().join(scored, "receiver")
    hits = hits.groupBy(F.col("block_id").alias("_b"), F.col("time").alias("_t")).agg(
        *[F.count_if(F.col("_score") >= F.lit(float(t))).alias(f"_hit_{_pct(t)}") for t in thresholds])
    both = unique.join(hits, F.col("block_id").eqNullSafe(F.col("_b")) & F.col("time").eqNullSafe(F.col("_t")), "left")

    def share(p: int) -> F.Column:
        size = sizes[f"n_{p}"]
        hit = F.coalesce(F.col(f"_hit_{p}"), F.lit(0)).cast("double")
        return (hit / F.lit(float(size)) if size else F.lit(None).cast("double")).alias(f"coverage_{p}")

    return both.select("block_id", "time", "n_unique_receivers", *[share(_pct(t)) for t in thresholds])


def _pct(t: float) -> int:
    return int(round(t * 100))
