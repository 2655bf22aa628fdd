"""The reference's programs on real inputs: block files and a candle parquet.

    python -m blockbeam.plans.ledger_jobs <job> --blocks DIR --candles PATH --out DIR [options]

Jobs: ``tx-listing`` (JOB-7), ``block-activity`` (JOB-1), ``receiver-raw`` (JOB-2),
``receiver-scores`` (JOB-3), ``block-features`` (JOB-4/5), ``train-report`` (JOB-8),
``tune`` (ML-7), ``candle-compaction`` (JOB-6) and ``rolling-slope`` (WIN-1 on the activity
CSV). Each reads the previous job's output folder, so they chain like the
reference's programs, and every constant of the reference is an option with the
reference's value as its default. Outputs go under ``--out`` (a shared folder on a
cluster) and appear there, listed in ``_manifest``, when the job has written them all (``sinks.runs``); a lost
executor is covered by Spark's retries and the stages under ``spark.checkpoint.dir``, which are deleted at the job's end.
``train-report`` saves its forest, and ``score`` gives a saved forest's predictions.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.scalars import threshold_percent
from ..ml import forest as M
from ..operators import chain, prices, receivers as R, splits, windows as Wn
from ..sinks.staging import staged
from ..session import build_session
from ..sinks import writers as Wr
from ..sinks.runs import run_folder
from ..sources import blocks as B, candles as C, text as Tx
from . import jobs as J
from .q_chain import ACTIVITY_COLUMNS, ACTIVITY_OFFSETS_H

# The reference's time grain, hour, cuts and limits.
DEFAULTS = dict(grain=60, hour=3600, receiver_cut_index=3999, train_v1=3800, train_v2=4000, valid=500,
                fanout_min=10, high_value=10.0, subsidy=6.25, missing="error", fewer="error", embargo=0)


def outputs(spark: SparkSession, a) -> DataFrame:
    """Decoded blocks -> flat outputs, staged once, with receiver keys."""
    return chain.explode_outputs(B.read_block_files(spark, a.blocks, glob=a.glob, on_bad=a.on_bad))


def candles(spark: SparkSession, a) -> DataFrame:
    return C.latest_by_key(C.read_candles(spark, a.candles).select("unix", "close"), "unix")


def tx_listing(spark, a) -> dict:
    blocks = B.read_block_files(spark, a.blocks, glob=a.glob, on_bad=a.on_bad)
    listing = chain.list_transactions(blocks)
    Wr.write_tuple_text(listing, a.run.path("transactions"), ["time", "txid"])
    r = listing.agg(F.min("time").alias("min_time"), F.max("time").alias("max_time"),
                    F.count(F.lit(1)).alias("n_txns")).first()
    return r.asDict()


def block_activity(spark, a) -> dict:
    act = chain.block_activity(outputs(spark, a), grain=a.grain, subsidy=a.subsidy)
    offs = {f"_p{h}": h * a.hour for h in ACTIVITY_OFFSETS_H}
    priced = prices.with_prices(act, candles(spark, a), offs, time_col="t", missing=a.missing)
    names = dict(zip(["t", "n_txns", "total_amount", "fee_reward", *offs], ACTIVITY_COLUMNS))
    table = priced.select(*[F.col(k).alias(v) for k, v in names.items()])
    path = a.run.path("block_activity")
    Wr.write_sorted_csv(table, path, ["block_timestamp"], single_file=a.single_file)
    return {"rows": spark.read.option("header", True).csv(path).count()}


def receiver_raw(spark, a) -> dict:
    outs = chain.explode_outputs(B.read_block_files(spark, a.blocks, glob=a.glob, on_bad=a.on_bad),
                                 drop_first_tx=True)
    act = staged(R.receiver_activity(outs, a.grain), "activity")
    cut = splits.nth_key(act, "t", a.receiver_cut_index + 1, fewer=a.fewer)
    priced = prices.with_prices(act, candles(spark, a), {"close": 0}, time_col="t", missing=a.missing)
    rows = splits.temporal_split(priced.select("t", "receiver", "n_txns", F.col("amount").cast("double"), "close"),
                                 "t", cut)
    path = a.run.path("receiver_account_raw_data")
    Wr.write_csv(rows, path, partition_by=["split"])
    return {"rows": spark.read.csv(path).count()}


def receiver_scores(spark, a) -> dict:
    train = Tx.read_receiver_activity(spark, f"{a.out}/receiver_account_raw_data/split=train")
    hrs = {"r30": a.hour // 2, "r1": a.hour, "r2": 2 * a.hour, "r3": 3 * a.hour, "r4": 4 * a.hour}
    scores = staged(J.receiver_scores(train, candles(spark, a), hrs, missing=a.missing, float32=a.float32), "scores")
    by_th = R.scores_by_threshold(scores).withColumn("threshold_pct", threshold_percent("threshold"))
    Wr.write_tuple_text(by_th, a.run.path("scored_receivers"), list(Tx.SCORE_FIELDS),
                        partition_by=["threshold_pct"], order=[F.desc("r4")])
    return {"scored": scores.count(), "histogram": R.popularity_histogram(R.receiver_popularity(train))
            .first().asDict()}


def block_features(spark, a) -> dict:
    scores = Tx.read_score_rows(spark, f"{a.out}/scored_receivers")
    feat = J.block_features(outputs(spark, a), scores, candles(spark, a), grain=a.grain, hour=a.hour,
                            fanout_min=a.fanout_min, high_value=a.high_value, subsidy=a.subsidy,
                            version=a.version, missing=a.missing)
    n_train = a.train_v1 if a.version == 1 else a.train_v2
    split = J.split_features(staged(feat, "features"), n_train, a.valid, embargo=a.embargo)
    Wr.write_parquet(split, a.run.path(f"block_features_v{a.version}"), partition_by=["split"])
    return {r.split: r["count"] for r in split.groupBy("split").count().collect()}


def _model_of(version: int) -> tuple[list[str], dict, tuple[str, ...]]:
    """Features, parameters and scored sets of a version."""
    if version == 2:
        return M.FEATURES_V2, M.TUNED, tuple(M.SCORED_SETS)
    return M.FEATURES_V1, {"seed": 1000}, ("valid", "test")


def train_report(spark, a) -> dict:
    sp = spark.read.parquet(f"{a.out}/block_features_v{a.version}")
    feats, params, sets = _model_of(a.version)
    model = M.train_forest(sp.filter(F.col("split") == "train"), feats, partitions=a.fit_partitions, **params)
    model.save(a.run.path(f"model_v{a.version}"))
    rep = staged(M.model_report(model, sp, feats, sets, with_importances=a.version == 2), "report")
    Wr.write_csv(rep, a.run.path(f"metrics_v{a.version}"), header=True)
    return {f"{r.scored_set}:{r.metric}:{r.feature or r.label}": r.value for r in rep.collect()}


def score(spark, a) -> dict:
    """Predictions of the saved forest on the blocks outside the training set."""
    feats, _, _ = _model_of(a.version)
    model = M.load_model(f"{a.out}/model_v{a.version}")
    sp = spark.read.parquet(f"{a.out}/block_features_v{a.version}").filter(F.col("split") != "train")
    path = a.run.path(f"predictions_v{a.version}")
    Wr.write_parquet(M.score(model, sp, feats), path)
    return {"rows": spark.read.parquet(path).count()}


def tune(spark, a) -> dict:
    sp = spark.read.parquet(f"{a.out}/block_features_v{a.version}")
    _, table, acc = M.tune_forest(sp, time_folds=a.time_folds, embargo=a.embargo, partitions=a.fit_partitions)
    Wr.write_csv(table, a.run.path("tuning_grid"), header=True)
    best = M.best_params(table).first().asDict()
    return {"valid_accuracy": acc, "best": best}


def candle_compaction(spark, a) -> dict:
    """Candle JSON payloads (one a line) and per-window CSVs -> one de-duplicated candle table, as CSV and parquet."""
    frames = []
    if a.payloads:
        frames.append(C.derive_candle_columns(C.parse_candle_payload(spark.read.text(a.payloads), "value")))
    if a.candle_csvs:
        raw = C.read_candle_csvs(spark, a.candle_csvs).select(*C.PAYLOAD_COLUMNS)
        frames.append(C.derive_candle_columns(raw))
    if not frames:
        raise ValueError("candle-compaction needs --payloads or --candle-csvs")
    merged = staged(C.union_dedupe(frames), "candles")
    Wr.write_dual(merged, a.run.path("candles_csv"), a.run.path("candles"))
    return {"rows": merged.count()}


def rolling_slope(spark, a) -> dict:
    """Slope of the activity count over the four hours ahead of each row, walked latest-first; rows of one
    time are ordered by their count."""
    act = Tx.read_activity_csv(spark, a.activity).withColumn("u", F.unix_micros(F.col("ts").cast("timestamp")))
    out = staged(Wn.rolling_slope_reversed(act, "u", "n", 4 * a.hour * 1_000_000, tiebreak=["n"])
                 .select("ts", "n", F.col("_slope").alias("slope")), "slopes")
    Wr.write_sorted_csv(out, a.run.path("rolling_slope"), ["ts", "n"], single_file=a.single_file)
    return {"rows": out.count()}


JOBS = {"tx-listing": tx_listing, "block-activity": block_activity, "receiver-raw": receiver_raw,
        "receiver-scores": receiver_scores, "block-features": block_features, "train-report": train_report, "score": score,
        "tune": tune, "candle-compaction": candle_compaction, "rolling-slope": rolling_slope}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="blockbeam.plans.ledger_jobs")
    p.add_argument("job", choices=sorted(JOBS))
    p.add_argument("--blocks", help="folder of block files")
    p.add_argument("--glob", default="*.dat")
    p.add_argument("--on-bad", dest="on_bad", default="error", choices=["error", "skip"])
    p.add_argument("--candles", help="candle parquet (unix, low, high, open, close, volume, date, vol_fiat)")
    p.add_argument("--payloads", help="candle JSON payloads, one a line (candle-compaction)")
    p.add_argument("--candle-csvs", dest="candle_csvs", help="folder of *_data.csv candle files (candle-compaction)")
    p.add_argument("--activity", help="activity CSV with a header (rolling-slope)")
    p.add_argument("--out", required=True)
    p.add_argument("--version", type=int, default=2, choices=[1, 2])
    p.add_argument("--float32", action="store_true", help="single-precision hit rates (quirk Q1)")
    p.add_argument("--single-file", dest="single_file", action="store_true", help="block-activity as one CSV (small reports)")
    p.add_argument("--time-folds", dest="time_folds", action="store_true")
    p.add_argument("--fit-partitions", dest="fit_partitions", type=int, default=M.FIT_PARTITIONS)
    for k, v in DEFAULTS.items():
        p.add_argument(f"--{k.replace('_', '-')}", dest=k, type=type(v), default=v)
    return p


def run(spark: SparkSession, argv: list[str]) -> dict:
    a = parser().parse_args(argv)
    with run_folder(spark, a.out, a.job) as a.run:
        return JOBS[a.job](spark, a)


def main(argv: list[str] | None = None) -> None:
    import sys
    spark = build_session(app="blockbeam-ledger-jobs")
    print(json.dumps(run(spark, sys.argv[1:] if argv is None else argv), default=str))


if __name__ == "__main__":
    main()

