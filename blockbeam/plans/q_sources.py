"""Registered queries: sources and sinks, each as a round trip through files Spark
writes from the stand-in tables into the shared output folder (SRC-1, SRC-2,
SRC-5..10, SNK-1..7, JOB-6)."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import functions as F

from ..functions.scalars import epoch_seconds
from ..sinks import writers as Wr
from ..sinks.scratch import scratch_path
from ..sinks.staging import staged
from ..sources import blocks as B, candles as C, text as Tx
from ..sources.files import opened, qualified
from . import standins as S
from .blockfiles import write_block_files
from .catalog import query
from .nested import nested_blocks
from .q_chain import block_activity_job
from .q_receivers import features, raw, scores
from .sqlviews import (BLOCKS, CANDLES, FEATURES, FIRSTS, HITS, NESTED_OUTS, OUTS, POP, RAW, epoch, split_sql,
                       with_)
from .q_chain import _JOB1_SQL

_FEAT = with_(OUTS, CANDLES, RAW, POP, HITS, FIRSTS, BLOCKS, FEATURES)


#: Blocks of a written block file, candles of a written CSV: files of bounded size, more of them for more data.
_FILE_BLOCKS, _FILE_CANDLES = 2048, 100_000


def _n_files(spark, rows: int, per_file: int) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions", "8")), -(-rows // per_file))


def block_dir(spark, blocks):
    """Nested blocks (time, nonce, txs) written as framed block files."""
    nb = staged(blocks, "nested")
    nb = nb.select("time", "nonce", F.transform("txs", lambda t: F.struct(t["txid"].alias("txid"), F.transform(
                       t["outs"], lambda o: F.struct(o["amount_sat"].alias("amount_sat"),
                                                     F.lower(F.hex(o["script"])).alias("script"))).alias("outs")))
                   .alias("txs"))
    path = scratch_path(spark, "blocks")
    write_block_files(nb, path, _n_files(spark, nb.count(), _FILE_BLOCKS)).agg(F.count(F.lit(1))).collect()
    return path


def _varint_len(c: str) -> str:
    return f"(CASE WHEN {c} < 253 THEN 1 WHEN {c} <= 65535 THEN 3 WHEN {c} <= 4294967295 THEN 5 ELSE 9 END)"


# Expected payload sizes from the wire format: header 80, tx count, and per
# transaction version 4 + one placeholder input (1 + 32 + 4 + 1 + 4) + output count
# + outputs (8 + script length + script) + lock time 4; scripts are the receiver's bytes.
_FRAMES_SQL = with_(NESTED_OUTS) + f"""
, tx AS (SELECT block_id, txid, count(*) AS n_out,
                sum(8 + {_varint_len('length(receiver)')} + length(receiver)) AS out_bytes
         FROM outs GROUP BY block_id, txid),
blk AS (SELECT block_id, count(*) AS n_tx,
               sum(4 + 42 + {_varint_len('n_out')} + out_bytes + 4) AS tx_bytes FROM tx GROUP BY block_id),
sz AS (SELECT 80 + {_varint_len('n_tx')} + tx_bytes AS size FROM blk)
SELECT count(*) AS n_frames, CAST(sum(size) AS BIGINT) AS payload_bytes,
       CAST(min(size) AS BIGINT) AS min_size, CAST(max(size) AS BIGINT) AS max_size FROM sz"""


@query("src_block_frames", _FRAMES_SQL)
def q_src_block_frames(spark, sf):
    """SRC-1: the frames of the written block files (one per block), summarised."""
    f = B.read_block_frames(spark, block_dir(spark, nested_blocks(spark, sf)), glob="*.dat")
    return f.agg(F.count(F.lit(1)).alias("n_frames"), F.sum("size").alias("payload_bytes"),
                 F.min("size").alias("min_size"), F.max("size").alias("max_size"))


@query("src_block_rows", with_(NESTED_OUTS) + """
SELECT block_id, time, CAST(count(DISTINCT txid) AS INTEGER) AS n_txns, CAST(count(*) AS BIGINT) AS n_outputs,
       CAST(sum(round(amount * 100)) AS BIGINT) AS total_sat FROM outs GROUP BY block_id, time""")
def q_src_block_rows(spark, sf):
    """SRC-1 + SRC-2: decoded nested rows, summarised per block."""
    b = B.read_block_files(spark, block_dir(spark, nested_blocks(spark, sf)), glob="*.dat")
    amounts = F.flatten(F.transform("txs", lambda t: F.transform(t["outs"], lambda o: o["amount_sat"])))
    return b.select(F.col("nonce").cast("string").alias("block_id"), "time", F.size("txs").alias("n_txns"), F.size(amounts).cast("long").alias("n_outputs"),
                    F.aggregate(amounts, F.lit(0).cast("long"), lambda a, x: a + x).alias("total_sat"))


_RAWSEL = "t, receiver, CAST(n_txns AS INTEGER) AS n_txns, CAST(amount AS DOUBLE) AS amount, close"


@query("src_receiver_csv", with_(OUTS, CANDLES, RAW) + f"SELECT {_RAWSEL} FROM rawp")
def q_src_receiver_csv(spark, sf):
    """SRC-5: receiver activity (train and test) written as CSV text and read back by schema."""
    path = scratch_path(spark, "receiver")
    r = raw(spark, sf)
    Wr.write_csv(r.select("t", "receiver", "n_txns", F.col("amount").cast("double"), "close"), path)
    return Tx.read_receiver_activity(spark, path)


@query("snk_receiver_csv_roundtrip", with_(OUTS, CANDLES, RAW) + f"SELECT {_RAWSEL}, split FROM rawp")
def q_snk_receiver_csv_roundtrip(spark, sf):
    """SNK-2: all receiver rows in one pass, one folder per split, read back."""
    path = scratch_path(spark, "receiver_account_raw_data")
    r = raw(spark, sf).select("t", "receiver", "n_txns", F.col("amount").cast("double"), "close", "split")
    Wr.write_csv(r, path, partition_by=["split"])
    back = spark.read.schema(Tx.RECEIVER_ACTIVITY_SCHEMA + ", split string").csv(path)
    return back


def _scores_dir(spark, sf):
    from ..functions.scalars import threshold_percent
    from ..operators.receivers import scores_by_threshold
    s = scores_by_threshold(scores(spark, sf)).withColumn("threshold_pct", threshold_percent("threshold"))
    path = scratch_path(spark, "scored_receivers")
    Wr.write_tuple_text(s, path, ["receiver", "n", "amount", "r30", "r1", "r2", "r3", "r4"],
                        partition_by=["threshold_pct"], order=[F.desc("r4")])
    return path


_SCORED_SQL = with_(OUTS, CANDLES, RAW, POP, HITS) + """
, scored AS (SELECT CAST(round(th.threshold * 100) AS INTEGER) AS threshold_pct, h.receiver
             FROM hits h JOIN (VALUES (0.9), (0.8), (0.75), (0.7), (0.65)) th(threshold) ON h.r4 >= th.threshold)
"""


@query("src_score_tuples", _SCORED_SQL + "SELECT DISTINCT threshold_pct, receiver FROM scored")
def q_src_score_tuples(spark, sf):
    """SRC-6: scored receivers per threshold from the tuple text, as distinct sets."""
    return Tx.read_score_tuples(spark, _scores_dir(spark, sf)).select("threshold_pct", "receiver").distinct()


@query("snk_scores_partitioned", _SCORED_SQL + "SELECT threshold_pct, receiver FROM scored")
def q_snk_scores_partitioned(spark, sf):
    """SNK-4: one folder per threshold, all five read back."""
    return Tx.read_score_tuples(spark, _scores_dir(spark, sf)).select("threshold_pct", "receiver")


@query("snk_text_roundtrip", with_(OUTS) + "SELECT DISTINCT time, txid FROM outs")
def q_snk_text_roundtrip(spark, sf):
    """SNK-1: (time, txid) tuples as text, read back and parsed."""
    path = scratch_path(spark, "transactions")
    Wr.write_tuple_text(S.outputs(spark, sf).select("time", "txid").distinct(), path, ["time", "txid"])
    parts = F.split(F.regexp_extract("value", r"^\((.*)\)$", 1), ",")
    return spark.read.text(path).select(parts.getItem(0).cast("long").alias("time"),
                                        parts.getItem(1).cast("long").alias("txid"))


_ACT_COLS = ("block_timestamp long, num_txns_in_block long, total_btc_in_block double, total_fee_reward double, "
             "btc_usd_price_at_timestamp double, btc_usd_price_4_hrs_later double, btc_usd_price_6_hrs_later double, "
             "btc_usd_price_12_hrs_later double, btc_usd_price_24_hrs_later double")


@query("snk_activity_csv_roundtrip", _JOB1_SQL)
def q_snk_activity_csv_roundtrip(spark, sf):
    """SNK-3: the block-activity table as sorted CSV with headers, read back."""
    path = scratch_path(spark, "block_activity_csv")
    Wr.write_sorted_csv(block_activity_job(spark, sf), path, ["block_timestamp"])
    return spark.read.option("header", True).schema(_ACT_COLS).csv(path)


_SPLIT_COLS = "blockId, blockFloorTime, numTxnsInBlock, label, changeInBtcPriceBtwCurrAnd1HrAgo"


def _splits_dir(spark, sf):
    path = scratch_path(spark, "block_splits")
    Wr.write_parquet(features(spark, sf, 2), path, partition_by=["split"])
    return path


@query("snk_splits_parquet_roundtrip", _FEAT + ", " + split_sql(S.TRAIN_BLOCKS_V2, S.VALID_BLOCKS) +
       f"SELECT {_SPLIT_COLS}, split FROM splitted")
def q_snk_splits_parquet_roundtrip(spark, sf):
    """SNK-5: feature rows written as parquet partitioned by split, read back."""
    return spark.read.parquet(_splits_dir(spark, sf)).select(*_SPLIT_COLS.split(", "), "split")


@query("src_splits", _FEAT + ", " + split_sql(S.TRAIN_BLOCKS_V2, S.VALID_BLOCKS) + """
SELECT blockId, split AS source FROM splitted
UNION ALL SELECT blockId, 'valid_test' FROM splitted WHERE split <> 'train'""")
def q_src_splits(spark, sf):
    """SRC-7: the train, valid, test and valid+test tables scanned separately."""
    path = _splits_dir(spark, sf)
    base = spark.read.parquet(path)
    parts = [base.filter(F.col("split") == s).select("blockId", F.lit(s).alias("source"))
             for s in ("train", "valid", "test")]
    parts.append(base.filter(F.col("split") != "train").select("blockId", F.lit("valid_test").alias("source")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


_WINDOW = 300 * S.GRAIN  # 300 candles per request


def _payloads(spark, sf, shared_endpoints: bool):
    """Candle JSON payloads, one per request window of 300 candles."""
    c = S.daily_candles(spark, sf)
    start = c.select(F.min("unix")).scalar()
    rel = F.col("unix") - start
    w = F.floor(rel / F.lit(_WINDOW))
    wins = F.when((rel % _WINDOW == 0) & (w > 0), F.array(w, w - 1)).otherwise(F.array(w)) \
        if shared_endpoints else F.array(w)
    row = F.array(F.col("unix").cast("double"), "low", "high", "open", "close", "volume")
    return (c.select(F.explode(wins).alias("w"), row.alias("r")).groupBy("w")
            .agg(F.to_json(F.collect_list("r")).alias("payload")))


@query("src_candle_json", with_(CANDLES) + "SELECT unix, low, high, open, close, volume FROM candles")
def q_src_candle_json(spark, sf):
    """SRC-8: JSON candle payloads (written as text, one per line) -> named columns."""
    path = scratch_path(spark, "payloads")
    _payloads(spark, sf, False).select("payload").write.mode("overwrite").text(path)
    return C.parse_candle_payload(spark.read.text(path), "value")


@query("job_candle_compaction", with_(CANDLES) + """
SELECT unix, low, high, open, close, volume, date, vol_fiat FROM candles""")
def q_job_candle_compaction(spark, sf):
    """JOB-6: payloads whose windows share endpoints -> rows -> UNION ALL + dedupe ->
    date and vol_fiat -> written as CSV and parquet -> parquet read back."""
    path = scratch_path(spark, "payloads_shared")
    _payloads(spark, sf, True).select("payload").write.mode("overwrite").text(path)
    rows = C.parse_candle_payload(spark.read.text(path), "value")
    # a second table that overlaps the payloads: the candles of the later half
    known = S.daily_candles(spark, sf).select(*C.PAYLOAD_COLUMNS)
    later = known.filter(F.col("unix") >= known.select(F.avg("unix")).scalar())
    merged = C.derive_candle_columns(C.union_dedupe([rows, later]))
    csv_path, pq_path = scratch_path(spark, "candles_csv"), scratch_path(spark, "candles_pq")
    Wr.write_dual(merged, csv_path, pq_path)
    return spark.read.parquet(pq_path)


_CANDLE_CSV_SCHEMA = "unix long, low double, high double, open double, close double, volume double, vol_fiat double"


def _write_named_csvs(df, path, suffix):
    """Executors write one pandas CSV per partition named ``iter<k><suffix>``, batch by batch."""
    base = qualified(df.sparkSession, path).rstrip("/")
    cols = list(df.columns)

    def write(batches):
        from pyspark import TaskContext
        ctx = TaskContext.get()
        pid = ctx.partitionId()
        fs, root = opened(base)
        fs.create_dir(root, recursive=True)
        final, tmp = f"{root}/candles_iter{pid}{suffix}", f"{root}/.candles_iter{pid}{suffix}.{ctx.attemptNumber()}"
        n = 0
        with fs.open_output_stream(tmp) as out:
            out.write((",".join(cols) + "\n").encode())
            for b in batches:
                out.write(b.to_pandas().to_csv(index=False, header=False).encode())
                n += b.num_rows
        fs.move(tmp, final)  # a failed attempt leaves no part-written file of that name
        yield pa.RecordBatch.from_pylist([{"n": n}])

    return df.mapInArrow(write, "n long")


@query("src_candle_csv_glob", with_(CANDLES) + """
SELECT unix, low, high, open, close, volume, strftime(date, '%Y-%m-%d %H:%M:%S') AS date, vol_fiat FROM candles""")
def q_src_candle_csv_glob(spark, sf):
    """SRC-9: many CSVs in one folder; only names ending with ``_data.csv`` are read
    (Spark's own part files written there first are filtered out)."""
    c = S.daily_candles(spark, sf).select(*C.CANDLE_COLUMNS).withColumn("date", F.date_format("date", "yyyy-MM-dd HH:mm:ss"))
    path = scratch_path(spark, "candle_csvs")
    c.write.mode("overwrite").option("header", True).csv(path)  # Spark part files: not *_data.csv
    _write_named_csvs(c.repartition(_n_files(spark, c.count(), _FILE_CANDLES), "unix"), path, "_data.csv").agg(F.sum("n")).collect()
    return C.read_candle_csvs(spark, path)


@query("src_activity_csv", f"""
SELECT make_timestamp(({epoch('ts')} - {epoch('ts')} % 3600) * 1000000) AS ts, count(*) AS n
FROM events GROUP BY 1""")
def q_src_activity_csv(spark, sf):
    """SRC-10: hourly activity CSV with an English datetime column, parsed back."""
    e = S.table(spark, sf, "events").select((epoch_seconds("ts") - epoch_seconds("ts") % 3600).alias("h"))
    act = e.groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    from ..functions.scalars import seconds_to_ntz
    out = act.select(F.date_format(seconds_to_ntz("h"), "yyyy-MM-dd HH:mm:ss").alias(Tx.ACTIVITY_TIME_COLUMN),
                     F.col("n").alias(Tx.ACTIVITY_COUNT_COLUMN))
    path = scratch_path(spark, "activity_csv")
    Wr.write_csv(out, path, header=True)
    return Tx.read_activity_csv(spark, path)


@query("snk_overwrite_idempotent", with_(CANDLES) + "SELECT unix, close FROM candles")
def q_snk_overwrite_idempotent(spark, sf):
    """SNK-6: writing twice with overwrite leaves exactly one copy."""
    path = scratch_path(spark, "overwrite")
    c = S.daily_candles(spark, sf).select("unix", "close")
    Wr.write_parquet(c, path)
    Wr.write_parquet(c, path)
    return spark.read.parquet(path)


@query("snk_candles_dual_roundtrip", with_(CANDLES) + """
SELECT unix, low, high, open, close, volume, vol_fiat, 'csv' AS fmt FROM candles
UNION ALL SELECT unix, low, high, open, close, volume, vol_fiat, 'parquet' FROM candles""")
def q_snk_candles_dual_roundtrip(spark, sf):
    """SNK-7: the candle table written as CSV and parquet; both read back."""
    c = S.daily_candles(spark, sf).select("unix", "low", "high", "open", "close", "volume", "vol_fiat")
    csv_path, pq_path = scratch_path(spark, "candles_csv"), scratch_path(spark, "candles_pq")
    Wr.write_dual(c, csv_path, pq_path)
    a = spark.read.option("header", True).schema(_CANDLE_CSV_SCHEMA).csv(csv_path).withColumn("fmt", F.lit("csv"))
    b = spark.read.parquet(pq_path).withColumn("fmt", F.lit("parquet"))
    return a.unionByName(b)
