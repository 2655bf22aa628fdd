"""Round trips: every sink read back equals its input."""

import glob
import os

from pyspark.sql import functions as F

from blockbeam.sinks import writers as Wr
from blockbeam.sources import candles as C, text as Tx


def _rows(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_tuple_text_partitioned_and_scores(spark, tmp_out):
    df = spark.createDataFrame([("a", 3, 1.5, 0.1, 0.2, 0.3, 0.4, 0.9, 90), ("b", 2, 2.0, 0.0, 0.5, 0.5, 0.5, 0.7, 70),
                                ("a", 3, 1.5, 0.1, 0.2, 0.3, 0.4, 0.9, 70)],
                               "receiver string, n long, amount double, r30 double, r1 double, r2 double, r3 double, "
                               "r4 double, threshold_pct int")
    path = tmp_out("scores")
    Wr.write_tuple_text(df, path, list(Tx.SCORE_FIELDS), partition_by=["threshold_pct"])
    back = Tx.read_score_tuples(spark, path)
    assert _rows(back, ["threshold_pct", "receiver"]) == [(70, "a"), (70, "b"), (90, "a")]
    rows = Tx.read_score_rows(spark, path)
    assert _rows(rows, ["receiver", "n", "r4"]) == [("a", 3, 0.9), ("b", 2, 0.7)]


def test_receiver_csv_round_trip(spark, tmp_out):
    df = spark.createDataFrame([(60, "x", 2, 1.25, 100.0, "train"), (120, "y", 1, 3.0, 101.5, "test")],
                               "t long, receiver string, n_txns int, amount double, close double, split string")
    path = tmp_out("recv")
    Wr.write_csv(df, path, partition_by=["split"])
    train = Tx.read_receiver_activity(spark, f"{path}/split=train")
    assert _rows(train, train.columns) == [(60, "x", 2, 1.25, 100.0)]


def test_single_sorted_csv_and_overwrite(spark, tmp_out):
    df = spark.createDataFrame([(t, t * 2.0) for t in (300, 100, 200)], "t long, v double")
    path = tmp_out("sorted")
    Wr.write_sorted_csv(df.repartition(3), path, ["t"], single_file=True)
    files = glob.glob(os.path.join(path.removeprefix("file:"), "*.csv"))
    assert len(files) == 1
    lines = open(files[0]).read().split()
    assert lines[0] == "t,v" and [x.split(",")[0] for x in lines[1:]] == ["100", "200", "300"]
    Wr.write_sorted_csv(df, path, ["t"])  # overwrite, not append
    assert spark.read.option("header", True).csv(path).count() == 3
    parts = sorted(glob.glob(os.path.join(path.removeprefix("file:"), "*.csv")))
    assert [x.split(",")[0] for p in parts for x in open(p).read().split()[1:]] == ["100", "200", "300"]


def test_parquet_partitioned_and_dual(spark, tmp_out):
    df = spark.createDataFrame([(1, "train"), (2, "valid"), (3, "test")], "id long, split string")
    path = tmp_out("splits")
    Wr.write_parquet(df, path, partition_by=["split"])
    assert spark.read.parquet(path).filter("split = 'valid'").select("id").collect()[0][0] == 2
    c = spark.createDataFrame([(0, 1.0, 2.0, 1.5, 1.75, 10.0, "1970-01-01 00:00:00", 17.5)],
                              "unix long, low double, high double, open double, close double, volume double, "
                              "date string, vol_fiat double")
    cp, pp = tmp_out("c_csv"), tmp_out("c_pq")
    Wr.write_dual(c, cp, pp)
    from_csv = spark.read.option("header", True).schema(C.CANDLE_SCHEMA).csv(cp)
    from_pq = C.read_candles(spark, pp)
    assert _rows(from_csv, from_csv.columns) == _rows(from_pq, from_pq.columns) == _rows(c, c.columns)


def test_activity_csv_source(spark, tmp_out):
    df = spark.createDataFrame([("2022-03-01 10:00:00", 5), ("2022-03-01 10:10:00", 7)],
                               f"`{Tx.ACTIVITY_TIME_COLUMN}` string, `{Tx.ACTIVITY_COUNT_COLUMN}` long")
    path = tmp_out("act")
    Wr.write_csv(df, path, header=True)
    back = Tx.read_activity_csv(spark, path).orderBy("ts").collect()
    assert [str(r.ts) for r in back] == ["2022-03-01 10:00:00", "2022-03-01 10:10:00"] and back[1].n == 7


def test_candle_csv_glob(spark, tmp_out):
    path = tmp_out("globs").removeprefix("file:")
    os.makedirs(path)
    header = "unix,low,high,open,close,volume,date,vol_fiat\n"
    for name, t in (("a_data.csv", 0), ("b_data.csv", 60), ("notes.csv", 120)):
        with open(os.path.join(path, name), "w") as f:
            f.write(header + f"{t},1,2,1,2,3,x,6\n")
    got = C.read_candle_csvs(spark, path)
    assert sorted(r.unix for r in got.collect()) == [0, 60]
    assert got.select(F.sum("vol_fiat")).first()[0] == 12.0
