"""Text sources: receiver-activity CSV, score-tuple text, activity CSV with a
datetime column (SRC-5, SRC-6, SRC-10). Schemas are explicit: no inference pass."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

RECEIVER_ACTIVITY_SCHEMA = "t long, receiver string, n_txns int, amount double, close double"
# The activity series' column headers in the reference's input CSV.
ACTIVITY_TIME_COLUMN = "Block time in English"
ACTIVITY_COUNT_COLUMN = "Number of Transaction"


def read_receiver_activity(spark: SparkSession, path: str) -> DataFrame:
    """SRC-5: comma-separated (t, receiver, n_txns, amount, close), no header."""
    return spark.read.schema(RECEIVER_ACTIVITY_SCHEMA).csv(path)


def parse_score_tuples(lines: DataFrame, col: str = "value") -> DataFrame:
    """SRC-6: ``(receiver,n,amount,r30,r1,r2,r3,r4)`` -> receiver (outer parentheses
    stripped, first comma field)."""
    inner = F.regexp_extract(F.col(col), r"^\((.*)\)$", 1)
    return lines.select(F.split(inner, ",").getItem(0).alias("receiver"),
                        *[c for c in lines.columns if c != col])


def read_score_tuples(spark: SparkSession, path: str) -> DataFrame:
    """SRC-6 over a directory (a ``threshold_pct=`` partition folder becomes a column)."""
    return parse_score_tuples(spark.read.text(path))


def read_activity_csv(spark: SparkSession, path: str, fmt: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    """SRC-10: header CSV with a datetime text column -> (ts timestamp_ntz, n)."""
    df = spark.read.option("header", True).schema(
        f"`{ACTIVITY_TIME_COLUMN}` string, `{ACTIVITY_COUNT_COLUMN}` long").csv(path)
    return df.select(F.to_timestamp_ntz(F.col(f"`{ACTIVITY_TIME_COLUMN}`"), F.lit(fmt)).alias("ts"),
                     F.col(f"`{ACTIVITY_COUNT_COLUMN}`").alias("n"))


SCORE_FIELDS = ("receiver", "n", "amount", "r30", "r1", "r2", "r3", "r4")


def read_score_rows(spark: SparkSession, path: str) -> DataFrame:
    """Score tuples with every field: (receiver, n, amount, r30, r1, r2, r3, r4),
    one row per receiver (a receiver listed under several thresholds appears once)."""
    inner = F.split(F.regexp_extract(F.col("value"), r"^\((.*)\)$", 1), ",")
    rows = spark.read.text(path).select(
        inner.getItem(0).alias("receiver"), inner.getItem(1).cast("long").alias("n"),
        *[inner.getItem(i).cast("double").alias(c) for i, c in enumerate(SCORE_FIELDS) if i >= 2])
    return rows.dropDuplicates(["receiver"])
