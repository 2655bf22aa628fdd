"""Price-candle sources: parquet/CSV tables, JSON payloads, de-duplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# The candle column order of the price files and of the JSON
# payload rows (the reference addresses columns by position).
CANDLE_COLUMNS = ("unix", "low", "high", "open", "close", "volume", "date", "vol_fiat")
PAYLOAD_COLUMNS = ("unix", "low", "high", "open", "close", "volume")

CANDLE_SCHEMA = T.StructType([
    T.StructField("unix", T.LongType()), T.StructField("low", T.DoubleType()),
    T.StructField("high", T.DoubleType()), T.StructField("open", T.DoubleType()),
    T.StructField("close", T.DoubleType()), T.StructField("volume", T.DoubleType()),
    T.StructField("date", T.StringType()), T.StructField("vol_fiat", T.DoubleType()),
])


def cast_candles(df: DataFrame) -> DataFrame:
    """SRC-3: address the first eight columns by position and cast them to
    (long, 5 x double, string, double) named as the candle table."""
    cols = df.columns[:len(CANDLE_COLUMNS)]
    return df.select(*[F.col(c).cast(f.dataType).alias(f.name) for c, f in zip(cols, CANDLE_SCHEMA.fields)])


def read_candles(spark: SparkSession, path: str) -> DataFrame:
    """SRC-3: candle parquet scan with positional casts (only the columns a query
    selects are read, thanks to column pruning)."""
    return cast_candles(spark.read.parquet(path))


def read_candle_csvs(spark: SparkSession, path: str, suffix: str = "_data.csv") -> DataFrame:
    """SRC-9: every CSV under ``path`` whose name ends with ``suffix``, as one table."""
    return (spark.read.option("header", True).option("pathGlobFilter", f"*{suffix}")
            .schema(CANDLE_SCHEMA).csv(path))


def parse_candle_payload(df: DataFrame, col: str = "payload") -> DataFrame:
    """SRC-8: JSON text ``[[unix, low, high, open, close, volume], ...]`` -> rows."""
    rows = df.select(F.explode(F.from_json(F.col(col), "array<array<double>>")).alias("r"))
    return rows.select(F.col("r")[0].cast("long").alias("unix"),
                       *[F.col("r")[i].alias(n) for i, n in enumerate(PAYLOAD_COLUMNS) if i > 0])


def derive_candle_columns(df: DataFrame) -> DataFrame:
    """PRJ-12: ``date`` from ``unix`` (UTC wall clock) and ``vol_fiat = volume * close``."""
    from ..functions.scalars import seconds_to_ntz
    return df.withColumns({"date": seconds_to_ntz("unix"), "vol_fiat": F.col("volume") * F.col("close")})


def latest_by_key(df: DataFrame, key: str = "unix", order: Sequence[str] | None = None) -> DataFrame:
    """SRC-4: one row per key. Among duplicates the row with the greatest ``order``
    columns wins (deterministic stand-in for "last wins"); partial aggregation
    combines duplicates before the shuffle."""
    others = [c for c in df.columns if c != key]
    order_col = F.struct(*(order or others))
    best = df.groupBy(key).agg(F.max_by(F.struct(*others), order_col).alias("_row"))
    return best.select(key, *[F.col(f"_row.{c}").alias(c) for c in others])


def union_dedupe(frames: Sequence[DataFrame]) -> DataFrame:
    """SET-4: UNION ALL of candle tables by column name, then whole-row dedupe."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.dropDuplicates()
