"""Sinks (SNK-1 ... SNK-7). Every writer is a DataFrame writer run by executors;
``mode("overwrite")`` replaces the reference's delete-then-write.

Before a write into folders by value the rows are rebalanced by those values, so that a folder gets files by its
bytes (a large value is split over several tasks, small ones share one) and not one from every task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def tuple_text(*cols) -> F.Column:
    """``(a,b,c)`` text of the given columns (the reference's tuple lines)."""
    return F.concat(F.lit("("), F.concat_ws(",", *[F.col(c).cast("string") for c in cols]), F.lit(")"))


def by_folder(df: DataFrame, partition_by: Sequence[str], order: Sequence = ()) -> DataFrame:
    """The rows of each folder together (in ``order`` within a file), a large folder in several tasks."""
    out = df.hint("rebalance", *partition_by)
    return out.sortWithinPartitions(*partition_by, *order) if order else out


def write_tuple_text(df: DataFrame, path: str, cols: Sequence[str], partition_by: Sequence[str] = (), order: Sequence = ()) -> None:
    """SNK-1 / SNK-4: one tuple line per row, optionally one folder per partition value, whose files are in ``order``."""
    if partition_by:
        df = by_folder(df, partition_by, order)
    out = df.select(tuple_text(*cols).alias("value"), *partition_by)
    w = out.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.text(path)


def write_csv(df: DataFrame, path: str, header: bool = False, partition_by: Sequence[str] = ()) -> None:
    """SNK-2: CSV lines, e.g. one folder per split (all / train / test in one pass)."""
    out = by_folder(df, partition_by) if partition_by else df
    w = out.write.mode("overwrite").option("header", header)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)


def write_sorted_csv(df: DataFrame, path: str, order: Sequence[str], single_file: bool = False) -> None:
    """SNK-3: sorted CSV with headers: a range-partitioned sort whose part files, in name
    order, hold the rows in order. ``single_file`` is for small reports only: one task then
    sorts and writes all rows."""
    out = df.coalesce(1).sortWithinPartitions(*order) if single_file else df.orderBy(*order)
    out.write.mode("overwrite").option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), single_file: bool = False) -> None:
    """SNK-5: parquet, optionally partitioned (e.g. by split); ``single_file`` mirrors
    the reference's coalesce(1) and is off by default at scale."""
    out = df.coalesce(1) if single_file else by_folder(df, partition_by) if partition_by else df
    w = out.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_dual(df: DataFrame, csv_path: str, parquet_path: str) -> None:
    """SNK-7: the same table as CSV (with header) and parquet."""
    df.write.mode("overwrite").option("header", True).csv(csv_path)
    df.write.mode("overwrite").parquet(parquet_path)
