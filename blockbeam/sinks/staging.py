"""Stage boundaries: a table written once to the run's shared folder and read back.

Readers of a staged table prune its columns and push filters into its scan, and a
lost executor recomputes nothing upstream. Nothing is cached across calls: the job
that stages a table passes the handle on, so changed inputs are always read anew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from .scratch import scratch_path


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet to a fresh shared folder and return the table read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
