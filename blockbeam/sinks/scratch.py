"""Shared scratch folders for sinks, staged tables and round trips.

They lie under the folder the cluster names in ``spark.checkpoint.dir`` (a shared
file system), never a machine-local temporary folder; a fresh sub-folder per call
keeps runs apart. Results are read lazily, so a folder must outlive the call that made it: folders go when the
driver's JVM ends, or, made within ``cleaned``, when that block ends.
"""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

from ..session import ensure_checkpoint_dir

_collectors: list[list[str]] = []


def hadoop(spark: SparkSession, path: str):
    """(Hadoop file system, Hadoop path) of a path."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def scratch_path(spark: SparkSession, name: str) -> str:
    base = ensure_checkpoint_dir(spark).rstrip("/")
    root = f"{base}/blockbeam-out/{uuid.uuid4().hex}"
    fs, p = hadoop(spark, root)
    fs.mkdirs(p)
    fs.deleteOnExit(p)
    for made in _collectors:
        made.append(root)
    return f"{root}/{name}"


@contextlib.contextmanager
def cleaned(spark: SparkSession) -> Iterator[None]:
    """Delete the scratch folders made in this block at its end, whether it fails or not. Only for work whose
    results have been written elsewhere by then."""
    made: list[str] = []
    _collectors.append(made)
    try:
        yield
    finally:
        _collectors.remove(made)
        for root in made:
            fs, p = hadoop(spark, root)
            fs.delete(p, True)
