"""Files that tasks open themselves, on the file system Spark would use for the same path.

A path without a scheme belongs to Spark's default file system, which on a cluster is not the
executors' local disk. ``qualified`` asks Hadoop for the full address once, on the driver; tasks open
that address with pyarrow (local, HDFS, S3, GCS and ABFS).
"""

from __future__ import annotations

import re

from pyspark.sql import SparkSession


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme and authority that Spark's readers and writers give it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    full = p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toString()
    return re.sub(r"^file:/+", "file:///", full)


def opened(uri: str):
    """(pyarrow file system, path on it) of a qualified address."""
    import pyarrow.fs as pafs
    return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


def matching(uri: str, glob: str | None = None) -> list[tuple[str, int]]:
    """(address, bytes) of the files at or below ``uri`` whose name matches ``glob``, in name order. Like
    Spark's readers it leaves out names that begin with ``_`` or ``.``."""
    import fnmatch

    import pyarrow.fs as pafs
    fs, root = opened(uri)
    info = fs.get_file_info(root)
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(uri)
    base, found = root.rstrip("/"), [info]
    if info.type == pafs.FileType.Directory:
        found = fs.get_file_info(pafs.FileSelector(root, recursive=True))
    out = []
    for f in found:
        below = f.path[len(base):].strip("/")
        if f.type != pafs.FileType.File or any(x[:1] in ("_", ".") for x in below.split("/")):
            continue
        if glob is None or fnmatch.fnmatchcase(f.base_name, glob):
            out.append((uri.rstrip("/") + f.path[len(base):], f.size))
    return sorted(out)
