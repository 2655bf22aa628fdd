"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Sequence

from pyspark.sql import SparkSession

# Settings the library's results depend on. Time zone: every timestamp the
# library emits is timestamp_ntz or epoch seconds, but UTC keeps the LTZ
# conversions of readers (CSV, JSON) deterministic.
CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

# What a task of the ledger queries takes on at most: bytes of a table as stored, and bytes of a shuffle. An output
# takes some 20 bytes of a shuffle, and 100 to 150 in each sort, window buffer or hash aggregate of a task.
SCAN_BYTES, SHUFFLE_BYTES = 16 << 20, 8 << 20


def build_session(master: str | None = None, app: str = "blockbeam",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's settings.

    On a cluster pass ``master=None`` so spark-submit decides; locally tests pass
    ``local[N]``. The Spark UI stays off: no web server is started.
    """
    b = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        b = b.master(master)
    for k, v in CORE_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names it (a shared file system path); only when it is unset, as in
    local sessions, is a fresh scratch folder made here. Off a local master an unset
    folder is an error: a machine-local one would be invisible to the executors. A folder
    set by ``setCheckpointDir`` is kept.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(current)
        return current
    made = spark.sparkContext.getCheckpointDir()
    if made is None and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if made is not None:
        spark.conf.set("spark.checkpoint.dir", made)
        return made
    local = tempfile.mkdtemp(prefix="blockbeam-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local


def apply_core_conf(spark: SparkSession) -> None:
    """Apply the runtime-settable core settings to an existing session."""
    for k, v in CORE_CONF.items():
        spark.conf.set(k, v)


def stored_bytes(spark: SparkSession, paths: Sequence[str]) -> int:
    """Bytes of the files at or below ``paths``; paths that aren't there count nothing."""
    total = 0
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
        if fs.exists(p):
            total += int(fs.getContentSummary(p).getLength())
    return total


def apply_task_sizes(spark: SparkSession, input_bytes: int) -> None:
    """Keep the size of a task, and so its memory, the same whatever the size of the input: more input makes more tasks.

    Scans are split, and adaptive execution merges shuffle partitions, up to ``SCAN_BYTES`` and ``SHUFFLE_BYTES`` (a session's
    own smaller sizes stay). Merging needs partitions that are small to begin with, so their number follows
    the input: two for each ``SHUFFLE_BYTES`` of it, and at least the session's shuffle partitions."""
    to_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    for key, most, default in (("spark.sql.files.maxPartitionBytes", SCAN_BYTES, "128m"),
                               ("spark.sql.adaptive.advisoryPartitionSizeInBytes", SHUFFLE_BYTES, "64m")):
        spark.conf.set(key, str(min(most, int(to_bytes(spark.conf.get(key, default))))))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), -(-2 * input_bytes // SHUFFLE_BYTES))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(parts))


def ship_package(spark: SparkSession) -> None:
    """Make ``blockbeam`` importable on the Python workers (the UDF and mapInArrow
    steps reference its functions): zip the package once per SparkContext and add it
    with ``addPyFile``, as ``spark-submit --py-files`` would."""
    import zipfile

    sc = spark.sparkContext
    if getattr(sc, "_blockbeam_shipped", False):
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="blockbeam-pyfiles-"), "blockbeam.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _dirs, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(out)
    sc._blockbeam_shipped = True
