"""Helpers the operators of this subpackage share: session settings, staging, words, hashes."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir, ship_package
from ..sinks.scratch import scratch_path

#: Arrow batches handed to Python hold at most this many rows and about this many bytes.
BATCH_ROWS, BATCH_BYTES = 2000, 8 << 20
#: The characters that separate words and are stripped from lines.
BLANKS = " \t\n\x0b\x0c\r"
#: The same characters inside a Java regular-expression class.
BLANK_CLASS = r"\x20\x09-\x0D"

_U = np.uint64


def prepare(spark: SparkSession) -> None:
    """Settings that every operator needs: shared checkpoint folder, code on the workers, small batches."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into a fresh folder of the shared checkpoint folder and read it back:
    lineage ends there, later readers prune its columns, and a lost executor loses nothing."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    a = batch.column(batch.schema.get_field_index(name))
    return a.combine_chunks() if isinstance(a, pa.ChunkedArray) else a


def slices(batches: Iterable[pa.RecordBatch], text: str, most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about ``most`` bytes of the column ``text`` (one row at least)."""
    for b in batches:
        if not b.num_rows:
            continue
        size = np.cumsum(pc.fill_null(pc.binary_length(column(b, text)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < b.num_rows:
            done = size[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(size, done + most, side="right")))
            yield b.slice(at, to - at)
            at = to


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (multiply and xor-shift)."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(32)
    x *= _U(0xD6E8FEB86659FD93)
    x ^= x >> _U(32)
    x *= _U(0xD6E8FEB86659FD93)
    x ^= x >> _U(32)
    return x


class Words:
    """The words of a batch of texts: ``doc`` and ``code`` per word (in text order), ``distinct`` words
    by code, ``count`` per text. Null texts have no words."""

    def __init__(self, texts: pa.Array):
        parts = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        flat = parts.flatten().dictionary_encode()
        lengths = pc.list_value_length(parts).to_numpy(zero_copy_only=False)
        doc = np.repeat(np.arange(len(texts), dtype=np.int32), lengths)
        code = flat.indices.to_numpy(zero_copy_only=False)
        empty = pc.index(flat.dictionary, pa.scalar("", flat.dictionary.type)).as_py()
        if empty >= 0:
            real = code != empty
            doc, code = doc[real], code[real]
        self.doc, self.code, self.distinct = doc, code, flat.dictionary
        self.count = np.bincount(doc, minlength=len(texts)).astype(np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.count)])

    def hashes(self, distinct: pa.Array | None = None) -> np.ndarray:
        """A 64-bit hash of each word."""
        words = (self.distinct if distinct is None else distinct).cast(pa.large_binary()).to_pylist()
        table = np.fromiter(map(xxhash.xxh3_64_intdigest, words), _U, len(words))
        return table[self.code] if len(words) else np.zeros(0, _U)


def windows(h: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of ``n`` consecutive words within one text, and where each window begins."""
    if len(h) < n:
        return np.zeros(0, _U), np.zeros(0, np.int64)
    m = len(h) - n + 1
    out = np.zeros(m, _U)
    for j in range(n):
        out = mix(out + h[j : j + m] + _U((j + 1) * 0x9E3779B97F4A7C15 % 2**64))
    at = np.flatnonzero(doc[:m] == doc[n - 1 :])
    return out[at], at


def counted(rows: DataFrame, count, n: int, parts: int = 32) -> np.ndarray:
    """The sum of arrays of ``n`` integers over all rows: ``count`` makes an array of a batch. Tasks send their
    sums in ``parts`` slices, which are added in groups of tasks and then over the groups; only the
    total, of fixed size, reaches the driver."""
    import pandas as pd

    width = -(-n // parts)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width * parts, np.int64)
        for b in batches:
            total[:n] += count(b)
        if total.any():
            yield pa.RecordBatch.from_pydict({"slice": pa.array(range(parts), pa.int32()), "counts": [x.tobytes() for x in np.split(total, parts)]})

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"slice": pdf["slice"][:1], "counts": [sum(np.frombuffer(x, np.int64) for x in pdf["counts"]).tobytes()]})

    from pyspark.sql import functions as F

    kind = "slice int, counts binary"
    some = rows.mapInArrow(sums, kind).withColumn("part", F.spark_partition_id() % 64).groupBy("slice", "part").applyInPandas(add, kind)
    total = np.zeros((parts, width), np.int64)
    for r in some.groupBy("slice").applyInPandas(add, kind).collect():
        total[r["slice"]] = np.frombuffer(r["counts"], np.int64)
    return total.reshape(-1)[:n]


def whole_groups(batches: Iterable[pa.RecordBatch], keys: list[str], most: int = 4 << 20) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """From batches sorted by ``keys``, tables of whole groups (about ``most`` bytes or one group), each with
    the rows at which its groups begin."""

    def starts(t: pa.Table) -> np.ndarray:
        new = np.zeros(t.num_rows, bool)
        new[:1] = True
        for k in keys:
            v = t.column(k).to_numpy()
            new[1:] |= v[1:] != v[:-1]
        return np.flatnonzero(new)

    held: list[pa.RecordBatch] = []
    size = 0
    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        size += b.nbytes
        if size >= most:
            t = pa.Table.from_batches(held).combine_chunks()
            at = starts(t)
            if len(at) > 1:
                yield t.slice(0, int(at[-1])), at[:-1]
            # what stays is copied, so that the rest can go
            rest = t.slice(int(at[-1])).take(pa.array(np.arange(t.num_rows - at[-1]))) if len(at) > 1 else t
            held, size = rest.combine_chunks().to_batches(), 0 if len(at) == 1 else rest.nbytes
    if held:
        t = pa.Table.from_batches(held).combine_chunks()
        yield t, starts(t)
