"""Block-file source (SRC-1, SRC-2): a Spark data source with splittable files.

A block file is a sequence of frames ``u32 magic | u32 size | payload[size]``
(little-endian); a payload is one serialized block: an 80-byte header, a varint
transaction count and the transactions. ``spark.read.format("block_files")`` reads

* ``what="frames"``: one row per frame, from the frame heads alone;
* ``what="blocks"``: one nested row per block, decoded.

Files are cut into ranges of ``range_bytes``, packed into partitions of about that size, so a
large file is read by many tasks and many small files by few. A range yields the frames that *begin* in it.
The first range of a file begins at its first byte; every other one looks for the first position with the magic, a
size that fits into the file, and a payload that is exactly one block. From there on each frame leads to
the next, so the rows don't depend on where files are cut. A range also checks that the frame its chain
leads to is the one that the next range finds. Only a payload that holds a whole framed block of its own
could mislead a range that begins in front of it; the check then fails the job, and ranges as long as the file
(which look for nothing) read it.

Zeros up to the end of a file end it (the client allocates files ahead). Anything else that is no frame
fails the job (``on_bad="error"``) or is skipped up to the next frame (``"skip"``, where every payload must be a
block); the frames' rows report each skipped span with ``magic_ok`` false.

A task holds one frame and the decoded blocks of about ``BATCH_BYTES`` of the file.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.scalars import BLOCK_MAGIC
from .files import matching, opened, qualified

#: ``split`` is the start of the range that found the row, ``place`` its number there.
FRAME_SCHEMA = "file string, split long, place long, offset long, size long, magic_ok boolean"
BLOCK_SCHEMA = ("file string, split long, place long, offset long, block_id string, time long, nonce long, "
                "txs array<struct<txid: string, outs: array<struct<amount_sat: bigint, script: string>>>>")
#: Bytes of a block's header.
HEADER = 80
#: Payload bytes whose decoded rows make one Arrow batch (one block at least).
BATCH_BYTES = 4 << 20
#: Bytes read at once when looking for a frame, and when frames are read one after another.
CHUNK = 1 << 20
_OUT_T = pa.struct([("amount_sat", pa.int64()), ("script", pa.string())])
_TX_T = pa.struct([("txid", pa.string()), ("outs", pa.list_(_OUT_T))])
_AT = [("file", pa.string()), ("split", pa.int64()), ("place", pa.int64()), ("offset", pa.int64())]
FRAME_ARROW = pa.schema([*_AT, ("size", pa.int64()), ("magic_ok", pa.bool_())])
BLOCK_ARROW = pa.schema([*_AT, ("block_id", pa.string()), ("time", pa.int64()), ("nonce", pa.int64()),
                         ("txs", pa.list_(_TX_T))])


class BadFrame(ValueError):
    pass


# ------------------------------------------------------------------ wire format

def _varint(buf: bytes, i: int) -> tuple[int, int]:
    b = buf[i]
    if b < 0xFD:
        return b, i + 1
    width = {0xFD: 2, 0xFE: 4, 0xFF: 8}[b]
    return int.from_bytes(buf[i + 1:i + 1 + width], "little"), i + 1 + width


def _dsha(b: bytes) -> bytes:
    return hashlib.sha256(hashlib.sha256(b).digest()).digest()


class Blocks:
    """Decoded blocks as flat columns, which become one Arrow batch without a Python object per row."""

    def __init__(self) -> None:
        self.at: list[tuple] = []
        self.heads: list[tuple[str, int, int]] = []
        self.txs, self.outs = [0], [0]  # how many transactions, and outputs, there are up to each block, and transaction
        self.txid: list[str] = []
        self.amount: list[int] = []
        self.script: list[str] = []

    def add(self, payload: bytes, at: tuple = ()) -> int:
        """Decode one block; returns where in ``payload`` it ends."""
        header, txid, amount, script, outs = payload[:80], self.txid, self.amount, self.script, self.outs
        n_tx, i = _varint(payload, 80)
        for _ in range(n_tx):
            start = i
            i += 4
            segwit = payload[i] == 0 and payload[i + 1] != 0
            if segwit:
                i += 2
            n_in, i = _varint(payload, i)
            for _ in range(n_in):
                sl, i = _varint(payload, i + 36)
                i += sl + 4
            n_out, i = _varint(payload, i)
            for _ in range(n_out):
                sl, j = _varint(payload, i + 8)
                amount.append(int.from_bytes(payload[i:i + 8], "little", signed=True))
                i = j + sl
                script.append(payload[j:i].hex())
            outs.append(len(amount))
            io_end = i
            if segwit:
                for _ in range(n_in):
                    n_items, i = _varint(payload, i)
                    for _ in range(n_items):
                        ln, i = _varint(payload, i)
                        i += ln
            i += 4
            raw = (payload[start:start + 4] + payload[start + 6:io_end] + payload[i - 4:i]) if segwit else payload[start:i]
            txid.append(_dsha(raw)[::-1].hex())
        if len(payload) < i:
            raise IndexError("the block is longer than its payload")
        self.txs.append(len(txid))
        self.heads.append((_dsha(header)[::-1].hex(), int.from_bytes(header[68:72], "little"),
                           int.from_bytes(header[76:80], "little")))
        self.at.append(at)
        return i

    def nested(self) -> pa.Array:
        """The column ``txs``."""
        outs = pa.StructArray.from_arrays([pa.array(self.amount, pa.int64()), pa.array(self.script, pa.string())],
                                          fields=list(_OUT_T))
        txs = pa.StructArray.from_arrays([pa.array(self.txid, pa.string()),
                                          pa.ListArray.from_arrays(pa.array(self.outs, pa.int32()), outs)],
                                         fields=list(_TX_T))
        return pa.ListArray.from_arrays(pa.array(self.txs, pa.int32()), txs)

    def batch(self) -> pa.RecordBatch:
        flat = [pa.array(c, t) for c, t in zip(zip(*(a + h for a, h in zip(self.at, self.heads))), BLOCK_ARROW.types)]
        return pa.RecordBatch.from_arrays([*flat, self.nested()], schema=BLOCK_ARROW)


def decode_block(payload: bytes) -> dict:
    """Serialized block -> dict(block_id, time, nonce, txs=[{txid, outs=[{amount_sat, script}]}])."""
    b = Blocks()
    b.add(payload)
    block_id, time, nonce = b.heads[0]
    return {"block_id": block_id, "time": time, "nonce": nonce, "txs": b.nested()[0].as_py()}


def is_block(payload: bytes) -> bool:
    """Whether the payload is exactly one serialized block."""
    try:
        return len(payload) > HEADER and Blocks().add(payload) == len(payload)
    except (IndexError, KeyError):
        return False


# ------------------------------------------------------------------ frames of a range

class FileBytes:
    """A file's bytes by position, read in chunks; the last chunk is kept."""

    def __init__(self, handle, length: int) -> None:
        self.handle, self.length, self.start, self.held = handle, length, 0, b""

    def get(self, at: int, n: int, ahead: int = 0) -> bytes:
        """``n`` bytes from ``at`` (fewer at the end), reading at least ``ahead`` of them from the file."""
        if not (self.start <= at and at + n <= self.start + len(self.held)):
            self.start, self.held = at, self.handle.read_at(max(0, min(max(n, ahead), self.length - at)), at)
        return self.held[at - self.start:at - self.start + n]

    def peek(self, at: int, n: int) -> bytes:
        """``n`` bytes from ``at``, without giving up the chunk that is held."""
        if self.start <= at and at + n <= self.start + len(self.held):
            return self.held[at - self.start:at - self.start + n]
        return self.handle.read_at(max(0, min(n, self.length - at)), at)


class Frame(NamedTuple):
    offset: int
    size: int
    ok: bool
    payload: bytes | None


class FrameScan:
    """Walks the frames of one file that begin in a range."""

    def __init__(self, data: FileBytes, magic: int, on_bad: str, ahead: int = 0) -> None:
        self.data, self.mark, self.on_bad, self.ahead = data, int(magic).to_bytes(4, "little"), on_bad, ahead

    def size_at(self, at: int, sure: bool) -> int | None:
        """Payload bytes of the frame at a position, or None if there is none. It fits into the file and is followed by a
        magic, zeros or the end; else, or if one must be ``sure``, its payload is a block."""
        head = self.data.get(at, 8, self.ahead)
        if len(head) < 8 or head[:4] != self.mark:
            return None
        size = int.from_bytes(head[4:], "little")
        after = at + 8 + size
        if size <= HEADER or after > self.data.length:
            return None
        if not sure:
            then = self.data.peek(after, 8)
            if then[:4] == self.mark or not then.strip(b"\x00"):
                return size
        return size if is_block(self.data.get(at + 8, size)) else None

    def find(self, start: int, end: int) -> int | None:
        """The first sure frame that begins in [start, end)."""
        at, own = start, FileBytes(self.data.handle, self.data.length)
        while at < end:
            held = own.get(at, min(CHUNK, end - at) + 3)
            k = held.find(self.mark)
            while k >= 0:
                if at + k < end and self.size_at(at + k, True) is not None:
                    return at + k
                k = held.find(self.mark, k + 1)
            at += CHUNK
        return None

    def zeros_to_end(self, at: int) -> bool:
        while at < self.data.length:
            if self.data.get(at, CHUNK).strip(b"\x00"):
                return False
            at += CHUNK
        return True

    def frames(self, start: int, end: int, payload: bool) -> Iterator[Frame]:
        """Frames that begin in [start, end), and the spans that follow them and are none."""
        at = 0 if start == 0 else self.find(start, end)
        if at is None:
            return
        n = self.data.length
        while at < n:
            size = self.size_at(at, at >= end or self.on_bad == "skip")
            if size is None:
                if not self.data.get(at, 8).strip(b"\x00") and self.zeros_to_end(at):
                    return
                if self.on_bad != "skip":
                    raise BadFrame(f"bad magic, short header or truncated frame at offset {at}")
                after = self.find(at + 1, n)
                after = n if after is None else after
                yield Frame(at, after - at - 8, False, None)
                at = after
                if at >= end:
                    return
                continue
            if at >= end:
                break
            yield Frame(at, size, True, self.data.get(at + 8, size, self.ahead) if payload else None)
            at += 8 + size
        # the next range looks for its first frame from ``end`` on: it must find the one this chain leads to
        if end < min(at, n) and self.on_bad != "skip" and self.find(end, min(at, n)) is not None:
            raise BadFrame(f"a frame seems to begin between {end} and {at}, inside another")


# ------------------------------------------------------------------ the data source

class Range(NamedTuple):
    """Bytes [start, end) of a file of ``length`` bytes."""

    file: str
    start: int
    end: int
    length: int


class Ranges(InputPartition):
    def __init__(self, ranges: Sequence[Range]) -> None:
        super().__init__(len(ranges))
        self.ranges = list(ranges)


def partitions(files: Sequence[tuple[str, int]], range_bytes: int) -> list[Ranges]:
    """Ranges of at most ``range_bytes``, several small ones to a partition."""
    out, held, size = [], [], 0
    for file, length in files:
        for start in range(0, length, range_bytes):
            end = min(start + range_bytes, length)
            if held and size + end - start > range_bytes:
                out.append(Ranges(held))
                held, size = [], 0
            held.append(Range(file, start, end, length))
            size += end - start
    return [*out, Ranges(held)] if held else out


class BlockFiles(DataSource):
    """Options: path (a qualified address), glob, what (frames or blocks), magic, on_bad, range_bytes, least_tasks
    (ranges are shorter, down to ``CHUNK``, if there would be fewer)."""

    @classmethod
    def name(cls) -> str:
        return "block_files"

    def schema(self) -> str:
        return FRAME_SCHEMA if self.options.get("what", "blocks") == "frames" else BLOCK_SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return BlockReader(dict(self.options))


class BlockReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        low = {k.lower(): v for k, v in options.items()}
        self.path, self.glob, self.what = low["path"], low.get("glob"), low.get("what", "blocks")
        self.magic, self.on_bad = int(low.get("magic", BLOCK_MAGIC)), low.get("on_bad", "error")
        self.range_bytes = int(low.get("range_bytes", 128 << 20))
        self.least_tasks = int(low.get("least_tasks", 1))

    def partitions(self) -> Sequence[InputPartition]:
        files = matching(self.path, self.glob)
        share = sum(length for _, length in files) // self.least_tasks
        return partitions(files, min(self.range_bytes, max(share, CHUNK)))

    def read(self, partition: Ranges) -> Iterator[pa.RecordBatch]:
        for r in partition.ranges:
            fs, path = opened(r.file)
            with fs.open_input_file(path) as handle:
                yield from (self.frames(r, handle) if self.what == "frames" else self.blocks(r, handle))

    def frames(self, r: Range, handle) -> Iterator[pa.RecordBatch]:
        rows = []
        scan = FrameScan(FileBytes(handle, r.length), self.magic, self.on_bad)
        for place, f in enumerate(scan.frames(r.start, r.end, False)):
            rows.append((r.file, r.start, place, f.offset, f.size, f.ok))
            if len(rows) == 10_000:
                yield self.rows(rows)
                rows = []
        if rows:
            yield self.rows(rows)

    @staticmethod
    def rows(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), FRAME_ARROW.types)],
                                          schema=FRAME_ARROW)

    def blocks(self, r: Range, handle) -> Iterator[pa.RecordBatch]:
        held, size = Blocks(), 0
        scan = FrameScan(FileBytes(handle, r.length), self.magic, self.on_bad, CHUNK)
        for place, f in enumerate(scan.frames(r.start, r.end, True)):
            if not f.ok:
                continue
            held.add(f.payload, (r.file, r.start, place, f.offset))
            size += f.size
            if size >= BATCH_BYTES:
                yield held.batch()
                held, size = Blocks(), 0
        if held.at:
            yield held.batch()


def _read(spark: SparkSession, path: str, what: str, magic: int, on_bad: str, glob: str | None,
          range_bytes: int | None) -> DataFrame:
    from ..session import ship_package
    ship_package(spark)  # the source's workers import this package
    spark.dataSource.register(BlockFiles)
    r = spark.read.format("block_files").option("what", what).option("magic", magic).option("on_bad", on_bad)
    if glob:
        r = r.option("glob", glob)
    if range_bytes is None:
        conf = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils
        range_bytes = conf.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes", "128m"))
        # like Spark's own readers: small inputs are cut so that every core has a part
        r = r.option("least_tasks", spark.sparkContext.defaultParallelism)
    return r.option("range_bytes", range_bytes).load(qualified(spark, path))


def read_block_frames(spark: SparkSession, path: str, magic: int = BLOCK_MAGIC, on_bad: str = "error",
                      glob: str | None = None, range_bytes: int | None = None) -> DataFrame:
    """SRC-1: one row per frame (file, index in the file, offset, payload size, whether it is a whole frame).

    The index adds up the rows of the ranges before; a file's ranges are few, one for each ``range_bytes``
    (default ``spark.sql.files.maxPartitionBytes``)."""
    f = _read(spark, path, "frames", magic, on_bad, glob, range_bytes)
    before = W.partitionBy("file").orderBy("split").rowsBetween(W.unboundedPreceding, -1)
    counts = f.groupBy("file", "split").agg(F.count(F.lit(1)).alias("_n")).select(
        "file", "split", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return f.join(counts, ["file", "split"]).select(
        "file", (F.col("_before") + F.col("place")).cast("int").alias("frame_idx"), "offset", "size", "magic_ok")


def read_block_files(spark: SparkSession, path: str, magic: int = BLOCK_MAGIC, on_bad: str = "error",
                     glob: str | None = None, range_bytes: int | None = None) -> DataFrame:
    """SRC-1 + SRC-2: one nested row per block, with the offset of its frame."""
    return _read(spark, path, "blocks", magic, on_bad, glob, range_bytes).drop("split", "place")
