"""Suffix dedup: repeated strings of ``LENGTH`` bytes, found by a difference cover and suffix buckets.

Texts are UTF-8 bytes. A byte goes if a string of 50 bytes that covers it also starts in a document with
a smaller doc_id.

A difference cover of period 31 is a set of six residues such that every two positions i, j have a
shift d below 31 with i + d and j + d both in the cover. So two equal strings of 50 bytes at i and j
hold equal strings of 50 - 31 + 1 = 20 bytes that begin at cover positions of both: suffixes are first
sorted by the 20 bytes at cover positions alone, a fifth of all, and a suffix whose 50 bytes hold no
repeated cover sample has no equal. The suffixes that are left tie for 20 bytes or more; they are
sorted by their 50 bytes.

Both sorts go by blocks and buckets. The documents are packed into blocks of about ``BLOCK`` bytes. A block
sends the names (64-bit hashes; only equality matters here, so no lexicographic order is kept) of its
suffixes, each once, to the suffix buckets, and a task sorts one bucket at a time. Back goes one bit for
each name: whether it is also in another block, and in the second sort, whether a document with a
smaller doc_id than the block's smallest one has it. Blocks are stored bucketed by their number, so that
the answers travel to the texts and not the texts. A task holds one block or one bucket; the number of
buckets follows the input's size.

Equal texts are one class: those with a larger doc_id than the class's smallest go as a whole
(if they have 50 bytes) and take no part in the sorts.

Defined results: a null text is an empty one. A document shorter than 50 bytes loses nothing. Rows with
a null doc_id neither lose bytes nor make others lose them. Repeated rows (or rows that share a doc_id) don't
make each other lose bytes. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ..sinks.scratch import scratch_path
from .common import column, mix, prepare, stage, whole_groups
from .shingles import holding

LENGTH, PERIOD = 50, 31
#: A perfect difference set: every residue of 31 is a difference of two of these.
COVER = (0, 1, 3, 8, 12, 18)
SAMPLE = LENGTH - PERIOD + 1
BLOCK, BUCKET = 6 << 20, 1 << 20
#: Bits of a cover sample's name beside its bucket; a false repeat costs time, not correctness.
SAMPLE_BITS = 32

_U = np.uint64
NONE = np.iinfo(np.int64).min  # stands for a null doc_id
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def packed(rising: np.ndarray) -> bytes:
    """Rising integers, as compressed byte planes of their differences."""
    d = np.diff(rising.astype(_U), prepend=_U(0))
    return struct.pack("<q", len(d)) + zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(d.view(np.uint8).reshape(-1, 8).T).tobytes())


def unpacked(data: bytes) -> np.ndarray:
    n = struct.unpack("<q", data[:8])[0]
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[8:], max_output_size=8 * n + 1), np.uint8).reshape(8, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view(_U).ravel(), dtype=_U)


class Block:
    """Documents of one block, by rising doc_id, in one buffer."""

    def __init__(self, ids: list, sizes: list, data: bytes):
        self.ids, self.size = np.array(ids, np.int64), np.array(sizes, np.int64)
        self.text = zstandard.ZstdDecompressor().decompress(data, max_output_size=int(self.size.sum()) + 1)
        self.start = np.cumsum(self.size) - self.size
        buffer = self.text + bytes(64)
        self.eight = np.ndarray((len(buffer) - 7,), "<u8", buffer, 0, (1,))
        longest = int(self.size.max(initial=0))
        pattern = (np.arange(0, longest + PERIOD, PERIOD)[:, None] + np.array(COVER)).ravel()
        own = [s + pattern[: np.searchsorted(pattern, n - SAMPLE, "right")] for s, n, i in zip(self.start, self.size, self.ids, strict=True) if n >= LENGTH and i != NONE]
        self.cover = np.concatenate(own) if own else np.zeros(0, np.int64)

    def name(self, at: np.ndarray, length: int) -> np.ndarray:
        """A hash of the ``length`` bytes at each place, in parts that bound the memory."""
        out = np.empty(len(at), _U)
        for i in range(0, len(at), 1 << 18):
            part = at[i : i + (1 << 18)]
            h = mix(self.eight[part])
            for k in [*range(8, length - 8, 8), length - 8]:
                h = mix(h + self.eight[part + k] * _U(0x9E3779B97F4A7C15))
            out[i : i + len(part)] = h
        return out

    def samples(self, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct names of the cover samples (``bits`` bits), which of them stand in the block twice, and each sample's."""
        names, back, many = np.unique(self.name(self.cover, SAMPLE) >> _U(64 - bits), return_inverse=True, return_counts=True)
        return names, many > 1, back

    def suffixes(self, repeated: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """From the repeated samples: distinct names of the 50-byte strings that hold one, the first document of each,
        and for each string its place and name. Documents rise, so the first has the smallest doc_id."""
        begin, end = self.cover[repeated] - (LENGTH - SAMPLE), self.cover[repeated] + 1
        edge = np.zeros(len(self.text) + 2, np.int32)
        doc = np.searchsorted(self.start, self.cover[repeated], "right") - 1
        # empty documents share a start; the last of them is the one that has bytes
        last = self.start[doc] + self.size[doc] - LENGTH + 1
        begin, end = np.maximum(begin, self.start[doc]), np.minimum(end, last)
        some = end > begin
        np.add.at(edge, begin[some], 1)
        np.add.at(edge, end[some], -1)
        at = np.flatnonzero(np.cumsum(edge, out=edge) > 0).astype(np.int32 if len(edge) < 1 << 31 else np.int64)
        del edge
        names, first, back = np.unique(self.name(at, LENGTH), return_index=True, return_inverse=True)
        return names, np.searchsorted(self.start, at[first], "right") - 1, at, back.astype(np.int32 if len(at) < 1 << 31 else np.int64)


def per_bucket(names: np.ndarray, bits: int, of: int) -> Iterator[tuple[int, int, int]]:
    """(bucket, from, to) of rising names of ``bits`` bits in ``of`` buckets by their first bits."""
    cut = np.searchsorted(names, (np.arange(1, of, dtype=_U) << _U(bits - of.bit_length() + 1)))
    ends = [0, *cut.tolist(), len(names)]
    return ((k, lo, hi) for k, (lo, hi) in enumerate(zip(ends[:-1], ends[1:], strict=True)) if hi > lo)


def answers(rows: list[tuple[int, bytes]], names: np.ndarray, bits: int, of: int) -> np.ndarray:
    """The bits that the buckets sent back, for all names."""
    out = np.zeros(len(names), bool)
    masks = dict(rows)
    for k, lo, hi in per_bucket(names, bits, of):
        out[lo:hi] = np.unpackbits(np.frombuffer(masks[k], np.uint8), count=hi - lo)
    return out


def blocks(docs: DataFrame, parts: int) -> DataFrame:
    """(block, ids, sizes, data), bucketed by block so that joins don't move the texts."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[tuple[int, bytes]] = []
        size = 0

        def out() -> pa.RecordBatch:
            held.sort(key=lambda x: x[0])
            data = zstandard.ZstdCompressor(level=3).compress(b"".join(x for _, x in held))
            kinds = [("block", pa.int64()), ("ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("data", pa.binary())]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, (_, k) in zip((number, [i for i, _ in held], [len(x) for _, x in held], data), kinds, strict=True)], names=[n for n, _ in kinds])

        for b in batches:
            for i, t in zip(column(b, "doc_id").to_pylist(), column(b, "text").to_pylist(), strict=True):
                data = (t or "").encode()
                if held and size + len(data) > BLOCK:
                    yield out()
                    held, size, number = [], 0, number + 1
                held.append((NONE if i is None else i, data))
                size += len(data)
        if held:
            yield out()

    spark = docs.sparkSession
    table = f"suffix_blocks_{uuid.uuid4().hex}"
    made = docs.mapInArrow(fill, "block long, ids array<long>, sizes array<long>, data binary")
    made.write.bucketBy(parts, "block").option("path", scratch_path(spark, table)).saveAsTable(table)
    return spark.table(table)


def asked(rows: DataFrame, answered: DataFrame | None, step, kind: str) -> DataFrame:
    """Run ``step(block, number, answers by kind of question)`` on every block, with the answers that belong to it."""
    if answered is not None:
        grouped = answered.groupBy("block").agg(F.collect_list(F.struct("step", "bucket", "mask")).alias("masks"))
        rows = rows.join(grouped, "block", "left")
    else:
        rows = rows.withColumn("masks", F.lit(None).cast("array<struct<step:int,bucket:int,mask:binary>>"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                ids, sizes, data, masks = (column(b, n)[i].as_py() for n in ("ids", "sizes", "data", "masks"))
                by: dict[int, list[tuple[int, bytes]]] = {1: [], 2: []}
                for m in masks or ():
                    by[m["step"]].append((m["bucket"], m["mask"]))
                yield from step(Block(ids, sizes, data), column(b, "block")[i].as_py(), by)

    return rows.mapInArrow(run, kind)


def suffix_dedup(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text) its bytes, those removed, their runs, and the SHA-256 of what is left."""
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    meta = stage(docs.select("doc_id", F.octet_length("text").cast("long").alias("n"), F.md5("text").alias("h")), "suffix-texts")
    total = meta.agg(F.sum("n")).first()[0] or 0
    first = meta.where("doc_id is not null").groupBy("h").agg(F.min("doc_id").alias("first"))
    copies = stage(meta.where(F.col("n") >= LENGTH).join(first, "h").where("doc_id > first").select("doc_id", "n", "h"), "suffix-copies")

    ids = copies.select(F.col("doc_id").alias("id"))
    maybe = holding(docs, ids).withColumn("h", F.md5("text")).join(copies.select("doc_id", "h").distinct().hint("merge"), ["doc_id", "h"], "left_anti")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // (8 * BLOCK)))
    texts = blocks(holding(docs, ids, inside=False).unionByName(maybe.select("doc_id", "text")), parts)

    of = 1 << max(4, int(total * len(COVER) / PERIOD / BUCKET).bit_length())
    bits = min(64, SAMPLE_BITS + of.bit_length() - 1)

    def send_samples(block: Block, number: int, _) -> Iterator[pa.RecordBatch]:
        names, _, _ = block.samples(bits)
        rows = [(k, packed(names[lo:hi])) for k, lo, hi in per_bucket(names, bits, of)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], pa.int32()), pa.array([number] * len(rows), pa.int64()), pa.array([x for _, x in rows], pa.binary())], names=["bucket", "block", "names"])

    def elsewhere(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g, at in whole_groups(batches, ["bucket"], 1 << 20):
            for lo, hi in zip(at, [*at[1:], g.num_rows], strict=True):
                part = g.slice(int(lo), int(hi - lo))
                each = [unpacked(x) for x in part.column("names").to_pylist()]
                names = np.concatenate(each)
                order = np.argsort(names, kind="stable")
                same = names[order[1:]] == names[order[:-1]]
                twice = np.zeros(len(names), bool)
                twice[order[1:][same]] = True
                twice[order[:-1][same]] = True
                yield _back(part, each, twice, 1)

    first_sort = asked(texts, None, send_samples, "bucket int, block long, names binary")
    repeated = stage(first_sort.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(elsewhere, "block long, step int, bucket int, mask binary"), "suffix-samples")

    def send_suffixes(block: Block, number: int, masks) -> Iterator[pa.RecordBatch]:
        names, twice, back = block.samples(bits)
        names, doc, _, _ = block.suffixes((twice | answers(masks[1], names, bits, of))[back])
        for k, lo, hi in per_bucket(names, 64, of):
            some, at = np.unique(doc[lo:hi], return_inverse=True)
            docs_ = packed((block.ids[some].astype(np.int64) ^ NONE).view(_U))
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([number], pa.int64()), pa.array([packed(names[lo:hi])], pa.binary()), pa.array([docs_], pa.binary()), pa.array([zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(at.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes())], pa.binary())], names=["bucket", "block", "names", "docs", "doc"])

    def earlier(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g, at in whole_groups(batches, ["bucket"], 1 << 20):
            for lo, hi in zip(at, [*at[1:], g.num_rows], strict=True):
                part = g.slice(int(lo), int(hi - lo))
                each = [unpacked(x) for x in part.column("names").to_pylist()]
                own = []
                for n, ids_, doc in zip(each, part.column("docs").to_pylist(), part.column("doc").to_pylist(), strict=True):
                    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(doc, max_output_size=4 * len(n) + 1), np.uint8).reshape(4, -1)
                    own.append(unpacked(ids_)[np.ascontiguousarray(planes.T).view("<u4").ravel()])
                names, doc = np.concatenate(each), np.concatenate(own)
                order = np.argsort(names, kind="stable")
                new = np.ones(len(names), bool)
                new[1:] = names[order[1:]] != names[order[:-1]]
                begin = np.flatnonzero(new)
                least = np.minimum.reduceat(doc[order], begin)
                before = np.zeros(len(names), bool)
                before[order] = doc[order] > np.repeat(least, np.diff(np.append(begin, len(names))))
                yield _back(part, each, before, 2)

    second_sort = asked(texts, repeated, send_suffixes, "bucket int, block long, names binary, docs binary, doc binary")
    gone = stage(second_sort.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(earlier, "block long, step int, bucket int, mask binary"), "suffix-answers")

    def cut(block: Block, number: int, masks) -> Iterator[pa.RecordBatch]:
        names, twice, back = block.samples(bits)
        names, doc, at, back = block.suffixes((twice | answers(masks[1], names, bits, of))[back])
        own = block.ids[np.searchsorted(block.start, at, "right") - 1]
        # if an earlier document of another block has it, all go; or else those after the block's smallest doc_id
        dead = answers(masks[2], names, 64, of)[back] | (own > block.ids[doc][back])
        edge = np.zeros(len(block.text) + LENGTH + 1, np.int32)
        np.add.at(edge, at[dead], 1)
        np.add.at(edge, at[dead] + LENGTH, -1)
        lost = np.cumsum(edge)[: len(block.text)] > 0
        text = np.frombuffer(block.text, np.uint8)
        out = []
        for i, s, n in zip(block.ids.tolist(), block.start.tolist(), block.size.tolist(), strict=True):
            m = lost[s : s + n]
            removed = int(m.sum())
            spans = int((m[1:] & ~m[:-1]).sum() + m[0]) if removed else 0
            data = text[s : s + n][~m].tobytes() if removed else block.text[s : s + n]
            out.append((None if i == NONE else i, n, removed, spans, hashlib.sha256(data).hexdigest()))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=[x.split()[0] for x in RESULT.split(", ")])

    kept = asked(texts, repeated.unionByName(gone), cut, RESULT)
    whole = copies.select("doc_id", F.col("n").alias("n_bytes"), F.col("n").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"), F.lit(hashlib.sha256(b"").hexdigest()).alias("kept_sha256"))
    return kept.unionByName(whole)


def _back(part: pa.Table, each: list[np.ndarray], bits: np.ndarray, step: int) -> pa.RecordBatch:
    """A bucket's answers to its blocks."""
    ends = np.cumsum([len(x) for x in each])[:-1]
    masks = [np.packbits(x).tobytes() for x in np.split(bits, ends)]
    n = len(each)
    return pa.RecordBatch.from_arrays([part.column("block").combine_chunks(), pa.array([step] * n, pa.int32()), part.column("bucket").combine_chunks(), pa.array(masks, pa.binary())], names=["block", "step", "bucket", "mask"])
