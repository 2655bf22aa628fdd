"""Line dedup: sharded cuckoo filters over exact reference counts.

A line's key is the line stripped of blanks, with A-Z lower-cased, and stands as a 128-bit hash.
``line_keys`` gives each document's distinct keys; ``references`` counts the documents of each key. The
counts are the exact state: ``changed`` adds the keys of new documents or takes those of deleted ones
away, so that a deletion undoes an insertion. Keys of ``min_docs`` documents or more are *common*;
each shard of them has a cuckoo filter, which ``updated`` keeps in step with the counts by inserting
and deleting fingerprints. Lines are first asked of their shard's filter, and those that it lets pass
are looked up among the exact counts, so a filter's false answers never drop a line.

Shards hold a bounded number of keys each (their number follows the keys); the lines asked are dealt
by shard and by a salt of the document, so that a very common line meets many copies of its filter.

Defined results: a null or empty text is one empty line, which is never dropped (keys have
``min_chars`` code points at least). Rows are documents: repeated rows count each. Lines are looked up for each (doc_id, hash of
the text), so rows that share a doc_id, or have none, don't meet unless their texts are equal as well; two texts of one hash
would share their common keys, which changes nothing. Extra columns are ignored by ``line_dedup`` and kept by ``dropped``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import column, prepare, slices, stage

MIN_DOCS, MIN_CHARS = 10, 1
#: Keys of a shard's filter, and lines asked in one group, on average.
SHARD_KEYS, GROUP_LINES = 50_000, 50_000
SLOTS, KICKS = 4, 500

RESULT = "doc_id long, n_lines long, n_dropped long, kept_sha256 string"


def key_of(line: bytes) -> bytes:
    """bytes.strip and bytes.lower know exactly the ASCII blanks and letters."""
    return line.strip().lower()


def digest(line: bytes, min_chars: int) -> bytes | None:
    key = key_of(line)
    if len(key) < min_chars or len(key.decode()) < min_chars:
        return None
    return xxhash.xxh3_128_digest(key)


def line_keys(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, hash of the text, k1, k2) for each distinct key of each row of ``docs``."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            # each text's set of digests goes as soon as it is joined: only 16 bytes a key are held
            found = [b"".join(sorted({d for line in t.encode().split(b"\n") if (d := digest(line, min_chars))})) if t else b"" for t in column(b, "text").to_pylist()]
            at = np.repeat(np.arange(len(found)), [len(x) // 16 for x in found])
            k = np.frombuffer(b"".join(found), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([*(column(b, c).take(pa.array(at)) for c in ("doc_id", "hash")), pa.array(k[:, 0]), pa.array(k[:, 1])], names=["doc_id", "hash", "k1", "k2"])

    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("hash")).mapInArrow(keys, "doc_id long, hash long, k1 long, k2 long")


def references(keys: DataFrame) -> DataFrame:
    """The exact table: documents of each key."""
    return keys.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("refs"))


def changed(refs: DataFrame, inserted: DataFrame | None = None, deleted: DataFrame | None = None) -> DataFrame:
    """The exact table after documents with the keys ``inserted`` came and ones with ``deleted`` went."""
    parts = [refs.select("k1", "k2", F.col("refs").alias("n"))]
    parts += [x.select("k1", "k2", F.lit(sign).cast("long").alias("n")) for x, sign in ((inserted, 1), (deleted, -1)) if x is not None]
    all_ = parts[0]
    for x in parts[1:]:
        all_ = all_.unionByName(x)
    return all_.groupBy("k1", "k2").agg(F.sum("n").alias("refs")).where("refs > 0")


class Cuckoo:
    """A cuckoo filter of 128-bit keys: 16-bit fingerprints, buckets of four, two buckets for each key."""

    def __init__(self, capacity: int = 0, table: np.ndarray | None = None):
        if table is None:
            table = np.zeros((1 << max(1, int(np.ceil(np.log2(max(1, capacity) / (SLOTS * 0.85))))), SLOTS), np.uint16)
        self.table = table

    def places(self, k1: np.ndarray, k2: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        mask = np.uint64(len(self.table) - 1)
        fp = (k2.view(np.uint64) % np.uint64(65535) + np.uint64(1)).astype(np.uint16)
        one = (k1.view(np.uint64) >> np.uint64(8)) & mask
        return fp, one.astype(np.int64), self.other(one.astype(np.int64), fp)

    def other(self, at: np.ndarray, fp: np.ndarray) -> np.ndarray:
        return at ^ ((fp.astype(np.int64) * 0x5BD1E995) & (len(self.table) - 1))

    def insert(self, k1: np.ndarray, k2: np.ndarray) -> bool:
        """False if a key found no place; the filter must then be built anew, larger."""
        t = self.table
        for fp, one, two in zip(*self.places(k1, k2), strict=True):
            at = one if (t[one] == 0).any() or not (t[two] == 0).any() else two
            for kick in range(KICKS):
                free = np.flatnonzero(t[at] == 0)
                if len(free):
                    t[at, free[0]] = fp
                    break
                fp, t[at, kick % SLOTS] = t[at, kick % SLOTS], fp
                at = int(self.other(np.int64(at), np.uint16(fp)))
            else:
                return False
        return True

    def delete(self, k1: np.ndarray, k2: np.ndarray) -> None:
        """Remove keys that are in the filter (the exact table knows which)."""
        for fp, one, two in zip(*self.places(k1, k2), strict=True):
            for at in (one, two):
                there = np.flatnonzero(self.table[at] == fp)
                if len(there):
                    self.table[at, there[0]] = 0
                    break

    def contains(self, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        fp, one, two = self.places(k1, k2)
        return (self.table[one] == fp[:, None]).any(1) | (self.table[two] == fp[:, None]).any(1)

    @classmethod
    def of(cls, k1: np.ndarray, k2: np.ndarray) -> Cuckoo:
        capacity = max(16, len(k1))
        while not (f := cls(capacity)).insert(k1, k2):
            capacity *= 2
        return f

    def dump(self) -> bytes:
        return self.table.tobytes()

    @classmethod
    def load(cls, data: bytes) -> Cuckoo:
        return cls(table=np.frombuffer(data, np.uint16).reshape(-1, SLOTS).copy())


def shard(shards: int) -> F.Column:
    return F.pmod(F.xxhash64("k1", "k2"), F.lit(shards)).cast("int")


def filters(common: DataFrame, shards: int) -> DataFrame:
    """(shard, filter) of the common keys (k1, k2); every shard has a row, be it empty."""

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        real = pdf[pdf["real"]]
        f = Cuckoo.of(real["k1"].to_numpy(np.int64), real["k2"].to_numpy(np.int64))
        return pd.DataFrame({"shard": pdf["shard"][:1], "filter": [f.dump()]})

    every = common.sparkSession.range(shards).select(F.col("id").cast("int").alias("shard"), F.lit(0).cast("long").alias("k1"), F.lit(0).cast("long").alias("k2"), F.lit(False).alias("real"))
    return common.select(shard(shards).alias("shard"), "k1", "k2", F.lit(True).alias("real")).unionByName(every).groupBy("shard").applyInPandas(build, "shard int, filter binary")


def updated(old: DataFrame, came: DataFrame, went: DataFrame, common: DataFrame, shards: int) -> DataFrame:
    """The filters after the keys ``came`` have become common and ``went`` have ceased to be; a shard whose
    filter overflows is built anew from its ``common`` keys of the new exact table."""
    rows = [x.select(shard(shards).alias("shard"), "k1", "k2", F.lit(sign).alias("sign")) for x, sign in ((came, 1), (went, -1), (common, 0))]

    def apply(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        f = Cuckoo.load(left["filter"].iloc[0])
        k = {s: g[["k1", "k2"]].to_numpy(np.int64).T.copy() for s, g in right.groupby("sign")}
        if -1 in k:
            f.delete(*k[-1])
        if 1 in k and not f.insert(*k[1]):
            f = Cuckoo.of(*k[0])
        return pd.DataFrame({"shard": left["shard"][:1], "filter": [f.dump()]})

    return old.groupBy("shard").cogroup(rows[0].unionByName(rows[1]).unionByName(rows[2]).groupBy("shard")).applyInPandas(apply, "shard int, filter binary")


def passed(keys: DataFrame, made: DataFrame, shards: int, salts: int) -> DataFrame:
    """The rows of ``keys`` that their shard's filter lets pass. Both sides are dealt by (shard, salt)."""

    def ask(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left):
            return left[["doc_id", "hash", "k1", "k2"]]
        yes = Cuckoo.load(right["filter"].iloc[0]).contains(left["k1"].to_numpy(np.int64), left["k2"].to_numpy(np.int64))
        return left.loc[yes, ["doc_id", "hash", "k1", "k2"]]

    # the salt takes the key in as well, so that rows that share a doc_id don't all meet
    asked = keys.withColumns({"shard": shard(shards), "salt": F.pmod(F.xxhash64("doc_id", "hash", "k2", F.lit("salt")), F.lit(salts)).cast("int")})
    copies = made.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return asked.groupBy("shard", "salt").cogroup(copies.groupBy("shard", "salt")).applyInPandas(ask, "doc_id long, hash long, k1 long, k2 long")


def drops(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, hash of the text, common): the common keys that documents hold."""
    keys = stage(line_keys(docs, min_chars), "line-keys")
    refs = stage(references(keys), "line-refs")
    common = refs.where(F.col("refs") >= min_docs).select("k1", "k2")
    shards = -(-common.count() // SHARD_KEYS) or 1
    salts = -(-keys.count() // (GROUP_LINES * shards)) or 1
    maybe = passed(keys, filters(common, shards), shards, salts)
    hits = maybe.join(common, ["k1", "k2"])  # the exact table decides
    return hits.groupBy("doc_id", "hash").agg(F.collect_set(F.struct("k1", "k2")).alias("common")).select(F.col("doc_id").alias("_id"), F.col("hash").alias("_hash"), "common")


def _commons(found: pa.ListArray) -> Iterator[set[bytes]]:
    """The common keys of each row of a column of them (k1, k2), one row's at a time: a batch of copies of a
    long text repeats all its keys in every row, which as Python objects would take twenty times the batch."""
    inner, ends = found.values, found.offsets.to_numpy()
    keys = np.column_stack([inner.field(0).to_numpy(zero_copy_only=False), inner.field(1).to_numpy(zero_copy_only=False)]).astype(np.int64, copy=False) if len(inner) else np.zeros((0, 2), np.int64)
    for a, b, there in zip(ends[:-1], ends[1:], found.is_valid().to_numpy(zero_copy_only=False), strict=True):
        row = keys[a:b].tobytes() if there else b""
        yield {row[i : i + 16] for i in range(0, len(row), 16)}


def _split(text: str | None, gone: set[bytes], min_chars: int) -> tuple[int, int, bytes]:
    """Lines, lines dropped, and the text that stays, without the lines of the keys ``gone``."""
    data = (text or "").encode()
    if not gone:
        return data.count(b"\n") + 1, 0, data
    lines = data.split(b"\n")
    kept = [x for x in lines if digest(x, min_chars) not in gone]
    return len(lines), len(lines) - len(kept), b"\n".join(kept)


def _with_drops(docs: DataFrame, min_docs: int, min_chars: int) -> DataFrame:
    found = drops(docs.select("doc_id", "text"), min_docs, min_chars)
    # an empty struct column carries the common keys beside the columns of docs, whatever their names
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"))
    same = F.col("_row.doc_id").cast("long").eqNullSafe(F.col("_id")) & (F.xxhash64(F.col("_row.text").cast("string")) == F.col("_hash"))
    return whole.join(found, same, "left")


def line_dedup(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """Per row of ``docs`` (doc_id, text) its lines, those dropped, and the SHA-256 of the text that stays."""
    prepare(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    joined = _with_drops(docs, min_docs, min_chars).select("_row.doc_id", "_row.text", "common")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            out = []
            for t, gone in zip(column(b, "text").to_pylist(), _commons(column(b, "common")), strict=True):
                n, less, kept = _split(t, gone, min_chars)
                out.append((n, less, hashlib.sha256(kept).hexdigest()))
            yield pa.RecordBatch.from_arrays([column(b, "doc_id"), pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64()), pa.array([x[2] for x in out], pa.string())], names=["doc_id", "n_lines", "n_dropped", "kept_sha256"])

    return joined.mapInArrow(cut, RESULT)


def dropped(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` with the common lines cut out of ``text``; all other columns stay."""
    prepare(docs.sparkSession)
    joined = _with_drops(docs, min_docs, min_chars).select(F.col("_row.text").cast("string").alias("text"), "common", "_row")
    kind = joined.select(F.col("text").alias("_text"), "_row").schema

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            texts = column(b, "text").to_pylist()
            out = [t if not gone else _split(t, gone, min_chars)[2].decode() for t, gone in zip(texts, _commons(column(b, "common")), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()), column(b, "_row")], names=["_text", "_row"])

    cut_ = joined.mapInArrow(cut, kind)
    return cut_.select(*((F.col("_text") if c == "text" else F.col(f"_row.`{c}`")).alias(c) for c in docs.columns))


SQL = r"""
with d as (
  select row_number() over () as r, doc_id, string_split(coalesce(text, ''), chr(10)) as parts from documents
), l as (
  select r, doc_id, unnest(parts) as line, generate_subscripts(parts, 1) as i from d
), k as (
  select *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from l
), c as (
  select key from k where length(key) >= 1 group by key having count(distinct r) >= 10
), m as (
  select k.*, c.key is not null as gone from k left join c on k.key = c.key
)
select any_value(doc_id) as doc_id, count(*)::bigint as n_lines, count(*) filter (where gone)::bigint as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by i) filter (where not gone), '')) as kept_sha256
from m group by r
"""
