"""Embedding near-dedup by cross-polytope hashing.

A vector is padded to a power of two and rotated fast and pseudo-randomly: three rounds of random sign
flips, each followed by a Hadamard transform. One hash is the signed axis nearest to the rotated
vector; a bucket of a table joins ``k`` hashes. The multiprobe puts each vector into the bucket of its
nearest axes and into that in which the least certain hash takes its second nearest axis. ``k`` grows
with the logarithm of the number of vectors, so that unrelated vectors seldom share a bucket. The number of
tables follows from the chance that two vectors at the asked cosine share a bucket of one table, so that
they share one of all with a chance of ``RECALL`` or more, whatever ``k`` is. If that takes more than
``MOST`` tables, ``k`` is smaller and the buckets are larger, down to one bucket of all vectors.

Vectors that share a bucket are candidates; their cosines are computed in double precision from the
stored components, so no link is wrong. A pair is counted in the first bucket that it shares, found
from both vectors' codes, so no pair is emitted or counted twice: a bucket gives each vector a number of
links and its components one edge for each vector. Buckets beyond ``PAGE`` vectors are cut into pages, each
two of which are compared as a unit; none is capped.

Equal vectors are one class, hashed once; a link to it counts as many vectors as it has.

Defined results: a vector that is null, empty or zero, holds a null or non-finite component, or has a
null vec_id links with nothing (its component_id is its vec_id). Vectors of different lengths don't
link. Repeated rows are vectors of their own. -0.0 equals 0.0. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import column, prepare, stage, whole_groups
from .components import Sets, components, star

COSINE, PAGE = 0.9, 1024
#: Tables for each hash of a bucket at least, buckets of a vector in a table, and the seed of the rotations.
TABLES, PROBES, SEED = 5, 2, 1_811
#: Chance that two vectors at the asked cosine share a bucket, tables at most, and draws that measure a table's chance.
RECALL, MOST, DRAWS = 0.99, 256, 1 << 14

RESULT = ["vec_id", "n_links", "component_id", "kept"]


def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of each row."""
    n, d = x.shape
    h = 1
    while h < d:
        y = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], 2).reshape(n, d)
        h *= 2
    return x / math.sqrt(d)


def codes(x: np.ndarray, k: int, tables: int) -> np.ndarray:
    """Buckets (rows x tables x PROBES) of unit vectors."""
    n, d = x.shape
    if not k:
        return np.zeros((n, tables, PROBES), np.int64)
    size = 1 << max(0, (d - 1).bit_length())
    x = np.pad(x, ((0, 0), (0, size - d)))
    random = np.random.Generator(np.random.Philox(SEED))
    out = np.zeros((n, tables, PROBES), np.int64)
    rows = np.arange(n)
    for t in range(tables):
        axes, loss = np.zeros((2, k, n), np.int64), np.zeros((k, n))
        for i in range(k):
            y = x
            for _ in range(3):
                y = hadamard(y * (random.integers(0, 2, size) * 2 - 1))
            strength = np.abs(y)
            best = strength.argmax(1)
            top = strength[rows, best]
            strength[rows, best] = -1
            second = strength.argmax(1)
            loss[i] = top - strength[rows, second]
            axes[0, i], axes[1, i] = 2 * best + (y[rows, best] < 0), 2 * second + (y[rows, second] < 0)
        doubt = loss.argmin(0)
        for p in range(PROBES):
            for i in range(k):
                out[:, t, p] = out[:, t, p] * (2 * size) + (np.where(doubt == i, axes[1, i], axes[0, i]) if p else axes[0, i])
    return out


@lru_cache
def axes(size: int, cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest and second axis (two vectors x DRAWS) and their distance, of pairs at ``cosine`` after random rotations."""
    random = np.random.Generator(np.random.Philox(SEED))
    best, second, loss = np.zeros((2, DRAWS), np.int64), np.zeros((2, DRAWS), np.int64), np.zeros((2, DRAWS))
    for at in range(0, DRAWS, 1024):
        x, z = random.normal(size=(2, 1024, size))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        z -= (z * x).sum(1, keepdims=True) * x
        z /= np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-300)
        for v, y in enumerate((x, x if size == 1 else cosine * x + math.sqrt(max(0.0, 1 - cosine * cosine)) * z)):
            own, rows = slice(at, at + 1024), np.arange(1024)
            strength = np.abs(y)
            one = strength.argmax(1)
            top = strength[rows, one]
            strength[rows, one] = -1
            two = strength.argmax(1)
            best[v, own], second[v, own] = 2 * one + (y[rows, one] < 0), 2 * two + (y[rows, two] < 0)
            loss[v, own] = top - strength[rows, two]
    return best, second, loss


def shared(k: int, size: int, cosine: float) -> float:
    """The chance that two vectors at ``cosine`` share a bucket of one table, by buckets of ``k`` of the drawn hashes."""
    best, second, loss = axes(size, cosine)
    random = np.random.Generator(np.random.Philox(SEED + 1))
    hits = total = 0
    for _ in range(32):
        pick = random.permutation(DRAWS)[: DRAWS // k * k].reshape(-1, k)
        doubt = loss[:, pick].argmin(2)[:, :, None] == np.arange(k)
        first = best[:, pick]
        codes = np.stack([first, np.where(doubt, second[:, pick], first)])  # probe, vector, bucket, hash
        met = np.zeros(len(pick), bool)
        for p in range(PROBES):
            for q in range(PROBES):
                met |= (codes[p, 0] == codes[q, 1]).all(1)
        hits, total = hits + int(met.sum()), total + len(met)
    return hits / total


def parameters(n: int, d: int, cosine: float = COSINE) -> tuple[int, int]:
    """Hashes of a bucket and tables for ``n`` vectors of ``d`` components."""
    half = 1 << max(0, (d - 1).bit_length())
    size = 2 * half
    k = max(1, min(math.ceil(math.log(max(n, 2)) / math.log(size)), int(62 / math.log2(size))))
    while k:
        p = 0.95 * shared(k, half, cosine)  # less what the draws may be off
        tables = math.ceil(math.log(1 - RECALL) / math.log(1 - p)) if p else MOST + 1
        if tables <= MOST:
            return k, max(tables, TABLES * k)
        k -= 1
    return 0, 1


def cleaned(vectors: DataFrame) -> DataFrame:
    """(vec_id, cls, d, raw): the components' bytes and their class, null where a vector can't link."""
    kind = vectors.schema["embedding"].dataType.elementType.simpleString()
    numbers = np.float32 if kind == "float" else np.float64

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw: list[bytes | None] = []
            for v in column(b, "embedding"):
                x = None
                if v.is_valid and len(v.values) and not v.values.null_count:
                    x = v.values.to_numpy(zero_copy_only=False).astype(numbers) + numbers(0)  # no -0.0
                    if not (np.isfinite(x).all() and x.any()):
                        x = None
                raw.append(None if x is None else x.tobytes())
            cls = [None if x is None else np.uint64(xxhash.xxh3_64_intdigest(x)).astype(np.int64) for x in raw]
            size = [None if x is None else len(x) // numbers().nbytes for x in raw]
            yield pa.RecordBatch.from_arrays([column(b, "vec_id"), pa.array(cls, pa.int64()), pa.array(size, pa.int32()), pa.array(raw, pa.binary())], names=["vec_id", "cls", "d", "raw"])

    typed = F.col("embedding").cast("array<float>" if kind == "float" else "array<double>")
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), typed.alias("embedding")).mapInArrow(clean, "vec_id long, cls long, d int, raw binary")


def units(x: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that no square overflows or vanishes."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def coded(reps: DataFrame, d: int, k: int, tables: int, numbers: type) -> DataFrame:
    """Add the buckets of each vector, as bytes."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = np.frombuffer(b"".join(column(b, "raw").to_pylist()), numbers).reshape(-1, d)
                c = codes(units(x), k, tables)
                yield pa.RecordBatch.from_arrays([column(b, "cls"), column(b, "m"), column(b, "raw"), pa.array(c.reshape(len(c), -1).tolist(), pa.list_(pa.int64()))], names=["cls", "m", "raw", "codes"])

    return reps.select("cls", "m", "raw").mapInArrow(code, "cls long, m long, raw binary, codes array<long>")


def compare(x: np.ndarray, c: np.ndarray, page: np.ndarray, table: int, code: int, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """The linked pairs of a unit that no earlier bucket has: those of different pages, or of all if there is one."""
    a, b = np.nonzero(np.triu(x @ x.T >= cosine, 1))
    if page.max() != page.min():
        far = page[a] != page[b]
        a, b = a[far], b[far]
    first = np.ones(len(a), bool)
    for t in range(table + 1):
        for p in range(PROBES):
            for q in range(PROBES):
                same = c[a, t, p] == c[b, t, q]
                first &= ~(same & (c[a, t, p] < code)) if t == table else ~same
    return a[first], b[first]


def found(rows: DataFrame, d: int, tables: int, cosine: float, numbers: type) -> DataFrame:
    """Per unit and vector (cls, links, low): the vectors linked to it, and the front of its component in the unit."""
    ids = rows.select("cls", F.posexplode("codes").alias("at", "code")).select("cls", F.floor(F.col("at") / PROBES).cast("int").alias("t"), "code").distinct()
    full = ids.groupBy("t", "code").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # only buckets with company take part; then the vectors go there
    placed = ids.join(full, ["t", "code"]).withColumn("k", F.ceil(F.col("n") / PAGE).cast("int")).drop("n")
    placed = placed.withColumn("page", F.pmod(F.xxhash64("cls", F.lit("page")), F.col("k")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("k") - 1))
    placed = placed.withColumn("other", other).select("cls", "t", "code", "page", F.least("page", "other").alias("i"), F.greatest("page", "other").alias("j"))
    full_rows = placed.join(rows, "cls")
    keys = ["t", "code", "i", "j"]

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g, at in whole_groups(batches, keys):
            raw = np.frombuffer(b"".join(g.column("raw").to_pylist()), numbers).reshape(-1, d)
            x, m, cls = units(raw), g.column("m").to_numpy(), g.column("cls").to_numpy()
            c = np.array(g.column("codes").to_pylist(), np.int64).reshape(len(x), tables, PROBES)
            page, t, code = (g.column(n).to_numpy() for n in ("page", "t", "code"))
            for lo, hi in zip(at, [*at[1:], len(x)], strict=True):
                if hi - lo < 2:
                    continue
                own = slice(lo, hi)
                a, b = compare(x[own], c[own], page[own], t[lo], code[lo], cosine)
                if not len(a):
                    continue
                n = np.bincount(a, weights=m[own][b], minlength=hi - lo) + np.bincount(b, weights=m[own][a], minlength=hi - lo)
                low = np.arange(hi - lo)
                while True:  # the smallest row reached, until nothing changes
                    new = low.copy()
                    np.minimum.at(new, a, low[b])
                    np.minimum.at(new, b, low[a])
                    new = new[new]
                    if (new == low).all():
                        break
                    low = new
                some = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array(cls[own][some]), pa.array(n[some].astype(np.int64)), pa.array(cls[own][low[some]])], names=["cls", "links", "low"])

    return full_rows.repartition(*keys).sortWithinPartitions(*keys).select("cls", "m", "raw", "codes", "page", *keys).mapInArrow(verify, "cls long, links long, low long")


def near_duplicates(vectors: DataFrame, *, cosine: float = COSINE) -> DataFrame:
    """Per row of ``vectors`` (vec_id, embedding) its links, its component and whether it stays."""
    spark = vectors.sparkSession
    prepare(spark)
    numbers = np.float32 if vectors.schema["embedding"].dataType.elementType.simpleString() == "float" else np.float64
    rows = stage(cleaned(vectors), "vectors")
    real = rows.where("cls is not null and vec_id is not null")
    reps = stage(real.groupBy("cls", "d", "raw").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("m")), "vector-classes")
    linked = None
    for r in reps.groupBy("d").count().orderBy("d").collect():  # one row for each length of vectors
        k, tables = parameters(r["count"], r["d"], cosine)
        part = stage(coded(reps.where(F.col("d") == r["d"]), r["d"], k, tables, numbers), "vector-codes")
        out = found(part, r["d"], tables, cosine, numbers)
        linked = out if linked is None else linked.unionByName(out)
    linked = stage(linked if linked is not None else spark.createDataFrame([], "cls long, links long, low long"), "vector-links")
    joined = components(linked.select(F.col("cls").alias("a"), F.col("low").alias("b")), name="vector-components")
    named = reps.select("cls", "rep", "m").join(joined.withColumnRenamed("node", "cls"), "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    named = named.join(linked.groupBy("cls").agg(F.sum("links").alias("links")), "cls", "left")
    smallest = named.groupBy("component").agg(F.min("rep").alias("least"))
    of = named.join(smallest, "component").select("cls", (F.coalesce("links", F.lit(0)) + F.col("m") - 1).alias("n"), "least")
    same = F.col("r.cls").eqNullSafe(F.col("c.cls")) & F.col("r.vec_id").isNotNull()
    out = rows.alias("r").join(of.alias("c"), same, "left")
    component = F.coalesce("c.least", "r.vec_id")
    return out.select("r.vec_id", F.coalesce("c.n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("r.vec_id") == component, F.lit(False)).alias("kept"))


SQL = r"""
with recursive v as (
  select vec_id, list_transform(embedding, lambda x: x::double) as e from embeddings
), g as (
  select vec_id, e, len(e) as d from v
  where e is not null and len(e) > 0 and len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(e, lambda x: x <> 0)) > 0
), l as (
  select a.vec_id as x, b.vec_id as y from g a join g b on a.d = b.d and a.vec_id < b.vec_id where list_cosine_similarity(a.e, b.e) >= 0.9
), e as (
  select x, y from l union all select y, x from l
), r as (
  select vec_id as x, vec_id as y from v union select r.x, e.y from r join e on r.y = e.x
), c as (
  select x, min(y) as component_id from r group by x
), n as (
  select x, count(*) as n from e group by x
)
select v.vec_id, coalesce(n.n, 0)::bigint as n_links, c.component_id, v.vec_id = c.component_id as kept
from v join c on c.x = v.vec_id left join n on n.x = v.vec_id
"""
