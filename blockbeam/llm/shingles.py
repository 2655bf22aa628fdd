"""N-gram Jaccard join with a count-vector R-tree.

A document's set holds the hashes of its distinct shingles of five words. Documents of equal sets are
one class, and a class is a point: its shingles are hashed into ``GROUPS`` groups and counted by group
(large sets into more, folded to the same number where two are compared).

*Units.* If sets are sorted by one order of all shingles, two sets with a Jaccard similarity of t or
more share a shingle among their first ``n - ceil(t * n) + 1``. The order puts frequent shingles last,
by counts over all documents in a table of ``SKETCH`` hashed counters. The classes that share a prefix
shingle are a unit; shingles with the same classes make one unit.

*Search.* The points of a unit are packed into an R-tree whose nodes keep the largest count of each
group and the smallest set size below them. The sum over groups of the smaller of two counts bounds
the overlap of two sets, and with a node's largest counts that of a set with all sets below the node;
subtrees and points whose bound is too small for t are passed over. Surviving pairs join their classes
to a *cell*, and a pair whose classes already are in one cell needs no further look, so that a unit
gives no more edges than it has classes. Linked classes always lie in one cell.

*Verification.* Each class's text goes once to its cell, and there the same search runs with the sets at
hand: surviving pairs are verified, but for those that the links found so far already join, since
the result is the components.

Units beyond ``UNIT`` classes and cells beyond ``CELL_WORDS`` shingles are cut into pages, and each two pages
are searched together.

Defined results: null texts and texts without words have an empty set and link with nothing. Rows with
a null doc_id link with nothing, and their component_id is null. Repeated rows are equal texts. Rows
that share a doc_id are nodes of their own class each. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import Words, column, counted, mix, prepare, slices, stage, whole_groups, windows
from .components import Sets, components, star

WORDS, PERCENT = 5, 80
SKETCH, GROUPS, FAN = 1 << 18, 128, 16
UNIT, CELL_WORDS = 2048, 4_000_000
MAX_BITS = 1 << 28

_U = np.uint64
RESULT = ["doc_id", "n_shingles", "component_id"]


def shingles(texts: pa.Array, size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text of every shingle, repeats included; a text of fewer words is one shingle."""
    words = Words(pc.ascii_lower(pc.fill_null(texts, "")))
    h = words.hashes()
    key, at = windows(h, words.doc, size)
    doc = words.doc[at]
    for n in range(1, size):
        few = words.count[words.doc] == n
        short, at = windows(h[few], words.doc[few], n)
        if len(short):
            key = np.concatenate([key, mix(short ^ _U(n))])
            doc = np.concatenate([doc, words.doc[few][at]])
    return key, doc


def ordered_sets(texts: pa.Array, rank: np.ndarray, size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """The sets of all texts, one after the other, each sorted by the order of all shingles, and where each
    begins (one more than texts). A shingle is its rank among the counters, then its hash."""
    key, doc = shingles(texts, size)
    key = (rank[(key & _U(SKETCH - 1)).astype(np.int64)].astype(_U) << _U(56)) | (mix(key) >> _U(8))
    order = np.lexsort((key, doc))
    key, doc = key[order], doc[order]
    first = np.ones(len(key), bool)
    first[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
    key, doc = key[first], doc[first]
    return key, np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(texts)))]).astype(np.int64)


def frequencies(docs: DataFrame, size: int = WORDS) -> np.ndarray:
    """The rank of each counter: the more documents' shingles it counts, the higher (0 to 255)."""

    def count(b: pa.RecordBatch) -> np.ndarray:
        total = np.zeros(SKETCH, np.int64)
        for part in slices([b], "text"):
            key, doc = shingles(column(part, "text"), size)
            # once for each document: a document's repeats say nothing about others
            one = np.unique(mix(key) ^ doc.astype(_U) * _U(0x9E3779B97F4A7C15), return_index=True)[1]
            total += np.bincount((key[one] & _U(SKETCH - 1)).astype(np.int64), minlength=SKETCH)
        return total

    total = counted(docs.select("text"), count, SKETCH)
    return np.minimum(np.log2(total + 1) * 4, 255).astype(np.uint8)


def names(keys: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """The class of each set: a hash of it (0 for the empty set)."""
    out = np.zeros(len(begin) - 1, np.int64)
    for i in np.flatnonzero(np.diff(begin)):
        out[i] = np.uint64(xxhash.xxh3_64_intdigest(keys[begin[i] : begin[i + 1]].tobytes())).astype(np.int64) or 1
    return out


def groups(n: int) -> int:
    """Groups of a set of ``n``: GROUPS, and in larger sets a power of two over n / 16, so that the bound stays sharp."""
    return max(GROUPS, 1 << max(0, int(n // 8).bit_length() - 1))


def points(keys: np.ndarray, begin: np.ndarray) -> list[np.ndarray]:
    """The counts by group of each set, in the smallest kind of integer that holds them."""
    out = []
    for lo, hi in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True):
        g = groups(hi - lo)
        c = np.bincount((keys[lo:hi] & _U(g - 1)).astype(np.int64), minlength=g)
        top = c.max(initial=0)
        out.append(c.astype("<u1" if top < 1 << 8 else "<u2" if top < 1 << 16 else "<u4"))
    return out


def loaded(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, f"<u{len(data) // groups(n)}")


def folded(point: np.ndarray, g: int) -> np.ndarray:
    """The same set's counts in ``g`` groups."""
    return point.reshape(-1, g).sum(0, dtype=np.int64)


def classes(docs: DataFrame, rank: np.ndarray, size: int = WORDS) -> DataFrame:
    """(doc_id, n, cls, point) of every row."""

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            keys, begin = ordered_sets(column(b, "text"), rank, size)
            yield pa.RecordBatch.from_arrays([column(b, "doc_id"), pa.array(np.diff(begin)), pa.array(names(keys, begin)), pa.array([x.tobytes() for x in points(keys, begin)], pa.binary())], names=["doc_id", "n", "cls", "point"])

    return docs.mapInArrow(name, "doc_id long, n long, cls long, point binary")


def prefixes(docs: DataFrame, rank: np.ndarray, percent: int, size: int = WORDS) -> DataFrame:
    """(key, cls) for the prefix shingles of each class, once in a batch."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            keys, begin = ordered_sets(column(b, "text"), rank, size)
            cls = names(keys, begin)
            n = np.diff(begin)
            one = np.zeros(len(cls), bool)
            one[np.unique(cls, return_index=True)[1]] = True
            take = np.where(one & (n > 0), n + (-percent * n) // 100 + 1, 0)
            at = np.repeat(begin[:-1] - (np.cumsum(take) - take), take) + np.arange(take.sum())
            yield pa.RecordBatch.from_arrays([pa.array(keys[at].view(np.int64)), pa.array(np.repeat(cls, take))], names=["key", "cls"])

    return docs.where("doc_id is not null").mapInArrow(emit, "key long, cls long")


def shared(posts: DataFrame) -> DataFrame:
    """The distinct (key, cls) of keys that two classes or more have. The rows of a key come sorted, so a task
    remembers no more than one row."""

    def several(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, held_cls, told = np.zeros(0, np.int64), np.zeros(0, np.int64), False
        for b in batches:
            if not b.num_rows:
                continue
            # the last row of the batch before goes in front, as its key may go on
            key = np.concatenate([held_key, column(b, "key").to_numpy()])
            cls = np.concatenate([held_cls, column(b, "cls").to_numpy()])
            one = np.ones(len(key), bool)
            one[1:] = (key[1:] != key[:-1]) | (cls[1:] != cls[:-1])
            key, cls = key[one], cls[one]
            same = key[1:] == key[:-1]
            out = np.zeros(len(key), bool)
            out[1:] |= same
            out[:-1] |= same
            held_key, held_cls = key[-1:], cls[-1:]
            last = bool(out[-1]) or (told and len(key) == 1)
            if told:
                out[0] = False
            told = last
            if out.any():
                yield pa.RecordBatch.from_arrays([pa.array(key[out]), pa.array(cls[out])], names=["key", "cls"])

    return posts.repartition("key").sortWithinPartitions("key", "cls").mapInArrow(several, "key long, cls long")


def units(pairs: DataFrame) -> DataFrame:
    """(unit, cls, m): keys that have the same classes are one unit, named by the smallest of them."""
    lists = pairs.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.bit_xor(F.xxhash64("cls")).alias("s"), F.bit_xor(F.xxhash64("cls", F.lit(1))).alias("t"))
    first = lists.groupBy("m", "s", "t").agg(F.min("key").alias("key")).select("key", "m")
    return pairs.join(first, "key").select(F.col("key").alias("unit"), "cls", "m")


def paged(rows: DataFrame, k: str) -> DataFrame:
    """Deal the classes of a group to ``k`` pages and copy them to each two pages (i, j) that they are part of."""
    page = F.pmod(F.xxhash64("cls", F.lit("page")), F.col(k)).cast("int")
    other = F.explode(F.when(F.col(k) == 1, F.array(F.lit(0))).otherwise(F.filter(F.sequence(F.lit(0), F.col(k) - 1), lambda j: j != F.col("page"))))
    return rows.withColumn("page", page).withColumn("other", other).withColumns({"i": F.least("page", "other"), "j": F.greatest("page", "other")}).drop("page", "other", k)


class CountTree:
    """An R-tree of count vectors: points packed by size and then by counts, ``FAN`` to a node."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray, percent: int):
        self.percent = percent
        # sort by size class first, as sets of very different sizes can't be linked
        self.order = np.lexsort((*points.T[:8][::-1], (np.log2(np.maximum(sizes, 1)) * 4).astype(int)))
        self.levels = [(points[self.order], sizes[self.order])]
        while len(self.levels[-1][1]) > FAN:
            high, low = self.levels[-1]
            at = np.arange(0, len(low), FAN)
            self.levels.append((np.maximum.reduceat(high, at), np.minimum.reduceat(low, at)))

    def search(self, point: np.ndarray, size: int) -> np.ndarray:
        """Points whose overlap with ``point`` may reach the similarity, by the summed smaller counts."""
        nodes = np.arange(len(self.levels[-1][1]))
        for depth in range(len(self.levels) - 1, -1, -1):
            high, low = self.levels[depth]
            bound = np.minimum(high[nodes], point).sum(1)
            # 100 * overlap >= percent * (size + other - overlap), other at its least
            nodes = nodes[(100 + self.percent) * bound >= self.percent * (size + low[nodes])]
            if depth:
                below = (nodes[:, None] * FAN + np.arange(FAN)).ravel()
                nodes = below[below < len(self.levels[depth - 1][1])]
        return self.order[nodes]


def link(points: list[np.ndarray], sizes: np.ndarray, percent: int, sets: list[np.ndarray] | None = None) -> Sets:
    """Join all points whose bound reaches ``percent``, or with ``sets`` all sets whose similarity does."""
    tree = CountTree(coarse := np.stack([folded(p, GROUPS) for p in points]), sizes, percent)
    joined = Sets(len(sizes))
    for x in range(len(sizes)):
        near = tree.search(coarse[x], sizes[x])
        near = near[near > x]
        while len(near := near[joined.of[near] != joined.of[x]]):
            y, near = int(near[0]), near[1:]
            need = percent * (sizes[x] + sizes[y])
            if (g := min(len(points[x]), len(points[y]))) > GROUPS and (100 + percent) * np.minimum(folded(points[x], g), folded(points[y], g)).sum() < need:
                continue
            if sets is not None and (100 + percent) * len(np.intersect1d(sets[x], sets[y], assume_unique=True)) < need:
                continue
            joined.join(x, y)
    return joined


def near(members: DataFrame, classed: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b) that join the classes of each unit whose points come near enough."""
    rows = members.withColumn("k", F.ceil(F.col("m") / UNIT).cast("int")).drop("m").join(classed.select("cls", "n", "point"), "cls")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, at in whole_groups(batches, ["unit", "i", "j"]):
            cls, n = t.column("cls").to_numpy(), t.column("n").to_numpy()
            point = [loaded(x, k) for x, k in zip(t.column("point").to_pylist(), n.tolist(), strict=True)]
            for lo, hi in zip(at, [*at[1:], t.num_rows], strict=True):
                joined = link(point[lo:hi], n[lo:hi], percent)
                if (joined.of != np.arange(len(joined.of))).any():
                    yield star(joined, cls[lo:hi])

    return paged(rows, "k").repartition("unit", "i", "j").sortWithinPartitions("unit", "i", "j").mapInArrow(search, "a long, b long")


def holding(docs: DataFrame, ids: DataFrame, inside: bool = True) -> DataFrame:
    """The rows of ``docs`` whose doc_id may be among ``ids`` (or with ``inside`` false the others, whose doc_id surely
    isn't), by a bitmap of bounded size, so that the join that decides needs to shuffle few texts."""
    bits = min(MAX_BITS, max(1 << 20, 1 << int(16 * ids.count()).bit_length()))
    parts = 16

    def place(b: pa.RecordBatch, name: str) -> np.ndarray:
        return (mix(pc.fill_null(column(b, name), -1).to_numpy(zero_copy_only=False).astype(np.int64).view(_U)) & _U(bits - 1)).astype(np.int64)

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(bits, bool)
        for b in batches:
            seen[place(b, "id")] = True
        if seen.any():
            yield pa.RecordBatch.from_pydict({"slice": pa.array(range(parts), pa.int32()), "bits": [np.packbits(x).tobytes() for x in np.split(seen, parts)]})

    def either(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"slice": pdf["slice"][:1], "bits": [np.bitwise_or.reduce([np.frombuffer(x, np.uint8) for x in pdf["bits"]]).tobytes()]})

    some = ids.mapInArrow(marks, "slice int, bits binary").withColumn("part", F.spark_partition_id() % 64).groupBy("slice", "part").applyInPandas(either, "slice int, bits binary")
    found = {r["slice"]: r["bits"] for r in some.groupBy("slice").applyInPandas(either, "slice int, bits binary").collect()}
    table = np.frombuffer(b"".join(found[i] for i in range(parts)), np.uint8) if found else np.zeros(bits // 8, np.uint8)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = place(b, "doc_id")
            yield b.filter(pa.array((table[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == inside))

    return docs.mapInArrow(keep, docs.schema)


def links(docs: DataFrame, rank: np.ndarray, cells: DataFrame, percent: int, size: int = WORDS) -> DataFrame:
    """Edges (a, b) between linked classes; ``cells`` has (rep, cls, n, cell), rep a document of the class."""
    pages = cells.groupBy("cell").agg(F.ceil(F.sum("n") / CELL_WORDS).cast("int").alias("k"))
    some = holding(docs, cells.select(F.col("rep").alias("id")))
    texts = some.join(cells.withColumnRenamed("rep", "doc_id"), "doc_id").select("text", "cls", "cell").join(pages, "cell")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, at in whole_groups(batches, ["cell", "i", "j"]):
            text = t.column("text").combine_chunks()
            keys, begin = ordered_sets(text if isinstance(text, pa.Array) else text.chunk(0), rank, size)
            cls, sizes, point = t.column("cls").to_numpy(), np.diff(begin), points(keys, begin)
            real = names(keys, begin) == cls  # rows that share a doc_id but not the text fall out
            for lo, hi in zip(at, [*at[1:], t.num_rows], strict=True):
                own = lo + np.flatnonzero(real[lo:hi])
                own = own[np.unique(cls[own], return_index=True)[1]]
                if len(own) > 1:
                    joined = link([point[i] for i in own], sizes[own], percent, [keys[begin[i] : begin[i + 1]] for i in own])
                    if (joined.of != np.arange(len(joined.of))).any():
                        yield star(joined, cls[own])

    return paged(texts, "k").repartition("cell", "i", "j").sortWithinPartitions("cell", "i", "j").mapInArrow(verify, "a long, b long")


def grouped(docs: DataFrame, percent: int, size: int) -> tuple[np.ndarray, DataFrame, DataFrame]:
    """The order of shingles, (doc_id, n, cls) of every row, and per class (cls, component_id, front): its component's
    smallest doc_id and, of the classes which that doc_id has there, the smallest."""
    prepare(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rank = frequencies(docs, size)
    rows = stage(classes(docs, rank, size), "shingle-classes")
    reps = rows.where("cls != 0 and doc_id is not null").groupBy("cls").agg(F.min("doc_id").alias("rep"), F.max("n").alias("n"), F.max("point").alias("point"))
    reps = stage(reps, "shingle-reps")
    members = units(stage(shared(prefixes(docs, rank, percent, size)), "shingle-keys"))
    reps, classed = reps.drop("point"), reps
    cells = components(near(members, classed, percent), name="cells").select(F.col("node").alias("cls"), F.col("component").alias("cell"))
    found = components(links(docs, rank, stage(reps.join(cells, "cls"), "shingle-cells"), percent, size), name="links")
    named = reps.join(found.select(F.col("node").alias("cls"), "component"), "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    smallest = named.groupBy("component").agg(F.min(F.struct("rep", "cls")).alias("s")).select("component", F.col("s.rep").alias("component_id"), F.col("s.cls").alias("front"))
    return rank, rows, named.join(smallest, "component").select("cls", "component_id", "front")


def jaccard_groups(docs: DataFrame, *, percent: int = PERCENT, size: int = WORDS) -> DataFrame:
    """Per row of ``docs`` (doc_id, text) its set's size and its component's smallest doc_id."""
    _, rows, of = grouped(docs, percent, size)
    real = F.col("r.cls").eqNullSafe(F.col("c.cls")) & F.col("r.doc_id").isNotNull()
    out = rows.alias("r").join(of.alias("c"), real, "left")
    return out.select("r.doc_id", F.col("r.n").alias("n_shingles"), F.coalesce("c.component_id", "r.doc_id").alias("component_id"))


def first_of_groups(docs: DataFrame, *, percent: int = PERCENT, size: int = WORDS) -> DataFrame:
    """``docs``, all columns, with one row of each group: that of the smallest doc_id. Rows with a null doc_id or
    without words stay. Rows that share a doc_id are decided one by one, each in the group of its own text; if
    the smallest doc_id has several rows in a group, the smallest class stays, and of its rows the first as JSON."""
    rank, rows, of = grouped(docs, percent, size)
    of = stage(of, "shingle-groups")
    placed = rows.where("doc_id is not null").select("doc_id", "cls").join(of, "cls", "left").select("doc_id", F.coalesce("component_id", "doc_id").alias("component_id"))
    ids = stage(placed.groupBy("doc_id").agg(F.count(F.lit(1)).alias("k"), F.min("component_id").alias("component_id")).where("k > 1 or doc_id <> component_id"), "shingle-ids")
    # the ids grow with the input, so they are never broadcast
    gone = ids.select(F.col("doc_id").alias("_gone"))
    out = docs.join(gone.hint("merge"), F.col("doc_id").cast("long") == F.col("_gone"), "left_anti")
    repeated = ids.where("k > 1").select("doc_id")
    if repeated.isEmpty():
        return out
    # a row whose doc_id others have too needs its class
    packed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"))

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([column(b, "doc_id"), pa.array(names(*ordered_sets(column(b, "text"), rank, size))), column(b, "_row")], names=["doc_id", "cls", "_row"])

    kind = StructType([StructField("doc_id", LongType()), StructField("cls", LongType()), packed.schema["_row"]])
    some = holding(packed, repeated.select(F.col("doc_id").alias("id"))).mapInArrow(name, kind).join(repeated.hint("merge"), "doc_id", "left_semi")
    some = stage(some, "shingle-repeated")
    fronts = of.where("cls = front").select(F.col("component_id").alias("doc_id"), "cls")
    first = some.where("cls <> 0").join(fronts.hint("merge"), ["doc_id", "cls"], "left_semi").groupBy("doc_id", "cls").agg(F.min_by("_row", F.to_json("_row")).alias("_row"))
    more = some.where("cls = 0").select("_row").union(first.select("_row"))
    return out.union(more.select(*(F.col(f"_row.`{c}`").alias(c) for c in docs.columns)))


SQL = r"""
with recursive d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents
), s as (
  select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as g from d
), n as (
  select doc_id, count(*) as n from s group by doc_id
), p as (
  select a.doc_id as x, b.doc_id as y, count(*) as shared from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by all
), l as (
  select x, y from p join n nx on nx.doc_id = x join n ny on ny.doc_id = y where 100 * shared >= 80 * (nx.n + ny.n - shared)
), e as (
  select x, y from l union all select y, x from l
), r as (
  select doc_id as x, doc_id as y from d union select r.x, e.y from r join e on r.y = e.x
)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, m.c as component_id
from d left join n on n.doc_id = d.doc_id join (select x, min(y) as c from r group by x) m on m.x = d.doc_id
"""
