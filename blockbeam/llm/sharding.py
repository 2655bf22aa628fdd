"""Sharding by a hierarchical weighted hash tree, in DataFrame functions only.

A tree has regions, racks in regions and shards in racks; each shard has a weight, and an inner node
weighs what its shards weigh. A row descends from the root: at every level each child draws
``-ln(u) / weight`` with ``u`` in (0, 1) from a hash of the key and the child's name, and the smallest
draw wins, so children win in proportion to their weights. A draw depends on the child's own name and
weight alone: if weights change, a row moves at a level only into a child that became heavier or out
of one that became lighter, and subtrees whose weights stay keep all rows that they have among
themselves. ``grow`` adds a shard as a region of its own, so that nothing but the new shard takes rows.

Each row also gets a slot, gapless from 0 in its shard: rows are numbered in hash buckets of their
shard, and bucket totals give the offsets. No task sees a whole shard, and no text is shuffled.

Defined results: a null doc_id is a key of its own; its rows share a shard, and their slots follow
their sizes and checksums. A null text has size 8 and checksum 0. Repeated rows each have a slot.
Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import prepare, stage

#: {region: {rack: {shard: weight}}}
Tree = dict[str, dict[str, dict[int, float]]]

#: Hash buckets of a shard in which its rows are numbered.
SLOT_BUCKETS = 4096


def tree(regions: int = 2, racks: int = 3, shards: int = 4) -> Tree:
    """A tree of equal shards, numbered from 0."""
    return {f"region{r}": {f"rack{r}.{k}": {(r * racks + k) * shards + s: 1.0 for s in range(shards)} for k in range(racks)} for r in range(regions)}


def grow(t: Tree, weight: float = 1.0) -> Tree:
    """The tree with one more shard, in a new region."""
    new = 1 + max(s for racks in t.values() for shards in racks.values() for s in shards)
    return t | {f"region+{new}": {f"rack+{new}": {new: weight}}}


def _weight(node) -> float:
    return sum(map(_weight, node.values())) if isinstance(node, dict) else float(node)


def _draw(key: Column, name: str, weight: float) -> Column:
    u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(name)), 11).cast("double") + 0.5) / float(1 << 53)
    return -F.log(u) / F.lit(weight)


def _descend(key: Column, node: dict, name: str) -> Column:
    """The shard that ``key`` reaches below ``node``."""
    children = [(k, f"{name}/{k}", _weight(v)) for k, v in node.items() if _weight(v) > 0]
    if not children:
        raise ValueError(f"{name or 'the tree'} has no weight")
    down = [_descend(key, node[k], path) if isinstance(node[k], dict) else F.lit(int(k)) for k, path, _ in children]
    if len(children) == 1:
        return down[0]
    won = F.array_min(F.array(*(F.struct(_draw(key, path, w).alias("d"), F.lit(i).alias("i")) for i, (_, path, w) in enumerate(children))))["i"]
    if all(not isinstance(node[k], dict) for k, _, _ in children):
        return F.element_at(F.array(*down), won + 1)
    out = F.when(won == 0, down[0])
    for i, x in enumerate(down[1:], 1):
        out = out.when(won == i, x)
    return out


def shard_of(key: Column, t: Tree) -> Column:
    """The shard of a key, as an expression."""
    return _descend(key, t, "").cast("int")


def with_slots(rows: DataFrame, shard: str, spread: list[str], order: list[str], slot: str = "slot", buckets: int = SLOT_BUCKETS) -> DataFrame:
    """Number the rows of each shard gaplessly from 0; ``rows`` must be staged (it is read twice)."""
    rows = rows.withColumn("_bucket", (F.pmod(F.xxhash64(*spread, F.lit("slot")), F.lit(buckets))).cast("int"))
    totals = rows.groupBy(shard, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(shard).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(shard, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_from"))
    inner = Window.partitionBy(shard, "_bucket").orderBy(*order)
    numbered = rows.withColumn("_at", F.row_number().over(inner) - 1)
    return numbered.join(starts, [shard, "_bucket"]).withColumn(slot, (F.col("_from") + F.col("_at")).cast("long")).drop("_bucket", "_at", "_from")


def sharding(docs: DataFrame, t: Tree | None = None) -> DataFrame:
    """Shard every row of ``docs`` (doc_id, text), with the shard it would have with one shard more."""
    prepare(docs.sparkSession)
    t = tree() if t is None else t
    key = F.col("doc_id")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    placed = docs.select(
        key.cast("long").alias("doc_id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).cast("long").alias("text_crc32"),
        F.lit("key").alias("law"),
    ).withColumns({"shard": shard_of(key, t), "grown_shard": shard_of(key, grow(t))})
    placed = stage(placed, "sharding")
    out = with_slots(placed, "shard", ["doc_id", "size", "text_crc32"], ["doc_id", "size", "text_crc32"])
    return out.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
