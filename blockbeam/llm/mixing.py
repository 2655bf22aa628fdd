"""Mixing sources to target weights by a time-varying curriculum, in DataFrame functions only.

The sources, in code point order (null last), weigh ``weights`` in turn and share ``budget`` times all
words. No target exceeds ``most`` times its source's size; what a source can't take is shared again
among the others by weight until no target is above.

A source's weight changes over training time t in [0, 1] as ``1 + slope * (2t - 1)``, which
integrates to 1: its cumulative token demand at time t is ``target * (t + slope * (t*t - t))``.
The source's documents stand in a hashed order, repeated as often as the target needs; the words
that lie below the target are taken. The document whose words begin at cumulative demand c is trained
at the t with demand(t) = c (the inverse, a quadratic). The result is range-sorted by that position.

A source's cumulative sums are taken in hash buckets with bucket totals as offsets, so that no task
holds a source; only three sums at a time reach the driver.

Defined results: a null text has size 0 and nothing is taken of it. A null doc_id is ordered by a
hash of its own. Repeated rows are documents of their own. A source without words has target 0.
Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import BLANK_CLASS, BLANKS, prepare, stage

WEIGHTS, BUDGET, MOST = (3, 1, 2), 1.5, 2
#: Slope of each source's weight over time, in turn.
SLOPES = (0.5, -0.5, 0.0)
#: Hex digits of the order hash that make a bucket.
DIGITS = 3


def n_words(text: Column) -> Column:
    """The number of words: every word, with the blanks before it, becomes one character."""
    trimmed = F.rtrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.length(F.regexp_replace(trimmed, f"[{BLANK_CLASS}]*[^{BLANK_CLASS}]+", "x")).cast("long")


def ranked(sources: DataFrame, by: str) -> DataFrame:
    """Number rows from 0 by ``by`` (null last): in range partitions, offset by the partitions' counts."""
    cut = stage(sources.repartitionByRange(F.col(by).asc_nulls_last()).withColumn("_part", F.spark_partition_id()), "ranges")
    counts = cut.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))  # a row for each partition
    starts = counts.withColumn("_from", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    inner = Window.partitionBy("_part").orderBy(F.col(by).asc_nulls_last())
    return cut.withColumn("_at", F.row_number().over(inner) - 1).join(starts, "_part").withColumn("rank", F.col("_from") + F.col("_at")).drop("_part", "_at", "_from")


def turn(values: tuple, rank: Column) -> Column:
    return F.element_at(F.array(*(F.lit(float(v)) for v in values)), (rank % len(values) + 1).cast("int"))


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, budget: float = BUDGET, most: int = MOST, slopes: tuple = SLOPES) -> DataFrame:
    """(source, source_size) -> the same with weight, slope and target. Each round of sharing is one
    aggregate over the sources; a round caps at least one more source or is the last."""
    rows = stage(ranked(sizes, "source").withColumns({"weight": turn(weights, F.col("rank")), "slope": turn(slopes, F.col("rank"))}), "sources")
    cap = F.col("source_size") * most
    level, total = 0.0, None
    while True:
        capped = F.lit(level) * F.col("weight") >= cap
        s = rows.agg(F.sum("source_size").alias("all"), F.sum(F.when(capped, cap)).alias("full"), F.sum(F.when(~capped, F.col("weight"))).alias("open")).first()
        total = total if total is not None else budget * (s["all"] or 0)
        if not s["open"] or (now := (total - (s["full"] or 0)) / s["open"]) <= level:
            break
        level = now
    return rows.withColumn("target", F.least(cap.cast("double"), F.lit(level) * F.col("weight")))


def position(begin: Column, target: Column, slope: Column) -> Column:
    """The time at which the cumulative demand reaches ``begin``."""
    x = F.when(target > 0, begin / target).otherwise(F.lit(0.0))
    rest = F.lit(1.0) - slope
    return F.when(x > 0, F.lit(2.0) * x / (rest + F.sqrt(rest * rest + F.lit(4.0) * slope * x))).otherwise(F.lit(0.0))


def order_hash() -> Column:
    """What the documents of a source are ordered by."""
    return F.md5(F.concat_ws("|", F.lit("mix"), F.col("doc_id").cast("string"), F.when(F.col("doc_id").isNull(), F.md5(F.col("text").cast("string")))))


def assign(docs: DataFrame, weights: tuple = WEIGHTS, budget: float = BUDGET, most: int = MOST, slopes: tuple = SLOPES) -> DataFrame:
    """Add ``size``, ``source_size``, ``target``, ``taken``, and per pass over the source the words taken and
    the training position (arrays ``takes`` and ``positions``, null where nothing is taken)."""
    spark = docs.sparkSession
    prepare(spark)
    text = F.col("text").cast("string")
    rows = stage(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), n_words(text).alias("size"), order_hash().alias("h"), F.crc32(text).alias("c")), "sizes")
    rows = rows.withColumn("bucket", F.substring("h", 1, DIGITS))
    totals = rows.groupBy("source", "bucket").agg(F.sum("size").alias("n"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("source", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    plan = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, budget, most, slopes)
    places = starts.alias("a").join(plan.alias("b"), F.col("a.source").eqNullSafe(F.col("b.source"))).select("a.source", "bucket", "start", "source_size", "target", "slope")
    inner = Window.partitionBy("source", "bucket").orderBy("h", "doc_id", "size", "c").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = rows.withColumn("upto", F.sum("size").over(inner))
    j = run.alias("r").join(places.alias("p"), F.col("r.source").eqNullSafe(F.col("p.source")) & (F.col("r.bucket") == F.col("p.bucket")))
    j = j.select("r.doc_id", "r.source", "r.size", "r.h", "r.c", "p.source_size", "p.target", "p.slope", (F.col("p.start") + F.col("r.upto") - F.col("r.size")).alias("begin"))
    whole = F.floor("target").cast("long")
    takes = F.transform(F.sequence(F.lit(0), F.lit(most - 1)), lambda k: F.greatest(F.lit(0), F.least(F.col("size"), whole - F.col("begin") - k * F.col("source_size"))).cast("long"))
    j = j.withColumn("takes", takes)
    j = j.withColumn("taken", F.aggregate("takes", F.lit(0).cast("long"), lambda a, x: a + x))
    at = F.transform("takes", lambda x, k: F.when(x > 0, position((F.col("begin") + k * F.col("source_size")).cast("double"), F.col("target"), F.col("slope"))))
    return j.withColumn("positions", at)


def mixing(docs: DataFrame, **options) -> DataFrame:
    """One row per document, range-sorted by its first training position (untaken documents last)."""
    rows = assign(docs, **options).select("doc_id", "size", "source_size", "target", "taken", F.element_at("positions", 1).alias("position"))
    return rows.orderBy(F.col("position").asc_nulls_last(), F.col("doc_id").asc_nulls_last())


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: ``docs``, all columns, each row as often as it is taken, range-sorted by training position. Of
    a document that is taken in part, the text has the words taken, with one blank between."""
    spare = [F.col(f"`{c}`") for c in docs.columns]
    # rows that share an order hash and a source are told apart by a number on either side, so that none meets two others
    twin = ["h", "c", "size", "_named", "_source"]
    number = F.row_number().over(Window.partitionBy(*twin).orderBy(*twin))
    source = lambda c: {"_named": c.isNotNull(), "_source": F.coalesce(c, F.lit(""))}
    text = F.col("_row.text").cast("string")
    whole = docs.select(F.struct(*spare).alias("_row"), order_hash().alias("h"), F.crc32(F.col("text").cast("string")).alias("c"), n_words(F.col("text").cast("string")).alias("size"), *(x.alias(k) for k, x in source(F.col("source").cast("string")).items()))
    whole = whole.withColumn("twin", number)
    # the join then keeps the texts where the numbering has put them, by a part of its keys
    docs.sparkSession.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    # numbered before any row is left out, so that both sides number the same rows
    taken = assign(docs, **options).withColumns(source(F.col("source"))).withColumn("twin", number).where("taken > 0")
    taken = taken.select(*twin, "twin", F.explode(F.arrays_zip("takes", "positions")).alias("t")).where("t.takes > 0")
    # neither side is small at scale, so neither is to be broadcast at any size
    rows = whole.join(taken.hint("merge"), [*twin, "twin"])
    cut = F.array_join(F.slice(F.regexp_extract_all(text, F.lit(f"([^{BLANK_CLASS}]+)"), F.lit(1)), 1, F.col("t.takes").cast("int")), " ")
    rows = rows.withColumn("_text", F.when(F.col("t.takes") < F.col("size"), cut).otherwise(text))
    kept = [F.length("_text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col("_text").alias(c) if c == "text" else F.col(f"_row.`{c}`").alias(c) for c in docs.columns]
    # the sort moves each text once: only what is returned goes through it
    rows = rows.select(F.struct(*kept).alias("_out"), F.col("t.positions").alias("_at"), "h", "_named", "_source", "twin").orderBy("_at", "h", "_named", "_source", "twin")
    return rows.select(*(F.col(f"_out.`{c}`").alias(c) for c in docs.columns))


SQL = r"""
with d as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
    md5(concat_ws('|', 'mix', cast(doc_id as varchar), case when doc_id is null then md5(text) end)) as h
  from documents
), s as (
  select source, sum(size)::bigint as source_size, row_number() over (order by source nulls last) - 1 as rk from d group by source
), w as (
  select *, [3.0::double, 1.0::double, 2.0::double][rk % 3 + 1] as weight, [0.5::double, -0.5::double, 0.0::double][rk % 3 + 1] as slope from s
), r as (
  select *, 2 * source_size / weight as ratio from w
), l as (
  select ratio,
    (1.5::double * (select sum(source_size) from w) - coalesce((select sum(2 * b.source_size) from r b where b.ratio < a.ratio), 0)) / (select sum(b.weight) from r b where b.ratio >= a.ratio) as lev
  from r a
), t as (
  select source, source_size, slope, least(2.0::double * source_size, (select max(lev) from l where lev <= ratio) * weight) as target from w
), c as (
  select d.*, t.source_size, t.target, t.slope,
    (sum(d.size) over (partition by d.source order by d.h, d.doc_id, d.size rows between unbounded preceding and current row) - d.size)::bigint as b
  from d join t on d.source is not distinct from t.source
)
select doc_id, size, source_size, target,
  (greatest(0, least(size, floor(target)::bigint - b)) + greatest(0, least(size, floor(target)::bigint - b - source_size)))::bigint as taken,
  case when greatest(0, least(size, floor(target)::bigint - b)) > 0 then
    case when b > 0 then 2.0::double * (b::double / target) / ((1.0::double - slope) + sqrt((1.0::double - slope) * (1.0::double - slope) + 4.0::double * slope * (b::double / target))) else 0.0::double end end as position
from c
"""
