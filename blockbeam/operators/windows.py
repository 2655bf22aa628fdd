"""Ordered-series operators without a single-partition window.

* ``row_index``: global 0-based position in an order, computed like
  ``zipWithIndex`` but on DataFrames: range-partition and sort by the order
  columns, number rows inside each partition (``monotonically_increasing_id``
  keeps the record number in its low bits), and add each partition's offset
  from a table of per-partition counts (one row per partition).
* time-framed rolling windows (WIN-1..3): a frame sum is ``P(end) - P(start - 1)``
  over running sums in time order. The merged order of rows and frame ends is cut into
  tiles of about equal size, and one exchange deals rows to tiles; only the ends of frames that cross a
  tile's end travel besides, as narrow rows, and totals, one row per tile. No task holds
  more than its share of rows and ends however dense a time span is, and the cost is linear in the rows (a
  sliding RANGE frame would re-aggregate the whole frame each time its lower end moves).
* row-framed windows (WIN-4, WIN-5, WIN-7): ordinary windows inside each range
  partition; only the last ``k`` rows of a partition are sent on, to the first rows of
  the partitions after it (a table of at most ``k`` x ``k`` rows per partition).

Regression slopes use exact integer sums (x and y scaled to integers, DECIMAL(38,0)
accumulation) and one final double division, so they do not depend on how rows
were partitioned or summed.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from ..sinks.staging import staged

DEC = T.DecimalType(38, 0)
_LOW_BITS = (1 << 33) - 1


#: Input bytes (as stored) that a task of an ordered scan takes on.
TASK_BYTES = 64 << 20


def _n_parts(df: DataFrame) -> int:
    """Range partitions for an ordered scan: by the bytes of the tables that ``df`` reads, and at least the session's
    shuffle partitions. Inputs whose size Spark doesn't know don't count."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    known = sum(s for s in sizes if s < 1 << 60)
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")), -(-known // TASK_BYTES))


def row_index(df: DataFrame, order_cols: Sequence[str], name: str = "idx",
              num_partitions: int | None = None) -> DataFrame:
    """Add a global 0-based row index in the order of ``order_cols`` (make it unique).

    The range-partitioned, sorted table is staged as Parquet so partition ids and record numbers are fixed before
    they are combined, later steps read only the columns they use, and a lost executor recomputes nothing upstream.
    """
    return _numbered(df, order_cols, name, num_partitions).drop("_pid", "_local", "_off", "_cnt")


def _numbered(df: DataFrame, order_cols: Sequence[str], name: str, num_partitions: int | None = None) -> DataFrame:
    """``row_index`` with each row's range partition, place and partition size (_pid, _local, _cnt)."""
    n = num_partitions or _n_parts(df)
    parted = (df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_local", F.monotonically_increasing_id().bitwiseAND(F.lit(_LOW_BITS))))
    parted = staged(parted, "numbered")
    counts = parted.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    offsets = counts.select("_pid", "_cnt", F.coalesce(
        F.sum("_cnt").over(W.orderBy("_pid").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    # one row per partition: always small enough to broadcast
    out = parted.join(F.broadcast(offsets), "_pid")
    return out.withColumn(name, F.col("_local") + F.col("_off"))


def _sent_on(idx: DataFrame, ks: Sequence[int], cols: Sequence[str]) -> DataFrame:
    """(_to, _k, cols): the rows that the ends of range partitions send ``k`` positions on, past
    the end of their own partition. At most ``max(ks)`` rows of a partition send anything, so the
    table grows with the number of partitions and not with the rows."""
    step = F.explode(F.array(*[F.lit(k) for k in ks])).alias("_k")
    ends = idx.filter(F.col("_local") + max(ks) >= F.col("_cnt")).select("_idx", "_local", "_cnt", *cols, step)
    return ends.filter(F.col("_local") + F.col("_k") >= F.col("_cnt")).select(
        (F.col("_idx") + F.col("_k")).alias("_to"), "_k", *cols)


def lags(df: DataFrame, order_cols: Sequence[str], cols: Sequence[str], ks: Sequence[int]) -> DataFrame:
    """WIN-4: ``lag(c, k)`` for each column and k: a window inside each range partition; the first
    ``k`` rows of a partition get theirs from the ends of the partitions before it."""
    ks = list(ks)
    idx = _numbered(df, order_cols, "_idx")
    own = W.partitionBy("_pid").orderBy("_local")
    inner = idx.withColumns({f"{c}_lag{k}": F.lag(c, k).over(own) for k in ks for c in cols})
    got = _sent_on(idx, ks, cols).groupBy("_to").agg(
        *[F.max(F.when(F.col("_k") == k, F.col(c))).alias(f"_got_{c}_{k}") for k in ks for c in cols])
    out = inner.join(F.broadcast(got), F.col("_idx") == F.col("_to"), "left")
    return out.select(*df.columns, *[F.when(F.col("_local") < k, F.col(f"_got_{c}_{k}")).otherwise(
        F.col(f"{c}_lag{k}")).alias(f"{c}_lag{k}") for k in ks for c in cols])


#: Tiles for each shuffle partition, and sampled keys for each tile, of the time-framed windows.
TILES, SAMPLED = 4, 20


class Tiles:
    """Cuts the merged order (key, tag, tiebreak, id) of a series and its frame ends into tiles of about equal
    size, by a sample of about ``SAMPLED`` keys a tile that the driver sorts. Keys that several cuts share (a
    hot time) are cut by the rest of the order."""

    def __init__(self, rows: DataFrame, u: str, frame: int, tail: Sequence[str], tiles: int):
        want, n = tiles * SAMPLED, rows.select(u).count()
        some = rows if n <= want else rows.sample(want / n, seed=11)
        sides = F.explode(F.array(F.struct(F.col(u).cast("long").alias("_key"), F.lit(1).alias("_tag")),
                                  F.struct((F.col(u) + F.lit(frame)).cast("long").alias("_key"), F.lit(0).alias("_tag"))))
        self.sample = some.select(sides.alias("_s"), *tail).select("_s.*", *tail)
        # any keys will do as cuts, so Python's order of odd values doesn't matter
        found = sorted(self.sample.collect(), key=lambda r: [(v is not None, v) for v in r])
        step = max(1, -(-len(found) // tiles))
        self.cuts = found[step::step]
        self.keys = sorted({r["_key"] for r in self.cuts})
        self.tail = ["_tag", *tail]

    def add(self, df: DataFrame, key: str, tag: int, name: str) -> DataFrame:
        """Add each row's tile."""
        from pyspark.ml.feature import Bucketizer
        if not self.keys:
            return df.withColumn(name, F.lit(0))
        ends = [float("-inf"), *map(float, self.keys), float("inf")]
        if len(set(ends)) < len(ends):  # keys beyond 2^53 that are one double
            ends = sorted(set(ends))
        at = [r["_key"] for r in self.cuts]
        upto = [sum(float(k) <= e for k in at) for e in ends[:-1]]  # cuts whose key is at most the bucket's lower end
        df = Bucketizer(splits=ends, inputCol="_bx", outputCol="_b").transform(df.withColumn("_bx", F.col(key).cast("double")))
        tile = F.element_at(F.array(*map(F.lit, upto)), F.col("_b").cast("int") + 1) if upto != list(range(len(upto))) else F.col("_b").cast("int")
        hot = sorted({k for k in at if sum(float(x) == float(k) for x in at) > 1})
        if not hot:
            return df.withColumn(name, tile).drop("_bx", "_b")
        spark, kinds = df.sparkSession, {f.name: f for f in self.sample.schema.fields}
        cut = T.StructType([kinds[c] for c in self.tail])
        table = spark.createDataFrame([(k, [tuple(r[c] for c in self.tail) for r in self.cuts if r["_key"] == k]) for k in hot],
                                      T.StructType([T.StructField("_hk", T.LongType()), T.StructField("_cuts", T.ArrayType(cut))]))
        own = F.struct(F.lit(tag).alias("_tag"), *[F.col(c) for c in self.tail[1:]])
        # at most one row for each cut
        df = df.join(F.broadcast(table), F.col(key).cast("long") == F.col("_hk"), "left")
        above = F.when(F.col("_hk").isNull(), 0).otherwise(F.size(F.filter("_cuts", lambda c: c > own)))
        return df.withColumn(name, tile - above).drop("_bx", "_b", "_hk", "_cuts")


def _frames(df: DataFrame, u: str, frame: int, values: dict[str, Column], lasts: Sequence[str] = (),
            tiebreak: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Running values at each row and at the end of its frame ``[u, u + frame)``, by tiles.

    Rows are dealt by range of time into tiles, in one exchange. A row whose frame ends beyond its tile sends on
    one narrow row, an *end*, to the tile where its frame ends; every other row makes its end in its own tile.
    A tile is sorted once, rows and ends together, and running sums go over it; a row then finds its own end
    in the tile, or else joins it by id. Ids number the rows of the input's partitions: stage an input that might not come in
    the same order twice. ``values`` may use ``_r``, a row's place in its tile (from 1).

    Returns (rows with their end in the tile, rows with their end elsewhere). Rows have ``_r``, ``_S_<k>``, the sums before the
    row in its tile, ``_E_<k>``, those up to the frame's end in the end's tile (``n`` counts rows), and ``_E_<c>``, the latest value
    there. The second have besides ``_Bp_<k>`` and ``_Bq_<k>``, what the tiles before the row's and the end's hold, where
    ``_Bp_place_<k>`` is the sum of a value times its place among all rows, for a value ``place_<k>`` given as ``_r`` times k."""
    n = _n_parts(df)
    rows = df.filter(F.col(u).isNotNull()).withColumn("_id", F.monotonically_increasing_id())
    tail = [*tiebreak, "_id"]
    tiles = Tiles(rows, u, frame, tail, n * TILES)
    rows = rows.withColumns({"_key": F.col(u).cast("long"), "_end": (F.col(u) + F.lit(frame)).cast("long")})
    rows = tiles.add(tiles.add(rows, "_key", 1, "_p"), "_end", 0, "_q")
    here, there = F.struct(F.lit(1).alias("_tag"), F.col("_p").alias("_pid")), F.struct(F.lit(0).alias("_tag"), F.col("_q").alias("_pid"))
    sent = rows.withColumn("_s", F.explode(F.when(F.col("_p") == F.col("_q"), F.array(here)).otherwise(F.array(here, there))))
    narrow = [c for c in df.columns if c not in tiebreak]
    is_row = F.col("_s._tag") == 1
    sent = sent.select("_s.*", "_id", "_key", "_end", "_p", "_q", *tiebreak, *[F.when(is_row, F.col(c)).alias(c) for c in narrow])
    dealt = sent.repartitionByRange(n, "_pid")
    own = F.when((F.col("_tag") == 1) & (F.col("_p") == F.col("_q")), F.array(F.lit(1), F.lit(0))).otherwise(F.array("_tag"))
    both = dealt.withColumn("_side", F.explode(own))
    both = both.withColumn("_at", F.when(F.col("_side") == 1, F.col("_key")).otherwise(F.col("_end")))
    run = W.partitionBy("_pid").orderBy("_at", "_side", *tail).rowsBetween(W.unboundedPreceding, W.currentRow)
    both = both.withColumn("_r", F.sum("_side").over(run))
    row = F.col("_side") == 1
    both = both.withColumns({f"_v_{k}": F.when(row, e) for k, e in values.items()})
    both = both.withColumns({"_R_n": F.col("_r"), **{f"_R_{k}": F.coalesce(F.sum(f"_v_{k}").over(run), F.lit(0)) for k in values},
                             **{f"_R_{c}": F.last(F.when(row, F.col(c)), ignorenulls=True).over(run) for c in lasts}})
    names = ["n", *values, *lasts]
    mine = W.partitionBy("_pid", "_id")
    both = both.withColumns({f"_E_{k}": F.max(F.when(~row, F.col(f"_R_{k}"))).over(mine) for k in names})
    before = {"_S_n": F.col("_r") - F.lit(1), **{f"_S_{k}": F.col(f"_R_{k}") - F.col(f"_v_{k}") for k in values}}
    kept = both.filter(row | (F.col("_p") != F.col("_q"))).select(
        *df.columns, "_id", "_pid", "_p", "_q", "_side", "_r", *[c.alias(k) for k, c in before.items()],
        *[f"_E_{k}" for k in names], *[f"_R_{k}" for k in names])
    held = staged(kept, "frames")
    cols = [*df.columns, "_r", *before, *[f"_E_{k}" for k in names]]
    data = held.filter(F.col("_side") == 1)
    local = data.filter(F.col("_p") == F.col("_q")).select(*cols)
    ends = held.filter(F.col("_side") == 0).select("_id", *[f"_E_{k}" for k in names])
    # dealt by id: rows of a dense span, whose tiles lie close together, spread over all tasks
    far = data.filter(F.col("_p") != F.col("_q")).select("_id", "_p", "_q", *[c for c in cols if not c.startswith("_E_")])
    far = far.join(ends.hint("merge"), "_id").drop("_id")
    offsets = _offsets(held, values, lasts)
    for t in "pq":
        far = far.join(F.broadcast(offsets.toDF(*[f"_{t}" if c == "_pid" else c.replace("_B_", f"_B{t}_") for c in offsets.columns])), f"_{t}")
    return local, far


def _offsets(held: DataFrame, values: dict[str, Column], lasts: Sequence[str]) -> DataFrame:
    """(_pid, _B_<k>): what all tiles before a tile hold. ``TILES`` rows a partition, added up on the driver."""
    names = ["n", *values, *lasts]
    last = F.max_by(F.struct(*[f"_R_{k}" for k in names]), F.struct("_r", "_side"))
    totals = held.groupBy("_pid").agg(last.alias("_t")).select("_pid", "_t.*").orderBy("_pid").collect()
    base, rows = dict.fromkeys(["n", *values], 0) | dict.fromkeys(lasts), []
    for t in totals:
        rows.append((t["_pid"], *[base[k] for k in names]))
        for k in values:
            moved = base["n"] * t[f"_R_{k.removeprefix('place_')}"] if k.startswith("place_") else 0
            base[k] = base[k] + t[f"_R_{k}"] + moved
        base["n"] += t["_R_n"]
        base |= {c: t[f"_R_{c}"] for c in lasts if t[f"_R_{c}"] is not None}
    kinds = {f.name: f.dataType for f in held.schema.fields}
    schema = T.StructType([T.StructField("_pid", kinds["_pid"]), *[T.StructField(f"_B_{k}", kinds[f"_R_{k}"]) for k in names]])
    rows = [tuple(Decimal(v) if isinstance(f.dataType, T.DecimalType) and v is not None else v for v, f in zip(r, schema)) for r in rows]
    return held.sparkSession.createDataFrame(rows, schema)


def _timeless(df: DataFrame, out: DataFrame, u: str) -> DataFrame:
    """Rows without a time have no frame."""
    return out.unionByName(df.filter(F.col(u).isNull()), allowMissingColumns=True)


def _slope(n: Column, sx: Column, sy: Column, sxy: Column, sxx: Column) -> Column:
    """Least-squares slope from exact sums: one double division at the end."""
    num = (n.cast(DEC) * sxy - sx * sy).cast(DEC)
    den = (n.cast(DEC) * sxx - sx * sx).cast(DEC)
    return F.when(den != 0, num.cast("double") / den.cast("double"))


def rolling_slope_reversed(df: DataFrame, u: str, y_int: str, frame: int, tiebreak: Sequence[str] = ()) -> DataFrame:
    """WIN-1: slope of y against row position over the frame ``[u, u + frame)``
    walked latest-first (quirk Q8), i.e. ``regr_slope(y, -rn)``; NULL for a
    single-row frame. ``y_int`` is y scaled to an integer (e.g. cents)."""
    y = F.col(y_int).cast(DEC)
    local, far = _frames(df, u, frame, {"y": y, "place_y": (F.col("_r") * y).cast(DEC)}, tiebreak=tiebreak)
    diff = lambda k, more=None: ((F.col(f"_E_{k}") - F.col(f"_S_{k}")) if more is None else more).cast(DEC).alias(f"_f_{k}")
    # places count from the tile's start; the slope doesn't depend on where they count from
    local = local.select(*df.columns, F.col("_r").alias("_own"), diff("n"), diff("y"), diff("place_y"))
    # up to a point: what the tiles before hold, and the tile's own sums moved by the number of rows before it
    upto = lambda t, p, k: F.col(f"_B{t}_{k}") + F.col(f"_{p}_{k}")
    place = lambda t, p: upto(t, p, "place_y") + F.col(f"_B{t}_n") * F.col(f"_{p}_y")
    far = far.select(*df.columns, (F.col("_Bp_n") + F.col("_r")).alias("_own"), *[
        diff(k, upto("q", "E", k) - upto("p", "S", k)) for k in ("n", "y")], diff("place_y", place("q", "E") - place("p", "S")))
    out = local.unionByName(far)
    # a frame's rows follow one another: their places from its own row on are 0 to n - 1, walked backwards
    n, sy = F.col("_f_n"), F.col("_f_y")
    one, two, six = (F.lit(k).cast(DEC) for k in (1, 2, 6))
    sx = (n * (n - one) / two).cast(DEC)
    sxx = ((n - one) * n * (two * n - one) / six).cast(DEC)
    sxy = (F.col("_f_place_y") - F.col("_own") * sy).cast(DEC)
    out = out.select(*df.columns, _slope(n, (-sx).cast(DEC), sy, (-sxy).cast(DEC), sxx).alias("_slope"))
    return _timeless(df, out, u)


def rolling_sum_forward(df: DataFrame, u: str, y: str, frame: int, name: str = "rolling_sum",
                        tiebreak: Sequence[str] = ()) -> DataFrame:
    """WIN-2: Σ y over ``[u, u + frame)`` (y integer or decimal for an exact sum)."""
    local, far = _frames(df, u, frame, {"y": F.col(y)}, tiebreak=tiebreak)
    inner = F.col("_E_y") - F.col("_S_y")
    out = local.select(*df.columns, inner.alias(name)).unionByName(
        far.select(*df.columns, (inner + F.col("_Bq_y") - F.col("_Bp_y")).alias(name)))
    return _timeless(df, out, u)


def rolling_endpoint_slope(df: DataFrame, u: str, y: str, frame: int, span_seconds: float,
                           name: str = "endpoint_slope", tiebreak: Sequence[str] = ()) -> DataFrame:
    """WIN-3: (current value - latest value in ``[u, u + frame)``) / span."""
    local, far = _frames(df, u, frame, {}, lasts=[y], tiebreak=tiebreak)
    slope = lambda last: ((F.col(y) - last) / F.lit(float(span_seconds))).alias(name)
    out = local.select(*df.columns, slope(F.col(f"_E_{y}"))).unionByName(
        far.select(*df.columns, slope(F.coalesce(F.col(f"_E_{y}"), F.col(f"_Bq_{y}")))))
    return _timeless(df, out, u)


def rolling_slope_rows(df: DataFrame, order_cols: Sequence[str], x_int: str, y_int: str, rows: int,
                       name: str = "slope_rows") -> DataFrame:
    """WIN-7: slope of y on x over the last ``rows`` rows (NULL until that many exist).

    The five sums are windows inside each range partition; the ends of the partitions
    before add what they hold of the first ``rows - 1`` frames.
    """
    x, y = F.col(x_int).cast(DEC), F.col(y_int).cast(DEC)
    terms = {"_n": F.lit(1).cast(DEC), "_sx": x, "_sy": y, "_sxy": (x * y).cast(DEC), "_sxx": (x * x).cast(DEC)}
    idx = _numbered(df, order_cols, "_idx").withColumns({f"_v{t}": e for t, e in terms.items()})
    own = W.partitionBy("_pid").orderBy("_local").rowsBetween(1 - rows, W.currentRow)
    inner = idx.withColumns({f"_w{t}": F.sum(f"_v{t}").over(own) for t in terms})
    got = _sent_on(idx, range(1, rows), [f"_v{t}" for t in terms]).groupBy("_to").agg(
        *[F.sum(f"_v{t}").alias(f"_g{t}") for t in terms]) if rows > 1 else None
    if got is not None:
        inner = inner.join(F.broadcast(got), F.col("_idx") == F.col("_to"), "left")
    total = {t: (F.col(f"_w{t}") + F.coalesce(F.col(f"_g{t}"), F.lit(0).cast(DEC)) if got is not None
                 else F.col(f"_w{t}")).cast(DEC) for t in terms}
    slope = F.when(total["_n"] == rows, _slope(*total.values()))
    return inner.select(*df.columns, slope.alias(name))
