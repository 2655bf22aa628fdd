"""Chronological cuts and splits without a global row number.

A cut is the n-th smallest key, found with ``orderBy(key).limit(n)`` (Spark plans
it as a per-task top-n plus a merge, of at most ``MERGED`` keys: a cut further on is narrowed down by counting) and a
``max`` over it, evaluated as a scalar subquery; rows are then labelled by comparing their key with the cut, a
narrow projection. The big table is never funnelled through one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..sinks.staging import staged


#: Keys that a top-n may merge in one task; a cut further on is narrowed down first.
MERGED = 100_000
#: Cuts that one pass counts, and keys that are sampled for them.
CUTS, SAMPLED = 32, 2_000


def _key(cols: Sequence[str]) -> Column:
    return F.col(cols[0]) if len(cols) == 1 else F.struct(*cols)


def nth_key(df: DataFrame, cols: Sequence[str] | str, n: int, distinct: bool = True,
            fewer: str = "error", merged: int = MERGED) -> Column:
    """SRT-5: the n-th smallest (1-based) value of ``cols`` as a scalar column.

    With fewer than n values the query fails (``fewer="error"``), or the largest one is returned
    and everything falls on the lower side of the cut (``"last"``). A top-n merges its n keys in one task; beyond
    ``merged`` of them, ``narrowed`` first finds a range of at most so many that holds the n-th.
    """
    cols = [cols] if isinstance(cols, str) else list(cols)
    keys = df.select(_key(cols).alias("_k"))
    if distinct:
        keys = keys.distinct()
    if n > merged:
        keys, n = narrowed(keys, n, merged)
    last = F.max("_k")
    if fewer == "error":
        last = F.when(F.count(F.lit(1)) < n, F.raise_error(F.lit(f"fewer than {n} values to cut at"))).otherwise(last)
    return keys.orderBy("_k").limit(n).agg(last).scalar()


def narrowed(keys: DataFrame, n: int, merged: int = MERGED) -> tuple[DataFrame, int]:
    """Distributed selection: a range of the keys ``_k`` of at most ``merged`` rows, or of equal ones, that holds the n-th, and its
    place there. Each pass counts the keys below some sampled ones (partial aggregates) and goes on
    between two of them; the keys are staged once. With fewer than n keys, the upper end and a place beyond it."""
    kind = keys.schema["_k"].dataType
    # wrapped, so that null keys compare like in a sort: first
    keys = staged(keys.select(F.struct("_k").alias("_w")), "keys")
    spark = keys.sparkSession
    inside, place = keys, n

    def literal(v) -> Column:
        one = spark.createDataFrame([(v,)], T.StructType([T.StructField("_k", kind)]))
        return one.select(F.struct("_k")).scalar()

    rows = inside.count()
    while rows > merged:
        some = inside.sample(min(1.0, SAMPLED / rows), seed=rows % 1000).collect()
        found = sorted({r["_w"]["_k"] for r in some}, key=lambda v: [(x is not None, x) for x in (v if isinstance(v, tuple) else (v,))])
        if not found:
            continue
        step = max(1, len(found) // CUTS)
        cuts = [(v, literal(v)) for v in found[::step]]
        told = inside.agg(*[f.alias(f"{c}{j}") for j, (_, at) in enumerate(cuts) for c, f in (
            ("lt", F.count_if(F.col("_w") < at)), ("le", F.count_if(F.col("_w") <= at)))]).first()
        lower, passed = None, 0
        for j, (_, at) in enumerate(cuts):
            if told[f"le{j}"] < place:
                lower, passed = at, told[f"le{j}"]
        upper = next(((j, at) for j, (_, at) in enumerate(cuts) if told[f"le{j}"] >= place), None)
        if upper is not None and told[f"lt{upper[0]}"] < place:  # the cut itself
            inside, place = inside.filter(F.col("_w") == upper[1]).limit(1), 1
            break
        if lower is not None:
            inside = inside.filter(F.col("_w") > lower)
        if upper is not None:
            inside = inside.filter(F.col("_w") < upper[1])
        place -= passed
        rows = (told[f"lt{upper[0]}"] if upper is not None else rows) - passed
    return inside.select("_w._k"), place


def temporal_split(df: DataFrame, time_col: str, cutoff: Column, label: str = "split") -> DataFrame:
    """FLT-1: ``train`` when ``time <= cutoff`` else ``test``."""
    return df.withColumn(label, F.when(F.col(time_col) <= cutoff, F.lit("train")).otherwise(F.lit("test")))


def chronological_split(df: DataFrame, order_cols: Sequence[str], n_train: int, n_valid: int,
                        label: str = "split", embargo: int = 0) -> DataFrame:
    """SRT-4 / SET-1 / SET-2 made deterministic (quirk Q3): order by ``order_cols``
    (unique, time first), first ``n_train`` rows are train, the next ``n_valid`` valid, the
    rest test. Returned as one table with a ``split`` column.

    ``embargo`` (seconds, quirk Q4): training rows less than ``embargo`` before the
    first non-training row are labelled ``embargo`` instead of train, so labels that
    look ahead (e.g. 4 hours) cannot reach past the cut."""
    k = _key(order_cols)
    c1 = nth_key(df, order_cols, n_train, distinct=False, fewer="last")
    c2 = nth_key(df, order_cols, n_train + n_valid, distinct=False, fewer="last")
    train = k <= c1
    if embargo:
        t = order_cols[0]
        first_after = df.filter(_key(order_cols) > c1).select(F.min(t)).scalar()
        train_kept = train & (first_after.isNull() | (F.col(t) <= first_after - F.lit(int(embargo))))
        return df.withColumn(label, F.when(train_kept, F.lit("train")).when(train, F.lit("embargo"))
                             .when(k <= c2, F.lit("valid")).otherwise(F.lit("test")))
    return df.withColumn(label, F.when(train, F.lit("train")).when(k <= c2, F.lit("valid"))
                         .otherwise(F.lit("test")))


def first_n(df: DataFrame, order_cols: Sequence[str], n: int) -> DataFrame:
    """SRT-4: the first n rows of an ordered table (top-n, no full sort)."""
    return df.orderBy(*order_cols).limit(n)


def except_rows(df: DataFrame, other: DataFrame) -> DataFrame:
    """SET-1: EXCEPT DISTINCT (planned as a null-safe anti join plus aggregate)."""
    return df.subtract(other)


def ordinal(df: DataFrame, col: str) -> DataFrame:
    """WIN-6: 0-based ordinal of each distinct value of ``col`` (``zipWithIndex`` on
    the sorted distinct values), via the distributed row index."""
    from .windows import row_index
    return row_index(df.select(col).distinct(), [col], "ordinal")
