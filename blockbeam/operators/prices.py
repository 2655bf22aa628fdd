"""Price series operators: multi-offset lookups, labels, rise flags, deltas.

Lookups (JN-1 ... JN-5) are one equi-join. Each candle is emitted once per offset at the
time that looks it up, an aggregate by time makes one wide row of all offsets (price and
whether a candle is there), and the facts join that table once; whether it is broadcast
or shuffled is left to Spark, by bytes, and doesn't change the rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

MISSING_POLICIES = ("error", "drop", "null")


def _wide(candles: DataFrame, offsets: Mapping[str, int], key_col: str, price_col: str) -> DataFrame:
    """One row per lookup time: per offset the price and a presence flag."""
    emitted = F.explode(F.array(*[F.struct((F.col(key_col).cast("long") - F.lit(int(off))).alias("t"), F.lit(i).alias("i"))
                                  for i, off in enumerate(offsets.values())])).alias("e")
    rows = candles.where(F.col(key_col).isNotNull()).select(F.col(price_col).alias("_p"), emitted)
    cols = [c for i, n in enumerate(offsets) for c in (
        F.max(F.when(F.col("e.i") == i, F.col("_p"))).alias(n),
        F.coalesce(F.bool_or(F.col("e.i") == i), F.lit(False)).alias(f"_has_{n}"))]
    return rows.groupBy(F.col("e.t").alias("_t")).agg(*cols)


def _looked_up(df: DataFrame, candles: DataFrame, offsets: Mapping[str, int], time_col: str,
               key_col: str, price_col: str) -> DataFrame:
    wide = _wide(candles, offsets, key_col, price_col)
    out = df.join(wide, df[time_col] == wide["_t"], "left").drop("_t")
    return out.withColumns({f"_has_{n}": F.coalesce(F.col(f"_has_{n}"), F.lit(False)) for n in offsets})


def with_prices(df: DataFrame, candles: DataFrame, offsets: Mapping[str, int], *,
                time_col: str = "t", key_col: str = "unix", price_col: str = "close",
                missing: str = "error") -> DataFrame:
    """Add one column per offset: the candle ``price_col`` at ``time_col + offset``.

    ``candles`` must be unique on ``key_col`` (see ``sources.candles.latest_by_key``).
    ``missing`` says what an absent candle does: ``"error"`` fails the job (the
    reference's behaviour), ``"drop"`` removes the row (``missing_report`` counts what is
    lost), ``"null"`` keeps it with a NULL price. A candle that is there with a NULL
    price is not absent: its row stays, with a NULL price.
    """
    if missing not in MISSING_POLICIES:
        raise ValueError(f"missing must be one of {MISSING_POLICIES}")
    names = list(offsets)
    out = _looked_up(df, candles, offsets, time_col, key_col, price_col)
    if missing == "drop":
        for n in names:
            out = out.where(F.col(f"_has_{n}"))
    elif missing == "error":
        # a filter, which stays whatever columns a query reads: an assertion in a price column would be pruned with it
        at = F.coalesce(F.col(time_col).cast("string"), F.lit("NULL"))
        for n in names:
            there = F.assert_true(F.col(f"_has_{n}"), F.concat(F.lit(f"no candle for offset {n} at t="), at))
            out = out.where(there.isNull())
    return out.drop(*[f"_has_{n}" for n in names])


def missing_report(df: DataFrame, candles: DataFrame, offsets: Mapping[str, int], *,
                   time_col: str = "t", key_col: str = "unix", price_col: str = "close") -> DataFrame:
    """JN-5: per offset, how many lookups find no candle (what "error" would hit)."""
    looked = _looked_up(df.select(time_col), candles, offsets, time_col, key_col, price_col)
    return looked.agg(F.count(F.lit(1)).alias("n_rows"),
                      *[F.count_if(~F.col(f"_has_{n}")).alias(f"missing_{n}") for n in offsets])


def price_label(later, now) -> F.Column:
    """PRJ-7: 1 if the later price is strictly above the current one, else 0."""
    return F.when(F.col(later) > F.col(now), F.lit(1)).otherwise(F.lit(0))


def rise_flags(df: DataFrame, now: str, later_cols: Mapping[str, str]) -> DataFrame:
    """PRJ-11: one 0/1 column per later price (strict ``>``), named by the mapping keys."""
    return df.withColumns({flag: price_label(col, now) for flag, col in later_cols.items()})


def price_deltas(df: DataFrame, chain: list[str], names: list[str]) -> DataFrame:
    """PRJ-9: successive differences ``chain[i] - chain[i+1]`` named ``names[i]``."""
    if len(names) != len(chain) - 1:
        raise ValueError("need len(chain) - 1 names")
    return df.withColumns({n: F.col(a) - F.col(b) for n, a, b in zip(names, chain[:-1], chain[1:])})
