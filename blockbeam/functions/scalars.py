"""Column-level helpers (projections and scalar functions).

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so it
stays inside whole-stage codegen; the one exception is the hash branch of
``receiver_key``, which needs RIPEMD-160 (not a Spark built-in) and runs as an
Arrow-batched pandas UDF on the rows that reach that branch only.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

# Fixed values of the ledger format and of the script shapes (must equal the
# reference's for identical receiver keys):
#   pay-to-pubkey-hash:  prefix "76a914", suffix "88ac"
#   pay-to-script-hash:  prefix "a914",   suffix "87"
#   pay-to-pubkey:       suffix "ac" (key = hash160 of the rest)
#   block-file frame magic: 0xd9b4bef9
P2PKH_PREFIX, P2PKH_SUFFIX = "76a914", "88ac"
P2SH_PREFIX, P2SH_SUFFIX = "a914", "87"
P2PK_SUFFIX = "ac"
BLOCK_MAGIC = 0xD9B4BEF9

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- time (PRJ-1, DT-*)

def floor_time(c, grain: int = 60) -> Column:
    """PRJ-1: floor epoch seconds to the grain, ``(t / g) * g`` on integers."""
    c = col_(c)
    return (c - F.pmod(c, F.lit(grain))).cast("long")


def epoch_seconds(ts) -> Column:
    """timestamp_ntz -> epoch seconds (independent of the session time zone)."""
    return F.unix_timestamp(col_(ts)).cast("long")


def epoch_micros(ts) -> Column:
    """timestamp_ntz -> epoch microseconds (independent of the session time zone)."""
    return F.expr(f"timestampdiff(MICROSECOND, {_EPOCH_NTZ}, {_sql(ts)})")


def seconds_to_ntz(c) -> Column:
    """DT-2: epoch seconds -> timestamp_ntz (UTC wall clock, no session zone)."""
    return F.expr(f"{_EPOCH_NTZ} + make_dt_interval(0, 0, 0, {_sql(c)})")


def shift_time(c, seconds: int) -> Column:
    """DT-1: second-offset arithmetic on epoch seconds."""
    return col_(c) + F.lit(int(seconds))


def _sql(c) -> str:
    if isinstance(c, str):
        return f"`{c}`"
    raise TypeError("pass a column name")


# ---------------------------------------------------------------- amounts (PRJ-5)

def to_coins(amount_sat, scale: int = 8) -> Column:
    """PRJ-5: integer base units -> exact DECIMAL coins (sum first, cast to double last)."""
    return (col_(amount_sat).cast(T.DecimalType(28, 0)) / F.lit(10 ** scale)).cast(
        T.DecimalType(28, scale))


# ---------------------------------------------------------------- receivers (STR-1)

def _hash160_hex(hex_str: str) -> str:
    sha = hashlib.sha256(bytes.fromhex(hex_str)).digest()  # text that is no hex fails the job
    return hashlib.new("ripemd160", sha).hexdigest()


@F.pandas_udf(T.StringType())
def hash160_hex(s: pd.Series) -> pd.Series:
    """RIPEMD160(SHA256(bytes)) of a hex string, as lowercase hex. Every row passes here, but
    only non-NULL entries (the scripts that reach the hash branch) are hashed, once for each
    distinct one of a batch."""
    return s.map({x: _hash160_hex(x) for x in s.dropna().unique()}).astype(object).where(s.notna(), None)


def _key_parts(script, strict: bool = False) -> tuple[Column, Column, Column]:
    """(key of the branches that need no hash, whether the script is in the hash branch, what is hashed then)."""
    s = col_(script)
    n = F.length(s)
    p2pkh = s.startswith(P2PKH_PREFIX) & s.endswith(P2PKH_SUFFIX)
    p2sh = s.startswith(P2SH_PREFIX) & s.endswith(P2SH_SUFFIX)
    p2pk = s.endswith(P2PK_SUFFIX) & ~p2pkh & ~p2sh
    if strict:
        p2pk = p2pk & n.isin(2 * 35, 2 * 67)
    inner_p2pkh = F.substring(s, len(P2PKH_PREFIX) + 1, n - len(P2PKH_PREFIX) - len(P2PKH_SUFFIX))
    inner_p2sh = F.substring(s, len(P2SH_PREFIX) + 1, n - len(P2SH_PREFIX) - len(P2SH_SUFFIX))
    plain = F.when(p2pkh, inner_p2pkh).when(p2sh, inner_p2sh).otherwise(s)
    return plain, F.coalesce(p2pk, F.lit(False)), F.substring(s, 1, n - len(P2PK_SUFFIX))


def receiver_key(script, strict: bool = False) -> Column:
    """STR-1: output script (lowercase hex) -> receiver key, as one column.

    Branches in order: P2PKH -> inner 20-byte hash; P2SH -> inner hash; any other
    script ending in "ac" -> hash160 of the script without that suffix (quirk Q7:
    this also catches other shapes; ``strict=True`` limits it to pushed 33/65-byte
    keys); otherwise the script itself. Every row passes the Python hash; for tables of outputs use
    ``operators.receivers.with_receiver_keys``.
    """
    plain, hashed, pub = _key_parts(script, strict)
    return F.when(hashed, hash160_hex(F.when(hashed, pub))).otherwise(plain)


def script_branch(script) -> Column:
    """Name of the receiver-key branch a script takes (STR-3 predicates)."""
    s = col_(script)
    return (F.when(s.startswith(P2PKH_PREFIX) & s.endswith(P2PKH_SUFFIX), F.lit("p2pkh"))
            .when(s.startswith(P2SH_PREFIX) & s.endswith(P2SH_SUFFIX), F.lit("p2sh"))
            .when(s.endswith(P2PK_SUFFIX), F.lit("p2pk"))
            .otherwise(F.lit("other")))


# ---------------------------------------------------------------- misc scalars

def hex_lower(binary) -> Column:
    """STR-2: bytes -> lowercase hex."""
    return F.lower(F.hex(col_(binary)))


def symbol_normalise(c) -> Column:
    """STR-7: pair symbol "A/B" -> "A-B"."""
    return F.replace(col_(c), F.lit("/"), F.lit("-"))


def threshold_percent(c) -> Column:
    """MTH-2: fraction -> integer percent label (0.65 -> 65)."""
    return F.round(col_(c) * 100).cast("int")


def csv_line(*cols) -> Column:
    """STR-5: interpolate columns into one comma-separated line."""
    return F.concat_ws(",", *[col_(c).cast("string") for c in cols])


def interval_spine(df, start: str, end: str, step: int):
    """DT-3: split ``[start, end]`` into ``ceil((end - start) / step)`` consecutive
    windows of ``step`` seconds, the last one clipped to ``end``. Each row expands
    to its own windows (an explode), so the work stays with the row's task."""
    n = F.ceil((F.col(end) - F.col(start)) / F.lit(step)).cast("long")
    idx = F.when(n > 0, F.sequence(F.lit(0).cast("long"), n - 1)).otherwise(F.array().cast("array<bigint>"))
    out = df.select("*", F.explode(idx).alias("_i"))
    return out.select(*df.columns, F.col("_i").cast("int").alias("i"),
                      (F.col(start) + F.col("_i") * step).alias("seg_start"),
                      F.least(F.col(start) + (F.col("_i") + 1) * step, F.col(end)).alias("seg_end"))
