"""Registered queries: scalar functions (STR-1..7, MTH-1, MTH-2, DT-3).

Scripts for the receiver-key function are derived from lineitem: P2PKH around the
part key, P2SH around the supplier key, a witness-like script around the order
key, and (hash branch, rows-only check) a pushed 33-byte key ending in "ac".
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as X
from ..operators import receivers as R
from . import standins as S
from .catalog import query
from .q_receivers import train
from .sqlviews import CANDLES, OUTS, POP, RAW, epoch, with_


def _hex(c, width):
    return F.lpad(F.lower(F.hex(F.col(c))), width, "0")


def _scripts(spark, sf, with_hash_branch: bool):
    li = S.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    p2pkh = F.concat(F.lit("76a914"), _hex("l_partkey", 40), F.lit("88ac"))
    p2sh = F.concat(F.lit("a914"), _hex("l_suppkey", 40), F.lit("87"))
    other = F.concat(F.lit("0014"), _hex("l_orderkey", 38), F.lit("01"))
    p2pk = F.concat(F.lit("21"), _hex("l_partkey", 66), F.lit("ac"))
    branch = F.col("l_linenumber") % 3
    script = (F.when(branch == 1, p2pkh).when(branch == 2, p2sh)
              .otherwise(p2pk if with_hash_branch else other))
    return li.select("l_orderkey", "l_linenumber", script.alias("script"))


_SCRIPTS_SQL = """scripts AS (
  SELECT l_orderkey, l_linenumber,
         CASE l_linenumber % 3
           WHEN 1 THEN '76a914' || lpad(lower(hex(l_partkey)), 40, '0') || '88ac'
           WHEN 2 THEN 'a914' || lpad(lower(hex(l_suppkey)), 40, '0') || '87'
           ELSE '0014' || lpad(lower(hex(l_orderkey)), 38, '0') || '01' END AS script
  FROM lineitem)"""


@query("receiver_key", with_(_SCRIPTS_SQL) + """
SELECT l_orderkey, l_linenumber, script,
       CASE WHEN starts_with(script, '76a914') AND suffix(script, '88ac') THEN substr(script, 7, length(script) - 10)
            WHEN starts_with(script, 'a914') AND suffix(script, '87') THEN substr(script, 5, length(script) - 6)
            ELSE script END AS receiver FROM scripts""")
def q_receiver_key(spark, sf):
    """STR-1, branches 1, 2 and 4 (inner hash of P2PKH / P2SH; other scripts unchanged)."""
    s = _scripts(spark, sf, with_hash_branch=False)
    return s.select("l_orderkey", "l_linenumber", "script", X.receiver_key("script").alias("receiver"))


# Public keys and their published hash160 (the curve's generator, compressed and not; the key that the
# first block pays; the key of the worked example of an address).
PUBLIC_KEYS = (
    ("0279be667ef9dcbbac55a06295ce870b07029bfcdb2dce28d959f2815b16f81798",
     "751e76e8199196d454941c45d1b3a323f1433bd6"),
    ("0479be667ef9dcbbac55a06295ce870b07029bfcdb2dce28d959f2815b16f81798"
     "483ada7726a3c4655da4fbfc0e1108a8fd17b448a68554199c47d08ffb10d4b8",
     "91b24bf9f5288532960ac687abb035127b1d28a5"),
    ("04678afdb0fe5548271967f1a67130b7105cd6a828e03909a67962e0ea1f61deb6"
     "49f6bc3f4cef38c4f35504e51ec112de5c384df7ba0b8d578a4c702b6bf11d5f",
     "62e907b15cbf27d5425399ebf6f0fb50ebb88f18"),
    ("0450863ad64a87ae8a2fe83c1af1a8403cb53f53e486d8511dad8a04887e5b2352"
     "2cd470243453a299fa9e77237716103abc11a1df38855ed6f2ee187e9c582ba6",
     "010966776006953d5567439e5e39f86a0d273bee"),
)
_VECTOR = f"l_partkey % {len(PUBLIC_KEYS)}"


@query("receiver_key_hash", f"""WITH vectors(k, key, hash) AS (VALUES {", ".join(f"({i}, '{k}', '{h}')" for i, (k, h) in enumerate(PUBLIC_KEYS))}),
scripts AS (
  SELECT l_orderkey, l_linenumber, {_VECTOR} AS k, CASE l_linenumber % 3
           WHEN 1 THEN '76a914' || lpad(lower(hex(l_partkey)), 40, '0') || '88ac'
           WHEN 2 THEN 'a914' || lpad(lower(hex(l_suppkey)), 40, '0') || '87' END AS hashed
  FROM lineitem)
SELECT l_orderkey, l_linenumber, coalesce(hashed, key || 'ac') AS script,
       CASE l_linenumber % 3 WHEN 1 THEN substr(hashed, 7, 40) WHEN 2 THEN substr(hashed, 5, 40) ELSE hash END AS receiver,
       CASE l_linenumber % 3 WHEN 1 THEN 'p2pkh' WHEN 2 THEN 'p2sh' ELSE 'p2pk' END AS branch
FROM scripts JOIN vectors USING (k)""")
def q_receiver_key_hash(spark, sf):
    """STR-1 with the pay-to-pubkey branch, by a dictionary of distinct scripts: a third of the rows pay to one
    of four public keys whose hash160 is published, the others as in ``receiver_key``."""
    keys = F.array(*[F.lit(k + "ac") for k, _ in PUBLIC_KEYS])
    li = S.table(spark, sf, "lineitem")
    s = li.select("l_orderkey", "l_linenumber", F.when(F.col("l_linenumber") % 3 == 1, F.concat(F.lit("76a914"), _hex("l_partkey", 40), F.lit("88ac")))
                  .when(F.col("l_linenumber") % 3 == 2, F.concat(F.lit("a914"), _hex("l_suppkey", 40), F.lit("87")))
                  .otherwise(F.element_at(keys, (F.expr(_VECTOR) + 1).cast("int"))).alias("script"))
    return R.with_receiver_keys(s).withColumn("branch", X.script_branch("script"))


@query("receiver_key_branches", with_(_SCRIPTS_SQL.replace("'0014' || lpad(lower(hex(l_orderkey)), 38, '0') || '01'",
                                                          "'21' || lpad(lower(hex(l_partkey)), 66, '0') || 'ac'")) + """
SELECT CASE l_linenumber % 3 WHEN 1 THEN 'p2pkh' WHEN 2 THEN 'p2sh' ELSE 'p2pk' END AS branch, count(*) AS n,
       count(DISTINCT script) AS n_keys, 40::BIGINT AS min_chars, 40::BIGINT AS max_chars, 0::BIGINT AS n_unchanged
FROM scripts GROUP BY 1""")
def q_receiver_key_branches(spark, sf):
    """STR-1 per branch, the hash branch included: every script gets a key of 20 bytes, and
    different scripts get different keys."""
    s = _scripts(spark, sf, with_hash_branch=True)
    keyed = R.with_receiver_keys(s, name="key").select("script", "key", X.script_branch("script").alias("branch"))
    return keyed.groupBy("branch").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("key").alias("n_keys"),
        F.min(F.length("key")).cast("long").alias("min_chars"), F.max(F.length("key")).cast("long").alias("max_chars"),
        F.count_if(F.col("key") == F.col("script")).alias("n_unchanged"))


@query("hex_ids", """
SELECT o_orderkey, sha256(CAST(o_orderkey AS VARCHAR)) AS txid,
       length(sha256(CAST(o_orderkey AS VARCHAR))) // 2 AS n_bytes FROM orders""")
def q_hex_ids(spark, sf):
    """STR-2: bytes -> lowercase hex (transaction ids as SHA-256 digests)."""
    o = S.table(spark, sf, "orders").select("o_orderkey")
    raw = F.unhex(F.sha2(F.col("o_orderkey").cast("string"), 256))
    return o.select("o_orderkey", X.hex_lower(raw).alias("txid"), F.octet_length(raw).cast("long").alias("n_bytes"))


@query("script_prefix_suffix", with_(_SCRIPTS_SQL) + """
SELECT l_orderkey, l_linenumber, starts_with(script, '76a914') AS p2pkh_prefix, suffix(script, '88ac') AS p2pkh_suffix,
       starts_with(script, 'a914') AS p2sh_prefix, suffix(script, '87') AS p2sh_suffix, suffix(script, 'ac') AS ends_ac,
       CAST(length(script) AS INTEGER) AS n_chars, substr(script, 1, 4) AS head FROM scripts""")
def q_script_prefix_suffix(spark, sf):
    """STR-3: startsWith / endsWith / substring / length on output scripts."""
    s = _scripts(spark, sf, with_hash_branch=False)
    c = F.col("script")
    return s.select("l_orderkey", "l_linenumber", c.startswith("76a914").alias("p2pkh_prefix"),
                    c.endswith("88ac").alias("p2pkh_suffix"), c.startswith("a914").alias("p2sh_prefix"),
                    c.endswith("87").alias("p2sh_suffix"), c.endswith("ac").alias("ends_ac"),
                    F.length(c).alias("n_chars"), F.substring(c, 1, 4).alias("head"))


_LINE_SQL = """lines AS (SELECT l_orderkey, l_linenumber,
  CAST(l_orderkey AS VARCHAR) || ',' || CAST(l_partkey AS VARCHAR) || ',' || CAST(l_suppkey AS VARCHAR) || ',' ||
  CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) || ',' || l_returnflag AS line FROM lineitem)"""


def _lines(spark, sf):
    li = S.table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", X.csv_line(
        "l_orderkey", "l_partkey", "l_suppkey", F.col("l_extendedprice").cast("decimal(18,2)"),
        "l_returnflag").alias("line"))


@query("format_csv_line", with_(_LINE_SQL) + "SELECT l_orderkey, l_linenumber, line FROM lines")
def q_format_csv_line(spark, sf):
    """STR-5: interpolate fields into one comma-separated line."""
    return _lines(spark, sf)


@query("split_items", with_(_LINE_SQL) + """
SELECT l_orderkey, l_linenumber, string_split(line, ',')[2] AS part, string_split(line, ',')[5] AS flag,
       CAST(len(string_split(line, ',')) AS INTEGER) AS n_items FROM lines""")
def q_split_items(spark, sf):
    """STR-4: split(",") and item access."""
    parts = F.split(F.col("line"), ",")
    return _lines(spark, sf).select("l_orderkey", "l_linenumber", parts.getItem(1).alias("part"),
                                    parts.getItem(4).alias("flag"), F.size(parts).alias("n_items"))


@query("text_casts", with_(_LINE_SQL) + """
SELECT l_orderkey, l_linenumber,
       CAST(string_split(line, ',')[1] AS BIGINT) AS orderkey, CAST(string_split(line, ',')[3] AS INTEGER) AS suppkey,
       CAST(string_split(line, ',')[4] AS DOUBLE) AS price, TRY_CAST(string_split(line, ',')[5] AS INTEGER) AS bad
FROM lines""")
def q_text_casts(spark, sf):
    """STR-6: string -> long / int / double; a failing cast gives NULL (try_cast)."""
    parts = F.split(F.col("line"), ",")
    return _lines(spark, sf).select(
        "l_orderkey", "l_linenumber", parts.getItem(0).cast("long").alias("orderkey"),
        parts.getItem(2).cast("int").alias("suppkey"), parts.getItem(3).cast("double").alias("price"),
        parts.getItem(4).try_cast("int").alias("bad"))


@query("symbol_normalise", """
SELECT c_custkey, replace(c_mktsegment || '/' || CAST(c_nationkey AS VARCHAR), '/', '-') AS symbol FROM customer""")
def q_symbol_normalise(spark, sf):
    """STR-7: pair symbol "A/B" -> "A-B"."""
    c = S.table(spark, sf, "customer")
    return c.select("c_custkey", X.symbol_normalise(
        F.concat(F.col("c_mktsegment"), F.lit("/"), F.col("c_nationkey").cast("string"))).alias("symbol"))


@query("integer_math", f"""
SELECT o_orderkey, {epoch('o_orderdate')} // 3600 AS hours_since_epoch, {epoch('o_orderdate')} % 3600 AS rem,
       CAST(ceil(o_totalprice / 300) AS BIGINT) AS n_requests, o_orderkey - o_custkey AS diff,
       o_totalprice / 1000 AS ratio FROM orders""")
def q_integer_math(spark, sf):
    """MTH-1: integer floor division, remainder, ceil, difference, ratio."""
    o = S.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice",
                                           X.epoch_seconds("o_orderdate").alias("t"))
    return o.select("o_orderkey", F.expr("t div 3600").alias("hours_since_epoch"),
                    F.pmod("t", F.lit(3600)).alias("rem"),
                    F.ceil(F.col("o_totalprice") / 300).alias("n_requests"),
                    (F.col("o_orderkey") - F.col("o_custkey")).alias("diff"),
                    (F.col("o_totalprice") / 1000).alias("ratio"))


@query("threshold_percent", with_(OUTS, CANDLES, RAW, POP) + """
SELECT receiver, CAST(round(fraction * 100) AS INTEGER) AS pct FROM pop""")
def q_threshold_percent(spark, sf):
    """MTH-2: fraction -> integer percent label."""
    pop = R.receiver_popularity(train(spark, sf))
    return pop.select("receiver", X.threshold_percent("fraction").alias("pct"))


_STEP = 300 * 3600  # 300 candles of one hour per request


@query("interval_spine", f"""
WITH r AS (SELECT c_nationkey AS nation, min({epoch('o_orderdate')}) AS s, max({epoch('o_orderdate')}) AS e
           FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1)
SELECT nation, CAST(i AS INTEGER) AS i, s + i * {_STEP} AS seg_start, least(s + (i + 1) * {_STEP}, e) AS seg_end
FROM r, LATERAL (SELECT unnest(range(0, CAST(ceil((e - s) / {_STEP}) AS BIGINT))) AS i)""")
def q_interval_spine(spark, sf):
    """DT-3: split each nation's order-date range into request windows of
    300 x 1 hour, the last one clipped to the end."""
    o = S.table(spark, sf, "orders").select("o_custkey", X.epoch_seconds("o_orderdate").alias("t"))
    c = S.table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("nation"))
    r = o.join(c, o.o_custkey == c.c_custkey).groupBy("nation").agg(F.min("t").alias("s"), F.max("t").alias("e"))
    return X.interval_spine(r, "s", "e", _STEP).select("nation", "i", "seg_start", "seg_end")
