import hashlib


from blockbeam.functions import scalars as X


def h160(hex_str):
    return hashlib.new("ripemd160", hashlib.sha256(bytes.fromhex(hex_str)).digest()).hexdigest()


def test_floor_time_and_threshold_percent(spark):
    df = spark.createDataFrame([(119,), (120,), (1646069459,)], "t long")
    got = [r[0] for r in df.select(X.floor_time("t", 60)).collect()]
    assert got == [60, 120, 1646069400]
    pct = spark.createDataFrame([(t,) for t in (0.9, 0.8, 0.75, 0.7, 0.65)], "x double")
    assert [r[0] for r in pct.select(X.threshold_percent("x")).collect()] == [90, 80, 75, 70, 65]


def test_receiver_key_branches(spark):
    key33 = "02" + "11" * 32
    rows = [
        ("76a914" + "ab" * 20 + "88ac", "ab" * 20),          # P2PKH -> inner hash
        ("a914" + "cd" * 20 + "87", "cd" * 20),              # P2SH -> inner hash
        ("21" + key33 + "ac", h160("21" + key33)),           # ends with ac -> hash160 of the rest
        ("0014" + "ef" * 20, "0014" + "ef" * 20),             # anything else unchanged
        ("0020" + "12" * 31 + "ac", h160("0020" + "12" * 31)),  # quirk Q7: witness ending in ac is hashed
    ]
    df = spark.createDataFrame(rows, "script string, want string")
    got = df.select(X.receiver_key("script").alias("k"), "want").collect()
    assert all(r.k == r.want for r in got), got


def test_receiver_key_strict_leaves_non_key_scripts(spark):
    s = "0020" + "12" * 31 + "ac"
    df = spark.createDataFrame([(s,)], "script string")
    assert df.select(X.receiver_key("script", strict=True)).first()[0] == s


def test_seconds_to_ntz_ignores_session_zone(spark):
    df = spark.createDataFrame([(86400 * 365,)], "u long")
    prev = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        a = df.select(X.seconds_to_ntz("u")).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)
    assert str(a) == "1971-01-01 00:00:00"


def test_interval_spine_even_and_uneven(spark):
    df = spark.createDataFrame([(1, 0, 600), (2, 0, 650), (3, 100, 100)], "k int, s long, e long")
    got = X.interval_spine(df, "s", "e", 300).orderBy("k", "i").select("k", "i", "seg_start", "seg_end").collect()
    assert [tuple(r) for r in got] == [(1, 0, 0, 300), (1, 1, 300, 600),
                                       (2, 0, 0, 300), (2, 1, 300, 600), (2, 2, 600, 650)]


def test_symbol_and_csv_line(spark):
    df = spark.createDataFrame([("BTC/USD", 5, 1.5)], "s string, n int, x double")
    r = df.select(X.symbol_normalise("s"), X.csv_line("s", "n", "x")).first()
    assert r[0] == "BTC-USD" and r[1] == "BTC/USD,5,1.5"


def test_hash160_of_public_vectors(spark):
    # Public keys of the generator point, compressed and not, and their hash160.
    x = "79be667ef9dcbbac55a06295ce870b07029bfcdb2dce28d959f2815b16f81798"
    y = "483ada7726a3c4655da4fbfc0e1108a8fd17b448a68554199c47d08ffb10d4b8"
    want = {"02" + x: "751e76e8199196d454941c45d1b3a323f1433bd6", "04" + x + y: "91b24bf9f5288532960ac687abb035127b1d28a5"}
    df = spark.createDataFrame([(k,) for k in [*want, *want, None]], "k string")
    got = [(r.k, r.h) for r in df.select("k", X.hash160_hex("k").alias("h")).collect()]
    assert got == [(k, want.get(k)) for k in [*want, *want, None]]


def test_keys_by_a_dictionary_equal_the_column(spark):
    from blockbeam.operators.receivers import with_receiver_keys

    key33 = "02" + "11" * 32
    rows = ["76a914" + "ab" * 20 + "88ac", "a914" + "cd" * 20 + "87", "21" + key33 + "ac", "0014" + "ef" * 20, "ac", "", None,
            "0020" + "12" * 31 + "ac"] + ["21" + key33 + "ac"] * 50 + [f"21{k:066x}ac" for k in range(20)]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(rows)], "i int, script string").repartition(3)
    for strict in (False, True):
        a = with_receiver_keys(df, strict=strict)
        assert sorted(map(tuple, a.collect())) == sorted(map(tuple, df.withColumn("receiver", X.receiver_key("script", strict)).collect()))
        plan = a._jdf.queryExecution().executedPlan().toString()
        assert "ArrowEvalPython" not in plan  # the dictionary is staged; no output passes Python
