import pytest

from blockbeam.operators import prices as P
from blockbeam.sources import candles as C


@pytest.fixture
def gap_prices(spark):
    # one-minute candles with 180 missing
    return spark.createDataFrame([(t, float(t)) for t in (0, 60, 120, 240, 300)], "unix long, close double")


@pytest.fixture
def facts(spark):
    return spark.createDataFrame([(0,), (60,), (120,)], "t long")


def test_missing_policies(spark, gap_prices, facts):
    offs = {"p0": 0, "p60": 60}
    drop = P.with_prices(facts, gap_prices, offs, missing="drop")
    assert sorted(tuple(r) for r in drop.collect()) == [(0, 0.0, 60.0), (60, 60.0, 120.0)]
    null = P.with_prices(facts, gap_prices, offs, missing="null")
    assert sorted(tuple(r) for r in null.collect()) == [(0, 0.0, 60.0), (60, 60.0, 120.0), (120, 120.0, None)]
    err = P.with_prices(facts, gap_prices, offs, missing="error")
    with pytest.raises(Exception, match="no candle"):
        err.collect()


def test_an_absent_candle_is_seen_whatever_is_read(gap_prices, facts):
    """No query may lose the check by not reading the price."""
    err = P.with_prices(facts, gap_prices, {"p0": 0, "p60": 60})
    for df in (err.select("t"), err.groupBy("t").count(), err.select("t").distinct(), err.agg({"t": "max"}), err.filter("t > 100").select("t")):
        with pytest.raises(Exception, match="no candle"):
            df.collect()
    assert [r.t for r in P.with_prices(facts.filter("t < 100"), gap_prices, {"p0": 0, "p60": 60}).select("t").orderBy("t").collect()] == [0, 60]


def test_a_candle_with_a_null_price_is_not_absent(spark):
    candles = spark.createDataFrame([(0, 1.0), (60, None)], "unix long, close double")
    facts = spark.createDataFrame([(0,), (60,), (120,)], "t long")
    drop = P.with_prices(facts, candles, {"p0": 0}, missing="drop").collect()
    assert sorted(map(tuple, drop)) == [(0, 1.0), (60, None)]
    ok = P.with_prices(facts.where("t < 100"), candles, {"p0": 0}).collect()
    assert sorted(map(tuple, ok)) == [(0, 1.0), (60, None)]
    assert P.missing_report(facts, candles, {"p0": 0}).first().missing_p0 == 1


def test_one_join_on_the_fact_side(spark, gap_prices, facts):
    plan = P.with_prices(facts, gap_prices, {"a": 0, "b": 60, "c": 120}, missing="null")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1


def test_missing_report(spark, gap_prices, facts):
    r = P.missing_report(facts, gap_prices, {"p0": 0, "p60": 60, "p120": 120}).first()
    assert (r.n_rows, r.missing_p0, r.missing_p60, r.missing_p120) == (3, 0, 1, 1)  # 180 is absent


def test_latest_by_key_and_union_dedupe(spark):
    a = spark.createDataFrame([(0, 1.0, "a"), (60, 2.0, "a")], "unix long, close double, src string")
    b = spark.createDataFrame([(60, 2.0, "a"), (60, 3.0, "b")], "unix long, close double, src string")
    u = C.union_dedupe([a, b])
    assert u.count() == 3  # the repeated boundary row collapses, the differing one stays (Q14)
    best = C.latest_by_key(u, "unix", order=["src"]).orderBy("unix").collect()
    assert [(r.unix, r.close) for r in best] == [(0, 1.0), (60, 3.0)]


def test_labels_flags_deltas(spark):
    df = spark.createDataFrame([(10.0, 10.0, 11.0, 9.0, 8.0, 7.0)], "p0 double, same double, up double, m1 double, m2 double, m3 double")
    r = P.rise_flags(df, "p0", {"f_same": "same", "f_up": "up"}).first()
    assert (r.f_same, r.f_up) == (0, 1)  # strict >
    d = P.price_deltas(df, ["p0", "m1", "m2", "m3"], ["d1", "d2", "d3"]).first()
    assert (d.d1, d.d2, d.d3) == (1.0, 1.0, 1.0)


def test_candle_payload_and_derived(spark):
    df = spark.createDataFrame([('[[60, 1.0, 2.0, 1.5, 1.75, 4.0], [0, 1, 2, 1, 2, 10]]',)], "payload string")
    rows = C.derive_candle_columns(C.parse_candle_payload(df)).orderBy("unix").collect()
    assert [r.unix for r in rows] == [0, 60]
    assert rows[1].vol_fiat == 7.0 and str(rows[1].date) == "1970-01-01 00:01:00"
