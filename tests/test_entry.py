import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from blockbeam.plans.standins import TABLES

SF = "/root/testdata/sf0.001"


def test_registry_consistent():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 100
    assert "job_block_activity" in o


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns[:2] == ["block_timestamp", "num_txns_in_block"]
    assert df.count() > 0


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", ["job_block_activity", "job_block_features_v2", "job_receiver_scores",
                                 "rolling_slope", "receiver_key", "src_block_rows", "block_lags"])
def test_oracle_sf0001(spark, con, key):
    s = E.queries()[key](spark, SF).toPandas()
    d = con.execute(E.oracle_sql()[key]).df()
    cols = sorted(s.columns)
    assert cols == sorted(d.columns)
    def norm(df):
        rows = [tuple(None if pd.isna(v) else v for v in r)
                for r in df[cols].astype(object).itertuples(index=False, name=None)]
        return sorted(rows, key=lambda r: tuple((v is None, v if v is not None else 0) for v in r))
    assert norm(s) == norm(d)
