"""Every operator on odd rows, empty tables and clashing extra columns."""

import pytest

from blockbeam.llm import vectors
from tests.llm.conftest import EXTRA, OPERATORS

PER_ROW = ("quality", "language", "sharding", "mixing", "lines", "dropped", "suffixes", "shingles")


def result(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, docs, name):
    out = OPERATORS[name](docs.where("doc_id < -1"))
    assert out.count() == 0 and out.columns


@pytest.mark.parametrize("name", PER_ROW)
def test_one_row_for_each_row(docs, corpus, name):
    assert OPERATORS[name](docs).count() == len(corpus)


@pytest.mark.parametrize("name", OPERATORS)
def test_extra_columns_with_clashing_names(spark, docs, name):
    from pyspark.sql import functions as F

    small = docs.where("doc_id between 55 and 100 or doc_id is null")
    wide = small.withColumns({c.split()[0]: F.lit(None).cast(c.split()[1]) for c in EXTRA.split(", ")})
    out = OPERATORS[name](wide)
    if "lang" in out.columns:  # rows pass through with all their columns
        assert out.columns == wide.columns
        out = out.select(small.columns)
    assert result(out) == result(OPERATORS[name](small))


@pytest.mark.parametrize("name", [n for n in OPERATORS if n != "packing"])
def test_partitions_do_not_matter(docs, name):
    small = docs.where("doc_id between 50 and 130 or doc_id > 200")
    assert result(OPERATORS[name](small.repartition(5))) == result(OPERATORS[name](small.coalesce(1)))


@pytest.mark.parametrize("kind", ["float", "double"])
def test_vectors(spark, kind):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0, 0.0]), (2, [2.0, 0.0, 0.0]), (3, [0.95, 0.1, 0.0]), (4, [0.0, 1.0, 0.0]), (5, None), (6, []), (7, [0.0, 0.0, 0.0]), (8, [nan, 1.0, 0.0]), (9, [inf, 1.0, 0.0]), (10, [None, 1.0, 0.0]), (11, [1.0, 0.0]), (12, [1.0, -0.0]), (None, [1.0, 0.0, 0.0]), (1, [1.0, 0.0, 0.0]), (13, [1e-30, 0.0, 0.0])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], f"vec_id long, embedding array<{kind}>, cls string")
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in vectors.near_duplicates(df).collect() if r.vec_id is not None)
    same = {1: 4, 2: 4, 3: 4, 13: 4}
    want = [(i, same.get(i, 1 if i in (11, 12) else 0), 1 if i in same else 11 if i in (11, 12) else i) for i, _ in rows if i is not None]
    assert got == sorted((i, n, c, i == c) for i, n, c in want)
    assert vectors.near_duplicates(df.where("vec_id < 0")).count() == 0
    null = vectors.near_duplicates(df.where("vec_id is null")).collect()
    assert [(r.n_links, r.component_id, r.kept) for r in null] == [(0, None, False)]
