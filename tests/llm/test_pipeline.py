"""The pipeline's stages, on odd rows and as a whole."""

import pytest

import corpus_pipeline
from blockbeam.llm import lines, mixing
from blockbeam.llm.common import stage
from tests.llm.conftest import EXTRA


def test_stages_keep_columns_and_take_effect(spark, docs, corpus):
    from pyspark.sql import functions as F

    wide = docs.withColumns({c.split()[0]: F.lit(None).cast(c.split()[1]) for c in EXTRA.split(", ")})
    now = stage(wide, "test-docs")
    counts = []
    for name, step in corpus_pipeline.STAGES[:-1]:
        before = now
        now = stage(step(spark, before, ""), f"test-{name}")
        assert now.columns == wide.columns, name
        counts.append(now.count())
        if name == "language":
            gone = {r.doc_id for r in before.join(now, "doc_id", "left_anti").collect()}
            assert {200, 201, 202, 205} <= gone and not gone & set(range(150))
        if name == "lines":
            assert counts[-1] == counts[-2] and now.where("n_chars <> length(text)").count() == 0
            assert now.where("text like '%Shared LINE%'").count() == 0
            assert lines.line_dedup(before).agg(F.sum("n_dropped")).first()[0] > 0
        if name == "near_duplicates":
            assert 0 < counts[-1] < counts[-2]
        if name == "mix":
            assert now.agg(F.sum(mixing.n_words(F.col("text")))).first()[0] == mixing.mixing(before).agg(F.sum("taken")).first()[0]
    last = corpus_pipeline.STAGES[-1][1](spark, now, "")
    assert last.where("piece = 0").count() == counts[-1] and last.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 4096").count() == 0


def test_empty(spark, docs):
    for name, step in corpus_pipeline.STAGES:
        assert step(spark, stage(docs.where("doc_id < -5"), f"none-{name}"), "").count() == 0


def test_run(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.count() > 100 and "sequence_id" in out.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "lines", "near_duplicates", "mix", "pack"]
