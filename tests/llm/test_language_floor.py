"""The language stage rejects languages that it never learned, and no clean text."""

import random

import corpus_pipeline
from blockbeam.llm.common import stage

SCRIPTS = ((0x430, 0x44F), (0x3B1, 0x3C9), (0x3041, 0x3094), (0x4E00, 0x9000))


def test_unlearned_scripts_go_and_clean_texts_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    clean = docs.count()
    assert docs.where("text is null or text = '' or lang is null").count() == 0
    rnd = random.Random(1)
    word = lambda lo, hi: "".join(chr(rnd.randrange(lo, hi)) for _ in range(rnd.randrange(2, 9)))
    foreign = [(-1 - i, " ".join(word(*SCRIPTS[i % 4]) for _ in range(2 if i % 8 < 4 else 40)), None) for i in range(200)]
    both = stage(docs.union(spark.createDataFrame(foreign, docs.schema)), "test-languages")
    kept = corpus_pipeline.language_stage(spark, both, "")
    assert kept.where("doc_id >= 0").count() == clean and kept.where("doc_id < 0").count() <= 1
