"""A training corpus from the table of documents: language ID, line dedup, near-duplicate removal,
mixing and packing. Each stage is written as Parquet and read again as the next one's documents.

Stages take (spark, docs, sf_dir). All but the last return the columns of ``docs``, whatever they are; null, empty,
very long and repeated rows, empty tables and extra columns are handled as the operators' docstrings
say.
"""

from __future__ import annotations

import math
from statistics import NormalDist

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from blockbeam.llm import language, lines, mixing, packing, shingles
from blockbeam.llm.common import prepare, read, stage

#: A cosine that unrelated vectors of this length reach by chance (one standard deviation).
CHANCE = 1 / math.sqrt(language.DIM)
#: How often a text that resembles no language may pass.
PASSING = 1e-4


def floor(languages: int) -> float:
    """A cosine that the largest of so many chance cosines reaches in a share of at most ``PASSING`` texts."""
    return NormalDist().inv_cdf(1 - PASSING / max(languages, 1)) * CHANCE


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject texts without a letter and those that resemble no language more than chance would. A few words can't
    reach that surely: of short texts in learned letters, those below one chance deviation go."""
    prepare(spark)
    train = docs.where(~language.held_out("doc_id")).select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    langs, protos = language.prototypes(train)
    return language.accepted(docs, langs, protos, min_score=floor(len(langs)), short_score=CHANCE, known=language.alphabet(train))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut the lines that ten documents or more share; n_chars follows the text."""
    out = lines.dropped(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest doc_id of each group of near-duplicates."""
    return shingles.first_of_groups(docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take each source to its target, in training order."""
    return mixing.mixed(docs)


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, packed into sequences."""
    return packing.packing(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language", language_stage),
    ("lines", line_stage),
    ("near_duplicates", near_duplicate_stage),
    ("mix", mix_stage),
    ("pack", pack_stage),
]

#: Hashed vectors, trees and a tokenizer are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents of ``sf_dir``."""
    prepare(spark)
    docs = read(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
