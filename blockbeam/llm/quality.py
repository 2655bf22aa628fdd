"""Quality rules: log-likelihood ratio of hashed n-grams between trusted and raw text.

Two multinomials over ``buckets`` hash buckets of word 1-grams and 2-grams are counted over *all*
documents (raw) and over the documents that labels call good (trusted). A document's score is the
mean over its n-grams of ``log p_trusted - log p_raw``, i.e. the log-likelihood ratio divided by the
number of n-grams. A document is kept if it passes the base rules and its score reaches a threshold
that is the same for all: the quantile ``LOST`` of the honest scores of the trusted documents that pass the base rules
(all of them, not a sample). A trusted document's honest score leaves its own n-grams out of the trusted counts if they
were fitted with it; its plain score would be too good for a threshold on documents that the fit hasn't seen.
Honest scores are counted in steps of 1 / ``STEPS``, so the threshold doesn't depend on the order of rows.

At sf0.1 the threshold keeps all trusted documents, 92 % of the unlabelled and none of those labelled bad (quality 0) that
pass the base rules, and 86 % of the toxic ones, whose few telling words hardly show in a mean over the whole text.

The trusted multinomial may be fitted on a bounded sample of the labelled documents
(``max_trusted``, by a hash of doc_id); the raw one counts every document.

The counts are two arrays of ``buckets`` integers whatever the input's size; they are summed by Spark
per slice of buckets, and only they reach the driver and the tasks.

Defined results: a null text is an empty one (no words, base_failed, not kept). Rows with a null
doc_id are judged like others. Repeated rows give repeated results; in the label table a doc_id is
trusted if any of its rows says so. With no trusted document every score is 0 and the base rules
alone decide. Extra columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import BLANKS, Words, column, counted, mix, prepare, slices, stage, windows

#: Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50

BUCKETS = 1 << 16
#: The trusted multinomial is fitted on about this many labelled documents at most; their ids are broadcast.
MAX_TRUSTED = 50_000
#: The share of trusted documents that the threshold may lose, and the steps in which it is found.
LOST, STEPS = 0.005, 10_000

RESULT = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, score double"
SCORED = RESULT + ", honest double"


def grams(words: Words, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and text of every 1-gram and 2-gram."""
    h = words.hashes()
    pair, at = windows(h, words.doc, 2)
    g = np.concatenate([mix(h), pair])
    return (g % np.uint64(buckets)).astype(np.int64), np.concatenate([words.doc, words.doc[at]])


def dup_lines(text: str) -> int:
    """Lines that hold a word and equal an earlier line."""
    lines = text.split("\n")
    if len(lines) < 2:
        return 0
    lines = [x for x in lines if x.strip(BLANKS)]
    return len(lines) - len(set(lines))


def base(words: Words, texts: list[str]) -> dict[str, np.ndarray]:
    """The base statistics of each text."""
    n = len(texts)
    h = words.hashes()
    three, at = windows(h, words.doc, 3)
    # the text takes part in the key, so that only repeats within one text meet
    key = mix(three ^ mix(words.doc[at].astype(np.uint64)))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    again = np.zeros(len(key), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    covered = np.zeros(len(h) + 2, bool)
    for j in range(3):
        covered[at[again] + j] = True
    out = {
        "n_words": words.count,
        "word_chars": np.array([len(t) - sum(map(t.count, BLANKS)) for t in texts], np.int64),
        "n_symbols": np.array([sum(map(t.count, SYMBOLS)) for t in texts], np.int64),
        "n_dup_lines": np.array([dup_lines(t) for t in texts], np.int64),
        "n_repeat_words": np.bincount(words.doc[covered[: len(h)]], minlength=n).astype(np.int64),
    }
    out["base_failed"] = (out["n_words"] < MIN_WORDS) | (100 * out["n_repeat_words"] > MAX_REPEAT_PERCENT * out["n_words"])
    return out


def gram_counts(docs: DataFrame, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Counts per bucket over all rows, and over those whose column ``trusted`` is true."""

    def count(batch: pa.RecordBatch) -> np.ndarray:
        total = np.zeros((2, buckets), np.int64)
        for b in slices([batch], "text"):
            g, doc = grams(Words(column(b, "text")), buckets)
            good = column(b, "trusted").to_numpy(zero_copy_only=False).astype(bool)
            total[0] += np.bincount(g, minlength=buckets)
            total[1] += np.bincount(g[good[doc]], minlength=buckets)
        return total.ravel()

    return tuple(counted(docs, count, 2 * buckets).reshape(2, buckets))


def log_ratio(raw: np.ndarray, trusted: np.ndarray) -> np.ndarray:
    """log p_trusted - log p_raw by bucket, with one count added to each."""
    if not trusted.any():
        return np.zeros(len(raw))
    return np.log((trusted + 1) / (trusted + 1).sum()) - np.log((raw + 1) / (raw + 1).sum())


def sampled(trusted: DataFrame, most: int) -> DataFrame:
    """The distinct trusted doc_ids, or if there are more than ``most``, about that many by a hash."""
    ids = trusted.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null").distinct()
    n = ids.count()
    return ids if n <= most else ids.where(F.pmod(F.xxhash64("doc_id", F.lit("trusted")), F.lit(1 << 31)) < int((1 << 31) * most / n))


def honest(g: np.ndarray, doc: np.ndarray, n: np.ndarray, raw: np.ndarray, trusted: np.ndarray) -> np.ndarray:
    """Score of each text whose n-grams are among the ``trusted`` counts, with its own left out of them."""
    buckets = len(raw)
    key, count = np.unique(doc.astype(np.int64) * buckets + g, return_counts=True)
    d, b = key // buckets, key % buckets
    own = np.log((trusted[b] - count + 1) / ((trusted + 1).sum() - n[d])) - np.log((raw[b] + 1) / (raw + 1).sum())
    return np.bincount(d, weights=count * own, minlength=len(n)) / np.maximum(n, 1)


def threshold(scored: DataFrame, lost: float) -> float:
    """The honest score that all but the share ``lost`` of the scored rows reach; minus infinity without rows."""
    # a row for each step between the least and the greatest score
    rows = scored.groupBy(F.floor(F.col("honest") * STEPS).alias("step")).agg(F.count(F.lit(1)).alias("n")).orderBy("step").collect()
    left = int(lost * sum(r["n"] for r in rows))
    for r in rows:
        if left < r["n"]:
            return r["step"] / STEPS
        left -= r["n"]
    return float("-inf")


def quality(docs: DataFrame, trusted: DataFrame, *, buckets: int = BUCKETS, max_trusted: int = MAX_TRUSTED, lost: float = LOST) -> DataFrame:
    """Judge every row of ``docs`` (doc_id, text); ``trusted`` holds the doc_ids of trusted documents."""
    prepare(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    good = sampled(trusted, max_trusted).withColumn("trusted", F.lit(True))
    marked = docs.join(F.broadcast(good), "doc_id", "left").select("doc_id", "text", F.coalesce("trusted", F.lit(False)).alias("trusted"))
    raw, told = gram_counts(marked.select("text", "trusted"), buckets)
    table = log_ratio(raw, told)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            text = column(b, "text")
            words = Words(text)
            out = base(words, [t or "" for t in text.to_pylist()])
            g, doc = grams(words, buckets)
            n = np.bincount(doc, minlength=len(text))
            score = np.bincount(doc, weights=table[g], minlength=len(text)) / np.maximum(n, 1)
            own = score.copy()
            fitted = column(b, "trusted").to_numpy(zero_copy_only=False).astype(bool)
            if fitted.any():
                some = fitted[doc]
                own[fitted] = honest(g[some], doc[some], n, raw, told)[fitted]
            yield pa.RecordBatch.from_arrays([column(b, "doc_id"), *(pa.array(x) for x in out.values()), pa.array(score), pa.array(own)], names=[x.split()[0] for x in SCORED.split(", ")])

    scored = stage(marked.mapInArrow(judge, SCORED), "quality")
    ids = trusted.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    limit = threshold(scored.where("not base_failed").join(ids, "doc_id", "left_semi"), lost)
    return scored.drop("honest").withColumn("kept", ~F.col("base_failed") & (F.col("score") >= F.lit(limit)))
