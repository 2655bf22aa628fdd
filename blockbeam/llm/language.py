"""Language identification with hyperdimensional profiles.

Every letter has a random vector of ``DIM`` signs, drawn from a generator that its code point seeds, so
any task draws the same one. A letter 3-gram is bound by multiplying its letters' vectors, permuted
(rotated) by their place: ``rot2(a) * rot1(b) * c``. A text's profile bundles (adds) the vectors of all
its 3-grams; a language's prototype bundles those of its training texts. A text gets the language
whose prototype has the largest cosine with its profile.

Texts are lower-cased; each run of other characters is one blank, and blanks stand at both ends.

Training sends one partial prototype of ``DIM`` integers for each language and task; the prototypes
(languages x ``DIM``) go to the driver and the tasks. The number of languages is checked against
``max_languages`` and more raise an error.

Defined results: a null text, or one without a letter, is ``und`` with score 0; so is every text if
nothing was learned. Equal cosines go to the first language by code point. A null doc_id counts as an
empty string in the fold rule. Repeated rows count and are answered as often as they occur. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import column, prepare, slices

DIM, SEED, MAX_LANGUAGES = 1024, 20_240_607, 2000
BLOCK = 4096  # 3-grams whose vectors are held at once
UNKNOWN = "und"
#: Letters and blanks of a text that is long enough to tell its language, and the share of a letter that counts as learned.
SHORT, RARE = 100, 1e-5
RESULT = "doc_id long, held_out boolean, lang_pred string, score double"


@lru_cache(1)
def letters() -> np.ndarray:
    """Per code point its lower-case letter, or 0 if it is no letter."""
    out = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        s = chr(c)
        if s.isalpha():
            low = s.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


@lru_cache(100_000)
def letter(code: int) -> np.ndarray:
    """The random signs of a letter (0: the blank)."""
    return (np.random.Generator(np.random.Philox(key=[SEED, code])).integers(0, 2, DIM) * 2 - 1).astype(np.int8)


def codes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Letters and blanks of all texts, one after the other, and the text of each."""
    points = [np.frombuffer((f" {t} " if t else "").encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    doc = np.repeat(np.arange(len(texts)), [len(p) for p in points])
    s = letters()[np.concatenate(points)] if points else np.zeros(0, np.uint32)
    again = np.zeros(len(s), bool)
    again[1:] = (s[1:] == 0) & (s[:-1] == 0) & (doc[1:] == doc[:-1])
    return s[~again], doc[~again]


def trigrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct letter 3-grams (rows of three code points), and for each occurrence its 3-gram and its text."""
    s, doc = codes(texts)
    if len(s) < 3:
        return np.zeros((0, 3), np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    known = np.flatnonzero(np.bincount(s))
    place = np.zeros(known[-1] + 1, np.int64)
    place[known] = np.arange(len(known))
    x, a = place[s], len(known)
    one = doc[2:] == doc[:-2]
    key = ((x[:-2] * a + x[1:-1]) * a + x[2:])[one]
    if a**3 <= 1 << 22:
        there = np.flatnonzero(np.bincount(key, minlength=1))
        back = np.zeros(a**3, np.int64)
        back[there] = np.arange(len(there))
        which = back[key]
    else:
        there, which = np.unique(key, return_inverse=True)
    return known[np.stack([there // (a * a), there // a % a, there % a], 1)], which, doc[2:][one]


def bundle(grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """counts (rows x 3-grams) times the bound vectors of the 3-grams; exact in integers below 2**53."""
    out = np.zeros((len(counts), DIM))
    kind = np.float32 if counts.sum(1).max(initial=0) < 1 << 24 else np.float64
    distinct, at = np.unique(grams, return_inverse=True)
    at = at.reshape(grams.shape)
    table = np.stack([letter(int(c)) for c in distinct]) if len(distinct) else np.zeros((0, DIM), np.int8)
    once, twice = np.roll(table, 1, 1), np.roll(table, 2, 1)
    for i in range(0, len(grams), BLOCK):
        g = at[i : i + BLOCK]
        out += counts[:, i : i + BLOCK].astype(kind) @ (twice[g[:, 0]] * once[g[:, 1]] * table[g[:, 2]]).astype(kind)
    return out


def profiles(texts: list[str | None], group: np.ndarray, n: int) -> np.ndarray:
    """Bundled vectors of ``n`` groups of texts."""
    grams, which, doc = trigrams(texts)
    width = len(grams)
    counts = np.bincount(group[doc] * width + which, minlength=n * width).reshape(n, width) if width else np.zeros((n, 0))
    return bundle(grams, counts)


def held_out(doc_id) -> F.Column:
    """The fold kept from training: crc32(doc_id as text) mod 4 is 2."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 4 == 2


def prototypes(train: DataFrame, max_languages: int = MAX_LANGUAGES) -> tuple[list[str], np.ndarray]:
    """Learn from (text, lang): languages by code point and one bundled vector for each."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for b in slices(batches, "text", 1 << 20):
            langs, group = np.unique(np.array(column(b, "lang").to_pylist(), dtype=object), return_inverse=True)
            for name, v in zip(langs, profiles(column(b, "text").to_pylist(), group, len(langs)), strict=True):
                total[name] = total.get(name, 0) + v.astype(np.int64)
        if total:
            yield pa.RecordBatch.from_pydict({"lang": list(total), "v": [v.tobytes() for v in total.values()]})

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"lang": pdf["lang"][:1], "v": [sum(np.frombuffer(x, np.int64) for x in pdf["v"]).tobytes()]})

    parts = train.where("text is not null and lang is not null").mapInArrow(partial, "lang string, v binary")
    some = parts.withColumn("part", F.spark_partition_id() % 64).groupBy("lang", "part").applyInPandas(add, "lang string, v binary")
    rows = some.groupBy("lang").applyInPandas(add, "lang string, v binary").limit(max_languages + 1).collect()
    if len(rows) > max_languages:
        raise ValueError(f"more than {max_languages} languages; clean the labels or raise max_languages")
    # what holds no letter can't be compared
    learned = sorted((r["lang"], np.frombuffer(r["v"], np.int64).astype(float)) for r in rows if np.frombuffer(r["v"], np.int64).any())
    return [x for x, _ in learned], np.stack([v for _, v in learned]) if learned else np.zeros((0, DIM))


def identify(docs: DataFrame, langs: list[str], protos: np.ndarray) -> DataFrame:
    """Predict every row of ``docs`` (doc_id, text) from its text alone."""
    unit = protos / np.linalg.norm(protos, axis=1, keepdims=True) if len(protos) else protos
    names = np.array([*langs, UNKNOWN], dtype=object)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", 1 << 20):
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                texts = column(part, "text").to_pylist()
                n = len(texts)
                best, score = np.full(n, len(langs)), np.zeros(n)
                if langs:
                    v = profiles(texts, np.arange(n), n)
                    length = np.sqrt((v * v).sum(1))
                    # a text of blanks alone has the profile of its blanks, but no letter
                    some = np.array([bool(t) and letters()[np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32)].any() for t in texts], bool) & (length > 0)
                    cosine = np.zeros((n, len(langs)))
                    # rounded, so that the order of adding can't tell
                    cosine[some] = np.round((v[some] @ unit.T) / length[some, None], 9)
                    best[some] = cosine[some].argmax(1)
                    score[some] = np.clip(cosine[some].max(1), 0, 1)
                yield pa.RecordBatch.from_arrays([column(part, "doc_id"), column(part, "held_out"), pa.array(names[best], pa.string()), pa.array(score)], names=["doc_id", "held_out", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out("doc_id").alias("held_out"), F.col("text").cast("string").alias("text")).mapInArrow(predict, RESULT)


def language_id(docs: DataFrame) -> DataFrame:
    """Learn from the rows outside the held-out fold and predict all rows."""
    prepare(docs.sparkSession)
    train = docs.where(~held_out("doc_id")).select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    return identify(docs, *prototypes(train))


def alphabet(train: DataFrame) -> np.ndarray:
    """The code points of the letters that make up ``RARE`` of all letters of the labelled texts or more."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0x110000, np.int64)
        for b in slices(batches, "text", 1 << 20):
            n = np.bincount(codes(column(b, "text").to_pylist())[0])
            total[: len(n)] += n
        total[0] = 0
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["letter", "n"])

    # a row for each letter of Unicode at most
    rows = train.where("text is not null and lang is not null").select("text").mapInArrow(count, "letter int, n long").groupBy("letter").agg(F.sum("n").alias("n")).collect()
    least = RARE * sum(r["n"] for r in rows)
    return np.array(sorted(r["letter"] for r in rows if r["n"] >= least), np.uint32)


def accepted(docs: DataFrame, langs: list[str], protos: np.ndarray, min_score: float, *, short_score: float | None = None, known: np.ndarray | None = None) -> DataFrame:
    """The rows of ``docs``, all columns, whose text has a known language with a cosine of ``min_score`` or more. With
    ``known`` letters, a text of less than ``SHORT`` letters and blanks, too few to tell, needs only ``short_score``
    if half of its letters or more are known."""
    unit = protos / np.linalg.norm(protos, axis=1, keepdims=True) if len(protos) else protos

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", 1 << 20):
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                texts = column(part, "text").to_pylist()
                v = profiles(texts, np.arange(len(texts)), len(texts))
                length = np.sqrt((v * v).sum(1))
                some = np.array([bool(t) and letters()[np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32)].any() for t in texts], bool) & (length > 0)
                best = np.round((v @ unit.T).max(1, initial=-np.inf) / np.where(some, length, 1), 9)
                stay = some & (best >= min_score)
                for i in np.flatnonzero(some & ~stay & (best >= short_score)) if known is not None else ():
                    own = codes([texts[i]])[0]
                    stay[i] = len(own) < SHORT and 2 * np.isin(own[own > 0], known).sum() >= (own > 0).sum()
                yield part.filter(pa.array(stay))

    return docs.mapInArrow(keep, docs.schema)
