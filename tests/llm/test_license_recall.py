"""Edited license texts are found by fingerprints: recall at 80 % coverage, and how candidates come about."""

import random

import pytest

from blockbeam.llm import licenses as L
from blockbeam.llm.common import Words
from tests.llm.conftest import frame

import pyarrow as pa

LONG = [n for n in L.TEMPLATES if not n.endswith("-notice")]


def edited(rnd, words, kind):
    """About 15 % of the words lost, replaced, or preceded by another; coverage stays at 80 % or more."""
    out = []
    for w in words:
        if rnd.random() >= 0.15:
            out.append(w)
        elif kind == "insert":
            out += [f"q{rnd.randrange(99)}", w]
        elif kind == "replace":
            out.append(f"q{rnd.randrange(99)}")
    return out


@pytest.mark.parametrize("kind", ["insert", "delete", "replace"])
def test_recall_on_edited_texts(spark, kind):
    rnd = random.Random(kind)
    texts, want = [], []
    for name in L.TEMPLATES:
        own = L.words_of(L.TEMPLATES[name])
        need = -(-L.PERCENT * len(own) // 100)
        for _ in range(20):
            words = edited(rnd, own, kind)
            # what a full alignment says, on all diagonals
            best = max((-c[1] for c in L.ends(words, own, need, 0, len(words), -len(own), len(words))), default=0)
            if best >= need:
                want.append((len(texts), name))
                around = [f"z{rnd.randrange(500)}" for _ in range(60)]
                texts.append(" ".join([*around[:30], *words, *around[30:]]))
    got = {(r.doc_id, r.license) for r in L.license_scan(frame(spark, [(i, t, "", "") for i, t in enumerate(texts)])).collect()}
    assert len(want) >= 150
    found = sum(x in got for x in want)
    # measured: all of them
    assert found >= 0.98 * len(want)


def test_every_match_comes_from_a_fingerprint():
    """Without the index there is no candidate; short templates have every word in it, long ones winnowed grams."""
    index = L.Index(L.TEMPLATES)
    text = " x ".join(L.TEMPLATES.values())
    words = Words(pa.array([" ".join(L.words_of(text))]))
    places = index.places(words)
    assert {index.names[t] for _, t, *_ in places} == set(L.TEMPLATES)
    short = {index.names[i] for i in range(len(index.names)) if index.by_place[i]}
    assert short >= {n for n in L.TEMPLATES if n.endswith("-notice")} and "MIT" not in short
    full = sum(len(L.words_of(L.TEMPLATES[n])) for n in L.TEMPLATES if n.endswith("-full"))
    assert 3 in index.parts and sum(index.names[t].endswith("-full") for t in index.parts[3][1].tolist()) < full
    index.parts = {}
    assert index.places(words) == []


def test_given_documents_match_by_fingerprints(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert L.license_scan(docs).count() > 0
