"""Short license notices: every copy is reported, whatever stands between and wherever words differ."""

import random

import pytest

from blockbeam.llm import licenses
from tests.llm.conftest import frame

SHORT = [n for n in licenses.TEMPLATES if n.endswith("-notice")]


def brute(text, name):
    """The best alignment of the whole text that covers enough, then the best beside it, and so on."""
    template = licenses.words_of(licenses.TEMPLATES[name])
    need = -(-licenses.PERCENT * len(template) // 100)
    out = []

    def look(lo, hi):
        best = min(licenses.ends(text, template, need, lo, hi, -len(template), len(text)), default=None) if hi - lo >= need else None
        if best:
            out.append((name, -best[1], best[2], best[3]))
            look(lo, best[2])
            look(best[3], hi)

    look(0, len(text))
    return out


def scan(spark, texts):
    got = {i: [] for i in range(len(texts))}
    for r in licenses.license_scan(frame(spark, [(i, t, "", "") for i, t in enumerate(texts)])).collect():
        if r.license in SHORT:
            got[r.doc_id].append((r.license, r.n_matched, r.start_word, r.end_word))
    return got


def test_copies_and_edits(spark):
    mit, apache = licenses.TEMPLATES["MIT-notice"], licenses.TEMPLATES["Apache-2.0-notice"]
    texts = [" ".join([mit] * 300), f"{apache} {apache}", f"{mit} a b c {mit}", "Released under MIT License", "Released under an MIT License"]
    got = scan(spark, texts)
    assert [len(got[i]) for i in range(5)] == [300, 2, 2, 1, 1]
    assert [(x[1], x[3] - x[2]) for x in got[0]] == [(5, 5)] * 300


@pytest.mark.parametrize("seed", [1, 2])
def test_short_notices_equal_brute_force(spark, seed):
    rnd = random.Random(seed)
    texts = []
    for _ in range(80):
        out = []
        for _ in range(rnd.randrange(1, 7)):
            w = licenses.words_of(licenses.TEMPLATES[rnd.choice(SHORT)])
            for _ in range(rnd.randrange(4)):
                at = rnd.randrange(len(w))
                w[at : at + rnd.randrange(2)] = rnd.choice([[], ["x"], ["the"], ["x", "y"]])
                w = w or ["x"]
            out += w + ["z"] * rnd.choice([0, 0, 1, 3, 30])
        texts.append(" ".join(out))
    got = scan(spark, texts)
    for i, t in enumerate(texts):
        assert sorted(got[i]) == sorted(x for n in SHORT for x in brute(licenses.words_of(t), n)), t
