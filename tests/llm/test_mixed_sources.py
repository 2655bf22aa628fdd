"""The mix takes a repeated document from the source that it was taken of."""

from collections import Counter

from blockbeam.llm import mixing
from tests.llm.conftest import frame, words


def test_documents_repeated_under_sources(spark):
    import random

    rnd = random.Random(8)
    texts = [words(rnd, 12) for _ in range(40)]
    docs = frame(spark, [(i % 40, texts[i % 40], "en", s) for s in ("b", "a", None) for i in range(80 if s == "b" else 40)])
    want = Counter()
    for r in mixing.assign(docs, budget=0.4).collect():
        want[r.doc_id, r.source] += sum(x > 0 for x in r.takes)
    got = Counter((r.doc_id, r.source) for r in mixing.mixed(docs, budget=0.4).collect())
    assert got == +want and len({s for _, s in got}) == 3
