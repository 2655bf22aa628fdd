"""Line dedup where a third of the rows has no doc_id, and many share one."""

import hashlib
import random
from collections import Counter

from blockbeam.llm import lines
from tests.llm.conftest import frame


def test_rows_without_doc_id_do_not_meet(spark):
    rnd = random.Random(12)
    common = [f"Common line {k}" for k in range(30)]
    rows = []
    for i in range(600):
        text = "\n".join(rnd.choice([*common, f"own {i} {rnd.random()}"]) for _ in range(rnd.randrange(1, 12)))
        rows.append((None if i % 3 == 0 else 7 if i % 3 == 1 else i, text, "en", "a"))
    rows += [rows[0]] * 50
    held = Counter()
    for _, t, *_ in rows:
        held.update({x.strip().lower() for x in t.split("\n")} - {""})
    want = Counter()
    for i, t, *_ in rows:
        kept = [x for x in t.split("\n") if held[x.strip().lower()] < 10]
        want[i, t.count("\n") + 1, t.count("\n") + 1 - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()] += 1
    docs = frame(spark, rows)
    assert Counter(map(tuple, lines.line_dedup(docs).collect())) == want
    # no group of keys grows with the rows that share an id: each holds the keys of one text
    found = lines.drops(docs)
    assert found.count() > 300
    assert max(len(r.common) for r in found.collect()) <= 12
