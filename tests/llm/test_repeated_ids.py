"""Rows that share a doc_id in the near-duplicate stage."""

from collections import Counter

from pyspark.sql import functions as F

from blockbeam.llm import shingles
from tests.llm.conftest import frame


def test_first_of_groups_with_repeated_ids(spark):
    text = {c: " ".join(f"{c}{k}" for k in range(40)) for c in "ABCDEFG"}
    near = text["E"] + " more"
    rows = [
        *[(3, text["A"]), (7, text["A"]), (7, text["B"])],  # 7's other text is alone
        *[(5, text["C"]), (9, text["C"]), (5, text["D"]), (2, text["D"])],  # 5 is first of one group only
        *[(11, text["E"]), (11, text["E"]), (11, text["E"].lower()), (11, near), (12, near)],  # 11 has a whole group
        *[(20, text["F"]), (20, text["F"]), (21, None), (21, ""), (21, text["G"]), (None, text["A"]), (None, text["A"])],
    ]
    docs = frame(spark, [(i, t, "en", "a") for i, t in rows])
    got = Counter((r.doc_id, t if (t := r.text) is None else t.upper().removesuffix(" MORE")) for r in shingles.first_of_groups(docs.withColumn("m", F.create_map(F.lit("k"), F.lit(1)))).collect())
    assert got == Counter([(3, text["A"]), (7, text["B"]), (5, text["C"]), (2, text["D"]), (11, text["E"]), (20, text["F"]), (21, None), (21, ""), (21, text["G"]), (None, text["A"]), (None, text["A"])])
