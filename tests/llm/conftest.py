import random

import public_tokenizers
import pytest

from blockbeam.llm import language, licenses, lines, mixing, packing, quality, sharding, shingles, suffixes

KIND = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names the operators use inside.
EXTRA = "size int, cls string, _row string, h int, twin int, _bucket int, block int, kept string, trusted int, page int, name string"


def words(rnd, n, size=400):
    return " ".join(f"w{rnd.randrange(size)}" for _ in range(n))


@pytest.fixture(scope="session")
def corpus():
    """(doc_id, text, lang, source): plain texts, copies, near copies, shared lines and passages, and odd rows."""
    rnd = random.Random(5)
    rows = []
    for i in range(60):
        rows.append((i, "\n".join(words(rnd, rnd.randrange(3, 30)) for _ in range(rnd.randrange(1, 8))), rnd.choice(["en", "fr"]), rnd.choice(["a", "b", "c", None])))
    passage = words(rnd, 60)
    for i in range(60, 90):
        rows.append((i, f"{words(rnd, 20)} {passage} {words(rnd, 20)}\n  Shared LINE {i % 2}\t\n{words(rnd, 5)}", "en", "hot"))
    for i in range(90, 120):
        near = rows[60][1].split(" ")
        near[rnd.randrange(len(near))] = "other"
        rows.append((i, " ".join(near) if i % 3 else rows[0][1], "en", "hot"))
    odd = [None, "", " \n\t", "x", "é à", "1 2 3 4", "a b c d e", "\n".join(["same"] * 30), "<|endoftext|> THE|end", "long " * 30_000, words(rnd, 9_000, 9_000), "naïve İstanbul K ́ ﬁ 中文 🙂\x1c y", "z" * 70_000]
    rows += [(200 + i, t, None if i % 2 else "en", None) for i, t in enumerate(odd)]
    rows += [(None, "no id at all here", "en", "a"), (None, None, None, None), rows[3], rows[3], (3, "another text of the same id", "fr", "b")]
    return rows


def frame(spark, rows):
    full = [(i, t, lang, src, None if t is None else len(t)) for i, t, lang, src in rows]
    return spark.createDataFrame(full, KIND).repartition(3)


@pytest.fixture(scope="session")
def docs(spark, corpus):
    return frame(spark, corpus).cache()


TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def trusted(spark):
    return spark.createDataFrame([(i,) for i in (1, 2, 3, 3, None)], "doc_id long")


OPERATORS = {
    "quality": lambda d: quality.quality(d, trusted(d.sparkSession)),
    "language": language.language_id,
    "sharding": sharding.sharding,
    "mixing": mixing.mixing,
    "packing": lambda d: packing.packing(d, TOKENIZER),
    "lines": lines.line_dedup,
    "dropped": lines.dropped,
    "suffixes": suffixes.suffix_dedup,
    "licenses": licenses.license_scan,
    "shingles": shingles.jaccard_groups,
    "first_of_groups": shingles.first_of_groups,
    "mixed": mixing.mixed,
}
