"""URL filters: rules by host and path, and gradient-boosted trees on lexical features for the URLs that no rule fits.

A rule (host, path, verdict) fits a URL whose host is the rule's host or a subdomain of it, and whose path starts
with the rule's; the longest rule (``host + path``) wins, then the one with the longer host. The rules are a curated list that
is written into the plan.

Features: lengths of URL, host, path and query, depth (slashes of the path), share of digits, entropy of the URL's bytes,
parameter count, dots and hyphens of the host, and statistics of four endings: the host's last label, its last
two labels, the file extension and the path's first segment. A statistic is the log-odds of block among the labelled
URLs with the same value, and the log of their count, both rounded coarsely: finer ones would tell apart a value's folds, and so
what is left out of them. Values are hashed into ``BUCKETS`` buckets, so these tables, which
count *all* labelled URLs, have a fixed size and are broadcast.

Training: labelled URLs are a table of (url, block). The trees (``pyspark.ml`` GBTClassifier) are fitted on at most
about ``MAX_LABELLED`` of them, by a hash of the URL. A training row's statistics leave out its own fold, so the
trees don't learn from a row's own label. The sample is put into one partition and sorted, so that a rerun fits the same trees.
The query labels URLs by the rules themselves: what a rule blocks or allows teaches the trees what to do elsewhere.

Defined results: host and path of a null URL, or one without ``://``, are empty; such URLs have features like others. Every row is
judged on its own, so repeated rows get equal results and a null page_id is kept. If the labelled URLs are all of
one kind, that is the verdict; with none, it is allow. Extra columns are ignored.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType

from .common import prepare, stage


class Rule(NamedTuple):
    host: str
    path: str
    block: bool


#: Fixed values of the contract.
RULES = (Rule("com", "/", False), Rule("example.com", "/en/", True), Rule("www.example.com", "/en/", False), Rule("net", "/es/", True), Rule("net", "/fr/", True))

#: Buckets of each ending's statistics.
BUCKETS = 1 << 16
#: The trees are fitted on about so many labelled URLs at most.
MAX_LABELLED = 20_000
#: Rows of a fold don't count in its own rows' statistics.
FOLDS = 5
#: Weight of the overall share of block in an ending's log-odds.
PRIOR = 4.0
#: Fixed sizes of the model; a leaf needs LEAF rows.
TREES, DEPTH, STEP, LEAF = 30, 4, 0.2, 10

ENDINGS = ("label", "site", "extension", "section")
LEXICAL = ("url_length", "host_length", "path_length", "query_length", "depth", "digit_ratio", "entropy", "parameters", "dots", "hyphens")
FEATURES = [*LEXICAL, *(f"{e}_{k}" for e in ENDINGS for k in ("odds", "count"))]


@F.arrow_udf(DoubleType())
def byte_entropy(url: pa.Array) -> pa.Array:
    """Entropy (bits) of the bytes of each string."""
    data, n = url.cast(pa.large_binary()), len(url)
    offsets = np.frombuffer(data.buffers()[1], np.int64, n + 1, data.offset * 8)
    out = np.zeros(n)
    # some rows at a time: 256 counts each, and about a million bytes
    at = 0
    while at < n:
        to = max(at + 1, min(at + 1000, int(np.searchsorted(offsets, offsets[at] + (1 << 20), side="right")) - 1))
        size = np.diff(offsets[at : to + 1])
        held = np.frombuffer(data.buffers()[2], np.uint8)[offsets[at] : offsets[to]] if size.any() else np.zeros(0, np.uint8)
        count = np.bincount(np.repeat(np.arange(to - at), size) * 256 + held, minlength=256 * (to - at)).reshape(-1, 256)
        p = count / np.maximum(size, 1)[:, None]
        out[at:to] = -(p * np.log2(np.where(p > 0, p, 1))).sum(1)
        at = to
    return pa.array(np.abs(out))


def split_url(urls: DataFrame) -> DataFrame:
    """Add host and path of the column ``url``."""
    part = lambda k: F.regexp_extract(F.coalesce("url", F.lit("")), r"(?s)^.*?://([^/?#]*)([^?#]*)", k)
    return urls.withColumns({"host": F.translate(part(1), string.ascii_uppercase, string.ascii_lowercase), "path": part(2)})


def fits(rule: Rule) -> Column:
    host = F.col("host")
    return ((host == rule.host) | host.endswith("." + rule.host)) & F.col("path").startswith(rule.path)


def by_rules(urls: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Add ``rule`` (host and path of the rule that decides, else null) and ``ruled`` (whether it blocks)."""
    order = sorted(rules, key=lambda r: (-len(r.host + r.path), -len(r.host), r))
    name = F.coalesce(*[F.when(fits(r), r.host + r.path) for r in order], F.lit(None).cast("string"))
    block = F.coalesce(*[F.when(fits(r), r.block) for r in order], F.lit(None).cast("boolean"))
    return urls.withColumns({"rule": name, "ruled": block})


def lexical(urls: DataFrame) -> DataFrame:
    """Add the lexical features and the endings' buckets to rows with ``url``, ``host`` and ``path``."""
    url = F.coalesce("url", F.lit(""))
    # one trailing slash doesn't make another page
    last = F.regexp_extract("path", r"(?s)([^/]*)/?$", 1)
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    n = F.length(url)
    ending = {
        "label": F.substring_index("host", ".", -1),
        "site": F.substring_index("host", ".", -2),
        "extension": F.regexp_extract(last, r"\.([^.]*)$", 1),
        "section": F.regexp_extract("path", r"^/([^/]*)", 1),
    }
    return urls.withColumns({
        "url_length": n, "host_length": F.length("host"), "path_length": F.length("path"), "query_length": F.length(query),
        "depth": F.regexp_count("path", F.lit("/")),
        "digit_ratio": F.regexp_count(url, F.lit("[0-9]")) / F.greatest(n, F.lit(1)),
        "entropy": byte_entropy(url),
        "parameters": F.regexp_count(query, F.lit("[^&;]+")),
        "dots": F.regexp_count("host", F.lit(r"\.")), "hyphens": F.regexp_count("host", F.lit("-")),
        **{f"{k}_bucket": F.pmod(F.xxhash64(F.lit(k), v), F.lit(BUCKETS)).cast("int") for k, v in ending.items()},
    })


class UrlFilter:
    """Trees and statistics learned from labelled URLs."""

    def __init__(self, share: float, counts: dict[str, DataFrame], model: GBTClassificationModel | None) -> None:
        self.share, self.counts, self.model = share, counts, model

    @staticmethod
    def with_statistics(rows: DataFrame, counts: dict[str, DataFrame], share: float, fold: Column | None = None) -> DataFrame:
        """Add the endings' statistics, without the rows' own fold if there is one."""
        for e, table in counts.items():
            rows = rows.join(F.broadcast(table), F.col(f"{e}_bucket") == F.col(f"{e}_key"), "left")
            block, n = (F.coalesce(F.aggregate(f"{e}_{c}", F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0)) for c in ("blocks", "rows"))
            if fold is not None:
                block, n = ((x - F.coalesce(F.element_at(f"{e}_{c}", fold + 1), F.lit(0))) * (FOLDS / (FOLDS - 1)) for x, c in ((block, "blocks"), (n, "rows")))
            odds = F.log((block + PRIOR * share) / (n - block + PRIOR * (1 - share)))
            rows = rows.withColumns({f"{e}_odds": F.round(odds * 4) / 4, f"{e}_count": F.round(F.log2(n + 1))}).drop(f"{e}_key", f"{e}_blocks", f"{e}_rows")
        return rows

    @classmethod
    def fit(cls, labelled: DataFrame, max_labelled: int = MAX_LABELLED) -> UrlFilter:
        """``labelled``: url and block (boolean)."""
        rows = lexical(split_url(labelled.select("url", "block"))).withColumn("fold", F.pmod(F.xxhash64("url", F.lit("fold")), F.lit(FOLDS)).cast("int"))
        total = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("block").alias("blocks")).first()
        share = total["blocks"] / total["n"] if total["n"] else 0.0
        if share in (0.0, 1.0):
            return cls(share, {}, None)
        # at most BUCKETS rows for each ending, each with a count for every fold
        in_fold = [(F.count_if((F.col("fold") == k) & F.col("block")), F.count_if(F.col("fold") == k)) for k in range(FOLDS)]
        ends = rows.select("fold", "block", F.explode(F.array(*[F.struct(F.lit(e).alias("ending"), F.col(f"{e}_bucket").alias("key")) for e in ENDINGS])).alias("at"))
        table = stage(ends.groupBy("at.ending", "at.key").agg(F.array(*[b for b, _ in in_fold]).alias("blocks"), F.array(*[n for _, n in in_fold]).alias("rows")), "url-endings")
        counts = {e: table.where(F.col("ending") == e).select(*(F.col(c).alias(f"{e}_{c}") for c in ("key", "blocks", "rows"))) for e in ENDINGS}
        some = rows
        if total["n"] > max_labelled:
            some = rows.where(F.pmod(F.xxhash64("url", F.lit("sample")), F.lit(1 << 31)) < int((1 << 31) * max_labelled / total["n"]))
        # the sample alone goes to one partition; a coalesce would take the scan along
        told = cls.with_statistics(some, counts, share, F.col("fold")).select("url", F.col("block").cast("double").alias("label"), *FEATURES)
        train = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(told).repartition(1).sortWithinPartitions("url", "label").select("features", "label")
        trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, minInstancesPerNode=LEAF, seed=11, cacheNodeIds=False)
        return cls(share, counts, trees.fit(train))

    def judged(self, urls: DataFrame) -> DataFrame:
        """Add ``block`` (the trees' verdict) to rows with ``url``, ``host`` and ``path``."""
        if self.model is None:
            return urls.withColumn("block", F.lit(self.share == 1.0))
        rows = self.with_statistics(lexical(urls), self.counts, self.share)
        rows = self.model.transform(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows))
        return rows.select(*urls.columns, (F.col("prediction") == 1.0).alias("block"))


def url_filter(pages: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Judge every row of ``pages`` (page_id, url): the longest rule that fits decides, else trees that learned from
    the URLs that rules decide."""
    prepare(pages.sparkSession)
    urls = by_rules(split_url(pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))), rules)
    model = UrlFilter.fit(urls.where("rule is not null").select("url", F.col("ruled").alias("block")))
    block = F.coalesce("ruled", "block")
    return model.judged(urls).select("page_id", "host", "path", "rule", F.when(block, "block").otherwise("allow").alias("verdict"), F.col("block").alias("method_block"))
