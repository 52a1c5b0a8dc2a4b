"""Judging URLs: rules first, then gradient-boosted trees on lexical features.

A rule is a host and a path; it fits its host and all subdomains if the URL's path starts with the rule's, and the
longest fitting rule decides. For all other URLs the trees decide, from length, depth, digit ratio, entropy,
parameter counts and statistics of the host's suffix; they are trained from labelled URLs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import Workspace

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RULES = [  # (verdict, host, path)
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]
# Words in the host of an advertising, gambling, adult or spam site; they label URLs for training.
ABUSE_WORDS = ["casino", "bets", "pills", "spam", "ads", "adult", "porn", "viagra", "xxx", "lottery"]
TRAINING_ROWS = 20_000  # labelled URLs that the trees are fitted on, at most
TREES, DEPTH, SEED = 10, 3, 5
BLOCK_FROM = 0.5  # probability of the trees from which a URL is blocked
FEATURES = [
    "url_length", "host_length", "path_length", "depth", "labels", "hyphens", "digit_ratio", "entropy", "parameters",
    "query_length", "fragment", "secure", "suffix_share", "suffix_blocked",
]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host (A-Z lower-cased) after the first ``://`` up to ``/``, ``?``, ``#`` or the end, and the path up to
    ``?``, ``#`` or the end; both empty for null or without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """The longest fitting rule (host and path joined) and its verdict, null if none fits; of equally long ones the
    first in the list."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decision, rule_host, rule_path in sorted(reversed(rules), key=lambda rule: len(rule[1] + rule[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(decision)).otherwise(verdict)
    return name, verdict


def entropy(text: Column) -> Column:
    """Bits per character of a text's own character distribution; 0 for an empty one."""
    size = F.length(text)

    def part(total: Column, character: Column) -> Column:
        share = (size - F.length(F.replace(text, character, F.lit("")))) / size
        return total - share * F.log2(share)

    return F.aggregate(F.filter(F.array_distinct(F.split(text, "")), lambda c: c != ""), F.lit(0.0), part)


def _digits(text: Column) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, "[0-9]", ""))


def _count(text: Column, mark: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))


def _described(urls: DataFrame, url: str) -> DataFrame:
    """``url, host, path, suffix`` and the features that need no statistics."""
    cut = urls.select(*urls.columns, F.coalesce(F.col(url).cast("string"), F.lit("")).alias("url_text"))
    cut = cut.select(*cut.columns, *(c.alias(n) for c, n in zip(host_and_path(F.col("url_text")), ("host", "path"))))
    query = F.regexp_extract("url_text", r"\?([^#]*)", 1)
    size = F.length("url_text")
    numbers = {
        "url_length": size,
        "host_length": F.length("host"),
        "path_length": F.length("path"),
        "depth": F.size(F.filter(F.split("path", "/"), lambda part: part != "")),
        "labels": F.size(F.split("host", r"\.")),
        "hyphens": _count(F.col("host"), "-"),
        "digit_ratio": _digits(F.col("url_text")) / F.greatest(size, F.lit(1)),
        "entropy": entropy(F.col("url_text")),
        "parameters": F.size(F.filter(F.split(query, "&"), lambda part: part != "")),
        "query_length": F.length(query),
        "fragment": F.col("url_text").contains("#").cast("int"),
        "secure": F.col("url_text").startswith("https://").cast("int"),
    }
    return cut.select(
        *cut.columns,
        F.substring_index("host", ".", -1).alias("suffix"),
        *(column.cast("double").alias(name) for name, column in numbers.items()),
    )


def label_by_words(urls: DataFrame, url: str = "url", words: Sequence[str] = ABUSE_WORDS) -> DataFrame:
    """``url, blocked`` for training: 1 if a word of the host (between dots and hyphens) is on the list, else 0."""
    host, _ = host_and_path(F.col(url).cast("string"))
    hit = F.arrays_overlap(F.split(host, "[.-]"), F.array(*map(F.lit, words)))
    return urls.where(F.col(url).isNotNull()).select(F.col(url).alias("url"), hit.cast("int").alias("blocked"))


class UrlFilter:
    """Trees and suffix statistics, fitted on labelled URLs."""

    def __init__(self, trees: GBTClassificationModel | None, suffixes: DataFrame):
        self.trees, self.suffixes = trees, suffixes

    def probability(self, urls: DataFrame, url: str) -> DataFrame:
        """``urls`` with ``host, path, blocked_probability``; 0 everywhere if there were no two classes to learn."""
        described = _described(urls, url)
        if self.trees is None:
            scored = described.withColumn("blocked_probability", F.lit(0.0))
        else:
            scored = self.trees.transform(_vectors(described, self.suffixes))
            scored = scored.withColumn("blocked_probability", vector_to_array("probability")[1])
        return scored.select(*urls.columns, "host", "path", "blocked_probability")


def _vectors(described: DataFrame, suffixes: DataFrame) -> DataFrame:
    joined = described.join(suffixes, "suffix", "left").fillna(0.0, ["suffix_share", "suffix_blocked"])
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(joined)


def train_filter(urls: DataFrame, labelled: DataFrame, work: Workspace, url: str = "url") -> UrlFilter:
    """Fit the trees on at most ``TRAINING_ROWS`` of ``labelled`` (``url, blocked`` 0 or 1; others are ignored),
    chosen by a hash of the URL, repeated URLs once.

    The share of each suffix is counted over all ``urls``; its share of blocked URLs over the training rows.
    Without both classes there is nothing to learn, and the filter blocks nothing.
    """
    rows = labelled.where("blocked in (0, 1) and url is not null").groupBy("url").agg(F.max("blocked").alias("blocked"))
    rows = rows.withColumn("at", F.xxhash64("url", F.lit(SEED))).orderBy("at", "url").limit(TRAINING_ROWS)
    rows = work.keep(_described(rows.select("url", "blocked"), "url"))
    host, _ = host_and_path(F.coalesce(F.col(url).cast("string"), F.lit("")))
    counts = urls.select(F.substring_index(host, ".", -1).alias("suffix")).groupBy("suffix").agg(F.count("*").alias("rows"))
    counts = work.keep(counts)
    learnt = rows.groupBy("suffix").agg(((F.sum("blocked") + 1) / (F.count("*") + 2)).alias("suffix_blocked"))
    total = counts.agg(F.sum("rows")).first()[0] or 1
    share = (F.col("rows") / F.lit(float(total))).alias("suffix_share")
    suffixes = work.keep(counts.join(learnt, "suffix", "left").select("suffix", share, "suffix_blocked"))
    if rows.select("blocked").distinct().count() < 2:
        return UrlFilter(None, suffixes)
    learner = GBTClassifier(labelCol="blocked", featuresCol="features", maxIter=TREES, maxDepth=DEPTH, seed=SEED)
    return UrlFilter(learner.fit(_vectors(rows, suffixes).select("features", "blocked")), suffixes)


def judge_urls(
    pages: DataFrame, labelled: DataFrame | None = None, rules: Sequence[tuple[str, str, str]] = RULES,
    page_id: str = "page_id", url: str = "url",
) -> DataFrame:
    """A verdict on every URL: the longest fitting rule's, else the trees'.

    One row per page: ``page_id, host, path, rule`` (null if none fits), ``verdict`` (allow or block),
    ``blocked_probability`` (of the trees). A null URL, or one without ``://``, has an empty host and path and is
    judged by the trees like any other. Without labelled URLs they are labelled by ``label_by_words``. Repeated
    rows and null ids are judged each for itself; other columns are ignored; an empty table gives an empty result.
    """
    plain = pages.select(F.col(page_id).alias("page_id"), F.col(url).cast("string").alias("page_url"))
    if labelled is None:
        labelled = label_by_words(plain, "page_url")
    with Workspace(pages.sparkSession, "urls") as work:
        scored = train_filter(plain, labelled, work, "page_url").probability(plain, "page_url")
        rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
        learnt = F.when(F.col("blocked_probability") >= BLOCK_FROM, F.lit("block")).otherwise(F.lit("allow"))
        return work.result(
            scored.select(
                "page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, learnt).alias("verdict"),
                "blocked_probability",
            )
        )
