"""Secrets in texts: fixed patterns, and character Markov models of random strings and ordinary words.

Two models give the probability of a string's characters, each from the one before: one learnt from random strings,
one from ordinary identifiers and words. The log-likelihood ratio of the two tells a random string, such as a key,
from a name. Long tokens whose ratio is high enough are reported beside the matches of the patterns.

All of it is expressions on columns: models are learnt by counting character pairs, and a text is scanned inside
its own row.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Kind, pattern, group whose length counts, least length.
PATTERNS = [
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", r"AKIA[A-Z0-9]{14,}", 0, 18),  # a maximal run of 18 characters or more
    ("hex", r"[0-9a-f]{16,}", 0, 16),  # a maximal run of 16 characters or more
]
TOKEN = r"[A-Za-z0-9+/_=-]{16,}"  # what the models judge
KINDS = ["assign", "access", "hex", "markov"]
SYMBOLS = "abcdefghijklmnopqrstuvwxyz0#"  # letters in either case, all digits as 0, anything else as #
SAMPLE_DOCS = 2_000  # documents whose words the model of ordinary strings is learnt from, at most
SAMPLE_STRINGS = 4_000  # random strings that the other model is learnt from
SMOOTHING = 0.5  # added to the count of every pair
MEAN_RATIO = 1.2  # least log-likelihood ratio per pair of characters
SUM_RATIO = 24.0  # least log-likelihood ratio of the token
SEED = 3


def symbols(text: Column) -> Column:
    """A text with every character replaced by its symbol."""
    return F.regexp_replace(F.regexp_replace(F.lower(text), "[0-9]", "0"), "[^a-z0]", "#")


def _pair_counts(strings: DataFrame) -> DataFrame:
    """How often each pair of symbols follows one another in the column ``string``."""
    coded = strings.select(symbols(F.col("string")).alias("s")).where(F.length("s") > 1)
    at = F.explode(F.sequence(F.lit(1), F.length("s") - 1)).alias("at")
    pairs = coded.select("s", at).select(F.substring(F.col("s"), F.col("at"), F.lit(2)).alias("pair"))
    return pairs.groupBy("pair").agg(F.count("*").alias("times"))


def _log_probabilities(counts: DataFrame) -> list[float]:
    """Logarithms of the probability of each symbol after each other one; at most one row per pair is gathered."""
    times = {row["pair"]: row["times"] for row in counts.collect()}
    out = []
    for first in SYMBOLS:
        row = [times.get(first + second, 0) + SMOOTHING for second in SYMBOLS]
        out += [math.log(value / sum(row)) for value in row]
    return out


def train_ratios(random_strings: DataFrame, ordinary: DataFrame) -> list[float]:
    """Log-likelihood ratio of each pair of symbols, random against ordinary, from labelled samples (``string``).

    Words have no marks in them, but paths and compound names do, so a pair with a mark says nothing.
    """
    random, known = (_log_probabilities(_pair_counts(strings)) for strings in (random_strings, ordinary))
    pairs = [first + second for first in SYMBOLS for second in SYMBOLS]
    return [0.0 if "#" in pair else a - b for pair, a, b in zip(pairs, random, known)]


def labelled_samples(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Random strings and ordinary words, each as a column ``string``, from the documents with the smallest hashes.

    Random strings are digests of those hashes, in base 16 and 64; ordinary ones are the documents' words of ASCII
    letters. Both are bounded by the number of documents chosen.
    """
    plain = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    keyed = plain.withColumn("at", F.xxhash64("doc_id", "text", F.lit(SEED)))
    chosen = keyed.select("at").distinct().orderBy("at").limit(max(SAMPLE_DOCS, SAMPLE_STRINGS))
    digest = F.sha2(F.concat(F.lit(f"{SEED}:"), F.col("at").cast("string")), 256)
    strings = chosen.orderBy("at").limit(SAMPLE_STRINGS)
    strings = strings.select(F.explode(F.array(F.base64(F.unhex(digest)), F.substring(digest, 1, 40))).alias("string"))
    few = F.broadcast(chosen.orderBy("at").limit(SAMPLE_DOCS))  # a bounded number of hashes
    words = F.explode(F.regexp_extract_all("text", F.lit(r"[A-Za-z]{3,}"), F.lit(0))).alias("string")
    return strings, keyed.join(few, "at", "left_semi").select(words)


def _spans(text: Column, pattern: str, kind: str, matches: Column) -> Column:
    """``array<struct<start, kind, stop>>`` of a pattern's matches: code points from 0, end exclusive.

    ``matches`` has a struct of ``size`` and ``wanted`` for each match; those not wanted are left out.
    """
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    steps = F.zip_with(gaps, matches, lambda gap, match: F.struct(gap.alias("gap"), match.alias("match")))
    none = F.array().cast("array<struct<start:int,kind:int,stop:int>>")

    def step(state: Column, one: Column) -> Column:
        start = state["at"] + one["gap"]
        stop = start + F.coalesce(one["match"]["size"], F.lit(0))
        span = F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("kind"), stop.alias("stop"))
        wanted = F.coalesce(one["match"]["wanted"], F.lit(False))
        found = F.when(wanted, F.concat(state["found"], F.array(span))).otherwise(state["found"])
        return F.struct(stop.alias("at"), found.alias("found"))

    start = F.struct(F.lit(0).alias("at"), none.alias("found"))
    return F.when(text.rlike(pattern), F.aggregate(steps, start, step, lambda state: state["found"])).otherwise(none)


def _sized(match: Column, wanted: Column) -> Column:
    return F.struct(F.length(match).alias("size"), wanted.alias("wanted"))


def pattern_spans(text: Column, kind: str) -> Column:
    """The spans of a kind's fixed pattern; matches whose counted group is too short are left out."""
    pattern, group, least = next(rest for name, *rest in PATTERNS if name == kind)
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    if group:
        counted = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
        matches = F.zip_with(whole, counted, lambda x, y: _sized(x, F.length(y) >= least))
    else:
        matches = F.transform(whole, lambda x: _sized(x, F.length(x) >= least))
    return _spans(text, pattern, kind, matches)


def ratio(token: Column, ratios: Sequence[float]) -> Column:
    """Sum of the ratios of a token's pairs of symbols."""
    table = F.lit(list(ratios))
    codes = F.transform(F.filter(F.split(symbols(token), ""), lambda c: c != ""), lambda c: F.instr(F.lit(SYMBOLS), c))

    def add(state: Column, code: Column) -> Column:
        pair = (state["last"] - 1) * len(SYMBOLS) + code
        more = F.when(state["last"] > 0, F.element_at(table, pair)).otherwise(F.lit(0.0))
        return F.struct(code.alias("last"), (state["total"] + more).alias("total"))

    start = F.struct(F.lit(0).alias("last"), F.lit(0.0).alias("total"))
    return F.aggregate(codes, start, add, lambda state: state["total"])


def markov_spans(text: Column, ratios: Sequence[float]) -> Column:
    """The spans of long tokens that look random: by the sum of their ratios, and by its mean."""
    whole = F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))

    def judged(token: Column) -> Column:
        least = F.greatest(F.lit(SUM_RATIO), F.lit(MEAN_RATIO) * (F.length(token) - 1))
        return _sized(token, ratio(token, ratios) >= least)

    return _spans(text, TOKEN, "markov", F.transform(whole, judged))


def _joined(spans: Column) -> Column:
    """``kind:start:end``, comma-joined, by start and then kind."""
    names = F.array(*map(F.lit, KINDS))
    one = F.transform(
        F.array_sort(spans),
        lambda span: F.concat_ws(
            ":", F.element_at(names, span["kind"] + 1), span["start"].cast("string"), span["stop"].cast("string")
        ),
    )
    return F.array_join(one, ",")


def scan_secrets(
    docs: DataFrame, ratios: Sequence[float] | None = None, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Spans of secrets in every whole text.

    One row per document: ``doc_id, n_assign, n_access, n_hex, n_markov, base_sha256`` (of the spans of the fixed
    patterns, ``kind:start:end`` by start and kind, comma-joined), ``spans`` (those and the models', joined
    likewise; a model's span never overlaps a pattern's). ``ratios`` come from ``train_ratios``; without them the
    models are learnt from ``labelled_samples`` of ``docs``. A null text is an empty one and has no spans; repeated
    rows and null ids are scanned each for itself; other columns are ignored; an empty table gives an empty result.
    """
    if ratios is None:
        ratios = train_ratios(*labelled_samples(docs, doc_id, text))
    plain = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    found = plain.select(
        "doc_id",
        *(pattern_spans(F.col("text"), kind).alias(kind) for kind in KINDS[:3]),
        markov_spans(F.col("text"), ratios).alias("markov"),
    )
    base = F.concat("assign", "access", "hex").alias("base")
    found = found.select("*", base)
    apart = F.filter(
        "markov",
        lambda m: ~F.exists("base", lambda b: (b["start"] < m["stop"]) & (m["start"] < b["stop"])),
    )
    found = found.withColumn("markov", apart)
    return found.select(
        "doc_id",
        *(F.size(kind).cast("long").alias(f"n_{kind}") for kind in KINDS),
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.concat("base", "markov")).alias("spans"),
    )
