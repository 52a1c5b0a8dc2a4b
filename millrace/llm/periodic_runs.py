"""Periodic runs of words: stretches that repeat themselves with a period, found by minimizers at several scales.

Scale s (8, 16, 32, ...) is for the periods in (s/2, s]. It hashes every stretch of s words and keeps the minima of all
windows of s/2 hashes. Inside a run of period q that repeats four times at least, a window recurs q words later with
the same minimum, and as a hash covers a whole period, equal hashes lie a multiple of q apart. So a run has two
neighbouring equal minima at distance q; each such pair is a seed, extended word by word to both sides. Periods up to 4
are too short for a scale: every word is compared with the one that many words before it.

All scales cost about as much memory as the words themselves: a scale keeps some 4/s of its positions, and a
scale's arrays are gone before the next one's are made. Nothing is shuffled; every text is searched whole.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import compress, count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import pick, ship
from millrace.llm.shingles import FACTORS, mix

MIN_WORDS, MIN_REPEATS = 6, 4  # a run has at least so many words, and its period at least so often
DIRECT = 4  # periods up to this are looked up directly
GROUP_BYTES = 1 << 19  # texts searched together; a longer one is searched alone

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

ship(__name__)
ship(mix.__module__)


def _forward(words: np.ndarray, a: int, b: int) -> int:
    """How many words from ``a`` on equal those from ``b`` (> a) on."""
    same, size = 0, 32
    while b + same < len(words):
        right = words[b + same : b + same + size]
        differ = np.flatnonzero(words[a + same : a + same + len(right)] != right)
        if len(differ):
            return same + int(differ[0])
        same, size = same + len(right), 2 * size
    return same


def _primitive(words: np.ndarray, start: int, period: int) -> bool:
    """Whether the stretch of that period has no smaller one (which then divides it)."""
    left, prime = period, 2
    while left > 1:
        if left % prime == 0:
            part = period // prime
            if np.array_equal(words[start : start + period], words[start + part : start + part + period]):
                return False
            while left % prime == 0:
                left //= prime
        prime = prime + 1 if prime * prime <= left else max(left, prime + 1)
    return True


def _direct(words: np.ndarray, period: int) -> Iterator[tuple[int, int, int]]:
    """Stretches of one short period: runs of equal pairs of words that far apart."""
    same = np.zeros(max(0, len(words) - period) + 2, np.int8)
    same[1:-1] = words[period:] == words[: max(0, len(words) - period)]
    edges = np.diff(same)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    lengths = ends - starts + period
    for k in np.flatnonzero(lengths >= max(MIN_WORDS, MIN_REPEATS * period)):
        yield int(starts[k]), int(lengths[k]), period


def _sliding(values: np.ndarray, width: int, pick_one: np.ufunc) -> np.ndarray:
    """Least or greatest value of every window of ``width`` (a power of two)."""
    step = 1
    while step < width:
        values = pick_one(values[:-step], values[step:])
        step *= 2
    return values


def _seeds(hashes: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Neighbouring equal minima at a distance that belongs to this scale: positions and distances, by distance."""
    width = scale // 2
    if len(hashes) < width:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    least = np.pad(_sliding(hashes, width, np.minimum), width - 1)
    minima = np.flatnonzero(_sliding(least, width, np.maximum) == hashes)
    found = hashes[minima]
    order = np.argsort(found, kind="stable")
    minima, found = minima[order], found[order]
    distance = np.diff(minima)
    seeds = (found[1:] == found[:-1]) & (distance > width) & (distance <= scale)
    at, distance = minima[:-1][seeds], distance[seeds]
    order = np.lexsort((at, distance))
    return at[order], distance[order]


def word_runs(words: np.ndarray, sizes: np.ndarray) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of every run in consecutive texts of ``sizes`` words, the longest text first.

    Equal numbers are equal words; after each text stands one number that occurs nowhere else.
    """
    found = [run for period in range(1, DIRECT + 1) for run in _direct(words, period)]
    ends = np.cumsum(sizes + 1)
    hashes, scale = mix(words.astype(np.uint64) + FACTORS[0]), 1
    backward = words[::-1]
    while True:
        texts = int(np.searchsorted(-sizes, -MIN_REPEATS * (scale + 1), "right"))  # long enough for the next scale
        if not texts or len(hashes) <= scale:
            break
        hashes = hashes[: ends[texts - 1]]
        hashes = mix(hashes[:-scale] * FACTORS[1] + hashes[scale:])
        scale *= 2
        if scale <= DIRECT:
            continue
        first = stop = period = 0
        for at, distance in zip(*(part.tolist() for part in _seeds(hashes, scale))):
            if distance == period and first <= at and at + distance < stop:
                continue  # in the stretch found last
            left = _forward(backward, len(words) - at - distance, len(words) - at)
            first, period = at - left, distance
            stop = at + distance + _forward(words, at, at + distance)
            if stop - first >= MIN_REPEATS * period:
                found.append((first, stop - first, period))
    return sorted({run for run in found if _primitive(words, run[0], run[2])})


def _search(texts: list[bytes | None]) -> tuple[list[list[tuple[int, int, int]]], list[bytes]]:
    """Runs of each text, and its words without the repeats, joined by one space."""
    split = [(text or b"").split() for text in texts]  # splits at \x20 and \x09-\x0D, as words are defined
    order = sorted(range(len(split)), key=lambda k: -len(split[k]))
    number, separator = defaultdict(count().__next__), count(-1, -1)
    numbers: list[int] = []
    for k in order:
        numbers += map(number.__getitem__, split[k])
        numbers.append(next(separator))
    sizes = np.array([len(split[k]) for k in order], np.int64)
    runs = word_runs(np.array(numbers, np.int64), sizes)
    starts = np.cumsum(sizes + 1) - sizes - 1
    change = np.zeros(len(numbers) + 1, np.int64)
    per_text: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for start, length, period in runs:
        k = int(np.searchsorted(starts, start, "right")) - 1
        per_text[order[k]].append((start - int(starts[k]), length, period))
        change[start + period] += 1
        change[start + length] -= 1
    kept = np.cumsum(change) == 0
    for k, start in zip(order, starts):
        if per_text[k]:
            split[k] = list(compress(split[k], kept[start : start + len(split[k])]))
    return per_text, [b" ".join(words) for words in split]


def find_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Periodic runs of each whole text.

    Words are the runs of ``[^\\x20\\x09-\\x0D]``, numbered from 0. A run is a stretch of words with smallest period q,
    of at least ``max(6, 4 * q)`` words, which no neighbouring word extends with that period. One row per row of
    ``docs``: ``doc_id``, ``runs`` (array of ``start, length, period``, by start, then period) and ``collapsed``: the
    words joined by one space, but for those that a run contains after its first q words.

    A null or empty text, and one without words, has no runs and an empty ``collapsed``. Repeated rows and null ids are
    searched each for itself; other columns are ignored, whatever their names; an empty table gives an empty result.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, at = batch.column("text"), 0
            sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            while at < len(texts):
                done = int(sizes[at - 1]) if at else 0
                to = max(at + 1, int(np.searchsorted(sizes, done + GROUP_BYTES, "right")))
                runs, collapsed = _search(texts[at:to].to_pylist())
                rows = [[dict(zip(("start", "length", "period"), run)) for run in found] for found in runs]
                columns = [batch.column("doc_id")[at:to], pa.array(rows, pa.list_(RUN)), pa.array(collapsed, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "runs", "collapsed"])
                at = to

    plain = pick(docs, doc_id=doc_id, text=text)
    plain = plain.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    found = plain.mapInArrow(
        search, "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed binary"
    )
    return found.withColumn("collapsed", F.col("collapsed").cast("string"))


def with_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``text`` with periodic tails planted in about a tenth of the texts, chosen by ``crc32`` of the id.

    With h the hash of the decimal id, g = floor(h / 10) and n words: where h % 10 = 0 and n > 0, each word i >= a
    becomes the original word ``a + (i - a) % p``, with a = g % n and p = 1 + floor((n - a) / (3 + g % 8)). Other texts,
    and those of null ids, stay as they are.
    """
    hashed = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    chosen = pick(docs, doc_id=doc_id, text=text).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    chosen = chosen.withColumn("_g", F.when(hashed % 10 == 0, F.floor(hashed / 10)))
    chosen = chosen.withColumn("_words", F.when(F.col("_g").isNotNull(), words))
    n = F.size("_words").cast("long")
    chosen = chosen.withColumn("_n", F.when(n > 0, n)).withColumn("_a", F.expr("_g % _n"))
    chosen = chosen.withColumn("_p", F.expr("1 + (_n - _a) div (3 + _g % 8)"))
    planted = F.expr("array_join(transform(sequence(0L, _n - 1), i -> _words[if(i < _a, i, _a + (i - _a) % _p)]), ' ')")
    return chosen.select("doc_id", F.when(F.col("_n").isNotNull(), planted).otherwise(F.col("text")).alias("text"))


def run_digests(found: DataFrame) -> DataFrame:
    """One row of figures and digests per row of ``find_runs``."""
    longest = F.array_max(F.transform("runs", lambda run: F.struct(run.length, -run.start, -run.period)))
    lines = F.transform("runs", lambda run: F.concat(F.concat_ws(",", run.start, run.length, run.period), F.lit("\n")))
    return (
        found.withColumn("_longest", longest)
        .withColumns({"length": F.col("_longest.length"), "start": -F.col("_longest.col2"), "period": -F.col("_longest.col3")})
        .select(
            "doc_id", F.size("runs").cast("long").alias("n_runs"), "start", "length", "period",
            F.expr("(1000 * length) div period").alias("exponent_milli"),
            F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
            F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
        )
    )
