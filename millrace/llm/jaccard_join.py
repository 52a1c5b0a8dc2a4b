"""Jaccard join of documents in the metric space of their shingle sets.

The Jaccard distance of sets is a metric, so pivots cut the space into regions, and triangle inequalities tell
which documents of one region can be close to those of another:

1. *Pivots of one shingle.* From the set {g} every document with shingle g is at the same smallest distance, every
   other one at 1, so the nearest such pivots of a document are its own shingles, the order of pivots deciding
   ties. If d(x, y) <= r, then d(x, x & y) <= r too, so at most r * |x| shingles of x are missing in y: x is
   copied to the regions of its first floor(r * |x|) + 2 pivots, and any close pair of unequal sets, which shares
   three shingles or more, meets in two. Pivots that few documents have come first, counted over all documents, so
   regions stay small. Two documents that are alone in a region, and in no second one, are therefore not close.
2. *Pivots that are documents.* In each region one document is the pivot. Documents within r of it (its ball) are
   linked to it and need no comparing with each other. A document further than 2r from it can have no link into
   the ball. One between r and 2r (the ring) is compared with those members of the ball that the triangle
   inequality leaves.
3. Documents outside the ball go on: small regions end with a direct join, large ones become one region per pivot
   document and get several new pivot documents. What those leave over of a region is joined by sketches if it fits
   one tile; else it is cut into regions as at first, by the shingles that few of its own members have, and these
   join in the same way. A region that its shingles do not halve (its members are about equally far from each other)
   is joined by sketches too, tile with tile, so that its pairs are spread over many tasks.

The pivot of a region is its most typical member, the one with the smallest share of rare shingles, so the original
of many edited copies comes before the copies.

Distances are bounded below by parity sketches (bit h mod B flips for every shingle hash h; two sketches differ
in at most as many bits as the sets differ in shingles) and computed exactly where the bound allows a link. Pairs
that are only tested for a link, not for a ring, move with sketches folded to half their length.
Equal sets are one class from the start, so exact copies cost nothing after the first scan.

The result is exact up to equal 64-bit hashes of different shingles or sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import Workspace, fresh, pick, ship
from millrace.llm.components import connected_components
from millrace.llm.shingles import mix, shingle_sets

SIMILARITY = Fraction(3, 4)
COUNTED_AT_ONCE = 1 << 21  # shingles whose repeats are counted together inside a task
REPEATS = 3  # a shingle is reported as frequent when that many of them have it
FREQUENT = 1 << 16  # frequent shingles that are ordered by their count; the order never changes the result
BROADCAST_KEYS = 200_000  # documents, of 16 bytes each, that are looked up without a shuffle
SALTS = 64  # parts of a frequent shingle's region while its pivot is found
SALT_AT = 57  # first of the bits of a frequent shingle that its salt changes
PARTNER_STEPS = 64  # of a document's size, in which the size of its largest partner is rounded up
BATCH_ROWS = 512  # texts, or pairs with their sets, that a task holds at once
SMALL_REGION = 32  # documents that are joined directly
TILE = 512  # documents that are joined with as many others at once; larger regions are cut before
EXPLODED = 1 << 18  # shingles that a task hands over at once
PIVOTS = 8  # of a large region in a further round, on average

ship(__name__)

_DESCRIBED = "doc_id long, text_key long, n long, c long, sketch array<long>, g long, df long"


def _class_of(found: np.ndarray) -> np.int64:
    """A digest of a sorted set: equal for equal sets."""
    spread = mix(found + np.uint64(0x632BE59BD9B4E019))
    parts = np.array([spread.sum(dtype=np.uint64), np.bitwise_xor.reduce(found) + np.uint64(len(found))], np.uint64)
    return mix(mix(parts) * np.array([3, 5], np.uint64)).sum(dtype=np.uint64, keepdims=True).view(np.int64)[0]


def _sketch(found: np.ndarray) -> np.ndarray:
    """Parity bits of the hashes modulo a power of two from 2n to 4n, at least 64, as longs."""
    bits = max(64, 1 << int(2 * len(found) - 1).bit_length())
    odd = np.bincount((found & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def _folded(sketch: str) -> Column:
    """The sketch of half as many bits."""
    half = (F.size(sketch) / 2).cast("int")
    return F.zip_with(F.slice(sketch, 1, half), F.slice(sketch, half + 1, half), lambda x, y: x.bitwiseXOR(y))


def _differing(a: str, b: str) -> Column:
    """Bits in which two sketches differ; one of sets up to twice as large is folded to the other's length."""

    def bits(x: Column, y: Column) -> Column:
        counts = F.zip_with(x, y, lambda one, other: F.bit_count(one.bitwiseXOR(other)))
        return F.aggregate(counts, F.lit(0), lambda total, one: total + F.coalesce(one, F.lit(0)))

    longer, shorter = F.size(a) > F.size(b), F.size(a) < F.size(b)
    return F.when(longer, bits(_folded(a), F.col(b))).when(shorter, bits(F.col(a), _folded(b))).otherwise(bits(F.col(a), F.col(b)))


def _source(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return pick(docs, doc_id=doc_id, text=text).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).select("doc_id", F.xxhash64("text").alias("text_key"), "text")


def _describe(source: DataFrame) -> DataFrame:
    """A row per document with its class, a sketch at a class's first row in a task, and rows of frequent shingles."""

    def frequent(parts: list[np.ndarray]) -> pa.RecordBatch:
        values = np.concatenate(parts)
        parts.clear()
        values.sort()  # where it is: these are the largest arrays of a task
        first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
        times = np.diff(first, append=len(values))
        often = times >= REPEATS
        values, times = values[first[often]], times[often]
        size, none = len(values), pa.nulls(len(values), pa.int64())
        columns = [none] * 4 + [pa.nulls(size, pa.list_(pa.int64())), pa.array(values.view(np.int64)), pa.array(times)]
        return pa.RecordBatch.from_arrays(columns, names)

    names = ["doc_id", "text_key", "n", "c", "sketch", "g", "df"]

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, parts, held = set(), [], 0
        for batch in batches:
            sizes, classes, sketches = [], [], []
            for found in shingle_sets(batch.column("text")):
                sizes.append(len(found))
                one = _class_of(found) if len(found) else None
                classes.append(one)
                sketches.append(None)
                if one is not None and one not in seen:
                    seen.add(one)
                    sketches[-1] = _sketch(found)
                    parts.append(found)
                    held += len(found)
                    if held >= COUNTED_AT_ONCE:
                        yield frequent(parts)
                        held = 0
            none = pa.nulls(batch.num_rows, pa.int64())
            described = [pa.array(sizes, pa.int64()), pa.array(classes, pa.int64()), pa.array(sketches, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), *described, none, none], names
            )
        if parts:
            yield frequent(parts)

    return source.mapInArrow(describe, _DESCRIBED)


def _first_pivots(source: DataFrame, frequent: list[tuple[int, int]], similarity: Fraction) -> DataFrame:
    """``k, c, meta``: the regions of each class, once a task; k is the shingle g, with a salt s above 0 in its first bits
    if g is frequent. ``meta`` has the class's size, s, the share of its shingles that are rare, in thousandths, and
    how large a partner may be, in steps of its own size: all shingles before g but one are missing in a document met
    first or second at g. The steps are coarse, so that neighbouring rows of a document are alike and compress."""
    frequent = sorted((np.uint64(g & (2**64 - 1)), df) for g, df in frequent)
    known = np.array([g for g, _ in frequent], np.uint64)
    counts = np.array([df for _, df in frequent], np.int64)
    hint = np.zeros(1 << 20, bool)
    hint[(known & np.uint64(len(hint) - 1)).astype(np.int64)] = True
    shared = source.sparkSession.sparkContext.broadcast((known, counts, hint))
    missing = 1 - similarity
    # Linked sets of sizes a and b share at least part / whole * (a + b).
    part, whole = similarity.numerator, similarity.numerator + similarity.denominator

    def pivots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts, hint = shared.value
        seen = set()
        for batch in batches:
            rows = []
            for found in shingle_sets(batch.column("text")):
                if not len(found) or (one := _class_of(found)) in seen:
                    continue
                seen.add(one)
                wanted = len(found) * missing.numerator // missing.denominator + 2
                maybe = np.flatnonzero(hint[(found & np.uint64(len(hint) - 1)).astype(np.int64)])
                at = np.searchsorted(known, found[maybe])
                hit = at < len(known)
                hit[hit] = known[at[hit]] == found[maybe[hit]]
                often = maybe[hit]
                rare = np.ones(len(found), bool)
                rare[often] = False
                cold = found[rare][:wanted]
                hot = found[often][np.argsort(counts[at[hit]], kind="stable")][: wanted - len(cold)]
                salt = 1 + int(one) % SALTS
                size, chosen = len(found), np.concatenate([cold, hot])
                left = size + 1 - np.arange(len(chosen))
                partner = -(-PARTNER_STEPS * (left * whole // part - size) // size)
                meta = (size << 33) + ((1000 * int(rare.sum()) // size) << 16) + partner
                meta[len(cold) :] += salt << 26
                keys = chosen.copy()
                keys[len(cold) :] ^= np.uint64(salt << SALT_AT)
                rows.append((keys, one, meta))
            if rows:
                sizes = [len(row[0]) for row in rows]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([row[0] for row in rows]).view(np.int64)),
                        pa.array(np.repeat(np.array([row[1] for row in rows], np.int64), sizes)),
                        pa.array(np.concatenate([row[2] for row in rows])),
                    ],
                    ["k", "c", "meta"],
                )

    return source.select("text").mapInArrow(pivots, "k long, c long, meta long")


def _regions(first: DataFrame, work: Workspace) -> DataFrame:
    """``g, c, n, most, several, p, np``: members of the regions with at least two classes but for the region's pivot
    document ``p`` of size ``np``, the largest size of a partner, and whether the region may hold a third class."""
    part = Window.partitionBy("k")
    n, most = F.shiftright("meta", 33), F.col("meta").bitwiseAND(F.lit(0xFFFF))
    rare, s = F.shiftright("meta", 16).bitwiseAND(F.lit(0x3FF)), F.shiftright("meta", 26).bitwiseAND(F.lit(0x7F))
    g = F.col("k").bitwiseXOR(F.shiftleft(s, SALT_AT))
    rows = first.repartition("k")  # they move as they are and are taken apart behind the shuffle
    rows = rows.select("k", g.alias("g"), s.alias("s"), "c", n.alias("n"), F.ceil(n * most / PARTNER_STEPS).alias("most"), rare.alias("w"))
    typical = F.struct("w", "c", "n")
    # In a region of two rows the other one's size and its largest partner are known at once.
    others = {c: F.sum(c).over(part) - F.col(c) for c in ("n", "most")}
    met = rows.withColumn("p", F.min(typical).over(part)).withColumn("q", F.max(typical).over(part))
    met = met.withColumn("rows", F.count("*").over(part))
    met = met.withColumn("fits", (others["n"] <= F.col("most")) & (F.col("n") <= others["most"]))
    apart = (F.col("p.c") != F.col("q.c")) & ((F.col("rows") > 2) | F.col("fits"))
    wanted = (F.col("s") > 0) | (apart & (F.col("c") != F.col("p.c")))
    # Rows with one k lie together already, so they are made distinct without being moved again.
    shared = met.where(wanted).withColumn("several", F.col("rows") > 2).withColumn("q", F.when(F.col("s") > 0, F.col("q")))
    shared = work.keep(shared.drop("rows", "fits", "w").distinct().drop("k"))
    pivots = shared.where("s > 0").groupBy("g").agg(F.min("p").alias("p"), F.max("q").alias("q")).where("p.c != q.c")
    hot = shared.where("s > 0").select("g", "c", "n", "most", F.lit(True).alias("several"))
    pivot = F.col("p.c").alias("p"), F.col("p.n").alias("np")
    hot = hot.join(pivots.select("g", *pivot), "g").where("c != p")
    few = shared.where("s = 0").select("g", "c", "n", "most", "several", *pivot)
    return work.keep(few.unionByName(hot))


class _Distances:
    """Compares pairs of classes; reads the shingle sets of a class again only when a pair first needs them."""

    def __init__(self, source: DataFrame, classes: DataFrame, similarity: Fraction, work: Workspace):
        self.source, self.classes, self.similarity, self.work = source, classes, similarity, work
        self.sets: DataFrame | None = None

    def compare(self, pairs: DataFrame) -> DataFrame:
        """``a, b, low, d`` of the pairs ``a, b, ring`` whose distance may be up to 2r, or r where ``ring`` is false:
        a lower bound, and the distance if it is at most r (else null)."""
        bounded = self.work.keep(self._bounded(pairs))
        r = 1 - self.similarity
        near = bounded.where(F.col("low") <= float(r) + 1e-9).select("a", "b", "na", "nb")
        self._fetch(near.select(F.col("a").alias("c")).union(near.select("b")))
        common = self._common(near)
        union = F.col("na") + F.col("nb") - F.col("both")
        linked = common.where(
            F.col("both") * F.lit(self.similarity.denominator) >= union * F.lit(self.similarity.numerator)
        ).select("a", "b", (1 - F.col("both") / union).alias("d"))
        return self.work.keep(bounded.select("a", "b", "low").join(linked, ["a", "b"], "left"))

    def _bounded(self, pairs: DataFrame) -> DataFrame:
        left = self.classes.select(F.col("c").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
        right = self.classes.select(F.col("c").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
        r = float(1 - self.similarity)
        reach = F.when(F.col("ring"), 2 * r + 1e-9).otherwise(r + 1e-9)
        sized = F.least("na", "nb") >= F.greatest("na", "nb") * (1 - reach)

        def needed(sketch: str) -> Column:
            return F.when(F.col("ring") | (F.size(sketch) == 1), F.col(sketch)).otherwise(_folded(sketch))

        met = pairs.select("a", "b", "ring").join(left, "a").withColumn("sa", needed("sa"))
        met = met.join(right, "b").where(sized).withColumn("sb", needed("sb"))
        met = met.withColumn("differ", _differing("sa", "sb"))
        by_size = 1 - F.least("na", "nb") / F.greatest("na", "nb")
        low = F.greatest(2 * F.col("differ") / (F.col("na") + F.col("nb") + F.col("differ")), by_size)
        return met.select("a", "b", "na", "nb", low.alias("low")).where(F.col("low") <= reach)

    def shingles(self, members: DataFrame) -> DataFrame:
        """``g, c, n, size, s``: a row for each shingle s of each of the members ``g, c, n, size``."""
        self._fetch(members.select("c"))

        def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                items = [np.frombuffer(x.as_py(), np.int64) for x in batch.column("items")]
                first, held = 0, 0
                for row, own in enumerate(items, 1):
                    held += len(own)
                    if held >= EXPLODED or row == len(items):
                        rows = pa.array(np.repeat(np.arange(first, row), [len(x) for x in items[first:row]]))
                        columns = [batch.column(name).take(rows) for name in ("g", "c", "n", "size")]
                        found = pa.array(np.concatenate(items[first:row]))
                        yield pa.RecordBatch.from_arrays([*columns, found], ["g", "c", "n", "size", "s"])
                        first, held = row, 0

        rows = members.join(self.sets, "c").select("g", "c", "n", "size", "items")
        return rows.mapInArrow(explode, "g long, c long, n long, size long, s long")

    def _fetch(self, classes: DataFrame) -> None:
        wanted = classes.distinct()
        if self.sets is not None:
            wanted = wanted.join(self.sets.select("c"), "c", "left_anti")
        wanted = self.work.keep(wanted.join(self.classes, "c").select("c", "n", *_KEY))
        keys = wanted.select(*_KEY)
        if wanted.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS:  # else texts are shuffled to their keys
            keys = F.broadcast(keys)
        rows = self.source.select(*_key(self.source), "text").join(keys, _KEY, "left_semi")

        def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = [x for x in shingle_sets(batch.column("text")) if len(x)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_class_of(x) for x in found], pa.int64()), pa.array([x.tobytes() for x in found], pa.binary())],
                    ["c", "items"],
                )

        new = rows.mapInArrow(sets, "c long, items binary").join(wanted.select("c"), "c", "left_semi")
        new = self.work.keep(new.dropDuplicates(["c"]))
        self.sets = new if self.sets is None else self.sets.unionByName(new)

    def _common(self, near: DataFrame) -> DataFrame:
        left = self.sets.select(F.col("c").alias("a"), F.col("items").alias("xa"))
        right = self.sets.select(F.col("c").alias("b"), F.col("items").alias("xb"))

        def common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                sizes = [
                    len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True))
                    for x, y in zip(batch.column("xa").to_pylist(), batch.column("xb").to_pylist())
                ]
                columns = [batch.column(k) for k in ("a", "b", "na", "nb")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(sizes, pa.int64())], ["a", "b", "na", "nb", "both"])

        return near.join(left, "a").join(right, "b").mapInArrow(common, "a long, b long, na long, nb long, both long")


_KEY = ["row_key", "text_key"]


def _key(source: DataFrame) -> list:
    """What finds a document again: its id, or its text's hash if it has none; and that hash."""
    return [F.coalesce("doc_id", "text_key").alias("row_key"), F.col("text_key")]


def _unordered(pairs: DataFrame, a: str, b: str, ring: Column) -> DataFrame:
    """``a, b, ring``: each pair once, with a ring if one of its rows has it."""
    return _met(pairs, a, b, ring).select("a", "b", "ring")


def _met(pairs: DataFrame, a: str, b: str, ring: Column) -> DataFrame:
    """``a, b, ring, times``: as ``_unordered``, with the number of rows of each pair."""
    ends = pairs.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"), ring.alias("ring"))
    return ends.groupBy("a", "b").agg(F.max("ring").alias("ring"), F.count("*").alias("times"))


def _both_ways(pairs: DataFrame) -> DataFrame:
    """``c, q, low, d``: every compared pair seen from either end."""
    ends = [("a", "b"), ("b", "a")]
    one, other = (pairs.select(F.col(x).alias("c"), F.col(y).alias("q"), "low", "d") for x, y in ends)
    return one.unionByName(other)


def _recurse(members: DataFrame, distances: _Distances, work: Workspace) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Ball after ball: ``compared`` (``c, q, low, d``; q a pivot), and what the balls leave over of small regions
    (``g, c, n, most``) and of those that are joined in tiles (``g, c, n, size``)."""
    alike = F.least("n", "np") >= F.greatest("n", "np") * F.lit(2 * float(distances.similarity) - 1 - 1e-9)
    # A close pair meets in two regions. If it is alone in both it has two rows; else a region of several decides it.
    # Below a half, unequal sets may be linked by a single shingle.
    times = 2 if 2 * distances.similarity > 1 else 1
    met = _met(members.where(alike), "c", "p", F.col("several")).where(F.col("ring") | (F.col("times") >= times))
    compared = _both_ways(distances.compare(met.drop("times")))
    links = compared.where("d is not null").select("c", F.col("q").alias("p"))
    # Where the pivot has met its only other class nothing is left to join.
    left = members.where("several").drop("several", "np").join(links, ["c", "p"], "left_anti")
    sizes = left.groupBy("g").agg(F.count("*").alias("size")).where("size > 1")
    left = work.keep(left.join(sizes, "g"))
    small = left.where(F.col("size") <= SMALL_REGION).select("g", "c", "n", "most")
    # Regions with one pivot overlap in most members: they go on as one.
    large = work.keep(left.where(F.col("size") > SMALL_REGION).select(F.col("p").alias("g"), "c", "n").distinct())
    rest, turn = large.limit(0).withColumn("size", F.lit(0).cast("long")), 0
    while not large.isEmpty():
        more, left = _further_balls(large, turn, distances, work)
        compared, turn = compared.unionByName(more), turn + 1
        sizes = left.groupBy("g").agg(F.count("*").alias("size")).where("size > 1")
        left = work.keep(left.join(sizes, "g"))
        rest = rest.unionByName(left.where(F.col("size") <= TILE))
        large = left.where(F.col("size") > TILE)
        if not large.isEmpty():
            few, large, tiled = _subregions(large, distances, work)
            small, rest = small.unionByName(few), rest.unionByName(tiled)
    return work.keep(compared), small, rest


def _further_balls(large: DataFrame, turn: int, distances: _Distances, work: Workspace) -> tuple[DataFrame, DataFrame]:
    """One round of several pivots a region: what was compared, and the members ``g, c, n`` outside the balls."""
    sizes = large.groupBy("g").agg(F.count("*").alias("size"), F.min("c").alias("least"))
    drawn = F.pmod(F.xxhash64("c", F.lit(turn)), F.lit(1 << 30)) * F.col("size") < F.lit(PIVOTS << 30)
    chosen = large.join(sizes, "g").where((F.col("c") == F.col("least")) | drawn)
    chosen = chosen.select("g", F.col("c").alias("q"), F.col("n").alias("nq"))
    alike = F.least("n", "nq") >= F.greatest("n", "nq") * F.lit(2 * float(distances.similarity) - 1 - 1e-9)
    met = work.keep(large.join(chosen, "g").where((F.col("c") != F.col("q")) & alike).select("g", "c", "q"))
    more = _both_ways(distances.compare(_unordered(met, "c", "q", F.lit(True))))
    links = more.where("d is not null").select("c", "q")
    inside = met.join(links, ["c", "q"], "left_semi").select("g", "c")
    gone = inside.unionByName(chosen.select("g", F.col("q").alias("c"))).distinct()
    return more, work.keep(large.join(gone, ["g", "c"], "left_anti"))


def _subregions(left: DataFrame, distances: _Distances, work: Workspace) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The members ``g, c, n, size`` in regions of their own region's shingles: ``few`` (``g, c, n, most``) of small ones,
    ``deeper`` (``g, c, n``) of those larger than a tile, and ``g, c, n, size`` of regions of one tile and of those
    that are not halved.

    A document is copied to its first floor(r * n) + 1 shingles, those first that few members of the region have. The
    regions that go deeper have half of the members at most, so the recursion ends."""
    missing = 1 - distances.similarity
    num, den = distances.similarity.numerator, distances.similarity.denominator
    rows = work.keep(distances.shingles(left))
    shared = rows.groupBy("g", "s").agg(F.count("*").alias("df"))
    place = F.row_number().over(Window.partitionBy("g", "c").orderBy("df", "s"))
    wanted = F.floor(F.col("n") * missing.numerator / missing.denominator) + 1
    met = rows.join(shared, ["g", "s"]).withColumn("place", place).where((F.col("place") <= wanted) & (F.col("df") > 1))
    # All shingles before the place are missing in a document first met there: see ``_first_pivots``.
    most = F.floor((F.col("n") - F.col("place") + 1) * (num + den) / num) - F.col("n")
    met = met.select(F.col("g").alias("top"), F.xxhash64("g", "s").alias("g"), "c", "n", "size", most.alias("most"))
    met = work.keep(met)
    sizes = met.groupBy("top", "g").agg(F.count("*").alias("own"), F.max("size").alias("size")).where("own > 1")
    stuck = sizes.where((F.col("own") > TILE) & (2 * F.col("own") > F.col("size"))).select("top").distinct()
    sizes = sizes.join(stuck, "top", "left_anti").select("top", "g", "own")
    met = work.keep(met.drop("size").join(sizes, ["top", "g"]))
    few = met.where(F.col("own") <= SMALL_REGION).select("g", "c", "n", "most")
    tile = met.where((F.col("own") > SMALL_REGION) & (F.col("own") <= TILE))
    rest = left.join(stuck.withColumnRenamed("top", "g"), "g", "left_semi").select("g", "c", "n", "size")
    rest = rest.unionByName(tile.select("g", "c", "n", F.col("own").alias("size")))
    deeper = met.where(F.col("own") > TILE).select("g", "c", "n").distinct()
    return work.keep(few), work.keep(deeper), work.keep(rest)


def _undecided(
    compared: DataFrame, small: DataFrame, large: DataFrame, groups: DataFrame, distances: _Distances
) -> DataFrame:
    """Pairs that the pivots neither linked nor kept apart: ball with ring, and what the balls left over.

    Where many documents meet (rings, large regions) they bring their sketches to the join, so that only pairs that
    may be linked come out of it."""
    r = 1 - distances.similarity
    grouped = groups.select(F.col("node").alias("c"), "component")
    known = distances.classes.select("c", "n", "sketch").join(grouped, "c", "left")
    known = known.withColumn("component", F.coalesce("component", "c"))
    few = small.join(grouped, "c", "left").withColumn("component", F.coalesce("component", "c"))

    def side(name: str) -> DataFrame:
        return few.select("g", *(F.col(c).alias(c + name) for c in ("c", "n", "most", "component")))

    def end(rows: DataFrame, name: str) -> DataFrame:
        renamed = [F.col(c).alias(c + name) if c in ("c", "n", "sketch", "component") else F.col(c) for c in (*rows.columns, "n", "sketch", "component")]
        return rows.join(known, "c").select(renamed)

    most = (F.col("nx") + F.col("ny")) * F.lit(float(r / (2 - r))) + F.lit(1e-6)
    sized = F.least("nx", "ny") * F.lit(distances.similarity.denominator) >= F.greatest("nx", "ny") * F.lit(distances.similarity.numerator)
    apart = (F.col("componentx") != F.col("componenty")) & sized
    open_ = apart & (_differing("sketchx", "sketchy") <= most)
    ball = end(compared.where("d is not null").select("q", "c", "d"), "x")
    ring = end(compared.where("d is null").select("q", "c", "low"), "y")
    across = ball.join(ring, "q").where((F.col("low") <= F.col("d") + F.lit(float(r) + 1e-9)) & open_)
    tiles = F.ceil(F.col("size") / TILE)
    tiled = large.withColumn("own", F.pmod(F.xxhash64("c"), tiles)).withColumn("other", F.explode(F.sequence(F.lit(0), tiles - 1)))
    tiled = tiled.select("g", "c", "own", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"))
    ours, theirs = end(tiled, "x").withColumnRenamed("own", "ownx"), end(tiled, "y").withColumnRenamed("own", "owny")
    once = (F.col("ownx") != F.col("owny")) | (F.col("lo") == F.col("hi"))  # one tile's pairs meet in its own place only
    direct = ours.join(theirs, ["g", "lo", "hi"]).where((F.col("cx") < F.col("cy")) & once & open_)
    fits = (F.col("nx") <= F.col("mosty")) & (F.col("ny") <= F.col("mostx"))
    near = side("x").join(side("y"), "g").where((F.col("cx") < F.col("cy")) & apart & fits)
    pairs = [found.select("cx", "cy") for found in (across, direct, near)]
    return _unordered(pairs[0].unionByName(pairs[1]).unionByName(pairs[2]), "cx", "cy", F.lit(False))


def jaccard_join(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: Fraction = SIMILARITY
) -> DataFrame:
    """Groups of documents linked by a Jaccard similarity of their shingle sets of at least ``similarity``.

    One row per document: ``doc_id, text_key`` (hash of the text), ``n_shingles`` (0 for a text that is null,
    empty or without words), ``component_id`` (smallest doc_id reachable by links, its own included),
    ``kept`` (true for one row of each component: its smallest doc_id, ties by text_key).
    Rows with a null doc_id take part like others; a component of such rows alone has a null id. Repeated rows
    are linked copies and all come back (``kept`` is then true for each copy of the kept row). Other columns are
    ignored; an empty table gives an empty result.
    """
    source = _source(docs, doc_id, text)
    with Workspace(docs.sparkSession, "jaccard", BATCH_ROWS) as work:
        described = work.keep(_describe(source))
        rows = described.where("n is not null").select("doc_id", "text_key", "n", "c", "sketch")
        owner = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_key"))
        classes = rows.where("c is not null").groupBy("c")
        classes = classes.agg(F.max("n").alias("n"), F.first("sketch", ignorenulls=True).alias("sketch"), owner.alias("owner"))
        classes = work.keep(
            classes.select("c", "n", "sketch", "owner", F.col("owner.doc_id").alias("doc_id"), F.col("owner.text_key").alias("text_key"))
            .select("c", "n", "sketch", "owner", *_key(rows))
        )
        frequent = described.where("g is not null").groupBy("g").agg(F.sum("df").alias("df"))
        frequent = [tuple(row) for row in frequent.orderBy(F.desc("df"), "g").limit(FREQUENT).collect()]
        members = _regions(_first_pivots(source, frequent, similarity), work)
        distances = _Distances(source, classes, similarity, work)
        compared, small, large = _recurse(members, distances, work)
        links = compared.where("d is not null").select(F.col("c").alias("a"), F.col("q").alias("b"))
        groups = connected_components(links, work)
        more = distances.compare(_undecided(compared, small, large, groups, distances)).where("d is not null").select("a", "b")
        if not more.isEmpty():
            groups = connected_components(links.unionByName(more), work)
        return work.result(_labelled(rows, classes, groups))


def _labelled(rows: DataFrame, classes: DataFrame, groups: DataFrame) -> DataFrame:
    owned = classes.select("c", "owner").join(groups.select(F.col("node").alias("c"), "component"), "c", "left")
    owned = owned.withColumn("component", F.coalesce("component", "c"))
    first = owned.groupBy("component").agg(F.min("owner").alias("first"))
    labels = owned.select("c", "component").join(first, "component").select("c", "first")
    alone = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_key")
    labelled = rows.join(labels, "c", "left").withColumn("first", F.coalesce("first", alone))
    return labelled.select(
        "doc_id",
        "text_key",
        F.col("n").alias("n_shingles"),
        F.col("first.doc_id").alias("component_id"),
        (F.col("first.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("first.text_key") == F.col("text_key"))).alias("kept"),
    )


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each component of ``jaccard_join``, all columns as they were.

    Rows with equal doc_id and text are one document. Documents without words are kept, one per doc_id. Texts move
    at most once, by the key of the join; only rows that are repeated are then reduced to one.
    """
    names = {name: fresh(docs, name) for name in ("id_key", "nameless", "text_key", "times")}
    *key, times = names.values()

    def keyed(rows: DataFrame, number: Column, digest: Column) -> DataFrame:
        return rows.withColumns(dict(zip(key, (F.coalesce(number, digest), number.isNull(), digest))))

    kept = jaccard_join(docs, doc_id, text).where("kept").select("doc_id", "text_key")
    kept = kept.withColumnsRenamed({"doc_id": "number", "text_key": "digest"})
    kept = keyed(kept, F.col("number"), F.col("digest")).groupBy(*key).agg(F.count("*").alias(times))
    found = keyed(docs, F.col(doc_id).cast("long"), F.xxhash64(F.col(text).cast("string"))).join(kept, key)
    once, repeated = found.where(F.col(times) == 1), found.where(F.col(times) > 1).dropDuplicates(key)
    return once.unionByName(repeated).drop(*key, times)
