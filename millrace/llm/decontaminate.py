"""Benchmark items found inside documents by MinHash containment search, partitioned by size.

An item is short and a document may be long, so the similarity of the two whole sets tells little. Items of fewer than
``FEW`` shingles are candidates wherever one of their shingles occurs; none is missed. The others are put in
partitions by the number of their shingles, each up to twice as large as the one before. For each partition every
document is cut into windows of twice the partition's largest size, each overlapping the next by half, so that a passage
of that size lies whole in a window. That turns the wanted containment into a similarity of item and window of
at least about a sixth, at any length of the document. Item and window are candidates if any of ``HASHES`` MinHash
values agrees; at that similarity a passage is missed with a chance below (5/6) ** 64, one in 100,000. Candidates
are verified by the exact share of the item's shingles that the whole document has.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import fresh, ship
from millrace.llm.shingles import mix, shingle_groups, shingle_sets

CONTAINMENT = Fraction(3, 4)
HASHES = 64
FEW = 3  # items of fewer shingles are looked up by each of them: in a window of 16 they are too small a share
SMALLEST = 8  # shingles up to which the other items share the first partition
BLOCK_SHINGLES = 1 << 21  # item shingles that a task holds at once, about; more items take more passes
HINTS = 1 << 18

ship(__name__)

FACTORS = mix(np.arange(1, HASHES + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)) | np.uint64(1)


class _Items:
    """The items of one pass: their shingle sets, the sorted shingles of those with few, and by partition of the others
    the MinHash values, sorted for each hash."""

    def __init__(self, ids: list[int], sets: list[np.ndarray]):
        self.ids, self.sets = np.array(ids, np.int64), sets
        sizes = np.array([len(found) for found in sets])
        parts = np.maximum(0, np.ceil(np.log2(np.maximum(sizes, 1) / SMALLEST)).astype(int))
        few = np.flatnonzero(sizes < FEW)
        self.few = np.concatenate([sets[k] for k in few]) if len(few) else np.zeros(0, np.uint64)
        order = np.argsort(self.few)
        self.few, self.few_items = self.few[order], np.repeat(few, sizes[few])[order]
        self.few_hints = np.zeros(HINTS, bool)
        self.few_hints[(self.few & np.uint64(HINTS - 1)).astype(np.int64)] = True
        self.parts = []
        for part in np.unique(parts[sizes >= FEW]):
            own = np.flatnonzero((parts == part) & (sizes >= FEW))
            minima = np.array([[(sets[k] * factor).min() for factor in FACTORS] for k in own], np.uint64)
            hints = np.zeros((HASHES, HINTS), bool)
            for k in range(HASHES):
                hints[k, (minima[:, k] & np.uint64(HINTS - 1)).astype(np.int64)] = True
            order = np.argsort(minima, axis=0)
            self.parts.append((SMALLEST << int(part), np.take_along_axis(minima, order, 0), own[order], hints))

    def _with_few(self, shingles: np.ndarray, sizes: np.ndarray) -> set[tuple[int, int]]:
        """The candidates among items of few shingles."""
        if not len(self.few):
            return set()
        maybe = np.flatnonzero(self.few_hints[(shingles & np.uint64(HINTS - 1)).astype(np.int64)])
        values = shingles[maybe]
        at, to = np.searchsorted(self.few, values), np.searchsorted(self.few, values, "right")
        owner = np.repeat(np.arange(len(sizes)), sizes)[maybe]
        hits = np.unique(np.column_stack([owner, at, to])[at < to], axis=0)
        return {(int(k), int(item)) for k, low, high in hits for item in self.few_items[low:high]}

    def candidates(self, shingles: np.ndarray, sizes: np.ndarray) -> set[tuple[int, int]]:
        """(document, item) by their positions, for consecutive documents with ``sizes`` shingles."""
        found = self._with_few(shingles, sizes)
        filled = np.flatnonzero(sizes > 0)
        if not len(filled) or not self.parts:
            return found
        blocks = -(-sizes[filled] // SMALLEST)
        document = np.repeat(filled, blocks)
        within = np.arange(len(document)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        first = np.repeat((np.cumsum(sizes) - sizes)[filled], blocks) + within * SMALLEST
        product = np.empty_like(shingles)
        for k in range(HASHES):
            np.multiply(shingles, FACTORS[k], out=product)
            lowest, level, owner, place = np.minimum.reduceat(product, first), SMALLEST, document, within
            for size, minima, items, hints in self.parts:
                while level < size:
                    start = np.flatnonzero(place % 2 == 0)
                    lowest, owner, place = np.minimum.reduceat(lowest, start), owner[start], place[start] // 2
                    level *= 2
                window = lowest.copy()
                follows = owner[1:] == owner[:-1]
                window[:-1][follows] = np.minimum(lowest[:-1], lowest[1:])[follows]
                maybe = np.flatnonzero(hints[k][(window & np.uint64(HINTS - 1)).astype(np.int64)])
                values = window[maybe]
                at, to = np.searchsorted(minima[:, k], values), np.searchsorted(minima[:, k], values, "right")
                for place_, low, high in zip(maybe[at < to], at[at < to], to[at < to]):
                    found.update((int(owner[place_]), int(item)) for item in items[low:high, k])
        return found


def _blocks(items: DataFrame, item_id: str, text: str) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """The distinct items in blocks of a bounded number of shingles, as far as whole items allow."""
    plain = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).cast("string").alias("text"))
    plain = plain.where("item_id is not null").distinct()

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([one.tobytes() for one in shingle_sets(batch.column("text"))], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), found], ["item_id", "items"])

    found = plain.mapInArrow(sets, "item_id long, items binary").where("length(items) > 0").distinct()
    total = found.agg(F.sum(F.length("items"))).first()[0] or 0
    parts = -(-total // (8 * BLOCK_SHINGLES))
    for part in range(parts):
        rows = found.where(F.pmod(F.xxhash64("item_id", "items"), F.lit(parts)) == part).collect()
        if rows:
            yield [row["item_id"] for row in rows], [np.frombuffer(row["items"], np.uint64) for row in rows]


def _matches(items: _Items, texts: pa.Array, containment: Fraction) -> Iterator[tuple[int, int, int, int]]:
    """For each text that contains an item: its row, the item's position, the item's shingles, those shared."""
    for row, shingles, sizes in shingle_groups(texts):
        ends = np.cumsum(sizes)
        own: dict[int, np.ndarray] = {}
        for k, item in sorted(items.candidates(shingles, sizes)):
            if k not in own:
                own[k] = np.unique(shingles[ends[k] - sizes[k] : ends[k]])
            wanted = items.sets[item]
            at = np.minimum(np.searchsorted(own[k], wanted), len(own[k]) - 1)
            both = int((own[k][at] == wanted).sum())
            if both * containment.denominator >= len(wanted) * containment.numerator:
                yield row + k, item, len(wanted), both


def _search(docs: DataFrame, shared: Broadcast, containment: Fraction) -> DataFrame:
    """One pass over the documents for one block of items."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = _Items(*shared.value)
        for batch in batches:
            out = [(row, items.ids[item], size, both) for row, item, size, both in _matches(items, batch.column("text"), containment)]
            if out:
                rows, ids, sizes, both = (np.array(column, np.int64) for column in zip(*out))
                columns = [batch.column("doc_id").take(pa.array(rows)), pa.array(ids), pa.array(sizes), pa.array(both)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "item_id", "n_item", "n_shared"])

    return docs.mapInArrow(search, "doc_id long, item_id long, n_item long, n_shared long")


def _clean(rows: DataFrame, texts: str, shared: Broadcast, containment: Fraction) -> DataFrame:
    """The rows whose ``texts`` contain no item of one block."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = _Items(*shared.value)
        for batch in batches:
            clean = np.ones(batch.num_rows, bool)
            clean[[row for row, *_ in _matches(items, batch.column(texts), containment)]] = False
            yield batch.filter(pa.array(clean))

    return rows.mapInArrow(keep, rows.schema)


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, containment: Fraction = CONTAINMENT,
    doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """Documents that contain at least ``containment`` of the distinct shingles of a benchmark item.

    One row per pair: ``doc_id, item_id, n_item`` (the item's shingles), ``n_shared`` (those that the document has
    too). Items with a null id, and items and texts that are null or without words, match nothing; an item of one to
    four words is in a document only if that is its whole text. Repeated items with equal id and words count once;
    repeated documents each have their rows; a null doc_id is returned as null. Other columns are ignored; an empty
    table on either side gives an empty result.

    Items travel to the tasks in blocks of bounded size, one pass over the documents for each; documents never move.
    """
    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    found = None
    for block in _blocks(benchmark, item_id, item_text):
        more = _search(plain, docs.sparkSession.sparkContext.broadcast(block), containment)
        found = more if found is None else found.unionByName(more)
    if found is None:
        found = docs.sparkSession.createDataFrame([], "doc_id long, item_id long, n_item long, n_shared long")
    return found


def without_leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without those that contain a benchmark item, all columns as they were.

    Each row is judged by its own text, whatever its ``doc_id``: other rows with an equal or a null one stay. Rows are
    filtered where they are, in one pass for each block of items; nothing is joined.
    """
    texts = fresh(docs, "leak_text")
    rows = docs.select("*", F.col(text).cast("string").alias(texts))
    for block in _blocks(benchmark, "item_id", "text"):
        rows = _clean(rows, texts, docs.sparkSession.sparkContext.broadcast(block), CONTAINMENT)
    return rows.drop(texts)
