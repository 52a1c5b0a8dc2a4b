"""Near copies of embeddings by counting collisions of one-dimensional projections.

Unit vectors with a cosine of at least s lie within delta = sqrt(2 - 2s) of each other. Each vector is projected
on ``PROJECTIONS`` orthonormal directions. On one direction a close pair differs by delta / sqrt(size) on average;
the window around a query's projection is ``WIDTH`` times that. How many of the windows a pair must collide in is
calibrated: the largest count that a pair at the very threshold reaches with the wanted recall.

A pair that reaches the count misses at most PROJECTIONS - count windows, so of that many bands plus one, each of
some projections, one collides in full. Bands are joined on sorted projections: the first ones are cut into cells
two windows wide, a query looks into the cells that its windows touch, and the join tests all windows of the band.
Pairs found are counted over all projections, and those passing the count are verified by their exact cosine.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import Workspace, ship
from millrace.llm.components import connected_components
from millrace.llm.shingles import mix

SIMILARITY = 0.98
PROJECTIONS = 24
WIDTH = 2.5  # half width of a window, in mean differences of a pair at the threshold
RECALL = 0.999  # of pairs at the threshold; closer pairs are found more often
CELLS = 4  # projections of a band that are cut into cells
SEED = 20

ship(__name__)


def calibrated_count(projections: int = PROJECTIONS, width: float = WIDTH, recall: float = RECALL) -> int:
    """The largest collision count that a pair at the threshold reaches with probability ``recall``.

    Its difference on one direction is close to normal, so it collides with probability erf(width / sqrt 2),
    and its collisions are close to binomial.
    """
    p = math.erf(width / math.sqrt(2))
    reached = 0.0
    for count in range(projections, -1, -1):
        reached += math.comb(projections, count) * p**count * (1 - p) ** (projections - count)
        if reached >= recall:
            return count
    return 0


def directions(size: int, projections: int = PROJECTIONS) -> np.ndarray:
    """Orthonormal columns, as many as asked for or as fit; the same on every machine."""
    columns = min(size, projections)
    numbers = np.arange(size * columns, dtype=np.uint64) * np.uint64(2) + np.uint64((SEED << 32) + (size << 8))
    uniform = [(mix(numbers + np.uint64(k)) >> np.uint64(11)).astype(float) / 2.0**53 + 2.0**-54 for k in (0, 1)]
    normal = np.sqrt(-2 * np.log(uniform[0])) * np.cos(2 * np.pi * uniform[1])
    return np.linalg.qr(normal.reshape(size, columns))[0]


def missable(size: int, projections: int = PROJECTIONS, width: float = WIDTH) -> int:
    """Windows that a pair at the threshold may miss: by the calibrated count, and never more than fit.

    The directions are orthonormal, so m missed windows need m * width ** 2 <= size.
    """
    return min(projections - calibrated_count(projections, width), int(size / width**2))


def _classes(vectors: DataFrame, vec_id: str, embedding: str, label: str) -> DataFrame:
    """``vec_id, label, vector, node``: rows of equal label and vector share a node; null if it links with nothing."""
    plain = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"),
        F.col(embedding).cast("array<double>").alias("vector"),
        F.col(label).cast("string").alias("label"),
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    usable = F.col("label").isNotNull() & finite & F.exists("vector", lambda x: x != 0)
    return plain.withColumn("node", F.when(F.coalesce(usable, F.lit(False)), F.xxhash64("label", "vector")))


def _projected(nodes: DataFrame) -> DataFrame:
    """``node, space`` (hash of label and size), ``size`` and ``p``, the projections of the unit vector."""

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.asarray(batch.column("size"))
            for size in np.unique(sizes):
                own = batch.filter(pa.array(sizes == size))
                matrix = np.asarray(own.column("vector").flatten(), float).reshape(own.num_rows, size)
                matrix = matrix / np.abs(matrix).max(axis=1, keepdims=True)
                matrix /= np.linalg.norm(matrix, axis=1, keepdims=True)
                found = pa.array(list(matrix @ directions(int(size))), pa.list_(pa.float64()))
                columns = [own.column(k) for k in ("node", "space", "size")]
                yield pa.RecordBatch.from_arrays([*columns, found], ["node", "space", "size", "p"])

    size = F.size("vector").alias("size")
    spaced = nodes.select("node", F.xxhash64("label", F.size("vector")).alias("space"), size, "vector")
    return spaced.mapInArrow(project, "node long, space long, size int, p array<double>")


def _band_rows(projected: DataFrame, delta: float, looks: bool) -> DataFrame:
    """``cell, node, w, reach``: a row for each band (``looks`` false), or for each cell that its windows touch.

    On the first projection a query looks upwards only: of each pair one end sees the other. A window is as wide
    as a cell, so it touches two cells at most.
    """

    def of_band(p: np.ndarray, space: np.ndarray, band: int, reach: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        own = p[:, :CELLS]
        down = np.r_[0.0, np.full(own.shape[1] - 1, reach)] if looks else 0.0
        low, high = np.floor((own - down) / (2 * reach)), np.floor((own + (reach if looks else 0.0)) / (2 * reach))
        for step in product((0, 1), repeat=own.shape[1]) if looks else [(0,) * own.shape[1]]:
            rows = np.flatnonzero((low + step <= high).all(axis=1))
            key = mix(space[rows].view(np.uint64) + np.uint64(band))
            for column in (low[rows] + step).astype(np.int64).T:
                key = mix(key * np.uint64(31) + column.view(np.uint64))
            yield rows, key.view(np.int64)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.asarray(batch.column("size"))
            for size in np.unique(sizes):
                part = batch.filter(pa.array(sizes == size))
                p = np.stack(part.column("p").to_numpy(zero_copy_only=False))
                node, space = (np.asarray(part.column(k)).copy() for k in ("node", "space"))
                reach, bands = WIDTH * delta / math.sqrt(size), missable(int(size)) + 1
                for band in range(bands):
                    own = p[:, band::bands]
                    for at, key in of_band(own, space, band, reach):
                        windows = pa.array(list(own[at].astype(np.float32)), pa.list_(pa.float32()))
                        columns = [pa.array(key), pa.array(node[at]), windows, pa.array(np.full(len(at), reach))]
                        yield pa.RecordBatch.from_arrays(columns, ["cell", "node", "w", "reach"])

    return projected.mapInArrow(rows, "cell long, node long, w array<float>, reach double")


def _found(projected: DataFrame, delta: float) -> DataFrame:
    """Distinct pairs ``a < b`` that collide in all windows of a band."""
    query = _band_rows(projected, delta, True).select("cell", F.col("node").alias("a"), F.col("w").alias("wa"), "reach")
    base = _band_rows(projected, delta, False).select("cell", F.col("node").alias("b"), F.col("w").alias("wb"))
    slack = F.col("reach") * F.lit(1 + 1e-5)  # projections are rounded to single precision here
    none = F.lit(0.0)
    above = F.coalesce(F.get("wb", F.lit(0)) - F.get("wa", F.lit(0)), none)
    collide = (F.col("a") != F.col("b")) & (above >= F.lit(-1e-6)) & (above <= slack)
    for k in range(1, max(-(-min(size, PROJECTIONS) // (missable(size) + 1)) for size in range(1, PROJECTIONS + 1))):
        collide &= F.coalesce(F.abs(F.get("wb", F.lit(k)) - F.get("wa", F.lit(k))), none) <= slack
    met = query.join(base, "cell").where(collide)
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _verified(pairs: DataFrame, nodes: DataFrame, projected: DataFrame, delta: float, similarity: float) -> DataFrame:
    """Pairs with enough collisions, one label, one size and a cosine of at least ``similarity``."""
    known = projected.select("node", "size", "p").join(nodes.select("node", "label", "vector"), "node")

    def end(name: str) -> DataFrame:
        return known.select(F.col("node").alias(name), *(F.col(c).alias(c + name) for c in ("size", "p", "label", "vector")))

    def dot(x: str, y: str) -> Column:
        products = F.zip_with(x, y, lambda left, right: left * right)
        return F.aggregate(products, F.lit(0.0), lambda total, one: total + one)

    reach = F.lit(WIDTH * delta * (1 + 1e-9)) / F.sqrt("sizea")
    missed = F.size(F.filter(F.zip_with("pa", "pb", lambda x, y: F.abs(x - y) > reach), lambda x: x))
    allowed = F.least(F.lit(missable(1 << 30)), (F.col("sizea") / F.lit(WIDTH**2)).cast("int"))
    alike = (F.col("labela") == F.col("labelb")) & (F.col("sizea") == F.col("sizeb")) & (missed <= allowed)
    cosine = dot("vectora", "vectorb") / (F.sqrt(dot("vectora", "vectora")) * F.sqrt(dot("vectorb", "vectorb")))
    return pairs.join(end("a"), "a").join(end("b"), "b").where(alike).where(cosine >= F.lit(similarity)).select("a", "b")


def _unscaled(vector: Column) -> Column:
    """Very large or small vectors brought to a size whose squares are ordinary numbers."""
    most = F.array_max(F.transform(vector, F.abs))
    return F.when(most.between(1e-100, 1e100), vector).otherwise(F.transform(vector, lambda x: x / most))


def near_copies(
    vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
    similarity: float = SIMILARITY,
) -> DataFrame:
    """Vectors of equal label linked by a cosine of at least ``similarity``.

    One row per vector: ``vec_id, n_links`` (other rows linked directly, equal vectors included),
    ``component_id`` (smallest vec_id reachable by links, its own included), ``kept`` (vec_id = component_id).
    A vector that is null, empty, zero or has a null or non-finite component, or whose label is null, links with
    nothing and is its own component; so do vectors of different sizes. Rows with a null vec_id are linked like
    others and never kept; repeated rows count as links of each other. Other columns are ignored.
    """
    with Workspace(vectors.sparkSession, "embeddings") as work:
        delta = math.sqrt(2 - 2 * similarity)
        rows = _classes(vectors, vec_id, embedding, label)
        grouped = rows.where("node is not null").groupBy("node", "label", "vector")
        nodes = grouped.agg(F.count("*").alias("copies"), F.min("vec_id").alias("vec_id"))
        nodes = work.keep(nodes.withColumn("vector", _unscaled(F.col("vector"))))
        projected = work.keep(_projected(nodes))
        pairs = work.keep(_found(projected, delta))
        links = work.keep(_verified(pairs, nodes, projected, delta, similarity))
        groups = connected_components(links, work)
        ends = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        copies = nodes.select(F.col("node").alias("b"), "copies")
        others = ends.join(copies, "b").groupBy(F.col("a").alias("node")).agg(F.sum("copies").alias("others"))
        joined = nodes.select("node", "copies", "vec_id").join(others, "node", "left").join(groups, "node", "left")
        joined = joined.withColumn("component", F.coalesce("component", "node"))
        first = joined.groupBy("component").agg(F.min("vec_id").alias("first"))
        labels = joined.join(first, "component").select(
            "node", "first", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("links")
        )
        out = rows.select("vec_id", "node").join(labels, "node", "left")
        component = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("first"))
        return work.result(
            out.select(
                "vec_id",
                F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                component.alias("component_id"),
                F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
            )
        )
