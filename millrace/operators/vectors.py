"""Embedding, nearest rows, similarity rows and retrieval context."""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Callable, Iterator, Sequence
from functools import reduce
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import vectors as V
from millrace.operators.project import joined_text
from millrace.session import file_names, scratch, steps

BLOCK_QUERIES = 8_192  # query vectors shipped to the tasks at once, at most; half as many on average
MODEL_BATCH = 512  # texts per model call
CHUNK_CELLS = 1_000_000  # distances held at once
REPEATED = "query ids are repeated"

Embedder = Callable[[Sequence[str]], np.ndarray]

# The helpers below travel inside the tasks, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


# -- embedding ----------------------------------------------------------------------------------


def hashed_words(size: int = 64) -> Embedder:
    """Deterministic offline embedder: counts of hashed lower-case words, scaled to length one.

    A text without words gives the zero vector.
    """

    def embed(texts: Sequence[str]) -> np.ndarray:
        split = [text.lower().split(" ") for text in texts]
        codes, words = pd.factorize(np.array(list(chain.from_iterable(split)), dtype=object))
        hashed = [int.from_bytes(hashlib.md5(word.encode()).digest()[:2], "big") % size for word in words]
        rows = np.repeat(np.arange(len(split)), [len(parts) for parts in split])
        filled = (words != "")[codes]
        cells = (rows * size + np.array(hashed)[codes])[filled]
        counts = np.bincount(cells, minlength=len(split) * size).reshape(len(split), size).astype(float)
        lengths = np.sqrt((counts**2).sum(axis=1, keepdims=True))
        return np.divide(counts, lengths, out=counts, where=lengths > 0)

    return embed


def embed_text(df: DataFrame, text: str, embedder: Embedder | None = None, name: str = "embedding") -> DataFrame:
    """Add the embedding of a text column, a batch of rows per model call; null text gives null.

    ``embedder`` maps a list of texts to a matrix, one row per text; it is shipped to the executors.
    Filter rows before embedding: the call is marked as not repeatable, so that no later filter makes
    the optimizer run the model a second time.
    """
    model = embedder or hashed_words()

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def embed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            filled = texts.notna()
            vectors = pd.Series([None] * len(texts), index=texts.index, dtype=object)
            known = texts[filled]
            for start in range(0, len(known), MODEL_BATCH):
                part = known.iloc[start : start + MODEL_BATCH]
                vectors[part.index] = pd.Series(list(np.asarray(model(part.tolist()), dtype=float)), index=part.index)
            yield vectors

    return df.withColumn(name, embed.asNondeterministic()(F.col(text)))


# -- nearest rows -------------------------------------------------------------------------------


def nearest_to(
    df: DataFrame, vector: Sequence[float], k: int = 3, id_column: str = "vec_id", column: str = "embedding"
) -> DataFrame:
    """The ``k`` rows nearest to one vector by Euclidean distance, ascending, ties by id.

    All native: every task keeps its own best ``k`` rows and only those move. Rows without a comparable
    vector are left out; the null test comes after the limit, as before it the distance would be
    computed a second time to decide the filter.
    """
    wanted = F.array(*[F.lit(float(x)) for x in vector])
    sized = df.filter(F.size(column) == len(vector))
    scored = sized.withColumn("distance", V.euclidean_distance(F.col(column), wanted))
    return scored.orderBy(F.asc_nulls_last("distance"), id_column).limit(k).filter(F.col("distance").isNotNull())


def _matrix(vectors) -> np.ndarray:
    lengths = vectors.value_lengths().unique()
    if len(lengths) > 1:
        raise ValueError(f"vectors differ in length: {lengths.to_pylist()[:5]}")
    return np.asarray(vectors.flatten(), dtype=float).reshape(len(vectors), -1)


def _stored_blocks(queries: DataFrame, keep: Callable[[DataFrame], DataFrame]) -> Iterator[pa.Table]:
    """``query_id, vector`` rows in stored blocks, of which the driver holds one at a time.

    Ids are unique, so their hash deals them out evenly: a block has half of ``BLOCK_QUERIES`` rows on average.
    """
    known = keep(queries.dropna())
    if not known.groupBy("query_id").count().filter("count > 1").isEmpty():
        raise ValueError(REPEATED)
    blocks = -(-2 * known.count() // BLOCK_QUERIES)
    dealt = known.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(max(1, blocks))))
    stored = keep(dealt.repartitionByRange(max(1, blocks), "block"))  # a block's rows lie together: others are not read
    for block in range(blocks):
        found = stored.filter(F.col("block") == block).select("query_id", "vector").toArrow()
        if found.num_rows:
            yield found.combine_chunks()


def _first_of_each(found: pa.Table, k: int) -> pa.Table:
    """The ``k`` smallest (distance, base_id) of every ``q``."""
    found = found.sort_by([("q", "ascending"), ("distance", "ascending"), ("base_id", "ascending")])
    q = found.column("q").to_numpy()
    return found.filter(pa.array(np.arange(len(q)) - np.searchsorted(q, q) < k))


def _scan_chunk(ids: pa.Array, part: np.ndarray, wanted: np.ndarray, best: pa.Table | None, k: int, digits: int | None):
    """``best`` after one chunk of base rows.

    One matrix product bounds all distances; those that may be among the ``k`` smallest are computed anew
    from the differences, so the product's rounding never decides.
    """
    sizes, lengths = np.square(part).sum(axis=1), np.square(wanted).sum(axis=1)
    near = sizes[:, None] + lengths[None, :]
    slack = near * (part.shape[1] + 4) * 1e-15
    near -= 2 * (part @ wanted.T)
    bound = np.full(len(wanted), np.inf)
    if len(part) >= k:
        bound = np.sqrt(np.maximum(np.partition(near + slack, k - 1, axis=0)[k - 1], 0))
    if best is not None:
        q = best.column("q").to_numpy()
        full = np.flatnonzero(np.bincount(q, minlength=len(wanted)) == k)
        last = best.column("distance").to_numpy()[np.searchsorted(q, full, side="right") - 1]
        bound[full] = np.minimum(bound[full], last)
    rounding = 0.0 if digits is None else 10.0**-digits
    rows, q = np.nonzero(near - slack <= np.square(bound + rounding)[None, :] * (1 + 1e-12))
    gaps = np.sqrt(np.square(part[rows] - wanted[q]).sum(axis=1))
    if digits is not None:
        gaps = np.round(gaps, digits)
    found = pa.table({"q": q, "base_id": ids.take(pa.array(rows)), "distance": gaps})
    return _first_of_each(found if best is None else pa.concat_tables([best, found]), k)


def _scan(base: DataFrame, block: pa.Table, k: int, digits: int | None, schema: T.StructType) -> DataFrame:
    """The ``k`` best rows of every task for the queries of one block. The base is read where it lies."""
    wanted = _matrix(block.column("vector").combine_chunks())
    good = np.isfinite(wanted).all(axis=1)
    names = block.column("query_id").combine_chunks().filter(pa.array(good))
    shared = base.sparkSession.sparkContext.broadcast((names, wanted[good]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, wanted = shared.value
        best = None
        step = max(1, CHUNK_CELLS // max(1, len(wanted)))
        for batch in batches:
            batch = batch.drop_null()
            if not batch.num_rows or not len(wanted):
                continue
            ids, rows = batch.column("base_id"), _matrix(batch.column("vector"))
            if rows.shape[1] != wanted.shape[1]:
                raise ValueError(f"vectors differ in length: {[rows.shape[1], wanted.shape[1]]}")
            finite = np.isfinite(rows).all(axis=1)
            ids, rows = ids.filter(pa.array(finite)), rows[finite]
            for start in range(0, len(rows), step):
                best = _scan_chunk(ids[start : start + step], rows[start : start + step], wanted, best, k, digits)
        if best is not None:
            found = pa.table(
                {"query_id": names.take(best.column("q")), "base_id": best["base_id"], "distance": best["distance"]}
            )
            yield from found.to_batches(max_chunksize=10_000)

    return base.mapInArrow(scan, schema)


def nearest_for_each(
    queries: DataFrame,
    base: DataFrame,
    k: int = 3,
    query_id: str = "query_id",
    base_id: str = "vec_id",
    column: str = "embedding",
    digits: int | None = None,
) -> DataFrame:
    """For every query row its ``k`` nearest base rows: query_id, rank, base_id, distance. Exact.

    One way at every size: queries are stored in blocks; for each block the tasks read the base where it lies, a
    chunk at a time, and write their best ``k`` rows for each of its queries to the shared folder. The base never
    moves, and what is shipped or held is one block and one chunk. A block costs one scan of the base, whose
    reading is little beside its ``BLOCK_QUERIES / 2`` distances a row.
    Vectors must share one length; null vectors and those with non-finite components are left out. Repeated query
    ids are refused, as their matches could not be told apart.
    ``digits`` rounds distances before ranking, which makes near-ties stable.
    """
    queries = queries.select(F.col(query_id).alias("query_id"), F.col(column).alias("vector"))
    base = base.select(F.col(base_id).alias("base_id"), F.col(column).alias("vector"))
    schema = T.StructType(
        [
            T.StructField("query_id", queries.schema["query_id"].dataType),
            T.StructField("base_id", base.schema["base_id"].dataType),
            T.StructField("distance", T.DoubleType()),
        ]
    )
    spark = base.sparkSession
    found = scratch(spark, "nearest")
    with steps(spark) as keep:
        for block in _stored_blocks(queries, keep):
            _scan(base, block, k, digits, schema).write.mode("append").parquet(found)
    spark.createDataFrame([], schema).write.mode("append").parquet(found)  # the folder is there without a query, too
    window = Window.partitionBy("query_id").orderBy("distance", "base_id")
    ranked = spark.read.schema(schema).parquet(found).withColumn("rank", F.row_number().over(window))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "base_id", "distance")


def approximate_nearest(
    df: DataFrame,
    vector: Sequence[float],
    k: int = 3,
    id_column: str = "vec_id",
    column: str = "embedding",
    bucket_length: float = 2.0,
    tables: int = 4,
    seed: int = 7,
) -> DataFrame:
    """Approximate form of ``nearest_to``: only rows sharing a hash bucket with the query are ranked.

    Buckets that hold fewer than ``k`` rows give fewer; a larger ``bucket_length`` or more ``tables`` find more.
    """
    from pyspark.ml.feature import BucketedRandomProjectionLSH
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.linalg import Vectors

    hashed = df.withColumn("_features", array_to_vector(F.col(column)))
    lsh = BucketedRandomProjectionLSH(
        inputCol="_features", outputCol="_hashes", bucketLength=bucket_length, numHashTables=tables, seed=seed
    )
    near = lsh.fit(hashed).approxNearestNeighbors(hashed, Vectors.dense(list(vector)), k, distCol="distance")
    return near.drop("_features", "_hashes")


def similarity_rows(
    df: DataFrame, anchors: DataFrame, anchor_id: str, column: str = "embedding", name: str = "similarities"
) -> DataFrame:
    """Rows of a similarity matrix, in blocks of anchors: ``name`` is an array of (anchor, similarity), by anchor.

    ``anchors`` has an id and a vector called ``column``. There is one output row for each row of ``df`` and block
    of at most about ``BLOCK_QUERIES`` anchors, so a row stays bounded however many anchors there are; ``df`` is
    read where it lies, once a block. Similarity is null where a vector is all zeros or not finite. Rows of ``df``
    without a vector are left out, as are anchors without one; without anchors there are no rows.
    """
    queries = anchors.select(F.col(anchor_id).alias("query_id"), F.col(column).alias("vector"))
    cell = T.StructType([T.StructField("anchor", queries.schema["query_id"].dataType), T.StructField("similarity", T.DoubleType())])
    rows = df.filter(F.col(column).isNotNull())
    spark = df.sparkSession
    with steps(spark) as keep:
        parts = [_similar(rows, block, column, name, cell) for block in _stored_blocks(queries, keep)]
    if not parts:
        return rows.withColumn(name, F.lit(None).cast(T.ArrayType(cell))).limit(0)
    return reduce(DataFrame.unionByName, parts)


def _similar(rows: DataFrame, block: pa.Table, column: str, name: str, cell: T.StructType) -> DataFrame:
    block = block.sort_by("query_id")
    matrix = _matrix(block.column("vector").combine_chunks())
    with np.errstate(all="ignore"):
        unit = matrix / np.sqrt(np.square(matrix).sum(axis=1, keepdims=True))
    ids = block.column("query_id").combine_chunks()
    shared = rows.sparkSession.sparkContext.broadcast(unit)

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def similarities(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        unit = shared.value
        step = max(1, CHUNK_CELLS // max(1, len(unit)))
        for vectors in batches:
            if vectors.map(len).ne(unit.shape[1]).any():
                raise ValueError("vectors differ in length")
            found = []
            for start in range(0, len(vectors), step):
                part = np.stack(vectors.iloc[start : start + step].to_numpy()).astype(float)
                with np.errstate(all="ignore"):
                    found.extend((part / np.sqrt(np.square(part).sum(axis=1, keepdims=True))) @ unit.T)
            yield pd.Series(found, index=vectors.index, dtype=object)

    named = F.lit(ids.to_pylist()) if len(ids) else F.array()
    pairs = F.zip_with(
        named, similarities(F.col(column)), lambda a, x: F.struct(a.alias("anchor"), F.nullif(x, F.lit(float("nan"))).alias("similarity"))
    )
    return rows.withColumn(name, pairs.cast(T.ArrayType(cell)))


class VectorStore:
    """Vectors kept by the digest of their text: a text is embedded once, whatever rows hold it.

    ``path`` is a folder that all executors reach; ``model`` names the embedder, as vectors of one model are of
    no use to another. Runs only add files, so a run that dies leaves a store that is right, and two runs at a
    time may write a vector twice, which readers see once.
    """

    SCHEMA = "digest string, embedding array<double>"

    def __init__(self, spark: SparkSession, path: str, model: str = "hashed_words_64", embedder: Embedder | None = None):
        self.spark, self.path, self.embedder = spark, f"{path.rstrip('/')}/model={model}", embedder

    def read(self) -> DataFrame:
        """``digest, embedding``, one row a digest."""
        if not file_names(self.spark, self.path):
            return self.spark.createDataFrame([], self.SCHEMA)
        return self.spark.read.schema(self.SCHEMA).parquet(self.path).dropDuplicates(["digest"])

    def add(self, texts: DataFrame, text: str = "text") -> None:
        """Embed the texts whose digests are not there yet, each once. Null texts have no vector."""
        asked = texts.select(F.sha2(F.col(text), 256).alias("digest"), F.col(text).alias("text")).dropna()
        new = asked.join(self.read().select("digest"), "digest", "left_anti").dropDuplicates(["digest"])
        embedded = embed_text(new, "text", self.embedder).select("digest", "embedding")
        embedded.write.mode("append").parquet(self.path)

    def vectors(self, df: DataFrame, text: str = "text", name: str = "embedding") -> DataFrame:
        """``df`` with the stored vector of its text, null where there is none. ``add`` first."""
        digest = f"_digest_of_{name}"
        stored = self.read().select(F.col("digest").alias(digest), F.col("embedding").alias(name))
        return df.withColumn(digest, F.sha2(F.col(text), 256)).join(stored, digest, "left").drop(digest)


# -- retrieval ----------------------------------------------------------------------------------


def retrieval_context(matches: DataFrame, base: DataFrame, base_id: str, text: str) -> DataFrame:
    """Per query the texts of its matches, nearest first, joined by `` / ``.

    ``matches`` comes from ``nearest_for_each``, which stores them, so Spark knows how large they are.
    """
    named = matches.join(base.select(F.col(base_id).alias("base_id"), F.col(text).alias("context")), "base_id")
    return joined_text(named, "context", " / ", groups=["query_id"])


def prompt(contexts: DataFrame, questions: DataFrame, query_id: str, question: str) -> DataFrame:
    """The question template filled with each question's context."""
    asked = questions.select(F.col(query_id).alias("query_id"), F.col(question).alias("question"))
    # Fixed value: the wording of the prompt.
    text = F.format_string("\nContext:\n%s\n\nQuestion:\n%s\n", "context", "question")
    return asked.join(contexts, "query_id").select("query_id", text.alias("prompt"))
