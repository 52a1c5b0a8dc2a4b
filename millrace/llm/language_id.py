"""Language identification by compression.

A text is encoded with a zstandard dictionary of each language, made of raw text in it; the language whose
dictionary gives the fewest bytes is chosen, and the choice is rejected when the runner-up is about as good.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import Workspace, pick, position, ship

SAMPLE_DOCS = 400  # labelled documents of each language that its dictionary is made of, at most
BLOCK = 256  # bytes of a dictionary that come from one place of a document
DICTIONARY = 96 * 1024  # bytes of a dictionary, at most
ALL_DICTIONARIES = 16 * 1024 * 1024  # bytes of all dictionaries together, which travel to every task
PIECE = 4096  # bytes of a text that are encoded together; the sizes of all pieces of the whole text add up
LEVEL = 6  # lower levels miss too many matches in short texts
MIN_MARGIN = 0.02  # share of the runner-up's size by which the best must be smaller
SURE_MARGIN = 0.25  # margin from which the score is 1
UNKNOWN = "und"
HELD_OUT = 1  # remainder of crc32(doc_id as text) modulo 3 of the documents that nothing is learnt from

_NOT_LETTERS = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

ship(__name__)


@dataclass(frozen=True)
class LanguageModel:
    """Languages with their dictionaries, the ones with more labelled documents first."""

    dictionaries: tuple[tuple[str, bytes], ...]


def normal(text: str) -> bytes:
    """The words of a text in lower case, without ASCII digits and marks, joined by spaces."""
    return b" ".join(text.lower().encode().translate(_NOT_LETTERS).split())


def _has_letter(text: str, words: bytes) -> bool:
    return re.search(rb"[a-z]", words) is not None or any(character.isalpha() for character in text)


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document is held out; a null id is not."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == HELD_OUT, F.lit(False))


def train_languages(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang"
) -> LanguageModel:
    """Dictionaries from the labelled documents that are not held out.

    Of each language the ``SAMPLE_DOCS`` documents with the smallest hashes give one block each, from a place in
    the whole text that the hash tells; equal texts give one. Null languages and texts teach nothing.
    """
    plain = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"), F.col(lang).alias("lang"))
    known = plain.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
    with Workspace(docs.sparkSession, "languages") as work:
        hashed = known.select("lang", F.xxhash64("text").alias("at"))
        # A window with a limit on its number: every task sends on that many rows of a language at most.
        order = F.row_number().over(Window.partitionBy("lang").orderBy("at"))
        hashed = hashed.distinct().withColumn("order", order).where(F.col("order") <= SAMPLE_DOCS)
        chosen = work.keep(hashed.select("lang", "at"))
        counts = dict(known.groupBy("lang").count().join(chosen.select("lang").distinct(), "lang").collect())

        def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = []
                for at, value in zip(batch.column("at").to_pylist(), batch.column("text").to_pylist()):
                    words = normal(value)
                    place = at % max(1, len(words) - BLOCK + 1)
                    found.append(words[place : place + BLOCK])
                columns = [batch.column("lang"), batch.column("at"), pa.array(found, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "at", "block"])

        texts = known.withColumn("at", F.xxhash64("text")).join(chosen, ["lang", "at"], "left_semi")
        parts = texts.select("lang", "at", "text").mapInArrow(blocks, "lang string, at long, block binary")
        rows = parts.distinct().orderBy("lang", "at").collect()  # SAMPLE_DOCS blocks of a language at most
    size = min(DICTIONARY, ALL_DICTIONARIES // max(1, len(counts)))
    made: dict[str, bytes] = {name: b"" for name in counts}
    for row in rows:
        made[row["lang"]] += bytes(row["block"]) + b" "
    order = sorted(counts, key=lambda name: (-counts[name], name))
    return LanguageModel(tuple((name, made[name][:size]) for name in order if made[name].strip()))


def _encoders(model: LanguageModel) -> list[zstandard.ZstdCompressor]:
    out = []
    for _, content in model.dictionaries:
        dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        dictionary.precompute_compress(level=LEVEL)
        options = {"write_checksum": False, "write_content_size": False, "write_dict_id": False}
        out.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, **options))
    return out


def _judge(texts: pa.Array, model: LanguageModel, encoders: list[zstandard.ZstdCompressor]) -> tuple[list[str], np.ndarray]:
    """The language of each text and the margin to the runner-up; ``und`` with 0 where there is none."""
    languages, margins = [], np.zeros(len(texts))
    for row, value in enumerate(texts.to_pylist()):
        words = normal(value) if value is not None else b""
        if value is None or not encoders or not _has_letter(value, words):
            languages.append(UNKNOWN)
            continue
        pieces = [words[k : k + PIECE] for k in range(0, len(words), PIECE)]
        sizes = np.array([sum(len(one.compress(piece)) for piece in pieces) for one in encoders], float)
        order = np.argsort(sizes, kind="stable")
        languages.append(model.dictionaries[order[0]][0])
        margins[row] = 1 - sizes[order[0]] / sizes[order[1]] if len(order) > 1 else 1.0
    return languages, margins


def identify_languages(
    docs: DataFrame, model: LanguageModel, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The language of every whole text.

    One row per document: ``doc_id, held_out, lang_pred`` (``und`` if the text is null or has no letter, or nothing
    was learnt), ``score`` (0 to 1: the margin, the share of the runner-up's size by which the best encoding is
    smaller, divided by ``SURE_MARGIN``; 1 for the only language, 0 for ``und``), ``rejected`` (the margin is below
    ``MIN_MARGIN``, or ``und``). Equal sizes go to the language with more labelled documents. Repeated rows and null
    ids are judged each for itself; other columns are not looked at; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model.dictionaries)

    def identify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = LanguageModel(shared.value)
        encoders = _encoders(known)
        for batch in batches:
            languages, margins = _judge(batch.column("text"), known, encoders)
            columns = [
                batch.column("doc_id"),
                batch.column("held_out"),
                pa.array(languages, pa.string()),
                pa.array(np.minimum(1.0, margins / SURE_MARGIN)),
                pa.array(margins < MIN_MARGIN),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "lang_pred", "score", "rejected"])

    plain = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), held_out(doc_id).alias("held_out"), F.col(text).cast("string").alias("text")
    )
    return plain.mapInArrow(identify, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")


def keep_identified(
    docs: DataFrame, model: LanguageModel | None = None, doc_id: str = "doc_id", text: str = "text", lang: str = "lang"
) -> DataFrame:
    """``docs`` without those whose language is rejected, all columns and other rows as they were.

    Without a model the dictionaries are made of the labelled rows of ``docs``.
    """
    model = model or train_languages(pick(docs, doc_id=doc_id, text=text, lang=lang))
    at = position(docs, text)
    shared = docs.sparkSession.sparkContext.broadcast(model.dictionaries)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = LanguageModel(shared.value)
        encoders = _encoders(known)
        for batch in batches:
            _, margins = _judge(batch.column(at), known, encoders)
            yield batch.filter(pa.array(margins >= MIN_MARGIN))

    return docs.mapInArrow(keep, docs.schema)
