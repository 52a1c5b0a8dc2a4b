"""Token counts of the sections of documents.

Each whole document is encoded once. A byte-level vocabulary gives the length of every token, so the running sum
gives its span in the text; the spans are joined to the spans of the sections (lines). A token that crosses a
boundary is allocated by an explicit rule: ``first``, to the section its first character is in, or ``majority``, to
the section that has most of its bytes (the first of several).
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import ship

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"  # ranks of a public vocabulary; any file of that form will do
# Fixed value: the public pattern that splits a text before the vocabulary's merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
RULES = ("first", "majority")
LONG_RUN = 10_000  # white space of this length is cut out before the pattern is matched, which it would overflow

ship(__name__)

_encoders: dict[bytes, tuple[tiktoken.Encoding, np.ndarray]] = {}


def _encoder(vocabulary: bytes) -> tuple[tiktoken.Encoding, np.ndarray]:
    """The encoder of a vocabulary and the length of each token in bytes, made once a process."""
    if vocabulary not in _encoders:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, vocabulary.splitlines())}
        lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            lengths[rank] = len(token)
        _encoders[vocabulary] = tiktoken.Encoding("given", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), lengths
    return _encoders[vocabulary]


def encode(encoder: tiktoken.Encoding, text: str) -> list[int]:
    """The tokens of a whole text.

    The pattern matches a run of white space but for its last character (that one too at the end of the text) in one
    piece, so a very long run is cut out and merged as the piece it is.
    """
    tokens, at = [], 0
    if len(text) >= LONG_RUN:
        for run in re.finditer(rf"\s{{{LONG_RUN},}}", text):
            stop = run.end() if run.end() == len(text) else run.end() - 1
            tokens += encoder.encode_ordinary(text[at : run.start()])
            tokens += encoder._encode_single_piece(text[run.start() : stop])
            at = stop
    return tokens + encoder.encode_ordinary(text[at:] if at else text)


def allocate(starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray, rule: str) -> np.ndarray:
    """The section of each token: ``bounds`` are the sections' first bytes."""
    first = np.searchsorted(bounds, starts, "right") - 1
    if rule == "majority":
        last = np.searchsorted(bounds, ends - 1, "right") - 1
        for k in np.flatnonzero(last > first):
            edges = np.r_[starts[k], bounds[first[k] + 1 : last[k] + 1], ends[k]]
            first[k] += int(np.argmax(np.diff(edges)))
    return first


def count_tokens(
    docs: DataFrame, vocabulary: str = VOCABULARY, rule: str = "first", doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Tokens of each line of each whole text.

    One row per line: ``doc_id, section_no`` (from 0), ``n_chars`` (its line break included), ``n_tokens``,
    ``doc_tokens`` (of the whole text: the sum over its lines). The line break belongs to the line that it ends; a
    text that ends with one has no empty line after it. A text that is null or empty has one row with no tokens.
    Repeated rows and null ids are counted each for itself; other columns are ignored; an empty table gives an
    empty result. ``vocabulary`` is a rank file that the driver can read; its bytes go to the executors.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    with open(vocabulary, "rb") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())

    def one(value: str | None, encoder: tiktoken.Encoding, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        if not value:
            return np.zeros(1, np.int64), np.zeros(1, np.int64), 0
        data = np.frombuffer(value.encode(), np.uint8)
        bounds = np.r_[0, np.flatnonzero(data == 10) + 1]
        bounds = bounds[bounds < len(data)]
        sizes = lengths[np.array(encode(encoder, value), np.int64)]
        ends = np.cumsum(sizes)
        tokens = np.bincount(allocate(ends - sizes, ends, bounds, rule), minlength=len(bounds))
        characters = np.add.reduceat(((data & 0xC0) != 0x80).astype(np.int64), bounds)
        return characters, tokens, len(sizes)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, lengths = _encoder(shared.value)
        for batch in batches:
            counted = [one(value.as_py(), encoder, lengths) for value in batch.column("text")]
            rows = np.array([len(characters) for characters, _, _ in counted])
            columns = [
                batch.column("doc_id").take(pa.array(np.repeat(np.arange(len(rows)), rows))),
                pa.array(np.concatenate([np.arange(size) for size in rows])),
                pa.array(np.concatenate([characters for characters, _, _ in counted])),
                pa.array(np.concatenate([tokens for _, tokens, _ in counted])),
                pa.array(np.repeat(np.array([total for _, _, total in counted]), rows)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "section_no", "n_chars", "n_tokens", "doc_tokens"])

    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return plain.mapInArrow(count, "doc_id long, section_no long, n_chars long, n_tokens long, doc_tokens long")
