"""Byte-level BPE over whole texts: ids with their places in the text, and the way back to bytes.

The ``tokenizers`` library encodes Arrow batches, stretch by stretch. Its model works on characters, so every byte stands
for one printable character (``byte_characters``). The tokens' lengths in bytes, mapped to the text's characters, give
their offsets; a character whose bytes lie in several tokens belongs to each of them. Only a file of ranks is given: a token's merge is the last step of merging its
own bytes by the lower ranks. Whatever stands beside those bytes, they end as the same two parts just before that merge,
since no merge of a lower rank crossed them; so these merges give what merging by rank gives.

Decoding turns ids into the bytes that their characters stand for. Cut anywhere, ids may begin or end inside a character:
the bytes are always right, and as text the incomplete characters become U+FFFD and are counted.
"""

from __future__ import annotations

import base64
import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, Tokenizer, decoders, models, pre_tokenizers

from millrace.llm.common import pick, ship

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"  # ranks of a public vocabulary; any file of that form will do
# Fixed value: the public pattern that splits a text before the vocabulary's merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
ROW_CHARS = 1 << 16  # new stretches encoded at once: an encoding takes some hundred bytes a token
KNOWN = 1 << 18  # stretches kept; beyond that they are forgotten and encoded again
BATCH = 1 << 19  # bytes of text, or ids, worked on at once; a longer text is alone

_CUT = re.compile(r"(?<=\S)(?=[ \n])")  # what is white space to the pattern is so to \S too

ship(__name__)

_forms: dict[tuple[bytes, str], str] = {}
_tokenizers: dict[str, Tokenizer] = {}
_tokens: dict[str, dict[int, bytes]] = {}


def byte_characters() -> dict[int, str]:
    """The character that stands for each byte: itself if printable, else the next one from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [byte for byte in range(256) if byte not in printable]
    return {byte: chr(byte) for byte in printable} | {byte: chr(256 + k) for k, byte in enumerate(others)}


def read_ranks(vocabulary: bytes) -> dict[bytes, int]:
    """Ranks of the tokens in a file with one base64 token and its rank a line."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, vocabulary.splitlines())}


def last_merge(token: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """The two parts that become ``token`` in the last step of merging its bytes."""
    parts = [token[k : k + 1] for k in range(len(token))]
    while len(parts) > 2:
        pairs = [ranks.get(a + b, len(ranks)) for a, b in zip(parts, parts[1:])]
        least = min(pairs)
        if least >= ranks[token]:
            return []  # merging its bytes never gives this token; it still stands for a match that equals it
        at = pairs.index(least)
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


def build_tokenizer(vocabulary: bytes, pattern: str = PATTERN) -> str:
    """The tokenizer of a file of ranks, in the library's JSON form; there are no special tokens. Made once a process."""
    if (vocabulary, pattern) in _forms:
        return _forms[vocabulary, pattern]
    ranks, characters = read_ranks(vocabulary), byte_characters()

    def written(token: bytes) -> str:
        return "".join(map(characters.__getitem__, token))

    ordered = sorted((token for token in ranks if len(token) > 1), key=ranks.__getitem__)
    merges = [tuple(map(written, parts)) for token in ordered if (parts := last_merge(token, ranks))]
    model = models.BPE(vocab={written(t): rank for t, rank in ranks.items()}, merges=merges, ignore_merges=True)
    tokenizer = Tokenizer(model)
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence(
        [pre_tokenizers.Split(Regex(pattern), "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
    )
    tokenizer.decoder = decoders.ByteLevel()
    _forms[vocabulary, pattern] = tokenizer.to_str()
    return _forms[vocabulary, pattern]


def _tokenizer(form: str) -> Tokenizer:
    """The tokenizer of a JSON form, made once a process. Spark has a process a core, so it must not start threads."""
    if form not in _tokenizers:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _tokenizers[form] = Tokenizer.from_str(form)
    return _tokenizers[form]


def _token_bytes(form: str) -> dict[int, bytes]:
    """The bytes of each id, by the reversed table of characters."""
    if form not in _tokens:
        back = {character: byte for byte, character in byte_characters().items()}
        vocabulary = json.loads(form)["model"]["vocab"]
        _tokens[form] = {rank: bytes(map(back.__getitem__, token)) for token, rank in vocabulary.items()}
    return _tokens[form]


def stretches(text: str) -> list[str]:
    """A text cut before every blank and line feed that follows something else than white space.

    The pattern has no match in which white space follows anything else, so no match crosses such a cut, and none before
    it looks beyond. The tokens of a text are those of its stretches.
    """
    return _CUT.split(text) if text else []


def _apart(stretch: str) -> bool:
    """Whether a stretch must be encoded on its own, as its white space could go together with that of a neighbour."""
    return stretch[-1].isspace() or (stretch[0].isspace() and stretch[0] not in " \n")


class Encoder:
    """Encodes texts, each stretch that comes again only once.

    New stretches are encoded in long rows; a stretch that begins with no white space has a line feed put before it, to
    part it from the one in front, whose token is taken off again.
    """

    def __init__(self, form: str):
        self.tokenizer, tokens = _tokenizer(form), _token_bytes(form)
        self.known: dict[str, list[int]] = {}
        self.sizes = np.zeros(max(tokens) + 1, np.int64)
        for rank, token in tokens.items():
            self.sizes[rank] = len(token)
        self.line_feed = len(self._ids(["\n"])[0])

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [made.ids for made in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, new: list[str]) -> None:
        alone = [stretch for stretch in new if _apart(stretch)]
        self.known.update(zip(alone, self._ids(alone)))
        row: list[str] = []
        size = 0
        for stretch in new:
            if not _apart(stretch):
                row.append(stretch)
                size += len(stretch)
                if size >= ROW_CHARS:
                    self._learn_row(row)
                    row, size = [], 0
        if row:
            self._learn_row(row)

    def _learn_row(self, row: list[str]) -> None:
        parted = [stretch if stretch[0] in " \n" else "\n" + stretch for stretch in row]
        [ids] = self._ids(["".join(parted)])
        ends = np.cumsum(self.sizes[np.array(ids)])
        bounds = np.searchsorted(ends, np.cumsum([len(stretch.encode()) for stretch in parted]), "right").tolist()
        start = 0
        for stretch, part, stop in zip(row, parted, bounds):
            self.known[stretch] = ids[start + (self.line_feed if len(part) > len(stretch) else 0) : stop]
            start = stop

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and where each text's begin, with the end of the last."""
        if len(self.known) > KNOWN:
            self.known.clear()
        cut = [stretches(text) for text in texts]
        new = [stretch for stretch in dict.fromkeys(chain.from_iterable(cut)) if stretch not in self.known]
        if new:
            self._learn(new)
        lists = [list(chain.from_iterable(map(self.known.__getitem__, parts))) for parts in cut]
        bounds = np.cumsum([0, *map(len, lists)])
        return np.fromiter(chain.from_iterable(lists), np.int32, int(bounds[-1])), bounds

    def places(self, texts: list[str], ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First character and end of every id, counted in its own text: bytes are mapped to their characters."""
        data = [np.frombuffer(text.encode(), np.uint8) for text in texts]
        character = np.concatenate([np.zeros(0, np.int64), *[np.cumsum((one & 0xC0) != 0x80) - 1 for one in data]])
        ends = np.cumsum(self.sizes[ids])
        return character[ends - self.sizes[ids]], character[ends - 1] + 1


def encode_texts(
    docs: DataFrame, vocabulary: str = VOCABULARY, offsets: bool = True, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The tokens of each whole text, as merging by rank inside each match of the pattern gives them.

    One row per row of ``docs``: ``doc_id``, ``ids``, and with ``offsets`` the tokens' first characters ``starts`` and
    their ``ends`` (exclusive), in characters of the text. A null or empty text has no tokens; bytes that are no UTF-8
    are taken as U+FFFD. What looks like a special token is plain text. Repeated rows and null ids are encoded each for
    itself; other columns are ignored, whatever their names; an empty table gives an empty result. ``vocabulary`` is a
    file that the driver can read; the tokenizer built from it goes to the executors.
    """
    with open(vocabulary, "rb") as file:
        form = docs.sparkSession.sparkContext.broadcast(build_tokenizer(file.read()))
    names = ["doc_id", "ids", "starts", "ends"][: 4 if offsets else 2]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(form.value)
        for batch in batches:
            texts = batch.column("text")
            for at, to in _slices(pc.fill_null(pc.binary_length(texts), 0).to_pylist(), BATCH):
                whole = [(value or b"").decode("utf-8", "replace") for value in texts[at:to].to_pylist()]
                ids, bounds = encoder.encode(whole)
                columns = [ids, *(encoder.places(whole, ids) if offsets else ())]
                lists = [pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(one, pa.int32())) for one in columns]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id")[at:to], *lists], names)

    plain = pick(docs, doc_id=doc_id, text=text)
    plain = plain.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return plain.mapInArrow(encode, ", ".join(f"{name} {'long' if name == 'doc_id' else 'array<int>'}" for name in names))


def _slices(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive rows that are ``limit`` in size, or one larger row."""
    start = total = 0
    for k, size in enumerate(sizes):
        if k > start and total + size > limit:
            yield start, k
            start, total = k, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def _as_lists(lists: pa.ListArray) -> Iterator[list[int] | None]:
    """Lists of numbers; a null in one of them becomes -1, which is no id."""
    values = pc.fill_null(lists.flatten(), -1).to_numpy(zero_copy_only=False).tolist()
    at = 0
    for size in pc.list_value_length(lists).to_pylist():
        yield None if size is None else values[at : at + size]
        at += size or 0


def joined_bytes(ids: list[int] | None, tokens: dict[int, bytes]) -> bytes | None:
    """The bytes of a list of ids; null if there is no list, or an id in it that the vocabulary does not have."""
    try:
        return None if ids is None else b"".join(map(tokens.__getitem__, ids))
    except KeyError:
        return None


def as_text(data: bytes | None) -> tuple[str | None, int]:
    """Bytes as text, and how many stretches of them were no whole character and became U+FFFD."""
    if data is None:
        return None, 0
    try:
        return data.decode(), 0
    except UnicodeDecodeError:
        broken = data.decode("utf-8", "replace")
        return broken, broken.count("�") - data.count("�".encode())


def decode_ids(
    encoded: DataFrame, vocabulary: str = VOCABULARY, text: bool = True, doc_id: str = "doc_id", ids: str = "ids"
) -> DataFrame:
    """The bytes that ids stand for: ``doc_id, ids, data`` (binary) and, with ``text``, ``text`` and ``n_broken``.

    Ids may be cut anywhere, also inside a character: ``data`` has exactly their bytes; in ``text`` each incomplete
    character is U+FFFD, and ``n_broken`` counts these. No ids give no bytes; a null list, a null id and an id that
    the vocabulary does not have give a null. Repeated rows and null ids of documents are kept as they are; other
    columns are ignored; an empty table gives an empty result.
    """
    with open(vocabulary, "rb") as file:
        form = encoded.sparkSession.sparkContext.broadcast(build_tokenizer(file.read()))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _token_bytes(form.value)
        for batch in batches:
            lists = batch.column("ids")
            for at, to in _slices(pc.fill_null(pc.list_value_length(lists), 0).to_pylist(), BATCH):
                data = [joined_bytes(one, tokens) for one in _as_lists(lists[at:to])]
                columns = [batch.column("doc_id")[at:to], lists[at:to], pa.array(data, pa.binary())]
                if text:
                    written = [as_text(one) for one in data]
                    columns += [pa.array([t for t, _ in written], pa.string()), pa.array([n for _, n in written], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "data", "text", "n_broken"][: len(columns)])

    plain = pick(encoded, doc_id=doc_id, ids=ids)
    plain = plain.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids"))
    schema = "doc_id long, ids array<int>, data binary" + (", text string, n_broken long" if text else "")
    return plain.mapInArrow(decode, schema)


def token_digests(decoded: DataFrame) -> DataFrame:
    """One row of figures and digests per row of ``decode_ids``."""
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("data", 256).alias("decoded_sha256"),
    )
