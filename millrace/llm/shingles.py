"""Word shingles of whole texts as 64-bit hashes, a batch of texts at a time.

Words are the runs of ``[^\\x20\\x09-\\x0D]`` after A-Z are lower-cased. A text's shingles are its runs of
five words in order; a text of one to four words has one shingle, its whole sequence; a text without words,
or null, has none. Equal shingles have equal hashes; different ones collide with a chance of 2**-64 a pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from millrace.llm.common import ship

SIZE = 5  # words of a shingle
GROUP_BYTES = 1 << 19  # text hashed at once; a longer text is cut at white space and goes in pieces
BASE = 0x9E3779B97F4A7C15  # odd, so that its powers have inverses modulo 2**64
FACTORS = np.array([0x9FB21C651E98DF25, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.ones(256, bool)
_IN_WORD[[9, 10, 11, 12, 13, 32]] = False
_powers: dict[str, np.ndarray] = {}

ship(__name__)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit over all output bits."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _table(name: str, base: int, size: int) -> np.ndarray:
    """Powers of ``base`` modulo 2**64, kept for the next call."""
    known = _powers.get(name)
    if known is None or len(known) < size:
        known = np.full(max(size, GROUP_BYTES + 1), base, np.uint64)
        known[0] = 1
        _powers[name] = known = np.multiply.accumulate(known)
    return known


def _word_hashes(data: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and start positions of the words of ``data``; no word goes across one of ``breaks``."""
    size = len(data)
    low = _LOWER[data]
    inside = _IN_WORD[data]
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    end = inside.copy()
    end[:-1] &= ~inside[1:]
    cuts = breaks[(breaks > 0) & (breaks < size)]
    start[cuts] |= inside[cuts]
    end[cuts - 1] |= inside[cuts - 1]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    sums = np.zeros(size + 1, np.uint64)
    np.cumsum((low.astype(np.uint64) + np.uint64(1)) * _table("up", BASE, size + 1)[:size], out=sums[1:])
    inverse = _table("down", pow(BASE, -1, 1 << 64), size + 1)
    words = (sums[ends] - sums[starts]) * inverse[starts]
    return mix(words + (ends - starts).astype(np.uint64) * FACTORS[3]), starts


def _long_text(data: np.ndarray) -> np.ndarray:
    """Word hashes of one text, hashed piece by piece; pieces end before white space."""
    parts, at = [], 0
    while at < len(data):
        to = min(at + GROUP_BYTES, len(data))
        while to < len(data) and _IN_WORD[data[to]]:
            ahead = np.flatnonzero(~_IN_WORD[data[to : to + GROUP_BYTES]])
            to = to + int(ahead[0]) if len(ahead) else min(to + GROUP_BYTES, len(data))
        parts.append(_word_hashes(data[at:to], np.zeros(0, np.int64))[0])
        at = to
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def _joined(words: np.ndarray) -> np.ndarray:
    """Hash of every run of five of the words."""
    size = max(0, len(words) - SIZE + 1)
    total = np.zeros(size, np.uint64)
    for k in range(SIZE):
        total += words[k : k + size] * FACTORS[k]
    return mix(total)


def _short(words: np.ndarray) -> np.ndarray:
    """The one shingle of a text of one to four words."""
    return mix((words * FACTORS[: len(words)]).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(words)))


def _of_words(words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of consecutive texts with ``counts`` words each, and how many each text has."""
    row = np.repeat(np.arange(len(counts)), counts)
    shingles = _joined(words)
    whole = row[: len(shingles)] == row[len(row) - len(shingles) :]
    sizes = np.where(counts >= SIZE, counts - SIZE + 1, np.minimum(counts, 1))
    short = np.flatnonzero((counts > 0) & (counts < SIZE))
    if not len(short):
        return shingles[whole], sizes
    out = np.empty(int(sizes.sum()), np.uint64)
    first = np.cumsum(sizes) - sizes
    is_short = np.zeros(len(out), bool)
    is_short[first[short]] = True
    out[~is_short] = shingles[whole]
    from_word = np.cumsum(counts) - counts
    for k in short:
        out[first[k]] = _short(words[from_word[k] : from_word[k] + counts[k]])[0]
    return out, sizes


def shingle_groups(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Groups of consecutive texts: the first one's row, all shingles in text order, and how many each text has."""
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    valid = np.asarray(column.is_valid())
    if not len(column):
        return
    row = 0
    while row < len(column):
        to = max(row + 1, int(np.searchsorted(offsets, offsets[row] + GROUP_BYTES, "right")) - 1)
        text, breaks = data[offsets[row] : offsets[to]], offsets[row : to + 1] - offsets[row]
        if len(text) > GROUP_BYTES:
            words = _long_text(text)
            counts = np.array([len(words)])
        else:
            words, starts = _word_hashes(text, breaks)
            counts = np.diff(np.searchsorted(starts, breaks))
        if not valid[row:to].all():
            filled = np.repeat(valid[row:to], counts)
            words, counts = words[filled], np.where(valid[row:to], counts, 0)
        yield row, *_of_words(words, counts)
        row = to


def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """For each text in turn its distinct shingles, sorted."""
    for _, shingles, sizes in shingle_groups(column):
        ends = np.cumsum(sizes)
        for start, end in zip(ends - sizes, ends):
            found = np.sort(shingles[start:end])
            if len(found) > 1:
                new = np.empty(len(found), bool)
                new[0] = True
                np.not_equal(found[1:], found[:-1], out=new[1:])
                found = found[new]
            yield found
