"""Periodic runs against a search of every period, word by word."""

import hashlib
import random
import re
import zlib

import pytest

pytest.importorskip("millrace.llm")

from millrace.llm.common import read  # noqa: E402
from millrace.llm.periodic_runs import _search, find_runs  # noqa: E402
from millrace.llm.queries import QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def all_runs(words):
    found = []
    for period in range(1, len(words) // 4 + 1):
        start = 0
        while start + period < len(words):
            stop = start
            while stop + period < len(words) and words[stop] == words[stop + period]:
                stop += 1
            length = stop - start + period
            if length >= max(6, 4 * period):
                piece = words[start : start + length]
                if not any(piece[p:] == piece[:-p] for p in range(1, period)):
                    found.append((start, length, period))
            start = max(stop, start + 1)
    return sorted(found)


def collapse(words, runs):
    dropped = {i for start, length, period in runs for i in range(start + period, start + length)}
    return " ".join(word for i, word in enumerate(words) if i not in dropped)


def repeating(rng):
    words = []
    for _ in range(rng.randint(0, 6)):
        part = [rng.choice("abcdefgh"[: rng.choice([1, 2, 3, 8])]) for _ in range(rng.randint(1, 40))]
        words += part * rng.choice([1, 1, 2, 3, 4, 5, 9]) + part[: rng.randint(0, len(part))]
    return words


def test_runs_of_random_words():
    rng = random.Random(11)
    for _ in range(120):
        texts = [repeating(rng) for _ in range(rng.randint(1, 6))]
        runs, collapsed = _search([" ".join(words).encode() for words in texts])
        assert runs == [all_runs(words) for words in texts]
        assert [c.decode() for c in collapsed] == [collapse(w, r) for w, r in zip(texts, runs)]


def test_runs_of_repetitive_words():
    a, b = "a", "b"
    for _ in range(11):
        a, b = a + b, a
    texts = [list(a), ["x"] * 300, list("abaab" * 60 + "c" + "abaab" * 60), list("ab" * 5 + "a"), list("aabaab" * 4), list("a" * 5)]
    texts += [[f"w{k % period}" for k in range(4 * period + extra)] for period in (4, 5, 8, 9, 16, 17, 33) for extra in (-1, 0, 1, 7)]
    runs, _ = _search([" ".join(words).encode() for words in texts])
    assert runs == [all_runs(words) for words in texts]


def test_operator_on_unusual_rows(spark):
    long_text = " ".join(f"w{k % 7000}" for k in range(30_000))
    texts = [None, "", " \t\n", "one", "x " * 6, "x y " * 6, "é中🙂 b\tc " * 4, long_text, long_text, "x " * 5]
    rows = [(k if k else None, text, "clash", "other") for k, text in enumerate(texts)] + [(4, "x " * 6, "clash", "other")]
    docs = spark.createDataFrame(rows, "Doc_ID long, Text string, runs string, collapsed string")
    found = sorted((r for r in find_runs(docs).collect()), key=lambda r: (r.doc_id or 0, r.collapsed))
    expected = sorted(((k, *(lambda w: (all_runs(w), collapse(w, all_runs(w))))(words_of(t))) for k, t, *_ in rows if t is not long_text), key=lambda r: (r[0] or 0, r[2]))
    assert [(r.doc_id, [tuple(x) for x in r.runs], r.collapsed) for r in found if r.doc_id not in (7, 8)] == expected
    for r in found:
        if r.doc_id in (7, 8):
            assert [tuple(x) for x in r.runs] == [(0, 30_000, 7000)] and r.collapsed == " ".join(words_of(long_text)[:7000])
    assert find_runs(docs.limit(0)).collect() == []
    with pytest.raises(ValueError):
        find_runs(docs, text="missing")


def expected_row(doc_id, text):
    words = words_of(text)
    hashed = zlib.crc32(str(doc_id).encode())
    if hashed % 10 == 0 and words:
        g, n = hashed // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = all_runs(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    lines = "".join(f"{s},{l},{q}\n" for s, l, q in runs)
    figures = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    digest = [hashlib.sha256(t.encode()).hexdigest() for t in (lines, collapse(words, runs))]
    return (doc_id, len(runs), *figures, *digest)


def test_query_equals_brute_force(spark):
    docs = [r for r in read(spark, SF, "documents").select("doc_id", "text").collect() if len(r.text or "") < 12_000]
    out = {r.doc_id: tuple(r) for r in QUERIES["op11_periodic_runs"](spark, SF).collect()}
    assert len(out) == read(spark, SF, "documents").count() and len(docs) > 150
    assert [out[r.doc_id] for r in docs] == [expected_row(r.doc_id, r.text) for r in docs]
    assert any(row[1] for row in out.values())
