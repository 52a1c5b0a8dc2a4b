"""Byte-level BPE against another library, and the way back to the same bytes."""

import base64
import hashlib
import random

import pytest

pytest.importorskip("millrace.llm")

import tiktoken  # noqa: E402

from millrace.llm import byte_bpe  # noqa: E402
from millrace.llm.byte_bpe import ROW_CHARS, VOCABULARY, decode_ids, encode_texts, stretches  # noqa: E402
from millrace.llm.common import read  # noqa: E402
from millrace.llm.queries import QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def plain():
    with open(VOCABULARY, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding("plain", pat_str=byte_bpe.PATTERN, mergeable_ranks=ranks, special_tokens={})


def unusual():
    rng = random.Random(3)
    alphabet = "ab AB 12 .,!? \n\t\r\x0b\x1c\x85\xa0​ 　'sé中🙂ßяñ́\x00|<>"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 400))) for _ in range(200)]
    texts += ["", " ", "   ", "a  ", "  a", "\n\n\n", "<|endoftext|> a<|endoftext|>", "I'll we've DON'T 's", "x" * 5000, " " * 3000 + "y"]
    texts += ["".join(chr(c) for c in range(start, start + 4000) if not 0xD800 <= c < 0xE000) for start in range(0, 0x20000, 4000)]
    return texts


def test_ids_are_those_of_merging_by_rank(spark, plain):
    texts = unusual()
    docs = spark.createDataFrame([(k, t, "clash") for k, t in enumerate(texts)], "DOC_ID long, TEXT string, ids string")
    encoded = encode_texts(docs).cache()
    rows = {r.doc_id: r for r in encoded.collect()}
    assert [rows[k].ids for k in range(len(texts))] == [plain.encode_ordinary(t) for t in texts]
    decoded = {r.doc_id: r for r in decode_ids(encoded).collect()}
    assert all(bytes(decoded[k].data) == t.encode() and decoded[k].text == t and decoded[k].n_broken == 0 for k, t in enumerate(texts))
    for k, text in enumerate(texts):
        for i, (start, end) in enumerate(zip(rows[k].starts, rows[k].ends)):
            token = plain.decode_single_token_bytes(rows[k].ids[i])
            assert start < end and token in text[start:end].encode()  # the characters that the token has bytes of
        covered = [p for start, end in zip(rows[k].starts, rows[k].ends) for p in range(start, end)]
        assert sorted(set(covered)) == list(range(len(text)))
    encoded.unpersist()


def test_nulls_repeats_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, None), (None, "two"), (None, "two"), (4, ""), (4, "four")], "doc_id long, text string")
    out = sorted((str(r.doc_id), r.ids, r.starts, r.ends) for r in encode_texts(docs).collect())
    assert out == [("1", [], [], []), ("4", [], [], []), ("4", [14337], [0], [4]), ("None", [11545], [0], [3]), ("None", [11545], [0], [3])]
    assert encode_texts(docs.limit(0)).collect() == [] and decode_ids(encode_texts(docs.limit(0))).collect() == []


def test_bytes_that_are_no_text(spark):
    docs = spark.sql("SELECT 1L AS doc_id, CAST(X'61FF62' AS STRING) AS text")
    [row] = decode_ids(encode_texts(docs)).collect()
    assert row.text == "a�b" and row.n_broken == 0


def test_split_characters_and_unknown_ids(spark, plain):
    ids = plain.encode_ordinary("a🙂中")
    cuts = [(k, ids[:k]) for k in range(len(ids) + 1)] + [(90, ids[2:]), (91, None), (92, [50_256]), (93, [-1]), (94, [None, 64])]
    rows = {r.doc_id: r for r in decode_ids(spark.createDataFrame(cuts, "doc_id long, ids array<int>")).collect()}
    for k, some in cuts[: len(ids) + 2]:
        data = b"".join(plain.decode_single_token_bytes(i) for i in some)
        assert bytes(rows[k].data) == data and rows[k].text == data.decode("utf-8", "replace")
        assert rows[k].n_broken == data.decode("utf-8", "replace").count("�")
    assert any(rows[k].n_broken for k in range(len(ids)))
    assert all(rows[k].data is None and rows[k].text is None for k in (91, 92, 93, 94))


def test_very_long_texts(spark, plain):
    rng = random.Random(8)
    text = " ".join("".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 9))) for _ in range(80_000))
    assert len(text) > 4 * ROW_CHARS and len(stretches(text)) == 80_000 and "".join(stretches(text)) == text
    [row] = encode_texts(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert row.ids == plain.encode_ordinary(text) and row.starts[0] == 0 and row.ends[-1] == len(text)
    assert all(text[s:e].encode() == plain.decode_single_token_bytes(i) for i, s, e in list(zip(row.ids, row.starts, row.ends))[-50:] if text[s:e].isascii())
    unbroken = "ab" * ROW_CHARS
    assert stretches(unbroken) == [unbroken]
    [row] = encode_texts(spark.createDataFrame([(1, unbroken)], "doc_id long, text string")).collect()
    assert row.ids == plain.encode_ordinary(unbroken)


def test_known_stretches_are_forgotten(plain, monkeypatch):
    monkeypatch.setattr(byte_bpe, "KNOWN", 20)
    monkeypatch.setattr(byte_bpe, "ROW_CHARS", 30)
    with open(VOCABULARY, "rb") as file:
        encoder = byte_bpe.Encoder(byte_bpe.build_tokenizer(file.read()))
    texts = unusual()
    for at in range(0, len(texts), 7):
        ids, bounds = encoder.encode(texts[at : at + 7])
        assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [plain.encode_ordinary(t) for t in texts[at : at + 7]]


def test_query_equals_the_other_library(spark, plain):
    docs = read(spark, SF, "documents").select("doc_id", "text").collect()
    out = {r.doc_id: tuple(r) for r in QUERIES["op12_byte_bpe"](spark, SF).collect()}
    assert len(out) == len(docs)
    for doc_id, text in docs:
        ids = plain.encode_ordinary(text or "")
        digests = [hashlib.sha256(data).hexdigest() for data in (" ".join(map(str, ids)).encode(), (text or "").encode())]
        assert out[doc_id] == (doc_id, len(ids), *digests)
