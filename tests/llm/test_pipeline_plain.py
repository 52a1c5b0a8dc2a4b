"""``corpus_pipeline.run`` against plain code, stage by stage, on rows that are awkward in every way it defines."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import xxhash
import zstandard

pytest.importorskip("millrace.llm")

import corpus_pipeline  # noqa: E402
from millrace.llm import language_id as L  # noqa: E402
from millrace.llm import pseudonyms  # noqa: E402
from millrace.llm.source_mix import WEIGHTS  # noqa: E402
from test_llm_operators import components, feistel, luhn, shingles  # noqa: E402

CARD, PHONE = "4111111111111111", "+1 (084) 555-3661"


def hashed(text):
    return int(np.uint64(xxhash.xxh64_intdigest(text.encode(), 42)).astype(np.int64))


def make_rows():
    rng = np.random.default_rng(21)
    letters = {"en": "etaoinshr", "de": "enirsatdu", "fr": "esaitnrul"}
    words = {k: ["".join(rng.choice(list(v), rng.integers(2, 8))) for _ in range(250)] for k, v in letters.items()}

    def prose(lang, size):
        return " ".join(rng.choice(words[lang], size))

    items = [(k, prose("en", int(size))) for k, size in enumerate(rng.integers(5, 40, 8))] + [(None, prose("en", 9)), (20, None)]
    rows = []
    for k in range(150):
        lang = ("en", "de", "fr")[k % 3]
        rows.append([k, prose(lang, int(rng.integers(20, 200))), lang, f"src{k % 5}"])
    for k in range(40):  # near copies, some too far away
        text = rows[k % 7][1].split()
        for at in rng.choice(len(text), min(len(text), int(rng.integers(1, 6))), replace=False):
            text[at] = "eee"
        rows.append([200 + k, " ".join(text), rows[k % 7][2], "src1"])
    for k in range(8):  # leaks, also in rows that share their id with a clean one or have none
        rows.append([(300 + k, 5, None)[k % 3], f"{prose('en', 60)} {items[k][1].upper()} {prose('en', 30)}", "en", "src0"])
    rows += [[400 + k, f"{prose('de', 40)} {CARD}, {PHONE}; {prose('de', 9)}", "de", None] for k in range(6)]
    rows += [[None, prose("fr", 50), "fr", "src2"] for _ in range(12)] + [[None, rows[3][1], "en", "src0"]]
    rows += [[500, "", "en", "src0"], [501, None, "en", "src0"], [502, "12 !! 34", "en", "src0"], [503, prose("en", 30_000), None, "src3"]]
    rows += [[510 + k, f"{prose('en', 3)} {prose('de', 3)} {prose('fr', 3)}", "en", "src0"] for k in range(30)]
    rows += [rows[1], rows[1], [2, prose("fr", 44), "fr", "src4"]]
    return rows, items


def identified(rows):
    known = [r for r in rows if r[1] is not None and r[2] is not None and (r[0] is None or zlib.crc32(str(r[0]).encode()) % 3 != 1)]
    counts = Counter(r[2] for r in known)
    dictionaries = {}
    for lang in counts:
        chosen = sorted({(hashed(r[1]), r[1]) for r in known if r[2] == lang})[: L.SAMPLE_DOCS]
        blocks = []
        for at, text in chosen:
            plain = L.normal(text)
            place = at % max(1, len(plain) - L.BLOCK + 1)
            blocks.append(plain[place : place + L.BLOCK] + b" ")
        dictionaries[lang] = b"".join(blocks)[: min(L.DICTIONARY, L.ALL_DICTIONARIES // len(counts))]

    def margin(text):
        if text is None or not any(c.isalpha() for c in text):
            return 0.0
        plain, sizes = L.normal(text), []
        for content in dictionaries.values():
            options = {"write_checksum": False, "write_content_size": False, "write_dict_id": False}
            learnt = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            encoder = zstandard.ZstdCompressor(level=L.LEVEL, dict_data=learnt, **options)
            sizes.append(sum(len(encoder.compress(plain[k : k + L.PIECE])) for k in range(0, len(plain), L.PIECE)))
        best, second = sorted(sizes)[:2]
        return 1 - best / second

    return [r for r in rows if margin(r[1]) >= L.MIN_MARGIN]


def one_of_each(rows):
    distinct = list({(r[0], r[1]): r for r in rows}.values())
    sets = [shingles(r[1]) for r in distinct]
    links = [
        (a, b)
        for a in range(len(distinct))
        for b in range(a)
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    groups = {}
    for row, group in zip(distinct, components(range(len(distinct)), links)):
        groups.setdefault(group, []).append(row)
    return [min(group, key=lambda r: (r[0] is None, r[0] or 0, hashed(r[1]))) for group in groups.values()]


def clean(rows, items):
    sets = [shingles(text) for k, text in items if k is not None and text]
    return [r for r in rows if not any(4 * len(s & shingles(r[1])) >= 3 * len(s) for s in sets)]


def disguised(text):
    payload = f"{feistel(int(CARD[:-1]), 10**8, 10**7, pseudonyms.KEY, 'card', 15):015d}"
    card = next(payload + d for d in "0123456789" if luhn(payload + d))
    digits = iter(f"{feistel(845553661, 10**5, 10**5, pseudonyms.KEY, 'phone', 10):010d}")
    phone = "+1" + re.sub("[0-9]", lambda _: next(digits), PHONE[2:])
    return text.replace(CARD, card).replace(PHONE, phone)


def copies(rows):
    size = Counter()
    for r in rows:
        size[r[3] if r[3] in WEIGHTS else "rest"] += len(r[1])
    rest = 1 - sum(WEIGHTS.values())
    out = Counter()
    for r in rows:
        part = r[3] if r[3] in WEIGHTS else "rest"
        rate = WEIGHTS.get(part, rest) * sum(size.values()) / size[part]
        own = hashlib.md5(r[1].encode()).hexdigest()
        u = int(hashlib.md5(f"11:{r[0]}:{own}".encode()).hexdigest()[:13], 16) / 2**52
        term = total = np.exp(-rate)
        count = 0
        while total <= u:
            count += 1
            term *= rate / count
            total += term
        if r[0] is not None:
            out.update((r[0], r[1], r[2], r[3], len(r[1]), count, k + 1) for k in range(count))
    return out


def test_run_equals_plain_code(spark, tmp_path):
    rows, items = make_rows()
    table = {
        "doc_id": [r[0] for r in rows], "Text": [r[1] for r in rows], "lang": [r[2] for r in rows],
        "source": [r[3] for r in rows], "N_Chars": [len(r[1] or "") for r in rows], "item_id": [r[0] for r in rows],
        "g": [len(r[1] or "") % 3 for r in rows], "copies_of": ["x"] * len(rows),
    }
    pq.write_table(pa.table(table), tmp_path / "documents.parquet")
    pq.write_table(pa.table({"item_id": [k for k, _ in items], "text": [t for _, t in items]}), tmp_path / "benchmark.parquet")
    want, docs = rows, spark.read.parquet(str(tmp_path / "documents.parquet"))
    plain = [identified, one_of_each, lambda r: clean(r, items), lambda r: [[x[0], disguised(x[1]), *x[2:]] for x in r]]
    for number, ((name, stage), step) in enumerate(zip(corpus_pipeline.STAGES, plain)):
        before, want = want, step(want)
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{number}")
        docs = spark.read.parquet(f"{tmp_path}/{number}")
        assert docs.columns == list(table), name
        got = Counter((r["doc_id"], r["Text"], r["lang"], r["source"]) for r in docs.collect())
        assert got == Counter(map(tuple, want)), name
        assert Counter(map(tuple, before)) != got, name  # every stage has something to do
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    columns = ("doc_id", "Text", "lang", "source", "N_Chars", "copies", "copy_no")
    assert Counter(tuple(r[c] for c in columns) for r in found if r["doc_id"] is not None) == copies(want)
    nameless = [r for r in found if r["doc_id"] is None]  # drawn by their place: whole sets of copies of kept rows
    assert {r["Text"] for r in nameless} <= {r[1] for r in want if r[0] is None}
    assert all(1 <= r["copy_no"] <= r["copies"] for r in nameless)
    assert len(nameless) == sum(r["copies"] for r in nameless if r["copy_no"] == 1) > 0
