"""Decontamination judges rows, not ids."""

from collections import Counter

import pytest

pytest.importorskip("millrace.llm")

from millrace.llm.decontaminate import without_leaks  # noqa: E402

ITEM = " ".join(f"item{k}" for k in range(30))


def test_rows_of_a_leaking_id_are_judged_one_by_one(spark):
    clean = [" ".join(f"w{n}x{k}" for k in range(80)) for n in range(4)]
    rows = [
        (None, f"before {ITEM} after"), (None, clean[0]), (None, clean[1]), (None, None), (None, ""),
        (7, f"{clean[2]} {ITEM.upper()}"), (7, clean[2]), (7, clean[2]), (8, clean[3]), (9, ITEM), (10, None),
    ]
    docs = spark.createDataFrame([(*r, [1, None]) for r in rows], "doc_id long, text string, leak_text array<int>")
    benchmark = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    left = without_leaks(docs, benchmark)
    assert left.columns == docs.columns
    want = Counter((k, text) for k, text in rows if ITEM not in (text or "").lower())
    assert Counter((r["doc_id"], r["text"]) for r in left.collect()) == want
    named = docs.select(docs.doc_id.cast("string").alias("Id"), docs.text.cast("binary").alias("Body"))
    assert without_leaks(named, benchmark, "Id", "body").count() == sum(want.values())
    assert without_leaks(docs, benchmark.limit(0)).count() == len(rows)
