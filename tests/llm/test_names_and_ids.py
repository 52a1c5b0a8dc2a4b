"""Columns spelled in another letter case, rows without an id, repeated ids, addresses of any script."""

from collections import Counter

import pytest

pytest.importorskip("millrace.llm")

from pyspark.errors import PySparkException  # noqa: E402

from millrace.llm import pseudonyms  # noqa: E402
from millrace.llm.common import pick, remove_results  # noqa: E402
from millrace.llm.jaccard_join import jaccard_join, one_of_each  # noqa: E402
from millrace.llm.language_id import keep_identified, train_languages  # noqa: E402
from millrace.llm.source_mix import mix_sources  # noqa: E402

DOCS = "Doc_ID long, Text string, LANG string, Source string, n_chars long"


def test_names_of_any_letter_case(spark):
    rows = [(k, f"wort für wort {k} und noch mehr worte" if k % 2 else f"word by word {k} and some more words", "de" if k % 2 else "en", "a", 1) for k in range(60)]
    docs = spark.createDataFrame(rows, DOCS)
    out = pseudonyms.pseudonymise(spark.createDataFrame([(1, "write to amy@example.org", "en", "a", 1)], DOCS), "k").collect()[0]
    assert "amy@" not in out["Text"] and out["n_pseudonyms"] == 1 and out.asDict().keys() >= {"Doc_ID", "Text", "LANG"}
    assert keep_identified(docs).columns == docs.columns and keep_identified(docs).count() > 30
    assert keep_identified(docs, train_languages(docs)).count() == keep_identified(docs).count()
    assert one_of_each(docs).columns == docs.columns and jaccard_join(docs).count() == 60
    assert mix_sources(docs).columns[:5] == docs.columns


def test_pick_takes_columns_by_place(spark):
    both = spark.createDataFrame([(1, "exact", "other case")], "doc_id long, text string, TEXT string")
    assert [tuple(r) for r in pick(both, text="text", second="TEXT").collect()] == [("exact", "other case")]


def test_addresses_of_any_script(spark):
    texts = ["иван@mail.ru", "josé.müller7@example.org", "-bob@x.org", "_amy@x.org", "x" * 90 + "@x.org", "李@例.org 李@mail.cn", "--@x.org", "a@b", "no address"]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts + texts[:2])], "doc_id long, text string")
    new = [r.text for r in sorted(pseudonyms.pseudonymise(docs, "k").collect())]
    counts = [r.n_pseudonyms for r in sorted(pseudonyms.pseudonymise(docs, "k").collect())]
    assert counts == [1, 1, 1, 1, 1, 1, 0, 0, 0, 1, 1] and new[9:] == new[:2]
    for old, one in list(zip(texts, new))[:6]:
        local, changed = old.rsplit("@", 1)[0].split(" ")[-1], one.rsplit("@", 1)[0].split(" ")[-1]
        assert changed != local and len(changed) == len(local) and changed.isascii()
        assert [c for c in changed if c in "._%+-"] == [c for c in local if c in "._%+-"] and one.rsplit("@", 1)[1] == old.rsplit("@", 1)[1]
    assert new[6:9] == texts[6:9]
    assert [r.text for r in sorted(pseudonyms.pseudonymise(docs, "other").collect())][:6] != new[:6]


def test_a_key_is_required(spark):
    with pytest.raises(TypeError):
        pseudonyms.pseudonymise(spark.createDataFrame([(1, "a@b.org")], "doc_id long, text string"))


def test_rows_without_an_id_are_drawn_one_by_one(spark):
    rows = [(None, f"text {k % 7}", "en", "a", 1) for k in range(1500)] + [(7, f"text {k:04}", "en", "a", 1) for k in range(1500)]
    rows += [(k, "text of b", "en", "b", 1) for k in range(10, 3010)]
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    mixed = mix_sources(docs, {"a": 0.25, "b": 0.75}).collect()
    copies = Counter((r.Source, r.Doc_ID is None) for r in mixed)
    total = len(mixed)
    assert 0.20 < (copies["a", True] + copies["a", False]) / total < 0.32
    for key in (("a", True), ("a", False)):
        assert 0.35 * 1500 < copies[key] < 0.75 * 1500
    assert len({r.deal for r in mixed if r.Doc_ID is None}) == copies["a", True]


def test_a_source_that_needs_too_many_copies_is_refused(spark):
    docs = spark.createDataFrame([(1, "x", "en", "a", 1), (2, "y" * 100_000, "en", "b", 1)], DOCS)
    with pytest.raises(PySparkException, match="repeated"):
        mix_sources(docs, {"a": 0.9, "b": 0.1}).collect()


def test_results_can_be_removed(spark):
    docs = spark.createDataFrame([(1, "one two three four five", "en", "a", 1)], DOCS)
    out = jaccard_join(docs)
    assert out.count() == 1 and "/results-" in out.inputFiles()[0]
    remove_results(spark)
    with pytest.raises(PySparkException):
        spark.read.parquet(out.inputFiles()[0].rsplit("/", 1)[0])
