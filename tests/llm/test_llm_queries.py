"""Registered queries against their oracle SQL, and the pipeline stage by stage."""

import pytest

pytest.importorskip("millrace.llm")

from compare import connect, differences  # noqa: E402

import corpus_pipeline  # noqa: E402
from millrace.llm.common import read  # noqa: E402
from millrace.llm.queries import ORACLES, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_oracle(spark, name):
    assert differences(QUERIES[name](spark, SF), connect(SF), ORACLES[name]) == []


def test_stages_hand_on_the_columns_of_documents(spark):
    docs = read(spark, SF, "documents")
    columns, before = docs.columns, docs.count()
    out = corpus_pipeline.run(spark, SF)
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "near_duplicates", "decontamination", "pii", "source_mix",
    ]
    assert out.columns == [*columns, "copies", "copy_no", "deal"] and 0 < out.count() < 2 * before
    leaks = QUERIES["op8_benchmark_decontamination"](spark, SF)
    assert out.join(leaks, "doc_id", "left_semi").isEmpty()
