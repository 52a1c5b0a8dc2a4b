"""Items of five and six words are found in long documents, all of them."""

import numpy as np
import pytest

pytest.importorskip("millrace.llm")

from millrace.llm.decontaminate import find_leaks  # noqa: E402


def test_items_of_few_shingles_are_never_missed(spark):
    rng = np.random.default_rng(11)

    def words(size):
        return " ".join("".join(rng.choice(list("abcdefgh"), 6)) for _ in range(size))

    items = [(k, words(5 if k % 4 else 6)) for k in range(160)]
    docs = []
    for k in range(40):
        filler = words(2000).split()
        texts = []
        for place, n in enumerate(rng.permutation(160)):
            item = items[n][1].split()
            texts += filler[place * 12 : place * 12 + 12] + (item if (n + k) % 5 else item[:-1])
        docs.append((k, " ".join(texts)))
    want = {(k, n) for k in range(40) for n in range(160) if (n + k) % 5}
    found = find_leaks(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    ).collect()
    assert len(found) == len(want) and {(r["doc_id"], r["item_id"]) for r in found} == want
    assert all(r["n_item"] == r["n_shared"] == (1 if r["item_id"] % 4 else 2) for r in found)
