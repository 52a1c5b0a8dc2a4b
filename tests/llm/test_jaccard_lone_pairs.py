"""Pairs that meet alone in their regions: short sets, edits at either end, and single shingles shared by chance."""

from collections import Counter

import numpy as np
import pytest

pytest.importorskip("millrace.llm")

from millrace.llm import jaccard_join as J  # noqa: E402
from test_llm_operators import components, shingles  # noqa: E402


def test_lone_pairs_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    texts = []
    for k in range(250):
        own = [f"w{k}x{i}" for i in range(int(rng.integers(5, 30)))]
        texts.append(" ".join(own))
        cut, more = int(rng.integers(0, 1 + len(own) // 3)), [f"n{k}y{i}" for i in range(int(rng.integers(0, 4)))]
        texts.append(" ".join(own[cut:] + more if k % 2 else more + own[: len(own) - cut]))
        if k % 5 == 0:  # one shingle of this text in another one
            texts.append(" ".join([f"z{k}a", *own[:5], f"z{k}b", f"z{k}c"]))
    sets = [shingles(text) for text in texts]
    links = [(a, b) for a in range(len(sets)) for b in range(a) if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    sizes = {max(len(sets[a]), len(sets[b])) for a, b in links if sets[a] != sets[b]}
    assert len(links) > 60 and min(sizes) <= 6  # unequal pairs of few shingles are among them
    want = Counter((k, len(s), c) for k, (s, c) in enumerate(zip(sets, components(list(range(len(sets))), links))))
    found = J.jaccard_join(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == want
