"""The Jaccard join where regions are large: recursion, regions that cannot be cut, and both ways to fetch texts."""

from collections import Counter

import numpy as np
import pytest

pytest.importorskip("millrace.llm")

from millrace.llm import jaccard_join as J  # noqa: E402
from test_llm_operators import components, shingles  # noqa: E402


def word(rng):
    return "".join(rng.choice(list("abcdefghijklmnop"), 6))


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(17)
    common = [word(rng) for _ in range(90)]
    passages = [" ".join(word(rng) for _ in range(12)) for _ in range(14)]
    texts = []
    for _ in range(90):  # about equally far from each other, a few of them linked
        texts.append(" ".join([*common[: int(rng.integers(60, 91))], *(word(rng) for _ in range(int(rng.integers(4, 30))))]))
    for _ in range(160):  # made of a few of many shared passages
        texts.append(" . ".join(passages[k] for k in sorted(rng.choice(14, 5, replace=False))))
    for k in range(40):
        w = texts[k].split()
        w[int(rng.integers(len(w)))] = word(rng)
        texts.append(" ".join(w))
    return [(k, text) for k, text in enumerate(texts)] + [(None, texts[0]), (5, texts[5])]


@pytest.mark.parametrize("small, tile, broadcast", [(32, 512, 200_000), (2, 7, 0)])
def test_large_regions_equal_brute_force(spark, rows, small, tile, broadcast, monkeypatch):
    for name, value in {"SMALL_REGION": small, "TILE": tile, "BROADCAST_KEYS": broadcast, "EXPLODED": 100, "PIVOTS": 2}.items():
        monkeypatch.setattr(J, name, value)
    rounds, seen = [], J._subregions

    def counted(left, distances, work):
        out = seen(left, distances, work)
        rounds.append([part.count() for part in out])
        return out

    monkeypatch.setattr(J, "_subregions", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sets = [shingles(text) for _, text in rows]
    links = [(a, b) for a in range(len(rows)) for b in range(a) if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    assert len(links) > 100
    want = Counter((r[0], len(s), c) for r, s, c in zip(rows, sets, components([r[0] for r in rows], links)))
    found = J.jaccard_join(docs).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == want
    assert not rounds if tile == 512 else len(rounds) > 1 and all(map(any, zip(*rounds)))  # each way of a cut is taken
