import subprocess
import sys

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from millrace.operators import vectors as R


@pytest.fixture(scope="module")
def base(spark):
    rng = np.random.default_rng(3)
    vectors = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(400)]
    vectors += [(900 + i, vectors[5][1]) for i in range(150)]  # many copies of one vector
    vectors += [(2000, None), (2001, [0.0] * 8)]
    return spark.createDataFrame(vectors, "vec_id bigint, embedding array<double>").repartition(5).cache()


def brute_force(base, target, k):
    found = [
        (float(np.sqrt(((np.array(r["embedding"]) - target) ** 2).sum())), r["vec_id"])
        for r in base.collect()
        if r["embedding"] is not None
    ]
    return [i for _, i in sorted(found)[:k]]


def test_nearest_to_one_vector(base):
    target = base.filter("vec_id = 5").first()["embedding"]
    found = [r["vec_id"] for r in R.nearest_to(base, target, 4).collect()]
    assert found == brute_force(base, np.array(target), 4) == [5, 900, 901, 902]


@pytest.mark.parametrize("block, chunk", [(8192, 1_000_000), (4, 50)])
def test_nearest_for_each_matches_brute_force(spark, base, block, chunk, monkeypatch):
    monkeypatch.setattr(R, "BLOCK_QUERIES", block)
    monkeypatch.setattr(R, "CHUNK_CELLS", chunk)
    rng = np.random.default_rng(4)
    asked = [(f"q{i}", [float(x) for x in rng.normal(size=8)]) for i in range(7)]
    asked += [("copy", base.filter("vec_id = 5").first()["embedding"]), ("null", None)]
    queries = spark.createDataFrame(asked, "query_id string, embedding array<double>")
    found = {}
    for r in R.nearest_for_each(queries, base, 3).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["base_id"], r["distance"]))
    for name, vector in asked:
        if vector is None:
            assert name not in found
            continue
        ranked = sorted(found[name])
        assert [i for _, i, _ in ranked] == brute_force(base, np.array(vector), 3)
        assert [r for r, _, _ in ranked] == [1, 2, 3]
    assert [d for _, _, d in sorted(found["copy"])] == [0.0, 0.0, 0.0]


def test_fewer_rows_than_asked_for(spark, base):
    few = base.filter("vec_id < 2")
    queries = spark.createDataFrame([(1, [0.0] * 8)], "query_id int, embedding array<double>")
    assert R.nearest_for_each(queries, few, 3).count() == 2
    assert R.nearest_for_each(queries.limit(0), few, 3).count() == 0


def test_repeated_query_ids_are_refused(spark, base):
    queries = spark.createDataFrame([(1, [0.0] * 8), (1, [1.0] * 8)], "query_id int, embedding array<double>")
    with pytest.raises(ValueError, match="repeated"):
        R.nearest_for_each(queries, base, 3)


def test_uneven_vectors_are_refused(spark):
    ragged = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0])], "vec_id int, embedding array<double>").coalesce(1)
    queries = spark.createDataFrame([(1, [0.0, 0.0])], "query_id int, embedding array<double>")
    with pytest.raises(Exception, match="differ in length"):
        R.nearest_for_each(queries, ragged, 1).collect()


def test_approximate_search_recalls_the_exact_one(base):
    dense = base.filter("embedding is not null and vec_id < 900")
    hits, asked = 0, 0
    for i in (1, 50, 200, 300):
        target = dense.filter(F.col("vec_id") == i).first()["embedding"]
        exact = {r["vec_id"] for r in R.nearest_to(dense, target, 3).collect()}
        near = {r["vec_id"] for r in R.approximate_nearest(dense, target, 3).collect()}
        hits, asked = hits + len(exact & near), asked + 3
        assert i in near
    assert hits / asked >= 0.6


@pytest.mark.parametrize("digits", [None, 3])
def test_far_from_the_origin_close_vectors_keep_their_order(spark, digits):
    rng = np.random.default_rng(5)
    rows = 1e4 + np.concatenate([rng.normal(size=(300, 4)), np.full((40, 4), 1e-3) * rng.integers(1, 4, (40, 1))])
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(rows)], "vec_id int, embedding array<double>")
    queries = spark.createDataFrame([(1, [1e4] * 4)], "query_id int, embedding array<double>")
    found = R.nearest_for_each(queries, df.repartition(3), 25, digits=digits).orderBy("rank").collect()
    gaps = np.sqrt(np.square(rows - 1e4).sum(axis=1))
    gaps = gaps if digits is None else np.round(gaps, digits)
    assert [r["base_id"] for r in found] == list(np.lexsort((np.arange(len(gaps)), gaps))[:25])


def test_vectors_that_are_not_finite_match_nothing(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame([(1, [nan, 0.0]), (2, [inf, 0.0]), (3, [1.0, 0.0])], "vec_id int, embedding array<double>")
    queries = spark.createDataFrame([(1, [0.0, 0.0]), (2, [0.0, nan])], "query_id int, embedding array<double>")
    found = R.nearest_for_each(queries, df, 3).collect()
    assert [(r["query_id"], r["base_id"]) for r in found] == [(1, 3)]


@pytest.mark.parametrize("block", [8192, 1])
def test_similarity_rows(spark, block, monkeypatch):
    monkeypatch.setattr(R, "BLOCK_QUERIES", block)
    rows = [(1, [1.0, 0.0]), (2, [3.0, 4.0]), (3, [0.0, 0.0]), (4, None)]
    df = spark.createDataFrame(rows, "id int, embedding array<double>")
    anchors = spark.createDataFrame([("x", [1.0, 0.0]), ("y", [0.0, 2.0]), ("z", None)], "name string, embedding array<double>")
    found = {}
    for row in R.similarity_rows(df, anchors, "name").collect():
        found.setdefault(row["id"], {}).update({s["anchor"]: s["similarity"] for s in row["similarities"]})
    assert found == {1: {"x": 1.0, "y": 0.0}, 2: {"x": pytest.approx(0.6), "y": pytest.approx(0.8)}, 3: {"x": None, "y": None}}
    assert R.similarity_rows(df, anchors.limit(0), "name").collect() == []


def test_a_store_embeds_a_text_once(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)

    def counted(texts):
        calls.add(len(texts))
        return np.array([[len(t), 1.0] for t in texts])

    store = R.VectorStore(spark, str(tmp_path / "store"), "lengths", counted)
    docs = spark.createDataFrame([(1, "abc"), (2, "abc"), (3, ""), (4, None)], "id int, text string")
    store.add(docs)
    assert calls.value == 2
    store.add(docs)
    assert calls.value == 2  # a second run embeds nothing
    more = docs.unionByName(spark.createDataFrame([(5, "new")], "id int, text string"))
    store.add(more)
    assert calls.value == 3
    found = {r["id"]: r["embedding"] for r in store.vectors(more).collect()}
    assert found == {1: [3.0, 1.0], 2: [3.0, 1.0], 3: [0.0, 1.0], 4: None, 5: [3.0, 1.0]}
    store.read().write.mode("append").parquet(store.path)  # as two runs at a time would
    assert store.vectors(more).count() == 5


def test_embedding_is_deterministic_and_unit_length(spark):
    texts = [(1, "Remote work is productive"), (2, "remote WORK  is productive"), (3, ""), (4, None)]
    df = spark.createDataFrame(texts, "id int, text string")
    got = {r["id"]: r["embedding"] for r in R.embed_text(df, "text").collect()}
    assert got[1] == got[2] and got[4] is None
    assert sum(x * x for x in got[1]) == pytest.approx(1.0)
    assert got[3] == [0.0] * 64


def test_embedder_is_pluggable_and_runs_once(spark):
    def lengths(texts):
        return np.array([[len(t), 1.0] for t in texts])

    df = spark.createDataFrame([("abc",), ("z",)], "text string")
    embedded = R.embed_text(df, "text", lengths).filter("embedding is not null")
    assert sorted(r["embedding"] for r in embedded.collect()) == [[1.0, 1.0], [3.0, 1.0]]
    plan = embedded.repartition(2).filter("size(embedding) = 2")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_retrieval_prompt(spark):
    docs = spark.createDataFrame(
        [(1, "course on data pipelines"), (2, "course on design"), (3, "data pipelines with care"), (4, "cooking")],
        "doc_id int, text string",
    )
    asked = spark.createDataFrame([(7, "data pipelines")], "item_id int, text string")
    matches = R.nearest_for_each(
        R.embed_text(asked, "text"), R.embed_text(docs, "text"), 2, "item_id", "doc_id"
    )
    contexts = R.retrieval_context(matches, docs, "doc_id", "text")
    text = R.prompt(contexts, asked, "item_id", "text").first()["prompt"]
    assert text == "\nContext:\ncourse on data pipelines / data pipelines with care\n\nQuestion:\ndata pipelines\n"


def test_helpers_need_no_package_on_the_executors(tmp_path):
    script = "import pickle, sys; f = pickle.load(sys.stdin.buffer); print(f.__name__, 'millrace' in sys.modules)"
    for helper in (R._scan_chunk, R._first_of_each, R.hashed_words()):
        done = subprocess.run(
            [sys.executable, "-c", script], input=cloudpickle.dumps(helper), cwd=tmp_path, capture_output=True, check=True
        )
        assert done.stdout.split() == [helper.__name__.encode(), b"False"]
