"""Vectors and retrieval over whole tables."""

from pyspark.sql import functions as F

from millrace.functions import vectors as V
from millrace.operators import vectors as R
from millrace.plans.bindings import table
from millrace.queries.registry import query
from millrace.session import scratch, shared_folder, spread

FIRST = "(SELECT CAST(embedding AS DOUBLE[]) FROM embeddings WHERE vec_id = 0)"


def _first_vector(spark, folder):
    return list(table(spark, folder, "embeddings").filter("vec_id = 0").first()["embedding"])


def _label_means(spark, folder):
    """Mean vector of every label, one aggregate per position in a single pass."""
    embeddings = table(spark, folder, "embeddings")
    size = len(embeddings.select("embedding").first()[0])
    means = F.array(*[F.avg(F.get("embedding", F.lit(i)).cast("double")) for i in range(size)])
    return embeddings.groupBy("label").agg(means.alias("embedding"))


MEANS = """means AS (SELECT label, list(m ORDER BY i) AS mean FROM (
    SELECT label, i, avg(CAST(embedding[i] AS DOUBLE)) AS m FROM embeddings, range(1, 65) t(i) GROUP BY 1, 2) GROUP BY 1)"""


@query(f"""SELECT vec_id, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), {FIRST}), 6) AS similarity
    FROM embeddings""")
def cosine(spark, folder):
    wanted = F.array(*[F.lit(float(x)) for x in _first_vector(spark, folder)])
    similarity = F.round(V.cosine_similarity(F.col("embedding"), wanted), 6)
    return table(spark, folder, "embeddings").select("vec_id", similarity.alias("similarity"))


@query(f"""SELECT vec_id, label, round(list_distance(CAST(embedding AS DOUBLE[]), {FIRST}), 6) AS distance
    FROM embeddings ORDER BY 3, 1 LIMIT 3""")
def euclid_topk(spark, folder):
    near = R.nearest_to(table(spark, folder, "embeddings"), _first_vector(spark, folder), 3)
    return near.select("vec_id", "label", F.round("distance", 6).alias("distance"))


@query(f"""WITH {MEANS}, scored AS (SELECT m.label AS query_id, vec_id AS base_id,
      round(list_distance(CAST(embedding AS DOUBLE[]), mean), 6) AS distance FROM embeddings, means m)
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, base_id) AS INTEGER) AS rank,
      base_id, distance FROM scored QUALIFY rank <= 3""")
def batch_topk(spark, folder):
    """The three rows nearest to each label's mean vector."""
    return R.nearest_for_each(
        _label_means(spark, folder), table(spark, folder, "embeddings"), 3, "label", "vec_id", digits=6
    )


@query(f"""WITH {MEANS} SELECT vec_id, max(s) AS best_similarity, CAST(arg_max(label, s) AS INTEGER) AS best_label FROM
    (SELECT vec_id, m.label, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), mean), 6) AS s
     FROM embeddings, means m) GROUP BY 1""")
def similarity_rows(spark, folder):
    """Similarity of every row to each label's mean, reduced to the best one."""
    rows = R.similarity_rows(table(spark, folder, "embeddings"), _label_means(spark, folder), "label")
    best = F.array_max(F.transform("similarities", lambda s: F.struct(F.round(s["similarity"], 6).alias("s"), s["anchor"].alias("a"))))
    scored = rows.groupBy("vec_id").agg(F.max(best).alias("best"))  # a row for every block of labels
    return scored.select("vec_id", F.col("best.s").alias("best_similarity"), F.col("best.a").alias("best_label"))


@query()
def lsh_topk(spark, folder):
    near = R.approximate_nearest(table(spark, folder, "embeddings"), _first_vector(spark, folder), 3)
    return near.select("vec_id", F.round("distance", 6).alias("distance"))


def embedding_sql(source: str, key: str) -> str:
    """The offline embedder in SQL: (key, vector)."""
    return f"""SELECT {key}, list(coalesce(n, 0) / greatest(length, 1e-300) ORDER BY i) AS vector FROM (
      SELECT k.{key}, i, n, sqrt(sum(coalesce(n, 0) * coalesce(n, 0)) OVER (PARTITION BY k.{key})) AS length
      FROM (SELECT {key}, i FROM {source}, range(0, 64) t(i)) k LEFT JOIN (
        SELECT {key}, CAST('0x' || substr(md5(w), 1, 4) AS INTEGER) % 64 AS bucket, CAST(count(*) AS DOUBLE) AS n
        FROM (SELECT {key}, unnest(string_split(lower(text), ' ')) AS w FROM {source}) WHERE w <> '' GROUP BY 1, 2) c
      ON k.{key} = c.{key} AND k.i = c.bucket) GROUP BY {key}"""


def _moments(vector: str):
    summed = F.aggregate(vector, F.lit(0.0), lambda total, x: total + x)
    filled = F.size(F.filter(vector, lambda x: x > 0))
    return filled.alias("filled"), F.round(summed, 6).alias("total"), F.round(V.norm(F.col(vector)), 6).alias("length")


MOMENTS = """CAST(len([x for x in vector if x > 0]) AS INTEGER) AS filled, round(list_sum(vector), 6) AS total,
    round(sqrt(list_sum([x * x for x in vector])), 6) AS length"""


@query(f"SELECT doc_id, {MOMENTS} FROM ({embedding_sql('documents', 'doc_id')})")
def embed_text(spark, folder):
    documents = spread(table(spark, folder, "documents").select("doc_id", "text"))
    return R.embed_text(documents, "text").select("doc_id", *_moments("embedding"))


@query(f"""SELECT d.text, {MOMENTS} FROM documents d JOIN ({embedding_sql('documents', 'doc_id')}) e
    ON d.doc_id = e.doc_id""")
def store_vectors(spark, folder):
    """Text and vector rows written, replaced and read back."""
    path = scratch(spark, "vectors")
    R.embed_text(spread(table(spark, folder, "documents").select("text")), "text").write.mode("overwrite").parquet(path)
    return spark.read.parquet(path).select("text", *_moments("embedding"))


@query(f"""WITH base AS ({embedding_sql('documents', 'doc_id')}), asked AS ({embedding_sql('benchmark', 'item_id')}),
    scored AS (SELECT item_id, doc_id, round(list_distance(b.vector, a.vector), 6) AS distance FROM asked a, base b),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY distance, doc_id) AS rank FROM scored)
    SELECT r.item_id AS query_id, chr(10) || 'Context:' || chr(10) || string_agg(d.text, ' / ' ORDER BY rank) || chr(10)
      || chr(10) || 'Question:' || chr(10) || any_value(q.text) || chr(10) AS prompt
    FROM ranked r JOIN documents d ON r.doc_id = d.doc_id JOIN benchmark q ON q.item_id = r.item_id
    WHERE rank <= 3 GROUP BY 1""")
def rag_context(spark, folder):
    """For every benchmark question a prompt holding its three nearest documents; only texts new to the store are embedded."""
    questions, documents = table(spark, folder, "benchmark"), table(spark, folder, "documents")
    store = R.VectorStore(spark, f"{shared_folder(spark)}/millrace/vector-store")
    store.add(spread(documents.select("text").unionByName(questions.select("text"))))
    asked = store.vectors(questions.select("item_id", "text"))
    base = store.vectors(documents.select("doc_id", "text")).drop("text")
    matches = R.nearest_for_each(asked, base, 3, "item_id", "doc_id", digits=6)
    contexts = R.retrieval_context(matches, documents, "doc_id", "text")
    return R.prompt(contexts, questions, "item_id", "text")
