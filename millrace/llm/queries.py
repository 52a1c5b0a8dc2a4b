"""The operators as queries over the given tables, with production parameters, and their oracle SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import license_scan
from millrace.llm.byte_bpe import decode_ids, encode_texts, token_digests
from millrace.llm.common import Workspace, read
from millrace.llm.conversation_repair import repair_report, with_damage
from millrace.llm.decontaminate import find_leaks
from millrace.llm.embedding_dedup import near_copies
from millrace.llm.jaccard_join import jaccard_join
from millrace.llm.language_id import identify_languages, train_languages
from millrace.llm.license_scan import known_licenses, scan_licenses
from millrace.llm.periodic_runs import find_runs, run_digests, with_repeats
from millrace.llm.pseudonyms import KEY, pseudonymise
from millrace.llm.secret_scan import scan_secrets
from millrace.llm.source_mix import SEED, STEPS, WEIGHTS, mix_sources
from millrace.llm.token_counts import count_tokens
from millrace.llm.url_filter import judge_urls

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op1_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_copies(read(spark, folder, "embeddings"))


def op2_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mix_sources(read(spark, folder, "documents"))


def op3_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join(read(spark, folder, "documents")).drop("text_key")


def op4_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return scan_licenses(read(spark, folder, "documents"), known_licenses(spark))


def op5_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return judge_urls(read(spark, folder, "pages"))


def op6_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return scan_secrets(read(spark, folder, "documents"))


def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return count_tokens(read(spark, folder, "documents"))


def op8_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return find_leaks(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


def op9_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    return identify_languages(docs, train_languages(docs))


def op10_pii_pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    return pseudonymise(read(spark, folder, "documents").select("doc_id", "text"), KEY)


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return run_digests(find_runs(with_repeats(read(spark, folder, "documents"))))


def op12_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return token_digests(decode_ids(encode_texts(read(spark, folder, "documents"), offsets=False), text=False))


def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    conversations = read(spark, folder, "conversations")
    with Workspace(spark, "op13") as work:
        return work.result(repair_report(conversations, with_damage(conversations), work))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


QUERIES = {
    query.__name__: query
    for query in (
        op1_embedding_near_dedup, op2_source_mix, op3_ngram_jaccard_join, op4_license_scan, op5_url_filter,
        op6_secret_scan, op7_token_counts, op8_benchmark_decontamination, op9_language_id, op10_pii_pseudonyms,
        op11_periodic_runs, op12_byte_bpe, op13_conversation_repair, pipeline,
    )
}

# -- oracle SQL -----------------------------------------------------------------------------------

COSINE = "list_dot_product(x.v, y.v) / (sqrt(list_dot_product(x.v, x.v)) * sqrt(list_dot_product(y.v, y.v)))"
OP1 = f"""
WITH RECURSIVE vectors AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
), links AS (
    SELECT x.vec_id AS a, y.vec_id AS b FROM vectors x JOIN vectors y
    ON x.label = y.label AND x.vec_id <> y.vec_id AND {COSINE} >= 0.98
), reached AS (
    SELECT vec_id AS a, vec_id AS b FROM vectors UNION SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a
), components AS (SELECT a, min(b) AS component_id FROM reached GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM vectors JOIN components ON vec_id = a
LEFT JOIN (SELECT a AS l, count(*) AS n FROM links GROUP BY a) ON vec_id = l
"""

_UNIFORM = "CAST(CAST('0x' || substr(md5({}), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496.0"
_PART = "CASE " + " ".join(f"WHEN source = '{name}' THEN '{name}'" for name in WEIGHTS) + " ELSE '' END"
_SHARE = "CASE part " + " ".join(f"WHEN '{name}' THEN {share}" for name, share in WEIGHTS.items())
_SHARE += f" ELSE {max(0.0, 1 - sum(WEIGHTS.values()))} END"
OP2 = f"""
WITH known AS (SELECT *, {_PART} AS part, md5(coalesce(text, '')) AS own FROM documents),
sizes AS (SELECT part, sum(coalesce(length(text), 0)) AS size FROM known GROUP BY part),
rates AS (
    SELECT part, CAST({_SHARE} AS DOUBLE) * (SELECT sum(size) FROM sizes) / size AS rate FROM sizes WHERE size > 0
), terms AS (
    SELECT part, k, exp(k * ln(rate) - rate - lgamma(k + 1)) AS term
    FROM (SELECT part, rate, unnest(range(0, CAST(ceil(rate + {STEPS} * sqrt(rate) + {STEPS}) AS BIGINT) + 1)) AS k
          FROM rates WHERE rate > 0)
), steps AS (
    SELECT part, k, sum(term) OVER (PARTITION BY part ORDER BY k ROWS UNBOUNDED PRECEDING) AS step FROM terms
), drawn AS (
    SELECT known.*, {_UNIFORM.format(f"concat('{SEED}:', coalesce(CAST(doc_id AS VARCHAR), ''), ':', own)")} AS u FROM known
), counted AS (
    SELECT doc_id, count(*) AS copies FROM drawn JOIN steps ON drawn.part = steps.part AND step <= u GROUP BY doc_id
), copied AS (
    SELECT documents.*, copies, unnest(range(1, copies + 1)) AS copy_no
    FROM documents JOIN counted ON documents.doc_id = counted.doc_id
)
SELECT *, {_UNIFORM.format(f"concat('{SEED + 1}:', CAST(doc_id AS VARCHAR), ':', md5(coalesce(text, '')), ':', CAST(copy_no AS VARCHAR))")} AS deal
FROM copied
"""

_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+')"
_RUNS = """CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))) END"""
OP3 = f"""
WITH RECURSIVE sets AS (
    SELECT doc_id, {_RUNS} AS shingles FROM (SELECT doc_id, {_WORDS} AS words FROM documents)
), items AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM sets),
links AS (
    SELECT x.doc_id AS a, y.doc_id AS b FROM items x JOIN items y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id
    GROUP BY x.doc_id, y.doc_id, x.n, y.n HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))
), reached AS (
    SELECT doc_id AS a, doc_id AS b FROM sets UNION SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a
), components AS (SELECT a, min(b) AS component_id FROM reached GROUP BY a)
SELECT doc_id, len(shingles) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN components ON doc_id = a
"""

OP8 = f"""
WITH doc_sets AS (
    SELECT doc_id, {_RUNS} AS shingles FROM (SELECT doc_id, {_WORDS} AS words FROM documents)
), item_sets AS (
    SELECT item_id, {_RUNS} AS shingles FROM (SELECT item_id, {_WORDS} AS words FROM benchmark)
), d AS (SELECT doc_id, unnest(shingles) AS shingle FROM doc_sets),
b AS (SELECT item_id, len(shingles) AS n_item, unnest(shingles) AS shingle FROM item_sets)
SELECT doc_id, item_id, n_item, count(*) AS n_shared FROM d JOIN b ON d.shingle = b.shingle
GROUP BY doc_id, item_id, n_item HAVING 4 * count(*) >= 3 * n_item
"""

ORACLES = {
    "op1_embedding_near_dedup": OP1,
    "op2_source_mix": OP2,
    "op3_ngram_jaccard_join": OP3,
    "op4_license_scan": license_scan.oracle(),
    "op8_benchmark_decontamination": OP8,
}
