"""A training corpus from raw documents: five stages, each of which works on all that the one before kept.

``STAGES`` lists the stages in order. Each takes ``(spark, docs, sf_dir)`` and returns a DataFrame; the caller writes it
as Parquet and reads it again as the next one's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import Workspace, read
from millrace.llm.decontaminate import without_leaks
from millrace.llm.jaccard_join import one_of_each
from millrace.llm.language_id import keep_identified
from millrace.llm.pseudonyms import KEY, pseudonymise
from millrace.llm.source_mix import mix_sources


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known with enough of a margin."""
    return keep_identified(docs)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items."""
    return without_leaks(docs, read(spark, sf_dir, "benchmark"))


def protect(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with pseudonyms in place of personal numbers, dates and addresses; ``n_chars`` is counted anew.

    The key is the session's ``millrace.pseudonyms.key``; only without one is it an example that everyone knows.
    """
    columns = [F.length("text").cast(docs.schema[c].dataType).alias(c) if c.lower() == "n_chars" else F.col(c) for c in docs.columns]
    return pseudonymise(docs, spark.conf.get("millrace.pseudonyms.key", KEY)).select(columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that sources have their target shares, in a random order."""
    return mix_sources(docs)


STAGES = [
    ("language_id", identify),
    ("near_duplicates", deduplicate),
    ("decontamination", decontaminate),
    ("pii", protect),
    ("source_mix", mix),
]

ORACLE_SQL = None  # compression, pseudonyms and MinHash have no SQL form; the tests hold run() against plain code


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    with Workspace(spark, "pipeline") as work:
        for _, stage in STAGES[:-1]:
            docs = work.keep(stage(spark, docs, sf_dir))
        return work.result(STAGES[-1][1](spark, docs, sf_dir))
