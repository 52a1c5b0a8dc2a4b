"""Rail movement models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.plans.models import Project, model

FACT_COLUMNS = ["event_type", "actual_timestamp_utc", "event_source", "train_id", "variation_status", "toc_id"]


@model
def stg_movements(project: Project) -> DataFrame:
    """The narrow movement row; the scan reads only its columns."""
    return project.source("movements").withColumnRenamed("actual_timestamp", "actual_timestamp_utc").select(*FACT_COLUMNS)


@model
def stg_operating_companies(project: Project) -> DataFrame:
    return project.source("operating_companies").select("toc_id", "company_name")


def join_companies(movements: DataFrame, companies: DataFrame, dedupe_reference: bool = False) -> DataFrame:
    """Movements left-joined to companies with no company column kept.

    A company id that occurs twice in the reference doubles its movements, as in the original model;
    ``dedupe_reference`` counts every movement once, which leaves nothing to join. The keys differ in
    type, text against integer: text that is no number matches nothing. ``movements`` may be a stream.
    """
    if dedupe_reference:
        return movements.select(*FACT_COLUMNS)
    reference = companies.select(F.col("toc_id").alias("company_toc_id"))
    return movements.join(
        reference, F.col("toc_id").try_cast("int") == F.col("company_toc_id"), "left"
    ).select(*FACT_COLUMNS)


@model
def fct_movements(project: Project) -> DataFrame:
    return join_companies(project.ref("stg_movements"), project.ref("stg_operating_companies"))
