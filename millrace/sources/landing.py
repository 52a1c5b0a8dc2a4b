"""Landed API records."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.sinks.layout import raw_path

# Names under which records arrive, and the names the models use.
LANDED_NAMES = {"user": "user_id", "order": "order_id", "product": "product_id", "address": "address_id"}
LANDED_TABLES = {"order-items": "order_items"}


def table_name(landed: str) -> str:
    return LANDED_TABLES.get(landed, landed)


def normalise(records: DataFrame, schema: T.StructType) -> DataFrame:
    """Landed records with model names, in the declared order and types; missing fields are null."""
    present = {LANDED_NAMES.get(c, c): c for c in records.columns}
    return records.select(
        [
            (F.col(f"`{present[f.name]}`") if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def land_day(records: DataFrame, root: str, domain: str, table: str, day: dt.date | str) -> str | None:
    """Write one day's records as CSV with a header; no file, and ``None``, when the day is empty."""
    if records.isEmpty():
        return None
    path = raw_path(root, domain, table_name(table), day)
    records.write.mode("overwrite").option("header", True).csv(path)
    return path


def read_records(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame | None:
    """A landed JSON array of records, or ``None`` when nothing was landed."""
    try:
        return spark.read.option("multiLine", True).schema(schema).json(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
