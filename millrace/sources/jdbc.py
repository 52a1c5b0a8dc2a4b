"""Database extracts over JDBC. The driver jar and the database come with the deployment."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.dates import day_bounds, in_range, moment


@dataclass(frozen=True)
class Database:
    """Connection settings; ``fetch_size`` rows travel per round trip (a server-side cursor)."""

    url: str
    properties: dict[str, str] = field(default_factory=dict)
    fetch_size: int = 10_000

    def options(self) -> dict[str, str]:
        return {"url": self.url, "fetchsize": str(self.fetch_size), **self.properties}


def table_options(db: Database, table: str, split: tuple[str, int, int, int] | None = None) -> dict[str, str]:
    """Options of a full-table scan; ``split`` = (column, lower, upper, tasks) reads ranges in parallel."""
    options = {**db.options(), "dbtable": table}
    if split:
        column, lower, upper, tasks = split
        options |= {
            "partitionColumn": column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(tasks),
        }
    return options


def query_options(db: Database, sql: str, split: tuple[str, int, int, int] | None = None) -> dict[str, str]:
    """Options of a query extract. With ``split``, as in ``table_options`` on a column of the result, the query is
    read as a derived table, as Spark splits tables only; without, one task reads it all."""
    if split:
        return table_options(db, f"({sql.strip().rstrip(';')}) extract_rows", split)
    return {**db.options(), "query": sql}


def read_table(
    spark: SparkSession, db: Database, table: str, split: tuple[str, int, int, int] | None = None
) -> DataFrame:
    return spark.read.format("jdbc").options(**table_options(db, table, split)).load()


def read_query(
    spark: SparkSession, db: Database, sql: str, split: tuple[str, int, int, int] | None = None
) -> DataFrame:
    return spark.read.format("jdbc").options(**query_options(db, sql, split)).load()


def day_slice(table: DataFrame, ts: str, day: dt.date | str) -> DataFrame:
    """Rows of one day, as a half-open range that databases and files can both use."""
    return table.filter(in_range(F.col(ts), day_bounds(day)))


def high_water_mark(loaded: DataFrame, ts: str) -> DataFrame:
    """One row holding the latest loaded timestamp."""
    return loaded.agg(F.max(ts).alias("last_loaded"))


def newer_than(table: DataFrame, ts: str, mark: dt.datetime | Column | None) -> DataFrame:
    """Rows strictly after the mark; everything when nothing was loaded yet."""
    if mark is None:
        return table
    if not isinstance(mark, Column):
        zone_free = isinstance(table.schema[ts].dataType, T.TimestampNTZType)
        mark = moment(mark) if zone_free else F.lit(mark)
    return table.filter(F.col(ts) > mark)


def increment(table: DataFrame, loaded: DataFrame, ts: str) -> DataFrame:
    """Rows of ``table`` strictly newer than the newest row of ``loaded``.

    The mark is one value, read first, so that the filter is a plain comparison pushed to the source.
    """
    return newer_than(table, ts, high_water_mark(loaded, ts).first()["last_loaded"])
