"""Loads into folders and tables."""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.schemas import CREATED_DAY
from millrace.session import remove_folder


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_orc(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").orc(path)


def write_xml(df: DataFrame, path: str, root_tag: str = "data", row_tag: str = "row") -> None:
    df.write.mode("overwrite").option("rootTag", root_tag).option("rowTag", row_tag).xml(path)


def write_avro(df: DataFrame, path: str, avro_schema: str | None = None) -> None:
    from millrace.sources.files import avro_available

    if not avro_available(df.sparkSession):
        raise RuntimeError("writing Avro needs the spark-avro package on the class path")
    writer = df.write.mode("overwrite").format("avro")
    (writer.option("avroSchema", avro_schema) if avro_schema else writer).save(path)


def load_table(df: DataFrame, table: str, path: str | None = None) -> None:
    """Truncate and load a whole table, kept at ``path`` or in the warehouse folder."""
    writer = df.write.mode("overwrite").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(table)


def _is_bad(field: T.StructField) -> Column:
    """The column has a value, but none of the declared type."""
    return F.col(field.name).isNotNull() & F.col(field.name).try_cast(field.dataType).isNull()


def conform(df: DataFrame, schema: T.StructType, strict: bool = True) -> DataFrame:
    """The declared columns in order, cast. A value that is none of the declared type fails the load; with
    ``strict=False`` it becomes null, and ``conform_or_reject`` sets its row aside instead."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns missing from the input: {missing}")

    def cast(field: T.StructField) -> Column:
        value = F.col(field.name).try_cast(field.dataType)
        if not strict:
            return value
        said = F.concat(F.lit(f"{field.name} is no {field.dataType.simpleString()}: "), F.col(field.name).cast("string"))
        return F.when(_is_bad(field), F.raise_error(said)).otherwise(value)

    return df.select([cast(f).alias(f.name) for f in schema.fields])


def conform_or_reject(df: DataFrame, schema: T.StructType, bad: str = "bad_columns") -> tuple[DataFrame, DataFrame]:
    """The rows that conform, cast, and the others as they came with the names of their bad columns."""
    names = F.array_compact(F.array(*[F.when(_is_bad(f), F.lit(f.name)) for f in schema.fields]))
    passed = ~reduce(or_, [_is_bad(f) for f in schema.fields])
    return conform(df.filter(passed), schema, strict=False), df.withColumn(bad, names).filter(F.size(bad) > 0)


def with_day(df: DataFrame, ts: str, day: str = CREATED_DAY) -> DataFrame:
    return df.withColumn(day, F.to_date(ts))


def write_by_day(df: DataFrame, path: str, ts: str, mode: str = "overwrite", day: str = CREATED_DAY) -> None:
    """Day-partitioned load. Rows are gathered by day and a salt, so that a hot day still fills many
    files while a quiet day does not become one tiny file per task."""
    _gathered(with_day(df, ts, day), day).write.mode(mode).partitionBy(day).parquet(path)


def replace_days(df: DataFrame, path: str, ts: str, day: str = CREATED_DAY) -> None:
    """Replace exactly the days present in ``df``; all other days stay as they are."""
    (
        _gathered(with_day(df, ts, day), day)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(day)
        .parquet(path)
    )


def _gathered(df: DataFrame, day: str) -> DataFrame:
    """A rebalance hint: AQE sizes the outputs and splits a day that is larger than the target."""
    return df.hint("rebalance", day)


def write_clustered(df: DataFrame, path: str, columns: Sequence[str], files: int | None = None) -> None:
    """Range-partitioned and sorted by ``columns``, so that file statistics skip most files on lookup.

    A last random range column lets a value that fills much of the table run over many files.
    """
    ranges = [*[F.col(c) for c in columns], F.rand(seed=1)]
    laid_out = df.repartitionByRange(files, *ranges) if files else df.repartitionByRange(*ranges)
    laid_out.sortWithinPartitions(*columns).write.mode("overwrite").parquet(path)


def export_query(spark: SparkSession, sql: str, path: str) -> None:
    write_parquet(spark.sql(sql), path)


def dump_table(spark: SparkSession, table: str, path: str) -> None:
    write_csv(spark.table(table), path)


def audit(df: DataFrame, table: str) -> DataFrame:
    """One row: table, rows, columns."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(table).alias("table_name"), "row_count", F.lit(len(df.columns)).cast("bigint").alias("column_count")
    )


def audited(load: Callable[[], None], read_back: Callable[[], DataFrame], table: str) -> DataFrame:
    """Run a load and return its audit row with the seconds it took."""
    started = time.monotonic()
    load()
    seconds = time.monotonic() - started
    return audit(read_back(), table).withColumn("seconds", F.lit(seconds))


def load_seed(spark: SparkSession, path: str, schema: str, table: str, location: str | None = None) -> None:
    """A typed CSV seed into a table."""
    from millrace.sources.files import read_csv_typed

    load_table(read_csv_typed(spark, path, schema), table, location)


class Attempt(NamedTuple):
    """Which plan was written, and what stopped the primary one (None if nothing did)."""

    written: str
    error: Exception | None


def first_that_works(primary: Callable[[], DataFrame], fallback: Callable[[], DataFrame], path: str) -> Attempt:
    """Write the primary result, or the fallback if the primary fails.

    Each attempt goes to a folder of its own beside ``path`` and takes its place only when it is complete, so
    the old output stays when both fail; the fallback's error is then raised from the primary's.
    """
    try:
        _write_aside(primary(), path)
        return Attempt("primary", None)
    except Exception as stopped:  # whatever stopped the primary, the fallback is the answer
        try:
            _write_aside(fallback(), path)
        except Exception as error:
            raise error from stopped
        return Attempt("fallback", stopped)


def _write_aside(df: DataFrame, path: str) -> None:
    """Write beside ``path``, then swap: the old folder is moved away first and removed last."""
    spark, mark = df.sparkSession, uuid.uuid4().hex
    fresh, old = f"{path.rstrip('/')}.new-{mark}", f"{path.rstrip('/')}.old-{mark}"
    try:
        write_parquet(df, fresh)
    except Exception:
        remove_folder(spark, fresh)
        raise
    Path = spark._jvm.org.apache.hadoop.fs.Path
    files = Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(Path(path)) and not files.rename(Path(path), Path(old)):
        raise OSError(f"{path} cannot be moved")
    if not files.rename(Path(fresh), Path(path)):
        files.rename(Path(old), Path(path))
        raise OSError(f"{fresh} cannot take the place of {path}")
    remove_folder(spark, old)


def ingest_day(df: DataFrame | None, path: str, ts: str, day: dt.date | str) -> bool:
    """Load one day's rows into its partition; a missing or empty input is a successful skip."""
    from millrace.sources.jdbc import day_slice

    if df is None:
        return False
    rows = day_slice(df, ts, day)
    if rows.isEmpty():
        return False
    replace_days(rows, path, ts)
    return True
