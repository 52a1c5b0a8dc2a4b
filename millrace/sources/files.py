"""File scans. Paths are Hadoop file-system URIs; a glob or a list works wherever Spark accepts one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.nested import flatten


def read_csv_text(spark: SparkSession, path: str) -> DataFrame:
    """Header row, every column a string; one pass."""
    return spark.read.option("header", True).csv(path)


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """Header row, types inferred by an extra pass over the files; declare types for large inputs."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def read_csv_typed(spark: SparkSession, path: str, schema: T.StructType | str, strict: bool = True) -> DataFrame:
    """Header row skipped, declared types. A value that does not parse fails the read of its column, or with
    ``strict=False`` becomes null; text read by ``read_csv_text`` can go through ``conform_or_reject`` instead."""
    reader = spark.read.option("header", True).option("enforceSchema", True).option("mode", "FAILFAST" if strict else "PERMISSIVE")
    return reader.schema(schema).csv(path)


def read_csv_renamed(spark: SparkSession, path: str, names: Sequence[str], inferred: bool = True) -> DataFrame:
    """A file with an untidy header (quoted names, leading blanks), columns renamed by position.

    Lines holding only blanks are no rows; a row whose fields are all empty is one, of nulls.
    """
    rows = (
        spark.read.option("header", True)
        .option("inferSchema", inferred)
        .option("ignoreLeadingWhiteSpace", True)
        .option("ignoreTrailingWhiteSpace", True)
        .csv(path)
    )
    return rows.toDF(*names)


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """JSON lines with a declared schema; absent and unreadable fields become null."""
    return spark.read.schema(schema).json(path)


def read_json_documents(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """A multi-line JSON array of nested documents, flattened to dotted columns.

    A multi-line file cannot be split: one task reads one file, so keep such files small.
    """
    reader = spark.read.option("multiLine", True)
    return flatten((reader.schema(schema) if schema else reader).json(path))


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def read_orc(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.orc(path)


def read_xml(
    spark: SparkSession, path: str, row_tags: Sequence[str], schema: T.StructType | str | None = None
) -> DataFrame:
    """Rows are the elements with one of ``row_tags``: one scan per tag, united by column name."""
    scans = []
    for tag in row_tags:
        reader = spark.read.option("rowTag", tag)
        scans.append((reader.schema(schema) if schema else reader).xml(path))
    united = scans[0]
    for scan in scans[1:]:
        united = united.unionByName(scan, allowMissingColumns=True)
    return united


def avro_available(spark: SparkSession) -> bool:
    """Whether the spark-avro package is on the class path."""
    try:
        spark.read.format("avro").schema("a int").load([])
    except AnalysisException as error:
        return "avro" not in str(error).lower()
    return True


def read_avro(spark: SparkSession, path: str, avro_schema: str | None = None) -> DataFrame:
    """Avro files; ``avro_schema`` is the JSON text of a reader schema with nullable unions."""
    if not avro_available(spark):
        raise RuntimeError("reading Avro needs the spark-avro package on the class path")
    reader = spark.read.format("avro")
    return (reader.option("avroSchema", avro_schema) if avro_schema else reader).load(path)


def read_if_present(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame | None:
    """A CSV folder as strings (or declared types), or ``None`` when it is missing or has no rows."""
    try:
        df = read_csv_typed(spark, path, schema) if schema else read_csv_text(spark, path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return None if df.isEmpty() else df


def query_view(df: DataFrame, name: str, sql: str) -> DataFrame:
    """Register ``df`` under ``name`` and run a query over it."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.sql(sql)


def find(
    collection: DataFrame,
    equal: dict[str, object] | None = None,
    fields: Sequence[str] = (),
    sort: Sequence[tuple[str, bool]] = (),
) -> DataFrame:
    """Documents equal to a query on (dotted) fields, projected, ordered by (field, ascending) pairs.

    Asking for ``None`` finds documents where the field is null or absent.
    """
    for name, wanted in (equal or {}).items():
        collection = collection.filter(F.col(name).eqNullSafe(F.lit(wanted)))
    if sort:
        collection = collection.orderBy(*[F.col(n).asc() if up else F.col(n).desc() for n, up in sort])
    return collection.select(*fields) if fields else collection
