"""Data-quality checks. A check returns its failing rows: none means the data passed."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.dates import moment
from millrace.functions.text import contains_ignoring_case

PHONE_LENGTH = 12


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, *columns: str) -> DataFrame:
    """Repeated non-null keys with their number of rows."""
    return (
        df.dropna(subset=list(columns))
        .groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .filter("n_records > 1")
    )


def repeated_keys(df: DataFrame, column_sets: Sequence[Sequence[str]]) -> DataFrame:
    """Repeated non-null keys of several sets of columns in one scan and one shuffle: ``set_no``, ``key_values`` (as
    text) and ``n_records``.

    Every row brings one (set, key) pair for each set of which it has all columns. Pairs are grouped together, and
    counted inside each task before they move, so a key of many rows is a few rows on the way.
    """

    def written(column: str) -> Column:
        value = F.col(column)
        fraction = isinstance(df.schema[column].dataType, (T.FloatType, T.DoubleType))
        return (F.when(value == 0, F.lit(0.0)).otherwise(value) if fraction else value).cast("string")  # -0.0 is 0.0

    def pair(number: int, columns: Sequence[str]) -> Column:
        filled = reduce(Column.__and__, [F.col(c).isNotNull() for c in columns])
        values = F.array(*[written(c) for c in columns])
        return F.when(filled, F.struct(F.lit(number).alias("set_no"), values.alias("key_values")))

    pairs = F.array_compact(F.array(*[pair(number, columns) for number, columns in enumerate(column_sets)]))
    stacked = df.select(F.inline(pairs))
    return stacked.groupBy("set_no", "key_values").agg(F.count(F.lit(1)).alias("n_records")).filter("n_records > 1")


def accepted_values(df: DataFrame, column: str, values: Sequence[object]) -> DataFrame:
    """Rows whose non-null value is outside the list."""
    return df.filter(F.col(column).isNotNull() & ~F.col(column).isin(list(values)))


def relationships(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Child rows whose non-null key has no parent row."""
    keys = parent.select(F.col(field).alias(column)).dropna().distinct()
    return child.filter(F.col(column).isNotNull()).join(keys, column, "left_anti").select(*child.columns)


def orphan_keys(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Missing parent keys with their number of child rows; children are counted before the join."""
    counted = child.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))
    return relationships(counted, column, parent, field)


def not_after(df: DataFrame, ts: str, now: Column | None = None) -> DataFrame:
    """Rows stamped in the future."""
    return df.filter(F.col(ts) > (F.current_timestamp() if now is None else now))


def ordered(df: DataFrame, first: str, second: str) -> DataFrame:
    """Rows whose first timestamp is later than the second."""
    return df.filter(F.col(first) > F.col(second))


def has_at_sign(df: DataFrame, column: str) -> DataFrame:
    return df.filter(~contains_ignoring_case(F.col(column), "@"))


def has_length(df: DataFrame, column: str, length: int = PHONE_LENGTH) -> DataFrame:
    return df.filter(F.length(column) != length)


def freshness(
    df: DataFrame, ts: str, now: Column | None = None, warn_hours: int = 1, error_hours: int = 2
) -> DataFrame:
    """One row: newest timestamp, age in seconds, and pass, warn or error. No rows at all is an error."""
    now = F.current_timestamp() if now is None else now
    newest = df.agg(F.max(ts).alias("max_loaded_at"))
    age = F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col("max_loaded_at").cast("timestamp"))
    aged = newest.withColumn("age_seconds", F.floor(age / 1_000_000).cast("bigint"))
    late = F.col("age_seconds")
    return aged.withColumn(
        "status",
        F.when(late.isNull() | (late > error_hours * 3600), "error")
        .when(late > warn_hours * 3600, "warn")
        .otherwise("pass"),
    )


# The texts that count as booleans.
TRUE_TEXTS = ("1", "on", "t", "true", "y", "yes")
FALSE_TEXTS = ("0", "off", "f", "false", "n", "no")


@dataclass(frozen=True)
class Field:
    """One field of a validated record; a field with ``optional`` falls back to ``default``."""

    name: str
    type: str
    optional: bool = False
    default: object = None

    def value(self) -> Column:
        raw = F.col(self.name)
        if self.type == "boolean":
            text = F.lower(raw.cast("string"))
            read = F.when(text.isin(*TRUE_TEXTS), True).when(text.isin(*FALSE_TEXTS), False)
        else:
            read = raw.try_cast(self.type)
        return F.when(raw.isNull(), F.lit(self.default).cast(self.type)).otherwise(read) if self.optional else read

    def error(self) -> Column:
        raw = F.col(self.name)
        missing = F.lit(None) if self.optional else F.when(raw.isNull(), f"{self.name}: field required")
        return F.coalesce(missing, F.when(raw.isNotNull() & self.value().isNull(), f"{self.name}: not a {self.type}"))


def validate(df: DataFrame, fields: Sequence[Field]) -> DataFrame:
    """Typed fields plus ``errors``, the list of what is wrong with the record; nothing is dropped."""
    passed_through = [c for c in df.columns if c not in {f.name for f in fields}]
    return df.select(
        *passed_through,
        *[f.value().alias(f.name) for f in fields],
        F.array_compact(F.array(*[f.error() for f in fields])).alias("errors"),
    )


def valid(validated: DataFrame) -> DataFrame:
    return validated.filter(F.size("errors") == 0).drop("errors")


def rejected(validated: DataFrame) -> DataFrame:
    return validated.filter(F.size("errors") > 0)


@dataclass(frozen=True)
class Check:
    """A check of a suite. ``kind`` is not_null, unique, accepted_values, relationships, column_exists or
    column_type; any other row test is a SQL ``predicate`` that is true for failing rows."""

    table: str
    column: str
    kind: str
    values: tuple = ()
    parent: tuple[str, str] | None = None
    predicate: str | None = None

    def key(self) -> tuple[str, str, str]:
        return self.table, self.column, self.kind

    def row_test(self) -> Column | None:
        """The failing-row condition of checks that need no other row."""
        column = F.col(f"`{self.column}`")
        if self.predicate is not None:
            return F.expr(self.predicate)
        if self.kind == "not_null":
            return column.isNull()
        if self.kind == "accepted_values":
            return column.isNotNull() & ~column.isin(list(self.values))
        return None


def _result(check: Check, failures: Column) -> Column:
    return F.struct(
        F.lit(check.table).alias("table_name"),
        F.lit(check.column).alias("column_name"),
        F.lit(check.kind).alias("check_name"),
        F.coalesce(failures, F.lit(0)).cast("bigint").alias("failures"),
    )


KINDS = ("not_null", "unique", "accepted_values", "relationships", "column_exists", "column_type")


def _refuse_unknown(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> None:
    """Raise before anything is read: a check that cannot run must not look like one that passed."""
    unknown = [c.key() for c in checks if c.kind not in KINDS and c.predicate is None]
    absent = {c.table for c in checks} - set(tables)
    absent |= {c.parent[0] for c in checks if c.kind == "relationships" and c.parent and c.predicate is None} - set(tables)
    orphaned = [c.key() for c in checks if c.kind == "relationships" and not c.parent and c.predicate is None]
    if not checks:
        raise ValueError("no checks given")
    if unknown or absent or orphaned:
        raise ValueError(f"unknown kinds: {unknown}; tables not given: {sorted(absent)}; no parent: {orphaned}")


def _has_columns(check: Check, tables: Mapping[str, DataFrame]) -> bool:
    """Whether the columns that a check reads exist; a predicate is free SQL and finds its own."""
    if check.predicate is not None or check.kind in ("column_exists", "column_type"):
        return True
    here = check.column in tables[check.table].columns
    return here and (check.kind != "relationships" or check.parent[1] in tables[check.parent[0]].columns)


def _schema_failures(check: Check, schema: T.StructType) -> Column:
    types = {f.name: f.dataType.simpleString() for f in schema.fields}
    if check.kind == "column_exists":
        return F.lit(int(check.column not in types))
    return F.lit(int(types.get(check.column) not in check.values))


def run_suite(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """One row per check: failures and whether it passed.

    An unknown kind or a table that is not given raises. A check of an absent column has one failure. A
    suite without checks raises too. All row tests of a table share one scan and one aggregate; all uniqueness checks of a table share
    another; they and relationship checks aggregate by key first, so hot keys shrink before they move.
    """
    _refuse_unknown(tables, checks)
    parts = []
    for name, df in tables.items():
        known = [c for c in checks if c.table == name]
        mine = [c for c in known if _has_columns(c, tables)]
        columnless = [c for c in known if c not in mine]
        by_row = [c for c in mine if c.row_test() is not None]
        by_schema = [c for c in mine if c.kind in ("column_exists", "column_type") and c.predicate is None]
        if by_row or by_schema or columnless:
            counts = df.agg(
                F.count(F.lit(1)).alias("_rows"),
                *[F.count_if(c.row_test()).alias(f"_c{i}") for i, c in enumerate(by_row)],
            )
            results = [_result(c, F.col(f"_c{i}")) for i, c in enumerate(by_row)]
            results += [_result(c, _schema_failures(c, df.schema)) for c in by_schema]
            results += [_result(c, F.lit(1)) for c in columnless]
            parts.append(counts.select(F.inline(F.array(*results))))
        by_key = [c for c in mine if c.kind == "unique" and c.predicate is None]
        if by_key:
            repeated = repeated_keys(df, [[c.column] for c in by_key])
            counts = repeated.agg(*[F.count_if(F.col("set_no") == i).alias(f"_u{i}") for i in range(len(by_key))])
            parts.append(counts.select(F.inline(F.array(*[_result(c, F.col(f"_u{i}")) for i, c in enumerate(by_key)]))))
        for check in mine:
            if check.predicate is not None:
                continue
            if check.kind == "relationships":
                parent, field = check.parent
                missing = orphan_keys(df, check.column, tables[parent], field).agg(F.sum("n_records").alias("_n"))
                parts.append(missing.select(F.inline(F.array(_result(check, F.col("_n"))))))
    united = parts[0]
    for part in parts[1:]:
        united = united.unionByName(part)
    return united.withColumn("passed", F.col("failures") == 0)


def row_differences(model: DataFrame, expected: DataFrame) -> DataFrame:
    """Where a model of any size differs from the expected rows: each row with ``found`` and ``wanted``, how often it is
    there and how often it should be. Rows are counted, so a repeated row is a difference too; nulls are equal."""
    counted = model.withColumns({"_found": F.lit(1), "_wanted": F.lit(0)}).unionByName(
        expected.withColumns({"_found": F.lit(0), "_wanted": F.lit(1)})
    )
    sides = counted.groupBy(*model.columns).agg(F.sum("_found").alias("found"), F.sum("_wanted").alias("wanted"))
    return sides.filter(F.col("found") != F.col("wanted"))


def expect_rows(model: DataFrame, expected: DataFrame) -> None:
    """Unit test of a model: raise unless it gives exactly the expected rows."""
    from pyspark.testing import assertDataFrameEqual

    assertDataFrameEqual(model, expected)


def run_time(now: dt.datetime) -> Column:
    """A fixed run time, for repeatable checks."""
    return moment(now)
