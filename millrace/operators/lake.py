"""Lake tables on plain Parquet: day-partitioned generations of files, keyed rows, one record per change.

Open-format jars (with MERGE and DELETE) are not assumed. A change writes a new generation folder with the whole content
of the days it rewrites, or with the rows it adds to a day, and then one small log record that names the generations of
every day. That record is the commit: until it is there nothing of the change can be seen, and old generations stay, so
earlier versions can be read and frames taken before a change stay valid. One writer at a time.

Layout: ``<root>/data/generation=<g>/<day>=.../`` holds rows, ``<root>/files/generation=<g>/`` the rows, smallest and
greatest key of each file, ``<root>/log/<version>.json`` the records. Filters on the timestamp prune days; keys are
looked up only in files whose range of keys they are in.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.dates import moment
from millrace.operators.day_range import Days, implied_days
from millrace.schemas import CREATED_DAY
from millrace.session import file_names, remove_folder, steps, write_record
from millrace.sinks.tables import with_day

LOG = "version bigint, operation string, committed_at timestamp, days bigint, table_schema string"
FOLDERS = f"folders array<struct<{CREATED_DAY}: date, generation: string>>"
STORED = "stored_as"
MOST_RANGES = 64  # ranges of keys that are looked up; more are joined to the one before

Folders = dict[dt.date, tuple[str, ...]]  # the generations that hold rows of a day
KeyRanges = list[tuple[tuple, tuple]]  # smallest and greatest key


class ConstraintError(ValueError):
    """Rows violate the table's required fields or its key."""


class LakeTable:
    """A keyed table partitioned by the day of one timestamp. Required fields are the non-nullable ones.

    The object remembers the version it last saw: another process's change shows after opening the table again.
    With ``version`` it is that version, which can be read only.
    """

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], ts: str, version: int | None = None):
        self.spark, self.root, self.keys, self.ts = spark, root.rstrip("/"), tuple(keys), ts
        self.data, self.files, self.log = (f"{self.root}/{part}" for part in ("data", "files", "log"))
        self.pinned = version is not None
        self.version, self.schema, self.folders = self._record(version)

    # -- definition -----------------------------------------------------------------------------

    @classmethod
    def create(
        cls, spark: SparkSession, root: str, schema: T.StructType, keys: Sequence[str], ts: str
    ) -> LakeTable:
        """Open the table at ``root``, creating it with ``schema`` when absent."""
        table = cls(spark, root, keys, ts)
        if table.schema is None:
            table._commit("create", 0, {}, schema)
        return table

    def at(self, version: int) -> LakeTable:
        """An earlier version, to be read."""
        return LakeTable(self.spark, self.root, self.keys, self.ts, version)

    def history(self) -> DataFrame:
        """Committed changes, oldest first."""
        return self.spark.read.schema(LOG).json(self.log).orderBy("version")

    def expire(self, keep: int = 1) -> None:
        """Remove all versions but the newest ``keep``, and the generations that no version left names."""
        versions = sorted(self._versions())
        old, left = versions[:-keep], versions[-keep:]
        named = {g for version in left for day in self._record(version)[2].values() for g in day}
        for version in old:
            remove_folder(self.spark, f"{self.log}/{_record_name(version)}")
        for folder in (self.data, self.files):
            for name in file_names(self.spark, folder):
                if name.removeprefix("generation=") not in named:
                    remove_folder(self.spark, f"{folder}/{name}")

    def _versions(self) -> list[int]:
        names = file_names(self.spark, self.log)
        return [int(name.removesuffix(".json")) for name in names if name[:1].isdigit() and name.endswith(".json")]

    def _record(self, version: int | None = None) -> tuple[int, T.StructType | None, Folders]:
        versions = self._versions()
        if version is None and not versions:
            return -1, None, {}
        if version is not None and version not in versions:
            raise ValueError(f"no version {version}; there are {sorted(versions)}")
        version = max(versions) if version is None else version
        record = self.spark.read.schema(f"{LOG}, {FOLDERS}").json(f"{self.log}/{_record_name(version)}").first()
        folders: Folders = {}
        for day, generation in record["folders"]:
            folders[day] = (*folders.get(day, ()), generation)
        return version, T.StructType.fromJson(json.loads(record["table_schema"])), folders

    def _commit(self, operation: str, days: int, folders: Folders, schema: T.StructType | None = None) -> None:
        if self.pinned:
            raise ValueError(f"version {self.version} can only be read")
        schema = schema or self.schema
        record = {
            "version": self.version + 1,
            "operation": operation,
            "committed_at": dt.datetime.now(dt.timezone.utc).isoformat(),
            "days": days,
            "table_schema": schema.json(),
            "folders": [{CREATED_DAY: str(day), "generation": g} for day in sorted(folders) for g in folders[day]],
        }
        write_record(self.spark, self.log, _record_name(self.version + 1), json.dumps(record))
        self.version, self.schema, self.folders = self.version + 1, schema, folders

    # -- reading --------------------------------------------------------------------------------

    def scan(self, where: Column | str | None = None, columns: Sequence[str] = ()) -> DataFrame:
        """Rows, filtered and projected; both reach the Parquet scan, and so do the days that the filter implies."""
        rows = self._stored() if where is None else self._days_of(where)[0].filter(where)
        return rows.select(*columns) if columns else rows.drop(CREATED_DAY)

    def scan_between(self, start: dt.datetime, end: dt.datetime, columns: Sequence[str] = ()) -> DataFrame:
        """Rows with ``start <= ts < end``."""
        return self.scan((F.col(self.ts) >= moment(start)) & (F.col(self.ts) < moment(end)), columns)

    def partitions(self) -> DataFrame:
        """Rows and files per day, from what is known of the files."""
        return self._known_files().groupBy(CREATED_DAY).agg(
            F.sum("rows").alias("record_count"), F.count(F.lit(1)).alias("file_count")
        )

    def _known_files(self) -> DataFrame:
        """Rows and range of keys of every current file."""
        generations = sorted({g for day in self.folders.values() for g in day})
        kinds = ", ".join(f"{k}: {self.schema[k].dataType.simpleString()}" for k in self.keys)
        schema = f"{CREATED_DAY} date, file string, rows bigint, low struct<{kinds}>, high struct<{kinds}>, generation string"
        if not generations:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", self.files)
        known = reader.parquet(*[f"{self.files}/generation={g}" for g in generations])
        pairs = [(day, g) for day, held in self.folders.items() for g in held]
        current = self.spark.createDataFrame(pairs, f"{CREATED_DAY} date, generation string")
        return known.join(current, [CREATED_DAY, "generation"], "left_semi")

    def _stored(self, days: Iterable[dt.date] | None = None) -> DataFrame:
        """All rows of the days (all of them unless given) under their current names, with the day column."""
        wanted = self.folders if days is None else sorted(set(days) & set(self.folders))
        return self._rows([f"{self.data}/generation={g}/{CREATED_DAY}={day}" for day in wanted for g in self.folders[day]])

    def _rows(self, paths: Sequence[str]) -> DataFrame:
        """Rows of some of the table's files; fields added later read as null."""
        on_disk = T.StructType(
            [T.StructField(f.metadata.get(STORED, f.name), f.dataType) for f in self.schema.fields]
        ).add(CREATED_DAY, "date")
        if paths:
            rows = self.spark.read.schema(on_disk).option("basePath", self.data).parquet(*paths)
        else:
            rows = self.spark.createDataFrame([], on_disk)
        return rows.select(
            *[F.col(f.metadata.get(STORED, f.name)).alias(f.name) for f in self.schema.fields], CREATED_DAY
        )

    def _days_of(self, where: Column | str) -> tuple[DataFrame, Days]:
        """Stored rows of the days that ``where`` can match, and their range."""
        days = implied_days(self._rows([next(iter(self._paths()))]) if self.folders else self._stored(), where, self.ts)
        rows = self._stored(day for day in self.folders if days.has(day))
        if days.first:
            rows = rows.filter(F.col(CREATED_DAY) >= F.lit(days.first))
        if days.last:
            rows = rows.filter(F.col(CREATED_DAY) <= F.lit(days.last))
        return rows, days

    def _paths(self) -> Iterable[str]:
        return (f"{self.data}/generation={g}/{CREATED_DAY}={day}" for day in self.folders for g in self.folders[day])

    # -- looking keys up ------------------------------------------------------------------------

    def _holding(self, ranges: KeyRanges) -> list[str]:
        """Files whose range of keys meets one of the given ranges."""
        if not ranges or not self.folders:
            return []
        kinds = [self.schema[k].dataType for k in self.keys]

        def bound(values: tuple) -> Column:
            return F.struct(*[F.lit(value).cast(kind).alias(k) for k, value, kind in zip(self.keys, values, kinds)])

        meets = reduce(Column.__or__, [(F.col("low") <= bound(high)) & (F.col("high") >= bound(low)) for low, high in ranges])
        found = self._known_files().filter(meets).select(CREATED_DAY, "generation", "file").collect()
        return [f"{self.data}/generation={r['generation']}/{CREATED_DAY}={r[CREATED_DAY]}/{r['file']}" for r in found]

    def _stored_keys(self, rows: DataFrame, ranges: KeyRanges, other: Column | None = None) -> DataFrame | None:
        """Day of each stored row that has a key of the given rows; only files that can hold one are read, and it is
        None where no file can. ``other`` leaves out stored rows for which it is true."""
        files, keys = self._holding(ranges), list(self.keys)
        if not files:
            return None
        stored = self._rows(files) if other is None else self._rows(files).filter(~other)
        return stored.select(*keys, CREATED_DAY).join(rows.select(*keys), keys, "left_semi")

    # -- changing -------------------------------------------------------------------------------

    def append(self, rows: DataFrame) -> None:
        """Add rows. A null in a required field, a key given twice or a key that the table has already stops
        the load before anything is added. Old files are opened only where their keys meet the given ones."""
        with steps(self.spark) as keep:
            rows, ranges = self._checked(rows, keep)
            self._refuse(self._stored_keys(rows, ranges))
            self._change("append", rows, [], counted=False)

    def upsert(self, rows: DataFrame) -> None:
        """Replace rows with the same key, insert the others. Rows equal to the stored ones change nothing, so
        running the same upsert again writes nothing. Days that only gain rows are not rewritten."""
        with steps(self.spark) as keep:
            (rows, ranges), keys = self._checked(rows, keep), list(self.keys)
            nearby = self._stored(self._distinct_days(self._stored_keys(rows, ranges)))
            same = [F.col(f"n.{c}").eqNullSafe(F.col(f"o.{c}")) for c in rows.columns if c not in keys]
            same += [F.col(f"n.{k}") == F.col(f"o.{k}") for k in keys]
            changed = keep(rows.alias("n").join(nearby.alias("o"), reduce(Column.__and__, same), "left_anti"))
            replaced = nearby.select(*keys, CREATED_DAY).join(changed.select(*keys), keys, "left_semi")
            left = self._distinct_days(replaced)
            kept = self._stored(left).join(changed.select(*keys), keys, "left_anti")
            self._change("upsert", kept.select(*rows.columns).unionByName(changed), left)

    def overwrite(self, rows: DataFrame, where: Column | str) -> None:
        """Delete the rows matching ``where`` and add ``rows``. A key of a stored row that stays is refused."""
        with steps(self.spark) as keep:
            (rows, ranges), match = self._checked(rows, keep), self._match(where)
            self._refuse(self._stored_keys(rows, ranges, other=match))
            left = self._distinct_days(self._days_of(where)[0].filter(match))
            kept = self._stored(left).filter(~match).select(*rows.columns)
            self._change("overwrite", kept.unionByName(rows), left)

    def update(self, where: Column | str, values: Mapping[str, Column]) -> None:
        """Set columns of the rows matching ``where``. Keys and the day's timestamp stay as they are."""
        if fixed := {self.ts, *self.keys} & set(values):
            raise ValueError(f"update cannot move rows between keys or days: {sorted(fixed)}")
        match, schema = self._match(where), self.schema
        days = self._distinct_days(self._days_of(where)[0].filter(match))
        changed = self._stored(days).withColumns(
            {c: F.when(match, v.cast(schema[c].dataType)).otherwise(F.col(c)) for c, v in values.items()}
        )
        self._change("update", changed.drop(CREATED_DAY), days)

    def delete(self, where: Column | str) -> None:
        """Delete the rows for which ``where`` is true."""
        match = self._match(where)
        days = self._distinct_days(self._days_of(where)[0].filter(match))
        self._change("delete", self._stored(days).filter(~match).drop(CREATED_DAY), days)

    def add_column(self, name: str, type_: str) -> None:
        """Add a nullable column; no file is touched. A name used before gets fresh storage, so the
        values of a dropped column never come back."""
        schema = self.schema
        if name in schema.names:
            raise ValueError(f"column {name} exists")
        kind = T.StructType.fromDDL(f"c {type_}")["c"].dataType
        field = T.StructField(name, kind, True, {STORED: f"{name}__{self.version + 1}"})
        self._commit("add_column", 0, self.folders, T.StructType([*schema.fields, field]))

    def drop_column(self, name: str) -> None:
        """Drop a column from the schema; no file is touched."""
        if name == self.ts or name in self.keys:
            raise ValueError(f"column {name} identifies or places rows")
        schema = T.StructType([f for f in self.schema.fields if f.name != name])
        self._commit("drop_column", 0, self.folders, schema)

    # -- helpers --------------------------------------------------------------------------------

    @staticmethod
    def _match(where: Column | str) -> Column:
        condition = F.expr(where) if isinstance(where, str) else where
        return F.coalesce(condition, F.lit(False))

    def _required(self) -> list[str]:
        return [f.name for f in self.schema.fields if not f.nullable or f.name in self.keys or f.name == self.ts]

    def _conformed(self, rows: DataFrame) -> DataFrame:
        """The table's columns in order and type; absent ones are null."""
        return rows.select(
            [
                (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in self.schema.fields
            ]
        )

    def _checked(self, rows: DataFrame, keep: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, KeyRanges]:
        """Conformed rows, kept as a step, and ranges that hold their keys; raises unless required fields are filled
        and keys unique. Keys mostly grow with time, so there is a range for every day, joined where they meet."""
        rows, required = keep(self._conformed(rows)), self._required()
        per_key = with_day(rows, self.ts, CREATED_DAY).groupBy(*self.keys).agg(
            F.count(F.lit(1)).alias("_n"),
            F.min(CREATED_DAY).alias("_day"),
            *[F.count_if(F.col(c).isNull()).alias(f"_{c}") for c in required],
        )
        key = F.struct(*self.keys)
        found = per_key.groupBy("_day").agg(
            F.max("_n").alias("_n"), F.min(key).alias("_low"), F.max(key).alias("_high"),
            *[F.sum(f"_{c}").alias(c) for c in required],
        ).collect()
        empty = {c: n for c in required if (n := sum(day[c] for day in found))}
        if empty:
            raise ConstraintError(f"required fields are null: {empty}")
        if any(day["_n"] > 1 for day in found):
            raise ConstraintError(f"key {self.keys} is not unique in the given rows")
        return rows, joined_ranges([(tuple(day["_low"]), tuple(day["_high"])) for day in found])

    def _refuse(self, repeated: DataFrame | None) -> None:
        if repeated is not None and not repeated.isEmpty():
            raise ConstraintError(f"key {self.keys} of a given row is in the table already")

    @staticmethod
    def _distinct_days(rows: DataFrame | None) -> list[dt.date]:
        """Days of the rows; bounded by the calendar, not by the rows."""
        return [] if rows is None else [row[0] for row in rows.select(CREATED_DAY).distinct().collect()]

    def _change(self, operation: str, rows: DataFrame, rewritten: Sequence[dt.date], counted: bool = True) -> None:
        """Commit ``rows`` as the whole content of the days ``rewritten``, and as added rows of all their other days."""
        if self.pinned:
            raise ValueError(f"version {self.version} can only be read")
        generation = uuid.uuid4().hex
        days = self._write(rows, generation)
        folders = {day: held for day, held in self.folders.items() if day not in set(rewritten)}
        folders |= {day: (*folders.get(day, ()), generation) for day in days}
        self._commit(operation, len({*days, *rewritten}) if counted else 0, folders)

    def _write(self, rows: DataFrame, generation: str) -> list[dt.date]:
        """Rows as a generation, with what is known of its files. Nothing names it yet."""
        stored_names = {f.name: f.metadata[STORED] for f in self.schema.fields if STORED in f.metadata}
        path = f"{self.data}/generation={generation}"
        placed = with_day(rows, self.ts, CREATED_DAY).withColumnsRenamed(stored_names)
        placed.hint("rebalance", CREATED_DAY).write.partitionBy(CREATED_DAY).parquet(path)
        keys = T.StructType([self.schema[k] for k in self.keys]).add(CREATED_DAY, "date")
        written, key = self.spark.read.schema(keys).parquet(path), F.struct(*self.keys)
        per_file = written.groupBy(CREATED_DAY, F.col("_metadata.file_name").alias("file"))
        known = per_file.agg(F.count(F.lit(1)).alias("rows"), F.min(key).alias("low"), F.max(key).alias("high"))
        known.write.parquet(f"{self.files}/generation={generation}")
        files = self.spark.read.schema(f"{CREATED_DAY} date").parquet(f"{self.files}/generation={generation}")
        return self._distinct_days(files)


def joined_ranges(ranges: KeyRanges, most: int = MOST_RANGES) -> KeyRanges:
    """At most so many ranges that cover the given ones; those that meet become one."""
    apart: KeyRanges = []
    for low, high in sorted(ranges):
        if apart and low <= apart[-1][1]:
            apart[-1] = apart[-1][0], max(high, apart[-1][1])
        else:
            apart.append((low, high))
    step = -(-len(apart) // most) or 1
    return [(apart[k][0], apart[min(k + step, len(apart)) - 1][1]) for k in range(0, len(apart), step)]


def _record_name(version: int) -> str:
    return f"{version:012}.json"
