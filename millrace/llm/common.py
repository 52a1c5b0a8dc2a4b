"""Reading, scratch tables and fresh column names shared by the operators."""

from __future__ import annotations

import sys
import uuid
from itertools import count
from types import TracebackType

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

from millrace.session import remove_folder, scratch, shared_folder

BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """A table of the given folder, by a path that only Spark needs to understand."""
    return spark.read.parquet(f"{folder}/{table}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` has it."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def position(df: DataFrame, name: str) -> int:
    """Where ``df`` has the column ``name``: spelled like that, or else the first that differs in letter case only."""
    same = [k for k, column in enumerate(df.columns) if column == name]
    same += [k for k, column in enumerate(df.columns) if column.lower() == name.lower()]
    if not same:
        raise ValueError(f"no column {name} among {df.columns}")
    return same[0]


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """The given columns under new names. They are taken by position, so other columns may have any names."""
    places = {new: position(df, name) for new, name in columns.items()}
    numbered = df.toDF(*[f"_{k}" for k in range(len(df.columns))])
    return numbered.select(*[numbered[f"_{k}"].alias(new) for new, k in places.items()])


def ship(module: str) -> None:
    """Let functions of a module travel inside the tasks, so that executors need no copy of this package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def _results(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/millrace/results-{spark.sparkContext.applicationId}"


def remove_results(spark: SparkSession) -> None:
    """Delete what the operators returned to this application; frames over it can be read no longer."""
    remove_folder(spark, _results(spark))


class Workspace:
    """Tables that one job writes to the shared folder: they survive lost executors and cut the lineage.

    Leaving the ``with`` block removes all of them but the one given to ``result``, which belongs to the caller (see
    ``remove_results``). ``batch_rows`` is how many rows the job hands to Python at once: whole texts or sets are
    large, and several tasks of an executor hold a batch each, on both sides.
    """

    def __init__(self, spark: SparkSession, label: str, batch_rows: int | None = None):
        self.spark, self.folder, self.numbers, self.label = spark, scratch(spark, label), count(), label
        self.batch_rows, self.before = batch_rows, None

    def __enter__(self) -> Workspace:
        if self.batch_rows:
            self.before = self.spark.conf.get(BATCH_ROWS)
            self.spark.conf.set(BATCH_ROWS, min(int(self.before), self.batch_rows) if int(self.before) > 0 else self.batch_rows)
        return self

    def __exit__(self, kind: type | None, error: BaseException | None, trace: TracebackType | None) -> None:
        if self.before is not None:
            self.spark.conf.set(BATCH_ROWS, self.before)
        remove_folder(self.spark, self.folder)

    def keep(self, df: DataFrame) -> DataFrame:
        return self._stored(df, f"{self.folder}/{next(self.numbers)}")

    def result(self, df: DataFrame) -> DataFrame:
        return self._stored(df, f"{_results(self.spark)}/{self.label}-{uuid.uuid4().hex}")

    def _stored(self, df: DataFrame, path: str) -> DataFrame:
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)
