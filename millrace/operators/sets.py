"""Set operations between two versions of a table.

Every comparison is one union and one grouped aggregate: rows combine inside each task before the only
shuffle, so a row repeated a billion times travels once per task, and nulls compare as equal.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STATUS = "status"


def _sides(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    both = left.select(*columns, F.lit(True).alias("_left"), F.lit(False).alias("_right")).unionByName(
        right.select(*columns, F.lit(False).alias("_left"), F.lit(True).alias("_right"))
    )
    return both.groupBy(*columns).agg(F.bool_or("_left").alias("_left"), F.bool_or("_right").alias("_right"))


def except_rows(source: DataFrame, destination: DataFrame) -> DataFrame:
    """Distinct rows of ``source`` that ``destination`` lacks."""
    columns = source.columns
    return _sides(source, destination, columns).filter(F.col("_left") & ~F.col("_right")).select(*columns)


def two_way_difference(before: DataFrame, after: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values of ``columns`` found on one side only, with status ``added`` or ``removed``."""
    changed = _sides(before, after, columns).filter(F.col("_left") != F.col("_right"))
    return changed.select(*columns, F.when(F.col("_left"), "removed").otherwise("added").alias(STATUS))


def union_all(*frames: DataFrame) -> DataFrame:
    """All rows of all frames, columns matched by name."""
    united = frames[0]
    for frame in frames[1:]:
        united = united.unionByName(frame)
    return united


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()


def count_distinct_tuples(df: DataFrame, columns: Sequence[str], name: str = "distinct_count") -> DataFrame:
    """Exact number of distinct combinations of ``columns``, combinations with nulls included."""
    return df.agg(F.count_distinct(F.struct(*columns)).alias(name))
