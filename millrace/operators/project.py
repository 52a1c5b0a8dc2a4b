"""Projections, bounded fetches and ordered picks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.dates import in_range, month_bounds

MAX_FETCH = 100


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename some columns, keep all, keep their order."""
    return df.withColumnsRenamed(dict(names))


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def month_and_state(df: DataFrame, ts: str, year: int, month: int, state: str, state_column: str) -> DataFrame:
    """Rows of one month in one state; the month is a range on the bare timestamp."""
    return df.filter(in_range(F.col(ts), month_bounds(year, month)) & (F.col(state_column) == state))


def newer_than_days(df: DataFrame, ts: str, days: int, now: Column | None = None) -> DataFrame:
    """Rows of the last ``days`` days before ``now`` (the current time unless given)."""
    now = F.current_timestamp() if now is None else now
    return df.filter(F.col(ts) > now - F.expr(f"INTERVAL {int(days)} DAYS"))


def bounded_fetch(df: DataFrame, n: int, order: Sequence[str | Column]) -> DataFrame:
    """At most ``n`` rows, ``n`` held between 1 and 100, in a total order so that reruns agree."""
    return df.orderBy(*order).limit(max(1, min(int(n), MAX_FETCH)))


def top_by_count(df: DataFrame, key: str, k: int, weight: str | None = None) -> DataFrame:
    """The ``k`` most frequent values of ``key``; equal counts are ordered by the value itself.

    ``weight`` sums an existing count column instead of counting rows.
    """
    counted = df.groupBy(key).agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("record_count"))
    return counted.orderBy(F.desc("record_count"), F.asc_nulls_last(key)).limit(k)


def top_per_group(df: DataFrame, group: str, order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows of every group with their ``rank``.

    Spark limits each group inside every task before the shuffle, so a hot group moves ``k`` rows a task.
    """
    window = Window.partitionBy(group).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= k)


def joined_text(df: DataFrame, text: str, separator: str, rank: str = "rank", groups: Sequence[str] = ()) -> DataFrame:
    """Texts of a group joined in rank order, for groups already cut to their top rows."""
    pairs = F.array_sort(F.collect_list(F.struct(rank, text)))
    joined = F.concat_ws(separator, F.transform(pairs, lambda pair: pair[text]))
    return df.groupBy(*groups).agg(joined.alias(text))


def side_by_side(*totals: DataFrame) -> DataFrame:
    """One row out of several one-row frames with different columns: united and folded, not cross joined."""
    united = totals[0]
    for total in totals[1:]:
        united = united.unionByName(total, allowMissingColumns=True)
    return united.agg(*[F.max(c).alias(c) for c in united.columns])
