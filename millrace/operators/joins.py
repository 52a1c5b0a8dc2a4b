"""Joins that stay even when one key holds much of a side."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def left_join_lines(left: DataFrame, lines: DataFrame, key: str, null_keys: bool = True) -> DataFrame:
    """Left join to a side that may hold very many rows of one key.

    Under a left join Spark can split a hot key on the left only. So every left key without lines gets
    one empty line first, and the join itself is an inner one, where either side can be split. Finding
    those keys reads the key columns alone, and keys combine inside each task before they move.
    ``null_keys=False`` promises that no left key is null, which lets the join reuse a partitioning.

    The price is a second read of the lines' keys. Where only sums per item are wanted, ``sums_over_lines`` reads the
    lines once.
    """
    known = lines.filter(F.col(key).isNotNull())
    missing = left.select(key).distinct().join(known.select(key).distinct(), key, "left_anti")
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in lines.schema.fields if f.name != key]
    filled = known.unionByName(missing.select(key, *empty)).withColumnRenamed(key, "_line_key")
    same = left[key].eqNullSafe(filled["_line_key"]) if null_keys else left[key] == filled["_line_key"]
    return left.join(filled, same).drop("_line_key")


def sums_over_lines(left: DataFrame, lines: DataFrame, key: str, item: str, weight: str) -> DataFrame:
    """``item`` and the sum of ``weight`` over the rows that a left join of ``left`` to ``lines`` by ``key`` would give.

    A key without lines, or null, counts once under a null item. Lines shrink to one row per (key, item) and the left
    side to one per key before they move; both then meet in one window per key, so the lines are read once, and a hot
    key is no more rows than it has different items.
    """
    known = lines.filter(F.col(key).isNotNull())
    pairs = known.groupBy(key, item).agg(F.count(F.lit(1)).alias("_n")).withColumn(weight, F.lit(None).cast("bigint"))
    heads = left.groupBy(key).agg(F.sum(weight).alias(weight))
    heads = heads.select(key, F.lit(None).cast(lines.schema[item].dataType).alias(item), F.lit(None).cast("bigint").alias("_n"), weight)
    of_key = Window.partitionBy(key)
    met = pairs.unionByName(heads).withColumns(
        {"_weight": F.sum(weight).over(of_key), "_pairs": F.count("_n").over(of_key)}
    )
    counts = (F.col("_n").isNotNull() & F.col("_weight").isNotNull()) | (F.col("_n").isNull() & (F.col("_pairs") == 0))
    return met.where(counts).groupBy(item).agg(F.sum(F.col("_weight") * F.coalesce("_n", F.lit(1))).alias(weight))
