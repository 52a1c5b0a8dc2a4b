"""Which days of a range a daily load has to run for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MODES = ("missing", "missing_and_failed", "all")


def days_between(start: Column, end: Column, bounds: DataFrame) -> DataFrame:
    """One row per day from ``start`` to ``end``, both columns of the one-row frame ``bounds``."""
    return bounds.select(F.explode(F.sequence(start, end)).alias("day"))


def plan_days(days: DataFrame, run_log: DataFrame, mode: str = "missing") -> DataFrame:
    """Days to (re)run. ``run_log`` has ``day`` and ``status`` (success or failed), possibly many runs
    a day; a day counts as done when any run succeeded, as run when it has any entry."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    if mode == "all":
        return days
    done = run_log if mode == "missing" else run_log.filter(F.col("status") == "success")
    return days.join(done.select("day").distinct(), "day", "left_anti")
