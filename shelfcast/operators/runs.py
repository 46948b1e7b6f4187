"""Choosing among numbered forecast runs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_runs(runs: Sequence[DataFrame]) -> DataFrame:
    """All runs in one table, columns matched by name, absent ones null."""
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), runs)


def run_summary(runs: DataFrame) -> DataFrame:
    """One row per run, ascending: rows and date span."""
    return runs.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("forecast_rows"), F.min("date").alias("first_date"),
        F.max("date").alias("last_date")).orderBy("run_id")


def next_run_id(runs: DataFrame) -> DataFrame:
    """One row: the highest run number plus one, or 1 when there is none."""
    return runs.agg((F.coalesce(F.max("run_id"), F.lit(0)) + 1).cast("int").alias("next_run_id"))


def winners(dates: DataFrame) -> DataFrame:
    """For each date, the highest run number that has it."""
    return dates.groupBy("date").agg(F.max("run_id").alias("run_id"))


def latest_run_per_date(runs: DataFrame) -> DataFrame:
    """For each date, the rows of the highest-numbered run that has that date.

    The choice is made per date, not per product: a product absent from that run has no row on that
    date.  A window over the date would put each day's whole forecast into one task, so the winners
    are aggregated first.  They hold one date and one integer per calendar date, about 3.7 million
    at most over Spark's date range and a few hundred in practice, whatever the product count;
    that bound is what allows the broadcast.
    """
    return runs.join(F.broadcast(winners(runs)), ["date", "run_id"], "left_semi")
