"""Input tables: filtered scans, the three inputs of a run, appends."""

from __future__ import annotations

import operator
from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_COMPARISONS = {"_gte": operator.ge, "_lte": operator.le, "_eq": operator.eq}


@dataclass(frozen=True)
class Table:
    """Where a table lives.  ``options`` go to the reader as they are.

    For a JDBC table give ``partitionColumn``, ``lowerBound``, ``upperBound`` and ``numPartitions``,
    so that the read is spread over executors.
    """

    path: str | None = None
    format: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)

    def read(self, spark: SparkSession) -> DataFrame:
        reader = spark.read.format(self.format).options(**self.options)
        return reader.load(self.path) if self.path else reader.load()


def scan(table: DataFrame, filters: Mapping[str, object] | None = None,
         order_by: str | None = None, descending: bool = False) -> DataFrame:
    """Rows that pass every filter.

    A key ending in ``_gte``, ``_lte`` or ``_eq`` names the comparison; a bare key means equality.
    Filters compare a column with a literal, so they reach the Parquet reader.  ``order_by`` is a
    global sort: leave it out unless the rows go to a reader that needs them in order.
    """
    for key, value in (filters or {}).items():
        for suffix, compare in _COMPARISONS.items():
            if key.endswith(suffix):
                table = table.where(compare(F.col(key.removesuffix(suffix)), F.lit(value)))
                break
        else:
            table = table.where(F.col(key) == F.lit(value))
    if order_by in table.columns:
        table = table.orderBy(F.desc(order_by) if descending else F.asc(order_by))
    return table


def sales_since(sales: DataFrame, start: date, day: str = "day") -> DataFrame:
    """Sales from ``start`` on, inclusive, with no upper bound."""
    return scan(sales, {f"{day}_gte": start})


def sales_profile(sales: DataFrame) -> DataFrame:
    """One row: sales records and the first and last day."""
    return sales.agg(F.count(F.lit(1)).alias("sales_rows"),
                     F.min("day").alias("first_day"), F.max("day").alias("last_day"))


def load_inputs(spark: SparkSession, sales: Table, products: Table, calendar: Table,
                history_start: date) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three input tables.  Reads one sales row to refuse an empty history."""
    sales_rows = sales_since(sales.read(spark), history_start)
    if sales_rows.isEmpty():
        raise ValueError(f"no sales on or after {history_start}")
    return sales_rows, products.read(spark), calendar.read(spark)


def append_table(rows: DataFrame, path: str) -> None:
    """Add rows to a Parquet table.  Runs a job."""
    rows.write.mode("append").parquet(path)
