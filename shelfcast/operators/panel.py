"""From sales facts to one row per product and day."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.operators.lifecycle import without_nan

EARLIEST = "0001-01-01"


def daily_sales(facts: DataFrame) -> DataFrame:
    """Sum ``units_sold`` and ``sales_amount`` to one row per product and day; keep the least of its ids.

    The sums are pre-aggregated before the shuffle, and the shuffle is on product *and* day, so a
    product that holds a third of all facts is spread over many tasks.  After it every product has at
    most one row per calendar day, which bounds each window partition built later.
    """
    kept = [F.min(name).alias(name) for name in ("id", "shopify_product_id") if name in facts.columns]
    sums = [F.sum(without_nan(facts, name)).alias(name) for name in ("units_sold", "sales_amount")]
    return facts.groupBy("product_id", "day").agg(*kept, *sums)


def day_range(daily: DataFrame) -> tuple[Column, Column]:
    """First and last day as scalar subqueries over the day column alone."""
    return (daily.agg(F.min("day")).scalar(), daily.agg(F.max("day")).scalar())


def densify(daily: DataFrame, first: date | Column, last: date | Column,
            products: DataFrame | None = None) -> DataFrame:
    """One row per product and day from ``first`` to ``last``, missing days with zero units.

    Row windows and look-back by rows are only right on such a panel.  Products are all of ``daily``,
    those whose rows lie outside the range too, and those of ``products`` (``product_id``), sold or not.
    Each row brings the zero rows up to the product's next one, and the product's first row those from the start of the range as well.
    So no product-by-date spine is built or joined, and the rows stay partitioned by product.
    """
    first = F.lit(first) if isinstance(first, date) else first
    last = F.lit(last) if isinstance(last, date) else last
    rows = daily.select("product_id", "day", "units_sold", "sales_amount")
    if products is not None:
        rows = rows.unionByName(products.select("product_id").distinct(), allowMissingColumns=True)
    # A row without a day stands before all others.
    placed = rows.withColumn("place", F.coalesce("day", F.lit(EARLIEST).cast("date")))
    product = Window.partitionBy("product_id").orderBy("place")
    marked = placed.withColumns({"position": F.row_number().over(product), "next": F.lead("place").over(product)})
    begin = F.when(F.col("position") == 1, first).otherwise(F.greatest("place", first))
    until = F.least(F.coalesce(F.date_sub("next", 1), last), last)
    filled = marked.withColumn("calendar_day", F.explode(
        F.when(begin <= until, F.sequence(begin, until)).otherwise(F.array().cast("array<date>"))))
    sold = F.coalesce(F.col("calendar_day") == F.col("day"), F.lit(False))
    return filled.select(
        "product_id", F.col("calendar_day").alias("day"),
        F.when(sold, F.col("units_sold")).otherwise(0).alias("units_sold"),
        F.when(sold, F.col("sales_amount")).otherwise(0.0).alias("sales_amount"))


def density_check(daily: DataFrame) -> DataFrame:
    """Products whose rows do not cover every day between their first and last row exactly once."""
    per_product = daily.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("day_rows"),
        (F.datediff(F.max("day"), F.min("day")) + 1).cast("long").alias("calendar_days"))
    return per_product.where(F.col("day_rows") != F.col("calendar_days"))
