"""Lifecycle features of a product-day table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.functions import categories as labels
from shelfcast.settings import Settings

ALL_ROWS = (Window.unboundedPreceding, Window.unboundedFollowing)


def product_rows(df: DataFrame) -> WindowSpec:
    """A product's rows by date.

    Every per-product window in the package uses this one specification, so that Spark shuffles and
    sorts the table once for all of them.
    """
    ties = ["id"] if "id" in df.columns else []
    return Window.partitionBy("product_id").orderBy("date", *ties)


def without_nan(df: DataFrame, name: str) -> Column:
    """The column with NaN, which sorts above any number and spoils sums, as null."""
    column = F.col(name)
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(column), column)
    return column


def sales_columns(sales: DataFrame) -> DataFrame:
    """Rename stored sales columns; NaN becomes null."""
    extra = [name for name in ("id", "shopify_product_id") if name in sales.columns]
    return sales.select(
        *extra, "product_id", F.col("day").cast("date").alias("date"),
        without_nan(sales, "units_sold").alias("sales_units"),
        without_nan(sales, "sales_amount").alias("sales_amount"))


def add_day_in_stock(sales: DataFrame) -> DataFrame:
    """Days since the product's first day with units, counting from 1; 0 if it never sold.

    Rows before the first sale get 0 on the last day before it and negative numbers earlier.
    """
    sold_on = F.when(F.col("sales_units") > 0, F.col("date"))
    first_sale = F.min(sold_on).over(product_rows(sales).rowsBetween(*ALL_ROWS))
    return sales.withColumn("day_in_stock", F.when(first_sale.isNull(), 0).otherwise(
        F.datediff("date", first_sale) + 1))


def add_recent_units(sales: DataFrame, settings: Settings) -> DataFrame:
    """Units over the last ``recent_rows`` rows, the current one included."""
    frame = product_rows(sales).rowsBetween(1 - settings.recent_rows, 0)
    return sales.withColumn("recent_sales_units", F.sum("sales_units").over(frame))


def add_cumulative_units(sales: DataFrame) -> DataFrame:
    frame = product_rows(sales).rowsBetween(Window.unboundedPreceding, 0)
    return sales.withColumn("cumulative_sales", F.sum("sales_units").over(frame))


def add_category_labels(sales: DataFrame, settings: Settings) -> DataFrame:
    """Age, sales, summarised and combined category from day in stock and recent units."""
    day, recent = F.col("day_in_stock"), F.col("recent_sales_units")
    labelled = sales.withColumns({
        "age_category": labels.age_category(day, settings.strict_draft),
        "sales_category": labels.sales_category(day, recent, settings.strict_draft)})
    labelled = labelled.withColumn(
        "summarized_sales_category", labels.summarized_sales_category(F.col("sales_category")))
    return labelled.withColumn("age_sales_category", labels.age_sales_category(
        F.col("age_category"), F.col("summarized_sales_category")))


def add_salary_period(sales: DataFrame, settings: Settings) -> DataFrame:
    return sales.withColumn("SALARY_PERIOD", labels.salary_period(
        F.col("date"), settings.salary_first_day, settings.salary_last_day))


def add_lifecycle(sales: DataFrame, settings: Settings) -> DataFrame:
    """Every lifecycle column.  One shuffle by product, one sort, three frames."""
    return (sales.transform(add_day_in_stock)
            .transform(add_recent_units, settings)
            .transform(add_cumulative_units)
            .transform(add_category_labels, settings)
            .transform(add_salary_period, settings))
