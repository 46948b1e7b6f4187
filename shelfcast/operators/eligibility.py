"""Which products get a forecast, judged by their categories on the history end date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.accuracy import percent
from shelfcast.operators.lifecycle import ALL_ROWS, product_rows
from shelfcast.settings import Settings

# Column names.
HISTORY_COLUMNS = ("product_id", "date", "sales_units", "age_category", "sales_category",
                   "age_sales_category", "style")
# Column names.
SNAPSHOT_COLUMNS = ("age_sales_category", "sales_category", "age_category", "style")


def history_cut(features: DataFrame, settings: Settings, extra: tuple[str, ...] = ()) -> DataFrame:
    """The columns a forecast needs, up to the history end date."""
    return features.select(*HISTORY_COLUMNS, *extra).where(
        F.col("date") <= F.lit(settings.history_end))


def is_non_eligible(settings: Settings) -> Column:
    return F.coalesce(
        F.col("age_category").isin(*settings.non_eligible_ages)
        | F.col("sales_category").isin(*settings.non_eligible_sales), F.lit(False))


def non_eligible_products(history: DataFrame, settings: Settings) -> DataFrame:
    """Products in an excluded category on the end date."""
    return history.where((F.col("date") == F.lit(settings.history_end)) & is_non_eligible(settings)
                         ).select("product_id").distinct()


def _with_end_date(history: DataFrame, settings: Settings) -> DataFrame:
    """Add each product's end-date verdict and snapshot to all of its rows.

    The verdict is a window over the product's own rows, in the order the lifecycle windows use.  An
    anti join and an inner join with the end-date rows would give the same answer for two more
    shuffles of the history and a second evaluation of the features.
    """
    on_end = F.col("date") == F.lit(settings.history_end)
    whole = product_rows(history).rowsBetween(*ALL_ROWS)
    return history.withColumns({
        "excluded": F.coalesce(
            F.max(F.when(on_end, is_non_eligible(settings))).over(whole), F.lit(False)),
        "snapshot": F.max(F.when(on_end, F.struct(*SNAPSHOT_COLUMNS))).over(whole)})


def eligible_history(history: DataFrame, settings: Settings) -> DataFrame:
    """History without the excluded products; a product with no end-date row stays."""
    return _with_end_date(history, settings).where(~F.col("excluded")).drop("excluded", "snapshot")


def qualified_history(history: DataFrame, settings: Settings) -> DataFrame:
    """Eligible history with the product's end-date categories as ``on_forecast_*`` columns.

    A product with no row on the end date drops out.  ``style`` is the end-date style, once.
    """
    kept = _with_end_date(history, settings).where(
        ~F.col("excluded") & F.col("snapshot").isNotNull())
    return kept.withColumns({
        "on_forecast_age_sales_category": F.col("snapshot.age_sales_category"),
        "on_forecast_sales_category": F.col("snapshot.sales_category"),
        "on_forecast_age_category": F.col("snapshot.age_category"),
        "style": F.col("snapshot.style")}).drop("excluded", "snapshot")


def category_distribution(history: DataFrame, category: str) -> DataFrame:
    """Distinct products and units per category, in category order."""
    return history.groupBy(category).agg(
        F.countDistinct("product_id").alias("distinct_products"),
        F.sum("sales_units").alias("total_sales_units")).orderBy(category)


def history_profile(history: DataFrame) -> DataFrame:
    """One row: records, distinct products, first and last date."""
    return history.agg(F.count(F.lit(1)).alias("total_records"),
                       F.countDistinct("product_id").alias("unique_products"),
                       F.min("date").alias("first_date"), F.max("date").alias("last_date"))


def recent_sales_stats(features: DataFrame, settings: Settings) -> DataFrame:
    """One row on the end date: least, most and mean recent units, and how many products have none."""
    recent = F.col("recent_sales_units")
    return features.where(F.col("date") == F.lit(settings.history_end)).agg(
        F.min(recent).alias("min_recent_sales"), F.max(recent).alias("max_recent_sales"),
        F.avg(recent).alias("avg_recent_sales"),
        F.count_if(recent == 0).alias("zero_recent_products"))


def filter_impact(features: DataFrame, settings: Settings) -> DataFrame:
    """What the exclusion rules remove, one row per rule.

    ``age`` and ``sales`` count products with any row in an excluded category and the units of those
    rows.  ``combined`` counts every unit of a product with any such row.  One pass per product,
    then one over products.
    """
    by_age = F.col("age_category").isin(*settings.non_eligible_ages)
    by_sales = F.col("sales_category").isin(*settings.non_eligible_sales)
    units = F.coalesce(F.col("sales_units"), F.lit(0))
    products = features.groupBy("product_id").agg(
        F.sum(units).alias("units"),
        F.sum(F.when(by_age, units).otherwise(0)).alias("age_units"),
        F.sum(F.when(by_sales, units).otherwise(0)).alias("sales_units"),
        F.max(by_age).alias("by_age"), F.max(by_sales).alias("by_sales"))
    either = F.col("by_age") | F.col("by_sales")
    totals = products.agg(
        F.count(F.lit(1)).alias("all_products"), F.sum("units").alias("all_units"),
        F.count_if("by_age").alias("age_products"), F.sum("age_units").alias("age_units"),
        F.count_if("by_sales").alias("sales_products"), F.sum("sales_units").alias("sales_units"),
        F.count_if(either).alias("combined_products"),
        F.coalesce(F.sum(F.when(either, F.col("units"))), F.lit(0)).alias("combined_units"))

    def line(rule: str, count: Column, unit_sum: Column) -> Column:
        return F.struct(F.lit(rule).alias("rule"), count.alias("products"), unit_sum.alias("units"))

    lines = totals.select("all_products", "all_units", F.explode(F.array(
        line("age", F.col("age_products"), F.col("age_units")),
        line("sales", F.col("sales_products"), F.col("sales_units")),
        line("combined", F.col("combined_products"), F.col("combined_units")),
        line("remaining", F.col("all_products") - F.col("combined_products"),
             F.col("all_units") - F.col("combined_units")),
        line("total", F.col("all_products"), F.col("all_units")))).alias("line"))

    def share(part: str, whole: str) -> Column:
        return F.coalesce(percent(F.col(part), F.col(whole)), F.lit(0.0))

    return lines.select("line.rule", "line.products", "line.units",
                        share("line.products", "all_products").alias("product_pct"),
                        share("line.units", "all_units").alias("unit_pct"))
