"""Scoring forecasts against actual sales."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfcast.functions import accuracy
from shelfcast.functions.accuracy import percent
from shelfcast.functions.categories import AGE_CATEGORIES
from shelfcast.operators.calendar import SPARSE, is_sparse

# Sums of forecasts are rounded here before they are binned.  The last bits of such a sum depend on the
# order rows arrive in, and a retried task must not move a product across a bin edge.
SUM_DIGITS = 9

# Column names of the evaluation table.
EVALUATION_KEYS = ("product_id", "style", "age_sales_category", "age_category", "sales_category",
                   "forecast_method")


def add_bias_and_error(df: DataFrame, actual: str = "sales_units", predicted: str = "forecast",
                       drop_unmatched: bool = False) -> DataFrame:
    """Add bias, error and their bins.

    A row without a forecast or an actual lands in the last bins; ``drop_unmatched`` removes such rows.
    """
    if drop_unmatched:
        df = df.where(F.col(actual).isNotNull() & F.col(predicted).isNotNull())
    scored = df.withColumns({"bias": accuracy.bias(F.col(actual), F.col(predicted)),
                             "error": accuracy.error(F.col(actual), F.col(predicted))})
    return scored.withColumns({"bias_bin": accuracy.bin_label("bias", F.col("bias")),
                               "error_bin": accuracy.bin_label("error", F.col("error"))})


def join_actuals(forecast: DataFrame, features: DataFrame, first: date | None = None,
                 last: date | None = None) -> DataFrame:
    """Forecast rows that have an actual.  Both sides have one row per product and day.

    ``first`` and ``last`` bound the dates scored; given, they reach the scan of the stored features,
    which hold the whole history.
    """
    actuals = features.select("product_id", "date", "sales_units")
    for bound, keep in ((first, F.col("date").__ge__), (last, F.col("date").__le__)):
        if bound is not None:
            actuals, forecast = actuals.where(keep(F.lit(bound))), forecast.where(keep(F.lit(bound)))
    return forecast.join(actuals, ["product_id", "date"])


def evaluation_table(forecast: DataFrame, features: DataFrame, first: date | None = None,
                     last: date | None = None) -> DataFrame:
    """Actual and forecast units per product, its forecast categories and method, with bins."""
    totals = join_actuals(forecast, features, first, last).groupBy(*EVALUATION_KEYS).agg(
        F.sum("sales_units").alias("sales_units"),
        F.round(F.sum("forecast"), SUM_DIGITS).alias("forecast"))
    return add_bias_and_error(totals)


def validation_table(features: DataFrame, forecast: DataFrame,
                     drop_unmatched: bool = False) -> DataFrame:
    """Full history beside the forecast, day by day, style filled forward per product, with bins."""
    predicted = forecast.select("product_id", "date", "forecast_method", "forecast")
    joined = features.join(predicted, ["product_id", "date"], "full")
    filled = joined.withColumn("style", F.last("style", ignorenulls=True).over(
        Window.partitionBy("product_id").orderBy("date")))
    return add_bias_and_error(filled, drop_unmatched=drop_unmatched)


def attribute_distribution(df: DataFrame, group_by: Sequence[str]) -> DataFrame:
    """Distinct products and units per group, with each one's share of the total over groups.

    Totals come from a scalar subquery over the grouped rows, since a window without partition would
    move every group into one task.  One subquery reads both columns, so that it is the same plan as the
    grouping up to the last step and Spark computes that part once.
    """
    groups = df.groupBy(*group_by).agg(F.countDistinct("product_id").alias("product_count"),
                                       F.sum("sales_units").alias("total_sales_units"))

    counted = ("product_count", "total_sales_units")
    totals = groups.agg(F.struct(*[F.sum(name).alias(name) for name in counted])).scalar()

    def share(name: str):
        return percent(F.col(name), totals.getField(name))

    return groups.withColumns({"product_count_pct": share("product_count"),
                               "total_sales_units_pct": share("total_sales_units")}
                              ).orderBy(*group_by)


def _bins(spark: SparkSession, method: str) -> DataFrame:
    rows = [(position, label, start, end)
            for position, (label, start, end) in enumerate(accuracy.bin_table(method))]
    return spark.createDataFrame(
        rows, f"position int, {method}_bin string, bin_start double, bin_end double")


def good_range(method: str, thresholds: tuple[float, float] | None) -> tuple[float, float]:
    """The accepted range.  Two non-negative numbers are tolerances below and above zero."""
    if thresholds is None:
        return accuracy.DEFAULT_GOOD_RANGE[method]
    low, high = (float(value) for value in thresholds)
    return (-low, high) if low >= 0 and high >= 0 else (low, high)


def accuracy_distribution(scored: DataFrame, method: str = "bias", target: str = "sales_units",
                          sales_category: str | None = None,
                          thresholds: tuple[float, float] | None = None,
                          include_partial_bins: bool = False) -> DataFrame:
    """Units per bin over all 22 bins, each one's percent, and the percent in good bins.

    A bin is good if it lies inside the accepted range, or with ``include_partial_bins`` if it
    overlaps it.  The window without partition runs over the 22 fixed bins only.
    """
    if method not in accuracy.BIN_EDGES:
        raise ValueError("method must be 'bias' or 'error'")
    low, high = good_range(method, thresholds)
    if sales_category is not None:
        scored = scored.where(F.col("sales_category") == sales_category)
    key = f"{method}_bin"
    return _distribution(scored.groupBy(key).agg(F.sum(target).alias("units_in_bin")), method, low, high, include_partial_bins)


def _distribution(units: DataFrame, method: str, low: float, high: float, include_partial_bins: bool) -> DataFrame:
    """All 22 bins from the units of those that have any (``units_in_bin``)."""
    key = f"{method}_bin"
    start, end = F.col("bin_start"), F.col("bin_end")
    good = ((start <= high) & (end >= low)) if include_partial_bins else (
        (start >= low) & (end <= high))
    table = _bins(units.sparkSession, method).join(units, key, "left").withColumns({
        "units_in_bin": F.coalesce(F.col("units_in_bin"), F.lit(0)), "is_good": good})
    everything = Window.partitionBy()
    total = F.sum("units_in_bin").over(everything)
    good_units = F.sum(F.when(F.col("is_good"), F.col("units_in_bin")).otherwise(0)).over(everything)
    divisor = F.when(total == 0, 1).otherwise(total)
    return table.select(
        key, "units_in_bin", "bin_start", "bin_end", "is_good",
        percent(F.col("units_in_bin"), divisor).alias("percentage_of_target"),
        F.when(total > 0, percent(good_units, divisor)).otherwise(0.0).alias("good_percent"),
        (F.col("position") - accuracy.ZERO_POSITION).alias("bin_numeric_pos")).orderBy(key)


def accuracy_by_category(scored: DataFrame, method: str = "bias", target: str = "sales_units",
                         thresholds: Mapping[str, tuple[float, float]] | None = None,
                         include_partial_bins: bool = False) -> DataFrame:
    """``accuracy_distribution`` for every sales category at once, each with its own accepted range.

    ``thresholds`` gives ranges by category; a category without one has the default.  Units are grouped by
    category and bin in one pass, so what follows has 22 rows for each category.
    """
    if method not in accuracy.BIN_EDGES:
        raise ValueError("method must be 'bias' or 'error'")
    key, spark = f"{method}_bin", scored.sparkSession
    units = scored.where(F.col("sales_category").isNotNull()).groupBy("sales_category", key).agg(
        F.sum(target).alias("units_in_bin"))
    grid = units.select("sales_category").distinct().join(_bins(spark, method))
    low, high = (F.lit(bound) for bound in good_range(method, None))
    for category, own in (thresholds or {}).items():
        own_low, own_high = good_range(method, own)
        here = F.col("sales_category") == category
        low, high = F.when(here, own_low).otherwise(low), F.when(here, own_high).otherwise(high)
    start, end = F.col("bin_start"), F.col("bin_end")
    good = ((start <= high) & (end >= low)) if include_partial_bins else ((start >= low) & (end <= high))
    table = grid.join(units, ["sales_category", key], "left").withColumns({
        "units_in_bin": F.coalesce(F.col("units_in_bin"), F.lit(0)), "is_good": good})
    whole = Window.partitionBy("sales_category")
    total = F.sum("units_in_bin").over(whole)
    good_units = F.sum(F.when(F.col("is_good"), F.col("units_in_bin")).otherwise(0)).over(whole)
    divisor = F.when(total == 0, 1).otherwise(total)
    return table.select(
        "sales_category", key, "units_in_bin", "bin_start", "bin_end", "is_good",
        percent(F.col("units_in_bin"), divisor).alias("percentage_of_target"),
        F.when(total > 0, percent(good_units, divisor)).otherwise(0.0).alias("good_percent"),
        (F.col("position") - accuracy.ZERO_POSITION).alias("bin_numeric_pos")).orderBy("sales_category", key)


def business_daily(features: DataFrame, forecast: DataFrame) -> DataFrame:
    """Units and forecast per date, with bias where both exist and units are positive.

    Each side is summed per date before the two meet, so no product is shuffled.
    """
    daily = features.groupBy("date").agg(F.sum("sales_units").alias("sales_units")).join(
        forecast.groupBy("date").agg(F.sum("forecast").alias("forecast")), "date", "full")
    ratio = (F.col("forecast") - F.col("sales_units")) / F.col("sales_units")
    return daily.withColumn("bias", F.when(F.col("sales_units") > 0, ratio)).orderBy("date")


def business_window(features: DataFrame, forecast: DataFrame, first: date, last: date) -> DataFrame:
    """One row over the evaluation dates: units, forecast, difference and percent.

    The dates bound both sides, so they reach the scan of the stored features.
    """
    inside = F.col("date").between(F.lit(first), F.lit(last))
    totals = features.where(inside).agg(F.coalesce(F.sum("sales_units"), F.lit(0)).alias("total_sales")).join(
        forecast.where(inside).agg(F.coalesce(F.sum("forecast"), F.lit(0.0)).alias("total_forecast")))
    gap = F.col("total_forecast") - F.col("total_sales")
    return totals.withColumns({"difference": gap, "difference_pct": gap / F.nullif(
        F.col("total_sales"), F.lit(0)) * 100})


def products_by_age(features: DataFrame, forecast: DataFrame) -> DataFrame:
    """Distinct products per date, one column per age category; zeros on dates with forecasts alone."""
    counts = features.groupBy("date").pivot("age_category", list(AGE_CATEGORIES)).agg(
        F.countDistinct("product_id"))
    dates = forecast.select("date").distinct()
    return counts.join(dates, "date", "full").fillna(0, subset=list(AGE_CATEGORIES))


# Distinct products that add up: a bitmap for each day and age

def product_numbers(products: DataFrame, groups: int = 256) -> DataFrame:
    """Each product_id with a number of its own, from 0 on without gaps, so that bitmaps of them are small.

    Products are numbered within ``groups`` hash groups, and groups one behind the other: one task sees ``groups`` rows.
    """
    known = products.select("product_id").where(F.col("product_id").isNotNull()).distinct().withColumn(
        "group", F.pmod(F.xxhash64("product_id"), F.lit(groups)))
    before = known.groupBy("group").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "before", F.coalesce(F.sum("n").over(Window.orderBy("group").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    place = F.row_number().over(Window.partitionBy("group").orderBy("product_id"))
    return known.join(before.select("group", "before"), "group").select(
        "product_id", (F.col("before") + place - 1).alias("number"))


def age_bitmaps(features: DataFrame, numbers: DataFrame) -> DataFrame:
    """Products of every date and age category as bitmaps: one row for each 32,768 numbers that have any.

    Stored, they answer for any window of dates by an OR of small rows, where distinct counts of days cannot be added.
    Rows meet before a bitmap is made of them: a product's task has few rows of any one bitmap, and each would leave it as 4 KB.
    """
    numbered = features.where(F.col("date").isNotNull()).select("date", "age_category", "product_id").join(numbers, "product_id")
    places = numbered.select("date", "age_category", F.bitmap_bucket_number("number").alias("bucket"),
                             F.bitmap_bit_position("number").alias("place"))
    keys = ("date", "age_category", "bucket")
    return places.repartition(*keys).groupBy(*keys).agg(F.bitmap_construct_agg("place").alias("products"))


def products_of(bitmaps: DataFrame, *group_by: str) -> DataFrame:
    """Distinct products of each group of bitmap rows."""
    united = bitmaps.groupBy(*group_by, "bucket").agg(F.bitmap_or_agg("products").alias("products"))
    return united.groupBy(*group_by).agg(F.sum(F.bitmap_count("products")).alias("product_count"))


# The evaluation table in one pass

def summary(scored: DataFrame) -> DataFrame:
    """Totals of the evaluation table by category, by bias bin, by error bin, by category and each bin, and of all of it.

    Grouping sets make all of them in one scan and one shuffle of partial sums.  ``view`` names the set a row belongs to; columns that
    its set does not group by are null.  ``worst_product`` is the one with the largest error, the smaller id among equals.
    """
    keys = ("sales_category", "bias_bin", "error_bin")
    sets = [["sales_category"], ["bias_bin"], ["error_bin"], ["sales_category", "bias_bin"], ["sales_category", "error_bin"], []]
    grouped = scored.groupingSets([[F.col(name) for name in names] for names in sets], *keys).agg(
        F.grouping_id(*keys).alias("set"), F.countDistinct("product_id").alias("product_count"), F.count(F.lit(1)).alias("rows"),
        F.sum("sales_units").alias("sales_units"), F.sum("forecast").alias("forecast"), F.sum("error").alias("error"),
        F.min_by("product_id", F.struct(-F.col("error"), "product_id")).alias("worst_product"))
    # A bit is set for each key that is not grouped by, the last key's the lowest.
    view = F.when(F.col("set") == 3, "category").when(F.col("set") == 5, "bias").when(F.col("set") == 6, "error").when(
        F.col("set") == 1, "category_bias").when(F.col("set") == 2, "category_error").otherwise("total")
    return grouped.withColumn("view", view).select("view", *keys, *[c for c in grouped.columns if c not in (*keys, "set")])


def accuracy_of(summed: DataFrame, method: str = "bias", sales_category: str | None = None,
                thresholds: tuple[float, float] | None = None, include_partial_bins: bool = False) -> DataFrame:
    """``accuracy_distribution`` of sales units from the rows of ``summary``, without another look at the products."""
    low, high = good_range(method, thresholds)
    rows = summed.where(F.col("view") == method) if sales_category is None else summed.where(
        (F.col("view") == f"category_{method}") & (F.col("sales_category") == sales_category))
    return _distribution(rows.select(f"{method}_bin", F.col("sales_units").alias("units_in_bin")), method, low, high, include_partial_bins)


def category_performance(scored: DataFrame, count_of: str = "style") -> DataFrame:
    """One row: distinct values of one column, and units, forecast and error summed."""
    return scored.agg(F.countDistinct(count_of).alias("product_count"),
                      F.sum("sales_units").alias("sales_units"),
                      F.sum("forecast").alias("forecast"), F.sum("error").alias("error"))


def worst_products(scored: DataFrame, limit: int = 10) -> DataFrame:
    """The largest over-forecasts.  Each task keeps ``limit`` rows, so nothing is sorted whole."""
    return scored.orderBy(F.desc("error"), F.asc("product_id")).limit(limit)


def style_series(df: DataFrame, style: str) -> DataFrame:
    """One style's rows by date."""
    return df.where(F.col("style") == style).orderBy("date")


def product_card(products: DataFrame, style: str) -> DataFrame:
    """Title, price, status and image link of one style, as far as the table has them."""
    wanted = ("product_title", "price", "status", "image_url")
    return products.where(F.col("product_number") == style).select(
        "id", "product_number", *[name for name in wanted if name in products.columns])


def active_effects(features: DataFrame, styles: Iterable[str] | None = None) -> DataFrame:
    """Days on which an anchor-day flag or the salary period is on, as (style, date, effect) rows."""
    if styles is not None:
        features = features.where(F.col("style").isin(*styles))
    if is_sparse(features):
        salary = F.when(F.col("SALARY_PERIOD") > 0, F.array(F.lit("SALARY_PERIOD"))).otherwise(F.array().cast("array<string>"))
        anchors = F.filter(SPARSE, lambda name: name.endswith("_DAY_0"))
        return features.select("style", "date", F.explode(F.concat(anchors, salary)).alias("effect"))
    flags = [name for name in features.columns if name.endswith("_DAY_0") or name == "SALARY_PERIOD"]
    active = F.explode(F.filter(
        F.array(*[F.when(F.col(name) > 0, F.lit(name)) for name in flags]), lambda e: e.isNotNull()))
    return features.select("style", "date", active.alias("effect"))
