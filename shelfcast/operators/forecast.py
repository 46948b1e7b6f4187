"""Fourteen-day forecasts: intermittent demand, and trend with a weekly season."""

from __future__ import annotations

from datetime import timedelta

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.categories import numeric_or_zero, salary_period
from shelfcast.operators.calendar import flag_columns, is_sparse
from shelfcast.operators.changepoint import EPOCH, RegressorDays, changepoint_values
from shelfcast.operators.lifecycle import ALL_ROWS, product_rows
from shelfcast.operators.training import PRODUCT_COLUMNS
from shelfcast.settings import Settings

CROSTON = "croston"
TREND_WEEKDAY = "trend_weekday"
CHANGEPOINT = "changepoint"

SMOOTHING = 0.4
BIAS_FACTOR = 1 - SMOOTHING / 2  # Syntetos-Boylan correction
TREND_FLOOR = 0.01  # keeps a weekday's trend sum positive
SEASON_ROWS = 14  # shortest window with a weekly season

FORECAST_COLUMNS = ("product_id", "age_sales_category", "age_category", "sales_category", "style",
                    "forecast_method", "date", "forecast")


def _add_trend(training: DataFrame) -> DataFrame:
    """Least-squares line through each product's rows by date, as its value on each row.

    Days are counted from the product's first training row, so gaps in the rows and between the
    last row and the forecast keep their length.  Sums of whole units and days are exact, so the line is
    the same in any row order.
    """
    whole = product_rows(training).rowsBetween(*ALL_ROWS)
    dated = training.withColumn("first_date", F.min("date").over(whole))
    day = F.datediff("date", "first_date").cast("long")
    x = F.when(F.col("y").isNotNull(), day)
    y = F.col("y")
    sums = dated.withColumns({
        "k": F.count("y").over(whole), "s_x": F.sum(x).over(whole), "s_y": F.sum(y).over(whole),
        "s_xx": F.sum(x * x).over(whole), "s_xy": F.sum(x * y).over(whole)})
    spread = F.col("k") * F.col("s_xx") - F.col("s_x") * F.col("s_x")
    slope = (F.col("k") * F.col("s_xy") - F.col("s_x") * F.col("s_y")).cast("double") / F.nullif(
        spread, F.lit(0))
    lined = sums.withColumn("slope", F.coalesce(slope, F.lit(0.0)))
    lined = lined.withColumn(
        "intercept", (F.col("s_y") - F.col("slope") * F.col("s_x")) / F.nullif(F.col("k"), F.lit(0)))
    return lined.withColumn("trend", F.col("intercept") + F.col("slope") * day).drop(
        "k", "s_x", "s_y", "s_xx", "s_xy")


def _keys(settings: Settings) -> list[Column]:
    method = F.when(F.col("zero_ratio") >= settings.zero_ratio_threshold, CROSTON).otherwise(
        TREND_WEEKDAY)
    return [F.col("zero_ratio"), method.alias("forecast_method")]


def _common_aggregates(settings: Settings) -> list[Column]:
    y, t, n = F.col("y"), F.col("t"), F.col("n")
    recent = t >= n - settings.recent_rows
    positive = y > 0
    return [
        # A null row is not a zero but stays in the denominator.
        (F.count_if(recent & (y == 0)) / F.count_if(recent)).alias("zero_ratio"),
        F.count_if(positive).alias("demand_rows"),
        F.sum(F.when(positive, y)).alias("demand_units"),
        # The first row never closes an interval, so intervals run over later demand rows.
        F.count_if(positive & (t >= 1)).alias("intervals"),
        F.max(F.when(positive & (t >= 1), t)).alias("last_demand_row")]


def _croston(factor: Column, n: Column) -> Column:
    """Mean demand over mean interval, bias-corrected.  The interval sum telescopes to the last
    demand row, so one aggregate is enough."""
    interval = F.when(F.col("demand_rows") == 1, n).otherwise(
        F.col("last_demand_row") / F.nullif(F.col("intervals"), F.lit(0)))
    level = F.col("demand_units") / F.nullif(F.col("demand_rows"), F.lit(0)) / F.nullif(interval, F.lit(0.0))
    return F.when(F.col("intervals") == 0, 0.0).otherwise(level * BIAS_FACTOR * factor)


def skipped_products(training: DataFrame, settings: Settings) -> DataFrame:
    """Products with too few training rows for any forecast."""
    return training.groupBy(*PRODUCT_COLUMNS).agg(
        F.count(F.lit(1)).alias("training_rows")).where(
        F.col("training_rows") < settings.min_observations)


def zero_ratios(training: DataFrame, settings: Settings) -> DataFrame:
    """Per product with enough rows: share of zero rows among the last ones, and the method."""
    return (_enough(training, settings).groupBy(*PRODUCT_COLUMNS, "n")
            .agg(*_common_aggregates(settings)).select(*PRODUCT_COLUMNS, *_keys(settings)))


def _enough(training: DataFrame, settings: Settings) -> DataFrame:
    return training.where(F.col("n") >= settings.min_observations)


def horizon(products: DataFrame, settings: Settings) -> DataFrame:
    """Each row once per forecast day, with ``step`` counting from 0."""
    days = F.sequence(F.lit(settings.forecast_start),
                      F.lit(settings.forecast_start + timedelta(days=settings.horizon_days - 1)))
    return products.select("*", F.posexplode(days).alias("step", "date"))


def _output(rows: DataFrame, method: Column, value: Column) -> DataFrame:
    return rows.select(
        F.col("product_id"), F.col("on_forecast_age_sales_category").alias("age_sales_category"),
        F.col("on_forecast_age_category").alias("age_category"),
        F.col("on_forecast_sales_category").alias("sales_category"), F.col("style"),
        method.alias("forecast_method"), F.col("date"), value.alias("forecast"))


def croston_forecast(training: DataFrame, settings: Settings) -> DataFrame:
    """Intermittent-demand forecast of every product with enough rows, whatever its zero ratio."""
    profile = _enough(training, settings).groupBy(*PRODUCT_COLUMNS, "n").agg(
        *_common_aggregates(settings))
    valued = profile.withColumn("croston", _croston(F.col("over_forecast_factor"), F.col("n")))
    return _output(horizon(valued, settings), F.lit(CROSTON), F.col("croston"))


def _trend_profile(training: DataFrame, settings: Settings) -> DataFrame:
    """One row per product: the method inputs, the line, and a seven-day season from Sunday."""
    weekday = F.dayofweek("date")
    base = F.when(F.col("y").isNotNull(), F.greatest(F.col("trend"), F.lit(TREND_FLOOR)))
    seasonal = []
    for number in range(1, 8):
        on_day = weekday == number
        ratio = F.sum(F.when(on_day, F.col("y"))) / F.sum(F.when(on_day, base))
        seasonal.append(F.when(F.col("n") >= SEASON_ROWS, F.coalesce(ratio, F.lit(1.0))).otherwise(1.0))
    lined = _add_trend(_enough(training, settings))
    return lined.groupBy(*PRODUCT_COLUMNS, "n", "slope", "intercept", "first_date").agg(
        *_common_aggregates(settings), F.array(*seasonal).alias("season"))


def _trend_value() -> Column:
    line = F.col("intercept") + F.col("slope") * F.datediff("date", "first_date")
    season = F.element_at("season", F.dayofweek("date"))
    return F.greatest(line * season * F.col("over_forecast_factor"), F.lit(0.0))


def trend_weekday_forecast(training: DataFrame, settings: Settings) -> DataFrame:
    """Trend-and-weekday forecast of every product with enough rows, whatever its zero ratio."""
    rows = horizon(_trend_profile(training, settings), settings)
    return _output(rows, F.lit(TREND_WEEKDAY), _trend_value())


def forecast(training: DataFrame, settings: Settings) -> DataFrame:
    """Every product's forecast by the method its zero ratio selects.

    A line that cannot be drawn falls back to the intermittent method.  Windows, the one grouping and
    the horizon all keep the partitioning by product, so nothing is shuffled here.
    """
    profile = _trend_profile(training, settings)
    intermittent = (F.col("zero_ratio") >= settings.zero_ratio_threshold) | F.col("intercept").isNull()
    valued = profile.withColumn("croston", _croston(F.col("over_forecast_factor"), F.col("n")))
    method = F.when(intermittent, CROSTON).otherwise(TREND_WEEKDAY)
    value = F.when(intermittent, F.col("croston")).otherwise(_trend_value())
    return _output(horizon(valued, settings), method, value)


def known_regressors(flags: DataFrame, settings: Settings) -> DataFrame:
    """Every date from the history start to the forecast end with all regressors, past and planned."""
    days = F.explode(F.sequence(F.lit(settings.history_start), F.lit(settings.forecast_end)))
    spine = flags.sparkSession.range(1).select(days.alias("date"))
    if is_sparse(flags):
        flags = flag_columns(flags, [name for name in settings.all_regressors if name != "SALARY_PERIOD"])
    present = [name for name in settings.all_regressors if name in flags.columns]
    filled = spine.join(flags.select("date", *present), "date", "left")
    salary = salary_period(F.col("date"), settings.salary_first_day, settings.salary_last_day)
    return filled.select("date", *[
        numeric_or_zero(F.col(name)).alias(name) if name in present
        else (salary if name == "SALARY_PERIOD" else F.lit(0)).cast("double").alias(name)
        for name in settings.all_regressors])


def _regressor_days(regressors: DataFrame, settings: Settings) -> RegressorDays:
    names = list(settings.all_regressors)
    rows = regressors.orderBy("date").select(*names).collect()
    columns = {category: [names.index(name) for name in rule.regressors]
               for category, rule in settings.lifecycle.items()}
    return RegressorDays((settings.history_start - EPOCH).days,
                         np.array([tuple(row) for row in rows], dtype=float), columns)


def changepoint_forecast(training: DataFrame, settings: Settings,
                         regressors: DataFrame | None = None) -> DataFrame:
    """As ``forecast``, but the trend bends at the category's changepoints and the weekly season is
    a Fourier series, fitted with a sparse prior on the bends.

    Each product is one row with its series in an array no longer than the look-back, so Arrow sends
    thousands of products to one call of the solver.

    ``regressors`` is the output of ``known_regressors``: one row per calendar day of the settings'
    dates, whatever the products.  Given, a job reads these few rows once, and they travel with the
    function; repeated in every product's row they would outweigh the sales.
    """
    profile = _enough(training, settings).groupBy(*PRODUCT_COLUMNS, "n").agg(
        *_common_aggregates(settings),
        # Rows without units are left out; the model goes by dates.
        F.transform(F.sort_array(F.collect_list(F.when(F.col("y").isNotNull(), F.struct("t", "y", "date")))),
                    lambda row: F.struct(row.y.cast("double").alias("y"),
                                         F.unix_date(row.date).alias("day"))).alias("series"))
    intermittent = F.col("zero_ratio") >= settings.zero_ratio_threshold
    solver = changepoint_values(
        settings.forecast_start, settings.horizon_days,
        None if regressors is None else _regressor_days(regressors, settings), settings.changepoint_penalty)
    fitted = profile.withColumn("croston", _croston(F.col("over_forecast_factor"), F.col("n"))).withColumn(
        "fitted", solver(F.when(~intermittent, F.col("series.y")),
                         F.when(~intermittent, F.col("series.day")),
                         F.col("changepoints"), F.col("changepoint_prior"),
                         F.col("on_forecast_age_sales_category")))
    # The solver gives null for an intermittent product and for a fit that is not finite.
    method = F.when(F.col("fitted").isNull(), CROSTON).otherwise(CHANGEPOINT)
    value = F.when(F.col("fitted").isNull(), F.col("croston")).otherwise(F.greatest(
        F.element_at("fitted", F.col("step") + 1) * F.col("over_forecast_factor"), F.lit(0.0)))
    return _output(horizon(fitted, settings), method, value)


def carry_regressors(history: DataFrame, settings: Settings) -> DataFrame:
    """Regressors over the forecast days: each product's last known value, 0 where it has none."""
    present = [name for name in settings.all_regressors if name in history.columns]
    last = history.groupBy("product_id").agg(*[
        F.max_by(numeric_or_zero(F.col(name)), "date").alias(name) for name in present])
    absent = {name: F.lit(0.0) for name in settings.all_regressors if name not in present}
    return horizon(last.withColumns(absent) if absent else last, settings).drop("step")
