"""Registered queries by name.  Each takes (spark, sf_dir) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import fixtures as fx
from shelfcast.functions.categories import numeric_or_zero
from shelfcast.operators import calendar as cal
from shelfcast.operators import eligibility as el
from shelfcast.operators import evaluation as ev
from shelfcast.operators import features as ft
from shelfcast.operators import forecast as fc
from shelfcast.operators import incremental as inc
from shelfcast.operators import lifecycle as lc
from shelfcast.operators import panel
from shelfcast.operators import runs as rn
from shelfcast.operators import training as tr
from shelfcast.plans import daily, scorecard
from shelfcast.session import shared_path
from shelfcast.sources import feature_store, run_store
from shelfcast.sources import tables as tb

Query = Callable[[SparkSession, str], DataFrame]

EVALUATION_FIRST, EVALUATION_LAST = date(2024, 1, 17), date(2024, 1, 30)
STYLE = "ST7"
CATEGORY = "02| Very Low"
CATEGORY_RANGES = {"02| Very Low": (-60.0, 60.0), "03| Low": (-40.0, 50.0), "05| Medium": (20.0, 30.0),
                   "07| High Winning": (-10.0, 20.0)}
SCAN_FILTERS = {"l_shipdate_gte": date(1996, 1, 1), "l_shipdate_lte": date(2000, 12, 31),
                "l_returnflag_eq": "R", "l_linestatus": "F"}


def rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    """Round results whose last digits depend on summation order."""
    return df.withColumns({name: F.round(name, digits) for name in names})


def forecast_rounded(df: DataFrame) -> DataFrame:
    """Round forecasts to six digits.  Many are short binary fractions that end exactly half way there;
    the nudge, far above summation noise, sends those up on any engine."""
    return df.withColumn("forecast", F.round(F.col("forecast") + 1e-9, 6))


# Sources and sinks

def scan_filtered(spark, sf):
    return tb.scan(fx.table(spark, sf, "lineitem"), SCAN_FILTERS).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


def scan_ordered(spark, sf):
    """The same rows in order of their day, latest first, for a reader that needs them so."""
    return tb.scan(fx.table(spark, sf, "lineitem"), SCAN_FILTERS, order_by="l_shipdate", descending=True).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


def scan_sales_since(spark, sf):
    return tb.sales_since(fx.part_sales(spark, sf), date(1998, 1, 3))


def sales_profile(spark, sf):
    return tb.sales_profile(fx.part_sales(spark, sf))


def features_roundtrip(spark, sf):
    path = shared_path(spark, "features")
    feature_store.write_features(fx.part_features(spark, sf, flags=True), path)
    return feature_store.read_features(spark, path)


def _stored_runs(spark, sf) -> str:
    path = shared_path(spark, "runs")
    # All runs in one job, each in its own folder.
    fx.forecast_runs(spark, sf).write.partitionBy("run_id").parquet(path)
    return path


def runs_roundtrip(spark, sf):
    return run_store.read_runs(spark, _stored_runs(spark, sf))


def run_by_id(spark, sf):
    return run_store.read_run(spark, _stored_runs(spark, sf), 2)


def list_runs(spark, sf):
    return run_store.list_runs(spark, _stored_runs(spark, sf)).select(
        "run_id", "forecast_rows", "first_date", "last_date")


def next_run_id(spark, sf):
    return rn.next_run_id(fx.forecast_runs(spark, sf))


def append_table(spark, sf):
    path = shared_path(spark, "appended")
    sales = fx.user_sales(spark, sf, purchases_only=False, dense=False)
    for _ in range(2):
        tb.append_table(sales, path)
    return spark.read.parquet(path)


# Lifecycle features, over every part and day of lineitem

def _part_rows(spark, sf):
    return lc.sales_columns(fx.part_sales(spark, sf))


def _lifecycle(*names: str) -> Query:
    def query(spark, sf):
        return lc.add_lifecycle(_part_rows(spark, sf), fx.ITEM).select("product_id", "date", *names)
    return query


def day_in_stock(spark, sf):
    return lc.add_day_in_stock(_part_rows(spark, sf)).select(
        "product_id", "date", "sales_units", "day_in_stock")


def recent_sales_units(spark, sf):
    return lc.add_recent_units(_part_rows(spark, sf), fx.ITEM).select(
        "product_id", "date", "recent_sales_units")


def cumulative_sales(spark, sf):
    return lc.add_cumulative_units(_part_rows(spark, sf)).select(
        "product_id", "date", "cumulative_sales")


def salary_period(spark, sf):
    return lc.add_salary_period(_part_rows(spark, sf), fx.ITEM).select(
        "product_id", "date", "SALARY_PERIOD")


def dense_panel(spark, sf):
    return fx.brand_sales(spark, sf)


def dense_catalogue(spark, sf):
    """Lifecycle labels of every part on a dense fortnight: parts without a sale are there, as Draft."""
    rows = lc.add_lifecycle(lc.sales_columns(fx.catalogue_sales(spark, sf)), fx.ITEM)
    return rows.select("product_id", "date", "sales_units", "sales_amount", "day_in_stock", "age_sales_category")


def density_check(spark, sf):
    return panel.density_check(fx.part_sales(spark, sf))


# Calendar

def calendar_days(spark, sf):
    return cal.effect_days(fx.calendar_effects(spark, sf))


def calendar_labels(spark, sf):
    return cal.label_effect_days(cal.effect_days(fx.calendar_effects(spark, sf)))


def _flags(spark, sf):
    return cal.pivot_flags(calendar_labels(spark, sf), fx.LABELS)


def calendar_flags(spark, sf):
    return cal.flags_by_date(_part_rows(spark, sf), _flags(spark, sf))


def missing_dates(spark, sf):
    return cal.missing_dates(_part_rows(spark, sf), _flags(spark, sf))


def missing_dates_sample(spark, sf):
    """Five dates sold on without an effect, any five: how many they are, and how many of them are such dates."""
    rows, flags = _part_rows(spark, sf), _flags(spark, sf)
    known = cal.missing_dates(rows, flags).withColumn("known", F.lit(1))
    return cal.missing_dates(rows, flags, sample=5).join(known, "date", "left").agg(
        F.count(F.lit(1)).alias("sampled"), F.countDistinct("date").alias("different"), F.count("known").alias("missing"))


def active_effects(spark, sf):
    return ev.active_effects(fx.brand_features(spark, sf, flags=True))


# Features

def sales_with_style(spark, sf):
    return ft.add_style(_part_rows(spark, sf), fx.part_products(spark, sf))


def features(spark, sf):
    return fx.part_features(spark, sf, flags=True)


def features_sparse_flags(spark, sf):
    """The features with the names of each day's flags in one column, here joined by commas."""
    rows = ft.build_features(fx.part_sales(spark, sf), fx.part_products(spark, sf), fx.calendar_effects(spark, sf), fx.ITEM, sparse=True)
    return rows.withColumn("flags", F.array_join("flags", ","))


def lifecycle_state(spark, sf):
    """What a run keeps of every part for the next one; the last units are joined by commas."""
    state = inc.lifecycle_state(_part_rows(spark, sf), fx.ITEM)
    return state.withColumn("last_units", F.array_join(F.transform("last_units", lambda units: units.cast("string")), ","))


def features_incremental(spark, sf):
    """The features again, from a base and two increments that read no history but that of products with late lines."""
    path = shared_path(spark, "features")
    base, *increments = fx.part_facts_by_run(spark, sf)
    products, effects = fx.part_products(spark, sf), fx.calendar_effects(spark, sf)
    daily.build_all(spark, base, products, effects, path, fx.ITEM, fx.LABELS, keep_state=True)
    for facts in increments:
        daily.add_new(spark, facts, products, effects, path, fx.ITEM)
    # Money was added up in cents.
    return feature_store.read_features(spark, path).withColumn("sales_amount", F.col("sales_amount") / 100.0)


def feature_totals(spark, sf):
    return ft.feature_totals(fx.part_features(spark, sf))


def regressor_numeric(spark, sf):
    events = fx.table(spark, sf, "events")
    text = F.when(F.col("event_type") == "error", F.col("props")).otherwise(
        F.col("value").cast("string"))
    return events.select("event_id", numeric_or_zero(text).alias("regressor"))


# Eligibility

def _user_history(spark, sf):
    return el.history_cut(fx.user_features(spark, sf), fx.USER)


def history_cut(spark, sf):
    return _user_history(spark, sf)


def non_eligible(spark, sf):
    return el.non_eligible_products(_user_history(spark, sf), fx.USER)


def eligible_history(spark, sf):
    return el.eligible_history(_user_history(spark, sf), fx.USER)


def qualified_history(spark, sf):
    return el.qualified_history(_user_history(spark, sf), fx.USER)


def _part_history(spark, sf):
    return el.history_cut(fx.part_features(spark, sf), fx.ITEM)


def age_distribution(spark, sf):
    return el.category_distribution(_part_history(spark, sf), "age_category")


def sales_distribution(spark, sf):
    return el.category_distribution(_part_history(spark, sf), "sales_category")


def history_profile(spark, sf):
    return el.history_profile(_part_history(spark, sf))


def recent_sales_stats(spark, sf):
    return rounded(el.recent_sales_stats(fx.part_features(spark, sf), fx.ITEM), "avg_recent_sales")


def filter_impact(spark, sf):
    return el.filter_impact(fx.part_features(spark, sf), fx.ITEM)


# Forecast

def _training(features_of, settings) -> Query:
    def query(spark, sf):
        history = el.history_cut(features_of(spark, sf), settings)
        return tr.training_window(el.qualified_history(history, settings), settings)
    return query


user_training = _training(fx.user_features, fx.USER)
event_training = _training(lambda spark, sf: fx.user_features(spark, sf, purchases_only=False), fx.USER)
sparse_training = _training(lambda spark, sf: fx.user_features(spark, sf, dense=False), fx.USER)
sparse_event_training = _training(
    lambda spark, sf: fx.user_features(spark, sf, purchases_only=False, dense=False), fx.USER)
brand_training = _training(fx.brand_features, fx.ITEM)
gap_training = _training(fx.brand_features, fx.GAP)


def part_training(spark, sf):
    return tr.training_from_sales(fx.part_facts(spark, sf), fx.part_products(spark, sf), fx.ITEM)


def training_window(spark, sf):
    return event_training(spark, sf)


def training_direct(spark, sf):
    return part_training(spark, sf)


def skipped_products(spark, sf):
    return fc.skipped_products(sparse_training(spark, sf), fx.USER).select("product_id", "training_rows")


def zero_ratio(spark, sf):
    return rounded(fc.zero_ratios(user_training(spark, sf), fx.USER), "zero_ratio").select(
        "product_id", "zero_ratio")


def method_choice(spark, sf):
    return fc.zero_ratios(user_training(spark, sf), fx.USER).select("product_id", "forecast_method")


def croston_forecast(spark, sf):
    return forecast_rounded(fc.croston_forecast(user_training(spark, sf), fx.USER))


def trend_weekday_forecast(spark, sf):
    return forecast_rounded(fc.trend_weekday_forecast(brand_training(spark, sf), fx.ITEM))


def trend_weekday_gap(spark, sf):
    return forecast_rounded(fc.trend_weekday_forecast(gap_training(spark, sf), fx.GAP))


def trend_weekday_sparse(spark, sf):
    return forecast_rounded(fc.trend_weekday_forecast(sparse_event_training(spark, sf), fx.USER))


def trend_weekday_events(spark, sf):
    return forecast_rounded(fc.trend_weekday_forecast(event_training(spark, sf), fx.USER))


def forecast(spark, sf):
    return forecast_rounded(fc.forecast(user_training(spark, sf), fx.USER))


def forecast_direct(spark, sf):
    return forecast_rounded(fc.forecast(part_training(spark, sf), fx.ITEM))


def changepoint_forecast(spark, sf):
    return forecast_rounded(fc.changepoint_forecast(part_training(spark, sf), fx.ITEM))


def _fitted(settings) -> Query:
    """The changepoint model over the direct training rows of every part, to three digits."""
    def query(spark, sf):
        training = tr.training_from_sales(fx.part_facts(spark, sf), fx.part_products(spark, sf), settings)
        return rounded(fc.changepoint_forecast(training, settings), "forecast", digits=3)
    return query


def changepoint_methods(spark, sf):
    """What the changepoint forecast shares with the plain one: rows, methods, dates, intermittent values."""
    rows = fc.changepoint_forecast(part_training(spark, sf), fx.ITEM)
    croston = F.col("forecast_method") == fc.CROSTON
    return forecast_rounded(rows).select(
        "product_id", "age_sales_category", "style", "forecast_method", "date",
        F.when(croston, F.col("forecast")).alias("intermittent"))


def horizon(spark, sf):
    products = user_training(spark, sf).select("product_id").distinct()
    return fc.horizon(products, fx.USER).select("product_id", "date")


def regressor_carry(spark, sf):
    names = (*el.HISTORY_COLUMNS, *fx.USER.all_regressors)
    return fc.carry_regressors(fx.user_features(spark, sf, flags=True).select(*names).where(
        F.col("date") <= F.lit(fx.USER.history_end)), fx.USER)


# Runs

def runs_union(spark, sf):
    runs = fx.forecast_runs(spark, sf)
    parts = [runs.where(F.col("run_id") == number) for number, _, _ in fx.RUNS]
    parts[0] = parts[0].drop("style")  # an older run without the column
    return rn.union_runs(parts)


def latest_run_per_date(spark, sf):
    return rn.latest_run_per_date(fx.forecast_runs(spark, sf))


def latest_runs_indexed(spark, sf):
    """The same from a store, whose index of dates says which runs to read."""
    return run_store.latest_runs(spark, _stored_runs(spark, sf))


# Evaluation

def _evaluation(spark, sf):
    return ev.evaluation_table(latest_run_per_date(spark, sf), fx.user_features(spark, sf),
                               EVALUATION_FIRST, EVALUATION_LAST)


def _validation(spark, sf, flags: bool = False):
    return ev.validation_table(fx.user_features(spark, sf, flags=flags), latest_run_per_date(spark, sf))


def _scores_rounded(df: DataFrame, *others: str) -> DataFrame:
    # Forecasts have six digits, so a ratio can end exactly half way at six; four avoids the tie.
    return rounded(rounded(df, "bias", digits=4), "error", *others)


def evaluation_table(spark, sf):
    return _scores_rounded(_evaluation(spark, sf), "forecast")


def validation_table(spark, sf):
    return _scores_rounded(_validation(spark, sf, flags=True))


def _scored_days(spark, sf):
    return ev.add_bias_and_error(
        ev.join_actuals(fx.forecast_runs(spark, sf), fx.user_features(spark, sf)))


def bias_error(spark, sf):
    return _scores_rounded(_scored_days(spark, sf)).select(
        "product_id", "date", "run_id", "bias", "error")


def bias_bins(spark, sf):
    return _scored_days(spark, sf).select("product_id", "date", "run_id", "bias_bin")


def error_bins(spark, sf):
    """Daily brand units against the rows' recent average, which reaches every error bin."""
    rows = lc.add_lifecycle(lc.sales_columns(fx.brand_sales(spark, sf)), fx.ITEM)
    scored = rows.withColumn("forecast", F.round(F.col("recent_sales_units") / 14.0, 3))
    return ev.add_bias_and_error(scored).select("product_id", "date", "bias_bin", "error_bin")


def attribute_distribution(spark, sf):
    return ev.attribute_distribution(_evaluation(spark, sf), ["sales_category"])


def accuracy_bias(spark, sf):
    return ev.accuracy_distribution(_evaluation(spark, sf), "bias")


def accuracy_error(spark, sf):
    return ev.accuracy_distribution(_evaluation(spark, sf), "error", thresholds=(2, 4),
                                    include_partial_bins=True)


def accuracy_category(spark, sf):
    """Weighted by recent units of every brand day, one category, explicit thresholds."""
    rows = lc.add_lifecycle(lc.sales_columns(fx.brand_sales(spark, sf)), fx.ITEM)
    scored = ev.add_bias_and_error(rows.withColumn(
        "forecast", F.round(F.col("recent_sales_units") / 14.0, 3)))
    return ev.accuracy_distribution(scored, "bias", sales_category="07| High Winning",
                                    thresholds=(-40, 40))


def accuracy_by_category(spark, sf):
    """Every part day by category, each with the accepted range of the category or the default one."""
    rows = lc.add_lifecycle(_part_rows(spark, sf), fx.ITEM)
    scored = ev.add_bias_and_error(rows.withColumn("forecast", F.round(F.col("recent_sales_units") / 14.0, 3)))
    return ev.accuracy_by_category(scored, "bias", thresholds=CATEGORY_RANGES)


def accuracy_excluding(spark, sf):
    """Every part day outside the slowest and the strongest categories, against its recent average."""
    rows = lc.add_lifecycle(_part_rows(spark, sf), fx.ITEM).where(
        ~F.col("sales_category").isin("02| Very Low", "03| Low", "07| High Winning"))
    return ev.accuracy_distribution(ev.add_bias_and_error(rows.withColumn(
        "forecast", F.round(F.col("recent_sales_units") / 14.0, 3))), "bias")


def business_daily(spark, sf):
    daily = ev.business_daily(fx.user_features(spark, sf), latest_run_per_date(spark, sf))
    return rounded(rounded(daily, "bias", digits=4), "forecast")


def business_window(spark, sf):
    window = ev.business_window(fx.user_features(spark, sf), latest_run_per_date(spark, sf),
                                EVALUATION_FIRST, EVALUATION_LAST)
    return rounded(window, "total_forecast", "difference", "difference_pct", digits=4)


def products_by_age_pivot(spark, sf):
    return ev.products_by_age(fx.user_features(spark, sf), latest_run_per_date(spark, sf))


def products_by_age_bitmap(spark, sf):
    """Distinct parts by month and age, from stored bitmaps of days: a month is an OR of its days' small rows."""
    features, path = fx.part_features(spark, sf), shared_path(spark, "bitmaps")
    ev.age_bitmaps(features, ev.product_numbers(features)).write.parquet(path)
    months = spark.read.parquet(path).withColumn("month", F.date_trunc("month", "date").cast("date"))
    return ev.products_of(months, "month", "age_category")


def scorecard_one_pass(spark, sf):
    # Rounded before it is summed up, so that ties are ties on any engine.
    return rounded(ev.summary(rounded(_evaluation(spark, sf), "forecast", "error")), "forecast", "error")


def category_performance(spark, sf):
    scored = _evaluation(spark, sf).where(F.col("sales_category") == CATEGORY)
    return rounded(ev.category_performance(scored), "forecast", "error", digits=4)


def worst_products(spark, sf):
    # Rounded before ranking, so that ties are ties on any engine.
    scored = rounded(_evaluation(spark, sf), "forecast", "bias", "error")
    return ev.worst_products(scored).select("product_id", "style", "sales_units", "forecast", "error")


def style_series(spark, sf):
    return rounded(ev.style_series(_validation(spark, sf), STYLE), "bias", "error").select(
        "product_id", "style", "date", "sales_units", "forecast", "bias_bin", "error_bin")


def worst_in_category(spark, sf):
    scored = rounded(_evaluation(spark, sf), "forecast", "bias", "error").where(F.col("sales_category") == CATEGORY)
    return ev.worst_products(scored).select("product_id", "style", "sales_units", "forecast", "error")


def run_style_series(spark, sf):
    """One style's rows of one stored run."""
    run = run_store.read_run(spark, _stored_runs(spark, sf), 3)
    return ev.style_series(run, STYLE).select("product_id", "style", "date", "forecast", "run_id")


# The two jobs, written and read back

def _job_inputs(spark, sf) -> list[tb.Table]:
    tables = {"sales": fx.user_sales(spark, sf), "products": fx.user_products(spark, sf),
              "calendar": fx.calendar_effects(spark, sf, "events", "ts")}
    places = [shared_path(spark, name) for name in tables]
    for df, place in zip(tables.values(), places):
        df.write.parquet(place)
    return [tb.Table(place) for place in places]


def daily_job(spark, sf):
    features, runs = shared_path(spark, "features"), shared_path(spark, "runs")
    run_id = daily.run(spark, *_job_inputs(spark, sf), features, runs, fx.USER, fx.LABELS, fc.TREND_WEEKDAY)
    return forecast_rounded(run_store.read_run(spark, runs, run_id))


def _model_job(settings) -> Query:
    """The job with its default model: rows, categories, methods and intermittent values of the stored run."""
    def query(spark, sf):
        features, runs = shared_path(spark, "features"), shared_path(spark, "runs")
        run_id = daily.run(spark, *_job_inputs(spark, sf), features, runs, settings, fx.LABELS)
        rows = forecast_rounded(run_store.read_run(spark, runs, run_id))
        return rows.withColumn("intermittent", F.when(F.col("forecast_method") == fc.CROSTON, F.col("forecast"))).drop("forecast")
    return query


def scorecard_job(spark, sf):
    features, out = shared_path(spark, "features"), shared_path(spark, "scorecard")
    feature_store.write_features(fx.user_features(spark, sf), features)
    card = scorecard.write_scorecard(spark, features, _stored_runs(spark, sf), out, EVALUATION_FIRST, EVALUATION_LAST)
    business = spark.read.parquet(f"{out}/business_daily")
    ages = spark.read.parquet(f"{out}/products_by_age")
    joined = business.join(ages, "date").join(
        card.validation.groupBy("date").agg(F.count(F.lit(1)).alias("validation_rows")), "date")
    return rounded(rounded(joined, "bias", digits=4), "forecast")


def product_card(spark, sf):
    return ev.product_card(fx.part_products(spark, sf), STYLE)


QUERIES: dict[str, Query] = {
    # sources and sinks
    "scan_filtered": scan_filtered,
    "scan_ordered": scan_ordered,
    "scan_sales_since": scan_sales_since,
    "sales_profile": sales_profile,
    "features_roundtrip": features_roundtrip,
    "runs_roundtrip": runs_roundtrip,
    "run_by_id": run_by_id,
    "list_runs": list_runs,
    "next_run_id": next_run_id,
    "append_table": append_table,
    # lifecycle
    "day_in_stock": day_in_stock,
    "age_category": _lifecycle("age_category"),
    "sales_category": _lifecycle("sales_category"),
    "age_sales_category": _lifecycle("summarized_sales_category", "age_sales_category"),
    "salary_period": salary_period,
    "recent_sales_units": recent_sales_units,
    "cumulative_sales": cumulative_sales,
    "dense_panel": dense_panel,
    "dense_catalogue": dense_catalogue,
    "density_check": density_check,
    # calendar
    "calendar_days": calendar_days,
    "calendar_labels": calendar_labels,
    "calendar_flags": calendar_flags,
    "missing_dates": missing_dates,
    "missing_dates_sample": missing_dates_sample,
    "active_effects": active_effects,
    # features
    "sales_with_style": sales_with_style,
    "features": features,
    "lifecycle_state": lifecycle_state,
    "features_incremental": features_incremental,
    "features_sparse_flags": features_sparse_flags,
    "feature_totals": feature_totals,
    "regressor_numeric": regressor_numeric,
    # eligibility
    "history_cut": history_cut,
    "non_eligible": non_eligible,
    "eligible_history": eligible_history,
    "qualified_history": qualified_history,
    "age_distribution": age_distribution,
    "sales_distribution": sales_distribution,
    "history_profile": history_profile,
    "recent_sales_stats": recent_sales_stats,
    "filter_impact": filter_impact,
    # forecast
    "training_window": training_window,
    "training_direct": training_direct,
    "skipped_products": skipped_products,
    "zero_ratio": zero_ratio,
    "method_choice": method_choice,
    "croston_forecast": croston_forecast,
    "trend_weekday_forecast": trend_weekday_forecast,
    "trend_weekday_events": trend_weekday_events,
    "trend_weekday_gap": trend_weekday_gap,
    "trend_weekday_sparse": trend_weekday_sparse,
    "changepoint_line": _fitted(fx.LINE),
    "changepoint_one_bend": _fitted(fx.BEND),
    "changepoint_sparse_bend": _fitted(fx.SPARSE_BEND),
    "changepoint_methods": changepoint_methods,
    "changepoint_forecast": changepoint_forecast,
    "horizon": horizon,
    "regressor_carry": regressor_carry,
    "forecast": forecast,
    "forecast_direct": forecast_direct,
    # runs
    "runs_union": runs_union,
    "latest_run_per_date": latest_run_per_date,
    "latest_runs_indexed": latest_runs_indexed,
    # evaluation
    "evaluation_table": evaluation_table,
    "validation_table": validation_table,
    "bias_error": bias_error,
    "bias_bins": bias_bins,
    "error_bins": error_bins,
    "attribute_distribution": attribute_distribution,
    "accuracy_bias": accuracy_bias,
    "accuracy_error": accuracy_error,
    "accuracy_category": accuracy_category,
    "accuracy_excluding": accuracy_excluding,
    "accuracy_by_category": accuracy_by_category,
    "business_daily": business_daily,
    "business_window": business_window,
    "products_by_age_pivot": products_by_age_pivot,
    "products_by_age_bitmap": products_by_age_bitmap,
    "scorecard_one_pass": scorecard_one_pass,
    "category_performance": category_performance,
    "worst_products": worst_products,
    "worst_in_category": worst_in_category,
    "style_series": style_series,
    "run_style_series": run_style_series,
    "product_card": product_card,
    # jobs
    "daily_job": daily_job,
    "daily_job_changepoint": _model_job(fx.USER),
    "daily_job_regressors": _model_job(replace(fx.USER, use_regressors=True)),
    "scorecard_job": scorecard_job,
}
