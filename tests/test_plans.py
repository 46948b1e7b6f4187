"""Plan shapes that matter at scale, checked with automatic broadcasts off."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from catalog import fixtures as fx
from catalog.queries import QUERIES
from shelfcast.operators import calendar as cal
from shelfcast.operators import eligibility as el
from shelfcast.operators import evaluation as ev
from shelfcast.operators import forecast as fc
from shelfcast.operators import lifecycle as lc
from shelfcast.operators import panel
from shelfcast.operators import runs as rn
from shelfcast.operators import training as tr
from shelfcast.operators.features import build_features
from shelfcast.settings import Settings
from tests.helpers import day, products, sales, values

SETTINGS = Settings(history_start=day(0), history_end=day(15))


@pytest.fixture(autouse=True)
def no_automatic_broadcast(spark):
    changed = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.maxMetadataStringLength": "2000"}
    before = {key: spark.conf.get(key) for key in changed}
    for key, value in changed.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Sales in a file, so that plans start at a scan."""
    path = str(tmp_path_factory.mktemp("plans") / "sales")
    sales(spark, {"a": [1] * 20, "b": [0, 2] * 10}).write.parquet(path)
    return spark.read.parquet(path)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _count(df, operator: str) -> int:
    return len(re.findall(rf"^[ :+\-]*{operator}\b", _plan(df), re.MULTILINE))


def test_lifecycle_shuffles_and_sorts_once(stored):
    df = lc.add_lifecycle(lc.sales_columns(stored), SETTINGS)
    assert (_count(df, "Exchange"), _count(df, "Sort")) == (1, 1)


def test_eligibility_training_and_forecast_add_no_shuffle(stored):
    features = lc.add_lifecycle(lc.sales_columns(stored), SETTINGS).withColumn("style", F.lit("x"))
    qualified = el.qualified_history(el.history_cut(features, SETTINGS), SETTINGS)
    training = tr.training_window(qualified, SETTINGS)
    for df in (qualified, training, fc.forecast(training, SETTINGS), fc.croston_forecast(training, SETTINGS),
               fc.changepoint_forecast(training, SETTINGS)):
        assert _count(df, "Exchange") == 1
        assert "Join" not in _plan(df)


def test_densify_needs_no_join(stored):
    dense = panel.densify(panel.daily_sales(stored), day(0), day(19))
    df = lc.add_lifecycle(lc.sales_columns(dense), SETTINGS)
    # One shuffle for the daily sums, spread over product and day, and one by product.
    assert _count(df, "Exchange") == 2
    assert "Join" not in _plan(df)
    assert "hashpartitioning(product_id" in _plan(df)


def test_direct_training_reads_its_columns_and_dates_only(spark, stored):
    df = tr.training_from_sales(stored, products(spark, "a", "b"), SETTINGS)
    scan = next(line for line in _plan(df).splitlines() if "FileScan" in line)
    assert "sales_amount" not in scan and "GreaterThanOrEqual(day" in scan
    assert _count(df, "Exchange") == 3  # daily buckets, products, and the product table


def test_products_meet_sales_on_the_partitioning_they_have(spark, sf_dir):
    df = fx.part_features(spark, sf_dir)
    assert "BroadcastExchange" not in _plan(df)
    assert _count(df, "Exchange") == 3  # daily sums, sales by product, products


def test_the_calendar_carries_no_hint(spark, stored):
    rows = lc.sales_columns(stored)
    flags = spark.createDataFrame([(day(1), 1)], "date date, EID_FITR_DAY_0 int")
    assert "Broadcast" not in _plan(cal.join_flags(rows, flags))


def test_building_features_runs_no_job(spark, sf_dir):
    inputs = (fx.part_sales(spark, sf_dir), fx.part_products(spark, sf_dir), fx.calendar_effects(spark, sf_dir))
    tracker, group = spark.sparkContext.statusTracker(), "features"
    spark.sparkContext.setJobGroup(group, group)
    build_features(*inputs, fx.ITEM, fx.LABELS)
    assert list(tracker.getJobIdsForGroup(group)) == []


def test_parts_are_summed_by_day_before_they_meet_their_brand(spark, sf_dir):
    plan = _plan(fx.brand_sales(spark, sf_dir))
    join = re.search(r"(SortMergeJoin|ShuffledHashJoin)", plan)
    assert join and "partial_sum" in plan[join.end():]


def test_business_views_shuffle_dates_alone(stored):
    features = stored.select("product_id", F.col("day").alias("date"), F.col("units_sold").alias("sales_units"),
                             F.lit("04| Mature").alias("age_category"))
    forecast = stored.select("product_id", F.col("day").alias("date"), F.col("sales_amount").alias("forecast"))
    assert "hashpartitioning(product_id" not in _plan(ev.business_daily(features, forecast))
    scans = [line for line in _plan(ev.business_window(features, forecast, day(3), day(5))).splitlines() if "FileScan" in line]
    assert len(scans) == 2 and all("GreaterThanOrEqual(day" in scan and "LessThanOrEqual(day" in scan for scan in scans)
    assert "product_id" not in scans[0]


def test_missing_dates_are_distinct_before_the_join(spark, stored):
    flags = spark.createDataFrame([(day(1), 1)], "date date, EID_FITR_DAY_0 int")
    plan = _plan(cal.missing_dates(lc.sales_columns(stored), flags))
    join = re.search(r"LeftAnti", plan)
    assert join and "HashAggregate(keys=[date" in plan[join.end():]


def test_latest_run_does_not_shuffle_forecasts(spark, tmp_path):
    spark.createDataFrame([("a", day(0), 1.0, 1)], "product_id string, date date, forecast double, run_id int"
                          ).write.partitionBy("run_id").parquet(str(tmp_path / "runs"))
    df = rn.latest_run_per_date(spark.read.parquet(str(tmp_path / "runs")))
    assert "BroadcastHashJoin" in _plan(df)
    assert _count(df, "Exchange") == 1  # the maximum per date
    assert "product_id" not in _plan(df).split("BroadcastExchange")[1]


def test_scans_push_filters_and_prune_columns(spark, sf_dir):
    scan = next(line for line in _plan(QUERIES["scan_filtered"](spark, sf_dir)).splitlines()
                if "FileScan" in line)
    assert "GreaterThanOrEqual(l_shipdate" in scan and "LessThanOrEqual(l_shipdate" in scan
    assert "l_extendedprice" not in scan


def test_evaluation_bounds_reach_the_features(spark, stored):
    forecast = spark.createDataFrame(
        [("a", day(16), "s", "c", "a", "v", "croston", 1.0)],
        "product_id string, date date, style string, age_sales_category string, age_category string, "
        "sales_category string, forecast_method string, forecast double")
    features = stored.select("product_id", F.col("day").alias("date"), F.col("units_sold").alias("sales_units"))
    df = ev.evaluation_table(forecast, features, day(16), day(19))
    scan = next(line for line in _plan(df).splitlines() if "FileScan" in line)
    assert "GreaterThanOrEqual(day" in scan and "LessThanOrEqual(day" in scan


def test_worst_products_keeps_a_heap_per_task(spark, stored):
    df = ev.worst_products(stored.withColumn("error", F.col("sales_amount")))
    assert "TakeOrderedAndProject" in _plan(df)


def test_a_product_with_a_third_of_all_rows(spark):
    """Same results, and no task holds the hot product's raw rows."""
    hot = spark.range(0, 300_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("p"), F.col("id") % 500)).alias("product_id"),
        F.date_add(F.lit(day(0)), (F.col("id") % 16).cast("int")).alias("day"),
        F.lit(1).cast("long").alias("units_sold"), F.lit(1.0).alias("sales_amount"))
    daily = panel.daily_sales(hot)
    assert values(daily.where("product_id = 'hot'").agg(F.count("*"), F.sum("units_sold")), "count(1)",
                  "sum(units_sold)") == [(16, 100_000)]
    plan = _plan(daily)
    assert "partial_sum" in plan and re.search(r"hashpartitioning\(product_id#\d+, day#\d+", plan)
    training = tr.training_from_sales(hot, products(spark, "hot"), SETTINGS)
    assert training.where("product_id = 'hot'").agg(F.sum("y")).first()[0] == 100_000
