import pytest
from pyspark.sql import functions as F

from shelfcast.functions import categories as labels
from shelfcast.operators import lifecycle as lc
from shelfcast.operators import panel
from shelfcast.settings import Settings
from tests.helpers import day, sales, values

SETTINGS = Settings(history_start=day(0), history_end=day(15))


def _features(spark, series, settings=SETTINGS):
    return lc.add_lifecycle(lc.sales_columns(sales(spark, {"a": series})), settings).orderBy("date")


def test_rows_before_the_first_sale(spark):
    df = _features(spark, [0, 0, 0, 3])
    assert values(df, "day_in_stock") == [-2, -1, 0, 1]
    assert values(df, "age_category") == ["01| New", "01| New", "00| Draft", "01| New"]
    assert values(df, "sales_category") == ["02| Very Low", "02| Very Low", "00| Draft", "02| Very Low"]


def test_strict_draft(spark):
    strict = Settings(history_start=day(0), history_end=day(15), strict_draft=True)
    assert values(_features(spark, [0, 0, 0, 3], strict), "age_category") == ["00| Draft"] * 3 + ["01| New"]


def test_never_sold_is_draft(spark):
    df = _features(spark, [0, 0, 0])
    assert set(values(df, "day_in_stock", "age_category", "age_sales_category")) == {
        (0, "00| Draft", "00| Draft_01| Low")}


def test_age_edges(spark):
    df = _features(spark, [1] * 31)
    ages = values(df, "age_category")
    assert [ages[d - 1] for d in (7, 8, 14, 15, 30, 31)] == [
        "01| New", "02| Launch", "02| Launch", "03| Growth", "03| Growth", "04| Mature"]


@pytest.mark.parametrize("recent, label, summary", [
    (0, "01| Dead", "01| Low"), (13, "02| Very Low", "01| Low"), (14, "03| Low", "01| Low"),
    (27, "03| Low", "01| Low"), (28, "04| Alive", "02| Medium"), (55, "04| Alive", "02| Medium"),
    (56, "05| Medium", "02| Medium"), (83, "05| Medium", "02| Medium"), (84, "06| Winning", "03| High"),
    (139, "06| Winning", "03| High"), (140, "07| High Winning", "03| High"),
    (None, "07| High Winning", "03| High")])
def test_sales_edges(spark, recent, label, summary):
    df = spark.createDataFrame([(5, recent)], "d int, r bigint").select(
        labels.sales_category(F.col("d"), F.col("r")).alias("s"))
    assert values(df.select("s", labels.summarized_sales_category(F.col("s")).alias("m")), "s", "m") == [
        (label, summary)]


def test_windows_count_rows(spark):
    df = _features(spark, list(range(1, 21)))
    assert values(df, "recent_sales_units")[-1] == sum(range(7, 21))
    assert values(df, "recent_sales_units")[:3] == [1, 3, 6]
    assert values(df, "cumulative_sales")[-1] == 210


def test_nan_units_become_null(spark):
    df = spark.createDataFrame([("a", day(0), float("nan"), 1.0), ("a", day(1), 2.0, 1.0)],
                               "product_id string, day date, units_sold double, sales_amount double")
    rows = lc.add_day_in_stock(lc.sales_columns(df)).orderBy("date")
    assert values(rows, "sales_units", "day_in_stock") == [(None, 0), (2.0, 1)]


def test_salary_period(spark):
    df = lc.add_salary_period(lc.sales_columns(sales(spark, {"a": [1] * 31})), SETTINGS)
    on = {row.date.day for row in df.where("SALARY_PERIOD = 1").collect()}
    assert on == {1, 2, 3, 4, 25, 26, 27, 28, 29, 30, 31}


def test_densify_fills_every_day_once(spark):
    sparse = spark.createDataFrame(
        [("a", day(2), 5, 1.5), ("a", day(4), 7, 2.5), ("b", day(0), 1, 1.0), ("c", day(9), 9, 9.0)],
        "product_id string, day date, units_sold bigint, sales_amount double")
    dense = panel.densify(sparse, day(0), day(6))
    assert values(dense.where("product_id = 'a'").orderBy("day"), "units_sold") == [0, 0, 5, 0, 7, 0, 0]
    assert values(dense.where("product_id = 'b'").orderBy("day"), "units_sold") == [1] + [0] * 6
    # Nothing of c lies in the range, but it is a product all the same.
    assert values(dense.where("product_id = 'c'").orderBy("day"), "units_sold") == [0] * 7
    assert dense.count() == 21
    catalogue = spark.createDataFrame([("a",), ("never",), ("never",)], "product_id string")
    wide = panel.densify(sparse, day(0), day(6), products=catalogue)
    assert wide.count() == 28 and values(wide.where("product_id = 'never'"), "units_sold") == [0] * 7
    assert sorted(map(str, wide.where("product_id <> 'never'").collect())) == sorted(map(str, dense.collect()))
    assert panel.density_check(dense).count() == 0
    assert values(panel.density_check(sparse), "product_id", "day_rows", "calendar_days") == [("a", 2, 3)]


def test_daily_sales_merges_a_day(spark):
    facts = spark.createDataFrame([("a", day(0), 1, 1.0), ("a", day(0), 2, 2.5), ("a", day(1), 4, 0.5)],
                                  "product_id string, day date, units_sold bigint, sales_amount double")
    assert values(panel.daily_sales(facts).orderBy("day"), "units_sold", "sales_amount") == [(3, 3.5), (4, 0.5)]


def test_daily_sales_keeps_ids_and_ignores_nan(spark):
    facts = spark.createDataFrame(
        [(9, "a", "s", day(0), 1.0, 1.0), (4, "a", "s", day(0), float("nan"), 2.0),
         (5, "a", "s", day(1), None, None)],
        "id bigint, product_id string, shopify_product_id string, day date, units_sold double, "
        "sales_amount double")
    rows = panel.daily_sales(facts).orderBy("day")
    assert values(rows, "id", "shopify_product_id", "units_sold", "sales_amount") == [
        (4, "s", 1.0, 3.0), (5, "s", None, None)]


def test_settings_refuse_bad_values():
    for bad in (dict(history_start=day(5), history_end=day(5)), dict(horizon_days=0),
                dict(zero_ratio_threshold=1.5), dict(history_end="2024-13-01"), dict(lifecycle={})):
        with pytest.raises(ValueError):
            Settings(**bad)
    settings = Settings(history_start="2025-04-21", history_end="2025-10-16")
    assert str(settings.forecast_start) == "2025-10-17" and str(settings.forecast_end) == "2025-10-30"
    assert settings.longest_look_back == 60 and len(settings.all_regressors) == 11
