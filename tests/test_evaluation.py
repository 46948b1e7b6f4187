import math
import random

import pytest
from pyspark.sql import functions as F

from shelfcast.functions.accuracy import bin_table
from shelfcast.operators import evaluation as ev
from tests.helpers import day, values

BIAS_22, ERROR_22 = "22| > +100", "22| > +50"


def _scored(spark, rows):
    df = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)],
                               "i int, sales_units bigint, forecast double")
    return ev.add_bias_and_error(df).orderBy("i")


def test_bias_and_error_edges(spark):
    df = _scored(spark, [(10, None), (None, 5.0), (0, 0.0), (0, 1.0), (10, 0.0), (10, 20.0), (-2, 1.0)])
    bias = values(df, "bias")
    assert bias[0] is None and bias[1] == 0 and bias[2] == 0
    assert bias[3] == pytest.approx(100000) and bias[4:] == [-1.0, 1.0, 0.0]
    assert values(df, "bias_bin") == [BIAS_22, "12| 0 +10", "12| 0 +10", BIAS_22, "02| -100 -90", BIAS_22,
                                      "12| 0 +10"]
    assert values(df, "error_bin") == [ERROR_22, ERROR_22, "12| 0 +5", "12| 0 +5", "10| -10 -5",
                                       "14| +10 +15", "12| 0 +5"]


# The bins of both metrics, in order.
LABELS = {
    "bias": ["01| < -100", "02| -100 -90", "03| -90 -80", "04| -80 -70", "05| -70 -60", "06| -60 -50", "07| -50 -40",
             "08| -40 -30", "09| -30 -20", "10| -20 -10", "11| -10 0", "12| 0 +10", "13| +10 +20", "14| +20 +30",
             "15| +30 +40", "16| +40 +50", "17| +50 +60", "18| +60 +70", "19| +70 +80", "20| +80 +90", "21| +90 +100",
             "22| > +100"],
    "error": ["01| < -50", "02| -50 -45", "03| -45 -40", "04| -40 -35", "05| -35 -30", "06| -30 -25", "07| -25 -20",
              "08| -20 -15", "09| -15 -10", "10| -10 -5", "11| -5 0", "12| 0 +5", "13| +5 +10", "14| +10 +15",
              "15| +15 +20", "16| +20 +25", "17| +25 +30", "18| +30 +35", "19| +35 +40", "20| +40 +45", "21| +45 +50",
              "22| > +50"],
}


@pytest.mark.parametrize("method, first, step", [("bias", -100, 10), ("error", -50, 5)])
def test_every_bin_edge(spark, method, first, step):
    table = bin_table(method)
    assert [label for label, _, _ in table] == LABELS[method]
    assert table[0][1] == -math.inf and table[-1][2] == math.inf
    assert [start for _, start, _ in table[1:]] == [first + step * i for i in range(21)]
    assert all(end == start for (_, _, end), (_, start, _) in zip(table, table[1:]))
    # Just below and just above each edge, with an actual of 100 so that both metrics are exact.
    rows = [(100, 100.0 + first + step * i + shift) for i in range(21) for shift in (-0.5, 0.5)]
    assert values(_scored(spark, rows), f"{method}_bin") == [
        label for i in range(21) for label in LABELS[method][i:i + 2]]


def test_drop_unmatched(spark):
    df = spark.createDataFrame([(1, None), (None, 1.0), (1, 1.0)], "sales_units bigint, forecast double")
    assert ev.add_bias_and_error(df, drop_unmatched=True).count() == 1


def _evaluation(spark):
    return ev.add_bias_and_error(spark.createDataFrame(
        [("a", "STa", "02| Very Low", 10, 11.0), ("b", "STb", "02| Very Low", 30, 30.0),
         ("c", "STc", "03| Low", 60, 180.0)],
        "product_id string, style string, sales_category string, sales_units bigint, forecast double"))


def test_accuracy_distribution(spark):
    full = ev.accuracy_distribution(_evaluation(spark), "bias").collect()
    assert len(full) == 22 and sum(r.units_in_bin for r in full) == 100
    assert {r.good_percent for r in full} == {40.0}
    assert [r.bias_bin for r in full if r.is_good] == [
        "10| -20 -10", "11| -10 0", "12| 0 +10", "13| +10 +20", "14| +20 +30"]
    assert [r.bin_numeric_pos for r in full] == list(range(-10, 12))
    part = ev.accuracy_distribution(_evaluation(spark), "bias", sales_category="03| Low",
                                    thresholds=(0, 100)).collect()
    assert {r.good_percent for r in part} == {0.0}
    overlap = ev.accuracy_distribution(_evaluation(spark), "error", thresholds=(1, 1),
                                       include_partial_bins=True).collect()
    assert [r.error_bin for r in overlap if r.is_good] == ["11| -5 0", "12| 0 +5"]
    nothing = ev.accuracy_distribution(_evaluation(spark).limit(0), "bias").collect()
    assert len(nothing) == 22 and {(r.good_percent, r.percentage_of_target) for r in nothing} == {(0.0, 0.0)}
    with pytest.raises(ValueError):
        ev.accuracy_distribution(_evaluation(spark), "other")


def test_shares_add_up(spark):
    got = ev.attribute_distribution(_evaluation(spark), ["sales_category"]).collect()
    assert [(r.product_count, r.product_count_pct, r.total_sales_units_pct) for r in got] == [
        (2, 66.7, 40.0), (1, 33.3, 60.0)]


def test_worst_products_break_ties_by_product(spark):
    assert values(ev.worst_products(_evaluation(spark), 2), "product_id") == ["c", "a"]


def test_business_views_on_a_forecast_only_day(spark):
    features = spark.createDataFrame(
        [("a", day(0), 4, "04| Mature", "STa"), ("b", day(0), 0, "00| Draft", "STb")],
        "product_id string, date date, sales_units bigint, age_category string, style string")
    forecast = spark.createDataFrame(
        [("a", day(0), "croston", 5.0), ("a", day(1), "croston", 3.0)],
        "product_id string, date date, forecast_method string, forecast double")
    table = ev.validation_table(features, forecast)
    assert set(values(table, "product_id", "date", "style")) == {
        ("a", day(0), "STa"), ("a", day(1), "STa"), ("b", day(0), "STb")}
    assert values(ev.business_daily(features, forecast), "date", "sales_units", "forecast", "bias") == [
        (day(0), 4, 5.0, 0.25), (day(1), None, 3.0, None)]
    assert tuple(ev.business_window(features, forecast, day(0), day(1)).first()) == (4, 8.0, 4.0, 100.0)
    assert ev.business_window(features, forecast, day(1), day(1)).first().difference_pct is None
    by_age = {r.date: r for r in ev.products_by_age(features, forecast).collect()}
    assert by_age[day(0)]["04| Mature"] == 1 and by_age[day(1)]["04| Mature"] == 0
    # A product without a forecast goes to the last bins of the full table.
    lone = table.where("product_id = 'b'").first()
    assert (lone.bias_bin, lone.error_bin) == (BIAS_22, ERROR_22)


def test_category_performance(spark):
    low = _evaluation(spark).where("sales_category = '02| Very Low'")
    assert tuple(ev.category_performance(low).first()) == (2, 40, 41.0, 1.0)


def test_accuracy_by_category_equals_one_category_at_a_time(spark):
    ranges = {"02| Very Low": (5, 5), "03| Low": (0, 300)}
    for method in ("bias", "error"):
        for partial in (False, True):
            got = {}
            for row in ev.accuracy_by_category(_evaluation(spark), method, thresholds=ranges, include_partial_bins=partial).collect():
                got.setdefault(row.sales_category, []).append(tuple(row)[1:])
            for category, own in ranges.items():
                one = ev.accuracy_distribution(_evaluation(spark), method, sales_category=category, thresholds=own,
                                               include_partial_bins=partial)
                assert got[category] == [tuple(row) for row in one.collect()]
    plain = ev.accuracy_by_category(_evaluation(spark), "bias").where("sales_category = '02| Very Low'").collect()
    assert [tuple(r)[1:] for r in plain] == [
        tuple(r) for r in ev.accuracy_distribution(_evaluation(spark), "bias", sales_category="02| Very Low").collect()]
    with pytest.raises(ValueError):
        ev.accuracy_by_category(_evaluation(spark), "other")


def test_bitmaps_of_days_answer_for_any_window(spark):
    rng = random.Random(5)
    rows = [(f"p{rng.randrange(70_000)}", day(rng.randrange(6)), rng.choice(["00| Draft", "04| Mature", None])) for _ in range(100_000)]
    features = spark.createDataFrame([*rows, (None, day(0), "00| Draft"), ("p1", None, "00| Draft")],
                                     "product_id string, date date, age_category string")
    numbers = ev.product_numbers(features)
    got = sorted(values(numbers, "number"))
    assert got == list(range(len({r[0] for r in [*rows, ("p1",)]})))
    bitmaps = ev.age_bitmaps(features, numbers)
    assert bitmaps.count() <= 6 * 3 * 3  # three blocks of numbers
    for first, last in ((0, 5), (2, 3), (4, 4)):
        inside = F.col("date").between(F.lit(day(first)), F.lit(day(last)))
        want = features.where(inside & F.col("product_id").isNotNull()).groupBy("age_category").agg(F.countDistinct("product_id").alias("n"))
        united = ev.products_of(bitmaps.where(inside), "age_category")
        assert sorted(map(str, values(united, "age_category", "product_count"))) == sorted(map(str, values(want, "age_category", "n")))


def test_bitmaps_are_made_of_rows_that_have_met(spark):
    """No bitmap is shuffled: the rows of one are in one task before it is made."""
    features = spark.createDataFrame([(f"p{i}", day(i % 6), "04| Mature") for i in range(60)], "product_id string, date date, age_category string")
    plan = ev.age_bitmaps(features, ev.product_numbers(features))._jdf.queryExecution().executedPlan().toString().splitlines()
    partial = next(i for i, line in enumerate(plan) if "partial_bitmap_construct_agg" in line)
    made = next(i for i, line in enumerate(plan) if "functions=[bitmap_construct_agg" in line)
    assert made < partial and not any("Exchange" in line for line in plan[made:partial])
    assert "Exchange" in plan[partial + 1] or "Exchange" in plan[partial + 2]


def test_the_summary_reads_the_evaluation_once(spark, tmp_path):
    rows = [(f"p{i}", f"ST{i}", i % 3, float((7 * i) % 11), ["02| Very Low", "05| Medium"][i % 2]) for i in range(60)]
    scored = ev.add_bias_and_error(spark.createDataFrame(
        rows, "product_id string, style string, sales_units bigint, forecast double, sales_category string"))
    scored.write.parquet(str(tmp_path / "evaluation"))
    stored = spark.read.parquet(str(tmp_path / "evaluation"))
    summed = ev.summary(stored)
    plan = summed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1
    summed.write.parquet(str(tmp_path / "summary"))
    summed = spark.read.parquet(str(tmp_path / "summary"))
    for method in ("bias", "error"):
        for category in (None, "05| Medium"):
            want = ev.accuracy_distribution(stored, method, sales_category=category)
            assert ev.accuracy_of(summed, method, category).collect() == want.collect()
    total = summed.where("view = 'total'").first()
    assert (total.product_count, total.rows) == (60, 60)
    assert total.worst_product == values(ev.worst_products(stored, 1), "product_id")[0]
    by_category = {r.sales_category: r for r in summed.where("view = 'category'").collect()}
    perf = ev.category_performance(stored.where("sales_category = '05| Medium'"), "product_id").first()
    assert by_category["05| Medium"].product_count == perf.product_count and by_category["05| Medium"].forecast == pytest.approx(perf.forecast)
