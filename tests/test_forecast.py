import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from catalog import fixtures as fx
from shelfcast.operators import changepoint
from shelfcast.operators import eligibility as el
from shelfcast.operators import forecast as fc
from shelfcast.operators import panel
from shelfcast.operators import training as tr
from shelfcast.operators.changepoint import EPOCH, RegressorDays, fit_block
from shelfcast.operators.features import build_features
from shelfcast.plans.daily import forecast_demand
from shelfcast.settings import Settings
from tests.helpers import day, products, sales, values

SETTINGS = Settings(history_start=day(0), history_end=day(15))


def _features(spark, series, settings=SETTINGS):
    return build_features(sales(spark, series), products(spark, *series), None, settings)


def _training(spark, series, settings=SETTINGS):
    history = el.history_cut(_features(spark, series, settings), settings)
    return tr.training_window(el.qualified_history(history, settings), settings)


def _training_rows(spark, series, factor=1.0):
    rows = [(name, "c", "a", "s", "ST", 60, factor, 1, 0.05, day(i), y, i, len(ys))
            for name, ys in series.items() for i, y in enumerate(ys)]
    return spark.createDataFrame(
        rows, "product_id string, on_forecast_age_sales_category string, on_forecast_age_category string, "
              "on_forecast_sales_category string, style string, look_back int, "
              "over_forecast_factor double, changepoints int, changepoint_prior double, date date, "
              "y bigint, t int, n int")


def test_croston_branches(spark):
    loose = Settings(history_start=day(0), history_end=day(15), min_observations=1)
    series = {"zero": [0, 0, 0], "first": [5, 0, 0], "one": [0, 0, 4], "two": [2, 0, 0, 4]}
    got = dict(values(fc.croston_forecast(_training_rows(spark, series), loose).where(
        F.col("date") == F.lit(day(16))), "product_id", "forecast"))
    assert got == pytest.approx({"zero": 0, "first": 0, "one": 4 / 3 * 0.8, "two": 3 / 3 * 0.8})


# Worked by hand: mean demand / mean interval * 0.8 * 1.3.  Intervals end at demand rows after the first row.
CROSTON_CASES = {
    "every_row": ([4] * 8, 4 / 1 * 0.8 * 1.3),
    "every_other": ([0, 6] * 5, 6 / (9 / 5) * 0.8 * 1.3),
    "from_the_first": ([3, 0, 0, 5, 0, 0, 0, 7], 5 / 3.5 * 0.8 * 1.3),
    "uneven": ([0, 0, 2, 0, 4, 0, 0, 0, 0, 9], 5 / 3 * 0.8 * 1.3),
    "one_late": ([0] * 9 + [8], 8 / 10 * 0.8 * 1.3),
    "first_row_only": ([8] + [0] * 9, 0.0),
    "first_and_last": ([1] + [0] * 8 + [3], 2 / 9 * 0.8 * 1.3),
}


def test_croston_against_series_worked_by_hand(spark):
    out = fc.croston_forecast(_training_rows(spark, {k: y for k, (y, _) in CROSTON_CASES.items()}, 1.3), SETTINGS)
    got = {p: f for p, f in values(out, "product_id", "forecast")}
    assert got == pytest.approx({k: value for k, (_, value) in CROSTON_CASES.items()})
    assert out.count() == len(CROSTON_CASES) * 14


def test_zero_ratio_counts_null_rows_in_the_denominator(spark):
    series = {"a": [0] * 10 + [None] * 4 + [1] * 6}
    # The last 14 rows: four zeros, four nulls, six ones.
    assert values(fc.zero_ratios(_training_rows(spark, series), SETTINGS), "zero_ratio") == [4 / 14]


def test_method_threshold_is_inclusive(spark):
    series = {"at": [0] * 6 + [1] * 4, "below": [0] * 5 + [1] * 5}
    got = dict(values(fc.zero_ratios(_training_rows(spark, series), SETTINGS), "product_id", "forecast_method"))
    assert got == {"at": "croston", "below": "trend_weekday"}


def test_too_short_series_get_no_forecast(spark):
    rows = _training_rows(spark, {"seven": [1] * 7, "eight": [1] * 8})
    assert values(fc.skipped_products(rows, SETTINGS), "product_id", "training_rows") == [("seven", 7)]
    for method in (fc.forecast, fc.croston_forecast, fc.trend_weekday_forecast, fc.changepoint_forecast):
        assert {r.product_id for r in method(rows, SETTINGS).collect()} == {"eight"}


def test_launch_high_is_never_forecast(spark):
    rows = _training(spark, {"a": [0] * 4 + [20] * 12})
    assert values(rows, "on_forecast_age_sales_category")[0] == "02| Launch_03| High"
    assert fc.forecast(rows, SETTINGS).count() == 0
    assert values(fc.skipped_products(rows, SETTINGS), "training_rows") == [7]


def test_excluded_products_and_a_product_without_an_end_row(spark):
    series = {"new": [0] * 12 + [1] * 4, "dead": [3] + [0] * 15, "draft": [0] * 16, "good": [1] * 16}
    history = el.history_cut(_features(spark, series), SETTINGS).where(
        (F.col("product_id") != "good") | (F.col("date") <= F.lit(day(15))))
    gone = _features(spark, {"gone": [1] * 10}).select(*history.columns)
    both = history.unionByName(gone)
    assert set(values(el.non_eligible_products(both, SETTINGS), "product_id")) == {"new", "dead", "draft"}
    assert set(values(el.eligible_history(both, SETTINGS), "product_id")) == {"good", "gone"}
    qualified = el.qualified_history(both, SETTINGS)
    assert set(values(qualified, "product_id")) == {"good"}
    assert qualified.columns.count("style") == 1


def test_unknown_category_takes_the_fallback_rule(spark):
    df = spark.createDataFrame([("nobody",), ("03| Growth_02| Medium",)],
                               "on_forecast_age_sales_category string")
    got = values(tr.with_rules(df, SETTINGS), "look_back", "over_forecast_factor", "changepoints",
                 "changepoint_prior")
    assert got == [(60, 1.1, 25, 0.05), (30, 1.3, 3, 0.05)]


def test_trend_recovers_a_line_and_a_weekly_season(spark):
    line = {"a": [10 + i for i in range(10)]}
    got = values(fc.trend_weekday_forecast(_training_rows(spark, line), Settings(
        history_start=day(0), history_end=day(9))).orderBy("date"), "forecast")
    assert got == pytest.approx([20 + i for i in range(14)])
    weekly = [70, 10, 10, 10, 10, 10, 10] * 4
    settings = Settings(history_start=day(0), history_end=day(27))
    got = values(fc.trend_weekday_forecast(_training_rows(spark, {"a": weekly}), settings).orderBy("date"),
                 "forecast")
    assert np.argmax(got[:7]) == 0 and got[0] > 4 * got[1]


def test_forecasts_are_not_negative(spark):
    falling = {"a": [60 - 3 * i for i in range(20)]}
    settings = Settings(history_start=day(0), history_end=day(19))
    for method in (fc.trend_weekday_forecast, fc.changepoint_forecast):
        got = values(method(_training_rows(spark, falling), settings), "forecast")
        assert len(got) == 14 and min(got) == 0


def test_direct_training_equals_the_dense_path(spark):
    rng = random.Random(3)
    settings = Settings(history_start=day(0), history_end=day(89))
    facts = []
    for p in range(60):
        first, rate = rng.randint(0, 95), rng.choice([0.02, 0.2, 0.7, 2.5])
        for d in range(first, 100):
            for _ in range(rng.randint(0, 3)):
                if rng.random() < rate:
                    facts.append((f"p{p}", day(d), rng.randint(0, 6), 1.0))
    table = spark.createDataFrame(
        facts, "product_id string, day date, units_sold bigint, sales_amount double")
    known = products(spark, *[f"p{p}" for p in range(50)])
    dense = panel.densify(panel.daily_sales(table), day(0), day(99))
    history = el.history_cut(build_features(dense, known, None, settings), settings)
    expected = tr.training_window(el.qualified_history(history, settings), settings)
    direct = tr.training_from_sales(table, known, settings)
    assert expected.count() > 0
    assert sorted(map(str, direct.select(*expected.columns).collect())) == sorted(map(str, expected.collect()))


def test_regressors_carry_forward(spark):
    history = spark.createDataFrame([("a", day(0), 1, "1"), ("a", day(1), 0, "x"), ("b", day(0), 1, "1")],
                                    "product_id string, date date, SALARY_PERIOD int, EID_FITR_DAY_0 string")
    out = fc.carry_regressors(history, SETTINGS)
    assert out.count() == 28
    assert set(values(out, "product_id", "SALARY_PERIOD", "EID_FITR_DAY_0", "ARAFAT_DAY_DAY_0")) == {
        ("a", 0.0, 0.0, 0.0), ("b", 1.0, 1.0, 0.0)}


def test_forecast_demand_has_fourteen_days_per_product(spark):
    series = {f"p{i}": [i % 4] * 16 for i in range(1, 9)}
    for model in ("trend_weekday", "changepoint"):
        out = forecast_demand(_features(spark, series), SETTINGS, model).toPandas()
        assert list(out.columns) == list(fc.FORECAST_COLUMNS)
        assert set(out.groupby("product_id").size()) == {14}
        assert str(out.date.min()) == str(SETTINGS.forecast_start)
    empty = forecast_demand(_features(spark, {"a": [0] * 16}), SETTINGS)
    assert empty.count() == 0 and empty.columns == list(fc.FORECAST_COLUMNS)


def _both_trainings(spark, facts, settings):
    """Training rows by the dense path and straight from the facts."""
    table = spark.createDataFrame(facts, "product_id string, day date, units_sold double, sales_amount double")
    known = products(spark, *{f[0] for f in facts})
    dense = panel.densify(panel.daily_sales(table), settings.history_start, settings.history_end)
    history = el.history_cut(build_features(dense, known, None, settings), settings)
    expected = tr.training_window(el.qualified_history(history, settings), settings)
    direct = tr.training_from_sales(table, known, settings).select(*expected.columns)
    return (sorted(map(str, df.withColumn("y", F.col("y").cast("double")).collect())) for df in (expected, direct))


@pytest.mark.parametrize("odd", [None, float("nan")])
def test_direct_training_keeps_stored_nulls_and_drops_nan(spark, odd):
    settings = Settings(history_start=day(0), history_end=day(29))
    facts = [("a", day(i), odd if i in (3, 20, 27) else float(1 + i % 4), 1.0) for i in range(30)]
    facts += [("b", day(i), 5.0, 1.0) for i in range(0, 30, 2)] + [("b", day(4), odd, 1.0), ("b", day(5), odd, 1.0)]
    # Only nulls among the recent days.
    facts += [("c", day(i), 2.0 if i < 16 else odd, 1.0) for i in range(30)]
    expected, direct = _both_trainings(spark, facts, settings)
    assert expected == direct and any("y=None" in row for row in direct)
    forecast = fc.forecast(tr.training_from_sales(
        spark.createDataFrame(facts, "product_id string, day date, units_sold double, sales_amount double"),
        products(spark, "a", "b", "c"), settings), settings)
    assert forecast.where("isnan(forecast)").count() == 0 and forecast.count() > 0


def test_the_trend_goes_by_dates(spark):
    line = {"a": [10 + i for i in range(30)]}
    late = Settings(history_start=day(0), history_end=day(29), forecast_start=day(37))
    for method in (fc.trend_weekday_forecast, fc.changepoint_forecast):
        got = values(method(_training_rows(spark, line).withColumn("changepoints", F.lit(0)), late).orderBy("date"), "forecast")
        assert got == pytest.approx([47 + i for i in range(14)], rel=1e-3)
    # Every third day: the slope is per day and not per row.
    sparse = _training_rows(spark, {"a": [10 + 3 * i for i in range(10)]}).withColumn(
        "date", F.date_add(F.lit(day(0)), 3 * F.col("t")))
    settings = Settings(history_start=day(0), history_end=day(27))
    got = values(fc.trend_weekday_forecast(sparse.withColumn("n", F.lit(10)), settings).orderBy("date"), "forecast")
    assert got == pytest.approx([38 + i for i in range(14)])


def test_a_forecast_cannot_start_within_the_history():
    for start in (day(15), day(3)):
        with pytest.raises(ValueError):
            Settings(history_start=day(0), history_end=day(15), forecast_start=start)


def test_regressor_days_outside_their_table_are_zero():
    table = RegressorDays(100, np.arange(1, 6, dtype=float)[:, None], {"c": [0]})
    assert table.of("c", np.array([98, 99, 100, 104, 105]))[:, 0].tolist() == [0, 0, 1, 5, 0]


def test_the_solver_needs_no_package_on_the_workers():
    import pickle
    import subprocess
    import sys

    from pyspark import cloudpickle

    from shelfcast.operators import changepoint

    blob = cloudpickle.dumps(changepoint.fit_block)
    code = ("import pickle, sys, numpy as np; f = pickle.loads(bytes.fromhex(sys.stdin.read())); "
            "print(f(np.arange(8.0)[None] + 1, np.arange(8), 0, 0.1, np.array([8]))[0, 0].round(3))")
    out = subprocess.run([sys.executable, "-I", "-c", code], input=blob.hex(), capture_output=True, text=True, cwd="/",
                         timeout=120)
    assert out.stdout.strip() == "9.0", out.stderr
    assert pickle.loads(blob) is not None


def test_fit_block_follows_a_bend_and_a_week():
    days = np.arange(60)
    bend = np.where(days < 30, 10.0, 10.0 + (days - 30)) * (1 + 0.3 * np.sin(2 * np.pi * days / 7))
    future = np.arange(60, 74)
    got = fit_block(bend[None, :], days, 8, 0.5, future)[0]
    want = (10.0 + (future - 30)) * (1 + 0.3 * np.sin(2 * np.pi * future / 7))
    assert np.abs(got / want - 1).max() < 0.15
    stiff = fit_block(bend[None, :], days, 8, 0.0001, future)[0]
    assert stiff[-1] < got[-1]  # a small prior keeps the line straight


def test_regressors_reach_the_model_only_when_given(spark):
    settings = Settings(history_start=day(0), history_end=day(59), use_regressors=True)
    flagged = {day(i) for i in (5, 20, 33, 47, 64)}  # the last one lies in the horizon
    flags = spark.createDataFrame([(d, 1) for d in flagged], "date date, EID_FITR_DAY_0 int")
    days = fc.known_regressors(flags, settings)
    assert days.count() == 74 and days.where("EID_FITR_DAY_0 = 1").count() == 5
    assert days.where("SALARY_PERIOD = 1").count() > 0
    units = [30 if day(i) in flagged else 10 for i in range(60)]
    rows = _training_rows(spark, {"a": units}).withColumn(
        "on_forecast_age_sales_category", F.lit("04| Mature_02| Medium"))
    without = dict(values(fc.changepoint_forecast(rows, settings), "date", "forecast"))
    seen = dict(values(fc.changepoint_forecast(rows, settings, days), "date", "forecast"))
    assert seen[day(64)] > 25 and without[day(64)] < 20
    assert seen[day(65)] == pytest.approx(10, rel=0.15)
    # A category without regressors ignores them.
    low = rows.withColumn("on_forecast_age_sales_category", F.lit("03| Growth_01| Low"))
    assert dict(values(fc.changepoint_forecast(low, settings, days), "date", "forecast")) == pytest.approx(without)


def _fit_one(y, days, future, changepoints, prior):
    """The same model for one series, by stacked least squares instead of normal equations."""
    def solve(x, penalties, target):
        rows = np.vstack([x, np.diag(np.sqrt(penalties))])
        return np.linalg.lstsq(rows, np.concatenate([target, np.zeros(len(penalties))]), rcond=None)[0]

    n, span, top = len(y), days[-1] - days[0], max(abs(v) for v in y)
    rows = int(n * 0.8)
    places = [days[int(round(i * (rows - 1) / min(changepoints, rows - 1)))]
              for i in range(1, min(changepoints, rows - 1) + 1)]

    def trend_row(d):
        return [1.0, (d - days[0]) / span] + [max(d - p, 0) / span for p in places]

    def week_row(d):
        return [f(2 * np.pi * d * k / 7) for f in (np.sin, np.cos) for k in (1, 2, 3)]

    x, w = np.array([trend_row(d) for d in days]), np.array([week_row(d) for d in days])
    target, seasonal = np.array(y) / top, span + 1 >= 14
    week = np.zeros(6)
    for _ in range(6 if seasonal else 1):
        trend = solve(x * (1 + w @ week)[:, None],
                      np.array([1e-8, 1e-8] + [1 / prior ** 2 / n] * len(places)), target)
        if seasonal:
            week = solve(w * (x @ trend)[:, None], np.full(6, 0.01), target - x @ trend)
    return [float(np.dot(trend_row(d), trend) * (1 + np.dot(week_row(d), week)) * top) for d in future]


def test_changepoint_model_against_one_series_at_a_time(spark):
    rng = random.Random(11)
    series = {f"p{i}": [rng.randint(1, 30) for _ in range(n)]
              for i, n in enumerate([8, 10, 13, 14, 20, 30, 60, 60])}
    # One system of equations for each product: bends with a normal prior.
    settings = Settings(history_start=day(0), history_end=day(60), changepoint_penalty="ridge")
    rows = _training_rows(spark, series, 1.15).withColumn("changepoints", F.lit(4))
    got = {}
    for product, value in values(fc.changepoint_forecast(rows, settings).orderBy("product_id", "date"),
                                 "product_id", "forecast"):
        got.setdefault(product, []).append(value)
    epoch = (day(0) - EPOCH).days
    future = range(epoch + 61, epoch + 75)
    for product, y in series.items():
        days = list(range(epoch, epoch + len(y)))
        want = [max(v * 1.15, 0) for v in _fit_one(y, days, future, 4, 0.05)]
        assert got[product] == pytest.approx(want, rel=1e-5, abs=1e-5), product


def test_changepoint_model_leaves_out_rows_without_units(spark):
    settings = Settings(history_start=day(0), history_end=day(20))
    # With a line and no season, the gap must not bend the fit.
    rows = _training_rows(spark, {"gap": [5, 6, 7, None, 9, 10, 11, None, 13, 14]}).withColumn(
        "changepoints", F.lit(0))
    assert values(fc.changepoint_forecast(rows, settings).orderBy("date"), "forecast")[0] == pytest.approx(26)
    nothing = _training_rows(spark, {"none": [None] * 10})
    assert set(values(fc.changepoint_forecast(nothing, settings), "forecast_method", "forecast")) == {
        ("croston", 0.0)}


def _optimal(gram, moment, weight, found) -> float:
    """By how much the worst coefficient misses the conditions under which none can be improved, in parts of the moments."""
    slope = moment - np.einsum("sij,sj->si", gram, found)
    miss = np.where(found != 0, np.abs(slope - weight[:, None] * np.sign(found)), np.maximum(np.abs(slope) - weight[:, None], 0))
    return float((miss.max(axis=1) / np.maximum(np.abs(moment).max(axis=1), weight)).max())


def test_sparse_bends_cannot_be_improved():
    rng = np.random.default_rng(3)
    for terms in (1, 2, 8, 25):
        rows = 60
        x = np.linspace(0, 1, rows)
        hinges = np.maximum(x[:, None] - np.linspace(0, 0.8, terms + 1)[1:], 0)
        hinges = hinges - np.column_stack([np.ones(rows), x]) @ np.linalg.lstsq(np.column_stack([np.ones(rows), x]), hinges, rcond=None)[0]
        y = rng.normal(size=(200, rows)).cumsum(axis=1)
        gram, moment = np.repeat((hinges.T @ hinges)[None], 200, axis=0), y @ hinges
        weight = np.abs(moment).max(axis=1) * rng.choice([0.0, 0.01, 0.3, 0.9, 1.5], size=200)
        found = changepoint.lasso(gram, moment, weight)
        assert _optimal(gram, moment, weight, found) < 1e-6
        assert (found[weight > np.abs(moment).max(axis=1)] == 0).all()


def test_no_bend_of_any_product_can_be_improved(spark, sf_dir, monkeypatch):
    training = tr.training_from_sales(fx.part_facts(spark, sf_dir), fx.part_products(spark, sf_dir), fx.ITEM)
    rows = training.where("n >= 8").groupBy("product_id", "changepoints", "changepoint_prior").agg(
        F.sort_array(F.collect_list(F.struct("t", "y", F.unix_date("date").alias("day")))).alias("s")).collect()
    seen = []
    solve = changepoint.lasso

    def checked(gram, moment, weight):
        found = solve(gram, moment, weight)
        seen.append(_optimal(gram, moment, weight, found))
        return found

    monkeypatch.setattr(changepoint, "lasso", checked)
    for row in rows:
        y = np.array([[float(p.y) for p in row.s]])
        if y.any():
            days = np.array([p.day for p in row.s])
            out = changepoint.fit_block(y, days, row.changepoints, row.changepoint_prior, days[-1] + np.arange(1, 15))
            assert np.isfinite(out).all()
    assert len(seen) > 100 and max(seen) < 1e-6


def test_a_sparse_trend_keeps_one_bend_and_drops_the_others():
    days = np.arange(60)
    rng = np.random.default_rng(5)
    bent = 20 + np.maximum(days - 30, 0) * 1.0 + rng.normal(size=(1, 60)) * 0.1
    straight = 20 + 0.5 * days[None, :] + rng.normal(size=(1, 60)) * 0.1
    counts = []
    solve = changepoint.lasso
    try:
        changepoint.lasso = lambda *args: counts.append((solve(*args) != 0).sum()) or solve(*args)
        ahead = changepoint.fit_block(bent, days, 8, 0.1, days[-1] + np.arange(1, 15))
        assert ahead[0, 13] == pytest.approx(20 + 43, rel=0.05)
        assert counts[-1] <= 4
        # Noise alone makes no bend where the prior is tight.
        ahead = changepoint.fit_block(straight, days, 8, 0.001, days[-1] + np.arange(1, 15))
        assert counts[-1] == 0 and ahead[0, 13] == pytest.approx(20 + 0.5 * 73, rel=0.01)
    finally:
        changepoint.lasso = solve


def test_hand_made_flags_lift_their_days(spark):
    """A flag that doubles sales on its days doubles the forecast on the one that is planned, and on no other."""
    flags = set(range(3, 64, 5))  # every weekday alike
    units = [20 if i in flags else 10 for i in range(60)]
    settings = Settings(history_start=day(0), history_end=day(59), use_regressors=True)
    table = spark.createDataFrame([(day(i), 1) for i in flags], "date date, EID_FITR_DAY_0 int")
    training = _training(spark, {"a": units}, settings)
    plain = values(fc.changepoint_forecast(training, settings).orderBy("date"), "forecast")
    known = values(fc.changepoint_forecast(training, settings, fc.known_regressors(table, settings)).orderBy("date"), "forecast")
    factor = 1.3
    assert known[3] == pytest.approx(20 * factor, rel=0.1)
    assert [known[i] for i in range(14) if i != 3] == pytest.approx([10 * factor] * 13, rel=0.1)
    assert plain[3] < 15 * factor
