from shelfcast.functions.categories import numeric_or_zero
from shelfcast.operators import calendar as cal
from shelfcast.operators import evaluation as ev
from shelfcast.operators import features as ft
from shelfcast.operators import lifecycle as lc
from shelfcast.operators.forecast import known_regressors
from shelfcast.settings import Settings
from tests.helpers import day, products, sales, values
import pytest
from pyspark.sql import functions as F

SCHEMA = ("calendar_effect string, calendar_effect_desc string, calendar_effect_type string, "
          "date date, start_date date, end_date date")
SETTINGS = Settings(history_start=day(0), history_end=day(15))


def _effects(spark):
    def row(kind, *dates):
        return (kind, "", kind, *dates)

    return spark.createDataFrame([
        row("NATIONAL_DAY", day(9), day(8), day(10)),
        row("WHITE_FRIDAY", day(11), day(10), day(12)),
        row("NATIONAL_DAY", None, day(14), day(14)),
        row("NATIONAL_DAY", day(24), None, day(24)),
        row("NATIONAL_DAY", day(27), day(28), day(26)),
    ], SCHEMA)


def _labelled(spark):
    return cal.label_effect_days(cal.effect_days(_effects(spark)))


def test_ranges_expand_and_bad_ones_vanish(spark):
    got = set(values(_labelled(spark), "date", "day_offset", "calendar_effect_day"))
    assert got == {
        (day(8), -1, "NATIONAL_DAY_DAY_MINUS_1"), (day(9), 0, "NATIONAL_DAY_DAY_0"),
        (day(10), 1, "NATIONAL_DAY_DAY_PLUS_1"), (day(10), -1, "WHITE_FRIDAY_DAY_MINUS_1"),
        (day(11), 0, "WHITE_FRIDAY_DAY_0"), (day(12), 1, "WHITE_FRIDAY_DAY_PLUS_1")}


def test_flags_cover_every_sales_date(spark):
    labels = cal.distinct_labels(_labelled(spark))
    assert len(labels) == 6
    rows = lc.sales_columns(sales(spark, {"a": [1] * 16, "b": [0] * 16}))
    flags = cal.pivot_flags(_labelled(spark), labels)
    by_date = cal.flags_by_date(rows, flags)
    assert by_date.count() == 16
    overlap = by_date.where(F.col("date") == day(10)).first()
    assert overlap.NATIONAL_DAY_DAY_PLUS_1 == 1 and overlap.WHITE_FRIDAY_DAY_MINUS_1 == 1
    assert overlap.NATIONAL_DAY_DAY_0 == 0
    assert set(values(cal.missing_dates(rows, flags), "date")) == {
        day(i) for i in range(16) if i not in (8, 9, 10, 11, 12)}
    assert cal.missing_dates(rows, flags, 5).count() == 5


def test_too_many_flags_are_an_error(spark):
    years = spark.createDataFrame([("EID_FITR", "", "EID_FITR", day(0), day(0), day(900))],
                                  "calendar_effect string, calendar_effect_desc string, calendar_effect_type "
                                  "string, date date, start_date date, end_date date")
    with pytest.raises(ValueError):
        cal.distinct_labels(cal.label_effect_days(cal.effect_days(years)))


def test_features_without_calendar_or_with_an_unknown_product(spark):
    table = sales(spark, {"a": [1] * 3, "x": [1] * 3})
    plain = ft.build_features(table, products(spark, "a"), None, SETTINGS)
    assert set(values(plain, "product_id", "style")) == {("a", "STa"), ("x", None)}
    empty = ft.build_features(table, products(spark, "a"), _effects(spark).limit(0), SETTINGS)
    assert empty.columns == plain.columns
    assert ft.feature_totals(plain.limit(0)).first() == (0, 0)


def test_active_effects(spark):
    built = ft.build_features(sales(spark, {"a": [1] * 16, "b": [1] * 16}), products(spark, "a", "b"),
                              _effects(spark), SETTINGS)
    points = values(ev.active_effects(built, ["STa"]), "style", "date", "effect")
    assert set(points) == {("STa", day(9), "NATIONAL_DAY_DAY_0"), ("STa", day(11), "WHITE_FRIDAY_DAY_0"),
                           *(("STa", day(i), "SALARY_PERIOD") for i in range(4))}


def test_numeric_or_zero(spark):
    df = spark.createDataFrame([("1.5",), ("x",), (None,), ("NaN",), ("-2",)], "v string")
    assert values(df.select(numeric_or_zero(F.col("v")).alias("n")), "n") == [1.5, 0.0, 0.0, 0.0, -2.0]


def test_any_number_of_flags_fits_one_column(spark):
    """Five thousand flags, no job to name them while the plan is built, and both forms say the same of the few that both have."""
    effects = spark.range(5000).select(
        F.concat(F.lit("KIND"), "id").alias("calendar_effect"), F.concat(F.lit("KIND"), "id").alias("calendar_effect_type"),
        F.date_add(F.lit(day(0)), (F.col("id") % 30).cast("int")).alias("date")).withColumns(
        {"start_date": F.col("date"), "end_date": F.date_add("date", 1)})
    labelled = cal.label_effect_days(cal.effect_days(effects))
    with pytest.raises(ValueError, match="sparse_flags"):
        cal.distinct_labels(labelled)
    sold = spark.createDataFrame([(day(i), i) for i in (0, 3, 31, 40)], "date date, n int")
    joined = cal.join_sparse_flags(sold, cal.sparse_flags(labelled))
    sizes = dict(values(joined.select("n", F.size("flags").alias("size")), "n", "size"))
    assert sizes[40] == 0 and sizes[31] == 0 and sizes[0] == len(range(0, 5000, 30)) and sizes[3] == 2 * sizes[0]
    names = ["KIND3_DAY_0", "KIND2_DAY_PLUS_1", "KIND4_DAY_0", "NONE_DAY_0"]
    wide = cal.flag_columns(joined, names)
    assert "flags" not in wide.columns and wide.schema["NONE_DAY_0"].dataType.simpleString() == "int"
    assert sorted(values(wide, "n", *names)) == [(0, 0, 0, 0, 0), (3, 1, 1, 0, 0), (31, 0, 0, 0, 0), (40, 0, 0, 0, 0)]
    few = cal.join_flags(sold, cal.pivot_flags(labelled, names[:3]))
    assert sorted(values(few, "n", *names[:3])) == sorted(values(wide, "n", *names[:3]))


def test_regressors_and_active_effects_read_either_form(spark):
    effects = spark.createDataFrame([("EID_FITR", "EID_FITR", day(4), day(3), day(5)), ("ARAFAT_DAY", "ARAFAT_DAY", day(4), day(4), day(4))],
                                    "calendar_effect string, calendar_effect_type string, date date, start_date date, end_date date")
    settings = Settings(history_start=day(0), history_end=day(15))
    labelled = cal.label_effect_days(cal.effect_days(effects))
    wide, narrow = cal.pivot_flags(labelled, cal.distinct_labels(labelled)), cal.sparse_flags(labelled)
    assert sorted(map(str, known_regressors(wide, settings).collect())) == sorted(map(str, known_regressors(narrow, settings).collect()))
    rows = sales(spark, {"a": [1] * 16})
    both = [ft.build_features(rows, products(spark, "a"), effects, settings, sparse=sparse) for sparse in (False, True)]
    found = [sorted(map(str, ev.active_effects(features).collect())) for features in both]
    assert found[0] == found[1] and any("ARAFAT_DAY_DAY_0" in row for row in found[0])
