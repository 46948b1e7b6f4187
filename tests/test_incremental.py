"""Features from a state and new days, and the snapshots that hold them."""

import random
import threading

import pytest
from pyspark.sql import functions as F

from shelfcast.operators import incremental as inc
from shelfcast.operators.features import build_features
from shelfcast.operators.lifecycle import add_lifecycle, sales_columns
from shelfcast.operators.panel import daily_sales
from shelfcast.plans import daily
from shelfcast.session import shared_path
from shelfcast.settings import Settings
from shelfcast.sources import feature_store, files, tables
from tests.helpers import day, products, values

SETTINGS = Settings(history_start=day(0), history_end=day(60))
FACTS = "product_id string, day date, units_sold bigint, sales_amount double"


def _facts(spark, rows):
    return spark.createDataFrame(rows, FACTS)


def _rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def _random_facts(seed: int):
    """Facts with the run that first sees them: products of every kind, late facts, days with several facts, null units."""
    rng = random.Random(seed)
    facts = []
    for p in range(40):
        start, rate = rng.randint(0, 70), rng.choice([0.05, 0.4, 1.0, 2.0])
        for d in range(start, 80):
            for _ in range(rng.choice([0, 1, 1, 2]) if rate < 2 else 1):
                units = rng.choice([0, 0, 1, 5, None]) if rng.random() < rate else 0
                run = 0 if d < 50 else 1 if d < 60 else 2 if d < 61 else 3
                if rng.random() < 0.01:
                    run = rng.randint(run, 3)  # late
                facts.append((run, (f"p{p}", day(d), units, None if units is None else units * 2.0)))
    facts += [(0, ("unsold", day(d), 0, 0.0)) for d in range(40, 50)] + [(2, ("unsold", day(60), 3, 6.0))]
    facts += [(0, ("quiet", day(d), 0, 0.0)) for d in range(0, 3)] + [(3, ("quiet", day(75), 0, 0.0))]
    facts += [(3, ("first", day(2), 9, 18.0))]
    return facts


@pytest.mark.parametrize("sparse", [False, True])
def test_increments_equal_the_whole(spark, sparse):
    facts, path = _random_facts(7), shared_path(spark, "features")
    known = products(spark, *[f"p{i}" for i in range(30)], "unsold")
    effects = spark.createDataFrame([("EID_FITR", "EID_FITR", day(d), day(d - 1), day(d + 1)) for d in (10, 49, 61, 77)],
                                    "calendar_effect string, calendar_effect_type string, date date, start_date date, end_date date")
    by_run = [_facts(spark, [fact for run, fact in facts if run == number]) for number in range(4)]
    daily.build_all(spark, by_run[0], known, effects, path, SETTINGS, keep_state=True, sparse=sparse)
    for new in by_run[1:]:
        daily.add_new(spark, new, known, effects, path, SETTINGS)
    everything = _facts(spark, [fact for _, fact in facts])
    whole = build_features(daily_sales(everything), known, effects, SETTINGS, sparse=sparse)
    stored = feature_store.read_features(spark, path)
    assert _rows(stored) == _rows(whole)
    state = feature_store.read_state(spark, path, feature_store.newest(spark, path))
    assert _rows(state) == _rows(inc.lifecycle_state(sales_columns(daily_sales(everything)), SETTINGS))
    assert max(values(state.select(F.size("last_units").alias("n")), "n")) == 13


def test_facts_are_read_once(spark):
    """Neither the whole build with its state nor an increment goes back to the facts for a second output."""
    path, read = shared_path(spark, "features"), spark.sparkContext.accumulator(0)

    def counted(rows):
        def seen(row):
            read.add(1)
            return row
        return spark.createDataFrame(spark.sparkContext.parallelize(rows, 2).map(seen), FACTS)

    known = products(spark, "a", "b", "b")
    daily.build_all(spark, counted([("a", day(i), 1, 1.0) for i in range(20)] + [("b", day(1), 0, 0.0), ("b", day(1), 2, 2.0)]),
                    known, None, path, SETTINGS, keep_state=True)
    assert read.value == 22
    state = feature_store.read_state(spark, path, feature_store.newest(spark, path)).orderBy("product_id").collect()
    # A product that is known twice has its features twice, but not its state.
    assert [tuple(r) for r in state] == [("a", day(0), 20, day(19), [1] * 13), ("b", day(1), 2, day(1), [2])]
    daily.add_new(spark, counted([("a", day(3), 1, 1.0), ("a", day(20), 1, 1.0), ("c", day(20), 1, 1.0)]), known, None, path, SETTINGS)
    assert read.value == 25
    stored = feature_store.read_features(spark, path)
    assert sorted(values(stored.groupBy("product_id").count(), "product_id", "count")) == [("a", 21), ("b", 2), ("c", 1)]


@pytest.mark.parametrize("recent_rows", [1, 2, 5])
def test_the_state_keeps_the_last_units_in_order(spark, recent_rows):
    rows = [("a", day(i), [None, 3, 0, 4][i], 1.0) for i in range(4)] + [("n", day(0), None, None), (None, day(1), 2, 1.0), ("d", None, 7, 1.0)]
    settings = Settings(history_start=day(0), history_end=day(60), recent_rows=recent_rows)
    got = {r.product_id: tuple(r)[1:] for r in inc.lifecycle_state(sales_columns(_facts(spark, rows)), settings).collect()}

    def last(*units):
        return list(units)[max(0, len(units) - recent_rows + 1):]
    assert got == {"a": (day(1), 7, day(3), last(None, 3, 0, 4)), "n": (None, None, day(0), last(None)),
                   None: (day(1), 2, day(1), last(2)), "d": (None, 7, None, last(7))}


def test_only_products_whose_past_changes_need_their_history(spark):
    state = inc.lifecycle_state(sales_columns(_facts(spark, [
        ("sold", day(0), 3, 1.0), ("sold", day(1), 0, 0.0), ("unsold", day(1), 0, 0.0), ("silent", day(1), 0, 0.0)])), SETTINGS)
    new = sales_columns(_facts(spark, [("sold", day(2), 1, 1.0), ("unsold", day(2), 1, 1.0), ("silent", day(2), 0, 0.0),
                                       ("new", day(2), 1, 1.0)]))
    assert values(inc.needing_history(new, state), "product_id") == ["unsold"]
    late = sales_columns(_facts(spark, [("sold", day(1), 1, 1.0), ("silent", day(5), 0, 0.0)]))
    assert values(inc.needing_history(late, state), "product_id") == ["sold"]
    rows = inc.extend(new.where("product_id <> 'unsold'"), state, SETTINGS)
    assert sorted(values(rows, "product_id", "day_in_stock", "recent_sales_units", "cumulative_sales")) == [
        ("new", 1, 1, 1), ("silent", 0, 0, 0), ("sold", 3, 4, 4)]


def test_a_days_run_does_not_scan_the_history_of_other_products(spark):
    """The rows of clean products come from the state and the new facts: no stored feature is in their plan."""
    state_path = shared_path(spark, "state")
    old = sales_columns(_facts(spark, [("a", day(i), 1, 1.0) for i in range(30)]))
    inc.lifecycle_state(old, SETTINGS).write.parquet(state_path)
    rows = inc.extend(sales_columns(_facts(spark, [("a", day(30), 2, 2.0)])), spark.read.parquet(state_path), SETTINGS)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1 and "SortMergeJoin" in plan or "BroadcastHashJoin" in plan
    want = add_lifecycle(sales_columns(_facts(spark, [("a", day(i), 1, 1.0) for i in range(30)] + [("a", day(30), 2, 2.0)])), SETTINGS)
    assert _rows(rows) == _rows(want.where(F.col("date") == F.lit(day(30))))


def test_readers_never_fail_while_features_are_replaced(spark):
    path = shared_path(spark, "features")

    def table(number: int):
        return spark.range(100).select(F.col("id").cast("string").alias("product_id"), F.lit(day(number)).alias("date"),
                                       F.lit(number).alias("version"))

    feature_store.write_features(table(0), path)
    seen, failures, done = [], [], threading.Event()

    def read() -> None:
        while not done.is_set():
            try:
                rows = feature_store.read_features(spark, path).groupBy("version").count().collect()
                seen.append([(r.version, r["count"]) for r in rows])
            except Exception as failure:  # any failure at all is what this test is about
                failures.append(failure)

    reader = threading.Thread(target=read)
    reader.start()
    for number in range(1, 21):
        feature_store.write_features(table(number), path)
    done.set()
    reader.join()
    assert not failures and len(seen) > 3
    assert all(len(rows) == 1 and rows[0][1] == 100 for rows in seen)
    assert [rows[0][0] for rows in seen] == sorted(rows[0][0] for rows in seen)
    # Old parts go, those of the last snapshots stay.
    assert len(files.names(spark, f"{path}/parts")) == feature_store.KEPT_SNAPSHOTS
    assert len(files.versions(spark, f"{path}/_snapshots")) == feature_store.KEPT_SNAPSHOTS


def test_a_writer_that_was_overtaken_is_told_so(spark):
    path = shared_path(spark, "features")
    table = _facts(spark, [("a", day(0), 1, 1.0)]).withColumnRenamed("day", "date")
    state = table.select("product_id")
    feature_store.write_features(table, path, state)
    base = feature_store.newest(spark, path)
    feature_store.append_features(table, state.limit(0), state, path, base)
    with pytest.raises(feature_store.Overtaken):
        feature_store.append_features(table, state.limit(0), state, path, base)
    assert feature_store.read_features(spark, path).count() == 2
    with pytest.raises(ValueError):
        feature_store.append_features(table.drop("sales_amount"), state, state, path, feature_store.newest(spark, path))
    with pytest.raises(FileNotFoundError):
        feature_store.read_features(spark, shared_path(spark, "none"))


def test_a_rewritten_product_is_read_from_its_last_part_on(spark):
    path = shared_path(spark, "features")
    schema = "product_id string, date date, n int"
    names = "product_id string"
    feature_store.write_features(spark.createDataFrame([("a", day(0), 1), ("b", day(0), 1), (None, day(0), 1)], schema), path)
    for rows, gone in (([("a", day(0), 2), ("a", day(1), 2)], ["a"]), ([("c", day(1), 3)], []), ([("a", day(0), 4), ("c", day(2), 4)], ["a"])):
        rewritten = spark.createDataFrame([(name,) for name in gone], names)
        feature_store.append_features(spark.createDataFrame(rows, schema), rewritten, rewritten, path, feature_store.newest(spark, path))
    assert sorted(map(str, values(feature_store.read_features(spark, path), "product_id", "n"))) == sorted(map(str, [
        ("b", 1), (None, 1), ("c", 3), ("a", 4), ("c", 4)]))


def test_the_job_goes_on_from_its_state(spark):
    root = shared_path(spark, "job")
    facts = [(p, day(i), 2 + i % 3, 4.0) for p in ("a", "b") for i in range(40)]
    products(spark, "a", "b").write.parquet(f"{root}/products")
    spark.createDataFrame([("EID_FITR", "EID_FITR", day(4), day(3), day(5))], "calendar_effect string, calendar_effect_type "
                          "string, date date, start_date date, end_date date").write.parquet(f"{root}/calendar")
    for name, rows in (("first", [f for f in facts if f[1] < day(30)]), ("second", [f for f in facts if f[1] >= day(30)]), ("all", facts)):
        _facts(spark, rows).write.parquet(f"{root}/{name}")
    others = [tables.Table(f"{root}/{name}") for name in ("products", "calendar")]

    def forecast(features: str, runs: str, sales: str, end: int, **options):
        settings = Settings(history_start=day(0), history_end=day(end))
        number = daily.run(spark, tables.Table(f"{root}/{sales}"), *others, f"{root}/{features}", f"{root}/{runs}", settings, **options)
        return number, _rows(spark.read.parquet(f"{root}/{runs}/run_id={number}"))

    assert forecast("features", "runs", "first", 29, incremental=True, owner="monday")[0] == 1
    assert forecast("features", "runs", "first", 29, owner="monday")[0] == 1  # a second attempt writes the same run
    number, rows = forecast("features-2", "runs-2", "first", 29, incremental=True)
    number, rows = forecast("features-2", "runs-2", "second", 39, incremental=True)
    assert number == 2 and rows == forecast("whole", "runs-whole", "all", 39)[1]
