import uuid
from concurrent.futures import ThreadPoolExecutor
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from shelfcast.operators import runs as rn
from shelfcast.plans.daily import run
from shelfcast.plans.scorecard import Scorecard, write_scorecard
from shelfcast.session import shared_path
from shelfcast.settings import Settings
from shelfcast.sources import files, run_store, tables
from shelfcast.sources.feature_store import read_features, write_features
from tests.helpers import day, products, sales, values


def _run(spark, rows):
    return spark.createDataFrame(rows, "product_id string, date date, forecast double")


def test_store_lists_reads_and_numbers_runs(spark):
    path = shared_path(spark, "runs")
    assert run_store.stored_next_run_id(spark, path) == 1
    assert run_store.read_runs(spark, path).count() == 0
    assert run_store.list_runs(spark, path).count() == 0
    first = _run(spark, [("a", day(0), 1.0), ("a", day(1), 1.0)])
    second = _run(spark, [("a", day(1), 2.0)]).withColumn("note", F.lit("x"))
    run_store.write_run(first, path, 1, "job one")
    run_store.write_run(second, path, 2, "job two")
    run_store.write_run(second, path, 2, "job two")  # a repeated job replaces its own run only
    assert run_store.stored_next_run_id(spark, path) == 3
    assert values(run_store.read_run(spark, path, 2), "product_id", "forecast", "note", "run_id") == [
        ("a", 2.0, "x", 2)]
    assert run_store.read_run(spark, path, 9).count() == 0
    listed = run_store.list_runs(spark, path)
    assert values(listed, "run_id", "forecast_rows", "first_date", "last_date") == [
        (1, 2, day(0), day(1)), (2, 1, day(1), day(1))]
    assert all(row.files >= 1 and row.bytes > 0 and row.last_modified for row in listed.collect())
    assert set(values(run_store.read_runs(spark, path), "run_id", "note")) == {(1, None), (2, "x")}


def test_latest_run_is_chosen_per_date(spark):
    old = _run(spark, [("a", day(0), 1.0), ("a", day(1), 1.0), ("b", day(1), 1.0)]).withColumn(
        "run_id", F.lit(1))
    new = _run(spark, [("a", day(1), 2.0)]).withColumn("run_id", F.lit(2))
    latest = rn.latest_run_per_date(rn.union_runs([old, new]))
    # b is absent from the newest run of its date, so it vanishes there.
    assert sorted(values(latest, "product_id", "date", "forecast")) == [
        ("a", day(0), 1.0), ("a", day(1), 2.0)]
    assert rn.latest_run_per_date(old.limit(0)).count() == 0
    assert values(rn.next_run_id(old.limit(0)), "next_run_id") == [1]


def test_two_jobs_never_claim_one_number(spark):
    for _ in range(100):
        path = shared_path(spark, "runs")
        with ThreadPoolExecutor(8) as pool:
            claimed = list(pool.map(lambda _: run_store.claim_run_id(spark, path), range(8)))
        assert sorted(claimed) == list(range(1, 9))


def test_a_run_belongs_to_the_job_that_claimed_it(spark):
    path = shared_path(spark, "runs")
    assert run_store.claim_run_id(spark, path, "mine") == 1
    assert run_store.claim_run_id(spark, path, "other") == 2
    assert run_store.claim_run_id(spark, path, "mine") == 1  # a second attempt
    assert run_store.owner_of(spark, path, 1) == "mine" and run_store.owner_of(spark, path, 7) is None
    mine, other = _run(spark, [("a", day(0), 1.0)]), _run(spark, [("b", day(0), 2.0)])
    run_store.write_run(mine, path, 1, "mine")
    for owner in ("other", ""):
        with pytest.raises(run_store.RunOwned):
            run_store.write_run(other, path, 1, owner)
    assert values(run_store.read_run(spark, path, 1), "product_id") == ["a"]
    run_store.write_run(other, path, 5, "other")  # nobody's number is claimed by writing it
    with pytest.raises(run_store.RunOwned):
        run_store.write_run(mine, path, 5, "mine")
    assert run_store.claim_run_id(spark, path) == 6


def test_a_file_is_created_once(spark):
    path = f"{shared_path(spark, 'files')}/deep/one"
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: files.create_once(spark, path, f"job {i}"), range(8)))
    assert sum(won) == 1 and files.read_text(spark, path) == f"job {won.index(True)}"
    assert files.read_text(spark, f"{path}-none") is None and files.names(spark, f"{path}-none") == []


def _jobs(spark, use) -> int:
    """How many Spark jobs a call starts."""
    group = f"count-{uuid.uuid4().hex}"
    spark.sparkContext.setJobGroup(group, group)
    use()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_reading_runs_opens_no_footers(spark):
    path = shared_path(spark, "runs")
    for number in range(1, 13):
        rows = _run(spark, [("a", day(number), 1.0)])
        run_store.write_run(rows.withColumn("note", F.lit("x")) if number == 7 else rows, path, number, "job")
    assert files.versions(spark, f"{path}/_index/schema") == [1, 2]
    assert run_store.read_runs(spark, path).columns == ["product_id", "date", "forecast", "note", "run_id"]
    assert _jobs(spark, lambda: run_store.read_runs(spark, path).schema) == 0
    assert sorted(values(run_store.read_runs(spark, path).where("note = 'x'"), "run_id")) == [7]
    with pytest.raises(ValueError, match="forecast is string"):
        run_store.write_run(_run(spark, [("a", day(0), 1.0)]).withColumn("forecast", F.lit("much")), path, 20, "job")
    assert run_store.read_runs(spark, path).count() == 12


def test_latest_runs_scan_no_run_that_lost(spark):
    path = shared_path(spark, "runs")
    assert run_store.latest_runs(spark, path).count() == 0
    # Stored without an index, as an older store is.
    old = [_run(spark, [("a", day(i), 1.0), ("b", day(i), 1.0)]).withColumn("run_id", F.lit(i + 1)) for i in range(10)]
    rn.union_runs(old).write.partitionBy("run_id").parquet(path)
    run_store.write_run(_run(spark, [("a", day(i), 2.0) for i in range(9)]).withColumn("note", F.lit("x")), path, 11, "job")
    latest = run_store.latest_runs(spark, path)
    assert sorted(values(latest, "product_id", "date", "forecast", "note", "run_id")) == sorted(
        [("a", day(i), 2.0, "x", 11) for i in range(9)] + [(p, day(9), 1.0, None, 10) for p in "ab"])
    assert sorted(values(latest, "product_id", "date", "run_id")) == sorted(values(
        rn.latest_run_per_date(run_store.read_runs(spark, path)), "product_id", "date", "run_id"))
    plan = latest._jdf.queryExecution().executedPlan()
    assert "dynamicpruningexpression" in plan.toString()
    latest.collect()
    # Of eleven runs the dates of all are read, and the forecasts of two.
    assert sorted(_scanned_partitions(latest)) == [2, 11]


def _scanned_partitions(df) -> list[int]:
    """Partition folders that each scan of a plan that has run has read."""
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        inner = node.getClass().getSimpleName()
        if inner == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif inner.endswith("QueryStageExec"):
            todo.append(node.plan())
        else:
            todo += [node.children().apply(i) for i in range(node.children().size())]
        if inner == "FileSourceScanExec":
            found.append(node.metrics().apply("numPartitions").value())
    return found


def test_a_failed_job_leaves_the_old_features(spark):
    path = shared_path(spark, "features")
    write_features(_run(spark, [("a", day(0), 1.0)]), path)
    broken = _run(spark, [("b", day(1), 2.0)]).withColumn("forecast", F.raise_error(F.lit("broken")).cast("double"))
    with pytest.raises(Exception, match="broken"):
        write_features(broken, path)
    assert values(read_features(spark, path), "product_id") == ["a"]
    write_features(_run(spark, [("c", day(2), 3.0)]), path)
    assert values(read_features(spark, path), "product_id") == ["c"]


def test_scan_filters(spark):
    df = spark.createDataFrame([(i, "x" if i % 2 else "y") for i in range(10)], "n int, kind string")
    got = tables.scan(df, {"n_gte": 3, "n_lte": 8, "kind_eq": "x"}, order_by="n", descending=True)
    assert values(got, "n") == [7, 5, 3]
    assert values(tables.scan(df, {"kind": "y", "n_lte": 2}), "n") == [0, 2]
    assert tables.scan(df, order_by="absent").count() == 10


def test_daily_job_and_scorecard(spark):
    settings = Settings(history_start=day(0), history_end=day(15))
    root = shared_path(spark, "job")
    # Sales go on after the history end: they are the actuals.
    series = {"a": [2] * 30, "b": [0, 3] * 15, "new": [0] * 13 + [1] * 17}
    # Product a comes in two rows a day.
    rows = sales(spark, series)
    halves = rows.where("product_id = 'a'").withColumn("units_sold", F.lit(1).cast("long"))
    rows.where("product_id <> 'a'").unionByName(halves).unionByName(halves).write.parquet(f"{root}/sales")
    products(spark, *series).write.parquet(f"{root}/products")
    spark.createDataFrame([("EID_FITR", "", "EID_FITR", day(4), day(3), day(5))],
                          "calendar_effect string, calendar_effect_desc string, calendar_effect_type "
                          "string, date date, start_date date, end_date date").write.parquet(f"{root}/calendar")
    inputs = [tables.Table(f"{root}/{name}") for name in ("sales", "products", "calendar")]
    for expected in (1, 2):
        assert run(spark, *inputs, f"{root}/features", f"{root}/runs", settings) == expected
    seeing = Settings(history_start=day(0), history_end=day(15), use_regressors=True)
    assert run(spark, *inputs, f"{root}/features", f"{root}/other-runs", seeing) == 1
    features = read_features(spark, f"{root}/features")
    assert "EID_FITR_DAY_MINUS_1" in features.columns
    card = Scorecard.build(features, run_store.read_runs(spark, f"{root}/runs"), day(16), day(29))
    assert set(values(card.evaluation, "product_id", "sales_units")) == {("a", 28), ("b", 21)}
    flat = card.evaluation.where("product_id = 'a'").first()
    # Growth with 28 recent units is Medium, whose over-forecast factor is 1.3.
    assert flat.forecast == pytest.approx(28 * 1.3, rel=0.001) and flat.error_bin == "13| +5 +10"
    assert card.validation.count() == 90
    assert card.business_daily().count() == 30
    assert card.business_window().first().total_sales == 28 + 21 + 14
    assert card.worst_products(limit=1).count() == 1
    assert card.accuracy("error").count() == 22
    assert card.distribution().count() >= 1
    assert card.products_by_age().count() == 30
    assert card.style("STa").count() == 30
    written = write_scorecard(spark, f"{root}/features", f"{root}/runs", f"{root}/card", day(16), day(29))
    assert sorted(map(str, written.evaluation.collect())) == sorted(map(str, card.evaluation.collect()))
    assert spark.read.parquet(f"{root}/card/accuracy_bias").count() == 22
    assert spark.read.parquet(f"{root}/card/business_daily").count() == 30
    with pytest.raises(ValueError):
        tables.load_inputs(spark, *inputs, day(400))


def test_shared_path_follows_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_path(spark, "x"), shared_path(spark, "x")
    assert first.startswith(f"{root}/x-") and first != second


def test_shared_path_needs_a_shared_folder_on_a_cluster():
    def session(master):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: default),
                               sparkContext=SimpleNamespace(master=master))

    assert shared_path(session("local[2]"), "x")
    with pytest.raises(RuntimeError):
        shared_path(session("yarn"), "x")
