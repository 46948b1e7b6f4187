"""The daily job: read, build features, forecast, store a numbered run.

    spark-submit --py-files shelfcast.zip -m shelfcast.plans.daily --sales ... --products ... \
        --calendar ... --features ... --runs ... --history-start 2025-04-21 --history-end 2025-10-16
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from shelfcast.operators import forecast as fc
from shelfcast.operators import incremental as inc
from shelfcast.operators.calendar import effect_days, is_sparse, join_flags, join_sparse_flags, label_effect_days, sparse_flags
from shelfcast.operators.eligibility import history_cut, qualified_history
from shelfcast.operators.features import add_style, build_features, calendar_flags
from shelfcast.operators.lifecycle import sales_columns
from shelfcast.operators.panel import daily_sales
from shelfcast.operators.training import training_window
from shelfcast.session import shared_path
from shelfcast.settings import Settings
from shelfcast.sources import files
from shelfcast.sources.feature_store import append_features, newest, read_features, read_state, write_features
from shelfcast.sources.run_store import claim_run_id, new_owner, write_run
from shelfcast.sources.tables import Table, load_inputs

TREND_MODELS = (fc.TREND_WEEKDAY, fc.CHANGEPOINT)


def forecast_demand(features: DataFrame, settings: Settings, trend_model: str = fc.CHANGEPOINT,
                    regressors: DataFrame | None = None) -> DataFrame:
    """Features to forecast rows: eligibility, training window, method choice, horizon."""
    history = history_cut(features, settings)
    qualified = qualified_history(history, settings)
    training = training_window(qualified, settings)
    if trend_model == fc.TREND_WEEKDAY:
        return fc.forecast(training, settings)
    return fc.changepoint_forecast(training, settings, regressors)


def build_all(spark: SparkSession, sales: DataFrame, products: DataFrame, calendar: DataFrame | None, features_path: str,
              settings: Settings, labels: Sequence[str] | None = None, keep_state: bool = False, sparse: bool = False) -> None:
    """Write the features of all sales facts.  With ``keep_state``, ``add_new`` can go on from them.

    The state comes from the features as written, so facts are read and brought to days once.
    """
    def state_of(stored: DataFrame) -> DataFrame:
        return inc.lifecycle_state(inc.one_per_day(stored), settings)

    write_features(build_features(daily_sales(sales), products, calendar, settings, labels, sparse), features_path,
                   state_of if keep_state else None)


def _written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The rows from a fresh path that they were written to, and that path."""
    spark, path = df.sparkSession, shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def add_new(spark: SparkSession, sales: DataFrame, products: DataFrame, calendar: DataFrame | None, features_path: str,
            settings: Settings) -> None:
    """Bring the stored features up to date with sales facts that they have not seen yet, late ones included.

    Reads the state and the new facts; stored rows are read for products whose past changes.  The days of the new facts and the rows
    of these products are written down, as the steps below read them several times.  Flags are those that the table has; a new one, like a change of settings, products' styles or past effects, asks for ``build_all``.
    """
    before = newest(spark, features_path)
    state = None if before is None else read_state(spark, features_path, before)
    if state is None:
        raise ValueError(f"{features_path} has no lifecycle state; build it with keep_state first")
    stored = read_features(spark, features_path, before)
    new, new_path = _written(sales_columns(daily_sales(sales)), "new")
    rewritten, rewritten_path = _written(inc.needing_history(new, state), "rewritten")
    whole, whole_path = _written(inc.whole_history(new, rewritten, stored.select(*new.columns)), "history")
    rows, after = inc.increment(new, rewritten, state, whole, settings)
    featured = add_style(rows, products)
    labels = [name for name in stored.columns if name not in featured.columns]
    if is_sparse(stored):
        if calendar is None:
            raise ValueError("the stored features have calendar flags; give the calendar")
        featured = join_sparse_flags(featured, sparse_flags(label_effect_days(effect_days(calendar))))
    elif labels:
        flags = None if calendar is None else calendar_flags(calendar, labels)
        if flags is None:
            raise ValueError("the stored features have calendar flags; give the calendar")
        featured = join_flags(featured, flags)
    append_features(featured, rewritten, after, features_path, before)
    for path in (new_path, rewritten_path, whole_path):
        files.remove(spark, path)


def run(spark: SparkSession, sales: Table, products: Table, calendar: Table, features_path: str,
        runs_path: str, settings: Settings, labels: Sequence[str] | None = None,
        trend_model: str = fc.CHANGEPOINT, run_id: int | None = None, owner: str | None = None,
        incremental: bool = False, sparse: bool = False) -> int:
    """Run everything and return the run number.  ``sparse`` keeps the calendar's flags in one column, however many there are.

    With ``incremental``, ``sales`` holds only the facts since the last run, once that run has kept its state: the features
    of the days before are not computed again.

    A new job claims its number.  ``owner`` names the job: resubmitted under the same name it gets the same number back and
    replaces its rows, while no other job can write them.

    Sales are first brought to one row per product and day.  Where they are so already nothing changes;
    where one product has many rows a day, no later task sees more than its days.

    The forecast starts from the written feature table, so a lost executor repeats one stage of one
    job and not the feature plan.
    """
    sales_rows, product_rows, effects = load_inputs(
        spark, sales, products, calendar, settings.history_start)
    before = newest(spark, features_path) if incremental else None
    if before and before.state:
        add_new(spark, sales_rows, product_rows, effects, features_path, settings)
    else:
        build_all(spark, sales_rows, product_rows, effects, features_path, settings, labels, incremental, sparse)
    regressors = None
    if settings.use_regressors:
        flags = sparse_flags(label_effect_days(effect_days(effects))) if sparse else calendar_flags(effects, labels)
        regressors = None if flags is None else fc.known_regressors(flags, settings)
    owner = owner or new_owner()
    if run_id is None:
        run_id = claim_run_id(spark, runs_path, owner)
    write_run(forecast_demand(read_features(spark, features_path), settings, trend_model, regressors),
              runs_path, run_id, owner)
    return run_id


def main(argv: Sequence[str] | None = None) -> None:
    from shelfcast.session import build_session

    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    for name in ("sales", "products", "calendar", "features", "runs"):
        parser.add_argument(f"--{name}", required=True, help=f"path of the {name} table")
    parser.add_argument("--history-start", required=True)
    parser.add_argument("--history-end", required=True)
    parser.add_argument("--format", default="parquet", help="format of the input tables")
    parser.add_argument("--run-id", type=int, help="number to write, if this job owns it or nobody does")
    parser.add_argument("--owner", help="name of this job, the same for all its attempts")
    parser.add_argument("--trend-model", choices=TREND_MODELS, default=fc.CHANGEPOINT)
    parser.add_argument("--incremental", action="store_true",
                        help="the sales table holds only facts that earlier runs have not seen")
    parser.add_argument("--sparse-flags", action="store_true", help="keep calendar flags in one column")
    parser.add_argument("--use-regressors", action="store_true",
                        help="let the changepoint model see the calendar")
    args = parser.parse_args(argv)
    settings = Settings(history_start=args.history_start, history_end=args.history_end,
                        use_regressors=args.use_regressors)
    spark = build_session("shelfcast daily forecast")
    tables = [Table(path, args.format) for path in (args.sales, args.products, args.calendar)]
    print(run(spark, *tables, args.features, args.runs, settings, trend_model=args.trend_model,
              run_id=args.run_id, owner=args.owner, incremental=args.incremental, sparse=args.sparse_flags))


if __name__ == "__main__":
    main()
