"""The scorecard: stored features and runs to the evaluation tables.

    spark-submit --py-files shelfcast.zip -m shelfcast.plans.scorecard --features ... --runs ... \
        --out ... --first 2025-10-07 --last 2025-10-17
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from shelfcast.operators import evaluation as ev
from shelfcast.operators.runs import latest_run_per_date
from shelfcast.sources.feature_store import read_features
from shelfcast.sources.run_store import latest_runs


@dataclass(frozen=True)
class Scorecard:
    """Named views, all lazy.  Write ``evaluation`` first if many views are wanted."""

    evaluation: DataFrame
    validation: DataFrame
    features: DataFrame
    forecast: DataFrame
    first: date
    last: date

    @classmethod
    def build(cls, features: DataFrame, runs: DataFrame, first: date, last: date) -> "Scorecard":
        latest = latest_run_per_date(runs)
        return cls(ev.evaluation_table(latest, features), ev.validation_table(features, latest),
                   features, latest, first, last)

    def business_daily(self) -> DataFrame:
        return ev.business_daily(self.features, self.forecast)

    def business_window(self) -> DataFrame:
        return ev.business_window(self.features, self.forecast, self.first, self.last)

    def products_by_age(self) -> DataFrame:
        return ev.products_by_age(self.features, self.forecast)

    def distribution(self, *group_by: str) -> DataFrame:
        return ev.attribute_distribution(self.evaluation, group_by or ("sales_category",))

    def accuracy(self, method: str = "bias", **options) -> DataFrame:
        return ev.accuracy_distribution(self.evaluation, method, **options)

    def category(self, sales_category: str) -> DataFrame:
        return self.evaluation.where(self.evaluation.sales_category == sales_category)

    def category_performance(self, sales_category: str, count_of: str = "style") -> DataFrame:
        return ev.category_performance(self.category(sales_category), count_of)

    def worst_products(self, sales_category: str | None = None, limit: int = 10) -> DataFrame:
        scored = self.evaluation if sales_category is None else self.category(sales_category)
        return ev.worst_products(scored, limit)

    def style(self, style: str) -> DataFrame:
        return ev.style_series(self.validation, style)


def write_scorecard(spark: SparkSession, features_path: str, runs_path: str, out: str,
                    first: date, last: date) -> Scorecard:
    """Write every view below ``out`` as Parquet and return the card over the written tables.

    The winning forecasts and the evaluation are written first and read back, so the views share them without
    a cache and a lost executor does not bring their joins back.  The validation table keeps the columns that
    its views read.
    """
    def stored(name: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{out}/{name}")
        return spark.read.parquet(f"{out}/{name}")

    features = read_features(spark, features_path)
    latest = stored("forecast", latest_runs(spark, runs_path))
    narrow = features.select("product_id", "date", "style", "sales_units", "age_category", "sales_category",
                             "age_sales_category")
    card = Scorecard(stored("evaluation", ev.evaluation_table(latest, features)),
                     stored("validation", ev.validation_table(narrow, latest)), features, latest, first, last)
    # Both distributions come from the summary's few rows.
    summed = stored("summary", ev.summary(card.evaluation))
    for name, view in (("business_daily", card.business_daily()),
                       ("business_window", card.business_window()),
                       ("products_by_age", card.products_by_age()),
                       ("sales_category_distribution", card.distribution("sales_category")),
                       ("accuracy_bias", ev.accuracy_of(summed, "bias")),
                       ("accuracy_error", ev.accuracy_of(summed, "error")),
                       ("worst_products", card.worst_products())):
        stored(name, view)
    return card


def main(argv: Sequence[str] | None = None) -> None:
    from shelfcast.session import build_session

    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    for name in ("features", "runs", "out"):
        parser.add_argument(f"--{name}", required=True)
    for name in ("first", "last"):
        parser.add_argument(f"--{name}", required=True, type=date.fromisoformat,
                            help=f"{name} date of the evaluation window")
    args = parser.parse_args(argv)
    write_scorecard(build_session("shelfcast scorecard"), args.features, args.runs, args.out,
                    args.first, args.last)


if __name__ == "__main__":
    main()
