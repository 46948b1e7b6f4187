"""The processed feature table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.operators import calendar
from shelfcast.operators.lifecycle import add_lifecycle, sales_columns
from shelfcast.settings import Settings


def product_styles(products: DataFrame) -> DataFrame:
    return products.select(F.col("id").alias("product_id"), F.col("product_number").alias("style"))


def add_style(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Left join on product; unknown products have a null style.

    The product table grows with the business, so it carries no broadcast hint.  Spark broadcasts it
    while it is under its measured threshold; beyond that both sides meet on product_id, the
    partitioning the sales side has already.
    """
    return sales.join(product_styles(products), "product_id", "left")


def calendar_flags(effects: DataFrame, labels: Sequence[str] | None = None) -> DataFrame | None:
    """One row per effect date with a 0/1 column per flag; none if the calendar has no effect day."""
    labelled = calendar.label_effect_days(calendar.effect_days(effects))
    names = list(labels) if labels is not None else calendar.distinct_labels(labelled)
    return calendar.pivot_flags(labelled, names) if names else None


def build_features(sales: DataFrame, products: DataFrame, effects: DataFrame | None,
                   settings: Settings, labels: Sequence[str] | None = None, sparse: bool = False) -> DataFrame:
    """Sales with lifecycle columns, style and calendar flags.

    No job runs here, unless ``labels`` is missing and the calendar's flags have to be named.  With ``sparse`` the flags
    are one column of names, for calendars with any number of them.
    """
    features = add_style(add_lifecycle(sales_columns(sales), settings), products)
    if sparse and effects is not None:
        return calendar.join_sparse_flags(features, calendar.sparse_flags(
            calendar.label_effect_days(calendar.effect_days(effects))))
    flags = None if effects is None else calendar_flags(effects, labels)
    if flags is None:
        return features
    return calendar.join_flags(features, flags)


def feature_totals(features: DataFrame) -> DataFrame:
    """One row: records and units, zero units when there is nothing."""
    return features.agg(F.count(F.lit(1)).alias("total_records"),
                        F.coalesce(F.sum("sales_units"), F.lit(0)).alias("total_sales_units"))
