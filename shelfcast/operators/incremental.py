"""Lifecycle features of new days from a small state, without the history before them.

The state has one row per product: its first sale, its units so far, its last date, and the units of its last rows.  New rows of a
product that all lie after its last date need nothing else: one join by product brings the state, the windows run over the new rows
alone, and what a window lacks at their start is in the state.

Two kinds of products need their history: those with a late row, on or before their last date, and those that had never
sold and now have, since their earlier rows count days to the first sale.  They are few; their stored rows are read, merged with
the new ones and computed as ever.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.operators.lifecycle import (
    ALL_ROWS, add_category_labels, add_lifecycle, add_salary_period, product_rows)
from shelfcast.settings import Settings

KEPT = ("id", "shopify_product_id")


def _added(first: Column, second: Column) -> Column:
    """A sum that ignores what is null, and is null where both are."""
    return F.coalesce(first + second, first, second)


def lifecycle_state(sales: DataFrame, settings: Settings) -> DataFrame:
    """One row per product from its rows (``sales_columns`` names): first sale, units so far, last date, last units.

    ``last_units`` has the units of the last ``recent_rows - 1`` rows, oldest first, so its length has a bound.  A product's last row
    sees all of it in one pass of running and shifted windows, so nothing is grouped or collected after them.
    """
    rows, kept = product_rows(sales), settings.recent_rows - 1
    so_far = rows.rowsBetween(Window.unboundedPreceding, 0)
    units = [F.lag("sales_units", back).over(rows) if back else F.col("sales_units") for back in range(kept - 1, -1, -1)]
    placed = sales.withColumns({
        "first_sale": F.min(F.when(F.col("sales_units") > 0, F.col("date"))).over(so_far),
        "units": F.sum("sales_units").over(so_far), "last_date": F.max("date").over(so_far),
        "place": F.least(F.row_number().over(rows), F.lit(kept)), "is_last": F.lead(F.lit(True)).over(rows).isNull(),
        "frame": F.array(*units).cast(T.ArrayType(sales.schema["sales_units"].dataType))})
    return placed.where("is_last").select("product_id", "first_sale", "units", "last_date",
                                          F.slice("frame", F.lit(kept + 1) - F.col("place"), F.col("place")).alias("last_units"))


def one_per_day(features: DataFrame) -> DataFrame:
    """product_id, date and units of stored features, once for each product and day, whatever was joined to them since."""
    product = Window.partitionBy("product_id").orderBy("date")
    placed = features.select("product_id", "date", "sales_units").withColumns(
        {"place": F.row_number().over(product), "before": F.lag("date").over(product)})
    return placed.where((F.col("place") == 1) | ~F.col("date").eqNullSafe(F.col("before"))).drop("place", "before")


def needing_history(new: DataFrame, state: DataFrame) -> DataFrame:
    """product_id of new rows whose product has a late row, or had never sold and now has."""
    per_product = new.groupBy("product_id").agg(
        F.min("date").alias("first_new"), F.max(F.coalesce(F.col("sales_units") > 0, F.lit(False))).alias("sold"))
    return per_product.join(state.select("product_id", "last_date", "first_sale"), "product_id").where(
        (F.col("first_new") <= F.col("last_date")) | (F.col("first_sale").isNull() & F.col("sold"))).select("product_id")


def extend(new: DataFrame, state: DataFrame, settings: Settings) -> DataFrame:
    """Every lifecycle column of new rows that lie after their products' state.

    The join and the windows share one partitioning by product.
    """
    held = state.select("product_id", "first_sale", "units", "last_units")
    rows = new.join(held, "product_id", "left")
    product = product_rows(rows)
    first_sale = F.coalesce("first_sale", F.min(F.when(F.col("sales_units") > 0, F.col("date"))).over(product.rowsBetween(*ALL_ROWS)))
    place = F.row_number().over(product)
    recent = F.sum("sales_units").over(product.rowsBetween(1 - settings.recent_rows, 0))
    running = F.sum("sales_units").over(product.rowsBetween(Window.unboundedPreceding, 0))
    placed = rows.withColumns({"first": first_sale, "place": place, "new_recent": recent, "new_running": running})
    # The frame's rows before the new ones: as many of the last as it still has room for.
    room = F.least(F.size("last_units"), F.greatest(F.lit(settings.recent_rows) - F.col("place"), F.lit(0)))
    in_frame = F.filter(F.slice("last_units", F.size("last_units") - room + 1, room), lambda units: units.isNotNull())
    old_recent = F.when(F.col("last_units").isNotNull() & (F.size(in_frame) > 0), F.aggregate(
        in_frame, F.lit(0).cast("long"), lambda total, units: total + units))
    featured = placed.withColumns({
        "day_in_stock": F.when(F.col("first").isNull(), 0).otherwise(F.datediff("date", F.col("first")) + 1),
        "recent_sales_units": _added(F.col("new_recent"), old_recent),
        "cumulative_sales": _added(F.col("new_running"), F.col("units"))})
    labelled = featured.transform(add_category_labels, settings).transform(add_salary_period, settings)
    return labelled.drop("first_sale", "units", "last_units", "first", "place", "new_recent", "new_running")


def extended_state(new: DataFrame, state: DataFrame, settings: Settings) -> DataFrame:
    """The state after new rows: both by product, the last rows of the one behind those of the other."""
    fresh = lifecycle_state(new, settings)
    names = ("first_sale", "units", "last_date", "last_units")
    both = state.join(fresh.select("product_id", *[F.col(name).alias(f"new_{name}") for name in names]), "product_id", "full")
    none = F.array().cast(state.schema["last_units"].dataType)
    units = F.concat(F.coalesce("last_units", none), F.coalesce("new_last_units", none))
    keep = F.least(F.size(units), F.lit(settings.recent_rows - 1))
    return both.select(
        "product_id", F.least("first_sale", "new_first_sale").alias("first_sale"),
        _added(F.col("units"), F.col("new_units")).alias("units"), F.greatest("last_date", "new_last_date").alias("last_date"),
        F.slice(units, F.size(units) - keep + 1, keep).alias("last_units"))


def merged_rows(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Stored and new sales rows, one per product and day: units and amounts of one day are added."""
    rows = stored.select(*new.columns).unionByName(new)
    kept = [F.min(name).alias(name) for name in KEPT if name in new.columns]
    return rows.groupBy("product_id", "date").agg(*kept, F.sum("sales_units").alias("sales_units"),
                                                  F.sum("sales_amount").alias("sales_amount")).select(*new.columns)


def whole_history(new: DataFrame, rewritten: DataFrame, stored: DataFrame) -> DataFrame:
    """All rows of the products of ``rewritten``, from ``stored``, the sales columns of the rows before, and the new ones."""
    return merged_rows(stored.join(rewritten, "product_id", "left_semi"), new.join(rewritten, "product_id", "left_semi"))


def increment(new: DataFrame, rewritten: DataFrame, state: DataFrame, whole: DataFrame,
              settings: Settings) -> tuple[DataFrame, DataFrame]:
    """Rows to add and the state after them, of new sales rows (one per product and day).

    ``rewritten`` is the result of ``needing_history``, ``whole`` that of ``whole_history``.  Rows and state each read every input,
    so a caller writes down what is dear to compute.
    """
    clean = new.join(rewritten, "product_id", "left_anti")
    rows = extend(clean, state, settings).unionByName(add_lifecycle(whole, settings))
    after = extended_state(clean, state.join(rewritten, "product_id", "left_anti"), settings).unionByName(lifecycle_state(whole, settings))
    return rows, after
