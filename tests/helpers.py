"""Small literal tables."""

from __future__ import annotations

from datetime import date, timedelta

DAY0 = date(2024, 1, 1)


def day(offset: int) -> date:
    return DAY0 + timedelta(days=offset)


def sales(spark, units_by_product: dict, start: date = DAY0):
    """Dense sales rows from a list of units per product."""
    rows = [(product, start + timedelta(days=i), units, None if units is None else units * 2.0)
            for product, series in units_by_product.items() for i, units in enumerate(series)]
    return spark.createDataFrame(
        rows, "product_id string, day date, units_sold bigint, sales_amount double")


def products(spark, *ids: str):
    return spark.createDataFrame([(i, f"ST{i}") for i in ids], "id string, product_number string")


def values(df, *names: str):
    return [tuple(row) if len(names) > 1 else row[0] for row in df.select(*names).collect()]
