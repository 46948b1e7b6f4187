"""Lifecycle labels as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Label and the highest day in stock it covers.
DRAFT = "00| Draft"
AGE_LIMITS = (("01| New", 7), ("02| Launch", 14), ("03| Growth", 30))
OLDEST = "04| Mature"
AGE_CATEGORIES = (DRAFT, *(label for label, _ in AGE_LIMITS), OLDEST)

# Label and the recent units it stays below.
DEAD = "01| Dead"
SALES_LIMITS = (
    ("02| Very Low", 14),
    ("03| Low", 28),
    ("04| Alive", 56),
    ("05| Medium", 84),
    ("06| Winning", 140),
)
STRONGEST = "07| High Winning"

# Sales labels behind each summary label; every other label is Low.
SUMMARY_HIGH = ("03| High", ("06| Winning", "07| High Winning"))
SUMMARY_MEDIUM = ("02| Medium", ("04| Alive", "05| Medium"))
SUMMARY_LOW = "01| Low"


def ladder(steps: Sequence[tuple[Column, str]], otherwise: str) -> Column:
    """First label whose condition holds.  A null condition does not hold."""
    (condition, label), *rest = steps
    chain = F.when(condition, F.lit(label))
    for condition, label in rest:
        chain = chain.when(condition, F.lit(label))
    return chain.otherwise(F.lit(otherwise))


def age_category(day_in_stock: Column, strict_draft: bool = False) -> Column:
    draft = day_in_stock <= 0 if strict_draft else day_in_stock == 0
    return ladder([(draft, DRAFT)] + [(day_in_stock <= top, label) for label, top in AGE_LIMITS],
                  OLDEST)


def sales_category(day_in_stock: Column, recent_units: Column, strict_draft: bool = False) -> Column:
    draft = day_in_stock <= 0 if strict_draft else day_in_stock == 0
    dead = (day_in_stock > 0) & (recent_units == 0)
    return ladder([(draft, DRAFT), (dead, DEAD)]
                  + [(recent_units < below, label) for label, below in SALES_LIMITS], STRONGEST)


def summarized_sales_category(sales: Column) -> Column:
    return ladder([(sales.isin(*members), label) for label, members in (SUMMARY_HIGH, SUMMARY_MEDIUM)],
                  SUMMARY_LOW)


def age_sales_category(age: Column, summary: Column) -> Column:
    return F.concat_ws("_", age, summary)


def salary_period(day: Column, first_day: int, last_day: int) -> Column:
    """1 in the pay period that runs over the month's end, else 0."""
    in_period = (F.dayofmonth(day) >= first_day) | (F.dayofmonth(day) <= last_day)
    return F.when(in_period, F.lit(1)).otherwise(F.lit(0))


def effect_day_label(effect_type: Column, offset: Column) -> Column:
    """``TYPE_DAY_0``, ``TYPE_DAY_PLUS_n`` or ``TYPE_DAY_MINUS_n``."""
    side = F.when(offset == 0, F.lit("_DAY_")).when(offset > 0, F.lit("_DAY_PLUS_")).when(
        offset < 0, F.lit("_DAY_MINUS_"))
    return F.concat(effect_type, side, F.abs(offset).cast("string"))


def numeric_or_zero(value: Column) -> Column:
    """Text or number to double; anything unreadable, missing or NaN is 0."""
    number = value.try_cast("double")
    return F.coalesce(F.nanvl(number, F.lit(None).cast("double")), F.lit(0.0))
