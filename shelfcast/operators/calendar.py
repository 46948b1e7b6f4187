"""Calendar effects: date ranges to one 0/1 column per effect day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.categories import effect_day_label

# Flag names become columns and pivot branches; a calendar with more of them keeps them in one column, see ``sparse_flags``.
MOST_LABELS = 500

SPARSE = "flags"


def _dated(effects: DataFrame) -> DataFrame:
    return effects.withColumns({
        name: F.col(name).try_cast("date") for name in ("date", "start_date", "end_date")})


def effect_days(effects: DataFrame) -> DataFrame:
    """One row per day of each effect's ``[start_date, end_date]``, with the anchor date kept.

    Effects without a readable anchor, start or end, and ranges that end before they start, have no days.
    """
    valid = _dated(effects).where(
        F.col("date").isNotNull() & (F.col("start_date") <= F.col("end_date")))
    return valid.select(
        "calendar_effect", "calendar_effect_type", F.col("date").alias("actual_effect_date"),
        F.explode(F.sequence("start_date", "end_date", F.expr("interval 1 day"))).alias("date"))


def label_effect_days(days: DataFrame) -> DataFrame:
    """Signed distance from the anchor and the flag name made of it."""
    offset = F.datediff("date", "actual_effect_date")
    return days.withColumns({
        "day_offset": offset,
        "calendar_effect_day": effect_day_label(F.col("calendar_effect_type"), offset)})


def distinct_labels(labelled: DataFrame) -> list[str]:
    """Flag names present, sorted.  Runs a job over the calendar table; pin the list to avoid it."""
    rows = labelled.select("calendar_effect_day").distinct().orderBy("calendar_effect_day").limit(MOST_LABELS + 1).collect()
    if len(rows) > MOST_LABELS:
        raise ValueError(f"more than {MOST_LABELS} calendar flags; keep them in one column with sparse_flags")
    return [row.calendar_effect_day for row in rows]


def pivot_flags(labelled: DataFrame, labels: Sequence[str]) -> DataFrame:
    """One row per effect date, one 0/1 column per flag name."""
    pivoted = labelled.groupBy("date").pivot("calendar_effect_day", list(labels)).agg(F.max(F.lit(1)))
    return pivoted.fillna(0, subset=list(labels))


def flags_by_date(sales: DataFrame, flags: DataFrame) -> DataFrame:
    """Every date sold on, with its flags; dates without an effect have zeros."""
    names = [name for name in flags.columns if name != "date"]
    spine = sales.select("date").where(F.col("date").isNotNull()).distinct()
    return spine.join(flags, "date", "left").fillna(0, subset=names)


def missing_dates(sales: DataFrame, flags: DataFrame, sample: int | None = None) -> DataFrame:
    """Dates sold on that the flag table lacks; ``sample`` keeps a few for a log line."""
    missing = sales.select("date").where(F.col("date").isNotNull()).distinct().subtract(flags.select("date"))
    return missing.limit(sample) if sample else missing


def join_flags(sales: DataFrame, flags: DataFrame) -> DataFrame:
    """Sales with the flags of their date, zero where there are none.

    No hint is given: Spark measures the flag table and broadcasts it while it is small.  Beyond that it shuffles
    by date and splits the heavy dates of the sales side as skewed partitions.
    """
    names = [name for name in flags.columns if name != "date"]
    return sales.join(flags, "date", "left").fillna(0, subset=names)


# Flags as one column: the names that are on, however many there are

def sparse_flags(labelled: DataFrame) -> DataFrame:
    """One row per effect date with the sorted names of its flags.

    A date has as many names as effects reach it, whatever the number of flags in the calendar, and no name has to be known
    while the plan is built.
    """
    return labelled.groupBy("date").agg(F.array_sort(F.collect_set("calendar_effect_day")).alias(SPARSE))


def join_sparse_flags(sales: DataFrame, flags: DataFrame) -> DataFrame:
    """Sales with the flags of their date, an empty array where there are none.  No hint is given, as in ``join_flags``."""
    joined = sales.join(flags, "date", "left")
    return joined.withColumn(SPARSE, F.coalesce(SPARSE, F.array().cast("array<string>")))


def is_sparse(df: DataFrame) -> bool:
    return SPARSE in df.columns and df.schema[SPARSE].dataType.simpleString() == "array<string>"


def flag(df: DataFrame, name: str) -> Column:
    """A flag as 0 or 1, by its name, from either form; a name that the calendar does not have is 0."""
    if is_sparse(df):
        return F.coalesce(F.array_contains(SPARSE, name).cast("int"), F.lit(0))
    return F.coalesce(F.col(name), F.lit(0)) if name in df.columns else F.lit(0)


def flag_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The sparse column as 0/1 columns of the chosen names."""
    return df.withColumns({name: flag(df, name) for name in names}).drop(SPARSE)
