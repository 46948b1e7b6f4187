"""Sales, product, calendar and run views over the given tables.

Everything here is derived from whole tables, so each view grows with the data.
"""

from __future__ import annotations

from dataclasses import replace
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shelfcast.operators.eligibility import SNAPSHOT_COLUMNS
from shelfcast.operators.features import build_features
from shelfcast.operators.panel import daily_sales, day_range, densify
from shelfcast.settings import FALLBACK_RULE, LIFECYCLE_RULES, Settings

USER = Settings(history_start=date(2024, 1, 1), history_end=date(2024, 1, 16))
ITEM = Settings(history_start=date(1995, 1, 1), history_end=date(2001, 6, 30))

# Two weeks of the catalogue, few enough that most parts sold on none of their days.
CATALOGUE = (date(1997, 3, 3), date(1997, 3, 16))
# A forecast that starts eight days after the history ends.
GAP = replace(ITEM, forecast_start=date(2001, 7, 9))
_SHORT = {name: replace(rule, look_back=13) for name, rule in LIFECYCLE_RULES.items()}
# Thirteen days and no bend: without a weekly season the changepoint model is a least-squares line.
LINE = replace(ITEM, zero_ratio_threshold=1.0, fallback=replace(FALLBACK_RULE, look_back=13, changepoints=0),
               lifecycle={name: replace(rule, changepoints=0) for name, rule in _SHORT.items()})
# The same with one bend, under either prior.
SPARSE_BEND = replace(ITEM, zero_ratio_threshold=1.0, fallback=replace(FALLBACK_RULE, look_back=13, changepoints=1),
                      lifecycle={name: replace(rule, changepoints=1) for name, rule in _SHORT.items()})
BEND = replace(SPARSE_BEND, changepoint_penalty="ridge")

# Kind of effect, days before and days after its anchor.  The week's number since the
# first Monday of 1970 picks the kind, in this order.
EFFECT_KINDS = (
    ("NATIONAL_DAY", 1, 1),
    ("WHITE_FRIDAY", 1, 1),
    ("EID_FITR", 1, 2),
    ("EID_ADHA", 1, 2),
    ("ARAFAT_DAY", 0, 0),
    ("ISLAMIC_NEW_YEAR", 0, 1),
    ("BLACK_FRIDAY", 0, 2),
)
LABELS = sorted(
    f"{kind}_DAY_" + ("0" if offset == 0 else f"{'PLUS' if offset > 0 else 'MINUS'}_{abs(offset)}")
    for kind, before, after in EFFECT_KINDS for offset in range(-before, after + 1))

# Run number, first date, last date.  Run 2 covers only products with units in the week
# before it, so the others vanish on the dates it wins.
RUNS = (
    (1, date(2024, 1, 17), date(2024, 1, 23)),
    (2, date(2024, 1, 19), date(2024, 1, 25)),
    (3, date(2024, 1, 24), date(2024, 1, 30)),
)
PARTIAL_RUN = 2


_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table.  Its schema is read from a file footer once, not on every query."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def _daily(facts: DataFrame) -> DataFrame:
    # Money is summed in whole cents, which is exact in any order.
    return daily_sales(facts).withColumn("sales_amount", F.col("sales_amount") / 100.0)


def _money(name: str) -> Column:
    return F.round(F.col(name) * 100).cast("long")


def part_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part sales line by line, money in cents."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("product_id"), F.col("l_shipdate").cast("date").alias("day"),
        F.col("l_quantity").cast("long").alias("units_sold"),
        _money("l_extendedprice").alias("sales_amount"))


def part_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part sales as stored: one row per part and day it shipped on."""
    daily = _daily(part_facts(spark, sf_dir))
    return daily.select((F.col("product_id") * 100000 + F.unix_date("day")).alias("id"), "product_id",
                        F.concat(F.lit("SP-"), "product_id").alias("shopify_product_id"),
                        "day", "units_sold", "sales_amount")


# The first days of the two increments that part features grow by, and which lines come late, with the second.
INCREMENTS = (date(2001, 1, 1), date(2001, 4, 1))
LATE_ORDERS = 97


def part_facts_by_run(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Part sales as three runs see them: a base, and two increments; every 97th order comes late, with the last."""
    facts = table(spark, sf_dir, "lineitem").withColumn("late", F.col("l_orderkey") % LATE_ORDERS == 0)
    day = F.col("l_shipdate").cast("date")
    number = F.when(F.col("late") | (day >= F.lit(INCREMENTS[1])), 2).when(day >= F.lit(INCREMENTS[0]), 1).otherwise(0)
    rows = facts.select(
        number.alias("run"), F.col("l_partkey").alias("product_id"), day.alias("day"),
        (F.col("l_partkey") * 100000 + F.unix_date(day)).alias("id"), F.concat(F.lit("SP-"), "l_partkey").alias("shopify_product_id"),
        F.col("l_quantity").cast("long").alias("units_sold"), _money("l_extendedprice").alias("sales_amount"))
    return [rows.where(F.col("run") == run).drop("run") for run in range(3)]


def brand_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brand sales on every day from the table's first day to its last.

    Parts are summed by day before they meet their brand, so a part with a third of all lines has one row a
    day by then.
    """
    brands = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("product_id"), "p_brand")
    parts = daily_sales(part_facts(spark, sf_dir))
    daily = _daily(parts.join(brands, "product_id").select(
        F.col("p_brand").alias("product_id"), "day", "units_sold", "sales_amount"))
    # Every line's part has a brand, so the range is that of the lines: one column, before anything is joined.
    return densify(daily, *day_range(part_facts(spark, sf_dir)))


def catalogue_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part sales on every day of the catalogue run, parts that sold on none of them included."""
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("product_id"))
    daily = _daily(part_facts(spark, sf_dir).where(
        F.col("day").between(F.lit(CATALOGUE[0]), F.lit(CATALOGUE[1]))))
    return densify(daily, *CATALOGUE, products=parts)


def user_sales(spark: SparkSession, sf_dir: str, purchases_only: bool = True,
               dense: bool = True) -> DataFrame:
    """Units per user: purchases, or all events.  Dense, every user has every day of the run."""
    events = table(spark, sf_dir, "events")
    counted = F.col("event_type") == "purchase" if purchases_only else F.lit(True)
    facts = events if dense else events.where(counted)
    daily = _daily(facts.select(
        F.col("user_id").alias("product_id"), F.col("ts").cast("date").alias("day"),
        F.when(counted, 1).otherwise(0).cast("long").alias("units_sold"),
        F.when(counted, _money("value")).otherwise(0).alias("sales_amount")))
    # Dense, every event counts as a row of its day, so the range is that of the events.
    return densify(daily, *day_range(events.select(F.col("ts").cast("date").alias("day")))) if dense else daily


def part_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), F.concat(F.lit("ST"), "p_partkey").alias("product_number"),
        F.col("p_name").alias("product_title"), F.col("p_retailprice").alias("price"),
        F.lit("active").alias("status"))


def _keyed_products(keys: DataFrame) -> DataFrame:
    return keys.distinct().select("id", F.concat(F.lit("ST"), "id").alias("product_number"))


def user_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _keyed_products(table(spark, sf_dir, "events").select(F.col("user_id").alias("id")))


def brand_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _keyed_products(table(spark, sf_dir, "part").select(F.col("p_brand").alias("id")))


def calendar_effects(spark: SparkSession, sf_dir: str, name: str = "orders",
                     column: str = "o_orderdate") -> DataFrame:
    """One effect a week, anchored on the busiest day of a table's week."""
    days = table(spark, sf_dir, name).groupBy(F.col(column).cast("date").alias("day")).agg(
        F.count(F.lit(1)).alias("rows"))
    weeks = days.groupBy(F.date_trunc("week", "day").cast("date").alias("week")).agg(
        F.max_by("day", F.struct("rows", -F.unix_date("day"))).alias("date"))
    slot = (F.datediff("week", F.lit(date(1970, 1, 5))) / 7).cast("int") % len(EFFECT_KINDS)
    kinds = F.array(*[F.struct(F.lit(kind).alias("kind"), F.lit(before).alias("before"),
                               F.lit(after).alias("after")) for kind, before, after in EFFECT_KINDS])
    picked = weeks.withColumn("kind", F.element_at(kinds, slot + 1))
    return picked.select(
        F.col("kind.kind").alias("calendar_effect"),
        F.concat(F.lit("busiest day of the week of "), F.col("week")).alias("calendar_effect_desc"),
        F.col("kind.kind").alias("calendar_effect_type"), "date",
        F.date_sub("date", F.col("kind.before")).alias("start_date"),
        F.date_add("date", F.col("kind.after")).alias("end_date"))


# The calendar join is left out of views whose queries read no flags: Spark cannot drop it by itself.

def part_features(spark: SparkSession, sf_dir: str, flags: bool = False) -> DataFrame:
    return build_features(part_sales(spark, sf_dir), part_products(spark, sf_dir),
                          calendar_effects(spark, sf_dir) if flags else None, ITEM, LABELS)


def brand_features(spark: SparkSession, sf_dir: str, flags: bool = False) -> DataFrame:
    return build_features(brand_sales(spark, sf_dir), brand_products(spark, sf_dir),
                          calendar_effects(spark, sf_dir) if flags else None, ITEM, LABELS)


def user_features(spark: SparkSession, sf_dir: str, purchases_only: bool = True,
                  dense: bool = True, flags: bool = False) -> DataFrame:
    effects = calendar_effects(spark, sf_dir, "events", "ts") if flags else None
    return build_features(user_sales(spark, sf_dir, purchases_only, dense),
                          user_products(spark, sf_dir), effects, USER, LABELS)


def forecast_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three overlapping runs over the users.  The forecast is the mean of the week before a run."""
    features = user_features(spark, sf_dir)
    on_end = F.col("date") == F.lit(USER.history_end)
    weeks = [F.sum(F.when((F.col("date") < F.lit(first)) & (F.col("date") >= F.date_sub(F.lit(first), 7)),
                          F.col("sales_units")).otherwise(0)).alias(f"week_{number}")
             for number, first, _ in RUNS]
    products = features.groupBy("product_id").agg(
        F.max(F.when(on_end, F.struct(*SNAPSHOT_COLUMNS))).alias("end"), *weeks)
    runs = F.array(*[F.struct(F.lit(number).alias("run_id"), F.col(f"week_{number}").alias("week"),
                              F.sequence(F.lit(first), F.lit(last)).alias("dates"))
                     for number, first, last in RUNS])
    rows = products.select("product_id", "end.*", F.explode(runs).alias("run")).where(
        (F.col("run.run_id") != PARTIAL_RUN) | (F.col("run.week") > 0))
    return rows.select(
        "product_id", "age_sales_category", "age_category", "sales_category", "style",
        F.lit("croston").alias("forecast_method"), F.explode("run.dates").alias("date"),
        F.round(F.col("run.week") / 7.0, 6).alias("forecast"), F.col("run.run_id").alias("run_id"))
