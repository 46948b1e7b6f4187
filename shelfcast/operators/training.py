"""Training rows of each product: its last rows, as many as its category looks back on."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions import categories as labels
from shelfcast.operators.eligibility import is_non_eligible
from shelfcast.operators.lifecycle import ALL_ROWS, product_rows, without_nan
from shelfcast.operators.features import product_styles
from shelfcast.settings import LifecycleRule, Settings

RULE_COLUMNS = ("look_back", "over_forecast_factor", "changepoints", "changepoint_prior")

# What identifies a product in a training table and in everything made from one.
PRODUCT_COLUMNS = ("product_id", "on_forecast_age_sales_category", "on_forecast_age_category",
                   "on_forecast_sales_category", "style", *RULE_COLUMNS)


def with_rules(products: DataFrame, settings: Settings) -> DataFrame:
    """Add the category's rule columns, or the fallback rule's.

    The rules are a handful of literals from the settings, so they are looked up in a constant map
    and cost no join.
    """
    def entry(rule: LifecycleRule) -> Column:
        return F.struct(F.lit(rule.look_back).alias("look_back"),
                        F.lit(float(rule.over_forecast_factor)).alias("over_forecast_factor"),
                        F.lit(rule.changepoints).alias("changepoints"),
                        F.lit(float(rule.changepoint_prior)).alias("changepoint_prior"))

    table = F.create_map(*[column for name, rule in settings.lifecycle.items()
                           for column in (F.lit(name), entry(rule))])
    rule = F.coalesce(F.try_element_at(table, F.col("on_forecast_age_sales_category")),
                      entry(settings.fallback))
    return (products.withColumn("rule", rule)
            .withColumns({name: F.col(f"rule.{name}") for name in RULE_COLUMNS}).drop("rule"))


def training_window(qualified: DataFrame, settings: Settings) -> DataFrame:
    """Each product's last ``look_back`` rows before the forecast start.

    Adds ``y``, the row index ``t`` from 0 and the row count ``n``.  Rows are counted, not days.
    """
    before = with_rules(qualified.where(F.col("date") < F.lit(settings.forecast_start)), settings)
    rows = product_rows(before)
    counted = before.withColumns({
        "position": F.row_number().over(rows),
        "total": F.count(F.lit(1)).over(rows.rowsBetween(*ALL_ROWS)).cast("int")})
    n = F.least("total", "look_back")
    kept = counted.where(F.col("position") > F.col("total") - n)
    return kept.select(*PRODUCT_COLUMNS, "date", F.col("sales_units").alias("y"),
                       (F.col("position") - 1 - F.col("total") + n).alias("t"), n.alias("n"))


def training_from_sales(sales: DataFrame, products: DataFrame, settings: Settings) -> DataFrame:
    """The same training rows straight from sales facts, without a dense panel.

    Equal to densifying every product from the history start, adding lifecycle features, qualifying
    and cutting the training window.  Only three things about a product reach the forecast: its first
    sale, its recent units, and its last days.  Days older than the longest look-back therefore
    collapse into one bucket per product before the shuffle, so what is shuffled grows with products
    and not with years of history, and only eligible products are spread out again.
    """
    reach = max(settings.longest_look_back, settings.recent_rows)
    bucket_from = settings.history_end - timedelta(days=reach - 1)
    recent_from = settings.history_end - timedelta(days=settings.recent_rows - 1)
    end = F.lit(settings.history_end)
    recent_days = min(settings.recent_rows, (settings.history_end - settings.history_start).days + 1)
    day, units = F.col("day"), without_nan(sales, "units_sold")
    bucket = F.when((day >= F.lit(bucket_from)) & (day <= end), day)
    daily = sales.where(day >= F.lit(settings.history_start)).groupBy("product_id", bucket.alias("bucket")).agg(
        F.sum(units).alias("units"), F.min(F.when(units > 0, day)).alias("sold_on"))

    per_product = daily.groupBy("product_id").agg(
        F.min("sold_on").alias("first_sale"),
        # A day without a row has zero units, a day with nulls alone has none: only if all recent days are
        # such, so is the sum.
        F.when(F.count_if((F.col("bucket") >= F.lit(recent_from)) & F.col("units").isNull()) < recent_days,
               F.coalesce(F.sum(F.when(F.col("bucket") >= F.lit(recent_from), F.col("units"))),
                          F.lit(0))).alias("recent_sales_units"),
        # At most one entry per day of the look-back.
        F.map_from_entries(F.collect_list(F.when(
            F.col("bucket").isNotNull(), F.struct("bucket", "units")))).alias("units_by_day"))
    day_in_stock = F.when(F.col("first_sale").isNull(), 0).otherwise(
        F.datediff(end, F.col("first_sale")) + 1)
    labelled = per_product.withColumns({
        "age_category": labels.age_category(day_in_stock, settings.strict_draft),
        "sales_category": labels.sales_category(
            day_in_stock, F.col("recent_sales_units"), settings.strict_draft)})
    eligible = labelled.where(~is_non_eligible(settings)).select(
        "product_id", "units_by_day",
        labels.age_sales_category(
            F.col("age_category"), labels.summarized_sales_category(F.col("sales_category"))
        ).alias("on_forecast_age_sales_category"),
        F.col("age_category").alias("on_forecast_age_category"),
        F.col("sales_category").alias("on_forecast_sales_category"))
    styled = with_rules(eligible.join(product_styles(products), "product_id", "left"), settings)
    panel_days = (settings.history_end - settings.history_start).days + 1
    n = F.least(F.lit(panel_days), F.col("look_back"))
    spread = styled.select(*PRODUCT_COLUMNS, "units_by_day", n.alias("n"),
                           F.posexplode(F.sequence(F.date_sub(end, n - 1), end)).alias("t", "date"))
    return spread.select(
        *PRODUCT_COLUMNS, "date",
        # A stored null is not a missing day.
        F.when(F.map_contains_key("units_by_day", F.col("date")),
               F.try_element_at("units_by_day", F.col("date"))).otherwise(0).alias("y"), "t", "n")
