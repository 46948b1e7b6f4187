"""SQL for each registered query, written from the operator's definition.

``FRAGMENTS`` are common table expressions; ``_sql`` puts the ones a query names, and what they need,
in front of its SELECT.
"""

from __future__ import annotations

from catalog import fixtures as fx
from shelfcast.settings import Settings

# The 22 bins of each metric, as label, start and end.
BIAS_BINS = """
  ('01| < -100', CAST('-inf' AS DOUBLE), -100), ('02| -100 -90', -100, -90), ('03| -90 -80', -90, -80),
  ('04| -80 -70', -80, -70), ('05| -70 -60', -70, -60), ('06| -60 -50', -60, -50), ('07| -50 -40', -50, -40),
  ('08| -40 -30', -40, -30), ('09| -30 -20', -30, -20), ('10| -20 -10', -20, -10), ('11| -10 0', -10, 0),
  ('12| 0 +10', 0, 10), ('13| +10 +20', 10, 20), ('14| +20 +30', 20, 30), ('15| +30 +40', 30, 40),
  ('16| +40 +50', 40, 50), ('17| +50 +60', 50, 60), ('18| +60 +70', 60, 70), ('19| +70 +80', 70, 80),
  ('20| +80 +90', 80, 90), ('21| +90 +100', 90, 100), ('22| > +100', 100, CAST('inf' AS DOUBLE))"""
ERROR_BINS = """
  ('01| < -50', CAST('-inf' AS DOUBLE), -50), ('02| -50 -45', -50, -45), ('03| -45 -40', -45, -40),
  ('04| -40 -35', -40, -35), ('05| -35 -30', -35, -30), ('06| -30 -25', -30, -25), ('07| -25 -20', -25, -20),
  ('08| -20 -15', -20, -15), ('09| -15 -10', -15, -10), ('10| -10 -5', -10, -5), ('11| -5 0', -5, 0),
  ('12| 0 +5', 0, 5), ('13| +5 +10', 5, 10), ('14| +10 +15', 10, 15), ('15| +15 +20', 15, 20),
  ('16| +20 +25', 20, 25), ('17| +25 +30', 25, 30), ('18| +30 +35', 30, 35), ('19| +35 +40', 35, 40),
  ('20| +40 +45', 40, 45), ('21| +45 +50', 45, 50), ('22| > +50', 50, CAST('inf' AS DOUBLE))"""
# Look-back, factor, changepoints and prior of each category, and of all others.
RULES = """
  ('02| Launch_01| Low', 10, CAST(1.0 AS DOUBLE), 1, CAST(0.01 AS DOUBLE)),
  ('02| Launch_02| Medium', 10, 1.15, 2, 0.05),
  ('02| Launch_03| High', 7, 1.2, 1, 0.1),
  ('03| Growth_01| Low', 10, 1.0, 2, 0.01),
  ('03| Growth_02| Medium', 30, 1.3, 3, 0.05),
  ('03| Growth_03| High', 30, 1.3, 4, 0.1),
  ('04| Mature_01| Low', 60, 1.0, 4, 0.01),
  ('04| Mature_02| Medium', 60, 1.3, 6, 0.05),
  ('04| Mature_03| High', 60, 1.3, 8, 0.1)"""
OTHER_LOOK_BACK, OTHER_FACTOR, OTHER_CHANGEPOINTS, OTHER_PRIOR = 60, 1.1, 25, 0.05

FRAGMENTS: dict[str, tuple[tuple[str, ...], str]] = {}


def _fragment(name: str, needs: tuple[str, ...], body: str) -> None:
    FRAGMENTS[name] = (needs, body)


def _sql(select: str, *names: str) -> str:
    ordered: dict[str, str] = {}

    def visit(name: str) -> None:
        needs, body = FRAGMENTS[name]
        for need in needs:
            visit(need)
        ordered.setdefault(name, body)

    for name in names:
        visit(name)
    return ("WITH " + ",\n".join(ordered.values()) + "\n" if ordered else "") + select


# Sales views

_fragment("part_sales", (), """part_sales AS (
  SELECT l_partkey * 100000 + date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) AS id,
         l_partkey AS product_id, 'SP-' || l_partkey AS shopify_product_id,
         CAST(l_shipdate AS DATE) AS date, CAST(sum(l_quantity) AS BIGINT) AS sales_units,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS sales_amount
  FROM lineitem GROUP BY l_partkey, CAST(l_shipdate AS DATE))""")

_fragment("brand_sales", (), """brand_sold AS (
  SELECT p_brand AS product_id, CAST(l_shipdate AS DATE) AS date, sum(l_quantity) AS units,
         sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS amount
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2),
brand_days AS (
  SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date
  FROM (SELECT min(date) AS lo, max(date) AS hi FROM brand_sold)),
brand_sales AS (
  SELECT b.product_id, d.date, CAST(coalesce(s.units, 0) AS BIGINT) AS sales_units,
         CAST(coalesce(s.amount, 0) AS DOUBLE) AS sales_amount
  FROM (SELECT DISTINCT product_id FROM brand_sold) b CROSS JOIN brand_days d
  LEFT JOIN brand_sold s ON s.product_id = b.product_id AND s.date = d.date)""")


def _user_fragment(name: str, counted: str) -> None:
    _fragment(name, (), f"""{name}_sold AS (
  SELECT user_id AS product_id, CAST(ts AS DATE) AS date, count(*) FILTER ({counted}) AS units,
         sum(CAST(value AS DECIMAL(12,2))) FILTER ({counted}) AS amount
  FROM events GROUP BY 1, 2),
{name}_days AS (
  SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM {name}_sold),
{name} AS (
  SELECT u.product_id, d.date, CAST(coalesce(s.units, 0) AS BIGINT) AS sales_units,
         CAST(coalesce(s.amount, 0) AS DOUBLE) AS sales_amount
  FROM (SELECT DISTINCT user_id AS product_id FROM events) u CROSS JOIN {name}_days d
  LEFT JOIN {name}_sold s ON s.product_id = u.product_id AND s.date = d.date)""")


_user_fragment("user_sales", "WHERE event_type = 'purchase'")
_user_fragment("event_sales", "WHERE true")
_fragment("sparse_sales", (), """sparse_sales AS (
  SELECT user_id AS product_id, CAST(ts AS DATE) AS date, count(*) AS sales_units,
         CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS sales_amount
  FROM events WHERE event_type = 'purchase' GROUP BY 1, 2)""")

_fragment("sparse_events", (), """sparse_events AS (
  SELECT user_id AS product_id, CAST(ts AS DATE) AS date, count(*) AS sales_units,
         CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS sales_amount
  FROM events GROUP BY 1, 2)""")
_fragment("catalogue_sales", ("part_sales",), f"""catalogue_sales AS (
  SELECT p_partkey AS product_id, CAST(d.date AS DATE) AS date, coalesce(s.sales_units, 0) AS sales_units,
         coalesce(s.sales_amount, 0) AS sales_amount
  FROM part CROSS JOIN (SELECT unnest(generate_series(DATE '{fx.CATALOGUE[0]}', DATE '{fx.CATALOGUE[1]}',
                                                       INTERVAL 1 DAY)) AS date) d
  LEFT JOIN part_sales s ON s.product_id = p_partkey AND s.date = d.date)""")

# Lifecycle


def _age(day: str) -> str:
    return (f"CASE WHEN {day} = 0 THEN '00| Draft' WHEN {day} <= 7 THEN '01| New' "
            f"WHEN {day} <= 14 THEN '02| Launch' WHEN {day} <= 30 THEN '03| Growth' "
            "ELSE '04| Mature' END")


def _sales(day: str, recent: str) -> str:
    return (f"CASE WHEN {day} = 0 THEN '00| Draft' WHEN {day} > 0 AND {recent} = 0 THEN '01| Dead' "
            f"WHEN {recent} < 14 THEN '02| Very Low' WHEN {recent} < 28 THEN '03| Low' "
            f"WHEN {recent} < 56 THEN '04| Alive' WHEN {recent} < 84 THEN '05| Medium' "
            f"WHEN {recent} < 140 THEN '06| Winning' ELSE '07| High Winning' END")


def _summary(sales: str) -> str:
    return (f"CASE WHEN {sales} IN ('06| Winning', '07| High Winning') THEN '03| High' "
            f"WHEN {sales} IN ('04| Alive', '05| Medium') THEN '02| Medium' ELSE '01| Low' END")


def _lifecycle_fragment(name: str, source: str) -> None:
    _fragment(name, (source,), f"""{name}_first AS (
  SELECT product_id, min(date) AS first_sale FROM {source} WHERE sales_units > 0 GROUP BY 1),
{name}_days AS (
  SELECT s.*, CAST(CASE WHEN f.first_sale IS NULL THEN 0
                        ELSE date_diff('day', f.first_sale, s.date) + 1 END AS INTEGER) AS day_in_stock,
         CAST(sum(s.sales_units) OVER (PARTITION BY s.product_id ORDER BY s.date
              ROWS BETWEEN 13 PRECEDING AND CURRENT ROW) AS BIGINT) AS recent_sales_units,
         CAST(sum(s.sales_units) OVER (PARTITION BY s.product_id ORDER BY s.date
              ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cumulative_sales,
         CAST(CASE WHEN day(s.date) >= 25 OR day(s.date) <= 4 THEN 1 ELSE 0 END AS INTEGER)
           AS "SALARY_PERIOD"
  FROM {source} s LEFT JOIN {name}_first f USING (product_id)),
{name}_labels AS (
  SELECT *, {_age('day_in_stock')} AS age_category,
         {_sales('day_in_stock', 'recent_sales_units')} AS sales_category FROM {name}_days),
{name} AS (
  SELECT *, {_summary('sales_category')} AS summarized_sales_category,
         age_category || '_' || {_summary('sales_category')} AS age_sales_category
  FROM {name}_labels)""")


_lifecycle_fragment("part_life", "part_sales")
_lifecycle_fragment("brand_life", "brand_sales")
_lifecycle_fragment("user_life", "user_sales")
_lifecycle_fragment("event_life", "event_sales")
_lifecycle_fragment("sparse_life", "sparse_sales")
_lifecycle_fragment("sparse_event_life", "sparse_events")
_lifecycle_fragment("catalogue_life", "catalogue_sales")

# Calendar

_KINDS = ", ".join(f"({slot}, '{kind}', {before}, {after})"
                   for slot, (kind, before, after) in enumerate(fx.EFFECT_KINDS))
_FLAG_COLUMNS = ", ".join(
    f"CAST(max(CASE WHEN calendar_effect_day = '{label}' THEN 1 ELSE 0 END) AS INTEGER) AS \"{label}\""
    for label in fx.LABELS)
_FILLED_FLAGS = ", ".join(f'coalesce(f."{label}", 0) AS "{label}"' for label in fx.LABELS)


def _calendar_fragment(name: str, source: str, column: str) -> None:
    _fragment(f"{name}_days", (), f"""{name}_counts AS (
  SELECT CAST({column} AS DATE) AS day, count(*) AS n FROM {source} GROUP BY 1),
{name}_weeks AS (
  SELECT CAST(date_trunc('week', day) AS DATE) AS week, day,
         row_number() OVER (PARTITION BY date_trunc('week', day) ORDER BY n DESC, day) AS place
  FROM {name}_counts),
{name}_effects AS (
  SELECT kind, day AS anchor, CAST(day - days_before AS DATE) AS first, CAST(day + days_after AS DATE) AS last
  FROM {name}_weeks JOIN (VALUES {_KINDS}) k(slot, kind, days_before, days_after)
    ON k.slot = (date_diff('day', DATE '1970-01-05', week) // 7) % 7
  WHERE place = 1),
{name}_days AS (
  SELECT kind AS calendar_effect, kind AS calendar_effect_type, anchor AS actual_effect_date,
         CAST(unnest(generate_series(first, last, INTERVAL 1 DAY)) AS DATE) AS date
  FROM {name}_effects)""")
    _fragment(f"{name}_labels", (f"{name}_days",), f"""{name}_labels AS (
  SELECT *, CAST(date_diff('day', actual_effect_date, date) AS INTEGER) AS day_offset,
         calendar_effect_type || CASE
           WHEN date = actual_effect_date THEN '_DAY_0'
           WHEN date > actual_effect_date
             THEN '_DAY_PLUS_' || date_diff('day', actual_effect_date, date)
           ELSE '_DAY_MINUS_' || date_diff('day', date, actual_effect_date) END AS calendar_effect_day
  FROM {name}_days)""")
    _fragment(f"{name}_flags", (f"{name}_labels",), f"""{name}_flags AS (
  SELECT date, {_FLAG_COLUMNS} FROM {name}_labels GROUP BY date)""")


_calendar_fragment("order_cal", "orders", "o_orderdate")
_calendar_fragment("event_cal", "events", "ts")

# Features


def _features_fragment(name: str, life: str, flags: str) -> None:
    _fragment(name, (life, flags), f"""{name} AS (
  SELECT l.*, 'ST' || l.product_id AS style, {_FILLED_FLAGS}
  FROM {life} l LEFT JOIN {flags} f USING (date))""")


_features_fragment("part_features", "part_life", "order_cal_flags")
_features_fragment("brand_features", "brand_life", "order_cal_flags")
_features_fragment("user_features", "user_life", "event_cal_flags")

# Eligibility and training

_EXCLUDED = "(age_category IN ('00| Draft', '01| New') OR sales_category IN ('01| Dead'))"
_fragment("rules", (), f"rules(category, look_back, factor, changepoints, prior) AS (VALUES {RULES})")


def _training_fragment(prefix: str, life: str, settings: Settings) -> None:
    end, start = settings.history_end, settings.forecast_start
    _fragment(f"{prefix}_history", (life,), f"""{prefix}_history AS (
  SELECT product_id, date, sales_units, age_category, sales_category, age_sales_category,
         'ST' || product_id AS style
  FROM {life} WHERE date <= DATE '{end}')""")
    _fragment(f"{prefix}_excluded", (f"{prefix}_history",), f"""{prefix}_excluded AS (
  SELECT DISTINCT product_id FROM {prefix}_history WHERE date = DATE '{end}' AND {_EXCLUDED})""")
    _fragment(f"{prefix}_qualified", (f"{prefix}_excluded",), f"""{prefix}_end AS (
  SELECT product_id, age_sales_category AS on_forecast_age_sales_category,
         sales_category AS on_forecast_sales_category, age_category AS on_forecast_age_category
  FROM {prefix}_history h WHERE date = DATE '{end}'
    AND NOT EXISTS (SELECT 1 FROM {prefix}_excluded x WHERE x.product_id = h.product_id)),
{prefix}_qualified AS (
  SELECT h.*, e.on_forecast_age_sales_category, e.on_forecast_sales_category, e.on_forecast_age_category
  FROM {prefix}_history h JOIN {prefix}_end e USING (product_id))""")
    _fragment(f"{prefix}_training", (f"{prefix}_qualified", "rules"), f"""{prefix}_ranked AS (
  SELECT q.*, coalesce(r.look_back, {OTHER_LOOK_BACK}) AS look_back,
         coalesce(r.factor, {OTHER_FACTOR}) AS over_forecast_factor,
         coalesce(r.changepoints, {OTHER_CHANGEPOINTS}) AS changepoints,
         coalesce(r.prior, {OTHER_PRIOR}) AS changepoint_prior,
         row_number() OVER (PARTITION BY product_id ORDER BY date DESC) AS back
  FROM {prefix}_qualified q LEFT JOIN rules r ON r.category = q.on_forecast_age_sales_category
  WHERE date < DATE '{start}'),
{prefix}_training AS (
  SELECT product_id, on_forecast_age_sales_category, on_forecast_age_category,
         on_forecast_sales_category, style, CAST(look_back AS INTEGER) AS look_back,
         CAST(over_forecast_factor AS DOUBLE) AS over_forecast_factor,
         CAST(changepoints AS INTEGER) AS changepoints,
         CAST(changepoint_prior AS DOUBLE) AS changepoint_prior, date, sales_units AS y,
         CAST(row_number() OVER (PARTITION BY product_id ORDER BY date) - 1 AS INTEGER) AS t,
         CAST(count(*) OVER (PARTITION BY product_id) AS INTEGER) AS n
  FROM {prefix}_ranked WHERE back <= look_back)""")


_training_fragment("user", "user_life", fx.USER)
_training_fragment("event", "event_life", fx.USER)
_training_fragment("sparse", "sparse_life", fx.USER)
_training_fragment("sparse_event", "sparse_event_life", fx.USER)
_training_fragment("brand", "brand_life", fx.ITEM)
_training_fragment("gap", "brand_life", fx.GAP)

# Training rows of dense parts: only the last 60 days of the dense panel can be trained on.
_END = fx.ITEM.history_end
_fragment("part_rules", ("part_sales", "rules"), f"""part_end AS (
  SELECT product_id,
         CASE WHEN min(date) FILTER (WHERE sales_units > 0) IS NULL THEN 0
              ELSE date_diff('day', min(date) FILTER (WHERE sales_units > 0), DATE '{_END}') + 1
         END AS day_in_stock,
         coalesce(sum(sales_units) FILTER (
           WHERE date BETWEEN DATE '{_END}' - 13 AND DATE '{_END}'), 0) AS recent
  FROM part_sales GROUP BY 1),
part_labels AS (
  SELECT product_id, {_age('day_in_stock')} AS age_category,
         {_sales('day_in_stock', 'recent')} AS sales_category FROM part_end),
part_eligible AS (
  SELECT *, age_category || '_' || {_summary('sales_category')} AS category
  FROM part_labels WHERE NOT {_EXCLUDED}),
part_rules AS (
  SELECT e.*, coalesce(r.look_back, {OTHER_LOOK_BACK}) AS look_back,
         coalesce(r.factor, {OTHER_FACTOR}) AS factor,
         coalesce(r.changepoints, {OTHER_CHANGEPOINTS}) AS changepoints,
         coalesce(r.prior, {OTHER_PRIOR}) AS prior
  FROM part_eligible e LEFT JOIN rules r USING (category))""")


def _part_training(name: str, rules: str) -> str:
    return f"""{name}_spread AS (
  SELECT *, unnest(generate_series(0, look_back - 1)) AS t FROM {rules}),
{name}_training AS (
  SELECT p.product_id, category AS on_forecast_age_sales_category,
         age_category AS on_forecast_age_category, sales_category AS on_forecast_sales_category,
         'ST' || p.product_id AS style, CAST(look_back AS INTEGER) AS look_back,
         CAST(factor AS DOUBLE) AS over_forecast_factor, CAST(changepoints AS INTEGER) AS changepoints,
         CAST(prior AS DOUBLE) AS changepoint_prior,
         CAST(DATE '{_END}' - CAST(look_back - 1 - t AS INTEGER) AS DATE) AS date,
         CAST(coalesce(s.sales_units, 0) AS BIGINT) AS y, CAST(t AS INTEGER) AS t,
         CAST(look_back AS INTEGER) AS n
  FROM {name}_spread p LEFT JOIN part_sales s ON s.product_id = p.product_id
    AND s.date = DATE '{_END}' - CAST(look_back - 1 - t AS INTEGER))"""


_fragment("part_training", ("part_rules",), _part_training("part", "part_rules"))
_fragment("short_training", ("part_rules",), "short_rules AS (SELECT * REPLACE (13 AS look_back) FROM part_rules),\n"
          + _part_training("short", "short_rules"))

# Forecasts


def _forecast_fragments(prefix: str, settings: Settings) -> None:
    enough = f"{prefix}_enough"
    _fragment(enough, (f"{prefix}_training",), f"""{enough} AS (
  SELECT * FROM {prefix}_training WHERE n >= 8)""")
    _fragment(f"{prefix}_products", (enough,), f"""{prefix}_products AS (
  SELECT product_id, any_value(on_forecast_age_sales_category) AS age_sales_category,
         any_value(on_forecast_age_category) AS age_category,
         any_value(on_forecast_sales_category) AS sales_category, any_value(style) AS style,
         any_value(over_forecast_factor) AS factor, any_value(n) AS n,
         avg(CASE WHEN y = 0 THEN 1.0 ELSE 0.0 END) FILTER (WHERE t >= n - 14) AS zero_ratio
  FROM {enough} GROUP BY product_id)""")
    _fragment(f"{prefix}_horizon", (), f"""{prefix}_horizon AS (
  SELECT CAST(DATE '{settings.forecast_start}' + CAST(step AS INTEGER) AS DATE) AS date, step
  FROM (SELECT unnest(generate_series(0, 13)) AS step))""")
    # Interval by interval, from the definition.
    _fragment(f"{prefix}_croston", (f"{prefix}_products",), f"""{prefix}_intervals AS (
  SELECT product_id, t - lag(t, 1, 0) OVER (PARTITION BY product_id ORDER BY t) AS gap
  FROM {enough} WHERE y > 0 AND t >= 1),
{prefix}_gaps AS (
  SELECT product_id, avg(gap) AS mean_gap FROM {prefix}_intervals GROUP BY 1),
{prefix}_demand AS (
  SELECT product_id, avg(y) AS mean_demand, count(*) AS demands FROM {enough} WHERE y > 0 GROUP BY 1),
{prefix}_croston AS (
  SELECT p.product_id, CASE WHEN g.mean_gap IS NULL THEN 0.0
    ELSE d.mean_demand / (CASE WHEN d.demands = 1 THEN p.n ELSE g.mean_gap END) * 0.8 * p.factor END AS value
  FROM {prefix}_products p LEFT JOIN {prefix}_demand d USING (product_id)
  LEFT JOIN {prefix}_gaps g USING (product_id))""")
    _fragment(f"{prefix}_trend", (f"{prefix}_products",), f"""{prefix}_line AS (
  SELECT product_id, min(date) AS first_date, coalesce(regr_slope(y, date_diff('day', DATE '1970-01-01', date)), 0) AS slope,
         avg(y) FILTER (WHERE y IS NOT NULL)
           - coalesce(regr_slope(y, date_diff('day', DATE '1970-01-01', date)), 0)
             * avg(date_diff('day', first_date_of, date)) FILTER (WHERE y IS NOT NULL) AS intercept
  FROM (SELECT *, min(date) OVER (PARTITION BY product_id) AS first_date_of FROM {enough}) GROUP BY 1),
{prefix}_season AS (
  SELECT e.product_id, dayofweek(e.date) AS weekday,
         sum(e.y) / sum(greatest(l.intercept + l.slope * date_diff('day', l.first_date, e.date), 0.01)) AS ratio
  FROM {enough} e JOIN {prefix}_line l USING (product_id) WHERE e.n >= 14 GROUP BY 1, 2),
{prefix}_trend AS (
  SELECT p.product_id, h.date, greatest(
    (l.intercept + l.slope * date_diff('day', l.first_date, h.date)) * coalesce(s.ratio, 1) * p.factor, 0) AS value
  FROM {prefix}_products p CROSS JOIN {prefix}_horizon h JOIN {prefix}_line l USING (product_id)
  LEFT JOIN {prefix}_season s ON s.product_id = p.product_id AND s.weekday = dayofweek(h.date))""")


for _prefix, _settings in (("user", fx.USER), ("event", fx.USER), ("sparse_event", fx.USER), ("brand", fx.ITEM),
                           ("gap", fx.GAP), ("part", fx.ITEM), ("short", fx.ITEM)):
    _forecast_fragments(_prefix, _settings)

_CATEGORIES = "p.product_id, p.age_sales_category, p.age_category, p.sales_category, p.style"


def _croston_select(prefix: str) -> str:
    return (f"SELECT {_CATEGORIES}, 'croston' AS forecast_method, h.date, round(c.value + 1e-9, 6) AS forecast "
            f"FROM {prefix}_products p JOIN {prefix}_croston c USING (product_id) CROSS JOIN {prefix}_horizon h")


def _trend_select(prefix: str) -> str:
    return (f"SELECT {_CATEGORIES}, 'trend_weekday' AS forecast_method, v.date, round(v.value + 1e-9, 6) AS forecast "
            f"FROM {prefix}_products p JOIN {prefix}_trend v USING (product_id)")


# The changepoint model without a season is a ridge regression on 1, x and the bend's hinge, where x runs from 0 to 1 over the
# thirteen training days and the bend is at the tenth.  Its normal equations are solved by determinants.
_HINGE = "greatest(t - 9, 0) / 12.0"
_fragment("short_line", ("short_products",), """short_line_fit AS (
  SELECT product_id, regr_slope(y, t) AS slope, regr_intercept(y, t) AS intercept FROM short_enough GROUP BY 1)""")
_fragment("short_bend", ("short_products",), f"""short_sums AS (
  SELECT product_id, any_value(changepoint_prior) AS prior, CAST(count(*) AS DOUBLE) AS n, sum(t / 12.0) AS x, sum({_HINGE}) AS h,
         sum(t / 12.0 * t / 12.0) AS xx, sum(t / 12.0 * {_HINGE}) AS xh,
         sum({_HINGE} * {_HINGE}) + 1 / (any_value(changepoint_prior) ** 2 * 13) AS hh,
         CAST(sum(y) AS DOUBLE) AS y, sum(t / 12.0 * y) AS xy, sum({_HINGE} * y) AS hy
  FROM short_enough GROUP BY 1),
short_bend_fit AS (
  SELECT product_id, (n * (xx * hh - xh * xh) - x * (x * hh - xh * h) + h * (x * xh - xx * h)) AS det,
    (y * (xx * hh - xh * xh) - x * (xy * hh - xh * hy) + h * (xy * xh - xx * hy)) AS det0,
    (n * (xy * hh - xh * hy) - y * (x * hh - xh * h) + h * (x * hy - xy * h)) AS det1,
    (n * (xx * hy - xy * xh) - x * (x * hy - xy * h) + y * (x * xh - xx * h)) AS det2
  FROM short_sums)""")

# With a Laplace prior the bend is what the line leaves of it, less a constant: the line's mean square over the prior.
_fragment("short_sparse", ("short_products",), f"""short_scaled AS (
  SELECT *, y / max(abs(y)) OVER (PARTITION BY product_id) AS u, t / 12.0 AS x, {_HINGE} AS h,
         max(abs(y)) OVER (PARTITION BY product_id) AS scale FROM short_enough),
short_moments AS (
  SELECT product_id, any_value(changepoint_prior) AS prior, any_value(scale) AS scale, avg(u) AS mean_u, avg(x) AS mean_x, avg(h) AS mean_h,
         regr_sxx(u, x) AS xx, regr_sxy(u, x) AS xu, regr_syy(u, x) AS uu, regr_sxy(h, x) AS xh, regr_syy(h, x) AS hh, regr_sxy(u, h) AS hu,
         count(*) AS n
  FROM short_scaled GROUP BY 1),
short_threshold AS (
  SELECT *, hu - xh * xu / xx AS own, hh - xh * xh / xx AS room, (uu - xu * xu / xx) / n / prior AS least FROM short_moments),
short_bent AS (
  SELECT *, CASE WHEN own > least THEN own - least WHEN own < -least THEN own + least ELSE 0 END / room AS bend FROM short_threshold),
short_sparse_fit AS (
  SELECT product_id, scale, bend, (xu - bend * xh) / xx AS slope, mean_u - (xu - bend * xh) / xx * mean_x - bend * mean_h AS intercept
  FROM short_bent)""")


def _fitted_sql(fit: str, value: str) -> str:
    return _sql(
        f"""SELECT {_CATEGORIES}, CASE WHEN p.zero_ratio >= 1 THEN 'croston' ELSE 'changepoint' END AS forecast_method, h.date,
  round(CASE WHEN p.zero_ratio >= 1 THEN 0 ELSE greatest({value} * p.factor, 0) END, 3) AS forecast
FROM short_products p CROSS JOIN short_horizon h JOIN {fit}_fit f USING (product_id)""", fit, "short_products", "short_horizon")


# What a run by the model shares with any run: rows, categories, methods, and the intermittent values.
_MODEL_JOB_SELECT = (
    f"SELECT {_CATEGORIES}, CASE WHEN p.zero_ratio >= 0.6 THEN 'croston' ELSE 'changepoint' END AS forecast_method, h.date, "
    "CASE WHEN p.zero_ratio >= 0.6 THEN round(c.value + 1e-9, 6) END AS intermittent, CAST(1 AS INTEGER) AS run_id "
    "FROM user_products p JOIN user_croston c USING (product_id) CROSS JOIN user_horizon h")


def _forecast_sql(prefix: str) -> str:
    return _sql(f"{_croston_select(prefix)} WHERE p.zero_ratio >= 0.6 UNION ALL "
                f"{_trend_select(prefix)} WHERE p.zero_ratio < 0.6",
                f"{prefix}_horizon", f"{prefix}_croston", f"{prefix}_trend")


# Runs

_RUN_ROWS = ", ".join(f"({number}, DATE '{first}', DATE '{last}')" for number, first, last in fx.RUNS)
_fragment("runs", ("user_life",), f"""run_list(run_id, first, last) AS (VALUES {_RUN_ROWS}),
run_weeks AS (
  SELECT r.run_id, r.first, r.last, u.product_id,
         sum(u.sales_units) FILTER (WHERE u.date BETWEEN r.first - 7 AND r.first - 1) AS week
  FROM run_list r CROSS JOIN user_life u GROUP BY ALL),
run_ends AS (
  SELECT * FROM user_life WHERE date = DATE '{fx.USER.history_end}'),
runs AS (
  SELECT w.product_id, e.age_sales_category, e.age_category, e.sales_category,
         'ST' || w.product_id AS style, 'croston' AS forecast_method,
         CAST(unnest(generate_series(w.first, w.last, INTERVAL 1 DAY)) AS DATE) AS date,
         round(w.week / 7.0, 6) AS forecast, CAST(w.run_id AS INTEGER) AS run_id
  FROM run_weeks w JOIN run_ends e USING (product_id) WHERE w.run_id <> 2 OR w.week > 0)""")
_fragment("latest", ("runs",), """latest AS (
  SELECT * FROM runs r WHERE run_id = (SELECT max(run_id) FROM runs o WHERE o.date = r.date))""")

# Evaluation.  Adding zero turns a rounded negative zero into zero, which Spark's round always gives.


def _bin(method: str, value: str) -> str:
    """The label of the last bin that starts at or below the value; the last bin for null."""
    table, unit = (BIAS_BINS, 100.0) if method == "bias" else (ERROR_BINS, 1.0)
    last = "22| > +100" if method == "bias" else "22| > +50"
    return (f"coalesce((SELECT max(b.label) FROM (VALUES {table}) b(label, lo, hi) "
            f"WHERE {value} >= CAST(b.lo AS DOUBLE) / CAST({unit} AS DOUBLE)), '{last}')")


def _scored(source: str) -> str:
    """Add bias, error and bins to a relation with sales_units and forecast."""
    return (f"SELECT *, {_bin('bias', 'bias')} AS bias_bin, {_bin('error', 'error')} AS error_bin FROM ("
            "SELECT *, CASE WHEN sales_units > 0 THEN (forecast - sales_units) / sales_units "
            "WHEN sales_units = 0 THEN (forecast - sales_units) / CAST(0.00001 AS DOUBLE) ELSE 0 END AS bias, "
            f"forecast - sales_units AS error FROM {source})")


_KEYS = "product_id, style, age_sales_category, age_category, sales_category, forecast_method"
_fragment("evaluation", ("latest", "user_sales"), f"""evaluation_sums AS (
  SELECT {_KEYS}, CAST(sum(u.sales_units) AS BIGINT) AS sales_units, round(sum(forecast), 9) AS forecast
  FROM latest JOIN user_sales u USING (product_id, date) GROUP BY ALL),
evaluation AS ({_scored('evaluation_sums')})""")
_fragment("validation", ("latest", "user_features"), f"""validation_rows AS (
  SELECT coalesce(u.product_id, f.product_id) AS product_id, coalesce(u.date, f.date) AS date,
         u.* EXCLUDE (product_id, date), f.forecast_method, f.forecast
  FROM user_features u FULL JOIN latest f ON u.product_id = f.product_id AND u.date = f.date),
validation_filled AS (
  SELECT * REPLACE (last_value(style IGNORE NULLS) OVER (PARTITION BY product_id ORDER BY date) AS style)
  FROM validation_rows),
validation AS ({_scored('validation_filled')})""")
_fragment("scored_days", ("runs", "user_sales"), f"""run_actuals AS (
  SELECT r.product_id, r.date, r.run_id, r.forecast, u.sales_units
  FROM runs r JOIN user_sales u USING (product_id, date)),
scored_days AS ({_scored('run_actuals')})""")
_fragment("scored_brands", ("brand_life",), f"""brand_guess AS (
  SELECT *, round(recent_sales_units / 14.0, 3) AS forecast FROM brand_life),
scored_brands AS ({_scored('brand_guess')})""")

_fragment("scored_parts", ("part_life",), f"""part_guess AS (
  SELECT *, round(recent_sales_units / 14.0, 3) AS forecast FROM part_life),
scored_parts AS ({_scored('part_guess')})""")


def _accuracy(source: str, method: str, where: str, low: float, high: float, overlap: bool) -> str:
    good = f"b.lo <= {high} AND b.hi >= {low}" if overlap else f"b.lo >= {low} AND b.hi <= {high}"
    bins = BIAS_BINS if method == "bias" else ERROR_BINS
    return f"""SELECT b.label AS {method}_bin, b.units_in_bin, b.bin_start, b.bin_end, b.is_good,
  round_even(b.units_in_bin / t.divisor * 100, 1) AS percentage_of_target,
  round_even(t.good / t.divisor * 100, 1) AS good_percent, CAST(b.position - 10 AS INTEGER) AS bin_numeric_pos
FROM filled b CROSS JOIN (
  SELECT CAST(sum(units_in_bin) FILTER (WHERE is_good) AS DOUBLE) AS good,
         CAST(CASE WHEN sum(units_in_bin) = 0 THEN 1 ELSE sum(units_in_bin) END AS DOUBLE) AS divisor
  FROM filled) t""", f"""filled AS (
  SELECT CAST(left(b.label, 2) AS INTEGER) - 1 AS position, b.label, CAST(b.lo AS DOUBLE) AS bin_start,
         CAST(b.hi AS DOUBLE) AS bin_end, {good} AS is_good, CAST(coalesce(u.units, 0) AS BIGINT) AS units_in_bin
  FROM (VALUES {bins}) b(label, lo, hi)
  LEFT JOIN (SELECT {method}_bin AS label, sum(sales_units) AS units FROM {source} {where} GROUP BY 1) u
  USING (label))"""


def _accuracy_sql(source: str, method: str, low: float, high: float, where: str = "",
                  overlap: bool = False) -> str:
    select, filled = _accuracy(source, method, where, low, high, overlap)
    return _sql(select, source).replace("\nSELECT b.label", ",\n" + filled + "\nSELECT b.label", 1)


def _by_category_sql() -> str:
    return _sql("""SELECT sales_category, label AS bias_bin, units_in_bin, bin_start, bin_end, is_good,
  round_even(units_in_bin / divisor * 100, 1) AS percentage_of_target, round_even(good / divisor * 100, 1) AS good_percent,
  CAST(CAST(left(label, 2) AS INTEGER) - 11 AS INTEGER) AS bin_numeric_pos
FROM (SELECT *, CAST(coalesce(sum(units_in_bin) FILTER (WHERE is_good) OVER c, 0) AS DOUBLE) AS good,
             CAST(CASE WHEN sum(units_in_bin) OVER c = 0 THEN 1 ELSE sum(units_in_bin) OVER c END AS DOUBLE) AS divisor
      FROM by_category WINDOW c AS (PARTITION BY sales_category))""", "by_category")


_fragment("by_category", ("scored_parts",), f"""by_category_units AS (
  SELECT sales_category, bias_bin AS label, sum(sales_units) AS units FROM scored_parts GROUP BY 1, 2),
by_category AS (
  SELECT c.sales_category, b.label, CAST(b.lo AS DOUBLE) AS bin_start, CAST(b.hi AS DOUBLE) AS bin_end,
         CAST(coalesce(u.units, 0) AS BIGINT) AS units_in_bin,
         b.lo >= coalesce(r.low, -20) AND b.hi <= coalesce(r.high, 30) AS is_good
  FROM (SELECT DISTINCT sales_category FROM scored_parts) c CROSS JOIN (VALUES {BIAS_BINS}) b(label, lo, hi)
  LEFT JOIN by_category_units u ON u.sales_category = c.sales_category AND u.label = b.label
  LEFT JOIN (VALUES ('02| Very Low', -60, 60), ('03| Low', -40, 50), ('05| Medium', -20, 30), ('07| High Winning', -10, 20))
    r(category, low, high) ON r.category = c.sales_category)""")


def _percent(part: str, whole: str) -> str:
    return f"coalesce(round_even(CAST({part} AS DOUBLE) / nullif({whole}, 0) * 100, 1), 0.0)"


_HISTORY_COLUMNS = ("product_id, date, sales_units, age_category, sales_category, "
                    "age_sales_category, style")
_AGES = ("00| Draft", "01| New", "02| Launch", "03| Growth", "04| Mature")
_REGRESSORS = fx.USER.all_regressors

ORACLE: dict[str, str] = {
    "scan_filtered": (
        "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem "
        "WHERE l_shipdate >= TIMESTAMP '1996-01-01' AND l_shipdate <= TIMESTAMP '2000-12-31' "
        "AND l_returnflag = 'R' AND l_linestatus = 'F'"),
    "scan_ordered": (
        "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem "
        "WHERE l_shipdate >= TIMESTAMP '1996-01-01' AND l_shipdate <= TIMESTAMP '2000-12-31' "
        "AND l_returnflag = 'R' AND l_linestatus = 'F'"),
    "scan_sales_since": _sql(
        "SELECT id, product_id, shopify_product_id, date AS day, sales_units AS units_sold, sales_amount "
        "FROM part_sales WHERE date >= DATE '1998-01-03'", "part_sales"),
    "sales_profile": _sql(
        "SELECT count(*) AS sales_rows, min(date) AS first_day, max(date) AS last_day FROM part_sales",
        "part_sales"),
    "features_roundtrip": _sql("SELECT * FROM part_features", "part_features"),
    "runs_roundtrip": _sql("SELECT * FROM runs", "runs"),
    "run_by_id": _sql("SELECT * FROM runs WHERE run_id = 2", "runs"),
    "list_runs": _sql("SELECT run_id, count(*) AS forecast_rows, min(date) AS first_date, "
                      "max(date) AS last_date FROM runs GROUP BY run_id ORDER BY run_id", "runs"),
    "next_run_id": _sql("SELECT CAST(coalesce(max(run_id), 0) + 1 AS INTEGER) AS next_run_id FROM runs",
                        "runs"),
    "append_table": _sql(
        "SELECT product_id, date AS day, sales_units AS units_sold, sales_amount FROM sparse_events "
        "UNION ALL SELECT product_id, date AS day, sales_units AS units_sold, sales_amount FROM sparse_events",
        "sparse_events"),
    "day_in_stock": _sql("SELECT product_id, date, sales_units, day_in_stock FROM part_life", "part_life"),
    "age_category": _sql("SELECT product_id, date, age_category FROM part_life", "part_life"),
    "sales_category": _sql("SELECT product_id, date, sales_category FROM part_life", "part_life"),
    "age_sales_category": _sql("SELECT product_id, date, summarized_sales_category, age_sales_category "
                               "FROM part_life", "part_life"),
    "salary_period": _sql('SELECT product_id, date, "SALARY_PERIOD" FROM part_life', "part_life"),
    "recent_sales_units": _sql("SELECT product_id, date, recent_sales_units FROM part_life", "part_life"),
    "cumulative_sales": _sql("SELECT product_id, date, cumulative_sales FROM part_life", "part_life"),
    "dense_panel": _sql("SELECT product_id, date AS day, sales_units AS units_sold, sales_amount "
                        "FROM brand_sales", "brand_sales"),
    "dense_catalogue": _sql("SELECT product_id, date, sales_units, sales_amount, day_in_stock, age_sales_category "
                            "FROM catalogue_life", "catalogue_life"),
    "density_check": _sql(
        "SELECT product_id, count(*) AS day_rows, date_diff('day', min(date), max(date)) + 1 AS calendar_days "
        "FROM part_sales GROUP BY 1 HAVING count(*) <> date_diff('day', min(date), max(date)) + 1",
        "part_sales"),
    "calendar_days": _sql("SELECT * FROM order_cal_days", "order_cal_days"),
    "calendar_labels": _sql("SELECT * FROM order_cal_labels", "order_cal_labels"),
    "calendar_flags": _sql(f"SELECT s.date, {_FILLED_FLAGS} FROM (SELECT DISTINCT date FROM part_sales) s "
                           "LEFT JOIN order_cal_flags f USING (date)", "part_sales", "order_cal_flags"),
    "missing_dates": _sql("SELECT date FROM part_sales EXCEPT SELECT date FROM order_cal_flags",
                          "part_sales", "order_cal_flags"),
    "missing_dates_sample": _sql(
        "SELECT least(5, n) AS sampled, least(5, n) AS different, least(5, n) AS missing FROM (SELECT count(*) AS n FROM ("
        "SELECT date FROM part_sales EXCEPT SELECT date FROM order_cal_flags))", "part_sales", "order_cal_flags"),
    "active_effects": _sql(
        " UNION ALL ".join(f"SELECT style, date, '{name}' AS effect FROM brand_features WHERE \"{name}\" > 0"
                           for name in ("SALARY_PERIOD", *(x for x in fx.LABELS if x.endswith("_DAY_0")))),
        "brand_features"),
    "sales_with_style": _sql(
        "SELECT id, product_id, shopify_product_id, date, sales_units, sales_amount, "
        "CASE WHEN p_partkey IS NOT NULL THEN 'ST' || p_partkey END AS style "
        "FROM part_sales LEFT JOIN part ON p_partkey = product_id", "part_sales"),
    "features": _sql("SELECT * FROM part_features", "part_features"),
    "features_sparse_flags": _sql(
        "SELECT l.*, 'ST' || l.product_id AS style, coalesce(f.flags, '') AS flags FROM part_life l LEFT JOIN (SELECT date, "
        "string_agg(DISTINCT calendar_effect_day, ',' ORDER BY calendar_effect_day) AS flags FROM order_cal_labels GROUP BY date) f "
        "USING (date)", "part_life", "order_cal_labels"),
    "lifecycle_state": _sql(
        "SELECT product_id, min(date) FILTER (sales_units > 0) AS first_sale, CAST(sum(sales_units) AS BIGINT) AS units, "
        "max(date) AS last_date, string_agg(sales_units, ',' ORDER BY date) FILTER (back <= 13) AS last_units FROM (SELECT *, "
        "row_number() OVER (PARTITION BY product_id ORDER BY date DESC) AS back FROM part_sales) GROUP BY 1", "part_sales"),
    "features_incremental": _sql("SELECT * FROM part_features", "part_features"),
    "feature_totals": _sql("SELECT count(*) AS total_records, CAST(coalesce(sum(sales_units), 0) AS BIGINT) "
                           "AS total_sales_units FROM part_sales", "part_sales"),
    "regressor_numeric": (
        "SELECT event_id, coalesce(TRY_CAST(CASE WHEN event_type = 'error' THEN props "
        "ELSE CAST(value AS VARCHAR) END AS DOUBLE), 0.0) AS regressor FROM events"),
    "history_cut": _sql("SELECT * FROM user_history", "user_history"),
    "non_eligible": _sql("SELECT * FROM user_excluded", "user_excluded"),
    "eligible_history": _sql("SELECT * FROM user_history WHERE product_id NOT IN "
                             "(SELECT product_id FROM user_excluded)", "user_excluded"),
    "qualified_history": _sql("SELECT * FROM user_qualified", "user_qualified"),
    "age_distribution": _sql(
        "SELECT age_category, count(DISTINCT product_id) AS distinct_products, "
        f"CAST(sum(sales_units) AS BIGINT) AS total_sales_units FROM part_life WHERE date <= DATE '{_END}' "
        "GROUP BY 1 ORDER BY 1", "part_life"),
    "sales_distribution": _sql(
        "SELECT sales_category, count(DISTINCT product_id) AS distinct_products, "
        f"CAST(sum(sales_units) AS BIGINT) AS total_sales_units FROM part_life WHERE date <= DATE '{_END}' "
        "GROUP BY 1 ORDER BY 1", "part_life"),
    "history_profile": _sql(
        "SELECT count(*) AS total_records, count(DISTINCT product_id) AS unique_products, "
        f"min(date) AS first_date, max(date) AS last_date FROM part_life WHERE date <= DATE '{_END}'",
        "part_life"),
    "recent_sales_stats": _sql(
        "SELECT min(recent_sales_units) AS min_recent_sales, max(recent_sales_units) AS max_recent_sales, "
        "round(avg(recent_sales_units), 6) AS avg_recent_sales, "
        f"count(*) FILTER (WHERE recent_sales_units = 0) AS zero_recent_products FROM part_life "
        f"WHERE date = DATE '{_END}'", "part_life"),
    "filter_impact": _sql(
        f"""SELECT r.rule, CAST(r.products AS BIGINT) AS products, CAST(r.units AS BIGINT) AS units,
  {_percent('r.products', 't.products')} AS product_pct, {_percent('r.units', 't.units')} AS unit_pct
FROM impact r CROSS JOIN (SELECT products, units FROM impact WHERE rule = 'total') t""",
        "part_life").replace("\nSELECT r.rule", """,
impact_flagged AS (
  SELECT DISTINCT product_id FROM part_life WHERE """ + _EXCLUDED + """),
impact AS (
  SELECT 'age' AS rule, count(DISTINCT product_id) AS products, coalesce(sum(sales_units), 0) AS units
  FROM part_life WHERE age_category IN ('00| Draft', '01| New')
  UNION ALL SELECT 'sales', count(DISTINCT product_id), coalesce(sum(sales_units), 0)
  FROM part_life WHERE sales_category = '01| Dead'
  UNION ALL SELECT 'combined', count(DISTINCT product_id), coalesce(sum(sales_units), 0)
  FROM part_life WHERE product_id IN (SELECT product_id FROM impact_flagged)
  UNION ALL SELECT 'remaining', count(DISTINCT product_id), coalesce(sum(sales_units), 0)
  FROM part_life WHERE product_id NOT IN (SELECT product_id FROM impact_flagged)
  UNION ALL SELECT 'total', count(DISTINCT product_id), coalesce(sum(sales_units), 0) FROM part_life)
SELECT r.rule""", 1),
    "training_window": _sql("SELECT * FROM event_training", "event_training"),
    "training_direct": _sql("SELECT * FROM part_training", "part_training"),
    "skipped_products": _sql("SELECT product_id, count(*) AS training_rows FROM sparse_training "
                             "GROUP BY 1 HAVING count(*) < 8", "sparse_training"),
    "zero_ratio": _sql("SELECT product_id, round(zero_ratio, 6) AS zero_ratio FROM user_products",
                       "user_products"),
    "method_choice": _sql("SELECT product_id, CASE WHEN zero_ratio >= 0.6 THEN 'croston' "
                          "ELSE 'trend_weekday' END AS forecast_method FROM user_products", "user_products"),
    "croston_forecast": _sql(_croston_select("user"), "user_horizon", "user_croston"),
    "trend_weekday_forecast": _sql(_trend_select("brand"), "brand_horizon", "brand_trend"),
    "trend_weekday_events": _sql(_trend_select("event"), "event_horizon", "event_trend"),
    "trend_weekday_gap": _sql(_trend_select("gap"), "gap_horizon", "gap_trend"),
    "trend_weekday_sparse": _sql(_trend_select("sparse_event"), "sparse_event_horizon", "sparse_event_trend"),
    "changepoint_line": _fitted_sql("short_line", "(f.intercept + f.slope * (13 + h.step))"),
    "changepoint_one_bend": _fitted_sql(
        "short_bend", "((f.det0 + f.det1 * (13 + h.step) / 12.0 + f.det2 * (4 + h.step) / 12.0) / f.det)"),
    "changepoint_sparse_bend": _fitted_sql(
        "short_sparse", "(f.scale * (f.intercept + f.slope * (13 + h.step) / 12.0 + f.bend * (4 + h.step) / 12.0))"),
    "changepoint_methods": _sql(
        "SELECT p.product_id, p.age_sales_category, p.style, CASE WHEN p.zero_ratio >= 0.6 THEN 'croston' "
        "ELSE 'changepoint' END AS forecast_method, h.date, CASE WHEN p.zero_ratio >= 0.6 "
        "THEN round(c.value + 1e-9, 6) END AS intermittent FROM part_products p JOIN part_croston c USING (product_id) "
        "CROSS JOIN part_horizon h", "part_croston", "part_horizon"),
    "horizon": _sql("SELECT product_id, h.date FROM (SELECT DISTINCT product_id FROM user_training) "
                    "CROSS JOIN user_horizon h", "user_training", "user_horizon"),
    "regressor_carry": _sql(
        "SELECT c.*, h.date FROM (SELECT product_id, "
        + ", ".join(f'CAST(arg_max("{name}", date) AS DOUBLE) AS "{name}"' for name in _REGRESSORS)
        + f" FROM user_features WHERE date <= DATE '{fx.USER.history_end}' GROUP BY product_id) c "
          "CROSS JOIN user_horizon h", "user_features", "user_horizon"),
    "forecast": _forecast_sql("user"),
    "forecast_direct": _forecast_sql("part"),
    "runs_union": _sql("SELECT * REPLACE (CASE WHEN run_id = 1 THEN NULL ELSE style END AS style) FROM runs",
                       "runs"),
    "latest_run_per_date": _sql("SELECT * FROM latest", "latest"),
    "latest_runs_indexed": _sql("SELECT * FROM latest", "latest"),
    "evaluation_table": _sql("SELECT * REPLACE (round(forecast, 6) AS forecast, round(bias, 4) + CAST(0 AS DOUBLE) AS bias, "
                             "round(error, 6) + CAST(0 AS DOUBLE) AS error) FROM evaluation", "evaluation"),
    "validation_table": _sql("SELECT * REPLACE (round(bias, 4) + CAST(0 AS DOUBLE) AS bias, round(error, 6) + CAST(0 AS DOUBLE) AS error) "
                             "FROM validation", "validation"),
    "bias_error": _sql("SELECT product_id, date, run_id, round(bias, 4) + CAST(0 AS DOUBLE) AS bias, round(error, 6) + CAST(0 AS DOUBLE) AS error "
                       "FROM scored_days", "scored_days"),
    "bias_bins": _sql("SELECT product_id, date, run_id, bias_bin FROM scored_days", "scored_days"),
    "error_bins": _sql("SELECT product_id, date, bias_bin, error_bin FROM scored_brands", "scored_brands"),
    "attribute_distribution": _sql(
        """SELECT g.*, round_even(product_count / t.products * 100, 1) AS product_count_pct,
  round_even(total_sales_units / t.units * 100, 1) AS total_sales_units_pct
FROM (SELECT sales_category, count(DISTINCT product_id) AS product_count,
             CAST(sum(sales_units) AS BIGINT) AS total_sales_units FROM evaluation GROUP BY 1) g
CROSS JOIN (SELECT CAST(sum(c) AS DOUBLE) AS products, CAST(sum(u) AS DOUBLE) AS units
            FROM (SELECT count(DISTINCT product_id) AS c, sum(sales_units) AS u
                  FROM evaluation GROUP BY sales_category)) t ORDER BY 1""", "evaluation"),
    "accuracy_bias": _accuracy_sql("evaluation", "bias", -20, 30),
    "accuracy_error": _accuracy_sql("evaluation", "error", -2, 4, overlap=True),
    "accuracy_category": _accuracy_sql("scored_brands", "bias", -40, 40,
                                       "WHERE sales_category = '07| High Winning'"),
    "accuracy_by_category": _by_category_sql(),
    "accuracy_excluding": _accuracy_sql(
        "scored_parts", "bias", -20, 30,
        "WHERE sales_category NOT IN ('02| Very Low', '03| Low', '07| High Winning')"),
    "business_daily": _sql(
        """SELECT date, sales_units, round(forecast, 6) AS forecast,
  round(CASE WHEN sales_units > 0 THEN (forecast - sales_units) / sales_units END, 4) + CAST(0 AS DOUBLE) AS bias
FROM (SELECT date, CAST(sum(sales_units) AS BIGINT) AS sales_units, sum(forecast) AS forecast
      FROM validation GROUP BY date) ORDER BY date""", "validation"),
    "business_window": _sql(
        """SELECT total_sales, round(total_forecast, 4) AS total_forecast,
  round(total_forecast - total_sales, 4) AS difference,
  round((total_forecast - total_sales) / nullif(total_sales, 0) * 100, 4) AS difference_pct
FROM (SELECT CAST(coalesce(sum(sales_units), 0) AS BIGINT) AS total_sales,
             coalesce(sum(forecast), 0) AS total_forecast FROM validation
      WHERE date BETWEEN DATE '2024-01-17' AND DATE '2024-01-30')""", "validation"),
    "products_by_age_pivot": _sql(
        "SELECT date, " + ", ".join(f"count(DISTINCT CASE WHEN age_category = '{age}' THEN product_id END) "
                                    f'AS "{age}"' for age in _AGES)
        + " FROM validation GROUP BY date", "validation"),
    "products_by_age_bitmap": _sql(
        "SELECT CAST(date_trunc('month', date) AS DATE) AS month, age_category, count(DISTINCT product_id) AS product_count "
        "FROM part_life GROUP BY ALL", "part_life"),
    "scorecard_one_pass": _sql(
        "SELECT CASE GROUPING(sales_category, bias_bin, error_bin) WHEN 3 THEN 'category' WHEN 5 THEN 'bias' WHEN 6 THEN 'error' "
        "WHEN 1 THEN 'category_bias' WHEN 2 THEN 'category_error' ELSE 'total' END AS view, sales_category, bias_bin, error_bin, "
        "count(DISTINCT product_id) AS product_count, count(*) AS rows, CAST(sum(sales_units) AS BIGINT) AS sales_units, "
        "round(sum(f), 6) AS forecast, round(sum(e), 6) + CAST(0 AS DOUBLE) AS error, arg_min(product_id, (-e, product_id)) AS worst_product "
        "FROM (SELECT *, round(forecast, 6) AS f, round(error, 6) + CAST(0 AS DOUBLE) AS e FROM evaluation) "
        "GROUP BY GROUPING SETS ((sales_category), (bias_bin), (error_bin), (sales_category, bias_bin), (sales_category, error_bin), ())",
        "evaluation"),
    "category_performance": _sql(
        "SELECT count(DISTINCT style) AS product_count, CAST(sum(sales_units) AS BIGINT) AS sales_units, "
        "round(sum(forecast), 4) AS forecast, round(sum(error), 4) AS error FROM evaluation "
        "WHERE sales_category = '02| Very Low'", "evaluation"),
    "worst_products": _sql(
        "SELECT product_id, style, sales_units, round(forecast, 6) AS forecast, round(error, 6) + CAST(0 AS DOUBLE) AS error "
        "FROM evaluation ORDER BY round(error, 6) DESC, product_id LIMIT 10", "evaluation"),
    "worst_in_category": _sql(
        "SELECT product_id, style, sales_units, round(forecast, 6) AS forecast, round(error, 6) + CAST(0 AS DOUBLE) AS error "
        "FROM evaluation WHERE sales_category = '02| Very Low' ORDER BY round(error, 6) DESC, product_id LIMIT 10", "evaluation"),
    "run_style_series": _sql("SELECT product_id, style, date, forecast, run_id FROM runs WHERE run_id = 3 AND style = 'ST7'",
                             "runs"),
    "daily_job_changepoint": _sql(_MODEL_JOB_SELECT, "user_croston", "user_horizon"),
    "daily_job_regressors": _sql(_MODEL_JOB_SELECT, "user_croston", "user_horizon"),
    "daily_job": _forecast_sql("user").replace(" AS forecast FROM", " AS forecast, CAST(1 AS INTEGER) AS run_id FROM"),
    "scorecard_job": _sql(
        "SELECT *, round(CASE WHEN sales_units > 0 THEN (exact - sales_units) / sales_units END, 4) + CAST(0 AS DOUBLE) AS bias, "
        "round(exact, 6) AS forecast FROM (SELECT date, CAST(sum(sales_units) AS BIGINT) AS sales_units, sum(forecast) AS exact, "
        "count(*) AS validation_rows, "
        + ", ".join(f"count(DISTINCT CASE WHEN age_category = '{age}' THEN product_id END) AS \"{age}\"" for age in _AGES)
        + " FROM validation GROUP BY date)", "validation").replace("SELECT *, round(CASE", "SELECT * EXCLUDE (exact), round(CASE"),
    "style_series": _sql(
        "SELECT product_id, style, date, sales_units, forecast, bias_bin, error_bin FROM validation "
        "WHERE style = 'ST7' ORDER BY date", "validation"),
    "product_card": "SELECT p_partkey AS id, 'ST' || p_partkey AS product_number, p_name AS product_title, "
                    "p_retailprice AS price, 'active' AS status FROM part WHERE p_partkey = 7",
}
