"""Forecast and what-if queries.

Queries compared with SQL run on the seasonal-naive forecast, which SQL can state; the fitted
forecast has its own two queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.catalog.registry import register
from headway.catalog.sql import along_calendar, case, rounded, text, with_ctes
from headway.functions.core import half_even
from headway.operators import scenario, series
from headway.plans.warehouse import Warehouse

BY = ["borough"]
AS_OF = "2026-01-01"

SERIES = {
    "means": "SELECT borough, date, avg(delay_minutes) AS value FROM trips GROUP BY borough, date",
    "spans": "SELECT borough, CAST(unnest(generate_series(low, high, INTERVAL 1 DAY)) AS DATE) AS date FROM "
    "(SELECT borough, min(date) AS low, max(date) AS high FROM means GROUP BY borough) AS b",
    "sparse": "SELECT spans.borough, spans.date, value FROM spans LEFT JOIN means ON spans.borough = means.borough AND spans.date = means.date",
    "filled": f"SELECT borough, date, {along_calendar('value', 'date', 'borough')} AS value FROM sparse",
    "naive": "SELECT borough, date + 7 AS date, value AS delay FROM filled QUALIFY row_number() OVER (PARTITION BY borough ORDER BY date DESC) <= 7",
    "outlook": "SELECT borough, date, value AS delay, 'Historical' AS type FROM filled UNION ALL SELECT borough, date, delay, 'Forecast' FROM naive",
}


def _naive(w: Warehouse) -> DataFrame:
    daily = w.borough_days
    return series.with_history(daily, series.seasonal_naive(daily, BY))


@register("daily_gapfill", with_ctes("SELECT borough, date, value FROM filled", SERIES))
def daily_gapfill(w: Warehouse):
    return series.daily_series(w.trips, BY)


@register(
    "forecast_reanchor",
    with_ctes(
        f"SELECT o.borough, o.delay, o.type, CAST(DATE '{AS_OF}' + CAST(o.date - e.last AS INTEGER) AS DATE) AS date FROM outlook AS o "
        "JOIN ends AS e ON o.borough = e.borough",
        {**SERIES, "ends": "SELECT borough, max(date) AS last FROM filled GROUP BY borough"},
    ),
)
def forecast_reanchor(w: Warehouse):
    return series.reanchor(_naive(w), AS_OF, BY)


_WEATHER_CASE = case([(f"w = {text(k)}", f"{v}e0") for k, v in scenario.WEATHER_DELTA.items()])
_EVENT_CASE = case([(f"e = {text(k)}", f"{v}e0") for k, v in scenario.EVENT_DELTA.items()])


@register(
    "forecast_scenario",
    with_ctes(
        f"SELECT o.borough, o.date, w AS weather_scenario, e AS event_scenario, o.type, "
        f"CASE o.type WHEN 'Forecast' THEN o.delay + ({_WEATHER_CASE} + {_EVENT_CASE}) ELSE o.delay END AS delay "
        "FROM outlook AS o JOIN starts ON o.borough = starts.borough AND o.date >= starts.start - 90 "
        f"CROSS JOIN (SELECT unnest([{', '.join(map(text, scenario.WEATHER_DELTA))}]) AS w) AS ws "
        f"CROSS JOIN (SELECT unnest([{', '.join(map(text, scenario.EVENT_DELTA))}]) AS e) AS es",
        {**SERIES, "starts": "SELECT borough, min(date) AS start FROM naive GROUP BY borough"},
    ),
)
def forecast_scenario(w: Warehouse):
    return scenario.scenarios(_naive(w), BY)


@register(
    "forecast_summary",
    with_ctes(
        "SELECT borough, date, delay, type, dayname(date) AS day_name, strftime(date, '%b %d') AS short_date, "
        "CASE WHEN delay > 60 THEN 'severe' WHEN delay > 40 THEN 'elevated' ELSE 'normal' END AS band FROM outlook WHERE type = 'Forecast'",
        SERIES,
    ),
)
def forecast_summary(w: Warehouse):
    return scenario.forecast_summary(_naive(w))


NETWORK = {
    "means": "SELECT date, avg(delay_minutes) AS value FROM trips GROUP BY date",
    "spans": "SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM means",
    "sparse": "SELECT spans.date, value FROM spans LEFT JOIN means ON spans.date = means.date",
    "filled": f"SELECT date, {along_calendar('value', 'date')} AS value FROM sparse",
    "naive": "SELECT date + 7 AS date, value AS delay FROM filled QUALIFY row_number() OVER (ORDER BY date DESC) <= 7",
    "outlook": "SELECT date, value AS delay, 'Historical' AS type FROM filled UNION ALL SELECT date, delay, 'Forecast' FROM naive",
}


@register("network_outlook", with_ctes("SELECT date, delay, type FROM outlook", NETWORK))
def network_outlook(w: Warehouse):
    """The daily series of the whole network with its last week repeated."""
    daily = w.network_days
    return series.with_history(daily, series.seasonal_naive(daily)).select("date", "delay", "type")


@register("network_forecast")
def network_forecast(w: Warehouse):
    """The fitted forecast of the whole network, re-anchored to a given day."""
    daily = w.network_days
    steps = series.forecast_steps(series.fit_holt_winters(daily))
    return series.reanchor(series.with_history(daily, steps), AS_OF)


_WEIGHTS = (0.3, 0.1, 0.2)
_SMOOTHED = """SELECT borough, CAST(any_value(days) AS INTEGER) AS days, sse, CAST(h AS INTEGER) AS step,
  level + h * trend + season[CAST(h AS BIGINT)] AS delay FROM (
  WITH RECURSIVE state AS (
    SELECT borough, days, 0 AS i, m1 AS level, (m2 - m1) / 7 AS trend, list_transform(week, lambda v: v - m1) AS season,
      CAST(0 AS DOUBLE) AS sse FROM opening
    UNION ALL
    SELECT borough, days, i + 1, level + trend + 0.3e0 * gap, trend + 0.3e0 * 0.1e0 * gap,
      list_concat(season[2:7], [season[1] + 0.2e0 * gap]), sse + gap * gap FROM (
      SELECT s.*, n.value - (s.level + s.trend) - s.season[1] AS gap FROM state AS s
      JOIN placed AS n ON n.borough = s.borough AND n.i = s.i) AS seen)
  SELECT * FROM state WHERE i = days) AS ended, range(1, 8) AS r(h) GROUP BY borough, sse, h, level, trend, season"""


@register(
    "hw_fixed_weights",
    with_ctes(
        f"SELECT borough, days, {rounded('sse', 4)} AS sse, step, {rounded('delay', 6)} AS delay FROM ({_SMOOTHED}) AS found "
        "JOIN (SELECT 1 FROM opening LIMIT 1) AS needed ON true",
        {
            **SERIES,
            "placed": "SELECT borough, value, row_number() OVER (PARTITION BY borough ORDER BY date) - 1 AS i, "
            "count(*) OVER (PARTITION BY borough) AS days FROM filled",
            "opening": "SELECT borough, any_value(days) AS days, avg(value) FILTER (WHERE i < 7) AS m1, "
            "avg(value) FILTER (WHERE i >= 7 AND i < 14) AS m2, list(value ORDER BY i) FILTER (WHERE i < 7) AS week "
            "FROM placed WHERE days >= 14 GROUP BY borough",
        },
    ),
)
def hw_fixed_weights(w: Warehouse):
    """Smoothing with given weights, day by day, and the week that follows."""
    found = series.smooth(w.borough_days, _WEIGHTS, BY).where("sse IS NOT NULL")
    steps = found.select("borough", "days", half_even(F.col("sse"), 4).alias("sse"), F.posexplode("steps").alias("at", "delay"))
    return steps.select("borough", "days", "sse", (F.col("at") + 1).alias("step"), half_even(F.col("delay"), 6).alias("delay"))


@register("hw_grid_fit")
def hw_grid_fit(w: Warehouse):
    """Weights, squared error and next week of every borough's series."""
    return series.fit_holt_winters(w.borough_days, BY)


@register("forecast")
def forecast(w: Warehouse):
    """History and the fitted forecast, re-anchored to a given day."""
    daily = w.borough_days
    steps = series.forecast_steps(series.fit_holt_winters(daily, BY), BY)
    return series.reanchor(series.with_history(daily, steps), AS_OF, BY)


