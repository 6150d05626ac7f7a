"""Reference SQL for DuckDB, written as named common table expressions."""

from __future__ import annotations

import re

from headway.catalog import roles
from headway.functions import calendar, delay, weather
from headway.functions.core import hash_multiplier
from headway.sources.generators import RECURRING_EVENTS, SEED_EVENTS
from headway.sources.schemas import WEATHER_MEASURES


def rounded(value: str, digits: int) -> str:
    """Half-even rounding; DuckDB's `round` goes half away from zero."""
    scale = f"1e{digits}"
    return f"(round_even(({value}) * {scale}, 0) / {scale})"


def finite(value: str) -> str:
    return f"CASE WHEN isfinite({value}) THEN {value} END"


def hashed(key: str, seed: int) -> str:
    low, high = f"(({key}) & 2147483647)", f"((({key}) >> 31) % 2147483647)"
    mixed = f"({low} * {hash_multiplier(seed)}) % 4294967296"
    more = f"({high} * {hash_multiplier(seed + 1)}) % 4294967296"
    return f"({mixed} + {more} + {seed}) % 4294967296"


def drawn(key: str, copy: str, seed: int) -> str:
    return hashed(f"{hashed(key, seed)} + CAST({copy} AS BIGINT) * 4294967296", seed + 100)


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def case(rules: list[tuple[str, str]], otherwise: str = "NULL") -> str:
    body = " ".join(f"WHEN {condition} THEN {value}" for condition, value in rules)
    return f"CASE {body} ELSE {otherwise} END"


def flag(condition: str) -> str:
    return f"CAST(coalesce({condition}, false) AS INTEGER)"


def bins(value: str, edges: list[int], labels: list[str]) -> str:
    return case(
        [
            (f"{value} > {lo} AND {value} <= {hi}", text(label))
            for lo, hi, label in zip(edges[:-1], edges[1:], labels)
        ]
    )


BUCKET = "CAST({} AS DOUBLE)".format(
    case([(f"delay_description = {text(k)}", str(v)) for k, v in delay.BUCKET_MINUTES.items()])
)

CATEGORY = "CASE WHEN {0} <= 15 THEN 'Minor' WHEN {0} <= 30 THEN 'Moderate' WHEN {0} <= 60 THEN 'Major' ELSE 'Severe' END"

CONDITION = """CASE WHEN snowfall_cm > 1 THEN 'Snow' WHEN precipitation_mm > 20 THEN 'Heavy Rain'
  WHEN precipitation_mm > 5 THEN 'Rain' WHEN precipitation_mm > 0.5 THEN 'Light Rain'
  WHEN wind_speed_max_kmh > 50 THEN 'Stormy' ELSE 'Clear' END"""

SEVERITY = """CAST(CASE
  WHEN snowfall_cm > 10 OR precipitation_mm > 30 OR wind_speed_max_kmh > 60 THEN 5
  WHEN snowfall_cm > 5 OR precipitation_mm > 20 OR wind_speed_max_kmh > 50 THEN 4
  WHEN precipitation_mm > 10 OR wind_speed_max_kmh > 40 THEN 3
  WHEN precipitation_mm > 2 OR wind_speed_max_kmh > 30 THEN 2 ELSE 1 END AS INTEGER)"""

RAIN, SNOW, WIND = (
    f"coalesce({c}, 0)" for c in ("precipitation_mm", "snowfall_cm", "wind_speed_max_kmh")
)


def along_calendar(column: str, order: str = "date", by: str = "") -> str:
    part = f"PARTITION BY {by} " if by else ""
    return (
        f"coalesce(last_value({column} IGNORE NULLS) OVER ({part}ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), "
        f"first_value({column} IGNORE NULLS) OVER ({part}ORDER BY {order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"
    )


def _filled_weather() -> str:
    filled = []
    for name in WEATHER_MEASURES:
        value = f"coalesce({along_calendar(name)}, 0)"
        if name in ("precipitation_mm", "wind_speed_max_kmh"):
            value = f"greatest({value}, 0)"
        filled.append(f"{value} AS {name}")
    return ", ".join(filled)


LAGS = ["prev_day_avg_delay", "rolling_3d_avg_delay", "rolling_7d_avg_delay", "delay_trend_3d"]

CTES: dict[str, str] = {
    "trips_raw": roles.TRIPS_RAW.format(occurred=roles.OCCURRED_DUCKDB),
    "weather_raw": roles.WEATHER_RAW,
    "events_raw": roles.EVENTS_RAW,
    "typical": f"SELECT median({BUCKET}) AS minutes FROM trips_raw WHERE created_on IS NOT NULL",
    "single": """SELECT * FROM trips_raw WHERE created_on IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY incident_id ORDER BY created_on DESC NULLS LAST,
        occurred_on NULLS LAST, delay_description NULLS LAST, borough NULLS LAST, delay_reason NULLS LAST,
        incident_type NULLS LAST, run_type NULLS LAST, route_id NULLS LAST, bus_company NULLS LAST,
        passenger_count NULLS LAST) = 1""",
    "timed": f"""SELECT *, CAST(created_on AS DATE) AS date,
      CAST(coalesce(hour(occurred_on), 8) AS INTEGER) AS hour,
      coalesce({BUCKET}, (SELECT minutes FROM typical)) AS delay_minutes FROM single""",
    "trips": f"""SELECT date, hour, incident_id, route_id, trim(coalesce(run_type, 'Unknown')) AS run_type,
      trim(coalesce(borough, 'Unknown')) AS borough, bus_company,
      trim(coalesce(delay_reason, 'Unknown')) AS delay_reason, delay_description, delay_minutes,
      {flag('delay_minutes > 15')} AS is_delayed, {CATEGORY.format('delay_minutes')} AS delay_category,
      trim(coalesce(incident_type, 'Unknown')) AS incident_type,
      coalesce(CAST(trunc(try_cast(passenger_count AS DOUBLE)) AS INTEGER), 0) AS passenger_count,
      dayname(date) AS day_of_week, {flag('isodow(date) >= 6')} AS is_weekend,
      {flag('hour BETWEEN 7 AND 9 OR hour BETWEEN 16 AND 18')} AS is_rush_hour FROM timed""",
    "weather_classified": f"SELECT *, {CONDITION} AS weather_condition, {SEVERITY} AS weather_severity FROM weather_raw",
    "weather": f"SELECT date, {_filled_weather()}, weather_condition, weather_severity FROM weather_classified",
    "events_single": """SELECT * FROM events_raw
      QUALIFY row_number() OVER (PARTITION BY date, event_name ORDER BY expected_attendance DESC NULLS LAST,
        event_type NULLS LAST, impact_level NULLS LAST, nationwide NULLS LAST) = 1""",
    "events": """SELECT date, event_name, trim(event_type) AS event_type, expected_attendance,
      concat(upper(trim(impact_level)[1]), lower(trim(impact_level)[2:])) AS titled, nationwide,
      CASE WHEN impact_level IS NOT NULL THEN titled END AS impact_level FROM events_single""",
    "events_scored": """SELECT *, CASE impact_level WHEN 'Low' THEN 1 WHEN 'Medium' THEN 2 WHEN 'High' THEN 3 ELSE 0 END AS score FROM events""",
    "event_types": """SELECT date, string_agg(event_type, ', ' ORDER BY first_seen) AS event_types FROM (
      SELECT date, event_type, min(seen) AS first_seen FROM (
        SELECT date, event_type, row_number() OVER (PARTITION BY date ORDER BY expected_attendance DESC, event_name, event_type) AS seen
        FROM events) AS s GROUP BY date, event_type) AS t GROUP BY date""",
    "event_days": """SELECT date, count(event_name) AS event_count,
      CAST(sum(expected_attendance) AS BIGINT) AS total_attendance, max(expected_attendance) AS max_attendance,
      CAST(max(score) AS INTEGER) AS max_impact_score, any_value(event_types) AS event_types,
      CAST(max(score) >= 3 AS INTEGER) AS has_high_impact, CAST(1 AS INTEGER) AS has_event
      FROM events_scored JOIN event_types USING (date) GROUP BY date""",
    "merged": """SELECT trips.*, weather.* EXCLUDE (date),
      coalesce(event_count, 0) AS event_count, coalesce(total_attendance, 0) AS total_attendance,
      coalesce(max_attendance, 0) AS max_attendance, coalesce(max_impact_score, 0) AS max_impact_score,
      coalesce(event_types, 'None') AS event_types, coalesce(has_high_impact, 0) AS has_high_impact,
      coalesce(has_event, 0) AS has_event
      FROM trips LEFT JOIN weather ON trips.date = weather.date LEFT JOIN event_days ON trips.date = event_days.date""",
    "daily": """SELECT date, avg(delay_minutes) AS daily_avg_delay FROM trips GROUP BY date""",
    "rolled": f"""SELECT date, daily_avg_delay, lag(daily_avg_delay) OVER (ORDER BY date) AS prev_day_avg_delay,
      {rounded('avg(daily_avg_delay) OVER (ORDER BY date ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)', 2)} AS rolling_3d_avg_delay,
      {rounded('avg(daily_avg_delay) OVER (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)', 2)} AS rolling_7d_avg_delay
      FROM daily""",
    "lags": f"""SELECT date, coalesce(prev_day_avg_delay, (SELECT avg(delay_minutes) FROM trips)) AS prev_day_avg_delay,
      rolling_3d_avg_delay, rolling_7d_avg_delay,
      {rounded('daily_avg_delay - rolling_3d_avg_delay', 2)} AS delay_trend_3d FROM rolled""",
    "featured": f"""SELECT merged.*, lags.* EXCLUDE (date), CAST(month(merged.date) AS INTEGER) AS month,
      CAST(dayofyear(merged.date) AS INTEGER) AS day_of_year, CAST(weekofyear(merged.date) AS INTEGER) AS week_of_year,
      CASE WHEN month(merged.date) IN (12, 1, 2) THEN 'Winter' WHEN month(merged.date) IN (3, 4, 5) THEN 'Spring'
        WHEN month(merged.date) IN (6, 7, 8) THEN 'Summer' ELSE 'Autumn' END AS season,
      {case([(f"hour >= {lo} AND hour < {hi}", text(n)) for n, (lo, hi) in calendar.PERIOD_HOURS.items()], text(calendar.PERIOD_ELSE))} AS time_period,
      sin(2 * pi() * hour / 24) AS hour_sin, cos(2 * pi() * hour / 24) AS hour_cos,
      sin(2 * pi() * month(merged.date) / 12) AS month_sin, cos(2 * pi() * month(merged.date) / 12) AS month_cos,
      CAST(isodow(merged.date) - 1 AS INTEGER) AS day_of_week_num,
      {rounded(f'weather_severity * 2 + ln(1 + {RAIN}) * 1.5e0 + least(greatest({WIND} - 20, 0), 60) / 10 + {SNOW} * 0.5e0', 2)} AS weather_severity_index,
      {bins('temperature_mean_c', weather.TEMPERATURE_EDGES, weather.TEMPERATURE_LABELS)} AS temp_category,
      {bins(RAIN, weather.RAIN_EDGES, weather.RAIN_LABELS)} AS rain_category,
      {flag(f'coalesce(weather_severity >= 4, false) OR {RAIN} > 20 OR {WIND} > 50')} AS is_extreme_weather,
      {flag(f'{RAIN} > 0.5')} AS is_rainy_day, {flag(f'{SNOW} > 0.1')} AS is_snowy_day,
      temperature_max_c - temperature_min_c AS temp_range_c, temperature_min_c - apparent_temp_min_c AS wind_chill_effect,
      CASE WHEN has_event = 0 THEN 0 ELSE {rounded('max_impact_score * 2 + ln(1 + total_attendance) + event_count * 0.5e0', 2)} END AS event_impact_score,
      {flag('max_attendance > 10000')} AS has_large_event, {flag('event_count > 1')} AS has_multiple_events
      FROM merged JOIN lags ON merged.date = lags.date""",
}


def seed_values() -> str:
    rows = ", ".join(
        f"(DATE {text(day)}, {text(name)}, {text(kind)}, {size}, {text(level)})"
        for day, name, kind, size, level in SEED_EVENTS
    )
    return (
        "SELECT date, event_name, event_type, CAST(expected_attendance AS BIGINT) AS expected_attendance, impact_level, false AS nationwide "
        f"FROM (VALUES {rows}) AS seeds(date, event_name, event_type, expected_attendance, impact_level)"
    )


def recurring_select(days: str) -> str:
    """Recurring events over a relation with a `date` column; the first matching series wins."""

    def pick(position: int) -> str:
        rules = []
        for row in RECURRING_EVENTS:
            value = row[position] if isinstance(row[position], int) else text(row[position])
            rules.append(
                (f"month(date) IN {row[0]} AND isodow(date) - 1 IN {row[1]}", str(value))
            )
        return case(rules)

    return (
        f"SELECT date, {pick(2)} AS event_name, 'Sports' AS event_type, CAST({pick(3)} AS BIGINT) AS expected_attendance, "
        f"{pick(4)} AS impact_level, false AS nationwide FROM {days} WHERE {pick(3)} IS NOT NULL"
    )


def with_ctes(body: str, extra: dict[str, str] | None = None) -> str:
    """Prefix `body` with the common table expressions it needs, in dependency order."""
    known = {**CTES, **(extra or {})}
    needed: list[str] = []

    def visit(sql: str) -> None:
        for name in known:
            if name not in needed and re.search(rf"(FROM|JOIN)\s+{name}\b", sql):
                visit(known[name])
                needed.append(name)

    visit(body)
    if not needed:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({known[n]})" for n in needed) + "\n" + body
