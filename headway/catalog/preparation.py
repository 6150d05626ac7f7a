"""Cleaning, merging and feature queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from headway.catalog.registry import register
from headway.catalog.sql import rounded, with_ctes
from headway.functions.core import half_even
from headway.operators import clean, features
from headway.plans.warehouse import Warehouse

ID_DATE = ["incident_id", "date"]


@register(
    "flagship",
    with_ctes(
        "SELECT weather_condition, count(*) AS trips, avg(delay_minutes) AS avg_delay, "
        f"{rounded('avg(is_delayed)', 6)} AS delayed_share FROM merged "
        "GROUP BY weather_condition"
    ),
)
def flagship(w: Warehouse):
    """Mean delay and share delayed per weather condition, from the raw tables."""
    return (
        w.trips.join(w.weather, "date", "left")
        .groupBy("weather_condition")
        .agg(
            F.count("*").alias("trips"),
            F.avg("delay_minutes").alias("avg_delay"),
            half_even(F.avg("is_delayed"), 6).alias("delayed_share"),
        )
    )


@register("trips_clean", with_ctes("SELECT * FROM trips"))
def trips_clean(w: Warehouse):
    return clean.clean_trips(clean.rename_trip_fields(w.trips_raw))


@register("weather_classified", with_ctes("SELECT * FROM weather_classified"))
def weather_classified(w: Warehouse):
    return clean.classify_weather(w.weather_raw)


@register("weather_clean", with_ctes("SELECT * FROM weather"))
def weather_clean(w: Warehouse):
    return clean.clean_weather(clean.classify_weather(w.weather_raw))


@register("events_clean", with_ctes("SELECT date, event_name, event_type, expected_attendance, impact_level, nationwide FROM events"))
def events_clean(w: Warehouse):
    return clean.clean_events(clean.largest_per_day(w.events_raw))


@register("events_daily", with_ctes("SELECT * FROM event_days"))
def events_daily(w: Warehouse):
    events = clean.clean_events(clean.largest_per_day(w.events_raw))
    return clean.roll_up_events(events)


@register("merged", with_ctes("SELECT * FROM merged"))
def merged(w: Warehouse):
    return w.merged


_TIME = ["month", "day_of_year", "week_of_year", "season", "time_period", "day_of_week_num"]
_CIRCLE = ["hour_sin", "hour_cos", "month_sin", "month_cos"]


@register(
    "time_features",
    with_ctes(
        f"SELECT incident_id, date, {', '.join(_TIME)}, "
        + ", ".join(f"{rounded(c, 6)} AS {c}" for c in _CIRCLE)
        + " FROM featured"
    ),
)
def time_features(w: Warehouse):
    rows = features.add_time_features(w.trips)
    return rows.select(*ID_DATE, *_TIME, *[half_even(F.col(c), 6).alias(c) for c in _CIRCLE])


_WEATHER = [
    "weather_severity_index", "temp_category", "rain_category", "is_extreme_weather",
    "is_rainy_day", "is_snowy_day", "temp_range_c", "wind_chill_effect",
]


@register("weather_features", with_ctes(f"SELECT incident_id, date, {', '.join(_WEATHER)} FROM featured"))
def weather_features(w: Warehouse):
    return features.add_weather_features(w.merged).select(*ID_DATE, *_WEATHER)


_EVENT = ["event_impact_score", "has_large_event", "has_multiple_events"]


@register("event_features", with_ctes(f"SELECT incident_id, date, {', '.join(_EVENT)} FROM featured"))
def event_features(w: Warehouse):
    return features.add_event_features(w.merged).select(*ID_DATE, *_EVENT)


@register(
    "lag_features",
    with_ctes(
        "SELECT incident_id, date, delay_minutes, "
        + ", ".join(f"{rounded(c, 6)} AS {c}" for c in features.LAG_COLUMNS)
        + " FROM featured"
    ),
)
def lag_features(w: Warehouse):
    rows = features.add_lag_features(w.trips, w.daily)
    lags = [half_even(F.col(c), 6).alias(c) for c in features.LAG_COLUMNS]
    return rows.select(*ID_DATE, "delay_minutes", *lags)


@register(
    "featured",
    with_ctes(
        "SELECT * EXCLUDE (hour_sin, hour_cos, month_sin, month_cos, prev_day_avg_delay), "
        + ", ".join(f"{rounded(c, 6)} AS {c}" for c in [*_CIRCLE, "prev_day_avg_delay"])
        + " FROM featured"
    ),
)
def featured(w: Warehouse):
    """Every feature at once: the fact table joined to the day dimension."""
    return w.featured.withColumns(
        {c: half_even(F.col(c), 6) for c in [*_CIRCLE, "prev_day_avg_delay"]}
    )
