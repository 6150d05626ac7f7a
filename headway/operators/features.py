"""Time, weather, event and lag features.

Everything except the hour-based features depends on the calendar day alone. `add_*` work on any
grain, so `headway.plans.warehouse` applies them to one row per day and joins the result once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from headway.functions import calendar, events, weather
from headway.functions.core import flag, half_even, ratio

LAG_COLUMNS = [
    "prev_day_avg_delay", "rolling_3d_avg_delay", "rolling_7d_avg_delay", "delay_trend_3d",
]


def add_date_features(df: DataFrame) -> DataFrame:
    month = F.month("date")
    month_sin, month_cos = calendar.on_circle(month, 12)
    return df.withColumns(
        {
            "month": month,
            "day_of_year": F.dayofyear("date"),
            "week_of_year": F.weekofyear("date"),
            "season": calendar.season(month),
            "month_sin": month_sin,
            "month_cos": month_cos,
            "day_of_week_num": F.weekday("date"),
        }
    )


def add_hour_features(df: DataFrame) -> DataFrame:
    hour_sin, hour_cos = calendar.on_circle(F.col("hour"), 24)
    return df.withColumns(
        {
            "time_period": calendar.time_period(F.col("hour")),
            "hour_sin": hour_sin,
            "hour_cos": hour_cos,
        }
    )


def add_time_features(df: DataFrame) -> DataFrame:
    return df.transform(add_date_features).transform(add_hour_features)


def add_weather_features(df: DataFrame) -> DataFrame:
    """Missing measures count as 0; a missing severity leaves the index null."""

    def measure(name: str):
        return F.coalesce(F.col(name), F.lit(0.0)) if name in df.columns else F.lit(0.0)

    rain, snow, wind = (
        measure(c) for c in ("precipitation_mm", "snowfall_cm", "wind_speed_max_kmh")
    )
    level = F.col("weather_severity")
    mean = "temperature_mean_c" if "temperature_mean_c" in df.columns else "temperature_max_c"
    features = {
        "weather_severity_index": weather.severity_index(level, rain, snow, wind),
        "temp_category": weather.temperature_category(F.col(mean)),
        "rain_category": weather.rain_category(rain),
        "is_extreme_weather": weather.is_extreme(level, rain, wind),
        "is_rainy_day": flag(rain > 0.5),
        "is_snowy_day": flag(snow > 0.1),
    }
    if {"temperature_max_c", "temperature_min_c"} <= set(df.columns):
        features["temp_range_c"] = F.col("temperature_max_c") - F.col("temperature_min_c")
    if {"temperature_min_c", "apparent_temp_min_c"} <= set(df.columns):
        features["wind_chill_effect"] = F.col("temperature_min_c") - F.col("apparent_temp_min_c")
    return df.withColumns(features)


def add_event_features(df: DataFrame) -> DataFrame:
    """Columns of an absent event table count as no event."""
    has = set(df.columns)
    score = F.lit(0.0)
    if "max_impact_score" in has:
        names = ("has_event", "max_impact_score", "total_attendance", "event_count")
        score = events.day_impact_score(*[F.col(c) for c in names])
    return df.withColumns(
        {
            "event_impact_score": score,
            "has_large_event": flag(F.col("max_attendance") > events.LARGE_EVENT_ABOVE)
            if "max_attendance" in has
            else F.lit(0),
            "has_multiple_events": flag(F.col("event_count") > 1)
            if "event_count" in has
            else F.lit(0),
        }
    )


def daily_delay(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Delay sum, record count and mean per observed day (and series)."""
    return df.groupBy(*(by or []), "date").agg(
        F.sum("delay_minutes").alias("delay_sum"),
        F.count("delay_minutes").alias("delay_records"),
        F.avg("delay_minutes").alias("daily_avg_delay"),
    )


def daily_lags(daily: DataFrame, by: list[str] | None = None, leak_free: bool = False) -> DataFrame:
    """Lag and rolling means over observed days of a `daily_delay` table.

    The default windows include the current day, which leaks the target into its own features;
    `leak_free` ends them on the day before.
    """
    days = W.partitionBy(*(by or [])).orderBy("date")
    last = -1 if leak_free else 0
    mean = F.col("daily_avg_delay")

    def rolling(width: int):
        return half_even(F.avg(mean).over(days.rowsBetween(last - width + 1, last)), 2)

    lagged = daily.withColumns(
        {
            "prev_day_avg_delay": F.lag(mean, 1).over(days),
            "rolling_3d_avg_delay": rolling(3),
            "rolling_7d_avg_delay": rolling(7),
        }
    )
    basis = F.col("prev_day_avg_delay") if leak_free else mean
    return lagged.withColumn("delay_trend_3d", half_even(basis - F.col("rolling_3d_avg_delay"), 2))


def fill_lags(df: DataFrame, row_mean) -> DataFrame:
    """A first day has no predecessor: delays take the mean over all records, the trend 0."""
    return df.withColumns(
        {
            c: F.coalesce(F.col(c), F.lit(0.0) if "trend" in c else row_mean)
            for c in LAG_COLUMNS
        }
    )


def mean_over_records(daily: DataFrame):
    """Mean over all records, taken from the day table's sums (a scalar subquery)."""
    return daily.agg(ratio(F.sum("delay_sum"), F.sum("delay_records"))).scalar()


def add_lag_features(df: DataFrame, daily: DataFrame | None = None, leak_free: bool = False) -> DataFrame:
    """Lag features joined back onto rows. Pass a staged `daily_delay` table to avoid recomputing it."""
    daily = daily if daily is not None else daily_delay(df)
    lags = fill_lags(daily_lags(daily, leak_free=leak_free), mean_over_records(daily))
    return df.join(lags.select("date", *LAG_COLUMNS), "date", "left")
