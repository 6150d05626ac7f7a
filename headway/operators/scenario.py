"""Rule-based prediction and what-if deltas on a forecast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.functions import delay
from headway.functions.core import first_match
from headway.functions.predictor import predicted_delay

# Minutes each scenario adds to forecast days.
WEATHER_DELTA = {"Typical (No Change)": 0.0, "Heavy Rain": 12.5, "Snowstorm": 25.0, "Severe Storms": 18.0}
EVENT_DELTA = {"None": 0.0, "Parade / Marathon": 15.0, "Major Concert / Sports Game": 8.0}
HISTORY_DAYS = 90


def predict(df: DataFrame) -> DataFrame:
    """Adds the predicted delay of each row, whether that counts as delayed, and its category."""
    inputs = [
        "precipitation_mm", "wind_speed_max_kmh", "weather_condition", "is_rush_hour",
        "is_weekend", "has_event", "total_attendance",
    ]
    minutes = F.col("predicted_delay")
    return df.withColumn("predicted_delay", predicted_delay(*map(F.col, inputs))).withColumns(
        {
            "predicted_delayed": delay.is_delayed(minutes),
            "predicted_category": delay.delay_category(minutes),
        }
    )


def scenarios(forecast: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Every weather and event scenario applied to a forecast, with the recent history kept.

    Forecast rows get the scenario's minutes; history starts 90 days before the first forecast day
    of its series.
    """
    weathers = F.array(*[F.struct(F.lit(k).alias("w"), F.lit(v).alias("d")) for k, v in WEATHER_DELTA.items()])
    cities = F.array(*[F.struct(F.lit(k).alias("e"), F.lit(v).alias("d")) for k, v in EVENT_DELTA.items()])
    is_forecast = F.col("type") == "Forecast"
    starts = forecast.where(is_forecast).groupBy(*(by or [])).agg(F.min("date").alias("start"))
    if by:
        recent = forecast.join(starts, by)
    else:
        recent = forecast.withColumn("start", starts.scalar())
    recent = recent.where(F.col("date") >= F.date_sub("start", HISTORY_DAYS))
    spread = recent.withColumn("weather", F.explode(weathers)).withColumn("city", F.explode(cities))
    added = F.col("weather.d") + F.col("city.d")
    return spread.select(
        *(by or []),
        "date",
        F.col("weather.w").alias("weather_scenario"),
        F.col("city.e").alias("event_scenario"),
        F.when(is_forecast, F.col("delay") + added).otherwise(F.col("delay")).alias("delay"),
        "type",
    )


def forecast_summary(forecast: DataFrame) -> DataFrame:
    """The forecast days with their weekday, short date and severity band."""
    # Minutes above which a day is shown as severe or elevated.
    bands = [(F.col("delay") > 60, "severe"), (F.col("delay") > 40, "elevated")]
    return forecast.where("type = 'Forecast'").withColumns(
        {
            "day_name": F.date_format("date", "EEEE"),
            "short_date": F.date_format("date", "MMM dd"),
            "band": first_match(bands, "normal"),
        }
    )
