"""Rule-based what-if predictor."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from headway.functions.core import first_match

# Minutes added or removed by each rule.
BASE = 20.0
STORM_EXTRA = {"Heavy Rain": 15.0, "Snow": 15.0, "Rain": 8.0}
RUSH_EXTRA = 10.0
WEEKEND_RELIEF = 8.0
EVENT_WEIGHT = 1.5


def predicted_delay(
    precipitation: Column,
    wind: Column,
    weather: Column,
    rush: Column,
    weekend: Column,
    has_event: Column,
    attendance: Column,
) -> Column:
    """Minutes, never negative. Rain counts only when the wind is above 20, as the rule is written."""
    windy = F.when(
        wind > 20, F.coalesce(precipitation, F.lit(0.0)) * 0.8 + (wind - 20) * 0.3
    ).otherwise(0.0)
    storm = first_match([(weather == name, extra) for name, extra in STORM_EXTRA.items()], 0.0)
    crowd = F.when(has_event == 1, F.log1p(attendance.cast("double")) * EVENT_WEIGHT).otherwise(0.0)
    total = (
        F.lit(BASE)
        + windy
        + storm
        + F.when(rush == 1, RUSH_EXTRA).otherwise(0.0)
        - F.when(weekend == 1, WEEKEND_RELIEF).otherwise(0.0)
        + crowd
    )
    return F.greatest(total, F.lit(0.0))
