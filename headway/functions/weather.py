"""Weather classification, indices and bins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from headway.functions.core import first_match, flag, half_even

# Bin edges, each bin (low, high], and their labels.
TEMPERATURE_EDGES = [-30, 0, 10, 20, 30, 50]
TEMPERATURE_LABELS = ["Freezing", "Cold", "Mild", "Warm", "Hot"]
RAIN_EDGES = [-1, 0, 2, 10, 25, 200]
RAIN_LABELS = ["No_Rain", "Drizzle", "Light_Rain", "Moderate_Rain", "Heavy_Rain"]


def condition(precipitation: Column, snow: Column, wind: Column) -> Column:
    return first_match(
        [
            (snow > 1, "Snow"),
            (precipitation > 20, "Heavy Rain"),
            (precipitation > 5, "Rain"),
            (precipitation > 0.5, "Light Rain"),
            (wind > 50, "Stormy"),
        ],
        "Clear",
    )


def severity(precipitation: Column, snow: Column, wind: Column) -> Column:
    """1 (calm) to 5. Each level lists (snow, precipitation, wind) limits; None means not tested."""
    # Limits per severity level.
    limits = {5: (10, 30, 60), 4: (5, 20, 50), 3: (None, 10, 40), 2: (None, 2, 30)}
    rules = []
    for level, (snow_limit, rain_limit, wind_limit) in limits.items():
        hit = (precipitation > rain_limit) | (wind > wind_limit)
        rules.append((hit if snow_limit is None else hit | (snow > snow_limit), level))
    return first_match(rules, 1)


def severity_index(level: Column, precipitation: Column, snow: Column, wind: Column) -> Column:
    """Null when the level is null; the measures must already be null-free."""
    gale = F.least(F.greatest(wind - 20, F.lit(0.0)), F.lit(60.0))
    return half_even(level * 2 + F.log1p(precipitation) * 1.5 + gale / 10 + snow * 0.5, 2)


def binned(value: Column, edges: list[int], labels: list[str]) -> Column:
    """(low, high] bins; a value outside every bin is null."""
    bins = zip(edges[:-1], edges[1:], labels)
    return first_match([((value > lo) & (value <= hi), label) for lo, hi, label in bins])


def temperature_category(value: Column) -> Column:
    return binned(value, TEMPERATURE_EDGES, TEMPERATURE_LABELS)


def rain_category(precipitation: Column) -> Column:
    return binned(precipitation, RAIN_EDGES, RAIN_LABELS)


def is_extreme(level: Column, precipitation: Column, wind: Column) -> Column:
    return flag(
        F.coalesce(level >= 4, F.lit(False)) | (precipitation > 20) | (wind > 50)
    )
