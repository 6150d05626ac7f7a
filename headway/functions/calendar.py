"""Calendar parts and their encodings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from headway.functions.core import first_match, flag

# Weekday names, Monday first.
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]

# Months of each season; hours [from, to) of each time period.
SEASON_MONTHS = {"Winter": (12, 1, 2), "Spring": (3, 4, 5), "Summer": (6, 7, 8)}
SEASON_ELSE = "Autumn"
PERIOD_HOURS = {
    "Early_Morning": (5, 9),
    "Morning": (9, 12),
    "Midday": (12, 14),
    "Afternoon": (14, 17),
    "Evening": (17, 20),
}
PERIOD_ELSE = "Night"


def day_name(date: Column) -> Column:
    return F.date_format(date, "EEEE")


def is_weekend(date: Column) -> Column:
    return flag(F.weekday(date) >= 5)


def season(month: Column) -> Column:
    return first_match([(month.isin(*m), name) for name, m in SEASON_MONTHS.items()], SEASON_ELSE)


def time_period(hour: Column) -> Column:
    rules = [((hour >= lo) & (hour < hi), name) for name, (lo, hi) in PERIOD_HOURS.items()]
    return first_match(rules, PERIOD_ELSE)


def on_circle(value: Column, period: int) -> tuple[Column, Column]:
    """Sine and cosine of the value's position in its period."""
    angle = F.lit(2.0) * F.pi() * value / F.lit(float(period))
    return F.sin(angle), F.cos(angle)
