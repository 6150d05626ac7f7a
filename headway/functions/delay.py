"""Delay buckets, categories and the hour-of-day flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from headway.functions.core import first_match, flag

# Reported delay bucket and its midpoint in minutes.
BUCKET_MINUTES = {
    "0-15 Min": 7.5,
    "16-30 Min": 23.0,
    "31-45 Min": 38.0,
    "46-60 Min": 53.0,
    "61-90 Min": 75.5,
}

# Upper bound (inclusive) of each delay category.
CATEGORY_LIMITS = [(15, "Minor"), (30, "Moderate"), (60, "Major")]
CATEGORY_ABOVE = "Severe"

# Longer delays count as delayed; the hour of an incident without a time.
DELAYED_ABOVE = 15
MISSING_HOUR = 8


def bucket_minutes(description: Column) -> Column:
    rules = [(description == label, minutes) for label, minutes in BUCKET_MINUTES.items()]
    return first_match(rules).cast("double")


def delay_category(minutes: Column) -> Column:
    return first_match([(minutes <= top, name) for top, name in CATEGORY_LIMITS], CATEGORY_ABOVE)


def is_delayed(minutes: Column) -> Column:
    return flag(minutes > DELAYED_ABOVE)


def occurrence_hour(occurred_on: Column) -> Column:
    return F.coalesce(F.hour(occurred_on), F.lit(MISSING_HOUR))


def is_rush_hour(hour: Column) -> Column:
    return flag(hour.between(7, 9) | hour.between(16, 18))
