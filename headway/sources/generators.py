"""Calendar, recurring events and a seed calendar of one-off events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.functions.core import first_match
from headway.sources.schemas import EVENTS_SCHEMA

# One-off events of our own: month, day, name, type, expected attendance, impact level.
CITY_CALENDAR = [
    (1, 20, "Winter Lights Walk", "Festival", 18000, "Medium"),
    (2, 3, "Frozen Harbor Regatta", "Sports", 12000, "Low"),
    (2, 24, "Indoor Athletics Open", "Sports", 9000, "Low"),
    (3, 9, "Bridge Half Marathon", "Sports", 26000, "Medium"),
    (3, 30, "Spring Garden Show", "Festival", 22000, "Medium"),
    (4, 13, "Book Fair on the Square", "Festival", 14000, "Low"),
    (4, 27, "Cherry Tree Parade", "Parade", 45000, "High"),
    (5, 11, "Five Parks Cycle Tour", "Sports", 32000, "High"),
    (5, 25, "Fleet Visit", "Festival", 70000, "High"),
    (6, 15, "Riverside Jazz Night", "Concert", 24000, "Medium"),
    (7, 6, "Open Air Opera", "Concert", 38000, "High"),
    (7, 27, "Street Food Weekend", "Festival", 41000, "Medium"),
    (8, 17, "Beach Volleyball Finals", "Sports", 11000, "Low"),
    (9, 7, "Back to School March", "Parade", 16000, "Medium"),
    (9, 21, "Car Free Day", "Festival", 90000, "High"),
    (10, 19, "Lantern Parade", "Parade", 52000, "High"),
    (11, 9, "Film Week Opening", "Concert", 8000, "Low"),
    (12, 14, "Toy Drive Run", "Sports", 15000, "Medium"),
]
SEED_YEARS = (2023, 2024)

#: The calendar in each of the years, as (date, name, type, expected attendance, impact level).
SEED_EVENTS = [
    (f"{year}-{month:02}-{day:02}", *event) for year in SEED_YEARS for month, day, *event in CITY_CALENDAR
]

# The two recurring series: months, weekdays (Monday = 0), name, attendance, impact.
RECURRING_EVENTS = [
    ((1, 2, 3, 4, 10, 11, 12), (1, 3, 5), "Pro Sports Game (MSG/Barclays)", 19000, "Medium"),
    ((4, 5, 6, 7, 8, 9), (2, 4, 6), "MLB Game (Yankees/Mets)", 45000, "High"),
]


def calendar(bounds: DataFrame, low: str = "low", high: str = "high") -> DataFrame:
    """One row per day between two dates, inclusive, for every row of `bounds`.

    Other columns of `bounds` (a series key, say) are kept.
    """
    days = F.explode(F.sequence(low, high, F.expr("interval 1 day"))).alias("date")
    return bounds.select(*[c for c in bounds.columns if c not in (low, high)], days)


def date_bounds(df: DataFrame, date: str = "date") -> DataFrame:
    return df.agg(F.min(date).alias("low"), F.max(date).alias("high"))


def recurring_events(days: DataFrame) -> DataFrame:
    """Events that recur on fixed weekdays of their season; the first matching series wins."""
    month, weekday = F.month("date"), F.weekday("date")
    rules = [
        (month.isin(*months) & weekday.isin(*weekdays), number)
        for number, (months, weekdays, *_) in enumerate(RECURRING_EVENTS)
    ]
    series = F.col("series")

    def pick(position: int):
        return first_match([(series == n, row[position]) for n, row in enumerate(RECURRING_EVENTS)])

    return (
        days.select("date", first_match(rules).alias("series"))
        .where(series.isNotNull())
        .select(
            "date",
            pick(2).alias("event_name"),
            F.lit("Sports").alias("event_type"),
            pick(3).cast("bigint").alias("expected_attendance"),
            pick(4).alias("impact_level"),
            F.lit(False).alias("nationwide"),
        )
    )


def seed_events(spark: SparkSession, rows: list[tuple] = SEED_EVENTS) -> DataFrame:
    """One-off events given as literal rows; none of them is nationwide."""
    schema = "day STRING, event_name STRING, event_type STRING, expected_attendance BIGINT, impact_level STRING"
    listed = spark.createDataFrame(rows, schema)
    return listed.select(
        F.col("day").cast("date").alias("date"),
        "event_name",
        "event_type",
        "expected_attendance",
        "impact_level",
        F.lit(False).alias("nationwide"),
    )


def event_columns() -> list[str]:
    return [part.split()[0] for part in EVENTS_SCHEMA.split(",")]
