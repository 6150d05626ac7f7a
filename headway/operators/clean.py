"""Cleaning of the three source tables and their join on the calendar day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway.functions import calendar, delay, events, weather
from headway.functions.core import flag, keep_null, nan_to_null, of_type, trimmed, whole_number
from headway.sources.schemas import TRIP_RENAMES

# The columns of a clean incident, in order.
TRIP_COLUMNS = [
    "date", "hour", "incident_id", "route_id", "run_type", "borough", "bus_company",
    "delay_reason", "delay_description", "delay_minutes", "is_delayed", "delay_category",
    "incident_type", "passenger_count", "day_of_week", "is_weekend", "is_rush_hour",
    "service_type",
]

# What a day without events gets.
EVENT_FILL = {
    "has_event": 0,
    "event_count": 0,
    "total_attendance": 0,
    "max_attendance": 0,
    "max_impact_score": 0,
    "has_high_impact": 0,
    "event_types": "None",
}


def keep(df: DataFrame, columns: list[str]) -> DataFrame:
    """The listed columns that exist, in the listed order."""
    return df.select([c for c in columns if c in df.columns])


def rename_trip_fields(df: DataFrame) -> DataFrame:
    """Landed field names to ours; fields that are absent are ignored.

    Where several landed fields mean the same column, the first that is not null counts.
    """
    sources: dict[str, list[str]] = {}
    for name in df.columns:
        sources.setdefault(TRIP_RENAMES.get(name, name), []).append(name)
    return df.select(*[F.coalesce(*(F.col(f"`{c}`") for c in old)).alias(new) for new, old in sources.items()])


def keep_one(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the given order.

    Spark limits every key to one row before the shuffle as well as after it, so a key that holds
    a third of the table sends one row per task.
    """
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def as_timestamp(df: DataFrame, name: str) -> Column:
    """Text is parsed, with null for what cannot be; timestamps pass through."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return F.col(name).try_cast("timestamp_ntz")
    return F.col(name).cast("timestamp_ntz")


def _dated(raw: DataFrame) -> DataFrame:
    return raw.withColumns(
        {"created_on": as_timestamp(raw, "created_on"), "occurred_on": as_timestamp(raw, "occurred_on")}
    ).where(F.col("created_on").isNotNull())


def typical_delay(raw: DataFrame) -> DataFrame:
    """The median delay over all dated records, duplicates included: one row.

    Delays take as many values as there are buckets, so the exact median merges tiny histograms.
    """
    return _dated(raw).agg(F.median(delay.bucket_minutes(F.col("delay_description"))).alias("typical"))


def clean_trips(raw: DataFrame, typical: Column | None = None) -> DataFrame:
    """Incident records to one clean row per incident.

    Missing delays are filled with `typical`, else with the `typical_delay` of these records.
    """
    dated = _dated(raw)
    typical = typical_delay(raw).scalar() if typical is None else typical

    others = [c for c in dated.columns if c not in ("incident_id", "created_on")]
    order = [F.col("created_on").desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in others]]
    single = keep_one(dated, ["incident_id"], order)

    minutes = F.col("delay_minutes")
    texts = {c: trimmed(F.col(c)) for c in ("borough", "delay_reason", "incident_type", "run_type")}
    return (
        single.withColumns(
            {
                "date": F.col("created_on").cast("date"),
                "hour": delay.occurrence_hour(F.col("occurred_on")),
                "delay_minutes": F.coalesce(
                    delay.bucket_minutes(F.col("delay_description")), typical
                ),
                "passenger_count": whole_number(F.col("passenger_count")),
                **texts,
            }
        )
        .withColumns(
            {
                "is_delayed": delay.is_delayed(minutes),
                "delay_category": delay.delay_category(minutes),
                "day_of_week": calendar.day_name(F.col("date")),
                "is_weekend": calendar.is_weekend(F.col("date")),
                "is_rush_hour": delay.is_rush_hour(F.col("hour")),
            }
        )
        .transform(keep, TRIP_COLUMNS)
    )


def classify_weather(raw: DataFrame) -> DataFrame:
    """Condition and severity of each day, from the measures as reported."""
    doubles = of_type(raw.schema, T.DoubleType, T.FloatType)
    days = raw.withColumns({c: nan_to_null(F.col(c)) for c in doubles})
    measures = [F.col(c) for c in ("precipitation_mm", "snowfall_cm", "wind_speed_max_kmh")]
    return days.withColumns(
        {
            "weather_condition": weather.condition(*measures),
            "weather_severity": weather.severity(*measures),
        }
    )


def fill_gaps(df: DataFrame, columns: list[str], order: str, by: list[str] | None = None) -> DataFrame:
    """Each null takes the last earlier value, else (at the start) the first known one.

    Meant for day-grain tables, where a window holds at most one row per calendar day; give `by`
    when the table has several series.
    """
    ordered = W.partitionBy(*(by or [])).orderBy(order)
    past = ordered.rowsBetween(W.unboundedPreceding, W.currentRow)
    whole = ordered.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    filled = {
        c: F.coalesce(
            F.last(c, ignorenulls=True).over(past), F.first(c, ignorenulls=True).over(whole)
        )
        for c in columns
    }
    return df.withColumns(filled)


def clean_weather(days: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Numeric gaps filled along the calendar, leftovers 0, rain and wind not negative."""
    numeric = [c for c in of_type(days.schema, T.NumericType) if c not in (by or [])]
    known = days.transform(fill_gaps, numeric, "date", by).fillna(0, subset=numeric)
    return known.withColumns(
        {
            c: keep_null(F.col(c), F.greatest(F.col(c), F.lit(0.0)))
            for c in ("precipitation_mm", "wind_speed_max_kmh")
        }
    )


def clean_events(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "impact_level": F.initcap(F.trim("impact_level")),
            "event_type": F.trim("event_type"),
            "expected_attendance": F.coalesce(
                nan_to_null(F.col("expected_attendance").try_cast("double")).try_cast("bigint"),
                F.lit(0).cast("bigint"),
            ),
        }
    )


def largest_per_day(df: DataFrame) -> DataFrame:
    """One row per (date, event name): the one with the highest attendance."""
    others = [c for c in df.columns if c not in ("date", "event_name", "expected_attendance")]
    order = [
        F.col("expected_attendance").desc_nulls_last(),
        *[F.col(c).asc_nulls_last() for c in others],
    ]
    return keep_one(df, ["date", "event_name"], order)


def union_events(*sources: DataFrame) -> DataFrame:
    """All event sources together, columns matched by name, then one row per day and name."""
    union = sources[0]
    for more in sources[1:]:
        union = union.unionByName(more, allowMissingColumns=True)
    return largest_per_day(union)


def roll_up_events(df: DataFrame) -> DataFrame:
    """Clean events to one row per day.

    Rolls up to (date, type) first, so a day with very many events is reduced before the shuffle
    and only its distinct types are ever gathered. Types are listed in order of their largest event.
    """
    scored = df.withColumn("score", events.impact_score(F.col("impact_level")))
    leader = F.struct(
        (-F.col("expected_attendance")).alias("size"),
        F.col("event_name").alias("name"),
        F.col("event_type").alias("kind"),
    )
    per_type = scored.groupBy("date", "event_type").agg(
        F.count("event_name").alias("n"),
        F.sum("expected_attendance").alias("attendance"),
        F.max("expected_attendance").alias("largest"),
        F.max("score").alias("score"),
        F.min(leader).alias("leader"),
    )
    kinds = F.array_sort(F.collect_list("leader"))
    return per_type.groupBy("date").agg(
        F.sum("n").alias("event_count"),
        F.sum("attendance").alias("total_attendance"),
        F.max("largest").alias("max_attendance"),
        F.max("score").alias("max_impact_score"),
        F.array_join(F.transform(kinds, lambda k: k["kind"]), ", ").alias("event_types"),
        flag(F.max("score") >= 3).alias("has_high_impact"),
        F.lit(1).alias("has_event"),
    )


def merge_days(trips: DataFrame, weather_days: DataFrame, event_days: DataFrame) -> DataFrame:
    """Trips with the weather and events of their day; days without events get 0 and "None".

    Weather of a day without a report stays null. Both right sides hold one row per day; staged,
    their file size lets Spark broadcast them (see `headway.plans.staging`).
    """
    merged = trips.join(weather_days, "date", "left").join(event_days, "date", "left")
    return merged.fillna({c: v for c, v in EVENT_FILL.items() if c in merged.columns})
