"""Cleaning, merging and features on small frames, one trap per test."""

import datetime as dt
import math

import numpy as np
from pyspark.sql import functions as F

from headway.functions import calendar, core, delay, weather
from headway.operators import clean, features
from tests.conftest import values

TRIPS = """incident_id long, created_on string, occurred_on string, delay_description string,
 borough string, delay_reason string, incident_type string, run_type string, route_id string,
 bus_company string, passenger_count string"""


def trip(i, created="2023-01-02T10:00:00", occurred="2023-01-02T07:30:00", bucket="0-15 Min", **more):
    row = dict(
        incident_id=i, created_on=created, occurred_on=occurred, delay_description=bucket,
        borough=" Bronx ", delay_reason="Traffic", incident_type=None, run_type="R", route_id=None,
        bus_company="B", passenger_count="3.0",
    )
    return tuple({**row, **more}.values())


def test_clean_trips_parses_fills_and_dedups(frame):
    raw = frame(
        [
            trip(1),
            trip(1, created="2023-01-03T10:00:00", bucket="61-90 Min"),
            trip(2, created="not a date"),
            trip(3, created=None),
            trip(4, occurred=None, bucket="unheard of", passenger_count="n/a"),
            trip(5, created="2023-01-07T23:59:59", occurred="bad", bucket=None, passenger_count="3"),
        ],
        TRIPS,
    )
    rows = {r["incident_id"]: r for r in clean.clean_trips(raw).collect()}
    assert set(rows) == {1, 4, 5}
    assert rows[1]["delay_minutes"] == 75.5 and rows[1]["date"] == dt.date(2023, 1, 3)
    # The fill value is the median of 7.5 and 75.5: both duplicates count, undated rows do not.
    assert rows[4]["delay_minutes"] == 41.5 and rows[5]["delay_minutes"] == 41.5
    assert (rows[4]["hour"], rows[5]["hour"], rows[1]["hour"]) == (8, 8, 7)
    assert [rows[i]["passenger_count"] for i in (1, 4, 5)] == [3, 0, 3]
    assert rows[1]["borough"] == "Bronx" and rows[1]["incident_type"] == "Unknown"
    assert rows[5]["day_of_week"] == "Saturday" and rows[5]["is_weekend"] == 1
    assert rows[1]["is_rush_hour"] == 1 and rows[1]["delay_category"] == "Severe"


def test_rename_and_keep_ignore_absent_columns(frame):
    raw = frame([(1, "x", "G")], "busbreakdown_id long, boro string, school_age_or_prek string")
    df = clean.rename_trip_fields(raw)
    assert df.columns == ["incident_id", "borough", "service_type"]
    assert clean.keep(df, clean.TRIP_COLUMNS).columns == ["incident_id", "borough", "service_type"]


def test_hot_duplicate_sends_one_row_per_task(frame):
    plan = clean.keep_one(frame([(1, 2)], "k long, v long"), ["k"], [F.col("v").desc()])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("WindowGroupLimit") == 2


def test_category_edges(frame):
    df = frame([(v,) for v in (15.0, 15.5, 30.0, 60.0, 60.5)], "m double")
    got = df.select("m", delay.delay_category(F.col("m")).alias("c"), delay.is_delayed(F.col("m")).alias("d"))
    assert values(got) == [
        (15.0, "Minor", 0), (15.5, "Moderate", 1), (30.0, "Moderate", 1), (60.0, "Major", 1), (60.5, "Severe", 1),
    ]


WEATHER = "date date, precipitation_mm double, snowfall_cm double, wind_speed_max_kmh double"


def day(n):
    return dt.date(2023, 1, n)


def test_weather_thresholds_nan_and_null(frame):
    cases = [
        (0.5, 0.0, 50.0, "Clear", 3), (0.51, 0.0, 0.0, "Light Rain", 1), (5.0, 1.0, 0.0, "Light Rain", 2),
        (5.1, 0.0, 0.0, "Rain", 2), (20.1, 0.0, 0.0, "Heavy Rain", 4), (0.0, 1.1, 0.0, "Snow", 1),
        (0.0, 0.0, 50.5, "Stormy", 4), (31.0, 0.0, 0.0, "Heavy Rain", 5), (0.0, 10.5, 0.0, "Snow", 5),
        (0.0, 0.0, 61.0, "Stormy", 5), (None, None, None, "Clear", 1),
        (math.nan, math.nan, math.nan, "Clear", 1), (0.0, 5.5, 0.0, "Snow", 4), (10.5, 0.0, 0.0, "Rain", 3),
    ]
    df = frame([(day(i + 1), *c[:3]) for i, c in enumerate(cases)], WEATHER)
    got = clean.classify_weather(df).orderBy("date").collect()
    assert [(r["weather_condition"], r["weather_severity"]) for r in got] == [c[3:] for c in cases]


def test_weather_gaps_fill_forward_then_backward(frame):
    rows = [(day(1), None, 1.0, -3.0), (day(2), 4.0, None, 1.0), (day(3), None, None, 2.0), (day(4), -2.0, 5.0, None)]
    df = clean.clean_weather(frame(rows, WEATHER))
    assert values(df) == [
        (day(1), 4.0, 1.0, 0.0), (day(2), 4.0, 1.0, 1.0), (day(3), 4.0, 1.0, 2.0), (day(4), 0.0, 5.0, 2.0),
    ]
    empty = clean.clean_weather(frame([(day(1), None, 0.0, 0.0)], WEATHER))
    assert values(empty)[0][1] == 0.0


EVENTS = "date date, event_name string, event_type string, expected_attendance long, impact_level string"


def test_events_dedup_clean_and_roll_up(frame):
    raw = frame(
        [
            (day(1), "A", " Sports", 10, " high"), (day(1), "A", "Parade", 50, "LOW"),
            (day(1), "B", "Sports", 90, "MEDIUM"), (day(1), None, "Fair", 70, None),
            (day(2), "C", "Fair", None, "odd"),
        ],
        EVENTS,
    )
    single = clean.largest_per_day(raw)
    assert single.count() == 4
    daily = clean.roll_up_events(clean.clean_events(single)).orderBy("date").collect()
    first, second = daily
    assert (first["event_count"], first["total_attendance"], first["max_attendance"]) == (2, 210, 90)
    assert first["event_types"] == "Sports, Fair, Parade"
    assert (first["max_impact_score"], first["has_high_impact"], first["has_event"]) == (2, 0, 1)
    assert (second["total_attendance"], second["max_impact_score"]) == (0, 0)


def test_merge_fills_events_but_not_weather(frame):
    trips = frame([(1, day(1)), (2, day(9))], "incident_id long, date date")
    weather_days = frame([(day(1), 2.0)], "date date, precipitation_mm double")
    event_days = clean.roll_up_events(clean.clean_events(frame([(day(1), "A", "Fair", 5, "High")], EVENTS)))
    got = {r["incident_id"]: r for r in clean.merge_days(trips, weather_days, event_days).collect()}
    assert got[2]["precipitation_mm"] is None
    assert (got[2]["has_event"], got[2]["event_types"], got[2]["total_attendance"]) == (0, "None", 0)
    assert (got[1]["has_event"], got[1]["has_high_impact"], got[1]["event_types"]) == (1, 1, "Fair")


def test_half_even_rounding(frame):
    inputs = [-0.125, 0.125, 0.375, 1.005, 2.675, 10.345]
    rounded = frame([(x,) for x in inputs], "x double").select(core.half_even(F.col("x"), 2).alias("r"))
    assert [r for (r,) in values(rounded)] == list(np.round(inputs, 2))


def test_bins_are_open_below_closed_above(frame):
    df = frame([(v,) for v in (-30.0, -29.0, 0.0, 10.0, 50.0, 51.0)], "t double")
    got = df.select("t", weather.temperature_category(F.col("t")).alias("c"))
    assert [c for _, c in values(got)] == [None, "Freezing", "Freezing", "Cold", "Hot", None]


def test_season_period_weekday(frame):
    df = frame([(day(1), 4), (dt.date(2023, 9, 4), 5), (dt.date(2023, 6, 4), 20)], "date date, hour int")
    got = features.add_time_features(df).orderBy("hour").collect()
    assert [(r["season"], r["time_period"], r["day_of_week_num"]) for r in got] == [
        ("Winter", "Night", 6), ("Autumn", "Early_Morning", 0), ("Summer", "Night", 6),
    ]
    assert got[0]["week_of_year"] == 52  # ISO week of 2023-01-01
    assert len(calendar.WEEKDAYS) == 7


def test_lags_run_over_observed_days_and_include_today(frame):
    rows = [(day(1), 8, 10.0), (day(1), 9, 20.0), (day(5), 8, 30.0), (day(9), 8, 50.01)]
    df = features.add_lag_features(frame(rows, "date date, hour int, delay_minutes double"))
    got = {(r["date"], r["hour"]): r for r in df.collect()}
    mean = (10 + 20 + 30 + 50.01) / 4
    assert got[day(1), 8]["prev_day_avg_delay"] == mean
    assert got[day(5), 8]["prev_day_avg_delay"] == 15.0
    assert got[day(9), 8]["rolling_3d_avg_delay"] == 31.67
    assert got[day(9), 8]["delay_trend_3d"] == 18.34
    assert got[day(1), 9]["delay_trend_3d"] == 0.0


def test_leak_free_lags_ignore_today(frame):
    rows = [(day(1), 10.0), (day(2), 99.0), (day(3), 30.0)]
    daily = features.daily_delay(frame(rows, "date date, delay_minutes double"))
    got = features.daily_lags(daily, leak_free=True).orderBy("date").collect()
    assert [r["rolling_3d_avg_delay"] for r in got] == [None, 10.0, 54.5]


def test_event_features_without_event_columns(frame):
    got = features.add_event_features(frame([(1,)], "incident_id long")).first()
    assert (got["event_impact_score"], got["has_large_event"], got["has_multiple_events"]) == (0.0, 0, 0)


def test_weather_features_of_a_day_without_report(frame):
    schema = "precipitation_mm double, wind_speed_max_kmh double, weather_severity int, temperature_mean_c double"
    got = features.add_weather_features(frame([(None, None, None, None)], schema)).first()
    assert got["weather_severity_index"] is None and got["temp_category"] is None
    assert (got["rain_category"], got["is_extreme_weather"], got["is_rainy_day"], got["is_snowy_day"]) == ("No_Rain", 0, 0, 0)


def test_numbers_beyond_their_type_count_as_missing(frame):
    rows = frame([("99999999999",), ("Infinity",), ("-1e300",), ("3.0",), (None,)], "x string")
    assert [r[0] for r in rows.select(core.whole_number(F.col("x"))).collect()] == [0, 0, 0, 3, 0]
    events = frame([("e", " t ", "high", "1e30"), ("f", "t", None, "12")], "event_name string, event_type string, impact_level string, expected_attendance string")
    assert values(clean.clean_events(events), "event_name", "expected_attendance") == [("e", 0), ("f", 12)]


def test_two_landed_fields_of_one_column_are_merged(frame):
    df = frame([(1, None, "pre-k"), (2, "school", "x")], "busbreakdown_id int, school_age_or_prek string, school_age_or_pre_k string")
    got = clean.rename_trip_fields(df)
    assert sorted(got.columns) == ["incident_id", "service_type"]
    assert values(got, "incident_id", "service_type") == [(1, "pre-k"), (2, "school")]
