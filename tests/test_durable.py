"""The warehouse at a path: opened without writing, refreshed by changed months."""

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from headway.operators import clean
from headway.plans.durable import DurableWarehouse, refresh
from headway.plans.warehouse import Warehouse
from tests.conftest import values

TRIPS = "incident_id BIGINT, created_on TIMESTAMP_NTZ, occurred_on TIMESTAMP_NTZ, delay_description STRING, borough STRING, delay_reason STRING, incident_type STRING, run_type STRING, route_id STRING, bus_company STRING, passenger_count STRING"
BUCKETS = ["0-15 Min", "16-30 Min", "31-45 Min", None]


def trip(i, month, day, bucket, borough="Bronx"):
    at = dt.datetime(2024, month, day, i % 24)
    return (i, at, at, bucket, borough, "Traffic", "Running Late", "A", str(i % 5), "co", "3")


def raw_trips():
    return [trip(i, 1 + i % 3, 1 + i % 28, BUCKETS[i % 4]) for i in range(120)]


@pytest.fixture(scope="module")
def others(spark):
    days = [dt.date(2024, m, d) for m in range(1, 6) for d in range(1, 29)]
    columns = ["precipitation_mm", "rain_mm", "snowfall_cm", "wind_speed_max_kmh", "temperature_max_c", "temperature_min_c", "temperature_mean_c", "apparent_temp_min_c"]
    weather = spark.createDataFrame(
        [(d, *[float((d.day * k) % 9) for k in range(1, 9)]) for d in days],
        "date DATE, " + ", ".join(f"{c} DOUBLE" for c in columns),
    )
    weather = weather.withColumns({c: F.lit(1.0) for c in ("apparent_temp_max_c", "precipitation_hours", "wind_gusts_max_kmh", "wind_direction_dominant", "solar_radiation_mj", "evapotranspiration_mm")})
    events = spark.createDataFrame(
        [(dt.date(2024, 1, 5), "Fair", "Festival", 5000, "High", False)],
        "date DATE, event_name STRING, event_type STRING, expected_attendance BIGINT, impact_level STRING, nationwide BOOLEAN",
    )
    return weather, events


def files_of(path):
    return {str(f): f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet")}


def same_as_built_at_once(star, rows, others):
    spark = star.spark
    plain = Warehouse(lambda: spark.createDataFrame(rows, TRIPS), lambda: others[0], lambda: others[1])
    assert values(star.trips.select(sorted(star.trips.columns))) == values(plain.trips.select(sorted(plain.trips.columns)))
    assert values(star.days.select(sorted(star.days.columns))) == values(plain.days.select(sorted(plain.days.columns)))


def test_a_month_is_added_and_another_session_reads_in_place(spark, tmp_path, others):
    path, rows = str(tmp_path / "w"), raw_trips()
    first = refresh(path, spark.createDataFrame(rows, TRIPS), *others)
    assert first.version == 1 and first.manifest["rewritten"] == ["2024-01", "2024-02", "2024-03"]
    same_as_built_at_once(first, rows, others)

    before = files_of(path)
    later = DurableWarehouse(spark.newSession(), path)
    assert later.featured.count() == 120 and later.network_days.count() > 0
    assert refresh(path, spark.createDataFrame(rows, TRIPS), *others).version == 1
    assert files_of(path) == before  # neither opening nor an idle refresh writes

    rows = rows + [trip(500 + i, 4, 1 + i, BUCKETS[i % 3]) for i in range(12)]
    second = refresh(path, spark.createDataFrame(rows, TRIPS), *others)
    assert second.version == 2 and second.manifest["rewritten"] == ["2024-04"]
    facts = {f: t for f, t in files_of(path).items() if "/facts/" in f}
    assert {f: t for f, t in before.items() if "/facts/" in f}.items() <= facts.items()
    same_as_built_at_once(second, rows, others)


def test_incidents_that_move_between_months_and_months_that_go(spark, tmp_path, others):
    path, rows = str(tmp_path / "w"), raw_trips()
    refresh(path, spark.createDataFrame(rows, TRIPS), *others)
    newer = trip(0, 3, 28, "16-30 Min", "Queens")  # incident 0 was one of January
    moved = refresh(path, spark.createDataFrame([*rows, newer], TRIPS), *others)
    assert moved.manifest["rewritten"] == ["2024-01", "2024-03"]
    same_as_built_at_once(moved, [*rows, newer], others)

    fewer = [r for r in rows if r[1].month != 2]
    again = refresh(path, spark.createDataFrame(fewer, TRIPS), *others)
    same_as_built_at_once(again, fewer, others)
    assert again.facts.where("date_month = '2024-02'").count() == 0


def test_a_new_fill_value_rewrites_all_months(spark, tmp_path, others):
    path, rows = str(tmp_path / "w"), raw_trips()
    refresh(path, spark.createDataFrame(rows, TRIPS), *others)
    rows = rows + [trip(900 + i, 4, 1 + i % 28, "61-90 Min") for i in range(200)]
    after = refresh(path, spark.createDataFrame(rows, TRIPS), *others)
    assert after.manifest["rewritten"] == ["2024-01", "2024-02", "2024-03", "2024-04"]
    assert after.manifest["typical"] == clean.typical_delay(spark.createDataFrame(rows, TRIPS)).first()[0]
    same_as_built_at_once(after, rows, others)


def test_no_warehouse_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        DurableWarehouse(spark, str(tmp_path / "none"))
