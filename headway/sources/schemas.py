"""Schemas and renames of the three landed tables."""

from __future__ import annotations

# Field names of the landed incident records and our column names.
TRIP_RENAMES = {
    "busbreakdown_id": "incident_id",
    "boro": "borough",
    "bus_company_name": "bus_company",
    "how_long_delayed": "delay_description",
    "reason": "delay_reason",
    "route_number": "route_id",
    "bus_no": "bus_number",
    "number_of_students_on_the_bus": "passenger_count",
    "breakdown_or_running_late": "incident_type",
    "school_age_or_pre_k": "service_type",
    "school_age_or_prek": "service_type",
}

# Field names of the landed daily weather document and our column names.
WEATHER_RENAMES = {
    "temperature_2m_max": "temperature_max_c",
    "temperature_2m_min": "temperature_min_c",
    "temperature_2m_mean": "temperature_mean_c",
    "apparent_temperature_max": "apparent_temp_max_c",
    "apparent_temperature_min": "apparent_temp_min_c",
    "precipitation_sum": "precipitation_mm",
    "rain_sum": "rain_mm",
    "snowfall_sum": "snowfall_cm",
    "precipitation_hours": "precipitation_hours",
    "wind_speed_10m_max": "wind_speed_max_kmh",
    "wind_gusts_10m_max": "wind_gusts_max_kmh",
    "wind_direction_10m_dominant": "wind_direction_dominant",
    "shortwave_radiation_sum": "solar_radiation_mj",
    "et0_fao_evapotranspiration": "evapotranspiration_mm",
}

WEATHER_MEASURES = list(WEATHER_RENAMES.values())

TRIPS_SCHEMA = """
    incident_id BIGINT, created_on TIMESTAMP_NTZ, occurred_on TIMESTAMP_NTZ,
    delay_description STRING, borough STRING, delay_reason STRING, incident_type STRING,
    run_type STRING, route_id STRING, bus_company STRING, passenger_count STRING
"""

EVENTS_SCHEMA = """
    date DATE, event_name STRING, event_type STRING, expected_attendance BIGINT,
    impact_level STRING, nationwide BOOLEAN
"""

HOLIDAY_SCHEMA = "date DATE, localName STRING, global BOOLEAN"

WEATHER_DOCUMENT_SCHEMA = "daily STRUCT<time: ARRAY<STRING>, {}>".format(
    ", ".join(f"{name}: ARRAY<DOUBLE>" for name in WEATHER_RENAMES)
)
