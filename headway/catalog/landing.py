"""Source and sink queries: each writes a whole table, reads it back and returns what it read."""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.catalog.registry import register
from headway.catalog.sql import recurring_select, seed_values, with_ctes
from headway.operators import clean
from headway.plans.durable import DurableWarehouse, refresh
from headway.plans.staging import new_path, small_splits, stage
from headway.plans.warehouse import Warehouse
from headway.sources import files, generators
from headway.sources.schemas import EVENTS_SCHEMA, TRIPS_SCHEMA, WEATHER_MEASURES, WEATHER_RENAMES


@register("csv_roundtrip", with_ctes("SELECT * FROM trips_raw"))
def csv_roundtrip(w: Warehouse):
    path = new_path(w.trips_raw.sparkSession, "trips.csv")
    files.write_csv(w.trips_raw, path)
    return files.read_csv(w.trips_raw.sparkSession, path, TRIPS_SCHEMA)


@register("parquet_scan", with_ctes("SELECT * FROM trips"))
def parquet_scan(w: Warehouse):
    """The base name has only a `.parquet` table here; the tests cover the CSV fallback."""
    spark = w.trips.sparkSession
    base = new_path(spark, "trips")
    w.trips.withColumn("date", F.col("date").cast("string")).write.parquet(f"{base}.parquet")
    return files.read_table(spark, base)


@register("json_columnar_explode", with_ctes("SELECT * FROM weather_raw"))
def json_columnar_explode(w: Warehouse):
    """Written as one document per year, so no array outgrows a year of days."""
    spark = w.weather_raw.sparkSession
    path = new_path(spark, "weather.json")
    fields = [F.col("date").cast("string").alias("time")]
    fields += [F.col(new).alias(old) for old, new in WEATHER_RENAMES.items()]
    days = w.weather_raw.groupBy(F.year("date").alias("year")).agg(
        F.sort_array(F.collect_list(F.struct(*fields))).alias("days")
    )
    arrays = [F.col(f"days.{name}").alias(name) for name in ["time", *WEATHER_RENAMES]]
    days.select(F.struct(*arrays).alias("daily")).write.json(path)
    return files.read_weather_documents(spark, path).select("date", *WEATHER_MEASURES)


@register("json_pages_union", with_ctes("SELECT * FROM trips_raw"))
def json_pages_union(w: Warehouse):
    """Null fields are left out when written, so the pages are ragged. Pages are small files, so they
    may be compressed: each is read by one task anyway."""
    spark = w.trips_raw.sparkSession
    path = new_path(spark, "pages.json")
    w.trips_raw.write.option("maxRecordsPerFile", 10000).json(path, compression="gzip")
    return files.read_record_pages(spark, path, TRIPS_SCHEMA)


def _landed_holidays(w: Warehouse) -> DataFrame:
    spark = w.events_raw.sparkSession
    path = new_path(spark, "holidays.json")
    w.events_raw.select(
        "date", F.col("event_type").alias("localName"), F.col("nationwide").alias("global")
    ).write.json(path)
    return files.read_holidays(spark, path)


_HOLIDAYS = (
    "SELECT date, event_type AS event_name, 'Public Holiday' AS event_type, CAST(0 AS BIGINT) AS expected_attendance, "
    "'High' AS impact_level, coalesce(nationwide, true) AS nationwide FROM events_raw"
)


@register("holiday_projection", with_ctes(_HOLIDAYS))
def holiday_projection(w: Warehouse):
    return _landed_holidays(w)


@register(
    "csv_to_parquet",
    with_ctes(
        "SELECT 'trips' AS table_name, count(*) AS records, count(DISTINCT created_on) AS moments FROM trips_raw "
        "UNION ALL SELECT 'weather', count(*), count(DISTINCT date) FROM weather_raw "
        "UNION ALL SELECT 'events', count(*), count(DISTINCT date) FROM events_raw"
    ),
)
def csv_to_parquet(w: Warehouse):
    """Converts all three tables and counts the rows and moments of the Parquet side."""
    tables, _ = _converted(w)
    counted = None
    for name, moment in _MOMENTS.items():
        found = w.trips_raw.sparkSession.read.parquet(tables[name][1]).agg(
            F.lit(name).alias("table_name"),
            F.count("*").alias("records"),
            F.countDistinct(moment).alias("moments"),
        )
        counted = found if counted is None else counted.union(found)
    return counted


_MOMENTS = {"trips": "created_on", "weather": "date", "events": "date"}


@cache
def _converted(w: Warehouse) -> tuple[dict[str, tuple[str, str, str]], DataFrame]:
    """The three tables landed as CSV and converted: their paths, and the report."""
    spark = w.trips_raw.sparkSession
    weather_schema = "date DATE, " + ", ".join(f"{c} DOUBLE" for c in WEATHER_MEASURES)
    sources = {
        "trips": (w.trips_raw, TRIPS_SCHEMA),
        "weather": (w.weather_raw, weather_schema),
        "events": (w.events_raw, EVENTS_SCHEMA),
    }
    tables = {}
    for name, (df, schema) in sources.items():
        source, target = new_path(spark, f"{name}.csv"), new_path(spark, f"{name}.parquet")
        files.write_csv(df.select([part.split()[0] for part in schema.split(",")]), source)
        tables[name] = (source, target, schema)
    return tables, files.csv_to_parquet(spark, tables)


@register(
    "csv_size_report",
    with_ctes(
        "SELECT 'trips' AS table_name, count(*) AS records, CAST(0 AS BIGINT) AS bad_records, true AS smaller FROM trips_raw "
        "UNION ALL SELECT 'weather', count(*), 0, true FROM weather_raw "
        "UNION ALL SELECT 'events', count(*), 0, true FROM events_raw"
    ),
)
def csv_size_report(w: Warehouse):
    """What the conversion reports: rows, rows that did not fit, and whether Parquet takes less room."""
    report = _converted(w)[1]
    smaller = (F.col("parquet_bytes") < F.col("csv_bytes")).alias("smaller")
    return report.select("table_name", "records", "bad_records", smaller)


@register(
    "csv_folder",
    with_ctes(
        "SELECT incident_id, borough, CASE WHEN incident_id % 3 = 2 THEN NULL ELSE delay_reason END AS delay_reason, "
        "CASE WHEN incident_id % 3 = 0 THEN NULL ELSE route_id END AS route_id FROM trips_raw"
    ),
)
def csv_folder(w: Warehouse):
    """Incidents landed as files of three different headers, read as one table."""
    folder = new_path(w.trips_raw.sparkSession, "mixed.csv")
    headers = [["incident_id", "borough", "delay_reason"], ["route_id", "delay_reason", "borough", "incident_id"],
               ["borough", "incident_id", "route_id"]]
    for part, columns in enumerate(headers):
        files.write_csv(w.trips_raw.where(F.col("incident_id") % 3 == part).select(columns), f"{folder}/part={part}")
    schema = "incident_id BIGINT, borough STRING, delay_reason STRING, route_id STRING"
    return files.read_csv_folder(w.trips_raw.sparkSession, f"{folder}/*", schema)


_CALENDAR = (
    "SELECT CAST(unnest(generate_series(low, high, INTERVAL 1 DAY)) AS DATE) AS date "
    "FROM (SELECT min(date) AS low, max(date) AS high FROM trips) AS bounds"
)


@register("calendar", with_ctes(_CALENDAR))
def calendar(w: Warehouse):
    return generators.calendar(generators.date_bounds(w.trips))


@register(
    "recurring_events", with_ctes(recurring_select("days"), {"days": _CALENDAR})
)
def recurring_events(w: Warehouse):
    return generators.recurring_events(calendar_of(w))


def calendar_of(w: Warehouse) -> DataFrame:
    return generators.calendar(generators.date_bounds(w.trips))


@register(
    "events_union",
    with_ctes(
        "SELECT * FROM all_events QUALIFY row_number() OVER (PARTITION BY date, event_name "
        "ORDER BY expected_attendance DESC NULLS LAST, event_type NULLS LAST, impact_level NULLS LAST, nationwide NULLS LAST) = 1",
        {
            "days": _CALENDAR,
            "holidays": _HOLIDAYS,
            "seeds": seed_values(),
            "recurring": recurring_select("days"),
            "all_events": "SELECT * FROM events_raw UNION ALL SELECT * FROM holidays UNION ALL SELECT * FROM seeds UNION ALL SELECT * FROM recurring",
        },
    ),
)
def events_union(w: Warehouse):
    spark = w.events_raw.sparkSession
    union = clean.union_events(
        w.events_raw,
        _landed_holidays(w),
        generators.seed_events(spark),
        generators.recurring_events(calendar_of(w)),
    )
    with small_splits(spark):  # each task sorts its events before the shuffle
        return stage(union, "events_union")


@register(
    "export_head",
    with_ctes(
        "SELECT incident_id, date, hour, borough, delay_minutes FROM trips "
        "ORDER BY date NULLS LAST, hour NULLS LAST, incident_id LIMIT 1000"
    ),
)
def export_head(w: Warehouse):
    spark = w.trips.sparkSession
    path = new_path(spark, "head.csv")
    columns = w.trips.select("incident_id", "date", "hour", "borough", "delay_minutes")
    files.export_head(columns, ["date", "hour", "incident_id"], path)
    schema = "incident_id BIGINT, date DATE, hour INT, borough STRING, delay_minutes DOUBLE"
    return files.read_csv(spark, path, schema)


@register(
    "warehouse_months",
    with_ctes("SELECT strftime(date, '%Y-%m') AS month, count(*) AS records FROM trips GROUP BY strftime(date, '%Y-%m')"),
)
def warehouse_months(w: Warehouse):
    """Incidents per month of a warehouse written to a named path and opened there again."""
    spark = w.trips_raw.sparkSession
    path = new_path(spark, "warehouse")
    refresh(path, w.trips_raw, w.weather_raw, w.events_raw)
    months = DurableWarehouse(spark, path).facts.groupBy(F.col("date_month").alias("month"))
    return months.agg(F.count("*").alias("records"))
