"""The given tables in the roles of incidents, daily weather and city events.

Every row of `lineitem` is an incident, every day of `orders` a weather report and every order a
city event. The same SQL serves both engines; only the hour arithmetic is spelled differently.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TRIPS_RAW = """
SELECT l_orderkey * 10 + l_linenumber AS incident_id, l_shipdate AS created_on,
  CASE WHEN l_partkey % 29 = 0 THEN NULL ELSE {occurred} END AS occurred_on,
  CASE WHEN l_quantity <= 10 THEN '0-15 Min' WHEN l_quantity <= 20 THEN '16-30 Min'
       WHEN l_quantity <= 30 THEN '31-45 Min' WHEN l_quantity <= 40 THEN '46-60 Min'
       WHEN l_quantity <= 46 THEN '61-90 Min' END AS delay_description,
  CASE WHEN n_nationkey = 24 THEN NULL ELSE concat(' ', n_name, ' ') END AS borough,
  p_type AS delay_reason,
  CASE l_returnflag WHEN 'A' THEN 'Running Late' WHEN 'R' THEN 'Breakdown' END AS incident_type,
  p_brand AS run_type, CAST(l_suppkey AS VARCHAR(20)) AS route_id, s_name AS bus_company,
  CASE WHEN l_linenumber = 7 THEN 'n/a'
       ELSE concat(CAST(CAST(l_quantity AS INT) AS VARCHAR(20)), '.0') END AS passenger_count
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  JOIN part ON l_partkey = p_partkey
"""

OCCURRED_SPARK = "timestampadd(HOUR, CAST(l_partkey % 24 AS INT), l_shipdate)"
OCCURRED_DUCKDB = "l_shipdate + to_hours(CAST(l_partkey % 24 AS INT))"

WEATHER_RAW = """
SELECT d AS date,
  CAST(c % 36 - 8 + n % 7 AS DOUBLE) AS temperature_max_c,
  CAST(c % 36 - 8 - c % 6 AS DOUBLE) AS temperature_min_c,
  CAST(c % 36 - 8 AS DOUBLE) AS temperature_mean_c,
  CAST(c % 36 - 6 + n % 7 AS DOUBLE) AS apparent_temp_max_c,
  CAST(c % 36 - 8 - c % 6 - w % 5 AS DOUBLE) AS apparent_temp_min_c,
  CASE WHEN k % 11 = 0 THEN NULL ELSE CAST(m * m AS DOUBLE) / 40.0e0 END AS precipitation_mm,
  CASE WHEN k % 11 = 0 THEN NULL ELSE CAST(m * m AS DOUBLE) / 50.0e0 END AS rain_mm,
  CASE WHEN month(d) IN (12, 1, 2) THEN CAST(w % 30 + c % 9 AS DOUBLE) / 2.0e0 - 3.5e0
       ELSE 0.0e0 END AS snowfall_cm,
  CAST(m % 24 AS DOUBLE) AS precipitation_hours,
  CAST(w % 66 AS DOUBLE) AS wind_speed_max_kmh,
  CAST(w % 66 + c % 20 AS DOUBLE) AS wind_gusts_max_kmh,
  CAST(k % 360 AS DOUBLE) AS wind_direction_dominant,
  CASE WHEN w % 13 = 0 THEN NULL ELSE CAST(c % 30 AS DOUBLE) END AS solar_radiation_mj,
  CAST(c % 8 AS DOUBLE) / 2.0e0 AS evapotranspiration_mm
FROM (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n, sum(o_custkey % 997) AS c,
        sum(o_orderkey % 991) AS k, sum(o_custkey % 997) % 41 AS m,
        sum((o_custkey + o_orderkey) % 983) AS w
      FROM orders GROUP BY CAST(o_orderdate AS DATE)) AS per_day
"""

EVENTS_RAW = """
SELECT CAST(o_orderdate AS DATE) AS date,
  concat('EVT_', CAST(o_custkey % 20 AS VARCHAR(20))) AS event_name, c_mktsegment AS event_type,
  CAST(floor(o_totalprice / 2) AS BIGINT) AS expected_attendance,
  CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'High' WHEN '2' THEN ' high'
       WHEN '3' THEN 'MEDIUM' WHEN '5' THEN 'Low' END AS impact_level,
  CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS nationwide
FROM orders JOIN customer ON o_custkey = c_custkey
"""


def _tables(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in names}


def trips_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    query = TRIPS_RAW.format(occurred=OCCURRED_SPARK)
    for name in ("lineitem", "supplier", "nation", "part"):
        query = query.replace(f" {name} ", f" {{{name}}} ", 1)
    return spark.sql(query, **_tables(spark, sf_dir, "lineitem", "supplier", "nation", "part"))


def weather_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    query = WEATHER_RAW.replace("FROM orders ", "FROM {orders} ")
    return spark.sql(query, **_tables(spark, sf_dir, "orders"))


def events_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    query = EVENTS_RAW.replace("FROM orders JOIN customer ", "FROM {orders} JOIN {customer} ")
    return spark.sql(query, **_tables(spark, sf_dir, "orders", "customer"))
