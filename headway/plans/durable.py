"""A warehouse at a named path: later sessions read it in place, changed months are rewritten alone.

    path/facts/date_month=2024-01/...   the incident facts
    path/days-<version>                 the day dimension and the series of that version
    path/months-<version>               per month of raw records: rows and a digest
    path/manifest/version=<n>           written last; names the tables of a version

A reader opens the tables that the newest manifest names. A refresh compares the months of the raw
records with those of the manifest, recomputes the facts of the months that changed and of those
that share an incident with them, and overwrites only these. The small tables are written anew under
the next version, and the manifest comes last. The raw records stay where they are.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.operators import clean, features, series
from headway.plans.staging import small_splits
from headway.plans.warehouse import Warehouse

#: Small tables of a version, each written once and read as it is.
TABLES = ("days", "weather", "event_days", "daily", "borough_days", "network_days")
MONTH = "date_month"


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def version_of(spark: SparkSession, path: str) -> int:
    """The newest version at a path; 0 where there is none."""
    found = _read(spark, f"{path}/manifest")
    return 0 if found is None else int(found.agg(F.max("version")).first()[0])


def _month(df: DataFrame) -> Column:
    return F.date_format(clean.as_timestamp(df, "created_on"), "yyyy-MM")


def raw_months(raw: DataFrame) -> DataFrame:
    """(date_month, records, digest) of raw records: equal for equal rows in whatever order."""
    digest = F.sum(F.xxhash64(*[F.col(f"`{c}`") for c in sorted(raw.columns)]).cast("decimal(38,0)"))
    return raw.groupBy(_month(raw).alias(MONTH)).agg(F.count("*").alias("records"), digest.alias("digest"))


class DurableWarehouse(Warehouse):
    """The warehouse of one version at a path: every table is read, none is computed."""

    def __init__(self, spark: SparkSession, path: str, version: int | None = None) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.version = version or version_of(spark, self.path)
        if not self.version:
            raise FileNotFoundError(f"no warehouse at {path}")
        for name in TABLES:
            setattr(self, name, spark.read.parquet(f"{self.path}/{name}-{self.version}"))
        self.facts = spark.read.parquet(f"{self.path}/facts")

    @property
    def manifest(self) -> dict:
        rows = self.spark.read.parquet(f"{self.path}/manifest").where(F.col("version") == self.version)
        return rows.first().asDict()


def _publish(spark: SparkSession, path: str, version: int, weather_raw: DataFrame, events_raw: DataFrame,
             months: DataFrame, typical: float | None, rewritten: list[str]) -> DurableWarehouse:
    """Write the small tables of a version from its facts, then the manifest."""
    facts = spark.read.parquet(f"{path}/facts").drop(MONTH)

    def write(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{path}/{name}-{version}")
        return spark.read.parquet(f"{path}/{name}-{version}")

    weather = write(clean.clean_weather(clean.classify_weather(weather_raw)), "weather")
    events = clean.roll_up_events(clean.clean_events(clean.largest_per_day(events_raw)))
    with small_splits(spark):
        event_days = write(events, "event_days")
    daily = write(features.daily_delay(facts), "daily")
    lags = features.fill_lags(features.daily_lags(daily), features.mean_over_records(daily))
    lags = lags.drop("delay_sum", "delay_records", "daily_avg_delay")
    days = clean.merge_days(lags, weather, event_days)
    for add in (features.add_date_features, features.add_weather_features, features.add_event_features):
        days = add(days)
    write(days, "days")
    write(series.daily_series(facts, ["borough"]), "borough_days")
    write(series.daily_series(facts), "network_days")
    write(months, "months")
    manifest = spark.createDataFrame([(typical, rewritten)], "typical DOUBLE, rewritten ARRAY<STRING>")
    manifest.coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest/version={version}")
    return DurableWarehouse(spark, path, version)


def _facts(raw: DataFrame, typical: float | None) -> DataFrame:
    cleaned = clean.clean_trips(raw, F.lit(typical).cast("double"))
    return cleaned.withColumn(MONTH, F.date_format("date", "yyyy-MM"))


def refresh(path: str, trips_raw: DataFrame, weather_raw: DataFrame, events_raw: DataFrame) -> DurableWarehouse:
    """Bring the warehouse at a path up to date with the raw tables; the first call builds it.

    Months of facts are rewritten if their raw records changed, or if they share an incident with
    such a month, as the newest record of an incident counts wherever it lies. The fill value of
    missing delays depends on all records: if it moves, all months are rewritten. Months that are no
    longer there are emptied. `manifest["rewritten"]` lists the months written.
    """
    spark, path = trips_raw.sparkSession, path.rstrip("/")
    version = version_of(spark, path)
    typical = clean.typical_delay(trips_raw).first()[0]
    months = raw_months(trips_raw).where(F.col(MONTH).isNotNull())
    target = f"{path}/facts"
    known = DurableWarehouse(spark, path, version).manifest if version else None
    if known is None or known["typical"] != typical:
        facts = _facts(trips_raw, typical)
        with small_splits(spark):
            facts.hint("rebalance", MONTH).write.mode("overwrite").partitionBy(MONTH).parquet(target)
        wrote = sorted(r[0] for r in spark.read.parquet(target).select(MONTH).distinct().collect())
        return _publish(spark, path, version + 1, weather_raw, events_raw, months, typical, wrote)

    before = spark.read.parquet(f"{path}/months-{version}")
    old, new = before.alias("a"), months.alias("b")
    differs = (F.col("a.records") != F.col("b.records")) | (F.col("a.digest") != F.col("b.digest"))
    joined = old.join(new, F.col(f"a.{MONTH}") == F.col(f"b.{MONTH}"), "full")
    either = F.coalesce(f"a.{MONTH}", f"b.{MONTH}")
    one_sided = F.col(f"a.{MONTH}").isNull() | F.col(f"b.{MONTH}").isNull()
    changed = sorted(r[0] for r in joined.where(one_sided | differs).select(either).collect())
    if not changed:
        return DurableWarehouse(spark, path, version)
    facts = spark.read.parquet(target)
    touched = trips_raw.where(_month(trips_raw).isin(changed)).select("incident_id")
    touched = touched.unionByName(facts.where(F.col(MONTH).isin(changed)).select("incident_id")).distinct()
    shared = trips_raw.join(touched, "incident_id", "left_semi")
    near = shared.select(_month(shared).alias(MONTH)).distinct()
    near = near.unionByName(facts.join(touched, "incident_id", "left_semi").select(MONTH).distinct())
    wide = sorted({r[0] for r in near.where(F.col(MONTH).isNotNull()).collect()} | set(changed))

    # All records of an incident decide which one counts, those in other months included.
    inside = trips_raw.where(_month(trips_raw).isin(wide)).select("incident_id").distinct()
    candidates = trips_raw.join(inside, "incident_id", "left_semi")
    fresh = _facts(candidates, typical).where(F.col(MONTH).isin(wide))
    writer = fresh.hint("rebalance", MONTH).write.mode("overwrite").partitionBy(MONTH)
    with small_splits(spark):
        writer.option("partitionOverwriteMode", "dynamic").parquet(target)
    left = {r[0] for r in spark.read.parquet(target).where(F.col(MONTH).isin(wide)).select(MONTH).distinct().collect()}
    gone = sorted(left - {r[0] for r in fresh.select(MONTH).distinct().collect()})
    for month in gone:  # a month without records any more
        empty = spark.read.parquet(target).drop(MONTH).limit(0)
        empty.write.mode("overwrite").parquet(f"{target}/{MONTH}={month}")
    return _publish(spark, path, version + 1, weather_raw, events_raw, months, typical, wide)
