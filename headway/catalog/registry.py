"""Registered queries and their reference SQL, one key per operator group."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from headway.catalog import roles
from headway.plans.warehouse import Warehouse

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

_warehouses: dict[tuple[str, str], Warehouse] = {}


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """One warehouse per application and input folder; its stages are built once."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _warehouses:
        _warehouses[key] = Warehouse(
            lambda: roles.trips_raw(spark, sf_dir),
            lambda: roles.weather_raw(spark, sf_dir),
            lambda: roles.events_raw(spark, sf_dir),
        )
    return _warehouses[key]


def register(name: str, sql: str | None = None) -> Callable[[Callable[[Warehouse], DataFrame]], Query]:
    """Register a function of the warehouse as a query, with its SQL where SQL can say it."""

    def wrap(build: Callable[[Warehouse], DataFrame]) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(warehouse(spark, sf_dir))

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return wrap
