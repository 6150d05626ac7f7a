"""Daily series: gap filling, Holt-Winters fits and forecasts."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway.functions import smoothing
from headway.operators.clean import fill_gaps
from headway.plans.staging import stage
from headway.sources.generators import calendar

HORIZON = 7


def daily_series(df: DataFrame, by: list[str] | None = None, y: str = "delay_minutes") -> DataFrame:
    """Mean per day over each series' whole calendar; missing days carry the last value forward.

    Everything after the first aggregate is day-grain: a series holds one row per calendar day.
    """
    by = by or []
    means = stage(df.groupBy(*by, "date").agg(F.avg(y).alias("value")), "series_means")
    bounds = means.groupBy(*by).agg(F.min("date").alias("low"), F.max("date").alias("high"))
    days = calendar(bounds)
    return days.join(means, [*by, "date"], "left").transform(fill_gaps, ["value"], "date", by)


def _series_arrays(daily: DataFrame, by: list[str]) -> DataFrame:
    """One row per series with its values in date order; as long as its calendar, never more."""
    points = F.sort_array(F.collect_list(F.struct("date", "value")))
    keys = [F.col(c) for c in by] or [F.lit("all").alias("series")]
    return daily.groupBy(*keys).agg(points.alias("points")).select(
        *(by or ["series"]),
        F.element_at("points.date", -1).alias("last_date"),
        F.col("points.value").alias("values"),
    )


def _per_series(daily: DataFrame, by: list[str], fit: Callable[[Sequence[float]], dict], fields: list[T.StructField]) -> DataFrame:
    """One row of `fit` per series, all series in parallel."""
    series = _series_arrays(daily, by)
    schema = T.StructType([*[f for f in series.schema.fields if f.name != "values"], *fields])

    def run(frames):
        for frame in frames:
            found = pd.DataFrame([fit(v) for v in frame["values"]], columns=[f.name for f in fields])
            yield pd.concat([frame.drop(columns="values").reset_index(drop=True), found], axis=1)

    # Few bytes but much work per row: a partition count given by hand is not merged by adaptive
    # execution, and hashing the hash makes it a shuffle of its own.
    parts = int(daily.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return series.repartition(parts, F.xxhash64(*(by or ["series"]))).mapInPandas(run, schema)


def _numbers(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.DoubleType()) for name in names]


def _list(name: str) -> T.StructField:
    return T.StructField(name, T.ArrayType(T.DoubleType()))


DAYS = T.StructField("days", T.IntegerType())


def fit_holt_winters(daily: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Additive trend and weekly season per series: the weights and starting states (level, trend,
    the week's seven) of least squared error, that error, and the next seven values.

    A series shorter than two weeks repeats its last week instead.
    """
    fields = [DAYS, *_numbers("alpha", "beta", "gamma", "sse"), _list("start"), _list("steps")]
    return _per_series(daily, by or [], lambda v: smoothing.best_fit(v, HORIZON), fields)


def smooth(daily: DataFrame, weights: tuple[float, float, float], by: list[str] | None = None) -> DataFrame:
    """The same smoothing with given weights, from the first two weeks: error and next seven values."""
    fields = [DAYS, *_numbers("sse"), _list("steps")]
    return _per_series(daily, by or [], lambda v: smoothing.smoothed(v, weights, HORIZON), fields)


def seasonal_naive(daily: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The last seven values of each series, repeated: a forecast without a fit."""
    back = F.row_number().over(W.partitionBy(*(by or [])).orderBy(F.desc("date")))
    recent = daily.withColumn("back", back).where(F.col("back") <= HORIZON)
    return recent.select(
        *(by or []), F.date_add("date", HORIZON).alias("date"), F.col("value").alias("delay")
    )


def forecast_steps(fits: DataFrame, by: list[str] | None = None) -> DataFrame:
    """One row per forecast day."""
    keys = by or []
    return fits.select(*keys, "last_date", F.posexplode("steps").alias("step", "delay")).select(
        *keys, F.date_add("last_date", F.col("step") + 1).alias("date"), "delay"
    )


def with_history(daily: DataFrame, steps: DataFrame) -> DataFrame:
    """History and forecast together, tagged by `type`."""
    history = daily.withColumnRenamed("value", "delay").withColumn("type", F.lit("Historical"))
    return history.unionByName(steps.withColumn("type", F.lit("Forecast")))


def reanchor(forecast: DataFrame, as_of: str, by: list[str] | None = None) -> DataFrame:
    """Shift dates so that history ends on `as_of` and the forecast starts the day after.

    History is contiguous, so every date of a series moves by the same number of days.
    """
    ends = forecast.where("type = 'Historical'").groupBy(*(by or [])).agg(F.max("date").alias("end"))
    joined = forecast.join(ends, by) if by else forecast.withColumn("end", ends.scalar())
    moved = F.date_add(F.lit(as_of).cast("date"), F.datediff("date", "end"))
    return joined.withColumn("date", moved).drop("end")
