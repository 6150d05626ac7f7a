"""The star the analytics read: one incident fact table and one day dimension.

Weather, events and lag features depend only on the day, so they are computed once per day and
joined to the facts with a single join. Nothing denormalised is stored: at scale the fact table is
written once, and every question scans only the fact columns it names.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame

from headway.operators import clean, encode, features, series
from headway.plans.staging import small_splits, stage


class Warehouse:
    """Stages are built on first use and reused afterwards."""

    def __init__(
        self,
        trips_raw: Callable[[], DataFrame],
        weather_raw: Callable[[], DataFrame],
        events_raw: Callable[[], DataFrame],
    ) -> None:
        self._trips_raw = trips_raw
        self._weather_raw = weather_raw
        self._events_raw = events_raw

    @cached_property
    def trips_raw(self) -> DataFrame:
        """Landed incident records. Landing them keeps the median pass a two-column scan."""
        return stage(self._trips_raw(), "trips_raw")

    @cached_property
    def weather_raw(self) -> DataFrame:
        return stage(self._weather_raw(), "weather_raw")

    @cached_property
    def events_raw(self) -> DataFrame:
        return stage(self._events_raw(), "events_raw")

    @cached_property
    def facts(self) -> DataFrame:
        """The fact table, partitioned by `date_month` so date filters prune files."""
        raw = self.trips_raw
        with small_splits(raw.sparkSession):  # each task sorts its records before the shuffle
            return stage(clean.clean_trips(raw), "trips", month_of="date")

    @property
    def trips(self) -> DataFrame:
        return self.facts.drop("date_month")

    @cached_property
    def weather(self) -> DataFrame:
        days = clean.clean_weather(clean.classify_weather(self.weather_raw))
        return stage(days, "weather")

    @cached_property
    def event_days(self) -> DataFrame:
        events = clean.largest_per_day(self.events_raw)
        with small_splits(events.sparkSession):
            return stage(clean.roll_up_events(clean.clean_events(events)), "event_days")

    @cached_property
    def daily(self) -> DataFrame:
        """Delay per observed day."""
        return stage(features.daily_delay(self.trips), "daily")

    @cached_property
    def days(self) -> DataFrame:
        """The day dimension: every observed day with all its day-level features."""
        lags = features.fill_lags(
            features.daily_lags(self.daily), features.mean_over_records(self.daily)
        ).drop("delay_sum", "delay_records", "daily_avg_delay")
        known = (
            clean.merge_days(lags, self.weather, self.event_days)
            .transform(features.add_date_features)
            .transform(features.add_weather_features)
            .transform(features.add_event_features)
        )
        return stage(known, "days")

    @cached_property
    def borough_days(self) -> DataFrame:
        """Gap-filled daily mean delay per borough."""
        return stage(series.daily_series(self.trips, ["borough"]), "borough_days")

    @cached_property
    def network_days(self) -> DataFrame:
        """Gap-filled daily mean delay of the whole network."""
        return stage(series.daily_series(self.trips), "network_days")

    @cached_property
    def encoded(self) -> DataFrame:
        """Encoded features, staged because every model reads them many times."""
        return stage(encode.encode(self.featured), "encoded")

    @property
    def regression_matrix(self) -> DataFrame:
        return encode.model_matrix(self.encoded, "regression")

    @property
    def classification_matrix(self) -> DataFrame:
        return encode.model_matrix(self.encoded, "classification")

    @property
    def merged(self) -> DataFrame:
        """Trips with weather and events: two map-side joins, no shuffle of the facts."""
        return clean.merge_days(self.trips, self.weather, self.event_days)

    @property
    def featured(self) -> DataFrame:
        """Trips with every feature: one map-side join, no shuffle of the facts."""
        return self.featured_by_month.drop("date_month")

    @property
    def featured_by_month(self) -> DataFrame:
        return self.facts.join(self.days, "date", "left").transform(features.add_hour_features)
