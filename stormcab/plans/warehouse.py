"""The model graph: raw tables -> staging -> dimensions -> facts.

`Warehouse` wires the model functions together the way the original
project's `ref()` calls do; every property is a lazy DataFrame, so asking for
one mart plans exactly the models it depends on.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame

from ..operators import staging
from . import marts


@dataclass(frozen=True)
class RawTables:
    trips: DataFrame      # raw.taxi_trips_yellow
    weather: DataFrame    # raw.weather_hourly
    zones: DataFrame      # raw.taxi_zone_lookup


class Warehouse:
    """Lazy model graph over a set of raw tables."""

    def __init__(self, raw: RawTables):
        self.raw = raw

    # staging (views)
    @cached_property
    def stg_taxi_trips(self) -> DataFrame:
        return staging.stg_taxi_trips(self.raw.trips)

    @cached_property
    def stg_weather_hourly(self) -> DataFrame:
        return staging.stg_weather_hourly(self.raw.weather)

    @cached_property
    def stg_locations(self) -> DataFrame:
        return staging.stg_locations(self.raw.zones)

    # dimensions
    @cached_property
    def dim_location(self) -> DataFrame:
        return marts.dim_location(self.stg_locations)

    @cached_property
    def dim_weather(self) -> DataFrame:
        return marts.dim_weather(self.stg_weather_hourly)

    @cached_property
    def dim_date_time(self) -> DataFrame:
        return marts.dim_date_time(self.stg_taxi_trips, self.stg_weather_hourly)

    # facts
    @cached_property
    def fct_taxi_trips(self) -> DataFrame:
        return marts.fct_taxi_trips(self.stg_taxi_trips, self.dim_location, self.stg_weather_hourly)

    @cached_property
    def trip_sums(self) -> DataFrame:
        return marts.trip_sums(self.fct_taxi_trips)

    @cached_property
    def fct_hourly_demand(self) -> DataFrame:
        return marts.fct_hourly_demand(self.trip_sums)

    @cached_property
    def fct_fare_revenue(self) -> DataFrame:
        return marts.fct_fare_revenue(self.trip_sums)

    @cached_property
    def fct_weather_impact(self) -> DataFrame:
        return marts.fct_weather_impact(self.trip_sums)

    RAW_NAMES = {"raw_taxi_trips_yellow": "trips", "raw_weather_hourly": "weather",
                 "raw_taxi_zone_lookup": "zones"}

    def model(self, name: str) -> DataFrame:
        """Any table of the graph by its warehouse name (raw tables included)."""
        if name in self.RAW_NAMES:
            return getattr(self.raw, self.RAW_NAMES[name])
        return getattr(self, name)

    MODELS = ("stg_taxi_trips", "stg_weather_hourly", "stg_locations", "dim_location", "dim_weather",
              "dim_date_time", "fct_taxi_trips", "fct_hourly_demand", "fct_fare_revenue",
              "fct_weather_impact")
