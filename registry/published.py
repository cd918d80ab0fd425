"""Marts built once for each dataset, as a monthly run leaves them, for the queries that read built tables.

The analysis SQL, the dashboard and the declared tests of the original read tables that a build left
behind.  `Published` writes a table the first time it is asked for, with what it depends on, under
`spark.checkpoint.dir` in a folder named by the fingerprint of the given files, and reads it from then on.
The folder goes when the application ends.
"""

from __future__ import annotations

import atexit
import contextlib
import hashlib
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stormcab.operators import staging
from stormcab.plans import job, marts
from stormcab.plans.warehouse import RawTables, Warehouse
from stormcab.sources import commits

GIVEN = ("lineitem", "orders", "customer", "supplier", "nation", "events")
PARENTS = {
    "dim_location": ("raw_taxi_zone_lookup",),
    "stg_weather_hourly": ("raw_weather_hourly",),
    "dim_weather": ("stg_weather_hourly",),
    "dim_date_time": ("raw_taxi_trips_yellow", "stg_weather_hourly"),
    "fct_taxi_trips": ("raw_taxi_trips_yellow", "dim_location", "stg_weather_hourly"),
    job.TRIP_SUMS: ("fct_taxi_trips",),
    **{name: (job.TRIP_SUMS,) for name in job.AGGREGATE_FACTS},
}
PARTITION = {"raw_taxi_trips_yellow": "ingestion_month", "raw_weather_hourly": "source_month",
             **{name: job.PICKUP_MONTH for name in ("fct_taxi_trips", job.TRIP_SUMS, *job.AGGREGATE_FACTS)}}
_lock = threading.RLock()


def removed_at_exit(spark: SparkSession, path: str) -> str:
    """`path`, a folder that goes when the application ends."""
    fs, p = commits.filesystem(spark, path)

    def remove() -> None:
        with contextlib.suppress(Exception):  # the JVM may be gone before
            fs.delete(p, True)

    atexit.register(remove)
    return path


def fingerprint(spark: SparkSession, sf_dir: str) -> str:
    """Names, sizes and times of the given files."""
    found = []
    for name in GIVEN:
        fs, p = commits.filesystem(spark, f"{sf_dir}/{name}.parquet")
        files = fs.listFiles(p, True)
        while files.hasNext():
            f = files.next()
            found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return hashlib.sha256(repr(sorted(found)).encode()).hexdigest()[:24]


class Published:
    """Tables of one dataset by name, also as attributes; written when first asked for."""

    def __init__(self, spark: SparkSession, root: str, raw: Callable[[], RawTables]):
        self.spark, self.root, self.given = spark, root, raw  # the feed is planned only if a raw table has to be written

    def _plan(self, name: str) -> DataFrame:
        if name in Warehouse.RAW_NAMES:
            return getattr(self.given(), Warehouse.RAW_NAMES[name])
        if name == "dim_location":
            return marts.dim_location(staging.stg_locations(self.model("raw_taxi_zone_lookup")))
        if name == "stg_weather_hourly":
            return staging.stg_weather_hourly(self.model("raw_weather_hourly"))
        if name == "dim_weather":
            return marts.dim_weather(self.model("stg_weather_hourly"))
        if name == "dim_date_time":
            return marts.dim_date_time(self.model("stg_taxi_trips"), self.model("stg_weather_hourly"))
        if name == "fct_taxi_trips":
            fct = marts.fct_taxi_trips(self.model("stg_taxi_trips"), self.model("dim_location"), self.model("stg_weather_hourly"))
            return fct.withColumn(job.PICKUP_MONTH, F.trunc("pickup_date", "MM"))
        if name == job.TRIP_SUMS:
            return job.by_month(marts.trip_sums(self.model("fct_taxi_trips")))
        return job.by_month(getattr(marts, name)(self.model(job.TRIP_SUMS)))

    def model(self, name: str) -> DataFrame:
        """A table; staging of trips and zones are views over the raw tables, as in the original."""
        if name == "stg_taxi_trips":
            return staging.stg_taxi_trips(self.model("raw_taxi_trips_yellow"))
        if name == "stg_locations":
            return staging.stg_locations(self.model("raw_taxi_zone_lookup"))
        with _lock:
            state = commits.latest(self.spark, self.root)
            if not state.has(name):
                for parent in PARENTS.get(name, ()):
                    self.model(parent)
                written = commits.write(self._plan(name), self.root, name, PARTITION.get(name))
                state = commits.commit(self.spark, commits.latest(self.spark, self.root), {name: written}, name)
            return state.read(self.spark, name)

    def __getattr__(self, name: str) -> DataFrame:
        return self.model(name)
