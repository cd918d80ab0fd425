"""Staging layer: cleaned, typed, classified rows (views in the original).

Filters that touch stored columns (NOT NULL, distance range) reach the
Parquet scan as pushed filters; filters on defaulted columns run right after
the scan inside the same codegen stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import fixed

MONEY_COLUMNS = ("fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
                 "improvement_surcharge", "total_amount", "congestion_surcharge",
                 "airport_fee", "cbd_congestion_fee")

STG_TRIP_COLUMNS = (
    "trip_id", "vendor_id", "pickup_ts_local", "dropoff_ts_local", "pickup_hour", "pickup_date",
    "passenger_count", "trip_distance", "rate_code_id", "store_and_fwd_flag",
    "pickup_location_id", "dropoff_location_id", "payment_type", "payment_type_name",
    *MONEY_COLUMNS,
    "trip_duration_min", "fare_per_mile", "weekday_number", "is_weekend", "is_rush_hour",
    "ingestion_month", "source_file", "ingested_at",
)


def stg_taxi_trips(raw_trips: DataFrame) -> DataFrame:
    """G1-G10 projections and F1-F7 validity filters on raw trips."""
    pickup, dropoff = F.col("pickup_datetime"), F.col("dropoff_datetime")
    dist = F.col("trip_distance")
    # F1-F4 on stored columns: pushed to the scan.
    valid = raw_trips.filter(
        pickup.isNotNull() & dropoff.isNotNull() & (dropoff > pickup)
        & F.col("pickup_location_id").isNotNull() & F.col("dropoff_location_id").isNotNull()
        & (dist > 0) & (dist <= fixed.MAX_TRIP_DISTANCE))
    money = {m: F.coalesce(F.col(m), F.lit(0)).cast("decimal(12,2)") for m in MONEY_COLUMNS}
    passengers = F.coalesce(F.col("passenger_count"), F.lit(fixed.DEFAULT_PASSENGERS)).cast("decimal(10,2)")
    base = valid.select(
        F.col("record_hash").alias("trip_id"),
        "vendor_id",
        pickup.alias("pickup_ts_local"),
        dropoff.alias("dropoff_ts_local"),
        C.hour_floor(pickup).alias("pickup_hour"),
        pickup.cast("date").alias("pickup_date"),
        passengers.alias("passenger_count"),
        "trip_distance", "rate_code_id", "store_and_fwd_flag",
        "pickup_location_id", "dropoff_location_id", "payment_type",
        C.payment_type_name("payment_type").alias("payment_type_name"),
        *[c.alias(n) for n, c in money.items()],
        C.minutes_between(pickup, dropoff).alias("trip_duration_min"),
        (money["fare_amount"].cast("double") / F.nullif(dist.cast("double"), F.lit(0.0))).alias("fare_per_mile"),
        C.iso_weekday(pickup).alias("weekday_number"),
        C.is_weekend(pickup).alias("is_weekend"),
        C.is_rush_hour(pickup).alias("is_rush_hour"),
        "ingestion_month", "source_file", "ingested_at",
    )
    # F5-F7 on defaulted columns (a NULL fare survives as 0).
    fare, total, pax = F.col("fare_amount"), F.col("total_amount"), F.col("passenger_count")
    return base.filter(
        (fare >= 0) & (fare <= fixed.MAX_FARE_AMOUNT)
        & (total >= 0) & (total <= fixed.MAX_TOTAL_AMOUNT)
        & pax.between(fixed.MIN_PASSENGERS, fixed.MAX_PASSENGERS))


_WEATHER_TIEBREAK = ("source_file", "temperature_2m", "precipitation_mm", "rain_mm",
                     "snowfall_cm", "wind_speed_10m", "weathercode", "weather_record_id")


def latest_weather(raw_weather: DataFrame) -> DataFrame:
    """Newest reading per (borough, hour).

    `ORDER BY ingested_at DESC` plus a tie-break on the other columns, so the
    winner never depends on file order.  Rows without an hour are dropped
    before the window; they are dropped after it in the original as well and
    form a partition of their own, so the result is the same.  Spark plans
    a partial WindowGroupLimit before the shuffle, so each task already keeps
    one row per key.
    """
    w = Window.partitionBy("borough", "weather_ts_hour").orderBy(
        F.col("ingested_at").desc_nulls_last(),
        *[F.col(c).asc_nulls_first() for c in _WEATHER_TIEBREAK])
    return (raw_weather.filter(F.col("weather_ts_hour").isNotNull())
                       .withColumn("_rn", F.row_number().over(w))
                       .filter(F.col("_rn") == 1).drop("_rn"))


STG_WEATHER_COLUMNS = (
    "weather_record_id", "borough", "weather_ts_hour", "temperature_2m", "precipitation_mm",
    "rain_mm", "snowfall_cm", "wind_speed_10m", "weathercode", "is_rain", "is_snow",
    "weather_severity", "source_month", "source_file", "ingested_at",
)


def stg_weather_hourly(raw_weather: DataFrame) -> DataFrame:
    """G11-G13 on the deduplicated readings, then the F8 range filter."""
    d = latest_weather(raw_weather)
    temp, wind = F.col("temperature_2m"), F.col("wind_speed_10m")
    d = d.filter(temp.between(fixed.MIN_TEMPERATURE, fixed.MAX_TEMPERATURE)
                 & wind.between(fixed.MIN_WIND_SPEED, fixed.MAX_WIND_SPEED))
    return d.select(
        "weather_record_id", "borough", "weather_ts_hour", "temperature_2m",
        C.nonneg_or_zero("precipitation_mm", "decimal(8,2)").alias("precipitation_mm"),
        C.nonneg_or_zero("rain_mm", "decimal(8,2)").alias("rain_mm"),
        C.nonneg_or_zero("snowfall_cm", "decimal(8,2)").alias("snowfall_cm"),
        C.nonneg_or_zero("wind_speed_10m", "decimal(8,2)").alias("wind_speed_10m"),
        "weathercode",
        C.positive_flag("rain_mm").alias("is_rain"),
        C.positive_flag("snowfall_cm").alias("is_snow"),
        C.weather_severity("precipitation_mm", "snowfall_cm").alias("weather_severity"),
        "source_month", "source_file", "ingested_at",
    )


def stg_locations(raw_zones: DataFrame) -> DataFrame:
    """Zone lookup with the NYC-borough flag (NULL borough -> FALSE)."""
    return raw_zones.select(
        "location_id", "borough", "zone", "service_zone",
        F.coalesce(F.col("borough").isin(*fixed.NYC_BOROUGHS), F.lit(False)).alias("is_nyc_borough"),
    )
