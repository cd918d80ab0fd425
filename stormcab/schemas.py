"""Declared schemas of the raw warehouse tables and the landed weather payload.

Column order follows the warehouse DDL; Spark selects by name, so the order
only matters for readability and for CSV export.
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)
DISTANCE = T.DecimalType(12, 3)
PASSENGERS = T.DecimalType(10, 2)
WEATHER_MEASURE = T.DecimalType(8, 2)
NTZ = T.TimestampNTZType()


def _schema(fields: list[tuple[str, T.DataType, bool]]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


RAW_ZONE = _schema([
    ("location_id", T.IntegerType(), False),
    ("borough", T.StringType(), False),
    ("zone", T.StringType(), False),
    ("service_zone", T.StringType(), True),
    ("source_file", T.StringType(), False),
    ("ingested_at", NTZ, False),
])

RAW_TRIPS = _schema([
    ("record_hash", T.StringType(), False),
    ("vendor_id", T.IntegerType(), True),
    ("pickup_datetime", NTZ, True),
    ("dropoff_datetime", NTZ, True),
    ("passenger_count", PASSENGERS, True),
    ("trip_distance", DISTANCE, True),
    ("rate_code_id", T.IntegerType(), True),
    ("store_and_fwd_flag", T.StringType(), True),
    ("pickup_location_id", T.IntegerType(), True),
    ("dropoff_location_id", T.IntegerType(), True),
    ("payment_type", T.IntegerType(), True),
    ("fare_amount", MONEY, True),
    ("extra", MONEY, True),
    ("mta_tax", MONEY, True),
    ("tip_amount", MONEY, True),
    ("tolls_amount", MONEY, True),
    ("improvement_surcharge", MONEY, True),
    ("total_amount", MONEY, True),
    ("congestion_surcharge", MONEY, True),
    ("airport_fee", MONEY, True),
    ("cbd_congestion_fee", MONEY, True),
    ("pickup_hour", NTZ, True),
    ("pickup_date", T.DateType(), True),
    ("ingestion_month", T.DateType(), False),
    ("source_file", T.StringType(), False),
    ("ingested_at", NTZ, False),
])

RAW_WEATHER = _schema([
    ("weather_record_id", T.StringType(), False),
    ("borough", T.StringType(), False),
    ("weather_ts_hour", NTZ, False),
    ("temperature_2m", WEATHER_MEASURE, True),
    ("precipitation_mm", WEATHER_MEASURE, True),
    ("rain_mm", WEATHER_MEASURE, True),
    ("snowfall_cm", WEATHER_MEASURE, True),
    ("wind_speed_10m", WEATHER_MEASURE, True),
    ("weathercode", T.IntegerType(), True),
    ("source_month", T.DateType(), False),
    ("source_file", T.StringType(), False),
    ("ingested_at", NTZ, False),
])

# Trip columns that are numbers in the warehouse, with their declared type.
TRIP_NUMERIC_TYPES: dict[str, T.DataType] = {
    f.name: f.dataType
    for f in RAW_TRIPS.fields
    if f.name in (
        "vendor_id", "passenger_count", "trip_distance", "rate_code_id",
        "pickup_location_id", "dropoff_location_id", "payment_type",
        "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
        "improvement_surcharge", "total_amount", "congestion_surcharge",
        "airport_fee", "cbd_congestion_fee",
    )
}

# Landed weather document: one per borough and month, hourly values as
# parallel arrays.  Declared so the JSON reader never infers.
WEATHER_PAYLOAD = T.StructType([
    T.StructField("requested_borough", T.StringType()),
    T.StructField("requested_month", T.StringType()),
    T.StructField("hourly", T.StructType([
        T.StructField("time", T.ArrayType(T.StringType())),
        T.StructField("temperature_2m", T.ArrayType(T.DoubleType())),
        T.StructField("precipitation", T.ArrayType(T.DoubleType())),
        T.StructField("rain", T.ArrayType(T.DoubleType())),
        T.StructField("snowfall", T.ArrayType(T.DoubleType())),
        T.StructField("windspeed_10m", T.ArrayType(T.DoubleType())),
        T.StructField("weathercode", T.ArrayType(T.IntegerType())),
    ])),
])

# Zone lookup CSV as landed (header row).
ZONE_CSV = _schema([
    ("LocationID", T.IntegerType(), True),
    ("Borough", T.StringType(), True),
    ("Zone", T.StringType(), True),
    ("service_zone", T.StringType(), True),
])
