"""What the writes of the month job cost: compiled code, hashes that are made, passes over the feed."""

import re
from datetime import datetime

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from stormcab import schemas
from stormcab.operators import normalize, quality, staging
from stormcab.plans import job, key_filters, marts
from stormcab.plans.warehouse import RawTables, Warehouse
from stormcab.sources import commits, landed, writers

RUN = "2025-02-01 06:00:00"
MONTH = "2025-01"
COLUMNS = ("VendorID int, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, trip_distance double, fare_amount double, "
           "total_amount double, PULocationID int, DOLocationID int, payment_type bigint, passenger_count double")
JIT_BYTES = 8000  # a longer method stays in the interpreter


def landed_rows(spark):
    a, b = datetime(2025, 1, 6, 8, 0), datetime(2025, 1, 6, 8, 20)
    return spark.createDataFrame([(1, a, b, 2.5, 10.0, 12.0, 1, 2, 1, 1.0), (2, a, b, 2.5, 11.0, 13.0, 2, 1, 2, 2.0), (1, a, b, 3.5, 10.0, 12.0, 1, 1, 1, None),
                                  (1, a, None, 2.5, 10.0, 12.0, 1, 2, 1, 1.0), (None,) * 10, (1, b, a, 2.5, 10.0, 12.0, 1, None, 1, 1.0)], COLUMNS)


def raw_tables(spark):
    trips = normalize.raw_trips(landed_rows(spark), MONTH, "f", RUN)
    weather = spark.createDataFrame([("w", "Queens", datetime(2025, 1, 6, 8), *[1.0] * 5, 3)],
                                    "weather_record_id string, borough string, weather_ts_hour timestamp_ntz, temperature_2m double, precipitation_mm double, "
                                    "rain_mm double, snowfall_cm double, wind_speed_10m double, weathercode int")
    weather = weather.withColumns({c: F.col(c).cast(schemas.WEATHER_MEASURE) for c in weather.columns[3:8]})
    weather = weather.withColumns({"source_month": F.lit("2025-01-01").cast("date"), "source_file": F.lit("f"), "ingested_at": normalize.run_timestamp(RUN)})
    zones = spark.createDataFrame([(1, "Queens", "A", "Z", "f"), (2, "Bronx", "B", "Z", "f")], "location_id int, borough string, zone string, service_zone string, source_file string")
    return RawTables(trips, weather, zones.withColumn("ingested_at", normalize.run_timestamp(RUN)))


def longest_method(df) -> int:
    spark = df.sparkSession
    own = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = spark._jvm.org.apache.spark.sql.execution.debug.package.codegenString(df._jdf.queryExecution().executedPlan())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", own)
    return max(int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text))


def test_counted_trip_fact_is_compiled(spark, scratch):
    raw = raw_tables(spark)
    root = f"{scratch}/tables"
    raw = job.raw_tables_of(spark, job.load_month(spark, raw, root, MONTH))
    wh = Warehouse(raw)
    _, loc, weather = job._write_dimensions(spark, wh, root)
    fct = marts.fct_taxi_trips(wh.stg_taxi_trips, loc, weather).withColumn(job.PICKUP_MONTH, F.trunc("pickup_date", "MM"))
    metrics = job._month_metrics("fct_taxi_trips", MONTH)
    assert longest_method(fct.observe(Observation(), *[c.alias(k) for k, c in metrics.items()])) < JIT_BYTES
    new = commits.write(fct, root, "fct_taxi_trips", job.PICKUP_MONTH, metrics)
    assert new.facts == {"2025-01-01": {"rows": 3, "null_trip_id": 0, "known_weather": 2, "out_of_range": 0, "month_rows": 3, "month_known": 2}}


def test_counted_month_of_the_trip_fact_is_compiled_and_checked(spark, scratch):
    raw = raw_tables(spark)
    raw = job.raw_tables_of(spark, job.load_month(spark, raw, scratch, MONTH))
    wh = Warehouse(raw)
    _, loc, weather = job._write_dimensions(spark, wh, scratch)
    first = F.lit("2025-01-01").cast("date")
    here = (F.col("pickup_datetime") >= first.cast("timestamp_ntz")) & (F.col("pickup_datetime") < F.add_months(first, 1).cast("timestamp_ntz"))
    fct = marts.fct_taxi_trips(staging.stg_taxi_trips(raw.trips.filter(here)), loc, weather).withColumn(job.PICKUP_MONTH, F.trunc("pickup_date", "MM"))
    rows = commits.counted(fct, Observation(), quality.write_metrics("fct_taxi_trips"), lambda df: writers.only_month(df, job.PICKUP_MONTH, MONTH))
    assert longest_method(rows) < JIT_BYTES
    assert rows.count() == 3
    with pytest.raises(Exception, match="a row of pickup_month 2025-01-01 in the load of 2025-02"):
        commits.write(fct, scratch, "x", job.PICKUP_MONTH, quality.write_metrics("fct_taxi_trips"), lambda df: writers.only_month(df, job.PICKUP_MONTH, "2025-02"))


def test_conditions_that_are_null_are_not_counted(spark):
    df = spark.createDataFrame([(1, 1.0), (None, -1.0), (2, None)], "trip_id int, fare_amount double")
    observed = Observation()
    df.observe(observed, quality.rows_where(F.col("trip_id").isNull()).alias("a"), quality.rows_where(F.col("fare_amount") < 0).alias("b"),
               quality.rows_where(F.col("fare_amount") > 5).alias("c")).collect()
    assert observed.get == {"a": 1, "b": 1, "c": 0}


def test_repeated_keys_are_found_without_md5(spark):
    t = datetime(2025, 1, 6, 8, 0, 0)
    rows = [(1, t, t, None, 10.0, 12.0, 1, 2, 1, 1.0), (1, t, t, None, 10.0, 12.0, 2, 1, 1, 1.0), (1, t, None, 1.0, 10.0, None, 2, 1, 1, 1.0),
            (1, None, t, 1.0, None, 10.0, 2, 1, 1, 1.0), (1, t, None, 1.0, None, 10.0, 2, 1, 1, 1.0)]  # no two alike
    df = spark.createDataFrame(rows, COLUMNS)
    keys = normalize.repeated_hash_keys(df, MONTH, "f")
    assert "md5" not in keys._jdf.queryExecution().optimizedPlan().toString()
    assert keys.count() == 0
    other = spark.createDataFrame([(2, t.replace(microsecond=7), t, None, 10.001, 12.0, 1, 2, 1, 1.0)], COLUMNS)  # the same hash: neither fraction nor third decimal is in it
    both = normalize.raw_trips(df.unionByName(other), MONTH, "f", RUN)
    assert normalize.repeated_hash_keys(df.unionByName(other), MONTH, "f").count() == 1 and both.count() == len(rows)


def test_key_filter_is_that_of_the_rows_of_the_load(spark, scratch):
    raw = raw_tables(spark)
    state = job.load_month(spark, raw, scratch, MONTH)
    found = state.read(spark, key_filters.TABLE)
    assert sorted(found.collect()) == sorted(key_filters.key_filter(raw.trips).select(found.columns).collect())
    state = job.load_month(spark, RawTables(raw.trips.limit(0), raw.weather, raw.zones), scratch, MONTH)  # a month without trips has no filter
    assert state.read(spark, key_filters.TABLE).count() == 0


def test_trips_of_several_months_land_in_one_pass(spark, scratch):
    months = ("2025-01", "2025-02", "2025-03")
    rows = landed_rows(spark).unionByName(landed_rows(spark))
    rows = rows.withColumn("file_month", F.when(F.col("VendorID") == 1, months[0]).when(F.col("VendorID") == 2, months[2]))
    writers.land_trip_months(rows.unionByName(rows.withColumn("file_month", F.lit("2025-04"))), f"{scratch}/once", "file_month", months)
    for month in months:
        writers.land_trip_month(rows.where(F.col("file_month") == month).drop("file_month"), f"{scratch}/each", month)
        once, each = (landed.read_trip_month(spark, f"{scratch}/{x}", month).drop("source_file") for x in ("once", "each"))
        assert once.schema == each.schema and sorted(map(repr, once.collect())) == sorted(map(repr, each.collect()))
    assert not commits.children(spark, f"{scratch}/once/taxi/yellow/year=*/month=04")


def test_keys_are_made_of_trips_whose_day_other_months_have(spark, scratch):
    raw = raw_tables(spark)
    late = raw.trips.where("trip_distance = 3.5 or pickup_datetime is null").withColumn("ingestion_month", F.lit("2025-02-01").cast("date"))
    job.load_month(spark, raw, scratch, MONTH)
    state = commits.latest(spark, scratch)
    staged = late.unionByName(late.withColumns({c: F.col(c) + F.expr("interval 40 days") for c in ("pickup_datetime", "pickup_date")}).where("pickup_date is not null"))
    staged.drop("record_hash").write.parquet(f"{scratch}/staged")
    new = normalize.with_record_hash(spark.read.parquet(f"{scratch}/staged"))
    filters = state.read(spark, key_filters.TABLE)
    found = key_filters.candidates(new, filters, "2025-02")
    text = found._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("md5(") == 1 and "LeftSemi" in text
    assert sorted(r.record_hash for r in found.collect()) == sorted(r.record_hash for r in late.collect())
    again = key_filters.repeated_keys(new, state.read(spark, job.RAW_TABLES["trips"]), filters, "2025-02")
    assert sorted(r.record_hash for r in again.collect()) == sorted(r.record_hash for r in late.collect())
