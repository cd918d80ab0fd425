"""The single-file prototype's star schema and weather mart (reference only).

Semantics follow the prototype, with two re-aims for a distributed engine:

* the prototype numbers trips by row position after cleaning; a global
  position needs every row in one task, so `trip_id` is the MD5 of the whole
  (deduplicated, hence unique) row in one canonical text form;
* its per-trip "dimensions" are one row for each trip under that same key, so the
  fact's five per-trip ids are the trip_id, by definition and without self-joins;
* its location dimensions get their natural id as key, where it had a running
  number: a number for each distinct value needs all values in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import columns as C
from ..operators.staging import latest_weather


def _canonical_text(df: DataFrame) -> Column:
    """One text form per row: numbers via decimal(20,4), timestamps as text."""
    parts = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType)):
            parts.append(C.ts_text(c))
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            parts.append(c.cast("decimal(20,4)").cast("string"))
        else:
            parts.append(c.cast("string"))
    return F.concat_ws("|", *[F.coalesce(p, F.lit("null")) for p in parts])


def whole_rows_once(rows: DataFrame) -> DataFrame:
    """`dropDuplicates` over all columns for rows that are nearly all different.

    Hash aggregation would keep each row in a map before the shuffle, where next to none meets its copy, and spill it.  Here
    rows are shuffled and sorted by a hash of theirs first, which tells nearly all of them apart; a sort spills only itself."""
    d = _zeros_alike(rows)
    return _once(d.withColumn("_hash", F.xxhash64(*[F.col(f"`{c}`") for c in d.columns])).repartition("_hash"), "_hash", d.columns).drop("_hash")


def _zeros_alike(rows: DataFrame) -> DataFrame:
    """-0.0 as 0.0, as in grouping."""
    return rows.withColumns({f.name: (F.col(f"`{f.name}`") + F.lit(0.0)).cast(f.dataType) for f in rows.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))})


def _once(dealt: DataFrame, by: str, columns: list[str]) -> DataFrame:
    """One of the rows that agree in `columns`, and so in `by`, by which they are dealt out."""
    copies = Window.partitionBy(by, *[F.col(f"`{c}`") for c in columns]).orderBy(by)
    return dealt.withColumn("_copy", F.row_number().over(copies)).where("_copy = 1").drop("_copy")


def _valid_trips(landed: DataFrame) -> DataFrame:
    """Drop NULL times, filter."""
    typed = landed.withColumns({
        "tpep_pickup_datetime": F.col("tpep_pickup_datetime").try_cast("timestamp_ntz"),
        "tpep_dropoff_datetime": F.col("tpep_dropoff_datetime").try_cast("timestamp_ntz"),
    })
    d = typed.dropna(subset=["tpep_pickup_datetime", "tpep_dropoff_datetime"])
    # a filter on whole rows keeps or drops all copies of one, so it may come first; Spark moves it into the scan, where a later
    # dropoff is cheap to test and the duration itself is not
    return d.filter((F.col("tpep_dropoff_datetime") > F.col("tpep_pickup_datetime")) & (F.col("fare_amount") >= 0) & (F.col("trip_distance") > 0))


def _duration() -> Column:
    return C.minutes_between("tpep_pickup_datetime", "tpep_dropoff_datetime")


def clean_trips(landed: DataFrame) -> DataFrame:
    """Whole-row dedup, drop NULL times, duration, filter, trip_id."""
    d = whole_rows_once(_valid_trips(landed))
    return d.withColumn("trip_duration_min", _duration()).select(F.md5(_canonical_text(d)).alias("trip_id"), "*")


def clean_trips_by_key(landed: DataFrame, parts: int) -> DataFrame:
    """The rows of `clean_trips`, dealt out in `parts` by the trip_id, which is its 16 bytes here.

    Equal rows have equal ids, so the one shuffle serves the deduplication and what is made of the trips by key."""
    d = _zeros_alike(_valid_trips(landed))
    dealt = d.withColumn("trip_id", F.unhex(F.md5(_canonical_text(d)))).repartition(parts, "trip_id")
    return _once(dealt, "trip_id", d.columns).withColumn("trip_duration_min", _duration()).select("trip_id", *d.columns, "trip_duration_min")


def datetime_dim(trips: DataFrame) -> DataFrame:
    """Calendar parts of pickup and dropoff, one row per trip."""
    p, d = F.col("tpep_pickup_datetime"), F.col("tpep_dropoff_datetime")
    return trips.select(
        F.col("trip_id").alias("datetime_id"), p.alias("tpep_pickup_datetime"),
        F.hour(p).alias("pick_hour"), F.dayofmonth(p).alias("pick_day"), F.month(p).alias("pick_month"),
        F.year(p).alias("pick_year"), F.weekday(p).alias("pick_weekday"),
        d.alias("tpep_dropoff_datetime"),
        F.hour(d).alias("drop_hour"), F.dayofmonth(d).alias("drop_day"), F.month(d).alias("drop_month"),
        F.year(d).alias("drop_year"), F.weekday(d).alias("drop_weekday"))


def rate_code_dim(trips: DataFrame) -> DataFrame:
    """Rate code with its name, one row per trip."""
    return trips.select(F.col("trip_id").alias("rate_code_id"), "RatecodeID",
                        C.rate_code_name("RatecodeID").alias("rate_code_name"))


def payment_type_dim(trips: DataFrame) -> DataFrame:
    """Payment type with its name, one row per trip."""
    return trips.select(F.col("trip_id").alias("payment_type_id"), "payment_type",
                        C.payment_type_name("payment_type").alias("payment_type_name"))


def passenger_count_dim(trips: DataFrame) -> DataFrame:
    """Passenger count, one row per trip."""
    return trips.select(F.col("trip_id").alias("passenger_count_id"), "passenger_count")


def trip_distance_dim(trips: DataFrame) -> DataFrame:
    """Trip distance, one row per trip."""
    return trips.select(F.col("trip_id").alias("trip_distance_id"), "trip_distance")


def location_dim(trips: DataFrame, natural: str, key: str) -> DataFrame:
    """The distinct location ids, keyed by themselves."""
    return trips.select(F.col(natural).alias(key), natural).distinct()


PROTO_FACT_COLUMNS = ("trip_id", "VendorID", "datetime_id", "passenger_count_id", "trip_distance_id",
                      "rate_code_id", "store_and_fwd_flag", "pickup_location_id", "dropoff_location_id",
                      "payment_type_id", "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
                      "improvement_surcharge", "total_amount")


def star_fact(trips: DataFrame) -> DataFrame:
    """The fact table over cleaned trips.

    Every foreign key is a column of the trip itself (see the module text), so
    the prototype's inner joins can neither drop nor repeat a row and are left
    out, but for trips without a location, which those joins dropped."""
    per_trip = [F.col("trip_id").alias(f"{d}_id") for d in ("datetime", "passenger_count", "trip_distance", "rate_code", "payment_type")]
    return trips.dropna(subset=["PULocationID", "DOLocationID"]).select(
        "*", *per_trip, F.col("PULocationID").alias("pickup_location_id"), F.col("DOLocationID").alias("dropoff_location_id")).select(*PROTO_FACT_COLUMNS)


# dimension: its key, and the fact's column that is joined to it
PROTO_DIMENSIONS = {"datetime": "datetime_id", "passenger_count": "passenger_count_id", "trip_distance": "trip_distance_id", "rate_code": "rate_code_id",
                    "pickup_location": "pickup_location_id", "dropoff_location": "dropoff_location_id", "payment_type": "payment_type_id"}


def dimensions(trips: DataFrame) -> dict[str, DataFrame]:
    """The seven dimensions."""
    return {"datetime": datetime_dim(trips), "passenger_count": passenger_count_dim(trips), "trip_distance": trip_distance_dim(trips),
            "rate_code": rate_code_dim(trips), "payment_type": payment_type_dim(trips),
            "pickup_location": location_dim(trips, "PULocationID", "pickup_location_id"),
            "dropoff_location": location_dim(trips, "DOLocationID", "dropoff_location_id")}


def merged_fact(trips: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """N6/J8 as the seven inner joins, over dimensions that have been written.

    Gives the rows of `star_fact`; it is for dimensions that others may have changed.  The per-trip
    dimensions share the trip's key and come first, so the trips are shuffled once for all five, and not at all
    if all are bucketed by it; the locations are small."""
    fact, locations = trips, {"pickup_location": "PULocationID", "dropoff_location": "DOLocationID"}
    for name, key in sorted(PROTO_DIMENSIONS.items(), key=lambda d: d[0] in locations):
        own = locations.get(name, "trip_id")
        dim = dims[name].select(F.col(key).alias(f"_{key}"))
        fact = fact.join(dim, F.col(own) == F.col(f"_{key}")).withColumnRenamed(f"_{key}", key)
    return fact.select(*PROTO_FACT_COLUMNS)


def weather_frame(raw_weather: DataFrame) -> DataFrame:
    """One reading per borough-hour with rain/snow flags and severity (NULL -> clear)."""
    w = latest_weather(raw_weather)
    return w.select(
        "borough", "weather_ts_hour", "temperature_2m", "precipitation_mm", "rain_mm", "snowfall_cm",
        F.col("wind_speed_10m").alias("wind_speed"), "weathercode",
        C.positive_flag("rain_mm").alias("is_rain"), C.positive_flag("snowfall_cm").alias("is_snow"),
        C.weather_severity("precipitation_mm", "snowfall_cm").alias("weather_severity"))


def pickup_date_bounds(trips: DataFrame) -> DataFrame:
    """First and last pickup date (one row; partial min/max per task)."""
    d = F.col("tpep_pickup_datetime").cast("date")
    return trips.agg(F.min(d).alias("start_date"), F.max(d).alias("end_date"))


def trip_weather(trips: DataFrame, landed_zones: DataFrame, weather: DataFrame) -> DataFrame:
    """Trips with pickup zone (left) and pickup-hour weather (left).

    The prototype asks for weather between the first and last pickup date;
    hours outside of them match no trip in the left join, so no bound is needed here.
    """
    z = landed_zones.select(F.col("LocationID"), F.col("Borough").alias("borough"), F.col("Zone").alias("pickup_zone"))
    w = weather
    t = trips.join(z, trips.PULocationID == z.LocationID, "left")
    t = t.withColumn("pickup_hour", C.hour_floor("tpep_pickup_datetime"))
    t = t.join(w, (t.pickup_hour == w.weather_ts_hour) & (t.borough == w.borough), "left").drop(w.borough)
    return t.select(
        "trip_id", "tpep_pickup_datetime", "pickup_hour", "borough", "pickup_zone", "trip_distance",
        "fare_amount", "total_amount",
        (F.col("fare_amount") / F.col("trip_distance")).alias("fare_per_mile"),
        "trip_duration_min", "temperature_2m", "precipitation_mm", "is_rain", "is_snow", "weather_severity")


def weather_hourly_mart(tw: DataFrame) -> DataFrame:
    """Per (hour, borough, severity), NULL groups kept, NULLs sorted last."""
    g = tw.groupBy("pickup_hour", "borough", "weather_severity").agg(
        F.count("trip_id").alias("trip_count"),
        F.avg("fare_amount").alias("avg_fare"),
        F.avg("total_amount").alias("avg_total_amount"),
        F.avg("trip_duration_min").alias("avg_duration_min"),
        F.avg("trip_distance").alias("avg_distance"),
        F.avg("fare_per_mile").alias("avg_fare_per_mile"),
        C.mean_exact("precipitation_mm").alias("avg_precipitation"),
        C.mean_exact("temperature_2m").alias("avg_temp"))
    return g.orderBy(*[F.col(c).asc_nulls_last() for c in ("pickup_hour", "borough", "weather_severity")])
