"""Star-schema marts: three dimensions and four facts.

Each model is a function of the models it references, so Catalyst sees one
plan from the raw scans to the mart.  The trip fact joins zones and
borough-hour weather with plain joins: read from written tables their bytes
are known, so the planner broadcasts them under its own threshold and the trip
side is not shuffled; beyond it, AQE splits hot keys of the sort-merge join.  The three
aggregate facts are sums of one mergeable pre-aggregate (`trip_sums`), a hash aggregation with a map-side partial
step, so a hot zone or hour collapses to one row per task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import fixed


def dim_location(stg_locations: DataFrame) -> DataFrame:
    """Zone dimension (pass-through)."""
    return stg_locations.select("location_id", "borough", "zone", "service_zone", "is_nyc_borough")


DIM_WEATHER_COLUMNS = ("weather_key", "weathercode", "weather_severity", "is_rain", "is_snow", "weather_group")


def dim_weather(stg_weather: DataFrame) -> DataFrame:
    """Distinct weather conditions plus the `unknown` member."""
    spark = stg_weather.sparkSession
    conditions = (stg_weather
                  .select("weathercode", "weather_severity", "is_rain", "is_snow").distinct()
                  .select(C.weather_key("weathercode", "weather_severity", "is_rain", "is_snow").alias("weather_key"),
                          "weathercode", "weather_severity", "is_rain", "is_snow",
                          C.weather_group("is_rain", "is_snow", "weather_severity").alias("weather_group")))
    unknown = spark.range(1).select(
        F.lit(fixed.UNKNOWN_WEATHER).alias("weather_key"),
        F.lit(None).cast("int").alias("weathercode"),
        F.lit(fixed.UNKNOWN_WEATHER).alias("weather_severity"),
        F.lit(False).alias("is_rain"),
        F.lit(False).alias("is_snow"),
        F.lit(fixed.UNKNOWN_WEATHER).alias("weather_group"))
    return unknown.unionByName(conditions)


DIM_DATE_TIME_COLUMNS = ("date_hour_key", "date_key", "hour_ts", "calendar_date", "year_number",
                         "month_number", "month_name", "day_of_month", "hour_of_day",
                         "iso_weekday_number", "weekday_name", "is_weekend")


def hour_bounds(stg_trips: DataFrame, stg_weather: DataFrame) -> DataFrame:
    """A5 + U1: one row (min_hour, max_hour) over trip and weather hours.

    Each side is reduced to its own min/max first (partial aggregates on the
    executors), so the union carries two rows, not every hour.
    """
    t = stg_trips.agg(F.min("pickup_hour").alias("lo"), F.max("pickup_hour").alias("hi"))
    w = stg_weather.agg(F.min("weather_ts_hour").alias("lo"), F.max("weather_ts_hour").alias("hi"))
    return t.unionByName(w).agg(F.min("lo").alias("min_hour"), F.max("hi").alias("max_hour"))


def dim_date_time(stg_trips: DataFrame, stg_weather: DataFrame) -> DataFrame:
    """U4 + M10: hourly calendar from the first to the last hour seen.

    The spine is one row per day first, and each day expands to its 24
    hours; its size follows the time span (hours), never the trip volume.
    Empty inputs give no rows (sequence over NULL bounds is NULL).
    """
    b = hour_bounds(stg_trips, stg_weather)
    days = b.select(
        F.col("min_hour"), F.col("max_hour"),
        F.explode(F.sequence(F.col("min_hour").cast("date"), F.col("max_hour").cast("date"))).alias("day"))
    hours = days.select(
        F.col("min_hour"), F.col("max_hour"),
        F.explode(F.sequence(F.lit(0), F.lit(23))).alias("h"), "day")
    ts = F.make_timestamp_ntz(F.year("day"), F.month("day"), F.dayofmonth("day"), F.col("h"), F.lit(0), F.lit(0))
    spine = (hours.select(ts.alias("hour_ts"), "min_hour", "max_hour")
                  .filter((F.col("hour_ts") >= F.col("min_hour")) & (F.col("hour_ts") <= F.col("max_hour"))))
    h = F.col("hour_ts")
    d = h.cast("date")
    return spine.select(
        C.date_hour_key(h).alias("date_hour_key"),
        C.date_key(h).alias("date_key"),
        h.alias("hour_ts"),
        d.alias("calendar_date"),
        F.year(h).alias("year_number"),
        F.month(h).alias("month_number"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.dayofmonth(h).alias("day_of_month"),
        F.hour(h).alias("hour_of_day"),
        C.iso_weekday(h).alias("iso_weekday_number"),
        F.date_format(d, "E").alias("weekday_name"),
        C.is_weekend(h).alias("is_weekend"),
    )


FCT_TRIP_COLUMNS = (
    "trip_id", "date_hour_key", "date_key", "pickup_ts_local", "dropoff_ts_local", "pickup_hour",
    "pickup_date", "pickup_location_id", "dropoff_location_id", "pickup_borough", "pickup_zone",
    "dropoff_borough", "dropoff_zone", "vendor_id", "passenger_count", "rate_code_id", "payment_type",
    "payment_type_name", "store_and_fwd_flag", "trip_distance", "trip_duration_min", "fare_amount",
    "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge", "total_amount",
    "congestion_surcharge", "airport_fee", "cbd_congestion_fee", "fare_per_mile", "weekday_number",
    "is_weekend", "is_rush_hour", "weather_key", "temperature_2m", "precipitation_mm", "rain_mm",
    "snowfall_cm", "wind_speed_10m", "weathercode", "weather_severity", "is_rain", "is_snow",
    "ingestion_month", "source_file", "ingested_at",
)


def weather_for_join(stg_weather: DataFrame) -> DataFrame:
    return stg_weather.select(
        F.col("borough").alias("w_borough"),
        F.col("weather_ts_hour").alias("w_hour"),
        C.weather_key("weathercode", "weather_severity", "is_rain", "is_snow").alias("w_key"),
        "temperature_2m", "precipitation_mm", "rain_mm", "snowfall_cm", "wind_speed_10m",
        "weathercode", F.col("weather_severity").alias("w_severity"),
        F.col("is_rain").alias("w_rain"), F.col("is_snow").alias("w_snow"))


def fct_taxi_trips(stg_trips: DataFrame, dim_loc: DataFrame, stg_weather: DataFrame) -> DataFrame:
    """Trip fact with pickup/dropoff zone and pickup-hour weather.

    Inner joins drop trips whose zone is unknown; the weather join is left,
    unmatched trips get the `unknown` weather member.
    """
    loc = dim_loc.select("location_id", "borough", "zone")
    pu = loc.select(F.col("location_id").alias("pu_id"), F.col("borough").alias("pickup_borough"),
                    F.col("zone").alias("pickup_zone"))
    do = loc.select(F.col("location_id").alias("do_id"), F.col("borough").alias("dropoff_borough"),
                    F.col("zone").alias("dropoff_zone"))
    w = weather_for_join(stg_weather)
    t = (stg_trips
         .join(pu, stg_trips.pickup_location_id == pu.pu_id, "inner")
         .join(do, F.col("dropoff_location_id") == do.do_id, "inner"))
    t = t.join(w, (t.pickup_hour == w.w_hour) & (t.pickup_borough == w.w_borough), "left")
    return t.select(
        "trip_id",
        C.date_hour_key("pickup_hour").alias("date_hour_key"),
        C.date_key("pickup_date").alias("date_key"),
        "pickup_ts_local", "dropoff_ts_local", "pickup_hour", "pickup_date",
        "pickup_location_id", "dropoff_location_id", "pickup_borough", "pickup_zone",
        "dropoff_borough", "dropoff_zone", "vendor_id", "passenger_count", "rate_code_id",
        "payment_type", "payment_type_name", "store_and_fwd_flag", "trip_distance",
        "trip_duration_min", "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
        "improvement_surcharge", "total_amount", "congestion_surcharge", "airport_fee",
        "cbd_congestion_fee", "fare_per_mile", "weekday_number", "is_weekend", "is_rush_hour",
        F.coalesce("w_key", F.lit(fixed.UNKNOWN_WEATHER)).alias("weather_key"),
        "temperature_2m", "precipitation_mm", "rain_mm", "snowfall_cm", "wind_speed_10m", "weathercode",
        F.coalesce("w_severity", F.lit(fixed.UNKNOWN_WEATHER)).alias("weather_severity"),
        F.coalesce("w_rain", F.lit(False)).alias("is_rain"),
        F.coalesce("w_snow", F.lit(False)).alias("is_snow"),
        "ingestion_month", "source_file", "ingested_at",
    )


# sums of the trip fact at the finest grain that the three aggregate facts share
_SUM_KEYS = ("pickup_hour", "pickup_location_id", "pickup_borough", "pickup_zone", "weather_key", "weather_severity", "payment_type_name")
_SUMMED = ("passenger_count", "trip_distance", "fare_amount", "total_amount", "tip_amount", "fare_per_mile", "precipitation_mm", "temperature_2m")


def trip_sums(fct: DataFrame) -> DataFrame:
    """Counts and sums of trips by hour, zone, weather condition and payment type.

    Everything in it adds up: rows of different loads or months may be put together, and the
    three facts below are sums of its rows.  Money, distances and weather are exact decimal sums, durations
    sums of whole microseconds, so the order of adding changes no bit of them."""
    sums = [x for c in _SUMMED for x in (F.sum(c).alias(f"s_{c}"), F.count(c).alias(f"n_{c}"))]
    g = fct.groupBy(*_SUM_KEYS).agg(F.count(F.lit(1)).alias("trips"), *sums, F.sum(C.microseconds("trip_duration_min")).alias("s_micros"),
                                    F.count("trip_duration_min").alias("n_micros"))
    hour, day = F.col("pickup_hour"), F.col("pickup_hour").cast("date")  # what follows from the hour is not shuffled
    return g.select(C.date_hour_key(hour).alias("date_hour_key"), C.date_key(day).alias("date_key"), "pickup_hour", day.alias("pickup_date"),
                    "pickup_location_id", "pickup_borough", "pickup_zone", "weather_key", "weather_severity",
                    C.is_weekend(hour).alias("is_weekend"), C.is_rush_hour(hour).alias("is_rush_hour"), "payment_type_name",
                    *[c for c in g.columns if c not in _SUM_KEYS])


def _mean(column: str) -> Column:
    return F.sum(f"s_{column}").cast("double") / F.sum(f"n_{column}").cast("double")


def _mean_minutes() -> Column:
    return F.sum("s_micros").cast("double") / F.lit(60000000.0) / F.sum("n_micros").cast("double")


def fct_hourly_demand(sums: DataFrame) -> DataFrame:
    """A1, M7: hour x pickup zone x weather condition."""
    g = sums.groupBy("date_hour_key", "date_key", "pickup_hour", "pickup_location_id", "pickup_borough",
                     "pickup_zone", "weather_key", "weather_severity", "is_weekend").agg(
        F.sum("trips").alias("trip_count"),
        F.sum("s_passenger_count").cast("decimal(20,2)").alias("passenger_count_total"),
        _mean("trip_distance").alias("avg_trip_distance"),
        _mean_minutes().alias("avg_trip_duration_min"),
        _mean("fare_amount").alias("avg_fare_amount"),
        _mean("total_amount").alias("avg_total_amount"))
    return g.select(C.md5_key("date_hour_key", "pickup_location_id", "weather_key").alias("hourly_demand_key"), "*")


def fct_fare_revenue(sums: DataFrame) -> DataFrame:
    """A2, M8: day x pickup zone x payment type."""
    g = sums.groupBy("date_key", "pickup_date", "pickup_location_id", "pickup_borough", "pickup_zone",
                     "payment_type_name").agg(
        F.sum("trips").alias("trip_count"),
        F.sum("s_fare_amount").cast("decimal(22,2)").alias("gross_fare_amount"),
        F.sum("s_total_amount").cast("decimal(22,2)").alias("total_revenue_amount"),
        F.sum("s_tip_amount").cast("decimal(22,2)").alias("total_tip_amount"),
        _mean("fare_amount").alias("avg_fare_amount"),
        _mean("total_amount").alias("avg_total_amount"),
        _mean("fare_per_mile").alias("avg_fare_per_mile"))
    return g.select(C.md5_key("date_key", "pickup_location_id", "payment_type_name").alias("fare_revenue_key"), "*")


def fct_weather_impact(sums: DataFrame) -> DataFrame:
    """A3, M9: hour x borough x weather condition."""
    g = sums.groupBy("date_hour_key", "date_key", "pickup_hour", F.col("pickup_borough").alias("borough"),
                     "weather_key", "weather_severity").agg(
        F.sum("trips").alias("trip_count"),
        _mean("fare_amount").alias("avg_fare_amount"),
        _mean("total_amount").alias("avg_total_amount"),
        _mean_minutes().alias("avg_trip_duration_min"),
        _mean("trip_distance").alias("avg_trip_distance"),
        _mean("precipitation_mm").alias("avg_precipitation_mm"),
        _mean("temperature_2m").alias("avg_temperature_2m"),
        F.coalesce(F.sum(F.when(F.col("is_rush_hour"), F.col("trips"))), F.lit(0)).alias("rush_hour_trip_count"))
    return g.select(C.md5_key("date_hour_key", "borough", "weather_severity").alias("weather_impact_key"), "*")
