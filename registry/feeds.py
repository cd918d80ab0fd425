"""Feeds derived from the given tables.

The warehouse expects landed trip Parquet, weather documents and a zone
lookup.  These functions derive all three from the given parquet tables with
integer arithmetic only (so any SQL engine reproduces them exactly) and keep
every row: their size grows with the tables.

* zones   <- nation, all of it
* trips   <- lineitem joined to orders, customer and supplier, in the source
             spellings of a trip file; three months, some trips in the file of a
             later month than their pickup, some with a zone id that the lookup lacks
* weather <- events, several readings per borough-hour (the staging dedup has
             work), or as landed documents with one reading per hour
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stormcab.functions import columns as C

# Feed constants (ours, not the original pipeline's).
MONTHS = ("2024-01", "2024-02", "2024-03")
START = "2024-01-01 00:00:00"
FIRST_SHIP_DATE = "1992-01-01"
DAYS = 90
ZONE_FILE = "taxi_zone_lookup.csv"
RUN_TS = "2024-04-01 06:00:00"
EWR_NATION = 24
UNLISTED_PICKUP, UNLISTED_DROPOFF = 99, 98
# borough of region 0..4 and service zone of nationkey % 3
REGION_BOROUGHS = ("Bronx", "Brooklyn", "Manhattan", "Queens", "Staten Island")
SERVICE_ZONES = ("Yellow Zone", "Boro Zone", "Airports")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def _pick(index: Column, values: tuple[str, ...]) -> Column:
    expr = None
    for i, v in enumerate(values):
        expr = F.when(index == i, F.lit(v)) if expr is None else expr.when(index == i, F.lit(v))
    return expr


def landed_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone lookup as landed (CSV header names) from `nation`."""
    k = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").select(
        (k + 1).cast("int").alias("LocationID"),
        F.when(k == EWR_NATION, F.lit("EWR")).otherwise(_pick(F.col("n_regionkey"), REGION_BOROUGHS)).alias("Borough"),
        F.col("n_name").alias("Zone"),
        _pick(k % 3, SERVICE_ZONES).alias("service_zone"),
    )


def landed_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips in the source spellings of a trip file, with `file_month`, the month they landed in.

    Join order: orders with customer first (both shuffle on the customer
    key), then lineitem once on the order key; supplier is joined last and
    is broadcast by Spark's own size check when it is small, otherwise it is
    a shuffle join.  lineitem, the big side, is shuffled as few times as the
    keys allow.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "l_shipdate")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    supp = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    oc = orders.join(cust, orders.o_custkey == cust.c_custkey).select("o_orderkey", "c_nationkey")
    j = (li.join(oc, li.l_orderkey == oc.o_orderkey)
           .join(supp, li.l_suppkey == supp.s_suppkey))

    ok, pk, sk, ln = (F.col(c) for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"))
    qty = F.col("l_quantity").cast("bigint")
    day = F.datediff(F.col("l_shipdate").cast("date"), F.lit(FIRST_SHIP_DATE).cast("date")) % DAYS
    second = day.cast("bigint") * 86400 + (ok * 37 + pk * 11 + ln * 101) % 1440 * 60 + ok % 60
    pickup = F.timestamp_add("SECOND", second, ntz(START))
    dropoff = F.when(pk % 97 == 0, F.lit(None)).otherwise(F.timestamp_add("SECOND", (qty - 2) * 60 + pk % 45, pickup))
    fare_c = (F.when(sk % 29 == 0, F.lit(None).cast("bigint"))
               .when(pk % 211 == 0, F.lit(120000).cast("bigint"))
               .otherwise((pk * 31 + sk * 17 + ln * 1009) % 12000 - 100))
    tip_c = sk % 500

    def money(cents: Column) -> Column:
        return cents.cast("double") / 100

    return j.select(
        (1 + sk % 2).cast("int").alias("VendorID"),
        pickup.alias("tpep_pickup_datetime"),
        dropoff.alias("tpep_dropoff_datetime"),
        F.when(pk % 13 == 0, F.lit(None)).otherwise(sk % 10).cast("double").alias("passenger_count"),
        money((pk * 7919 + qty * 131 + ln * 17) % 21000).alias("trip_distance"),
        F.nullif(pk % 8, F.lit(0)).cast("double").alias("RatecodeID"),
        F.col("l_returnflag").alias("store_and_fwd_flag"),
        F.when(pk % 41 == 0, UNLISTED_PICKUP).otherwise(F.col("s_nationkey") + 1).cast("int").alias("PULocationID"),
        F.when(pk % 43 == 0, UNLISTED_DROPOFF).otherwise(F.col("c_nationkey") + 1).cast("int").alias("DOLocationID"),
        ln.cast("bigint").alias("payment_type"),
        money(fare_c).alias("fare_amount"),
        money(ln * 50).alias("extra"),
        F.lit(0.5).alias("mta_tax"),
        money(tip_c).alias("tip_amount"),
        F.lit(0.0).alias("tolls_amount"),
        F.lit(1.0).alias("improvement_surcharge"),
        money(F.coalesce(fare_c, F.lit(0)) + tip_c + ln * 50 + 150).alias("total_amount"),
        F.when(ln % 3 == 0, F.lit(None).cast("double")).otherwise(F.lit(2.5)).alias("congestion_surcharge"),
        F.lit(0.0).alias("Airport_fee"),
        F.lit(None).cast("double").alias("cbd_congestion_fee"),
        F.when(pk % 53 == 0, F.lit(MONTHS[-1])).otherwise(F.substring(pickup.cast("string"), 1, 7)).alias("file_month"),
    )


def trip_file(month: Column) -> Column:
    """Name of the file that a month's trips landed in."""
    return F.concat(F.lit("yellow_tripdata_"), month, F.lit(".parquet"))


def landed_month(spark: SparkSession, sf_dir: str, month: str) -> DataFrame:
    """The trips of one landed file, in the file's own columns."""
    return landed_trips(spark, sf_dir).where(F.col("file_month") == month).drop("file_month")


def _weather_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-event weather readings (decimal measures as in the warehouse), spread over three months."""
    eid = F.col("event_id")

    def tenths(x: Column) -> Column:
        return (x.cast("double") / 10).cast("decimal(8,2)")

    ts = F.timestamp_add("DAY", eid % 3 * 30, F.col("ts"))
    return table(spark, sf_dir, "events").select("event_id", "ts", "user_id").select(
        eid,
        _pick(F.col("user_id") % 5, REGION_BOROUGHS).alias("borough"),
        C.hour_floor(ts).alias("weather_ts_hour"),
        ts.alias("ts"),
        ((eid % 700).cast("double") / 10 - 5).cast("decimal(8,2)").alias("temperature_2m"),
        F.when(eid % 7 == 0, F.lit(None)).when(eid % 4 == 0, tenths(eid % 120))
         .otherwise(F.lit(0)).cast("decimal(8,2)").alias("precipitation_mm"),
        F.when(eid % 8 == 0, tenths(eid % 120)).otherwise(F.lit(0)).cast("decimal(8,2)").alias("rain_mm"),
        F.when(eid % 10 == 0, tenths(eid % 50)).otherwise(F.lit(0)).cast("decimal(8,2)").alias("snowfall_cm"),
        (eid % 210).cast("decimal(8,2)").alias("wind_speed_10m"),
        F.when(eid % 11 == 0, F.lit(None)).otherwise(eid % 100).cast("int").alias("weathercode"),
    )


def raw_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw weather table as left by several ingestions (ingested_at = reading time)."""
    r = _weather_readings(spark, sf_dir)
    return r.select(
        C.md5_key(F.col("borough"), C.ts_text("weather_ts_hour")).alias("weather_record_id"),
        "borough", "weather_ts_hour", "temperature_2m", "precipitation_mm", "rain_mm",
        "snowfall_cm", "wind_speed_10m", "weathercode",
        F.trunc(F.col("weather_ts_hour").cast("date"), "MM").alias("source_month"),
        F.concat(F.lit("weather/"), F.col("borough"), F.lit(".json")).alias("source_file"),
        F.col("ts").alias("ingested_at"),
    )


def landed_weather_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather as landed documents: parallel hourly arrays, one document per borough and month.

    Of an hour's readings the first (smallest event id) is in the document, so
    a document has at most 744 hours whatever the size of the tables.
    """
    reading = F.struct(
        F.col("temperature_2m").cast("double").alias("temperature_2m"),
        F.col("precipitation_mm").cast("double").alias("precipitation"),
        F.col("rain_mm").cast("double").alias("rain"),
        F.col("snowfall_cm").cast("double").alias("snowfall"),
        F.col("wind_speed_10m").cast("double").alias("windspeed_10m"),
        F.col("weathercode").alias("weathercode"),
    )
    hours = (_weather_readings(spark, sf_dir).groupBy("borough", "weather_ts_hour")
             .agg(F.min_by(reading, "event_id").alias("r")))
    month = F.substring(F.col("weather_ts_hour").cast("string"), 1, 7)
    entry = F.struct(C.ts_text("weather_ts_hour", iso_minutes=True).alias("time"), "r.*")
    docs = (hours.groupBy(F.col("borough").alias("requested_borough"), month.alias("requested_month"))
            .agg(F.sort_array(F.collect_list(entry)).alias("readings")))

    def field(name: str) -> Column:
        return F.transform(F.col("readings"), lambda x: x[name]).alias(name)

    hourly = F.struct(*[field(f) for f in ("time", "temperature_2m", "precipitation", "rain",
                                           "snowfall", "windspeed_10m", "weathercode")])
    return docs.select(
        "requested_borough", "requested_month", hourly.alias("hourly"),
        F.format_string("weather/%s/%s.json", F.col("requested_month"), F.col("requested_borough")).alias("source_file"),
    )


def month_documents(spark: SparkSession, sf_dir: str, month: str) -> DataFrame:
    """The weather documents of one month."""
    return landed_weather_documents(spark, sf_dir).where(F.col("requested_month") == month)
