"""Reference SQL (DuckDB dialect) for every registered query.

Each model of the warehouse is written once more as a plain SQL CTE over the
benchmark tables; a query's oracle is `WITH <all CTEs> SELECT ...`.  DuckDB
drops CTEs a query does not reference.  Decimal outputs are cast to DOUBLE on
both sides (see `catalog.to_output`) so the comparison never depends on how
a client library renders decimals.
"""

from __future__ import annotations

from stormcab.functions import fixed

from . import feeds


def _case(expr: str, values: tuple[str, ...]) -> str:
    arms = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {expr} {arms} END"


def _payment_name(expr: str) -> str:
    arms = " ".join(f"WHEN {k} THEN '{v}'" for k, v in fixed.PAYMENT_TYPE_NAMES.items())
    return f"CASE {expr} {arms} ELSE '{fixed.UNKNOWN_PAYMENT}' END"


def _in(values) -> str:
    return ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)


def _severity(p: str, s: str) -> str:
    return (f"CASE WHEN COALESCE({p}, 0) >= {fixed.SEVERE_PRECIPITATION_MM} OR COALESCE({s}, 0) >= {fixed.SEVERE_SNOWFALL_CM} THEN 'severe' "
            f"WHEN COALESCE({p}, 0) >= {fixed.MODERATE_PRECIPITATION_MM} OR COALESCE({s}, 0) >= {fixed.MODERATE_SNOWFALL_CM} THEN 'moderate' "
            f"WHEN COALESCE({p}, 0) > 0 OR COALESCE({s}, 0) > 0 THEN 'light' ELSE 'clear' END")


def _weather_key(code: str, sev: str, rain: str, snow: str) -> str:
    return (f"md5(COALESCE(CAST({code} AS VARCHAR), 'na') || '|' || {sev} || '|' || "
            f"CAST({rain} AS VARCHAR) || '|' || CAST({snow} AS VARCHAR))")


def _hour_key(ts: str) -> str:
    return f"CAST(strftime({ts}, '%Y%m%d%H') AS BIGINT)"


def _day_key(ts: str) -> str:
    return f"CAST(strftime({ts}, '%Y%m%d') AS BIGINT)"


def _mean_minutes(x: str) -> str:
    return f"CAST(SUM(CAST(round({x} * 60000000.0) AS BIGINT)) AS DOUBLE) / 60000000.0 / CAST(COUNT({x}) AS DOUBLE)"


def _mean(x: str) -> str:
    return f"CAST(SUM({x}) AS DOUBLE) / CAST(COUNT({x}) AS DOUBLE)"


TS = "'%Y-%m-%d %H:%M:%S'"
START = f"TIMESTAMP '{feeds.START}'"
RUN = f"TIMESTAMP '{feeds.RUN_TS}'"
MONEY = ("fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge",
         "total_amount", "congestion_surcharge", "airport_fee", "cbd_congestion_fee")
WMEAS = ("temperature_2m", "precipitation_mm", "rain_mm", "snowfall_cm", "wind_speed_10m")

_DAY = f"(date_diff('day', DATE '{feeds.FIRST_SHIP_DATE}', CAST(l.l_shipdate AS DATE)) % {feeds.DAYS})"
_PICKUP = (f"({START} + to_seconds(CAST({_DAY} * 86400 + (l.l_orderkey * 37 + l.l_partkey * 11 + l.l_linenumber * 101) % 1440 * 60 "
           "+ l.l_orderkey % 60 AS BIGINT)))")
_FARE_C = ("(CASE WHEN l.l_suppkey % 29 = 0 THEN NULL WHEN l.l_partkey % 211 = 0 THEN 120000 "
           "ELSE (l.l_partkey * 31 + l.l_suppkey * 17 + l.l_linenumber * 1009) % 12000 - 100 END)")

CTES: list[tuple[str, str]] = [
    ("landed_trips", f"""
SELECT
  CAST(1 + l.l_suppkey % 2 AS INTEGER) AS "VendorID",
  {_PICKUP} AS tpep_pickup_datetime,
  CASE WHEN l.l_partkey % 97 = 0 THEN NULL
       ELSE {_PICKUP} + to_seconds((CAST(l.l_quantity AS BIGINT) - 2) * 60 + l.l_partkey % 45) END AS tpep_dropoff_datetime,
  CAST(CASE WHEN l.l_partkey % 13 = 0 THEN NULL ELSE l.l_suppkey % 10 END AS DOUBLE) AS passenger_count,
  CAST((l.l_partkey * 7919 + CAST(l.l_quantity AS BIGINT) * 131 + l.l_linenumber * 17) % 21000 AS DOUBLE) / 100 AS trip_distance,
  CAST(NULLIF(l.l_partkey % 8, 0) AS DOUBLE) AS "RatecodeID",
  l.l_returnflag AS store_and_fwd_flag,
  CAST(CASE WHEN l.l_partkey % 41 = 0 THEN {feeds.UNLISTED_PICKUP} ELSE s.s_nationkey + 1 END AS INTEGER) AS "PULocationID",
  CAST(CASE WHEN l.l_partkey % 43 = 0 THEN {feeds.UNLISTED_DROPOFF} ELSE oc.c_nationkey + 1 END AS INTEGER) AS "DOLocationID",
  CAST(l.l_linenumber AS BIGINT) AS payment_type,
  CAST({_FARE_C} AS DOUBLE) / 100 AS fare_amount,
  CAST(l.l_linenumber * 50 AS DOUBLE) / 100 AS extra,
  0.5::DOUBLE AS mta_tax,
  CAST(l.l_suppkey % 500 AS DOUBLE) / 100 AS tip_amount,
  0.0::DOUBLE AS tolls_amount,
  1.0::DOUBLE AS improvement_surcharge,
  CAST(COALESCE({_FARE_C}, 0) + l.l_suppkey % 500 + l.l_linenumber * 50 + 150 AS DOUBLE) / 100 AS total_amount,
  CASE WHEN l.l_linenumber % 3 = 0 THEN NULL ELSE 2.5::DOUBLE END AS congestion_surcharge,
  0.0::DOUBLE AS "Airport_fee",
  CAST(NULL AS DOUBLE) AS cbd_congestion_fee,
  CASE WHEN l.l_partkey % 53 = 0 THEN '{feeds.MONTHS[-1]}' ELSE strftime({_PICKUP}, '%Y-%m') END AS file_month
FROM lineitem l
JOIN (SELECT o.o_orderkey, c.c_nationkey FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey) oc
  ON l.l_orderkey = oc.o_orderkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey"""),
    ("norm_trips", f"""
SELECT
  md5(concat_ws('|',
      COALESCE(strftime(pickup_datetime, {TS}), 'null'),
      COALESCE(strftime(dropoff_datetime, {TS}), 'null'),
      COALESCE(CAST(pickup_location_id AS VARCHAR), 'null'),
      COALESCE(CAST(dropoff_location_id AS VARCHAR), 'null'),
      COALESCE(CAST(fare_amount AS VARCHAR), 'null'),
      COALESCE(CAST(total_amount AS VARCHAR), 'null'),
      COALESCE(CAST(trip_distance AS VARCHAR), 'null'))) AS record_hash,
  t.*
FROM (
  SELECT
    TRY_CAST("VendorID" AS INTEGER) AS vendor_id,
    TRY_CAST(tpep_pickup_datetime AS TIMESTAMP) AS pickup_datetime,
    TRY_CAST(tpep_dropoff_datetime AS TIMESTAMP) AS dropoff_datetime,
    TRY_CAST(passenger_count AS DECIMAL(10,2)) AS passenger_count,
    TRY_CAST(trip_distance AS DECIMAL(12,3)) AS trip_distance,
    TRY_CAST("RatecodeID" AS INTEGER) AS rate_code_id,
    CAST(store_and_fwd_flag AS VARCHAR) AS store_and_fwd_flag,
    TRY_CAST("PULocationID" AS INTEGER) AS pickup_location_id,
    TRY_CAST("DOLocationID" AS INTEGER) AS dropoff_location_id,
    TRY_CAST(payment_type AS INTEGER) AS payment_type,
    TRY_CAST(fare_amount AS DECIMAL(12,2)) AS fare_amount,
    TRY_CAST(extra AS DECIMAL(12,2)) AS extra,
    TRY_CAST(mta_tax AS DECIMAL(12,2)) AS mta_tax,
    TRY_CAST(tip_amount AS DECIMAL(12,2)) AS tip_amount,
    TRY_CAST(tolls_amount AS DECIMAL(12,2)) AS tolls_amount,
    TRY_CAST(improvement_surcharge AS DECIMAL(12,2)) AS improvement_surcharge,
    TRY_CAST(total_amount AS DECIMAL(12,2)) AS total_amount,
    TRY_CAST(congestion_surcharge AS DECIMAL(12,2)) AS congestion_surcharge,
    TRY_CAST("Airport_fee" AS DECIMAL(12,2)) AS airport_fee,
    TRY_CAST(cbd_congestion_fee AS DECIMAL(12,2)) AS cbd_congestion_fee,
    date_trunc('hour', TRY_CAST(tpep_pickup_datetime AS TIMESTAMP)) AS pickup_hour,
    CAST(TRY_CAST(tpep_pickup_datetime AS TIMESTAMP) AS DATE) AS pickup_date,
    CAST(file_month || '-01' AS DATE) AS ingestion_month,
    'yellow_tripdata_' || file_month || '.parquet' AS source_file,
    {RUN} AS ingested_at
  FROM landed_trips
) t"""),
    ("raw_trips", """
SELECT * FROM norm_trips
QUALIFY row_number() OVER (PARTITION BY record_hash ORDER BY
  vendor_id ASC NULLS FIRST, passenger_count ASC NULLS FIRST, rate_code_id ASC NULLS FIRST,
  store_and_fwd_flag ASC NULLS FIRST, payment_type ASC NULLS FIRST, extra ASC NULLS FIRST,
  mta_tax ASC NULLS FIRST, tip_amount ASC NULLS FIRST, tolls_amount ASC NULLS FIRST,
  improvement_surcharge ASC NULLS FIRST, congestion_surcharge ASC NULLS FIRST,
  airport_fee ASC NULLS FIRST, cbd_congestion_fee ASC NULLS FIRST, source_file ASC NULLS FIRST) = 1"""),
    ("readings", f"""
SELECT
  event_id,
  {_case('user_id % 5', feeds.REGION_BOROUGHS)} AS borough,
  date_trunc('hour', ts + to_days(CAST(event_id % 3 * 30 AS INTEGER))) AS weather_ts_hour,
  ts + to_days(CAST(event_id % 3 * 30 AS INTEGER)) AS ts,
  CAST(CAST(event_id % 700 AS DOUBLE) / 10 - 5 AS DECIMAL(8,2)) AS temperature_2m,
  CAST(CASE WHEN event_id % 7 = 0 THEN NULL
            WHEN event_id % 4 = 0 THEN CAST(CAST(event_id % 120 AS DOUBLE) / 10 AS DECIMAL(8,2))
            ELSE 0 END AS DECIMAL(8,2)) AS precipitation_mm,
  CAST(CASE WHEN event_id % 8 = 0 THEN CAST(CAST(event_id % 120 AS DOUBLE) / 10 AS DECIMAL(8,2)) ELSE 0 END AS DECIMAL(8,2)) AS rain_mm,
  CAST(CASE WHEN event_id % 10 = 0 THEN CAST(CAST(event_id % 50 AS DOUBLE) / 10 AS DECIMAL(8,2)) ELSE 0 END AS DECIMAL(8,2)) AS snowfall_cm,
  CAST(event_id % 210 AS DECIMAL(8,2)) AS wind_speed_10m,
  CAST(CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_id % 100 END AS INTEGER) AS weathercode
FROM events"""),
    ("raw_weather", f"""
SELECT
  md5(borough || '|' || strftime(weather_ts_hour, {TS})) AS weather_record_id,
  borough, weather_ts_hour, temperature_2m, precipitation_mm, rain_mm, snowfall_cm, wind_speed_10m, weathercode,
  CAST(date_trunc('month', weather_ts_hour) AS DATE) AS source_month,
  'weather/' || borough || '.json' AS source_file,
  ts AS ingested_at
FROM readings"""),
    ("raw_zone", f"""
SELECT
  CAST(n_nationkey + 1 AS INTEGER) AS location_id,
  CASE WHEN n_nationkey = {feeds.EWR_NATION} THEN 'EWR' ELSE {_case('n_regionkey', feeds.REGION_BOROUGHS)} END AS borough,
  n_name AS zone,
  {_case('n_nationkey % 3', feeds.SERVICE_ZONES)} AS service_zone,
  '{feeds.ZONE_FILE}' AS source_file,
  {RUN} AS ingested_at
FROM nation"""),
    ("stg_taxi_trips", f"""
SELECT
  record_hash AS trip_id, vendor_id,
  pickup_datetime AS pickup_ts_local, dropoff_datetime AS dropoff_ts_local,
  date_trunc('hour', pickup_datetime) AS pickup_hour,
  CAST(pickup_datetime AS DATE) AS pickup_date,
  CAST(COALESCE(passenger_count, 1) AS DECIMAL(10,2)) AS passenger_count,
  trip_distance, rate_code_id, store_and_fwd_flag, pickup_location_id, dropoff_location_id, payment_type,
  {_payment_name('payment_type')} AS payment_type_name,
  {", ".join(f"CAST(COALESCE({m}, 0) AS DECIMAL(12,2)) AS {m}" for m in MONEY)},
  CAST(date_diff('microsecond', pickup_datetime, dropoff_datetime) AS DOUBLE) / 60000000.0::DOUBLE AS trip_duration_min,
  CAST(COALESCE(fare_amount, 0) AS DOUBLE) / NULLIF(CAST(trip_distance AS DOUBLE), 0.0) AS fare_per_mile,
  CAST(isodow(pickup_datetime) AS INTEGER) AS weekday_number,
  isodow(pickup_datetime) IN ({_in(fixed.WEEKEND_ISO_DAYS)}) AS is_weekend,
  hour(pickup_datetime) IN ({_in(fixed.RUSH_HOURS)}) AS is_rush_hour,
  ingestion_month, source_file, ingested_at
FROM raw_trips
WHERE pickup_datetime IS NOT NULL AND dropoff_datetime IS NOT NULL AND dropoff_datetime > pickup_datetime
  AND pickup_location_id IS NOT NULL AND dropoff_location_id IS NOT NULL
  AND trip_distance > 0 AND trip_distance <= {fixed.MAX_TRIP_DISTANCE}
  AND COALESCE(fare_amount, 0) >= 0 AND COALESCE(total_amount, 0) >= 0
  AND COALESCE(passenger_count, 1) BETWEEN {fixed.MIN_PASSENGERS} AND {fixed.MAX_PASSENGERS}
  AND COALESCE(fare_amount, 0) <= {fixed.MAX_FARE_AMOUNT} AND COALESCE(total_amount, 0) <= {fixed.MAX_TOTAL_AMOUNT}"""),
    ("latest_weather", """
SELECT * FROM raw_weather WHERE weather_ts_hour IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY borough, weather_ts_hour ORDER BY
  ingested_at DESC NULLS LAST, source_file ASC NULLS FIRST, temperature_2m ASC NULLS FIRST,
  precipitation_mm ASC NULLS FIRST, rain_mm ASC NULLS FIRST, snowfall_cm ASC NULLS FIRST,
  wind_speed_10m ASC NULLS FIRST, weathercode ASC NULLS FIRST, weather_record_id ASC NULLS FIRST) = 1"""),
    ("stg_weather_hourly", f"""
SELECT
  weather_record_id, borough, weather_ts_hour, temperature_2m,
  CAST(GREATEST(COALESCE(precipitation_mm, 0), 0) AS DECIMAL(8,2)) AS precipitation_mm,
  CAST(GREATEST(COALESCE(rain_mm, 0), 0) AS DECIMAL(8,2)) AS rain_mm,
  CAST(GREATEST(COALESCE(snowfall_cm, 0), 0) AS DECIMAL(8,2)) AS snowfall_cm,
  CAST(GREATEST(COALESCE(wind_speed_10m, 0), 0) AS DECIMAL(8,2)) AS wind_speed_10m,
  weathercode,
  COALESCE(rain_mm, 0) > 0 AS is_rain,
  COALESCE(snowfall_cm, 0) > 0 AS is_snow,
  {_severity('precipitation_mm', 'snowfall_cm')} AS weather_severity,
  source_month, source_file, ingested_at
FROM latest_weather
WHERE temperature_2m BETWEEN {fixed.MIN_TEMPERATURE} AND {fixed.MAX_TEMPERATURE}
  AND wind_speed_10m BETWEEN {fixed.MIN_WIND_SPEED} AND {fixed.MAX_WIND_SPEED}"""),
    ("stg_locations", f"""
SELECT location_id, borough, zone, service_zone,
  CASE WHEN borough IN ({_in(fixed.NYC_BOROUGHS)}) THEN TRUE ELSE FALSE END AS is_nyc_borough
FROM raw_zone"""),
    ("dim_location", "SELECT location_id, borough, zone, service_zone, is_nyc_borough FROM stg_locations"),
    ("dim_weather", f"""
SELECT 'unknown' AS weather_key, CAST(NULL AS INTEGER) AS weathercode, 'unknown' AS weather_severity,
       FALSE AS is_rain, FALSE AS is_snow, 'unknown' AS weather_group
UNION ALL
SELECT {_weather_key('weathercode', 'weather_severity', 'is_rain', 'is_snow')} AS weather_key,
  weathercode, weather_severity, is_rain, is_snow,
  CASE WHEN is_rain AND is_snow THEN 'mixed' WHEN is_snow THEN 'snow' WHEN is_rain THEN 'rain'
       WHEN weather_severity = 'clear' THEN 'clear' ELSE 'other' END AS weather_group
FROM (SELECT DISTINCT weathercode, weather_severity, is_rain, is_snow FROM stg_weather_hourly) d"""),
    ("dim_date_time", f"""
SELECT
  {_hour_key('hour_ts')} AS date_hour_key,
  {_day_key('hour_ts')} AS date_key,
  hour_ts,
  CAST(hour_ts AS DATE) AS calendar_date,
  CAST(year(hour_ts) AS INTEGER) AS year_number,
  CAST(month(hour_ts) AS INTEGER) AS month_number,
  strftime(hour_ts, '%B') AS month_name,
  CAST(day(hour_ts) AS INTEGER) AS day_of_month,
  CAST(hour(hour_ts) AS INTEGER) AS hour_of_day,
  CAST(isodow(hour_ts) AS INTEGER) AS iso_weekday_number,
  strftime(hour_ts, '%a') AS weekday_name,
  isodow(hour_ts) IN ({_in(fixed.WEEKEND_ISO_DAYS)}) AS is_weekend
FROM (
  SELECT unnest(generate_series(min_hour, max_hour, INTERVAL 1 HOUR)) AS hour_ts
  FROM (SELECT MIN(h) AS min_hour, MAX(h) AS max_hour
        FROM (SELECT pickup_hour AS h FROM stg_taxi_trips
              UNION ALL SELECT weather_ts_hour AS h FROM stg_weather_hourly) u) b
) s"""),
    ("fct_taxi_trips", f"""
SELECT
  t.trip_id,
  {_hour_key('t.pickup_hour')} AS date_hour_key,
  {_day_key('t.pickup_date')} AS date_key,
  t.pickup_ts_local, t.dropoff_ts_local, t.pickup_hour, t.pickup_date,
  t.pickup_location_id, t.dropoff_location_id,
  pl.borough AS pickup_borough, pl.zone AS pickup_zone,
  dl.borough AS dropoff_borough, dl.zone AS dropoff_zone,
  t.vendor_id, t.passenger_count, t.rate_code_id, t.payment_type, t.payment_type_name,
  t.store_and_fwd_flag, t.trip_distance, t.trip_duration_min,
  {", ".join(f"t.{m}" for m in MONEY)},
  t.fare_per_mile, t.weekday_number, t.is_weekend, t.is_rush_hour,
  COALESCE(w.weather_key, 'unknown') AS weather_key,
  w.temperature_2m, w.precipitation_mm, w.rain_mm, w.snowfall_cm, w.wind_speed_10m, w.weathercode,
  COALESCE(w.weather_severity, 'unknown') AS weather_severity,
  COALESCE(w.is_rain, FALSE) AS is_rain,
  COALESCE(w.is_snow, FALSE) AS is_snow,
  t.ingestion_month, t.source_file, t.ingested_at
FROM stg_taxi_trips t
JOIN dim_location pl ON t.pickup_location_id = pl.location_id
JOIN dim_location dl ON t.dropoff_location_id = dl.location_id
LEFT JOIN (
  SELECT borough, weather_ts_hour,
    {_weather_key('weathercode', 'weather_severity', 'is_rain', 'is_snow')} AS weather_key,
    temperature_2m, precipitation_mm, rain_mm, snowfall_cm, wind_speed_10m, weathercode,
    weather_severity, is_rain, is_snow
  FROM stg_weather_hourly
) w ON t.pickup_hour = w.weather_ts_hour AND pl.borough = w.borough"""),
    ("fct_hourly_demand", f"""
SELECT
  md5(CAST(date_hour_key AS VARCHAR) || '|' || CAST(pickup_location_id AS VARCHAR) || '|' || weather_key) AS hourly_demand_key,
  date_hour_key, date_key, pickup_hour, pickup_location_id, pickup_borough, pickup_zone,
  weather_key, weather_severity, is_weekend,
  COUNT(*) AS trip_count,
  SUM(passenger_count) AS passenger_count_total,
  {_mean('trip_distance')} AS avg_trip_distance,
  {_mean_minutes('trip_duration_min')} AS avg_trip_duration_min,
  {_mean('fare_amount')} AS avg_fare_amount,
  {_mean('total_amount')} AS avg_total_amount
FROM fct_taxi_trips
GROUP BY date_hour_key, date_key, pickup_hour, pickup_location_id, pickup_borough, pickup_zone,
  weather_key, weather_severity, is_weekend"""),
    ("fct_fare_revenue", f"""
SELECT
  md5(CAST(date_key AS VARCHAR) || '|' || CAST(pickup_location_id AS VARCHAR) || '|' || payment_type_name) AS fare_revenue_key,
  date_key, pickup_date, pickup_location_id, pickup_borough, pickup_zone, payment_type_name,
  COUNT(*) AS trip_count,
  SUM(fare_amount) AS gross_fare_amount,
  SUM(total_amount) AS total_revenue_amount,
  SUM(tip_amount) AS total_tip_amount,
  {_mean('fare_amount')} AS avg_fare_amount,
  {_mean('total_amount')} AS avg_total_amount,
  AVG(fare_per_mile) AS avg_fare_per_mile
FROM fct_taxi_trips
GROUP BY date_key, pickup_date, pickup_location_id, pickup_borough, pickup_zone, payment_type_name"""),
    ("fct_weather_impact", f"""
SELECT
  md5(CAST(date_hour_key AS VARCHAR) || '|' || pickup_borough || '|' || weather_severity) AS weather_impact_key,
  date_hour_key, date_key, pickup_hour, pickup_borough AS borough, weather_key, weather_severity,
  COUNT(*) AS trip_count,
  {_mean('fare_amount')} AS avg_fare_amount,
  {_mean('total_amount')} AS avg_total_amount,
  {_mean_minutes('trip_duration_min')} AS avg_trip_duration_min,
  {_mean('trip_distance')} AS avg_trip_distance,
  {_mean('precipitation_mm')} AS avg_precipitation_mm,
  {_mean('temperature_2m')} AS avg_temperature_2m,
  CAST(SUM(CASE WHEN is_rush_hour THEN 1 ELSE 0 END) AS BIGINT) AS rush_hour_trip_count
FROM fct_taxi_trips
GROUP BY date_hour_key, date_key, pickup_hour, pickup_borough, weather_key, weather_severity"""),
]

# Decimal columns of each model (cast to DOUBLE in query outputs on both sides).
DECIMALS: dict[str, tuple[str, ...]] = {
    "raw_trips": ("passenger_count", "trip_distance", *MONEY),
    "norm_trips": ("passenger_count", "trip_distance", *MONEY),
    "raw_weather": WMEAS,
    "stg_taxi_trips": ("passenger_count", "trip_distance", *MONEY),
    "stg_weather_hourly": WMEAS,
    "fct_taxi_trips": ("passenger_count", "trip_distance", *MONEY, *WMEAS),
    "fct_hourly_demand": ("passenger_count_total",),
    "fct_fare_revenue": ("gross_fare_amount", "total_revenue_amount", "total_tip_amount"),
}


def with_models(select: str, extra_ctes: list[tuple[str, str]] | None = None, replaced: dict[str, str] | None = None) -> str:
    """`WITH <model CTEs> <select>`; DuckDB ignores the CTEs the select does not use.
    `replaced` gives other definitions of some models."""
    parts = [f"{name} AS ({(replaced or {}).get(name, body)}\n)" for name, body in CTES + (extra_ctes or [])]
    return "WITH " + ",\n".join(parts) + "\n" + select


# Means of inexact doubles depend on summation order; outputs round them.
OUTPUT_DIGITS = 9
ROUNDED: dict[str, tuple[str, ...]] = {
    "fct_fare_revenue": ("avg_fare_per_mile",),
}


def model_select(model: str) -> str:
    """SELECT * of a model with decimal columns as DOUBLE and order-dependent means rounded."""
    rep = [f"CAST({c} AS DOUBLE) AS {c}" for c in DECIMALS.get(model, ())]
    rep += [f"round({c}, {OUTPUT_DIGITS}) AS {c}" for c in ROUNDED.get(model, ())]
    if rep:
        return f"SELECT * REPLACE ({', '.join(rep)}) FROM {model}"
    return f"SELECT * FROM {model}"


# --- prototype (notebook) models --------------------------------------------------

# landed trip columns in order, with the kind that decides their canonical text
LANDED_KINDS = (
    ("VendorID", "int"), ("tpep_pickup_datetime", "ts"), ("tpep_dropoff_datetime", "ts"),
    ("passenger_count", "num"), ("trip_distance", "num"), ("RatecodeID", "num"),
    ("store_and_fwd_flag", "str"), ("PULocationID", "int"), ("DOLocationID", "int"),
    ("payment_type", "int"), ("fare_amount", "num"), ("extra", "num"), ("mta_tax", "num"),
    ("tip_amount", "num"), ("tolls_amount", "num"), ("improvement_surcharge", "num"),
    ("total_amount", "num"), ("congestion_surcharge", "num"), ("Airport_fee", "num"),
    ("cbd_congestion_fee", "num"),
)


def _canon(name: str, kind: str) -> str:
    c = f'"{name}"'
    if kind == "ts":
        text = f"strftime({c}, {TS})"
    elif kind == "num":
        text = f"CAST(CAST({c} AS DECIMAL(20,4)) AS VARCHAR)"
    else:
        text = f"CAST({c} AS VARCHAR)"
    return f"COALESCE({text}, 'null')"


_DURATION = ("CAST(date_diff('microsecond', tpep_pickup_datetime, tpep_dropoff_datetime) AS DOUBLE) "
             "/ 60000000.0::DOUBLE")

PROTO_CTES: list[tuple[str, str]] = [
    ("proto_trips", f"""
SELECT md5(concat_ws('|', {', '.join(_canon(n, k) for n, k in LANDED_KINDS)})) AS trip_id, d.*,
       {_DURATION} AS trip_duration_min
FROM (SELECT DISTINCT * EXCLUDE (file_month) FROM landed_trips) d
WHERE tpep_pickup_datetime IS NOT NULL AND tpep_dropoff_datetime IS NOT NULL
  AND {_DURATION} > 0 AND fare_amount >= 0 AND trip_distance > 0"""),
    ("proto_weather", f"""
SELECT borough, weather_ts_hour, temperature_2m, precipitation_mm, rain_mm, snowfall_cm,
       wind_speed_10m AS wind_speed, weathercode,
       COALESCE(rain_mm, 0) > 0 AS is_rain, COALESCE(snowfall_cm, 0) > 0 AS is_snow,
       {_severity('precipitation_mm', 'snowfall_cm')} AS weather_severity
FROM latest_weather"""),
    ("proto_trip_weather", """
SELECT t.trip_id, t.tpep_pickup_datetime, date_trunc('hour', t.tpep_pickup_datetime) AS pickup_hour,
       z.borough, z.zone AS pickup_zone, t.trip_distance, t.fare_amount, t.total_amount,
       t.fare_amount / t.trip_distance AS fare_per_mile, t.trip_duration_min,
       w.temperature_2m, w.precipitation_mm, w.is_rain, w.is_snow, w.weather_severity
FROM proto_trips t
LEFT JOIN raw_zone z ON t."PULocationID" = z.location_id
LEFT JOIN proto_weather w ON date_trunc('hour', t.tpep_pickup_datetime) = w.weather_ts_hour
                         AND z.borough = w.borough"""),
]


# weather documents -> raw rows: a document has the first reading (smallest event id) of each hour
WEATHER_DOC_SQL = f"""
SELECT md5(borough || '|' || strftime(weather_ts_hour, {TS})) AS weather_record_id,
       borough, weather_ts_hour, temperature_2m, precipitation_mm, rain_mm, snowfall_cm, wind_speed_10m, weathercode,
       CAST(date_trunc('month', weather_ts_hour) AS DATE) AS source_month,
       'weather/' || strftime(weather_ts_hour, '%Y-%m') || '/' || borough || '.json' AS source_file,
       {RUN} AS ingested_at
FROM readings
QUALIFY row_number() OVER (PARTITION BY borough, weather_ts_hour ORDER BY event_id) = 1"""

# trips loaded month by month: deduplicated inside each month
MONTHLY_TRIPS_SQL = dict(CTES)["raw_trips"].replace("PARTITION BY record_hash", "PARTITION BY ingestion_month, record_hash")
# the raw tables as the job leaves them
LOADED = {"raw_trips": MONTHLY_TRIPS_SQL, "raw_weather": WEATHER_DOC_SQL}
