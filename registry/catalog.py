"""Registered queries: name -> (Spark builder, DuckDB oracle SQL).

Every builder takes (spark, sf_dir), reads the given tables through the
derived feeds and returns a DataFrame over the whole tables.  The builder of a model only
plans: no job runs before the result is used.  Serving and quality queries read built tables, which the first
of them writes (`published`); those of the load path
(`src_*`, `sink_*`, `job_*`, some `dq_*`) have writing and reading files for their subject.
Both write under the shared folder in `spark.checkpoint.dir`.  Outputs carry no DECIMAL columns (cast to DOUBLE),
mirroring `oracle.model_select`.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stormcab import schemas
from stormcab.functions import columns as C
from stormcab.functions import fixed as serving_fixed
from stormcab.operators import normalize, quality
from stormcab.plans import job, prototype, serving
from stormcab.plans.warehouse import RawTables, Warehouse
from stormcab.session import checkpoint_dir
from stormcab.sources import landed as landed_files
from stormcab.plans import key_filters
from stormcab.sources import bucketed, commits, writers

from . import feeds, oracle
from .published import Published, fingerprint, removed_at_exit

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLES: dict[str, str] = {}


def landed_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.landed_trips(spark, sf_dir)


def _file_columns() -> tuple:
    month = F.col("file_month")
    return month, feeds.trip_file(month), feeds.RUN_TS


def raw_tables(spark: SparkSession, sf_dir: str) -> RawTables:
    """The raw tables of the feed, all months."""
    return RawTables(trips=normalize.raw_trips(landed_trips(spark, sf_dir), *_file_columns()),
                     weather=feeds.raw_weather(spark, sf_dir),
                     zones=normalize.raw_zones(feeds.landed_zones(spark, sf_dir), feeds.ZONE_FILE, feeds.RUN_TS))


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The model graph over the feed: asking for a model plans what it depends on and nothing else."""
    return Warehouse(raw_tables(spark, sf_dir))


def published(spark: SparkSession, sf_dir: str) -> Published:
    """The built tables of the feed."""
    root = f"{checkpoint_dir(spark)}/published-{fingerprint(spark, sf_dir)}"
    if root not in _published:
        _published.add(removed_at_exit(spark, root))
    return Published(spark, root, lambda: raw_tables(spark, sf_dir))


_published: set[str] = set()


def to_output(df: DataFrame, rounded: tuple[str, ...] = ()) -> DataFrame:
    """Cast DECIMAL columns to DOUBLE (nearest double of the exact value) and
    round the named order-dependent means to `oracle.OUTPUT_DIGITS`."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        if f.name in rounded:
            c = F.round(c, oracle.OUTPUT_DIGITS)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def register(name: str, sql: str | None):
    def deco(fn: Builder) -> Builder:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def _model_query(model: str) -> None:
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        return to_output(getattr(warehouse(spark, sf_dir), model),
                         oracle.ROUNDED.get(model, ()))
    register(model, oracle.with_models(oracle.model_select(model)))(build)


for _m in Warehouse.MODELS:
    _model_query(_m)


# --- raw normalisation ------------------------------------------------------------

@register("norm_trips_rename_cast", oracle.with_models(oracle.model_select("norm_trips")))
def norm_trips_rename_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed trips renamed, coerced, stamped and hashed (before dedup)."""
    return to_output(normalize.normalize_trips(landed_trips(spark, sf_dir), *_file_columns()))


@register("norm_trip_dedup_hash", oracle.with_models(oracle.model_select("raw_trips")))
def norm_trip_dedup_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per record hash (deterministic winner)."""
    return to_output(normalize.raw_trips(landed_trips(spark, sf_dir), *_file_columns()))


@register("norm_zone_lookup", oracle.with_models("SELECT * FROM raw_zone"))
def norm_zone_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone lookup renamed and stamped."""
    return normalize.raw_zones(feeds.landed_zones(spark, sf_dir), feeds.ZONE_FILE, feeds.RUN_TS)


# --- serving queries ------------------------------------------------------------------

def _serve(name: str, sql: str, rounded: tuple[str, ...] = ()):
    """Register a serving query: `fn(warehouse) -> DataFrame` over whole marts."""
    def deco(fn):
        def build(spark: SparkSession, sf_dir: str) -> DataFrame:
            return to_output(fn(published(spark, sf_dir)), rounded)
        build.__name__ = name
        build.__doc__ = fn.__doc__
        rep = ", ".join(f"round({c}, {oracle.OUTPUT_DIGITS}) AS {c}" for c in rounded)
        full = f"SELECT * REPLACE ({rep}) FROM ({sql}) q" if rounded else sql
        register(name, oracle.with_models(full))(build)
        return fn
    return deco


_SEV = ", ".join(f"'{v}'" for v in serving_fixed.SEVERITY_LEVELS)
_PEAK = ", ".join(str(h) for h in serving_fixed.RUSH_HOURS)


@_serve("q_hourly_weather_demand", """
SELECT pickup_hour, borough, weather_severity, trip_count, avg_total_amount, avg_trip_duration_min
FROM fct_weather_impact ORDER BY pickup_hour, borough, weather_severity""")
def _q1(wh: Published) -> DataFrame:
    """V1: hourly demand under each weather severity."""
    return serving.hourly_weather_demand(wh.fct_weather_impact)


@_serve("q_top_zone_revenue", f"""
SELECT l.zone AS pickup_zone, r.trip_count, CAST(r.total_revenue_amount AS DOUBLE) AS total_revenue_amount,
       r.avg_fare_amount
FROM fct_fare_revenue r JOIN dim_location l ON r.pickup_location_id = l.location_id
ORDER BY r.total_revenue_amount DESC, r.fare_revenue_key LIMIT {serving_fixed.TOP_REVENUE_ROWS}""")
def _q2(wh: Published) -> DataFrame:
    """V2: top revenue rows joined to their zone."""
    return serving.top_zone_revenue(wh.fct_fare_revenue, wh.dim_location)


@_serve("q_borough_severity_volume", f"""
SELECT borough, weather_severity, CAST(SUM(trip_count) AS BIGINT) AS trip_count
FROM fct_weather_impact WHERE weather_severity IN ({_SEV})
GROUP BY borough, weather_severity ORDER BY borough, weather_severity""")
def _q3(wh: Published) -> DataFrame:
    """V3: trip volume by borough and severity."""
    return serving.borough_severity_volume(wh.fct_weather_impact)


@_serve("m_trip_count", "SELECT CAST(COALESCE(SUM(trip_count), 0) AS BIGINT) AS trip_count FROM fct_hourly_demand")
def _m0(wh: Published) -> DataFrame:
    """V4: Trip Count."""
    return serving.trip_count(wh.fct_hourly_demand)


_REVENUE_SQL = """
SELECT CAST(tr AS DOUBLE) AS total_revenue, CAST(gf AS DOUBLE) AS gross_fare,
       CAST(gf AS DOUBLE) / NULLIF(CAST(n AS DOUBLE), 0) AS average_fare,
       CAST(tr AS DOUBLE) / NULLIF(CAST(n AS DOUBLE), 0) AS average_revenue_per_trip
FROM (SELECT SUM(total_revenue_amount) AS tr, SUM(gross_fare_amount) AS gf, SUM(trip_count) AS n
      FROM fct_fare_revenue) a"""


@_serve("m_average_fare", _REVENUE_SQL)
def _m1(wh: Published) -> DataFrame:
    """V5/V6: Total Revenue, Gross Fare, Average Fare, Average Revenue Per Trip."""
    return serving.revenue_measures(wh.fct_fare_revenue)


_UNWEIGHTED_SQL = """
SELECT * FROM
 (SELECT AVG(avg_trip_distance) AS average_trip_distance,
         AVG(avg_trip_duration_min) AS average_trip_duration_min FROM fct_hourly_demand) h
CROSS JOIN
 (SELECT CAST(COALESCE(SUM(rush_hour_trip_count), 0) AS BIGINT) AS rush_hour_trip_count,
         AVG(avg_precipitation_mm) AS average_precipitation,
         AVG(avg_temperature_2m) AS average_temperature FROM fct_weather_impact) i"""


@_serve("m_unweighted_averages", _UNWEIGHTED_SQL,
        ("average_trip_distance", "average_trip_duration_min", "average_precipitation", "average_temperature"))
def _m2(wh: Published) -> DataFrame:
    """V7/V8/V9: unweighted averages of the facts' means and the rush-hour count."""
    return serving.unweighted_averages(wh.fct_hourly_demand, wh.fct_weather_impact)


_SHARE_SQL = """
SELECT rain_trip_count, snow_trip_count, trip_count,
       CAST(rain_trip_count AS DOUBLE) / NULLIF(CAST(trip_count AS DOUBLE), 0) AS rain_trip_share,
       CAST(snow_trip_count AS DOUBLE) / NULLIF(CAST(trip_count AS DOUBLE), 0) AS snow_trip_share
FROM (SELECT CAST(COALESCE(SUM(CASE WHEN w.weather_group = 'rain' THEN h.trip_count END), 0) AS BIGINT) AS rain_trip_count,
             CAST(COALESCE(SUM(CASE WHEN w.weather_group = 'snow' THEN h.trip_count END), 0) AS BIGINT) AS snow_trip_count,
             CAST(COALESCE(SUM(h.trip_count), 0) AS BIGINT) AS trip_count
      FROM fct_hourly_demand h LEFT JOIN dim_weather w ON h.weather_key = w.weather_key) a"""


@_serve("m_rain_snow_share", _SHARE_SQL)
def _m3(wh: Published) -> DataFrame:
    """Rain Trip Share and Snow Trip Share."""
    return serving.rain_snow_share(wh.fct_hourly_demand, wh.dim_weather)


@_serve("m_peak_offpeak", f"""
SELECT peak_trip_count, trip_count - peak_trip_count AS off_peak_trip_count, trip_count
FROM (SELECT CAST(COALESCE(SUM(CASE WHEN c.hour_of_day IN ({_PEAK}) THEN h.trip_count END), 0) AS BIGINT) AS peak_trip_count,
             CAST(COALESCE(SUM(h.trip_count), 0) AS BIGINT) AS trip_count
      FROM fct_hourly_demand h LEFT JOIN dim_date_time c ON h.date_hour_key = c.date_hour_key) a""")
def _m4(wh: Published) -> DataFrame:
    """Peak Hour Trip Count and Off Peak Trip Count."""
    return serving.peak_offpeak(wh.fct_hourly_demand, wh.dim_date_time)


@_serve("m_kpis", f"""
SELECT t.trip_count, r.total_revenue, r.average_fare, u.average_trip_duration_min, u.average_precipitation,
       s.rain_trip_share
FROM (SELECT CAST(COALESCE(SUM(trip_count), 0) AS BIGINT) AS trip_count FROM fct_hourly_demand) t
CROSS JOIN ({_REVENUE_SQL}) r
CROSS JOIN ({_UNWEIGHTED_SQL}) u
CROSS JOIN ({_SHARE_SQL}) s""", ("average_trip_duration_min", "average_precipitation"))
def _m5(wh: Published) -> DataFrame:
    """KPI card row."""
    return serving.kpi_row(wh.fct_hourly_demand, wh.fct_fare_revenue, wh.fct_weather_impact, wh.dim_weather)


@_serve("v_hourly_trip_line", """
SELECT c.hour_ts, CAST(SUM(h.trip_count) AS BIGINT) AS trip_count
FROM fct_hourly_demand h JOIN dim_date_time c ON h.date_hour_key = c.date_hour_key
GROUP BY c.hour_ts ORDER BY c.hour_ts""")
def _v12(wh: Published) -> DataFrame:
    """Trips by hour (line chart)."""
    return serving.hourly_trip_line(wh.fct_hourly_demand, wh.dim_date_time)


_PIVOT = ",\n".join(f"CAST(SUM(CASE WHEN c.hour_of_day = {h} THEN h.trip_count END) AS BIGINT) AS h{h:02d}"
                    for h in serving.HOURS)


@_serve("v_weekday_hour_matrix", f"""
SELECT c.iso_weekday_number, c.weekday_name, {_PIVOT}
FROM fct_hourly_demand h JOIN dim_date_time c ON h.date_hour_key = c.date_hour_key
GROUP BY c.iso_weekday_number, c.weekday_name ORDER BY c.iso_weekday_number""")
def _v13(wh: Published) -> DataFrame:
    """Weekday x hour matrix."""
    return serving.weekday_hour_matrix(wh.fct_hourly_demand, wh.dim_date_time)


@_serve("v_top15_zones_trips", f"""
SELECT l.location_id, l.zone, CAST(SUM(h.trip_count) AS BIGINT) AS trip_count
FROM fct_hourly_demand h JOIN dim_location l ON h.pickup_location_id = l.location_id
GROUP BY l.location_id, l.zone ORDER BY trip_count DESC, l.location_id LIMIT {serving_fixed.TOP_ZONES}""")
def _v16a(wh: Published) -> DataFrame:
    """Top pickup zones by trips."""
    return serving.top_zones_by_trips(wh.fct_hourly_demand, wh.dim_location)


@_serve("v_top15_zones_revenue", f"""
SELECT l.location_id, l.zone, CAST(SUM(r.total_revenue_amount) AS DOUBLE) AS total_revenue
FROM fct_fare_revenue r JOIN dim_location l ON r.pickup_location_id = l.location_id
GROUP BY l.location_id, l.zone ORDER BY SUM(r.total_revenue_amount) DESC, l.location_id
LIMIT {serving_fixed.TOP_ZONES}""")
def _v16b(wh: Published) -> DataFrame:
    """Top pickup zones by revenue."""
    return serving.top_zones_by_revenue(wh.fct_fare_revenue, wh.dim_location)


@_serve("v_zone_map", """
SELECT l.borough, l.zone, l.location_id, CAST(SUM(h.trip_count) AS BIGINT) AS trip_count
FROM fct_hourly_demand h JOIN dim_location l ON h.pickup_location_id = l.location_id
GROUP BY l.borough, l.zone, l.location_id""")
def _v17(wh: Published) -> DataFrame:
    """Trips by borough and zone (map data)."""
    return serving.zone_map(wh.fct_hourly_demand, wh.dim_location)


@_serve("v_zone_table", """
SELECT l.location_id, l.zone, t.trip_count,
       CAST(r.gf AS DOUBLE) / NULLIF(CAST(r.rn AS DOUBLE), 0) AS average_fare, CAST(r.tr AS DOUBLE) AS total_revenue
FROM (SELECT pickup_location_id, CAST(SUM(trip_count) AS BIGINT) AS trip_count FROM fct_hourly_demand
      GROUP BY pickup_location_id) t
JOIN (SELECT pickup_location_id, SUM(gross_fare_amount) AS gf, SUM(trip_count) AS rn,
             SUM(total_revenue_amount) AS tr FROM fct_fare_revenue GROUP BY pickup_location_id) r
  ON t.pickup_location_id = r.pickup_location_id
JOIN dim_location l ON t.pickup_location_id = l.location_id""")
def _v18(wh: Published) -> DataFrame:
    """Zone table."""
    return serving.zone_table(wh.fct_hourly_demand, wh.fct_fare_revenue, wh.dim_location)


@_serve("v_hourly_precip_trips", """
SELECT pickup_hour, CAST(SUM(trip_count) AS BIGINT) AS trip_count, AVG(avg_precipitation_mm) AS average_precipitation
FROM fct_weather_impact GROUP BY pickup_hour ORDER BY pickup_hour""", ("average_precipitation",))
def _v19(wh: Published) -> DataFrame:
    """Trips and average precipitation by hour."""
    return serving.hourly_precip_trips(wh.fct_weather_impact)


@_serve("v_severity_profile", """
SELECT weather_severity, CAST(SUM(trip_count) AS BIGINT) AS trip_count,
       SUM(avg_fare_amount * trip_count) / NULLIF(CAST(SUM(trip_count) AS DOUBLE), 0) AS average_fare
FROM fct_weather_impact GROUP BY weather_severity""", ("average_fare",))
def _v20(wh: Published) -> DataFrame:
    """Trips and average fare by severity."""
    return serving.severity_profile(wh.fct_weather_impact)


@_serve("v_precip_scatter", """
SELECT borough, pickup_hour, AVG(avg_precipitation_mm) AS average_precipitation,
       CAST(SUM(trip_count) AS BIGINT) AS trip_count
FROM fct_weather_impact GROUP BY borough, pickup_hour""", ("average_precipitation",))
def _v21(wh: Published) -> DataFrame:
    """Precipitation against trips per borough and hour."""
    return serving.precip_scatter(wh.fct_weather_impact)


@_serve("v_borough_severity_matrix", """
SELECT pickup_borough AS borough, weather_severity, CAST(SUM(trip_count) AS BIGINT) AS trip_count,
       AVG(avg_trip_duration_min) AS average_trip_duration_min
FROM fct_hourly_demand GROUP BY pickup_borough, weather_severity""", ("average_trip_duration_min",))
def _v22(wh: Published) -> DataFrame:
    """Borough x severity matrix."""
    return serving.borough_severity_matrix(wh.fct_hourly_demand)


# --- slicers: one query for each, on a fact it applies to ------------------------------

@_serve("v_sliced_date", """
SELECT c.hour_ts, CAST(SUM(h.trip_count) AS BIGINT) AS trip_count
FROM fct_hourly_demand h JOIN dim_date_time c ON h.date_hour_key = c.date_hour_key
WHERE CAST(h.pickup_hour AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-02-05' GROUP BY c.hour_ts""")
def _s1(wh: Published) -> DataFrame:
    """F16: date range."""
    return serving.hourly_trip_line(wh.fct_hourly_demand, wh.dim_date_time, serving.Slicers(date_from="2024-01-10", date_to="2024-02-05"))


@_serve("v_sliced_borough", """
SELECT l.borough, l.zone, l.location_id, CAST(SUM(h.trip_count) AS BIGINT) AS trip_count
FROM fct_hourly_demand h JOIN dim_location l ON h.pickup_location_id = l.location_id
WHERE h.pickup_borough IN ('Bronx', 'EWR') GROUP BY l.borough, l.zone, l.location_id""")
def _s2(wh: Published) -> DataFrame:
    """F16: borough."""
    return serving.zone_map(wh.fct_hourly_demand, wh.dim_location, serving.Slicers(boroughs=("Bronx", "EWR")))


@_serve("v_sliced_severity", """
SELECT pickup_borough AS borough, weather_severity, CAST(SUM(trip_count) AS BIGINT) AS trip_count,
       AVG(avg_trip_duration_min) AS average_trip_duration_min
FROM fct_hourly_demand WHERE weather_severity IN ('light', 'severe') GROUP BY pickup_borough, weather_severity""", ("average_trip_duration_min",))
def _s3(wh: Published) -> DataFrame:
    """F16: weather severity."""
    return serving.borough_severity_matrix(wh.fct_hourly_demand, serving.Slicers(severities=("light", "severe")))


@_serve("v_sliced_payment", _REVENUE_SQL.replace("FROM fct_fare_revenue", "FROM fct_fare_revenue WHERE payment_type_name = 'Cash'"))
def _s4(wh: Published) -> DataFrame:
    """F16: payment type."""
    return serving.revenue_measures(wh.fct_fare_revenue, serving.Slicers(payment_types=("Cash",)))


@_serve("v_sliced_hour", """
SELECT pickup_hour, CAST(SUM(trip_count) AS BIGINT) AS trip_count, AVG(avg_precipitation_mm) AS average_precipitation
FROM fct_weather_impact WHERE hour(pickup_hour) IN (7, 8, 9) GROUP BY pickup_hour""", ("average_precipitation",))
def _s5(wh: Published) -> DataFrame:
    """F16: hour of day."""
    return serving.hourly_precip_trips(wh.fct_weather_impact, serving.Slicers(hours_of_day=(7, 8, 9)))


@_serve("v_sliced_weather_group", """
SELECT CAST(COALESCE(SUM(h.trip_count), 0) AS BIGINT) AS trip_count
FROM fct_hourly_demand h WHERE h.weather_key IN (SELECT weather_key FROM dim_weather WHERE weather_group = 'rain')""")
def _s6(wh: Published) -> DataFrame:
    """F16: weather group."""
    return serving.trip_count(wh.fct_hourly_demand, serving.Slicers(weather_groups=("rain",)), wh.dim_weather)


# --- data-quality queries -------------------------------------------------------------

_CTE_OF = {"raw_taxi_trips_yellow": "raw_trips", "raw_weather_hourly": "raw_weather",
           "raw_taxi_zone_lookup": "raw_zone"}


def _cte(model: str) -> str:
    return _CTE_OF.get(model, model)


def _dq_row(check: str, model: str, column: str, failures: str, frm: str) -> str:
    return (f"SELECT '{check}' AS check_name, '{model}' AS model, '{column}' AS column_name, "
            f"CAST({failures} AS BIGINT) AS failures FROM {frm}")


_NOT_NULL_SQL = "\nUNION ALL\n".join(
    _dq_row("not_null", m, c, f"COUNT(*) FILTER (WHERE {c} IS NULL)", _cte(m))
    for m, cols in quality.NOT_NULL.items() for c in cols)
_UNIQUE_SQL = "\nUNION ALL\n".join(
    _dq_row("unique", m, c, "COUNT(*)",
            f"(SELECT {c} FROM {_cte(m)} WHERE {c} IS NOT NULL GROUP BY {c} HAVING COUNT(*) > 1) d")
    for m, c in quality.UNIQUE)
_ACCEPTED_SQL = "\nUNION ALL\n".join(
    _dq_row("accepted_values", m, c, "COUNT(*)",
            f"(SELECT DISTINCT {c} FROM {_cte(m)} WHERE {c} IS NOT NULL AND {c} NOT IN "
            f"({', '.join(repr(v) for v in vals)})) d")
    for m, c, vals in quality.ACCEPTED_VALUES)
_REL_SQL = "\nUNION ALL\n".join(
    _dq_row("relationships", m, c, "COUNT(*)",
            f"{_cte(m)} ch WHERE ch.{c} IS NOT NULL AND NOT EXISTS "
            f"(SELECT 1 FROM {_cte(p)} pa WHERE pa.{pc} = ch.{c})")
    for m, c, p, pc in quality.RELATIONSHIPS)


@register("dq_not_null", oracle.with_models(_NOT_NULL_SQL))
def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1: NULL rows of the 23 declared not-null columns."""
    return quality.not_null_checks(published(spark, sf_dir).model)


@register("dq_unique", oracle.with_models(_UNIQUE_SQL))
def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q2: duplicated values of the 13 declared unique columns."""
    return quality.unique_checks(published(spark, sf_dir).model)


@register("dq_accepted_values", oracle.with_models(_ACCEPTED_SQL))
def dq_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q3-Q5: values outside the accepted lists."""
    return quality.accepted_values_checks(published(spark, sf_dir).model)


@register("dq_relationships", oracle.with_models(_REL_SQL))
def dq_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orphan foreign keys of the 6 declared relationships."""
    return quality.relationship_checks(published(spark, sf_dir).model)


@register("dq_trip_ranges", oracle.with_models(
    "SELECT * FROM (" + oracle.model_select("fct_taxi_trips") + ") f WHERE trip_duration_min <= 0 OR "
    "trip_distance <= 0 OR fare_amount < 0 OR total_amount < 0 OR passenger_count < 0 OR passenger_count > 8"))
def dq_trip_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q7: fact rows outside the valid ranges (empty = pass)."""
    return to_output(quality.trip_range_violations(published(spark, sf_dir).fct_taxi_trips).drop(job.PICKUP_MONTH))


_RANGES = ("trip_duration_min <= 0 OR trip_distance <= 0 OR fare_amount < 0 OR total_amount < 0 OR passenger_count < 0 "
           "OR passenger_count > 8")


@register("dq_trip_ranges_raw", oracle.with_models(f"""
SELECT record_hash, trip_duration_min FROM (
  SELECT *, CAST(date_diff('microsecond', pickup_datetime, dropoff_datetime) AS DOUBLE) / 60000000.0::DOUBLE AS trip_duration_min FROM raw_trips) r
WHERE {_RANGES}"""))
def dq_trip_ranges_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q7 on the raw trips, which have rows that staging removes."""
    trips = published(spark, sf_dir).raw_taxi_trips_yellow
    timed = trips.withColumn("trip_duration_min", C.minutes_between("pickup_datetime", "dropoff_datetime"))
    return quality.trip_range_violations(timed).select("record_hash", "trip_duration_min")


@register("dq_weather_coverage_total", oracle.with_models(f"""
SELECT weather_join_coverage, CAST({serving_fixed.MIN_WEATHER_JOIN_COVERAGE} AS DOUBLE) AS min_coverage,
       weather_join_coverage >= CAST({serving_fixed.MIN_WEATHER_JOIN_COVERAGE} AS DOUBLE) AS passed
FROM (SELECT COALESCE(CAST(COUNT(*) FILTER (WHERE weather_key <> 'unknown') AS DOUBLE) / CAST(NULLIF(COUNT(*), 0) AS DOUBLE), 0.0)
               AS weather_join_coverage FROM fct_taxi_trips) c"""))
def dq_weather_coverage_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q9: weather join coverage of the whole table against the threshold."""
    return quality.coverage_total(published(spark, sf_dir).fct_taxi_trips)


@register("dq_month_gate", oracle.with_models(f"""
SELECT (SELECT COUNT(*) FROM raw_trips WHERE ingestion_month = DATE '{feeds.MONTHS[1]}-01') AS taxi_rows,
       (SELECT COUNT(*) FROM raw_weather WHERE source_month = DATE '{feeds.MONTHS[1]}-01') AS weather_rows,
       (SELECT CAST(COUNT(*) FILTER (WHERE weather_key <> 'unknown') AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) FROM fct_taxi_trips
        WHERE pickup_ts_local >= DATE '{feeds.MONTHS[1]}-01' AND pickup_ts_local < DATE '{feeds.MONTHS[2]}-01') AS weather_join_coverage,
       CAST((SELECT COUNT(*) FROM fct_taxi_trips WHERE pickup_ts_local >= DATE '{feeds.MONTHS[1]}-01' AND pickup_ts_local < DATE '{feeds.MONTHS[2]}-01')
        - (SELECT SUM(trip_count) FROM fct_hourly_demand WHERE pickup_hour >= DATE '{feeds.MONTHS[1]}-01' AND pickup_hour < DATE '{feeds.MONTHS[2]}-01') AS BIGINT) AS gap"""))
def dq_month_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q13-Q16 figures of one month (F10 load month, F11 pickup month)."""
    wh = published(spark, sf_dir)
    return quality.month_gate(feeds.MONTHS[1], wh.raw_taxi_trips_yellow, wh.raw_weather_hourly, wh.fct_taxi_trips, wh.fct_hourly_demand)


@register("dq_weather_coverage", oracle.with_models(f"""
SELECT pickup_month, trip_count, weather_join_coverage,
       CAST({serving_fixed.MIN_WEATHER_JOIN_COVERAGE} AS DOUBLE) AS min_coverage,
       weather_join_coverage >= CAST({serving_fixed.MIN_WEATHER_JOIN_COVERAGE} AS DOUBLE) AS passed
FROM (SELECT CAST(date_trunc('month', pickup_ts_local) AS DATE) AS pickup_month, COUNT(*) AS trip_count,
             CAST(COUNT(*) FILTER (WHERE weather_key <> 'unknown') AS DOUBLE) / CAST(COUNT(*) AS DOUBLE)
               AS weather_join_coverage
      FROM fct_taxi_trips GROUP BY 1) c"""))
def dq_weather_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather join coverage per pickup month against the threshold."""
    return quality.weather_coverage(published(spark, sf_dir).fct_taxi_trips)


@register("dq_hourly_consistency", oracle.with_models("""
SELECT COALESCE(d.pickup_month, a.pickup_month) AS pickup_month,
       COALESCE(d.n, 0) AS detailed_trip_count, CAST(COALESCE(a.n, 0) AS BIGINT) AS aggregated_trip_count,
       COALESCE(d.n, 0) - CAST(COALESCE(a.n, 0) AS BIGINT) AS gap
FROM (SELECT CAST(date_trunc('month', pickup_ts_local) AS DATE) AS pickup_month, COUNT(*) AS n
      FROM fct_taxi_trips GROUP BY 1) d
FULL OUTER JOIN (SELECT CAST(date_trunc('month', pickup_hour) AS DATE) AS pickup_month, SUM(trip_count) AS n
                 FROM fct_hourly_demand GROUP BY 1) a
  ON d.pickup_month = a.pickup_month"""))
def dq_hourly_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trip fact count minus hourly-mart rollup, per pickup month."""
    wh = published(spark, sf_dir)
    return quality.hourly_consistency(wh.fct_taxi_trips, wh.fct_hourly_demand)


@register("dq_month_row_counts", oracle.with_models(f"""
SELECT 'raw_taxi_trips_yellow' AS model, ingestion_month AS month, COUNT(*) AS row_count,
       CAST({serving_fixed.MIN_TAXI_ROWS} AS DOUBLE) AS min_rows,
       COUNT(*) >= CAST({serving_fixed.MIN_TAXI_ROWS} AS DOUBLE) AS passed
FROM raw_trips GROUP BY ingestion_month
UNION ALL
SELECT 'raw_weather_hourly' AS model, source_month AS month, COUNT(*) AS row_count,
       CAST(day(last_day(source_month)) * 24 * 5 AS DOUBLE) * CAST({serving_fixed.WEATHER_ROWS_FRACTION} AS DOUBLE) AS min_rows,
       COUNT(*) >= CAST(day(last_day(source_month)) * 24 * 5 AS DOUBLE) * CAST({serving_fixed.WEATHER_ROWS_FRACTION} AS DOUBLE) AS passed
FROM raw_weather GROUP BY source_month"""))
def dq_month_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per loaded month against the minimums."""
    wh = published(spark, sf_dir)
    return quality.month_row_counts(wh.raw_taxi_trips_yellow, wh.raw_weather_hourly)


# --- prototype notebook ---------------------------------------------------------------

def _proto(name: str, sql: str, rounded: tuple[str, ...] = ()):
    def deco(fn):
        def build(spark: SparkSession, sf_dir: str) -> DataFrame:
            return to_output(fn(spark, sf_dir), rounded)
        build.__name__ = name
        build.__doc__ = fn.__doc__
        rep = ", ".join(f"round({c}, {oracle.OUTPUT_DIGITS}) AS {c}" for c in rounded)
        full = f"SELECT * REPLACE ({rep}) FROM ({sql}) q" if rounded else sql
        register(name, oracle.with_models(full, oracle.PROTO_CTES))(build)
        return fn
    return deco


def _proto_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prototype.clean_trips(landed_trips(spark, sf_dir).drop("file_month"))


@_proto("proto_star_fact", """
SELECT trip_id, "VendorID", trip_id AS datetime_id, trip_id AS passenger_count_id,
       trip_id AS trip_distance_id, trip_id AS rate_code_id, store_and_fwd_flag,
       "PULocationID" AS pickup_location_id, "DOLocationID" AS dropoff_location_id, trip_id AS payment_type_id,
       fare_amount, extra, mta_tax, tip_amount, tolls_amount, improvement_surcharge, total_amount
FROM proto_trips WHERE "PULocationID" IS NOT NULL AND "DOLocationID" IS NOT NULL""")
def _n6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prototype star fact (cleaned trips, location surrogates)."""
    return prototype.star_fact(_proto_trips(spark, sf_dir))


_BUCKETS = 16  # at least
_LOCATIONS = ("pickup_location_id", "dropoff_location_id")


@_proto("proto_fact_merged", """
SELECT t.trip_id, "VendorID", t.trip_id AS datetime_id, t.trip_id AS passenger_count_id,
       t.trip_id AS trip_distance_id, t.trip_id AS rate_code_id, store_and_fwd_flag,
       "PULocationID" AS pickup_location_id, "DOLocationID" AS dropoff_location_id, t.trip_id AS payment_type_id,
       fare_amount, extra, mta_tax, tip_amount, tolls_amount, improvement_surcharge, total_amount
FROM proto_trips t WHERE "PULocationID" IN (SELECT DISTINCT "PULocationID" FROM proto_trips WHERE "VendorID" = 1) AND "DOLocationID" IS NOT NULL
  AND "RatecodeID" IS NOT NULL""")
def _n6b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The seven joins over written dimensions, of which two have lost rows."""
    root, buckets, name = _folder(spark, "prototype"), bucketed.width(spark, _BUCKETS), f"proto_{uuid.uuid4().hex}"
    cleaned = prototype.clean_trips_by_key(landed_trips(spark, sf_dir).drop("file_month"), buckets)
    trips = bucketed.write(cleaned, f"{name}_trips", f"{root}/trips", "trip_id", buckets)
    kept = {"pickup_location": prototype.location_dim(trips.where("VendorID = 1"), "PULocationID", "pickup_location_id"),
            "rate_code": prototype.rate_code_dim(trips.where("RatecodeID is not null"))}
    dims = {}
    for dim, rows in prototype.dimensions(trips).items():
        rows, path = kept.get(dim, rows), f"{root}/{dim}"
        if prototype.PROTO_DIMENSIONS[dim] in _LOCATIONS:
            rows.write.options(**commits.ENCODING).parquet(path)
            dims[dim] = spark.read.parquet(path)
        else:
            dims[dim] = bucketed.write(rows, f"{name}_{dim}", path, prototype.PROTO_DIMENSIONS[dim], buckets)
    fact = prototype.merged_fact(trips, dims)
    per_trip = {"trip_id", *prototype.PROTO_DIMENSIONS.values()} - set(_LOCATIONS)
    return fact.select(*[F.lower(F.hex(c)).alias(c) if c in per_trip else c for c in fact.columns])


@_proto("proto_datetime_dim", """
SELECT trip_id AS datetime_id, tpep_pickup_datetime,
       CAST(hour(tpep_pickup_datetime) AS INTEGER) AS pick_hour, CAST(day(tpep_pickup_datetime) AS INTEGER) AS pick_day,
       CAST(month(tpep_pickup_datetime) AS INTEGER) AS pick_month, CAST(year(tpep_pickup_datetime) AS INTEGER) AS pick_year,
       CAST(isodow(tpep_pickup_datetime) - 1 AS INTEGER) AS pick_weekday,
       tpep_dropoff_datetime,
       CAST(hour(tpep_dropoff_datetime) AS INTEGER) AS drop_hour, CAST(day(tpep_dropoff_datetime) AS INTEGER) AS drop_day,
       CAST(month(tpep_dropoff_datetime) AS INTEGER) AS drop_month, CAST(year(tpep_dropoff_datetime) AS INTEGER) AS drop_year,
       CAST(isodow(tpep_dropoff_datetime) - 1 AS INTEGER) AS drop_weekday
FROM proto_trips""")
def _n3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prototype calendar parts per trip."""
    return prototype.datetime_dim(_proto_trips(spark, sf_dir))


_RATE = " ".join(f"WHEN {k} THEN '{v}'" for k, v in serving_fixed.RATE_CODE_NAMES.items())


@_proto("proto_rate_code_dim", f"""
SELECT trip_id AS rate_code_id, "RatecodeID",
       CASE "RatecodeID" {_RATE} ELSE '{serving_fixed.UNKNOWN_PAYMENT}' END AS rate_code_name
FROM proto_trips""")
def _n4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prototype rate-code dimension with names."""
    return prototype.rate_code_dim(_proto_trips(spark, sf_dir))


_PAYMENT = " ".join(f"WHEN {k} THEN '{v}'" for k, v in serving_fixed.PAYMENT_TYPE_NAMES.items())


@_proto("proto_payment_type_dim", f"""
SELECT trip_id AS payment_type_id, payment_type,
       CASE payment_type {_PAYMENT} ELSE '{serving_fixed.UNKNOWN_PAYMENT}' END AS payment_type_name
FROM proto_trips""")
def _n4b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prototype payment-type dimension with names."""
    return prototype.payment_type_dim(_proto_trips(spark, sf_dir))


@_proto("proto_passenger_count_dim", "SELECT trip_id AS passenger_count_id, passenger_count FROM proto_trips")
def _n4c(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prototype passenger-count dimension."""
    return prototype.passenger_count_dim(_proto_trips(spark, sf_dir))


@_proto("proto_trip_distance_dim", "SELECT trip_id AS trip_distance_id, trip_distance FROM proto_trips")
def _n4d(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prototype trip-distance dimension."""
    return prototype.trip_distance_dim(_proto_trips(spark, sf_dir))


@_proto("proto_pickup_location_dim", 'SELECT DISTINCT "PULocationID" AS pickup_location_id, "PULocationID" FROM proto_trips')
def _n5a(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prototype pickup locations."""
    return prototype.location_dim(_proto_trips(spark, sf_dir), "PULocationID", "pickup_location_id")


@_proto("proto_dropoff_location_dim", 'SELECT DISTINCT "DOLocationID" AS dropoff_location_id, "DOLocationID" FROM proto_trips')
def _n5b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prototype dropoff locations."""
    return prototype.location_dim(_proto_trips(spark, sf_dir), "DOLocationID", "dropoff_location_id")


@_proto("proto_date_bounds", "SELECT MIN(CAST(tpep_pickup_datetime AS DATE)) AS start_date, MAX(CAST(tpep_pickup_datetime AS DATE)) AS end_date FROM proto_trips")
def _a11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First and last pickup date."""
    return prototype.pickup_date_bounds(_proto_trips(spark, sf_dir))


def _proto_trip_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = _proto_trips(spark, sf_dir)
    weather = prototype.weather_frame(feeds.raw_weather(spark, sf_dir))
    return prototype.trip_weather(trips, feeds.landed_zones(spark, sf_dir), weather)


@_proto("proto_trip_weather", "SELECT * REPLACE (CAST(temperature_2m AS DOUBLE) AS temperature_2m, "
                              "CAST(precipitation_mm AS DOUBLE) AS precipitation_mm) FROM proto_trip_weather")
def _n8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips with pickup zone and pickup-hour weather (left joins)."""
    return _proto_trip_weather(spark, sf_dir)


@_proto("proto_weather_hourly_mart", """
SELECT pickup_hour, borough, weather_severity, COUNT(trip_id) AS trip_count,
       AVG(fare_amount) AS avg_fare, AVG(total_amount) AS avg_total_amount,
       AVG(trip_duration_min) AS avg_duration_min, AVG(trip_distance) AS avg_distance,
       AVG(fare_per_mile) AS avg_fare_per_mile,
       CAST(SUM(precipitation_mm) AS DOUBLE) / CAST(COUNT(precipitation_mm) AS DOUBLE) AS avg_precipitation,
       CAST(SUM(temperature_2m) AS DOUBLE) / CAST(COUNT(temperature_2m) AS DOUBLE) AS avg_temp
FROM proto_trip_weather GROUP BY pickup_hour, borough, weather_severity""",
        ("avg_fare", "avg_total_amount", "avg_duration_min", "avg_distance", "avg_fare_per_mile"))
def _n9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prototype weather-hourly mart (NULL groups kept)."""
    return prototype.weather_hourly_mart(_proto_trip_weather(spark, sf_dir))


_DOC_WEATHER = "SELECT * REPLACE (" + ", ".join(f"CAST({m} AS DOUBLE) AS {m}" for m in oracle.WMEAS) + f") FROM ({oracle.WEATHER_DOC_SQL}) w"


@register("norm_weather_inline", oracle.with_models(_DOC_WEATHER))
def norm_weather_inline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather documents of all months (parallel hourly arrays) -> raw weather rows."""
    docs = feeds.landed_weather_documents(spark, sf_dir)
    return to_output(normalize.raw_weather_from_documents(docs, F.col("requested_month"), feeds.RUN_TS))


@register("norm_weather_month", oracle.with_models(
    f"SELECT * FROM ({_DOC_WEATHER}) m WHERE source_month = DATE '{feeds.MONTHS[1]}-01'"))
def norm_weather_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of one month; the month is the argument, the documents do not say it."""
    docs = feeds.month_documents(spark, sf_dir, feeds.MONTHS[1]).drop("requested_month")
    return to_output(normalize.raw_weather_from_documents(docs, feeds.MONTHS[1], feeds.RUN_TS))


# --- load path: files under the shared folder -------------------------------------------

def _folder(spark: SparkSession, name: str) -> str:
    return removed_at_exit(spark, f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4()}")


@register("src_trip_parquet", oracle.with_models("SELECT * EXCLUDE (file_month) FROM landed_trips"))
def src_trip_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three landed trip months, read back together by name."""
    root = _folder(spark, "trips")
    for month in feeds.MONTHS:
        writers.land_trip_month(feeds.landed_month(spark, sf_dir, month), root, month)
    return landed_files.read_trip_months(spark, root, list(feeds.MONTHS)).drop("source_file")


@register("src_trip_schemas", oracle.with_models("SELECT * EXCLUDE (file_month) FROM landed_trips"))
def src_trip_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trips in 120 monthly files of three schemas (a spelling, a missing column, another type), read back in three scans."""
    root = _folder(spark, "many-months")
    number = F.pmod(F.timestamp_diff("MINUTE", feeds.ntz(feeds.START), F.col("tpep_pickup_datetime")), F.lit(120))
    trips = landed_trips(spark, sf_dir).drop("file_month").withColumn("n", number)
    forms = (trips, trips.withColumnRenamed("Airport_fee", "airport_fee").drop("cbd_congestion_fee"),
             trips.withColumn("payment_type", F.col("payment_type").cast("int")))
    for i, form in enumerate(forms):
        (form.where(F.col("n") % len(forms) == i)
             .withColumn("year", F.format_string("%04d", F.lit(2010) + F.floor(F.col("n") / 12)))
             .withColumn("month", F.format_string("%02d", F.col("n") % 12 + 1))
             .drop("n").write.mode("append").partitionBy("year", "month").parquet(f"{root}/taxi/yellow"))
    months = [f"{2010 + n // 12}-{n % 12 + 1:02d}" for n in range(120)]
    there = {p.rsplit("/", 2)[1][5:] + "-" + p[-2:] for p in commits.children(spark, f"{root}/taxi/yellow/year=*/month=*")}
    both = landed_files.read_trip_months(spark, root, [m for m in months if m in there])
    return both.withColumn("payment_type", F.col("payment_type").cast("bigint")).drop("source_file")


@register("src_weather_json", oracle.with_models(f"SELECT * EXCLUDE (source_file) FROM ({_DOC_WEATHER}) m"))
def src_weather_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three months of multi-line JSON documents, read back and normalised."""
    root, out = _folder(spark, "weather"), None
    for month in feeds.MONTHS:
        writers.land_weather_documents(feeds.month_documents(spark, sf_dir, month), root, month, multi_line=True)
        rows = normalize.raw_weather_from_documents(landed_files.read_weather_documents(spark, root, month), month, feeds.RUN_TS)
        out = rows if out is None else out.unionByName(rows)
    return to_output(out).drop("source_file")


@register("src_zone_csv", oracle.with_models("SELECT location_id, borough, zone, service_zone FROM raw_zone"))
def src_zone_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3/K3: the zone lookup as CSV, read back."""
    root = _folder(spark, "zones")
    writers.land_zone_lookup(feeds.landed_zones(spark, sf_dir), root)
    zones = normalize.raw_zones(landed_files.read_zone_lookup(spark, root), feeds.ZONE_FILE, feeds.RUN_TS)
    return zones.select("location_id", "borough", "zone", "service_zone")


def _monthly_trips(spark: SparkSession, sf_dir: str, month: str) -> DataFrame:
    return normalize.raw_trips(feeds.landed_month(spark, sf_dir, month), month, feeds.trip_file(F.lit(month)), feeds.RUN_TS)


@register("sink_month_replace", oracle.with_models(
    f"SELECT record_hash, ingestion_month FROM raw_trips WHERE ingestion_month <> DATE '{feeds.MONTHS[1]}-01' OR vendor_id = 1",
    replaced=oracle.LOADED))
def sink_month_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4: three months loaded, the second replaced by the trips of one vendor, read back."""
    root, name = _folder(spark, "raw"), "raw_taxi_trips_yellow"
    for month in feeds.MONTHS:
        writers.replace_month(_monthly_trips(spark, sf_dir, month), root, name, "ingestion_month", month)
    again = _monthly_trips(spark, sf_dir, feeds.MONTHS[1]).where("vendor_id = 1")
    after = writers.replace_month(again, root, name, "ingestion_month", feeds.MONTHS[1])
    return after.read(spark, name).select("record_hash", "ingestion_month")


@register("sink_csv_export", oracle.with_models("SELECT location_id, borough, zone, service_zone, is_nyc_borough FROM dim_location"))
def sink_csv_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K8: a dimension exported as CSV, read back."""
    path = _folder(spark, "export")
    dim = warehouse(spark, sf_dir).dim_location
    writers.export_csv(dim, path)
    return spark.read.schema(dim.schema).option("header", True).csv(path)


@register("dq_raw_extract", oracle.with_models(f"""
SELECT source_month, COUNT(DISTINCT borough) AS documents, COUNT(*) AS weather_rows,
       CAST((COUNT(DISTINCT borough) <> {serving_fixed.WEATHER_FILES_PER_MONTH})::INTEGER
            + (COUNT(*) <= {serving_fixed.MIN_WEATHER_EXTRACT_ROWS})::INTEGER AS BIGINT) AS failures
FROM raw_weather GROUP BY source_month""", replaced=oracle.LOADED))
def dq_raw_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q10-Q12: schema and counts of each month's extract."""
    out = None
    for month in feeds.MONTHS:
        docs = feeds.month_documents(spark, sf_dir, month)
        weather = normalize.raw_weather_from_documents(docs, month, feeds.RUN_TS)
        found = docs.count()
        errors = quality.raw_extract_checks(_monthly_trips(spark, sf_dir, month), weather, found)
        row = weather.agg(F.lit(f"{month}-01").cast("date").alias("source_month"), F.lit(found).cast("bigint").alias("documents"),
                          F.count(F.lit(1)).alias("weather_rows"), F.lit(len(errors)).cast("bigint").alias("failures"))
        out = row if out is None else out.unionByName(row)
    return out


@register("dq_load_constraints", oracle.with_models("""
SELECT 'raw_taxi_zone_lookup' AS model, 'location_id' AS column_name, COUNT(*) AS failures FROM raw_zone WHERE location_id % 5 = 0
UNION ALL SELECT 'raw_taxi_zone_lookup', 'zone', COUNT(*) FROM raw_zone WHERE location_id % 5 = 0"""))
def dq_load_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6: constraint violations of a zone table in which every fifth zone is there twice, once without its name."""
    zones = raw_tables(spark, sf_dir).zones
    twice = zones.unionByName(zones.where("location_id % 5 = 0").withColumn("zone", F.lit(None).cast("string")))
    found = quality.constraint_counts(twice, schemas.RAW_ZONE, "location_id")
    return spark.createDataFrame([("raw_taxi_zone_lookup", c, n) for c, n in found.items() if n], "model string, column_name string, failures bigint")


def _landed(spark: SparkSession, sf_dir: str, months: tuple[str, ...] = feeds.MONTHS) -> str:
    """The feed's months as landed files."""
    landing = _folder(spark, "landing")
    writers.land_zone_lookup(feeds.landed_zones(spark, sf_dir), landing)
    writers.land_trip_months(landed_trips(spark, sf_dir), landing, "file_month", months)  # one join of the given tables
    for month in months:
        writers.land_weather_documents(feeds.month_documents(spark, sf_dir, month), landing, month)
    return landing


def _loaded(spark: SparkSession, sf_dir: str, months: tuple[str, ...] = feeds.MONTHS) -> tuple[str, str, dict[str, RawTables]]:
    """Landing root, a warehouse with the feed's months loaded, and the raw rows of each load."""
    landing, root = _landed(spark, sf_dir, months), _folder(spark, "warehouse")
    raw = {m: job.normalize_month(spark, landing, f"{landing}/staged-{m}", m, feeds.RUN_TS, weather_multi_line=False).raw for m in months}
    for month in months:
        job.load_month(spark, raw[month], root, month)
    return landing, root, raw


def _smaller(raw: RawTables) -> RawTables:
    """Another delivery of a month: one vendor's trips, four boroughs' weather, zones without the airport."""
    return RawTables(trips=raw.trips.where("vendor_id = 1"), weather=raw.weather.where("borough <> 'Bronx'"), zones=raw.zones.where("borough <> 'EWR'"))


class _Lost(RuntimeError):
    """A driver that ends at a step."""


def _lost_at(wanted: str) -> job.Progress:
    def progress(step: str) -> None:
        if step == wanted:
            raise _Lost(step)
    return progress


def _broken(run, wanted: str) -> None:
    try:
        run(_lost_at(wanted))
    except _Lost:
        return
    raise AssertionError(f"no step {wanted}")


_LOAD_STEPS = (*job.RAW_TABLES.values(), key_filters.TABLE, "committed")
_SECOND = f"DATE '{feeds.MONTHS[1]}-01'"


@register("sink_commit_recovery", oracle.with_models(f"""
SELECT s.step AS broken_after, m.month,
       (SELECT COUNT(*) FROM raw_trips t WHERE t.ingestion_month = m.month AND (m.month <> {_SECOND} OR s.step <> 'committed' OR t.vendor_id = 1)) AS trip_rows,
       (SELECT COUNT(*) FROM raw_weather w WHERE w.source_month = m.month AND (m.month <> {_SECOND} OR s.step <> 'committed' OR w.borough <> 'Bronx')) AS weather_rows,
       (SELECT COUNT(*) FROM raw_zone z WHERE s.step <> 'committed' OR z.borough <> 'EWR') AS zone_rows
FROM (SELECT unnest([{', '.join(f"'{x}'" for x in _LOAD_STEPS)}]) AS step) s
CROSS JOIN (SELECT DISTINCT ingestion_month AS month FROM raw_trips) m""", replaced=oracle.LOADED))
def sink_commit_recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4/K5/L3: three months loaded, then a smaller delivery of the second, broken after each step; what readers
    see of trips, weather and zones: all of the old load before the commit, all of the new one behind it."""
    _, root, raw = _loaded(spark, sf_dir)
    again, out = _smaller(raw[feeds.MONTHS[1]]), None
    for step in _LOAD_STEPS:
        _broken(lambda progress: job.load_month(spark, again, root, feeds.MONTHS[1], progress), step)
        seen = job.read_raw(spark, root)
        trips = seen.trips.groupBy(F.col("ingestion_month").alias("month")).agg(F.count(F.lit(1)).alias("trip_rows"))
        weather = seen.weather.groupBy(F.col("source_month").alias("month")).agg(F.count(F.lit(1)).alias("weather_rows"))
        zones = seen.zones.agg(F.count(F.lit(1)).alias("zone_rows"))  # one row
        row = trips.join(weather, "month").crossJoin(zones).select(F.lit(step).alias("broken_after"), "month", "trip_rows", "weather_rows", "zone_rows")
        out = row if out is None else out.unionByName(row)
    return out


@register("dq_keys_in_other_months", oracle.with_models(f"""
SELECT ingestion_month, record_hash FROM raw_trips o
WHERE ingestion_month <> {_SECOND} AND record_hash IN (
  SELECT record_hash FROM raw_trips WHERE ingestion_month = {_SECOND}
  UNION ALL SELECT record_hash FROM raw_trips WHERE ingestion_month = DATE '{feeds.MONTHS[0]}-01' AND payment_type = 1)""", replaced=oracle.LOADED))
def dq_keys_in_other_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4: keys of a delivery of the second month, into which trips of the first have got, that other months have."""
    _, root, raw = _loaded(spark, sf_dir)
    first, month = raw[feeds.MONTHS[0]].trips, feeds.MONTHS[1]
    mixed = raw[month].trips.unionByName(first.where("payment_type = 1").withColumn("ingestion_month", F.lit(f"{month}-01").cast("date")))
    state = commits.latest(spark, root)
    return key_filters.repeated_keys(mixed, state.read(spark, "raw_taxi_trips_yellow"), state.read(spark, key_filters.TABLE), month)


@register("dq_bucketed_keys", oracle.with_models(f"""
SELECT 'repeated' AS finding, record_hash, COUNT(*) AS rows FROM raw_trips GROUP BY record_hash HAVING COUNT(*) > 1
UNION ALL SELECT 'known', record_hash, 1 FROM raw_trips WHERE ingestion_month = {_SECOND} AND vendor_id = 1""", replaced=oracle.LOADED))
def dq_bucketed_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loaded trips bucketed by key; keys that are there twice, and keys of another delivery that are there already."""
    root, buckets = _folder(spark, "bucketed"), bucketed.width(spark, _BUCKETS)
    landed = landed_trips(spark, sf_dir).where(F.col("file_month").isin(*feeds.MONTHS))
    raw = normalize.raw_trips_by_key(landed, *_file_columns(), buckets)
    name = f"trips_{uuid.uuid4().hex}"
    trips = bucketed.write(raw, name, f"{root}/trips", "record_hash", buckets)
    again = bucketed.write(trips.where(f"ingestion_month = {_SECOND} and vendor_id = 1"), f"{name}_new", f"{root}/new", "record_hash", buckets)
    text = F.lower(F.hex("record_hash")).alias("record_hash")
    twice = bucketed.repeated(trips, "record_hash").select(F.lit("repeated").alias("finding"), text, "rows")
    known = bucketed.known_keys(again, trips, "record_hash").select(F.lit("known").alias("finding"), text, F.lit(1).cast("bigint").alias("rows"))
    return twice.unionByName(known)


_REQUIRED = ", ".join(f"'{c}'" for c in serving_fixed.REQUIRED_TAXI_COLUMNS)


@register("dq_rejected_inputs", oracle.with_models(f"""
SELECT 'trips' AS feed, c AS finding, (SELECT COUNT(*) FROM landed_trips) AS rows FROM (SELECT unnest([{_REQUIRED}]) AS c)
UNION ALL SELECT 'weather', strftime(source_month, '%Y-%m') || ' weather document of ' || borough || CASE borough WHEN 'Bronx' THEN ': its arrays differ in length' ELSE ' has no hours' END,
       CASE borough WHEN 'Bronx' THEN COUNT(*) ELSE 0 END FROM raw_weather WHERE borough IN ('Bronx', 'Queens') GROUP BY source_month, borough""", replaced=oracle.LOADED))
def dq_rejected_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feeds that a load must refuse: trips without each of the required columns, documents of two
    boroughs with a ragged and with empty arrays; what is refused, and how many rows it has."""
    trips = landed_trips(spark, sf_dir).drop("file_month")
    found = []
    for source, name in serving_fixed.TAXI_COLUMN_RENAME_MAP.items():
        if name in serving_fixed.REQUIRED_TAXI_COLUMNS:
            try:
                normalize.normalize_trips(trips.drop(source), feeds.MONTHS[0], F.lit("landed"), feeds.RUN_TS)
            except normalize.SchemaError as refused:
                if f"[{name!r}]" in str(refused):
                    found.append(name)
    refused = trips.agg(F.count(F.lit(1)).alias("rows")).select(F.lit("trips").alias("feed"), F.explode(F.lit(found)).alias("finding"), "rows")
    docs = feeds.landed_weather_documents(spark, sf_dir)
    h, empty = F.col("hourly"), F.array().cast("array<string>")
    planted = docs.withColumn("hourly", F.when(F.col("requested_borough") == "Bronx", h.withField("rain", F.slice(h["rain"], 2, 10_000)))
                              .when(F.col("requested_borough") == "Queens", h.withField("time", empty)).otherwise(h))
    bad = normalize.rejected_documents(planted)
    return refused.unionByName(bad.select(F.lit("weather").alias("feed"), F.concat("requested_month", F.lit(" "), "problem").alias("finding"),
                                          F.size("hourly.time").cast("bigint").alias("rows")))


@register("job_month_marts", oracle.with_models(oracle.model_select("fct_hourly_demand"), replaced=oracle.LOADED))
def job_month_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1-L3: three months landed, loaded month by month, marts built and published; the hourly mart."""
    _, root, _ = _loaded(spark, sf_dir)
    job.build_marts(spark, root)
    return to_output(job.read_mart(spark, root, "fct_hourly_demand").drop(job.PICKUP_MONTH))


_RELOADED = {"raw_trips": f"SELECT * FROM ({oracle.MONTHLY_TRIPS_SQL}) t WHERE ingestion_month <> DATE '{feeds.MONTHS[2]}-01' OR vendor_id = 1",
             "raw_weather": f"SELECT * FROM ({oracle.WEATHER_DOC_SQL}) w WHERE source_month <> DATE '{feeds.MONTHS[2]}-01' OR borough <> 'Bronx'",
             "raw_zone": f"SELECT * FROM ({dict(oracle.CTES)['raw_zone']}) z WHERE borough <> 'EWR'"}


@register("job_incremental_marts", oracle.with_models(oracle.model_select("fct_weather_impact"), replaced=_RELOADED))
def job_incremental_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7: marts of three months built, a smaller delivery of the third loaded, the months it touches rebuilt;
    the weather mart, which must be that of a full refresh."""
    _, root, raw = _loaded(spark, sf_dir)
    job.build_marts(spark, root)
    month = feeds.MONTHS[2]
    job.load_month(spark, _smaller(raw[month]), root, month)
    job.rebuild_months(spark, root, set(feeds.MONTHS))  # the zones changed, so every month is touched
    return to_output(job.read_mart(spark, root, "fct_weather_impact").drop(job.PICKUP_MONTH))


def _gate_sql(month: str) -> str:
    span = f"{{0}} >= DATE '{month}-01' AND {{0}} < DATE '{month}-01' + INTERVAL 1 MONTH"
    return f"""
SELECT '{month}' AS month, (SELECT COUNT(*) FROM raw_trips WHERE ingestion_month = DATE '{month}-01') AS taxi_rows,
       (SELECT COUNT(*) FROM raw_weather WHERE source_month = DATE '{month}-01') AS weather_rows,
       (SELECT CAST(COUNT(*) FILTER (WHERE weather_key <> 'unknown') AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) FROM fct_taxi_trips WHERE {span.format('pickup_ts_local')}) AS weather_join_coverage,
       CAST((SELECT COUNT(*) FROM fct_taxi_trips WHERE {span.format('pickup_ts_local')}) - (SELECT SUM(trip_count) FROM fct_hourly_demand WHERE {span.format('pickup_hour')}) AS BIGINT) AS gap"""


@register("job_month_gates", oracle.with_models(" UNION ALL ".join(map(_gate_sql, feeds.MONTHS)), replaced=oracle.LOADED))
def job_month_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L4, Q13-Q16: the gate figures of three loaded months, counted while the tables were written where they were written for the month."""
    _, root, _ = _loaded(spark, sf_dir)
    rows = []
    for month in feeds.MONTHS:
        job.build_marts(spark, root, month=month)
        rows.append((month, *job.month_figures(commits.latest(spark, root), month)))
    return spark.createDataFrame(rows, "month string, taxi_rows bigint, weather_rows bigint, weather_join_coverage double, gap bigint")


@register("job_restart", oracle.with_models(oracle.model_select("fct_weather_impact"), replaced=oracle.LOADED))
def job_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1: three months, the last by a run that loses its driver after each step and is started again; the weather mart."""
    landing, root = _landed(spark, sf_dir), _folder(spark, "warehouse")
    for month in feeds.MONTHS[:2]:
        job.load_month(spark, job.normalize_month(spark, landing, f"{landing}/staged-{month}", month, feeds.RUN_TS, weather_multi_line=False).raw, root, month)
    month = feeds.MONTHS[2]

    def run(progress: job.Progress) -> None:
        job.run_month(spark, landing, root, month, weather_multi_line=False, fail=False, ingested_at=feeds.RUN_TS, progress=progress)

    for step in job.STEPS:
        _broken(run, step)
    run(job.no_progress)
    return to_output(job.read_mart(spark, root, "fct_weather_impact").drop(job.PICKUP_MONTH))


def queries() -> dict[str, Builder]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
