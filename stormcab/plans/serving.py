"""Serving queries: the analysis SQL, the dashboard measures and visuals.

All of them read the aggregated facts (a few rows per hour and zone), not the
trip fact, as the dashboard guidance asks.  Dimensions join those aggregates
with plain joins: both sides are small, and AQE broadcasts whichever side its
measured shuffle size puts under the broadcast threshold (a sort-merge join
otherwise), without an extra counting job.  One-row measure results are
combined with cross joins of one-row frames only.  Every function accepts
optional `Slicers` (the dashboard filters); the registered queries use none,
i.e. whole tables.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed


@dataclass(frozen=True)
class Slicers:
    """Dashboard filters; None means unfiltered."""
    date_from: str | None = None          # inclusive, 'YYYY-MM-DD'
    date_to: str | None = None            # inclusive, 'YYYY-MM-DD'
    boroughs: tuple[str, ...] | None = None
    severities: tuple[str, ...] | None = None
    payment_types: tuple[str, ...] | None = None
    hours_of_day: tuple[int, ...] | None = None
    weather_groups: tuple[str, ...] | None = None


NO_SLICERS = Slicers()
PICKUP_MONTH = "pickup_month"


def apply_slicers(fact: DataFrame, s: Slicers, dim_weather: DataFrame | None = None) -> DataFrame:
    """Filter a fact by the slicers (pushed to the scan).

    A slicer that the fact has no column for is an error: a measure must not
    mix filtered and unfiltered numbers.  The weather group comes from `dim_weather`."""
    cols = set(fact.columns)
    hour = F.col("pickup_hour") if "pickup_hour" in cols else None
    day = F.col("pickup_date") if "pickup_date" in cols else F.col("pickup_hour").cast("date")

    def need(ok: bool, what: str) -> None:
        if not ok:
            raise ValueError(f"the {what} slicer does not apply to a fact with columns {sorted(cols)}")

    month = F.col(PICKUP_MONTH) if PICKUP_MONTH in cols else None  # partition of a written mart: leaves out whole folders
    if s.date_from:
        first = F.lit(s.date_from).cast("date")
        fact = fact.filter(day >= first) if month is None else fact.filter((month >= F.trunc(first, "MM")) & (day >= first))
    if s.date_to:
        last = F.lit(s.date_to).cast("date")
        fact = fact.filter(day <= last) if month is None else fact.filter((month <= last) & (day <= last))
    if s.boroughs is not None:
        fact = fact.filter(F.col("pickup_borough" if "pickup_borough" in cols else "borough").isin(*s.boroughs))
    if s.severities is not None:
        need("weather_severity" in cols, "weather severity")
        fact = fact.filter(F.col("weather_severity").isin(*s.severities))
    if s.payment_types is not None:
        need("payment_type_name" in cols, "payment type")
        fact = fact.filter(F.col("payment_type_name").isin(*s.payment_types))
    if s.hours_of_day is not None:
        need(hour is not None, "hour of day")
        fact = fact.filter(F.hour(hour).isin(*s.hours_of_day))
    if s.weather_groups is not None:
        need("weather_key" in cols and dim_weather is not None, "weather group")
        keys = dim_weather.filter(F.col("weather_group").isin(*s.weather_groups)).select("weather_key")
        fact = fact.join(keys, "weather_key", "left_semi")
    return fact


def _ratio(num: Column, den: Column) -> Column:
    """DIVIDE(num, den): NULL when den is 0 or NULL."""
    return F.try_divide(num.cast("double"), den.cast("double"))


# --- analysis queries ------------------------------------------------------------

def hourly_weather_demand(impact: DataFrame, s: Slicers = NO_SLICERS, dim_weather: DataFrame | None = None) -> DataFrame:
    """V1: demand per hour, borough and severity (borough column, see README)."""
    f = apply_slicers(impact, s, dim_weather)
    return (f.select("pickup_hour", "borough", "weather_severity", "trip_count",
                     "avg_total_amount", "avg_trip_duration_min")
             .orderBy(F.col("pickup_hour").asc_nulls_last(), F.col("borough").asc_nulls_last(),
                      F.col("weather_severity").asc_nulls_last()))


def top_zone_revenue(revenue: DataFrame, dim_location: DataFrame, s: Slicers = NO_SLICERS, dim_weather: DataFrame | None = None,
                     n: int = fixed.TOP_REVENUE_ROWS) -> DataFrame:
    """The n revenue rows (day x zone x payment type) with most revenue."""
    f = apply_slicers(revenue, s, dim_weather)
    loc = dim_location.select("location_id", F.col("zone").alias("loc_zone"))
    j = f.join(loc, f.pickup_location_id == loc.location_id, "inner")
    return (j.orderBy(F.col("total_revenue_amount").desc_nulls_last(), F.col("fare_revenue_key").asc())
             .limit(n)
             .select(F.col("loc_zone").alias("pickup_zone"), "trip_count", "total_revenue_amount",
                     "avg_fare_amount"))


def borough_severity_volume(impact: DataFrame, s: Slicers = NO_SLICERS, dim_weather: DataFrame | None = None) -> DataFrame:
    """Trips by borough and known severity."""
    f = apply_slicers(impact, s, dim_weather).filter(F.col("weather_severity").isin(*fixed.SEVERITY_LEVELS))
    return (f.groupBy("borough", "weather_severity").agg(F.sum("trip_count").alias("trip_count"))
             .orderBy(F.col("borough").asc_nulls_last(), F.col("weather_severity").asc_nulls_last()))


# --- measures (one-row results) ----------------------------------------------------

def trip_count(hourly: DataFrame, s: Slicers = NO_SLICERS, dim_weather: DataFrame | None = None) -> DataFrame:
    """V4: Trip Count = SUM(hourly_demand.trip_count)."""
    return apply_slicers(hourly, s, dim_weather).agg(F.coalesce(F.sum("trip_count"), F.lit(0)).alias("trip_count"))


def revenue_measures(revenue: DataFrame, s: Slicers = NO_SLICERS, dim_weather: DataFrame | None = None) -> DataFrame:
    """V5/V6: Total Revenue, Gross Fare, Average Fare, Average Revenue Per Trip."""
    f = apply_slicers(revenue, s, dim_weather)
    a = f.agg(F.sum("total_revenue_amount").alias("tr"), F.sum("gross_fare_amount").alias("gf"),
              F.sum("trip_count").alias("n"))
    return a.select(F.col("tr").cast("double").alias("total_revenue"),
                    F.col("gf").cast("double").alias("gross_fare"),
                    _ratio(F.col("gf"), F.col("n")).alias("average_fare"),
                    _ratio(F.col("tr"), F.col("n")).alias("average_revenue_per_trip"))


def unweighted_averages(hourly: DataFrame, impact: DataFrame, s: Slicers = NO_SLICERS, dim_weather: DataFrame | None = None) -> DataFrame:
    """V7/V8/V9: means of the facts' group means (unweighted, as the measures define)."""
    h = apply_slicers(hourly, s, dim_weather).agg(
        F.avg("avg_trip_distance").alias("average_trip_distance"),
        F.avg("avg_trip_duration_min").alias("average_trip_duration_min"))
    i = apply_slicers(impact, s, dim_weather).agg(
        F.coalesce(F.sum("rush_hour_trip_count"), F.lit(0)).alias("rush_hour_trip_count"),
        F.avg("avg_precipitation_mm").alias("average_precipitation"),
        F.avg("avg_temperature_2m").alias("average_temperature"))
    return h.crossJoin(i)


def rain_snow_share(hourly: DataFrame, dim_weather: DataFrame, s: Slicers = NO_SLICERS) -> DataFrame:
    """Share of trips in rain / snow weather groups (total stays unfiltered)."""
    f = apply_slicers(hourly, s, dim_weather)
    dw = dim_weather.select("weather_key", "weather_group")
    j = f.join(dw, "weather_key", "left")
    a = j.agg(F.coalesce(F.sum(F.when(F.col("weather_group") == "rain", F.col("trip_count"))), F.lit(0)).alias("rain_trip_count"),
              F.coalesce(F.sum(F.when(F.col("weather_group") == "snow", F.col("trip_count"))), F.lit(0)).alias("snow_trip_count"),
              F.coalesce(F.sum("trip_count"), F.lit(0)).alias("trip_count"))
    return a.select("*", _ratio(F.col("rain_trip_count"), F.col("trip_count")).alias("rain_trip_share"),
                    _ratio(F.col("snow_trip_count"), F.col("trip_count")).alias("snow_trip_share"))


def peak_offpeak(hourly: DataFrame, dim_date_time: DataFrame, s: Slicers = NO_SLICERS, dim_weather: DataFrame | None = None) -> DataFrame:
    """Peak-hour trips (via the calendar's hour_of_day) and the rest."""
    f = apply_slicers(hourly, s, dim_weather)
    cal = dim_date_time.select("date_hour_key", "hour_of_day")
    j = f.join(cal, "date_hour_key", "left")
    a = j.agg(F.coalesce(F.sum(F.when(F.col("hour_of_day").isin(*fixed.RUSH_HOURS), F.col("trip_count"))),
                         F.lit(0)).alias("peak_trip_count"),
              F.coalesce(F.sum("trip_count"), F.lit(0)).alias("trip_count"))
    return a.select("peak_trip_count", (F.col("trip_count") - F.col("peak_trip_count")).alias("off_peak_trip_count"),
                    "trip_count")


def kpi_row(hourly: DataFrame, revenue: DataFrame, impact: DataFrame, dim_weather: DataFrame,
            s: Slicers = NO_SLICERS) -> DataFrame:
    """The KPI cards as one row (cross join of one-row measures)."""
    t = trip_count(hourly, s, dim_weather)
    r = revenue_measures(revenue, s, dim_weather).select("total_revenue", "average_fare")
    u = unweighted_averages(hourly, impact, s, dim_weather).select("average_trip_duration_min", "average_precipitation")
    share = rain_snow_share(hourly, dim_weather, s).select("rain_trip_share")
    return t.crossJoin(r).crossJoin(u).crossJoin(share)


# --- dashboard visuals -----------------------------------------------------------

def hourly_trip_line(hourly: DataFrame, dim_date_time: DataFrame, s: Slicers = NO_SLICERS, dim_weather: DataFrame | None = None) -> DataFrame:
    """Trips by calendar hour."""
    f = apply_slicers(hourly, s, dim_weather)
    cal = dim_date_time.select("date_hour_key", "hour_ts")
    return (f.join(cal, "date_hour_key", "inner").groupBy("hour_ts")
             .agg(F.sum("trip_count").alias("trip_count")).orderBy("hour_ts"))


HOURS = list(range(24))


def weekday_hour_matrix(hourly: DataFrame, dim_date_time: DataFrame, s: Slicers = NO_SLICERS, dim_weather: DataFrame | None = None) -> DataFrame:
    """Weekday x hour-of-day matrix of trips (pivot on the 24 fixed hours)."""
    f = apply_slicers(hourly, s, dim_weather)
    cal = dim_date_time.select("date_hour_key", "iso_weekday_number", "weekday_name", "hour_of_day")
    p = (f.join(cal, "date_hour_key", "inner")
          .groupBy("iso_weekday_number", "weekday_name").pivot("hour_of_day", HOURS)
          .agg(F.sum("trip_count")))
    return p.select("iso_weekday_number", "weekday_name",
                    *[F.col(str(h)).alias(f"h{h:02d}") for h in HOURS]).orderBy("iso_weekday_number")


def _by_zone(fact: DataFrame, dim_location: DataFrame, measure: Column, name: str) -> DataFrame:
    loc = dim_location.select("location_id", "borough", "zone")
    g = fact.groupBy("pickup_location_id").agg(measure.alias(name))
    return g.join(loc, g.pickup_location_id == loc.location_id, "inner").drop("pickup_location_id")


def top_zones_by_trips(hourly: DataFrame, dim_location: DataFrame, s: Slicers = NO_SLICERS, dim_weather: DataFrame | None = None,
                       n: int = fixed.TOP_ZONES) -> DataFrame:
    """Top n pickup zones by trips."""
    z = _by_zone(apply_slicers(hourly, s, dim_weather), dim_location, F.sum("trip_count"), "trip_count")
    return (z.orderBy(F.col("trip_count").desc(), F.col("location_id").asc()).limit(n)
             .select("location_id", "zone", "trip_count"))


def top_zones_by_revenue(revenue: DataFrame, dim_location: DataFrame, s: Slicers = NO_SLICERS, dim_weather: DataFrame | None = None,
                         n: int = fixed.TOP_ZONES) -> DataFrame:
    """Top n pickup zones by total revenue."""
    z = _by_zone(apply_slicers(revenue, s, dim_weather), dim_location, F.sum("total_revenue_amount"), "total_revenue")
    return (z.orderBy(F.col("total_revenue").desc(), F.col("location_id").asc()).limit(n)
             .select("location_id", "zone", F.col("total_revenue").cast("double").alias("total_revenue")))


def zone_map(hourly: DataFrame, dim_location: DataFrame, s: Slicers = NO_SLICERS, dim_weather: DataFrame | None = None) -> DataFrame:
    """Trips per borough and zone (map data)."""
    z = _by_zone(apply_slicers(hourly, s, dim_weather), dim_location, F.sum("trip_count"), "trip_count")
    return z.select("borough", "zone", "location_id", "trip_count")


def zone_table(hourly: DataFrame, revenue: DataFrame, dim_location: DataFrame, s: Slicers = NO_SLICERS, dim_weather: DataFrame | None = None) -> DataFrame:
    """Zone, trips, average fare, total revenue."""
    trips = apply_slicers(hourly, s, dim_weather).groupBy("pickup_location_id").agg(F.sum("trip_count").alias("trip_count"))
    rev = (apply_slicers(revenue, s, dim_weather).groupBy(F.col("pickup_location_id").alias("rev_location_id"))
           .agg(F.sum("gross_fare_amount").alias("gf"), F.sum("trip_count").alias("rn"),
                F.sum("total_revenue_amount").alias("tr")))
    loc = dim_location.select("location_id", "zone")
    j = (trips.join(rev, trips.pickup_location_id == rev.rev_location_id, "inner")
              .join(loc, F.col("pickup_location_id") == loc.location_id, "inner"))
    return j.select("location_id", "zone", "trip_count", _ratio(F.col("gf"), F.col("rn")).alias("average_fare"),
                    F.col("tr").cast("double").alias("total_revenue"))


def hourly_precip_trips(impact: DataFrame, s: Slicers = NO_SLICERS, dim_weather: DataFrame | None = None) -> DataFrame:
    """Trips with the average precipitation per hour."""
    return (apply_slicers(impact, s, dim_weather).groupBy("pickup_hour")
            .agg(F.sum("trip_count").alias("trip_count"),
                 F.avg("avg_precipitation_mm").alias("average_precipitation"))
            .orderBy("pickup_hour"))


def severity_profile(impact: DataFrame, s: Slicers = NO_SLICERS, dim_weather: DataFrame | None = None) -> DataFrame:
    """Trips and trip-weighted average fare per severity."""
    f = apply_slicers(impact, s, dim_weather)
    g = f.groupBy("weather_severity").agg(
        F.sum("trip_count").alias("trip_count"),
        F.sum(F.col("avg_fare_amount") * F.col("trip_count")).alias("_fare"))
    return g.select("weather_severity", "trip_count", _ratio(F.col("_fare"), F.col("trip_count")).alias("average_fare"))


def precip_scatter(impact: DataFrame, s: Slicers = NO_SLICERS, dim_weather: DataFrame | None = None) -> DataFrame:
    """Per borough and hour, average precipitation against trips."""
    return (apply_slicers(impact, s, dim_weather).groupBy("borough", "pickup_hour")
            .agg(F.avg("avg_precipitation_mm").alias("average_precipitation"),
                 F.sum("trip_count").alias("trip_count")))


def borough_severity_matrix(hourly: DataFrame, s: Slicers = NO_SLICERS, dim_weather: DataFrame | None = None) -> DataFrame:
    """Borough x severity with trips and the (unweighted) average duration."""
    return (apply_slicers(hourly, s, dim_weather).groupBy(F.col("pickup_borough").alias("borough"), "weather_severity")
            .agg(F.sum("trip_count").alias("trip_count"),
                 F.avg("avg_trip_duration_min").alias("average_trip_duration_min")))
