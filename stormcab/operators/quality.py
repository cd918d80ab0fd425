"""Data-quality operators.

Every check is a DataFrame of results computed on the executors; only the
final one-row-per-check summary (a few dozen rows) is collected by the
runner, which raises `QualityCheckError` with all failures at once.

Generic checks count failures the way the declarative test framework of the
original project does: NULL rows (not_null), distinct duplicated values
(unique, NULLs ignored), distinct values outside the list (accepted_values,
NULL passes) and child rows without a parent (relationships, NULL passes).
Per table, all not_null columns are counted in one scan.
"""

from __future__ import annotations

import calendar
from collections.abc import Callable, Collection
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fixed


class QualityCheckError(RuntimeError):
    """A quality gate failed; the message lists every failing check."""


# --- declared checks (fixed values: the original project's test declarations) ---

NOT_NULL: dict[str, tuple[str, ...]] = {
    "raw_taxi_trips_yellow": ("record_hash", "pickup_datetime", "dropoff_datetime"),
    "raw_weather_hourly": ("weather_record_id", "borough"),
    "raw_taxi_zone_lookup": ("location_id",),
    "stg_taxi_trips": ("trip_id", "pickup_ts_local", "dropoff_ts_local", "pickup_location_id",
                       "dropoff_location_id"),
    "stg_weather_hourly": ("weather_record_id", "borough", "weather_ts_hour"),
    "stg_locations": ("location_id", "zone"),
    "dim_date_time": ("date_hour_key",),
    "dim_location": ("location_id",),
    "dim_weather": ("weather_key",),
    "fct_taxi_trips": ("trip_id",),
    "fct_hourly_demand": ("hourly_demand_key",),
    "fct_fare_revenue": ("fare_revenue_key",),
    "fct_weather_impact": ("weather_impact_key",),
}

UNIQUE: tuple[tuple[str, str], ...] = (
    ("raw_taxi_trips_yellow", "record_hash"),
    ("raw_weather_hourly", "weather_record_id"),
    ("raw_taxi_zone_lookup", "location_id"),
    ("stg_taxi_trips", "trip_id"),
    ("stg_weather_hourly", "weather_record_id"),
    ("stg_locations", "location_id"),
    ("dim_date_time", "date_hour_key"),
    ("dim_location", "location_id"),
    ("dim_weather", "weather_key"),
    ("fct_taxi_trips", "trip_id"),
    ("fct_hourly_demand", "hourly_demand_key"),
    ("fct_fare_revenue", "fare_revenue_key"),
    ("fct_weather_impact", "weather_impact_key"),
)

ACCEPTED_VALUES: tuple[tuple[str, str, tuple[str, ...]], ...] = (
    ("stg_taxi_trips", "payment_type_name",
     ("Credit card", "Cash", "No charge", "Dispute", "Unknown", "Voided trip")),
    ("stg_weather_hourly", "borough", ("Manhattan", "Brooklyn", "Queens", "Bronx", "Staten Island")),
    ("stg_weather_hourly", "weather_severity", ("clear", "light", "moderate", "severe")),
    ("dim_weather", "weather_severity", ("clear", "light", "moderate", "severe", "unknown")),
)

RELATIONSHIPS: tuple[tuple[str, str, str, str], ...] = (
    ("stg_taxi_trips", "pickup_location_id", "stg_locations", "location_id"),
    ("stg_taxi_trips", "dropoff_location_id", "stg_locations", "location_id"),
    ("fct_taxi_trips", "date_hour_key", "dim_date_time", "date_hour_key"),
    ("fct_taxi_trips", "pickup_location_id", "dim_location", "location_id"),
    ("fct_taxi_trips", "dropoff_location_id", "dim_location", "location_id"),
    ("fct_taxi_trips", "weather_key", "dim_weather", "weather_key"),
)

# --- end of declared checks ----------------------------------------------------

Models = Callable[[str], DataFrame]


def _result(df: DataFrame, check: str, model: str, column: str, failures) -> DataFrame:
    return df.select(F.lit(check).alias("check_name"), F.lit(model).alias("model"),
                     F.lit(column).alias("column_name"), failures.cast("bigint").alias("failures"))


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def not_null_checks(models: Models, known: Collection[str] = ()) -> DataFrame:
    """Q1: NULL rows per declared column, one aggregate pass per model (but those `known`)."""
    frames = []
    for model, cols in NOT_NULL.items():
        if model in known:
            continue
        agg = models(model).agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
        frames += [_result(agg, "not_null", model, c, F.col(c)) for c in cols]
    return _union(frames)


def _short_key(df: DataFrame, column: str) -> list[Column]:
    """A text key as bytes, an MD5 in lower-case hexadecimal as its 16; equal just where the keys are (the flag keeps
    an MD5 apart from a text of the same bytes).  Keys of other types are taken as they are."""
    key = F.col(column)
    if df.schema[column].dataType != T.StringType():
        return [key.alias("key")]
    is_md5 = key.rlike("^[0-9a-f]{32}$") & (F.length(key) == 32)
    return [is_md5.alias("is_md5"), F.when(is_md5, F.unhex(key)).otherwise(key.cast("binary")).alias("key")]


def unique_failures(df: DataFrame, column: str) -> DataFrame:
    """Number of distinct non-NULL values that occur more than once (one row).

    The group-by runs a map-side partial count first, so even a value held by
    a third of all rows reaches the shuffle as one row per task; unique keys
    reach it in their shortest form.
    """
    keys = df.filter(F.col(column).isNotNull()).select(*_short_key(df, column))
    dup = keys.groupBy(*keys.columns).count().filter(F.col("count") > 1)
    return dup.agg(F.count(F.lit(1)).alias("n"))


def unique_checks(models: Models) -> DataFrame:
    """Q2."""
    return _union([_result(unique_failures(models(m), c), "unique", m, c, F.col("n")) for m, c in UNIQUE])


def _by_model(decls):
    grouped: dict[str, list] = {}
    for d in decls:
        grouped.setdefault(d[0], []).append(d[1:])
    return grouped


def accepted_values_checks(models: Models) -> DataFrame:
    """Q3-Q5: distinct values outside the accepted list (NULL passes).

    One pass per model: each row gives its bad values, grouped with combining
    before the shuffle.
    """
    frames = []
    for m, decls in _by_model(ACCEPTED_VALUES).items():
        bad = [F.when(~F.col(c).isin(*values), F.struct(F.lit(c).alias("c"), F.col(c).alias("v"))) for c, values in decls]
        found = (models(m).select(F.explode(F.array_compact(F.array(*bad))).alias("b")).groupBy("b").agg(F.lit(1).alias("one"))
                 .agg(*[F.count_if(F.col("b.c") == c).alias(f"n{i}") for i, (c, _) in enumerate(decls)]))
        frames += [_result(found, "accepted_values", m, c, F.col(f"n{i}")) for i, (c, _) in enumerate(decls)]
    return _union(frames)


def relationship_checks(models: Models) -> DataFrame:
    """Orphan child rows per declared relationship.

    The child's rows are first counted by foreign key (combined before the
    shuffle, so a key with a third of all rows is one row per task); the
    counts then meet the parent's distinct keys.
    """
    frames = []
    for m, c, parent, pc in RELATIONSHIPS:
        counts = models(m).filter(F.col(c).isNotNull()).groupBy(F.col(c).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
        keys = models(parent).select(F.col(pc).alias("_k")).distinct()
        orphans = counts.join(keys, "_k", "left_anti").agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n"))
        frames.append(_result(orphans, "relationships", m, c, F.col("n")))
    return _union(frames)


def out_of_range() -> Column:
    """Q7: is a fact row outside the valid ranges?"""
    pax = F.col("passenger_count")
    return ((F.col("trip_duration_min") <= 0) | (F.col("trip_distance") <= 0)
            | (F.col("fare_amount") < 0) | (F.col("total_amount") < 0) | (pax < 0) | (pax > 8))


def trip_range_violations(fct: DataFrame) -> DataFrame:
    """Q7: fact rows outside the valid ranges (empty = pass)."""
    return fct.filter(out_of_range())


def pickup_month(ts: str) -> Column:
    """First day of the month of a timestamp column."""
    return F.trunc(F.col(ts).cast("date"), "MM")


def weather_coverage(fct: DataFrame, min_coverage: float = fixed.MIN_WEATHER_JOIN_COVERAGE) -> DataFrame:
    """Share of trips with known weather, per pickup month."""
    g = fct.groupBy(pickup_month("pickup_ts_local").alias("pickup_month")).agg(
        F.count(F.lit(1)).alias("trip_count"),
        (F.count_if(F.col("weather_key") != fixed.UNKNOWN_WEATHER).cast("double")
         / F.count(F.lit(1)).cast("double")).alias("weather_join_coverage"))
    return g.select("*", F.lit(min_coverage).alias("min_coverage"),
                    (F.col("weather_join_coverage") >= min_coverage).alias("passed"))


def overall_weather_coverage(fct: DataFrame) -> DataFrame:
    """Q9: whole-table coverage in one row (0.0 on an empty table, which then fails)."""
    return fct.agg(F.coalesce(F.count_if(F.col("weather_key") != fixed.UNKNOWN_WEATHER).cast("double")
                              / F.nullif(F.count(F.lit(1)), F.lit(0)).cast("double"),
                              F.lit(0.0)).alias("weather_join_coverage"))


def coverage_total(fct: DataFrame, min_coverage: float = fixed.MIN_WEATHER_JOIN_COVERAGE) -> DataFrame:
    """Q9 as declared: whole-table coverage against the threshold."""
    return overall_weather_coverage(fct).select(
        "weather_join_coverage", F.lit(min_coverage).alias("min_coverage"),
        (F.col("weather_join_coverage") >= min_coverage).alias("passed"))


def hourly_consistency(fct: DataFrame, hourly: DataFrame) -> DataFrame:
    """Trips in the fact minus trips rolled up in the hourly mart, per month.

    Both sides are reduced to one row per month before they meet.
    """
    d = fct.groupBy(pickup_month("pickup_ts_local").alias("pickup_month")).agg(
        F.count(F.lit(1)).alias("detailed_trip_count"))
    a = hourly.groupBy(pickup_month("pickup_hour").alias("pickup_month")).agg(
        F.sum("trip_count").alias("aggregated_trip_count"))
    j = d.join(a, "pickup_month", "full_outer")
    dt = F.coalesce(F.col("detailed_trip_count"), F.lit(0))
    at = F.coalesce(F.col("aggregated_trip_count"), F.lit(0)).cast("bigint")
    return j.select("pickup_month", dt.alias("detailed_trip_count"), at.alias("aggregated_trip_count"),
                    (dt - at).alias("gap"))


def expected_weather_rows(month_col: Column) -> Column:
    """days in month x 24 hours x 5 boroughs."""
    return F.dayofmonth(F.last_day(month_col)) * 24 * len(fixed.NYC_BOROUGHS)


def month_row_counts(raw_trips: DataFrame, raw_weather: DataFrame,
                     min_taxi_rows: int = fixed.MIN_TAXI_ROWS,
                     weather_fraction: float = fixed.WEATHER_ROWS_FRACTION) -> DataFrame:
    """Rows per loaded month against their minimum."""
    t = raw_trips.groupBy(F.col("ingestion_month").alias("month")).agg(F.count(F.lit(1)).alias("row_count"))
    t = t.select(F.lit("raw_taxi_trips_yellow").alias("model"), "month", "row_count",
                 F.lit(float(min_taxi_rows)).alias("min_rows"))
    w = raw_weather.groupBy(F.col("source_month").alias("month")).agg(F.count(F.lit(1)).alias("row_count"))
    w = w.select(F.lit("raw_weather_hourly").alias("model"), "month", "row_count",
                 (expected_weather_rows(F.col("month")) * F.lit(weather_fraction)).cast("double").alias("min_rows"))
    u = t.unionByName(w)
    return u.select("*", (F.col("row_count") >= F.col("min_rows")).alias("passed"))


def generic_checks(models: Models, known: Collection[str] = ()) -> DataFrame:
    """All 46 declared generic checks as one result frame; without the not_null ones of models `known` from their writes."""
    return _union([not_null_checks(models, known), unique_checks(models), accepted_values_checks(models),
                   relationship_checks(models)])


# --- raw-file checks (schema and counts of a processed extract) ------------------

def raw_extract_checks(trips: DataFrame, weather: DataFrame, weather_files: int) -> list[str]:
    """Q10-Q12: required columns (plan only), five weather files, weather rows.

    Returns the list of failure messages.  Only the schema and two counts
    are needed; the trip extract is never read beyond its schema.
    """
    errors = []
    if weather_files != fixed.WEATHER_FILES_PER_MONTH:
        errors.append(f"weather documents: {weather_files} found, {fixed.WEATHER_FILES_PER_MONTH} required")
    if not set(fixed.REQUIRED_PROCESSED_TAXI_COLUMNS).issubset(trips.columns):
        errors.append(f"trip extract: columns {sorted(set(fixed.REQUIRED_PROCESSED_TAXI_COLUMNS) - set(trips.columns))} are missing")
    if not set(fixed.REQUIRED_PROCESSED_WEATHER_COLUMNS).issubset(weather.columns):
        errors.append(f"weather extract: columns {sorted(set(fixed.REQUIRED_PROCESSED_WEATHER_COLUMNS) - set(weather.columns))} are missing")
    elif weather.limit(fixed.MIN_WEATHER_EXTRACT_ROWS + 1).count() <= fixed.MIN_WEATHER_EXTRACT_ROWS:
        errors.append(f"weather extract: at most {fixed.MIN_WEATHER_EXTRACT_ROWS} rows, more required")
    return errors


def constraint_counts(df: DataFrame, schema, key: str | None) -> dict[str, int]:
    """K6: NULL rows of each NOT NULL column of the declared schema (one aggregate
    pass), and under `key` its NULL rows plus its duplicated values."""
    required = [f.name for f in schema.fields if not f.nullable]
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required]).first().asDict() if required else {}
    if key:
        row[key] = row.get(key, 0) + unique_failures(df, key).first()["n"]
    return row


def load_constraint_violations(table: str, df: DataFrame, schema, key: str | None) -> list[str]:
    """K6: what the warehouse DDL would reject on load, one message per column."""
    return [f"{table}.{c}: {n} NULL rows or duplicated keys, 0 allowed" for c, n in constraint_counts(df, schema, key).items() if n]


@dataclass(frozen=True)
class WarehouseGate:
    """Q13-Q16 thresholds (defaults of the original settings)."""
    min_taxi_rows: int = fixed.MIN_TAXI_ROWS
    min_weather_join_coverage: float = fixed.MIN_WEATHER_JOIN_COVERAGE
    weather_fraction: float = fixed.WEATHER_ROWS_FRACTION


def month_gate(month: str, raw_trips: DataFrame, raw_weather: DataFrame, fct: DataFrame, hourly: DataFrame) -> DataFrame:
    """Q13-Q16 figures of one month, in one row.

    Month filters are range predicates on the stored columns (F10, F11), so the
    scans prune partitions / row groups of other months.
    """
    first = F.lit(f"{month}-01").cast("date")
    start, stop = first.cast("timestamp_ntz"), F.add_months(first, 1).cast("timestamp_ntz")
    taxi = raw_trips.filter(F.col("ingestion_month") == first).agg(F.count(F.lit(1)).alias("taxi_rows"))
    weather = raw_weather.filter(F.col("source_month") == first).agg(F.count(F.lit(1)).alias("weather_rows"))
    month_fct = fct.filter((F.col("pickup_ts_local") >= start) & (F.col("pickup_ts_local") < stop))
    month_hourly = hourly.filter((F.col("pickup_hour") >= start) & (F.col("pickup_hour") < stop))
    gap = hourly_consistency(month_fct, month_hourly).agg(F.coalesce(F.sum("gap"), F.lit(0)).alias("gap"))
    # one-row frames
    return taxi.crossJoin(weather).crossJoin(overall_weather_coverage(month_fct)).crossJoin(gap)


def gate_errors(month: str, row, gate: WarehouseGate = WarehouseGate()) -> list[str]:
    """Q13-Q16 for one month's figures; returns failure messages (empty = pass)."""
    year, number = map(int, month.split("-"))
    wanted = calendar.monthrange(year, number)[1] * 24 * len(fixed.NYC_BOROUGHS) * gate.weather_fraction
    errors = []
    if row.taxi_rows < gate.min_taxi_rows:
        errors.append(f"raw_taxi_trips_yellow {month}: {row.taxi_rows} rows, {gate.min_taxi_rows} required")
    if row.weather_rows < wanted:
        errors.append(f"raw_weather_hourly {month}: {row.weather_rows} rows, {wanted:g} required")
    if row.weather_join_coverage < gate.min_weather_join_coverage:
        errors.append(f"fct_taxi_trips {month}: weather coverage {row.weather_join_coverage}, {gate.min_weather_join_coverage} required")
    if row.gap != 0:
        errors.append(f"fct_hourly_demand {month}: {row.gap} trips fewer than in fct_taxi_trips, 0 required")
    return errors


def warehouse_checks(month: str, raw_trips: DataFrame, raw_weather: DataFrame, fct: DataFrame,
                     hourly: DataFrame, gate: WarehouseGate = WarehouseGate()) -> list[str]:
    """Q13-Q16 for one month, read from the tables."""
    return gate_errors(month, month_gate(month, raw_trips, raw_weather, fct, hourly).first(), gate)


# --- figures counted while a table is written ------------------------------------------

def rows_where(condition: Column) -> Column:
    """Number of rows that meet a condition, for `DataFrame.observe`.

    `count_if` would have its condition evaluated as a column of the rows below.  In the trip fact that column makes the method that
    gives the rows too long to be compiled to machine code (8,000 bytes), and the whole write runs in the interpreter."""
    return F.count(F.when(condition, F.lit(1)))


def write_metrics(model: str) -> dict[str, Column]:
    """Q1, Q7, Q9, Q13-Q16: aggregates of a model's rows, for `DataFrame.observe` on its write."""
    out = {"rows": F.count(F.lit(1))} | {f"null_{c}": rows_where(F.col(c).isNull()) for c in NOT_NULL.get(model, ())}
    if model == "fct_taxi_trips":
        out |= {"known_weather": rows_where(F.col("weather_key") != fixed.UNKNOWN_WEATHER), "out_of_range": rows_where(out_of_range())}
    if model == "fct_hourly_demand":
        out["trips"] = F.coalesce(F.sum("trip_count"), F.lit(0))
    return out


def observed_not_null(facts: dict[str, dict]) -> list[tuple]:
    """Q1 from the figures of the writes: rows of (check, model, column, failures)."""
    return [("not_null", model, c, int(facts[model][f"null_{c}"])) for model, columns in NOT_NULL.items() if model in facts for c in columns]


def raise_if_failed(errors: list[str]) -> None:
    """Q17: fail fast with every message."""
    if errors:
        raise QualityCheckError("; ".join(errors))
