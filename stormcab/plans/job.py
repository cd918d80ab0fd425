"""The monthly job (L1-L4) as one Spark application.

    normalise landed feeds, written once to a staging folder -> raw checks on
    what was written -> replace the month in the raw tables -> rebuild
    dimensions and facts -> declared tests and warehouse checks

Every stage boundary is a written Parquet table, which cuts the lineage: an
executor lost late in the job only recomputes from the last written table.
Trips, weather and zones of a load are one commit, all marts of a build another (`sources.commits`):
readers see a load or a build whole or not at all.  Figures for the gates and for the tests that
count rows are taken while the tables are written.  Finished steps of a run are in a journal
under the month and the fingerprint of its input files, so a run that lost its driver goes on behind the last one;
running a month again gives the same tables.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators import normalize, quality, staging
from ..sources import commits, landed, writers
from . import key_filters, marts
from .warehouse import RawTables, Warehouse

RAW_TABLES = {"trips": "raw_taxi_trips_yellow", "weather": "raw_weather_hourly", "zones": "raw_taxi_zone_lookup"}
MONTH_COLUMN = {"trips": "ingestion_month", "weather": "source_month"}
DIMENSIONS = ("dim_location", "dim_weather", "dim_date_time")
HOURLY_WEATHER = "stg_weather_hourly"
PICKUP_MONTH = "pickup_month"
TRIP_SUMS = "agg_trip_sums"
AGGREGATE_FACTS = ("fct_hourly_demand", "fct_fare_revenue", "fct_weather_impact")
STEPS = ("start", "normalised", "checked", "loaded", "built", "tested")


Progress = Callable[[str], None]


def no_progress(step: str) -> None:
    """Nobody listens."""


def run_timestamp() -> str:
    """UTC now, floored to the second, without zone: one literal per run."""
    return datetime.now(timezone.utc).replace(tzinfo=None, microsecond=0).isoformat(sep=" ")


@dataclass
class JobReport:
    month: str
    raw_errors: list[str] = field(default_factory=list)
    test_failures: list[dict] = field(default_factory=list)
    warehouse_errors: list[str] = field(default_factory=list)

    @property
    def errors(self) -> list[str]:
        tests = [f"{t['check_name']} {t['model']}.{t['column_name']}: {t['failures']}" for t in self.test_failures]
        return self.raw_errors + tests + self.warehouse_errors


@dataclass
class MonthFeeds:
    raw: RawTables          # the month's rows, written to the staging folder
    documents: int          # weather documents landed


def input_fingerprint(spark: SparkSession, landing: str, month: str, dataset: str = "yellow") -> str:
    """Names, sizes and times of the month's landed files."""
    found = []
    for path in (landed.trip_month_dir(landing, month, dataset), landed.weather_month_dir(landing, month), landed.zone_file(landing)):
        fs, p = commits.filesystem(spark, path)
        if fs.exists(p):
            files = fs.listFiles(p, True)
            while files.hasNext():
                f = files.next()
                found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return hashlib.sha256(json.dumps(sorted(found)).encode()).hexdigest()[:24]


@dataclass
class Journal:
    """Finished steps of one run, a small file each."""

    spark: SparkSession
    root: str

    def done(self, step: str) -> dict | None:
        path = f"{self.root}/{step}.json"
        fs, p = commits.filesystem(self.spark, path)
        return json.loads(commits.read_text(self.spark, path)) if fs.exists(p) else None

    def step(self, name: str, work: Callable[[], dict | None]) -> dict:
        """What the step gave, from the journal if an earlier run has finished it."""
        found = self.done(name)
        if found is None:
            found = work() or {}
            commits.create_text(self.spark, f"{self.root}/{name}.json", json.dumps(found))
        return found

    def end(self) -> None:
        """The run is over: its journal and its staged files go, those of other runs stay."""
        commits.remove(self.spark, self.root)


def normalize_month(spark: SparkSession, landing: str, staged_root: str, month: str, ingested_at: str,
                    dataset: str = "yellow", weather_multi_line: bool = True) -> MonthFeeds:
    """L2: the month's landed feeds as raw rows, each feed written once below `staged_root`."""
    trips, file = landed.read_trip_month(spark, landing, month, dataset), F.col("source_file")
    with landed.small_splits(spark):
        normalize.repeated_hash_keys(trips, month, file).write.mode("overwrite").option("compression", commits.CODEC).parquet(f"{staged_root}/repeated")
        repeated = spark.read.parquet(f"{staged_root}/repeated")  # written, so that the planner knows its bytes
        normalize.staged_trips(trips, month, file, ingested_at, repeated).write.mode("overwrite").options(**commits.ENCODING).parquet(f"{staged_root}/trips")
    docs = landed.read_weather_documents(spark, landing, month, weather_multi_line)
    normalize.raw_weather_from_documents(docs, month, ingested_at).write.mode("overwrite").option("compression", commits.CODEC).parquet(f"{staged_root}/weather")
    normalize.raw_zones(landed.read_zone_lookup(spark, landing), landed.zone_file(landing), ingested_at).write.mode("overwrite").option("compression", commits.CODEC).parquet(f"{staged_root}/zones")
    return MonthFeeds(staged_tables(spark, staged_root), docs.select("requested_borough").count())


def staged_tables(spark: SparkSession, staged_root: str) -> RawTables:
    found = {k: spark.read.parquet(f"{staged_root}/{k}") for k in RAW_TABLES}
    return RawTables(**found | {"trips": normalize.with_record_hash(found["trips"])})


def load_constraints(raw: RawTables) -> list[str]:
    """K6 before loading.  Trips need no key check (deduplicated on the key)
    and their NOT NULL columns are literals, a file path and an MD5; weather
    is deduplicated on its key too, but its hour may fail to parse."""
    return (quality.load_constraint_violations(RAW_TABLES["weather"], raw.weather, schemas.RAW_WEATHER, None)
            + quality.load_constraint_violations(RAW_TABLES["zones"], raw.zones, schemas.RAW_ZONE, "location_id"))


def keys_in_other_months(spark: SparkSession, trips: DataFrame, warehouse: str, month: str) -> list[str]:
    """K4: trips of this load that another loaded month has already (the key is global)."""
    state = commits.latest(spark, warehouse)
    if not state.has(RAW_TABLES["trips"]):
        return []
    found = key_filters.repeated_keys(trips, state.read(spark, RAW_TABLES["trips"]), state.read(spark, key_filters.TABLE), month)
    n = 0 if found is None else found.count()
    return [f"{RAW_TABLES['trips']} {month}: {n} record hashes are in other months, 0 allowed"] if n else []


def _months(df: DataFrame, column: str) -> set[str]:
    rows = df.select(F.substring(F.col(column).cast("string"), 1, 7).alias("m")).where("m is not null").distinct().collect()
    return {r.m for r in rows}  # calendar months


def affected_months(raw: RawTables, month: str) -> set[str]:
    """Pickup months whose facts depend on the rows of one load: those of its trips and of its weather."""
    first = F.lit(f"{month}-01").cast("date")
    return (_months(raw.trips.filter(F.col("ingestion_month") == first), "pickup_datetime")
            | _months(raw.weather.filter(F.col("source_month") == first), "weather_ts_hour"))


def load_month(spark: SparkSession, raw: RawTables, warehouse: str, month: str, progress: Progress = no_progress) -> commits.Snapshot:
    """L3: K3 zone full refresh, K4/K5 month replacement of trips and weather, in one commit."""
    before = commits.latest(spark, warehouse)
    new: dict[str, commits.Table] = {}
    for kind, name in RAW_TABLES.items():
        if kind in MONTH_COLUMN:
            new[name] = writers.month_written(before, getattr(raw, kind), name, MONTH_COLUMN[kind], month, quality.write_metrics(name))
        else:
            new[name] = commits.write(getattr(raw, kind), warehouse, name, None, quality.write_metrics(name))
        progress(name)
    trips = RAW_TABLES["trips"]  # the keys of what was written, which are made of seven columns in `raw`
    loaded = commits.Snapshot(warehouse, tables=new).read(spark, trips).where(F.col(MONTH_COLUMN["trips"]) == F.lit(f"{month}-01").cast("date"))
    new[key_filters.TABLE] = writers.month_written(before, key_filters.key_filter(loaded), key_filters.TABLE, "ingestion_month", month)
    progress(key_filters.TABLE)
    after = commits.commit(spark, before, new, f"load {month}")
    progress("committed")
    return after


def raw_tables_of(spark: SparkSession, state: commits.Snapshot) -> RawTables:
    return RawTables(**{k: state.read(spark, v) for k, v in RAW_TABLES.items()})


def read_raw(spark: SparkSession, warehouse: str) -> RawTables:
    return raw_tables_of(spark, commits.latest(spark, warehouse))


def read_mart(spark: SparkSession, warehouse: str, name: str) -> DataFrame:
    """K7: a dimension or fact of the last build."""
    return commits.latest(spark, warehouse).read(spark, name)


def _month_metrics(model: str, month: str | None) -> dict:
    """The figures of a whole fact, and of one pickup month in it."""
    metrics = quality.write_metrics(model)
    if month:
        here = F.col(PICKUP_MONTH) == F.lit(f"{month}-01").cast("date")
        if model == "fct_taxi_trips":
            metrics |= {"month_rows": quality.rows_where(here), "month_known": quality.rows_where(here & (F.col("weather_key") != quality.fixed.UNKNOWN_WEATHER))}
        if model == "fct_hourly_demand":
            metrics["month_trips"] = F.coalesce(F.sum(F.when(here, F.col("trip_count"))), F.lit(0))
    return metrics


def _write_dimensions(spark: SparkSession, wh: Warehouse, root: str) -> tuple[dict[str, commits.Table], DataFrame, DataFrame]:
    """Dimensions and hourly weather, written before the trip fact joins them so that the planner knows their bytes."""
    new = {name: commits.write(getattr(wh, name), root, name, None, quality.write_metrics(name)) for name in (*DIMENSIONS, HOURLY_WEATHER)}
    written = commits.Snapshot(root, tables=new)
    return new, written.read(spark, "dim_location"), written.read(spark, HOURLY_WEATHER)


def _write_facts(spark: SparkSession, fct: DataFrame, root: str, metrics: Callable[[str], dict], only: Callable[[DataFrame], DataFrame]) -> dict[str, commits.Table]:
    """The trip fact, its mergeable sums and the three facts made of them, by pickup month.

    The trip fact is read back once, for the sums; they are read back for the three facts."""
    new: dict[str, commits.Table] = {}

    def written(name: str, df: DataFrame) -> DataFrame:
        new[name] = commits.write(df, root, name, PICKUP_MONTH, metrics(name), only)
        return commits.Snapshot(root, tables=new).read(spark, name)

    trips = written("fct_taxi_trips", fct.withColumn(PICKUP_MONTH, F.trunc("pickup_date", "MM")))
    sums = written(TRIP_SUMS, by_month(marts.trip_sums(trips)))
    for name in AGGREGATE_FACTS:
        written(name, by_month(getattr(marts, name)(sums)))
    return new


def build_marts(spark: SparkSession, warehouse: str, raw: RawTables | None = None, month: str | None = None) -> commits.Snapshot:
    """K7, full refresh: staging stays lazy (views); dimensions and facts are written, then committed together.

    `month`: the pickup month whose gate figures are counted on the way."""
    before = commits.latest(spark, warehouse)
    wh = Warehouse(raw or raw_tables_of(spark, before))
    new, loc, weather = _write_dimensions(spark, wh, warehouse)
    fct = marts.fct_taxi_trips(wh.stg_taxi_trips, loc, weather)
    new |= _write_facts(spark, fct, warehouse, lambda name: _month_metrics(name, month), lambda df: df)
    return commits.commit(spark, before, new, "build all months")


def by_month(fact: DataFrame) -> DataFrame:
    """An aggregate fact with its pickup month (a function of its hour or day key)."""
    day = F.col("pickup_date") if "pickup_date" in fact.columns else F.col("pickup_hour").cast("date")
    return fact.withColumn(PICKUP_MONTH, F.trunc(day, "MM"))


def rebuild_months(spark: SparkSession, warehouse: str, months: set[str]) -> commits.Snapshot:
    """K7, incremental: dimensions and hourly weather anew, and the facts of the given pickup months; the
    other months' folders are named again.  Readers see the build before until the commit.

    Same tables as a full refresh if `months` has every month that a changed trip or reading touches."""
    before = commits.latest(spark, warehouse)
    wh = Warehouse(raw_tables_of(spark, before))
    new, loc, weather = _write_dimensions(spark, wh, warehouse)
    facts = {name: before.tables[name] for name in ("fct_taxi_trips", TRIP_SUMS, *AGGREGATE_FACTS)}
    for month in sorted(months):
        first = F.lit(f"{month}-01").cast("date")
        here = (F.col("pickup_datetime") >= first.cast("timestamp_ntz")) & (F.col("pickup_datetime") < F.add_months(first, 1).cast("timestamp_ntz"))
        fct = marts.fct_taxi_trips(staging.stg_taxi_trips(wh.raw.trips.filter(here)), loc, weather)
        built = _write_facts(spark, fct, warehouse, quality.write_metrics, lambda df, m=month: writers.only_month(df, PICKUP_MONTH, m))
        facts = {name: t.replaced(built[name], [f"{month}-01"]) for name, t in facts.items()}
    return commits.commit(spark, before, new | facts, f"build {' '.join(sorted(months))}")


def table_facts(table: commits.Table) -> dict | None:
    """What the writes of a table counted, over all its partitions; None if some were not counted."""
    parts = [table.facts[""]] if "" in table.facts else [table.facts.get(k) for k in table.folders]
    if not parts or any(p is None for p in parts):
        return None
    return {k: sum(int(p[k] or 0) for p in parts) for k in parts[0]}


def month_figures(state: commits.Snapshot, month: str) -> Row | None:
    """Q13-Q16 of a month from the figures of the writes, if all were counted."""
    first = f"{month}-01"

    def of(name: str) -> dict | None:
        table = state.tables[name]
        if "" in table.facts:
            return {k.removeprefix("month_"): v for k, v in table.facts[""].items() if k.startswith("month_")} or None
        return table.facts.get(first, None if first in table.folders else {})

    raw = [of(RAW_TABLES[k]) for k in ("trips", "weather")]
    fct, hourly = of("fct_taxi_trips"), of("fct_hourly_demand")
    if None in (*raw, fct, hourly):
        return None
    rows, known = int(fct.get("rows", 0)), int(fct.get("known", fct.get("known_weather", 0)))
    return Row(taxi_rows=int(raw[0].get("rows", 0)), weather_rows=int(raw[1].get("rows", 0)),
               weather_join_coverage=known / rows if rows else 0.0, gap=rows - int(hourly.get("trips", 0)))


def table_models(spark: SparkSession, warehouse: str, state: commits.Snapshot | None = None):
    """Model accessor over written tables (staging derived from the raw tables)."""
    state = state or commits.latest(spark, warehouse)
    raw = raw_tables_of(spark, state)
    views = {"stg_taxi_trips": lambda: staging.stg_taxi_trips(raw.trips),
             "stg_weather_hourly": lambda: staging.stg_weather_hourly(raw.weather),
             "stg_locations": lambda: staging.stg_locations(raw.zones)}

    def model(name: str) -> DataFrame:
        return views[name]() if name in views else state.read(spark, name)
    return model


def _row(check: str, model: str, column: str, failures) -> dict:
    return {"check_name": check, "model": model, "column_name": column, "failures": int(failures)}


def run_tests(spark: SparkSession, warehouse: str) -> list[dict]:
    """The 46 declared tests plus the three singular ones; returns failing rows only.

    Tests that only count rows (not_null of written models, trip ranges, consistency, coverage) take what the
    writes counted; they read the tables where a table was written in parts by older runs without figures."""
    state = commits.latest(spark, warehouse)
    models = table_models(spark, warehouse, state)
    facts = {name: f for name, t in state.tables.items() if name in quality.NOT_NULL and (f := table_facts(t))}
    rows = [_row(*t) for t in quality.observed_not_null(facts)]
    rows += [r.asDict() for r in quality.generic_checks(models, facts).filter(F.col("failures") > 0).collect()]  # a row a check
    fct, hourly = facts.get("fct_taxi_trips"), facts.get("fct_hourly_demand")
    if fct and hourly:
        out, gap = fct["out_of_range"], abs(fct["rows"] - hourly["trips"])
        covered = fct["rows"] > 0 and fct["known_weather"] / fct["rows"] >= quality.fixed.MIN_WEATHER_JOIN_COVERAGE
    else:
        trips = models("fct_taxi_trips")
        out = quality.trip_range_violations(trips).count()
        gap = quality.hourly_consistency(trips, models("fct_hourly_demand")).agg(F.coalesce(F.sum(F.abs("gap")), F.lit(0))).first()[0]
        covered = quality.coverage_total(trips).first().passed
    rows += [_row("trip_ranges", "fct_taxi_trips", "*", out), _row("hourly_demand_consistency", "fct_hourly_demand", "trip_count", gap),
             _row("weather_join_coverage", "fct_taxi_trips", "weather_key", not covered)]
    return [r for r in rows if r["failures"] > 0]


def gate_row(spark: SparkSession, warehouse: str, month: str) -> Row:
    """Q13-Q16 of a month: counted by the writes, else read from the tables."""
    state = commits.latest(spark, warehouse)
    models = table_models(spark, warehouse, state)
    return month_figures(state, month) or quality.month_gate(month, *map(models, (RAW_TABLES["trips"], RAW_TABLES["weather"], "fct_taxi_trips", "fct_hourly_demand"))).first()


def run_month(spark: SparkSession, landing: str, warehouse: str, month: str, *, dataset: str = "yellow",
              ingested_at: str | None = None, weather_multi_line: bool = True,
              gate: quality.WarehouseGate = quality.WarehouseGate(), fail: bool = True,
              incremental: bool = False, progress: Progress = no_progress) -> JobReport:
    """L1: the whole month; raises QualityCheckError on failures when `fail`.

    `incremental=True` rebuilds only the facts of pickup months that the load
    touches; the default is the original full refresh.  `progress` hears of each finished step.  A run that ended
    before its last step is taken up behind its last finished one by the next run over the same files.
    """
    journal = Journal(spark, f"{warehouse}/_journal/{month}-{input_fingerprint(spark, landing, month, dataset)}")
    report = JobReport(month)

    def step(name: str, work: Callable[[], dict | None]) -> dict:
        found = journal.step(name, work)
        progress(name)
        return found

    ts = step("start", lambda: {"ingested_at": ingested_at or run_timestamp()})["ingested_at"]
    staged = f"{journal.root}/staged"
    documents = step("normalised", lambda: {"documents": normalize_month(spark, landing, staged, month, ts, dataset, weather_multi_line).documents})["documents"]

    def check() -> dict:
        raw = staged_tables(spark, staged)
        errors = quality.raw_extract_checks(raw.trips, raw.weather, documents) + load_constraints(raw)
        before = commits.latest(spark, warehouse)
        touched = affected_months(raw_tables_of(spark, before), month) if before.has(RAW_TABLES["trips"]) else set()
        return {"errors": errors + keys_in_other_months(spark, raw.trips, warehouse, month), "months": sorted(touched | affected_months(raw, month))}

    checked = step("checked", check)
    report.raw_errors = checked["errors"]
    if report.raw_errors and fail:
        journal.end()  # a load that is refused leaves nothing
        quality.raise_if_failed(report.raw_errors)

    step("loaded", lambda: {"commit": load_month(spark, staged_tables(spark, staged), warehouse, month).number})

    def build() -> None:
        if incremental and commits.latest(spark, warehouse).has("fct_taxi_trips"):
            rebuild_months(spark, warehouse, set(checked["months"]))
        else:
            build_marts(spark, warehouse, month=month)

    step("built", build)
    report.test_failures = step("tested", lambda: {"failures": run_tests(spark, warehouse)})["failures"]
    report.warehouse_errors = quality.gate_errors(month, gate_row(spark, warehouse, month), gate)
    journal.end()
    if fail:
        quality.raise_if_failed(report.errors)
    return report
