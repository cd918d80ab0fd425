"""Marts invariants, sinks, the month job and the streaming loader on sf0.001."""

import tempfile
from datetime import datetime

from pyspark.sql import functions as F

import pytest

from conftest import SMOKE
from registry import catalog, feeds
from stormcab.operators import normalize, quality
from stormcab.plans import job, key_filters, serving
from stormcab.sources import commits, landed, writers


def test_mart_keys_unique_and_consistent(spark):
    wh = catalog.warehouse(spark, SMOKE)
    for name, key in (("fct_hourly_demand", "hourly_demand_key"), ("fct_fare_revenue", "fare_revenue_key"),
                      ("fct_weather_impact", "weather_impact_key"), ("dim_weather", "weather_key"),
                      ("dim_date_time", "date_hour_key")):
        df = getattr(wh, name)
        assert df.count() == df.select(key).distinct().count(), name
    gap = quality.hourly_consistency(wh.fct_taxi_trips, wh.fct_hourly_demand).collect()
    assert all(r.gap == 0 for r in gap)
    unknown = wh.dim_weather.filter(F.col("weather_key") == "unknown").collect()
    assert len(unknown) == 1 and unknown[0].weather_group == "unknown"


def test_fact_defaults_for_unmatched_weather(spark):
    wh = catalog.warehouse(spark, SMOKE)
    r = wh.fct_taxi_trips.filter(F.col("weather_key") == "unknown").first()
    assert r.weather_severity == "unknown" and r.is_rain is False and r.temperature_2m is None


def test_empty_inputs_give_empty_calendar(spark):
    wh = catalog.warehouse(spark, SMOKE)
    assert wh.dim_date_time.limit(0).count() == 0
    from stormcab.plans import marts
    assert marts.dim_date_time(wh.stg_taxi_trips.limit(0), wh.stg_weather_hourly.limit(0)).count() == 0


def test_slicers_filter(spark):
    wh = catalog.warehouse(spark, SMOKE)
    hourly = [r.asDict() for r in wh.fct_hourly_demand.collect()]
    groups = {r.weather_key: r.weather_group for r in wh.dim_weather.collect()}

    def trips(s):
        return serving.trip_count(wh.fct_hourly_demand, s, wh.dim_weather).first().trip_count

    assert trips(serving.Slicers(boroughs=("Bronx",))) == sum(r["trip_count"] for r in hourly if r["pickup_borough"] == "Bronx")
    rain = sum(r["trip_count"] for r in hourly if groups[r["weather_key"]] == "rain")
    assert 0 < trips(serving.Slicers(weather_groups=("rain",))) == rain < trips(serving.NO_SLICERS)
    assert trips(serving.Slicers(hours_of_day=(7,))) == sum(r["trip_count"] for r in hourly if r["pickup_hour"].hour == 7)
    share = serving.rain_snow_share(wh.fct_hourly_demand, wh.dim_weather, serving.Slicers(weather_groups=("rain",))).first()
    assert share.rain_trip_share == 1.0


def test_a_slicer_without_its_column_is_an_error(spark):
    wh = catalog.warehouse(spark, SMOKE)
    for s in (serving.Slicers(hours_of_day=(7,)), serving.Slicers(severities=("light",)), serving.Slicers(weather_groups=("rain",))):
        with pytest.raises(ValueError, match="does not apply"):
            serving.revenue_measures(wh.fct_fare_revenue, s, wh.dim_weather)


def test_builders_start_no_job(spark, monkeypatch):
    """Builders of models only plan; the load path and the queries over built tables write files."""
    from pyspark.sql.classic.dataframe import DataFrame

    def used(*_, **__):
        raise AssertionError("a builder ran a job")

    for name in ("collect", "count", "first", "take", "head", "isEmpty", "checkpoint", "localCheckpoint", "toPandas"):
        monkeypatch.setattr(DataFrame, name, used)
    monkeypatch.setattr(DataFrame, "write", property(used))
    acting = ("src_", "sink_", "job_", "proto_fact_merged", "q_", "m_", "v_", "dq_")  # the last four read built tables
    for name, build in catalog.QUERIES.items():
        if not name.startswith(acting):
            build(spark, SMOKE)


def test_dim_location_reads_the_nations_only(spark):
    plan = catalog.QUERIES["dim_location"](spark, SMOKE)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") == 1 and "n_nationkey" in plan


def test_replace_month_keeps_other_months_and_drops_empty(spark, scratch):
    df = spark.createDataFrame([(1, datetime(2025, 1, 1).date()), (2, datetime(2025, 2, 1).date())],
                               "v int, ingestion_month date")

    def rows():
        return sorted((r.v, str(r.ingestion_month)) for r in landed.read_table(spark, scratch, "t").collect())

    writers.replace_month(df.where("v = 1"), scratch, "t", "ingestion_month", "2025-01")
    writers.replace_month(df.where("v = 2"), scratch, "t", "ingestion_month", "2025-02")
    new_jan = spark.createDataFrame([(3, datetime(2025, 1, 1).date())], "v int, ingestion_month date")
    writers.replace_month(new_jan, scratch, "t", "ingestion_month", "2025-01")
    writers.replace_month(new_jan, scratch, "t", "ingestion_month", "2025-01")  # idempotent
    assert rows() == [(2, "2025-02-01"), (3, "2025-01-01")]
    writers.replace_month(new_jan.limit(0), scratch, "t", "ingestion_month", "2025-01")  # empty month -> removed
    assert rows() == [(2, "2025-02-01")]


def test_replace_month_rejects_rows_of_other_months(spark, scratch):
    old = spark.createDataFrame([(1, datetime(2025, 1, 1).date())], "v int, ingestion_month date")
    writers.replace_month(old, scratch, "t", "ingestion_month", "2025-01")
    for wrong in (datetime(2025, 2, 1).date(), None):
        mixed = spark.createDataFrame([(2, datetime(2025, 1, 1).date()), (3, wrong)], "v int, ingestion_month date")
        with pytest.raises(Exception, match="in the load of 2025-01"):
            writers.replace_month(mixed, scratch, "t", "ingestion_month", "2025-01")
    assert [r.v for r in landed.read_table(spark, scratch, "t").collect()] == [1]  # a failed load leaves the month as it was


MONTH = feeds.MONTHS[0]


def _land(spark, root, months=(MONTH,), only=None):
    for month in months:
        trips = feeds.landed_month(spark, SMOKE, month)
        writers.land_trip_month(trips if only is None else trips.where(only), root, month)
        writers.land_weather_documents(feeds.month_documents(spark, SMOKE, month), root, month)
    writers.land_zone_lookup(feeds.landed_zones(spark, SMOKE), root)


@pytest.fixture(scope="module")
def staged(spark):
    """Raw rows of each month's landed files."""
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    _land(spark, f"{root}/landing", feeds.MONTHS)
    return {m: job.normalize_month(spark, f"{root}/landing", f"{root}/staged-{m}", m, "2024-04-01 00:00:00", weather_multi_line=False).raw for m in feeds.MONTHS}


def _folders(spark, wh):
    """Journal folders of runs that have not ended."""
    return commits.children(spark, f"{wh}/_journal/*")


def test_month_job_end_to_end(spark, scratch):
    land, wh = f"{scratch}/landing", f"{scratch}/warehouse"
    _land(spark, land)
    rep = job.run_month(spark, land, wh, MONTH, weather_multi_line=False, fail=False,
                        ingested_at="2024-02-01 00:00:00")
    assert len(rep.raw_errors) == 1 and "weather extract" in rep.raw_errors[0]  # the smoke feed has few hours
    n = job.read_mart(spark, wh, "fct_taxi_trips").count()
    assert n > 0
    assert job.read_mart(spark, wh, "fct_hourly_demand").agg(F.sum("trip_count")).first()[0] == n
    # failing gates are reported: the feed's coverage is below the threshold
    assert any("coverage" in e for e in rep.warehouse_errors)
    assert any(t["check_name"] == "weather_join_coverage" for t in rep.test_failures)
    before = commits.latest(spark, wh)
    with pytest.raises(quality.QualityCheckError, match="weather extract"):
        job.run_month(spark, land, wh, MONTH, weather_multi_line=False, fail=True)
    assert commits.latest(spark, wh).number == before.number  # nothing was loaded
    assert _folders(spark, wh) == []  # and nothing is left of the run
    job.run_month(spark, land, wh, MONTH, weather_multi_line=False, fail=False, ingested_at="2024-02-01 00:00:00")
    assert job.read_mart(spark, wh, "fct_taxi_trips").count() == n  # re-run is idempotent
    assert commits.latest(spark, wh).number == before.number + 2 and _folders(spark, wh) == []


def test_figures_of_the_writes_equal_those_of_the_tables(spark, scratch, staged):
    wh = scratch
    for month in feeds.MONTHS[:2]:
        job.load_month(spark, staged[month], wh, month)

    def tables(month):
        models = job.table_models(spark, wh)
        return quality.month_gate(month, *map(models, ("raw_taxi_trips_yellow", "raw_weather_hourly", "fct_taxi_trips", "fct_hourly_demand"))).first()

    def read(state):
        return [r.asDict() for r in quality.not_null_checks(job.table_models(spark, wh, state)).collect()]

    job.build_marts(spark, wh, month=feeds.MONTHS[0])
    state = commits.latest(spark, wh)
    assert tuple(job.month_figures(state, feeds.MONTHS[0])) == tuple(tables(feeds.MONTHS[0]))
    counted = {(m, c): n for _, m, c, n in quality.observed_not_null({k: job.table_facts(t) for k, t in state.tables.items() if k in quality.NOT_NULL})}
    assert counted.items() <= {(r["model"], r["column_name"]): r["failures"] for r in read(state)}.items() and len(counted) > 10
    facts = job.table_facts(state.tables["fct_taxi_trips"])
    trips = state.read(spark, "fct_taxi_trips")
    assert facts["rows"] == trips.count() and facts["out_of_range"] == quality.trip_range_violations(trips).count()
    tests = job.run_tests(spark, wh)
    job.rebuild_months(spark, wh, {feeds.MONTHS[1]})  # now the fact has figures of one month only: the tables are read
    state = commits.latest(spark, wh)
    assert job.table_facts(state.tables["fct_taxi_trips"]) is None
    assert sorted(map(str, job.run_tests(spark, wh))) == sorted(map(str, tests))
    assert tuple(job.month_figures(state, feeds.MONTHS[1])) == tuple(tables(feeds.MONTHS[1])) and job.month_figures(state, feeds.MONTHS[0]) is None
    assert tuple(job.gate_row(spark, wh, feeds.MONTHS[0])) == tuple(tables(feeds.MONTHS[0]))


def test_gates_do_not_read_the_fact(spark, scratch, monkeypatch, staged):
    wh = scratch
    job.load_month(spark, staged[MONTH], wh, MONTH)
    job.build_marts(spark, wh, month=MONTH)
    monkeypatch.setattr(quality, "month_gate", lambda *_: pytest.fail("the tables were read"))
    assert job.gate_row(spark, wh, MONTH).taxi_rows > 0


def test_a_broken_build_leaves_the_published_marts(spark, scratch, monkeypatch, staged):
    """Broken before each of its nine writes, and before its commit."""
    job.load_month(spark, staged[MONTH], scratch, MONTH)
    state = commits.commit(spark, commits.latest(spark, scratch), {"fct_taxi_trips": commits.write(spark.range(3), scratch, "fct_taxi_trips")})
    write, made = commits.write, {}

    def lost(df, root, name, *rest):
        if len(made) == step:
            raise RuntimeError("lost")
        made[name] = write(df.limit(10), root, name, *rest)
        return made[name]

    monkeypatch.setattr(job.commits, "write", lost)
    for step in range(9):
        made.clear()
        with pytest.raises(RuntimeError):
            job.build_marts(spark, scratch)
        assert commits.latest(spark, scratch).number == state.number and job.read_mart(spark, scratch, "fct_taxi_trips").count() == 3
    assert commits.sweep(spark, scratch)  # what broken builds wrote can be told from what is in use
    assert job.read_mart(spark, scratch, "fct_taxi_trips").count() == 3
    made.clear()
    monkeypatch.setattr(job.commits, "commit", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
    step = 9
    with pytest.raises(RuntimeError):
        job.build_marts(spark, scratch)
    assert len(made) == 9 and job.read_mart(spark, scratch, "fct_taxi_trips").count() == 3


def test_trips_of_another_month_are_rejected(spark, scratch):
    land, wh = f"{scratch}/landing", f"{scratch}/warehouse"
    _land(spark, land)
    job.run_month(spark, land, wh, MONTH, weather_multi_line=False, fail=False)
    writers.land_trip_month(feeds.landed_month(spark, SMOKE, MONTH), land, "2024-02")
    writers.land_weather_documents(feeds.month_documents(spark, SMOKE, "2024-02"), land, "2024-02")
    with pytest.raises(quality.QualityCheckError, match="record hashes are in other months"):
        job.run_month(spark, land, wh, "2024-02", weather_multi_line=False)


def test_streaming_loader_available_now(spark, scratch):
    from stormcab.streaming.landing import start_trip_landing_stream
    land, wh = f"{scratch}/landing", f"{scratch}/warehouse"
    writers.land_trip_month(feeds.landed_month(spark, SMOKE, MONTH), land, MONTH)
    q = start_trip_landing_stream(spark, land, wh, name=f"s{abs(hash(scratch))}", ingested_at="2024-02-01 00:00:00")
    q.awaitTermination(300)
    raw = landed.read_table(spark, wh, "raw_taxi_trips_yellow")
    assert raw.count() == normalize.raw_trips(feeds.landed_month(spark, SMOKE, MONTH), MONTH, "f", feeds.RUN_TS).count()
    assert {str(r.ingestion_month) for r in raw.select("ingestion_month").distinct().collect()} == {"2024-01-01"}


def test_incremental_rebuild_matches_full_refresh(spark, scratch):
    """Two months; the second load has other trips for a month and changed weather."""
    ts = "2024-04-01 00:00:00"
    months = feeds.MONTHS[1:]
    roots = {}
    for kind in ("full", "inc"):
        land, wh = f"{scratch}/{kind}-landing", f"{scratch}/{kind}"

        def load(month):
            job.load_month(spark, job.normalize_month(spark, land, f"{wh}-staged", month, ts, weather_multi_line=False).raw, wh, month)

        _land(spark, land, months)
        for month in months:
            load(month)
        if kind == "inc":
            job.build_marts(spark, wh)
        _land(spark, land, months[1:], only="VendorID = 1")
        docs = feeds.month_documents(spark, SMOKE, months[1])
        warmer = F.transform(F.col("hourly.temperature_2m"), lambda x: x + 1)
        writers.land_weather_documents(docs.withColumn("hourly", F.col("hourly").withField("temperature_2m", warmer)), land, months[1])
        if kind == "inc":
            job.run_month(spark, land, wh, months[1], weather_multi_line=False, fail=False, ingested_at=ts, incremental=True)
        else:
            load(months[1])
            job.build_marts(spark, wh)
        roots[kind] = wh
    for name in (*job.DIMENSIONS, "fct_taxi_trips", *job.AGGREGATE_FACTS):
        a = job.read_mart(spark, roots["full"], name)
        b = job.read_mart(spark, roots["inc"], name).select(*a.columns)
        a, b = (x.drop("source_file") for x in (a, b))
        assert a.count() > 0 and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name


def test_csv_export_round_trip(spark, scratch):
    wh = catalog.warehouse(spark, SMOKE)
    df = wh.dim_location
    writers.export_csv(df, f"{scratch}/export")
    back = spark.read.option("header", True).csv(f"{scratch}/export")
    assert back.count() == df.count() and set(back.columns) == set(df.columns)


def test_months_with_different_spellings_union_by_name(spark, scratch):
    base = feeds.landed_trips(spark, SMOKE).drop("file_month").limit(5)
    writers.land_trip_month(base, scratch, "2024-01")
    writers.land_trip_month(base.withColumnRenamed("Airport_fee", "airport_fee").drop("cbd_congestion_fee"),
                            scratch, "2024-02")
    both = landed.read_trip_months(spark, scratch, ["2024-01", "2024-02"])
    # names resolve case-insensitively: the two spellings meet in one column,
    # and the month without cbd_congestion_fee gets NULLs
    assert "cbd_congestion_fee" in both.columns
    raw = normalize.normalize_trips(both, "2024-01", F.col("source_file"), "2024-02-01 00:00:00").collect()
    assert len(raw) == 10 and all(r.airport_fee is not None for r in raw)
    assert sum(r.cbd_congestion_fee is None for r in raw) == 10
    assert {r.source_file.rsplit("/", 2)[-2] for r in raw} == {"month=01", "month=02"}


def test_model_columns_follow_declared_order(spark):
    from stormcab import schemas
    from stormcab.operators import staging
    from stormcab.plans import marts, prototype
    wh = catalog.warehouse(spark, SMOKE)
    assert tuple(wh.raw.trips.columns) == tuple(f.name for f in schemas.RAW_TRIPS.fields)
    assert tuple(wh.stg_taxi_trips.columns) == staging.STG_TRIP_COLUMNS
    assert tuple(wh.stg_weather_hourly.columns) == staging.STG_WEATHER_COLUMNS
    assert tuple(wh.dim_weather.columns) == marts.DIM_WEATHER_COLUMNS
    assert tuple(wh.dim_date_time.columns) == marts.DIM_DATE_TIME_COLUMNS
    assert tuple(wh.fct_taxi_trips.columns) == marts.FCT_TRIP_COLUMNS and len(marts.FCT_TRIP_COLUMNS) == 48
    trips = prototype.clean_trips(feeds.landed_trips(spark, SMOKE).drop("file_month"))
    assert tuple(prototype.star_fact(trips).columns) == prototype.PROTO_FACT_COLUMNS


def test_load_constraints_reject_what_the_ddl_rejects(spark):
    from stormcab import schemas
    from stormcab.plans.warehouse import RawTables
    z = spark.createDataFrame([(1, "Bronx", "a", None, "f", datetime(2024, 1, 1)),
                               (1, "Bronx", "b", None, "f", datetime(2024, 1, 1)),
                               (2, None, "c", None, "f", datetime(2024, 1, 1))],
                              "location_id int, borough string, zone string, service_zone string, "
                              "source_file string, ingested_at timestamp_ntz")
    errs = quality.load_constraint_violations("raw_taxi_zone_lookup", z, schemas.RAW_ZONE, "location_id")
    assert len(errs) == 2 and any(".borough: 1 " in e for e in errs) and any(".location_id: 1 " in e for e in errs)
    wh = catalog.warehouse(spark, SMOKE)
    assert job.load_constraints(RawTables(trips=wh.raw.trips, weather=wh.raw.weather, zones=wh.raw.zones)) == []


def test_weather_streaming_loader_available_now(spark, scratch):
    from stormcab.streaming.landing import start_weather_landing_stream
    land, wh = f"{scratch}/landing", f"{scratch}/warehouse"
    writers.land_weather_documents(feeds.month_documents(spark, SMOKE, MONTH), land, MONTH)
    q = start_weather_landing_stream(spark, land, wh, multi_line=False, name=f"w{abs(hash(scratch))}",
                                     ingested_at="2024-02-01 00:00:00")
    q.awaitTermination(300)
    raw = landed.read_table(spark, wh, "raw_weather_hourly")
    assert raw.count() > 0
    assert raw.count() == raw.select("weather_record_id").distinct().count()


def _scans(df):
    """File scans of a plan, as text."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "FileScan" in line]


def test_a_reader_keeps_the_state_it_started_from(spark, scratch, staged):
    wh, months, raw = scratch, feeds.MONTHS[:2], staged
    for month in months:
        job.load_month(spark, raw[month], wh, month)
    state = job.build_marts(spark, wh)
    reader = state.read(spark, "fct_hourly_demand")
    before = sorted(map(str, reader.collect()))
    smaller = raw[months[1]]
    job.load_month(spark, type(smaller)(smaller.trips.where("vendor_id = 1"), smaller.weather, smaller.zones), wh, months[1])
    after = job.rebuild_months(spark, wh, {months[1]})
    assert sorted(map(str, reader.collect())) == before  # planned before, run after the commit
    assert len(after.read(spark, "fct_hourly_demand").collect()) < len(before)
    first = f"{months[0]}-01"
    assert after.tables["fct_hourly_demand"].folders[first] == state.tables["fct_hourly_demand"].folders[first]  # named again, not copied


def test_commits_conflict_and_clean_up(spark, scratch):
    df = spark.range(4)
    first = commits.commit(spark, commits.latest(spark, scratch), {"t": commits.write(df, scratch, "t")}, "one")
    for _ in range(3):
        last = commits.commit(spark, commits.latest(spark, scratch), {"t": commits.write(df.where("id > 1"), scratch, "t")})
    with pytest.raises(commits.CommitConflict):
        commits.commit(spark, first, {"t": commits.write(df, scratch, "t")})
    assert commits.numbers(spark, scratch) == [0, 1, 2, 3] and last.read(spark, "t").count() == 2
    assert len(commits.children(spark, f"{scratch}/t/load=*")) == 3  # the last state, the one before, and the writer's that lost
    assert len(commits.sweep(spark, scratch)) == 1
    assert commits.latest(spark, scratch).read(spark, "t").count() == 2 and commits.at(spark, scratch, 2).read(spark, "t").count() == 2
    assert not commits.create_text(spark, f"{scratch}/_commits/000000000003.json", "x") and commits.latest(spark, scratch).number == 3
    empty = commits.commit(spark, last, {"t": commits.write(df.limit(0), scratch, "t")})
    assert empty.read(spark, "t").columns == ["id"] and empty.read(spark, "t").count() == 0


def test_key_check_reads_candidate_months_only(spark, scratch, staged):
    months = feeds.MONTHS
    raw = {m: staged[m].trips for m in months}
    for m in months:
        state = writers.replace_month(raw[m], scratch, "trips", "ingestion_month", m)
        state = writers.replace_month(key_filters.key_filter(raw[m]), scratch, key_filters.TABLE, "ingestion_month", m)
    loaded, filters = state.read(spark, "trips"), state.read(spark, key_filters.TABLE)
    clean = raw[months[1]]
    assert key_filters.repeated_keys(clean, loaded, filters, months[1]) is None or key_filters.repeated_keys(clean, loaded, filters, months[1]).count() == 0
    planted = clean.unionByName(raw[months[0]].limit(20).withColumn("ingestion_month", F.lit(f"{months[1]}-01").cast("date")))
    found = key_filters.repeated_keys(planted, loaded, filters, months[1])
    rows = found.collect()
    assert len(rows) == 20 and {str(r.ingestion_month) for r in rows} == {f"{months[0]}-01"}
    keys = [line for line in _scans(found) if "record_hash" in line and "Location" in line and "/trips/" in line]
    assert any(f"ingestion_month#" in line and f"{months[0]}-01" in line.split("PartitionFilters")[1] and f"{months[2]}-01" not in line.split("PartitionFilters")[1] for line in keys)
    nothing = raw[months[0]].limit(0)
    assert key_filters.repeated_keys(nothing, loaded, filters, months[1]) is None


def test_date_slicer_leaves_out_months(spark):
    marts = catalog.published(spark, SMOKE)
    fact = serving.apply_slicers(marts.fct_hourly_demand, serving.Slicers(date_from="2024-01-10", date_to="2024-02-05"))
    [scan] = _scans(fact)
    assert "pickup_month" in scan.split("PartitionFilters")[1].split("PushedFilters")[0]


def test_aggregate_facts_read_the_trip_fact_once(spark, scratch, staged):
    wh = scratch
    job.load_month(spark, staged[MONTH], wh, MONTH)
    state = job.build_marts(spark, wh)
    sums = state.read(spark, job.TRIP_SUMS)
    for name in job.AGGREGATE_FACTS:
        made = job.by_month(getattr(job.marts, name)(sums))
        assert all(f"/{job.TRIP_SUMS}/" in line for line in _scans(made))
        written = state.read(spark, name).select(*made.columns)
        assert made.exceptAll(written).count() == 0 and written.count() == made.count()
    # sums of parts add up to the sums of the whole
    trips = state.read(spark, "fct_taxi_trips")
    parts = job.marts.trip_sums(trips.where("vendor_id = 1")).unionByName(job.marts.trip_sums(trips.where("vendor_id <> 1")))
    a, b = job.marts.fct_hourly_demand(parts), job.marts.fct_hourly_demand(job.marts.trip_sums(trips))
    assert a.exceptAll(b).count() == 0 and a.count() == b.count() > 0


def test_many_months_are_one_scan_a_schema(spark):
    scans = _scans(catalog.QUERIES["src_trip_schemas"](spark, SMOKE))
    assert len(scans) == 3


def test_a_run_goes_on_behind_its_last_finished_step(spark, scratch):
    land, wh = f"{scratch}/landing", f"{scratch}/warehouse"
    _land(spark, land)
    seen = []

    def run(wanted=None):
        def progress(step):
            seen.append(step)
            if step == wanted:
                raise RuntimeError("lost")
        return job.run_month(spark, land, wh, MONTH, weather_multi_line=False, fail=False, progress=progress)

    other = f"{wh}/_journal/2023-01-other/staged"
    spark.range(1).write.parquet(other)  # another month that is loading
    with pytest.raises(RuntimeError):
        run("loaded")
    number = commits.latest(spark, wh).number
    report = run()
    assert commits.latest(spark, wh).number == number + 1  # not loaded again
    assert seen == [*job.STEPS[:4], *job.STEPS] and report.month == MONTH
    assert [f.rsplit("/", 1)[1] for f in _folders(spark, wh)] == ["2023-01-other"]  # its own files are gone, the other's are not
    land_again = feeds.landed_month(spark, SMOKE, MONTH).where("VendorID = 1")
    first = job.input_fingerprint(spark, land, MONTH)
    writers.land_trip_month(land_again, land, MONTH)
    assert job.input_fingerprint(spark, land, MONTH) != first  # other files are another run
