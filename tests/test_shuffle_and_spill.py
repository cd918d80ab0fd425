"""Plans and files of the steps that every trip passes: what is sorted, shuffled and written."""

import glob
from datetime import datetime

from pyspark.sql import functions as F

from stormcab.operators import normalize, quality
from stormcab.plans import marts, prototype
from stormcab.sources import commits, landed

RUN = "2025-02-01 06:00:00"
COLUMNS = ("VendorID int, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, trip_distance double, fare_amount double, "
           "total_amount double, PULocationID int, DOLocationID int, tip_amount double")


def trips(spark):
    a, b, c = (datetime(2025, 1, 6, 8, m) for m in (0, 20, 40))
    return spark.createDataFrame([(2, a, b, 2.5, 10.0, 12.0, 1, 2, 3.0), (1, a, b, 2.5, 10.0, 12.0, 1, 2, 4.0), (1, a, b, 2.5, 10.0, 12.0, 1, 2, None),
                                  (1, a, b, 2.5, 10.0, 12.0, 1, 2, None), (1, b, a, 2.5, 10.0, 12.0, 1, 2, 1.0), (1, b, b, 2.5, 10.0, 12.0, 1, 2, 1.0),
                                  (1, b, None, 2.5, 10.0, 12.0, 1, 2, 1.0), (1, b, c, 2.5, None, 12.0, 1, 2, 1.0), (1, a, c, 0.0, 10.0, 12.0, 1, 2, 1.0)], COLUMNS)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def lines(df, start: str) -> list[str]:
    return [x for x in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if x.lstrip(" :+-").startswith(start)]


def test_raw_trips_are_sorted_behind_the_shuffle_only_and_keep_the_first(spark):
    landed = trips(spark)
    raw = normalize.raw_trips(landed, "2025-01", "f", RUN)
    assert "WindowGroupLimit" not in plan(raw)
    assert raw.columns == normalize.RAW_TRIP_COLUMNS
    every = normalize.normalize_trips(landed, "2025-01", "f", RUN).collect()
    kept = raw.collect()
    assert len(kept) == len({r.record_hash for r in every}) == 6
    assert {r.record_hash for r in kept} == {r.record_hash for r in every} and all(r in every for r in kept)
    twice = [r for r in kept if r.tip_amount is None]  # the smallest vendor, then no tip before a tip
    assert len(twice) == 1 and twice[0].vendor_id == 1


def _staged(spark, folder, rows):
    """Raw rows by way of the staged ones, and the plan that makes these."""
    rows.write.mode("overwrite").parquet(f"{folder}/landed")
    given = spark.read.parquet(f"{folder}/landed")
    normalize.repeated_hash_keys(given, "2025-01", "f").write.mode("overwrite").parquet(f"{folder}/repeated")
    repeated = spark.read.parquet(f"{folder}/repeated")
    staged = normalize.staged_trips(given, "2025-01", "f", RUN, repeated)
    assert "record_hash" not in staged.columns
    staged.write.mode("overwrite").options(**commits.ENCODING).parquet(f"{folder}/staged")
    return normalize.with_record_hash(spark.read.parquet(f"{folder}/staged")), plan(staged), repeated.count()


def test_staged_trips_shuffle_repeated_rows_only(spark, scratch):
    every = trips(spark)
    nulls = spark.createDataFrame([(None,) * 9] * 3 + [(1, *(None,) * 8)], COLUMNS)
    for rows, several in ((every, 1), (every.unionByName(nulls), 2), (every.unionByName(every), 6), (every.limit(0), 0), (every.where("trip_distance = 0"), 0)):
        raw, text, found = _staged(spark, scratch, rows)
        want = normalize.raw_trips(rows, "2025-01", "f", RUN)
        assert found == several and ("Window" in text) == (several > 0)
        assert several or "Exchange" not in text
        assert raw.columns == want.columns
        assert sorted(map(repr, raw.collect())) == sorted(map(repr, want.collect()))


def test_staged_trips_lie_in_the_order_of_pickup(spark, scratch):
    t = [datetime(2025, 1, 6, 8, m) for m in (50, 10, 40, 20, 30)]
    rows = spark.createDataFrame([(1, x, None, 2.5, 10.0, 12.0, i, 2, 3.0) for i, x in enumerate(t)], COLUMNS).coalesce(1)
    raw, _, _ = _staged(spark, scratch, rows)
    assert [r.pickup_datetime for r in raw.collect()] == sorted(t)


def test_landed_files_are_read_in_small_splits_for_the_sort_only(spark):
    key = "spark.sql.files.maxPartitionBytes"
    own = spark.conf.get(key)
    try:
        for given, within in (("128m", str(landed.SPLIT_BYTES)), ("16m", "16m"), ("134217728", str(landed.SPLIT_BYTES))):
            spark.conf.set(key, given)
            with landed.small_splits(spark):
                assert spark.conf.get(key) == within
            assert spark.conf.get(key) == given
    finally:
        spark.conf.set(key, own)


def test_trip_sums_do_not_shuffle_what_follows_from_the_hour(spark):
    hours = [datetime(2024, 1, 5, 7), datetime(2024, 1, 6, 23), datetime(2024, 1, 7, 0)]
    fct = spark.createDataFrame([(h, 1, "Queens", "A", "k", "clear", "Cash", 1.0, 2.0) for h in hours * 2],
                                "pickup_hour timestamp_ntz, pickup_location_id int, pickup_borough string, pickup_zone string, weather_key string, "
                                "weather_severity string, payment_type_name string, trip_duration_min double, fare_per_mile double")
    for c in ("passenger_count", "trip_distance", "fare_amount", "total_amount", "tip_amount", "precipitation_mm", "temperature_2m"):
        fct = fct.withColumn(c, F.lit("1.00").cast("decimal(10,2)"))
    derived = {"date_hour_key": F.lit(0).cast("bigint"), "date_key": F.lit(0).cast("bigint"), "pickup_date": F.col("pickup_hour").cast("date"),
               "is_weekend": F.lit(True), "is_rush_hour": F.lit(True)}
    sums = marts.trip_sums(fct.withColumns(derived))
    exchanged = [x for x in plan(sums).splitlines() if "hashpartitioning" in x]
    assert exchanged and not any(c in x for x in exchanged for c in ("date_hour_key", "date_key", "pickup_date", "is_weekend", "is_rush_hour"))
    found = sorted((r.date_hour_key, r.date_key, str(r.pickup_date), r.is_weekend, r.is_rush_hour, r.trips) for r in sums.collect())
    assert found == [(2024010507, 20240105, "2024-01-05", False, True, 2), (2024010623, 20240106, "2024-01-06", True, False, 2),
                     (2024010700, 20240107, "2024-01-07", True, False, 2)]


def test_prototype_filter_is_cheap_below_the_deduplication(spark):
    clean = prototype.clean_trips(trips(spark))
    assert not any("unix_date" in x or "unixdate" in x.lower() for x in lines(clean, "Filter"))
    assert sorted((r.VendorID, r.tip_amount or 0.0, r.trip_duration_min) for r in clean.collect()) == [(1, 0.0, 20.0), (1, 4.0, 20.0), (2, 3.0, 20.0)]


def test_whole_rows_are_deduplicated_by_a_sort_behind_one_shuffle(spark):
    nan = float("nan")
    rows = [(1, 0.0, "a", 1.5), (1, -0.0, "a", 1.5), (1, nan, "a", 1.5), (1, nan, "a", 1.5), (None, None, None, None), (None, None, None, None),
            (1, 0.0, None, 1.5), (1, None, "a", 1.5), (2, 0.0, "a", 1.5), (1, 0.0, "A", 1.5)]
    df = spark.createDataFrame(rows * 2, "a int, `b.c` double, d string, e float")
    once = prototype.whole_rows_once(df)
    assert once.schema == df.schema
    assert sorted(map(repr, once.collect())) == sorted(map(repr, df.dropDuplicates().collect())) and once.count() == 7
    text = plan(prototype.clean_trips(trips(spark)))
    assert "HashAggregate" not in text and text.count("Exchange") == 1


def test_repeated_keys_of_any_form_are_counted(spark):
    md5 = "00112233445566778899aabbccddeeff"
    raw = bytes.fromhex("41" * 16)
    keys = [md5, md5, md5.upper(), raw.hex(), raw.decode(), "x", "x", "x", "", None, None, "y", md5 + "\n"]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    found = quality.unique_failures(df, "k")
    assert "unhex" in plan(found) and found.first().n == 2
    assert quality.unique_failures(spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int"), "k").first().n == 1


def test_partitions_are_written_side_by_side_and_small(spark, scratch):
    df = spark.range(0, 100, 1, 2).select("id", F.md5(F.col("id").cast("string")).alias("h"), (F.col("id") % 20).cast("string").alias("p"))
    table = commits.write(df, scratch, "t", "p")
    assert len(table.folders) == 20  # more than a task keeps open
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"
    files = glob.glob(f"{scratch}/t/**/*.parquet", recursive=True)
    assert files and all(f.endswith(".zstd.parquet") for f in files)
    back = commits.Snapshot(scratch, tables={"t": table}).read(spark, "t")
    assert sorted(back.collect()) == sorted(df.select("id", "h", "p").collect())
