"""One shuffle serves the deduplication, the buckets and the joins by key."""

import glob
import uuid
from datetime import datetime

from conftest import SMOKE
from pyspark.sql import functions as F

from registry import catalog, feeds
from stormcab.operators import normalize
from stormcab.plans import prototype
from stormcab.sources import bucketed

RUN = "2025-02-01 06:00:00"
COLUMNS = ("VendorID int, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, trip_distance double, fare_amount double, "
           "total_amount double, PULocationID int, DOLocationID int, tip_amount double")


def trips(spark):
    a, b = datetime(2025, 1, 6, 8, 0), datetime(2025, 1, 6, 8, 20)
    rows = [(2, a, b, 2.5, 10.0, 12.0, 1, 2, 0.0), (2, a, b, 2.5, 10.0, 12.0, 1, 2, -0.0), (1, a, b, 2.5, 10.0, 12.0, 1, 2, None), (1, a, b, 2.5, 10.0, 12.0, 1, 2, None),
            (None, a, b, 3.5, 10.0, 12.0, None, 2, 1.0), (1, b, a, 2.5, 10.0, 12.0, 1, 2, 1.0), (None,) * 9, (None,) * 9]
    return spark.createDataFrame(rows, COLUMNS)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_months_are_deduplicated_and_dealt_out_in_one_shuffle(spark):
    months = ("2025-01", "2025-02")
    rows = trips(spark).crossJoin(spark.createDataFrame([(m,) for m in months], "m string"))
    found = normalize.raw_trips_by_key(rows, F.col("m"), "f", RUN, 16)
    assert plan(found).count("Exchange hashpartitioning") == 1
    each = [normalize.raw_trips(trips(spark), m, "f", RUN) for m in months]
    want = each[0].unionByName(each[1])
    text = found.withColumn("record_hash", F.lower(F.hex("record_hash")))
    assert found.columns == want.columns and sorted(map(repr, text.collect())) == sorted(map(repr, want.collect())) and want.count() == 8


def test_rows_dealt_out_by_the_key_are_written_without_a_shuffle(spark, scratch):
    rows = spark.range(2000).select(F.md5((F.col("id") % 900).cast("string")).alias("k"), "id")
    name = f"t_{uuid.uuid4().hex}"
    table = bucketed.write(rows, name, f"{scratch}/t", "k", 8)
    own = spark.conf.get("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    again = bucketed.write(table.where("id % 2 = 0"), f"{name}_new", f"{scratch}/new", "k", 8)
    assert spark.conf.get("spark.sql.sources.bucketing.autoBucketedScan.enabled") == own
    assert len(glob.glob(f"{scratch}/new/*.parquet")) == 8 and again.count() == 1000  # one file a bucket: each was read and written by itself
    assert all(x.endswith(".zstd.parquet") or ".zstd" in x for x in glob.glob(f"{scratch}/*/*.parquet"))


def test_buckets_are_as_many_as_parts_of_a_shuffle(spark):
    own = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for given, want in (("8", 16), ("16", 16), ("200", 200)):
            spark.conf.set("spark.sql.shuffle.partitions", given)
            assert bucketed.width(spark, 16) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", own)


def test_cleaned_trips_by_key_are_the_cleaned_trips(spark):
    by_key, want = prototype.clean_trips_by_key(trips(spark), 16), prototype.clean_trips(trips(spark))
    assert plan(by_key).count("Exchange hashpartitioning") == 1 and by_key.columns == want.columns
    text = by_key.withColumn("trip_id", F.lower(F.hex("trip_id")))
    assert sorted(map(repr, text.collect())) == sorted(map(repr, want.collect())) and want.count() == 3


def test_merged_fact_joins_its_dimensions_without_a_shuffle(spark):
    fact = catalog.QUERIES["proto_fact_merged"](spark, SMOKE)
    own = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for large dimensions; the location ids are shuffled, which are few
        joins = plan(fact.select("*"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", own)
    assert "hashpartitioning(trip_id" not in joins and "hashpartitioning(_" not in joins.replace("hashpartitioning(_pickup_location_id", "").replace("hashpartitioning(_dropoff_location_id", "")
    cleaned = catalog._proto_trips(spark, SMOKE)
    at = [r.PULocationID for r in cleaned.where("VendorID = 1").select("PULocationID").distinct().collect()]
    want = catalog.to_output(prototype.star_fact(cleaned.where(F.col("PULocationID").isin(at) & F.col("RatecodeID").isNotNull())))
    assert fact.columns == want.columns and fact.count() == want.count() > 1000
    assert fact.exceptAll(want).count() == 0


def test_bucketed_keys_are_found_for_each_month(spark):
    found = catalog.QUERIES["dq_bucketed_keys"](spark, SMOKE)
    raw = None
    for month in feeds.MONTHS:
        rows = catalog._monthly_trips(spark, SMOKE, month)
        raw = rows if raw is None else raw.unionByName(rows)
    twice = raw.groupBy("record_hash").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select(F.lit("repeated").alias("finding"), "record_hash", "rows")
    known = raw.where(f"ingestion_month = DATE '{feeds.MONTHS[1]}-01' and vendor_id = 1").select(F.lit("known").alias("finding"), "record_hash", F.lit(1).cast("bigint").alias("rows"))
    assert sorted(found.collect()) == sorted(twice.unionByName(known).collect())
