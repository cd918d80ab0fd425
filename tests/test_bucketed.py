"""Bucketed tables: key checks without a shuffle; refused feeds; the merged prototype fact."""

import uuid

import pytest
from pyspark.sql import functions as F

from conftest import SMOKE
from registry import catalog
from stormcab.operators import normalize
from stormcab.plans import prototype
from stormcab.sources import bucketed


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("attached", [False, True])
def test_key_checks_of_bucketed_tables_have_no_exchange(spark, scratch, attached):
    name = f"t_{uuid.uuid4().hex}"
    rows = spark.range(1000).select(F.md5((F.col("id") % 900).cast("string")).alias("k"), "id")
    table = bucketed.write(rows, name, f"{scratch}/t", "k", 4)
    new = bucketed.write(rows.where("id < 50").unionByName(spark.range(2000, 2010).select(F.md5(F.col("id").cast("string")).alias("k"), "id")), f"{name}_new", f"{scratch}/new", "k", 4)
    if attached:  # as another session would
        table, new = bucketed.attach(spark, name, f"{scratch}/t", "k", 4), bucketed.attach(spark, f"{name}_new", f"{scratch}/new", "k", 4)
    twice = bucketed.repeated(table, "k")
    known = bucketed.known_keys(new, table.hint("merge"), "k")
    for df in (twice, known):
        assert "Exchange hashpartitioning" not in _plan(df) and "Bucketed: true" in _plan(df)
    assert twice.count() == 100 and known.count() == 50
    spark.sql(f"DROP TABLE {name}")
    assert spark.read.parquet(f"{scratch}/t").count() == 1000  # an external table's files stay


def test_rejected_documents_are_those_that_stop_a_load(spark):
    docs = spark.createDataFrame(
        [("Bronx", (["2025-01-01T00:00"], [1.0], [0.0], [0.0], [0.0], [1.0], [0])), ("Queens", ([], [], [], [], [], [], [])),
         ("Manhattan", (["2025-01-01T00:00", "2025-01-01T01:00"], [1.0], [0.0], [0.0], [0.0], [1.0], [0])), (None, None)],
        "requested_borough string, hourly struct<time: array<string>, temperature_2m: array<double>, precipitation: array<double>, rain: array<double>, "
        "snowfall: array<double>, windspeed_10m: array<double>, weathercode: array<int>>").withColumn("source_file", F.lit("f"))
    bad = {r.requested_borough: r.problem for r in normalize.rejected_documents(docs).collect()}
    assert set(bad) == {"Queens", "Manhattan", None} and "differ in length" in bad["Manhattan"] and "no hours" in bad["Queens"]
    assert normalize.flatten_weather_documents(docs.where("requested_borough = 'Bronx'"), "2025-01").count() == 1
    for borough, problem in bad.items():
        with pytest.raises(Exception, match=problem.split(":")[0].replace("?", r"\?")):
            normalize.flatten_weather_documents(docs.where(F.col("requested_borough").eqNullSafe(F.lit(borough))), "2025-01").collect()


def test_merged_fact_equals_the_star_fact(spark):
    trips = catalog._proto_trips(spark, SMOKE).limit(200).checkpoint()
    merged, fact = prototype.merged_fact(trips, prototype.dimensions(trips)), prototype.star_fact(trips)
    assert merged.columns == fact.columns and merged.count() == fact.count() > 100
    assert merged.exceptAll(fact).count() == 0
