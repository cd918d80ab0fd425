"""Readers for landed feeds and the warehouse tables.

Layout of a landing root (month-partitioned, Hive style):

    <root>/taxi/<dataset>/year=YYYY/month=MM/<dataset>_tripdata_YYYY-MM.parquet
    <root>/weather/year=YYYY/month=MM/<borough>.json     (one document each)
    <root>/reference/taxi_zone_lookup.csv

Trip months of one schema are read together and schemas combined with
`unionByName(allowMissingColumns=True)`: monthly files disagree on column
spellings and types, which a merged-schema read would reject.
"""

from __future__ import annotations

import contextlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from . import commits


SPLIT_BYTES = 32 * 1024 * 1024  # of landed files: rows that a task sorts without spilling
_SPLIT = "spark.sql.files.maxPartitionBytes"


@contextlib.contextmanager
def small_splits(spark: SparkSession):
    """Scans started within read at most `SPLIT_BYTES` a task; a smaller setting of the session stays."""
    own = spark.conf.get(_SPLIT)
    if spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(own) <= SPLIT_BYTES:
        yield
        return
    spark.conf.set(_SPLIT, str(SPLIT_BYTES))
    try:
        yield
    finally:
        spark.conf.set(_SPLIT, own)


def trip_root(root: str, dataset: str = "yellow") -> str:
    return f"{root}/taxi/{dataset}"


def trip_month_dir(root: str, month: str, dataset: str = "yellow") -> str:
    year, mm = month.split("-")
    return f"{trip_root(root, dataset)}/year={year}/month={mm}"


def trip_month_file(root: str, month: str, dataset: str = "yellow") -> str:
    return f"{trip_month_dir(root, month, dataset)}/{dataset}_tripdata_{month}.parquet"


def weather_month_dir(root: str, month: str) -> str:
    year, mm = month.split("-")
    return f"{root}/weather/year={year}/month={mm}"


def zone_file(root: str) -> str:
    return f"{root}/reference/taxi_zone_lookup.csv"


def read_trip_month(spark: SparkSession, root: str, month: str, dataset: str = "yellow") -> DataFrame:
    """One month of landed trips plus its file path (`source_file`)."""
    df = spark.read.parquet(trip_month_dir(root, month, dataset))
    return df.withColumn("source_file", F.col("_metadata.file_path"))


def read_trip_months(spark: SparkSession, root: str, months: list[str], dataset: str = "yellow") -> DataFrame:
    """S1 over several months: union by name, missing columns as NULL.

    Files disagree on spellings and types, so they are grouped by the schema in their footers and each
    schema is one scan, however many months there are."""
    groups: dict[str, list[str]] = {}
    for month in months:
        path = trip_month_dir(root, month, dataset)
        groups.setdefault(spark.read.parquet(path).schema.json(), []).append(path)
    out = None
    for schema, paths in groups.items():
        df = (spark.read.schema(T.StructType.fromJson(json.loads(schema))).parquet(*paths)
              .withColumn("source_file", F.col("_metadata.file_path")))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def read_weather_documents(spark: SparkSession, root: str, month: str, multi_line: bool = True) -> DataFrame:
    """The month's weather documents with a declared schema.

    `multi_line=True` for files holding one (pretty-printed) document each, as
    the weather archive delivers them; False for JSON-lines files.
    """
    return (spark.read.schema(schemas.WEATHER_PAYLOAD).option("multiLine", multi_line)
            .json(weather_month_dir(root, month))
            .withColumn("source_file", F.col("_metadata.file_path")))


def read_zone_lookup(spark: SparkSession, root: str) -> DataFrame:
    """S3: zone lookup CSV with header; the text N/A stays text."""
    return spark.read.schema(schemas.ZONE_CSV).option("header", True).csv(zone_file(root))


def read_table(spark: SparkSession, warehouse: str, name: str) -> DataFrame:
    """A warehouse table as last committed; filters on its partition column prune directories."""
    return commits.latest(spark, warehouse).read(spark, name)
