"""Tables bucketed by their key (P11, Q2, K6): checks and joins on the key need no shuffle.

A bucketed table keeps the rows of one key hash in one file of each task, and the catalog says so.
Grouping by the key, or joining two tables with the same number of buckets on it, then reads bucket by
bucket: the one shuffle is paid when the table is written (`write`, which brings each bucket's rows together first, so
a bucket is one file).  Size `buckets` for the table at its largest, about its bytes / 512 MB.

The files are an external table: dropping it from the catalog leaves them, and `attach` names them again in another
session.  A key that many rows share is in one bucket; the keys here are MD5 texts, unique or nearly so.
"""

from __future__ import annotations

import contextlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import commits

_AUTO = "spark.sql.sources.bucketing.autoBucketedScan.enabled"


def width(spark: SparkSession, least: int) -> int:
    """Buckets for a table as large as the session's shuffles: as wide as these, so that a bucket is sorted without spilling."""
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions")))


@contextlib.contextmanager
def _by_bucket(spark: SparkSession):
    """Bucketed tables are scanned bucket by bucket, also for a write alone: rows that come dealt out by the key are not shuffled again."""
    own = spark.conf.get(_AUTO)
    spark.conf.set(_AUTO, "false")
    try:
        yield
    finally:
        spark.conf.set(_AUTO, own)


def write(df: DataFrame, name: str, path: str, key: str, buckets: int) -> DataFrame:
    """Write `df` as table `name` at `path`, bucketed and sorted by `key`; an older one of that name is replaced.

    Rows that are dealt out by `key` in as many parts already are not shuffled: Spark leaves the second dealing out."""
    df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")
    with _by_bucket(df.sparkSession):
        (df.repartition(buckets, key).write.mode("overwrite").format("parquet").option("path", path).options(**commits.ENCODING)
           .bucketBy(buckets, key).sortBy(key).saveAsTable(name))
    return df.sparkSession.table(name)


def attach(spark: SparkSession, name: str, path: str, key: str, buckets: int) -> DataFrame:
    """Name the files of a bucketed table in this session's catalog."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet LOCATION '{path}' CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS")
    return spark.table(name)


def repeated(table: DataFrame, key: str) -> DataFrame:
    """Q2: keys that occur more than once, and how often."""
    return table.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def known_keys(new: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """K4/K6: keys of `new` that `table` has; both bucketed alike."""
    return new.select(key).join(table.select(key), key, "left_semi")
