"""Sharding (operator 4): contiguous balanced shards from global byte-size prefix sums.

Documents in id order are cut at equal byte targets.  A document's place is its
global prefix sum: the bytes of all partitions before its own, plus the bytes
before it inside its partition.  Only (id, size, checksum) is dealt out by range
and sorted; each partition then adds up its own rows, and the one row of totals
that each partition leaves (as many rows as partitions) gives the offsets.

A document belongs to the shard in which its middle byte lies, so a shard's
bytes differ from the target by at most one document at either end.

Defined results: a null text has size 1 and the checksum of no bytes; repeated
rows and equal ids are ordered by size and checksum, and rows equal in all three
are interchangeable; null ids come first; an empty table gives no row; other
columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import frame, partitions, saved, table, texts

SHARDS = 16


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32): UTF-8 bytes plus one, and the unsigned CRC-32 of the text."""
    schema = pa.schema([("doc_id", pa.int64()), ("size", pa.int64()), ("text_crc32", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = texts(batch, text_col)
            yield frame(schema, doc_id=batch.column(id_col).cast(pa.int64()), size=[len(t) + 1 for t in raw], text_crc32=[zlib.crc32(t) for t in raw])

    return docs.select(id_col, text_col).mapInArrow(run, "doc_id long, size long, text_crc32 long")


def prefix_sums(rows: DataFrame, order: list[str], size: str = "size") -> tuple[DataFrame, DataFrame]:
    """(`rows` with bytes_before and rows_before inside their range partition `part`, totals of each part)."""
    columns = [c for c in rows.columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, count = 0, 0
        for batch in batches:
            sizes = batch.column(size).to_numpy(zero_copy_only=False)
            ends = done + np.cumsum(sizes)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), batch.column("part"), pa.array(ends - sizes, pa.int64()), pa.array(count + np.arange(len(sizes)), pa.int64())],
                                             [*columns, "part", "bytes_before", "rows_before"])
            done, count = int(ends[-1]) if len(ends) else done, count + len(sizes)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    ranged = (rows.repartitionByRange(partitions(rows.sparkSession), *order).sortWithinPartitions(*order)
              .withColumn("part", F.spark_partition_id().cast("long")))
    local = saved(ranged.mapInArrow(run, f"{fields}, part long, bytes_before long, rows_before long"))
    totals = local.groupBy("part").agg(F.sum(size).alias("bytes"), F.count(F.lit(1)).alias("rows"))
    return local, totals


def byte_shards(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for every row of `docs`."""
    local, totals = prefix_sums(measured(docs, id_col, text_col), ["doc_id", "size", "text_crc32"])
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # one row for each partition, not for each document
    offsets = totals.select("part", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("part_bytes"), F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("part_rows"), F.sum("bytes").over(everything).alias("all_bytes"))
    placed = (local.join(F.broadcast(offsets), "part")
              .withColumn("start", F.col("part_bytes") + F.col("bytes_before")).withColumn("row", F.col("part_rows") + F.col("rows_before"))
              .withColumn("shard", F.expr(f"((2 * start + size) * {shards}) div (2 * all_bytes)").cast("int")))
    first = placed.groupBy("shard").agg(F.min("row").alias("first_row"))  # one row for each shard
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("row") - F.col("first_row")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sixteen contiguous shards of near equal bytes."""
    return byte_shards(table(spark, sf_dir, "documents"))
