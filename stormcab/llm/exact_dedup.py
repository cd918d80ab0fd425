"""Exact dedup (operator 3): a minimal perfect hash over the distinct digests of the past.

History is a set of distinct digests, each with the locator (largest doc_id) of
its winner.  It is cut into buckets by the digest's first bytes; each bucket
gets a minimal perfect hash of its own, levels of bit vectors: a digest sits at
the first level where no other digest of the bucket falls on its bit, and its
slot is the number of bits set before its bit.  Slot tables hold the full digest
and the winner's locator and size; the bit vectors, a few bits a digest, are the
index.  A new digest is hashed to its only possible slot and compared with
the full digest there: equal, it repeats the past; else it is new, and the new
ones are grouped among themselves.

Scale: texts are read once, by a map that makes 32-byte digests; digests are
grouped with combining before the shuffle, so a text that a third of all rows
share is one row from then on.  Buckets are even because digests are.  The way
back from groups to rows broadcasts the at most 1,024 largest groups and
shuffles the rest.

Defined results: null and empty texts are equal to each other; ties do not
arise (doc_ids decide); repeated rows (same doc_id, same text) are members of
their group each and kept with the same flag; a null doc_id is kept in the output,
wins nothing unless its whole group has null ids, and `kept` is false for it; an empty table
gives no row; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import frame, mix64, row_of, saved, sorted_groups, split_join, table, texts

BUCKET_DIGESTS = 4096  # mean number of digests in a bucket
GAMMA = 2.0  # bits of a level for each digest that is still unplaced


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, row, digest): SHA-256 of the text with A-Z lower-cased, as 32 bytes; `row` tells apart
    rows of one id with different texts."""
    schema = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("digest", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = [hashlib.sha256(t.lower()).digest() for t in texts(batch)]  # bytes.lower is A-Z only
            yield frame(schema, doc_id=batch.column("doc_id").cast(pa.int64()), row=batch.column("row"), digest=hashes)

    named = docs.select(F.col(id_col).alias("doc_id"), row_of(text_col), F.col(text_col).alias("text"))
    return named.mapInArrow(run, "doc_id long, row long, digest binary")


def digest_groups(rows: DataFrame) -> DataFrame:
    """One row for each distinct digest: winner (largest doc_id) and size."""
    return rows.groupBy("digest").agg(F.max("doc_id").alias("winner"), F.count(F.lit(1)).alias("n"))


def level_positions(words: np.ndarray, level: int, size: int) -> np.ndarray:
    """The bit of each digest (four 64-bit words) in a level of `size` bits."""
    x = np.full(len(words), level + 1, np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for k in range(4):
        x = mix64(x ^ words[:, k])
    return (x % np.uint64(size)).astype(np.int64)


def build_levels(words: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Levels of bits for distinct digests, and each digest's slot: a bijection to 0..n-1."""
    levels, slots, left, placed = [], np.zeros(len(words), np.int64), np.arange(len(words)), 0
    while len(left):
        size = max(8, int(GAMMA * len(left)))
        at = level_positions(words[left], len(levels), size)
        alone = np.bincount(at, minlength=size) == 1
        levels.append(alone)
        fits = alone[at]
        slots[left[fits]] = placed + (np.cumsum(alone) - 1)[at[fits]]
        placed += int(alone.sum())
        left = left[~fits]
    return levels, slots


def lookup(levels: list[np.ndarray], words: np.ndarray) -> np.ndarray:
    """The only slot that each digest can have; -1 for a digest that cannot be a member."""
    slots, left, placed = np.full(len(words), -1, np.int64), np.arange(len(words)), 0
    for k, bits in enumerate(levels):
        at = level_positions(words[left], k, len(bits))
        hit = bits[at]
        slots[left[hit]] = placed + (np.cumsum(bits) - 1)[at[hit]]
        placed += int(bits.sum())
        left = left[~hit]
    return slots


def words_of(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), ">u8").reshape(-1, 4).astype(np.uint64)


def bucketed(groups: DataFrame, buckets: int) -> DataFrame:
    """`bucket` from the digest's first four bytes."""
    first = F.conv(F.substring(F.hex("digest"), 1, 8), 16, 10).cast("long")
    return groups.withColumn("bucket", (first * F.lit(buckets) / F.lit(1 << 32)).cast("long"))


def build_history(groups: DataFrame, buckets: int) -> tuple[DataFrame, DataFrame]:
    """(slots, index) over distinct digests.  slots: bucket, slot, digest, winner, n.
    index: bucket, bits (each level's size, then its packed bits)."""
    schema = pa.schema([("bucket", pa.int64()), ("slot", pa.int64()), ("digest", pa.binary()), ("winner", pa.int64()), ("n", pa.int64()), ("bits", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def built(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            rows = pa.Table.from_batches(parts)
            levels, slots = build_levels(words_of(rows.column("digest")))
            bits = b"".join(len(b).to_bytes(8, "little") + np.packbits(b).tobytes() for b in levels)
            order = [x.combine_chunks() for x in (rows.column("bucket"), rows.column("digest"), rows.column("winner"), rows.column("n"))]
            return frame(schema, bucket=order[0], slot=slots, digest=order[1], winner=order[2], n=order[3], bits=[bits] + [None] * (len(slots) - 1))

        held: list[pa.RecordBatch] = []
        for new, rows in sorted_groups(batches, ["bucket"]):
            if new and held:
                yield built(held)
                held = []
            held.append(rows)
        if held:
            yield built(held)

    out = saved(bucketed(groups, buckets).repartition("bucket").sortWithinPartitions("bucket").select("bucket", "digest", "winner", "n")
                .mapInArrow(run, "bucket long, slot long, digest binary, winner long, n long, bits binary"))
    return out.drop("bits"), out.where("bits is not null").select("bucket", "bits")


def probe(groups: DataFrame, slots: DataFrame, index: DataFrame, buckets: int) -> DataFrame:
    """New digests with what history holds for them: digest, winner, n, old_winner, old_n (null: not a member)."""
    schema = pa.schema([("bucket", pa.int64()), ("slot", pa.int64()), ("digest", pa.binary()), ("winner", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels: list[np.ndarray] = []
        for new, rows in sorted_groups(batches, ["bucket"]):
            if new:
                levels = []
            bits = [b for b in rows.column("bits").to_pylist() if b is not None]
            if bits:  # the index row comes first in its bucket
                raw, at = bits[0], 0
                while at < len(raw):
                    size = int.from_bytes(raw[at:at + 8], "little")
                    packed = (size + 7) // 8
                    levels.append(np.unpackbits(np.frombuffer(raw, np.uint8, packed, at + 8))[:size].astype(bool))
                    at += 8 + packed
            rows = rows.filter(pc.is_valid(rows.column("digest")))
            if rows.num_rows:
                found = lookup(levels, words_of(rows.column("digest")))
                yield frame(schema, bucket=rows.column("bucket"), slot=found, digest=rows.column("digest"), winner=rows.column("winner"), n=rows.column("n"))

    asked = bucketed(groups, buckets).select("bucket", "digest", "winner", "n", F.lit(None).cast("binary").alias("bits"))
    told = index.select("bucket", F.lit(None).cast("binary").alias("digest"), F.lit(None).cast("long").alias("winner"), F.lit(None).cast("long").alias("n"), "bits")
    hashed = (told.unionByName(asked).repartition("bucket").sortWithinPartitions("bucket", F.col("digest").isNotNull())
              .mapInArrow(run, "bucket long, slot long, digest binary, winner long, n long"))
    old = slots.select("bucket", "slot", F.col("digest").alias("old_digest"), F.col("winner").alias("old_winner"), F.col("n").alias("old_n"))
    checked = F.col("old_digest") == F.col("digest")  # the byte check
    return (hashed.join(old, ["bucket", "slot"], "left")
            .select("digest", "winner", "n", F.when(checked, F.col("old_winner")).alias("old_winner"), F.when(checked, F.col("old_n")).alias("old_n"), checked.alias("member")))


def exact_dedup(docs: DataFrame, is_history, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, row, keep_id, group_size, kept, text_sha256, repeats_history) for every row of `docs`.

    `is_history` is a column over the id that tells which rows are the past; every row is in the
    result and groups run across both parts."""
    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = saved(digests(named).withColumn("past", F.coalesce(is_history, F.lit(False))))
    past = digest_groups(rows.where("past"))
    fresh = digest_groups(rows.where("not past"))
    buckets = max(1, rows.count() // BUCKET_DIGESTS)
    slots, index = build_history(past, buckets)
    probed = saved(probe(fresh, slots, index, buckets))
    repeats = probed.where("member").select("digest", F.greatest("winner", "old_winner").alias("keep_id"), (F.col("n") + F.col("old_n")).alias("group_size"), F.lit(True).alias("member"))
    new = probed.where("member is null or not member").select("digest", F.col("winner").alias("keep_id"), F.col("n").alias("group_size"), F.lit(False).alias("member"))
    alone = (slots.join(repeats.select("digest"), "digest", "left_anti")
             .select("digest", F.col("winner").alias("keep_id"), F.col("n").alias("group_size"), F.lit(False).alias("member")))
    groups = saved(repeats.unionByName(new).unionByName(alone))
    return split_join(rows, groups, "digest", "group_size").select(
        "doc_id", "row", "keep_id", "group_size", F.coalesce(F.col("doc_id") == F.col("keep_id"), F.lit(False)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"), (~F.col("past") & F.col("member")).alias("repeats_history"))


def earlier_half(id_col: str = "doc_id"):
    """The query's past: about half of the documents, by the first hex digit of the id's MD5; the others are probed."""
    return F.substring(F.md5(F.col(id_col).cast("string")), 1, 1) < "8"


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Winner, group size and digest of every document."""
    return exact_dedup(table(spark, sf_dir, "documents"), earlier_half()).drop("row")


OP3_SQL = """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256,
         coalesce(substr(md5(doc_id::VARCHAR), 1, 1) < '8', false) AS past
  FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, coalesce(doc_id = max(doc_id) OVER g, false) AS kept,
       text_sha256, NOT past AND bool_or(past) OVER g AS repeats_history
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""
