"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
import os
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# White space of the word rule `[^\x20\x09-\x0D]+`; `bytes.split()` follows the same rule.
WORD = r"[^\x20\x09-\x0D]+"
MASK = (1 << 64) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint directory in the folder that `spark.checkpoint.dir` names.

    Only a local session with neither that setting nor a checkpoint directory (a test) gets a folder here."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured is None and not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(configured or tempfile.mkdtemp(prefix="run-", dir=os.environ.get("TMPDIR", "/tmp")))
    return sc.getCheckpointDir()


def saved(df: DataFrame) -> DataFrame:
    """`df` written to the shared folder and read back, so that a lost executor costs a re-read and not
    a recomputation of what came before.

    Spark deletes the files when the frame is no longer used
    (`spark.cleaner.referenceTracking.cleanCheckpoints`)."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def release(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle and checkpoint files of frames that are no longer used.

    Spark does so when the driver collects their handles, which a driver with memory to spare puts off; in a
    loop the files of all rounds would lie on the disks together."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def row_of(text_col: str) -> Column:
    """`row`: with the id, names a row even where one id has several texts."""
    return F.xxhash64(text_col).alias("row")


def kept_rows(docs: DataFrame, decided: DataFrame) -> DataFrame:
    """The rows of `docs` that `decided` (doc_id, row) names, each once."""
    once = Window.partitionBy("doc_id", "row").orderBy("doc_id")
    wanted = docs.withColumn("row", row_of("text")).join(decided.select("doc_id", "row"), ["doc_id", "row"], "left_semi")
    return wanted.withColumn("again", F.row_number().over(once)).where("again = 1").select(*docs.columns)


def partitions(spark: SparkSession) -> int:
    """The session's shuffle width, used for explicit repartitionings."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer, element by element."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def texts(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """The UTF-8 bytes of a text column; null is empty."""
    column = batch.column(name)
    if pa.types.is_null(column.type):
        return [b""] * len(column)
    column = column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary())
    return [x or b"" for x in column.to_pylist()]


class Memo(dict):
    """A dict that computes missing values and starts afresh at `limit` entries, to bound memory."""

    def __init__(self, compute: Callable, limit: int):
        super().__init__()
        self.compute, self.limit = compute, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        self[key] = value = self.compute(key)
        return value


def word_hashes(words: list[bytes], memo: Memo) -> np.ndarray:
    """64-bit hashes of words, in order."""
    return np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash for each run of `size` consecutive word hashes.

    Doubling: the hash of 2n words is made of two hashes of n words, so each window takes
    about log2(size) vector operations."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, done, block, length = None, 0, hashes, 1
    while True:
        if size & length:
            part = block[done:done + n]
            out = part.copy() if out is None else mix64(out * np.uint64(0x9E3779B97F4A7C15) + part)
            done += length
        if length * 2 > size:
            return mix64(out)
        block = mix64(block[:-length] * np.uint64(0xD6E8FEB86659FD93) + block[length:])
        length *= 2


def as_signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return np.ascontiguousarray(x).view(np.int64)


def frame(schema: pa.Schema, **columns) -> pa.RecordBatch:
    """A record batch of the columns in the schema's order."""
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if not isinstance(columns[f.name], pa.Array) else columns[f.name] for f in schema], schema=schema)


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[bool, pa.RecordBatch]]:
    """Slices of a partition sorted by integer `keys`: (does a new group start, rows of one group).

    A group longer than a batch comes in several slices, so no group is held whole here."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in keys])
        cuts = [0, *(np.flatnonzero((values[:, 1:] != values[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            key = tuple(values[:, a].tolist())
            yield key != last, batch.slice(a, b - a)
            last = key


def heavy(counted: DataFrame, key: list[str], weight: Column, total: int, share: int = 1024) -> DataFrame:
    """The keys that hold at least one part in `share` of all rows: at most `share` keys whatever the
    size of the data, so the result may be broadcast."""
    return counted.where(weight * F.lit(share) >= F.lit(max(total, 1))).select(*key)


def split_join(rows: DataFrame, groups: DataFrame, key: str, weight: str, share: int = 1024) -> DataFrame:
    """Inner equi-join of many `rows` with `groups` (one row for each key) where a key may hold a
    third of all rows: the at most `share` keys with one part in `share` of the rows are broadcast and
    joined without a shuffle, the others shuffled, where none can weigh much.

    `groups` has in `weight` how many rows each key has; it is read several times, so it should be saved."""
    total = groups.agg(F.sum(weight)).first()[0] or 0
    hot = heavy(groups, [key], F.col(weight), total, share)
    hot_groups = groups.join(F.broadcast(hot), key, "left_semi")
    cold = rows.join(F.broadcast(hot), key, "left_anti")
    return (rows.join(F.broadcast(hot_groups), key)
            .unionByName(cold.join(groups.join(F.broadcast(hot), key, "left_anti"), key)))


def narrowed(df: DataFrame, rows: int, share: int = 100_000) -> DataFrame:
    """`df` in a task for each `share` of its `rows`, at most as many as it has.

    Rounds over a few rows would else run, and leave shuffle files of, a task for each of the session's partitions."""
    return df.coalesce(max(1, -(-rows // share)))


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """Connected components of undirected `edges`: (node, component), component the smallest node.

    Alternating large and small stars: each round relinks every node's larger neighbours, then its
    smaller ones, to the smallest of them, until nothing changes; if `rounds` run out before, that is an error.  Minima are combined before the
    shuffle; the joins on a hub's key are sort-merge joins, which Spark splits where they are skewed.  Links go from
    the larger node to the smaller one, and a round never makes more of them than there were."""
    def state(links: DataFrame) -> tuple:
        r = links.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("u").cast("decimal(38,0)") * 31 + F.col("v").cast("decimal(38,0)")).alias("s")).first()
        return r.n, r.s

    links = saved(edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    count = state(links)
    for _ in range(rounds):
        links = narrowed(links, count[0])
        turned = links.select(F.col("v").alias("u"), F.col("u").alias("v"))
        least = links.unionByName(turned).groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = turned.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").select(F.greatest("v", "m").alias("x"), "u", "m")
                 .select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                                           F.struct(F.col("x").alias("u"), F.col("m").alias("v")))).alias("e"))
                 .select("e.u", "e.v").where("u <> v").distinct())
        before, links = links, saved(narrowed(small, count[0]))
        release(links.sparkSession)
        # done when every node points at one root that points nowhere: the round has changed no link
        last, count = count, state(links)
        if count == last and links.join(before, ["u", "v"], "left_anti").isEmpty():
            break
    else:
        raise RuntimeError(f"components not found in {rounds} rounds")
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return saved(narrowed(links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots), 2 * count[0]))
