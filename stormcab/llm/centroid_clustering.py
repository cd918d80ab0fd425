"""Centroid clustering (operator 11): exact integer k-means over subvector dictionaries.

Vectors are dealt to chunks of at most `CHUNK` rows as they are read.  In each chunk every
block of `WIDTH` dimensions is dictionary-encoded without loss: its distinct subvectors, and
a code for each vector.  In a round a chunk computes the exact distance of each distinct
subvector to the same block of every centroid once; the distance of a vector is the sum of
its codes' entries over the blocks.  New centroids come the same way: how often a cluster uses
a code, times the code's subvector.

A dictionary belongs to its chunk, so it is no larger than the chunk however many distinct
subvectors the table has, nothing is shuffled but one row of sums for each cluster and
dimension of a task, and only the centroids (`k` rows) go through the driver.
The encoded chunks are written to the shared folder: a lost executor re-reads its chunks.

Components are floor(`SCALE` * x), exact in 64 bits.  Only vectors with exactly `dims` finite
components take part; as distances are 64-bit numbers, a component beyond `LARGEST` in
magnitude counts as not finite.  Other columns are not read.

Defined results: null vectors and those of another length, or with a null or non-finite
component, have no row; repeated rows are a vector each; a null id is clustered like the others but starts no
centroid; equal distances go to the smaller cluster number; with fewer vectors than `k` there are as many
centroids as vectors with an id; an empty table, or one without such a vector, gives no row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import saved, table

SCALE, DIMS, CLUSTERS, ROUNDS = 64, 64, 16, 3
# vectors of one chunk; dimensions of one block; vectors whose distances are in memory together
CHUNK, WIDTH, SLICE = 1 << 15, 2, 1 << 13
LARGEST = 1 << 27  # 64 * (2 * LARGEST)^2 is below 2^63

CHUNKS = "ids array<bigint>, sizes array<int>, subvectors binary, codes binary"
SUMS = "cluster int, dim int, total bigint, n bigint"
ASSIGNED = "vec_id bigint, cluster int, distance bigint"


def integers(batch: pa.RecordBatch, dims: int) -> tuple[np.ndarray, list]:
    """The kept vectors of a batch as integers, and their ids."""
    column = batch.column("embedding")
    if pa.types.is_null(column.type):
        return np.zeros((0, dims), np.int64), []
    kept = np.flatnonzero(pa.compute.equal(pa.compute.list_value_length(column), dims).fill_null(False).to_numpy(zero_copy_only=False))
    rows = column.take(pa.array(kept)).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, dims)
    with np.errstate(over="ignore", invalid="ignore"):
        scaled = np.floor(rows * SCALE)
        good = (np.abs(scaled) <= LARGEST).all(axis=1)
    ids = batch.column("vec_id").take(pa.array(kept[good])).to_pylist()
    return scaled[good].astype(np.int64), ids


def encode(vectors: np.ndarray, width: int) -> tuple[list[int], bytes, bytes]:
    """Dictionary encoding of each block of `width` dimensions: dictionary sizes, subvectors, codes."""
    sizes, subvectors, codes = [], [], []
    for at in range(0, vectors.shape[1], width):
        block = vectors[:, at:at + width]
        # one number for each distinct subvector: numbers of a dimension's distinct values, dimension by dimension
        key = np.zeros(len(block), np.int64)
        for column in block.T:
            values, number = np.unique(column, return_inverse=True)
            key = np.unique(key * len(values) + number, return_inverse=True)[1]
        first = np.unique(key, return_index=True)[1]
        sizes.append(len(first))
        subvectors.append(np.ascontiguousarray(block[first]).astype("<i8").tobytes())
        codes.append(key.astype("<u2").tobytes())
    return sizes, b"".join(subvectors), b"".join(codes)


def encoded_chunks(vectors: DataFrame, dims: int = DIMS, width: int = WIDTH, chunk: int = CHUNK) -> DataFrame:
    """Chunks of dictionary-encoded vectors, one row each."""
    if chunk > 1 << 16:
        raise ValueError("codes have 16 bits")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, ids = [], []

        def packed(n: int) -> pa.RecordBatch:
            held = np.concatenate(rows)
            sizes, subvectors, codes = encode(held[:n], width)
            out = pa.RecordBatch.from_arrays([pa.array([ids[:n]], pa.list_(pa.int64())), pa.array([sizes], pa.list_(pa.int32())),
                                              pa.array([subvectors], pa.binary()), pa.array([codes], pa.binary())],
                                             names=["ids", "sizes", "subvectors", "codes"])
            rows[:], ids[:] = [held[n:]], ids[n:]
            return out

        for batch in batches:
            found, numbers = integers(batch, dims)
            rows.append(found)
            ids.extend(numbers)
            while len(ids) >= chunk:
                yield packed(chunk)
        if ids:
            yield packed(len(ids))

    return saved(vectors.select("vec_id", "embedding").mapInArrow(work, CHUNKS))


@dataclass
class Chunk:
    """A decoded row of `encoded_chunks`."""

    ids: list
    dictionaries: list[np.ndarray]  # block by block: distinct subvectors
    codes: np.ndarray               # block x vector

    def partials(self, centroids: np.ndarray) -> list[np.ndarray]:
        """Exact squared distance of each distinct subvector to its block of every centroid."""
        out, at = [], 0
        for subvectors in self.dictionaries:
            width = subvectors.shape[1]
            gap = subvectors[:, None, :] - centroids[None, :, at:at + width]
            out.append((gap * gap).sum(axis=2))
            at += width
        return out

    def nearest(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cluster and squared distance of each vector: entries of its codes summed over the blocks."""
        tables, n = self.partials(centroids), len(self.ids)
        cluster, distance = np.zeros(n, np.int64), np.zeros(n, np.int64)
        for a in range(0, n, SLICE):
            part = slice(a, min(a + SLICE, n))
            total = np.zeros((part.stop - a, len(centroids)), np.int64)
            for entries, codes in zip(tables, self.codes):
                total += entries[codes[part]]
            cluster[part] = total.argmin(axis=1)  # the first of equals
            distance[part] = total[np.arange(len(total)), cluster[part]]
        return cluster, distance

    def sums(self, cluster: np.ndarray, k: int) -> np.ndarray:
        """Componentwise sums by cluster: uses of each code times its subvector."""
        out = []
        for subvectors, codes in zip(self.dictionaries, self.codes):
            uses = np.bincount(cluster * len(subvectors) + codes, minlength=k * len(subvectors)).reshape(k, -1)
            out.append(uses @ subvectors)
        return np.concatenate(out, axis=1)


def chunks_of(batch: pa.RecordBatch, dims: int, width: int) -> Iterator[Chunk]:
    """The chunks of a batch."""
    for row in range(batch.num_rows):
        ids = batch.column("ids")[row].as_py()
        sizes = batch.column("sizes")[row].as_py()
        raw = np.frombuffer(batch.column("subvectors")[row].as_py(), "<i8")
        codes = np.frombuffer(batch.column("codes")[row].as_py(), "<u2").reshape(len(sizes), -1).astype(np.int64)
        dictionaries, at = [], 0
        for b, size in enumerate(sizes):
            w = min(width, dims - b * width)
            dictionaries.append(raw[at:at + size * w].reshape(size, w))
            at += size * w
        yield Chunk(ids, dictionaries, codes)


def first_centroids(vectors: DataFrame, k: int, seed: int, dims: int) -> np.ndarray:
    """The `k` kept vectors with the smallest hash of `seed:<vec_id>`, in hash order."""
    x = F.col("embedding")
    fits = F.forall(x, lambda v: F.coalesce(F.abs(F.floor(v.cast("double") * SCALE).cast("double")) <= F.lit(LARGEST), F.lit(False)))
    finite = F.forall(x, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) <= F.lit(float(LARGEST))), F.lit(False)))
    kept = vectors.where(F.col("vec_id").isNotNull() & x.isNotNull()).where(F.size(x) == dims).where(finite).where(fits)
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = kept.select(order.alias("h"), "embedding").orderBy("h", "embedding").limit(k).collect()
    return np.floor(np.array([r.embedding for r in rows], np.float64).reshape(-1, dims) * SCALE).astype(np.int64)


def round_sums(chunks: DataFrame, centroids: np.ndarray, dims: int, width: int) -> DataFrame:
    """Sums and sizes of the clusters around `centroids`: one row for each cluster and dimension."""
    k = len(centroids)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            for chunk in chunks_of(batch, dims, width):
                cluster, _ = chunk.nearest(centroids)
                total += chunk.sums(cluster, k)
                n += np.bincount(cluster, minlength=k)
        cluster, dim = (x.ravel() for x in np.indices((k, dims), np.int32))
        used = n[cluster] > 0
        yield pa.RecordBatch.from_arrays([pa.array(cluster[used]), pa.array(dim[used]), pa.array(total.ravel()[used]), pa.array(n[cluster][used])],
                                         names=["cluster", "dim", "total", "n"])

    return (chunks.mapInArrow(work, SUMS).groupBy("cluster", "dim")
            .agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")))


def fit(chunks: DataFrame, centroids: np.ndarray, rounds: int, dims: int = DIMS, width: int = WIDTH) -> np.ndarray:
    """The centroids after `rounds` rounds; a centroid without vectors stays."""
    for _ in range(rounds):
        moved = centroids.copy()
        for r in round_sums(chunks, centroids, dims, width).collect():  # k * dims rows
            moved[r.cluster, r.dim] = int(r.total) // r.n
        centroids = moved
    return centroids


def assign(chunks: DataFrame, centroids: np.ndarray, dims: int = DIMS, width: int = WIDTH) -> DataFrame:
    """Cluster and squared distance of each vector."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks_of(batch, dims, width):
                cluster, distance = chunk.nearest(centroids)
                yield pa.RecordBatch.from_arrays([pa.array(chunk.ids, pa.int64()), pa.array(cluster.astype(np.int32)), pa.array(distance)],
                                                 names=["vec_id", "cluster", "distance"])

    return saved(chunks.mapInArrow(work, ASSIGNED))


def cluster_vectors(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, seed: int = 1, dims: int = DIMS,
                    width: int = WIDTH, chunk: int = CHUNK) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance) of each kept vector, and the final centroids."""
    centroids = first_centroids(vectors, k, seed, dims)
    if not len(centroids):
        return vectors.sparkSession.createDataFrame([], ASSIGNED), centroids
    chunks = encoded_chunks(vectors, dims, width, chunk)
    centroids = fit(chunks, centroids, rounds, dims, width)
    return assign(chunks, centroids, dims, width), centroids


def digests(centroids: np.ndarray) -> list[str]:
    return [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each vector's cluster, distance and its cluster's inertia and centroid hash."""
    assigned, centroids = cluster_vectors(table(spark, sf_dir, "embeddings"))
    sums = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()  # one row a cluster
    total, hashes = sum(int(r.s) for r in sums), digests(centroids)
    facts = spark.createDataFrame([(r.cluster, int(r.s), total, hashes[r.cluster]) for r in sums],
                                  "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return (assigned.join(F.broadcast(facts), "cluster")
            .select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"))


def _round_sql(i: int) -> str:
    """One round of the DuckDB statement: assignment `a{i}` to `c{i}`, then centroids `c{i + 1}`."""
    return f"""
d{i} AS (SELECT v.n, v.vec_id, c.k, SUM((x.c - y.c) * (x.c - y.c)) AS d
         FROM vs v JOIN comps x ON x.n = v.n JOIN c{i} y ON y.dim = x.dim JOIN (SELECT DISTINCT k FROM c0) c ON c.k = y.k
         GROUP BY v.n, v.vec_id, c.k),
a{i} AS (SELECT n, vec_id, k, d FROM d{i} QUALIFY row_number() OVER (PARTITION BY n ORDER BY d, k) = 1),
c{i + 1} AS (SELECT o.k, o.dim, COALESCE(m.c, o.c) AS c FROM c{i} o LEFT JOIN (
         SELECT a.k, x.dim, CAST(floor(SUM(x.c)::DOUBLE / COUNT(*)) AS BIGINT) AS c FROM a{i} a JOIN comps x ON x.n = a.n GROUP BY a.k, x.dim) m
         ON m.k = o.k AND m.dim = o.dim)"""


def oracle_sql() -> str:
    """The same result in DuckDB, all distances by plain sums over components."""
    rounds = ",".join(_round_sql(i) for i in range(ROUNDS + 1))
    return f"""
WITH vs AS MATERIALIZED (
  SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * {SCALE}) AS BIGINT)) AS e
  FROM embeddings WHERE len(embedding) = {DIMS}
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND NOT isnan(x) AND NOT isinf(x))) = {DIMS}),
comps AS MATERIALIZED (SELECT n, unnest(range({DIMS})) AS dim, unnest(e) AS c FROM vs),
seeds AS (SELECT n, sha256('1:' || vec_id) AS h FROM vs ORDER BY h LIMIT {CLUSTERS}),
c0 AS MATERIALIZED (SELECT s.k, x.dim, x.c FROM (SELECT n, row_number() OVER (ORDER BY h) - 1 AS k FROM seeds) s JOIN comps x ON x.n = s.n),
{rounds}
SELECT a.vec_id, CAST(a.k AS INTEGER) AS cluster, CAST(a.d AS BIGINT) AS distance,
       CAST(SUM(a.d) OVER (PARTITION BY a.k) AS BIGINT) AS cluster_inertia, CAST(SUM(a.d) OVER () AS BIGINT) AS inertia, h.centroid_sha256
FROM a{ROUNDS} a JOIN (SELECT k, sha256(string_agg(c::VARCHAR, ',' ORDER BY dim)) AS centroid_sha256 FROM c{ROUNDS} GROUP BY k) h ON h.k = a.k"""
