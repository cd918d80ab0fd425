"""Approximate nearest neighbours (operator 7): stable projections, a kd-tree, and a chi-square stop.

Unit vectors are projected to `PROJECTED` dimensions with Gaussian (2-stable)
directions: for two vectors at distance s, the squared projected distance over
s squared has a chi-square distribution with that many degrees of freedom.  A query
takes candidates in order of projected distance from a kd-tree and verifies
them on the original vectors.  It stops at projected distance p once
p squared >= q * d squared, where d is the distance of the k-th best so far and q the
`CONFIDENCE` quantile of that distribution: each neighbour nearer than d would then
have been met before with at least that probability.

The tree's top is fitted on a bounded sample (`SAMPLE` vectors, the smallest by hash) and cuts the
space into cells; every vector is put into its cell, and a large cell into blocks of about `BLOCK` rows.
Each task builds the tree of one block and answers the queries sent to it.
A query first searches its own cell; the distance it gets there tells,
by the same test against the cells' bounding boxes, which other cells it has to visit.

Equal vectors are one entry: with k results wanted, only the k + 1 smallest ids of equal vectors
can ever be in a result, so a vector that a third of all rows share is k + 1 ids from then on.
Cosine and distance of unit vectors give the same order; scores are computed
on the original vectors in double precision, in the same order of additions for every pair.

Vectors whose squares would leave the range of doubles are multiplied by a power of two, which changes no cosine.

Defined results: vectors that are null, zero, hold null or non-finite components, have a null id or another
length than the most frequent one (or `dim`; a cosine needs equal lengths) take no part; rows equal in id and vector are one;
a query has as many results as there are candidates, if fewer than k; an empty table gives no row; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import exp

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import frame, partitions, saved, sorted_groups, split_join, table

NEAREST, PROJECTED, CONFIDENCE = 5, 24, 0.9
SAMPLE, CELL, BLOCK, LEAF, SLICE = 20_000, 4096, 8192, 64, 64
EXTREME = 140  # decimal exponent from which squares might leave the doubles
SEED = 71


def chi_square_quantile(p: float, degrees: int) -> float:
    """Quantile of the chi-square distribution with an even number of degrees of freedom."""
    def below(x: float) -> float:
        term, total = 1.0, 1.0
        for i in range(1, degrees // 2):
            term *= x / 2 / i
            total += term
        return 1 - exp(-x / 2) * total

    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if below(middle) < p else (low, middle)
    return high


def directions(dim: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((dim, PROJECTED))


def norms_of(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt((vectors * vectors).sum(axis=1))


def projected(vectors: np.ndarray) -> np.ndarray:
    return (vectors / norms_of(vectors)[:, None]) @ directions(vectors.shape[1])


def in_range(values: np.ndarray) -> np.ndarray:
    """Vectors whose squares are finite and not 0: the very large and the very small times a power of two."""
    largest = np.abs(values).max(axis=1, initial=0.0)
    extreme = (largest > 10.0 ** EXTREME) | (largest < 10.0 ** -EXTREME)
    return np.where(extreme[:, None], np.ldexp(values, -np.frexp(largest)[1][:, None]), values)


def usable(rows: DataFrame, id_col: str, vector_col: str, dim: int) -> DataFrame:
    """(vec_id, vec): the vectors that take part, as bytes of doubles."""
    schema = pa.schema([("vec_id", pa.int64()), ("vec", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column, ids = batch.column(vector_col), batch.column(id_col).cast(pa.int64())
            fits = np.array([v is not None and len(v) == dim for v in column.to_pylist()], bool) & ids.is_valid().to_numpy(zero_copy_only=False)
            column, ids = column.filter(pa.array(fits)), ids.filter(pa.array(fits))
            values = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, dim) + 0.0  # -0 is 0
            good = np.isfinite(values).all(axis=1) & (values != 0).any(axis=1)
            values[good] = in_range(values[good])
            yield frame(schema, vec_id=ids.filter(pa.array(good)), vec=[v.tobytes() for v in values[good]])

    return rows.select(id_col, vector_col).mapInArrow(run, "vec_id long, vec binary").distinct()


def split_rule(sample: np.ndarray, cells: int) -> list[tuple[int, float, int, int]]:
    """The top of the kd-tree: nodes (dimension, border, low child, high child); a child below 0 is cell -child - 1."""
    nodes: list = []
    made = 0

    def grow(points: np.ndarray, wanted: int) -> int:
        nonlocal made
        spread = np.ptp(points, axis=0) if len(points) else np.zeros(sample.shape[1])
        if wanted <= 1 or len(points) < 2 or spread.max() == 0:
            made += 1
            return -made
        d = int(spread.argmax())
        border = float(np.partition(points[:, d], len(points) // 2)[len(points) // 2])
        low = points[:, d] < border
        if not low.any():
            made += 1
            return -made
        at = len(nodes)
        nodes.append(None)
        nodes[at] = (d, border, grow(points[low], wanted // 2), grow(points[~low], wanted - wanted // 2))
        return at

    root = grow(sample, cells)
    return nodes if root >= 0 else []


def cells_of(points: np.ndarray, nodes: list[tuple[int, float, int, int]]) -> np.ndarray:
    """The cell of each projected vector."""
    at = np.zeros(len(points), np.int64) if nodes else np.full(len(points), -1, np.int64)
    dims, borders, lows, highs = (np.array(x) for x in zip(*nodes)) if nodes else ([],) * 4
    while (inner := np.flatnonzero(at >= 0)).size:
        node = at[inner]
        at[inner] = np.where(points[inner, dims[node]] < borders[node], lows[node], highs[node])
    return -at - 1


class BlockTree:
    """A kd-tree over the projections of one block's vectors, with a box for each leaf."""

    def __init__(self, vectors: np.ndarray, ids: list[list[int]]):
        points = projected(vectors)
        order, self.cuts = [], [0]
        stack = [np.arange(len(points))]
        while stack:
            part = stack.pop()
            spread = np.ptp(points[part], axis=0)
            if len(part) <= LEAF or spread.max() == 0:
                order.append(part)
                self.cuts.append(self.cuts[-1] + len(part))
                continue
            d = int(spread.argmax())
            half = np.argpartition(points[part, d], len(part) // 2)
            stack += [part[half[len(part) // 2:]], part[half[:len(part) // 2]]]
        order = np.concatenate(order)
        self.points, self.verified = points[order], 0
        self.vectors, self.norms = vectors[order], norms_of(vectors)[order]
        self.ids = [ids[i] for i in order.tolist()]
        self.low = np.minimum.reduceat(points[order], self.cuts[:-1], axis=0)
        self.high = np.maximum.reduceat(points[order], self.cuts[:-1], axis=0)

    def search(self, vector: np.ndarray, wanted: int, bound: float, quantile: float) -> list[tuple[float, int]]:
        """The best (-score, id) found, incrementally by projected distance; `bound` is the worst score of
        use (-inf: none known)."""
        point, norm = projected(vector[None])[0], norms_of(vector[None])[0]
        gaps = (np.maximum(np.maximum(self.low - point, point - self.high), 0) ** 2).sum(axis=1)
        reach = np.inf if bound == -np.inf else quantile * max(2 - 2 * bound, 0.0)
        rows = np.flatnonzero(np.repeat(gaps < reach, np.diff(self.cuts)))
        away = ((self.points[rows] - point) ** 2).sum(axis=1)
        inside = away < reach
        rows, away = rows[inside], away[inside]
        order = np.argsort(away)
        best: list[tuple[float, int]] = []
        for at in range(0, len(order), SLICE):  # the next projected neighbours
            if bound > -np.inf and away[order[at]] >= quantile * max(2 - 2 * bound, 0.0):
                break
            part = rows[order[at:at + SLICE]]
            self.verified += len(part)
            scores = (self.vectors[part] * vector).sum(axis=1) / (self.norms[part] * norm)
            for i in np.flatnonzero(scores >= bound).tolist():
                best += [(-float(scores[i]), v) for v in self.ids[part[i]]]
            best = sorted(best)[:wanted]
            if len(best) == wanted:
                bound = max(bound, -best[-1][0])
        return best


def answered(tasks: DataFrame, wanted: int) -> DataFrame:
    """(vid, least, vec_id, score): best candidates of each query in each task.

    tasks: cell, block, kind (0 a vector with its ids, 1 a query), vid, least, vec, ids, bound."""
    schema = pa.schema([("vid", pa.int64()), ("least", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
    quantile = chi_square_quantile(CONFIDENCE, PROJECTED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors: list[bytes] = []
        ids: list[list[int]] = []
        tree = None
        for new, rows in sorted_groups(batches, ["cell", "block"]):
            if new:
                vectors, ids, tree = [], [], None
            out: list[tuple] = []
            for kind, vid, least, vec, own, bound in zip(*(rows.column(c).to_pylist() for c in ("kind", "vid", "least", "vec", "ids", "bound"))):
                if kind == 0:
                    vectors.append(vec)
                    ids.append(own)
                    continue
                if tree is None:
                    if not vectors:
                        continue
                    tree = BlockTree(np.frombuffer(b"".join(vectors)).reshape(len(vectors), -1), ids)
                out += [(vid, least, i, -s) for s, i in tree.search(np.frombuffer(vec), wanted, -np.inf if bound is None else bound, quantile)]
            if out:
                yield frame(schema, **dict(zip(schema.names, map(list, zip(*out)))))

    ordered = tasks.repartition(partitions(tasks.sparkSession), "cell", "block").sortWithinPartitions("cell", "block", "kind")
    return ordered.mapInArrow(run, "vid long, least long, vec_id long, score double")


def points_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The projections of vectors."""
    for batch in batches:
        if batch.num_rows:
            points = projected(np.frombuffer(b"".join(batch.column("vec").to_pylist())).reshape(batch.num_rows, -1))
            yield pa.RecordBatch.from_arrays([pa.array(points.tolist(), pa.list_(pa.float64()))], ["point"])


def with_cells(entries: DataFrame, nodes: list) -> DataFrame:
    """`entries` with their cell and projection."""
    schema = pa.schema([("vid", pa.int64()), ("least", pa.int64()), ("vec", pa.binary()), ("ids", pa.list_(pa.int64())), ("asked", pa.bool_()), ("cell", pa.int64()), ("point", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                points = projected(np.frombuffer(b"".join(batch.column("vec").to_pylist())).reshape(batch.num_rows, -1))
                yield frame(schema, **{c: batch.column(c) for c in schema.names[:5]}, cell=cells_of(points, nodes), point=points.tolist())

    return entries.select("vid", "least", "vec", "ids", "asked").mapInArrow(run, "vid long, least long, vec binary, ids array<long>, asked boolean, cell long, point array<double>")


def nearest(rows: DataFrame, is_query: Column, k: int = NEAREST, id_col: str = "vec_id", vector_col: str = "embedding", dim: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest of each row that `is_query` (a column over vec_id) selects."""
    if dim is None:
        common = rows.where(F.size(vector_col) > 0).groupBy(F.size(vector_col).alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
        dim = common["size"] if common else 1
    used = saved(usable(rows, id_col, vector_col, dim))
    order = Window.partitionBy("vec").orderBy("vec_id")
    first = used.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 1).groupBy("vec").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    asking = used.where(is_query).groupBy("vec").agg(F.count(F.lit(1)).alias("n"))
    entries = saved(first.join(asking, "vec", "left").select(F.xxhash64("vec").alias("vid"), F.col("ids")[0].alias("least"), "vec", "ids", F.col("n").isNotNull().alias("asked"), "n"))
    # a bounded sample fits the top of the tree
    sample = entries.select("vec").orderBy(F.xxhash64("vec", F.lit(SEED))).limit(SAMPLE).mapInArrow(points_of, "point array<double>").collect()
    points = np.array([r.point for r in sample]).reshape(len(sample), PROJECTED)
    nodes = split_rule(points, min(max(1, entries.count() // CELL), max(1, SAMPLE // 16)))
    placed = saved(with_cells(entries, nodes))
    boxes = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), *(f(F.col("point")[d]).alias(f"{name}{d}") for name, f in (("low", F.min), ("high", F.max)) for d in range(PROJECTED))).collect()  # one row for each cell
    blocks = {r.cell: -(-r.n // BLOCK) for r in boxes}
    low = np.array([[r[f"low{d}"] for d in range(PROJECTED)] for r in boxes])
    high = np.array([[r[f"high{d}"] for d in range(PROJECTED)] for r in boxes])
    names, sizes = [r.cell for r in boxes], [blocks[r.cell] for r in boxes]
    counts = F.create_map(*(F.lit(x).cast("long") for c in names for x in (c, blocks[c]))) if names else None
    if not names:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    stored = placed.select("cell", F.pmod(F.xxhash64("vid", "least"), counts[F.col("cell")]).alias("block"), F.lit(0).alias("kind"), "vid", "least", "vec", "ids", F.lit(None).cast("double").alias("bound"))
    queries = placed.where("asked")
    none = F.lit(None).cast("array<long>").alias("ids")
    home = queries.select("cell", F.explode(F.sequence(F.lit(0).cast("long"), counts[F.col("cell")] - 1)).alias("block"), F.lit(1).alias("kind"), "vid", "least", "vec", none, F.lit(None).cast("double").alias("bound"))
    found = saved(answered(stored.unionByName(home), k + 1))
    best = Window.partitionBy("vid", "least").orderBy(F.desc("score"), "vec_id")
    bound = found.withColumn("r", F.row_number().over(best)).where(F.col("r") == k + 1).select("vid", "least", F.col("score").alias("bound"))
    quantile = chi_square_quantile(CONFIDENCE, PROJECTED)
    schema = pa.schema([("cell", pa.int64()), ("block", pa.int64()), ("vid", pa.int64()), ("least", pa.int64()), ("vec", pa.binary()), ("bound", pa.float64())])

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for cell, vid, least, vec, point, bound in zip(*(batch.column(c).to_pylist() for c in ("cell", "vid", "least", "vec", "point", "bound"))):
                gaps = (np.maximum(np.maximum(low - point, point - high), 0) ** 2).sum(axis=1)
                reach = np.inf if bound is None else quantile * max(2 - 2 * bound, 0.0)
                out += [(names[i], b, vid, least, vec, bound) for i in np.flatnonzero(gaps < reach).tolist() if names[i] != cell for b in range(sizes[i])]
            if out:
                yield frame(schema, **dict(zip(schema.names, map(list, zip(*out)))))

    more = queries.join(bound, ["vid", "least"], "left").mapInArrow(visits, "cell long, block long, vid long, least long, vec binary, bound double")
    away = more.select("cell", "block", F.lit(1).alias("kind"), "vid", "least", "vec", none, "bound")
    everything = found.unionByName(answered(stored.unionByName(away), k + 1))
    results = saved(everything.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1).groupBy("vid", "least")
                    .agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("minus"), "vec_id"))).alias("best"))
                    .join(entries.where("asked").select("vid", "least", "vec", "n"), ["vid", "least"]).select("vec", "n", "best"))
    rows_asking = used.where(is_query).select("vec", F.col("vec_id").alias("query_id"))
    return (split_join(rows_asking, results, "vec", "n")
            .select("query_id", F.posexplode(F.slice(F.filter("best", lambda x: x["vec_id"] != F.col("query_id")), 1, k)).alias("i", "b"))
            .select("query_id", (F.col("i") + 1).cast("int").alias("rank"), F.col("b.vec_id").alias("vec_id"), (-F.col("b.minus")).alias("score")))


def op7_projected_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every fiftieth one."""
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
