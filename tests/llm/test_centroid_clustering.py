"""Centroid clustering against brute force in Python integers, and against DuckDB."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from stormcab.llm import centroid_clustering as cc

from .brute import SMOKE, duck_rows, rows_of

SCHEMA = "vec_id long, embedding array<float>, label int, cluster string, distance string"


def brute(rows, k=cc.CLUSTERS, rounds=cc.ROUNDS, dims=cc.DIMS):
    """(vec_id, cluster, distance) sorted, and the centroids, all in Python integers."""
    kept = [(r[0], [math.floor(float(x) * 64) for x in r[1]]) for r in rows
            if r[1] is not None and len(r[1]) == dims and all(x is not None and math.isfinite(x) for x in r[1])]
    order = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    centroids = [v for _, v in order[:k]]

    def nearest():
        out = []
        for i, v in kept:
            d, c = min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))
            out.append((i, v, c, d))
        return out

    if not centroids:
        return [], []
    for _ in range(rounds):
        found = nearest()
        for n in range(len(centroids)):
            own = [v for _, v, c, _ in found if c == n]
            if own:
                centroids[n] = [sum(column) // len(own) for column in zip(*own)]
    return sorted(((i, c, d) for i, _, c, d in nearest()), key=repr), centroids


def vectors(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA)


def random_rows(n, seed=0, spread=0.2):
    rng = random.Random(seed)
    return [(i, [float(np.float32(rng.gauss(0, spread))) for _ in range(cc.DIMS)]) for i in range(n)]


def test_op11_equals_duckdb_and_brute_force(spark):
    got = cc.op11_centroid_clustering(spark, SMOKE)
    columns = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert got.columns == columns
    rows = rows_of(got, columns)
    assert rows == duck_rows(cc.oracle_sql(), SMOKE, columns)
    table = spark.read.parquet(f"{SMOKE}/embeddings.parquet").select("vec_id", "embedding").collect()
    expected, centroids = brute(table)
    assert sorted((r[:3] for r in rows), key=repr) == expected
    assert {(r[1], r[5]) for r in rows} == {(c, hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for _, c, _ in expected}


@pytest.mark.parametrize("width, chunk", [(2, 64), (3, 50), (8, 1 << 15), (64, 7)])
def test_block_width_and_chunk_size_change_nothing(spark, width, chunk):
    rows = random_rows(150)
    found, centroids = cc.cluster_vectors(vectors(spark, rows), width=width, chunk=chunk)
    expected, theirs = brute(rows)
    assert rows_of(found, ["vec_id", "cluster", "distance"]) == expected
    assert centroids.tolist() == theirs


def test_nulls_lengths_repeats_ties_and_large_components(spark):
    one = [0.5] * cc.DIMS
    rows = random_rows(30, 1) + [
        (100, None), (101, []), (102, [0.1] * 63), (103, [0.1] * 65), (104, [None] + one[1:]), (105, [float("nan")] + one[1:]),
        (106, [float("inf")] + one[1:]), (107, [-float("inf")] + one[1:]), (None, one), (None, None), (108, one), (108, one), (108, one),
        (109, [float(1 << 20)] * cc.DIMS), (110, [-float(1 << 21)] + one[1:]), (111, [-0.0] * cc.DIMS), (112, [0.0] * cc.DIMS)]
    found, centroids = cc.cluster_vectors(vectors(spark, rows))
    expected, theirs = brute(rows)
    assert rows_of(found, ["vec_id", "cluster", "distance"]) == expected
    assert centroids.tolist() == theirs
    beyond = [(113, [3.0e38] + one[1:])]  # no distance to it fits a long
    again, _ = cc.cluster_vectors(vectors(spark, rows + beyond))
    assert rows_of(again, ["vec_id", "cluster", "distance"]) == expected


def test_few_vectors_and_none(spark):
    rows = random_rows(3, 2)
    found, centroids = cc.cluster_vectors(vectors(spark, rows))
    assert len(centroids) == 3 and rows_of(found, ["vec_id", "cluster", "distance"]) == brute(rows)[0]
    for none in ([], [(1, None), (None, [0.1] * cc.DIMS)]):
        found, centroids = cc.cluster_vectors(vectors(spark, none))
        assert found.count() == 0 and len(centroids) == 0 and found.columns == ["vec_id", "cluster", "distance"]


def test_encoding_is_lossless():
    held = np.array([v for _, v in random_rows(500, 3)])
    ints = np.floor(held * 64).astype(np.int64)
    sizes, subvectors, codes = cc.encode(ints, 3)
    raw, at, out = np.frombuffer(subvectors, "<i8"), 0, []
    for b, (size, row) in enumerate(zip(sizes, np.frombuffer(codes, "<u2").reshape(len(sizes), -1))):
        w = min(3, cc.DIMS - 3 * b)
        block = raw[at:at + size * w].reshape(size, w)
        assert len(np.unique(block, axis=0)) == size
        out.append(block[row])
        at += size * w
    assert (np.concatenate(out, axis=1) == ints).all()
