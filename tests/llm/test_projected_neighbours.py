"""Projected neighbours against brute force: recall, exact scores, ties and unusable vectors."""

from __future__ import annotations

import math
import random

import numpy as np
import pyarrow.parquet as pq
import pytest

from pyspark.sql import functions as F
from stormcab.llm import projected_neighbours as P


def brute(rows, k=5):
    good = {}
    for i, v in rows:
        if i is not None and v is not None and len(v) and not any(x is None or not math.isfinite(x) for x in v):
            a = np.array(v, float)
            if np.sqrt((a * a).sum()) > 0:
                good[i] = a
    out = {}
    for i, a in good.items():
        if i % 50 == 0:
            scores = sorted((-(a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum())), j) for j, b in good.items() if j != i)
            out[i] = [(j, -s) for s, j in scores[:k]]
    return out


def recall(got, want):
    for q, rows in got.items():
        assert [r.rank for r in rows] == list(range(1, len(rows) + 1)) and len(rows) == len(want[q])
        assert [(-r.score, r.vec_id) for r in rows] == sorted((-r.score, r.vec_id) for r in rows)
    hits = [len({r.vec_id for r in got.get(q, [])} & {j for j, _ in w}) / len(w) for q, w in want.items() if w]
    return sum(hits) / len(hits)


def by_query(df):
    out: dict = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append(r)
    return out


@pytest.mark.parametrize("cell,block", [(4096, 8192), (100, 40)])
def test_recall_on_embeddings(spark, monkeypatch, cell, block):
    monkeypatch.setattr(P, "CELL", cell)
    monkeypatch.setattr(P, "BLOCK", block)
    folder = "/root/testdata/sf0.1"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    got, want = by_query(P.op7_projected_neighbours(spark, folder)), brute(rows)
    assert set(got) == set(want)
    assert recall(got, want) >= 0.95
    exact = {q: dict(w) for q, w in brute(rows, 10**6).items()}
    assert all(abs(exact[q][r.vec_id] - r.score) < 1e-12 for q, w in got.items() for r in w)


def test_ties_copies_and_unusable_vectors(spark):
    rng = random.Random(1)
    hot = [rng.gauss(0, 1) for _ in range(8)]
    rows = [(i, hot if i % 3 == 0 else [rng.gauss(0, 1) for _ in range(8)]) for i in range(600)]
    rows += [(700, None), (750, [0.0] * 8), (751, [math.nan] + [1.0] * 7), (752, [None] + [1.0] * 7), (753, [math.inf] + [1.0] * 7), (800, [1.0]), (850, []), (None, hot), (0, hot)]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, score string")
    got = by_query(P.nearest(df, F.col("vec_id") % 50 == 0))
    want = brute([r for r in rows if r[1] is None or len(r[1]) == 8])
    assert set(got) == set(want)
    for q in want:
        if q % 3 == 0:
            assert [r.vec_id for r in got[q]] == [j for j, _ in want[q]]
    assert recall(got, want) >= 0.95


def test_few_and_no_candidates(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5])], "vec_id long, embedding array<float>")
    assert [(r.vec_id, r.rank) for r in by_query(P.nearest(df, F.col("vec_id") % 50 == 0))[0]] == [(1, 1)]
    assert P.nearest(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    assert P.nearest(df.limit(1), F.col("vec_id") % 50 == 0).count() == 0


def test_quantile():
    # chi-square with 8 degrees of freedom: published table values
    assert abs(P.chi_square_quantile(0.95, 8) - 15.507) < 1e-3
    assert abs(P.chi_square_quantile(0.99, 8) - 20.090) < 1e-3


def test_very_large_and_very_small_vectors_take_part(spark):
    rows = [(0, [1e-170, 0.0]), (1, [1.0, 0.1]), (2, [0.0, 1.0]), (50, [1e200, 1e200]), (3, [5e-324, 0.0]), (4, [1.7e308, -1.7e308])]
    got = by_query(P.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0))
    assert [r.vec_id for r in got[0]] == [3, 1, 4, 50, 2] and len(got[50]) == 5
    assert abs(got[0][0].score - 1) < 1e-12 and abs(got[50][0].score - 1.1 / math.sqrt(2 * 1.01)) < 1e-12


def test_a_part_of_the_vectors_is_verified():
    """Recall and verified share of one block over the given vectors (random directions, the hardest case)."""
    vectors = np.array(pq.read_table("/root/testdata/sf0.1/embeddings.parquet").column("embedding").to_pylist(), float)
    tree = P.BlockTree(vectors, [[i] for i in range(len(vectors))])
    quantile, hits = P.chi_square_quantile(P.CONFIDENCE, P.PROJECTED), 0
    unit = vectors / P.norms_of(vectors)[:, None]
    for q in range(0, 2000, 50):
        found = {i for _, i in tree.search(vectors[q], 6, -np.inf, quantile)} - {q}
        hits += len(found & set(np.argsort(-(unit @ unit[q]))[1:6].tolist()))
    assert hits >= 0.95 * 5 * 40 and tree.verified <= 0.65 * 40 * 2000
