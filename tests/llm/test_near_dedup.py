"""Near-dedup against all pairs by brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest

from stormcab.llm import near_dedup
from stormcab.llm.common import components, narrowed

from .brute import SMOKE, edge_docs, rows_of


def shingles(text):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4)))


def brute(docs):
    """One row for each (doc_id, text), like the operator's, by comparing all distinct sets that share a shingle."""
    sets = [(d, shingles(t)) for d, t in docs]
    distinct = sorted({s for _, s in sets if s}, key=lambda s: sorted(s))
    number = {s: i for i, s in enumerate(distinct)}
    holders: dict = {}
    for i, s in enumerate(distinct):
        for x in s:
            holders.setdefault(x, []).append(i)
    parent = list(range(len(distinct)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, s in enumerate(distinct):
        shared: dict = {}
        for x in s:
            for j in holders[x]:
                if j < i:
                    shared[j] = shared.get(j, 0) + 1
        for j, n in shared.items():
            if 100 * n >= 75 * (len(s) + len(distinct[j]) - n):
                parent[root(i)] = root(j)
    least: dict = {}
    for d, s in sets:
        if s and d is not None:
            r = root(number[s])
            least[r] = min(d, least.get(r, d))
    out = []
    for d, s in sets:
        component = d if not s or d is None else least[root(number[s])]
        out.append((d, len(s), component, d is not None and d == component))
    return sorted(out, key=repr)


COLUMNS = ["doc_id", "n_shingles", "component_id", "kept"]


def check(spark, docs):
    got = rows_of(near_dedup.near_dedup(docs), COLUMNS)
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert got == want


def test_near_dedup_on_documents(spark):
    check(spark, spark.read.parquet(f"{SMOKE}/documents.parquet"))


def test_edges(spark):
    docs = edge_docs(spark)
    check(spark, docs)
    assert near_dedup.near_dedup(docs.limit(0)).count() == 0


@pytest.mark.parametrize("block,bucket", [(256, 4096), (8, 4096), (8, 5)])
def test_chains_and_a_large_loose_group(spark, monkeypatch, block, bucket):
    """Copies of one text with more and more edits: dense, with links, near misses and chains."""
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    monkeypatch.setattr(near_dedup, "BUCKET", bucket)
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    base = [rng.choice(words) for _ in range(120)]
    rows, i = [], 0
    for _ in range(150):
        text = list(base)
        for _ in range(rng.randint(0, 9)):
            text[rng.randrange(len(text))] = rng.choice(words)
        rows.append((1000 - i, " ".join(text)))
        i += 1
    chain = list(base[::-1])
    for _ in range(30):
        rows.append((1000 - i, " ".join(chain)))
        chain[rng.randrange(len(chain))] = "z" + str(i)
        i += 1
    check(spark, spark.createDataFrame(rows, "doc_id long, text string"))


def test_forest_is_of_the_exact_graph():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 40, rng.integers(1, 30)).astype(np.uint64)) for _ in range(60)]
    a, b = near_dedup.confirmed_forest(sets)
    jaccard = [[len(np.intersect1d(x, y)) * 100 >= 75 * len(np.union1d(x, y)) for y in sets] for x in sets]
    assert all(jaccard[i][j] for i, j in zip(a, b))
    assert len(set(zip(a, b))) == len(a)


def test_pairs_within_the_distance_share_a_key():
    rng = random.Random(2)
    for _ in range(200):
        wrong = set(rng.sample(range(near_dedup.SYMBOLS), near_dedup.DISTANCE))
        assert any(sum(k in wrong for k in range(c, c + near_dedup.CHUNK)) <= 1 for c in range(0, near_dedup.SYMBOLS, near_dedup.CHUNK))


def test_components_are_whole_or_an_error(spark):
    path = spark.range(40).selectExpr("id AS a", "id + 1 AS b")
    assert sorted(tuple(r) for r in components(path).collect()) == [(i, 0) for i in range(41)]
    assert components(path.limit(0)).count() == 0
    with pytest.raises(RuntimeError):
        components(path, rounds=2)


def test_rounds_over_few_links_run_in_few_tasks(spark):
    path = spark.range(0, 40, 1, 8).selectExpr("id as a", "id + 1 as b")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert components(path).rdd.getNumPartitions() == 1
        assert [narrowed(path, n, 10).rdd.getNumPartitions() for n in (0, 10, 11, 1000)] == [1, 1, 2, 8]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
