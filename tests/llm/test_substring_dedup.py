"""Substring dedup against windows looked up in a dict."""

from __future__ import annotations

import hashlib
import random

import pytest

from stormcab.llm import substring_dedup

from .brute import SMOKE, edge_docs, rows_of

COLUMNS = ["doc_id", "n_words", "n_removed", "kept_sha256"]


def brute(docs):
    split = [(d, (t or "").encode().split()) for d, t in docs]
    first: dict = {}
    for d, words in split:
        if d is not None:
            for i in range(len(words) - 49):
                w = tuple(words[i:i + 50])
                first[w] = min(d, first.get(w, d))
    out = []
    for d, words in split:
        gone = set()
        for i in range(len(words) - 49):
            if d is not None and first[tuple(words[i:i + 50])] < d:
                gone.update(range(i, i + 50))
        kept = [w for i, w in enumerate(words) if i not in gone]
        out.append((d, len(words), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out, key=repr)


def check(spark, docs):
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert rows_of(substring_dedup.substring_dedup(docs), COLUMNS) == want
    return want


def test_documents(spark):
    want = check(spark, spark.read.parquet(f"{SMOKE}/documents.parquet"))
    assert sum(r[2] for r in want) > 0


def test_edges(spark):
    docs = edge_docs(spark, ["y " * 200, "x y " * 60])
    check(spark, docs)
    assert substring_dedup.substring_dedup(docs.limit(0)).count() == 0


@pytest.mark.parametrize("load", [20_000, 5])
def test_passages_in_many_contexts(spark, monkeypatch, load):
    """Passages of 40 to 130 words shared in different contexts, variants that miss the first holder, repeated ids."""
    monkeypatch.setattr(substring_dedup, "LOAD", load)
    rng = random.Random(11)
    words = [f"w{i}" for i in range(500)]

    def prose(n):
        return [rng.choice(words) for _ in range(n)]

    shared = [prose(n) for n in (40, 49, 50, 51, 75, 130, 130)]
    rows = []
    for i in range(120):
        parts = []
        for _ in range(rng.randint(1, 4)):
            parts += prose(rng.randint(0, 60))
            passage = list(rng.choice(shared))
            if rng.random() < 0.4:  # a variant: from now on it may be copied itself
                passage[rng.randrange(len(passage))] = rng.choice(words)
                shared.append(passage)
            parts += passage[rng.randint(0, 3):]
        rows.append((rng.randrange(10_000) if i % 10 else 77, " ".join(parts)))
    rows += [(i + 20_000, t) for i, (_, t) in enumerate(rows[:30])]
    want = check(spark, spark.createDataFrame(rows, "doc_id long, text string"))
    assert sum(r[2] for r in want) > 1000


def test_automaton_has_the_longest_matches():
    rng = random.Random(4)
    for _ in range(100):
        a = [rng.choice(b"abc") for _ in range(rng.randint(0, 25))]
        b = [rng.choice(b"abcd") for _ in range(rng.randint(0, 25))]
        runs = {tuple(a[i:j]) for i in range(len(a)) for j in range(i + 1, len(a) + 1)}
        want = [max((n for n in range(1, i + 2) if tuple(b[i + 1 - n:i + 1]) in runs), default=0) for i in range(len(b))]
        assert substring_dedup.SuffixAutomaton(a).matching(b) == want
