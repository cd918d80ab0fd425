"""Personal data: rules against plain patterns, the field against enumeration, detection on planted texts."""

from __future__ import annotations

import hashlib
import itertools
import math
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stormcab.llm import private_spans as ps

from .brute import SMOKE, edge_docs, rows_of

# The plain patterns of the rules.
PLAIN = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")
COLUMNS = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]


def luhn(digits):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(digits[::-1])) % 10 == 0


def brute(text):
    out = []
    for kind, pattern in enumerate(PLAIN):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == 1 and any(int(x) > 255 for x in m.group().split(".")):
                continue
            if kind == 2 and not (13 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == 3 and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, *m.span()))
    return out


PIECES = ["a", "b.c", "@", "x@y.z", ".", "-", " ", "+", "(", ")", "1", "25", "256", "0.1", "4111", "4111111111111111", "555-0199", "+1 (212)", "é", "\n", "%", "@@"]


@settings(max_examples=600, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=14))
def test_rules_equal_the_plain_patterns(parts):
    assert ps.base_spans("".join(parts)) == brute("".join(parts))


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="a1.@+- ()", max_size=30))
def test_rules_on_any_text(text):
    assert ps.base_spans(text) == brute(text)


def test_long_texts_take_linear_time():
    n = 200_000
    for text in ("a" * n, "1" * n, "1." * n, "@" * n, "a@" * n, "+1" + " " * n, "1 " * n, "a.b" * n, "word " * n + "x@y.zz", " at " * n, "12 " * n):
        base = ps.base_spans(text)
        assert len(base) == (1 if text.endswith("x@y.zz") else (n // 4 if text[:2] == "1." else 0))
        if text[:2] not in ("1.", "12"):
            ps.added_spans(text, base, {"email is": 1.0})


def segmentations(lattice):
    """Every set of segments that do not overlap."""
    for n in range(len(lattice.segments) + 1):
        for chosen in itertools.combinations(range(len(lattice.segments)), n):
            spans = sorted(lattice.segments[k][1:] for k in chosen)
            if all(a[1] <= b[0] for a, b in zip(spans, spans[1:])):
                yield chosen


@pytest.mark.parametrize("seed", range(12))
def test_viterbi_and_sums_equal_enumeration(seed):
    rng = np.random.default_rng(seed)
    segments = list({(int(k), int(a), int(a + w)) for k, a, w in zip(rng.integers(0, 4, 7), rng.integers(0, 9, 7), rng.integers(1, 6, 7))})
    lattice = ps.Lattice(segments)
    scores = rng.normal(0, 2, len(lattice.segments))
    sums = {c: sum(scores[k] for k in c) for c in segmentations(lattice)}
    best = max(sums.values())
    assert math.isclose(sum(scores[k] for k in lattice.best(scores.tolist())), best, abs_tol=1e-9)
    total, arcs = lattice.expected(scores)
    assert math.isclose(total, math.log(sum(math.exp(v) for v in sums.values())), rel_tol=1e-9)
    for k in range(len(scores)):
        assert math.isclose(arcs[k], sum(math.exp(v - total) for c, v in sums.items() if k in c), rel_tol=1e-7, abs_tol=1e-12)


def test_ties_take_fewer_entities():
    lattice = ps.Lattice([(3, 0, 4), (3, 4, 8), (3, 0, 8)])
    scores = {(3, 0, 4): 1.0, (3, 4, 8): 1.0, (3, 0, 8): 2.0}
    assert [lattice.segments[k] for k in lattice.best([scores[s] for s in lattice.segments])] == [(3, 0, 8)]
    assert ps.Lattice([(0, 2, 5)]).best([0.0]) == []


EXAMPLES = [(0, "please write to ann.lee@mail.example.com for more", 16, 40), (0, "the of.55@mail9.example.com hest", 4, 27),
            (1, "from 97.51.17.173 came", 5, 17), (1, "host 10.0.0.7, up", 5, 13), (2, "paid with 4111111111111111 today", 10, 26),
            (2, "no 5500 0000 0000 0004 here", 3, 22), (3, "tel +1 (212) 555-0199 or", 4, 21), (3, "call +44 20 7946 0958 now", 5, 21),
            (-1, "a 1234567890123456 7536784127813050 b", 2, 18)]


def weights():
    return ps.fit(ps.examples_of(EXAMPLES))


def test_fitting_raises_the_likelihood():
    examples = ps.examples_of(EXAMPLES)
    w = ps.fit(examples)
    before, after = (sum(ps.log_likelihood(x, *e) for e in examples) for x in ({}, w))
    assert after > before / 4  # log-likelihoods: nearer to 0
    right = 0
    for text, candidates, truth in examples:
        lattice = ps.Lattice(candidates)
        scores = [sum(w.get(f, 0.0) for f in ps.features(text, s)) for s in lattice.segments]
        right += sorted(lattice.segments[k] for k in lattice.best(scores)) == sorted(truth)
    assert right >= 0.97 * len(examples)


@pytest.mark.parametrize("text, said", [
    ("call (646) 555-0147 now", "(646) 555-0147"), ("tel 646-555-0147.", "646-555-0147"), ("write joe at mail.example.com please", "joe at mail.example.com"),
    ("write joe [at] mail [dot] example [dot] com", "joe [at] mail [dot] example [dot] com"), ("seen 10[.]1[.]2[.]3 there", "10[.]1[.]2[.]3"),
    ("see 43 4111111111111111 x", "4111111111111111"), ("ring +1 (017) 555-7713 2023 12 x", "+1 (017) 555-7713")])
def test_added_spans(text, said):
    base = ps.base_spans(text)
    assert base == []
    assert [text[a:b] for _, a, b in ps.added_spans(text, base, weights())] == [said]


@pytest.mark.parametrize("text", ["on 2024-01-01 12 30", "version 1.2.3 build 20240101", "in 1999 2000 2001 2002", "we met at home. Then we left", "meet at home.Then go",
                                  "1234567890123456", "page 12 of 340", 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"', "12 34 56 78 90 12 34"])
def test_clean_texts_are_left_alone(text):
    assert ps.base_spans(text) == [] and ps.added_spans(text, [], weights()) == []


def test_base_spans_stay_and_nothing_overlaps_them():
    text = "a@b.cc at d.ee +1 (212) 555-0199 10.0.0.1 4111 1111 1111 1111"
    base = ps.base_spans(text)
    added = ps.added_spans(text, base, weights())
    assert all(e <= a or s >= b for _, a, b in added for _, s, e in base)


def test_op12_base_equals_brute_force(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMOKE}/documents.parquet").collect()}
    got = ps.op12_private_spans(spark, SMOKE)
    assert got.columns == COLUMNS
    rows = got.collect()
    assert len(rows) == len(docs)
    for r in rows:
        base = brute(docs[r.doc_id])
        names = [f"{ps.KINDS[k]}:{a}:{b}" for k, a, b in base]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for k, _, _ in base) for i in range(4)]
        assert r.base_sha256 == hashlib.sha256(",".join(names).encode()).hexdigest()
        assert set(names) <= set(r.spans.split(",") if r.spans else [])


def test_edges_and_empty_table(spark):
    docs = edge_docs(spark, ["é x@y.zz 😀 10.0.0.1", "+1 (212) 555-0199"] * 2).withColumnRenamed("digest", "spans")
    found = ps.find_spans(docs, weights())
    assert found.columns == ["doc_id", "spans"] and found.count() == docs.count()
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for r in found.where("doc_id is not null").collect():
        for s in r.spans:
            assert texts[r.doc_id][s.start:s.end] == s.text
        assert [(ps.KINDS.index(s.kind), s.start, s.end) for s in r.spans if s.base] == brute(texts[r.doc_id])
    empty = spark.createDataFrame([], "doc_id long, text string, kind string")
    assert ps.train(empty) == {} and ps.find_spans(empty, {}).count() == 0
    clean = spark.createDataFrame([(1, "call (646) 555-0147"), (None, None)], "doc_id long, text string")
    assert ps.train(clean) == {}
    assert rows_of(ps.find_spans(clean, {}), ["doc_id", "spans"]) == [(1, []), (None, [])]
