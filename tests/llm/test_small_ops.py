"""Token counts, exact dedup and sharding against brute force and DuckDB."""

from __future__ import annotations

import hashlib
import random
import unicodedata
import zlib

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pyspark.sql import functions as F
from stormcab.llm import exact_dedup, sharding, token_counts

from .brute import EDGES, SMOKE, duck_rows, edge_docs, rows_of

LIBRARY = Tokenizer.from_file(public_tokenizers.path(token_counts.TOKENIZER))
COUNTER = token_counts.PrefixCounter(public_tokenizers.path(token_counts.TOKENIZER))


def library(text: str) -> int:
    return len(LIBRARY.encode(text or "", add_special_tokens=False).ids)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=40))
def test_every_prefix_has_the_library_count(text):
    counts = COUNTER.text(text)
    assert (counts[-1] if len(counts) else 0) == library(text)
    if not any(s in text for s in COUNTER.special):
        plain = (text if text.isascii() else unicodedata.normalize("NFC", text).replace("Σ", "σ")).lower()
        assert [int(x) for x in counts] == [library(plain[:p]) for p in range(1, len(plain) + 1)]


@pytest.mark.parametrize("text", ["It's we'll 'real !!'re", "abc!<|startoftext|>d<|endoftext|>", "a" * 700, "ΑΣ İstanbul", "'re're"])
def test_awkward_texts(text):
    counts = COUNTER.text(text)
    assert counts[-1] == library(text)


def test_special_prefixes():
    text = "abc!<|startoftext|>d"
    assert [int(x) for x in COUNTER.text(text)] == [library(text[:p]) for p in range(1, len(text) + 1)]


def test_op1_rows(spark):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet").collect()
    got = {r.doc_id: r for r in token_counts.op1_token_counts(spark, SMOKE).collect()}
    assert len(got) == len(docs)
    for d in docs:
        n = library(d.text)
        assert (got[d.doc_id].n_tokens, got[d.doc_id].n_bytes, got[d.doc_id].over_limit) == (n, len(d.text.encode()), n > 2048)


def test_prefix_questions(spark):
    counted = token_counts.prefix_counts(edge_docs(spark)).collect()
    assert len(counted) == len(EDGES) + 8 + 4
    df = spark.createDataFrame([("hello wonderful worldly things",), ("",)], "text string").withColumn("doc_id", F.lit(1))
    c = F.col("prefix_tokens")
    rows = token_counts.prefix_counts(df).select(token_counts.longest_prefix(c, 2).alias("p"), token_counts.tokens_at(c, F.lit(7)).alias("t"), token_counts.total(c).alias("n")).collect()
    text = "hello wonderful worldly things"
    best = max(p for p in range(len(text) + 1) if library(text[:p]) <= 2)
    assert sorted((r.p, r.t, r.n) for r in rows) == [(0, 0, 0), (best, library(text[:7]), library(text))]


def test_levels_are_a_bijection():
    rng = random.Random(3)
    for n in (0, 1, 2, 100, 5000):
        raw = {rng.randbytes(32) for _ in range(n)}
        words = exact_dedup.words_of(__import__("pyarrow").array(sorted(raw), "binary"))
        levels, slots = exact_dedup.build_levels(words)
        assert sorted(slots.tolist()) == list(range(len(raw)))
        assert exact_dedup.lookup(levels, words).tolist() == slots.tolist()


def test_exact_dedup_matches_sql(spark):
    columns = ["doc_id", "keep_id", "group_size", "kept", "text_sha256", "repeats_history"]
    assert rows_of(exact_dedup.op3_exact_dedup(spark, SMOKE), columns) == duck_rows(exact_dedup.OP3_SQL, SMOKE, columns)


@pytest.mark.parametrize("past", [True, False, None])
def test_exact_dedup_edges(spark, past):
    docs = edge_docs(spark)
    rule = F.lit(past) if past is not None else exact_dedup.earlier_half()
    got = rows_of(exact_dedup.exact_dedup(docs, rule), ["doc_id", "keep_id", "group_size", "kept"])
    groups: dict = {}
    for r in docs.collect():
        groups.setdefault((r.text or "").encode().lower(), []).append(r.doc_id)
    want = []
    for ids in groups.values():
        keep = max((i for i in ids if i is not None), default=None)
        want += [(i, keep, len(ids), i is not None and i == keep) for i in ids]
    assert got == sorted(want, key=repr)
    assert exact_dedup.exact_dedup(docs.limit(0), rule).count() == 0


def check_shards(rows, want):
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.size, r.text_crc32) for r in rows) == sorted((i is not None, i or 0, s, c) for i, s, c in want)
    everything, before = sum(s for _, s, _ in want), 0
    counts: dict = {}
    for r in sorted(rows, key=lambda r: (r.shard, r.slot)):
        assert r.slot == counts.setdefault(r.shard, 0)
        counts[r.shard] += 1
        assert r.shard == (2 * before + r.size) * 16 // (2 * everything)
        before += r.size
    order = [r.doc_id for r in sorted(rows, key=lambda r: (r.shard, r.slot)) if r.doc_id is not None]
    assert order == sorted(order)


def test_sharding(spark):
    for docs in (edge_docs(spark), spark.read.parquet(f"{SMOKE}/documents.parquet")):
        want = [(r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in docs.collect()]
        check_shards(sharding.byte_shards(docs).collect(), want)
    assert sharding.byte_shards(docs.limit(0)).count() == 0
    assert hashlib.sha256(b"").hexdigest()  # the digest of an empty text is defined
