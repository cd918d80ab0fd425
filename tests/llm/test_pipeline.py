"""The pipeline: every stage against brute force on its own input."""

from __future__ import annotations

import duckdb

import corpus_pipeline as P
import pytest
from pyspark.sql import functions as F
from stormcab.llm import language_id, mixing, packing

from .brute import SMOKE, edge_docs
from .test_near_dedup import brute as near_groups


def test_stages(spark, scratch):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")
    columns = docs.columns
    docs = docs.unionByName(edge_docs(spark).select(*columns).withColumn("doc_id", F.expr("doc_id + 1000")))
    path = f"{scratch}/documents.parquet"
    docs.write.parquet(path)
    docs = spark.read.parquet(path)
    inputs, outputs = [], []
    for k, (name, stage) in enumerate(P.STAGES):
        inputs.append([r.asDict() for r in docs.collect()])
        out = f"{scratch}/{k}"
        stage(spark, docs, scratch).write.parquet(out)
        docs = spark.read.parquet(out)
        if k < 4:
            assert docs.columns == columns
        outputs.append([r.asDict() for r in docs.collect()])
    rows = [sorted((tuple(r.values()) for r in o), key=repr) for o in outputs]

    def having(source, keep):
        """The distinct rows that stay."""
        return sorted({tuple(r.values()) for r in source if keep(r)}, key=repr)

    # language: every document with a letter and an id stays, repeated rows too
    want = [r for r in inputs[0] if r["doc_id"] is not None and language_id.letters(r["text"] or "")]
    assert rows[0] == sorted((tuple(r.values()) for r in want), key=repr)
    # exact: the largest id of equal texts
    best: dict = {}
    for r in inputs[1]:
        key = (r["text"] or "").encode().lower()
        best[key] = max(best.get(key, -1), r["doc_id"])
    assert rows[1] == having(inputs[1], lambda r: best[(r["text"] or "").encode().lower()] == r["doc_id"])
    # near: the smallest id of each component
    kept = {d for d, _, _, k in near_groups([(r["doc_id"], r["text"]) for r in inputs[2]]) if k}
    assert rows[2] == having(inputs[2], lambda r: r["doc_id"] in kept)
    # mixing: the same sample as in DuckDB
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{scratch}/2/*.parquet')")
    sampled = {i for i, s in con.execute(f"SELECT doc_id, sampled FROM ({mixing.oracle_sql()})").fetchall() if s}
    assert rows[3] == having(inputs[3], lambda r: r["doc_id"] in sampled)
    assert len(rows[3]) < len(rows[2])
    # packing: all words of what is left, in bins that hold them
    words = {r["doc_id"]: len((r["text"] or "").encode().split()) for r in inputs[4]}
    got: dict = {}
    for r in outputs[4]:
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["n_tokens"]
        assert r["bin_tokens"] <= packing.CAPACITY
    assert got == words


def test_run_is_its_stages(spark):
    rows = P.run(spark, SMOKE)
    assert rows.columns == packing.RESULT.names and rows.count() > 0


def test_a_broken_run_goes_on_behind_its_last_stage(spark, scratch, monkeypatch):
    ran = []

    def stage(name):
        def work(spark, docs, sf_dir):
            if lost == name:
                raise RuntimeError("lost")
            ran.append(name)
            return docs.where(f"doc_id % 7 <> {len(name)}")
        return name, work

    monkeypatch.setattr(P, "STAGES", [stage("a"), stage("bb"), stage("ccc")])
    lost = None
    whole = sorted(r.doc_id for r in P.run(spark, SMOKE).collect())
    for lost in ("a", "bb", "ccc"):
        ran.clear()
        with pytest.raises(RuntimeError):
            P.run(spark, SMOKE, f"{scratch}/{lost}")
        where, lost = f"{scratch}/{lost}", None
        assert sorted(r.doc_id for r in P.run(spark, SMOKE, where).collect()) == whole
        assert ran == ["a", "bb", "ccc"]  # none twice
