"""Language ID: backoff by hand, held-out accuracy, edge rows."""

from __future__ import annotations

import numpy as np

from pyspark.sql import functions as F
from stormcab.llm import language_id
from stormcab.llm.language_id import Model

from .brute import SMOKE, edge_docs


def test_backoff_takes_the_longest_known_grams():
    one = np.array([-1.0, -2.0])
    model = Model(["a", "b"], {"known": 0}, one[None], {"^x": 0, "x": 1, "y$": 2, "$": 3}, np.outer([2, 9, 3, 4, 20], one))
    # positions of ^xy$: ^x, x, y$, $; of ^z$: ^, z (unknown), $
    assert np.allclose(model.unseen(["xy", "z"]), [one * (2 + 9 + 3 + 4) / 4, one * (20 + 20 + 4) / 3])
    scorer = language_id.Scorer(model)
    assert np.allclose(scorer.mean(["known", "xy", "known", "z", "xy"]), (one * 2 + one * 4.5 * 2 + one * 44 / 3) / 5)
    assert np.allclose(scorer.mean(["xy"]), one * 4.5)


def test_kept_rows_are_bounded(monkeypatch):
    monkeypatch.setattr(language_id, "KEPT_WORDS", 10)
    model = Model(["a"], {}, np.zeros((0, 1)), {"x": 0}, np.array([[-1.0], [-20.0]]))
    scorer = language_id.Scorer(model)
    for i in range(50):
        assert np.allclose(scorer.mean(["x" * (i + 1), "y"]), (model.unseen(["x" * (i + 1)])[0] + model.unseen(["y"])[0]) / 2)
    assert len(scorer.numbers) <= 12


def test_long_runs_are_read_whole():
    assert language_id.letters("É" * 200 + " 12 b") == ["é" * 64] * 3 + ["é" * 8, "b"]


def test_held_out_accuracy(spark):
    docs = {r.doc_id: r.lang for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang").collect()}
    rows = language_id.op10_language_id(spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == len(docs)
    held = [r for r in rows if r.held_out]
    assert 0.1 < len(held) / len(rows) < 0.3
    assert np.mean([r.lang_pred == docs[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_labels_are_no_input_of_a_prediction(spark):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")
    model = language_id.train(language_id.training_rows(docs))
    found = {r.doc_id: (r.lang_pred, r.score) for r in language_id.identify(docs, model).collect()}
    other = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string"))
    assert {r.doc_id: (r.lang_pred, r.score) for r in language_id.identify(other, model).collect()} == found


def test_every_word_and_gram_of_the_sample_is_known(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = {f"{a}{b}{c}{d}" for a in letters[:20] for b in letters[:12] for c in letters[:11] for d in letters[:10]}
    often = sorted(words)[1:]
    docs = spark.createDataFrame([(1, "en", " ".join(often * 2) + " " + min(words)), (2, "fr", "once")], "doc_id long, lang string, text string")
    model = language_id.train(docs)
    assert len(words) > 25_000 and set(model.words) == words | {"once"}
    padded = [f"^{w}$" for w in words | {"once"}]
    assert set(model.grams) == {w[i:i + n] for w in padded for n in range(1, 5) for i in range(len(w) - n + 1)}


def test_edges(spark):
    docs = edge_docs(spark)
    model = language_id.train(docs)
    assert model.languages == ["en", "fr"]
    rows = language_id.identify(docs, model).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len(rows) == docs.count()
    for r in rows:
        if r.doc_id is not None:
            blank = not any(c.isalpha() for c in texts[r.doc_id] or "")
            assert (r.lang_pred == "und") == blank and (r.score == 0) == blank
    nothing = language_id.train(docs.limit(0))
    assert {r.lang_pred for r in language_id.identify(docs, nothing).collect()} == {"und"}
    assert language_id.identify(docs.limit(0), model).count() == 0
