"""Language ID against a plain count, clashing columns, and texts of a million words."""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F
from stormcab.llm import language_id, near_dedup, packing, substring_dedup, token_counts

from .brute import SMOKE, edge_docs


def brute_languages(training, texts):
    """(prediction, score) of each text by plain counts of words and n-grams."""
    words, grams, totals, gram_totals = defaultdict(Counter), defaultdict(Counter), Counter(), Counter()
    for lang, text in training:
        for w in language_id.letters(text):
            words[lang][w] += 1
            totals[lang] += 1
            padded = f"^{w}$"
            for n in range(1, 5):
                for i in range(len(padded) - n + 1):
                    grams[lang][padded[i:i + n]] += 1
                    gram_totals[lang, n] += 1
    languages = sorted(totals)
    every_word, every_gram = set().union(*words.values()), set().union(*grams.values())

    def of_word(w, lang):
        if w in every_word:
            return math.log((words[lang][w] + 0.5) / (totals[lang] + 1))
        padded, out = f"^{w}$", []
        for i in range(len(padded)):
            known = next((padded[i:i + n] for n in (4, 3, 2, 1) if padded[i:i + n] in every_gram), None)
            out.append(language_id.FLOOR if known is None else math.log((grams[lang][known] + 0.5) / (gram_totals[lang, len(known)] + 1)))
        return sum(out) / len(out)

    found = []
    for text in texts:
        own = language_id.letters(text or "")
        if not own:
            found.append(("und", 0.0))
            continue
        mean = [sum(of_word(w, lang) for w in own) / len(own) for lang in languages]
        best = mean.index(max(mean))
        found.append((languages[best], 1 / sum(math.exp((m - mean[best]) * min(len(own), language_id.EVIDENCE)) for m in mean)))
    return found


def test_predictions_equal_plain_counts(spark):
    docs = [r for r in spark.read.parquet(f"{SMOKE}/documents.parquet").collect()]
    training = [(r.lang, r.text) for r in docs if r.lang is not None and r.text is not None and zlib.crc32(str(r.doc_id).encode()) % 5]
    expected = brute_languages(training, [r.text for r in docs])
    got = {r.doc_id: (r.lang_pred, r.score) for r in language_id.op10_language_id(spark, SMOKE).collect()}
    for r, (lang, score) in zip(docs, expected):
        assert got[r.doc_id][0] == lang and abs(got[r.doc_id][1] - score) < 1e-9


def test_equal_scores_go_to_the_first_language(spark):
    docs = spark.createDataFrame([(1, "fr", "mot mot"), (2, "en", "mot mot")], "doc_id long, lang string, text string")
    [r] = language_id.identify(spark.createDataFrame([("mot xyz",)], "text string"), language_id.train(docs)).collect()
    assert r.lang_pred == "en" and abs(r.score - 0.5) < 1e-12


def test_columns_named_like_those_of_the_operators(spark):
    names = ["row", "cls", "sig", "parts", "refs", "spans", "owner", "n_tokens", "cluster", "group", "component_id", "kept", "shard", "slot"]
    docs = edge_docs(spark)
    clash = docs
    for n in names:
        clash = clash.withColumn(n, F.lit("clash"))

    def rows(df):
        return sorted(map(str, df.collect()))

    for of in (near_dedup.near_dedup, lambda d: packing.pack(packing.measured(d)), substring_dedup.removed_windows,
               token_counts.prefix_counts):
        assert rows(of(clash)) == rows(of(docs))
    model = language_id.train(docs)
    again = language_id.identify(clash.withColumn("lang_pred", F.lit("clash")).withColumn("score", F.lit("clash")), model)
    assert rows(again.select("doc_id", "lang_pred", "score")) == rows(language_id.identify(docs, model).select("doc_id", "lang_pred", "score"))


def test_million_words(spark):
    words = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta", "eta"]
    long = " ".join(words[(i * i + i // 7) % 7] + str(i % 1009) for i in range(1_000_000))
    docs = spark.createDataFrame([(1, long, "en", "s"), (2, long + " more", "en", "s"), (3, "x y z", "fr", "s")], "doc_id long, text string, lang string, source string")
    near = {r.doc_id: r.component_id for r in near_dedup.near_dedup(docs).collect()}
    assert near == {1: 1, 2: 1, 3: 3}
    found = {r.doc_id: r.lang_pred for r in language_id.identify(docs, language_id.train(docs)).collect()}
    assert found[1] == found[2] == "en"
    pieces = packing.pack(packing.measured(docs)).groupBy("doc_id").agg(F.sum("n_tokens").alias("n")).collect()
    assert {r.doc_id: r.n for r in pieces} == {1: 1_000_000, 2: 1_000_001, 3: 3}
