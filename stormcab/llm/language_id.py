"""Language ID (operator 10): known words first, character n-grams for the rest.

A word that was seen in training scores its log frequency in each language.  An unseen
word is read by character n-grams: at each of its positions the longest known one of
4, 3, 2 or 1 characters scores.  A document's score for a language is the mean over
its words; the prediction is the best language, and the score its posterior.

Training counts words and n-grams of labelled documents with Spark, on a bounded
sample: about `PER_LANGUAGE` documents of each language, drawn by a hash.  The model keeps every word and
n-gram of the sample, also those seen once, so its size depends on the texts of about that many documents a
language and not on the number of documents; it is sent to the workers.
Prediction is one map over whole texts.

Defined results: a null text, or one without a letter, is `und` with score 0; rows with null
language are not learned from; repeated rows are predicted alike; with nothing to learn
from, all are `und`; equal scores go to the alphabetically first language; an empty table
gives no row.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product, repeat

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import frame, saved, table, texts

PER_LANGUAGE, LONGEST = 3000, 4  # n-grams of up to 4: see Model.unseen
UNKNOWN = "und"
KEPT_WORDS = 300_000
# the posterior counts this many words at most: words of a text are not independent
EVIDENCE = 40
FLOOR = -20.0  # log frequency of a character that no n-gram has
RUN = 64  # letters of one word that are read at a time
LETTERS, ASCII_LETTERS = regex.compile(r"\p{L}+"), re.compile("[a-z]+")


@dataclass
class Model:
    """Log frequencies by language: a row of `word_rows` for each word, of `gram_rows` for each n-gram."""

    languages: list[str]
    words: dict[str, int]
    word_rows: np.ndarray
    grams: dict[str, int]
    gram_rows: np.ndarray  # the last row is for a character that no n-gram has

    def unseen(self, words: list[str]) -> np.ndarray:
        """Scores of words that training did not see: the mean over their positions of the longest known n-gram."""
        get, found, ends = self.grams.get, [], []
        nothing = len(self.gram_rows) - 1
        for word in words:
            padded = f"^{word}$"
            for at in range(len(padded)):
                row = get(padded[at:at + 4])
                if row is None:
                    row = get(padded[at:at + 3])
                    if row is None:
                        row = get(padded[at:at + 2])
                        if row is None:
                            row = get(padded[at], nothing)
                found.append(row)
            ends.append(len(found))
        starts = np.array([0, *ends[:-1]])
        return np.add.reduceat(self.gram_rows[found], starts, axis=0) / np.diff([0, *ends])[:, None]


class Scorer:
    """Scores whole texts; keeps the rows of about `KEPT_WORDS` unseen words."""

    def __init__(self, model: Model):
        self.model = model
        self.numbers = dict(model.words)
        self.rows = model.word_rows

    def mean(self, words: list[str]) -> np.ndarray:
        """Mean score of a text's words in each language."""
        if len(self.numbers) > len(self.model.words) + KEPT_WORDS:
            self.numbers, self.rows = dict(self.model.words), self.model.word_rows
        numbers = np.fromiter(map(self.numbers.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(numbers < 0)
        if len(missing):
            new = list({words[i]: None for i in missing.tolist()})
            first = len(self.numbers)
            if first + len(new) > len(self.rows):
                self.rows = np.concatenate([self.rows[:first], np.zeros((max(len(new), first), self.rows.shape[1]))])
            self.rows[first:first + len(new)] = self.model.unseen(new)
            self.numbers.update(zip(new, range(first, first + len(new))))
            numbers[missing] = [self.numbers[words[i]] for i in missing.tolist()]
        return self.rows[numbers].mean(axis=0)


def letters(text: str) -> list[str]:
    """Lower-case words of letters; a very long run of letters is read in parts."""
    text = text.lower()
    words = (ASCII_LETTERS if text.isascii() else LETTERS).findall(text)
    if words and max(map(len, words)) > RUN:
        words = [w[i:i + RUN] for w in words for i in range(0, len(w), RUN)]
    return words


def counted_words(docs: DataFrame) -> DataFrame:
    """(lang, word, n): word counts of labelled documents, added up inside each batch before the shuffle."""
    schema = pa.schema([("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[str, Counter] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), texts(batch)):
                counts.setdefault(lang, Counter()).update(letters(text.decode("utf-8", "replace")))
            for lang, own in counts.items():
                if own:
                    yield frame(schema, lang=[lang] * len(own), word=list(own), n=list(own.values()))

    return docs.mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """A model of bounded size from `labelled` rows with a language."""
    rows = labelled.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), *labelled_id(labelled)).where("lang is not null and text is not null")
    # each language's rate follows from its number of rows, so no text is sorted to draw the sample
    rates = rows.groupBy("lang").agg((F.lit(PER_LANGUAGE * (1 << 32)) / F.count(F.lit(1))).alias("below"))  # one row for each language
    chosen = rows.join(F.broadcast(rates), "lang").where(F.pmod(F.xxhash64("id", "text"), F.lit(1 << 32)) < F.col("below"))
    words = saved(counted_words(chosen.select("lang", "text")))
    padded = F.concat(F.lit("^"), F.col("word"), F.lit("$"))

    def of_length(n: int) -> Column:
        # the lambda has one argument: a second one would be given the position
        return F.transform(F.sequence(F.lit(1), F.length(padded) - (n - 1)), lambda i: F.substring(padded, i, F.lit(n)))

    per_length = [of_length(n) for n in range(1, LONGEST + 1)]
    grams = (words.withColumn("grams", F.flatten(F.array(*(F.when(F.length(padded) >= n, g).otherwise(F.array().cast("array<string>")) for n, g in enumerate(per_length, 1)))))
             .select("lang", F.explode("grams").alias("word"), "n").groupBy("lang", "word").agg(F.sum("n").alias("n")))
    # a word has as many n-grams as positions where one fits
    places = [F.sum(F.col("n") * F.greatest(F.length(padded) - (n - 1), F.lit(0))).alias(f"n{n}") for n in range(1, LONGEST + 1)]
    counted = words.groupBy("lang").agg(F.sum("n").alias("n"), *places).collect()  # one row for each language
    totals = {r.lang: r.n for r in counted}
    gram_totals = {(r.lang, n): r[f"n{n}"] for r in counted for n in range(1, LONGEST + 1)}

    word_counts = words.select("lang", "word", "n").toArrow()  # words and n-grams of the sample
    gram_counts = grams.toArrow()
    languages = sorted(totals)
    at = {lang: i for i, lang in enumerate(languages)}

    def scores(counts: pa.Table, total_of) -> tuple[dict[str, int], np.ndarray]:
        numbers: dict[str, int] = {}
        for word in counts.column("word").to_pylist():
            numbers.setdefault(word, len(numbers))
        table = np.zeros((len(numbers), len(languages)))
        rows = [numbers[w] for w in counts.column("word").to_pylist()]
        table[rows, [at[x] for x in counts.column("lang").to_pylist()]] = counts.column("n").to_numpy()
        total = np.zeros((max(map(len, numbers), default=0) + 1, len(languages)))
        for size, lang in product(range(len(total)), languages):
            total[size, at[lang]] = total_of(lang, size)
        return numbers, np.log((table + 0.5) / (total[[len(w) for w in numbers]] + 1.0))

    known, word_rows = scores(word_counts, lambda lang, _: totals[lang])
    grams, gram_table = scores(gram_counts, lambda lang, size: gram_totals.get((lang, size), 0))
    return Model(languages, known, word_rows, grams, np.vstack([gram_table, np.full((1, len(languages)), FLOOR)]))


def labelled_id(labelled: DataFrame) -> list:
    """The id column, where there is one: copies of a text are drawn one by one."""
    return [F.col("doc_id").alias("id")] if "doc_id" in labelled.columns else [F.lit(None).cast("long").alias("id")]


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """`docs` with lang_pred and score; columns of these names are replaced, all others passed through."""
    own = [c for c in docs.columns if c not in ("lang_pred", "score")]
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.words, model.word_rows, model.grams, model.gram_rows))
    schema = T.StructType([*(docs.schema[c] for c in own), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        scorer = Scorer(model)
        for batch in batches:
            predicted, scores = [], []
            for text in texts(batch, text_col):
                words = letters(text.decode("utf-8", "replace")) if model.languages else []
                if not words:
                    predicted.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                mean = scorer.mean(words)
                best = int(mean.argmax())
                odds = np.exp((mean - mean[best]) * min(len(words), EVIDENCE))
                predicted.append(model.languages[best])
                scores.append(float(1.0 / odds.sum()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(predicted, pa.string()), pa.array(scores, pa.float64())], [*own, "lang_pred", "score"])

    return docs.select(*own).mapInArrow(run, schema)


def training_rows(docs: DataFrame) -> DataFrame:
    """Documents that the query may learn from."""
    return docs.where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, by a model of the documents that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = train(training_rows(docs))
    found = identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", (F.crc32(F.col("doc_id").cast("string")) % 5 == 0).alias("held_out"), "lang_pred", "score")
