"""Substring dedup (operator 9): suffix automata of reference documents, matched by streams of passages.

A window is 50 consecutive words.  A window is removed if the same words also start
in a document with a smaller id; a word goes if any removed window covers it.

1. Every window has an anchor, the smallest hash of its 26 runs of 25 words: equal
   windows have equal anchors.  An anchor's reference document is the smallest id that has it.
   Anchors of one document only are of no use and end here; the others are grouped with
   combining before the shuffle.
2. A document is cut into passages, the longest runs of windows whose anchors have the
   same reference document.  A reference document's suffix automaton is built once in each
   task that its passages are sent to, and the passages are streamed past it for
   matching statistics: where the longest match is 50 words or more, a window recurs.  References that many
   passages ask for are built in several tasks, so that no task gets more than about `LOAD` anchors.
3. A window that its anchor's reference lacks can still recur between two other
   documents; then both lack a match, and their windows meet by a 128-bit hash of the
   whole window.  This is the exact way for the rest.

All automata of a self-join cannot be broadcast: together they are as large as the
corpus.  So only reference documents that share an anchor are built, one document an
automaton, and the passages are dealt to them.

Defined results: null and empty texts have no words; a document with fewer than 50 words keeps
them all; rows with equal ids are neither smaller than the
other and each is cut by itself; a null id is no reference and keeps its words; white space is what `[^\\x20\\x09-\\x0D]+` leaves out;
an empty table gives no row; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Memo, as_signed, frame, mix64, partitions, saved, sorted_groups, split_join, table, texts, windows, word_hashes

WINDOW, GRAM = 50, 25
LOAD = 20_000  # anchors that ask for one automaton in one task
KEPT_WORDS = 400_000
SECOND = np.uint64(0xA0761D6478BD642F)


def row_key(text: bytes) -> int:
    """Tells apart rows that have one id and different texts."""
    return xxhash.xxh3_64_intdigest(text) >> 1


def anchors_of(hashes: np.ndarray) -> np.ndarray:
    """The anchor of each window: the smallest of its GRAM-word hashes."""
    grams = windows(hashes, GRAM)
    span = WINDOW - GRAM + 1
    if len(grams) < span:
        return np.zeros(0, np.uint64)
    n, least, width = len(grams) - span + 1, grams, 1
    while width * 2 <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    return np.minimum(least[:n], least[span - width:span - width + n])


class SuffixAutomaton:
    """All runs of a sequence of words, as states that share their ends."""

    def __init__(self, words: list[bytes]):
        self.following: list[dict] = [{}]
        self.link, self.length = [-1], [0]
        following, link, length = self.following, self.link, self.length
        last = 0
        for word in words:
            state = len(following)
            following.append({})
            length.append(length[last] + 1)
            p = last
            while p >= 0 and word not in following[p]:
                following[p][word] = state
                p = link[p]
            if p < 0:
                link.append(0)
            else:
                q = following[p][word]
                if length[p] + 1 == length[q]:
                    link.append(q)
                else:
                    link.append(state + 1)
                    copy = state + 1
                    following.append(dict(following[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    link[q] = copy
                    while p >= 0 and following[p].get(word) == q:
                        following[p][word] = copy
                        p = link[p]
            last = state

    def matching(self, words: list[bytes]) -> list[int]:
        """For each position, the length of the longest run that ends there and occurs in the sequence."""
        following, link, length = self.following, self.link, self.length
        state, matched, out = 0, 0, []
        for word in words:
            found = following[state].get(word)
            while found is None and state:
                state = link[state]
                matched = length[state]
                found = following[state].get(word)
            if found is not None:
                state = found
                matched += 1
            out.append(matched)
        return out


def document_anchors(docs: DataFrame) -> DataFrame:
    """(doc_id, row, anchors): the distinct anchors of each document that has a window."""
    schema = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("anchors", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Memo(xxhash.xxh3_64_intdigest, KEPT_WORDS)
        for batch in batches:
            ids, keys, found, sizes = [], [], [], [0]
            for doc, text in zip(batch.column("doc_id").to_pylist(), texts(batch)):
                words = text.split()
                if len(words) >= WINDOW:
                    anchors = anchors_of(word_hashes(words, memo))
                    anchors = np.unique(anchors[np.concatenate([[True], anchors[1:] != anchors[:-1]])])
                    ids.append(doc)
                    keys.append(row_key(text))
                    found.append(anchors)
                    sizes.append(len(anchors))
            if ids:
                yield frame(schema, doc_id=ids, row=keys, anchors=pa.ListArray.from_arrays(pa.array(np.cumsum(sizes), pa.int32()), pa.array(as_signed(np.concatenate(found)))))

    return docs.where("doc_id is not null").select("doc_id", "text").mapInArrow(run, "doc_id long, row long, anchors array<long>")


def passages(docs: DataFrame, plan: DataFrame) -> DataFrame:
    """(owner, part, kind, doc_id, row, start, words): kind 0, a reference's whole text for each of its
    parts; kind 1, a passage of a document from word `start` on."""
    schema = pa.schema([("owner", pa.int64()), ("part", pa.int64()), ("kind", pa.int64()), ("doc_id", pa.int64()), ("row", pa.int64()), ("start", pa.int64()), ("words", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Memo(xxhash.xxh3_64_intdigest, KEPT_WORDS)
        rows: list[tuple] = []
        size = 0
        for batch in batches:
            for doc, text, parts, refs in zip(batch.column("doc_id").to_pylist(), texts(batch), batch.column("parts").to_pylist(), batch.column("refs")):
                words = text.split()
                if len(words) < WINDOW:
                    continue
                key = row_key(text)
                for part in range(parts or 0):
                    rows.append((doc, part, 0, doc, key, 0, b" ".join(words)))
                    size += len(text)
                refs = refs.values
                if refs is not None:
                    refs = refs.filter(pc.equal(refs.field("row"), key))
                if refs is not None and len(refs):
                    names = refs.field("anchor").to_numpy().view(np.uint64)
                    order = np.argsort(names)
                    owners = refs.field("owner").to_numpy()[order]
                    shares = refs.field("parts").to_numpy()[order]
                    names = names[order]
                    anchors = anchors_of(word_hashes(words, memo))
                    at = np.minimum(np.searchsorted(names, anchors), len(names) - 1)
                    at = np.where(names[at] == anchors, at, -1)
                    owner = np.where(at >= 0, owners[at], -1)
                    cuts = [0, *(np.flatnonzero((owner[1:] != owner[:-1]) | ((at[1:] < 0) != (at[:-1] < 0))) + 1).tolist(), len(owner)]
                    for a, b in zip(cuts, cuts[1:]):
                        if at[a] >= 0:
                            piece = b" ".join(words[a:b + WINDOW - 1])
                            size += len(piece)
                            rows.append((int(owner[a]), doc % int(shares[at[a]]), 1, doc, key, a, piece))
                if size > 4_000_000:
                    yield frame(schema, **dict(zip(schema.names, map(list, zip(*rows)))))
                    rows, size = [], 0
        if rows:
            yield frame(schema, **dict(zip(schema.names, map(list, zip(*rows)))))

    joined = docs.select("doc_id", "text").join(plan, "doc_id")
    return joined.mapInArrow(run, "owner long, part long, kind long, doc_id long, row long, start long, words binary")


def matched_windows(pieces: DataFrame) -> DataFrame:
    """(doc_id, row, start, stop, first, second): windows from start to stop - 1 that the reference has
    (first and second null), or lacks (their hashes)."""
    schema = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("start", pa.int64()), ("stop", pa.int64()), ("first", pa.list_(pa.int64())), ("second", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Memo(xxhash.xxh3_64_intdigest, KEPT_WORDS)
        automaton = None
        for new, rows in sorted_groups(batches, ["owner", "part"]):
            if new:
                automaton = None
            out: list[tuple] = []
            for kind, doc, key, start, piece in zip(*(rows.column(c).to_pylist() for c in ("kind", "doc_id", "row", "start", "words"))):
                words = piece.split()
                if kind == 0:  # several rows of one id are one document: the automaton of all of them
                    automaton = [*(automaton or []), *([None] if automaton else []), *words]
                    continue
                if isinstance(automaton, list):
                    automaton = SuffixAutomaton(automaton)
                matched = np.array(automaton.matching(words)[WINDOW - 1:]) >= WINDOW
                cuts = [0, *(np.flatnonzero(matched[1:] != matched[:-1]) + 1).tolist(), len(matched)]
                hashes = None
                for a, b in zip(cuts, cuts[1:]):
                    if matched[a]:
                        out.append((doc, key, start + a, start + b, None, None))
                    else:
                        if hashes is None:
                            hashes = word_hashes(words, memo)
                        own = hashes[a:b + WINDOW - 1]
                        out.append((doc, key, start + a, start + b, as_signed(windows(own, WINDOW)), as_signed(windows(mix64(own ^ SECOND), WINDOW))))
            if out:
                yield frame(schema, **dict(zip(schema.names, map(list, zip(*out)))))

    ordered = pieces.repartition(partitions(pieces.sparkSession), "owner", "part").sortWithinPartitions("owner", "part", "kind")
    return ordered.mapInArrow(run, "doc_id long, row long, start long, stop long, first array<long>, second array<long>")


def removed_windows(docs: DataFrame) -> DataFrame:
    """(doc_id, row, start, stop): window starts of `docs` to remove."""
    found = saved(document_anchors(docs))
    rows = found.select("doc_id", "row", F.explode("anchors").alias("anchor"))
    shared = saved(rows.groupBy("anchor").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("last"), F.count(F.lit(1)).alias("n"))
                   .where("owner < last").select("anchor", "owner", "n"))
    parts = saved(shared.groupBy("owner").agg(F.ceil(F.sum(F.col("n") - 1) / LOAD).cast("long").alias("parts")))
    asked = split_join(rows, saved(shared.join(parts, "owner")), "anchor", "n").where("doc_id <> owner")
    refs = asked.groupBy("doc_id").agg(F.collect_list(F.struct("row", "anchor", "owner", "parts")).alias("refs"))  # at most a document's own windows
    plan = refs.join(parts.withColumnRenamed("owner", "doc_id"), "doc_id", "full")
    windows_ = saved(matched_windows(passages(docs, plan)))
    lacking = (windows_.where("first is not null").select("doc_id", "row", "start", F.posexplode(F.arrays_zip("first", "second")).alias("i", "h"))
               .select("doc_id", "row", (F.col("start") + F.col("i")).alias("start"), F.struct("h.first", "h.second").alias("window")))
    again = saved(lacking.groupBy("window").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("last"), F.count(F.lit(1)).alias("n")).where("least < last"))
    rest = split_join(lacking, again, "window", "n").where("doc_id > least").select("doc_id", "row", "start", (F.col("start") + 1).alias("stop"))
    return windows_.where("first is null").select("doc_id", "row", "start", "stop").unionByName(rest)


def cut(docs: DataFrame, removed: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept_text) for every row of `docs`."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept_text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                totals, gone, digests, kept_texts = [], [], [], []
                for text, spans in zip(texts(batch), batch.column("spans")):
                    words = text.split()
                    kept = words
                    if spans.values is not None and len(words) >= WINDOW:
                        own = spans.values.filter(pc.equal(spans.values.field("row"), row_key(text)))
                        edges = np.zeros(len(words) + 1, np.int64)
                        np.add.at(edges, own.field("start").to_numpy(), 1)
                        np.add.at(edges, own.field("stop").to_numpy() + WINDOW - 1, -1)
                        kept = [w for w, covered in zip(words, np.cumsum(edges).tolist()) if not covered]
                    joined = b" ".join(kept)
                    totals.append(len(words))
                    gone.append(len(words) - len(kept))
                    digests.append(hashlib.sha256(joined).hexdigest())
                    kept_texts.append(joined.decode("utf-8", "replace"))
                yield frame(schema, doc_id=batch.column("doc_id"), n_words=totals, n_removed=gone, kept_sha256=digests, kept_text=kept_texts)

    spans = removed.groupBy("doc_id").agg(F.collect_list(F.struct("row", "start", "stop")).alias("spans"))  # at most a document's own windows
    joined = docs.select("doc_id", "text").join(spans, "doc_id", "left")
    return joined.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string")


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row of `docs` without the words of windows that an earlier document has."""
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return cut(named, removed_windows(named))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Removed words and the digest of what stays, for every document."""
    return substring_dedup(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")
