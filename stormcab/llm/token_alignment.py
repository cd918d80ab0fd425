"""Cross-tokenizer alignment (operator 13): pointer jumping over overlapping tokens.

Two vocabularies cut the same bytes.  Every token points to the farthest-right token that
overlaps it, itself included (farthest by its end; of equal ends the second vocabulary's).
Tokens of one component of overlapping tokens so lead to the same last token, the one of the
second vocabulary that ends where both end, which points at itself.  Doubling the successors of all
tokens of a block of documents at once (`jump`) reaches it in about log2(longest chain) vector operations,
and labels the groups.

Corpus counts: in how many documents is an id pair linked?  Documents are dealt to chunks of about
`CHUNK_BYTES` as they are read.  A chunk lists its distinct pairs once, whatever number of its
documents has them, and keeps for each document the numbers of its pairs in that list.  Only the
lists are shuffled: summed by pair, joined with the sums, and sent back to their chunk, where
each document's sums are table lookups.  A pair that every document has is one row a chunk.
The encoded chunks are written to the shared folder, so a lost executor re-reads and does not encode again.
The one thing broadcast is the highest count of each id of the first vocabulary, a row an id.

Tokenizers: texts are split where no token of the vocabulary can cross, by the first
vocabulary's own pattern or before the spaces and around the line ends of the second, and each
distinct part is encoded once by the vocabulary's library.  A text with a character that the
library's pattern and this one's class differently (newer Unicode) goes to the library whole.

Defined results: a null or empty text, or one that a vocabulary does not give back byte by byte, has
no tokens: zeros and ''.  Repeated rows are a document each; a null id is passed through; an empty table gives no row.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import Memo, partitions, saved, table
from .token_counts import byte_symbols

FIRST, SECOND = "byte_bpe_50k.json", "piece_bpe_32k.model"
# bytes of text in a chunk, and of those aligned at a time; parts whose tokens a worker keeps; groups of more links pair distinct ids
CHUNK_BYTES, BLOCK_BYTES, KEPT_PARTS, DENSE = 8 << 20, 1 << 20, 300_000, 64
SPACE = "▁"  # stands for a space in pieces

DOCUMENT = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string"
CHUNK = f"chunk bigint, documents array<struct<{DOCUMENT.replace(' ', ': ').replace(',: ', ', ')}>>, pairs array<bigint>, held array<int>, ends binary, codes binary, times binary"
RESULT = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"
ALIGNED = "doc_id bigint, a_ids array<int>, b_ids array<int>, a_groups array<int>, b_groups array<int>"


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each start, `length` numbers each, in one array."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.arange(total) + np.repeat(starts - before, lengths)


class Encoder:
    """Token ids of whole texts, each distinct part of them encoded once."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.bytes_of_token = np.array([len(t) for t in tokens], np.int64)
        self.forget()

    def forget(self) -> None:
        self.numbers, self.ids, self.same = {}, np.zeros(0, np.int32), np.zeros(0, bool)
        self.starts, self.sizes = np.zeros((2, 0), np.int64)

    def split(self, text: str) -> list[str]:
        """The parts of a text; no token crosses from one to the next."""
        raise NotImplementedError

    def encode(self, parts: list[str]) -> Iterable[list[int]]:
        """Token ids of each part by the library."""
        raise NotImplementedError

    def learn(self, parts: list[str]) -> None:
        """Keeps the tokens of new parts, and whether they give the part back."""
        found = list(self.encode(parts))
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.fromiter(chain.from_iterable(found), np.int32, int(sizes.sum()))
        said = "".join(parts)
        lengths = np.fromiter(map(len, parts if said.isascii() else map(str.encode, parts)), np.int64, len(parts))
        tokens = np.concatenate([[0], np.cumsum(self.bytes_of_token[ids])])[np.cumsum(sizes)]
        if np.array_equal(tokens, np.cumsum(lengths)) and b"".join(map(self.tokens.__getitem__, ids.tolist())) == said.encode():
            same = np.ones(len(parts), bool)
        else:
            same = np.fromiter((b"".join(map(self.tokens.__getitem__, i)) == p.encode() for p, i in zip(parts, found)), bool, len(parts))
        self.numbers.update(zip(parts, range(len(self.numbers), len(self.numbers) + len(parts))))
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(sizes) - sizes])
        self.ids, self.sizes, self.same = (np.concatenate(x) for x in ((self.ids, ids), (self.sizes, sizes), (self.same, same)))

    def texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Token ids of all texts in a row, how many each has, and do they give back space + text?"""
        if len(self.numbers) > KEPT_PARTS:
            self.forget()
        split = [self.split(t) for t in texts]
        missing = {}
        for parts in split:
            missing.update(dict.fromkeys(set(parts).difference(self.numbers)))
        self.learn(list(missing))
        ends = np.cumsum([0, *map(len, split)])
        numbers = np.fromiter(map(self.numbers.__getitem__, chain.from_iterable(split)), np.int64, int(ends[-1]))
        ids = self.ids[ragged(self.starts[numbers], self.sizes[numbers])]
        tokens, wrong = (np.concatenate([[0], np.cumsum(x[numbers])])[ends] for x in (self.sizes, ~self.same))
        return ids, np.diff(tokens), np.diff(wrong) == 0


class FirstEncoder(Encoder):
    """Byte-level vocabulary of a tokenizers file."""

    # The vocabulary's own pattern, and the same for ASCII texts.
    PARTS = regex.compile(r"'(?:s|t|re|ve|m|ll|d)| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
    ASCII_PARTS = re.compile(r"'(?:s|t|re|ve|m|ll|d)| ?[A-Za-z]+| ?[0-9]+| ?[^\t-\r 0-9A-Za-z]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+")
    CLASSES = (regex.compile(r"\p{L}"), regex.compile(r"\p{N}"), regex.compile(r"[^\p{White_Space}\p{L}\p{N}]"))

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        names = spec["model"]["vocab"] | {t["content"]: t["id"] for t in spec["added_tokens"]}
        byte = {s: b for b, s in enumerate(byte_symbols())}
        tokens = [b""] * (max(names.values()) + 1)
        for name, i in names.items():
            tokens[i] = bytes(byte[c] for c in name) if all(c in byte for c in name) else name.encode()
        self.agreed = Memo(self.agrees, 200_000)
        self.symbols = str.maketrans({b: s for b, s in enumerate(byte_symbols()) if b < 128})
        self.whole = set()  # texts that the library splits itself
        super().__init__(tokens)

    def agrees(self, c: str) -> bool:
        """Is a character of the same class here as in the library?"""
        pieces = self.library.pre_tokenizer.pre_tokenize_str
        return [len(pieces(x + c + x)) == 1 for x in "a1!"] == [bool(r.match(c)) for r in self.CLASSES]

    def split(self, text):
        text = " " + text
        if text.isascii():
            return self.ASCII_PARTS.findall(text)
        if all(map(self.agreed.__getitem__, set(text))):
            return self.PARTS.findall(text)
        self.whole.add(text)
        return [text]

    def encode(self, parts):
        """A part is one word of the library's pattern, so it goes to the merges directly."""
        tokenize, symbols, marks = self.library.model.tokenize, self.symbols, byte_symbols()
        for part in parts:
            if part in self.whole:
                yield self.library.encode(part, add_special_tokens=False).ids
            else:
                said = part.translate(symbols) if part.isascii() else "".join([marks[b] for b in part.encode()])
                yield [t.id for t in tokenize(said)]
        self.whole.clear()


class SecondEncoder(Encoder):
    """Piece vocabulary of a sentencepiece file with byte fallback.

    No piece has a space after another character, and none a line end, so parts start at runs of spaces
    and stop before line ends; and before a mark that no piece has behind a letter or digit."""

    WORD, MARKS = "A-Za-z0-9\u00c0-\u024f", ",.;:!?\"')(|-"

    def __init__(self, path: str):
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.library.id_to_piece(i) for i in range(len(self.library))]
        if any(SPACE in n.lstrip(SPACE) or "\n" in n for n in names):
            raise ValueError("pieces cross spaces or line ends: texts can't be split")
        letter = re.compile(f"[{self.WORD}]")
        inside = {b for n in names for a, b in zip(n, n[1:]) if letter.match(a)}
        marks = "".join(re.escape(c) for c in self.MARKS if c not in inside)
        self.parts = re.compile((rf" *[{self.WORD}]++(?=[{marks}])|" if marks else "") + r" *[^ \n]+| +|\n")
        # a lone space, and how the library starts a text that starts with a line end
        self.space, self.line = [self.library.piece_to_id(SPACE)], self.library.encode("\n")
        super().__init__([bytes([int(n[3:5], 16)]) if self.library.is_byte(i) else n.replace(SPACE, " ").encode() for i, n in enumerate(names)])

    def split(self, text):
        return self.parts.findall(" " + text)

    def encode(self, parts):
        """The library puts a space first, so a part's own first space is left out, and a part without one follows a line end."""
        given = [p[1:] if p[0] == " " else "\n" + p for p in parts]
        for part, ids in zip(parts, self.library.encode(given, num_threads=1) if given else ()):
            yield self.space if part == " " else ids if part[0] == " " else ids[len(self.line):]


def jump(successor: np.ndarray) -> np.ndarray:
    """Where each chain of successors ends: successors are doubled until none changes."""
    while True:
        further = successor[successor]
        if (further == successor).all():
            return successor
        successor = further


@dataclass
class Alignment:
    """The tokens of several documents in a row and the group of each; groups are numbered from 0 in order."""

    a_ids: np.ndarray
    b_ids: np.ndarray
    a_group: np.ndarray
    b_group: np.ndarray
    a_counts: np.ndarray      # by document
    b_counts: np.ndarray
    group_counts: np.ndarray

    @property
    def links(self) -> np.ndarray:
        """By group: how many pairs of tokens it links."""
        n = int(self.group_counts.sum())
        return np.bincount(self.a_group, minlength=n) * np.bincount(self.b_group, minlength=n)

    def pairs(self, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (document, a * width + b) and how many links each stands for, in order."""
        n = int(self.group_counts.sum())
        na, nb = np.bincount(self.a_group, minlength=n), np.bincount(self.b_group, minlength=n)
        document = np.repeat(np.arange(len(self.group_counts)), self.group_counts)
        first_a, first_b = np.cumsum(na) - na, np.cumsum(nb) - nb
        plain = (na * nb <= DENSE)[self.a_group]
        group, ids = self.a_group[plain], self.a_ids[plain].astype(np.int64)
        reps = nb[group]
        docs = [np.repeat(document[group], reps)]
        keys = [np.repeat(ids * width, reps) + self.b_ids[ragged(first_b[group], reps)]]
        times = [np.ones(len(keys[0]), np.int64)]
        for g in np.flatnonzero(na * nb > DENSE).tolist():  # ids of a large group are paired once each
            a, ca = np.unique(self.a_ids[first_a[g]:first_a[g] + na[g]], return_counts=True)
            b, cb = np.unique(self.b_ids[first_b[g]:first_b[g] + nb[g]], return_counts=True)
            keys.append((a.astype(np.int64)[:, None] * width + b).ravel())
            times.append((ca[:, None] * cb).ravel())
            docs.append(np.full(len(keys[-1]), document[g]))
        docs, keys, times = map(np.concatenate, (docs, keys, times))
        order = np.lexsort((keys, docs))
        docs, keys, times = docs[order], keys[order], times[order]
        new = np.flatnonzero(np.concatenate([[True], (docs[1:] != docs[:-1]) | (keys[1:] != keys[:-1])])) if len(keys) else np.zeros(0, np.int64)
        return docs[new], keys[new], np.add.reduceat(times, new) if len(new) else times


class Aligner:
    """Tokens and groups of whole texts under two vocabularies."""

    def __init__(self, first: str, second: str):
        self.a, self.b = FirstEncoder(first), SecondEncoder(second)
        self.width = len(self.b.tokens)
        names = [str(i) for i in range(max(len(self.a.tokens), self.width))]
        # a token's text in a group's description, by what follows it
        self.words = np.array([n + c for c in ",|;" for n in names], object)
        self.ids = len(names)

    def align(self, texts: list[str]) -> Alignment:
        """Alignment of the texts; null ones are ''."""
        whole = [t if t and SPACE not in t else "" for t in texts]  # a piece's mark would come back as a space
        spoken = [t for t in whole if t]
        a, na, good_a = self.a.texts(spoken)
        b, nb, good_b = self.b.texts(spoken)
        good = good_a & good_b
        a, b = a[np.repeat(good, na)], b[np.repeat(good, nb)]
        counts = np.zeros((2, len(texts)), np.int64)
        at = np.flatnonzero([bool(t) for t in whole])[good]
        counts[0, at], counts[1, at] = na[good], nb[good]
        end_a, end_b = np.cumsum(self.a.bytes_of_token[a]), np.cumsum(self.b.bytes_of_token[b])
        # a successor is the other vocabulary's token over one's last byte, if it ends later, or as late and is of the second
        over_a = np.searchsorted(end_b, end_a, side="left") + len(a)
        over_b = np.searchsorted(end_a, end_b, side="left")
        own_b = np.arange(len(b)) + len(a)
        last = jump(np.concatenate([over_a, np.where(end_a[over_b] > end_b, over_b, own_b) if len(b) else own_b]))
        a_last, b_last = last[:len(a)] - len(a), last[len(a):] - len(a)
        ends = np.flatnonzero(b_last == np.arange(len(b)))  # the last token of each group
        number = np.zeros(len(b), np.int64)
        number[ends] = np.arange(len(ends))
        groups = np.diff(np.concatenate([[0], np.searchsorted(ends, np.cumsum(counts[1]))]))
        return Alignment(a, b, number[a_last], number[b_last], counts[0], counts[1], groups)

    def described(self, al: Alignment) -> list[str]:
        """By document: `a1,a2|b1;a3|b2,b3`, the ids of its groups in order."""
        n = int(al.group_counts.sum())
        na, nb = np.bincount(al.a_group, minlength=n), np.bincount(al.b_group, minlength=n)
        word = np.zeros(len(al.a_ids) + len(al.b_ids), np.int64)
        last_a = np.zeros(len(al.a_ids), bool)
        last_b = np.zeros(len(al.b_ids), bool)
        last_a[np.cumsum(na) - 1], last_b[np.cumsum(nb) - 1] = True, True
        # an a stands behind the b of earlier groups, a b behind the a of its own too
        word[np.arange(len(al.a_ids)) + (np.cumsum(nb) - nb)[al.a_group]] = al.a_ids + np.where(last_a, self.ids, 0)
        word[np.arange(len(al.b_ids)) + np.cumsum(na)[al.b_group]] = al.b_ids + np.where(last_b, 2 * self.ids, 0)
        ends = np.cumsum(al.a_counts + al.b_counts)
        return ["".join(self.words[word[x:y]].tolist())[:-1] for x, y in zip([0, *ends.tolist()], ends.tolist())]


def chunks_of_texts(batches: Iterator[pa.RecordBatch], limit: int = CHUNK_BYTES) -> Iterator[tuple[list, list[str]]]:
    """(ids, texts) of about `limit` bytes of text; a longer text is alone."""
    ids, held, size = [], [], 0
    for batch in batches:
        for i, text in zip(batch.column("doc_id"), batch.column("text")):
            text = text.as_py() or ""
            if held and size + len(text) > limit:
                yield ids, held
                ids, held, size = [], [], 0
            ids.append(i.as_py())
            held.append(text)
            size += len(text) + 64
    if held:
        yield ids, held


def blocks_of(held: list[str]) -> Iterator[tuple[int, list[str]]]:
    """Parts of a chunk of about `BLOCK_BYTES` each, with the number of their first text."""
    first, size = 0, 0
    for i, text in enumerate(held):
        if i > first and size + len(text) > BLOCK_BYTES:
            yield first, held[first:i]
            first, size = i, 0
        size += len(text)
    yield first, held[first:]


def alignments(docs: DataFrame, first: str | None = None, second: str | None = None) -> DataFrame:
    """Token ids of both vocabularies and the group of each token, by document."""
    first, second = first or public_tokenizers.path(FIRST), second or public_tokenizers.path(SECOND)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(first, second)
        for ids, held in chunks_of_texts(batches, BLOCK_BYTES):
            al = aligner.align(held)
            before = np.repeat(np.cumsum(al.group_counts) - al.group_counts, al.a_counts), np.repeat(np.cumsum(al.group_counts) - al.group_counts, al.b_counts)

            def lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
                return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(values, pa.int32()))

            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), lists(al.a_ids, al.a_counts), lists(al.b_ids, al.b_counts),
                                              lists(al.a_group - before[0], al.a_counts), lists(al.b_group - before[1], al.b_counts)],
                                             names=["doc_id", "a_ids", "b_ids", "a_groups", "b_groups"])

    return docs.select("doc_id", "text").mapInArrow(work, ALIGNED)


def packed(numbers: np.ndarray) -> bytes:
    """Numbers of 0 and more, in as few bytes each as the largest needs, compressed."""
    kind = np.min_scalar_type(int(numbers.max()) if len(numbers) else 0)
    return kind.str.encode() + zlib.compress(numbers.astype(kind).tobytes(), 1)


def unpacked(raw: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(raw[3:]), raw[:3].decode()).astype(np.int64)


def aligned_chunks(docs: DataFrame, first: str | None = None, second: str | None = None, limit: int = CHUNK_BYTES) -> DataFrame:
    """Chunks of aligned documents: the figures of each, the chunk's distinct id pairs, in how many of its
    documents each is linked, and for each document the numbers of its pairs and how often they are linked."""
    first, second = first or public_tokenizers.path(FIRST), second or public_tokenizers.path(SECOND)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, task = Aligner(first, second), TaskContext.get().partitionId() << 32
        for number, (ids, held) in enumerate(chunks_of_texts(batches, limit)):
            counts, entries, digests = [], [], []
            for first_of, block in blocks_of(held):
                al = aligner.align(block)
                docs_of, keys, times = al.pairs(aligner.width)
                entries.append((docs_of + first_of, keys, times))
                ends = np.cumsum(al.group_counts)
                links = np.concatenate([[0], np.cumsum(al.links)])
                counts.append(np.stack([al.a_counts, al.b_counts, al.group_counts, links[ends] - links[ends - al.group_counts]]))
                digests += [hashlib.sha256(d.encode()).hexdigest() if d else "" for d in aligner.described(al)]
            docs_of, keys, times = (np.concatenate(x) for x in zip(*entries))
            pairs, code = np.unique(keys, return_inverse=True)
            documents = pa.StructArray.from_arrays(
                [pa.array(ids, pa.int64()), *map(pa.array, np.concatenate(counts, axis=1)), pa.array(digests, pa.string())],
                names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"])
            yield pa.RecordBatch.from_arrays(
                [pa.array([task + number], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(documents)], pa.int32()), documents),
                 pa.array([pairs], pa.list_(pa.int64())), pa.array([np.bincount(code, minlength=len(pairs)).astype(np.int32)], pa.list_(pa.int32())),
                 pa.array([packed(np.searchsorted(docs_of, np.arange(len(ids)), side="right"))], pa.binary()),
                 pa.array([packed(code)], pa.binary()), pa.array([packed(times)], pa.binary())],
                names=["chunk", "documents", "pairs", "held", "ends", "codes", "times"])

    return saved(docs.select("doc_id", "text").mapInArrow(work, CHUNK))


def pair_rows(chunks: DataFrame) -> DataFrame:
    """The distinct pairs of each chunk: (chunk, code, pair, held)."""
    return chunks.select("chunk", F.posexplode(F.arrays_zip("pairs", "held")).alias("code", "p")).select("chunk", "code", "p.pairs", "p.held").withColumnRenamed("pairs", "pair")


def pair_counts(rows: DataFrame, width: int) -> DataFrame:
    """(pair, a, b, documents, best): in how many documents a pair is linked, and is that the most for its `a`."""
    counts = rows.groupBy("pair").agg(F.sum("held").alias("documents")).withColumn("a", F.floor(F.col("pair") / width)).withColumn("b", F.col("pair") % width)
    most = counts.groupBy("a").agg(F.max("documents").alias("most"))  # at most one row an id of the first vocabulary
    return counts.join(F.broadcast(most), "a").select("pair", "a", "b", "documents", (F.col("documents") == F.col("most")).alias("best"))


def figures(chunks: DataFrame, counts: DataFrame, rows: DataFrame) -> DataFrame:
    """Each document's figures: every chunk's list of pairs comes back to it with the corpus counts."""
    found = rows.join(counts.select("pair", "documents", "best"), "pair").select(F.col("chunk").alias("home"), "code", "documents", "best")

    def work(chunk: pa.Table, found: pa.Table) -> pa.Table:
        row = chunk.slice(0, 1)
        count, best = np.zeros(found.num_rows, np.int64), np.zeros(found.num_rows, np.int64)
        code = found.column("code").to_numpy()
        count[code], best[code] = found.column("documents").to_numpy(), found.column("best").to_numpy()
        ends, codes, times = (unpacked(row.column(c)[0].as_py()) for c in ("ends", "codes", "times"))
        sums = [np.concatenate([[0], np.cumsum(times * x[codes])]) for x in (best, count)]
        starts = np.concatenate([[0], ends[:-1]])
        documents = row.column("documents").combine_chunks().flatten()
        field = {f.name: documents.field(f.name) for f in documents.type}
        field |= {"n_best": pa.array(sums[0][ends] - sums[0][starts]), "count_sum": pa.array(sums[1][ends] - sums[1][starts])}
        names = [c.split()[0] for c in RESULT.split(", ")]
        return pa.table({n: field[n] for n in names})

    kept = chunks.select("chunk", "documents", "ends", "codes", "times")
    return kept.groupBy("chunk").cogroup(found.groupBy("home")).applyInArrow(work, RESULT)


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's token, group and link counts, and its links by corpus-wide count."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    chunks = aligned_chunks(docs)
    rows = pair_rows(chunks)
    width = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(SECOND)).get_piece_size()
    return figures(chunks, pair_counts(rows, width), rows)
