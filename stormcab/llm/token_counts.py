"""Token counts (operator 1): exact token counts at every prefix by dynamic programming.

`prefix_counts` stores, for each document, how many tokens each prefix of its
(normalised) text has.  Truncation and budget questions are then array
lookups (`tokens_at`, `longest_prefix`) and no text is encoded again.

The dynamic program goes over the prefixes of a word.  In a byte-pair
encoding the tokens before the last one are the encoding of a shorter prefix,
so the encoding of a prefix is: the one vocabulary entry t that ends there and
may follow the last token of the prefix that t leaves; the count is one more
than that prefix's.  Whether t may follow s is the question if s + t encodes
to just [s, t], which the ranks of the merges at their border tell; the
answers are kept, as are the counts of recent words.
Words of one text are independent, so a text's counts are its words' counts
plus what came before.

Defined results: a null or empty text has no prefix and no tokens; repeated
rows are counted each; every other column is passed through unread.
A special token inside a text counts one, as the library has it by default,
and its own prefixes count as ordinary text.  An empty table gives no row.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Memo, table, texts

TOKENIZER = "word_bpe_49k.json"
LIMIT = 2048
# characters of prefix counts in one Arrow batch; words and token pairs kept by a Python worker
BATCH_CHARS, KEPT_WORDS, KEPT_PAIRS = 1 << 21, 400_000, 300_000
NEVER, SPAN = 1 << 60, 1 << 20  # SPAN: over the size of any vocabulary

# White space, and the contractions that the vocabulary's file splits off first.
WHITE = "\t\n\x0b\x0c\r \x85\xa0                　"
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")



PIECES = regex.compile("|".join([r"\p{L}+", *CONTRACTIONS, r"\p{N}", r"[^\p{White_Space}\p{L}\p{N}]+"]))
ASCII_PIECES = re.compile("|".join([r"[a-z]+", *CONTRACTIONS, r"[0-9]", r"[^\t-\r a-z0-9]+"]))
WHITE_CODES = np.array([ord(c) for c in WHITE], np.uint32)


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: itself if printable in
    Latin-1, else the next free character from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, free = [], 256
    for b in range(256):
        out.append(chr(b) if b in printable else chr(free))
        free += b not in printable
    return out


class PrefixCounter:
    """Token counts of all prefixes under the vocabulary in a tokenizers file."""

    def __init__(self, file: str):
        with open(file, encoding="utf-8") as f:
            spec = json.load(f)
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        self.rank = {m: i for i, m in enumerate(merges)}
        self.end = spec["model"]["end_of_word_suffix"] or ""
        vocabulary = spec["model"]["vocab"]
        names = sorted({t.removesuffix(self.end) for t in vocabulary})
        self.finder = ahocorasick.Automaton()
        for t in names:  # (length, number inside a word, number at its end), a number 0 where there is no such token
            self.finder.add_word(t, (len(t), vocabulary.get(t, -1) + 1, vocabulary.get(t + self.end, -1) + 1))
        self.finder.make_automaton()
        self.token = {i + 1: t for t, i in vocabulary.items()}
        self.longest = max(map(len, names))
        self.symbols = byte_symbols()
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.split = re.compile("|".join(f"({re.escape(s)})" for s in self.special)) if self.special else None
        self.made = {}
        for (left, right), i in self.rank.items():
            self.made.setdefault(left + right, (left, right, i))
        self.rights = Memo(lambda t: self.spine(t, 1), KEPT_PAIRS)
        self.lefts = Memo(lambda t: self.spine(t, 0), KEPT_PAIRS)
        self.pairs = Memo(self.may_follow, KEPT_PAIRS)
        self.words = Memo(self.word, KEPT_WORDS)

    def spine(self, token: str, side: int) -> list[tuple[str, int]]:
        """The parts of a token at its right (1) or left (0) edge, smallest first, each with the
        rank of the merge that takes it in."""
        out, limit = [], NEVER
        while token in self.made:
            out.append((token, limit))
            *parts, limit = self.made[token]
            token = parts[side]
        return [*out, (token, limit)][::-1]

    def may_follow(self, pair: int) -> bool:
        """Do two tokens side by side stay as they are?  Merges go by rank, so a merge across the
        border happens if it ranks before the merges that take its two sides into their tokens
        (of equals, the leftmost goes first)."""
        left, right = self.rights[self.token[pair // SPAN]], self.lefts[self.token[pair % SPAN]]
        i = j = 0
        while True:
            (x, until_x), (y, until_y) = left[i], right[j]
            across = self.rank.get((x, y), NEVER)
            if across < until_x and across <= until_y:
                return False
            if until_x == until_y == NEVER:
                return True
            if until_x <= until_y:
                i += 1
            else:
                j += 1

    def word(self, word: str) -> bytes:
        """32-bit counts of the prefixes of one piece, one for each character."""
        if word in CONTRACTIONS and len(word) > 2:  # cut short, it is an apostrophe and a letter
            return array("i", [*range(1, len(word)), self.counts(word)[-1]]).tobytes()
        return array("i", self.counts(word)).tobytes()

    def counts(self, word: str) -> list[int]:
        text = word if word.isascii() and word.isprintable() else "".join(map(self.symbols.__getitem__, word.encode("utf-8", "surrogatepass")))
        # for each position, the last token of the prefix that ends there (times SPAN) and its count
        lasts, counts, ends = ([0] * (len(text) + 1) for _ in range(3))
        pairs = self.pairs
        for i, (size, inside, final) in self.finder.iter(text):
            at = i + 1 - size
            before = lasts[at]
            if inside and not lasts[i + 1] and (at == 0 or pairs[before + inside]):
                lasts[i + 1] = inside * SPAN
                counts[i + 1] = counts[at] + 1
            if final and not ends[i + 1] and (at == 0 or pairs[before + final]):
                ends[i + 1] = counts[at] + 1
        if len(text) == len(word):
            return ends[1:]
        return [ends[i] for i in np.cumsum([len(c.encode("utf-8", "surrogatepass")) for c in word]).tolist()]

    def ordinary(self, text: str) -> np.ndarray:
        """Counts of the prefixes of a text without special tokens."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        pieces = (ASCII_PIECES if text.isascii() else PIECES).findall(text)
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        if not pieces:
            return np.zeros(len(codes), np.int32)
        inner = np.frombuffer(b"".join(map(self.words.__getitem__, pieces)), np.int32)
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ends = np.cumsum(lengths)
        totals = inner[ends - 1]
        inner = inner + np.repeat(np.cumsum(totals) - totals, lengths)
        solid = ~np.isin(codes, WHITE_CODES) if not text.isascii() else ~((codes == 32) | ((codes >= 9) & (codes <= 13)))
        at = np.cumsum(solid)  # white space has what the character before it has
        return np.concatenate([np.zeros(1, np.int32), inner.astype(np.int32)])[at]

    def text(self, text: str) -> np.ndarray:
        """Counts of the prefixes of a whole text, special tokens included."""
        if not self.split or not any(s in text for s in self.special):
            return self.ordinary(text)
        parts = [p for p in self.split.split(text) if p]
        out, base, k = [], 0, 0
        while k < len(parts):
            plain = "" if parts[k] in self.special else parts[k]
            k += plain != ""
            special = parts[k] if k < len(parts) else ""
            k += special != ""
            counts = self.ordinary(plain + special[:-1])
            size = len(counts) - max(0, len(special) - 1)
            out.append(counts + base)
            base += int(counts[size - 1]) if size else 0
            if special:
                base += 1
                out.append(np.array([base], np.int32))
        return np.concatenate(out) if out else np.zeros(0, np.int32)


def prefix_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None) -> DataFrame:
    """(id, prefix_tokens): element p of `prefix_tokens` is the token count of the first p characters
    (p from 1) of the text after the tokenizer's own normalisation (NFC, lower case).

    A map over the rows: no shuffle; a Python worker keeps a bounded number of words."""
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("prefix_tokens", T.ArrayType(T.IntegerType(), False), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PrefixCounter(tokenizer or public_tokenizers.path(TOKENIZER))
        for batch in batches:
            rows, sizes, chars, start = [], [], 0, 0
            for i, raw in enumerate(texts(batch, text_col)):
                counts = counter.text(raw.decode("utf-8", "replace"))
                rows.append(counts)
                sizes.append(len(counts))
                chars += len(counts)
                if chars >= BATCH_CHARS or i + 1 == batch.num_rows:
                    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(np.concatenate(rows), pa.int32()))
                    yield pa.RecordBatch.from_arrays([batch.column(id_col).slice(start, len(rows)), lists], ["id", "prefix_tokens"])
                    rows, sizes, chars, start = [], [], 0, i + 1

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def total(counts: Column) -> Column:
    """Tokens of the whole text."""
    return F.when(F.size(counts) > 0, F.element_at(counts, -1)).otherwise(0).cast("long")


def tokens_at(counts: Column, chars: Column) -> Column:
    """Tokens of the first `chars` characters (of the whole text, if it is shorter)."""
    at = F.least(chars.cast("int"), F.size(counts))
    return F.when(at > 0, F.get(counts, at - 1)).otherwise(0).cast("long")


def longest_prefix(counts: Column, budget: int) -> Column:
    """Characters of the longest prefix with at most `budget` tokens.  Counts can fall when a word is
    completed, so this is the last such position and not the first excess."""
    fits = F.transform(counts, lambda n, i: F.when(n <= F.lit(budget), i + 1).otherwise(0))
    return F.coalesce(F.array_max(fits), F.lit(0)).cast("long")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes, tokens and budget flag of every document."""
    docs = table(spark, sf_dir, "documents")
    sized = docs.select(F.struct("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")).alias("key"), "text")
    counted = prefix_counts(sized, "key")
    tokens = total(F.col("prefix_tokens"))
    return counted.select("id.doc_id", "id.n_bytes", tokens.alias("n_tokens"), (tokens > LIMIT).alias("over_limit"))
