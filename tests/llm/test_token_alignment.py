"""Token alignment against the two libraries and a plain union of overlapping tokens."""

from __future__ import annotations

import collections
import hashlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from stormcab.llm import token_alignment as ta

from .brute import SMOKE, edge_docs, rows_of

A = Tokenizer.from_file(public_tokenizers.path(ta.FIRST))
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(ta.SECOND))
BYTE = {s: b for b, s in enumerate(ta.byte_symbols())}
ALIGNER = ta.Aligner(public_tokenizers.path(ta.FIRST), public_tokenizers.path(ta.SECOND))
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
AWKWARD = ["", " ", "  ", "\n", "\n\n x", " a  b ", "a\nb", "it's we'll", "<|endoftext|> <s> <0x0A> <unk>", "a▁b", "▁", "日本語のテキスト 漢字", "é ﬁ İ",
           "\x00\x01", "　x y", "\r\n\t z", "a" * 3000, "ab" * 2000 + " " * 500, "\U00010940꟎ 1౜", "x\u0085y", "😀👩‍👩‍👧 ok", "1234567 ٣٤", "'s 's"]


def tokens(text):
    """Ids and bytes by the libraries; none where they do not give the text back."""
    if not text:
        return [], [], [], []
    a, b = A.encode(" " + text, add_special_tokens=False).ids, B.encode(text, num_threads=1)
    x = [bytes(BYTE[c] for c in A.id_to_token(i)) for i in a]
    y = [bytes([int(B.id_to_piece(i)[3:5], 16)]) if B.is_byte(i) else B.id_to_piece(i).replace("▁", " ").encode() for i in b]
    whole = (" " + text).encode()
    return (a, x, b, y) if b"".join(x) == whole == b"".join(y) else ([], [], [], [])


def groups(text):
    """[(a ids, b ids)]: cut wherever tokens of both end."""
    a, x, b, y = tokens(text)
    out, i, j = [], 0, 0
    while i < len(a):
        first, end_a, end_b = (i, j), len(x[i]), len(y[j])
        i, j = i + 1, j + 1
        while end_a != end_b:
            if end_a < end_b:
                end_a, i = end_a + len(x[i]), i + 1
            else:
                end_b, j = end_b + len(y[j]), j + 1
        out.append((a[first[0]:i], b[first[1]:j]))
    return out


def brute(rows):
    """The rows of op13 for (doc_id, text)."""
    found = [(i, groups(t)) for i, t in rows]
    links = [collections.Counter((a, b) for g in gs for a in g[0] for b in g[1]) for _, gs in found]
    counts = collections.Counter(p for c in links for p in c)
    most = collections.defaultdict(int)
    for (a, _), n in counts.items():
        most[a] = max(most[a], n)
    out = []
    for (i, gs), c in zip(found, links):
        said = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in gs)
        out.append((i, sum(len(a) for a, _ in gs), sum(len(b) for _, b in gs), len(gs), sum(c.values()), sum(n for p, n in c.items() if counts[p] == most[p[0]]),
                    sum(n * counts[p] for p, n in c.items()), hashlib.sha256(said.encode()).hexdigest() if gs else ""))
    return sorted(out, key=repr)


def found(spark, docs, **how):
    chunks = ta.aligned_chunks(docs, **how)
    rows = ta.pair_rows(chunks)
    return rows_of(ta.figures(chunks, ta.pair_counts(rows, ALIGNER.width), rows), COLUMNS)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=30), max_size=4))
def test_ids_and_groups_of_any_texts(texts):
    al = ALIGNER.align(texts)
    assert ALIGNER.described(al) == [";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups(t)) for t in texts]


@pytest.mark.parametrize("text", AWKWARD)
def test_awkward_texts(text):
    al = ALIGNER.align(["ab", text, "c d"])
    assert al.group_counts.tolist()[1] == len(groups(text))
    assert al.a_ids.tolist() == tokens("ab")[0] + tokens(text)[0] + tokens("c d")[0]
    assert al.b_ids.tolist() == tokens("ab")[2] + tokens(text)[2] + tokens("c d")[2]


def test_op13_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet").select("doc_id", "text").collect()
    got = ta.op13_token_alignment(spark, SMOKE)
    assert got.columns == COLUMNS
    assert rows_of(got, COLUMNS) == brute([tuple(r) for r in docs])


@pytest.mark.parametrize("limit", [1, 300, ta.CHUNK_BYTES])
def test_edges_and_chunk_sizes(spark, limit):
    docs = edge_docs(spark, AWKWARD)
    assert found(spark, docs, limit=limit) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_million_words_and_large_groups(spark):
    words = ["alpha", "beta,", "gamma\n", "délta", "12345"]
    long = " ".join(words[i * i % 5] for i in range(1_000_000))
    al = ALIGNER.align([long, "short"])
    assert al.a_counts.tolist() == [len(A.encode(" " + long, add_special_tokens=False).ids), len(tokens("short")[0])]
    rows = [(1, "ab" * 3000), (2, "ab" * 10), (3, "aab" * 500 + " x")]  # groups beyond DENSE
    assert found(spark, spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, pairs string, chunk int")
    assert found(spark, docs) == []
    nothing = spark.createDataFrame([(1, None), (None, "")], "doc_id long, text string")
    assert found(spark, nothing) == brute([(1, None), (None, "")])


def test_alignments_give_the_groups(spark):
    docs = edge_docs(spark, AWKWARD)
    for r in ta.alignments(docs.where("doc_id is not null").dropDuplicates(["doc_id"])).join(docs.select("doc_id", "text").distinct(), "doc_id").collect():
        expected = groups(r.text)
        assert [(list(np.array(r.a_ids)[np.array(r.a_groups) == g]), list(np.array(r.b_ids)[np.array(r.b_groups) == g])) for g in range(len(expected))] == expected
        assert len(r.a_ids) == sum(len(a) for a, _ in expected)


def test_jump_reaches_the_last_of_a_chain():
    successor = np.minimum(np.arange(1000) + 1, 999)
    assert (ta.jump(successor) == 999).all()
