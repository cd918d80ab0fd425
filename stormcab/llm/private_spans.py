"""Personal data (operator 12): fixed rules, and a semi-Markov conditional random field beside them.

The rules give the base spans (`base_spans`).  They miss data written another way: `name at host dot com`,
a telephone number without its plus, a card number next to another number.  For those, the places of a text that
could hold an entity become small lattices (`Lattice`): a segment is a whole candidate entity of a type, of at
most `LONGEST` parts, scored by features of the whole span (its number of digits, the lengths of its groups,
its separators, what stands on either side, ...); everything outside has score 0.  Viterbi over
segments chooses boundaries and types together.  A candidate must also hold what the type demands
(digits, check digit, ranges), and may not overlap a base span; the best segmentation's entities are added.

The field is fitted here, by the gradient of its log-likelihood (forward and backward sums over segments), on places
of a bounded sample of documents: base spans are the labels, each also rewritten in the ways of
`rewritten`, next to places without any.  The bound: places from about `SAMPLE_DOCUMENTS` documents drawn by a
hash, of which `PER_KIND` for each type and for none, of at most `PLACE` characters, go to the driver.  Detection is one map over whole texts.

Defined results: a null or empty text has no spans; repeated rows are treated alike; offsets count code points;
with no base span in the sample there is no model, and nothing is added; of equally good segmentations
the one with fewer entities is taken; an empty table gives no row.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import saved, table

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
SAMPLE_DOCUMENTS, PER_KIND, PLACE = 20_000, 150, 200
LONGEST = 6             # parts (labels or digit groups) of one entity
STEPS, RATE, RIDGE = 40, 0.5, 1e-3

SPAN = "struct<kind: string, start: int, end: int, base: boolean, text: string>"
FOUND = f"doc_id bigint, spans array<{SPAN}>"
SAMPLED = "kind int, place string, start int, end int"
DIGEST = "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string"

# --- base rules -----------------------------------------------------------------------
# The same matches as the plain patterns' leftmost non-overlapping ones, found in linear time: an
# address from its @, a dotted number from the start of its digits.
ADDRESS_HOST = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
ADDRESS_NAME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOTTED = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
NUMBER = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
DIALLED = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile("[0-9]")


def check_digit_right(digits: str) -> bool:
    """The Luhn sum."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def small_parts(parts: list[str]) -> bool:
    """Four numbers of at most 255?"""
    return len(parts) == 4 and all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in parts)


def card_digits(digits: str) -> bool:
    return 13 <= len(digits) <= 19 and check_digit_right(digits)


def digits_of(text: str) -> str:
    return "".join(DIGIT.findall(text))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by the rules, by kind and start."""
    out, last = [], 0
    if "@" in text:
        for m in ADDRESS_HOST.finditer(text):
            start = m.start()
            while start > last and text[start - 1] in ADDRESS_NAME:
                start -= 1
            if start < m.start():
                out.append((EMAIL, start, m.end()))
                last = m.end()
    if DIGIT.search(text):
        out += [(IP, *m.span()) for m in DOTTED.finditer(text) if small_parts(m.group().split("."))]
        for m in NUMBER.finditer(text):
            if m.end() - m.start() >= 13 and card_digits(digits_of(m.group())):
                out.append((CARD, *m.span()))
        if "+" in text:
            out += [(PHONE, *m.span()) for m in DIALLED.finditer(text) if 9 <= len(digits_of(m.group())) <= 15]
    return out


# --- places and candidate segments ---------------------------------------------------
FIGURES = re.compile(r"[+(]?[0-9](?:[0-9+().\-/\x20\[\]]*[0-9])?")
GROUP = re.compile(r"[0-9]+")
AT = re.compile(r"\x20?(?:@|\[at\]|\(at\)|(?<=\x20)at(?=\x20))\x20?")
LABEL = r"[A-Za-z0-9](?:[A-Za-z0-9-]{0,62})"
HOST = re.compile(rf"{LABEL}(?:(?:\.|\x20?\[\.\]\x20?|\x20?[\[(]dot[\])]\x20?|\x20dot\x20){LABEL}){{1,{LONGEST - 1}}}+")
HOST_PART = re.compile(rf"(\.|\x20?\[\.\]\x20?|\x20?[\[(]dot[\])]\x20?|\x20dot\x20)?({LABEL})")
NAME = re.compile(r"(?:[A-Za-z0-9._%+-]+(?:\x20dot\x20|\[\.\]))*[A-Za-z0-9._%+-]+$")
NAME_DOT = re.compile(r"\x20dot\x20|\[\.\]")
FORMS = {IP: re.compile(r"[0-9]+(?:(?:\.|\[\.\]|\x20\.\x20|\(\.\))[0-9]+){3}"),
         CARD: re.compile(r"[0-9]+(?:[\x20./-]{1,3}[0-9]+)*"),
         PHONE: re.compile(r"\+?\(?[0-9]+(?:[\x20().\-/]{1,2}[0-9]+)*")}

Segment = tuple[int, int, int]  # kind, start, end


def allowed(kind: int, said: str) -> bool:
    """Does a span's text hold what its type demands?"""
    if kind == EMAIL:
        return True  # held by construction
    if not FORMS[kind].fullmatch(said):
        return False
    groups = GROUP.findall(said)
    n = sum(map(len, groups))
    if kind == IP:
        return small_parts(groups)
    if kind == CARD:
        return card_digits("".join(groups))
    return 9 <= n <= 15 and (len(groups) > 1 or said[0] == "+") and said.count("(") == said.count(")")


def figure_segments(text: str, start: int, end: int) -> list[Segment]:
    """Candidates of a run of digits and separators: every run of up to `LONGEST` of its groups that a type allows."""
    groups = [(m.start(), m.end()) for m in GROUP.finditer(text, start, end)]
    out = []
    for i, (a, _) in enumerate(groups):
        n = 0
        for j in range(i, min(i + LONGEST, len(groups))):
            n += groups[j][1] - groups[j][0]
            if n > 19:
                break
            if n < 4:
                continue
            b = groups[j][1]
            if j == i + 3:
                out += [(IP, a, b)] if allowed(IP, text[a:b]) else []
            if n >= 13 and allowed(CARD, text[a:b]):
                out.append((CARD, a, b))
            if 9 <= n <= 15:
                head = a
                while head > 0 and a - head < 2 and text[head - 1] in "+(":
                    head -= 1
                out += [(PHONE, h, b) for h in range(head, a + 1) if allowed(PHONE, text[h:b])]
    return out


def address_segments(text: str, m: re.Match) -> list[Segment]:
    """Candidates around something that may stand for @: names of one or more parts, hosts of two or more labels."""
    host = HOST.match(text, m.end())
    name = NAME.search(text, max(0, m.start() - 64), m.start())
    if not host or not name:
        return []
    ends = [x.end() for x in HOST_PART.finditer(text, host.start(), host.end())
            if x.group(1) and x.group(2).isalpha() and len(x.group(2)) > 1 and x.group(2)[1:].islower() == x.group(2)[0].islower()]
    starts = [name.start()] + [name.start() + x.end() for x in NAME_DOT.finditer(name.group())]
    return [(EMAIL, a, b) for a in starts for b in ends]


def places(text: str) -> Iterator[tuple[int, int, list[Segment]]]:
    """(start, end, candidates) of each place that could hold an entity, left to right by kind of place."""
    if DIGIT.search(text):
        for m in FIGURES.finditer(text):
            if m.end() - m.start() >= 7:
                found = figure_segments(text, *m.span())
                if found:
                    yield min(s for _, s, _ in found), max(e for _, _, e in found), found
    for m in AT.finditer(text):
        found = address_segments(text, m)
        if found:
            yield min(s for _, s, _ in found), max(e for _, _, e in found), found


def side(text: str, at: int, step: int) -> str:
    """What stands beside a span: the class of the next character, and of the one behind a separator."""
    def kind(i: int) -> str:
        if not 0 <= i < len(text):
            return "edge"
        c = text[i]
        return "9" if c.isdigit() else "a" if c.isalpha() else "_" if c.isspace() else c
    first = kind(at)
    return f"{first}{kind(at + step)}" if first in "_.-/()" else first


def features(text: str, segment: Segment) -> list[str]:
    """Features of a whole span, each with its type."""
    kind, a, b = segment
    said = text[a:b]
    before = re.search(r"([^\W\d_]+)\W{0,3}$", text[max(0, a - 24):a])
    out = ["is", f"left {side(text, a - 1, -1)}", f"right {side(text, b, 1)}", f"word {before.group(1).lower() if before else ''}"]
    if kind == EMAIL:
        at = AT.search(said)
        host = said[at.end():]
        out += [f"at {at.group()}", f"dot {'' .join(sorted(set(re.findall(r'[^A-Za-z0-9-]|(?<=\x20)dot', host))))}", f"last {re.split(r'[^A-Za-z]', host)[-1].lower()}",
                f"labels {len(HOST_PART.findall(host))}", f"name {len(re.findall(r'[A-Za-z0-9]+', said[:at.start()]))}"]
    else:
        groups = GROUP.findall(said)
        marks = "".join(sorted(set(said) - set("0123456789")))
        out += [f"digits {sum(map(len, groups))}", f"groups {len(groups)}", f"lengths {'-'.join(str(len(g)) for g in groups)}", f"marks {marks}", f"first {said[0] if said[0] in '+(' else '9'}"]
    return [f"{KINDS[kind]} {f}" for f in out]


# --- the field ----------------------------------------------------------------------
@dataclass
class Lattice:
    """The candidates of a place in order of their ends, as arcs between numbered positions."""

    segments: list[Segment]
    arcs: list[tuple[int, int]] = field(default_factory=list)
    size: int = 1

    def __post_init__(self):
        self.segments = sorted(set(self.segments), key=lambda s: (s[2], s[1], s[0]))
        number = {p: i for i, p in enumerate(sorted({x for s in self.segments for x in s[1:]}))}
        self.arcs = [(number[a], number[b]) for _, a, b in self.segments]
        self.size = max(1, len(number))

    def best(self, scores: list[float]) -> list[int]:
        """Viterbi: numbers of the chosen arcs, for the highest sum (of equals, fewer arcs)."""
        value, back = [(0.0, 0)] * self.size, [None] * self.size
        k = 0
        for p in range(1, self.size):
            value[p] = value[p - 1]
            while k < len(self.arcs) and self.arcs[k][1] == p:
                a = self.arcs[k][0]
                reached = (value[a][0] + scores[k], value[a][1] - 1)
                if reached > value[p]:
                    value[p], back[p] = reached, k
                k += 1
        out, p = [], self.size - 1
        while p > 0:
            if back[p] is None:
                p -= 1
            else:
                out.append(back[p])
                p = self.arcs[back[p]][0]
        return out[::-1]

    def expected(self, scores: np.ndarray) -> tuple[float, np.ndarray]:
        """Log of the sum over all segmentations, and each arc's probability."""
        ahead, behind = np.zeros(self.size), np.zeros(self.size)
        k = 0
        for p in range(1, self.size):
            ahead[p] = ahead[p - 1]
            while k < len(self.arcs) and self.arcs[k][1] == p:
                ahead[p] = np.logaddexp(ahead[p], ahead[self.arcs[k][0]] + scores[k])
                k += 1
        starts = [[] for _ in range(self.size)]
        for k, (a, _) in enumerate(self.arcs):
            starts[a].append(k)
        for p in range(self.size - 2, -1, -1):
            behind[p] = behind[p + 1]
            for k in starts[p]:
                behind[p] = np.logaddexp(behind[p], behind[self.arcs[k][1]] + scores[k])
        a, b = np.array(self.arcs).T
        return ahead[-1], np.exp(ahead[a] + scores + behind[b] - ahead[-1])


Weights = dict[str, float]


def fit(examples: list[tuple[str, list[Segment], list[Segment]]]) -> Weights:
    """Weights of the features by the log-likelihood of (text, candidates, true segments), with adaptive steps."""
    lattices, index, rows, ends, truth = [], {}, [], [], []
    for text, candidates, right in examples:
        lattice = Lattice(candidates)
        lattices.append((len(truth), lattice))
        for s in lattice.segments:
            rows += [index.setdefault(f, len(index)) for f in features(text, s)]
            ends.append(len(rows))
            truth.append(s in right)
    if not truth or not any(truth):
        return {}
    rows, starts, truth = np.array(rows), np.array([0, *ends[:-1]]), np.array(truth, float)
    owner = np.repeat(np.arange(len(ends)), np.diff([0, *ends]))
    weights, past = np.zeros(len(index)), np.full(len(index), 1e-8)
    for _ in range(STEPS):
        scores = np.add.reduceat(weights[rows], starts)
        expected = np.zeros(len(truth))
        for first, lattice in lattices:
            part = slice(first, first + len(lattice.arcs))
            expected[part] = lattice.expected(scores[part])[1]
        slope = np.bincount(rows, (truth - expected)[owner], minlength=len(index)) / len(lattices) - RIDGE * weights
        past += slope * slope
        weights += RATE * slope / np.sqrt(past)
    return dict(zip(index, weights.tolist()))


def log_likelihood(weights: Weights, text: str, candidates: list[Segment], right: list[Segment]) -> float:
    """Of the segmentation `right` among all of the place."""
    lattice = Lattice(candidates)
    scores = np.array([sum(weights.get(f, 0.0) for f in features(text, s)) for s in lattice.segments])
    return float(sum(x for x, s in zip(scores, lattice.segments) if s in right) - lattice.expected(scores)[0])


def added_spans(text: str, base: list[Segment], weights: Weights) -> list[Segment]:
    """Entities of the best segmentation of each place; nothing that overlaps a base span."""
    out = []
    if not weights:
        return out
    taken = sorted((s, e) for _, s, e in base)
    for a, b, candidates in places(text):
        near = [(s, e) for s, e in taken if s < b and e > a] if taken else ()
        if near:
            candidates = [c for c in candidates if not any(s < c[2] and e > c[1] for s, e in near)]
            if not candidates:
                continue
        lattice = Lattice(candidates)
        scores = [sum(weights.get(f, 0.0) for f in features(text, s)) for s in lattice.segments]
        for k in lattice.best(scores):
            if all(s >= lattice.segments[k][2] or e <= lattice.segments[k][1] for _, s, e in out[-LONGEST:]):
                out.append(lattice.segments[k])
    return out


def rewritten(kind: int, said: str) -> list[str]:
    """An entity in other ways people write it."""
    digits = digits_of(said)
    if kind == EMAIL:
        name, host = said.split("@")
        return [f"{name} at {host}", f"{name} [at] {host.replace('.', ' [dot] ')}", f"{name} at {host.replace('.', ' dot ')}", f"{name}(at){host}", f"{name} @ {host}"]
    if kind == IP:
        return [said.replace(".", "[.]"), said.replace(".", " . "), said.replace(".", "(.)")]
    if kind == CARD:
        fours = [digits[i:i + 4] for i in range(0, len(digits), 4)]
        return [".".join(fours), "/".join(fours), " - ".join(fours)]
    groups = GROUP.findall(said)
    inland = groups[1:] if sum(map(len, groups[1:])) > 8 else groups
    return [said[1:], *(mark.join(g) for mark in " -." for g in (groups, inland)), said[said.find("("):] if "(" in said else said]


def foils(number: int) -> list[str]:
    """Runs of numbers that are no entity: days, times, years, columns of a table."""
    year, month, day, hour = 1900 + number % 200, number % 12 + 1, number % 28 + 1, number % 24
    return [f"{year}-{month:02d}-{day:02d} {hour:02d}", f"{day:02d}.{month:02d}.{year} {hour:02d}", f"{year}{month:02d}{day:02d} {hour:02d}{day:02d}",
            f"{month:02d}/{day:02d}/{year} {hour:02d}", f"{year} {year + 1} {year + 2}", f"{year}-{year + 1} {day}", " ".join(str(number * k % 90 + 10) for k in range(2, 8)),
            " ".join(str(number * k % 900 + 100) for k in range(2, 6)), f"{number * 7919 % 10 ** 6} {number * 104729 % 10 ** 6}"]


def examples_of(rows: list[tuple[int, str, int, int]]) -> list[tuple[str, list[Segment], list[Segment]]]:
    """Training examples of sampled places (kind, text, start, end); kind -1: nothing there."""
    out = []

    def example(text: str, right: list[Segment]) -> None:
        candidates = [c for _, _, found in places(text) for c in found]
        if candidates and all(r in candidates for r in right):
            out.append((text, candidates, right))

    for kind, text, a, b in rows:
        if kind < 0:
            example(text, [])
            continue
        example(text, [(kind, a, b)])
        for i, said in enumerate(rewritten(kind, text[a:b])):
            example(text[:a] + said + text[b:], [(kind, a, a + len(said))])
        if kind in (CARD, PHONE):  # next to a number that the plain rule takes in
            number = str(b * 37 % 900 + 100)
            if kind == CARD:
                example(f"{text[:a]}{number} {text[a:]}", [(kind, a + 4, b + 4)])
            example(f"{text[:b]} {number}{text[b:]}", [(kind, a, b)])
            for said in foils(a * 31 + len(text) * 17 + b):
                example(f"{text[:a]}{said}{text[b:]}", [])
    return out


def sampled_places(docs: DataFrame) -> list[tuple[int, str, int, int]]:
    """Places of a sample of documents: per type and for none at most `PER_KIND`, of at most `PLACE` characters each."""
    total = docs.count()
    rate = min(1.0, SAMPLE_DOCUMENTS / max(1, total))
    drawn = docs.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) < F.lit(int(rate * (1 << 30)))).select("text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                base = base_spans(text or "")
                held = [(k, a, b) for k, a, b in base if b - a <= PLACE // 2]
                empty = [(-1, a, b) for a, b, _ in places(text or "") if b - a <= PLACE // 2 and not any(s < b and e > a for _, s, e in base)]
                for k, a, b in held + empty:
                    first = max(0, a - PLACE // 4)
                    around = text[first:b + PLACE // 4]
                    if k < 0 or len({x for x in base if x[1] < b + PLACE // 4 and x[2] > first}) == 1:
                        rows.append((k, around, a - first, b - first))
            columns = list(zip(*rows)) if rows else [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.string(), pa.int32(), pa.int32()))], names=["kind", "place", "start", "end"])

    found = saved(drawn.mapInArrow(work, SAMPLED).distinct())
    out = []
    for kind in range(-1, len(KINDS)):
        rows = found.where(F.col("kind") == kind).orderBy(F.xxhash64("place"), "place", "start", "end").limit(PER_KIND)
        out += [tuple(r) for r in rows.collect()]  # a bounded sample
    return out


def train(docs: DataFrame) -> Weights:
    """The field fitted on a bounded sample of the documents."""
    return fit(examples_of(sampled_places(docs)))


def find_spans(docs: DataFrame, weights: Weights) -> DataFrame:
    """(doc_id, spans): every span with its kind, code-point offsets, text, and whether a rule gave it."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column("text"):
                text = text.as_py() or ""
                base = base_spans(text)
                spans = [(*s, True) for s in base] + [(*s, False) for s in added_spans(text, base, weights)]
                out.append([{"kind": KINDS[k], "start": a, "end": b, "base": rule, "text": text[a:b]} for k, a, b, rule in sorted(spans)])
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()), ("text", pa.string())]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, kind)], names=["doc_id", "spans"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(work, FOUND)


def op12_private_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's base spans by kind, their digest, and all spans."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_spans(docs, train(docs))
    named = F.transform("spans", lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string")))
    ruled = F.transform(F.filter("spans", lambda s: s.base), lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string")))

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s.base & (s.kind == kind))).cast("bigint").alias(f"n_{kind}")

    return found.select("doc_id", *map(number, KINDS), F.sha2(F.concat_ws(",", ruled), 256).alias("base_sha256"), F.concat_ws(",", named).alias("spans"))
