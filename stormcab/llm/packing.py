"""Best-fit packing (operator 6): the tightest bin that has neither the source nor the duplicate cluster.

Documents go to bins of `CAPACITY` tokens.  A document longer than that fills
whole bins with its first pieces; its last piece is packed like a short document.  Pieces
are taken by falling size.  Bins with room are kept in order of
residual, each with a bitmap of the sources and one of the duplicate clusters in it; the search starts at the
successor of the piece's size, the smallest residual that has room, and goes on to the
next larger one until a bin has neither the piece's source nor its cluster.  If none has, a bin is opened.

Scale: documents are dealt by a hash of their id to packing groups of about `GROUP` documents, each
packed by itself and held alone; this takes about one bin in 100 more than one large group (README).  A source
or cluster with a third of all rows is spread over all groups like any other.

Defined results: a text without words has one row of no tokens and no bin; null sources
and null clusters conflict with nothing; ties go by id, then source, then cluster, so repeated rows are packed
next to each other; a null id is an id of its own; an empty table has no bin; other columns are not read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import frame, partitions, saved, sorted_groups, table, texts

CAPACITY, GROUP = 2048, 4096

RESULT = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("source", pa.string()), ("cluster", pa.string()),
                    ("bin", pa.int64()), ("place", pa.int32()), ("bin_tokens", pa.int64())])
RESULT_DDL = "doc_id long, piece int, start long, n_tokens long, source string, cluster string, bin long, place int, bin_tokens long"


class Bins:
    """Open bins in order of residual, with the bitmaps of what they hold."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.open: list[tuple[int, int]] = []  # (residual, bin)
        self.sources: list[int] = []
        self.clusters: list[int] = []
        self.fill: list[int] = []
        self.count: list[int] = []
        self.bits: tuple[dict, dict] = ({}, {})

    def bit(self, kind: int, value) -> int:
        return 0 if value is None else 1 << self.bits[kind].setdefault(value, len(self.bits[kind]))

    def add(self, size: int, source, cluster) -> tuple[int, int]:
        """Puts a piece into its bin; (bin, place in it)."""
        s, c = self.bit(0, source), self.bit(1, cluster)
        at = bisect_left(self.open, (size, -1))
        while at < len(self.open) and (self.sources[b := self.open[at][1]] & s or self.clusters[b] & c):
            at += 1
        if at < len(self.open):
            residual, b = self.open.pop(at)
        else:
            residual, b = self.capacity, len(self.fill)
            for column in (self.sources, self.clusters, self.fill, self.count):
                column.append(0)
        self.sources[b] |= s
        self.clusters[b] |= c
        self.fill[b] += size
        self.count[b] += 1
        if residual > size:
            insort(self.open, (residual - size, b))
        return b, self.count[b] - 1


def pack_group(items: list[tuple], group: int, capacity: int) -> list[tuple]:
    """Result rows of one group; items: (doc_id, n_tokens, source, cluster) in any order."""
    bins, rows = Bins(capacity), []
    parts = []
    for doc, n, source, cluster in items:
        whole, rest = divmod(n, capacity)
        parts += [(capacity, doc, k, source, cluster) for k in range(whole)]
        if rest:
            parts.append((rest, doc, whole, source, cluster))
        if not n:
            rows.append((doc, 0, 0, 0, source, cluster, None, None, None))
    parts.sort(key=lambda p: (-p[0], p[1] is None, p[1] or 0, p[2], p[3] or "", p[4] or ""))
    placed = [(p, *bins.add(p[0], p[3], p[4])) for p in parts]
    for (size, doc, k, source, cluster), b, place in placed:
        rows.append((doc, k, k * capacity, size, source, cluster, (group << 32) + b, place, bins.fill[b]))
    return rows


def pack(items: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """Bins for `items` (doc_id, n_tokens, source, cluster); one row for each piece."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        number = None
        for new, rows in sorted_groups(batches, ["group"]):
            if new:
                if held:
                    yield frame(RESULT, **dict(zip(RESULT.names, map(list, zip(*pack_group(held, number, capacity))))))
                held, number = [], rows.column("group")[0].as_py()
            held += zip(*(rows.column(c).to_pylist() for c in ("doc_id", "n_tokens", "source", "cluster")))
        if held:
            yield frame(RESULT, **dict(zip(RESULT.names, map(list, zip(*pack_group(held, number, capacity))))))

    items = saved(items.select("doc_id", "n_tokens", "source", "cluster"))
    groups = max(1, -(-items.count() // group))
    # rows with no id are told apart by the rest of the row
    dealt = items.withColumn("group", F.pmod(F.xxhash64("doc_id", "n_tokens", "cluster"), F.lit(groups)))
    return (dealt.repartition(partitions(items.sparkSession), "group").sortWithinPartitions("group")
            .select("group", "doc_id", "n_tokens", "source", "cluster").mapInArrow(run, RESULT_DDL))


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, source, cluster): words of the whole text; equal texts but for A-Z case are a cluster."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("source", pa.string()), ("cluster", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = texts(batch)
            yield frame(schema, doc_id=batch.column("doc_id").cast(pa.int64()), n_tokens=[len(t.split()) for t in raw], source=batch.column("source").cast(pa.string()),
                        cluster=[hashlib.sha256(t.lower()).hexdigest()[:32] for t in raw])

    return docs.select("doc_id", "source", "text").mapInArrow(run, "doc_id long, n_tokens long, source string, cluster string")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in bins of 2,048 words."""
    return pack(measured(table(spark, sf_dir, "documents")))
