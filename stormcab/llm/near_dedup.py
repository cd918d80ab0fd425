"""MinHash near-dedup (operator 8): a multi-index Hamming join over b-bit signatures.

Documents are sets of five-word shingles; documents with a Jaccard similarity
of 0.75 or more are linked, and every connected class is one component.

1. Equal sets are one class from the start; only classes go on.
2. A class has 64 MinHash symbols of 16 bits.  Linked classes differ in about
   a quarter of them; more than 31 differ in about one linked pair of 70,000 at
   exactly 0.75, one of 12 million at 0.8.  31 is the signature-distance threshold.
3. Pigeonhole: 64 symbols are 16 chunks of four.  Two signatures that differ
   in at most 31 symbols agree in some chunk up to one error, since two errors in
   every chunk make 32.  For each chunk the four ways to leave out one symbol
   are keys, so all pairs within the threshold share a key.
4. Inside a key's bucket, signatures are compared by two bits of each symbol
   (which never makes a distance larger); a spanning forest of the pairs within
   the threshold is kept, never all pairs.  Its components hold every pair that
   can be linked.
5. In each of these components the full sets are compared: exact intersections
   as a matrix product, block by block.  Blocks are of bounded size; a component of
   many blocks first links every block with itself and its first block, and then
   only classes outside its largest linked part meet the remaining blocks.
   Each task returns a spanning forest of confirmed links.

Scale: nothing grows with the square of a group's rows but the in-task
comparison of classes that are not linked yet.  A bucket of over `BLOCK` members is joined to its first
member unseen (step 5 decides exactly anyway), so a bucket is streamed, never
held.  The step from classes to rows broadcasts the at most 1,024 largest classes.

Defined results: null or empty texts have no shingles and are linked with nothing; a text
of fewer than five words is one shingle; repeated rows are equal documents; a null doc_id
takes part in no link, its component_id is null and it is not kept; an empty table gives no row; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Memo, as_signed, components, frame, mix64, partitions, release, row_of, saved, sorted_groups, split_join, table, texts, windows, word_hashes

SHINGLE, NUMERATOR, DENOMINATOR = 5, 75, 100
SYMBOLS, CHUNK, DISTANCE = 64, 4, 31
SEED = 20240531
BLOCK, BLOCK_SHINGLES = 256, 200_000
BUCKET = 4096
KEPT_WORDS = 400_000
STEP = 1 << 16  # shingles whose symbols are made at once
EVEN_BITS = np.uint64(0x5555555555555555)


def shingle_set(text: bytes, memo: Memo) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes of a whole text."""
    words = text.lower().split()  # on bytes: A-Z only, and white space \x20 \x09-\x0D
    if not words:
        return np.zeros(0, np.uint64)
    hashes = word_hashes(words, memo)
    if len(words) < SHINGLE:
        return windows(hashes, len(words)) ^ np.uint64(len(words))
    return np.unique(windows(hashes, SHINGLE))


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """64 MinHash symbols of 16 bits for each non-empty set."""
    rng = np.random.default_rng(SEED)
    flips = rng.integers(0, 1 << 63, SYMBOLS, np.uint64)
    factors = rng.integers(0, 1 << 63, SYMBOLS, np.uint64) * np.uint64(2) + np.uint64(1)
    out, at = np.zeros((len(sets), SYMBOLS), np.uint16), 0
    while at < len(sets):
        end, size = at, 0
        while end < len(sets) and (size == 0 or size + len(sets[end]) <= STEP):
            size += len(sets[end])
            end += 1
        values = np.concatenate(sets[at:end])
        starts = np.cumsum([0] + [len(s) for s in sets[at:end - 1]])
        for k in range(SYMBOLS):
            least = np.minimum.reduceat((values ^ flips[k]) * factors[k], starts)
            out[at:end, k] = mix64(least).astype(np.uint16)
        at = end
    return out


def sketch(docs: DataFrame) -> DataFrame:
    """(doc_id, row, n_shingles, cls, sig): one row for each document; cls identifies its shingle set."""
    schema = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("n_shingles", pa.int64()), ("cls", pa.int64()), ("sig", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Memo(xxhash.xxh3_64_intdigest, KEPT_WORDS)
        for whole in batches:
            for start in range(0, whole.num_rows, 500):
                batch = whole.slice(start, 500)
                sets = [shingle_set(t, memo) for t in texts(batch)]
                full = [s for s in sets if len(s)]
                made = iter(signatures(full)) if full else iter(())
                yield frame(schema, doc_id=batch.column("doc_id"), row=batch.column("row"), n_shingles=[len(s) for s in sets],
                            cls=[xxhash.xxh3_64_intdigest(s.tobytes()) >> 1 for s in sets], sig=[next(made).tobytes() if len(s) else None for s in sets])

    return docs.select("doc_id", row_of("text"), "text").mapInArrow(run, "doc_id long, row long, n_shingles long, cls long, sig binary")


def chunk_keys(classes: DataFrame) -> DataFrame:
    """(key, cls, low, high): for each chunk and left-out symbol a key; low and high are two bits of each symbol."""
    schema = pa.schema([("key", pa.int64()), ("cls", pa.int64()), ("low", pa.int64()), ("high", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 2000):
                batch = whole.slice(start, 2000)
                symbols = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint16).reshape(-1, SYMBOLS).astype(np.uint64)
                places = np.arange(32, dtype=np.uint64) * np.uint64(2)
                halves = [((symbols[:, h * 32:h * 32 + 32] & np.uint64(3)) << places).sum(axis=1, dtype=np.uint64) for h in (0, 1)]
                keys = np.zeros_like(symbols)
                for k in range(SYMBOLS):
                    chunk = k // CHUNK * CHUNK
                    x = np.full(len(symbols), k + 1, np.uint64)
                    for j in range(chunk, chunk + CHUNK):
                        if j != k:
                            x = x << np.uint64(16) | symbols[:, j]
                    keys[:, k] = mix64(x)  # one to one: number of the key and three symbols
                cls = np.repeat(batch.column("cls").to_numpy(), SYMBOLS)
                yield frame(schema, key=as_signed(keys.ravel()), cls=cls, low=np.repeat(as_signed(halves[0]), SYMBOLS), high=np.repeat(as_signed(halves[1]), SYMBOLS))

    return classes.select("cls", "sig").mapInArrow(run, "key long, cls long, low long, high long")


def differing(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Symbols with a bit set in `x` or `y`, the exclusive or of two rows' low and high words.

    Two bits of a symbol differ only if the symbol does, so this is at most the full distance."""
    return np.bitwise_count((x | x >> np.uint64(1)) & EVEN_BITS) + np.bitwise_count((y | y >> np.uint64(1)) & EVEN_BITS)


def loose_forest(low: np.ndarray, high: np.ndarray) -> tuple[list[int], list[int]]:
    """A spanning forest of the pairs of a bucket that are within the threshold."""
    left, a, b, frontier = np.arange(len(low)), [], [], []
    while len(left):
        if not frontier:
            frontier, left = [int(left[0])], left[1:]
        at = frontier.pop()
        near = differing(low[left] ^ low[at], high[left] ^ high[at]) <= DISTANCE
        found = left[near].tolist()
        a += [at] * len(found)
        b += found
        frontier += found
        left = left[~near]
    return a, b


def bucket_links(keyed: DataFrame) -> DataFrame:
    """(a, b): spanning forests of every bucket's pairs within the signature distance."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    names = ["key", "cls", "low", "high"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None  # rows of the bucket that may go on in the next batch
        big = None  # (key, first class) of a bucket beyond BUCKET rows

        def linked(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            key, cls, low, high = rows
            low, high = low.view(np.uint64), high.view(np.uint64)
            cuts = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]])
            sizes = np.diff(cuts)
            a, b = [], []
            pairs = cuts[:-1][sizes == 2]  # the most common case, all at once
            if len(pairs):
                near = differing(low[pairs] ^ low[pairs + 1], high[pairs] ^ high[pairs + 1]) <= DISTANCE
                a.append(cls[pairs[near]])
                b.append(cls[pairs[near] + 1])
            for k in np.flatnonzero(sizes > 2):
                s, e = cuts[k], cuts[k + 1]
                i, j = loose_forest(low[s:e], high[s:e])
                a.append(cls[s:e][i])
                b.append(cls[s:e][j])
            if a:
                yield frame(schema, a=np.concatenate(a), b=np.concatenate(b))

        for batch in batches:
            rows = [batch.column(n).to_numpy() for n in names]
            if not batch.num_rows:
                continue
            if big is not None:
                more = rows[0] == big[0]
                if more.any():
                    yield frame(schema, a=np.full(int(more.sum()), big[1]), b=rows[1][more])
                    rows = [r[~more] for r in rows]
                if not len(rows[0]):
                    continue
                big = None
            if held is not None:
                rows = [np.concatenate([h, r]) for h, r in zip(held, rows)]
            cut = int(np.searchsorted(rows[0], rows[0][-1], "left"))  # sorted by key
            yield from linked([r[:cut] for r in rows]) if cut else ()
            held = [r[cut:] for r in rows]
            if len(held[0]) > BUCKET:
                big = (held[0][0], held[1][0])
                yield frame(schema, a=np.full(len(held[1]) - 1, big[1]), b=held[1][1:])
                held = None
        if held is not None:
            yield from linked(held)

    ordered = keyed.repartition(partitions(keyed.sparkSession), "key").sortWithinPartitions("key", "cls")
    return ordered.mapInArrow(run, "a long, b long")


def confirmed_forest(sets: list[np.ndarray]) -> tuple[list[int], list[int]]:
    """A spanning forest of the pairs of sets with at least the wanted similarity, by exact intersections."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    if n < 2:
        return [], []
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(n), sizes)
    _, index, counts = np.unique(values, return_inverse=True, return_counts=True)
    common = counts[index] > 1
    if not common.any():
        return [], []
    _, index = np.unique(index[common], return_inverse=True)
    owner = owner[common]
    order = np.argsort(index, kind="stable")
    index, owner = index[order], owner[order]
    shared = np.zeros((n, n), np.float32)
    width = max(256, min(8192, (1 << 22) // n))
    for start in range(0, int(index[-1]) + 1, width):
        s, e = np.searchsorted(index, [start, start + width])
        part = np.zeros((n, min(width, int(index[-1]) + 1 - start)), np.float32)
        part[owner[s:e], index[s:e] - start] = 1
        shared += part @ part.T
    shared = shared.astype(np.int64)
    linked = DENOMINATOR * shared >= NUMERATOR * (sizes[:, None] + sizes[None, :] - shared)
    a, b, left, frontier = [], [], np.ones(n, bool), []
    for seed in range(n):
        if not left[seed]:
            continue
        left[seed] = False
        frontier = [seed]
        while frontier:
            at = frontier.pop()
            found = np.flatnonzero(linked[at] & left).tolist()
            left[found] = False
            a += [at] * len(found)
            b += found
            frontier += found
    return a, b


def block_links(rows: DataFrame) -> DataFrame:
    """(a, b): confirmed links inside each task; rows: task columns t1, t2, t3, then cls and set."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def linked() -> Iterator[pa.RecordBatch]:
            a, b = confirmed_forest(sets)
            if a:
                yield frame(schema, a=[cls[i] for i in a], b=[cls[i] for i in b])

        cls: list[int] = []
        sets: list[np.ndarray] = []
        for new, part in sorted_groups(batches, ["t1", "t2", "t3"]):
            if new:
                yield from linked()
                cls, sets = [], []
            cls += part.column("cls").to_pylist()
            sets += [np.frombuffer(x, np.uint64) for x in part.column("shingles").to_pylist()]
        yield from linked()

    ordered = rows.repartition(partitions(rows.sparkSession), "t1", "t2", "t3").sortWithinPartitions("t1", "t2", "t3")
    return ordered.select("t1", "t2", "t3", "cls", "shingles").mapInArrow(run, "a long, b long")


def full_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """`wanted` (rep, cls, ...) with the full shingle set of document rep."""
    schema = pa.schema([("cls", pa.int64()), ("t1", pa.int64()), ("block", pa.int64()), ("blocks", pa.int64()), ("shingles", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Memo(xxhash.xxh3_64_intdigest, KEPT_WORDS)
        for whole in batches:
            for start in range(0, whole.num_rows, 500):
                batch = whole.slice(start, 500)
                sets = [shingle_set(t, memo).tobytes() for t in texts(batch)]
                same = [xxhash.xxh3_64_intdigest(s) >> 1 == c for s, c in zip(sets, batch.column("cls").to_pylist())]  # an id may have several texts
                out = frame(schema, cls=batch.column("cls"), t1=batch.column("t1"), block=batch.column("block"), blocks=batch.column("blocks"), shingles=sets)
                yield out.filter(pa.array(same))

    joined = docs.select(F.col("doc_id").alias("rep"), "text").join(wanted.select("rep", "cls", "t1", "block", "blocks"), "rep")
    found = joined.mapInArrow(run, "cls long, t1 long, block long, blocks long, shingles binary")
    return saved(found)


def linked_classes(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """(node, component) over the classes that are linked with others."""
    loose = components(bucket_links(chunk_keys(classes)))
    release(docs.sparkSession)
    members = classes.drop("sig").join(loose.select(F.col("node").alias("cls"), F.col("component").alias("t1")), "cls")
    members = saved(members)
    sizes = saved(members.groupBy("t1").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("all_shingles"))
                  .select("t1", "n", F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("all_shingles") / BLOCK_SHINGLES)).alias("blocks")))
    wanted = split_join(members, sizes, "t1", "n").withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")))
    sets = full_sets(docs, wanted)
    # each block with itself and its component's first block
    to_first = sets.where("block = 0 and blocks > 1").withColumn("t2", F.explode(F.sequence(F.lit(1), F.col("blocks") - 1)))
    first = block_links(sets.withColumn("t2", F.col("block")).unionByName(to_first).withColumn("t3", F.lit(0).cast("long")))
    links = saved(first)
    release(docs.sparkSession)
    many = sizes.where("blocks > 1").select("t1")
    parts = components(links)
    open_ = (sets.where("blocks > 1").select("t1", "cls", "block", "blocks")
             .join(parts, F.col("cls") == F.col("node"), "left").select("t1", "cls", "block", "blocks", F.coalesce("component", "cls").alias("part")))
    open_ = saved(open_)
    largest = open_.groupBy("t1", "part").agg(F.count(F.lit(1)).alias("n")).groupBy("t1").agg(F.max_by("part", F.struct("n", "part")).alias("part"))
    outside = saved(open_.join(largest, ["t1", "part"], "left_anti"))
    if many.isEmpty() or outside.isEmpty():
        return parts
    rounds = saved(outside.groupBy("t1").agg(F.count(F.lit(1)).alias("n_outside")).join(sizes, "t1").select(
        "t1", "n", F.greatest(F.ceil(F.col("n_outside") / BLOCK), F.lit(1)).alias("asking")))
    # a component may hold most of these rows
    blocks = split_join(sets.where("blocks > 1"), rounds, "t1", "n")
    asking = (blocks.join(outside.select("cls"), "cls", "left_semi")
              .withColumn("t3", F.pmod(F.xxhash64("cls", F.lit(1)), F.col("asking"))).withColumn("t2", F.explode(F.sequence(F.lit(1), F.col("blocks") - 1)))
              .where("t2 <> block"))
    told = (blocks.where("block > 0").withColumn("t2", F.col("block"))
            .withColumn("t3", F.explode(F.sequence(F.lit(0).cast("long"), F.col("asking") - 1))))
    columns = ["t1", "t2", "t3", "cls", "shingles"]
    second = block_links(asking.select(*columns).unionByName(told.select(*columns)))
    return components(links.unionByName(second))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, row, n_shingles, component_id, kept) for every row of `docs`."""
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = saved(sketch(named))
    full = rows.where("n_shingles > 0 and doc_id is not null")
    classes = saved(full.groupBy("cls").agg(F.min(F.struct("doc_id", "sig", "n_shingles")).alias("first"), F.count(F.lit(1)).alias("rows"))
                    .select("cls", F.col("first.doc_id").alias("rep"), F.col("first.sig").alias("sig"), F.col("first.n_shingles").alias("n_shingles"), "rows"))
    linked = linked_classes(named, classes)
    parts = classes.select("cls", "rep", "rows").join(linked, F.col("cls") == F.col("node"), "left").select("cls", "rep", "rows", F.coalesce("component", "cls").alias("part"))
    parts = saved(parts)
    least = parts.groupBy("part").agg(F.min("rep").alias("component_id"), F.count(F.lit(1)).alias("n"))
    named_parts = saved(split_join(parts, saved(least), "part", "n").select("cls", "rows", "component_id"))
    found = split_join(full.drop("sig"), named_parts, "cls", "rows").select("doc_id", "row", "n_shingles", "component_id")
    alone = rows.where("n_shingles = 0 or doc_id is null").select("doc_id", "row", "n_shingles", F.col("doc_id").alias("component_id"))
    return found.unionByName(alone).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document."""
    return near_dedup(table(spark, sf_dir, "documents")).drop("row")
