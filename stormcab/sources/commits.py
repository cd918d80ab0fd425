"""Tables that change together (K3-K7): numbered commit files over folders that are never changed.

    <root>/<table>/<partition>=<value>/load=<id>/part-*.parquet     one write of one partition
    <root>/<table>/load=<id>/part-*.parquet                         one write of a table without partitions
    <root>/_commits/000000000007.json                               which folders make up each table

A write only adds folders.  A commit file is written aside and renamed to the next number, which
fails if that number is taken, so a load or a build shows to readers whole or not at all, and of two
writers that started from the same state one fails.  Partitions that a commit does not replace are
named again and not copied.  Readers take the highest number once and keep it (`Snapshot`).

Folders go only after a commit that no longer names them, and only if no one of the `KEPT` commits
before it does either, so a reader of the state before is not cut off.  What a broken run wrote is in no
commit and seen by nobody; `sweep` removes such folders when no writer is at work.
"""

from __future__ import annotations

import contextlib
import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

COMMITS, LOAD = "_commits", "load"
CODEC = "zstd"  # half the bytes of MD5 texts, which the default codec cannot shorten
ENCODING = {"compression": CODEC, "parquet.writer.version": "v2"}  # v2: numbers and texts as differences
OPEN_FILES = 12  # partitions that a task writes side by side
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
KEPT = 1  # commits before the last whose folders stay


class CommitConflict(RuntimeError):
    """Another writer has committed since this one read the state."""


@dataclass(frozen=True)
class Table:
    """A table's state: its folders by partition value ('' without partitions), and what was counted as they were written."""

    schema: str                       # JSON, with the partition column
    partition: str | None
    folders: dict[str, str]           # partition value -> folder below the root
    facts: dict[str, dict] = field(default_factory=dict)  # partition value -> metrics of the write

    def replaced(self, new: Table, values: list[str]) -> Table:
        """This table with the partitions `values` taken from `new`; one that `new` lacks is empty now."""
        def merged(old: dict, other: dict) -> dict:  # figures of several partitions together ('') hold no longer
            return {k: v for k, v in old.items() if k not in values and (k or not self.partition)} | {k: v for k, v in other.items() if k in values}
        return replace(new, folders=merged(self.folders, new.folders), facts=merged(self.facts, new.facts))


@dataclass(frozen=True)
class Snapshot:
    """The state of all tables at one commit."""

    root: str
    number: int = -1
    tables: dict[str, Table] = field(default_factory=dict)
    note: str = ""

    def has(self, name: str) -> bool:
        return name in self.tables

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        """A table; filters on its partition column leave out folders."""
        table = self.tables[name]
        schema = T.StructType.fromJson(json.loads(table.schema))
        if not table.folders:
            return spark.createDataFrame([], schema)
        with_load = T.StructType([*schema.fields, T.StructField(LOAD, T.StringType())])
        paths = [f"{self.root}/{f}" for f in table.folders.values()]
        return spark.read.schema(with_load).option("basePath", f"{self.root}/{name}").parquet(*paths).select(*schema.names)


def filesystem(spark: SparkSession, path: str):
    """Hadoop file system of a path, and the path."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def children(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern, sorted."""
    fs, p = filesystem(spark, pattern)
    return sorted(s.getPath().toString() for s in fs.globStatus(p) or ())


def read_text(spark: SparkSession, path: str) -> str:
    """A small file."""
    fs, p = filesystem(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file whole or not at all; False if it is there already."""
    jvm = spark.sparkContext._jvm
    fs, target = filesystem(spark, path)
    _, aside = filesystem(spark, f"{path}.{uuid.uuid4()}.tmp")
    if fs.exists(target):
        return False
    stream = fs.create(aside, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    none[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE  # never over an existing file
    try:
        context.rename(aside, target, none)
        return True
    except Exception:
        if not fs.exists(target):
            raise
        fs.delete(aside, False)
        return False


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, if it is there."""
    fs, p = filesystem(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


@contextlib.contextmanager
def open_files(spark: SparkSession):
    """Lets a task keep a file open for each of a few partitions, where Spark would sort its rows by partition first (and spill
    them); beyond `OPEN_FILES` it sorts the rest.  A setting that the session has already stays."""
    own = int(spark.conf.get(_WRITERS, "0") or 0)
    if own:
        yield
        return
    spark.conf.set(_WRITERS, str(OPEN_FILES))
    try:
        yield
    finally:
        spark.conf.set(_WRITERS, "0")


def _commit_file(root: str, number: int) -> str:
    return f"{root}/{COMMITS}/{number:012d}.json"


def at(spark: SparkSession, root: str, number: int) -> Snapshot:
    """The state at a commit."""
    found = json.loads(read_text(spark, _commit_file(root, number)))
    return Snapshot(root, number, {k: Table(**t) for k, t in found["tables"].items()}, found["note"])


def numbers(spark: SparkSession, root: str) -> list[int]:
    return [int(p.rsplit("/", 1)[1].removesuffix(".json")) for p in children(spark, f"{root}/{COMMITS}/*.json")]


def latest(spark: SparkSession, root: str) -> Snapshot:
    """The last committed state; an empty one before the first commit."""
    found = numbers(spark, root)
    return at(spark, root, found[-1]) if found else Snapshot(root)


def counted(df: DataFrame, observed, metrics: dict, check: Callable[[DataFrame], DataFrame] | None) -> DataFrame:
    """The rows to write, counted first and checked then: together with the rows themselves the check would be too long a method to be compiled."""
    if metrics:
        df = df.observe(observed, *[c.alias(k) for k, c in metrics.items()])
    return check(df) if check else df


def write(df: DataFrame, root: str, name: str, partition: str | None = None, metrics: dict | None = None,
          check: Callable[[DataFrame], DataFrame] | None = None) -> Table:
    """Write rows as new folders of a table, seen by nobody until a commit names them.

    `metrics` (name -> aggregate) are counted while writing; they are the facts of the partition, of all
    of them together ('') if there are several.  `check` gives the same rows, or fails when they are run."""
    from pyspark.sql import Observation
    spark, load = df.sparkSession, uuid.uuid4().hex
    schema = df.schema.json()
    observed = Observation(f"write {name} {load}") if metrics else None
    df = counted(df, observed, metrics or {}, check)
    by = [partition, LOAD] if partition else [LOAD]
    path = f"{root}/{name}"
    # dynamic mode stages each job's files apart and replaces nothing, as the load is new
    rows = df.withColumn(LOAD, F.lit(load)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").options(**ENCODING)
    with open_files(spark):
        rows.partitionBy(*by).parquet(path)
    found = children(spark, f"{path}/{partition}=*/{LOAD}={load}" if partition else f"{path}/{LOAD}={load}")
    folders = {}
    for folder in found:
        parts = folder.rsplit("/", 3 if partition else 2)[1:]
        folders[parts[1].split("=", 1)[1] if partition else ""] = "/".join(parts)
    facts = {}
    if observed:
        facts = {next(iter(folders)) if len(folders) == 1 else "": dict(observed.get)}
    return Table(schema, partition, folders, facts)


def commit(spark: SparkSession, before: Snapshot, changes: dict[str, Table], note: str = "") -> Snapshot:
    """Publish `changes` on top of `before`, all together."""
    after = Snapshot(before.root, before.number + 1, before.tables | changes, note)
    text = json.dumps({"note": note, "tables": {k: vars(t) for k, t in after.tables.items()}}, indent=1, default=str)
    if not create_text(spark, _commit_file(after.root, after.number), text):
        raise CommitConflict(f"{after.root}: commit {after.number} exists, this writer started from {before.number}")
    clean(spark, after)
    return after


def _kept(spark: SparkSession, last: Snapshot) -> set[str]:
    """Folders of the last commit and of the `KEPT` before it."""
    states = [last, *(at(spark, last.root, n) for n in range(max(0, last.number - KEPT), last.number))]
    return {f for s in states for t in s.tables.values() for f in t.folders.values()}


def clean(spark: SparkSession, last: Snapshot) -> None:
    """Remove the folders that only the commit which is no longer kept names.

    Commit files stay, so that a writer which started long ago finds its number taken."""
    gone = last.number - KEPT - 1
    if gone >= 0:
        used = _kept(spark, last)
        for table in at(spark, last.root, gone).tables.values():
            for folder in set(table.folders.values()) - used:
                remove(spark, f"{last.root}/{folder}")


def sweep(spark: SparkSession, root: str) -> list[str]:
    """Remove folders that no kept commit names (of broken runs); only when no writer is at work."""
    used = _kept(spark, latest(spark, root))
    loads = children(spark, f"{root}/*/{LOAD}=*") + children(spark, f"{root}/*/*/{LOAD}=*")
    gone = [p for p in loads if not any(p.endswith(f"/{f}") for f in used)]
    for p in gone:
        remove(spark, p)
    return gone
