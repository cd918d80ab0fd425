"""The corpus pipeline: documents in, packed training bins out.

Five stages; each reads what the one before it wrote to the shared folder and
decides about all of it:

1. language ID: documents without a letter in any language it knows go (as do rows without a doc_id, which nothing after could name);
2. exact dedup: of equal texts the row with the largest doc_id stays;
3. MinHash near-dedup: of each group of near copies the smallest doc_id stays;
4. mixing: documents are sampled to the raked source, language and topic weights;
5. best-fit packing: what is left goes to bins of 2,048 words.

All but the last return the columns of `documents`.  A run that lost its driver goes on behind the last stage it
wrote if it is given that run's folder; the folder of a run without one goes when the application ends.
An empty table gives no bin.
"""

from __future__ import annotations

import atexit
import contextlib
import uuid

from pyspark.sql import DataFrame, SparkSession

from stormcab.llm import exact_dedup, language_id, mixing, near_dedup, packing
from stormcab.llm.common import kept_rows, shared_folder

# SQL has no language model, MinHash or best fit; the stages are tested against brute force instead.
ORACLE_SQL = None


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known."""
    model = language_id.train(language_id.training_rows(docs))
    found = language_id.identify(docs, model)
    return found.where((found.lang_pred != language_id.UNKNOWN) & found.doc_id.isNotNull()).select(*docs.columns)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return kept_rows(docs, exact_dedup.exact_dedup(docs, exact_dedup.earlier_half()).where("kept"))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return kept_rows(docs, near_dedup.near_dedup(docs).where("kept"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample at the target weights."""
    return kept_rows(docs, mixing.mix(docs).where("sampled"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The bins."""
    return packing.pack(packing.measured(docs))


STAGES = [
    ("language_id", language_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]


def written(spark: SparkSession, path: str) -> bool:
    """Has a stage been written whole to `path`?"""
    mark = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(mark)


def folder_for_now(spark: SparkSession) -> str:
    """A folder of its own that goes when the application ends."""
    path = f"{shared_folder(spark)}/pipeline-{uuid.uuid4()}"
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def remove() -> None:
        with contextlib.suppress(Exception):  # the JVM may be gone before
            fs.delete(place, True)

    atexit.register(remove)
    return path


def run(spark: SparkSession, sf_dir: str, folder: str | None = None) -> DataFrame:
    """The rows of the last stage over all documents; stages that are whole in `folder` are not run again."""
    folder = folder or folder_for_now(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        if not written(spark, path):
            stage(spark, docs, sf_dir).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
    return docs
