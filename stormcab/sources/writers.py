"""Sinks (K1-K8): month replacement, full refresh, CSV export, landing files.

Tables are written as folders of their own and published by a commit file (`commits`): other months
survive, a failed write changes nothing that readers see, and a task that is retried after an executor
loss writes the same files again.  A month that arrives empty has no folder any more, matching "delete the month, then
load" of the original loader.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import commits, landed


def only_month(df: DataFrame, partition_column: str, month: str) -> DataFrame:
    """`df`, failing when it is run if a row belongs to another month."""
    first = F.lit(f"{month}-01").cast("date")
    text = F.coalesce(F.col(partition_column).cast("string"), F.lit("no month"))
    wrong = F.raise_error(F.concat(F.lit(f"a row of {partition_column} "), text, F.lit(f" in the load of {month}"))).cast("boolean")
    # a filter, which stays in the plan when the column itself is not needed any more
    return df.filter(F.when(F.col(partition_column) == first, True).otherwise(wrong))


def month_written(before: commits.Snapshot, df: DataFrame, name: str, partition_column: str, month: str,
                  metrics: dict[str, Column] | None = None) -> commits.Table:
    """K4/K5: a table's state with one month replaced, written and not yet committed.

    A row of another month fails the load.  A month without rows is removed."""
    new = commits.write(df, before.root, name, partition_column, metrics, lambda rows: only_month(rows, partition_column, month))
    value = f"{month}-01"
    if not new.folders and metrics:
        new.facts.clear()
    return before.tables[name].replaced(new, [value]) if before.has(name) else new


def replace_month(df: DataFrame, root: str, name: str, partition_column: str, month: str) -> commits.Snapshot:
    """K4/K5: replace one month of one table (DELETE month + INSERT, idempotent) and commit."""
    before = commits.latest(df.sparkSession, root)
    written = month_written(before, df, name, partition_column, month)
    return commits.commit(df.sparkSession, before, {name: written}, f"{name} {month}")


def export_csv(df: DataFrame, path: str) -> None:
    """K8: CSV export with a header row (one file per task)."""
    df.write.mode("overwrite").option("header", True).csv(path)


# --- landing (used by tests and the benchmark to stage landed files) ---------------

def land_trip_month(landed_trips: DataFrame, root: str, month: str, dataset: str = "yellow") -> None:
    """Write a month of trips as the landed Parquet directory of that month."""
    landed_trips.write.mode("overwrite").option("compression", commits.CODEC).parquet(landed.trip_month_dir(root, month, dataset))


def land_trip_months(landed_trips: DataFrame, root: str, month_column: str, months: tuple[str, ...], dataset: str = "yellow") -> None:
    """Write trips of several months, each to the landed directory of its own, in one pass; a month without trips gets empty files."""
    spark, text = landed_trips.sparkSession, F.col(month_column)
    rows = landed_trips.where(text.isin(*months)).withColumns({"year": F.substring(text, 1, 4), "month": F.substring(text, 6, 2)}).drop(month_column)
    with commits.open_files(spark):
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", commits.CODEC)
             .partitionBy("year", "month").parquet(landed.trip_root(root, dataset)))
    for month in months:
        if not commits.children(spark, landed.trip_month_dir(root, month, dataset)):
            land_trip_month(landed_trips.limit(0).drop(month_column), root, month, dataset)


def land_weather_documents(docs: DataFrame, root: str, month: str, multi_line: bool = False) -> None:
    """Write weather documents under the month directory: JSON lines (read
    them back with `multi_line=False`), or one indented document per file."""
    docs, path = docs.drop("source_file"), landed.weather_month_dir(root, month)
    if multi_line:
        text = docs.select(F.to_json(F.struct(*docs.columns), {"pretty": "true"}).alias("value"))
        text.write.mode("overwrite").option("maxRecordsPerFile", 1).text(path)
    else:
        docs.write.mode("overwrite").json(path)


def land_zone_lookup(zones: DataFrame, root: str) -> None:
    """Write the zone lookup as one CSV file with a header."""
    zones.coalesce(1).write.mode("overwrite").option("header", True).csv(landed.zone_file(root))
