"""K4: is a trip's key in another loaded month?  A Bloom filter beside each month.

The key is global and a load brings one month, so a plain check would read the keys of all other
months.  Beside each month a filter is written instead (`key_filter`): for each pickup day `BUCKETS` words of
64 bits, of which only those in use are rows; a key sets four bits of one word.  A trip with the same key
has the same pickup time, so a key is looked up on its own pickup day only: months that hold no
trips of that day, or a few late ones, hardly ever give a false answer.  Only the months in which some
word holds all four bits of a key are then read, and those keys alone are compared.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TABLE = "raw_trip_key_filters"
BUCKETS = 1 << 16  # words a day: 4 million bits
BITS = 4
NO_DAY = "0001-01-01"  # of trips without a pickup time


def _day() -> Column:
    return F.coalesce(F.col("pickup_date"), F.lit(NO_DAY).cast("date"))


def _addressed(trips: DataFrame) -> DataFrame:
    """Day, word and bits of each key."""
    key = F.col("record_hash")
    spread = F.xxhash64(key, F.lit("bits"))
    bits = [F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(F.shiftright(spread, 6 * i), F.lit(64)).cast("int")) for i in range(BITS)]
    word, mask = F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int"), reduce(Column.bitwiseOR, bits)
    # never NULL, and Spark has to see it: else it asks below the join if they are, making the key anew for each time it is named
    return trips.select("ingestion_month", "record_hash", _day().alias("day"), F.coalesce(word, F.lit(0)).alias("word"), F.coalesce(mask, F.lit(0).cast("bigint")).alias("mask"))


def key_filter(trips: DataFrame) -> DataFrame:
    """The filters of the months of `trips`: (ingestion_month, day, word, bits)."""
    return _addressed(trips).groupBy("ingestion_month", "day", "word").agg(F.bit_or("mask").alias("bits"))


def candidates(new: DataFrame, filters: DataFrame, month: str) -> DataFrame:
    """(ingestion_month, record_hash): keys of `new` that another month may have."""
    other = filters.where(F.col("ingestion_month") != F.lit(f"{month}-01").cast("date"))
    # days are few: of the trips of other days, which are nearly all of a month's, no key is made or shuffled
    near = new.join(F.broadcast(other.select("day").distinct()), _day() == F.col("day"), "left_semi")
    keys = _addressed(near).select("record_hash", "day", "word", "mask")
    return (keys.join(other, ["day", "word"]).where(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask"))
            .select("ingestion_month", "record_hash"))


def repeated_keys(new: DataFrame, loaded: DataFrame, filters: DataFrame, month: str) -> DataFrame | None:
    """The keys of `new` that another loaded month has, with that month; None if no filter knows any.

    One job finds the candidate months (a row a month on the driver); only their folders are then read."""
    found = candidates(new, filters, month)
    months = [r.ingestion_month for r in found.select("ingestion_month").distinct().collect()]
    if not months:
        return None
    there = loaded.where(F.col("ingestion_month").isin(months)).select("ingestion_month", "record_hash")
    return there.join(found, ["ingestion_month", "record_hash"], "left_semi")
