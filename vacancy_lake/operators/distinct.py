"""Distinct postings over any range of months, from sets that merge: bitmaps of posting numbers.

Each posting has a number, given once and kept in a table; numbers are dense, so a set of postings is a few bitmaps of
32,768 places (4 KB at most, less where Parquet packs empty ones). The index holds one set per source, month and value.
A count over months, sources or values is the union of sets, and exact, though postings occur in several months; it reads
the index and neither the postings nor their keys. A new batch adds its own sets beside the old ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..schema import use_shared_checkpoints

_INDEX_IN_PARTITION = (1 << 33) - 1


def number_postings(keys: DataFrame, known: DataFrame | None = None, key: str = "job_id") -> DataFrame:
    """(key, number) of all keys: those of `known` keep theirs, new ones go on behind them without gaps.

    New keys are placed once in the checkpoint folder; their place in a partition and the sizes of the partitions before
    give the number, so nothing is sorted or gathered. A null key has no number.
    """
    spark = keys.sparkSession
    use_shared_checkpoints(spark)
    fresh = keys.select(key).where(F.col(key).isNotNull()).distinct()
    first = 0
    if known is not None:
        fresh = fresh.join(known.select(key), key, "left_anti")
        first = (known.agg(F.max("number")).first()[0] or -1) + 1 if not known.isEmpty() else 0
    placed = fresh.withColumn("_id", F.monotonically_increasing_id()).checkpoint()
    placed = placed.select(key, F.shiftrightunsigned("_id", 33).cast("int").alias("_part"),
                           F.col("_id").bitwiseAND(F.lit(_INDEX_IN_PARTITION)).alias("_at"))
    offsets, at = [], first
    for row in placed.groupBy("_part").agg(F.count("*").alias("n")).orderBy("_part").collect():  # one row per partition
        offsets.append((row["_part"], at))
        at += row["n"]
    starts = spark.createDataFrame(offsets, "_part int, _start long")
    numbered = placed.join(F.broadcast(starts), "_part").select(key, (F.col("_start") + F.col("_at")).alias("number"))
    return numbered if known is None else known.select(key, "number").unionByName(numbered)


def posting_sets(rows: DataFrame, keys: Sequence[str | Column], number: str = "number") -> DataFrame:
    """The set of postings of each combination of `keys`: a bitmap for every 32,768 numbers that occur.

    Bitmaps are built by task before the shuffle, so a value that holds a third of all rows sends a few of them.
    """
    # Numbers start at 1 for the bitmap functions, where 0 would lie in a bucket of its own.
    place = F.col(number) + 1
    return rows.groupBy(*keys, F.bitmap_bucket_number(place).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("postings"))


def distinct_postings(sets: DataFrame, keys: Sequence[str] = (), out: str = "postings") -> DataFrame:
    """Distinct postings by `keys`: sets are united over everything else, then counted."""
    united = sets.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("postings").alias("_set"))
    return united.groupBy(*keys).agg(F.sum(F.bitmap_count("_set")).alias(out))


def merge_sets(sets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One set per combination of `keys`, from sets of several batches."""
    return sets.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("postings").alias("postings"))
