"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..schema import ensure_shared_folder

#: Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: Lists of names of rows (id and digest, 40 bytes) are broadcast up to this length.
BROADCAST_ROWS = 200_000


def staged(df: DataFrame, name: str) -> DataFrame:
    """`df` written once to the shared folder and read back: cuts the lineage, survives lost executors, and makes
    the result of anything that depends on the partitioning (row numbers, blocks) stable."""
    spark = df.sparkSession
    path = f"{ensure_shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_TABLES: dict[str, Callable[[], None]] = {}


def table_of(owner: str, clear: Callable[[], None]) -> None:
    """Say how the table that `owner` keeps between the tasks of a worker is emptied."""
    _TABLES[owner] = clear


def begin(owner: str) -> None:
    """A task of `owner` begins: workers are used again by the next stage, so tables of other operators go."""
    for other, clear in _TABLES.items():
        if other != owner:
            clear()
    pa.default_memory_pool().release_unused()


def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """`batches`; the memory of each goes back when it is done with, as workers that wait keep what they have."""
    for batch in batches:
        yield batch
        del batch
        pa.default_memory_pool().release_unused()


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def words(text: str | None) -> list[bytes]:
    """Words of a text in UTF-8; `bytes.split` breaks at exactly the six ASCII white-space characters of WORD."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def lower_words(text: str | None) -> list[bytes]:
    """The same with A-Z lower-cased (`bytes.lower` touches nothing else)."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def count_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def tasks_for(rows: int, per_task: int, least: int = 1) -> int:
    """Number of partitions so that each holds about `per_task` rows; grows with the data."""
    return max(least, -(-rows // per_task))


def text_digest(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def keep_rows(df: DataFrame, marks: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `df`, with all their columns, whose `marks` (doc_id, digest, kept) say so.

    Rows that go are named by id and digest of the text. Up to BROADCAST_ROWS names are broadcast, so no text is
    shuffled; more are met by a shuffle. Where one of several rows with the same id and text stays, these rows alone
    are thinned with their texts.
    """
    keys = marks.groupBy("doc_id", "digest").agg(F.max("kept").alias("stays"), F.count("*").alias("n"))
    keys = staged(keys.where(~F.col("stays") | (F.col("n") > 1)), "marks")
    key = [F.col("doc_id").alias("_id"), F.col("digest").alias("_digest")]
    hinted = F.broadcast if keys.count() <= BROADCAST_ROWS else lambda names: names
    lost, again = hinted(keys.where(~F.col("stays")).select(*key)), hinted(keys.where("stays").select(*key))
    rows = df.select(F.struct("*").alias("_doc"), F.col(id_col).alias("_i"), text_digest(F.col(text_col)).alias("_d"))
    same = F.col("_i").eqNullSafe(F.col("_id")) & (F.col("_d") == F.col("_digest"))
    rows = rows.join(lost, same, "left_anti")
    repeated = rows.join(again, same, "left_semi").dropDuplicates(["_i", "_d"])
    return rows.join(again, same, "left_anti").unionByName(repeated).select("_doc.*")
