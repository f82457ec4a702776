"""Exact deduplication with a split of heavy hitters.

A text that a large share of all rows repeats would send all its rows to one task. Misra-Gries summaries, made per
task and merged, hold every digest with more than rows / counters copies. The exact winners of those candidates
(at most `counters` rows, so broadcast is safe) settle their groups on the map side. The rest has groups of at most
rows / counters rows and is shuffled by digest in the ordinary way.

Defined results: null text counts as empty; null ids are smallest; of rows repeated under one id and one text just
one is kept; an empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import keep_rows, staged, text_digest

COUNTERS = 1024


class MisraGries:
    """At most `k` counters. After n items a counter is short of the true count by n / (k + 1) at most."""

    def __init__(self, k: int):
        self.k, self.counts = k, {}

    def add(self, counts: dict) -> None:
        for key, n in counts.items():
            self.counts[key] = self.counts.get(key, 0) + n
        if len(self.counts) > self.k:
            cut = sorted(self.counts.values(), reverse=True)[self.k]
            self.counts = {key: n - cut for key, n in self.counts.items() if n > cut}


def frequent(df: DataFrame, column: str, counters: int = COUNTERS) -> DataFrame:
    """Candidates for values with more than rows / counters copies: at most `counters` rows, none of those missed.

    Per task one summary travels, at most `counters` rows. Their counts are added per value, and the `counters`
    largest stay: summaries can be merged this way without losing a value above the bound.
    """
    def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = MisraGries(counters)
        for batch in batches:
            found = batch.column(0).value_counts()
            sketch.add(dict(zip(found.field("values").to_pylist(), found.field("counts").to_pylist())))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sketch.counts), batch_type), pa.array(list(sketch.counts.values()), pa.int64())],
            ["value", "n"])

    batch_type = pa.binary()
    merged = df.select(column).mapInArrow(summaries, "value binary, n long").groupBy("value").agg(F.sum("n").alias("n"))
    return merged.orderBy(F.desc("n"), "value").limit(counters).select(F.col("value").alias(column))


def fingerprints(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, digest): 32 bytes of SHA-256 for each row, computed in the scan."""
    return df.select(F.col(id_col).alias("doc_id"), text_digest(F.col(text_col)).alias("digest"))


def exact_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS) -> DataFrame:
    """One row per input row: doc_id, digest, keep_id, group_size, kept."""
    rows = staged(fingerprints(df, id_col, text_col).withColumn("row", F.monotonically_increasing_id()), "digests")
    best = F.max(F.struct("doc_id", "row")).alias("best"), F.count("*").alias("group_size")
    candidates = frequent(rows, "digest", counters)
    winners = staged(rows.join(F.broadcast(candidates), "digest").groupBy("digest").agg(*best), "winners")
    heavy = rows.join(F.broadcast(winners), "digest")
    by_digest = Window.partitionBy("digest")
    light = (rows.join(F.broadcast(winners), "digest", "left_anti")
             .withColumns({"best": F.max(F.struct("doc_id", "row")).over(by_digest),
                           "group_size": F.count("*").over(by_digest)}))
    return heavy.unionByName(light).select(
        "doc_id", "digest", F.col("best.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"))


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS) -> DataFrame:
    """The rows of `df` that stay, with all their columns."""
    return keep_rows(df, exact_groups(df, id_col, text_col, counters), id_col, text_col)
