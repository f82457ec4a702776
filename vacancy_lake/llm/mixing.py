"""Mixing sources to target weights by weighted sampling without replacement.

Every document draws an exponential key, -ln(u) / quality weight, with u from a hash of its id (Efraimidis and
Spirakis: the smallest keys are a sample weighted by quality). Within its source documents are sorted by key and
their sizes summed; a document is taken while the middle of its share of that sum lies within the token budget, so
the total is the nearest that whole documents reach. Where a target exceeds the source, complete epochs come first
and the fraction of the last epoch is selected by the keys.

No source is sorted as a whole. Keys fall into `buckets` slices of the exponential distribution; slice sums are
combined before the shuffle, slices below the budget are taken and above are left, and only the one slice that the
budget cuts is sorted row by row.

Defined results: null texts have size 0; a null source is a source, the last in order; null ids draw as the empty
id; repeated rows count and are drawn one by one; sources without words get target 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import count_words, staged

#: Sources up to this number are broadcast (a few dozen bytes each); more go through an ordinary join.
BROADCAST_SOURCES = 100_000


def quality(text: Column, size: Column) -> Column:
    """1 for texts with usual lengths of words (six characters with the blank), less the farther from it."""
    per_word = F.length(F.coalesce(text, F.lit(""))) / F.greatest(size, F.lit(1))
    return 1.0 / (1.0 + F.abs(per_word - 6.0) / 6.0)


def exponential_key(doc_id: Column, weight: Column) -> Column:
    bits = F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, 13), 16, 10).cast("long")
    return -F.ln((bits + 0.5) / F.lit(2.0 ** 52)) / weight


def water_fill(sizes: DataFrame, weights: tuple[int, ...], share: float, epochs: float) -> DataFrame:
    """Targets of sources (source, source_size): `share` of all sizes by weight, at most `epochs` times each source.

    Sorted by epochs * size / weight, sources are full up to a first one that is not; from there all share the rest
    by weight. One row per source, so windows over all of them are small.
    """
    every = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*map(F.lit, map(float, weights))), ((F.row_number().over(every) - 1) % len(weights) + 1))
    rows = sizes.withColumn("weight", w).withColumn("cap", F.lit(epochs) * F.col("source_size"))
    rows = rows.withColumn("fill", F.col("cap") / F.col("weight"))
    by_fill = Window.orderBy("fill", F.col("source").asc_nulls_last())
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    after = by_fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy(F.lit(0))
    rows = rows.withColumns({
        "place": F.row_number().over(by_fill),
        "level": (F.lit(share) * F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        / F.sum("weight").over(after)})
    rows = rows.withColumn("first", F.min(F.when(F.col("fill") >= F.col("level"), F.col("place"))).over(whole))
    rows = rows.withColumn("final", F.max(F.when(F.col("place") == F.col("first"), F.col("level"))).over(whole))
    return rows.select("source", "source_size",
                       F.when(F.col("place") < F.col("first"), F.col("cap"))
                       .otherwise(F.least("cap", F.col("final") * F.col("weight"))).alias("target"))


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, epochs: float = 2.0, buckets: int = 4096) -> DataFrame:
    """`df` as column `doc` with size, source_size, target, copies (how often the mix takes it) and taken (words)."""
    size = count_words(F.col(text_col))
    rows = df.select(F.struct("*").alias("doc"), F.col(source_col).alias("source"), size.alias("size"))
    rows = rows.withColumn("key", exponential_key(F.col(f"doc.{id_col}"), quality(F.col(f"doc.{text_col}"), F.col("size"))))
    rows = rows.withColumn("slice", F.least(F.floor(F.lit(buckets) * (1.0 - F.exp(-F.col("key")))), F.lit(buckets - 1)))

    sums = staged(rows.groupBy("source", "slice").agg(F.sum("size").alias("n")), "slices")
    targets = water_fill(sums.groupBy("source").agg(F.sum("n").alias("source_size")), weights, share, epochs)
    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    targets = targets.withColumn("full", full.cast("long"))
    targets = targets.withColumn("budget", F.col("target") - F.col("full") * F.col("source_size"))
    targets = staged(targets, "targets")
    small = targets.count() <= BROADCAST_SOURCES
    hinted = F.broadcast if small else lambda x: x

    by_slice = Window.partitionBy("source").orderBy("slice")
    ends = sums.withColumn("before", F.coalesce(
        F.sum("n").over(by_slice.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    # The first slice that ends beyond the budget is cut by it; null where none is.
    t = targets.select(F.col("source").alias("s"), "budget", "full", "target", "source_size")
    cut = (ends.join(hinted(t), F.col("source").eqNullSafe(F.col("s")))
           .groupBy("s", "full", "budget", "target", "source_size")
           .agg(F.min(F.when(F.col("before") + F.col("n") > F.col("budget"), F.struct("slice", "before"))).alias("cut")))
    cut = staged(cut, "cuts")

    drawn = rows.join(hinted(cut), F.col("source").eqNullSafe(F.col("s")))
    inside = drawn.where(F.coalesce(F.col("slice") == F.col("cut.slice"), F.lit(False)))
    outside = drawn.where(~F.coalesce(F.col("slice") == F.col("cut.slice"), F.lit(False)))
    order = Window.partitionBy("source").orderBy("key", f"doc.{id_col}", "size", F.xxhash64(f"doc.{text_col}"))
    before = F.col("cut.before") + F.coalesce(
        F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = inside.withColumn("picked", 2 * before + F.col("size") <= 2 * F.col("budget"))
    outside = outside.withColumn("picked", F.coalesce(F.col("slice") < F.col("cut.slice"), F.lit(True)))
    copies = F.col("full") + F.when(F.col("picked"), 1).otherwise(0)
    return inside.unionByName(outside).select(
        "doc", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def taken_rows(mixed: DataFrame) -> DataFrame:
    """The mix itself: every document of `mix` as often as it is taken, with its own columns."""
    copies = F.array_repeat(F.lit(0), F.col("copies").cast("int"))
    return mixed.withColumn("copy", F.explode(copies)).select("doc.*")
