"""Quartiles and whiskers per group: mergeable summaries with a stated rank error, and exact values bracketed by them.

A summary is a KLL sketch: a few kilobytes per group whatever its size. Summaries of batches, months or sources merge, and a
quantile read from one has a rank within `rank_error(k)` of the one asked for (with 99 % confidence).

Exact quantiles take one pass more. The summary says between which two values a quantile must lie; what is smaller is only
counted, and only values between the two are put in order. A group with a third of all rows is never sorted. Should a
value lie outside of its bracket after all, the count shows it, and that group is ranked over all of its distinct values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..schema import use_shared_checkpoints
from .metrics import per_group

QUARTILES = (0.25, 0.5, 0.75)


def rank_error(k: int) -> float:
    """Normalised rank error of a KLL sketch of size `k`, one side, 99 % confidence."""
    return 2.296 / k ** 0.9723


def summaries(df: DataFrame, keys: Sequence[str], measure: str, k: int = 400) -> DataFrame:
    """One mergeable summary per group, with the number of its values; nulls do not count."""
    value = F.col(measure).cast("double")
    return df.where(value.isNotNull()).groupBy(*keys).agg(F.kll_sketch_agg_double(value, k).alias("sketch"), F.count(value).alias("n"))


def merge_summaries(parts: DataFrame, keys: Sequence[str], k: int = 400) -> DataFrame:
    """Summaries of larger groups from those of smaller ones, without the values."""
    return parts.groupBy(*keys).agg(F.kll_merge_agg_double("sketch", k).alias("sketch"), F.sum("n").alias("n"))


def quantiles_of(parts: DataFrame, keys: Sequence[str], probs: Sequence[float] = QUARTILES) -> DataFrame:
    """Approximate quantiles q25, q50, ... of summaries."""
    return parts.select(*keys, "n", *[F.kll_sketch_get_quantile_double("sketch", F.lit(p)).alias(_name(p)) for p in probs])


def _name(p: float) -> str:
    return f"q{round(p * 100):02d}"


def exact_quantiles(df: DataFrame, keys: Sequence[str], measure: str, probs: Sequence[float] = QUARTILES, k: int = 400,
                    small_groups: bool = False) -> DataFrame:
    """keys, n and the exact quantiles q25, q50, ...: the smallest value that at least p * n values do not exceed.

    The summaries are kept in the checkpoint folder, so brackets do not change between the passes. `small_groups` as in
    `metrics`: there are as many groups as published slices, so their brackets are broadcast.
    """
    use_shared_checkpoints(df.sparkSession)
    value = F.col(measure).cast("double")
    counts = df.where(value.isNotNull()).groupBy(*keys, value.alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    parts = summaries(df, keys, measure, k).checkpoint()
    slack = 3 * rank_error(k)

    def edge(at: float) -> Column:
        return F.kll_sketch_get_quantile_double("sketch", F.lit(min(1.0, max(0.0, at))))

    asked = F.array(*[F.struct(F.lit(p).alias("_p"), edge(p - slack).alias("_lo"), edge(p + slack).alias("_hi")) for p in probs])
    brackets = parts.select(*keys, "n", F.explode(asked).alias("_q")).select(
        *keys, F.col("n"), "_q.*", F.greatest(F.lit(1), F.ceil(F.col("_q._p") * F.col("n"))).alias("_rank"))
    found = _ranked(counts, per_group(brackets, small_groups), keys)
    # A quantile outside of its bracket: that group again, over all of its values.
    lost = (brackets.join(found.select(*keys, "_p"), [*keys, "_p"], "left_anti")
            .withColumns({"_lo": F.lit(float("-inf")), "_hi": F.lit(float("inf"))})).checkpoint()
    if not lost.isEmpty():
        found = found.unionByName(_ranked(counts, per_group(lost, small_groups), keys))
    return found.groupBy(*keys, "n").agg(*[F.max(F.when(F.col("_p") == p, F.col("_v"))).alias(_name(p)) for p in probs])


def _ranked(counts: DataFrame, brackets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, n, _p, _v of the quantiles that lie in their brackets."""
    near = counts.join(brackets, list(keys))
    inside = F.col("_v").between(F.col("_lo"), F.col("_hi"))
    group = [*keys, "n", "_p", "_rank"]
    # Smaller values fall together in one row, which comes first.
    rows = near.where(F.col("_v") <= F.col("_hi")).groupBy(*group, F.when(inside, F.col("_v")).alias("_v")).agg(F.sum("_c").alias("_c"))
    running = F.sum("_c").over(Window.partitionBy(*group).orderBy(F.asc_nulls_first("_v")))
    hits = rows.withColumn("_cum", running).where((F.col("_cum") >= F.col("_rank")) & (F.col("_cum") - F.col("_c") < F.col("_rank")))
    return hits.where(F.col("_v").isNotNull()).select(*keys, "n", "_p", "_v")


def box_plot(df: DataFrame, keys: Sequence[str], measure: str, k: int = 400, small_groups: bool = False) -> DataFrame:
    """keys, n, q25, q50, q75 and the whiskers low and high: outermost values within one and a half times the box."""
    quartiles = exact_quantiles(df, keys, measure, k=k, small_groups=small_groups)
    value, reach = F.col(measure).cast("double"), 1.5 * (F.col("q75") - F.col("q25"))
    inside = value.between(F.col("q25") - reach, F.col("q75") + reach)
    whiskers = (df.where(value.isNotNull()).join(per_group(quartiles, small_groups), list(keys)).groupBy(*keys)
                .agg(F.min(F.when(inside, value)).alias("low"), F.max(F.when(inside, value)).alias("high")))
    return quartiles.join(whiskers, list(keys))
