"""Generic market measures over any counted dimension.

Each takes the grouping keys, the dimension and the measure by name. Group totals come from partial
aggregation, rankings keep only the first k rows per group on every task before the shuffle, and no operator
gathers an unbounded group in one task.

`small_groups=True` says the groups are published slices such as (source, month, run): there are as many as there are
folders, so tables with a few rows per group have a known bound and are broadcast. The rows themselves are then never
shuffled by group, however many of them one month holds. The views, whose keys are fixed, say so; by default nothing
is hinted, and Spark chooses the join by measured size.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, Window as W

from ..schema import use_shared_checkpoints


def per_group(df: DataFrame, small_groups: bool = True) -> DataFrame:
    return F.broadcast(df) if small_groups else df


def stacked(first: DataFrame, rest: DataFrame, key: str) -> DataFrame:
    """Rows of both by name, as `unionByName` with missing columns allowed, for parts that may be dealt alike by `key` (text).

    Spark 4.1 plans a union of such parts as dealt by the key too and leaves out the exchange above it. When partitions are
    joined or split at run time that no longer holds: a join fails ("Can't zip RDDs with unequal numbers of partitions"),
    a ranking or a count meets a key in two tasks. An expression around the key of one part takes the promise away.
    """
    return first.withColumn(key, F.concat(key)).unionByName(rest, allowMissingColumns=True)


def share(part: Column, whole: Column) -> Column:
    """part / whole as double; NULL when the universe is empty."""
    return F.try_divide(part.cast("double"), F.nullif(whole.cast("double"), F.lit(0.0)))


def hhi_of(measure: str) -> Column:
    """Aggregate: concentration index, sum of squared shares, in one pass without group totals."""
    m = F.col(measure).cast("double")
    return F.try_divide(F.sum(m * m), F.nullif(F.pow(F.sum(m), 2), F.lit(0.0)))


def hhi(df: DataFrame, keys: Sequence[str], measure: str = "job_count", name: str = "hhi") -> DataFrame:
    return df.groupBy(*keys).agg(hhi_of(measure).alias(name))


def first_k(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first k rows per group with their rank."""
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)


def top_k(df: DataFrame, keys, dim: str, k: int, measure: str = "job_count", rank: str = "rank") -> DataFrame:
    """Largest k values of a dimension per group; ties go to the smaller name."""
    return first_k(df, keys, [F.desc(measure), F.asc(dim)], k, rank)


def topk_share(df: DataFrame, keys, dim: str, k: int, measure="job_count", name="topk_share") -> DataFrame:
    """Share of mass held by the k largest values of a dimension."""
    best = top_k(df, keys, dim, k, measure).groupBy(*keys).agg(F.sum(measure).alias("_best"))
    total = df.groupBy(*keys).agg(F.sum(measure).alias("_all"))
    return total.join(best, list(keys), "left").select(
        *keys, share(F.coalesce(F.col("_best"), F.lit(0)), F.col("_all")).alias(name))


def _with_rank(df: DataFrame, best: DataFrame, names: Sequence[str], small_groups: bool) -> DataFrame:
    """Add `_rank` where a row is among the best, NULL elsewhere.

    Null-safe equality: plain equality would add not-null filters below one side only, and Spark could no longer
    reuse the exchange both sides share.
    """
    marks = best.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(names)], "_rank")
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(names)])
    return df.join(per_group(marks, small_groups), same, "left").drop(*[f"_k{i}" for i in range(len(names))])


def top_n_other(df: DataFrame, keys, dim: str, n: int, measure="job_count", label="label", other="Other",
                carry: dict[str, Column] | None = None, small_groups: bool = False) -> DataFrame:
    """Totals per value: the n largest by name, the rest as one remainder row.

    `carry` holds further max-like aggregates, e.g. `{"posted_month": F.max("posted_month")}`.
    """
    carry = carry or {}
    totals = df.groupBy(*keys, dim).agg(F.sum(measure).alias(measure), *[a.alias(c) for c, a in carry.items()])
    # Values are unique per group here, so the carried columns never decide a rank; naming them keeps both uses
    # of the totals column for column alike, and Spark then runs the aggregation once and reuses its exchange.
    order = [F.desc(measure), F.asc(dim), *map(F.asc, carry)]
    best = first_k(totals, keys, order, n, "_rank")
    labelled = _with_rank(totals, best, [*keys, dim], small_groups).withColumn(
        label, F.when(F.col("_rank").isNotNull(), F.col(dim)).otherwise(F.lit(other)))
    return (labelled.groupBy(*keys, label).agg(F.sum(measure).cast("long").alias(measure),
                                               *[F.max(c).alias(c) for c in carry])
            .where(F.col(measure) > 0))


def running_total(df: DataFrame, keys, order: Sequence[Column], measure: str, rank="rank", total="running",
                  bounded: bool = False) -> DataFrame:
    """Rank and running sum per group in the given order.

    `bounded=True` is for dimensions with a fixed small domain: one plain window. Otherwise rows are range
    partitioned by (keys, order) and written once to the shared checkpoint folder together with the number of
    their slice; slice sums give each slice its start value, so even a group holding most rows is spread.
    """
    if bounded:
        w = W.partitionBy(*keys).orderBy(*order)
        return (df.withColumn(rank, F.row_number().over(w).cast("long"))
                .withColumn(total, F.sum(measure).over(w.rowsBetween(W.unboundedPreceding, 0))))
    use_shared_checkpoints(df.sparkSession)
    placed = (df.repartitionByRange(*[F.asc(k) for k in keys], *order)
              .withColumn("_slice", F.spark_partition_id()).checkpoint())
    before = W.partitionBy(*keys).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    starts = (placed.groupBy(*keys, "_slice").agg(F.count(F.lit(1)).alias("_n"), F.sum(measure).alias("_m"))
              .select(*keys, "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n0"),
                      F.coalesce(F.sum("_m").over(before), F.lit(0)).alias("_m0")))
    inside = W.partitionBy(*keys, "_slice").orderBy(*order)
    return (placed.join(starts, [*keys, "_slice"])
            .withColumn(rank, F.col("_n0") + F.row_number().over(inside))
            .withColumn(total, F.col("_m0") + F.sum(measure).over(inside.rowsBetween(W.unboundedPreceding, 0)))
            .drop("_slice", "_n0", "_m0"))


def with_total(df: DataFrame, keys, measure: str, name: str, small_groups: bool = False) -> DataFrame:
    """Add the group total by joining the aggregated totals back (no window over a whole group)."""
    totals = df.groupBy(*keys).agg(F.sum(measure).alias(name))
    return df.join(per_group(totals, small_groups), list(keys))


def with_share(df: DataFrame, keys, measure: str = "job_count", name: str = "share",
               small_groups: bool = False) -> DataFrame:
    """Share of each row in the total of its group."""
    return (with_total(df, keys, measure, "_total", small_groups)
            .withColumn(name, share(F.col(measure), F.col("_total"))).drop("_total"))


def pareto(df: DataFrame, keys, dim: str, measure="job_count", bounded: bool = False,
           small_groups: bool = False) -> DataFrame:
    """Rank, share and cumulative percent of every value, largest first."""
    ranked = running_total(df, keys, [F.desc(measure), F.asc(dim)], measure, "pareto_rank", "_run", bounded)
    totals = df.groupBy(*keys).agg(F.sum(measure).alias("_total"))
    return ranked.join(per_group(totals, small_groups), list(keys)).select(
        *df.columns, "pareto_rank", share(F.col(measure), F.col("_total")).alias("share_of_total"),
        (F.lit(100.0) * share(F.col("_run"), F.col("_total"))).alias("cumulative_job_pct"))


def bucket_top(df: DataFrame, keys, dim: str, k: int, other: str, weight: str, out: str,
               small_groups: bool = False) -> DataFrame:
    """Replace a dimension by itself where it is one of the k heaviest of its group, else by `other`."""
    mass = df.groupBy(*keys, dim).agg(F.sum(weight).alias("_mass"))
    best = top_k(mass, keys, dim, k, "_mass", "_rank")
    return (_with_rank(df, best, [*keys, dim], small_groups)
            .withColumn(out, F.when(F.col("_rank").isNotNull(), F.col(dim)).otherwise(F.lit(other))).drop("_rank"))


def flow_edges(rows: DataFrame, keys, src: str, dst: str, k_src: int | None = None, k_dst: int | None = None,
               other_src="Other", other_dst="Other", version: str | None = None,
               small_groups: bool = False) -> DataFrame:
    """Edge weights between two dimensions, each optionally reduced to its k heaviest values plus a remainder.

    Rows are counted per (src, dst) pair first, so ranking and bucketing see pairs, not rows. `version` names a
    column whose largest value is reported per edge; it joins the first, hash aggregated grouping.
    """
    more = [version] if version else []
    edges = rows.groupBy(*keys, src, dst, *more).agg(F.count(F.lit(1)).alias("_w"))
    left, right = F.col(src), F.col(dst)
    if k_src:
        edges, left = bucket_top(edges, keys, src, k_src, other_src, "_w", "_src", small_groups), F.col("_src")
    if k_dst:
        edges, right = bucket_top(edges, keys, dst, k_dst, other_dst, "_w", "_dst", small_groups), F.col("_dst")
    return edges.groupBy(*keys, left.alias("source_bucket"), right.alias("target_bucket")).agg(
        F.sum("_w").cast("long").alias("edge_weight"), *[F.max(v).alias(f"latest_{v}") for v in more])
