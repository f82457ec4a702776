"""Checks over facts, views and landing tables; each check is one row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..schema import RUN_SUMMARY
from .metrics import per_group


def reconcile(facts: dict[str, DataFrame], kpi: DataFrame, location_other: DataFrame, employer_other: DataFrame,
              role_pareto: DataFrame, keys=("source", "posted_month", "run_id")) -> DataFrame:
    """Facts against the views made from them, per month and run.

    Totals equal the fact sums, located <= total, remainder rows keep the mass, the Pareto curve ends at 100
    with as many ranks as roles, shares add up to 1, and KPI ratios equal their definition on the facts. A side that is
    missing is ok only when the other is missing too.
    """
    keys = list(keys)

    def sums(df, name, *more):
        return df.groupBy(*keys).agg(F.sum("job_count").cast("long").alias(name), *more)

    role, loc, emp = (facts[t] for t in ("role_demand_monthly", "location_demand_monthly", "company_hiring_monthly"))
    j = F.col("job_count").cast("double")
    base = (kpi.select(*keys, "total_postings", "located_postings", "location_hhi", "company_hhi", "top1_role_share")
            .join(sums(role, "role_sum", F.max("job_count").alias("role_max"), F.count(F.lit(1)).alias("roles")),
                  keys, "left")
            .join(sums(loc, "loc_sum", F.sum(j * j).alias("loc_sq")), keys, "left")
            .join(sums(emp, "emp_sum", F.sum(j * j).alias("emp_sq")), keys, "left")
            .join(sums(location_other, "loc_other"), keys, "left")
            .join(sums(employer_other, "emp_other"), keys, "left")
            .join(role_pareto.groupBy(*keys).agg(
                F.max("cumulative_job_pct").alias("curve_end"), F.max("pareto_rank").alias("last_rank"),
                F.sum("share_of_total").alias("share_sum")), keys, "left"))
    c = F.col
    lines = [
        ("total_postings", c("role_sum"), c("total_postings"), 0),
        ("located_postings", F.coalesce(c("loc_sum"), F.lit(0)), c("located_postings"), 0),
        ("located_within_total", F.lit(0), F.greatest(c("located_postings") - c("total_postings"), F.lit(0)), 0),
        ("locations_with_other", c("loc_sum"), c("loc_other"), 0),
        ("employers_with_other", c("emp_sum"), c("emp_other"), 0),
        ("pareto_end", F.lit(100), c("curve_end"), 0.01),
        ("pareto_ranks", c("roles"), c("last_rank"), 0),
        ("pareto_share_sum", F.lit(1), c("share_sum"), 0.001),
        ("location_hhi", F.try_divide(c("loc_sq"), F.pow("loc_sum", F.lit(2))), c("location_hhi"), 0.0001),
        ("company_hhi", F.try_divide(c("emp_sq"), F.pow("emp_sum", F.lit(2))), c("company_hhi"), 0.0001),
        ("top1_role_share", F.try_divide("role_max", "role_sum"), c("top1_role_share"), 0.0001)]
    packed = F.array(*[F.struct(
        F.lit(n).alias("check"), e.cast("double").alias("expected"), a.cast("double").alias("actual"),
        F.coalesce(F.abs(e.cast("double") - a.cast("double")) <= tol, e.isNull() & a.isNull()).alias("ok"))
        for n, e, a, tol in lines])
    return base.select(*keys, F.inline(packed))


def verify_publication(tables: dict[str, DataFrame], latest: DataFrame) -> DataFrame:
    """Per source: rows of the pointed-to run in every table, and whether the run counts as published.

    The summary must hold it, and at least one of the skill and role facts.
    """
    tagged = reduce(DataFrame.unionByName, [
        t.select("source", "run_id").withColumn("table", F.lit(n)) for n, t in tables.items()])
    hits = tagged.join(per_group(latest.select("source", "run_id")), ["source", "run_id"], "left_semi")
    counts = hits.groupBy("source", "run_id").agg(
        *[F.count_if(F.col("table") == n).alias(f"{n}_rows") for n in tables])
    done = latest.select("source", "run_id").join(counts, ["source", "run_id"], "left")
    done = done.na.fill(0, [f"{n}_rows" for n in tables])
    facts = F.lit(False)
    for n in ("skill_demand_monthly", "role_demand_monthly"):
        if n in tables:
            facts = facts | (F.col(f"{n}_rows") >= 1)
    return done.withColumn("published", (F.col(f"{RUN_SUMMARY}_rows") >= 1) & facts)


def profile_json(df: DataFrame, column: str) -> DataFrame:
    """Per top-level key of a JSON column: present, null and blank counts, and the kinds of value seen.

    Texts that are no JSON object are counted under the key `(unparsed)`, of kind `unparsed`.

    Rows become (key, value) pairs and are counted per key with partial aggregation; a key found in every row
    is reduced on each task before the shuffle.
    """
    parsed = F.from_json(F.col(column), "map<string,variant>")
    broken = F.when(F.col(column).isNotNull(), F.create_map(F.lit("(unparsed)"), F.lit(None).cast("variant")))
    pairs = df.select(F.explode(F.coalesce(parsed, broken)).alias("key", "value"))
    shape = F.schema_of_variant("value")
    blank = F.coalesce((shape == "STRING") & (F.btrim(F.col("value").cast("string")) == ""), F.lit(False))
    kind = (F.when(F.col("value").isNull(), F.lit("unparsed")).when(shape == "VOID", F.lit("null")).when(shape == "STRING", F.lit("str"))
            .when(shape == "BOOLEAN", F.lit("bool")).when(shape == "BIGINT", F.lit("int"))
            .when(shape.startswith("ARRAY"), F.lit("array")).when(shape.startswith("OBJECT"), F.lit("object"))
            .otherwise(F.lit("float")))
    per_kind = (pairs.select("key", kind.alias("kind"), blank.alias("blank"))
                .groupBy("key", "kind").agg(F.count(F.lit(1)).alias("n"), F.count_if("blank").alias("b")))
    n, k = F.col("n"), F.col("kind")
    return per_kind.groupBy("key").agg(
        F.sum(F.when(k != "null", n - F.col("b")).otherwise(0)).cast("long").alias("present"),
        F.sum(F.when(k == "null", n).otherwise(0)).cast("long").alias("null"),
        F.sum("b").cast("long").alias("empty_str"), F.array_sort(F.collect_set("kind")).alias("kinds"))
