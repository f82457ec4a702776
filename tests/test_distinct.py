"""Bitmaps of posting numbers against sets of keys."""

import random

from pyspark.sql import functions as F

from vacancy_lake.operators import distinct as DI


def test_numbers_are_dense_and_stay(spark):
    first = DI.number_postings(spark.createDataFrame([(f"k{i % 700}",) for i in range(2000)] + [(None,)], "job_id string").repartition(7))
    known = {r["job_id"]: r["number"] for r in first.collect()}
    assert sorted(known.values()) == list(range(700))
    again = DI.number_postings(spark.createDataFrame([(f"k{i}",) for i in range(600, 900)], "job_id string").repartition(3), first)
    now = {r["job_id"]: r["number"] for r in again.collect()}
    assert {k: now[k] for k in known} == known and sorted(now.values()) == list(range(900))
    empty = spark.createDataFrame([], "job_id string")
    assert DI.number_postings(empty).count() == 0
    assert sorted(r["number"] for r in DI.number_postings(empty, first).collect()) == list(range(700))


def test_counts_over_any_months_are_exact(spark):
    rng = random.Random(2)
    rows = [(rng.choice([0, 1, 32_767, 32_768, 32_769, 70_000]) + rng.randint(0, 40), f"2024-{rng.randint(1, 6):02d}", rng.choice("abc"))
            for _ in range(4000)] + [(n, "2024-01", "hot") for n in range(3000)]
    df = spark.createDataFrame(rows, "number long, month string, skill string")
    sets = DI.posting_sets(df.where("month < '2024-04'"), ["month", "skill"]).unionByName(
        DI.posting_sets(df.where("month >= '2024-04'"), ["month", "skill"]))
    for low, high in (("2024-01", "2024-06"), ("2024-03", "2024-04"), ("2025-01", "2025-02")):
        got = {r["skill"]: r["postings"] for r in DI.distinct_postings(sets.where(F.col("month").between(low, high)), ["skill"]).collect()}
        want = {}
        for n, m, s in rows:
            if low <= m <= high:
                want.setdefault(s, set()).add(n)
        assert got == {s: len(v) for s, v in want.items()}
    total = DI.distinct_postings(sets).first()["postings"]
    assert total == len({n for n, _, _ in rows})
    assert DI.distinct_postings(DI.merge_sets(sets, ["skill"]), ["skill"]).count() == 4


def test_sets_combine_before_the_shuffle(spark):
    df = spark.range(100).select(F.col("id").alias("number"), F.lit("x").alias("skill"))
    plan = DI.distinct_postings(DI.posting_sets(df, ["skill"]), ["skill"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_bitmap_construct_agg" in plan and "partial_bitmap_or_agg" in plan
