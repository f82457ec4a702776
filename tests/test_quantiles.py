"""Quartiles against sorted lists; merged summaries against their stated rank error."""

import math
import random

from pyspark.sql import functions as F

from vacancy_lake.operators import quantiles as Q


def frame(spark, groups):
    return spark.createDataFrame([(g, v) for g, values in groups.items() for v in values], "g string, v double").repartition(5)


def disc(values, p):
    return sorted(values)[max(1, math.ceil(p * len(values))) - 1]


def some_groups():
    rng = random.Random(1)
    return {"one": [3.0], "two": [1.0, 2.0], "ties": [5.0] * 500, "steps": [float(i % 4) for i in range(1003)],
            "hot": [rng.lognormvariate(0, 3) for _ in range(30_000)], "signs": [rng.uniform(-9, 9) for _ in range(999)]}


def test_exact_quantiles_equal_sorted_lists(spark):
    groups = some_groups()
    probs = (0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0)
    for k in (16, 400):  # small sketches make wide brackets, not other results
        got = {r["g"]: r for r in Q.exact_quantiles(frame(spark, groups), ["g"], "v", probs, k).collect()}
        for g, values in groups.items():
            assert got[g]["n"] == len(values)
            assert [got[g][Q._name(p)] for p in probs] == [disc(values, p) for p in probs], g


def test_values_outside_of_the_bracket_are_found(spark, monkeypatch):
    monkeypatch.setattr(Q, "rank_error", lambda k: -0.05)  # brackets that cannot hold their quantile
    groups = some_groups()
    got = {r["g"]: r["q50"] for r in Q.exact_quantiles(frame(spark, groups), ["g"], "v").collect()}
    assert got == {g: disc(values, 0.5) for g, values in groups.items()}


def test_box_plot_whiskers_nulls_and_empty(spark):
    df = spark.createDataFrame([("a", float(v)) for v in [*range(1, 12), 100]] + [("a", None), ("n", None)], "g string, v double")
    row, = Q.box_plot(df, ["g"], "v").collect()
    assert (row["n"], row["q25"], row["q50"], row["q75"], row["low"], row["high"]) == (12, 3.0, 6.0, 9.0, 1.0, 11.0)
    assert Q.box_plot(df.where("g = 'n'"), ["g"], "v").collect() == []


def test_merged_summaries_keep_the_rank_error(spark):
    rng = random.Random(3)
    values = [(f"m{rng.randint(1, 12)}", rng.gauss(0, 1)) for _ in range(60_000)]
    parts = Q.summaries(spark.createDataFrame(values, "month string, v double"), ["month"], "v")
    merged = Q.merge_summaries(parts.withColumn("all", F.lit(1)), ["all"])
    row = Q.quantiles_of(merged, ["all"], (0.1, 0.5, 0.9)).first()
    ordered = sorted(v for _, v in values)
    for p, q in ((0.1, "q10"), (0.5, "q50"), (0.9, "q90")):
        rank = sum(v <= row[q] for v in ordered) / len(ordered)
        assert abs(rank - p) <= Q.rank_error(400)
    assert row["n"] == 60_000
