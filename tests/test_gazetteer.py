"""Places from a table: the rule object's results, large tables, longest suffixes against plain Python."""

import random

from pyspark.sql import functions as F

from vacancy_lake.functions.rules import PlaceRules
from vacancy_lake.operators import gazetteer as G
from vacancy_lake.operators.standardize import canonicalize_places

SMALL = PlaceRules(
    country="land", country_forms=("land", "ld"), context_forms=("land", "ld", "the land"), states=("north", "south", "east"),
    cities={"a": "north", "b": "south", "c": "east", "east": "east"}, aliases={"aa": "a", "norden": "north", "ldd": "ld", "b": "c"},
    geo_spellings={}, geo_alone={}, geo_with_country={}, geo_pairs=())


def test_same_as_the_rule_object(spark):
    rng = random.Random(3)
    words = ["land", "ld", "the land", "north", "south", "east", "a", "b", "c", "aa", "norden", "ldd", "else", "", " - ", "x  y"]
    values = [", ".join(rng.choice(words) for _ in range(rng.randint(0, 5))) for _ in range(3000)] + [None, "", ",,", " north "]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, place string")
    want = {r["i"]: r["out"] for r in canonicalize_places(df, "place", SMALL, "out").collect()}
    got = G.canonicalize(df, "place", G.from_rules(spark, SMALL), "land", "out")
    assert got.columns == ["i", "place", "out"] and {r["i"]: r["out"] for r in got.collect()} == want
    assert len({v for v in want.values()}) > 100
    default = PlaceRules()
    texts = ["pune, in", "bangalore", "Kochi", "kerala", "india", "bengaluru, karnataka, india", "x, y", "mumbai, mumbai, maharashtra, india"]
    df = spark.createDataFrame([(t,) for t in texts], "place string")
    want = canonicalize_places(df, "place", default).collect()
    assert sorted(G.canonicalize(df, "place", G.from_rules(spark, default), "india").collect()) == sorted(want)


def test_hundred_thousand_places(spark):
    n = spark.range(100_000).select(F.concat(F.lit("town "), F.col("id")).alias("name"), F.lit("city").alias("kind"),
                                    F.concat(F.lit("state "), F.col("id") % 50).alias("target"), "id")
    states = spark.range(50).select(F.concat(F.lit("state "), "id").alias("name"), F.lit("state").alias("kind"),
                                    F.lit(None).cast("string").alias("target"))
    other = spark.createDataFrame([("ld", "country", None), ("ld", "context", None), (None, "city", "state 1"), ("town 7", "city", "zzz"),
                                   ("nowhere", "city", None), ("x", None, None)], G.SCHEMA)
    gazetteer = n.drop("id").unionByName(states).unionByName(other)
    df = n.select("id", F.when(F.col("id") % 3 == 0, F.lit("town 7, ld")).otherwise(F.concat("name", F.lit(", ld"))).alias("place"))
    out = G.canonicalize(df, "place", gazetteer, "land")
    shown = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id"))
    want = F.concat(F.lit("town "), shown, F.lit(", state "), shown % 50)
    assert out.where(F.col("place") != want).isEmpty() and out.count() == 100_000
    assert "town 99" not in out._jdf.queryExecution().optimizedPlan().toString()


def brute_suffix(location, names):
    parts = [s for s in (p.strip() for p in (location or "").split(",")) if s]
    for n in range(len(parts), 0, -1):
        if ", ".join(parts[-n:]) in names:
            return names[", ".join(parts[-n:])], ", ".join(parts[:-n])
    return None, ", ".join(parts)


def test_longest_suffix(spark):
    rng = random.Random(4)
    words = list("abcdef")
    names = {", ".join(rng.choice(words) for _ in range(rng.randint(1, 3))): f"v{i}" for i in range(60)}
    values = [",".join(rng.choice([*words, "", " a "]) for _ in range(rng.randint(0, 6))) for _ in range(2000)]
    values += [None, "", ", ".join(["a"] * 5000), "zz"]
    df = spark.createDataFrame([(i, v, 1) for i, v in enumerate(values)], "i int, place string, value int")
    table = spark.createDataFrame([*names.items(), (None, "v"), ("zz", None), ("", "e"), (next(iter(names)), "w")], "name string, value string")
    got = {r["i"]: (r["out"], r["rest"]) for r in G.longest_suffix(df, "place", table, "out", "rest").collect()}
    assert got == {i: brute_suffix(v, names) for i, v in enumerate(values)}


def test_empty_tables(spark):
    df = spark.createDataFrame([("a, b",), (None,)], "place string")
    none = spark.createDataFrame([], G.SCHEMA)
    assert [r[0] for r in G.canonicalize(df, "place", none, "land", "out").select("out").sort("out").collect()] == ["", "a, b"]
    assert G.canonicalize(df.limit(0), "place", G.from_rules(spark, SMALL), "land").isEmpty()
    names = none.withColumn("value", F.lit("v"))
    assert {tuple(r) for r in G.longest_suffix(df, "place", names, "out", "rest").collect()} == {("a, b", None, "a, b"), (None, None, "")}
