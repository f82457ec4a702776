"""Places from a table: any number of names, matched by equi-joins on the distinct spellings of a column.

A gazetteer has rows (name, kind, target), names as comma segments in lower case:

kind     meaning of `name`                                     target
state    a state                                               -
city     a city                                                its state
alias    another spelling of one segment                       the name it stands for
country  a form of the country's name                          -
context  a word that shows that a location is of this country  -

`functions.text.canonical_place` has the same rules as expressions that hold every name in the plan; use that for some
hundred names. Here names meet segments in a shuffle (or a broadcast, where Spark measures a small side), so tables of
millions will do. Only distinct spellings are split and joined; a spelling that a third of all rows share is one row
there, and on the way back it is the skewed side of a join whose other side holds it once, which AQE splits.

Defined results: a null location is the empty one and stays empty; spellings nothing is known of stay as they are; rows
with a null name, kind or, where one is due, target are ignored; of several targets of one name the smallest counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.rules import PlaceRules
from ..functions.text import edge_trim, let, squeeze, text

SCHEMA = "name string, kind string, target string"
_SPELLING = "_spelling"


def from_rules(spark: SparkSession, places: PlaceRules) -> DataFrame:
    """The gazetteer that says what a small rule object says."""
    rows = [(n, kind, None) for kind, names in (("state", places.states), ("country", places.country_forms),
                                                ("context", places.context_forms)) for n in names]
    rows += [(n, kind, t) for kind, pairs in (("city", places.cities), ("alias", places.aliases)) for n, t in pairs.items()]
    return spark.createDataFrame(rows, SCHEMA)


def segments(c: Column) -> Column:
    """Comma segments, trimmed, without empty ones."""
    return F.filter(F.transform(F.split(c, ","), lambda s: edge_trim(squeeze(s))), lambda s: s != "")


def _facts(gazetteer: DataFrame) -> DataFrame:
    """One row per name: what it is, and what the name it stands for is."""
    def target(kind: str) -> Column:
        return F.min(F.when(F.col("kind") == kind, F.col("target")))

    def has(kind: str) -> Column:
        return F.bool_or(F.coalesce(F.col("kind") == kind, F.lit(False)))

    one = gazetteer.where(F.col("name").isNotNull()).groupBy("name").agg(
        has("state").alias("state"), has("country").alias("country"), has("context").alias("context"),
        target("city").alias("city"), target("alias").alias("alias"))
    known = F.col("state") | F.col("context") | F.col("city").isNotNull()
    meant = one.select(F.col("name").alias("alias"), *[F.col(c).alias(f"to_{c}") for c in ("state", "country", "city")])

    def of_meant(c: str) -> Column:
        return F.when(F.col("alias").isNull(), F.col(c)).otherwise(F.col(f"to_{c}")).alias(c)

    # Few names are aliases, and only those are looked up a second time.
    plain = one.where(F.col("alias").isNull()).select("name", "alias", known.alias("known"), "state", "country", "city")
    renamed = one.where(F.col("alias").isNotNull()).join(meant, "alias", "left").select(
        "name", "alias", known.alias("known"), of_meant("state"), of_meant("country"), of_meant("city"))
    return plain.unionByName(renamed)


def _spellings(df: DataFrame, column: str) -> DataFrame:
    return df.select(text(F.col(column)).alias(_SPELLING)).distinct()


def _back(df: DataFrame, column: str, found: DataFrame) -> DataFrame:
    return df.withColumn(_SPELLING, text(F.col(column))).join(found, _SPELLING, "left")


def _shape(p: Column, country: str) -> Column:
    """The canonical text of segments (name, state, country, city) in order."""
    home, names = F.lit(country), F.transform(p, lambda s: s["name"])
    first, second = F.get(p, F.lit(0)), F.get(p, F.lit(1))
    low, mid, last = (F.get(p, F.size(p) - k) for k in (3, 2, 1))

    def with_parent(otherwise: Column) -> Column:
        return (F.when(first["state"], F.concat_ws(", ", first["name"], home))
                .when(first["city"].isNotNull(), F.concat_ws(", ", first["name"], first["city"])).otherwise(otherwise))

    n = F.size(p)
    return (F.when((n == 1) & first["country"], home).when(n == 1, with_parent(first["name"]))
            .when((n == 2) & second["country"], with_parent(F.concat_ws(", ", first["name"], home)))
            .when((n > 2) & last["country"] & mid["state"] & ~low["state"], F.concat_ws(", ", low["name"], mid["name"]))
            .otherwise(F.array_join(names, ", ")))


def canonicalize(df: DataFrame, column: str, gazetteer: DataFrame, country: str, out: str | None = None) -> DataFrame:
    """"city, state", "state, country" or the country alone, for locations that name something of the gazetteer."""
    parts = _spellings(df, column).select(_SPELLING, F.posexplode(segments(F.col(_SPELLING))).alias("_at", "name"))
    none = F.lit(False)
    met = parts.join(_facts(gazetteer), "name", "left").select(
        _SPELLING, F.coalesce("known", none).alias("_known"), F.struct(
            "_at", F.coalesce("alias", "name").alias("name"), F.coalesce("state", none).alias("state"),
            F.coalesce("country", none).alias("country"), "city").alias("_part"))
    whole = met.groupBy(_SPELLING).agg(F.bool_or("_known").alias("_known"),
                                       F.array_sort(F.collect_list("_part")).alias("_parts")).where("_known")
    once = F.filter("_parts", lambda s, i: (i == 0) | (s["name"] != F.get("_parts", i - 1)["name"]))
    found = whole.select(_SPELLING, let(once, lambda p: _shape(p, country)).alias("_canonical"))
    found = found.where(F.col("_canonical") != F.col(_SPELLING))
    return _back(df, column, found).withColumn(
        out or column, F.coalesce("_canonical", _SPELLING)).drop(_SPELLING, "_canonical")


def longest_suffix(df: DataFrame, column: str, names: DataFrame, out: str, rest: str | None = None) -> DataFrame:
    """`out`: value of the longest run of last segments that `names` (name, value) has, else NULL.

    `rest` receives the segments before the match (all of them without one), joined. A suffix longer than the longest
    name cannot match, so a location of many segments makes only as many suffixes as that name has segments.
    """
    keys = names.where(F.col("name").isNotNull() & F.col("value").isNotNull()).select(
        F.array_join(segments(F.col("name")), ", ").alias("name"), F.size(segments(F.col("name"))).alias("_n"), "value")
    keys = keys.where("_n > 0").groupBy("name").agg(F.min("value").alias("value"), F.max("_n").alias("_n"))
    most = keys.agg(F.max("_n").alias("_most"))  # one row
    split = _spellings(df, column).select(_SPELLING, segments(F.col(_SPELLING)).alias("_s"))
    split = split.where(F.size("_s") > 0).join(F.broadcast(most), F.col("_most").isNotNull())
    lengths = F.sequence(F.lit(1), F.least(F.size("_s"), F.col("_most")))
    tails = split.select(_SPELLING, F.explode(F.transform(lengths, lambda n: F.array_join(
        F.slice("_s", F.size("_s") - n + 1, n), ", "))).alias("name"))
    best = tails.join(keys, "name").groupBy(_SPELLING).agg(F.max(F.struct("_n", "value")).alias("_best"))
    done = _back(df, column, best).withColumn(out, F.col("_best.value"))
    if rest is not None:
        left = let(segments(F.col(_SPELLING)), lambda s: F.slice(
            s, F.lit(1), F.size(s) - F.coalesce(F.col("_best._n"), F.lit(0))))
        done = done.withColumn(rest, F.array_join(left, ", "))
    return done.drop(_SPELLING, "_best")
