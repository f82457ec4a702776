"""Driver tables in the shape of the domain: postings, payloads, facts. Whole tables, no sampling.

Only used by the registered queries, the bench and the tests; the library does not know these tables.
"""

from __future__ import annotations

import uuid
from datetime import date
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vacancy_lake.functions.rules import PlaceRules
from vacancy_lake.operators import facts as E
from vacancy_lake.schema import POSTING, ensure_shared_folder
from vacancy_lake.sources import lake as A
from vacancy_lake.sources.lake import Lake

AS_OF = date(2001, 8, 1)
SOURCES = ("src_a", "src_b")

# Raw titles and employer endings that give the text rules something to do; picked by key.
TITLES = (
    "Senior Data Engineer (m/w/d)", "IT-Security Architect", "DevOps Engineer / Kubernetes ", "Customer Success Manager",
    "Java Developer (m/f/d) - ref. nr. 4711", "Product Owner", "Marketing Manager, ", "Account Executive",
    "Accountant", "HR Business Partner", "UX Designer", "Legal Counsel", "Firmware Engineer",
    "Berater | Strategie", "Office Manager (remote)", "Head of", "Gardener", "- Truck  Driver -", "Lead",
    "Power BI Analyst (all genders)", "Full Stack Engineer", "Support Engineer 2nd Line", "Vertrieb", "Nurse")
ENDINGS = (" GmbH", " AG", "")
REGION_NAMES = ("africa", "america", "asia", "europe", "middle east")
# The country of the fixture: regions are its states, nations its cities.
PLACES = PlaceRules(
    country="world", country_forms=("world",), context_forms=("world",), states=REGION_NAMES,
    cities={f"nation_{i}": REGION_NAMES[i % 5] for i in range(25)}, aliases={"far east": "asia"}, geo_spellings={},
    geo_alone={}, geo_with_country={}, geo_pairs=())


_PLANS: dict[tuple, DataFrame] = {}


def once(fn):
    """Build a plan once per application: reading a footer and analysing a plan cost time, data is not kept."""
    @wraps(fn)
    def planned(spark: SparkSession, sf_dir: str, *args, **kw) -> DataFrame:
        key = (fn.__name__, spark.sparkContext.applicationId, sf_dir, args, tuple(sorted(kw.items())))
        if key not in _PLANS:
            _PLANS[key] = fn(spark, sf_dir, *args, **kw)
        return _PLANS[key]
    return planned


@once
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_lake(spark: SparkSession, name: str) -> Lake:
    """A fresh folder under the shared folder of the session."""
    return Lake(f"{ensure_shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}")


def pick(values, index: Column) -> Column:
    return F.get(F.array(*map(F.lit, values)), index.cast("int"))


@once
def orders_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One order = one posting, with employer and place. Join sides are left to Catalyst to size."""
    orders = table(spark, sf_dir, "orders")
    return (orders.join(table(spark, sf_dir, "customer"), orders.o_custkey == F.col("c_custkey"))
            .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .withColumn("day", F.col("o_orderdate").cast("timestamp")))


@once
def order_skills(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    parts = table(spark, sf_dir, "part").select("p_partkey", F.lower("p_type").alias("t"), F.lower("p_brand").alias("b"))
    pairs = lines.join(parts, lines.l_partkey == parts.p_partkey).select(
        "l_orderkey", F.explode(F.array("t", "b")).alias("skill"))
    return pairs.groupBy("l_orderkey").agg(F.array_sort(F.collect_set("skill")).alias("skills"))


@once
def postings(spark: SparkSession, sf_dir: str, skills: bool = True) -> DataFrame:
    """Postings in the contract. `skills=False` leaves the line items unread."""
    o = orders_wide(spark, sf_dir)
    key = F.col("o_orderkey")
    if skills:
        o = o.join(order_skills(spark, sf_dir), key == F.col("l_orderkey"), "left")
    else:
        o = o.withColumn("skills", F.lit(None).cast("array<string>"))
    nation, region = F.lower("n_name"), F.lower("r_name")
    source = F.when(key % 2 == 0, "src_a").otherwise("src_b")
    half = F.when(F.dayofmonth("day") <= 15, "a").otherwise("b")
    return o.select(
        F.sha2(F.concat_ws("|", source, F.lit("id"), key.cast("string")), 256).alias("job_id"),
        source.alias("source"), key.cast("string").alias("source_job_id"),
        F.lower(F.concat_ws(" ", "c_mktsegment", "o_orderpriority")).alias("title_norm"),
        F.lower("c_name").alias("company_norm"), nation.alias("location_raw"),
        F.when(F.col("o_orderstatus") == "F", "remote").when(F.col("o_orderstatus") == "O", "onsite")
        .otherwise("unknown").alias("remote_type"),
        F.coalesce("skills", F.array().cast("array<string>")).alias("skills"),
        F.when(key % 97 != 0, F.col("day")).alias("posted_at"),
        F.date_format(F.date_add("day", 1), "yyyy-MM-dd'T'00:00:00'Z'").alias("ingested_at"),
        F.lit("id").alias("job_id_strategy"),
        F.concat(F.date_format("day", "yyyyMM"), half).alias("bronze_run_id"),
        F.date_format(F.date_add("day", 1), "yyyy-MM-dd").alias("bronze_ingest_date"),
        F.lit(None).cast("string").alias("bronze_data_file"),
        # variants behind the contract: raw title, employer with legal form, place in several shapes
        pick(TITLES, key % len(TITLES)).alias("title_raw"),
        F.concat(F.lower("c_name"), pick(ENDINGS, F.col("c_custkey") % 3)).alias("company_legal"),
        F.when(key % 5 == 0, F.concat_ws(", ", nation, region)).when(key % 5 == 1, region)
        .when(key % 5 == 2, F.lit("")).when(key % 5 == 3, F.concat_ws(", ", nation, F.lit("world")))
        .otherwise(nation).alias("place"))


def stored_postings(spark: SparkSession, sf_dir: str, lake: Lake, skills: bool = True) -> DataFrame:
    """Postings in the contract, written once below the lake. For queries that read them many times."""
    path = f"{lake.root}/postings"
    (postings(spark, sf_dir, skills).select(*POSTING.fieldNames()).write.partitionBy("source")
     .option("compression", "zstd").parquet(path))
    return spark.read.schema(POSTING).parquet(path).select(*POSTING.fieldNames())


RUN = "bronze_run_id"


def facts(df: DataFrame) -> dict[str, DataFrame]:
    """Fact counts of several runs: every half month is a run of its own. One row per posting, so rows are counted."""
    run = F.col(RUN)
    return {"skill_demand_monthly": E.skill_counts(df, run, unique=True), "role_demand_monthly": E.role_counts(df, run),
            "location_demand_monthly": E.location_counts(df, run, None),
            "company_hiring_monthly": E.company_counts(df, run)}


@once
def published(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The facts of all runs, written once per application to the shared folder and read from there, folder by folder."""
    lake = work_lake(spark, "facts")
    out = {}
    for name, df in facts(postings(spark, sf_dir)).items():
        A.write_fact(df, name, lake)
        out[name] = A.read_fact(spark, name, lake).select(*df.columns)
    return out


@once
def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payload JSON per order: src_a speaks the board dialect, src_b the nested one; plus `created` seconds."""
    o = orders_wide(spark, sf_dir)
    key = F.col("o_orderkey")
    title = pick(TITLES, key % len(TITLES))
    board = F.to_json(F.struct(
        F.concat(F.lit("job-"), key).alias("slug"), F.concat(F.lit("https://example.org/"), key).alias("url"),
        title.alias("title"), F.col("c_name").alias("company_name"), F.col("n_name").alias("location"),
        F.concat(F.lit("<p>Python &amp; "), F.col("c_mktsegment"), F.lit("</p>")).alias("description"),
        F.array(F.col("o_orderpriority"), F.lit("K8s")).alias("tags"), (F.col("o_orderstatus") == "F").alias("remote"),
        F.unix_timestamp("day").alias("created_at")))
    nested = F.to_json(F.struct(
        key.cast("string").alias("id"), F.concat(F.lit("https://example.com/"), key).alias("redirect_url"),
        title.alias("title"), F.concat(F.lit("SQL hybrid "), F.col("c_mktsegment")).alias("description"),
        F.date_format("day", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("created"),
        F.struct(F.col("c_name").alias("display_name")).alias("company"),
        F.struct(F.lit("India").alias("display_name"),
                 F.array(F.lit("India"), F.col("r_name"), F.col("n_name")).alias("area")).alias("location"),
        F.struct(F.lit("IT Jobs").alias("label"), F.lit("it-jobs").alias("tag")).alias("category"),
        F.lit("full_time").alias("contract_time")))
    return o.select(F.when(key % 2 == 0, "src_a").otherwise("src_b").alias("source"), "o_orderkey", "day",
                    F.when(key % 2 == 0, board).otherwise(nested).alias("raw_payload"))
