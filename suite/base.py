"""Registry of (query, SQL) pairs and the SQL twins of the fixtures."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType

from .fixtures import ENDINGS, TITLES, ensure_shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def rounded(df: DataFrame, digits: int = 9) -> DataFrame:
    """Doubles rounded: the order of summation differs between engines."""
    return df.withColumns({f.name: F.round(f.name, digits) for f in df.schema.fields
                           if isinstance(f.dataType, DoubleType)}) \
        if any(isinstance(f.dataType, DoubleType) for f in df.schema.fields) else df


def query(name: str, sql: str | None = None):
    """Register a query, and its SQL when there is one; months and dates are read as UTC."""
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            ensure_shared_folder(spark)
            return rounded(fn(spark, sf_dir))
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run
    return register


def sql_list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


SQL_SKILLS = """sk AS (
  SELECT l_orderkey, list_sort(list(DISTINCT s)) AS skills
  FROM (SELECT l_orderkey, unnest([lower(p_type), lower(p_brand)]) AS s FROM lineitem JOIN part ON l_partkey = p_partkey)
  GROUP BY l_orderkey)"""

SQL_POSTINGS = SQL_SKILLS + f""", p0 AS (
  SELECT o_orderkey AS k, CASE WHEN o_orderkey % 2 = 0 THEN 'src_a' ELSE 'src_b' END AS source, o_orderdate AS day,
    lower(c_mktsegment || ' ' || o_orderpriority) AS title_norm, lower(c_name) AS company_norm,
    lower(n_name) AS location_raw, lower(r_name) AS region, c_name, n_name, r_name, c_mktsegment, o_orderpriority,
    o_orderstatus,
    CASE o_orderstatus WHEN 'F' THEN 'remote' WHEN 'O' THEN 'onsite' ELSE 'unknown' END AS remote_type,
    coalesce(sk.skills, []) AS skills,
    strftime(o_orderdate, '%Y%m') || CASE WHEN day(o_orderdate) <= 15 THEN 'a' ELSE 'b' END AS bronze_run_id,
    strftime(o_orderdate + INTERVAL 1 DAY, '%Y-%m-%d') AS bronze_ingest_date,
    {sql_list(TITLES)}[CAST(o_orderkey % {len(TITLES)} AS INTEGER) + 1] AS title_raw,
    lower(c_name) || {sql_list(ENDINGS)}[CAST(c_custkey % 3 AS INTEGER) + 1] AS company_legal,
    CASE o_orderkey % 5 WHEN 0 THEN lower(n_name) || ', ' || lower(r_name) WHEN 1 THEN lower(r_name) WHEN 2 THEN ''
      WHEN 3 THEN lower(n_name) || ', world' ELSE lower(n_name) END AS place
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey LEFT JOIN sk ON l_orderkey = o_orderkey),
p AS (
  SELECT *, sha256(source || '|id|' || CAST(k AS VARCHAR)) AS job_id,
    CASE WHEN k % 97 <> 0 THEN strftime(day, '%Y-%m') ELSE substr(bronze_ingest_date, 1, 7) END AS posted_month,
    CASE WHEN k % 97 <> 0 THEN strftime(day, '%Y-%m') END AS strict_month,
    CASE WHEN k % 97 <> 0 THEN 'posted' ELSE 'ingest_fallback' END AS time_axis
  FROM p0)"""

SQL_FACTS = SQL_POSTINGS + """,
prof AS (
  SELECT source, posted_month, bronze_run_id AS run_id, max(bronze_ingest_date) AS bronze_ingest_date,
    CASE WHEN count(DISTINCT time_axis) = 1 THEN max(time_axis) ELSE 'mixed' END AS time_axis
  FROM p GROUP BY ALL),
f_role AS (
  SELECT source, posted_month, bronze_run_id AS run_id, title_norm AS role, count(*) AS job_count FROM p GROUP BY ALL),
f_loc AS (
  SELECT source, posted_month, bronze_run_id AS run_id, location_raw AS location, count(*) AS job_count FROM p
  GROUP BY ALL),
f_emp AS (
  SELECT source, posted_month, bronze_run_id AS run_id, company_norm AS company_name, count(*) AS job_count FROM p
  GROUP BY ALL),
f_skill AS (
  SELECT source, posted_month, run_id, skill, count(DISTINCT job_id) AS job_count
  FROM (SELECT source, posted_month, bronze_run_id AS run_id, job_id, unnest(skills) AS skill FROM p) GROUP BY ALL),
newest AS (SELECT source, posted_month, max(run_id) AS run_id FROM f_role GROUP BY ALL),
win AS (SELECT * FROM newest WHERE posted_month BETWEEN '2001-07' AND '2001-08')"""


def sql(ctes: str, select: str) -> str:
    return f"WITH {ctes}\n{select}"
