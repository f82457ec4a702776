"""F queries: market views over the facts of the fixture postings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from vacancy_lake.functions import rules as R
from vacancy_lake.operators import audit as AU, metrics as M, quantiles as Q
from vacancy_lake.operators.facts import assign_month, month_profile, resolve_run, run_summary
from vacancy_lake.plans import views as V

from . import fixtures as fx
from .base import SQL_FACTS, SQL_POSTINGS, query, sql

KEYS = list(V.KEYS)


def _facts(spark, d, skills=False):
    return fx.published(spark, d)


def _role(spark, d):
    return _facts(spark, d)["role_demand_monthly"]


def _loc(spark, d):
    return _facts(spark, d)["location_demand_monthly"]


def _emp(spark, d):
    return _facts(spark, d)["company_hiring_monthly"]


def _skill(spark, d):
    return _facts(spark, d, True)["skill_demand_monthly"]


def _pointer(spark, d):
    """Newest run of each source by the rule the pointer is published under."""
    return resolve_run(fx.postings(spark, d, False))


POINTER = """ptr AS (SELECT source, max_by(bronze_run_id, bronze_ingest_date || bronze_run_id) AS run_id FROM p
  GROUP BY source)"""


@query("f01_latest_only", sql(SQL_FACTS + ", " + POINTER, """
SELECT source, posted_month, run_id, role, job_count FROM f_role JOIN ptr USING (source, run_id)"""))
def f01(spark, d):
    return V.latest_only(_role(spark, d), _pointer(spark, d)).select(*KEYS, "role", "job_count")


@query("f02_latest_per_month", sql(SQL_FACTS, """
SELECT source, posted_month, run_id, role, job_count FROM f_role JOIN win USING (source, posted_month, run_id)"""))
def f02(spark, d):
    return V.latest_per_month(_role(spark, d), fx.AS_OF).select(*KEYS, "role", "job_count")


@query("f03_silver_base", sql(SQL_FACTS, """
SELECT source, job_id, posted_month, title_norm, company_norm, location_raw, remote_type, bronze_run_id, time_axis
FROM p WHERE posted_month IN (SELECT posted_month FROM win)
  AND (source, posted_month) IN (SELECT (source, posted_month) FROM win)"""))
def f03(spark, d):
    df = fx.postings(spark, d, False)
    months = V.latest_runs(_role(spark, d), fx.AS_OF)
    return V.silver_base(df, months).select("source", "job_id", "posted_month", "title_norm", "company_norm",
                                            "location_raw", "remote_type", "bronze_run_id", "time_axis")


@query("f03_silver_base_strict", sql(SQL_FACTS, """
SELECT source, job_id, strict_month AS posted_month, title_norm FROM p
WHERE (source, strict_month) IN (SELECT (source, posted_month) FROM newest)"""))
def f03_strict(spark, d):
    df = fx.postings(spark, d, False)
    months = V.latest_runs(_role(spark, d))
    return V.silver_base(df, months, fallback=False).select("source", "job_id", "posted_month", "title_norm")


@query("f04_skills_long", sql(SQL_POSTINGS, """
SELECT source, job_id, posted_month, unnest(skills) AS skill_token FROM p"""))
def f04(spark, d):
    return V.skills_long(assign_month(fx.postings(spark, d))).select("source", "job_id", "posted_month", "skill_token")


def _kpi_sql(runs: str) -> str:
    return f""", rr AS (SELECT f.* FROM f_role f JOIN {runs} USING (source, posted_month, run_id)),
ll AS (SELECT f.*, sum(job_count) OVER w AS tot, row_number() OVER (w ORDER BY job_count DESC, location) AS rn
  FROM f_loc f JOIN {runs} USING (source, posted_month, run_id) WINDOW w AS (PARTITION BY source, posted_month, run_id)),
ee AS (SELECT f.*, sum(job_count) OVER (PARTITION BY source, posted_month, run_id) AS tot
  FROM f_emp f JOIN {runs} USING (source, posted_month, run_id)),
ss AS (SELECT f.*, sum(job_count) OVER w AS tot, row_number() OVER (w ORDER BY job_count DESC, skill) AS rn
  FROM f_skill f JOIN {runs} USING (source, posted_month, run_id)
  WINDOW w AS (PARTITION BY source, posted_month, run_id)),
r1 AS (SELECT source, posted_month, run_id, sum(job_count) AS tot, max(job_count) AS top, count(*) AS n FROM rr GROUP BY ALL),
l1 AS (SELECT source, posted_month, run_id, sum(job_count) AS tot, max(job_count) AS top, count(*) AS n,
  sum(job_count) FILTER (rn <= 3) AS top3, sum(pow(CAST(job_count AS DOUBLE) / tot, 2)) AS hhi FROM ll GROUP BY ALL),
e1 AS (SELECT source, posted_month, run_id, sum(pow(CAST(job_count AS DOUBLE) / tot, 2)) AS hhi FROM ee GROUP BY ALL),
s1 AS (SELECT source, posted_month, run_id, sum(job_count) AS tot, count(*) AS n, sum(job_count) FILTER (rn <= 5) AS top5,
  sum(pow(CAST(job_count AS DOUBLE) / tot, 2)) AS hhi FROM ss GROUP BY ALL),
m1 AS (SELECT source, strict_month AS posted_month, avg(CASE WHEN remote_type <> 'unknown' THEN 1.0 ELSE 0.0 END) AS known
  FROM p GROUP BY ALL),
a1 AS (SELECT source, run_id, count(DISTINCT posted_month) AS months FROM rr GROUP BY ALL)"""


KPI_SELECT = """SELECT r1.source, r1.posted_month, r1.run_id, months AS active_posted_months,
  CAST(r1.tot AS BIGINT) AS total_postings, CAST(coalesce(l1.tot, 0) AS BIGINT) AS located_postings,
  round(l1.top3 / l1.tot, 9) AS top3_location_share, round(l1.top / l1.tot, 9) AS top1_location_share,
  round(l1.hhi, 9) AS location_hhi, round(e1.hhi, 9) AS company_hhi, round(r1.top / r1.tot, 9) AS top1_role_share,
  round(s1.hhi, 9) AS skill_tag_hhi, s1.n AS distinct_skill_tags, l1.n AS distinct_location_buckets,
  r1.n AS distinct_role_title_buckets, CAST(1 AS BIGINT) AS distinct_role_groups,
  round(s1.top5 / s1.tot, 9) AS top5_skill_tag_share, round(m1.known, 9) AS remote_classified_share,
  CAST(1.0 AS DOUBLE) AS unknown_role_group_share
FROM r1 JOIN a1 USING (source, run_id) LEFT JOIN l1 USING (source, posted_month, run_id)
LEFT JOIN e1 USING (source, posted_month, run_id) LEFT JOIN s1 USING (source, posted_month, run_id)
LEFT JOIN m1 USING (source, posted_month)"""


def _kpi(spark, d, pick):
    f = {t: pick(x) for t, x in fx.published(spark, d).items()}
    return V.kpi_slice(f["role_demand_monthly"], f["location_demand_monthly"], f["company_hiring_monthly"],
                       f["skill_demand_monthly"], V.classify_roles(f["role_demand_monthly"]),
                       fx.postings(spark, d, False))


@query("f05_kpi_slice", sql(SQL_FACTS + _kpi_sql("newest"), KPI_SELECT))
def f05(spark, d):
    """All months, newest run of each."""
    runs = V.latest_runs(_role(spark, d))
    return _kpi(spark, d, lambda f: V.restrict(f, runs))


@query("f05_kpi_slice_window", sql(SQL_FACTS + _kpi_sql("win"), KPI_SELECT))
def f05_window(spark, d):
    """Rolling window of two months, newest run of each."""
    runs = V.latest_runs(_role(spark, d), fx.AS_OF)
    return _kpi(spark, d, lambda f: V.restrict(f, runs, fx.AS_OF))


@query("f05_kpi_slice_pointer", sql(SQL_FACTS + ", " + POINTER + _kpi_sql(
    "(SELECT DISTINCT source, posted_month, run_id FROM f_role JOIN ptr USING (source, run_id))"), KPI_SELECT))
def f05_pointer(spark, d):
    """The pointed-to run of each source, whatever months it holds."""
    ptr = _pointer(spark, d)
    return _kpi(spark, d, lambda f: V.latest_only(f, ptr))


@query("f06_hhi", sql(SQL_FACTS, """
SELECT source, posted_month, run_id, round(sum(job_count * job_count) / pow(sum(job_count), 2), 9) AS hhi
FROM f_emp GROUP BY ALL"""))
def f06(spark, d):
    return M.hhi(_emp(spark, d), KEYS)


@query("f07_topk_share", sql(SQL_FACTS, """
SELECT source, posted_month, run_id, round(sum(job_count) FILTER (rn <= 5) / sum(job_count), 9) AS topk_share
FROM (SELECT *, row_number() OVER (PARTITION BY source, posted_month, run_id ORDER BY job_count DESC, location) AS rn
  FROM f_loc) GROUP BY ALL"""))
def f07(spark, d):
    return M.topk_share(_loc(spark, d), KEYS, "location", 5)


@query("f08_work_mode_share", sql(SQL_FACTS, """
SELECT n.source, n.posted_month,
  round(avg(CASE WHEN p.job_id IS NULL THEN NULL WHEN remote_type <> 'unknown' THEN 1.0 ELSE 0.0 END), 9)
    AS remote_classified_share
FROM (SELECT DISTINCT source, posted_month FROM newest) n
LEFT JOIN p ON p.source = n.source AND p.strict_month = n.posted_month GROUP BY ALL"""))
def f08(spark, d):
    df = fx.postings(spark, d, False)
    months = _role(spark, d).select("source", "posted_month").distinct()
    return V.work_mode_share(df, months)


def _family_case(column: str) -> str:
    """The family rules as SQL; word boundaries are ASCII there, and so are the fixture titles."""
    cases = "\n".join(f"    WHEN regexp_matches({column}, '(?i){p}') THEN '{n}'" for n, p in R.ROLE_FAMILIES)
    return f"CASE WHEN {column} = '' THEN 'unknown_other'\n{cases}\n    ELSE 'unknown_other' END"


def _clean_title_sql(column: str) -> str:
    out = f"lower(trim({column}))"
    for p, n in R.ROLE_NOISE:
        out = f"regexp_replace({out}, '{p}', '{n}', 'g')"
    edge = r"[, .;:|\\/-]+"
    return f"trim(regexp_replace(regexp_replace(trim({out}), '^{edge}', ''), '{edge}$', ''))"


RAW_ROLES = f"""raw_role AS (
  SELECT source, posted_month, bronze_run_id AS run_id, lower(regexp_replace(trim(title_raw), '\\s+', ' ', 'g')) AS role,
    count(*) AS job_count FROM p GROUP BY ALL),
cls0 AS (SELECT *, {_clean_title_sql('role')} AS t FROM raw_role),
cls AS (SELECT source, posted_month, run_id, role AS raw_role, CASE WHEN t = '' THEN '(empty title)' ELSE t END
    AS cleaned_role_title, {_family_case('t')} AS normalized_role_group, job_count FROM cls0)"""


def _classified(spark, d):
    df = fx.postings(spark, d, False)
    return V.classify_roles(fx.facts(df.withColumn("title_norm", F.col("title_raw")))["role_demand_monthly"])


@query("f09_family_quality", sql(SQL_POSTINGS + ", " + RAW_ROLES, """
SELECT source, posted_month, run_id, count(DISTINCT normalized_role_group) AS distinct_role_groups,
  round(sum(CASE WHEN normalized_role_group = 'unknown_other' THEN job_count ELSE 0 END) / sum(job_count), 9)
    AS unknown_role_group_share FROM cls GROUP BY ALL"""))
def f09(spark, d):
    return V.family_quality(_classified(spark, d))


def _top_other_sql(fact: str, dim: str, n: int, keys: str, label: str, other: str) -> str:
    return f"""
SELECT {keys}, posted_month, {label}, CAST(job_count AS BIGINT) AS job_count FROM (
  SELECT {keys}, max(posted_month) AS posted_month, CASE WHEN rn <= {n} THEN {dim} ELSE '{other}' END AS {label},
    sum(job_count) AS job_count
  FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY job_count DESC, {dim}) AS rn
    FROM (SELECT {keys}, {dim}, sum(job_count) AS job_count, max(posted_month) AS posted_month FROM {fact} GROUP BY {keys}, {dim}))
  GROUP BY {keys}, CASE WHEN rn <= {n} THEN {dim} ELSE '{other}' END)"""


@query("f10_top_n_other_locations", sql(SQL_FACTS, _top_other_sql("f_loc", "location", 15, "source, run_id",
                                                                  "location_label", "Other")))
def f10(spark, d):
    return V.location_top_other(_loc(spark, d), 15)


@query("f10_top_n_other_employers", sql(SQL_FACTS, _top_other_sql("f_emp", "company_name", 12, "source, run_id",
                                                                  "label", "Other")))
def f10_employers(spark, d):
    return V.run_top_other(_emp(spark, d), "company_name", 12, ["source", "run_id"])


def _pareto_sql(src: str, keys: str, dim: str) -> str:
    return f"""
SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY job_count DESC, {dim}) AS pareto_rank,
  round(job_count / sum(job_count) OVER (PARTITION BY {keys}), 9) AS share_of_total,
  round(100.0 * sum(job_count) OVER (PARTITION BY {keys} ORDER BY job_count DESC, {dim}
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / sum(job_count) OVER (PARTITION BY {keys}), 9)
    AS cumulative_job_pct
FROM ({src})"""


@query("f11_role_pareto", sql(SQL_FACTS, _pareto_sql(
    "SELECT source, posted_month, run_id, role, job_count FROM f_role", "source, posted_month, run_id", "role")))
def f11(spark, d):
    return V.role_pareto(_role(spark, d))


@query("f11_employer_pareto", sql(SQL_FACTS, _pareto_sql(
    "SELECT source, company_name, CAST(sum(job_count) AS BIGINT) AS job_count FROM f_emp GROUP BY ALL", "source",
    "company_name")))
def f11_employers(spark, d):
    """One huge group per source: every employer of all months."""
    totals = _emp(spark, d).groupBy("source", "company_name").agg(F.sum("job_count").cast("long").alias("job_count"))
    return M.pareto(totals, ["source"], "company_name")


@query("f12_classify_roles", sql(SQL_POSTINGS + ", " + RAW_ROLES, "SELECT * FROM cls"))
def f12(spark, d):
    return _classified(spark, d)


@query("f13_family_demand", sql(SQL_POSTINGS + ", " + RAW_ROLES, """
SELECT source, posted_month, run_id, normalized_role_group AS role_group, CAST(sum(job_count) AS BIGINT) AS job_count
FROM cls GROUP BY ALL"""))
def f13(spark, d):
    return V.family_demand(_classified(spark, d))


@query("f13_family_pareto", sql(SQL_POSTINGS + ", " + RAW_ROLES, _pareto_sql(
    "SELECT source, run_id, normalized_role_group AS role_group, CAST(sum(job_count) AS BIGINT) AS job_count, "
    "max(posted_month) AS posted_month FROM cls GROUP BY ALL", "source, run_id", "role_group")))
def f13_pareto(spark, d):
    return V.family_pareto(_classified(spark, d))


EMPLOYERS = """emp0 AS (
  SELECT source, posted_month, bronze_run_id AS run_id,
    regexp_replace(company_legal, '(?i)\\s+(gmbh|ag)$', '') AS company_key FROM p),
emp AS (SELECT source, posted_month, run_id, company_key, count(*) AS job_count FROM emp0 GROUP BY ALL)"""


def _legal_employers(spark, d):
    df = fx.postings(spark, d, False).withColumn("company_norm", F.col("company_legal"))
    return fx.facts(df)["company_hiring_monthly"]


@query("f14_employers_top_month", sql(SQL_POSTINGS + ", " + EMPLOYERS, """
SELECT source, posted_month, run_id, CASE WHEN rn <= 20 THEN company_key ELSE '__LONG_TAIL__' END AS company_label,
  CAST(sum(job_count) AS BIGINT) AS job_count
FROM (SELECT *, row_number() OVER (PARTITION BY source, posted_month, run_id ORDER BY job_count DESC, company_key) AS rn
  FROM emp) GROUP BY ALL"""))
def f14(spark, d):
    return V.employers_top(_legal_employers(spark, d), 20)


@query("f14_employers_top_run", sql(SQL_POSTINGS + ", " + EMPLOYERS, _top_other_sql(
    "emp", "company_key", 50, "source, run_id", "company_label", "__LONG_TAIL__")))
def f14_run(spark, d):
    return V.employers_top(_legal_employers(spark, d), 50, ("source", "run_id"))


@query("f15_employer_labels", sql(SQL_POSTINGS, """
SELECT company_legal AS company_norm, CASE
  WHEN company_legal LIKE '% gmbh' THEN upper(substr(company_legal, 1, 1)) || replace(substr(company_legal, 2), ' gmbh', ' GmbH')
  WHEN company_legal LIKE '% ag' THEN upper(substr(company_legal, 1, 1)) || replace(substr(company_legal, 2), ' ag', ' AG')
  ELSE upper(substr(company_legal, 1, 1)) || substr(company_legal, 2) END AS company_label,
  count(*) AS job_count FROM p GROUP BY ALL"""))
def f15(spark, d):
    counts = fx.postings(spark, d, False).groupBy(F.col("company_legal").alias("company_norm")).agg(
        F.count(F.lit(1)).alias("job_count"))
    return V.employer_labels(counts.withColumn("company_label", F.col("company_norm"))).select(
        "company_norm", "company_label", "job_count")


@query("f16_fact_grain", sql(SQL_FACTS + ", " + POINTER, """
SELECT source, posted_month, run_id, company_name, job_count FROM f_emp JOIN ptr USING (source, run_id)"""))
def f16(spark, d):
    return V.fact_grain(V.latest_only(_emp(spark, d), _pointer(spark, d)), "company_name")


@query("f16_skill_grain", sql(SQL_FACTS, """
SELECT source, posted_month, run_id, skill, job_count FROM f_skill JOIN newest USING (source, posted_month, run_id)"""))
def f16_skill(spark, d):
    return V.fact_grain(V.restrict(_skill(spark, d), V.latest_runs(_role(spark, d))), "skill")


def _box_sql(rows: str, keys: str, v: str) -> str:
    return f"""SELECT {keys}, n, q25, q50, q75, min(v) FILTER (v BETWEEN q25 - 1.5 * (q75 - q25) AND q75 + 1.5 * (q75 - q25)) AS low,
  max(v) FILTER (v BETWEEN q25 - 1.5 * (q75 - q25) AND q75 + 1.5 * (q75 - q25)) AS high FROM (
  SELECT *, max(CASE WHEN rn = greatest(1, ceil(0.25 * n)) THEN v END) OVER w AS q25,
    max(CASE WHEN rn = greatest(1, ceil(0.5 * n)) THEN v END) OVER w AS q50,
    max(CASE WHEN rn = greatest(1, ceil(0.75 * n)) THEN v END) OVER w AS q75 FROM (
    SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY v) AS rn, count(*) OVER (PARTITION BY {keys}) AS n FROM (
      SELECT {keys}, CAST({v} AS DOUBLE) AS v FROM {rows})) WINDOW w AS (PARTITION BY {keys})) GROUP BY ALL"""


@query("f16_box_plot", sql(SQL_FACTS, _box_sql("f_emp", "source, posted_month", "job_count")))
def f16_box(spark, d):
    """Postings per employer and half-month run: quartiles and whiskers of each month."""
    return Q.box_plot(_emp(spark, d), ["source", "posted_month"], "job_count", small_groups=True)


@query("f16_box_plot_prices", _box_sql("lineitem", "l_returnflag, l_linestatus", "l_extendedprice"))
def f16_box_prices(spark, d):
    """A few groups of many different values, as a measure with a unit has."""
    return Q.box_plot(fx.table(spark, d, "lineitem"), ["l_returnflag", "l_linestatus"], "l_extendedprice", small_groups=True)


@query("f17_location_month", sql(SQL_FACTS, """
SELECT location AS location_label, posted_month, job_count, run_id, source FROM f_loc
JOIN newest USING (source, posted_month, run_id)"""))
def f17(spark, d):
    return V.location_month(V.latest_per_month(_loc(spark, d)))


@query("f17_location_month_wide", sql(SQL_FACTS, """
SELECT source, run_id, location AS location_label,
  CAST(sum(job_count) FILTER (posted_month = '2001-06') AS BIGINT) AS "2001-06",
  CAST(sum(job_count) FILTER (posted_month = '2001-07') AS BIGINT) AS "2001-07" FROM f_loc GROUP BY ALL"""))
def f17_wide(spark, d):
    return V.location_month(_loc(spark, d), ["2001-06", "2001-07"])


@query("f18_location_share", sql(SQL_FACTS, """
SELECT source, posted_month, run_id, location AS location_label, job_count AS location_job_count,
  round(job_count / sum(job_count) OVER (PARTITION BY source, posted_month, run_id), 9) AS location_share_of_monthly_total
FROM f_loc JOIN newest USING (source, posted_month, run_id)"""))
def f18(spark, d):
    return V.location_share(V.latest_per_month(_loc(spark, d)))


GEO = """geo AS (
  SELECT *, CASE WHEN place = '' THEN 'unmapped' WHEN k % 5 = 1 THEN region WHEN k % 5 = 0 THEN region
    ELSE region END AS state_name FROM p)"""


def _geo(spark, d, skills=False):
    df = fx.postings(spark, d, skills).withColumn("location_raw", F.col("place"))
    return V.geo_states(assign_month(df), fx.PLACES)


@query("f19_geo_states", sql(SQL_POSTINGS + ", " + GEO, "SELECT job_id, place AS location_raw, state_name FROM geo"))
def f19(spark, d):
    return _geo(spark, d).select("job_id", "location_raw", "state_name")


@query("f20_geo_state_monthly", sql(SQL_POSTINGS + ", " + GEO, """
SELECT source, posted_month, state_name, max(bronze_run_id) AS latest_bronze_run_id, count(*) AS job_count,
  CASE state_name WHEN 'middle east' THEN 'Middle East' ELSE upper(substr(state_name, 1, 1)) || substr(state_name, 2) END
    AS state_name_display, 'World' AS country,
  CASE WHEN state_name LIKE 'unmapped%' THEN NULL WHEN state_name = 'middle east' THEN 'Middle East'
    ELSE upper(substr(state_name, 1, 1)) || substr(state_name, 2) END AS state_geo
FROM geo GROUP BY source, posted_month, state_name"""))
def f20(spark, d):
    return V.geo_state_monthly(_geo(spark, d), "World")


HEATMAP = sql(SQL_POSTINGS + ", " + GEO + """,
lng AS (SELECT source, posted_month, bronze_run_id, job_id, state_name, unnest(skills) AS s FROM geo
  WHERE state_name NOT LIKE 'unmapped%'),
rk AS (SELECT source, posted_month, s, row_number() OVER (PARTITION BY source, posted_month ORDER BY count(*) DESC, s) AS rn
  FROM lng GROUP BY source, posted_month, s)""", """
SELECT source, posted_month, state_name AS dim_x, CASE WHEN rn <= 15 THEN s ELSE 'Other' END AS dim_y,
  max(bronze_run_id) AS latest_bronze_run_id, count(DISTINCT job_id) AS job_count
FROM lng JOIN rk USING (source, posted_month, s) GROUP BY ALL""")


@query("f21_heatmap", HEATMAP)
def f21(spark, d):
    return V.heatmap(_geo(spark, d, True), 15)


@query("f21_heatmap_snapshot", HEATMAP)
def f21_snapshot(spark, d):
    """The same on a base known to hold one row per posting."""
    return V.heatmap(_geo(spark, d, True), 15, unique=True)


def _edge_sql(rows: str, src: str, dst: str) -> str:
    return f"""
SELECT source, posted_month, {src} AS source_bucket, {dst} AS target_bucket, count(*) AS edge_weight,
  max(bronze_run_id) AS latest_bronze_run_id FROM {rows} GROUP BY ALL"""


def _rank_sql(name: str, rows: str, dim: str) -> str:
    return f"""{name} AS (SELECT source, posted_month, {dim},
  row_number() OVER (PARTITION BY source, posted_month ORDER BY count(*) DESC, {dim}) AS {name}_rn
  FROM {rows} GROUP BY source, posted_month, {dim})"""


@query("f22_flow_state_employer", sql(
    SQL_POSTINGS + ", " + GEO + ", g2 AS (SELECT * FROM geo WHERE state_name NOT LIKE 'unmapped%'), "
    + _rank_sql("er", "g2", "company_norm"),
    _edge_sql("g2 JOIN er USING (source, posted_month, company_norm)", "state_name",
              "CASE WHEN er_rn <= 10 THEN company_norm ELSE 'Other' END")))
def f22(spark, d):
    return V.flow_state_employer(_geo(spark, d), 10)


@query("f23_flow_location_employer", sql(
    SQL_POSTINGS + """, g3 AS (SELECT *, CASE WHEN place = '' THEN '(unknown location)'
  ELSE split_part(place, ',', 1) END AS pl FROM p), """ + _rank_sql("er", "g3", "company_norm") + ", "
    + _rank_sql("lr", "g3", "pl"),
    _edge_sql("g3 JOIN er USING (source, posted_month, company_norm) JOIN lr USING (source, posted_month, pl)",
              "CASE WHEN lr_rn <= 10 THEN pl ELSE 'Other (locations)' END",
              "CASE WHEN er_rn <= 10 THEN company_norm ELSE 'Other (employers)' END")))
def f23(spark, d):
    return V.flow_location_employer(_geo(spark, d), 10)


@query("f24_source_month_totals", sql(SQL_FACTS, """
SELECT CASE source WHEN 'src_a' THEN 'A' ELSE source END AS region_label, source, posted_month, run_id,
  CAST(sum(job_count) AS BIGINT) AS total_postings FROM f_role GROUP BY ALL"""))
def f24(spark, d):
    return V.source_month_totals(_role(spark, d), {"src_a": "A"})


@query("f25_skill_mix", sql(SQL_FACTS, """
SELECT source AS region_label, source, posted_month, run_id, skill, job_count AS skill_tag_count,
  round(job_count / sum(job_count) OVER (PARTITION BY source, posted_month, run_id), 9) AS share_within_region_skill_tags
FROM f_skill"""))
def f25(spark, d):
    return V.skill_mix(_skill(spark, d))


@query("f26_coverage_funnel", sql(SQL_POSTINGS + """, c AS (
  SELECT source, posted_month, max(bronze_run_id) AS bronze_run_id, count(*) AS n1,
    count_if(place NOT IN ('', 'asia')) AS n2, count_if(place NOT IN ('', 'asia') AND len(skills) > 0) AS n3,
    count_if(place NOT IN ('', 'asia') AND len(skills) > 0 AND remote_type <> 'unknown') AS n4
  FROM p GROUP BY ALL)""", """
SELECT source, posted_month, bronze_run_id, 'data_coverage' AS funnel_kind, stage_order, stage_name, stage_description,
  CAST(CASE stage_order WHEN 1 THEN n1 WHEN 2 THEN n2 WHEN 3 THEN n3 ELSE n4 END AS BIGINT) AS job_count
FROM c CROSS JOIN (VALUES """ + ", ".join(f"(CAST({i} AS INTEGER), '{n}', '{t}')" for i, (n, t) in enumerate(V.FUNNEL, 1))
    + ") AS v(stage_order, stage_name, stage_description)"))
def f26(spark, d):
    df = assign_month(fx.postings(spark, d)).withColumn("location_raw", F.col("place"))
    return V.coverage_funnel(df, "asia")


@query("f27_radar_profile", sql(SQL_POSTINGS + ", " + GEO + """,
w AS (SELECT source, posted_month, max(bronze_run_id) AS bronze_run_id, count(*) AS n,
    avg(CASE WHEN remote_type <> 'unknown' THEN 1.0 ELSE 0.0 END) AS remote_classified_share,
    avg(CASE WHEN len(skills) > 0 THEN 1.0 ELSE 0.0 END) AS skill_tagged_share,
    avg(CASE WHEN place NOT IN ('', 'asia') THEN 1.0 ELSE 0.0 END) AS location_subnational_share FROM geo GROUP BY ALL),
s3 AS (SELECT source, posted_month, sum(c) FILTER (rn <= 3) AS top FROM (
  SELECT source, posted_month, count(*) AS c, row_number() OVER (PARTITION BY source, posted_month
    ORDER BY count(*) DESC, state_name) AS rn FROM geo GROUP BY source, posted_month, state_name) GROUP BY ALL),
e5 AS (SELECT source, posted_month, sum(c) FILTER (rn <= 5) AS top FROM (
  SELECT source, posted_month, count(*) AS c, row_number() OVER (PARTITION BY source, posted_month
    ORDER BY count(*) DESC, company_norm) AS rn FROM geo GROUP BY source, posted_month, company_norm) GROUP BY ALL)""", """
SELECT w.source, w.posted_month, bronze_run_id, 'fixture_market' AS profile_name, axis_name,
  round(CASE axis_name WHEN 'remote_classified_share' THEN remote_classified_share
    WHEN 'skill_tagged_share' THEN skill_tagged_share WHEN 'location_subnational_share' THEN location_subnational_share
    WHEN 'geography_top3_state_share' THEN s3.top / n ELSE e5.top / n END, 9) AS axis_value, axis_description
FROM w JOIN s3 USING (source, posted_month) JOIN e5 USING (source, posted_month) CROSS JOIN (VALUES """
    + ", ".join(f"('{a}', '{t}')" for a, t in V.RADAR.items()) + ") AS v(axis_name, axis_description)"))
def f27(spark, d):
    return V.radar_profile(_geo(spark, d, True), "fixture_market", "asia")


COMMON = """common AS (SELECT posted_month FROM win GROUP BY 1 HAVING count(DISTINCT source) = 2),
last_common AS (SELECT max(posted_month) AS posted_month FROM common)"""


@query("f28_common_months", sql(SQL_FACTS, """
SELECT posted_month FROM newest GROUP BY 1 HAVING count(DISTINCT source) = 2"""))
def f28(spark, d):
    return V.common_months(V.latest_runs(_role(spark, d)), fx.SOURCES)


@query("f28_latest_common_month", sql(SQL_FACTS + ", " + COMMON, "SELECT posted_month FROM last_common"))
def f28_latest(spark, d):
    return V.latest_common_month(V.latest_runs(_role(spark, d), fx.AS_OF), fx.SOURCES)


@query("f29_hhi_common_months", sql(SQL_FACTS + ", " + COMMON, """
SELECT source, posted_month, run_id, round(sum(job_count * job_count) / pow(sum(job_count), 2), 9) AS location_hhi,
  'strict_common_month' AS layer_scope, true AS month_in_strict_intersection
FROM f_loc JOIN win USING (source, posted_month, run_id) JOIN common USING (posted_month) GROUP BY ALL"""))
def f29(spark, d):
    runs = V.latest_runs(_role(spark, d), fx.AS_OF)
    return V.hhi_common_months(_loc(spark, d), runs, fx.SOURCES, fx.AS_OF)


@query("f30_skill_mix_aligned", sql(SQL_FACTS + ", " + COMMON + """,
mx AS (SELECT source, posted_month, run_id, skill, job_count FROM f_skill JOIN win USING (source, posted_month, run_id)
  JOIN last_common USING (posted_month)),
top AS (SELECT skill FROM mx GROUP BY skill ORDER BY sum(job_count) DESC, skill LIMIT 20)""", """
SELECT source, posted_month, run_id, skill, job_count AS skill_tag_count,
  round(job_count / sum(job_count) OVER (PARTITION BY source), 9) AS share_within_source_skill_tags,
  'strict_intersection_latest_month' AS alignment_kind FROM mx WHERE skill IN (SELECT skill FROM top)"""))
def f30(spark, d):
    runs = V.latest_runs(_role(spark, d), fx.AS_OF)
    return V.skill_mix_aligned(_skill(spark, d), runs, fx.SOURCES, 20, fx.AS_OF)


@query("f31_benchmark", sql(SQL_FACTS + ", " + COMMON + """,
h AS (SELECT source, posted_month, run_id, sum(job_count * job_count) / pow(sum(job_count), 2) AS hhi FROM f_skill
  JOIN win USING (source, posted_month, run_id) GROUP BY ALL)""", """
SELECT source, posted_month AS aligned_posted_month, run_id, CAST(sum(job_count) AS BIGINT) AS total_role_postings,
  round(max(hhi), 9) AS skill_tag_hhi, 'strict_intersection_latest_month' AS alignment_kind
FROM f_role JOIN win USING (source, posted_month, run_id) JOIN last_common USING (posted_month)
LEFT JOIN h USING (source, posted_month, run_id) GROUP BY source, posted_month, run_id"""))
def f31(spark, d):
    f = _facts(spark, d, True)
    runs = V.latest_runs(_role(spark, d), fx.AS_OF)
    return V.benchmark(f["role_demand_monthly"], f["skill_demand_monthly"], runs, fx.SOURCES, fx.AS_OF)


@query("f32_skills_per_job", sql(SQL_POSTINGS, """
SELECT source, job_id, posted_month, CAST(len(skills) AS BIGINT) AS skills_per_job, bronze_run_id AS run_id,
  '2001-07' AS time_axis FROM p WHERE posted_month = '2001-07' AND len(skills) > 0"""))
def f32(spark, d):
    return V.skills_per_job(V.skills_long(assign_month(fx.postings(spark, d))), "2001-07")


@query("f32_box_plot", sql(SQL_POSTINGS, _box_sql("(SELECT source, posted_month, len(skills) AS n_skills FROM p WHERE len(skills) > 0)", "source, posted_month", "n_skills")))
def f32_box(spark, d):
    """Skills per posting, as box plots of all months."""
    rows = assign_month(fx.postings(spark, d)).select("source", "posted_month", F.size("skills").alias("n_skills")).where("n_skills > 0")
    return Q.box_plot(rows, ["source", "posted_month"], "n_skills", small_groups=True)


@query("f32_summaries_merge", sql(SQL_POSTINGS, """
SELECT source, CAST(count(*) AS BIGINT) AS n, true AS within_rank_error FROM p WHERE len(skills) > 0 GROUP BY source"""))
def f32_summaries(spark, d):
    """Monthly summaries merged to one per source: the ranks of its quartiles, counted on the rows, are as close as stated."""
    rows = assign_month(fx.postings(spark, d)).select("source", "posted_month", F.size("skills").alias("v")).where("v > 0")
    merged = Q.merge_summaries(Q.summaries(rows, ["source", "posted_month"], "v"), ["source"])
    found = Q.quantiles_of(merged, ["source"])
    names = [(p, f"q{round(p * 100):02d}") for p in Q.QUARTILES]
    ranks = rows.join(F.broadcast(found), "source").groupBy("source", "n").agg(*[
        agg for _, q in names for agg in (F.count_if(F.col("v") < F.col(q)).alias(f"{q}_below"), F.count_if(F.col("v") <= F.col(q)).alias(f"{q}_upto"))])
    error = Q.rank_error(400)
    close = [(F.col(f"{q}_below") <= (p + error) * F.col("n")) & (F.col(f"{q}_upto") >= (p - error) * F.col("n")) for p, q in names]
    return ranks.select("source", "n", reduce(lambda x, y: x & y, close).alias("within_rank_error"))


@query("f33_reconcile", sql(SQL_FACTS + """,
g AS (SELECT source, posted_month, run_id FROM newest),
r AS (SELECT source, posted_month, run_id, sum(job_count) AS s, max(job_count) AS m, count(*) AS n FROM f_role
  JOIN g USING (source, posted_month, run_id) GROUP BY ALL),
l AS (SELECT source, posted_month, run_id, sum(job_count * job_count) / pow(sum(job_count), 2) AS h FROM f_loc GROUP BY ALL),
e AS (SELECT source, posted_month, run_id, sum(job_count * job_count) / pow(sum(job_count), 2) AS h FROM f_emp GROUP BY ALL)""",
    """SELECT source, posted_month, run_id, c AS "check", round(v, 9) AS expected, round(v, 9) AS actual, true AS ok FROM (
  SELECT source, posted_month, run_id, unnest(['total_postings', 'located_postings', 'located_within_total',
    'locations_with_other', 'employers_with_other', 'pareto_end', 'pareto_ranks', 'pareto_share_sum', 'location_hhi',
    'company_hhi', 'top1_role_share']) AS c,
    unnest([CAST(s AS DOUBLE), s, 0, s, s, 100, n, 1, l.h, e.h, m / s]) AS v
  FROM r JOIN l USING (source, posted_month, run_id) JOIN e USING (source, posted_month, run_id))"""))
def f33(spark, d):
    runs = V.latest_runs(_role(spark, d))
    f = {t: V.restrict(x, runs) for t, x in _facts(spark, d, True).items()}
    kpi = V.kpi_slice(f["role_demand_monthly"], f["location_demand_monthly"], f["company_hiring_monthly"],
                      f["skill_demand_monthly"])
    return AU.reconcile(
        f, kpi, V.location_top_other(f["location_demand_monthly"], 15, KEYS),
        M.top_n_other(f["company_hiring_monthly"], KEYS, "company_name", 12), V.role_pareto(f["role_demand_monthly"]))


@query("f33_reconcile_broken", sql(SQL_FACTS + """,
g AS (SELECT n.source, n.posted_month, n.run_id, CAST(sum(job_count) AS DOUBLE) AS t FROM newest n JOIN f_role USING (source, posted_month, run_id)
  GROUP BY ALL)""", """
SELECT source, posted_month, run_id, 'total_postings' AS "check", t AS expected, t + 1 AS actual, false AS ok FROM g
UNION ALL SELECT source, posted_month, run_id, 'employers_with_other', t, NULL, false FROM g"""))
def f33_broken(spark, d):
    """A KPI that counts one posting too many, and a view that lost its rows: both are reported."""
    runs = V.latest_runs(_role(spark, d))
    f = {t: V.restrict(x, runs) for t, x in _facts(spark, d, True).items()}
    kpi = V.kpi_slice(f["role_demand_monthly"], f["location_demand_monthly"], f["company_hiring_monthly"],
                      f["skill_demand_monthly"]).withColumn("total_postings", F.col("total_postings") + 1)
    out = AU.reconcile(
        f, kpi, V.location_top_other(f["location_demand_monthly"], 15, KEYS),
        M.top_n_other(f["company_hiring_monthly"], KEYS, "company_name", 12).where("false"), V.role_pareto(f["role_demand_monthly"]))
    return out.where(F.col("check").isin("total_postings", "employers_with_other"))


@query("f34_verify_publication", sql(SQL_FACTS + ", " + POINTER + """,
c AS (SELECT source, run_id, (SELECT count(*) FROM f_skill s WHERE s.source = ptr.source AND s.run_id = ptr.run_id) AS a,
    (SELECT count(*) FROM f_role s WHERE s.source = ptr.source AND s.run_id = ptr.run_id) AS b,
    (SELECT count(*) FROM prof s WHERE s.source = ptr.source AND s.run_id = ptr.run_id) AS c FROM ptr)""", """
SELECT source, run_id, a AS skill_demand_monthly_rows, b AS role_demand_monthly_rows, c AS pipeline_run_summary_rows,
  (c >= 1 AND (a >= 1 OR b >= 1)) AS published FROM c"""))
def f34(spark, d):
    df = fx.postings(spark, d)
    f = fx.published(spark, d)
    tables = {t: f[t] for t in ("skill_demand_monthly", "role_demand_monthly")}
    tables["pipeline_run_summary"] = run_summary(f, month_profile(df, F.col(fx.RUN)))
    return AU.verify_publication(tables, _pointer(spark, d))


@query("f35_ranked_display", sql(SQL_FACTS, """
SELECT source, posted_month, run_id, rank, value, label, CAST(NULL AS VARCHAR) AS original,
  CASE WHEN rank <= 12 THEN label END AS chart_label, job_count
FROM (SELECT *, company_name AS value, 'Customer#' || substr(company_name, 10) AS label,
    CAST(row_number() OVER (PARTITION BY source, posted_month, run_id ORDER BY job_count DESC, company_name) AS INTEGER)
      AS rank
  FROM f_emp) WHERE rank <= 20"""))
def f35(spark, d):
    return V.ranked_display(_emp(spark, d), "company_name", "company")


@query("f36_profile_json", """
SELECT 'k' AS key, count(json_extract(props, '$.k')) AS present, CAST(0 AS BIGINT) AS "null",
  CAST(0 AS BIGINT) AS empty_str, 'int' AS kinds FROM events""")
def f36(spark, d):
    out = AU.profile_json(fx.table(spark, d, "events"), "props")
    return out.withColumn("kinds", F.array_join("kinds", ","))


@query("f36_profile_payloads", sql(SQL_POSTINGS + """, n AS (SELECT count_if(k % 2 = 0) AS a, count_if(k % 2 = 1) AS b FROM p)""",
    """SELECT key, CAST(present AS BIGINT) AS present, CAST(0 AS BIGINT) AS "null", CAST(0 AS BIGINT) AS empty_str, kinds
FROM (SELECT unnest(['slug', 'url', 'company_name', 'tags', 'remote', 'created_at', 'title', 'description', 'location',
    'id', 'redirect_url', 'created', 'company', 'category', 'contract_time']) AS key,
  unnest([a, a, a, a, a, a, a + b, a + b, a + b, b, b, b, b, b, b]) AS present,
  unnest(['str', 'str', 'str', 'array', 'bool', 'int', 'str', 'str', 'object,str', 'str', 'str', 'str', 'object', 'object',
    'str']) AS kinds FROM n)"""))
def f36_payloads(spark, d):
    out = AU.profile_json(fx.payloads(spark, d), "raw_payload")
    return out.withColumn("kinds", F.array_join("kinds", ","))


def _title_sql(s: str) -> str:
    return f"array_to_string([upper(substr(r, 1, 1)) || substr(r, 2) for r in regexp_extract_all({s}, '[a-z]+|[^a-z]+')], '')"


def _hard_sql(s: str, n: int) -> str:
    return f"CASE WHEN length({s}) <= {n} THEN {s} ELSE substr({s}, 1, {n - 1}) || '…' END"


def _word_sql(s: str, n: int) -> str:
    word = f"regexp_replace(substr({s}, 1, {n - 1}), ' [^ ]*$', '')"
    return (f"CASE WHEN length({s}) <= {n} THEN {s} WHEN length({word}) < {n // 2} THEN substr({s}, 1, {n - 1}) || '…' "
            f"ELSE {word} || '…' END")


def _display_sql(fact: str, dim: str, shown: str, chart: str, raw: str | None = None) -> str:
    """Ranks, labels, and chart labels with numbers behind those that occur again in a month."""
    return sql(SQL_FACTS + f""",
r AS (SELECT source, posted_month, run_id, {dim} AS value, job_count, {_title_sql(raw or dim)} AS title,
    CAST(row_number() OVER (PARTITION BY source, posted_month, run_id ORDER BY job_count DESC, {dim}) AS INTEGER) AS rank FROM {fact}),
c AS (SELECT *, {shown} AS d FROM r WHERE rank <= {R.TABLE_TOP}),
e AS (SELECT *, CASE WHEN rank <= {R.CHART_TOP} THEN {chart} END AS ch FROM c),
n AS (SELECT *, row_number() OVER (PARTITION BY source, posted_month, run_id, ch ORDER BY rank) AS again FROM e)""", f"""
SELECT source, posted_month, run_id, rank, value, {_hard_sql('d', R.TABLE_LABEL_MAX)} AS label,
  CASE WHEN '{dim}' <> 'skill' AND lower(d) <> lower(value) THEN value END AS original,
  CASE WHEN ch <> '' AND again > 1 THEN ch || ' (' || again || ')' ELSE ch END AS chart_label, job_count FROM n""")


@query("f35_ranked_roles", _display_sql("f_role", "role", _word_sql("title", R.ROLE_LABEL_MAX), _word_sql("d", R.CHART_LABEL_MAX),
                                         "regexp_replace(role, ' *- *', ' - ', 'g')"))
def f35_roles(spark, d):
    return V.ranked_display(_role(spark, d), "role", "role")


@query("f35_ranked_locations", _display_sql("f_loc", "location", "title", _hard_sql("d", R.CHART_LABEL_MAX)))
def f35_locations(spark, d):
    return V.ranked_display(_loc(spark, d), "location", "location")


@query("f35_ranked_skills", _display_sql("f_skill", "skill", "title", _hard_sql("d", R.CHART_LABEL_MAX)))
def f35_skills(spark, d):
    return V.ranked_display(_skill(spark, d), "skill", "skill")
