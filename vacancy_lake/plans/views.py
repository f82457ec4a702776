"""Market views: every named question as a lazy function of facts, postings and a pointer.

Facts arrive restricted to the runs that count (`latest_only` or `latest_per_month`), so each view works for
any source and both run policies. Tables of one row per source, month or run are broadcast (see `metrics`).
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, GroupedData, functions as F

from ..functions import labels as L, rules as R
from ..functions.skills import skills_from_json
from ..functions.text import let, lits, lookup, squash, text
from ..functions.times import window_months
from ..operators import metrics as M
from ..operators.facts import assign_month

KEYS = ("source", "posted_month", "run_id")


# --- which rows count --------------------------------------------------------------------------------------

def latest_only(fact: DataFrame, latest: DataFrame, months: tuple[str, str] | None = None) -> DataFrame:
    """Rows of the pointed-to run of each source; the one-row side prunes run folders at run time."""
    if months:
        fact = fact.where(F.col("posted_month").between(*months))
    return fact.join(M.per_group(latest.select("source", "run_id")), ["source", "run_id"], "left_semi")


def latest_runs(fact: DataFrame, as_of: date | None = None) -> DataFrame:
    """Newest run per source and month, inside the rolling two-month window when `as_of` is given."""
    if as_of is not None:
        fact = fact.where(F.col("posted_month").between(*window_months(as_of)))
    # Distinct first: hash aggregation to a handful of rows, then the text maximum (which sorts) on those.
    return fact.select(*KEYS).distinct().groupBy("source", "posted_month").agg(F.max("run_id").alias("run_id"))


def restrict(fact: DataFrame, runs: DataFrame, as_of: date | None = None) -> DataFrame:
    """Fact rows of the chosen (source, month, run); the window is repeated as a literal so it prunes."""
    if as_of is not None:
        fact = fact.where(F.col("posted_month").between(*window_months(as_of)))
    return fact.join(M.per_group(runs.select(*KEYS)), list(KEYS), "left_semi")


def latest_per_month(fact: DataFrame, as_of: date | None = None) -> DataFrame:
    return restrict(fact, latest_runs(fact, as_of), as_of)


def silver_base(postings: DataFrame, months: DataFrame, fallback: bool = True) -> DataFrame:
    """Postings with their month, limited to the published months of their source."""
    return assign_month(postings, fallback).join(
        M.per_group(months.select("source", "posted_month").distinct()), ["source", "posted_month"], "left_semi")


def skills_array(df: DataFrame) -> Column:
    return F.col("skills") if dict(df.dtypes)["skills"] != "string" else skills_from_json("skills")


def skills_long(base: DataFrame) -> DataFrame:
    """One row per posting and non-blank skill."""
    skill = F.explode(skills_array(base)).alias("skill_token")
    keep = [c for c in base.columns if c != "skills"]
    return base.select(*keep, skill).withColumn("skill_token", F.btrim("skill_token")).where("skill_token <> ''")


# --- KPI slice ---------------------------------------------------------------------------------------------

_KINDS = {"role": "role", "loc": "location", "emp": "company_name", "skill": "skill"}


def kpi_slice(role: DataFrame, location: DataFrame, company: DataFrame, skill: DataFrame,
              families: DataFrame | None = None, postings: DataFrame | None = None) -> DataFrame:
    """One row of indicators per source, month and run.

    The four facts are tagged and put under each other: one aggregate gives sums, squares, maxima and counts of
    all of them, one limited ranking the few largest values. Only rows per month are joined.
    """
    keys, c = list(KEYS), F.col
    tagged = reduce(DataFrame.unionByName, [
        df.select(*keys, F.lit(kind).alias("kind"), c(dim).alias("value"), "job_count")
        for df, (kind, dim) in zip((role, location, company, skill), _KINDS.items())])
    stats = tagged.groupBy(*keys, "kind").agg(
        F.sum("job_count").cast("long").alias("sum"), F.max("job_count").alias("max"), F.count(F.lit(1)).alias("n"),
        M.hhi_of("job_count").alias("hhi"))
    out = stats.groupBy(*keys).agg(*[F.max(F.when(c("kind") == k, c(m))).alias(f"{k}_{m}")
                                     for k in _KINDS for m in ("sum", "max", "n", "hhi")]).where("role_sum IS NOT NULL")
    # Months of a run: at most the months of the calendar, so a window is safe here.
    out = out.withColumn("active_posted_months", F.count(F.lit(1)).over(M.W.partitionBy("source", "run_id")))
    ranked = M.first_k(tagged.where(c("kind").isin("loc", "skill")), [*keys, "kind"], [F.desc("job_count"), F.asc("value")], 5)
    best = ranked.groupBy(*keys).agg(
        F.sum(F.when((c("kind") == "loc") & (c("rank") <= 3), c("job_count"))).alias("loc_top3"),
        F.sum(F.when(c("kind") == "skill", c("job_count"))).alias("skill_top5"))
    out = out.join(best, keys, "left")
    if families is not None:
        out = out.join(family_quality(families), keys, "left")
    else:
        out = out.withColumns({"distinct_role_groups": F.lit(None).cast("long"),
                               "unknown_role_group_share": F.lit(None).cast("double")})
    if postings is not None:
        out = out.join(work_mode_rates(postings, role), ["source", "posted_month"], "left")
    else:
        out = out.withColumn("remote_classified_share", F.lit(None).cast("double"))
    return out.select(
        *keys, "active_posted_months", c("role_sum").alias("total_postings"),
        F.coalesce("loc_sum", F.lit(0).cast("long")).alias("located_postings"),
        M.share(c("loc_top3"), c("loc_sum")).alias("top3_location_share"),
        M.share(c("loc_max"), c("loc_sum")).alias("top1_location_share"),
        c("loc_hhi").alias("location_hhi"), c("emp_hhi").alias("company_hhi"),
        M.share(c("role_max"), c("role_sum")).alias("top1_role_share"), c("skill_hhi").alias("skill_tag_hhi"),
        c("skill_n").alias("distinct_skill_tags"), c("loc_n").alias("distinct_location_buckets"),
        c("role_n").alias("distinct_role_title_buckets"), "distinct_role_groups",
        M.share(c("skill_top5"), c("skill_sum")).alias("top5_skill_tag_share"), "remote_classified_share",
        "unknown_role_group_share")


def work_mode_rates(postings: DataFrame, months: DataFrame | None = None) -> DataFrame:
    """Share of postings whose work mode is known, per source and month of posting; of the given months only."""
    rows = postings if "posted_month" in postings.columns else assign_month(postings, fallback=False)
    if months is not None:  # one row per published slice
        rows = rows.join(M.per_group(months.select("source", "posted_month").distinct()), ["source", "posted_month"], "left_semi")
    known = F.avg(F.when(F.lower(F.btrim(text("remote_type"))) != "unknown", 1.0).otherwise(0.0))
    return rows.groupBy("source", "posted_month").agg(known.alias("remote_classified_share"))


def work_mode_share(postings: DataFrame, months: DataFrame) -> DataFrame:
    """The rate for each wanted month; NULL when a month has no posting."""
    return months.join(work_mode_rates(postings, months), ["source", "posted_month"], "left")


# --- roles -------------------------------------------------------------------------------------------------

def classify_roles(role: DataFrame, families=R.ROLE_FAMILIES) -> DataFrame:
    """Role facts with cleaned title and family; runs on distinct titles, which is what the fact holds."""
    cleaned = role.withColumn("_t", L.clean_role("role"))
    return cleaned.select(
        *KEYS, F.col("role").alias("raw_role"),
        F.when(F.col("_t") == "", R.EMPTY_TITLE).otherwise(F.col("_t")).alias("cleaned_role_title"),
        L.role_family(F.col("_t"), families).alias("normalized_role_group"), "job_count")


def family_demand(classified: DataFrame) -> DataFrame:
    return classified.groupBy(*KEYS, F.col("normalized_role_group").alias("role_group")).agg(
        F.sum("job_count").cast("long").alias("job_count"))


def family_quality(classified: DataFrame) -> DataFrame:
    """Distinct families and the share of postings no family rule covers."""
    group, n = F.col("normalized_role_group"), F.col("job_count")
    return classified.groupBy(*KEYS).agg(
        F.count_distinct(group).alias("distinct_role_groups"),
        M.share(F.sum(F.when(group == R.UNKNOWN_FAMILY, n).otherwise(0)), F.sum(n)).alias("unknown_role_group_share"))


def family_pareto(classified: DataFrame) -> DataFrame:
    """Pareto over families, months of a run summed. The domain is the rule list, so one window is fine."""
    totals = family_demand(classified).groupBy("source", "run_id", "role_group").agg(
        F.sum("job_count").cast("long").alias("job_count"), F.max("posted_month").alias("posted_month"))
    return M.pareto(totals, ["source", "run_id"], "role_group", bounded=True, small_groups=True)


def role_pareto(role: DataFrame) -> DataFrame:
    return M.pareto(role.select(*KEYS, "role", "job_count"), list(KEYS), "role", small_groups=True)


# --- employers and places ----------------------------------------------------------------------------------

def run_top_other(fact: DataFrame, dim: str, n: int, keys: Sequence[str], label: str = "label",
                  other: str = "Other") -> DataFrame:
    """Top n and the rest, with the newest month of each label when months are summed.

    The month travels as a date: a maximum of text can not be hash aggregated, one of dates can.
    """
    if "posted_month" in keys:
        return M.top_n_other(fact, list(keys), dim, n, label=label, other=other, small_groups=True)
    first_day = F.max(F.to_date(F.concat("posted_month", F.lit("-01"))))
    out = M.top_n_other(fact, list(keys), dim, n, label=label, other=other, carry={"posted_month": first_day},
                        small_groups=True)
    return out.withColumn("posted_month", F.date_format("posted_month", "yyyy-MM"))


def location_top_other(location: DataFrame, n: int = 15, keys: Sequence[str] = ("source", "run_id")) -> DataFrame:
    return run_top_other(location, "location", n, keys, "location_label")


def employers_top(company: DataFrame, n: int = 50, keys: Sequence[str] = KEYS) -> DataFrame:
    """Employers after name cleaning: the n largest and one long-tail row, per month or per run."""
    cleaned = company.withColumn("company_key", L.employer_key("company_name"))
    return run_top_other(cleaned, "company_key", n, keys, "company_label", R.LONG_TAIL)


def employer_labels(df: DataFrame, column: str = "company_label", overrides=R.EMPLOYER_OVERRIDES) -> DataFrame:
    return df.withColumn(column, L.employer_label(column, overrides))


def fact_grain(fact: DataFrame, dim: str) -> DataFrame:
    """Rows for histograms and box plots."""
    return fact.select(*KEYS, dim, "job_count")


def grain_summary(fact: DataFrame, accuracy: int = 10_000) -> DataFrame:
    """Five-number summary per month from mergeable sketches."""
    return fact.groupBy(*KEYS).agg(F.percentile_approx("job_count", [0.0, 0.25, 0.5, 0.75, 1.0], accuracy)
                                   .alias("quartiles"))


def location_month(location: DataFrame, pivot_months: Sequence[str] | None = None) -> DataFrame:
    """Location by month, long, or wide over a given list of months."""
    if pivot_months is None:
        return location.select(F.col("location").alias("location_label"), "posted_month", "job_count", "run_id",
                               "source")
    wide = location.groupBy("source", "run_id", F.col("location").alias("location_label"))
    return wide.pivot("posted_month", list(pivot_months)).agg(F.sum("job_count"))


def location_share(location: DataFrame) -> DataFrame:
    """Volume of a location and its share of the month."""
    return M.with_share(location, list(KEYS), name="location_share", small_groups=True).select(
        *KEYS, F.col("location").alias("location_label"), F.col("job_count").alias("location_job_count"),
        F.col("location_share").alias("location_share_of_monthly_total"))


def geo_states(base: DataFrame, places: R.PlaceRules = R.PlaceRules()) -> DataFrame:
    """State of each posting by rule; what no rule covers is named `unmapped...` by kind.

    Distinct spellings are few next to postings, yet the rules are plain expressions: no shuffle either way.
    """
    loc = F.lower(F.btrim(F.regexp_replace(squash(text("location_raw")), r",\s*", ",")))
    states = lits(places.states)
    common = {**places.cities, **places.geo_spellings}

    def state_of(p: Column, extra: dict[str, str], otherwise: str) -> Column:
        return F.coalesce(F.when(F.array_contains(states, p), p), lookup({**common, **extra}, p), F.lit(otherwise))

    def decide(segments: Column) -> Column:
        p1, p2 = F.btrim(F.get(segments, F.lit(0))), F.btrim(F.coalesce(F.get(segments, F.lit(1)), F.lit("")))
        pairs = [F.when((p1 == city) & (p2 == part[1:] if part.startswith("=") else p2.contains(part)), F.lit(state))
                 for city, part, state in places.geo_pairs]
        return F.coalesce(
            F.when(p2 == "", state_of(p1, places.geo_alone, "unmapped_single")),
            F.when(p2.isin(*places.country_forms), state_of(p1, places.geo_with_country, f"unmapped_state_{places.country}")),
            *pairs, F.when(F.array_contains(states, p2), p2), F.lit("unmapped_pair"))

    state = (F.when(loc == "", F.lit("unmapped")).when(loc == places.country, F.lit("unmapped_country"))
             .otherwise(let(F.split(loc, ","), decide)))
    return base.withColumn("state_name", state)


def per_run(rows: DataFrame, keys: Sequence[str], *measures: Column) -> GroupedData:
    """Measures per key and landing run, grouped by key again.

    The newest run id of a group is a text maximum, which makes Spark sort its input; counting per run first
    is hash aggregation over the rows and leaves that sort a few rows per key.
    """
    return rows.groupBy(*keys, "bronze_run_id").agg(*measures).groupBy(*keys)


def geo_state_monthly(geo: DataFrame, country: str = "India") -> DataFrame:
    """Postings per state and month with a display name; the map column is NULL for unmapped buckets."""
    counts = per_run(geo, ["source", "posted_month", "state_name"], F.count(F.lit(1)).alias("job_count")).agg(
        F.max("bronze_run_id").alias("latest_bronze_run_id"), F.sum("job_count").alias("job_count"))
    shown = F.initcap(F.replace("state_name", F.lit("_"), F.lit(" ")))
    return counts.withColumns({"state_name_display": shown, "country": F.lit(country),
                               "state_geo": F.when(~F.col("state_name").startswith("unmapped"), shown)})


def heatmap(geo: DataFrame, k: int = 15, unique: bool = False) -> DataFrame:
    """State by skill, distinct postings: the k most mentioned skills of a month, the rest together.

    The winners of a month form one small array row that meets the postings; each posting then names its
    buckets once, so nothing is joined per skill. `unique=True` says the base holds one row per job_id, as a
    snapshot does: counting rows replaces the distinct count and its shuffle by job_id.
    """
    month = ["source", "posted_month"]
    mapped = geo.where(~F.col("state_name").startswith("unmapped")).withColumn("_s", F.filter(F.transform(
        skills_array(geo), lambda s: F.lower(F.btrim(s))), lambda s: s != ""))
    mass = mapped.select(*month, F.explode("_s").alias("_t")).groupBy(*month, "_t").agg(F.count(F.lit(1)).alias("_n"))
    best = M.top_k(mass, month, "_t", k, "_n").groupBy(*month).agg(F.collect_list("_t").alias("_best"))
    buckets = F.array_distinct(F.transform("_s", lambda s: F.when(F.array_contains("_best", s), s).otherwise("Other")))
    cells = mapped.join(M.per_group(best), month).select(
        *month, F.col("state_name").alias("dim_x"), F.explode(buckets).alias("dim_y"), "job_id", "bronze_run_id")
    keys = [*month, "dim_x", "dim_y"]
    if unique:
        return per_run(cells, keys, F.count(F.lit(1)).alias("_n")).agg(
            F.max("bronze_run_id").alias("latest_bronze_run_id"), F.sum("_n").alias("job_count"))
    jobs = cells.groupBy(*keys).agg(F.count_distinct("job_id").alias("job_count"))
    return jobs.join(newest_run(cells, keys), keys)


def newest_run(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.select(*keys, "bronze_run_id").distinct().groupBy(*keys).agg(
        F.max("bronze_run_id").alias("latest_bronze_run_id"))


def flow_state_employer(geo: DataFrame, k: int = 10) -> DataFrame:
    """Mapped state to employer, the k largest employers of a month by name."""
    rows = (geo.withColumn("employer", F.lower(F.btrim(text("company_norm"))))
            .where((F.col("employer") != "") & ~F.col("state_name").startswith("unmapped")))
    return M.flow_edges(rows, ["source", "posted_month"], "state_name", "employer", k_dst=k, version="bronze_run_id",
                        small_groups=True)


def flow_location_employer(base: DataFrame, k: int = 10) -> DataFrame:
    """First location segment to employer, both reduced to the k largest of a month."""
    place = F.lower(F.btrim(F.substring_index(F.btrim(text("location_raw")), ",", 1)))
    rows = base.withColumns({
        "place": F.when(place == "", F.lit("(unknown location)")).otherwise(place),
        "employer": F.lower(F.btrim(text("company_norm")))}).where("employer <> ''")
    return M.flow_edges(rows, ["source", "posted_month"], "place", "employer", k, k, "Other (locations)",
                        "Other (employers)", version="bronze_run_id", small_groups=True)


# --- comparisons -------------------------------------------------------------------------------------------

def region_labels(df: DataFrame, regions: dict[str, str] | None) -> DataFrame:
    label = F.coalesce(lookup(regions, F.col("source")), F.col("source")) if regions else F.col("source")
    return df.withColumn("region_label", label)


def source_month_totals(role: DataFrame, regions: dict[str, str] | None = None) -> DataFrame:
    """Postings per source and month."""
    totals = role.groupBy(*KEYS).agg(F.sum("job_count").cast("long").alias("total_postings"))
    return region_labels(totals, regions)


def skill_mix(skill: DataFrame, regions: dict[str, str] | None = None) -> DataFrame:
    """Share of every skill in the tag mass of its source and month."""
    mixed = M.with_share(skill.select(*KEYS, "skill", F.col("job_count").alias("skill_tag_count")), list(KEYS),
                         "skill_tag_count", "share_within_region_skill_tags", small_groups=True)
    return region_labels(mixed, regions)


def common_months(runs: DataFrame, sources: Sequence[str]) -> DataFrame:
    """Months every given source has published, among (source, month, run) rows."""
    return (runs.where(F.col("source").isin(*sources)).groupBy("posted_month")
            .agg(F.count_distinct("source").alias("_n")).where(F.col("_n") == len(set(sources)))
            .select("posted_month"))


def latest_common_month(runs: DataFrame, sources: Sequence[str]) -> DataFrame:
    return common_months(runs, sources).agg(F.max("posted_month").alias("posted_month")).where(
        "posted_month IS NOT NULL")


def on_months(fact: DataFrame, runs: DataFrame, months: DataFrame, sources: Sequence[str],
              as_of: date | None = None) -> DataFrame:
    """Fact rows of the newest runs on the given months."""
    picked = runs.where(F.col("source").isin(*sources)).join(months, "posted_month", "left_semi")
    return restrict(fact, picked, as_of)


def hhi_common_months(location: DataFrame, runs: DataFrame, sources, as_of: date | None = None) -> DataFrame:
    """Location concentration per source on the months all sources share."""
    rows = on_months(location, runs, common_months(runs, sources), sources, as_of)
    return M.hhi(rows, list(KEYS), name="location_hhi").withColumns(
        {"layer_scope": F.lit("strict_common_month"), "month_in_strict_intersection": F.lit(True)})


def skill_mix_aligned(skill: DataFrame, runs: DataFrame, sources, k: int = 20,
                      as_of: date | None = None) -> DataFrame:
    """On the latest common month: the k skills with most combined mass, shares within them per source."""
    rows = on_months(skill, runs, latest_common_month(runs, sources), sources, as_of).select(
        *KEYS, "skill", F.col("job_count").alias("skill_tag_count"))
    best = (rows.groupBy("skill").agg(F.sum("skill_tag_count").alias("_m"))
            .orderBy(F.desc("_m"), "skill").limit(k).select("skill"))
    return M.with_share(rows.join(F.broadcast(best), "skill", "left_semi"), ["source"], "skill_tag_count",
                        "share_within_source_skill_tags", small_groups=True).withColumn(
        "alignment_kind", F.lit("strict_intersection_latest_month"))


def benchmark(role: DataFrame, skill: DataFrame, runs: DataFrame, sources, as_of: date | None = None) -> DataFrame:
    """One row per source on the latest common month: postings and skill concentration."""
    month = latest_common_month(runs, sources)
    postings = on_months(role, runs, month, sources, as_of).groupBy(*KEYS).agg(
        F.sum("job_count").cast("long").alias("total_role_postings"))
    tags = M.hhi(on_months(skill, runs, month, sources, as_of), list(KEYS), name="skill_tag_hhi")
    return postings.join(tags, list(KEYS), "left").withColumnRenamed(
        "posted_month", "aligned_posted_month").withColumn(
        "alignment_kind", F.lit("strict_intersection_latest_month"))


def skills_per_job(long: DataFrame, month: str) -> DataFrame:
    """Skills per posting in one month; postings without a skill do not appear."""
    return long.where(F.col("posted_month") == month).groupBy("source", "job_id", "posted_month").agg(
        F.count(F.lit(1)).alias("skills_per_job"), F.max("bronze_run_id").alias("run_id")).withColumn(
        "time_axis", F.lit(month))


# --- coverage ----------------------------------------------------------------------------------------------

# Stages of the coverage funnel and axes of the radar profile.
FUNNEL = (("1_all_postings", "All ingested postings in the merged Silver snapshot"),
          ("2_subnational_location", "Location is more specific than country-only (excludes empty and india-only)"),
          ("3_subnational_with_skills", "Subnational location AND at least one extracted skill token"),
          ("4_remote_mode_classified",
           "Subnational + skills AND remote_type is not unknown (hybrid/onsite/remote)"))
RADAR = {"remote_classified_share": "Share of jobs with remote_type not unknown",
         "skill_tagged_share": "Share of jobs with at least one extracted skill token",
         "location_subnational_share": "Share of jobs with location more specific than country-only",
         "geography_top3_state_share":
             "Share of jobs in the three largest state buckets (from geo rules, incl. unmapped buckets)",
         "employer_top5_concentration_share": "Share of all jobs accounted for by the top 5 employers by count"}


def _tests(base: DataFrame, country: str) -> tuple[Column, Column, Column]:
    place = F.lower(F.btrim(text("location_raw")))
    return ((place != "") & (place != country), F.coalesce(F.size(skills_array(base)), F.lit(0)) > 0,
            F.lower(F.btrim(text("remote_type"))) != "unknown")


def coverage_funnel(base: DataFrame, country: str = "india") -> DataFrame:
    """Four nested filters per source and month, long form, from one aggregate."""
    sub, skilled, known = _tests(base, country)
    counts = per_run(base, ["source", "posted_month"], F.count(F.lit(1)).alias("n1"), F.count_if(sub).alias("n2"),
                     F.count_if(sub & skilled).alias("n3"), F.count_if(sub & skilled & known).alias("n4")).agg(
        F.max("bronze_run_id").alias("bronze_run_id"), *[F.sum(f"n{i}").alias(f"n{i}") for i in range(1, 5)])
    stages = F.array(*[F.struct(
        F.lit("data_coverage").alias("funnel_kind"), F.lit(i).alias("stage_order"), F.lit(name).alias("stage_name"),
        F.lit(what).alias("stage_description"), F.col(f"n{i}").alias("job_count"))
        for i, (name, what) in enumerate(FUNNEL, 1)])
    return counts.select("source", "posted_month", "bronze_run_id", F.inline(stages))


def radar_profile(geo: DataFrame, profile: str, country: str = "india") -> DataFrame:
    """Five rates per source and month in long form; `geo` is the base with its state column."""
    keys = ["source", "posted_month"]
    sub, skilled, known = _tests(geo, country)

    tests = {"remote_classified_share": known, "skill_tagged_share": skilled, "location_subnational_share": sub}
    rates = per_run(geo, keys, F.count(F.lit(1)).alias("_jobs"), *[F.count_if(t).alias(n) for n, t in tests.items()]).agg(
        F.max("bronze_run_id").alias("bronze_run_id"), F.sum("_jobs").alias("_jobs"),
        *[M.share(F.sum(n), F.sum("_jobs")).alias(n) for n in tests])

    def best(value: Column, k: int, name: str) -> DataFrame:
        mass = geo.groupBy(*keys, value.alias("_v")).agg(F.count(F.lit(1)).alias("_n")).where("_v <> ''")
        return M.top_k(mass, keys, "_v", k, "_n").groupBy(*keys).agg(F.sum("_n").alias(name))

    wide = (rates.join(best(F.col("state_name"), 3, "_states"), keys, "left")
            .join(best(F.lower(F.btrim(text("company_norm"))), 5, "_employers"), keys, "left")
            .withColumns({"geography_top3_state_share": M.share(F.col("_states"), F.col("_jobs")),
                          "employer_top5_concentration_share": M.share(F.col("_employers"), F.col("_jobs"))}))
    axes = F.array(*[F.struct(F.lit(profile).alias("profile_name"), F.lit(a).alias("axis_name"),
                              F.col(a).alias("axis_value"), F.lit(d).alias("axis_description"))
                     for a, d in RADAR.items()])
    return wide.select(*keys, "bronze_run_id", F.inline(axes)).where("axis_value IS NOT NULL")


# --- presentation ------------------------------------------------------------------------------------------

def ranked_display(fact: DataFrame, dim: str, kind: str, table_k: int = R.TABLE_TOP,
                   chart_k: int = R.CHART_TOP) -> DataFrame:
    """Largest values per month with a table label, the original where it differs, and a unique chart label.

    Only the first `table_k` rows of a month are kept, so label work and the numbering of equal labels see
    that many rows per group.
    """
    best = M.top_k(fact.select(*KEYS, dim, "job_count"), list(KEYS), dim, table_k)
    shown = best.withColumn("_d", L.display_label(dim, kind)).withColumns({
        "label": L.shorten_hard(F.col("_d"), R.TABLE_LABEL_MAX),
        "original": F.when(F.lit(kind != "skill") & (F.lower("_d") != F.lower(squash(text(dim)))), F.col(dim)),
        "_c": F.when(F.col("rank") <= chart_k, L.chart_label(dim, kind))})
    again = F.row_number().over(M.W.partitionBy(*KEYS, "_c").orderBy("rank"))
    chart = F.when((F.col("_c") != "") & (again > 1), F.concat("_c", F.lit(" ("), again.cast("string"), F.lit(")")))
    return shown.select(*KEYS, "rank", F.col(dim).alias("value"), "label", "original",
                        F.coalesce(chart, "_c").alias("chart_label"), "job_count")

