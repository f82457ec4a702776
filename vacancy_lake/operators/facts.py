"""Monthly facts: which month a posting counts in, and how often each skill, role, place and employer occurs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import text as T, times as X
from ..functions.rules import PlaceRules
from ..functions.skills import skills_from_json
from ..schema import FACT_DIMENSION, LINEAGE_COUNTS, LINEAGE_ORDER, RUN_SUMMARY, fact_schema, summary_schema
from .metrics import per_group, stacked

_GROUP = ("source", "posted_month", "run_id")


def assign_month(df: DataFrame, fallback: bool = True) -> DataFrame:
    """Add posted_month (yyyy-MM) and time_axis.

    The month is that of posted_at; without one it is the ingest month and the axis says so. No valid month is
    empty text. `fallback=False` leaves the month NULL instead.
    """
    types = dict(df.dtypes)
    ts = X.stored_time("posted_at", types["posted_at"].startswith("timestamp")) if "posted_at" in types \
        else F.lit(None).cast("timestamp")
    posted = X.month_of(ts)
    if not fallback:
        return df.withColumns({"posted_month": posted,
                               "time_axis": F.when(posted.isNotNull(), F.lit("posted"))})
    landed = X.ingest_month("bronze_ingest_date") if "bronze_ingest_date" in types else F.lit(None).cast("string")
    return df.withColumns({
        "posted_month": F.coalesce(posted, landed, F.lit("")),
        "time_axis": F.when(posted.isNotNull(), F.lit("posted")).otherwise(F.lit("ingest_fallback"))})


def _dated(df: DataFrame, run: str | Column) -> DataFrame:
    """Rows with a valid month, stamped with the run the facts belong to."""
    if "posted_month" not in df.columns:
        df = assign_month(df)
    return (df.where(F.col("posted_month").rlike(X.MONTH_PATTERN))
            .withColumn("run_id", run if isinstance(run, Column) else F.lit(run)))


def month_profile(df: DataFrame, run: str | Column) -> DataFrame:
    """Per month and run: representative ingest date and dominant time axis.

    Both are maxima of text, which Spark aggregates by sorting; the distinct dates are hash aggregated first.
    """
    return _dated(df, run).select(*_GROUP, "bronze_ingest_date", "time_axis").distinct().groupBy(*_GROUP).agg(
        F.max("bronze_ingest_date").alias("bronze_ingest_date"), X.dominant_axis("time_axis").alias("time_axis"))


def lineage(df: DataFrame) -> DataFrame:
    """Rows with a valid month by (source, posted_month, bronze_ingest_date, bronze_run_id, time_axis), with their number.

    A few rows per month and run: enough to settle the run id, the profile of each month, and its fallback date.
    """
    rows = _dated(df, F.col("bronze_run_id"))
    return rows.groupBy("source", "posted_month", *[T.text(c).alias(c) for c in LINEAGE_ORDER[:2]], "time_axis").agg(
        F.count(F.lit(1)).alias("job_count"))


def profile_of(lines: DataFrame, run: str) -> DataFrame:
    """The month profile from `lineage` rows."""
    return lines.withColumn("run_id", F.lit(run)).groupBy(*_GROUP).agg(
        F.max("bronze_ingest_date").alias("bronze_ingest_date"), X.dominant_axis("time_axis").alias("time_axis"))


def _stamp(counts: DataFrame, df: DataFrame, run, table: str, profile: DataFrame | None = None) -> DataFrame:
    """Facts carry the profile of their month: one row per published slice, broadcast to the counts."""
    profile = month_profile(df, run) if profile is None else profile
    joined = counts.join(per_group(profile), list(_GROUP)).withColumn("bronze_run_id", F.col("run_id"))
    return joined.select(*fact_schema(table).fieldNames())


def _plain(column: str) -> Column:
    return T.squash(F.lower(T.text(column)))


def skill_counts(df: DataFrame, run: str | Column, unique: bool = False, weight: Column | int = 1) -> DataFrame:
    """Distinct postings per skill and month, without the month profile.

    `unique=True` says there is one row per job_id, as in a snapshot: rows are then counted (by `weight`), which combines
    on each task before the shuffle, instead of shuffling every (skill, job_id).
    """
    skills = F.col("skills") if dict(df.dtypes)["skills"] != "string" else skills_from_json("skills")
    each = _dated(df, run).select(*_GROUP, "job_id", F.lit(weight).alias("_w"), F.explode(F.array_distinct(
        F.transform(skills, lambda s: F.btrim(s)))).alias("skill")).where("skill <> ''")
    jobs = F.sum(F.col("_w").cast("long")) if unique else F.count_distinct("job_id")
    return each.groupBy(*_GROUP, "skill").agg(jobs.alias("job_count"))


def value_counts(df: DataFrame, run: str | Column, value: Column, dim: str, weight: Column | int = 1) -> DataFrame:
    """Postings per value and month, blanks dropped. A row counts `weight` (one; less than that takes away)."""
    return (_dated(df, run).select(*_GROUP, value.alias(dim), F.lit(weight).cast("long").alias("_w")).where(F.col(dim) != "")
            .groupBy(*_GROUP, dim).agg(F.sum("_w").alias("job_count")))


def role_counts(df: DataFrame, run: str | Column, weight: Column | int = 1) -> DataFrame:
    return value_counts(df, run, _plain("title_norm"), "role", weight)


def company_counts(df: DataFrame, run: str | Column, weight: Column | int = 1) -> DataFrame:
    return value_counts(df, run, _plain("company_norm"), "company_name", weight)


def location_counts(df: DataFrame, run: str | Column, places: PlaceRules | None = PlaceRules(),
                    weight: Column | int = 1) -> DataFrame:
    """Postings per normalised location. Distinct raw spellings are counted first, then normalised."""
    raw = (_dated(df, run).groupBy(*_GROUP, "location_raw").agg(F.sum(F.lit(weight).cast("long")).alias("_n"))
           .select(*_GROUP, "_n", T.normalize_location("location_raw", places).alias("location")))
    return raw.where("location <> ''").groupBy(*_GROUP, "location").agg(F.sum("_n").alias("job_count"))


def skill_demand(df: DataFrame, run: str | Column, unique: bool = False, profile: DataFrame | None = None) -> DataFrame:
    return _stamp(skill_counts(df, run, unique), df, run, "skill_demand_monthly", profile)


def role_demand(df: DataFrame, run: str | Column, profile: DataFrame | None = None) -> DataFrame:
    return _stamp(role_counts(df, run), df, run, "role_demand_monthly", profile)


def location_demand(df: DataFrame, run: str | Column, places: PlaceRules | None = PlaceRules(),
                    profile: DataFrame | None = None) -> DataFrame:
    return _stamp(location_counts(df, run, places), df, run, "location_demand_monthly", profile)


def company_hiring(df: DataFrame, run: str | Column, profile: DataFrame | None = None) -> DataFrame:
    return _stamp(company_counts(df, run), df, run, "company_hiring_monthly", profile)


def run_summary(facts: dict[str, DataFrame], profile: DataFrame, published: DataFrame | None = None) -> DataFrame:
    """One row per month and run: rows of each fact, status and axis.

    `published` lists (source, posted_month, run_id, bronze_ingest_date) of months that must appear even
    when they hold nothing; those count zero, axis `posted`.
    """
    parts = [f.groupBy(*_GROUP).agg(F.count(F.lit(1)).alias(f"{FACT_DIMENSION[t].split('_')[0]}_row_count"))
             for t, f in facts.items()]
    base = profile
    if published is not None:
        base = published.join(profile.withColumnRenamed("bronze_ingest_date", "_d"), list(_GROUP), "left").select(
            *_GROUP, F.coalesce("_d", "bronze_ingest_date").alias("bronze_ingest_date"), "time_axis")
    for p in parts:
        base = base.join(p, list(_GROUP), "left")
    zero = {f"{n}_row_count": F.coalesce(F.col(f"{n}_row_count"), F.lit(0).cast("long"))
            for n in ("skill", "role", "location", "company")}
    return base.withColumns({**zero, "status": F.lit("PASS"), "bronze_run_id": F.col("run_id"),
                             "time_axis": F.coalesce("time_axis", F.lit("posted"))}) \
        .select(*summary_schema().fieldNames())


def resolve_run(df: DataFrame, source: str | None = None) -> DataFrame:
    """Run id the facts are published under: newest in (date, run, ingested) order among rows with a month.

    The run id is settled by (date, run) alone, so the few distinct pairs are enough.
    """
    missing = {"bronze_ingest_date", "bronze_run_id", "source"} - set(df.columns)
    if missing:
        raise ValueError(f"lineage columns missing: {sorted(missing)}")
    rows = assign_month(df).where(F.col("posted_month").rlike(X.MONTH_PATTERN))
    if source is not None:  # rows of another source fail the query
        rows = rows.withColumn("source", F.when(F.col("source") == source, F.col("source")).otherwise(F.raise_error(
            F.concat(F.lit(f"expected source {source}, found "), F.coalesce("source", F.lit("none")))).cast("string")))
    pairs = rows.select("source", *[T.text(c).alias(c) for c in LINEAGE_ORDER[:2]]).distinct()
    return pairs.groupBy("source").agg(F.max_by("bronze_run_id", F.struct(*LINEAGE_ORDER[:2])).alias("run_id"))


def check_months(months: Sequence[str]) -> list[str]:
    for m in months:
        if not (len(m) == 7 and m[4] == "-" and (m[:4] + m[5:]).isdigit()):
            raise ValueError(f"invalid month {m!r}, expected yyyy-MM")
    return sorted(set(months))


def _near(df: DataFrame, months: Sequence[str]) -> DataFrame:
    """Time range of the months on the stored column, so the scan skips row groups outside of it."""
    if not months or not dict(df.dtypes).get("posted_at", "").startswith("timestamp"):
        return df
    y, m = int(months[-1][:4]), int(months[-1][5:])
    end = f"{y + m // 12:04d}-{m % 12 + 1:02d}-01"
    at = F.col("posted_at")
    return df.where(at.isNull() | ((at >= F.lit(f"{months[0]}-01").cast("timestamp")) & (at < F.lit(end).cast("timestamp"))))


def on_months(df: DataFrame, months: Sequence[str] | None) -> DataFrame:
    """Rows with a valid month, of the given months if any; a time range reaches the scan."""
    dated = _dated(df, F.lit(None).cast("string")).drop("run_id")
    return dated if months is None else _near(dated, months).where(F.col("posted_month").isin(months))


def fact_tables(dated: DataFrame, run: str | Column, places: PlaceRules | None = PlaceRules(), unique: bool = False,
                profile: DataFrame | None = None) -> dict[str, DataFrame]:
    """The four facts of rows that have their month; each reads the rows once when the profile is given."""
    return {"skill_demand_monthly": skill_demand(dated, run, unique, profile),
            "role_demand_monthly": role_demand(dated, run, profile),
            "location_demand_monthly": location_demand(dated, run, places, profile),
            "company_hiring_monthly": company_hiring(dated, run, profile)}


def build_facts(df: DataFrame, run: str | Column, months: Sequence[str] | None = None,
                places: PlaceRules | None = PlaceRules(), unique: bool = False) -> dict[str, DataFrame]:
    """All four facts and the run summary, every month in the same grouped jobs.

    `unique` as in `skill_counts`.

    With `months` only those are rebuilt, and each of them is published per source even if it has no row.
    """
    months = check_months(months) if months is not None else None
    overall, dated = on_months(df, None), on_months(df, months)
    facts = fact_tables(dated, run, places, unique)
    published = None
    if months is not None:
        wanted = F.explode(F.array(*map(F.lit, months))).alias("posted_month")
        published = (_dated(overall, run).groupBy("source", "run_id")
                     .agg(F.max("bronze_ingest_date").alias("bronze_ingest_date"))
                     .select("source", "run_id", "bronze_ingest_date", wanted))
    return {**facts, RUN_SUMMARY: run_summary(facts, month_profile(dated, run), published)}


# --- facts kept up to date by changes ----------------------------------------------------------------------

def signed_counts(changes: DataFrame, run: str | Column, places: PlaceRules | None = PlaceRules()) -> dict[str, DataFrame]:
    """What signed postings (`sign` +1 or -1, one row per job_id and sign) add to the counts of each fact.

    All counts are sums over postings of a snapshot, where a key occurs once, so they follow from the changes alone.
    """
    sign = F.col("sign")
    lines = (_dated(changes, run).groupBy(*_GROUP, T.text("bronze_ingest_date").alias("bronze_ingest_date"), "time_axis")
             .agg(F.sum(sign.cast("long")).alias("job_count")))
    return {"skill_demand_monthly": skill_counts(changes, run, True, sign), "role_demand_monthly": role_counts(changes, run, sign),
            "location_demand_monthly": location_counts(changes, run, places, sign),
            "company_hiring_monthly": company_counts(changes, run, sign), LINEAGE_COUNTS: lines}


def add_counts(old: DataFrame, signed: DataFrame, keys: Sequence[str], run: str) -> DataFrame:
    """Counts of an earlier run and signed counts, added up under `run`; what is left with nothing goes."""
    columns = [c for c in (*_GROUP, *keys) if c != "run_id"]
    both = stacked(old.select(*columns, "job_count"), signed.select(*columns, "job_count"), "posted_month")
    return (both.groupBy(*columns).agg(F.sum("job_count").alias("job_count")).where(F.col("job_count") != 0)
            .withColumn("run_id", F.lit(run)))


def updated_facts(old: dict[str, DataFrame], signed: dict[str, DataFrame], run: str) -> dict[str, DataFrame]:
    """The four facts and the lineage counts of `run`, from those of an earlier run and signed counts."""
    lines = add_counts(old[LINEAGE_COUNTS], signed[LINEAGE_COUNTS], ("bronze_ingest_date", "time_axis"), run)
    profile = profile_of(lines, run)
    facts = {t: _stamp(add_counts(old[t], signed[t], (dim,), run), lines, run, t, profile) for t, dim in FACT_DIMENSION.items()}
    return {**facts, LINEAGE_COUNTS: lines}
