"""The three batch steps of the lake, each a short composition of operators.

Order inside every step: data first, then state or pointer, so a crash repeats rows and the upsert absorbs
them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.rules import PlaceRules, Vocabulary
from ..operators import facts as E, incremental as B, merge as D, standardize as C
from ..schema import FACT_DIMENSION, LINEAGE_COUNTS, RUN_SUMMARY, lineage_schema, use_shared_checkpoints
from ..sources import file_index as I, lake as A, snapshot as S, state as ST


def land(fetched: DataFrame, lake: A.Lake, dialect: B.Dialect, source: str, run_id: str, ingest_date: str,
         batch_created_at: str, lookback_hours: int = 48, cap: int | None = None, mode: str = "lookback",
         batch_id: int | None = None, index: bool = False) -> dict:
    """Land the new part of a fetch (source, raw_payload) and move the watermark over all of it.

    `index=True` also adds the run to the file index of the lake, before the watermark moves.
    """
    spark = fetched.sparkSession
    state = ST.read_state(spark, lake.root, source, lake.slice, batch_id, lookback_hours)
    chosen, report = B.select_incremental(fetched, B.created_seconds(dialect), state["fetch_watermark"],
                                          lookback_hours, cap, mode)
    stats = B.refuse_empty(report)
    A.write_landing(B.to_landing(chosen, dialect, run_id, ingest_date, batch_created_at), lake)
    if index:
        I.add(spark, lake, I.LANDED, [(source, ingest_date, run_id)])
    ST.write_state(spark, lake.root, {
        **state, "last_run_id": run_id, "last_run_at": batch_created_at, "fetch_watermark": stats["max_created"],
        "lookback_hours": lookback_hours, "status": "ok", "strategy": mode,
        "batch_id": state["batch_id"] + 1 if batch_id is None else batch_id})
    known = spark.createDataFrame([(source, run_id, *(stats[f.name] for f in report.schema))],
                                  StructType([*_RUN_KEY, *report.schema.fields]))
    A.append_audit(A.audit_rows(known, "landing", batch_created_at), lake)
    return stats


def standard_batch(landed: DataFrame, aggregator_sources: tuple[str, ...] = (), vocab: Vocabulary = Vocabulary(),
                   places: PlaceRules | None = PlaceRules()) -> DataFrame:
    """Landing rows to the distinct postings of a batch.

    Text work comes first: it is narrow, and the shuffle behind the first-row rule then carries short
    standard rows instead of payloads.
    """
    rows = C.standardize(landed, aggregator_sources, vocab, places, keep=("_line",))
    return D.dedup_batch(rows, ["bronze_data_file", "_line"], keep_order=True).drop("_line")


def build_postings(spark: SparkSession, lake: A.Lake, source: str, path: str | None = None,
                   aggregator_sources: tuple[str, ...] = (), vocab: Vocabulary = Vocabulary(),
                   places: PlaceRules | None = PlaceRules(), legacy_source: bool = False, heal: bool = False,
                   index: bool = False) -> dict:
    """Newest landing batch to a standard batch and a new snapshot version; a failing batch writes nothing.

    The batch becomes a version on top of the snapshot before it; without one, of the union of all batches. `heal=True`
    takes the broader of both (more months, then more rows), which reads the whole history: for snapshots written
    elsewhere, since a failed write here leaves the version before it in force. `index=True` finds the newest landing
    batch in the file index of the lake instead of listing folders.

    The batch feeds the gate, the batch table and the upsert, so it is put in the shared checkpoint folder:
    the text work runs once, and a lost executor does not repeat it.
    """
    use_shared_checkpoints(spark)
    by_index = index and path is None
    landed = A.require_rows(I.read_landing(spark, lake, source) if by_index else A.read_landing(spark, lake, source, path))
    rows_in = landed.count()
    batch = standard_batch(landed, aggregator_sources, vocab, places).checkpoint()
    report = D.quality_gate(batch, rows_in)
    run = batch.agg(F.max("bronze_run_id")).first()[0]
    state = S.version(spark, lake, source)
    if state is not None and not heal:
        A.write_batch(batch, lake)
        done = S.upsert(batch, lake, source, run)
    else:
        merged = None if state is None else S.read(spark, lake, source, number=state.number)
        history = A.read_history(spark, lake, source, legacy_source, places)
        union = None if history is None else D.keep_last(history, [*D.LINEAGE_ORDER, "bronze_data_file"])
        old = D.pick_snapshot(merged, union) if merged is not None or union is not None else batch.limit(0)
        A.write_batch(batch, lake)
        done = S.replace(D.upsert_history(old, batch, snapshot=True), lake, source, run, state.number if state else 0)
    out = {**report, "version": done.number, "landed": rows_in, "dedup_removed": rows_in - report["row_count"],
           "merged_rows": done.keys}
    quality = spark.createDataFrame([(source, run, report["status"], *[int(out[c]) for c in _QUALITY])],
                                    "source string, run_id string, status string, " + ", ".join(f"{c} long" for c in _QUALITY))
    A.append_audit(A.audit_rows(quality, "silver", run), lake)
    return out


_RUN_KEY = [StructField("source", StringType()), StructField("run_id", StringType())]
_QUALITY = ("landed", "row_count", "dedup_removed", "merged_rows", "missing_title", "missing_company", "duplicate_job_id", "duplicate_source_key")


def rebuild(spark: SparkSession, lake: A.Lake, source: str, version: str, legacy_source: bool = False,
            places: PlaceRules | None = PlaceRules()) -> DataFrame:
    """Merged snapshot anew from every batch; returns its month audit."""
    history = A.read_history(spark, lake, source, legacy_source, places)
    if history is None:
        raise ValueError(f"no batches for source {source}")
    snapshot, audit = D.rebuild_snapshot(history)
    S.replace(snapshot, lake, source, version)
    return audit


def publish_facts(postings: DataFrame, lake: A.Lake, run: str | None = None,
                  months: Sequence[str] | None = None, places: PlaceRules | None = PlaceRules(),
                  unique: bool = False, source: str | None = None) -> dict[str, int]:
    """Build and write the facts of one source, then the summary counted from what was written, then the pointer.

    A crash on the way leaves no PASS row for facts that are not there. `postings` is read five times: once for the
    few lines of its lineage, which settle run, profile and fallback date, and once per fact; of the given months only,
    unless the newest run is asked for or a month is empty. Rows of another source than `source` are refused. Pass
    `unique=True` for a merged snapshot, which holds one row per job_id.
    """
    spark = postings.sparkSession
    use_shared_checkpoints(spark)
    months = E.check_months(months) if months is not None else None
    lines = E.lineage(postings if run is None or months is None else E.on_months(postings, months)).checkpoint()
    there = {r["posted_month"] for r in lines.select("posted_month").distinct().collect()}
    blank = [m for m in months or () if m not in there]
    whole = E.lineage(postings).checkpoint() if blank and run is not None else lines
    found = whole.groupBy("source").agg(F.max_by("bronze_run_id", F.struct("bronze_ingest_date", "bronze_run_id")).alias("run_id"),
                                        F.max("bronze_ingest_date").alias("day")).limit(2).collect()
    if not found:
        raise ValueError("no posting with a valid month")
    if len(found) > 1:
        raise ValueError("facts are published per source")
    if source is not None and found[0]["source"] != source:
        raise ValueError(f"expected source {source}, found {found[0]['source']}")
    source, newest = found[0]["source"], found[0]["run_id"]
    run = run or newest
    if months is not None:
        lines = lines.where(F.col("posted_month").isin(months))
    profile = E.profile_of(lines, run).checkpoint()
    wanted = sorted(r["posted_month"] for r in profile.select("posted_month").collect())  # one row per month
    tables = E.fact_tables(E.on_months(postings, months), run, places, unique, profile)
    for table, fact in tables.items():
        seen = Observation()
        fact = fact.observe(seen, F.count(F.lit(1)).alias("rows"),
                            *[F.count_if(F.col("posted_month") == m).alias(m) for m in wanted])
        A.write_fact(fact, table, lake)
        A.clear_months(fact, table, lake, [(source, m, run) for m in [*blank, *(m for m in wanted if not seen.get[m])]])
    counted = lines.groupBy("source", "posted_month", "bronze_ingest_date", "time_axis").agg(F.sum("job_count").alias("job_count"))
    A.write_fact(counted.withColumn("run_id", F.lit(run)).select(*lineage_schema().fieldNames()), LINEAGE_COUNTS, lake)
    stored = {t: A.read_fact(spark, t, lake).where((F.col("source") == source) & (F.col("run_id") == run)
                                                   & F.col("posted_month").isin([*wanted, *blank])) for t in tables}
    asked = spark.createDataFrame([(source, m, run, found[0]["day"]) for m in [*wanted, *blank]],
                                  "source string, posted_month string, run_id string, bronze_ingest_date string")
    A.write_fact(E.run_summary(stored, profile, asked), RUN_SUMMARY, lake)
    A.publish_latest(spark.createDataFrame([(source, run)], "source string, run_id string"), lake)
    summary = A.read_fact(spark, RUN_SUMMARY, lake).where(
        (F.col("source") == source) & (F.col("run_id") == run) & F.col("posted_month").isin([*wanted, *blank]))
    A.append_audit(A.audit_rows(summary, "gold", newest), lake)
    return {r["posted_month"]: r["role_row_count"] for r in summary.select("posted_month", "role_row_count").collect()}


def publish_changes(spark: SparkSession, lake: A.Lake, source: str, before: int, after: int, old_run: str, run: str,
                    places: PlaceRules | None = PlaceRules()) -> dict[str, int]:
    """Facts of `run` for snapshot version `after`, from those of `old_run`, published for version `before`.

    Reads the changed postings and the old facts, never the snapshot. All months of the old run are published again under
    the new one, so either way of choosing runs finds it whole; facts come first, then the summary, then the pointer.
    Returns changed postings that were added and taken away.
    """
    use_shared_checkpoints(spark)
    changes = S.changes(spark, lake, source, before, after).checkpoint()
    tables = (*FACT_DIMENSION, LINEAGE_COUNTS)
    old = {t: A.read_fact(spark, t, lake).where((F.col("source") == source) & (F.col("run_id") == old_run)) for t in tables}
    facts = E.updated_facts(old, E.signed_counts(changes, run, places), run)
    months = {r["posted_month"] for r in old[LINEAGE_COUNTS].select("posted_month").distinct().collect()}  # one row per month
    lines = facts[LINEAGE_COUNTS].checkpoint()
    left = {r["posted_month"] for r in lines.select("posted_month").distinct().collect()}
    for table in FACT_DIMENSION:
        A.write_fact(facts[table], table, lake, [(source, m, run) for m in sorted(months - left)])
    A.write_fact(lines.select(*lineage_schema().fieldNames()), LINEAGE_COUNTS, lake, [(source, m, run) for m in sorted(months - left)])
    stored = {t: A.read_fact(spark, t, lake).where((F.col("source") == source) & (F.col("run_id") == run)) for t in FACT_DIMENSION}
    A.write_fact(E.run_summary(stored, E.profile_of(lines, run)), RUN_SUMMARY, lake)
    A.publish_latest(spark.createDataFrame([(source, run)], "source string, run_id string"), lake)
    row = changes.agg(F.count_if(F.col("sign") > 0).alias("added"), F.count_if(F.col("sign") < 0).alias("taken")).first()
    return row.asDict()
