"""A to E queries: landing, standardisation, current state and facts, on the driver tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from vacancy_lake.functions import rules as R, skills as S, text as T, times as X
from vacancy_lake.operators import distinct as DI, facts as E, gazetteer as G, incremental as B, merge as D, standardize as C
from vacancy_lake.plans import build as P
from vacancy_lake.plans.build import standard_batch
from vacancy_lake.schema import FACT_DIMENSION, LINEAGE_COUNTS, POSTING, RUN_SUMMARY
from vacancy_lake.sources import file_index as I, lake as A, snapshot as SN, state as ST
from vacancy_lake.streaming import current_state as CS, landing_stream as STREAM

from . import fixtures as fx
from .base import SQL_FACTS, SQL_POSTINGS, query, sql, sql_list

NESTED = B.aggregator("nested_")
DIALECTS = (("src_a", B.BOARD), ("src_b", NESTED))


def _landing(spark, d) -> DataFrame:
    """All orders as landing rows; one run per year."""
    rows = fx.payloads(spark, d)
    year = F.date_format("day", "yyyy")
    stamped = rows.withColumns({"_run": F.concat(year, F.lit("1231T000000Z-0000")),
                                "_date": F.concat(year, F.lit("-12-31"))})
    return reduce(DataFrame.unionByName, [
        B.to_landing(stamped.where(F.col("source") == s), dialect, F.col("_run"), F.col("_date"),
                     F.concat("_date", F.lit("T00:00:00Z"))) for s, dialect in DIALECTS])


SQL_LANDING = SQL_POSTINGS + """, ln AS (
  SELECT source, k, CASE WHEN source = 'src_a' THEN sha256('src_a|slug|job-' || k) ELSE sha256('src_b|id|' || k) END AS job_id,
    CASE WHEN source = 'src_a' THEN 'slug' ELSE 'nested_id' END AS job_id_strategy,
    CASE WHEN source = 'src_b' THEN CAST(k AS VARCHAR) END AS source_job_id,
    CASE WHEN source = 'src_a' THEN 'job-' || k ELSE CAST(k AS VARCHAR) END AS source_slug,
    CASE WHEN source = 'src_a' THEN 'https://example.org/' || k ELSE 'https://example.com/' || k END AS source_url,
    strftime(day, '%Y') || '1231T000000Z-0000' AS run_id, strftime(day, '%Y') || '-12-31' AS bronze_ingest_date,
    title_raw AS title, c_name, n_name, r_name, c_mktsegment, o_orderpriority, o_orderstatus, day FROM p)"""


# --- sources and sinks -------------------------------------------------------------------------------------

@query("a01_read_landing", sql(SQL_LANDING, """
SELECT source, job_id, job_id_strategy, run_id, bronze_ingest_date, title FROM ln"""))
def a01(spark, d):
    lake = fx.work_lake(spark, "a01")
    A.write_landing(_landing(spark, d), lake)
    return A.read_landing(spark, lake).select(
        "source", "job_id", "job_id_strategy", "run_id", "bronze_ingest_date",
        F.get_json_object("raw_payload", "$.title").alias("title"))


@query("a01_newest_batch", sql(SQL_LANDING, """
SELECT source, run_id, count(*) AS n FROM ln WHERE (source, run_id) IN (SELECT (source, max(run_id)) FROM ln GROUP BY source)
GROUP BY ALL"""))
def a01_newest(spark, d):
    """Batches land one after the other; the newest of a source is the default input."""
    lake = fx.work_lake(spark, "a01n")
    rows = _landing(spark, d)
    last = rows.agg(F.max("run_id")).first()[0]
    A.write_landing(rows.where(F.col("run_id") != last), lake)
    A.write_landing(rows.where(F.col("run_id") == last), lake)
    return reduce(DataFrame.unionByName, [A.read_landing(spark, lake, s) for s, _ in DIALECTS]).groupBy(
        "source", "run_id").agg(F.count(F.lit(1)).alias("n"))


def _runs(df: DataFrame) -> list[tuple[str, str, str]]:
    """Source, ingest date and run id of what was written; a few rows."""
    return [tuple(r) for r in df.select("source", "bronze_ingest_date", df.columns[-1]).distinct().collect()]


@query("a01_indexed_landing", sql(SQL_LANDING, """
SELECT 'range' AS read, source, run_id, n, count(*) OVER (PARTITION BY source) AS batches FROM (
  SELECT source, run_id, count(*) AS n FROM ln WHERE bronze_ingest_date >= '1996-12-31' AND bronze_ingest_date < '1999-12-31'
  GROUP BY ALL)
UNION ALL SELECT 'newest', source, run_id, count(*), 1 FROM ln
WHERE (source, run_id) IN (SELECT (source, max(run_id)) FROM ln GROUP BY source) GROUP BY ALL"""))
def a01_indexed(spark, d):
    """Files of three years by their times, and of the newest batch, read without listing folders."""
    lake = fx.work_lake(spark, "a01i")
    rows = _landing(spark, d)
    A.write_landing(rows, lake)
    runs = sorted(_runs(rows.select("source", "bronze_ingest_date", "run_id")), key=lambda r: r[1])
    I.add(spark, lake, I.LANDED, [r for r in runs if r[1] != runs[-1][1]])
    I.add(spark, lake, I.LANDED, [r for r in runs if r[1] == runs[-1][1]])
    part = I.read_landing(spark, lake, since="1996-12-31", until="1999-12-31")
    newest = reduce(DataFrame.unionByName, [I.read_landing(spark, lake, s) for s, _ in DIALECTS])
    files = I.entries(spark, lake, I.LANDED)
    met = files.where((F.col("greatest") >= "1996-12-31") & (F.col("least") < "1999-12-31")).groupBy("source").agg(
        F.count_distinct("run_id").alias("batches"))
    counted = part.groupBy("source", "run_id").agg(F.count(F.lit(1)).alias("n")).join(met, "source")
    last = newest.groupBy("source", "run_id").agg(F.count(F.lit(1)).alias("n")).withColumn("batches", F.lit(1).cast("long"))
    return counted.withColumn("read", F.lit("range")).unionByName(last.withColumn("read", F.lit("newest")))


@query("a02_write_landing_slice", sql(SQL_LANDING, """
SELECT 'main' AS lake, source, run_id, count(*) AS n FROM ln WHERE source = 'src_a' GROUP BY ALL
UNION ALL SELECT 'backfill', source, run_id, count(*) FROM ln WHERE source = 'src_b' GROUP BY ALL"""))
def a02(spark, d):
    """One source goes to the main lake, the other to a slice; neither sees the other. Writing twice is safe."""
    main = fx.work_lake(spark, "a02")
    part = A.Lake(main.root, "backfill")
    rows = _landing(spark, d)
    for lake, source in ((main, "src_a"), (part, "src_b"), (part, "src_b")):
        A.write_landing(rows.where(F.col("source") == source), lake)
    out = [A.read_landing(spark, lake).groupBy("source", "run_id").agg(F.count(F.lit(1)).alias("n"))
           .withColumn("lake", F.lit(name)) for lake, name in ((main, "main"), (part, "backfill"))]
    return out[0].unionByName(out[1])


@query("a03_path_lineage", sql(SQL_LANDING, """
SELECT run_id, bronze_ingest_date, count(*) AS n FROM ln GROUP BY ALL"""))
def a03(spark, d):
    lake = fx.work_lake(spark, "a03")
    A.write_landing(_landing(spark, d), lake)
    raw = spark.read.text(lake.batch_glob(lake.landing))
    return A.with_path_lineage(raw.select("value", "_metadata.file_path"), F.col("file_path")).groupBy(
        "run_id", "bronze_ingest_date").agg(F.count(F.lit(1)).alias("n"))


def _yearly(df: DataFrame) -> DataFrame:
    year = F.left("bronze_ingest_date", F.lit(4))
    return df.withColumns({"bronze_run_id": F.concat(year, F.lit("1231T0")),
                           "bronze_ingest_date": F.concat(year, F.lit("-12-31"))})


YEARLY = "substr(bronze_ingest_date, 1, 4) || '1231T0'"


@query("a04_read_history", sql(SQL_POSTINGS, f"""
SELECT job_id, source, title_norm, company_norm, location_raw, remote_type, list_aggregate(skills, 'string_agg', '|') AS skills,
  {YEARLY} AS bronze_run_id, strftime(CASE WHEN k % 97 <> 0 THEN day END, '%Y-%m-%d') AS posted_on FROM p"""))
def a04(spark, d):
    """Current and earlier flat layout together; the merged snapshot beside them stays unread."""
    lake = fx.work_lake(spark, "a04")
    df = _yearly(fx.postings(spark, d))
    late = F.col("bronze_run_id") >= "1998"
    A.write_batch(df.where(late), lake)
    SN.replace(df.where("source = 'src_a'"), lake, "src_a", "20011231T0")
    earlier = C.text_contract(df.where(~late)).withColumns(
        {"ingest_date": F.col("bronze_ingest_date"), "run_id": F.col("bronze_run_id")})
    (earlier.withColumnsRenamed({"title_norm": "title_raw", "company_norm": "company_raw", "location_raw": "location"})
     .write.partitionBy("ingest_date", "run_id").parquet(lake.legacy_jobs))
    out = A.read_history(spark, lake, "src_a", legacy_source=True).unionByName(A.read_history(spark, lake, "src_b"))
    return out.select("job_id", "source", "title_norm", "company_norm", "location_raw", "remote_type",
                      F.nullif(F.array_join("skills", "|"), F.lit("")).alias("skills"), "bronze_run_id",
                      F.date_format("posted_at", "yyyy-MM-dd").alias("posted_on"))


@query("a04_indexed_history", sql(SQL_POSTINGS, """
SELECT job_id, title_norm, company_norm, strftime(day + INTERVAL 1 DAY, '%Y-%m-%d') AS ingested_on FROM p
WHERE source = 'src_a' AND day + INTERVAL 1 DAY >= DATE '1996-03-01' AND day + INTERVAL 1 DAY < DATE '1997-09-01'"""))
def a04_indexed(spark, d):
    """Postings of eighteen months out of the batches of all years; files of other years stay closed."""
    lake = fx.work_lake(spark, "a04i")
    df = _yearly(fx.postings(spark, d, False))
    A.write_batch(df, lake)
    I.add(spark, lake, I.BATCHES, _runs(df.select("source", "bronze_ingest_date", "bronze_run_id")))
    out = I.read_history(spark, lake, "src_a", "1996-03-01", "1997-09-01")
    return out.select("job_id", "title_norm", "company_norm", F.substring("ingested_at", 1, 10).alias("ingested_on"))


@query("a05_write_fact", sql(SQL_POSTINGS, """
SELECT source, posted_month, '20010901T0' AS run_id, company_norm AS company_name, count(*) AS job_count FROM p GROUP BY ALL"""))
def a05(spark, d):
    """Write all months, write one of them again, read all back."""
    lake = fx.work_lake(spark, "a05")
    fact = E.company_hiring(fx.postings(spark, d, False), "20010901T0")
    A.write_fact(fact, "company_hiring_monthly", lake)
    A.write_fact(fact.where("posted_month = '2001-07'"), "company_hiring_monthly", lake)
    return A.read_fact(spark, "company_hiring_monthly", lake).select("source", "posted_month", "run_id", "company_name", "job_count")


@query("a06_latest_run", sql(SQL_POSTINGS, """
SELECT source, CASE source WHEN 'src_a' THEN 'again' ELSE max_by(bronze_run_id, bronze_ingest_date || bronze_run_id) END
  AS run_id FROM p GROUP BY source"""))
def a06(spark, d):
    """Publish both pointers, then move one: the other stays."""
    lake = fx.work_lake(spark, "a06")
    runs = E.resolve_run(fx.postings(spark, d, False))
    A.publish_latest(runs, lake)
    A.publish_latest(runs.where("source = 'src_a'").withColumn("run_id", F.lit("again")), lake)
    return A.latest_run(spark, lake)


@query("a07_audit_rows", sql(SQL_POSTINGS, """
SELECT unnest(['silver', 'gold']) AS stage, source, run_id, 'PASS' AS status, n AS postings FROM (
  SELECT source, bronze_run_id AS run_id, count(*) AS n FROM p GROUP BY ALL)"""))
def a07(spark, d):
    lake = fx.work_lake(spark, "a07")
    report = fx.postings(spark, d, False).groupBy("source", F.col("bronze_run_id").alias("run_id")).agg(
        F.count(F.lit(1)).alias("n"), F.lit("PASS").alias("status"))
    for stage in ("silver", "gold"):
        A.append_audit(A.audit_rows(report, stage, "2001-08-01T00:00:00Z"), lake)
    back = spark.read.parquet(f"{lake.root}/audit")
    return back.select("stage", "source", "run_id", "status",
                       F.get_json_object("details", "$.n").cast("long").alias("postings"))


@query("a08_pick_snapshot", sql(SQL_POSTINGS, "SELECT posted_month, count(*) AS n FROM p GROUP BY ALL"))
def a08(spark, d):
    """The merged snapshot lost the rows with skills; the union of batches spans more and is chosen."""
    df = fx.postings(spark, d)
    chosen = D.pick_snapshot(df.where(F.size("skills") == 0), df)
    return E.assign_month(chosen).groupBy("posted_month").agg(F.count(F.lit(1)).alias("n"))


@query("a09_register_tables", sql(SQL_POSTINGS, """
SELECT source, CAST(count(*) AS BIGINT) AS total_postings, count(DISTINCT company_norm) AS employers FROM p GROUP BY source"""))
def a09(spark, d):
    lake = fx.work_lake(spark, "a09")
    df = fx.postings(spark, d)
    for name, fact in E.build_facts(df, "r1", places=None).items():
        A.write_fact(fact, name, lake)
    A.publish_latest(E.resolve_run(df).withColumn("run_id", F.lit("r1")), lake)
    for source, _ in DIALECTS:
        SN.replace(df.where(F.col("source") == source), lake, source, "r1")
    database = "vacancy_" + lake.root.rsplit("-", 1)[-1]
    A.register_tables(spark, lake, database)
    for source, _ in DIALECTS:
        SN.register(spark, lake, source, database)
    return spark.sql(f"""SELECT source, total_postings, employers FROM (
        SELECT source, sum(job_count) AS total_postings FROM {database}.role_demand_monthly
        JOIN {database}.latest_run_metadata USING (source, run_id) GROUP BY source) JOIN (
        SELECT source, count(DISTINCT company_norm) AS employers FROM (
          SELECT source, company_norm FROM {database}.postings_src_a UNION ALL
          SELECT source, company_norm FROM {database}.postings_src_b)
        JOIN {database}.latest_run_metadata USING (source) GROUP BY source) USING (source)""")


# --- incremental landing -----------------------------------------------------------------------------------

WATERMARK = 1705708800  # 2024-01-20T00:00:00Z


def _events(spark, d):
    return fx.table(spark, d, "events").withColumns({
        "source": F.col("event_type"), "created": F.unix_timestamp(F.col("ts").cast("timestamp"))})


@query("b01_select_incremental", f"""
SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS created FROM events WHERE floor(epoch(ts)) > {WATERMARK} - 48 * 3600""")
def b01(spark, d):
    rows, _ = B.select_incremental(_events(spark, d), F.col("created"), WATERMARK, 48)
    return rows.select("event_id", "created")


@query("b01_landing_report", f"""
SELECT 'lookback' AS filter_mode, count(*) AS fetched, CAST(count_if(c > {WATERMARK - 86400 * 5}) AS BIGINT) AS landed,
  CAST(count_if(c <= {WATERMARK - 86400 * 5}) AS BIGINT) AS filtered_out, CAST({WATERMARK} AS BIGINT) AS watermark_before,
  CAST({WATERMARK - 86400 * 5} AS BIGINT) AS cutoff, max(c) AS max_created, min(c) AS min_created
FROM (SELECT CAST(floor(epoch(ts)) AS BIGINT) AS c FROM events)""")
def b01_report(spark, d):
    """A cap earlier than watermark - lookback wins."""
    return B.select_incremental(_events(spark, d), F.col("created"), WATERMARK, 48, WATERMARK - 86400 * 5)[1]


@query("b02_floor_mode", """
SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-25 00:00:00'""")
def b02(spark, d):
    fetched = B.floor_fetch(fx.table(spark, d, "events").select("event_id", "ts"), "ts", "2024-01-25 00:00:00")
    return B.select_incremental(fetched, F.unix_timestamp(F.col("ts").cast("timestamp")), WATERMARK, 48,
                                mode="floor")[0].select("event_id")


@query("b03_next_watermark", """
SELECT event_type AS source, CAST(max(floor(epoch(ts))) AS BIGINT) AS fetch_watermark FROM events GROUP BY ALL""")
def b03(spark, d):
    return B.next_watermark(_events(spark, d), F.col("created"))


@query("b03_state_round_trip", """
SELECT event_type AS source, 'main' AS slice, CAST(max(floor(epoch(ts))) AS BIGINT) AS fetch_watermark,
  CAST(1 AS BIGINT) AS batch_id FROM events GROUP BY ALL""")
def b03_state(spark, d):
    """Two committed batches per source; the newer state is in force."""
    lake = fx.work_lake(spark, "b03")
    for r in B.next_watermark(_events(spark, d), F.col("created")).collect():  # one row per source
        for batch in (0, 1):
            ST.write_state(spark, lake.root, {
                **ST.read_state(spark, lake.root, r["source"]), "fetch_watermark": r["fetch_watermark"] - 1 + batch,
                "batch_id": batch})
    rows = spark.read.schema(ST.SCHEMA).parquet(f"{lake.root}/state")
    best = rows.groupBy("source", "slice").agg(F.max_by("fetch_watermark", "batch_id").alias("fetch_watermark"),
                                               F.max("batch_id").alias("batch_id"))
    return best


@query("b04_job_key", sql(SQL_LANDING, "SELECT source, k AS o_orderkey, job_id, job_id_strategy FROM ln"))
def b04(spark, d):
    rows = fx.payloads(spark, d)
    return reduce(DataFrame.unionByName, [B.with_job_key(rows.where(F.col("source") == s), dialect) for s, dialect
                                          in DIALECTS]).select("source", "o_orderkey", "job_id", "job_id_strategy")


@query("b04_job_key_fallback", """
SELECT doc_id, sha256('corpus|fallback||' || '|' || '|' || CAST(doc_id AS VARCHAR)) AS job_id,
  'fallback_text_time' AS job_id_strategy FROM documents""")
def b04_fallback(spark, d):
    """No slug, no url: text and time fields are hashed, missing ones as empty text."""
    docs = fx.table(spark, d, "documents").select(
        "doc_id", F.lit("corpus").alias("source"), F.to_json(F.struct(F.col("doc_id").alias("created_at")))
        .alias("raw_payload"))
    return B.with_job_key(docs, B.BOARD).select("doc_id", "job_id", "job_id_strategy")


@query("b05_to_landing", sql(SQL_LANDING, """
SELECT source, 'v1' AS schema_version, job_id, job_id_strategy, source_job_id, source_slug, source_url,
  bronze_ingest_date || 'T00:00:00Z' AS ingested_at, run_id, bronze_ingest_date,
  bronze_ingest_date || 'T00:00:00Z' AS batch_created_at, title FROM ln"""))
def b05(spark, d):
    return _landing(spark, d).withColumn("title", F.get_json_object("raw_payload", "$.title")).drop("raw_payload")


STREAM_LOOKBACK = 24 * 31


STREAM_SQL = f"""
SELECT source, CASE WHEN source = 'src_a' THEN 'job-' || k ELSE CAST(k AS VARCHAR) END AS source_job_id, CAST(b AS BIGINT) AS batch
FROM (SELECT source, k, b, created, max(top) OVER (PARTITION BY source ORDER BY b RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS wm
  FROM (SELECT *, max(created) OVER (PARTITION BY source, b) AS top FROM (
    SELECT source, k, CAST(epoch(day) AS BIGINT) AS created,
      (least(year(day) + CASE WHEN k % 50 = 0 THEN 1 ELSE 0 END, 2001) - 1995) // 2 AS b FROM p)))
WHERE wm IS NULL OR created > wm - {STREAM_LOOKBACK} * 3600"""


#: Rows in a file of a year, where all years hold that many.
FILE_ROWS = 50_000


def _incoming(spark, d, lake, source: str, copies: int = 0) -> tuple[str, int]:
    """Files of each year, in the order of years; every fiftieth posting comes a year late. `copies` repeats postings in
    the files of the next year. Returns the folders and the number of files a year, which is the same for all years, so
    that so many times the files of a micro-batch make the same micro-batches."""
    rows = fx.payloads(spark, d).where(F.col("source") == source)
    year = F.least(F.year("day") + F.when(F.col("o_orderkey") % 50 == 0, 1).otherwise(0), F.lit(2001))
    spread = rows.withColumn("y", year)
    if copies:
        again = spread.where(F.col("o_orderkey") % copies == 0).withColumn("y", F.least(F.col("y") + 1, F.lit(2001)))
        spread = spread.unionByName(again)
    # Joined and spelled out once, by all tasks, instead of once a year by a single one.
    path = f"{lake.root}/spread/{source}"
    spread.select("source", "raw_payload", "y").write.partitionBy("y").option("compression", "zstd").parquet(path)
    spread = spark.read.schema("source string, raw_payload string, y int").parquet(path)
    held = {r["y"]: r["n"] for r in spread.groupBy("y").agg(F.count("*").alias("n")).collect()}
    parts = max(1, min(held.get(y, 0) for y in range(1995, 2002)) // FILE_ROWS)
    for y in range(1995, 2002):
        of_year = spread.where(F.col("y") == y).select("source", "raw_payload")
        (of_year.coalesce(1) if parts == 1 else of_year.repartition(parts)).write.mode("append").json(
            f"{lake.root}/incoming/{source}/y={y}")
    return f"{lake.root}/incoming/{source}/*", parts


def _stream(spark, lake, src, source, dialect, checkpoint="stream", lookback=STREAM_LOOKBACK, files=2):
    STREAM.start_landing_stream(spark, src, lake, f"{lake.root}/{checkpoint}/{source}", source, dialect, lookback,
                                files_per_trigger=files, aggregator_sources=("src_b",), places=None).awaitTermination()


@query("b06_landing_stream", sql(SQL_POSTINGS, STREAM_SQL))
def b06(spark, d):
    """Both dialects, two files per micro-batch; what arrives in a later batch and is older than the lookback is dropped."""
    lake = fx.work_lake(spark, "b06")
    for source, dialect in DIALECTS:
        src, parts = _incoming(spark, d, lake, source)
        _stream(spark, lake, src, source, dialect, files=2 * parts)
    out = reduce(DataFrame.unionByName, [STREAM.current_postings(spark, lake, s, None) for s, _ in DIALECTS])
    return out.select("source", "source_job_id", F.element_at(F.split("bronze_run_id", "-"), -1).cast("long").alias("batch"))


@query("b06_restart", sql(SQL_POSTINGS, """
SELECT source, CASE WHEN source = 'src_a' THEN 'job-' || k ELSE CAST(k AS VARCHAR) END AS source_job_id,
  CAST(epoch(max(day) OVER (PARTITION BY source)) AS BIGINT) AS fetch_watermark FROM p"""))
def b06_restart(spark, d):
    """Postings repeat across the files of a batch; the first half of the years runs under one checkpoint, then all
    files under a new one, whose batch 0 must not replace the folders of the old. Nothing is older than the lookback."""
    lake, parts = fx.work_lake(spark, "b06r"), []
    for source, dialect in DIALECTS:
        src, files = _incoming(spark, d, lake, source, copies=7)
        early = src.replace("/*", "/y={1995,1996,1997,1998}")
        _stream(spark, lake, early, source, dialect, "first", 24 * 366 * 20, 2 * files)
        _stream(spark, lake, src, source, dialect, "second", 24 * 366 * 20, 3 * files)
        top = ST.read_state(spark, lake.root, source, before_batch=0, query="any")["fetch_watermark"]
        parts.append(STREAM.current_postings(spark, lake, source, None).select(
            "source", "source_job_id", F.lit(top).cast("long").alias("fetch_watermark")))
    return parts[0].unionByName(parts[1])


@query("b06_keyed_state", sql(SQL_POSTINGS, """
SELECT source, job_id, CASE WHEN k % 10 < 2 THEN 'newer' ELSE title_norm END AS title_norm, CAST(k % 10 < 2 AS BIGINT) AS changed
FROM p"""))
def b06_keyed_state(spark, d):
    """Newest versions as stream state, restarted after every file: first versions, then newer, older and repeated ones.
    What the state gave out last is in the last run of the snapshot."""
    lake, parts = fx.work_lake(spark, "b06s"), []
    df = fx.stored_postings(spark, d, lake, False)
    k = F.col("source_job_id").cast("long")
    later = df.where(k % 10 < 2).withColumns({"title_norm": F.lit("newer"), "bronze_ingest_date": F.lit("2030-01-01")})
    older = df.where((k % 10).isin(4, 5)).withColumns({"title_norm": F.lit("older"), "bronze_ingest_date": F.lit("1990-01-01")})
    feeds = [df, later.unionByName(older).unionByName(df.where(k % 10 > 5))]
    for source, _ in DIALECTS:
        for feed in feeds:
            feed.where(F.col("source") == source).repartition(4).write.mode("append").parquet(f"{lake.root}/feed/{source}")
            rows = spark.readStream.schema(POSTING).parquet(f"{lake.root}/feed/{source}")
            CS.start_current_stream(spark, rows, lake, f"{lake.root}/keyed/{source}", source, "ingested_at",
                                    24 * 366 * 20).awaitTermination()
        state = SN.version(spark, lake, source)
        keys = spark.read.parquet(f"{lake.merged(source)}/data/{state.delta}").select("job_id", F.lit(1).cast("long").alias("changed"))
        parts.append(SN.read(spark, lake, source).join(keys, "job_id", "left"))
    return parts[0].unionByName(parts[1]).select("source", "job_id", "title_norm", F.coalesce("changed", F.lit(0).cast("long")).alias("changed"))


# --- standardisation ---------------------------------------------------------------------------------------

@query("c01_flatten_payload", sql(SQL_LANDING, """
SELECT job_id, trim(title) AS title, c_name AS company,
  CASE WHEN source = 'src_a' THEN n_name ELSE n_name || ', ' || r_name END AS location,
  CASE WHEN source = 'src_a' THEN o_orderpriority || '|K8s' ELSE '' END AS tags, source_slug AS slug,
  CASE WHEN source = 'src_a' THEN '<p>Python &amp; ' || c_mktsegment || '</p>' ELSE 'SQL hybrid ' || c_mktsegment END
    AS description, CASE WHEN source = 'src_b' THEN 'it jobs' ELSE '' END AS category_context FROM ln"""))
def c01(spark, d):
    flat = C.flatten_payload(_landing(spark, d), ("src_b",))
    return flat.select("job_id", "title", "company", "location", F.array_join("tags", "|").alias("tags"), "slug",
                       "description", "category_context")


@query("c01_json_types", sql(SQL_POSTINGS, """
SELECT k, CASE k % 5 WHEN 0 THEN true WHEN 1 THEN false END AS remote_flag,
  CASE k % 5 WHEN 0 THEN strftime(day, '%Y-%m-%d') WHEN 1 THEN strftime(day, '%Y-%m-%d') WHEN 4 THEN '2023-11-14' END AS posted_on FROM p"""))
def c01_types(spark, d):
    """Booleans and numbers as such; text that looks like them is neither."""
    o = fx.orders_wide(spark, d)
    k, sec = F.col("o_orderkey"), F.unix_timestamp("day")
    remote = pick_sql(k, "true", "false", '"yes"', "1", '"true"')
    created = (F.when(k % 5 == 0, sec.cast("string")).when(k % 5 == 1, F.concat(F.lit('"'), sec, F.lit('"')))
               .when(k % 5 == 2, F.lit('"-5"')).when(k % 5 == 3, F.lit('"1.7e9"')).otherwise(F.lit("1.7e9")))
    body = F.concat(F.lit('{"slug": "s", "remote": '), remote, F.lit(', "created_at": '), created, F.lit("}"))
    rows = o.select(k.alias("k"), F.lit("src_a").alias("source"), F.lit("s").alias("source_slug"), body.alias("raw_payload"))
    return C.flatten_payload(rows).select(
        "k", "remote_flag", F.date_format(X.posted_at("created_raw", "created_iso"), "yyyy-MM-dd").alias("posted_on"))


def pick_sql(key, *values):
    return fx.pick(values, key % len(values))


@query("c02_html_to_text", r"""
SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
  regexp_replace(replace(replace(replace(html, '&copy;', '©'), '&middot;', '·'), '&quot;', '"'), '&amp;?', '&', 'g'),
  '(?is)<script[^>]*>.*?</script>', ' ', 'g'), '(?is)<style[^>]*>.*?</style>', ' ', 'g'), '<[^>]+>', ' ', 'g'),
  '\s+', ' ', 'g')) AS body FROM pages""")
def c02(spark, d):
    return C.html_to_text(fx.table(spark, d, "pages"), "html", "body").select("page_id", "body")


def _collapse(e: str) -> str:
    return f"trim(regexp_replace({e}, '\\s+', ' ', 'g'))"


_EDGE_SQL = r"[\s.,;:|/\\-]+"


def _edge_sql(e: str) -> str:
    return f"regexp_replace(regexp_replace({e}, '^{_EDGE_SQL}', ''), '{_EDGE_SQL}$', '')"


TITLE_SQL = "lower(trim(regexp_replace(" + _edge_sql(_collapse(
    "regexp_replace(" + _collapse("title_raw") + r", '(?i) ?\([mfwd]/[mfwd]/[mfwd]\)', ' ', 'g')")) + ", ' ?/ ', ' ', 'g')))"


@query("c03_normalize_titles", sql(SQL_POSTINGS, f"""
SELECT title_raw, {TITLE_SQL} AS title_norm, count(*) AS n FROM p GROUP BY ALL"""))
def c03(spark, d):
    df = C.normalize_titles(fx.postings(spark, d, False), "title_raw", "title_norm")
    return df.groupBy("title_raw", "title_norm").agg(F.count(F.lit(1)).alias("n"))


@query("c04_enrich_titles", sql(SQL_POSTINGS + f", t AS (SELECT k, {TITLE_SQL} AS t, lower(c_mktsegment) AS tag FROM p)", """
SELECT k, CASE WHEN (t NOT LIKE '% %' OR t IN ('head of')) AND t <> '' AND tag <> 'building' THEN t || ' - ' || tag ELSE t END
  AS title_norm FROM t"""))
def c04(spark, d):
    """One segment carries a vague tag, which never enriches."""
    df = fx.postings(spark, d, False).select(
        F.col("source_job_id").cast("long").alias("k"), T.normalize_title("title_raw").alias("title_norm"),
        F.split("company_norm", "#")[0].alias("_"), F.split("title_norm", " ")[0].alias("seg"))
    df = df.withColumn("category_tag", F.when(F.col("seg") == "building", "general").otherwise(F.col("seg")))
    return C.enrich_titles(df).select("k", "title_norm")


@query("c05_normalize_companies", sql(SQL_POSTINGS, """
SELECT k, CASE k % 3 WHEN 0 THEN lower(c_name) WHEN 1 THEN 'the ab' ELSE replace(lower(c_name), '#', ' ai ') END AS company_norm
FROM p"""))
def c05(spark, d):
    """Bars, a leading article on long and short names, edge punctuation."""
    df = fx.orders_wide(spark, d)
    k = F.col("o_orderkey")
    raw = (F.when(k % 3 == 0, F.concat(F.lit(" The  "), "c_name", F.lit(" ,-")))
           .when(k % 3 == 1, F.lit("The Ab")).otherwise(F.replace("c_name", F.lit("#"), F.lit("| AI |"))))
    return C.normalize_companies(df.select(k.alias("k"), raw.alias("company_norm")), "company_norm")


@query("c06_normalize_locations", sql(SQL_POSTINGS, """
SELECT k, CASE k % 5 WHEN 0 THEN location_raw WHEN 1 THEN location_raw || ', ' || region WHEN 2 THEN location_raw
  WHEN 3 THEN 'berlin' ELSE '' END AS location FROM p"""))
def c06(spark, d):
    """First two of three equal; adjacent repeats; edge marks; a known spelling; only punctuation."""
    df = fx.orders_wide(spark, d)
    k, n, r = F.col("o_orderkey"), F.col("n_name"), F.col("r_name")
    raw = (F.when(k % 5 == 0, F.concat(n, F.lit(", "), n, F.lit(" ,"), r)).when(k % 5 == 1, F.concat(n, F.lit(",,"), r, F.lit(" , "), r))
           .when(k % 5 == 2, F.concat(F.lit(" - "), n, F.lit(" ."))).when(k % 5 == 3, F.lit("Berlin,  Germany")).otherwise(F.lit(" ,; ")))
    return C.normalize_locations(df.select(k.alias("k"), raw.alias("location")), "location", places=None)


@query("c07_canonicalize_places", sql(SQL_POSTINGS, """
SELECT job_id, place, CASE k % 5 WHEN 0 THEN location_raw || ', ' || region WHEN 1 THEN region || ', world' WHEN 2 THEN ''
  ELSE location_raw || ', ' || region END AS canonical FROM p"""))
def c07(spark, d):
    df = C.canonicalize_places(fx.postings(spark, d, False), "place", fx.PLACES, "canonical")
    return df.select("job_id", "place", "canonical")


@query("c07_places_table", sql(SQL_POSTINGS, """
SELECT k, CASE k % 6 WHEN 0 THEN company_norm || ', ' || location_raw WHEN 1 THEN company_norm || ', ' || location_raw
  WHEN 2 THEN company_norm || ', ' || location_raw WHEN 3 THEN location_raw || ', world'
  WHEN 4 THEN company_norm || ', ' || location_raw ELSE 'elsewhere ' || k END AS place FROM p"""))
def c07_table(spark, d):
    """Every customer is a city of the state its nation names, under two spellings; the gazetteer grows with them."""
    city, state = F.lower("c_name"), F.lower("n_name")
    nations = fx.table(spark, d, "nation")
    at = fx.table(spark, d, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    short = F.concat(F.lit("no. "), F.col("c_custkey"))
    none = F.lit(None).cast("string")
    gazetteer = reduce(DataFrame.unionByName, [
        at.select(city.alias("name"), F.lit("city").alias("kind"), state.alias("target")),
        at.select(short.alias("name"), F.lit("alias").alias("kind"), city.alias("target")),
        nations.select(state.alias("name"), F.lit("state").alias("kind"), none.alias("target")),
        nations.limit(1).select(F.lit("world").alias("name"), F.explode(F.array(F.lit("country"), F.lit("context"))).alias("kind"),
                                none.alias("target"))])
    o = fx.orders_wide(spark, d)
    k = F.col("o_orderkey")
    alias = F.concat(F.lit(" no. "), F.col("o_custkey"))
    raw = (F.when(k % 6 == 0, city).when(k % 6 == 1, F.concat(city, F.lit(" ,world"))).when(k % 6 == 2, F.concat(alias, F.lit(", world")))
           .when(k % 6 == 3, F.concat(state, F.lit(", "), state)).when(k % 6 == 4, F.concat(alias, F.lit(", "), state, F.lit(", world")))
           .otherwise(F.concat(F.lit("elsewhere "), k)))
    return G.canonicalize(o.select(k.alias("k"), raw.alias("place")), "place", gazetteer, "world")


@query("c07_longest_suffix", sql(SQL_POSTINGS, """
SELECT k, CASE WHEN k % 5 < 3 THEN 'of ' || location_raw WHEN k % 5 = 3 THEN 'in ' || region END AS place,
  CASE k % 5 WHEN 0 THEN 'dock ' || k % 7 WHEN 1 THEN '' WHEN 2 THEN 'order' WHEN 3 THEN company_norm || ', order ' || k
    ELSE 'order ' || k END AS rest
FROM p"""))
def c07_suffix(spark, d):
    """Names of one and of two segments: a customer in its nation wins over the nation alone."""
    city, state = F.lower("c_name"), F.lower("n_name")
    nations = fx.table(spark, d, "nation").join(fx.table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    at = fx.table(spark, d, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    names = nations.select(state.alias("name"), F.concat(F.lit("in "), F.lower("r_name")).alias("value")).unionByName(
        at.select(F.concat(city, F.lit(","), state).alias("name"), F.concat(F.lit("of "), state).alias("value")))
    o = fx.orders_wide(spark, d)
    k = F.col("o_orderkey")
    pair = F.concat(city, F.lit(" , "), state)
    raw = (F.when(k % 5 == 0, F.concat(F.lit("dock "), k % 7, F.lit(", "), pair)).when(k % 5 == 1, pair)
           .when(k % 5 == 2, F.concat(F.lit("order, "), city, F.lit(", ,"), state))
           .when(k % 5 == 3, F.concat(city, F.lit(", order "), k, F.lit(","), state)).otherwise(F.concat(F.lit("order "), k)))
    found = G.longest_suffix(o.select(k.alias("k"), raw.alias("raw")), "raw", names, "place", "rest")
    return found.select("k", "place", "rest")


@query("c08_resolve_area", sql(SQL_POSTINGS, """
SELECT k, CASE k % 5 WHEN 0 THEN n_name || ', ' || r_name WHEN 1 THEN n_name WHEN 2 THEN n_name || ', ' || r_name
  WHEN 3 THEN r_name || ' shown' ELSE '' END AS location FROM p"""))
def c08(spark, d):
    df = fx.orders_wide(spark, d)
    k, n, r = F.col("o_orderkey"), F.col("n_name"), F.col("r_name")
    display = (F.when(k % 5 <= 1, F.lit("India")).when(k % 5 == 3, F.concat(r, F.lit(" shown"))).otherwise(F.lit(None)))
    area = (F.when(k % 5 == 0, F.array(F.lit("India"), r, n)).when(k % 5 == 1, F.array(F.lit("India"), n))
            .when(k % 5 == 2, F.array(r, n)).otherwise(F.array().cast("array<string>")))
    return C.resolve_area(df.select(k.alias("k"), display.alias("shown"), area.alias("area")), "shown", "area",
                          "location").select("k", "location")


@query("c09_work_mode", sql(SQL_POSTINGS, """
SELECT k, CASE WHEN o_orderstatus = 'O' THEN 'hybrid' WHEN title_raw LIKE '%(remote)%' THEN 'remote'
  WHEN o_orderstatus = 'F' THEN 'onsite' ELSE 'unknown' END AS remote_type FROM p"""))
def c09(spark, d):
    df = fx.orders_wide(spark, d)
    status = F.col("o_orderstatus")
    body = F.when(status == "O", "Hybrid, or on-site").when(status == "F", "Report to Office").otherwise("")
    rows = df.select(F.col("o_orderkey").alias("k"), fx.pick(fx.TITLES, F.col("o_orderkey") % len(fx.TITLES)).alias("t"),
                     body.alias("b"))
    return C.classify_work_mode(rows, "t", "b").select("k", "remote_type")


WORD_MODES = (("hybrid", r"\bthe\b"), ("remote", r"\b(der|die)\b"), ("onsite", r"\ble\b"))


@query("c09_work_mode_corpus", r"""
SELECT doc_id, CASE WHEN regexp_matches(t, '(^|[^\p{L}\p{N}_])the($|[^\p{L}\p{N}_])') THEN 'hybrid'
  WHEN regexp_matches(t, '(^|[^\p{L}\p{N}_])(der|die)($|[^\p{L}\p{N}_])') THEN 'remote'
  WHEN regexp_matches(t, '(^|[^\p{L}\p{N}_])le($|[^\p{L}\p{N}_])') THEN 'onsite' ELSE 'unknown' END AS remote_type
FROM (SELECT doc_id, lower(text) AS t FROM documents)""")
def c09_corpus(spark, d):
    """Whole texts; Unicode word boundaries."""
    docs = fx.table(spark, d, "documents")
    return C.classify_work_mode(docs, "text", patterns=WORD_MODES).select("doc_id", "remote_type")


@query("c10_parse_posted_at", """
SELECT event_id, CASE WHEN event_id % 5 <> 4 THEN strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') END AS posted_at
FROM events""")
def c10(spark, d):
    """Epoch number, digit text, ISO with Z, ISO with offset, garbage."""
    ev = _events(spark, d)
    ts = F.col("ts").cast("timestamp")
    k = F.col("event_id") % 5
    shifted = F.date_format(ts + F.expr("INTERVAL 2 HOURS"), "yyyy-MM-dd'T'HH:mm:ss.SSS'+02:00'")
    raw = (F.when(k == 0, F.col("created").cast("string")).when(k == 1, F.concat(F.lit(" "), F.col("created")))
           .when(k == 2, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")).when(k == 3, shifted).otherwise(F.lit("soon")))
    out = C.parse_posted_at(ev.select("event_id", raw.alias("raw")), "raw")
    return out.select("event_id", F.date_format("posted_at", "yyyy-MM-dd HH:mm:ss").alias("posted_at"))


def _blob_sql(e: str) -> str:
    return f"trim(regexp_replace(regexp_replace(lower({e}), '[^\\p{{L}}\\p{{N}}_/+.#-]+', ' ', 'g'), ' +', ' ', 'g'))"


@query("c11_tag_terms", f"""
WITH b AS (SELECT string_split({_blob_sql('text')}, ' ') AS w FROM benchmark),
v AS (SELECT DISTINCT unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS g FROM b),
dw AS (SELECT doc_id, string_split({_blob_sql('text')}, ' ') AS w FROM documents),
dg AS (SELECT DISTINCT doc_id, unnest(list_concat(w, list_filter(list_transform(w, lambda x: trim(x, '.#_/-')), lambda x: len(x) >= 2),
    list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS g FROM dw),
h AS (SELECT doc_id, count(*) AS n_terms, md5(string_agg(g, '|' ORDER BY g)) AS terms FROM dg JOIN v USING (g)
  WHERE length(g) > 0 GROUP BY doc_id)
SELECT doc_id, coalesce(n_terms, 0) AS n_terms, coalesce(terms, md5('')) AS terms FROM documents LEFT JOIN h USING (doc_id)""")
def c11(spark, d):
    """Vocabulary of all benchmark words and word pairs against the whole texts."""
    blob = S.token_text("text")
    words = fx.table(spark, d, "benchmark").select(F.split(blob, " ").alias("w"))
    pairs = F.transform(F.sequence(F.lit(1), F.size("w") - 1), lambda i: F.array_join(F.slice("w", i, 2), " "))
    vocab = words.select(F.explode(F.concat("w", F.when(F.size("w") > 1, pairs).otherwise(F.array().cast("array<string>"))))
                         .alias("term")).where("term <> ''").distinct()
    out = C.tag_terms(fx.table(spark, d, "documents"), vocab, "doc_id", "text", unique_key=True)
    return out.select("doc_id", F.size("skills").cast("long").alias("n_terms"), F.md5(F.array_join("skills", "|")).alias("terms"))


@query("c11_tag_terms_long", f"""
WITH b AS (SELECT string_split({_blob_sql('text')}, ' ') AS w FROM benchmark),
v AS (SELECT DISTINCT unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS g FROM b),
dw AS (SELECT doc_id, string_split({_blob_sql('text')}, ' ') AS w FROM documents),
dg AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS g FROM dw),
h AS (SELECT doc_id, count(*) AS n_terms, md5(string_agg(g, '|' ORDER BY g)) AS terms FROM dg JOIN v USING (g) GROUP BY doc_id)
SELECT doc_id, coalesce(n_terms, 0) AS n_terms, coalesce(terms, md5('')) AS terms FROM documents LEFT JOIN h USING (doc_id)""")
def c11_long(spark, d):
    """Terms of three words, all triples of the benchmark."""
    words = fx.table(spark, d, "benchmark").select(F.split(S.token_text("text"), " ").alias("w")).where(F.size("w") > 2)
    triples = F.transform(F.sequence(F.lit(1), F.size("w") - 2), lambda i: F.array_join(F.slice("w", i, 3), " "))
    out = C.tag_terms(fx.table(spark, d, "documents"), words.select(F.explode(triples).alias("term")).distinct(), "doc_id", "text", unique_key=True)
    return out.select("doc_id", F.size("skills").cast("long").alias("n_terms"), F.md5(F.array_join("skills", "|")).alias("terms"))


@query("c11_tag_terms_joined", f"""
WITH b AS (SELECT string_split({_blob_sql('text')}, ' ') AS w FROM benchmark),
v AS (SELECT DISTINCT unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g FROM b),
dw AS (SELECT doc_id, string_split({_blob_sql('text')}, ' ') AS w FROM documents),
dg AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g FROM dw),
h AS (SELECT doc_id, count(*) AS n_terms, md5(string_agg(g, '|' ORDER BY g)) AS terms FROM dg JOIN v USING (g) GROUP BY doc_id)
SELECT doc_id, coalesce(n_terms, 0) AS n_terms, coalesce(terms, md5('')) AS terms FROM documents LEFT JOIN h USING (doc_id)""")
def c11_joined(spark, d):
    """The way of vocabularies too large for an automaton: word pairs of the benchmark, joined."""
    words = fx.table(spark, d, "benchmark").select(F.split(S.token_text("text"), " ").alias("w")).where(F.size("w") > 1)
    pairs = F.transform(F.sequence(F.lit(1), F.size("w") - 1), lambda i: F.array_join(F.slice("w", i, 2), " "))
    out = C.join_terms(fx.table(spark, d, "documents"), words.select(F.explode(pairs).alias("term")).distinct(), "doc_id", "text")
    return out.select("doc_id", F.size("skills").cast("long").alias("n_terms"), F.md5(F.array_join("skills", "|")).alias("terms"))


_TERMS = ", ".join(f"('{t}')" for t in R.SKILL_TERMS)
_ALIASES = ", ".join(f"('{k}', '{t}')" for k, v in R.SKILL_ALIASES.items() if " " not in k for t in v)
SQL_TAGGED = SQL_LANDING + f""", v(term) AS (VALUES {_TERMS}), al(alias, term) AS (VALUES {_ALIASES}),
txt AS (SELECT job_id, source, ' ' || {_blob_sql("title || ' ' || CASE WHEN source = 'src_a' THEN 'Python & ' || c_mktsegment || ' ' || o_orderpriority || ' K8s' ELSE 'SQL hybrid ' || c_mktsegment || ' it jobs' END")} || ' ' AS b FROM ln),
tg AS (SELECT job_id, term FROM txt JOIN v ON contains(b, ' ' || term || ' ')
  UNION SELECT job_id, term FROM (SELECT job_id, trim(unnest(string_split(b, ' ')), '.#_/-') AS alias FROM txt) JOIN al USING (alias))"""


@query("c11_tag_skills", sql(SQL_TAGGED, """
SELECT job_id, string_agg(term, '|' ORDER BY term) AS skills FROM tg GROUP BY job_id"""))
def c11_fixed(spark, d):
    """Fixed vocabulary on title, description, tags and category."""
    flat = C.html_to_text(C.flatten_payload(_landing(spark, d), ("src_b",)), "description", "body", False)
    out = C.tag_skills(flat, "title", "body", "tags", "category_context", weak=F.col("is_aggregator"))
    return out.select("job_id", F.array_join("skills", "|").alias("skills"))


@query("c12_enrich_weak_tags", sql(SQL_POSTINGS, """
SELECT k, CASE k % 3 WHEN 0 THEN 'data science|python' WHEN 1 THEN 'python|sql' ELSE 'data science' END AS skills FROM p"""))
def c12(spark, d):
    """One known skill: the category joins the title and completes a phrase; two skills stay as they are."""
    k = F.col("o_orderkey")
    rows = fx.table(spark, d, "orders").select(
        k.alias("k"), F.lit("Senior Data").alias("title"), F.col("o_orderpriority").alias("body"), F.lit("Science").alias("ctx"),
        F.when(k % 3 == 0, F.array(F.lit("python"))).when(k % 3 == 1, F.array(F.lit("sql"), F.lit("python")))
        .otherwise(F.array().cast("array<string>")).alias("skills"))
    more = S.enrich_weak(F.col("skills"), F.col("title"), F.col("body"), F.col("ctx"))
    return rows.select("k", F.array_join(more, "|").alias("skills"))


@query("c13_tag_fallback", sql(SQL_POSTINGS, """
SELECT k, list_aggregate(list_sort(CASE k % 3 WHEN 0 THEN [lower(c_mktsegment), lower(o_orderpriority)]
  WHEN 1 THEN [lower(c_mktsegment)] ELSE [lower(o_orderpriority), 'seg'] END), 'string_agg', '|') AS skills FROM p"""))
def c13(spark, d):
    """Tags as list, text and object; nothing matches the vocabulary, so the cleaned tags stand in."""
    df = fx.orders_wide(spark, d)
    k, seg, pri = F.col("o_orderkey"), F.col("c_mktsegment"), F.col("o_orderpriority")
    raw = (F.when(k % 3 == 0, F.to_json(F.array(pri, seg, F.lit(" x "), F.lit(""), seg))).when(k % 3 == 1, seg)
           .otherwise(F.to_json(F.struct(pri.alias("a"), k.alias("seg")))))
    tags = S.tag_list(raw)
    out = S.extract_skills(tags, F.lit(""), F.lit(""), F.lit(""))
    return df.select(k.alias("k"), F.array_join(out, "|").alias("skills"))


@query("c14_skills_codec", sql(SQL_POSTINGS, """
SELECT job_id, CASE WHEN len(skills) = 0 THEN '[]' ELSE '["' || list_aggregate(skills, 'string_agg', '","') || '"]' END AS json,
  len(skills) AS n_back, CASE WHEN len(skills) = 0 THEN '' ELSE '["broken|' END AS scalar_back FROM p"""))
def c14(spark, d):
    """Array to JSON and back; bad JSON is taken as one skill."""
    df = fx.postings(spark, d).withColumn("json", S.skills_to_json("skills"))
    bad = F.when(F.size("skills") > 0, F.lit(' ["broken')).otherwise(F.lit(None))
    return df.select("job_id", "json", F.size(S.skills_from_json("json")).cast("long").alias("n_back"),
                     F.array_join(F.transform(S.skills_from_json(bad), lambda s: F.concat(s, F.lit("|"))), "").alias("scalar_back"))


@query("c15_project_contract", sql(SQL_POSTINGS, f"""
SELECT job_id, {len(POSTING)} AS n_columns, title_norm, CAST(NULL AS VARCHAR) AS company_norm, CAST(0 AS BIGINT) AS n_skills,
  strftime(day, '%Y-%m-%d') AS posted_on FROM p"""))
def c15(spark, d):
    df = fx.postings(spark, d, False)
    text_time = F.concat(F.date_format(F.date_sub(F.to_date("bronze_ingest_date"), 1), "yyyy-MM-dd"), F.lit("T10:00:00Z"))
    out = C.project_contract(df.drop("company_norm", "skills").withColumn("posted_at", text_time))
    return out.select("job_id", F.lit(len(out.columns)).alias("n_columns"), "title_norm", "company_norm",
                      F.size("skills").cast("long").alias("n_skills"), F.date_format("posted_at", "yyyy-MM-dd").alias("posted_on"))


@query("c16_align_legacy", sql(SQL_POSTINGS, """
SELECT job_id, source, CASE source WHEN 'src_a' THEN CAST(k AS VARCHAR) END AS source_job_id, title_norm, company_norm,
  location_raw, CASE o_orderstatus WHEN 'P' THEN 'unknown' ELSE remote_type END AS remote_type, list_aggregate(skills, 'string_agg', '|') AS skills
FROM p"""))
def c16(spark, d):
    """Two earlier layouts renamed from the current one, aligned and put together."""
    df = fx.postings(spark, d)
    flag = F.when(F.col("remote_type") == "remote", True).when(F.col("remote_type") == "onsite", False)
    one = df.where("source = 'src_a'").select(
        "job_id", "source", F.upper("title_norm").alias("title_raw"), F.upper("company_norm").alias("company_raw"),
        F.upper("location_raw").alias("location"), flag.alias("is_remote"), "skills", F.col("source_job_id").alias("source_record_key"))
    two = df.where("source = 'src_b'").select(
        "job_id", "source", F.col("title_norm").alias("title"), F.lit("x").alias("title_clean"),
        F.upper("company_norm").alias("company_name"), "location_raw", "remote_type", S.skills_to_json("skills").alias("skills"),
        F.concat(F.lit("http://x/"), "source_job_id").alias("source_record_key"))
    both = C.align_legacy(one, None).unionByName(C.align_legacy(two, None))
    return both.select("job_id", "source", "source_job_id", "title_norm", "company_norm", "location_raw", "remote_type",
                       F.nullif(F.array_join("skills", "|"), F.lit("")).alias("skills"))


# --- current state -----------------------------------------------------------------------------------------

@query("d01_dedup_batch", """
SELECT user_id || '|' || event_type AS job_id, min(event_id) AS event_id, min_by(value, event_id) AS value
FROM events GROUP BY user_id, event_type""")
def d01(spark, d):
    ev = fx.table(spark, d, "events").withColumn("job_id", F.concat_ws("|", "user_id", "event_type"))
    return D.dedup_batch(ev, ["event_id"], keep_order=True).select("job_id", "event_id", "value")


@query("d01_dedup_conversations", """
SELECT conv_id, arg_min(role, turn) AS role, arg_min(text, turn) AS text FROM conversations GROUP BY conv_id""")
def d01_conversations(spark, d):
    return D.dedup_batch(fx.table(spark, d, "conversations"), ["turn"], "conv_id").select("conv_id", "role", "text")


@query("d02_upsert_history", """
SELECT job_id, event_id, value FROM (
  SELECT *, user_id || '|' || event_type AS job_id, row_number() OVER (PARTITION BY user_id, event_type
    ORDER BY strftime(ts, '%Y-%m-%d') DESC, event_id % 3 DESC, ts >= TIMESTAMP '2024-01-16' DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1""")
def d02(spark, d):
    """Many versions per key in both sides, equal lineage included."""
    ev = fx.table(spark, d, "events").withColumns({
        "job_id": F.concat_ws("|", "user_id", "event_type"), "bronze_ingest_date": F.date_format("ts", "yyyy-MM-dd"),
        "bronze_run_id": (F.col("event_id") % 3).cast("string"), "ingested_at": F.lit(None).cast("string")})
    split = F.col("ts") >= F.lit("2024-01-16").cast("timestamp_ntz")
    out = D.upsert_history(ev.where(~split), ev.where(split), tie=("event_id",))
    return out.select("job_id", "event_id", "value")


@query("d02_upsert_snapshot", sql(SQL_POSTINGS, """
SELECT source, job_id, CASE WHEN k % 10 = 0 THEN 'newer' ELSE title_norm END AS title_norm,
  strftime(CASE WHEN k % 97 <> 0 THEN day END, '%Y-%m') AS month FROM p"""))
def d02_snapshot(spark, d):
    """The stored snapshot: batches become runs of their own; newer lineage wins, older loses, new keys come in."""
    lake, parts = fx.work_lake(spark, "d02"), []
    df = fx.stored_postings(spark, d, lake, False)
    k = F.col("source_job_id").cast("long")
    for source, _ in DIALECTS:
        mine = df.where(F.col("source") == source)
        SN.replace(mine.where(k % 10 != 3), lake, source, "v1")
        newer = mine.where(k % 10 == 0).withColumns({"title_norm": F.lit("newer"), "bronze_ingest_date": F.lit("2030-01-01")})
        older = mine.where(k % 10 == 5).withColumns({"title_norm": F.lit("older"), "bronze_ingest_date": F.lit("1990-01-01")})
        SN.upsert(newer.unionByName(older), lake, source, "v2")
        SN.upsert(mine.where(k % 10 == 3), lake, source, "v3")
        parts.append(SN.read(spark, lake, source))
    return parts[0].unionByName(parts[1]).select("source", "job_id", "title_norm", F.date_format("posted_at", "yyyy-MM").alias("month"))


@query("d03_quality_report", """
WITH l AS (SELECT l_orderkey || '-' || l_linenumber AS job_id, CAST(l_partkey AS VARCHAR) AS sid, p_name, p_brand FROM lineitem
  JOIN part ON l_partkey = p_partkey),
c AS (SELECT count(*) AS row_count, CAST(count_if(p_name LIKE 'small%') AS BIGINT) AS missing_title,
  CAST(count_if(p_brand = 'Brand#2') AS BIGINT) AS missing_company,
  count(*) - count(DISTINCT job_id) AS duplicate_job_id,
  count(*) - count(DISTINCT CASE WHEN p_brand = 'Brand#3' THEN job_id ELSE sid END) AS duplicate_source_key FROM l)
SELECT *, CAST(1 AS BIGINT) AS sources, 4 AS checks_failed, 2 AS checks_passed, 'FAIL' AS status FROM c""")
def d03(spark, d):
    lines = fx.table(spark, d, "lineitem").join(fx.table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    df = lines.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("job_id"), F.lit("shop").alias("source"),
        F.when(F.col("p_brand") == "Brand#3", " ").otherwise(F.col("l_partkey").cast("string")).alias("source_job_id"),
        F.when(~F.col("p_name").startswith("small"), F.col("p_name")).alias("title_norm"),
        F.when(F.col("p_brand") == "Brand#2", " ").otherwise(F.col("p_brand")).alias("company_norm"))
    return D.quality_report(df)


@query("d04_rebuild_snapshot", sql(SQL_POSTINGS, """
SELECT CASE WHEN k % 97 <> 0 THEN posted_month ELSE substr(bronze_ingest_date, 1, 4) || '-12' END AS posted_month,
  count(*) AS "rows" FROM p GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 50"""))
def d04(spark, d):
    """Every posting in two batches; the snapshot holds each once. The audit is a top-50 report."""
    df = _yearly(fx.postings(spark, d, False))
    history = df.unionByName(df.withColumn("bronze_run_id", F.concat("bronze_run_id", F.lit("-again"))))
    lake = fx.work_lake(spark, "d04")
    snapshot, audit = D.rebuild_snapshot(history)
    SN.replace(snapshot.where("source = 'src_a'"), lake, "src_a", "v1")
    return audit


@query("d05_run_month_coverage", sql(SQL_POSTINGS + """, ptr AS (
  SELECT source, max_by(bronze_run_id, bronze_ingest_date || bronze_run_id) AS run_id FROM p GROUP BY source)""", """
SELECT source, run_id, count(*) AS rows_same_run, count(DISTINCT posted_month) AS months, min(posted_month) AS first_month,
  max(posted_month) AS last_month, count(DISTINCT posted_month) <= 1 AS single_month
FROM p JOIN ptr USING (source) WHERE bronze_run_id = run_id GROUP BY ALL"""))
def d05(spark, d):
    df = fx.postings(spark, d, False)
    return D.run_month_coverage(df, E.resolve_run(df))


# --- facts -------------------------------------------------------------------------------------------------

@query("e01_assign_month", sql(SQL_POSTINGS, "SELECT job_id, posted_month, time_axis FROM p"))
def e01(spark, d):
    return E.assign_month(fx.postings(spark, d, False)).select("job_id", "posted_month", "time_axis")


@query("e01_assign_month_text", """
SELECT event_id, CASE event_id % 4 WHEN 3 THEN '' ELSE strftime(ts, '%Y-%m') END AS posted_month,
  CASE WHEN event_id % 4 IN (2, 3) THEN 'ingest_fallback' ELSE 'posted' END AS time_axis FROM events""")
def e01_text(spark, d):
    """Stored as ISO text, as epoch text, missing, and with a bad ingest date as well."""
    k = F.col("event_id") % 4
    ts = F.col("ts").cast("timestamp")
    df = _events(spark, d).select(
        "event_id", F.when(k == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")).when(k == 1, F.col("created").cast("string"))
        .when(k == 2, F.lit("n/a")).alias("posted_at"),
        F.when(k == 3, F.lit("2024/01")).otherwise(F.date_format(ts, "yyyy-MM-dd")).alias("bronze_ingest_date"))
    return E.assign_month(df).select("event_id", "posted_month", "time_axis")


@query("e02_dominant_axis", sql(SQL_POSTINGS, """
SELECT source, posted_month, CASE WHEN count(DISTINCT time_axis) = 1 THEN max(time_axis) ELSE 'mixed' END AS time_axis
FROM p GROUP BY ALL"""))
def e02(spark, d):
    axes = E.assign_month(fx.postings(spark, d, False)).select("source", "posted_month", "time_axis").distinct()
    return axes.groupBy("source", "posted_month").agg(X.dominant_axis("time_axis").alias("time_axis"))


def _fact_sql(fact: str, dim: str) -> str:
    return sql(SQL_FACTS, f"""
SELECT source, posted_month, run_id, {dim}, job_count, bronze_ingest_date, run_id AS bronze_run_id, time_axis
FROM {fact} JOIN prof USING (source, posted_month, run_id)""")


@query("e03_skill_demand", _fact_sql("f_skill", "skill"))
def e03(spark, d):
    return E.skill_demand(fx.postings(spark, d), F.col(fx.RUN))


@query("e03_skill_demand_snapshot", _fact_sql("f_skill", "skill"))
def e03_snapshot(spark, d):
    """The same on postings known to hold one row per job_id."""
    return E.skill_demand(fx.postings(spark, d), F.col(fx.RUN), unique=True)


_AGAIN = SQL_POSTINGS + """, h AS (
  SELECT source, job_id, posted_month, company_norm, skills FROM p UNION ALL
  SELECT source, job_id, strftime(day + INTERVAL 1 MONTH, '%Y-%m'), company_norm, skills FROM p WHERE k % 3 = 0),
w AS (SELECT * FROM h WHERE posted_month BETWEEN '1996-11' AND '1997-02')"""


def _history_sets(spark, d) -> DataFrame:
    """Every third posting occurs again in the next month; two batches are numbered and indexed one after the other."""
    p = fx.postings(spark, d)
    k, day = F.col("source_job_id").cast("long"), F.to_date(F.date_sub(F.to_date("bronze_ingest_date"), 1))
    month = E.assign_month(p).select("source", "job_id", "company_norm", "skills", "posted_month")
    again = p.where(k % 3 == 0).select("source", "job_id", "company_norm", "skills",
                                       F.date_format(F.add_months(day, 1), "yyyy-MM").alias("posted_month"))
    lake, sets, known = fx.work_lake(spark, "e03d"), [], None
    for name, batch in (("first", month.where("source = 'src_a'")), ("second", month.where("source = 'src_b'").unionByName(again))):
        known = DI.number_postings(batch, known)
        known.write.parquet(f"{lake.root}/numbers-{name}")
        known = spark.read.parquet(f"{lake.root}/numbers-{name}")
        values = F.explode(F.concat(F.transform("skills", lambda s: F.struct(F.lit("skill").alias("kind"), s.alias("value"))), F.array(
            F.struct(F.lit("employer").alias("kind"), F.col("company_norm").alias("value")))))
        rows = batch.join(known, "job_id").select("number", "source", "posted_month", values.alias("v")).select(
            "number", "source", "posted_month", "v.kind", "v.value")
        DI.posting_sets(rows, ["source", "posted_month", "kind", "value"]).write.parquet(f"{lake.root}/sets/{name}")
    return spark.read.parquet(f"{lake.root}/sets/*")


@query("e03_distinct_over_months", sql(_AGAIN, """
SELECT 'skill' AS kind, skill AS value, CAST(count(DISTINCT job_id) AS BIGINT) AS postings
FROM (SELECT job_id, unnest(skills) AS skill FROM w) GROUP BY ALL UNION ALL
SELECT 'employer', company_norm, CAST(count(DISTINCT job_id) AS BIGINT) FROM w GROUP BY ALL"""))
def e03_distinct(spark, d):
    """Distinct postings per skill and employer over four months, from bitmaps alone."""
    months = _history_sets(spark, d).where(F.col("posted_month").between("1996-11", "1997-02"))
    return DI.distinct_postings(months, ["kind", "value"])


@query("e04_role_demand", _fact_sql("f_role", "role"))
def e04(spark, d):
    return E.role_demand(fx.postings(spark, d, False), F.col(fx.RUN))


@query("e05_location_demand", _fact_sql("f_loc", "location"))
def e05(spark, d):
    """Locations arrive with noise and are normalised again."""
    df = fx.postings(spark, d, False)
    noisy = df.withColumn("location_raw", F.concat(F.lit(" "), F.upper("location_raw"), F.lit(" ,")))
    return E.location_demand(noisy, F.col(fx.RUN))


@query("e06_company_hiring", _fact_sql("f_emp", "company_name"))
def e06(spark, d):
    return E.company_hiring(fx.postings(spark, d, False), F.col(fx.RUN))


SUMMARY = """SELECT source, posted_month, run_id, bronze_ingest_date, run_id AS bronze_run_id,
  (SELECT count(*) FROM f_skill f WHERE (f.source, f.posted_month, f.run_id) = (x.source, x.posted_month, x.run_id)) AS skill_row_count,
  (SELECT count(*) FROM f_role f WHERE (f.source, f.posted_month, f.run_id) = (x.source, x.posted_month, x.run_id)) AS role_row_count,
  (SELECT count(*) FROM f_loc f WHERE (f.source, f.posted_month, f.run_id) = (x.source, x.posted_month, x.run_id)) AS location_row_count,
  (SELECT count(*) FROM f_emp f WHERE (f.source, f.posted_month, f.run_id) = (x.source, x.posted_month, x.run_id)) AS company_row_count,
  'PASS' AS status, time_axis FROM prof x"""


@query("e07_run_summary", sql(SQL_FACTS, SUMMARY))
def e07(spark, d):
    df = fx.postings(spark, d)
    return E.run_summary(fx.facts(df), E.month_profile(df, F.col(fx.RUN)))


@query("e08_build_facts_months", sql(SQL_POSTINGS, """
SELECT source, m AS posted_month, 'r9' AS run_id, count(DISTINCT CASE WHEN posted_month = m THEN title_norm END) AS role_row_count,
  count(DISTINCT CASE WHEN posted_month = m THEN company_norm END) AS company_row_count,
  count(DISTINCT CASE WHEN posted_month = m THEN location_raw END) AS location_row_count, 'PASS' AS status,
  (SELECT count(DISTINCT s) FROM (SELECT unnest(skills) AS s FROM p q WHERE q.source = p.source AND q.posted_month = m)) AS skill_row_count,
  coalesce(CASE WHEN count(DISTINCT CASE WHEN posted_month = m THEN time_axis END) > 1 THEN 'mixed'
    ELSE max(CASE WHEN posted_month = m THEN time_axis END) END, 'posted') AS time_axis,
  coalesce(max(CASE WHEN posted_month = m THEN bronze_ingest_date END), max(bronze_ingest_date)) AS bronze_ingest_date
FROM p CROSS JOIN (SELECT unnest(['2001-07', '2001-08', '2030-01']) AS m) GROUP BY source, m"""))
def e08(spark, d):
    """Three months asked for, one of them without any posting: it is published with zero rows."""
    out = E.build_facts(fx.postings(spark, d), "r9", ["2001-08", "2001-07", "2030-01"], None)
    return out["pipeline_run_summary"].select("source", "posted_month", "run_id", "role_row_count", "company_row_count",
                                              "location_row_count", "status", "bronze_ingest_date", "skill_row_count", "time_axis")


@query("e08_build_facts_all", sql(SQL_POSTINGS + """,
pr AS (SELECT source, posted_month, max(bronze_ingest_date) AS day,
  CASE WHEN count(DISTINCT time_axis) = 1 THEN max(time_axis) ELSE 'mixed' END AS axis FROM p GROUP BY ALL),
f AS (SELECT 'skill' AS fact, source, posted_month, unnest(skills) AS value FROM p
  UNION ALL SELECT 'role', source, posted_month, title_norm FROM p
  UNION ALL SELECT 'location', source, posted_month, location_raw FROM p
  UNION ALL SELECT 'company', source, posted_month, company_norm FROM p),
c AS (SELECT fact, source, posted_month, value, count(*) AS n FROM f GROUP BY ALL),
s AS (SELECT source, posted_month, fact, count(*) AS n FROM c GROUP BY ALL)""", """
SELECT fact, source, posted_month, 'r9' AS run_id, value, n AS job_count, day AS bronze_ingest_date, 'r9' AS bronze_run_id,
  axis AS time_axis FROM c JOIN pr USING (source, posted_month)
UNION ALL SELECT 'summary ' || fact, source, posted_month, 'r9', 'PASS', n, day, 'r9', axis FROM s JOIN pr USING (source, posted_month)"""))
def e08_all(spark, d):
    """All five tables with every column, as written by a publication of each source and read back."""
    lake, df = fx.work_lake(spark, "e08"), fx.postings(spark, d)
    for source, _ in DIALECTS:
        P.publish_facts(df.where(F.col("source") == source), lake, "r9", None, None, True, source)
    rest = ("source", "posted_month", "run_id")
    lineage = ("bronze_ingest_date", "bronze_run_id", "time_axis")
    parts = [A.read_fact(spark, t, lake).select(F.lit(dim.split("_")[0]).alias("fact"), *rest, F.col(dim).alias("value"), "job_count", *lineage)
             for t, dim in FACT_DIMENSION.items()]
    summary = A.read_fact(spark, RUN_SUMMARY, lake)
    counts = F.explode(F.array(*[F.struct(F.lit(f"summary {n}").alias("fact"), F.col(f"{n}_row_count").alias("job_count"))
                                 for n in ("skill", "role", "location", "company")]))
    parts.append(summary.withColumn("c", counts).select("c.fact", *rest, F.col("status").alias("value"), "c.job_count", *lineage))
    return reduce(DataFrame.unionByName, parts)


_AFTER = SQL_POSTINGS + """, q AS (
  SELECT source, k, skills, company_norm, location_raw, CASE WHEN k % 10 < 2 THEN 'newer' ELSE title_norm END AS title_norm,
    CASE WHEN k % 10 < 2 THEN '2030-01-01' ELSE bronze_ingest_date END AS bronze_ingest_date,
    CASE WHEN k % 97 <> 0 THEN strftime(day, '%Y-%m') WHEN k % 10 < 2 THEN '2030-01' ELSE substr(bronze_ingest_date, 1, 7) END AS posted_month,
    CASE WHEN k % 97 <> 0 THEN 'posted' ELSE 'ingest_fallback' END AS time_axis FROM p),
profile AS (SELECT source, posted_month, max(bronze_ingest_date) AS bronze_ingest_date,
  CASE WHEN count(DISTINCT time_axis) = 1 THEN max(time_axis) ELSE 'mixed' END AS time_axis FROM q GROUP BY ALL)"""


@query("e08_change_feed", sql(_AFTER, """
SELECT fact, source, posted_month, value, CAST(n AS BIGINT) AS job_count, bronze_ingest_date, time_axis FROM (
  SELECT 'role' AS fact, source, posted_month, title_norm AS value, count(*) AS n FROM q GROUP BY ALL UNION ALL
  SELECT 'company_name', source, posted_month, company_norm, count(*) FROM q GROUP BY ALL UNION ALL
  SELECT 'location', source, posted_month, location_raw, count(*) FROM q GROUP BY ALL UNION ALL
  SELECT 'skill', source, posted_month, skill, count(*) FROM (SELECT source, posted_month, unnest(skills) AS skill FROM q) GROUP BY ALL)
JOIN profile USING (source, posted_month)"""))
def e08_changes(spark, d):
    """Facts of a first version, brought to a third one from the changes alone: newer titles, moved months, new postings,
    and older versions that change nothing."""
    lake, parts = fx.work_lake(spark, "e08c"), []
    df = fx.stored_postings(spark, d, lake)
    k = F.col("source_job_id").cast("long")
    for source, _ in DIALECTS:
        mine = df.where(F.col("source") == source)
        before = SN.replace(mine.where(k % 10 != 3), lake, source, "v1").number
        newer = mine.where((k % 10 < 2)).withColumns({"title_norm": F.lit("newer"), "bronze_ingest_date": F.lit("2030-01-01")})
        older = mine.where(k % 10 == 5).withColumns({"title_norm": F.lit("older"), "bronze_ingest_date": F.lit("1990-01-01")})
        SN.upsert(newer.unionByName(older), lake, source, "v2")
        SN.upsert(mine.where(k % 10 == 3), lake, source, "v3")
        first = SN.read(spark, lake, source, number=before)
        old = {**E.fact_tables(E.on_months(first, None), "run-1", None, True), LINEAGE_COUNTS: E.lineage(first)}
        changes = SN.changes(spark, lake, source, before).checkpoint()
        facts = E.updated_facts(old, E.signed_counts(changes, "run-2", None), "run-2")
        parts += [facts[t].select(F.lit(dim).alias("fact"), "source", "posted_month", F.col(dim).alias("value"), "job_count",
                                  "bronze_ingest_date", "time_axis") for t, dim in FACT_DIMENSION.items()]
    return reduce(DataFrame.unionByName, parts)


@query("e09_resolve_run", sql(SQL_POSTINGS, """
SELECT source, max_by(bronze_run_id, bronze_ingest_date || bronze_run_id) AS run_id FROM p GROUP BY source"""))
def e09(spark, d):
    return E.resolve_run(fx.postings(spark, d, False))


@query("c99_standard_batch", sql(SQL_LANDING, f"""
SELECT job_id, source, CASE WHEN source = 'src_a' THEN source_slug ELSE source_job_id END AS source_job_id,
  lower(c_name) AS company_norm,
  CASE WHEN source = 'src_a' THEN lower(n_name) ELSE lower(n_name) || ', ' || lower(r_name) END AS location_raw,
  CASE WHEN source = 'src_a' THEN CASE o_orderstatus WHEN 'F' THEN 'remote' ELSE 'onsite' END ELSE 'hybrid' END AS remote_type,
  strftime(day, '%Y-%m-%d') AS posted_on, run_id AS bronze_run_id, bronze_ingest_date FROM ln"""))
def c99(spark, d):
    """Landing to standard postings end to end, written and read back in between; every row lands twice."""
    lake = fx.work_lake(spark, "c99")
    rows = _landing(spark, d)
    A.write_landing(rows.unionByName(rows), lake)
    out = standard_batch(A.read_landing(spark, lake), ("src_b",))
    return out.select("job_id", "source", "source_job_id", "company_norm", "location_raw", "remote_type",
                      F.date_format("posted_at", "yyyy-MM-dd").alias("posted_on"), "bronze_run_id", "bronze_ingest_date")
