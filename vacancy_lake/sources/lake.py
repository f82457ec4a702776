"""Where tables live and how they are read and written: landing files, batches, facts, pointers."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.rules import PlaceRules
from ..operators.standardize import align_legacy, project_contract
from ..schema import (FACT_DIMENSION, FACT_PARTITIONS, LANDING, LATEST_RUN, LINEAGE_COUNTS, POSTING, RUN_SUMMARY,
                      fact_schema, lineage_schema, path_is_missing, summary_schema)


@dataclass(frozen=True)
class Lake:
    """Folder layout under one root. A slice tag keeps a backfill beside the main lake, not in it."""

    root: str
    slice: str | None = None

    @property
    def landing(self) -> str:
        return f"{self.root}/bronze"

    @property
    def jobs(self) -> str:
        return f"{self.root}/silver/jobs"

    @property
    def legacy_jobs(self) -> str:
        return f"{self.root}/silver_legacy/jobs"

    @property
    def gold(self) -> str:
        return f"{self.root}/gold" + (f"/slice={self.slice}" if self.slice else "")

    def batch_glob(self, base: str, source: str = "*", sliced: bool = False) -> str:
        return f"{base}/source={source}" + (f"/slice={self.slice}" if sliced else "") + "/ingest_date=*/run_id=*"

    def merged(self, source: str) -> str:
        return f"{self.jobs}/source={source}" + (f"/slice={self.slice}" if self.slice else "") + "/merged"


def partitions(lake: Lake) -> list[str]:
    return ["source", *(["slice"] if lake.slice else []), "ingest_date", "run_id"]


def _replace_partitions(df: DataFrame, partitions: Sequence[str]):
    return df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions)


# --- landing -----------------------------------------------------------------------------------------------

def write_landing(df: DataFrame, lake: Lake, rows_per_file: int = 500_000) -> None:
    """Gzip JSON lines under source / [slice] / ingest_date / run_id.

    A gzip file is one read task, so files are kept small. Writing a run again replaces just that run.
    """
    out = df.withColumn("ingest_date", F.col("bronze_ingest_date"))
    if lake.slice:
        out = out.withColumn("slice", F.lit(lake.slice))
    (_replace_partitions(out, partitions(lake)).option("compression", "gzip")
     .option("maxRecordsPerFile", rows_per_file).option("ignoreNullFields", "false").json(lake.landing))


def newest_batch(spark: SparkSession, lake: Lake, source: str) -> str:
    """Folder of the newest landed batch of a source, from file listing alone (no content is read)."""
    glob = lake.batch_glob(lake.landing, source, bool(lake.slice))
    try:
        files = spark.read.format("binaryFile").load(glob).select("path", "modificationTime")
    except AnalysisException as e:
        if not path_is_missing(e):
            raise
        raise FileNotFoundError(f"no landing files for source {source}") from e
    row = files.agg(F.max_by("path", F.struct("modificationTime", "path")).alias("path")).first()
    if row is None or row["path"] is None:
        raise FileNotFoundError(f"no landing files for source {source}")
    return row["path"].rsplit("/", 1)[0]


def read_landing(spark: SparkSession, lake: Lake, source: str | None = None, path: str | list[str] | None = None) -> DataFrame:
    """Landing rows, payload as JSON text, with file lineage and line order (`_file`, `_line`).

    Without a path or paths: the newest batch of `source`, or every batch of the lake when no source is given.
    """
    if path is None:
        path = newest_batch(spark, lake, source) if source else lake.batch_glob(lake.landing, "*", bool(lake.slice))
    schema = StructType(LANDING.fields + [StructField("ingest_date", StringType())]
                        + ([StructField("slice", StringType())] if lake.slice else []))
    rows = spark.read.schema(schema).option("basePath", lake.landing).json(path)
    return with_path_lineage(rows).withColumns({"_line": F.monotonically_increasing_id()})


def with_path_lineage(df: DataFrame, file: Column | None = None) -> DataFrame:
    """Run id and ingest date from the path of the file a row came from; a path without them is an error."""
    file = file if file is not None else F.col("_metadata.file_path")

    def part(name: str) -> Column:
        folder = F.try_element_at(F.filter(F.split(file, "/"), lambda s: s.startswith(f"{name}=")), F.lit(-1))
        return F.nullif(F.right(folder, F.length(folder) - len(name) - 1), F.lit(""))

    def stamped(column: str, name: str) -> Column:
        own = F.col(column) if column in df.columns else F.lit(None).cast("string")
        return F.when(part(name).isNotNull(), F.coalesce(own, part(name))).otherwise(
            F.raise_error(F.concat(F.lit(f"no {name} in path "), file)).cast("string"))

    return df.withColumns({"run_id": stamped("run_id", "run_id"),
                           "bronze_ingest_date": stamped("bronze_ingest_date", "ingest_date"), "bronze_data_file": file})


def require_rows(df: DataFrame, what: str = "landing input") -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"{what} is empty")
    return df


# --- batches ---------------------------------------------------------------------------------

def write_batch(df: DataFrame, lake: Lake) -> None:
    """Standard postings of one or more runs under source / [slice] / ingest_date / run_id.

    Stored typed (skills as array, posted_at as timestamp), so readers parse nothing and time ranges reach the
    scan. `operators.standardize.text_contract` gives the all-text form for export.
    """
    out = project_contract(df).withColumns({"ingest_date": F.col("bronze_ingest_date"), "run_id": F.col("bronze_run_id")})
    if lake.slice:
        out = out.withColumn("slice", F.lit(lake.slice))
    _replace_partitions(out, partitions(lake)).parquet(lake.jobs)


def read_history(spark: SparkSession, lake: Lake, source: str, legacy_source: bool = False,
                 places: PlaceRules | None = PlaceRules()) -> DataFrame | None:
    """Every batch of a source in the contract: current layout, slice and, on request, the flat earlier layout.

    The merged snapshot is never matched. Current layouts are read with the contract as schema, so no footer is
    read to plan; earlier files may differ in columns and types, so those merge schemas and are aligned.
    """
    current = StructType(POSTING.fields + [StructField(p, StringType()) for p in ("ingest_date", "run_id")])
    parts = []
    for sliced in ([False, True] if lake.slice else [False]):
        schema = StructType(current.fields + ([StructField("slice", StringType())] if sliced else []))
        try:
            rows = (spark.read.schema(schema).option("basePath", lake.jobs)
                    .parquet(lake.batch_glob(lake.jobs, source, sliced)))
        except AnalysisException as e:
            if not path_is_missing(e):
                raise
            continue  # layout not in use
        parts.append(project_contract(rows.withColumn("bronze_data_file", F.coalesce(
            "bronze_data_file", F.col("_metadata.file_path")))))
    if legacy_source:
        try:
            rows = (spark.read.option("basePath", lake.legacy_jobs).option("mergeSchema", "true")
                    .parquet(f"{lake.legacy_jobs}/ingest_date=*/run_id=*"))
            known = ["bronze_data_file"] if "bronze_data_file" in rows.columns else []
            parts.append(align_legacy(rows.withColumn("bronze_data_file", F.coalesce(
                *known, F.col("_metadata.file_path"))), places))
        except AnalysisException as e:
            if not path_is_missing(e):
                raise
    return reduce(DataFrame.unionByName, parts) if parts else None


# --- facts -------------------------------------------------------------------------------------------------

def write_fact(df: DataFrame, table: str, lake: Lake, empty_for: Sequence[tuple[str, str, str]] = ()) -> None:
    """Facts under source / posted_month / run_id; only partitions present in `df` are replaced.

    Rows are rebalanced by month, so small months share a task and a month that holds most rows is split.
    `empty_for` lists (source, month, run) that were asked for but have no row: dynamic overwrite leaves such
    partitions alone, so they get an empty file of their own.
    """
    out = df.hint("rebalance", "source", "posted_month")
    _replace_partitions(out, FACT_PARTITIONS).parquet(f"{lake.gold}/{table}")
    clear_months(df, table, lake, empty_for)


def clear_months(df: DataFrame, table: str, lake: Lake, empty_for: Sequence[tuple[str, str, str]]) -> None:
    """An empty file for each (source, month, run), in place of what was there."""
    blank = df.sparkSession.createDataFrame([], StructType([f for f in df.schema.fields if f.name not in FACT_PARTITIONS]))
    for source, month, run in empty_for:
        blank.write.mode("overwrite").parquet(
            f"{lake.gold}/{table}/source={source}/posted_month={month}/run_id={run}")


def read_fact(spark: SparkSession, table: str, lake: Lake) -> DataFrame:
    """Typed fact with partition columns as text, so month and run predicates prune folders."""
    other = {RUN_SUMMARY: summary_schema, LINEAGE_COUNTS: lineage_schema}
    schema = other[table]() if table in other else fact_schema(table)
    return spark.read.schema(schema).parquet(f"{lake.gold}/{table}")


def publish_latest(df: DataFrame, lake: Lake) -> None:
    """Point each source of `df` (source, run_id) at its run; other sources keep their pointer."""
    _replace_partitions(df.select("source", "run_id").coalesce(1), ["source"]).parquet(f"{lake.gold}/{LATEST_RUN}")


def latest_run(spark: SparkSession, lake: Lake, source: str | None = None) -> DataFrame:
    """One row per source. Joined without a hint: Spark measures it and broadcasts it."""
    schema = StructType([StructField("run_id", StringType()), StructField("source", StringType())])
    rows = spark.read.schema(schema).parquet(f"{lake.gold}/{LATEST_RUN}").select("source", "run_id")
    return rows if source is None else rows.where(F.col("source") == source)


# --- run audit and catalog ---------------------------------------------------------------------------------

def audit_rows(details: DataFrame, stage: str, recorded_at: str) -> DataFrame:
    """Any report (source, run_id, ...) as rows of the run-audit table; the rest becomes JSON."""
    rest = [c for c in details.columns if c not in ("source", "run_id", "status")]
    status = F.col("status") if "status" in details.columns else F.lit("ok")
    return details.select(F.lit(stage).alias("stage"), "source", "run_id", status.alias("status"),
                          F.lit(recorded_at).alias("recorded_at"),
                          F.to_json(F.struct(*rest)).alias("details"))


def append_audit(rows: DataFrame, lake: Lake) -> None:
    rows.write.mode("append").partitionBy("stage").parquet(f"{lake.root}/audit")


def register_tables(spark: SparkSession, lake: Lake, database: str) -> list[str]:
    """Declare facts, run summary and pointer of a lake as partitioned external tables.

    `snapshot.register` does the same for the postings of a source.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    tables = {**{t: fact_schema(t) for t in FACT_DIMENSION}, RUN_SUMMARY: summary_schema(),
              LATEST_RUN: StructType([StructField("run_id", StringType()), StructField("source", StringType())])}
    for name, schema in tables.items():
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        parts = "source" if name == LATEST_RUN else ", ".join(FACT_PARTITIONS)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet "
                  f"PARTITIONED BY ({parts}) LOCATION '{lake.gold}/{name}'")
        spark.sql(f"MSCK REPAIR TABLE {database}.{name}")
    return sorted(tables)
