"""Table contracts and small settings shared by all modules."""

from __future__ import annotations

import re
import tempfile
import uuid
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql.types import (ArrayType, LongType, StringType, StructField, StructType, TimestampType)

_S = StringType()


def _struct(**cols) -> StructType:
    return StructType([StructField(n, t) for n, t in cols.items()])


# Landing envelope; `raw_payload` stays opaque JSON text.
LANDING = _struct(source=_S, schema_version=_S, job_id=_S, job_id_strategy=_S, source_job_id=_S, source_slug=_S,
                  source_url=_S, ingested_at=_S, run_id=_S, bronze_ingest_date=_S, batch_created_at=_S,
                  raw_payload=_S)

# One current row per posting.
POSTING = _struct(job_id=_S, source=_S, source_job_id=_S, title_norm=_S, company_norm=_S, location_raw=_S,
                  remote_type=_S, skills=ArrayType(_S), posted_at=TimestampType(), ingested_at=_S,
                  job_id_strategy=_S, bronze_run_id=_S, bronze_ingest_date=_S, bronze_data_file=_S)

# Facts: name of the fact table -> its dimension column.
FACT_DIMENSION = {"skill_demand_monthly": "skill", "role_demand_monthly": "role",
                  "location_demand_monthly": "location", "company_hiring_monthly": "company_name"}
FACT_PARTITIONS = ("source", "posted_month", "run_id")
RUN_SUMMARY = "pipeline_run_summary"
# Postings per ingest date and time axis, from which the profile of a month follows.
LINEAGE_COUNTS = "month_lineage_counts"
LATEST_RUN = "latest_run_metadata"

# Order of versions of one posting, as text.
LINEAGE_ORDER = ("bronze_ingest_date", "bronze_run_id", "ingested_at")


def fact_schema(table: str) -> StructType:
    return StructType([StructField(FACT_DIMENSION[table], _S), StructField("job_count", LongType()),
                       StructField("bronze_ingest_date", _S), StructField("bronze_run_id", _S),
                       StructField("time_axis", _S)] + [StructField(p, _S) for p in FACT_PARTITIONS])


def lineage_schema() -> StructType:
    return StructType([StructField("bronze_ingest_date", _S), StructField("time_axis", _S), StructField("job_count", LongType())]
                      + [StructField(p, _S) for p in FACT_PARTITIONS])


def summary_schema() -> StructType:
    counts = [StructField(f"{n}_row_count", LongType()) for n in ("skill", "role", "location", "company")]
    return StructType([StructField("bronze_ingest_date", _S), StructField("bronze_run_id", _S), *counts,
                       StructField("status", _S), StructField("time_axis", _S)]
                      + [StructField(p, _S) for p in FACT_PARTITIONS])


def path_is_missing(error: AnalysisException) -> bool:
    """Whether a read failed since nothing is there yet; every other failure is one."""
    return error.getCondition() == "PATH_NOT_FOUND"


def new_run_id(now: datetime | None = None) -> str:
    """Run ids sort by time: UTC stamp plus a random tail."""
    return f"{now or datetime.now(timezone.utc):%Y%m%dT%H%M%SZ}-{uuid.uuid4().hex[:8]}"


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the session names it; there is no machine-local default."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return folder.rstrip("/")


def ensure_shared_folder(spark: SparkSession) -> str:
    """The shared folder of the session. A session in one process may go without: it gets a temporary folder, since
    driver and tasks see the same disk. Any other session without a shared folder is refused."""
    try:
        return shared_folder(spark)
    except ValueError:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="vacancy-lake-"))
        return shared_folder(spark)


def use_shared_checkpoints(spark: SparkSession) -> None:
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
