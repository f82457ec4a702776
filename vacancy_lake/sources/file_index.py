"""Index of the files of a lake: which file holds what, so that reads name their files instead of listing folders.

One row per file: source, slice, ingest date, run, path, bytes, rows, smallest and largest time of its rows. `add` reads the
folders of the runs just written, and nothing else, and appends their rows as a small Parquet part. Parts are named by
numbered manifests that are created only if their number is free, so of two writers the second goes on top of the first.
Parts next to each other are merged when those behind one hold as many rows as it does, so their number stays
logarithmic, and a reader opens one manifest and a few files however many folders there are.

A run that is written and added again replaces its rows: per run those of the largest manifest number count. A run that is
added without files is gone. The number is also the order of landing, by which the newest batch is found.

Add a run after its files are written: until then readers see the lake as it was. A reader that meets a file replaced under
it fails as any reader of the folder would, and reads again. Times are instants; rows whose time is missing or no time are
counted but belong to no range. Names of sources, slices and runs are letters, digits, `.`, `_` and `-`; others are refused.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..operators.standardize import project_contract
from ..schema import LANDING, POSTING
from . import files
from .lake import Lake, partitions, read_landing as landing_rows

#: Adjacent parts there must be before they are merged into one.
FAN_IN = 8
_ENTRY = ("source string, slice string, ingest_date string, run_id string, path string, bytes long, rows long, "
          "least timestamp, greatest timestamp, seq long")
_RUN = ("source", "slice", "ingest_date", "run_id")
LANDED, BATCHES = "landing", "jobs"


def _home(lake: Lake, kind: str) -> str:
    return f"{lake.root}/index/{kind}"


def _base(lake: Lake, kind: str) -> str:
    return lake.landing if kind == LANDED else lake.jobs


def _folder(lake: Lake, kind: str, source: str, date: str, run: str) -> str:
    for name in (source, lake.slice or "-", date, run):
        if not re.fullmatch(r"[\w.\-]+", name):
            raise ValueError(f"no plain name: {name!r}")
    return f"{_base(lake, kind)}/source={source}" + (f"/slice={lake.slice}" if lake.slice else "") + f"/ingest_date={date}/run_id={run}"


# --- manifests ---------------------------------------------------------------------------------------------

def _newest(spark: SparkSession, lake: Lake, kind: str) -> dict:
    names = [n for n in files.names(spark, f"{_home(lake, kind)}/manifest") if n.endswith(".json") and not n.startswith(".")]
    return json.loads(files.read_text(spark, f"{_home(lake, kind)}/manifest/{names[-1]}")) if names else {"number": 0, "parts": []}


def _commit(spark: SparkSession, lake: Lake, kind: str, change) -> dict:
    """Put the parts that `change` makes of the newest ones under the next number; None from it leaves things alone."""
    while True:
        now = _newest(spark, lake, kind)
        number = now["number"] + 1
        parts = change(now["parts"], number)
        if parts is None:
            return now
        after = {"number": number, "parts": parts}
        if files.create(spark, f"{_home(lake, kind)}/manifest/{number:012d}.json", json.dumps(after)):
            return after


def _write(df: DataFrame, lake: Lake, kind: str) -> tuple[str, int]:
    name = uuid.uuid4().hex
    path = f"{_home(lake, kind)}/data/{name}"
    df.coalesce(1).write.parquet(path)  # one row per file of the lake
    return name, df.sparkSession.read.schema(_ENTRY).parquet(path).count()


def _rows(spark: SparkSession, lake: Lake, kind: str, parts: Sequence[dict]) -> DataFrame:
    """Rows of parts, each with the number of the manifest that brought it, one scan for all."""
    if not parts:
        return spark.createDataFrame([], _ENTRY)
    rows = spark.read.schema(_ENTRY).parquet(*[f"{_home(lake, kind)}/data/{p['name']}" for p in parts])
    part = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    numbers = F.create_map(*[x for p in parts for x in (F.lit(p["name"]), F.lit(p["seq"]).cast("long"))])
    return rows.withColumn("seq", F.coalesce("seq", numbers[part]))


def _live(rows: DataFrame) -> DataFrame:
    """Per run the rows of its last addition."""
    last = rows.groupBy(*_RUN).agg(F.max("seq").alias("_last"))
    same = [rows[c].eqNullSafe(last[c]) for c in _RUN]
    return rows.join(last, [*same, rows["seq"] == last["_last"]], "left_semi")


def _merge_from(parts: Sequence[dict]) -> int | None:
    """First part that is no larger than all behind it, if there are enough of them."""
    for i in range(len(parts) - FAN_IN + 1):
        if sum(p["rows"] for p in parts[i + 1:]) >= parts[i]["rows"]:
            return i
    return None


# --- writing -----------------------------------------------------------------------------------------------

def _stat(spark: SparkSession, lake: Lake, kind: str, runs: Sequence[tuple[str, str, str]], time: str) -> DataFrame:
    """A row per file of the runs, read from their folders alone; a row without a path for a run without files."""
    named = spark.createDataFrame([(s, lake.slice, d, r) for s, d, r in runs], ", ".join(f"{c} string" for c in _RUN))
    there = [p for p in (_folder(lake, kind, *run) for run in runs) if files.names(spark, p)]
    found = spark.createDataFrame([], _ENTRY)
    if there:
        schema = LANDING if kind == LANDED else POSTING
        reader = spark.read.schema(StructType([schema[time]]))
        rows = reader.json(there) if kind == LANDED else reader.parquet(*there)
        at = F.try_to_timestamp(F.col(time).cast("string"))
        # The reader gives a URI; it takes a path.
        path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))

        def part(name: str) -> Column:
            folder = F.try_element_at(F.filter(F.split("path", "/"), lambda s: s.startswith(f"{name}=")), F.lit(-1))
            return F.right(folder, F.length(folder) - len(name) - 1).alias(name)

        stats = (rows.select(path.alias("path"), F.col("_metadata.file_size").alias("bytes"), at.alias("_at")).groupBy("path", "bytes")
                 .agg(F.count("*").alias("rows"), F.min("_at").alias("least"), F.max("_at").alias("greatest")))
        found = stats.select(part("source"), F.lit(lake.slice).cast("string").alias("slice"), part("ingest_date"), part("run_id"),
                             "path", "bytes", "rows", "least", "greatest", F.lit(None).cast("long").alias("seq"))
    gone = named.join(found, [named[c].eqNullSafe(found[c]) for c in _RUN], "left_anti")
    return found.unionByName(gone, allowMissingColumns=True)


def add(spark: SparkSession, lake: Lake, kind: str, runs: Sequence[tuple[str, str, str]], time: str = "ingested_at") -> int:
    """Index the files of runs (source, ingest date, run id) as they are now; the number under which they count."""
    if not runs:
        return _newest(spark, lake, kind)["number"]
    name, rows = _write(_stat(spark, lake, kind, runs, time), lake, kind)
    done = _commit(spark, lake, kind, lambda parts, n: [*parts, {"name": name, "seq": n, "rows": rows}])
    compact(spark, lake, kind)
    return next(p["seq"] for p in done["parts"] if p["name"] == name)


def compact(spark: SparkSession, lake: Lake, kind: str) -> None:
    """Merge parts where it is due. Another writer's merge wins, and parts that came meanwhile stay behind."""
    parts = _newest(spark, lake, kind)["parts"]
    first = _merge_from(parts)
    if first is None:
        return
    chosen = parts[first:]
    rows = _live(_rows(spark, lake, kind, chosen))
    if first == 0:  # nothing older is left that a run without files would have to hide
        rows = rows.where(F.col("path").isNotNull())
    name, n = _write(rows, lake, kind)

    def change(now: list[dict], number: int) -> list[dict] | None:
        if now[first:first + len(chosen)] != chosen or now[:first] != parts[:first]:
            return None
        return [*now[:first], {"name": name, "seq": chosen[-1]["seq"], "rows": n}, *now[first + len(chosen):]]

    _commit(spark, lake, kind, change)


# --- reading -----------------------------------------------------------------------------------------------

def entries(spark: SparkSession, lake: Lake, kind: str) -> DataFrame:
    """The files of the lake: main and slices, one row each."""
    return _live(_rows(spark, lake, kind, _newest(spark, lake, kind)["parts"])).where(F.col("path").isNotNull())


def _within(found: DataFrame, source: str | None, since: datetime | str | None, until: datetime | str | None) -> DataFrame:
    if source is not None:
        found = found.where(F.col("source") == source)
    if since is not None:
        found = found.where(F.col("greatest") >= F.lit(since).cast("timestamp"))
    if until is not None:
        found = found.where(F.col("least") < F.lit(until).cast("timestamp"))
    return found


def _paths(found: DataFrame) -> list[str]:
    """The names of the files a read needs, which Spark's reader takes from the driver."""
    return sorted(r["path"] for r in found.select("path").collect())


def newest_batch(spark: SparkSession, lake: Lake, source: str, kind: str = LANDED) -> DataFrame:
    """Files of the batch of a source that was added last."""
    mine = entries(spark, lake, kind).where((F.col("source") == source) & F.col("slice").eqNullSafe(F.lit(lake.slice)))
    last = mine.select(F.max(F.struct("seq", "ingest_date", "run_id")).alias("last")).first()["last"]
    if last is None:
        raise FileNotFoundError(f"no landing files for source {source}")
    return mine.where((F.col("seq") == last["seq"]) & (F.col("ingest_date") == last["ingest_date"]) & (F.col("run_id") == last["run_id"]))


def _in_range(rows: DataFrame, time: str, since, until) -> DataFrame:
    at = F.try_to_timestamp(F.col(time).cast("string"))
    if since is not None:
        rows = rows.where(at >= F.lit(since).cast("timestamp"))
    if until is not None:
        rows = rows.where(at < F.lit(until).cast("timestamp"))
    return rows


def read_landing(spark: SparkSession, lake: Lake, source: str | None = None, since=None, until=None,
                 time: str = "ingested_at") -> DataFrame:
    """`lake.read_landing` by the index: the newest batch of a source, or, without one or with a range, all that match.

    A range is since <= time < until; files outside it are not opened.
    """
    if source is not None and since is None and until is None:
        found = newest_batch(spark, lake, source)
    else:
        found = _within(entries(spark, lake, LANDED).where(F.col("slice").eqNullSafe(F.lit(lake.slice))), source, since, until)
    paths = _paths(found)
    if not paths:
        folders = partitions(lake)  # a reader puts these behind the columns of the file
        fields = [f for f in LANDING if f.name not in folders] + [StructField(c, StringType()) for c in (*folders, "bronze_data_file")]
        return spark.createDataFrame([], StructType([*fields, StructField("_line", LongType(), False)]))
    return _in_range(landing_rows(spark, lake, path=paths), time, since, until)


def read_history(spark: SparkSession, lake: Lake, source: str, since=None, until=None, time: str = "ingested_at") -> DataFrame:
    """Every batch of a source in the contract, of the main lake and of the lake's slice, by the index."""
    where = F.col("slice").isNull() | F.col("slice").eqNullSafe(F.lit(lake.slice))
    paths = _paths(_within(entries(spark, lake, BATCHES).where(where), source, since, until))
    schema = StructType(POSTING.fields + [StructField(p, StringType()) for p in ("slice", "ingest_date", "run_id")])
    if not paths:
        return spark.createDataFrame([], POSTING)
    rows = spark.read.schema(schema).option("basePath", lake.jobs).parquet(*paths)
    rows = project_contract(rows.withColumn("bronze_data_file", F.coalesce("bronze_data_file", F.col("_metadata.file_path"))))
    return _in_range(rows, time, since, until)
