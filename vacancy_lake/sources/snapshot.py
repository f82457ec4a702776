"""Current postings of a source: one row per key, kept as a merge tree of Parquet runs under numbered manifests.

An upsert writes the rows of the batch as a run of its own and names it in the next manifest; nothing else is read to
write it or written again. Reading merges the runs by key: the newest lineage wins, on equal lineage the later run. Rows of
the oldest run, which is by far the largest, pass through unless a later run holds their key, so only touched keys are
ranked. Runs next to each other are merged into one when those behind a run hold as many rows as it does, and there are
FAN_IN of them: a row is rewritten a logarithmic number of times, and the number of runs is logarithmic too.

Rows of a run are sorted by month of posting and hash of the key and cut into files by size, so files grow with the data.
Beside each run lie two small tables: for each file and month the range of key hashes, and a Bloom filter of the keys of
each file, as bitmaps of 4 KB. With them a month is read from the files that hold it, and keys from the files that may hold
them: by range through a join on the first bits of the hash, then by filter.

A manifest is a small JSON file: number, label, runs, number of keys. It is created under the next number only if that
is free; a writer that comes second reads the manifest that won and tries again on top of it, so no batch is lost. A
reader holds on to the manifest it began with. Everything else is written before, under names nobody else uses.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import asdict, dataclass, replace as changed
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from ..functions.text import text
from ..operators import merge as D
from ..operators.metrics import first_k
from ..operators.standardize import project_contract
from ..schema import LINEAGE_ORDER, POSTING
from . import files
from .lake import Lake

#: Adjacent runs there must be before they are merged into one.
FAN_IN = 4
BITS_PER_KEY, HASHES = 12, 4
#: Keys up to which the filter of a file is asked. One of that size lets 0.65 % of other keys through, so more keys than
#: that would leave out one file in six hundred.
PROBED = 1_000
_NO_MONTH = "none"
#: Leading bits of a key hash by which ranges of files and keys are joined.
_CELL = 52

_RUN = StructType([f for f in POSTING.fields if f.name != "source"]
                  + [StructField("month", StringType()), StructField("key_hash", LongType())])
_RANGES = "run string, file string, month string, rows long, low long, high long"
_BLOOM = "run string, file string, bits long, bucket long, bitmap binary"


@dataclass(frozen=True)
class Run:
    name: str
    seq: int  # number of the newest manifest whose batch is in it
    rows: int


@dataclass(frozen=True)
class Version:
    number: int
    label: str
    runs: tuple[Run, ...]  # oldest first
    keys: int
    delta: str | None = None  # run of the batch this version added
    whole: bool = False  # replaced what was there


class Conflict(RuntimeError):
    """What a commit rests on is no longer there."""


# --- manifests ---------------------------------------------------------------------------------------------

def versions(spark: SparkSession, lake: Lake, source: str) -> list[int]:
    """Numbers of the manifests there are, oldest first."""
    found = files.names(spark, f"{lake.merged(source)}/manifest")
    return [int(n.removesuffix(".json")) for n in found if n.endswith(".json") and not n.startswith(".")]


def version(spark: SparkSession, lake: Lake, source: str, number: int | None = None) -> Version | None:
    """A manifest, the newest by default; None where there is none."""
    if number is None:
        known = versions(spark, lake, source)
        if not known:
            return None
        number = known[-1]
    body = json.loads(files.read_text(spark, _manifest(lake, source, number)))
    return Version(**{**body, "runs": tuple(Run(**r) for r in body["runs"])})


def _manifest(lake: Lake, source: str, number: int) -> str:
    return f"{lake.merged(source)}/manifest/{number:012d}.json"


def commit(spark: SparkSession, lake: Lake, source: str, change: Callable[[Version], Version]) -> Version:
    """Put `change` of the newest version under the next number; when another writer was faster, again on top of that."""
    while True:
        now = version(spark, lake, source) or Version(0, "", (), 0)
        after = changed(change(now), number=now.number + 1)
        if files.create(spark, _manifest(lake, source, after.number), json.dumps(asdict(after))):
            return after


# --- runs --------------------------------------------------------------------------------------------------

def _positions(key_hash: Column, bits: Column) -> Column:
    """Places of a key in a filter of so many bits, from 1."""
    return F.array(*[F.pmod(F.xxhash64(key_hash, F.lit(i)), bits) + 1 for i in range(HASHES)])


def write_run(df: DataFrame, lake: Lake, source: str) -> Run:
    """Write rows (one per key) with ranges and filters; nobody sees them until a manifest names them."""
    spark, base, name = df.sparkSession, lake.merged(source), uuid.uuid4().hex
    rows = project_contract(df).drop("source").withColumns({
        "month": F.coalesce(F.date_format("posted_at", "yyyy-MM"), F.lit(_NO_MONTH)), "key_hash": F.xxhash64("job_id")})
    # A range exchange whose partitions are joined to the advised size at run time: files by size, sorted all over.
    rows.select(*_RUN.fieldNames()).sort("month", "key_hash").write.parquet(f"{base}/data/{name}")
    there = (spark.read.schema(_RUN).parquet(f"{base}/data/{name}")
             .select(F.lit(name).alias("run"), F.col("_metadata.file_name").alias("file"), "month", "key_hash"))
    ranges = there.groupBy("run", "file", "month").agg(F.count("*").alias("rows"), F.min("key_hash").alias("low"), F.max("key_hash").alias("high"))
    ranges.coalesce(1).write.parquet(f"{base}/ranges/{name}")
    ranges = spark.read.schema(_RANGES).parquet(f"{base}/ranges/{name}")
    size = ranges.groupBy("file").agg((F.sum("rows") * BITS_PER_KEY).alias("bits"))
    places = there.join(size, "file").select("run", "file", "bits", F.explode(_positions(F.col("key_hash"), F.col("bits"))).alias("place"))
    blooms = places.groupBy("run", "file", "bits", F.bitmap_bucket_number("place").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bitmap"))
    blooms.write.option("compression", "zstd").parquet(f"{base}/blooms/{name}")
    return Run(name, 0, ranges.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0])


def _scan(spark: SparkSession, lake: Lake, source: str, run: Run, only: Iterable[str] | None = None) -> DataFrame:
    """Rows of a run, or of some of its files, with the number of the run."""
    folder = f"{lake.merged(source)}/data/{run.name}"
    paths = [folder] if only is None else [f"{folder}/{f}" for f in sorted(only)]
    rows = spark.read.schema(_RUN).parquet(*paths) if paths else spark.createDataFrame([], _RUN)
    return rows.withColumns({"source": F.lit(source), "seq": F.lit(run.seq).cast("long")})


def _merged(runs: Sequence[DataFrame]) -> DataFrame:
    """Newest version of each key over runs, oldest first; the oldest holds a key once."""
    if len(runs) == 1:
        return runs[0]
    return D.upsert_history(runs[0], reduce(DataFrame.unionByName, runs[1:]), tie=("seq",), snapshot=True)


def _beside(spark: SparkSession, lake: Lake, source: str, kind: str, schema: str, runs: Sequence[Run]) -> DataFrame:
    return spark.read.schema(schema).parquet(*[f"{lake.merged(source)}/{kind}/{r.name}" for r in runs])


# --- reading -----------------------------------------------------------------------------------------------

def read(spark: SparkSession, lake: Lake, source: str, months: Sequence[str] | None = None,
         number: int | None = None) -> DataFrame | None:
    """Postings of a version, the newest by default; None when there is none.

    `months` gives those of these months of posting, and those without one. Of the oldest run only files that hold such
    rows are read; later runs are read in full, since a key may have moved to another month.
    """
    state = version(spark, lake, source, number)
    if state is None:
        return None
    runs = state.runs
    if not runs:
        return spark.createDataFrame([], POSTING)
    first = None
    if months is not None:
        ranges = _beside(spark, lake, source, "ranges", _RANGES, runs[:1])
        # At most one name per file of the run, as for any scan.
        first = {r["file"] for r in ranges.where(F.col("month").isin(*months, _NO_MONTH)).select("file").distinct().collect()}
    rows = _merged([_scan(spark, lake, source, r, first if i == 0 else None) for i, r in enumerate(runs)])
    if months is not None:
        rows = rows.where(F.col("month").isin(*months, _NO_MONTH))
    return rows.select(*POSTING.fieldNames())


def files_with(spark: SparkSession, lake: Lake, source: str, runs: Sequence[Run], keys: DataFrame) -> dict[str, set[str]]:
    """Files of each run that may hold one of the `keys` (key_hash, each once): by range of hashes, then by Bloom filter.

    Keys are counted by cell first. A file with more than PROBED keys in its cells is taken as it is, since its filter lets
    one of them through in any case; so filters are asked for PROBED keys a file at most, however many keys there are.
    """
    cell = F.shiftright(F.col("key_hash"), _CELL).alias("cell")
    ranges = _beside(spark, lake, source, "ranges", _RANGES, runs).withColumn(
        "cell", F.explode(F.sequence(F.shiftright("low", _CELL), F.shiftright("high", _CELL))))
    load = (ranges.select("run", "file", "cell").distinct().join(keys.groupBy(cell).agg(F.count("*").alias("n")), "cell")
            .groupBy("run", "file").agg(F.sum("n").alias("n")))
    out: dict[str, set[str]] = {r.name: set() for r in runs}
    open_: list[tuple[str, str]] = []
    for row in load.collect():  # names of files, at most all of them
        if row["n"] > PROBED:
            out[row["run"]].add(row["file"])
        else:
            open_.append((row["run"], row["file"]))
    if not open_:
        return out
    left = spark.createDataFrame(open_, "run string, file string")
    near = (keys.select("key_hash", cell).join(ranges.join(left, ["run", "file"], "left_semi"), "cell")
            .where(F.col("key_hash").between(F.col("low"), F.col("high"))).select("run", "file", "key_hash").distinct())
    blooms = _beside(spark, lake, source, "blooms", _BLOOM, runs)
    size = blooms.select("run", "file", "bits").distinct()
    asked = near.join(size, ["run", "file"]).select("run", "file", "key_hash", F.explode(
        _positions(F.col("key_hash"), F.col("bits"))).alias("place"))
    asked = asked.withColumns({"bucket": F.bitmap_bucket_number("place"), "bit": F.bitmap_bit_position("place").cast("int")})
    byte = F.conv(F.hex(F.substring(F.col("bitmap"), F.shiftright("bit", 3) + 1, F.lit(1))), 16, 10).cast("int")
    held = F.getbit(byte, F.col("bit") % 8) == 1
    found = (asked.join(blooms.drop("bits"), ["run", "file", "bucket"]).where(held).groupBy("run", "file", "key_hash")
             .agg(F.count("*").alias("n")).where(F.col("n") == HASHES).select("run", "file").distinct())
    for row in found.collect():  # names of files to scan, at most all of them
        out[row["run"]].add(row["file"])
    return out


def _of_keys(rows: Sequence[DataFrame], keys: DataFrame | None) -> DataFrame:
    """Rows of several scans, those of the `keys` (job_id, each once) if any are given.

    Scans are put together before they are dealt by key (see `metrics.stacked`), with an inner join, as Spark would push a
    semi join below the union.
    """
    rows = reduce(DataFrame.unionByName, rows)
    return rows if keys is None else rows.join(keys, "job_id")


def _newest_first() -> list[Column]:
    return [*(F.desc_nulls_last(text(c)) for c in LINEAGE_ORDER), F.desc("seq")]


def lookup(spark: SparkSession, lake: Lake, source: str, keys: DataFrame, number: int | None = None) -> DataFrame:
    """Current rows of the `keys` (job_id), from the files that may hold them."""
    state = version(spark, lake, source, number)
    runs = state.runs if state else ()
    keys = keys.select("job_id").distinct()
    if not runs:
        return spark.createDataFrame([], POSTING)
    hit = files_with(spark, lake, source, runs, keys.select(F.xxhash64("job_id").alias("key_hash")))
    parts = [_scan(spark, lake, source, r, hit[r.name]) for r in runs if hit[r.name]]
    if not parts:
        return spark.createDataFrame([], POSTING)
    return first_k(_of_keys(parts, keys), ["job_id"], _newest_first(), 1).select(*POSTING.fieldNames())


def _filled(runs: tuple[Run, ...]) -> tuple[Run, ...]:
    return tuple(r for r in runs if r.rows)


# --- writing -----------------------------------------------------------------------------------------------

def upsert(batch: DataFrame, lake: Lake, source: str, label: str, compact_after: bool = True) -> Version:
    """Add a batch (one row per key, as `dedup_batch` leaves it) as a version of its own."""
    spark = batch.sparkSession
    run = write_run(batch, lake, source)
    keys = _scan(spark, lake, source, run).select("job_id")

    def add(now: Version) -> Version:
        # Keys are counted; which version of a key is the newest does not matter, so nothing is merged.
        hit = files_with(spark, lake, source, now.runs, keys.select(F.xxhash64("job_id").alias("key_hash"))) if now.runs else {}
        known = [_scan(spark, lake, source, r, hit[r.name]).select("job_id") for r in now.runs if hit[r.name]]
        fresh = run.rows - (keys.join(reduce(DataFrame.unionByName, known), "job_id", "left_semi").count() if known else 0)
        return Version(0, label, _filled((*now.runs, changed(run, seq=now.number + 1))), now.keys + fresh, run.name)

    done = commit(spark, lake, source, add)
    return (compact(spark, lake, source) or done) if compact_after else done


def replace(df: DataFrame, lake: Lake, source: str, label: str, based_on: int | None = None) -> Version:
    """Put `df` (one row per key) in the place of the version it was made from, by default the newest of now.

    Batches that others commit in the meantime stay on top of it.
    """
    spark = df.sparkSession
    if based_on is None:
        known = versions(spark, lake, source)
        based_on = known[-1] if known else 0
    run = changed(write_run(df, lake, source), seq=based_on)

    def put(now: Version) -> Version:
        runs = _filled((run, *(r for r in now.runs if r.seq > based_on)))
        keys = run.rows if runs in ((), (run,)) else _merged([_scan(spark, lake, source, r) for r in runs]).count()
        return Version(0, label, runs, keys, whole=True)

    return commit(spark, lake, source, put)


def to_merge(runs: Sequence[Run], fan_in: int = FAN_IN) -> int | None:
    """First of the runs to merge with all behind it: those behind hold as many rows, and there are `fan_in` in all."""
    for i, run in enumerate(runs):
        if len(runs) - i >= fan_in and run.rows <= sum(r.rows for r in runs[i + 1:]):
            return i
    return None


def compact(spark: SparkSession, lake: Lake, source: str, everything: bool = False) -> Version | None:
    """Merge runs that are due (or all) into one; None when none are, or another writer has merged them."""
    state = version(spark, lake, source)
    start = None if state is None else (0 if everything and len(state.runs) > 1 else to_merge(state.runs))
    if start is None:
        return None
    old = state.runs[start:]
    run = changed(write_run(_merged([_scan(spark, lake, source, r) for r in old]), lake, source), seq=old[-1].seq)

    def swap(now: Version) -> Version:
        if old[0] not in now.runs:
            raise Conflict(f"{old[0].name} is gone")
        at = now.runs.index(old[0])
        if now.runs[at:at + len(old)] != old:
            raise Conflict("runs have been merged otherwise")
        return changed(now, runs=(*now.runs[:at], run, *now.runs[at + len(old):]), delta=None, whole=False)

    try:
        return commit(spark, lake, source, swap)
    except Conflict:
        _drop(spark, lake, source, run.name)
        return None


def _drop(spark: SparkSession, lake: Lake, source: str, run: str) -> None:
    for kind in ("data", "ranges", "blooms"):
        files.delete(spark, f"{lake.merged(source)}/{kind}/{run}")


def retire(spark: SparkSession, lake: Lake, source: str, keep: int) -> list[int]:
    """Delete all manifests but the newest `keep`, and the runs that only they name."""
    if keep < 1:
        raise ValueError("at least the newest version stays")
    known = versions(spark, lake, source)

    def named(numbers: Sequence[int]) -> set[str]:
        states = [version(spark, lake, source, n) for n in numbers]
        return {r.name for s in states for r in s.runs} | {s.delta for s in states if s.delta}

    gone = known[:-keep]
    lost = named(gone) - named(known[-keep:])
    for number in gone:  # first the manifests, so that no reader begins with one whose runs are gone
        files.delete(spark, _manifest(lake, source, number))
    for run in lost:
        _drop(spark, lake, source, run)
    return gone


# --- changes -----------------------------------------------------------------------------------------------

def changes(spark: SparkSession, lake: Lake, source: str, before: int, after: int | None = None) -> DataFrame:
    """What changed between two versions, as signed rows: -1 with the old posting, 1 with the new one.

    Only keys of the batches in between can differ; both versions are asked for these alone. A replaced version is
    compared as a whole. Rows that are equal in all columns are no change.
    """
    if after is None:
        after = versions(spark, lake, source)[-1]
    between = [version(spark, lake, source, n) for n in range(before + 1, after + 1)]
    sides = {}  # run -> signs of the versions it belongs to; a run that both name is read once
    for sign, state in ((-1, version(spark, lake, source, before) if before else None), (1, version(spark, lake, source, after))):
        for r in state.runs if state else ():
            sides.setdefault(r, []).append(sign)
    runs, hit, keys = list(sides), {}, None
    if before and not any(v.whole for v in between):
        deltas = [_scan(spark, lake, source, Run(v.delta, v.number, 0)).select("job_id") for v in between if v.delta]
        keys = reduce(DataFrame.unionByName, deltas).distinct() if deltas else spark.createDataFrame([], "job_id string")
        hit = files_with(spark, lake, source, runs, keys.select(F.xxhash64("job_id").alias("key_hash"))) if runs else {}
    rows = [_scan(spark, lake, source, r, hit.get(r.name)).withColumn("signs", F.array(*map(F.lit, sides[r])))
            for r in runs if keys is None or hit[r.name]]
    if not rows:
        return spark.createDataFrame([], StructType([StructField("sign", IntegerType()), *POSTING.fields]))
    asked = _of_keys(rows, keys)
    current = first_k(asked.withColumn("sign", F.explode("signs")), ["job_id", "sign"], _newest_first(), 1)
    row = F.struct(*POSTING.fieldNames())
    both = current.groupBy("job_id").agg(*[F.max(F.when(F.col("sign") == sign, row)).alias(side) for side, sign in (("old", -1), ("new", 1))])
    signed = F.array(F.struct(F.lit(-1).alias("sign"), F.col("old").alias("row")), F.struct(F.lit(1).alias("sign"), F.col("new").alias("row")))
    return (both.where(~F.col("old").eqNullSafe(F.col("new"))).select(F.explode(signed).alias("s"))
            .where(F.col("s.row.job_id").isNotNull()).select("s.sign", "s.row.*"))


# --- catalog -----------------------------------------------------------------------------------------------

def register(spark: SparkSession, lake: Lake, source: str, database: str) -> str:
    """Declare the runs of the newest version as one external table, a partition each, and the view that merges them.

    Table and view are declared once, with the schema; later calls only move partitions to the runs of the manifest, so
    whoever queries the view sees the new version.
    """
    state = version(spark, lake, source)
    if state is None:
        raise ValueError(f"no snapshot of source {source}")
    table, view = f"{database}.postings_{source}_runs", f"{database}.postings_{source}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in _RUN.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}, seq BIGINT, run STRING) USING parquet PARTITIONED BY (seq, run) "
              f"LOCATION '{lake.merged(source)}/data'")
    wanted = {(r.seq, r.name) for r in state.runs}
    parts = (dict(p.split("=") for p in row[0].split("/")) for row in spark.sql(f"SHOW PARTITIONS {table}").collect())
    there = {(int(p["seq"]), p["run"]) for p in parts}
    for seq, run in sorted(wanted - there):
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION (seq={seq}, run='{run}') LOCATION '{lake.merged(source)}/data/{run}'")
    for seq, run in sorted(there - wanted):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (seq={seq}, run='{run}')")
    order = ", ".join(f"coalesce({c}, '') DESC" for c in LINEAGE_ORDER)
    names = ", ".join(c for c in POSTING.fieldNames() if c != "source")
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT {names}, '{source}' AS source FROM (SELECT *, row_number() OVER "
              f"(PARTITION BY job_id ORDER BY {order}, seq DESC) AS newest FROM {table}) WHERE newest = 1")
    return view
