"""Landing: which fetched rows are new, their identity, and the envelope they are stored in."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import squash, text
from ..functions.times import created_epoch
from ..schema import LANDING


@dataclass(frozen=True)
class Dialect:
    """How one kind of source spells its payload.

    `key_paths` are tried in order as (label of the hashed part, JSON path, strategy name); when all are blank
    the `fallback_paths` are hashed together. `created_kind` is "epoch" or "iso".
    """

    name: str
    key_paths: tuple[tuple[str, str, str], ...]
    fallback_paths: tuple[str, ...]
    fallback_strategy: str
    created_path: str
    created_kind: str
    slug_path: str
    url_path: str
    id_path: str | None = None


# Field preference and labels of the two payload dialects.
BOARD = Dialect(
    "board", (("slug", "$.slug", "slug"), ("url", "$.url", "url")),
    ("$.title", "$.company_name", "$.location", "$.created_at"), "fallback_text_time",
    "$.created_at", "epoch", "$.slug", "$.url")


def aggregator(strategy_prefix: str = "") -> Dialect:
    p = strategy_prefix
    return Dialect(
        "aggregator", (("id", "$.id", p + "id"), ("redirect_url", "$.redirect_url", p + "redirect_url")),
        ("$.title", "$.company.display_name", "$.created"), p + "fallback_text_time",
        "$.created", "iso", "$.id", "$.redirect_url", "$.id")


def json_text(payload: Column, path: str) -> Column:
    return F.get_json_object(payload, path)


def created_seconds(dialect: Dialect, payload: str = "raw_payload") -> Column:
    return created_epoch(json_text(F.col(payload), dialect.created_path), dialect.created_kind)


def select_incremental(df: DataFrame, ts: Column, watermark: int | None, lookback_hours: int,
                       cap: int | None = None, mode: str = "lookback",
                       more: tuple[Column, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Rows to land and a one-row report.

    No watermark yet, or `mode="floor"` (the source already filtered): everything. Otherwise rows created
    strictly after watermark - lookback, or after `cap` if that is earlier. Literals, so the test reaches the
    scan. The report comes from one aggregate over the full fetch, with the next watermark in `max_created`;
    `more` adds aggregates to it.
    """
    if mode not in ("lookback", "floor"):
        raise ValueError(f"unknown mode {mode!r}")
    cutoff = None
    if mode == "lookback" and watermark is not None:
        cutoff = watermark - lookback_hours * 3600
        cutoff = cutoff if cap is None else min(cutoff, cap)
    keep = F.lit(True) if cutoff is None else ts > F.lit(cutoff)
    name = "floor" if mode == "floor" else "bootstrap" if watermark is None else "lookback"
    report = df.agg(
        F.lit(name).alias("filter_mode"), F.count(F.lit(1)).alias("fetched"), F.count_if(keep).alias("landed"),
        F.count_if(~keep).alias("filtered_out"), F.lit(watermark).cast("long").alias("watermark_before"),
        F.lit(cutoff).cast("long").alias("cutoff"), F.max(ts).alias("max_created"), F.min(ts).alias("min_created"),
        *more)
    return (df if cutoff is None else df.where(keep)), report


def floor_fetch(df: DataFrame, column: str, floor: int | None) -> DataFrame:
    """What a source that filters by a minimum creation time returns: the predicate is pushed into the scan."""
    return df if floor is None else df.where(F.col(column) >= F.lit(floor))


def refuse_empty(report: DataFrame) -> dict:
    """The report as a dict; an empty fetch is refused so that it can not move the watermark."""
    row = report.first().asDict()
    if row["fetched"] == 0:
        raise ValueError("empty fetch: landing state is left alone")
    return row


def next_watermark(df: DataFrame, ts: Column, keys=("source",)) -> DataFrame:
    """Largest creation second over everything fetched, filtered rows included."""
    return df.groupBy(*keys).agg(F.max(ts).alias("fetch_watermark"))


def hash_key(*parts: Column) -> Column:
    """sha256 over trimmed lower-case parts joined by a bar; missing parts count as empty text."""
    return F.sha2(F.concat_ws("|", *[F.lower(squash_ends(p)) for p in parts]), 256)


def squash_ends(c: Column) -> Column:
    return F.regexp_replace(text(c), r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def with_job_key(df: DataFrame, dialect: Dialect, payload: str = "raw_payload", source: str = "source") -> DataFrame:
    """Add job_id and job_id_strategy by field preference of the dialect."""
    body, src = F.col(payload), F.col(source)
    ids, names = [], []
    for label, path, strategy in dialect.key_paths:
        value = squash_ends(json_text(body, path))
        ids.append(F.when(value != "", hash_key(src, F.lit(label), value)))
        names.append(F.when(value != "", F.lit(strategy)))
    rest = [json_text(body, p) for p in dialect.fallback_paths]
    return df.withColumns({
        "job_id": F.coalesce(*ids, hash_key(src, F.lit("fallback"), *rest)),
        "job_id_strategy": F.coalesce(*names, F.lit(dialect.fallback_strategy))})


def to_landing(df: DataFrame, dialect: Dialect, run_id: str | Column, ingest_date: str | Column,
               batch_created_at: str | Column, ingested_at: str | Column | None = None,
               payload: str = "raw_payload", keep: tuple[str, ...] = ()) -> DataFrame:
    """Wrap payload rows (source, raw_payload) in the landing envelope of one run; `keep` carries more columns along."""
    def as_col(v):
        return v if isinstance(v, Column) else F.lit(v)

    body = F.col(payload)
    stamped = with_job_key(df, dialect, payload).withColumns({
        "schema_version": F.lit("v1"),
        "source_job_id": squash_ends(json_text(body, dialect.id_path)) if dialect.id_path
        else F.lit(None).cast("string"),
        "source_slug": text(json_text(body, dialect.slug_path)),
        "source_url": text(json_text(body, dialect.url_path)),
        "ingested_at": as_col(ingested_at if ingested_at is not None else batch_created_at),
        "run_id": as_col(run_id), "bronze_ingest_date": as_col(ingest_date),
        "batch_created_at": as_col(batch_created_at), "raw_payload": body})
    return stamped.select(*LANDING.fieldNames(), *keep)


def payload_json(df: DataFrame, source: Column | str) -> DataFrame:
    """Rows of any shape as (source, raw_payload) with the whole row as JSON text."""
    src = source if isinstance(source, Column) else F.lit(source)
    return df.select(src.alias("source"), F.to_json(F.struct("*")).alias("raw_payload"))


__all__ = ["BOARD", "Dialect", "aggregator", "created_seconds", "floor_fetch", "hash_key", "next_watermark",
           "payload_json", "refuse_empty", "select_incremental", "squash", "to_landing", "with_job_key"]
