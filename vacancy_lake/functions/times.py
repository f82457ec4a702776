"""Column functions for posting times, months and the time axis."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, functions as F

from .text import squash, text

MONTH_PATTERN = r"^[0-9]{4}-[0-9]{2}$"
_ISO = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ].*)?$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def iso_timestamp(c: Column | str) -> Column:
    """ISO-8601 text (date, local time read as UTC, or with offset) to a timestamp of whole seconds."""
    s = squash(text(c))
    return F.date_trunc("second", F.when(s.rlike(_ISO), s.try_cast("timestamp")))


def epoch_timestamp(c: Column | str) -> Column:
    """Seconds since 1970 as number or digit string to a timestamp; anything else is NULL."""
    s = squash(text(c))
    seconds = F.when(s.rlike(r"^-?[0-9]+(\.[0-9]+)?([eE]\+?[0-9]+)?$"), s.try_cast("double")).try_cast("long")
    return F.when(seconds.between(-62135596800, 253402300799), F.timestamp_seconds(seconds))


def posted_at(epoch_or_iso: Column | str, iso: Column | str | None = None) -> Column:
    """Posting time from the epoch-or-ISO field, else from the ISO-only field; failure is NULL."""
    found = [epoch_timestamp(epoch_or_iso), iso_timestamp(epoch_or_iso)]
    if iso is not None:
        found.append(iso_timestamp(iso))
    return F.coalesce(*found)


def created_epoch(c: Column | str, kind: str) -> Column:
    """Creation second used by the landing watermark: `kind` is "epoch" or "iso"; unreadable values are 0."""
    ts = epoch_timestamp(c) if kind == "epoch" else iso_timestamp(c)
    return F.coalesce(F.unix_timestamp(ts), F.lit(0).cast("long"))


def stored_time(c: Column | str, is_timestamp: bool) -> Column:
    """A stored posting time, typed or as text; plain numbers count as epoch seconds inside 1e9..1e11."""
    if is_timestamp:
        return _col(c).cast("timestamp")
    s = squash(text(c))
    seconds = s.try_cast("double")
    epoch = F.when((seconds >= 1e9) & (seconds < 1e11), F.timestamp_seconds(seconds.try_cast("long")))
    return F.coalesce(iso_timestamp(s), epoch)


def month_of(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def ingest_month(c: Column | str) -> Column:
    m = F.left(F.btrim(text(c)), F.lit(7))
    return F.when(m.rlike(MONTH_PATTERN), m)


def window_months(as_of: date) -> tuple[str, str]:
    """The rolling window: previous and current month of `as_of`, as literals that prune partitions."""
    y, m = (as_of.year, as_of.month - 1) if as_of.month > 1 else (as_of.year - 1, 12)
    return f"{y:04d}-{m:02d}", f"{as_of.year:04d}-{as_of.month:02d}"


def dominant_axis(axis: Column | str) -> Column:
    """Aggregate: the single time axis of a group, `mixed` if there are several."""
    axis = F.when(F.btrim(_col(axis)) != "", _col(axis))
    low, high = F.min(axis), F.max(axis)
    return F.coalesce(F.when(low == high, low), F.when(low != high, F.lit("mixed")), F.lit("ingest_fallback"))
