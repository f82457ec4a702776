"""Current postings as keyed state of a stream: the newest version of every key, in RocksDB, emitting changes only.

Each key keeps the lineage of its newest version and a hash of the row. A micro-batch gives out a row only where it brings a
newer version; copies, replays and older versions end here, so the snapshot receives what changed and nothing else. A key
is forgotten once the watermark (event time less the lookback) has passed its last event by the lookback again, or up to a
sixteenth of the lookback later: rows that old do not come in any more. Should one come later by another way, it is given
out, and the snapshot, which knows lineage as well, decides. State and snapshot therefore agree with an upsert of all rows,
whatever the batches, restarts or replays.

Python and the state store talk by messages, about 2 ms a key when each key is a group of its own. So keys are dealt into
BUCKETS groups by hash; a group keeps its keys in one value and has one timer, and a message serves all keys of a group.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..functions.text import text
from ..operators.standardize import project_contract
from ..schema import LINEAGE_ORDER, POSTING
from ..sources import files, lake as A, snapshot as S
from .landing_stream import query_name

#: Working columns; rows reach a processor as named tuples, whose names must not begin with an underscore.
_ORDER = [f"order_{i}" for i in range(len(LINEAGE_ORDER))]
_IN = StructType([*POSTING.fields, StructField("at_ms", LongType()), StructField("row_hash", LongType()),
                  *[StructField(c, StringType()) for c in _ORDER]])
#: Groups of keys. Part of a checkpoint: with another number its state would be looked for in other groups.
BUCKETS = 16_384
#: Next time a group is looked through, and its keys as JSON: [job_id, lineage ..., row_hash, until_ms] each.
_STATE = StructType([StructField("timer_ms", LongType()), StructField("keys", StringType())])
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_PARTS = "spark.sql.shuffle.partitions"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class NewestVersion(StatefulProcessor):
    """Newest version per key by lineage as text; of equal lineage the later batch wins, in a batch the larger hash."""

    def __init__(self, keep_ms: int):
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.newest = handle.getValueState("newest", _STATE)

    def _known(self) -> tuple[int | None, dict]:
        state = self.newest.get()
        return (None, {}) if state is None else (state[0], {k[0]: k[1:] for k in json.loads(state[1])})

    def _keep(self, timer: int | None, known: dict) -> None:
        """Store the keys; the group is looked through when the first is due, with some room, so that one look serves several."""
        due = min(k[-1] for k in known.values()) + self.keep_ms // 16
        if timer is None or due < timer:
            self.handle.registerTimer(due)
            timer = due
        self.newest.update((timer, json.dumps([[key, *k] for key, k in known.items()], separators=(",", ":"))))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        best: dict = {}  # job_id -> newest of the batch: lineage and hash, row
        until: dict = {}
        for row in rows:
            job = row["job_id"]
            until[job] = max(until.get(job, 0), row["at_ms"] + self.keep_ms)
            own = (*(row[c] for c in _ORDER), row["row_hash"])
            if job not in best or own > best[job][0]:
                best[job] = own, row
        if not best:
            return
        timer, known = self._known()
        stored, out = False, []
        for job, (rank, row) in best.items():
            had = known.get(job)
            *lineage, row_hash = rank
            changed = had is None or lineage > had[:-2] or (lineage == had[:-2] and row_hash != had[-2])
            last = max(until[job], had[-1] if had is not None else 0)
            if changed or last > had[-1]:
                known[job] = [*(rank if changed else had[:-1]), last]
                stored = True
            if changed:
                out.append(row)
        if stored:
            self._keep(timer, known)
        for row in out:
            yield Row(**{c: row[c] for c in POSTING.fieldNames()})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        _, known = self._known()
        passed = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        left = {job: k for job, k in known.items() if k[-1] > passed}
        if left:
            self._keep(None, left)
        else:
            self.newest.clear()
        return iter(())

    def close(self) -> None:
        pass


def changed_versions(rows: DataFrame, event_time: str, lookback_hours: int) -> DataFrame:
    """Streaming postings (contract and `event_time`) to those that are newer than what their key had."""
    prints = F.xxhash64(*[F.col(c) for c in POSTING.fieldNames()])
    keyed = (project_contract(rows.withColumn("event", F.col(event_time).cast("timestamp")), keep=("event",))
             .withWatermark("event", f"{lookback_hours} hours")
             .withColumns({"at_ms": F.unix_millis("event"), "row_hash": prints,
                           **{o: text(c) for o, c in zip(_ORDER, LINEAGE_ORDER)},
                           "bucket": F.pmod(F.xxhash64("job_id"), F.lit(BUCKETS))}))
    return (keyed.select(*_IN.fieldNames(), "event", "bucket").groupBy("bucket").transformWithState(
        NewestVersion(lookback_hours * 3_600_000), POSTING, "Update", "EventTime"))


def start_current_stream(spark: SparkSession, rows: DataFrame, lake: A.Lake, checkpoint: str, source: str, event_time: str,
                         lookback_hours: int = 48, every: str | None = None, state_partitions: int | None = None) -> StreamingQuery:
    """Keep the snapshot of `source` up to date with a stream of postings.

    Per micro-batch the changed versions become one version of the snapshot, named by query and batch. A replayed batch
    that is the newest version already is left alone; any other replay adds the same rows again, which changes nothing.
    `state_partitions` is the number of parts the state is dealt into, for good, when a checkpoint is new; by default as
    many as the session shuffles into.
    """
    query = query_name(checkpoint)

    def commit(changed: DataFrame, batch_id: int) -> None:
        # Every action on `changed` runs the state again, so it is written once and read back; by the session outside of
        # the stream, as that of a stream plans without regard to sizes.
        label = f"{query}-{batch_id:06d}"
        staged = f"{lake.merged(source)}/staged/{label}"
        changed.write.mode("overwrite").parquet(staged)
        state, rows = S.version(spark, lake, source), spark.read.schema(POSTING).parquet(staged)
        if (state is None or state.label != label) and not rows.isEmpty():
            S.upsert(rows, lake, source, label)
        files.delete(spark, staged)

    settings = {_PROVIDER: _ROCKSDB, **({_PARTS: str(state_partitions)} if state_partitions else {})}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:  # the query takes the settings along when it starts
        return (changed_versions(rows, event_time, lookback_hours).writeStream.outputMode("update").foreachBatch(commit)
                .option("checkpointLocation", checkpoint)
                .trigger(**({"processingTime": every} if every else {"availableNow": True})).start())
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
