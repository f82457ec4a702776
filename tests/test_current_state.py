"""Newest version per key as stream state: restarts, repeated and late rows, time to live."""

from pathlib import Path

from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, TimestampType

from test_snapshot import model, postings, random_batches, shown
from vacancy_lake.schema import POSTING
from vacancy_lake.sources import snapshot as S
from vacancy_lake.streaming import current_state as CS

SCHEMA = StructType([*POSTING.fields, StructField("at", TimestampType())])


def drop(spark, lake, name, rows, minute):
    at = F.timestamp_seconds(F.lit(1_700_000_000 + 60 * minute))
    postings(spark, rows).withColumn("at", at).coalesce(1).write.parquet(f"{lake.root}/in/{name}")


def run(spark, lake, lookback=48, checkpoint="c"):
    rows = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{lake.root}/in/*")
    query = CS.start_current_stream(spark, rows, lake, f"{lake.root}/{checkpoint}", "s", "at", lookback)
    query.awaitTermination()
    return query


def deltas(spark, lake):
    """Rows that each batch gave out."""
    states = [S.version(spark, lake, "s", n) for n in S.versions(spark, lake, "s")]
    return [next(r.rows for r in v.runs if r.name == v.delta) for v in states if v.delta and any(r.name == v.delta for r in v.runs)]


def test_state_equals_an_upsert_of_all_rows(spark, lake):
    batches = random_batches(3, 6)
    for i, batch in enumerate(batches):
        drop(spark, lake, f"b{i}", batch, i)
        if i in (2, 5):  # a restart in between
            run(spark, lake)
            assert shown(S.read(spark, lake, "s")) == {k: v[:2] for k, v in model(batches[:i + 1]).items()}
    known = S.versions(spark, lake, "s")
    run(spark, lake)
    assert S.versions(spark, lake, "s") == known  # nothing new, no version


def test_changes_only(spark, lake):
    first = [(k, "a", 1, "r1", None) for k in range(20)]
    drop(spark, lake, "b0", first, 0)
    drop(spark, lake, "b1", first, 1)  # the same rows again: no change, no version
    drop(spark, lake, "b2", [(1, "b", 2, "r2", None), (2, "old", 1, "r0", None), (3, "a", 1, "r1", None), (99, "new", 1, "r1", None)], 2)
    run(spark, lake)
    assert deltas(spark, lake) == [20, 2]
    got = shown(S.read(spark, lake, "s"))
    assert got[1][0] == "b" and got[2][0] == "a" and got[99][0] == "new" and len(got) == 21


def test_several_versions_in_a_batch_and_equal_lineage(spark, lake):
    drop(spark, lake, "b0", [(1, "x", 3, "r", None), (1, "y", 4, "r", None), (1, "z", 2, "r", None), (None, "n", 1, "r", None)], 0)
    drop(spark, lake, "b1", [(1, "later batch", 4, "r", None)], 1)
    run(spark, lake)
    rows = {r["job_id"]: r["title_norm"] for r in S.read(spark, lake, "s").collect()}
    assert rows["1"] == "later batch" and len(rows) == 2


def test_state_is_forgotten_after_the_lookback(spark, lake):
    drop(spark, lake, "b0", [(k, "a", 5, "r5", None) for k in range(30)], 0)
    for i in range(1, 4):  # hours later than the lookback of one
        drop(spark, lake, f"b{i}", [(100 + i, "tick", 1, "r", None)], 600 * i)
    query = run(spark, lake, 1)
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert max(kept) >= 30 and kept[-1] < 30
    # A row older than the watermark is late and does not come in; a forgotten key with older lineage does not win.
    drop(spark, lake, "b4", [(5, "late", 9, "r9", None)], 0)
    drop(spark, lake, "b5", [(6, "older lineage", 1, "r0", None), (7, "newer lineage", 9, "r9", None)], 1801)
    run(spark, lake, 1)
    got = shown(S.read(spark, lake, "s"))
    assert (got[5][0], got[6][0], got[7][0]) == ("a", "a", "newer lineage")


def test_groups_of_many_keys(spark, lake, monkeypatch):
    """Three groups hold all keys: newest, older and repeated versions, restarts, and a group forgets only what is due."""
    monkeypatch.setattr(CS, "BUCKETS", 3)
    batches = [[(k, "a", 5, "r5", None) for k in range(40)], [(k, "b", 5 + (k % 3) - 1, "r6", None) for k in range(10, 40)]]
    for i, batch in enumerate(batches):
        drop(spark, lake, f"b{i}", batch, i)
        run(spark, lake, 1)
    assert shown(S.read(spark, lake, "s")) == {k: v[:2] for k, v in model(batches).items()}
    assert [S.version(spark, lake, "s", n).runs[-1].rows for n in S.versions(spark, lake, "s")] == [40, sum(k % 3 > 0 for k in range(10, 40))]
    for i in range(2, 5):  # half of the keys come again and stay; the others are due
        drop(spark, lake, f"b{i}", [(k, "c", 6 + i, "r7", None) for k in range(20)], 600 * i)
    query = run(spark, lake, 1)
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert max(kept) < 20  # one value and its timer a group, not a key
    held = {k[0] for r in spark.read.format("statestore").option("stateVarName", "newest").load(f"{lake.root}/c").select("value.keys").collect()
            for k in CS.json.loads(r["keys"])}
    assert held == {str(k) for k in range(20)}


def test_state_runs_once_a_batch(spark, lake, monkeypatch):
    plans, upsert = [], S.upsert
    monkeypatch.setattr(S, "upsert", lambda rows, *a: (plans.append(rows._jdf.queryExecution().toString()), upsert(rows, *a))[1])
    drop(spark, lake, "b0", [(k, "a", 1, "r1", None) for k in range(20)], 0)
    run(spark, lake)
    assert plans and not any("TransformWithState" in plan for plan in plans)
    assert not list(Path(lake.merged("s")).glob("staged/*"))
