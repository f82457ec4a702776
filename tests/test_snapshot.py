"""The merge tree of current postings: against a dictionary, under two writers, by size of what is written."""

import random
import threading
from functools import reduce
from pathlib import Path

import pytest
from pyspark.sql import DataFrame, functions as F

from vacancy_lake.schema import POSTING
from vacancy_lake.sources import files, snapshot as S


def postings(spark, rows, source="s"):
    """(key, title, ingest day, run, month of posting or None)."""
    made = spark.createDataFrame([(None if k is None else str(k), t, f"2024-02-{d:02d}", r, m) for k, t, d, r, m in rows],
                                 "job_id string, title_norm string, bronze_ingest_date string, bronze_run_id string, m string")
    other = {c.name: F.lit(None).cast(c.dataType) for c in POSTING.fields if c.name not in made.columns}
    return made.withColumns({**other, "source": F.lit(source), "skills": F.array("title_norm"),
                             "posted_at": F.to_timestamp(F.concat("m", F.lit("-03")))}).select(*POSTING.fieldNames())


def shown(df):
    return {int(r["job_id"]): (r["title_norm"], r["bronze_ingest_date"]) for r in df.collect()}


def folder_bytes(lake, kind="*"):
    return sum(p.stat().st_size for p in Path(lake.merged("s")).glob(f"{kind}/**/*.parquet"))


def random_batches(seed, n=14, keys=60):
    rng = random.Random(seed)
    return [[(k, f"t{seed}-{i}-{k}", rng.randint(1, 5), f"r{i}", rng.choice(["2024-01", "2024-02", None]))
             for k in rng.sample(range(keys), rng.randint(1, 12))] for i in range(n)]


def model(batches):
    now = {}
    for i, batch in enumerate(batches):
        for k, t, d, r, m in batch:
            if k not in now or (f"2024-02-{d:02d}", r, i) >= now[k][2]:
                now[k] = (t, f"2024-02-{d:02d}", (f"2024-02-{d:02d}", r, i), m)
    return now


def test_upserts_equal_a_dictionary(spark, lake):
    batches = random_batches(1)
    for i, batch in enumerate(batches):
        done = S.upsert(postings(spark, batch), lake, "s", f"v{i}")
        assert done.keys == len(model(batches[:i + 1]))
    want = model(batches)
    assert shown(S.read(spark, lake, "s")) == {k: v[:2] for k, v in want.items()}
    assert len(done.runs) < len(batches)  # some have been merged
    asked = spark.createDataFrame([(str(k),) for k in (3, 7, 7, 999, 41)], "job_id string")
    assert shown(S.lookup(spark, lake, "s", asked)) == {k: v[:2] for k, v in want.items() if k in (3, 7, 999, 41)}
    january = S.read(spark, lake, "s", months=["2024-01"])
    assert shown(january) == {k: v[:2] for k, v in want.items() if v[3] in ("2024-01", None)}
    S.compact(spark, lake, "s", everything=True)
    assert len(S.version(spark, lake, "s").runs) == 1 and shown(S.read(spark, lake, "s")) == {k: v[:2] for k, v in want.items()}


def test_null_keys_empty_batches_and_no_snapshot(spark, lake):
    assert S.read(spark, lake, "s") is None and S.version(spark, lake, "s") is None and S.versions(spark, lake, "s") == []
    empty = postings(spark, [(1, "a", 1, "r", None)]).limit(0)
    assert S.upsert(empty, lake, "s", "v").runs == () and S.read(spark, lake, "s").count() == 0
    assert S.lookup(spark, lake, "s", empty).count() == 0
    S.upsert(postings(spark, [(1, "a", 1, "r", None)]), lake, "s", "v")
    assert S.replace(empty, lake, "s", "none").keys == 0 and S.read(spark, lake, "s").count() == 0


def test_small_batch_writes_little(spark, lake):
    """A thousand keys into a million: under a hundredth of the bytes, in a handful of files, nothing rewritten."""
    n = 1_000_000
    every = spark.range(n).select(
        F.sha2(F.col("id").cast("string"), 256).alias("job_id"), F.concat(F.lit("title "), F.col("id") % 500).alias("title_norm"),
        F.date_add(F.lit("2023-01-01").cast("date"), (F.col("id") % 400).cast("int")).cast("timestamp").alias("posted_at"),
        F.lit("2024-01-01").alias("bronze_ingest_date"), F.lit("r0").alias("bronze_run_id"))
    none = {c.name: F.lit(None).cast(c.dataType) for c in POSTING.fields if c.name not in every.columns}
    every = every.withColumns({**none, "source": F.lit("s")}).select(*POSTING.fieldNames())
    first = S.replace(every, lake, "s", "base")
    size, count = folder_bytes(lake), len(list(Path(lake.merged("s")).glob("data/**/*.parquet")))
    assert count <= 40  # 14 months: files follow bytes
    done = S.upsert(every.where("pmod(xxhash64(job_id), 1000) = 7").withColumn("title_norm", F.lit("new")), lake, "s", "batch")
    assert folder_bytes(lake) - size < 0.02 * size
    assert done.runs[0] == first.runs[0] and done.keys == n and 900 < done.runs[1].rows < 1100
    assert len(list(Path(lake.merged("s")).glob("data/**/*.parquet"))) <= count + 8
    changed = S.read(spark, lake, "s").where("title_norm = 'new'").count()
    assert changed == done.runs[1].rows
    # A month is read from the files that hold it, a few keys from the files that may hold them.
    month = S.read(spark, lake, "s", months=["2023-05"], number=first.number)
    assert len(month.inputFiles()) < count or count == 1
    plan = month._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(month, [2023-05,none])" in plan


def test_filters_leave_out_files_without_the_keys(spark, lake):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for seed in range(3):
            S.upsert(postings(spark, [(seed * 1000 + k, "t", 1, "r", "2024-01") for k in range(400)]), lake, "s", "v", compact_after=False)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    state = S.version(spark, lake, "s")
    keys = spark.createDataFrame([("1001",), ("1002",)], "job_id string").select(F.xxhash64("job_id").alias("key_hash"))
    hit = S.files_with(spark, lake, "s", state.runs, keys)
    assert 1 <= len(hit[state.runs[1].name]) <= 2 and not hit[state.runs[0].name] and not hit[state.runs[2].name]


def test_filters_are_asked_for_few_keys_of_a_file(spark, lake, monkeypatch):
    """More keys than PROBED in the range of a file: it is taken unasked, and nothing is paired key by file."""
    for seed in range(2):
        S.upsert(postings(spark, [(seed * 1000 + k, "t", 1, "r", "2024-01") for k in range(400)]), lake, "s", "v", compact_after=False)
    state = S.version(spark, lake, "s")
    asked = postings(spark, [(1000 + k, "", 1, "r", None) for k in range(40)]).select("job_id")
    keys = asked.select(F.xxhash64("job_id").alias("key_hash"))
    hit = S.files_with(spark, lake, "s", state.runs, keys)
    assert not hit[state.runs[0].name] and hit[state.runs[1].name]
    want = shown(S.lookup(spark, lake, "s", asked))
    monkeypatch.setattr(S, "PROBED", 10)
    monkeypatch.setattr(S, "_positions", lambda *_: pytest.fail("filters are asked"))
    more = S.files_with(spark, lake, "s", state.runs, keys)
    assert all(more[r.name] >= hit[r.name] for r in state.runs) and more[state.runs[0].name]
    assert shown(S.lookup(spark, lake, "s", asked)) == want and len(want) == 40


def test_upsert_counts_keys_without_merging(spark, lake, monkeypatch):
    monkeypatch.setattr(S, "lookup", lambda *_: pytest.fail("rows are merged"))
    for i, batch in enumerate(([0, 1, 2], [2, 3], [], [3, 4, 0])):
        done = S.upsert(postings(spark, [(k, "t", 1, f"r{i}", None) for k in batch]), lake, "s", f"v{i}", compact_after=False)
    assert done.keys == 5


def test_interleaved_writers_keep_both_batches(spark, lake, monkeypatch):
    S.upsert(postings(spark, [(0, "base", 1, "r0", None)]), lake, "s", "v0")
    create, entered = files.create, []

    def slow(session, path, text):
        if not entered:  # before the first manifest is created, another writer commits under its number
            entered.append(path)
            S.upsert(postings(spark, [(1, "other", 2, "r1", None), (2, "other", 9, "r1", None)]), lake, "s", "other")
        return create(session, path, text)

    monkeypatch.setattr(files, "create", slow)
    done = S.upsert(postings(spark, [(2, "mine", 3, "r2", None), (3, "mine", 3, "r2", None)]), lake, "s", "mine")
    assert done.number == 3 and done.keys == 4
    assert {k: v[0] for k, v in shown(S.read(spark, lake, "s")).items()} == {0: "base", 1: "other", 2: "other", 3: "mine"}


def test_threads_lose_no_batch(spark, lake):
    def write(who):
        for i in range(3):
            S.upsert(postings(spark, [(who * 100 + i, f"w{who}", 1, "r", None), (999, f"w{who}", 1 + i, f"r{who}", None)]), lake, "s", f"w{who}-{i}")

    threads = [threading.Thread(target=write, args=(w,)) for w in range(3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    got = shown(S.read(spark, lake, "s"))
    assert set(got) == {w * 100 + i for w in range(3) for i in range(3)} | {999}
    assert got[999] == ("w2", "2024-02-03") and S.version(spark, lake, "s").keys == 10


def test_create_is_won_once(spark, tmp_path):
    path, won = f"{tmp_path}/m/1.json", []
    threads = [threading.Thread(target=lambda i=i: won.append(files.create(spark, path, f"writer {i}"))) for i in range(6)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(won) == [False] * 5 + [True] and files.read_text(spark, path).startswith("writer ")
    assert files.names(spark, f"{tmp_path}/m") == ["1.json"]


def test_replace_keeps_what_was_committed_meanwhile(spark, lake):
    first = S.upsert(postings(spark, [(0, "a", 1, "r0", None), (1, "a", 1, "r0", None)]), lake, "s", "v0")
    S.upsert(postings(spark, [(5, "late", 2, "r1", None)]), lake, "s", "v1")
    done = S.replace(postings(spark, [(0, "rebuilt", 1, "r0", None)]), lake, "s", "rebuilt", first.number)
    assert {k: v[0] for k, v in shown(S.read(spark, lake, "s")).items()} == {0: "rebuilt", 5: "late"} and done.keys == 2


def test_compaction_gives_way(spark, lake, monkeypatch):
    """Another writer merges the same runs first: the second result is dropped, nothing is lost."""
    for i in range(3):
        S.upsert(postings(spark, [(i, "t", 1, "r", None)]), lake, "s", f"v{i}", compact_after=False)
    create, entered = files.create, []

    def slow(session, path, text):
        if not entered:
            entered.append(path)
            assert S.compact(spark, lake, "s", everything=True) is not None
        return create(session, path, text)

    monkeypatch.setattr(files, "create", slow)
    assert S.compact(spark, lake, "s", everything=True) is None
    state = S.version(spark, lake, "s")
    assert len(state.runs) == 1 and set(shown(S.read(spark, lake, "s"))) == {0, 1, 2}
    assert len(files.names(spark, f"{lake.merged('s')}/data")) == 4  # three batches and the one merged run


@pytest.mark.parametrize("rows, want", [((100, 1, 1, 1), None), ((100, 2, 1, 1), None), ((3, 1, 1, 1), 0), ((100, 3, 1, 1, 1), 1),
                                        ((4, 1, 1), None), ((50, 40, 9, 1), 0), ((), None)])
def test_runs_to_merge(rows, want):
    assert S.to_merge([S.Run(str(i), i, n) for i, n in enumerate(rows)]) == want


def test_runs_stay_logarithmic():
    runs, written = [], 0
    for i in range(2000):
        runs.append(S.Run(str(i), i, 1))
        at = S.to_merge(runs)
        if at is not None:
            runs = [*runs[:at], S.Run("m", i, sum(r.rows for r in runs[at:]))]
            written += runs[-1].rows
    assert len(runs) < 24 and written < 2000 * 24


def test_changes_between_versions(spark, lake):
    batches = random_batches(5, 8)
    numbers = []
    for i, batch in enumerate(batches):
        S.upsert(postings(spark, batch), lake, "s", f"v{i}")
        numbers.append(S.versions(spark, lake, "s")[-1])
    for a, b in ((0, 3), (2, 7), (3, 3)):
        old, new = model(batches[:a + 1]), model(batches[:b + 1])
        got = sorted((r["sign"], int(r["job_id"]), r["title_norm"]) for r in S.changes(spark, lake, "s", numbers[a], numbers[b]).collect())
        moved = [k for k in new if k not in old or old[k][0] != new[k][0]]
        assert got == sorted([(-1, k, old[k][0]) for k in moved if k in old] + [(1, k, new[k][0]) for k in moved])
    S.replace(postings(spark, [(1, "only", 1, "r", None)]), lake, "s", "whole")
    last = model(batches)
    got = S.changes(spark, lake, "s", numbers[-1]).collect()
    assert {int(r["job_id"]) for r in got if r["sign"] == -1} == set(last) and sum(r["sign"] == 1 for r in got) == 1
    assert S.changes(spark, lake, "s", 0).count() == 1


@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_changes_without_broadcasts(spark, lake, coalesce):
    """Batches too large to broadcast: rows of several runs, dealt by key, are put together and joined again by key."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": coalesce}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        S.replace(postings(spark, [(k, "t", 1, "r", "2024-01") for k in range(300)]), lake, "s", "v1")
        S.upsert(postings(spark, [(k, "u", 2, "r", "2024-02") for k in range(100, 200)]), lake, "s", "v2", compact_after=False)
        done = S.upsert(postings(spark, [(k, "w", 3, "r", "2024-02") for k in range(150, 350)]), lake, "s", "v3", compact_after=False)
        got = sorted((r["sign"], int(r["job_id"]), r["title_norm"]) for r in S.changes(spark, lake, "s", 1).collect())
        now = S.read(spark, lake, "s")
        again = now.join(postings(spark, [(k, "", 1, "r", None) for k in range(120, 400)]).select("job_id"), "job_id", "left_semi").count()
        found = shown(S.lookup(spark, lake, "s", postings(spark, [(k, "", 1, "r", None) for k in (0, 120, 160, 320, 999)])))
    finally:
        for name in settings:
            spark.conf.unset(name)
    assert got == sorted([(-1, k, "t") for k in range(100, 300)] + [(1, k, "u" if k < 150 else "w") for k in range(100, 350)])
    assert done.keys == 350 and again == 230
    assert {k: v[0] for k, v in found.items()} == {0: "t", 120: "u", 160: "w", 320: "w"}


def test_retired_versions_leave_nothing_behind(spark, lake):
    for i in range(5):
        S.upsert(postings(spark, [(i, "t", 1, "r", None)]), lake, "s", f"v{i}")
    known = S.versions(spark, lake, "s")
    assert S.retire(spark, lake, "s", 1) == known[:-1]
    state = S.version(spark, lake, "s")
    kept = {r.name for r in state.runs} | {state.delta} - {None}
    for kind in ("data", "ranges", "blooms"):
        assert set(files.names(spark, f"{lake.merged('s')}/{kind}")) == kept
    assert S.read(spark, lake, "s").count() == 5
    with pytest.raises(ValueError):
        S.retire(spark, lake, "s", 0)


def test_view_follows_the_versions(spark, lake):
    spark.sql("CREATE DATABASE IF NOT EXISTS snapshot_test")
    batches = random_batches(8, 6)
    for i, batch in enumerate(batches):
        S.upsert(postings(spark, batch), lake, "s", f"v{i}")
        view = S.register(spark, lake, "s", "snapshot_test")
        assert shown(spark.table(view)) == {k: v[:2] for k, v in model(batches[:i + 1]).items()}
    assert spark.table(view).columns == [*[c for c in POSTING.fieldNames() if c != "source"], "source"]


def test_reading_shuffles_touched_keys_alone(spark, lake):
    """Rows of the oldest run pass through an anti join; only the semi-joined ones are ranked."""
    S.upsert(postings(spark, [(k, "t", 1, "r", None) for k in range(50)]), lake, "s", "v0")
    S.upsert(postings(spark, [(1, "new", 2, "r", None)]), lake, "s", "v1", compact_after=False)
    plan = S.read(spark, lake, "s")._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan and "LeftSemi" in plan
    assert isinstance(reduce(DataFrame.unionByName, [S.read(spark, lake, "s")]), DataFrame)


def test_facts_follow_the_changes(spark, lake, tmp_path):
    """Facts brought forward from changes equal facts built anew, a month that runs empty included."""
    from vacancy_lake.plans import build as P
    from vacancy_lake.schema import FACT_DIMENSION, LINEAGE_COUNTS
    from vacancy_lake.sources import lake as A

    def facts(where, run):
        out = []
        for table in (*FACT_DIMENSION, LINEAGE_COUNTS, "pipeline_run_summary"):
            df = A.read_fact(spark, table, where).where(F.col("run_id") == run).drop("run_id", "bronze_run_id")
            if table == "pipeline_run_summary":
                df = df.where("role_row_count > 0")
            out.append(sorted(map(str, df.collect())))
        return out

    batches = random_batches(11, 5) + [[(k, "moved", 28, "r9", "2024-02") for k in range(60)]]
    S.replace(postings(spark, [*{r[0]: r for r in batches[0]}.values()]), lake, "s", "v0")
    first = S.versions(spark, lake, "s")[-1]
    P.publish_facts(S.read(spark, lake, "s"), lake, "run-1", places=None, unique=True)
    for i, batch in enumerate(batches[1:]):
        last = S.upsert(postings(spark, batch), lake, "s", f"v{i + 1}")
    counts = P.publish_changes(spark, lake, "s", first, last.number, "run-1", "run-2", None)
    assert counts["added"] == 60 and 0 < counts["taken"] <= 12
    other = A.Lake(str(tmp_path / "anew"))
    P.publish_facts(S.read(spark, lake, "s"), other, "run-2", places=None, unique=True)
    assert facts(lake, "run-2") == facts(other, "run-2")
    assert A.latest_run(spark, lake, "s").first()["run_id"] == "run-2"
    months = {r["posted_month"] for r in A.read_fact(spark, "role_demand_monthly", lake).where("run_id = 'run-2'").collect()}
    assert months == {"2024-02"}
