"""Writing, reading and publishing: layouts, empty months, pointers, gates, stream against batch."""

import json

import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from vacancy_lake.operators import audit as AU, facts as E, incremental as B, merge as D
from vacancy_lake.plans import build as P
from vacancy_lake.schema import POSTING
from vacancy_lake.sources import lake as A, snapshot as S, state as ST
from vacancy_lake.streaming import landing_stream as STREAM


def board(slug, title="Python Developer", company="Acme GmbH", created=1704100000, **more):
    return json.dumps({"slug": slug, "url": f"https://x/{slug}", "title": title, "company_name": company, "location": "Berlin",
                       "description": "<p>SQL</p>", "tags": ["K8s"], "remote": True, "created_at": created, **more})


def fetched(spark, *payloads, source="board"):
    return spark.createDataFrame([(source, p) for p in payloads], "source string, raw_payload string")


def land(spark, lake, run, *payloads, day="2024-01-02", **kw):
    return P.land(fetched(spark, *payloads), lake, B.BOARD, "board", run, day, f"{day}T00:00:00Z", **kw)


def test_batch_flow_end_to_end(spark, lake):
    first = land(spark, lake, "20240102T000000Z-a", board("a"), board("b", created=1704200000), board("a", title="Second line"))
    assert first["filter_mode"] == "bootstrap" and first["landed"] == 3
    assert ST.read_state(spark, lake.root, "board")["fetch_watermark"] == 1704200000
    built = P.build_postings(spark, lake, "board")
    assert (built["row_count"], built["landed"], built["dedup_removed"]) == (2, 3, 1)
    # A later run: one row is older than the lookback, one changes its title, one is new.
    second = land(spark, lake, "20240103T000000Z-b", board("old", created=1), board("b", title="Changed", created=1704200001),
                  board("c", created=1704300000), day="2024-01-03")
    assert (second["filter_mode"], second["landed"], second["filtered_out"]) == ("lookback", 2, 1)
    P.build_postings(spark, lake, "board")
    snapshot = {r["source_job_id"]: r for r in S.read(spark, lake, "board").collect()}
    assert {k: r["title_norm"] for k, r in snapshot.items()} == {"a": "python developer", "b": "changed", "c": "python developer"}
    assert snapshot["a"]["skills"] == ["kubernetes", "python", "sql"] and snapshot["a"]["remote_type"] == "remote"
    assert snapshot["b"]["bronze_run_id"] == "20240103T000000Z-b"
    # Facts, pointer and publication check.
    counts = P.publish_facts(S.read(spark, lake, "board"), lake)
    assert counts == {"2024-01": 2}
    tables = {t: A.read_fact(spark, t, lake) for t in ("skill_demand_monthly", "role_demand_monthly", "pipeline_run_summary")}
    row = AU.verify_publication(tables, A.latest_run(spark, lake)).first()
    assert row["published"] and row["run_id"] == "20240103T000000Z-b" and row["role_demand_monthly_rows"] == 2
    # A rebuild from the batches gives the same snapshot.
    P.rebuild(spark, lake, "board", "20240104T0")
    again = {r["source_job_id"]: r["title_norm"] for r in S.read(spark, lake, "board").collect()}
    assert again == {k: r["title_norm"] for k, r in snapshot.items()}
    stages = spark.read.parquet(f"{lake.root}/audit").groupBy("stage").count().collect()
    assert {r["stage"]: r["count"] for r in stages} == {"landing": 2, "silver": 2, "gold": 1}


def test_gate_blocks_every_write(spark, lake):
    land(spark, lake, "20240102T000000Z-a", board("a", company=" "))
    with pytest.raises(D.QualityError):
        P.build_postings(spark, lake, "board")
    assert A.read_history(spark, lake, "board") is None and S.read(spark, lake, "board") is None


def test_empty_fetch_keeps_the_watermark(spark, lake):
    land(spark, lake, "20240102T000000Z-a", board("a"))
    with pytest.raises(ValueError):
        P.land(fetched(spark, board("x")).limit(0), lake, B.BOARD, "board", "r", "2024-01-03", "t")
    assert ST.read_state(spark, lake.root, "board")["fetch_watermark"] == 1704100000


def test_landing_again_replaces_the_run(spark, lake):
    for _ in range(2):
        A.write_landing(B.to_landing(fetched(spark, board("a"), board("b")), B.BOARD, "r1", "2024-01-01", "t"), lake)
    back = A.read_landing(spark, lake, "board")
    assert back.count() == 2
    assert {r["run_id"] for r in back.collect()} == {"r1"}
    assert json.loads(back.orderBy("_line").first()["raw_payload"])["slug"] == "a"


def test_missing_input_and_bad_path_are_errors(spark, lake, tmp_path):
    with pytest.raises(FileNotFoundError):
        A.read_landing(spark, lake, "nobody")
    folder = str(tmp_path / "flat")
    spark.createDataFrame([("x",)], "value string").write.text(folder)
    rows = A.with_path_lineage(spark.read.text(folder).select("value", "_metadata.file_path"), F.col("file_path"))
    with pytest.raises(SparkRuntimeException, match="run_id"):
        rows.collect()
    with pytest.raises(ValueError):
        A.require_rows(spark.range(0))


def _postings(spark, rows, source="s"):
    full = [(str(i), source, None, title, "acme", "goa", "remote", ["x"], None, "t", "id", run, f"{month}-10", None)
            for i, (title, month, run) in enumerate(rows)]
    df = spark.createDataFrame(full, "job_id string, source string, source_job_id string, title_norm string, company_norm string, "
                               "location_raw string, remote_type string, skills array<string>, posted_at timestamp, ingested_at string, "
                               "job_id_strategy string, bronze_run_id string, bronze_ingest_date string, bronze_data_file string")
    assert df.columns == POSTING.fieldNames()
    return df


def test_empty_month_is_published_and_clears_old_rows(spark, lake):
    df = _postings(spark, [("dev", "2024-01", "r1"), ("ops", "2024-02", "r1")])
    P.publish_facts(df, lake, "run")
    P.publish_facts(df.where("bronze_ingest_date < '2024-02'"), lake, "run", ["2024-01", "2024-02", "2024-03"])
    role = A.read_fact(spark, "role_demand_monthly", lake)
    assert [(r["posted_month"], r["role"]) for r in role.collect()] == [("2024-01", "dev")]
    summary = {r["posted_month"]: r for r in A.read_fact(spark, "pipeline_run_summary", lake).collect()}
    assert {m: (r["role_row_count"], r["status"], r["time_axis"]) for m, r in summary.items()} == {
        "2024-01": (1, "PASS", "ingest_fallback"), "2024-02": (0, "PASS", "posted"), "2024-03": (0, "PASS", "posted")}
    assert summary["2024-03"]["bronze_ingest_date"] == "2024-01-10"


def test_month_rebuild_pushes_the_time_range_into_the_scan(spark, lake):
    S.replace(_postings(spark, [("dev", "2024-01", "r1")]), lake, "s", "v1")
    facts = E.build_facts(S.read(spark, lake, "s"), "run", ["2023-12", "2024-01"])
    plan = facts["role_demand_monthly"]._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "PushedFilters" in line and "title_norm" in line)
    assert "GreaterThanOrEqual(posted_at,2023-12-01" in scan and "LessThan(posted_at," in scan
    assert "skills" not in scan.split("ReadSchema")[1] and facts["role_demand_monthly"].count() == 1


def test_months_rebuilt_one_by_one_equal_a_full_build(spark):
    df = _postings(spark, [(t, m, "r1") for t in ("dev", "ops") for m in ("2024-01", "2024-02", "2024-03")] * 3)
    whole = E.build_facts(df, "run")
    for name in ("role_demand_monthly", "skill_demand_monthly", "pipeline_run_summary"):
        parts = [E.build_facts(df, "run", [m])[name] for m in ("2024-01", "2024-02", "2024-03")]
        union = parts[0].unionByName(parts[1]).unionByName(parts[2])
        assert sorted(map(tuple, whole[name].collect())) == sorted(map(tuple, union.collect()))


def test_bad_months_are_refused():
    for bad in ("2024-1", "24-01", "2024/01"):
        with pytest.raises(ValueError):
            E.check_months([bad])


def test_month_predicate_prunes_folders(spark, lake):
    A.write_fact(E.role_demand(_postings(spark, [("dev", f"2024-0{m}", "r1") for m in range(1, 7)]), "run"), "role_demand_monthly", lake)
    df = A.read_fact(spark, "role_demand_monthly", lake).where("posted_month BETWEEN '2024-02' AND '2024-03'")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(posted_month" in plan
    assert len(df.inputFiles()) <= 6 and df.count() == 2


def test_one_source_does_not_move_the_pointer_of_another(spark, lake):
    for source, run in (("a", "r1"), ("b", "r2"), ("a", "r3")):
        A.publish_latest(spark.createDataFrame([(source, run)], "source string, run_id string"), lake)
    assert {(r["source"], r["run_id"]) for r in A.latest_run(spark, lake).collect()} == {("a", "r3"), ("b", "r2")}
    assert A.latest_run(spark, lake, "b").count() == 1


def test_slice_is_isolated(spark, lake):
    side = A.Lake(lake.root, "backfill")
    df = _postings(spark, [("dev", "2024-01", "r1")])
    A.write_batch(df, lake)
    A.write_batch(df.withColumn("job_id", F.lit("sliced")).withColumn("bronze_run_id", F.lit("r2")), side)
    assert {r["job_id"] for r in A.read_history(spark, lake, "s").collect()} == {"0"}
    assert {r["job_id"] for r in A.read_history(spark, side, "s").collect()} == {"0", "sliced"}
    P.publish_facts(df, side, "run")
    with pytest.raises(Exception):
        A.read_fact(spark, "role_demand_monthly", lake).count()
    assert A.read_fact(spark, "role_demand_monthly", side).count() == 1


def test_registered_tables_answer_sql(spark, lake):
    P.publish_facts(_postings(spark, [("dev", "2024-01", "r1"), ("dev", "2024-01", "r1")]), lake, "run")
    A.register_tables(spark, lake, "market_test")
    row = spark.sql("SELECT sum(job_count) AS n FROM market_test.role_demand_monthly JOIN market_test.latest_run_metadata USING (source, run_id)").first()
    assert row["n"] == 2


# --- stream ------------------------------------------------------------------------------------------------

def _drop(spark, lake, name, *payloads):
    fetched(spark, *payloads).coalesce(1).write.json(f"{lake.root}/incoming/{name}")


def _run(spark, lake, checkpoint="c1", **kw):
    STREAM.start_landing_stream(spark, f"{lake.root}/incoming/*", lake, f"{lake.root}/{checkpoint}", "board", B.BOARD, 1,
                                files_per_trigger=1, **kw).awaitTermination()
    return {r["source_job_id"]: r["title_norm"] for r in STREAM.current_postings(spark, lake, "board").collect()}


def test_stream_equals_batch_and_replay_adds_nothing(spark, lake, tmp_path):
    files = [[board("a", created=10_000), board("b", created=10_500), board("a", title="Twice", created=10_000)],
             [board("a", title="Newer", created=10_600), board("late", created=6_900), board("edge", created=6_901)]]
    _drop(spark, lake, "f0", *files[0])
    assert _run(spark, lake) == {"a": "python developer", "b": "python developer"}
    _drop(spark, lake, "f1", *files[1])
    expected = {"a": "newer", "b": "python developer", "edge": "python developer"}  # 10500 - 3600 = 6900 is excluded
    assert _run(spark, lake) == expected
    assert ST.read_state(spark, lake.root, "board")["fetch_watermark"] == 10_600
    before = A.read_history(spark, lake, "board").count()
    assert _run(spark, lake) == expected and A.read_history(spark, lake, "board").count() == before  # nothing new
    assert A.read_landing(spark, lake).count() == 5  # what passed the lookback, as it came
    # All files once more under another checkpoint: folders of its own, the watermark is carried over.
    assert _run(spark, lake, "c2") == expected
    assert ST.read_state(spark, lake.root, "board", before_batch=0, query="new")["fetch_watermark"] == 10_600
    # The batch form over the same files.
    other = A.Lake(str(tmp_path / "batch"))
    for i, payloads in enumerate(files):
        land(spark, other, f"2024010{i + 1}T0", *payloads, lookback_hours=1, day=f"2024-01-0{i + 1}")
        P.build_postings(spark, other, "board")
    assert {r["source_job_id"]: r["title_norm"] for r in S.read(spark, other, "board").collect()} == expected


def test_stream_first_version_wins_on_request(spark, lake):
    _drop(spark, lake, "f0", board("a", created=10_000))
    _drop(spark, lake, "f1", board("a", title="Newer", created=10_600), board("b", created=10_700))
    assert _run(spark, lake, first_wins=True) == {"a": "python developer", "b": "python developer"}


def test_stream_takes_the_first_row_of_a_batch(spark, lake):
    """Of one key in two files of a batch the row of the earlier file counts, however large the later one is."""
    _drop(spark, lake, "f0", board("a", title="Early", created=10_000))
    _drop(spark, lake, "f1", board("a", title="Late", created=10_000), *[board(f"x{i}", created=10_000) for i in range(50)])
    STREAM.start_landing_stream(spark, f"{lake.root}/incoming/*", lake, f"{lake.root}/c", "board", B.BOARD, 1).awaitTermination()
    got = {r["source_job_id"]: r["title_norm"] for r in STREAM.current_postings(spark, lake, "board").collect()}
    assert got["a"] == "early" and len(got) == 51


def test_new_checkpoint_keeps_what_the_old_one_landed(spark, lake):
    _drop(spark, lake, "f0", board("a", created=10_000))
    assert _run(spark, lake, "c1") == {"a": "python developer"}
    fetched(spark, board("b", created=10_100)).coalesce(1).write.json(f"{lake.root}/more/f0")
    STREAM.start_landing_stream(spark, f"{lake.root}/more/*", lake, f"{lake.root}/c2", "board", B.BOARD, 1).awaitTermination()
    assert {r["source_job_id"] for r in STREAM.current_postings(spark, lake, "board").collect()} == {"a", "b"}


@pytest.mark.parametrize("bad", [json.dumps({"source": "other", "raw_payload": "{}"}), "no json at all"])
def test_stream_refuses_or_counts_foreign_rows(spark, lake, bad):
    lines = [json.dumps({"source": "board", "raw_payload": board("a", created=10_000)}), bad]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{lake.root}/incoming/f0")
    with pytest.raises(Exception, match="not of source board"):
        _run(spark, lake, "c1")
    assert A.read_history(spark, lake, "board") is None
    assert _run(spark, lake, "c2", foreign="count") == {"a": "python developer"}
    row = spark.read.parquet(f"{lake.root}/audit").where("stage = 'stream'").first()
    assert json.loads(row["details"])["foreign_rows"] == 1


def test_stream_gate_keeps_the_raw_rows(spark, lake):
    _drop(spark, lake, "f0", board("a", title=" ", company="", created=10_000))
    with pytest.raises(Exception, match="missing_title"):
        _run(spark, lake)
    assert A.read_history(spark, lake, "board") is None and A.read_landing(spark, lake).count() == 1


def test_stream_run_ids_sort_with_batch_run_ids(spark, lake):
    _drop(spark, lake, "f0", board("a", created=10_000))
    _run(spark, lake)
    run = A.read_history(spark, lake, "board").first()["bronze_run_id"]
    assert "20200101T0" < run < "20990101T0" and run.endswith("-000000")


def test_legacy_layout_of_another_type_is_an_error(spark, lake):
    df = _postings(spark, [("dev", "2024-01", "r1")]).withColumns({
        "ingest_date": F.col("bronze_ingest_date"), "run_id": F.col("bronze_run_id"), "skills": F.create_map(F.lit("a"), F.lit("b"))})
    df.write.partitionBy("ingest_date", "run_id").parquet(lake.legacy_jobs)
    with pytest.raises(Exception):
        A.read_history(spark, lake, "s", legacy_source=True).collect()
    assert A.read_history(spark, lake, "s") is None


def test_path_is_checked_even_when_the_row_knows_its_run(spark):
    df = spark.createDataFrame([("r", "2024-01-01", "/x/run_id=a/ingest_date=2024-01-02/f"), ], "run_id string, bronze_ingest_date string, f string")
    assert A.with_path_lineage(df, F.col("f")).select("run_id", "bronze_ingest_date").first() == ("r", "2024-01-01")
    with pytest.raises(SparkRuntimeException, match="run_id"):
        A.with_path_lineage(df.withColumn("f", F.lit("/x/f")), F.col("f")).collect()


def test_no_pass_row_before_the_facts(spark, lake, monkeypatch):
    write, calls = A.write_fact, []

    def breaks(df, table, *more):
        calls.append(table)
        if len(calls) == 2:
            raise OSError("disk")
        write(df, table, *more)

    monkeypatch.setattr(A, "write_fact", breaks)
    with pytest.raises(OSError):
        P.publish_facts(_postings(spark, [("dev", "2024-01", "r1")]), lake, "run")
    assert "pipeline_run_summary" not in calls
    with pytest.raises(Exception):
        A.latest_run(spark, lake).count()


def test_publication_of_another_source_is_refused(spark, lake):
    with pytest.raises(ValueError, match="expected source t"):
        P.publish_facts(_postings(spark, [("dev", "2024-01", "r1")]), lake, "run", source="t")
    with pytest.raises(SparkRuntimeException, match="expected source t"):
        E.resolve_run(_postings(spark, [("dev", "2024-01", "r1")]), "t").collect()


def test_publication_reads_the_snapshot_five_times(spark, lake):
    """Every scan of the run's folder in the plans of the session from here on, told apart by the folder's own name."""
    state = S.replace(_postings(spark, [("dev", "2024-01", "r1"), ("ops", "2024-02", "r1")]), lake, "s", "v1")
    df, store = S.read(spark, lake, "s"), spark._jsparkSession.sharedState().statusStore()
    known = {e.executionId() for e in _executions(store)}
    P.publish_facts(df, lake, "run", ["2024-01", "2024-02"])
    plans = [e.physicalPlanDescription() for e in _executions(store) if e.executionId() not in known]
    scans = sum(p.split("(1)")[0].count("Scan parquet") for p in plans if state.runs[0].name in p)
    assert 0 < scans <= 5


def _executions(store):
    """What the store keeps, newest included; older ones may have been dropped from it."""
    found = store.executionsList()
    return [found.apply(i) for i in range(found.size())]


def test_heal_takes_the_broader_base(spark, lake):
    """A snapshot from elsewhere lost a posting; the union of batches brings it back."""
    land(spark, lake, "20240102T0-a", board("a"), board("b"))
    P.build_postings(spark, lake, "board")
    S.replace(S.read(spark, lake, "board").where("source_job_id = 'a'"), lake, "board", "20240102T1-cut")
    land(spark, lake, "20240103T0-b", board("c"), day="2024-01-03")
    P.build_postings(spark, lake, "board", heal=True)
    assert {r["source_job_id"] for r in S.read(spark, lake, "board").collect()} == {"a", "b", "c"}


def test_steps_by_the_file_index(spark, lake):
    """The newest batch is the one added last; a batch landed without the index is not seen by it."""
    land(spark, lake, "20240102T000000Z-a", board("a"), index=True)
    land(spark, lake, "20240103T000000Z-b", board("b", created=1704200000), day="2024-01-03", index=True)
    land(spark, lake, "20240104T000000Z-c", board("c", created=1704300000), day="2024-01-04")
    P.build_postings(spark, lake, "board", index=True)
    assert {r["bronze_run_id"] for r in S.read(spark, lake, "board").collect()} == {"20240103T000000Z-b"}
