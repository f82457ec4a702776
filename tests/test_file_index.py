"""File index: reads name their files, replaced and vanished runs, two writers, few parts."""

import gzip
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from vacancy_lake.schema import LANDING, POSTING
from vacancy_lake.sources import file_index as I, files, lake as A


def put(lake, source, day, run, rows):
    folder = Path(lake.landing) / f"source={source}" / (f"slice={lake.slice}" if lake.slice else "") / f"ingest_date={day}" / f"run_id={run}"
    folder.mkdir(parents=True, exist_ok=True)
    with gzip.open(folder / "part-0.json.gz", "wt") as f:
        for job, at in rows:
            f.write(json.dumps({"source": source, "job_id": job, "ingested_at": at, "raw_payload": "{}"}) + "\n")
    return source, day, run


def jobs(df):
    return sorted(r["job_id"] for r in df.select("job_id").collect())


@pytest.fixture
def lake(tmp_path):
    return A.Lake(str(tmp_path / "a lake+"))


def test_many_folders(spark, lake):
    days = [f"20{y:02}-{m:02}-{d:02}" for y in range(10, 14) for m in range(1, 13) for d in range(1, 11)]
    runs = [put(lake, "s", day, f"r{day}", [(f"j{day}", f"{day}T05:00:00Z"), (f"k{day}", f"{day}T07:00:00Z")]) for day in days]
    I.add(spark, lake, I.LANDED, runs[:-1])
    I.add(spark, lake, I.LANDED, runs[-1:])
    put(lake, "s", "2030-01-01", "unknown", [("hidden", "2011-05-03T06:00:00Z")])  # not added: nobody lists folders
    found = I.entries(spark, lake, I.LANDED)
    assert found.count() == 480 and found.agg(F.sum("rows")).first()[0] == 960
    assert jobs(I.read_landing(spark, lake, "s")) == [f"j{days[-1]}", f"k{days[-1]}"]
    part = I.read_landing(spark, lake, "s", "2011-05-03T06:00:00Z", "2011-05-05T06:00:00Z")
    assert jobs(part) == ["j2011-05-04", "j2011-05-05", "k2011-05-03", "k2011-05-04"] and len(part.inputFiles()) == 3
    row = part.where("job_id = 'j2011-05-04'").first()
    assert (row["run_id"], row["bronze_ingest_date"]) == ("r2011-05-04", "2011-05-04") and "_line" in part.columns
    assert len(jobs(I.read_landing(spark, lake))) == 960
    assert I.read_landing(spark, lake, "s", "2031-01-01").columns == part.columns
    assert I.read_landing(spark, lake, "s", "2031-01-01").isEmpty()


def test_replaced_and_gone(spark, lake):
    a = put(lake, "s", "2020-01-01", "r1", [("a", "2020-01-01T00:00:00Z"), ("z", None), ("y", "never")])
    b = put(lake, "s", "2020-01-02", "r2", [("b", "2020-01-02T00:00:00Z")])
    I.add(spark, lake, I.LANDED, [a])
    I.add(spark, lake, I.LANDED, [b])
    put(lake, "s", "2020-01-01", "r1", [("c", "2020-01-05T00:00:00Z")])
    assert I.add(spark, lake, I.LANDED, [a]) == 3
    assert jobs(I.read_landing(spark, lake)) == ["b", "c"]
    assert jobs(I.read_landing(spark, lake, "s")) == ["c"]  # added last
    assert jobs(I.read_landing(spark, lake, since="2020-01-03")) == ["c"]
    (Path(lake.landing) / "source=s/ingest_date=2020-01-02/run_id=r2/part-0.json.gz").unlink()
    for crc in (Path(lake.landing) / "source=s/ingest_date=2020-01-02/run_id=r2").iterdir():
        crc.unlink()
    I.add(spark, lake, I.LANDED, [b])
    assert jobs(I.read_landing(spark, lake)) == ["c"]
    assert I.add(spark, lake, I.LANDED, []) == 4
    with pytest.raises(ValueError):
        I.add(spark, lake, I.LANDED, [("s/..", "2020-01-01", "r")])
    with pytest.raises(FileNotFoundError):
        I.read_landing(spark, lake, "other")


def test_slices(spark, lake):
    part = A.Lake(lake.root, "back")
    I.add(spark, lake, I.LANDED, [put(lake, "s", "2020-01-01", "r1", [("a", "2020-01-01T00:00:00Z")])])
    I.add(spark, part, I.LANDED, [put(part, "s", "2020-01-01", "r1", [("b", "2020-01-01T00:00:00Z")])])
    assert jobs(I.read_landing(spark, lake)) == ["a"] and jobs(I.read_landing(spark, part)) == ["b"]
    assert jobs(I.read_landing(spark, part, "s")) == ["b"]
    none = A.Lake(lake.root + "2")
    assert I.entries(spark, none, I.LANDED).isEmpty() and I.read_landing(spark, none).isEmpty()


def test_two_writers_and_few_parts(spark, lake, monkeypatch):
    """A writer that finds its number taken goes on top; parts stay few, whatever is added again or gone."""
    monkeypatch.setattr(I, "FAN_IN", 3)
    runs = [put(lake, "s", "2020-01-01", f"r{i}", [(f"j{i}", "2020-01-01T00:00:00Z")]) for i in range(8)]
    create, raced = files.create, []

    def slow(session, path, text):
        if not raced:
            raced.append(path)
            I.add(session, lake, I.LANDED, runs[7:])  # the other one, in between
        return create(session, path, text)

    monkeypatch.setattr(files, "create", slow)
    assert I.add(spark, lake, I.LANDED, runs[:1]) == 2
    for run in (*runs[1:7], runs[2], runs[7]):
        I.add(spark, lake, I.LANDED, [run])
    assert jobs(I.read_landing(spark, lake)) == [f"j{i}" for i in range(8)]
    assert jobs(I.read_landing(spark, lake, "s")) == ["j7"]
    assert len(I._newest(spark, lake, I.LANDED)["parts"]) <= 4


def test_history(spark, lake):
    rows = spark.createDataFrame([(f"j{i}", "s", f"2020-01-0{i}T00:00:00Z", f"2020010{i}T0", f"2020-01-0{i}") for i in range(1, 5)],
                                 "job_id string, source string, ingested_at string, bronze_run_id string, bronze_ingest_date string")
    A.write_batch(rows.select(*[(F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType)).alias(f.name)
                                for f in POSTING.fields]), lake)
    I.add(spark, lake, I.BATCHES, [("s", f"2020-01-0{i}", f"2020010{i}T0") for i in range(1, 5)])
    whole = I.read_history(spark, lake, "s")
    assert sorted(whole.drop("bronze_data_file").collect()) == sorted(A.read_history(spark, lake, "s").drop("bronze_data_file").collect())
    some = I.read_history(spark, lake, "s", "2020-01-02", "2020-01-04")
    assert jobs(some) == ["j2", "j3"] and len(some.inputFiles()) == 2
    assert I.read_history(spark, lake, "t").isEmpty() and set(LANDING.names) >= {"ingested_at"}
