"""Input that the registered stream queries write for themselves."""

from pathlib import Path

import pytest

from suite import fixtures as fx, tables
from suite.compare import difference, oracle

SF = "/root/testdata/sf0.001"


def test_every_year_has_the_same_number_of_files(spark, lake, monkeypatch):
    monkeypatch.setattr(tables, "FILE_ROWS", 10)
    src, parts = tables._incoming(spark, SF, lake, "src_a", copies=7)
    files = {y: list(Path(f"{lake.root}/incoming/src_a/y={y}").glob("*.json")) for y in range(1995, 2002)}
    assert parts > 1 and {len(f) for f in files.values()} == {parts}
    last = [max(p.stat().st_mtime_ns for p in files[y]) for y in sorted(files)]
    first = [min(p.stat().st_mtime_ns for p in files[y]) for y in sorted(files)]
    assert all(a < b for a, b in zip(last, first[1:]))  # the stream takes files by time
    rows = fx.payloads(spark, SF).where("source = 'src_a'")
    assert spark.read.json(src).count() == rows.count() + rows.where("o_orderkey % 7 = 0").count()


@pytest.mark.parametrize("name", ["b06_landing_stream", "b06_restart"])
def test_many_files_a_year_make_the_same_batches(spark, monkeypatch, name):
    monkeypatch.setattr(tables, "FILE_ROWS", 40)
    assert difference(spark, oracle(SF), name, SF) is None
