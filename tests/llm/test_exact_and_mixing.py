"""Exact deduplication and mixing against SQL, brute force and edge rows."""

import hashlib
from collections import Counter, defaultdict
from math import log

import pytest
from hypothesis import given, settings, strategies as st

import suite.compare as compare
from vacancy_lake.llm import exact_dedup, mixing, queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_matches_sql(spark, monkeypatch, name):
    monkeypatch.setattr(compare, "QUERIES", queries.QUERIES)
    monkeypatch.setattr(compare, "ORACLES", queries.ORACLES)
    assert compare.difference(spark, compare.oracle(SF), name, SF) is None


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 12), max_size=40), max_size=6), st.integers(1, 5))
def test_misra_gries_keeps_every_frequent_value(parts, k):
    total, merged = Counter(), Counter()
    for part in parts:
        sketch = exact_dedup.MisraGries(k)
        for v in part:
            sketch.add({v: 1})
        total.update(part)
        merged.update(sketch.counts)
        assert len(sketch.counts) <= k
    kept = [v for v, _ in sorted(merged.items(), key=lambda x: (-x[1], x[0]))]
    for v, n in total.items():
        if n > total.total() / (k + 1):
            assert v in kept


def brute_groups(rows):
    groups = defaultdict(list)
    for d, t, _ in rows:
        groups[t or ""].append(d)
    return groups


@pytest.mark.parametrize("counters", [1, 3, 1024])
def test_exact_groups_on_edges(frame, edge_rows, counters):
    out = exact_dedup.exact_groups(frame(edge_rows), counters=counters).collect()
    groups = brute_groups(edge_rows)
    digest = {hashlib.sha256(t.encode()).digest(): t for t in groups}
    assert len(out) == len(edge_rows)
    for r in out:
        ids = groups[digest[bytes(r["digest"])]]
        known = [i for i in ids if i is not None]
        assert r["group_size"] == len(ids) and r["keep_id"] == (max(known) if known else None)
    assert Counter(bytes(r["digest"]) for r in out if r["kept"]) == Counter(digest.keys())


def test_keep_one(frame, edge_rows):
    df = frame(edge_rows)
    out = exact_dedup.keep_one(df)
    assert out.columns == df.columns
    kept = Counter((r["doc_id"], r["text"] or "") for r in out.collect())
    groups = brute_groups(edge_rows)
    assert kept == Counter((max([i for i in ids if i is not None], default=None), t) for t, ids in groups.items())


def test_empty_tables(frame):
    empty = frame([]).limit(0)
    assert exact_dedup.exact_groups(empty).count() == 0 and exact_dedup.keep_one(empty).count() == 0
    assert mixing.mix(empty).count() == 0


def fill(sizes, weights, share):
    """Reshare the excess until no source is above twice its size."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, rest = {}, dict(w)
    total = share * sum(sizes.values())
    while rest:
        left = total - sum(full.values())
        level = {s: left * w[s] / sum(rest.values()) for s in rest}
        over = [s for s in rest if level[s] > 2 * sizes[s]]
        if not over:
            return full | level
        for s in over:
            full[s] = 2 * sizes[s]
            del rest[s]
    return full


@pytest.mark.parametrize("buckets", [1, 7, 4096])
def test_mix_on_edges(frame, edge_rows, buckets):
    df = frame(edge_rows)
    rows = mixing.mix(df, buckets=buckets).select("doc.*", "size", "source_size", "target", "copies", "taken").toDF(
        *df.columns, "n", "total", "target", "copies", "taken").collect()
    again = mixing.mix(df, buckets=4096).select("doc.doc_id", "taken").collect()
    assert Counter((r["doc_id"], r["taken"]) for r in rows) == Counter(map(tuple, again))
    sizes, longest, taken = Counter(), Counter(), Counter()
    for d, t, s in edge_rows:
        n = len((t or "").encode().split())
        sizes[s] += n
        longest[s] = max(longest[s], n)
    want = fill(dict(sizes), (5, 2, 1), 1.5)
    for r in rows:
        taken[r["source"]] += r["taken"]
        assert r["total"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= 2 * r["n"] and r["taken"] == r["n"] * r["copies"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= longest[s] / 2 + 1e-6
    assert sum(want.values()) == pytest.approx(1.5 * sum(sizes.values()))


def test_mix_follows_quality(spark, frame):
    """Smaller keys, so better texts, are taken first within a source."""
    good, bad = "normal words here now " * 5, "x y z q " * 5
    rows = [(i, good if i % 2 else bad, "big" if i < 400 else "other") for i in range(800)]
    taken = Counter()
    for r in mixing.mix(frame(rows), weights=(1, 9), share=1.0).select("doc.doc_id", "copies").collect():
        if r["doc_id"] < 400:
            taken[r["doc_id"] % 2] += r["copies"]
    assert taken[1] > taken[0]


def test_taken_rows(frame, edge_rows):
    df = frame(edge_rows)
    mixed = mixing.mix(df)
    out = mixing.taken_rows(mixed)
    assert out.columns == df.columns and out.count() == sum(r["copies"] for r in mixed.select("copies").collect())


def test_exponential_key(rows):
    from pyspark.sql import functions as F
    bits = int(hashlib.md5(b"5").hexdigest()[:13], 16)
    key = rows([(5,)], "v long", lambda: mixing.exponential_key(F.col("v"), F.lit(0.5)))[0]
    assert key == pytest.approx(-log((bits + 0.5) / 2 ** 52) / 0.5)
