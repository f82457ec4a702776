"""Prefix trie of conversations against a dictionary of prefixes."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from vacancy_lake.llm import prefix_trie as T
from vacancy_lake.llm.queries import conversation_trie

SCHEMA = "conv_id long, turn long, role string, text string, shard int, key string, path string, kind int, depth string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "k", "p", 2, "d") for r in rows], SCHEMA)


def rebuilt(rows):
    own = {}
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        own.setdefault(c, []).append((role or "", text or ""))
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    return out


def brute(paths):
    members, ends = {}, {}
    for c, turns in paths.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    children = {}
    for prefix in members:
        if prefix:
            children.setdefault(prefix[:-1], []).append(prefix)

    def below(prefix):
        kids = [below(k) for k in children.get(prefix, [])]
        own = (len(members[prefix]) - 1) * (len(prefix[-1][1]) if prefix else 0)
        return sum(k[0] for k in kids) or 1, own + sum(k[1] for k in kids)
    out = set()
    for prefix, who in members.items():
        leaves, saved = below(prefix)
        out.add((min(who), len(prefix), min(members[prefix[:-1]]) if prefix else None, len(who), len(children.get(prefix, [])),
                 leaves, saved, hashlib.sha256(",".join(map(str, sorted(ends.get(prefix, [])))).encode()).hexdigest()))
    return out


def found(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def some_rows(seed, conversations=300, spread=3, most=9):
    rng, rows = random.Random(seed), []
    for c in rng.sample(range(700), conversations):
        for turn in range(rng.randint(1, most)):
            rows.append((c, turn, rng.choice(["user", "assistant"]) if turn % 3 else "user", "x" * rng.randint(0, spread)))
    rng.shuffle(rows)
    return rows


EDGES = [(0, None, None, None), (0, 1, "user", "ü\U0001F600"), (0, 2, "a", ""), (1, 5, "", None), (None, 0, "user", "lost"),
         (100, 3, "user", "z" * 30_000), (101, 1, "user", "one"), (230, 1, "user", "no base"), (231, None, "x", "y"), (100, None, "", "")]


@pytest.mark.parametrize("per_shard", [15, 200, T.TURNS_PER_SHARD])
def test_trie_equals_prefix_sets(spark, per_shard):
    rows = some_rows(1)
    assert found(conversation_trie(frame(spark, rows), per_shard)) == brute(rebuilt(rows))


@pytest.mark.parametrize("per_shard", [3, T.TURNS_PER_SHARD])
def test_edges(spark, per_shard):
    assert found(conversation_trie(frame(spark, EDGES), per_shard)) == brute(rebuilt(EDGES))
    assert found(conversation_trie(frame(spark, []), per_shard)) == set()
    assert found(conversation_trie(frame(spark, [(None, 1, "user", "x")]), per_shard)) == set()


def test_large_group_of_copies_over_many_shards(spark):
    """Two thirds of all conversations are equal, and one goes on behind them; ends and leaves are still exact."""
    rows = [(c, t, "user", f"turn {t}") for c in range(0, 4000, 10) for t in range(4)] + [(c, 0, "user", f"own {c}") for c in range(1, 2000, 10)]
    rows += [(4001, t, "user", f"turn {t}") for t in range(7)]
    convs = T.conversations(frame(spark, rows))
    paths = {}
    for c, t, role, text in sorted(rows):
        paths.setdefault(c, []).append((role, text))
    assert found(T.trie(convs, 60)) == brute(paths)


def test_repeated_rows_and_ties(spark):
    rows = [(5, 1, "user", "a"), (5, 1, "user", "a"), (5, 1, "user", "b"), (6, 1, "user", "b"), (6, 1, "user", "a"), (6, 1, "user", "a")]
    got = found(T.trie(T.conversations(frame(spark, rows))))
    assert {(r[1], r[3]) for r in got} == {(d, 2) for d in range(4)}  # both conversations have the same order


@given(st.lists(st.integers(0, 3), min_size=1, max_size=300))
@settings(max_examples=60, deadline=None)
def test_findclose(steps):
    bits = []
    depth = 0
    for s in steps:
        close = min(depth, s)
        bits += [0] * close + [1]
        depth += 1 - close
    bits = np.array([1, *bits] + [0] * (depth + 1), np.uint8)
    opens = np.flatnonzero(bits)
    stack, want = [], {}
    for i, b in enumerate(bits):
        if b:
            stack.append(i)
        else:
            want[stack.pop()] = i
    assert T.Parentheses(bits).findclose(opens).tolist() == [want[i] for i in opens]


def test_findclose_deep():
    bits = np.array([1] * 5000 + [0] * 5000, np.uint8)
    assert T.Parentheses(bits).findclose(np.arange(5000)).tolist() == list(range(9999, 4999, -1))


def test_hash_of_ids_streams_over_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = [(c, 0, "user", "same") for c in range(100, 400)]
        got = T.trie(T.conversations(frame(spark, rows)), 20).where(F.col("depth") == 1).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert [r["ends_sha256"] for r in got] == [hashlib.sha256(",".join(map(str, range(100, 400))).encode()).hexdigest()]
