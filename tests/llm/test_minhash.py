"""Near-duplicates against all pairs, on given tables and on edge rows."""

import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from vacancy_lake.llm import minhash
from vacancy_lake.llm.common import documents
from vacancy_lake.llm.components import components
from tests.llm.conftest import words


def sets_of(rows, width):
    out = []
    for d, t, *_ in rows:
        w = (t or "").encode().lower().split()
        k = min(width, len(w))
        out.append((d, frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if w else frozenset()))
    return out


def brute(rows, width, percent=80):
    """Component id per row: all pairs of distinct sets that share a shingle."""
    sets = sets_of(rows, width)
    distinct = list({s for _, s in sets if s})
    number = {s: i for i, s in enumerate(distinct)}
    parent = list(range(len(distinct)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i, s in enumerate(distinct):
        near = {j for g in s for j in holders[g]}
        for j in near:
            n = len(s & distinct[j])
            if 100 * n >= percent * (len(s) + len(distinct[j]) - n):
                parent[root(i)] = root(j)
        for g in s:
            holders[g].append(i)
    least = {}
    for d, s in sets:
        if s and d is not None:
            r = root(number[s])
            least[r] = min(least.get(r, d), d)
    return [(d, len(s), least.get(root(number[s])) if s else d) for d, s in sets]


def found(df, width):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in minhash.near_groups(df, width).collect()), key=repr)


@pytest.mark.parametrize("width", [2, 5])
def test_given_table(spark, width):
    docs = documents(spark, "/root/testdata/sf0.001")
    rows = docs.select("doc_id", "text").collect()
    assert found(docs, width) == sorted(brute(rows, width), key=repr)


@pytest.mark.parametrize("width", [1, 2, 5])
def test_edges(frame, edge_rows, width):
    assert found(frame(edge_rows), width) == sorted(brute(edge_rows, width), key=repr)


def test_chains_and_threshold(frame):
    """Chains whose ends are not similar, and pairs at and just below the threshold."""
    rng = random.Random(4)
    rows, text = [], words(60, 9).split()
    for i in range(40):
        text[rng.randrange(60)] = f"new{i}"
        rows.append((i, " ".join(text), "s"))
    a = [f"w{i}" for i in range(90)]
    for k in range(12):
        rows.append((100 + k, " ".join(a[:90 - k] + [f"v{k}{j}" for j in range(k)]), "s"))
    assert found(frame(rows), 2) == sorted(brute(rows, 2), key=repr)


def test_large_group_of_near_copies(frame):
    rng = random.Random(5)
    base = words(150, 7).split()
    rows = []
    for i in range(300):
        text = list(base)
        for _ in range(rng.randint(0, 9)):
            text[rng.randrange(150)] = f"z{rng.random()}"
        rows.append((i, " ".join(text), "s"))
    assert found(frame(rows), 2) == sorted(brute(rows, 2), key=repr)


def test_close_pairs_in_hot_buckets(frame, monkeypatch):
    """Texts of the same few words, about 0.66 similar, so all buckets are hot; only few pairs are above the threshold; few centres."""
    monkeypatch.setattr(minhash, "CENTRES", 1)
    rng = random.Random(6)
    pool, rows = [f"w{i}" for i in range(126)], []
    for i in range(500):
        mine = rng.sample(pool, 100)
        rows.append((i, " ".join(mine), "s"))
        if i < 20:
            others = [w for w in pool if w not in mine]
            rows.append((1000 + i, " ".join(mine[:90] + rng.sample(others, 10)), "s"))
    want = sorted(brute(rows, 1), key=repr)
    assert 20 <= sum(d != c for d, _, c in want) < 100
    assert found(frame(rows), 1) == want


def test_keep_one(frame, edge_rows):
    df = frame(edge_rows)
    out = minhash.keep_one(df, 5)
    assert out.columns == df.columns
    ids = [r["doc_id"] for r in out.collect()]
    groups = brute(edge_rows, 5)
    assert sorted(i for i in ids if i is not None) == sorted({c for d, n, c in groups if n and d is not None}
                                                             | {d for d, n, _ in groups if not n and d is not None})
    assert minhash.keep_one(frame([]).limit(0)).count() == 0 and minhash.near_groups(frame([]).limit(0)).count() == 0


def test_signature_is_the_sample_of_its_donor():
    rng = np.random.default_rng(1)
    for n in (1, 2, 5, 60, 5000):
        h = np.unique(rng.integers(0, 2 ** 64, n, dtype=np.uint64))
        sig = minhash.signature(h)
        bins = (h >> np.uint64(57)).astype(int)
        for b in set(bins):
            assert sig[b] == h[bins == b].min()
        assert set(sig) <= {h[bins == b].min() for b in set(bins)}


def test_signature_estimates_similarity():
    rng = np.random.default_rng(2)
    for n in (10, 100, 1000):
        agree = []
        for _ in range(60):
            h = rng.integers(0, 2 ** 64, n + n // 4, dtype=np.uint64)
            a, b = h[:n], h[n // 4:]
            agree.append((minhash.signature(np.sort(a)) == minhash.signature(np.sort(b))).mean() - (n - n // 4) / len(h))
        assert abs(np.mean(agree)) < 0.05


def test_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (102, 101), (7, 7), (200, 201)]
    out = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(out[i] == 0 for i in range(61)) and out[102] == 100 and out[201] == 200


@given(st.lists(st.tuples(st.integers(0, 6), st.integers(0, 9)), max_size=40, unique=True), st.lists(st.integers(1, 7), min_size=1, max_size=12))
@settings(max_examples=300, deadline=None)
def test_shared_buckets_over_batches(rows, cuts):
    rows, batches, at = sorted(rows), [], 0
    while at < len(rows):
        size = cuts[len(batches) % len(cuts)]
        part = rows[at:at + size]
        batches.append(pa.RecordBatch.from_arrays([pa.array([b for b, _ in part]), pa.array([n for _, n in part])], ["bucket", "node"]))
        at += size
    got = sorted(tuple(r.values()) for batch in minhash._shared_buckets(iter(batches)) for r in batch.to_pylist())
    first = {}
    for b, n in rows:
        first.setdefault(b, n)
    several = {b for b, n in rows if n != first[b]}
    assert got == [(b, n, first[b]) for b, n in rows if b in several]


def test_a_hot_family_makes_few_pairs(spark, frame, monkeypatch):
    """Texts that share a passage without being similar: compared pairs stay in proportion to the rows."""
    def compared(rows):
        seen = []
        monkeypatch.setattr(minhash, "confirmed", lambda pairs, sets, percent: (seen.append(pairs.count()), real(pairs, sets, percent))[1])
        minhash.near_groups(frame(rows), 2).count()
        return sum(seen)

    real = minhash.confirmed
    family = words(120, 5)
    hot = [(i, family + " " + words(60, 1000 + i), "a") for i in range(600)]
    apart = [(i, words(180, 5000 + i), "a") for i in range(600)]
    few = [(600 + i, words(200, 20 + i // 2), "a") for i in range(100)]
    assert compared(hot + few) <= 3 * max(50, compared(apart + few)) + 3 * len(hot)


def test_full_sets_of_unlike_texts_do_not_travel(frame, monkeypatch):
    """Families of texts about 0.72 similar: nearly all of their pairs go by parities, and the similar ones are all found."""
    asked, sent = [], []

    def counting(pairs, sets, percent):
        asked.append(pairs.count())
        return real(pairs, sets, percent)

    def watching(df, name):
        if name == "used":
            sent.append(df.count())
        return write(df, name)

    real, write = minhash.confirmed, minhash.staged
    monkeypatch.setattr(minhash, "confirmed", counting)
    monkeypatch.setattr(minhash, "staged", watching)
    rng, rows = random.Random(8), []
    for family in range(40):
        base = words(200, 100 + family).split()
        for i in range(6):
            text = list(base)
            for at in rng.sample(range(200), 8):
                text[at] = f"x{family}{i}{at}"
            rows.append((10 * family + i, " ".join(text), "s"))
        if family < 5:
            text[0] = "changed"
            rows.append((10 * family + 9, " ".join(text), "s"))
    want = sorted(brute(rows, 2), key=repr)
    assert sum(d != c for d, _, c in want) >= 5
    assert found(frame(rows), 2) == want
    assert sum(asked) > 100 and sum(sent) < 60, (asked, sent)


@given(st.integers(1, 400), st.integers(0, 400), st.integers(0, 400), st.integers(0, 99))
@settings(max_examples=300, deadline=None)
def test_parities_differ_in_no_more_bits_than_sets(shared, left, right, seed):
    h = np.unique(np.random.default_rng(seed).integers(0, 2 ** 64, shared + left + right, dtype=np.uint64))
    np.random.default_rng(seed).shuffle(h)
    a, b = minhash.parities(h[:shared + left]), minhash.parities(np.concatenate([h[:shared], h[shared + left:]]))
    k = min(len(a), len(b))
    a, b = (np.bitwise_xor.reduce(x.reshape(-1, k), 0) for x in (a, b))
    assert np.bitwise_count((a ^ b).view(np.uint64)).sum() <= len(h) - shared


def test_possible_keeps_every_similar_pair(spark):
    """Sets of any sizes, so parities of different lengths are folded; at percentages down to 10."""
    rng, sets, rows = np.random.default_rng(9), [], []
    for i in range(60):
        h = rng.integers(0, 2 ** 64, int(rng.integers(1, 300)), dtype=np.uint64)
        mine = np.concatenate([h, sets[i // 2][:int(rng.integers(0, 300))]]) if i else h
        sets.append(np.unique(mine))
        rows.append((i, len(sets[i]), minhash.parities(sets[i]).tolist()))
    frame = spark.createDataFrame(rows, "node long, n long, parity array<long>")
    pairs = [(i, j) for i in range(60) for j in range(i)]
    for percent in (10, 50, 80):
        similar = {(i, j) for i, j in pairs
                   if 100 * len(np.intersect1d(sets[i], sets[j])) >= percent * len(np.union1d(sets[i], sets[j]))}
        got = {tuple(r) for r in minhash.possible(spark.createDataFrame(pairs, "a long, b long"), frame, percent).collect()}
        assert similar and similar <= got


def test_prefixes_are_a_part_of_the_sets(spark):
    """What is joined and dealt out for the exact step is the prefix of each set, not the set."""
    sets = [sorted(random.Random(i).sample(range(10 ** 6), 10 * i)) for i in range(1, 30)]
    df = spark.createDataFrame(list(enumerate(sets)), "node long, shingles array<long>")
    for r in minhash.prefixes(df, 80).collect():
        n = len(sets[r["node"]])
        assert r["n"] == n and len(r["firsts"]) == n - -(-80 * n // 100) + 1 and set(r["firsts"]) <= set(sets[r["node"]])
        assert r["most"] == n - -(-160 * n // 180)
