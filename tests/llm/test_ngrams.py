"""N-gram scores: the Elias-Fano trie, exact counts, a true distribution, better than single words."""

import zlib
from collections import Counter
from math import log10

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from vacancy_lake.llm import ngrams, queries
from vacancy_lake.llm.common import documents


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2 ** 64 - 1)), min_size=1, max_size=200))
def test_elias_fano(values):
    values = np.sort(np.array(values, np.uint64))
    ef = ngrams.EliasFano.build(values)
    assert (ef.get(np.arange(len(values))) == values).all()
    asked = np.unique(np.concatenate([values, values[:3] // np.uint64(2)]))
    assert (ef.find(asked) == np.searchsorted(values, asked)).all()


def test_elias_fano_is_compact():
    values = np.sort(np.random.default_rng(1).integers(0, 2 ** 40, 50_000).astype(np.uint64))
    assert sum(a.nbytes for a in ngrams.EliasFano.build(values).arrays()) < 0.6 * values.nbytes


def test_trie_lookup():
    rng = np.random.default_rng(2)
    contexts = np.unique(rng.integers(0, 2 ** 63, 300).astype(np.uint64))
    sizes = rng.integers(1, 9, len(contexts))
    prints = np.concatenate([np.sort(rng.choice(2 ** 40, n, replace=False)) for n in sizes]).astype(np.uint64)
    codes = rng.integers(0, 256, len(prints)).astype(np.uint8)
    with ngrams.Trie.build(contexts, sizes, prints, codes).mapped() as trie:
        assert (trie.lookup(contexts, sizes, prints) == codes).all()
        first = np.cumsum(sizes) - sizes
        some = np.array([3, 77, 200])
        assert (trie.lookup(contexts[some], np.ones(3, int), prints[first[some]]) == codes[first[some]]).all()
        # misses: successors that are not there, before, between and behind those that are, and unknown contexts
        known = {(c, p): k for c, p, k in zip(np.repeat(contexts, sizes).tolist(), prints.tolist(), codes.tolist())}
        asked = np.sort(np.concatenate([contexts, contexts[::3] + np.uint64(1), np.array([0, 2 ** 64 - 1], np.uint64)]))
        each = np.concatenate([[0, 2 ** 40 - 1], prints[::40], prints[::40] + np.uint64(1)]).astype(np.uint64)
        got = trie.lookup(asked, np.full(len(asked), len(each)), np.tile(each, len(asked)))
        assert got.tolist() == [known.get((c, p), 0) for c in asked.tolist() for p in each.tolist()] and got.any()
    none = np.zeros(0, np.uint64)
    with ngrams.Trie.build(none, np.zeros(0, int), none, np.zeros(0, np.uint8)).mapped() as trie:
        assert trie.lookup(contexts[:2], np.array([1, 2]), prints[:3]).tolist() == [0, 0, 0]


def test_codes_round_down():
    p = np.array([1.0, 0.5, 1e-3, 3e-9, 1e-12])
    back = ngrams.restore(ngrams.quantise(np.log10(p)))
    assert back[0] == 1.0 and (back[:4] <= p[:4] * 1.000001).all() and (back[:3] > p[:3] * 0.9).all()
    assert ngrams.restore(np.zeros(1, np.uint8))[0] == 0


def words_of(text):
    return (text or "").encode().lower().split() + [b"\n"]


def brute_base(rows, held):
    c = Counter()
    for d, t in rows:
        if not held(d):
            c.update(words_of(t))
    n, v = c.total(), len(c)
    return {(d, t): (len(w := words_of(t)), sum(c[x] > 0 for x in w), n,
                     sum(log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)) for d, t in rows}


class BruteModel:
    """The same model in dictionaries, one token after the other."""

    def __init__(self, rows, held):
        self.c, self.pairs = Counter(), Counter()
        for d, t in rows:
            if not held(d):
                w = words_of(t)
                self.c.update(w)
                self.pairs.update(zip([b"\n", *w], w))
        self.n, once, all_ = self.c.total(), Counter(), Counter()
        for (h, _), n in self.pairs.items():
            k = self.c[h].bit_length()
            once[k] += n == 1
            all_[k] += n
        self.mu = {k: (once[k] + 1) / (all_[k] + 2) for k in all_}

    def p(self, h, w):
        base = (self.c[w] + 0.5) / (self.n + 0.5 * (len(self.c) + 1))
        mu, seen = self.mu.get(self.c[h].bit_length(), 1.0), 0.0
        if self.pairs[h, w]:
            code = 1 + min(254, max(0, int(254 * (1 + log10(self.pairs[h, w] / self.c[h]) / 9) + 1e-9)))
            seen = 10 ** (-9 * (1 - (code - 1) / 254))
        return (1 - mu) * seen + mu * base

    def score(self, text):
        w = words_of(text)
        return sum(log10(self.p(h, x)) for h, x in zip([b"\n", *w], w))


def check(df, held_column, held):
    rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    want = sorted(((d, *brute_base(rows, held)[d, t][:3]) for d, t in rows), key=repr)
    out = ngrams.scores(df, held_column).toPandas()
    got = sorted(((None if d is None or d != d else int(d), a, b, c) for d, a, b, c in
                  zip(out.doc_id, out.n_tokens, out.n_known, out.train_tokens)), key=repr)
    assert got == want
    assert sorted(out.base_score) == pytest.approx(sorted(v[3] for v in (brute_base(rows, held)[r] for r in rows)))
    assert (out.score <= 0).all() and np.isfinite(out.score).all()
    model = BruteModel(rows, held)
    assert sorted(out.score) == pytest.approx(sorted(model.score(t) for _, t in rows))
    return out


@pytest.mark.parametrize("small", [False, True])
def test_given_table(spark, monkeypatch, small):
    if small:  # many blocks, shards, and split contexts
        for name, n in (("BLOCK_TOKENS", 9000), ("WORDS_PER_SHARD", 9000), ("PAIRS_PER_SHARD", 9000)):
            monkeypatch.setattr(ngrams, name, n)
    out = check(documents(spark, "/root/testdata/sf0.001"), queries.fold() == 1, lambda d: zlib.crc32(str(d).encode()) % 5 == 1)
    test_given_table.sums = getattr(test_given_table, "sums", []) + [round(out.score.sum(), 4)]
    assert len(set(test_given_table.sums)) == 1


def test_better_than_single_words(spark):
    out = queries.QUERIES["op4_ngram_scores"](spark, "/root/testdata/sf0.01").toPandas()
    held = out[out.held_out]
    assert held.score.sum() > held.base_score.sum() and len(out) == 1000


def test_distribution(spark):
    """After any context the probabilities of all known words and one unknown add up to 1, less what codes round off.

    `check` holds the library's scores against the dictionary model, whose probabilities are added up here.
    """
    df = documents(spark, "/root/testdata/sf0.001")
    rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    model = BruteModel(rows, lambda d: zlib.crc32(str(d).encode()) % 5 == 1)
    words = [*model.c, b"never seen"]
    for h in [b"\n", b"never seen", *list(model.c)[:40]]:
        assert 0.9 < sum(model.p(h, w) for w in words) < 1 + 1e-9


def test_edges(frame, edge_rows):
    check(frame(edge_rows), F.col("doc_id") % 2 == 1, lambda d: d is not None and d % 2 == 1)
    check(frame(edge_rows), F.lit(True), lambda d: True)
    assert ngrams.scores(frame([]).limit(0), F.lit(False)).count() == 0
