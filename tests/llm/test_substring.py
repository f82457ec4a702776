"""Passage removal against brute force; the FM-index against plain search."""

import random

import numpy as np
import pytest

from tests.llm.conftest import words
from vacancy_lake.llm import substring
from vacancy_lake.llm.common import documents


def brute(rows, window):
    first, texts = {}, []
    for d, t in rows:
        w = (t or "").encode().split()
        texts.append((d, w))
        if d is not None:
            for i in range(len(w) - window + 1):
                k = tuple(w[i:i + window])
                first[k] = min(first.get(k, d), d)
    out = []
    for d, w in texts:
        stay = [True] * len(w)
        if d is not None:
            for i in range(len(w) - window + 1):
                if first[tuple(w[i:i + window])] < d:
                    stay[i:i + window] = [False] * window
        out.append((d, len(w), stay.count(False), b" ".join(x for x, s in zip(w, stay) if s).decode()))
    return sorted(out, key=repr)


def check(df, window=50, gram=8):
    rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    got = sorted(map(tuple, substring.remove_repeats(df, window=window, gram=gram).collect()), key=repr)
    want = brute(rows, window)
    assert got == want
    return sum(r[2] for r in want)


@pytest.mark.parametrize("common", [5_000, 2])
def test_given_table(spark, monkeypatch, common):
    monkeypatch.setattr(substring, "COMMON", common)
    assert check(documents(spark, "/root/testdata/sf0.001")) > 0


@pytest.mark.parametrize("window, gram", [(50, 8), (6, 2), (3, 3)])
def test_edges(frame, edge_rows, window, gram):
    check(frame(edge_rows), window, gram)


@pytest.mark.parametrize("common", [5_000, 1])
def test_small_alphabet(frame, monkeypatch, common):
    """Few words, so windows overlap and repeat within and between documents; several shards; one hot passage."""
    monkeypatch.setattr(substring, "COMMON", common)
    monkeypatch.setattr(substring, "WORDS_PER_SHARD", 150)
    rng = random.Random(3)
    passage = " ".join(rng.choice("abc") for _ in range(14))
    rows = []
    for i in range(70):
        own = " ".join(rng.choice("abc") for _ in range(rng.randint(0, 30)))
        rows.append((i % 60, f"{own} {passage} {own[::-1]}" if i % 3 == 0 else own, "s"))
    for window, gram in ((8, 3), (12, 4), (5, 1)):
        assert check(frame(rows), window, gram) > 0


def test_pieces_around_a_common_passage_do_not_meet_in_one_search():
    """What is searched together stays small, however many documents hold the passage between words of their own."""
    passage, searched = words(60, 9), {}
    texts = [substring.word_hashes(f"{words(60, 100 + i)} {passage} {words(60, 300 + i)}") for i in range(80)]
    common = np.unique(np.concatenate([g[np.unique(p)] for p, g in (substring.anchors(h, 50, 8) for h in texts)]))
    for h in texts:
        covered = np.zeros(len(h) - 49, int)
        for route, first, n, *search in substring.pieces_of(h, common, common, 50, 8):
            covered[first:first + n] += 1
            if search != [False]:
                searched.setdefault(route, set()).add(h[first:first + n + 49].tobytes())
        assert (covered == 1).all()
    assert max(map(len, searched.values()), default=0) < 10


def test_empty_table(frame):
    assert substring.remove_repeats(frame([]).limit(0)).count() == 0
    assert check(frame([(1, "short", None), (2, "short", None)])) == 0


def test_index_ranges_and_minima():
    rng = np.random.default_rng(4)
    pieces = [rng.integers(1, 4, rng.integers(5, 30)) for _ in range(40)]
    docs = np.sort(rng.integers(0, 25, 40))
    text = np.concatenate([np.append(0, p) for p in pieces])
    of = np.repeat(docs, [len(p) + 1 for p in pieces])
    index = substring.FmIndex(text, of, 8)
    for _ in range(200):
        p = rng.integers(1, 4, rng.integers(1, 8))
        lo, hi = np.array([0]), np.array([index.n])
        for c in p[::-1]:
            lo, hi = index.extend(np.array([c]), lo, hi)
            if hi[0] <= lo[0]:
                break
        places = [i for i in range(len(text) - len(p) + 1) if (text[i:i + len(p)] == p).all()]
        assert max(0, hi[0] - lo[0]) == len(places)
        if places:
            assert index.least_document(lo, hi)[0] == min(of[i] for i in places)


def test_wavelet_ranks():
    values = np.random.default_rng(5).integers(0, 37, 500)
    w = substring.WaveletMatrix(values, 6)
    for c in (0, 5, 36):
        lo, hi = w.ranks(np.array([c, c]), np.array([0, 130]), np.array([500, 131]))
        assert hi[0] - lo[0] == (values == c).sum() and lo[1] == (values[:130] == c).sum()


def test_anchors_agree_in_equal_windows():
    text = words(200, 8).split()
    a, b = substring.word_hashes(" ".join(text)), substring.word_hashes(" ".join(["x", "y", *text[40:150], "z"]))
    pa, ga = substring.anchors(a, 50, 8)
    pb, gb = substring.anchors(b, 50, 8)
    for i in range(40, 100):
        j = i - 40 + 2
        assert pa[i] - i == pb[j] - j and ga[pa[i]] == gb[pb[j]]


def test_word_hashes_are_equal_for_equal_words_alone(monkeypatch):
    """Every length around the two numbers that are read, zero bytes, blanks of Unicode; only long words are looked up one by one."""
    rng, pool = random.Random(6), []
    for n in range(1, 24):
        pool += ["".join(rng.choice("ab\0é \u0085") for _ in range(n)) for _ in range(8)] + ["a" * n, "\0" * n]
    text = "\n" + "".join(rng.choice(pool) + rng.choice([" ", "\t", "\n", "\v", "\f", "\r", "  "]) for _ in range(5000)) + "end"
    asked, table = [], substring._HASHES
    monkeypatch.setattr(substring, "_HASHES", type("Watched", (), {"__getitem__": lambda _, w: (asked.append(w), table[w])[1]})())
    found, want = substring.word_hashes(text).tolist(), text.encode().split()
    assert len(found) == len(want) and len(set(found)) == len(set(zip(found, want))) == len(set(want))
    assert asked == [w for w in want if len(w) > 16]
    assert substring.word_hashes("").tolist() == substring.word_hashes(None).tolist() == []
    assert substring.word_hashes("\ud800 x").tolist()[1] == substring.word_hashes("x").tolist()[0]


def test_anchor_is_the_leftmost_least_gram():
    rng = np.random.default_rng(7)
    for window, gram in ((50, 8), (6, 2), (5, 1), (3, 3), (13, 5)):
        h = rng.integers(0, 3, 200).astype(np.uint64)
        place, grams = substring.anchors(h, window, gram)
        assert len(grams) == 201 - gram and len(place) == 201 - window
        assert len({(g, tuple(h[i:i + gram])) for i, g in enumerate(grams.tolist())}) == len(set(grams.tolist()))
        for i, at in enumerate(place.tolist()):
            assert at == i + int(grams[i:i + window - gram + 1].argmin())
