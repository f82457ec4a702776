"""Re-Pair token files: exact round trips, order, random access."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from vacancy_lake.llm import bpe, token_files
from vacancy_lake.llm.common import documents

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def expand(rules, symbols, base):
    out = []
    for s in symbols:
        out.extend([s] if s < base else expand(rules, rules[s - base].tolist(), base))
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 4), max_size=60), min_size=1, max_size=12))
def test_grammar_round_trip(docs):
    docs = [[*d, 2] for d in docs]
    ids, sizes = np.array(sum(docs, []), np.uint32), np.array([len(d) for d in docs])
    rules, symbols, starts = token_files.compress(ids, np.cumsum(sizes) - 1, 5)
    cuts = [*starts.tolist(), len(symbols)]
    assert [expand(rules, symbols[a:b].tolist(), 5) for a, b in zip(cuts, cuts[1:])] == docs
    assert (token_files.from_planes(token_files.planes(symbols)) == symbols).all()


def test_grammar_gains_on_repeats():
    ids = np.array(([7, 8, 9, 10] * 500 + [2]) * 3, np.uint32)
    _, symbols, _ = token_files.compress(ids, np.arange(1, 4) * 2001 - 1, 100)
    assert len(symbols) < len(ids) / 20


def test_turns_count_open_places_alone(monkeypatch):
    """Pairs met with too few places are not counted again, and at the end no pair is worth a rule."""
    rng = np.random.default_rng(5)
    ids = np.minimum(rng.zipf(1.3, 100_000), 3000).astype(np.uint32) + 2
    ends = np.append(np.sort(rng.choice(len(ids) - 1, 200, replace=False)), len(ids) - 1)
    ids[ends] = 2
    counted, bincount = [], np.bincount
    monkeypatch.setattr(np, "bincount", lambda x, *a, **b: counted.append(len(x)) or bincount(x, *a, **b))
    rules, symbols, starts = token_files.compress(ids, ends, 5000)
    monkeypatch.undo()
    assert sum(counted) < 4 * len(ids)  # 2.7 times; 5.2 when every turn counts all places
    table = token_files.expansions(rules, 5000)
    assert b"".join(table[s] for s in symbols.tolist()) == ids.tobytes()
    closed = np.zeros(len(symbols), bool)
    closed[np.append(starts[1:], len(symbols)) - 1] = True
    pairs = np.stack([symbols[:-1], symbols[1:]], 1)[~closed[:-1]]
    found, n = np.unique(pairs[pairs[:, 0] != pairs[:, 1]], axis=0, return_counts=True)
    assert n.max() < token_files.LEAST_COUNT


def test_parts_are_looked_up_once():
    """All texts of a call share their parts: what occurs again costs no lookup, and what is known no call of the library."""
    class Counted(dict):
        asked = 0

        def get(self, *a):
            Counted.asked += 1
            return dict.get(self, *a)

    lib = token_files.LibraryIds(PATH)
    lib.table = Counted(lib.table)
    texts = ["the quick, brown fox.\nthe brown; quick fox, ñandú!\n", None, "", "\n the, fox", "fox  fox", "a<|endoftext|>b"] * 50
    want = [np.array(LIBRARY.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert lib.encode(texts) == want
    assert Counted.asked < 20  # parts without marks; 800 words
    asked = []
    lib.runs = lambda parts: asked.extend(parts) or []
    assert lib.encode(texts[:4] * 9) == want[:4] * 9 and not asked


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.lists(st.sampled_from(
    [" ", " ", "\n", "\t", "a", "The", "ñu", ".", ",;", "'s", "it's", "7", "\u00a0", "\u3000", "中", "<|endoftext|>", "\x1c", "×"]),
    max_size=10).map("".join), st.text(max_size=20)), max_size=6))
def test_texts_of_a_call(texts):
    assert token_files.library(PATH).encode(texts) == [
        np.array(LIBRARY.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


def test_slices_cover_all_rows():
    rows = pa.RecordBatch.from_arrays([pa.array(range(7)), pa.array(["x" * 25, None, "ab", "", "y" * 9, "zz", None])], ["i", "t"])
    got = [s.to_pylist() for s in bpe.slices(rows, 10)]
    assert sum(got, []) == rows.to_pylist() and len(got) > 2
    assert not list(bpe.slices(rows.slice(0, 0), 10))


def check(df):
    texts = df.select("doc_id", "text").collect()
    want = {}
    for r in texts:
        ids = np.array(LIBRARY.encode(r["text"] or "", add_special_tokens=False).ids + [2], "<u4")
        want.setdefault(r["doc_id"], []).append((len(ids), zlib.crc32(ids.tobytes())))
    blocks = token_files.write(df, PATH)
    out = token_files.listing(blocks).collect()
    assert len(out) == len(texts)
    for r in out:
        assert (r["n_tokens"], r["ids_crc32"]) in want[r["doc_id"]]
    order = sorted(out, key=lambda r: r["start"])
    at, last = 0, None
    for r in order:
        assert r["start"] == at and (last is None or r["doc_id"] >= last)
        at, last = at + r["n_tokens"], r["doc_id"]
    return blocks


def test_given_table(spark):
    blocks = check(documents(spark, "/root/testdata/sf0.001"))
    block = blocks.orderBy("shard", "block").first().asDict()
    places = [len(block["doc_ids"]) - 1, 3]
    whole = {at: raw for at, _, raw, _ in token_files.documents_of(block)}
    assert {at: raw for at, _, raw, _ in token_files.documents_of(block, places)} == {p: whole[p] for p in places}
    lengths = block["rule_lengths"]
    table = token_files.expansions(token_files.from_planes(block["rules"]).reshape(-1, 2), block["base"])
    assert [len(t) // 4 for t in table[block["base"]:]] == lengths


def test_many_shards_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(token_files, "ROWS_PER_SHARD", 13)
    monkeypatch.setattr(token_files, "BLOCK", 3000)
    docs = documents(spark, "/root/testdata/sf0.001")
    blocks = check(docs)
    assert blocks.select("shard").distinct().count() > 10
    monkeypatch.setattr(token_files, "MOST_CUTS", 2)
    check(docs)


def test_edges(frame, edge_rows):
    check(frame(edge_rows))
    assert token_files.listing(token_files.write(frame([]).limit(0), PATH)).count() == 0
