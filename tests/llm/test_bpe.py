"""Byte-level BPE against the tokenizers library."""

import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from vacancy_lake.llm import bpe, token_files
from vacancy_lake.llm.common import documents

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
OWN = bpe.ByteBpe(PATH)


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def check(text):
    want, ids = ids_of(text), OWN.encode(text)
    assert np.frombuffer(ids, "<u4").tolist() == want
    assert OWN.decode(ids) == LIBRARY.decode(want, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    check(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([" ", "  ", "\n", "\t", "a", "the", " of", "'s", "'ll", "1", "é", "ß", " ", "　", "-", "!!",
                                 "<|endoftext|>", "<|endof", "中", "\U0001f600", "\x1c", "\x85"]), max_size=14))
def test_pieces_and_special_tokens(parts):
    text = "".join(parts)
    check(text)
    assert np.frombuffer(token_files.library(PATH).encode([text])[0], "<u4").tolist() == ids_of(text)


def test_white_space_code_points():
    for c in [*range(0x3100), 0xFEFF, 0x1D7D8, 0x20000]:
        if not 0xD800 <= c < 0xE000:
            check(f"a {chr(c)}b  {chr(c)}{chr(c)} 1{chr(c)}\n{chr(c)}x")


def test_long_pieces():
    for text in ("ab" * 20_000, "x" * 30_001, "é" * 9_000, "- " * 9_000):
        check(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 99), min_size=1, max_size=2000), st.lists(st.tuples(st.integers(0, 1999), st.integers(0, 99)), max_size=20))
def test_tree_root_is_the_minimum(keys, changes):
    tree = bpe.PairTree(list(keys))
    assert tree.root() == min(keys)
    for place, key in changes:
        place %= len(keys)
        keys[place] = key
        tree.put(place, key)
        assert tree.root() == min(keys)


def test_round_trip_on_tables(spark, frame, edge_rows):
    for df in (documents(spark, "/root/testdata/sf0.001"), frame(edge_rows)):
        texts = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
        want = sorted(((d, len(i := ids_of(t)), hashlib.sha256(np.array(i, "<u4").tobytes()).hexdigest(),
                        hashlib.sha256(LIBRARY.decode(i, skip_special_tokens=False).encode()).hexdigest()) for d, t in texts), key=repr)
        assert sorted(map(tuple, bpe.round_trip(df, PATH).collect()), key=repr) == want
        coded = bpe.encode(df, PATH)
        assert sorted(((r["doc_id"], r["ids"]) for r in coded.collect()), key=repr) == sorted(((d, ids_of(t)) for d, t in texts), key=repr)
        back = bpe.decode(coded, PATH).collect()
        assert sorted(map(tuple, back), key=repr) == sorted(((d, t or "") for d, t in texts), key=repr)


def test_empty_table(frame):
    empty = frame([]).limit(0)
    assert bpe.encode(empty, PATH).count() == 0 and bpe.round_trip(empty, PATH).count() == 0


def test_table_of_two_generations(monkeypatch):
    """With room for a few pieces only, what goes from the table is encoded again, with the same ids."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = [f"word{i} again, word{i % 3}; some  more\nlines {i}" for i in range(40)]
    want = [bpe.ByteBpe(path).encode(t) for t in texts]
    monkeypatch.setattr(bpe, "CACHED", 5)
    small = bpe.ByteBpe(path)
    assert [small.encode(t) for t in texts] == want
    assert len(small.known) <= 5 and len(small.old) <= 5


PARTS = [" ", " ", "\n", "\t", "a", "The", "ñu", "don't", ".", ",;", "'s", "7", "\u00a0", "\u3000", "中", "×", "<|endoftext|>", "\x1c", "\x85"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=20), st.lists(st.sampled_from(PARTS), max_size=10).map("".join)), max_size=6))
def test_texts_of_a_call(texts):
    assert OWN.encode_all(pa.array(texts, pa.string())) == [np.array(ids_of(t), "<u4").tobytes() for t in texts]


def test_white_space_between_texts_of_a_call():
    found = [chr(c) for c in [*range(0x3100), 0xFEFF, 0x1D7D8] if not 0xD800 <= c < 0xE000]
    texts = [t for c in found for t in (f"a{c}b {c}c. d{c}", f"{c}a b{c}\n c")]
    assert OWN.encode_all(pa.array(texts)) == [np.array(ids_of(t), "<u4").tobytes() for t in texts]


def test_a_part_is_encoded_once_a_call(monkeypatch):
    """With room for a few pieces only, texts that share their words still cost one encoding a word, not one a place."""
    monkeypatch.setattr(bpe, "CACHED", 5)
    small, merged = bpe.ByteBpe(PATH), []
    merge = small.merge
    small.merge = lambda piece: merged.append(piece) or merge(piece)
    texts = [" ".join(f"wordy{'abcdefghij'[(i + j) % 10] * 3}{',.;'[j % 3]}" for j in range(10)) + "\n" for i in range(100)]
    assert small.encode_all(pa.array(texts)) == [OWN.encode(t) for t in texts]
    assert len(merged) < 40  # 20 words, with and without a blank, and three marks; 1000 places
