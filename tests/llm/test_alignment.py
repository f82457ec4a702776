"""Alignment of two tokenizers against whole-text encodings and plain loops."""

import base64
import hashlib
import json
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from vacancy_lake.llm import alignment as L
from vacancy_lake.llm.queries import documents

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    ranks = {int(r): base64.b64decode(t) for t, r in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
    return a, ranks, sentencepiece.SentencePieceProcessor(model_file=B)


def groups_of(libraries, text):
    """Groups of whole texts, by plain loops over byte offsets; None where bytes differ."""
    a, ranks, b = libraries
    if not text:
        return None
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    parts_a = [ranks[i] for i in ids_a]
    parts_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
    if b"".join(parts_a) != (" " + text).encode() or b"".join(parts_b) != (" " + text).encode():
        return None
    out, left, right, i, j, end_a, end_b = [], [], [], 0, 0, 0, 0
    while i < len(ids_a) or j < len(ids_b):
        if end_a <= end_b and i < len(ids_a):
            left.append(ids_a[i])
            end_a += len(parts_a[i])
            i += 1
        else:
            right.append(ids_b[j])
            end_b += len(parts_b[j])
            j += 1
        if end_a == end_b:
            out.append((left, right))
            left, right = [], []
    return out


def brute(libraries, rows):
    docs = [groups_of(libraries, t) for _, t in rows]
    links = [Counter((x, y) for left, right in d or [] for x in left for y in right) for d in docs]
    count = Counter(pair for l in links for pair in l)
    best = {}
    for (x, _), n in count.items():
        best[x] = max(best.get(x, 0), n)
    out = []
    for (doc_id, _), d, l in zip(rows, docs, links):
        text = ";".join(",".join(map(str, left)) + "|" + ",".join(map(str, right)) for left, right in d or [])
        out.append((doc_id, sum(len(left) for left, _ in d or []), sum(len(right) for _, right in d or []), len(d or []), sum(l.values()),
                    sum(n for (x, y), n in l.items() if count[x, y] == best[x]), sum(n * count[p] for p, n in l.items()),
                    hashlib.sha256(text.encode()).hexdigest() if d else ""))
    return sorted(out, key=repr)


TEXTS = ["", None, " ", "  ", "\n", "a", "Hello world", "  two  blanks  ", "tabs\tand\nlines\n\n x", "<|endoftext|> plain", "<s> </s> <unk> <0x41>",
         "▁ a▁ b", "é\U0001F600ü 漢字 カナ", "zero\x00byte", "x" * 20_000, "a b  c", "'s 're don't", "1234567 89", "aé́ ́b",
         " \n mixed \r\n ends ", "﷽ ​ ﬁ", "<|endoftext|>", "the the the cat sat on the mat " * 300, "\x1c \x85  x ᠎ y"]


@pytest.mark.parametrize("hot", [3, 200, L.HOT])
def test_equals_plain_loops(spark, frame, libraries, hot):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(6, TEXTS[6]), (None, "Hello world"), (None, None)]
    got = L.alignment(frame([(i, t, "s") for i, t in rows]), A, B, hot=hot).collect()
    assert sorted(map(tuple, got), key=repr) == brute(libraries, rows)


def test_whole_table_equals_plain_loops(spark, libraries):
    docs = documents(spark, "/root/testdata/sf0.001").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    assert sorted(map(tuple, L.alignment(docs, A, B).collect()), key=repr) == brute(libraries, rows)


def test_edge_rows(spark, frame, edge_rows, libraries):
    got = L.alignment(frame(edge_rows), A, B)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(libraries, [(d, t) for d, t, _ in edge_rows])
    assert L.alignment(frame([]), A, B).collect() == []


@given(st.text(alphabet=" \n\tabé漢▁.,'1  \U0001F600<|>", max_size=60))
@settings(max_examples=400, deadline=None)
def test_chunks_align_like_whole_texts(libraries, text):
    got = {k: v.to_pylist()[0] for k, v in L.aligner(A, B).rows([text]).items()}
    want = brute(libraries, [(0, text)])[0]
    assert (got["n_a"], got["n_b"], got["n_groups"], got["n_links"], got["groups_sha256"]) == (*want[1:5], want[7])


def test_bounded_table(libraries, monkeypatch):
    monkeypatch.setattr(L, "CACHED", 5)
    both = L.Aligner(A, B)
    for text in TEXTS * 2:
        got = {k: v.to_pylist()[0] for k, v in both.rows([text]).items()}
        assert got["n_links"] == brute(libraries, [(0, text)])[0][4]


def test_added_tokens_have_no_bytes():
    spec = json.load(open(A))
    assert all(L.aligner(A, B).bytes_a[t["id"]] == b"" for t in spec["added_tokens"])
