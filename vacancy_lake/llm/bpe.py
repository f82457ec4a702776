"""Byte-level BPE encoding and decoding with a segment tree over adjacent pair ranks.

The file of a public byte-level tokenizer gives vocabulary, merges and special tokens; nothing is trained. A text is
split at special tokens, then by the tokenizer's pattern. For each piece the ranks of adjacent pairs lie in a segment
tree whose nodes hold the least (rank, place) of 32 below them. The root is the leftmost pair of lowest rank; a merge
changes three leaves, each updated along its path to the root, until no pair of finite rank is left: O(n log n) for any piece,
also one as long as the text. What was seen before is looked up, first by blank-separated chunk, then by piece, in one
table of the Python worker. It is bounded: when it is full, its older half, what was not asked for since, goes.

Defined results: null is the empty text, with no ids; nothing is added to a text, padded or truncated.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F

from .common import begin, released, table_of

#: Chunks and pieces of a generation; a worker remembers two.
CACHED = 50_000
#: Longest chunk or piece that is remembered, in characters.
LONGEST = 64
#: Bytes of texts whose parts are looked up together.
SLICE = 1 << 19

# The splitting pattern of byte-level BPE, and Unicode's white space as the pattern's \s means it.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPACE = r"\t\n\x0b\x0c\r \x85\xa0  -     　"

#: What no piece of PATTERN crosses: a chunk with its leading blank, or white space less what belongs to the next chunk.
CHUNK = re.compile(rf" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]")
#: White space other than a blank or line break before a chunk.
RUNS = "[" + SPACE.replace(r"\n", "").replace(" ", "", 1) + r"]|\n\n| [ \n]| \z"

#: Letters whose class no version of Unicode disputes, with the line break that may stand before a word, and punctuation.
STEM = "\n" + "".join(chr(c) for c in [*range(65, 91), *range(97, 123), *range(0xC0, 0x250)] if c not in (0xD7, 0xF7))
MARKS = ".,;:!?*%&$#|"


def byte_letters() -> dict[str, int]:
    """Letters that stand for bytes in the vocabulary: printable ones for themselves, others from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def parts_of(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """(parts of all texts, distinct ones numbered; where each text starts among them): cut before every blank, which
    goes, and before every line break, which stays at the head of its part. A break is added before each text."""
    lines = pc.binary_join_element_wise(pa.scalar("\n", pa.large_string()), pc.replace_substring(texts, "\n", " \n"),
                                        pa.scalar("", pa.large_string()))
    parts = pc.split_pattern(lines, " ")
    return parts.values.dictionary_encode(), parts.offsets.to_numpy()


def ids_by_part(texts: pa.Array, line: bytes, looked_up: Callable[[list[str]], list], mark_ids: Callable[[str], bytes]) -> list:
    """Ids of texts, put together from those of their parts; None where a part has none.

    `looked_up` gets distinct parts, `mark_ids` the punctuation behind words, where the pattern breaks as well. A part
    stands for itself with a blank before it, or for a line break and what follows; the added break is `line` long.
    """
    parts, starts = parts_of(texts)
    distinct = parts.dictionary
    rest = pc.utf8_ltrim(distinct, STEM)
    stem = pc.utf8_rtrim(distinct, MARKS)
    word = pc.and_(pc.equal(pc.utf8_rtrim(rest, MARKS), ""), pc.greater(pc.binary_length(pc.utf8_ltrim(stem, "\n")), 0))
    stem, rest = pc.if_else(word, stem, distinct).dictionary_encode(), pc.if_else(word, rest, "").dictionary_encode()
    stems = pa.array(looked_up(stem.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.large_binary())
    marks = pa.array([mark_ids(mark) for mark in rest.dictionary.to_pylist()], pa.large_binary())
    ids = pc.binary_join_element_wise(stems.take(stem.indices), marks.take(rest.indices), pa.scalar(b"", pa.large_binary()))
    ids = ids.take(parts.indices)
    lost = [False] * len(texts)
    if ids.null_count:
        lost = (np.add.reduceat(ids.is_null().to_numpy(zero_copy_only=False), starts[:-1], dtype=np.int64) > 0).tolist()
    at = np.frombuffer(ids.buffers()[1], np.int64)[starts].tolist()
    raw, skip = memoryview(ids.buffers()[2] or b""), len(line)
    return [None if none else raw[a + skip:b].tobytes() for none, a, b in zip(lost, at, at[1:])]


def slices(batch: pa.RecordBatch, size: int, column: int = 1) -> Iterator[pa.RecordBatch]:
    """Rows of a batch in order, about `size` bytes of text at a time."""
    held = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        end = int(np.searchsorted(held, (held[at - 1] if at else 0) + size)) + 1
        yield batch.slice(at, end - at)
        at = end


class PairTree:
    """Segment tree over keys: each node holds the least of WIDTH nodes below it. `FREE` stands where there is no key."""

    FREE = 1 << 62
    WIDTH = 32

    def __init__(self, keys: list[int]):
        self.levels, width = [keys], self.WIDTH
        while len(keys) > width:
            keys = [min(keys[i:i + width]) for i in range(0, len(keys), width)]
            self.levels.append(keys)
        #: With one level there is nothing above a leaf.
        self.put = self.levels[0].__setitem__ if len(self.levels) == 1 else self._put

    def root(self) -> int:
        return min(self.levels[-1])

    def _put(self, place: int, key: int) -> None:
        below, width = self.levels[0], self.WIDTH
        below[place] = key
        for level in self.levels[1:]:
            place //= width
            least = min(below[place * width:place * width + width])
            if level[place] == least:
                break
            level[place] = least
            below = level


class ByteBpe:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters, vocab = byte_letters(), spec["model"]["vocab"]
        self.merges = {}  # of two ids, the rank in the upper bits and the id of both in the lower 32
        for rank, (a, b) in enumerate(spec["model"]["merges"]):
            self.merges.setdefault((vocab[a], vocab[b]), rank << 32 | vocab[a + b])
        self.of_byte = [0] * 256
        for letter, byte in letters.items():
            self.of_byte[byte] = vocab[letter]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        top = max([*vocab.values(), *special.values()])
        self.bytes_of = [b""] * (top + 1)
        for token, i in vocab.items():
            self.bytes_of[i] = bytes(letters[c] for c in token)
        for token, i in special.items():
            self.bytes_of[i] = token.encode()
        self.special = {t: np.uint32(i).tobytes() for t, i in special.items()}
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") \
            if special else None
        self.pieces = regex.compile(PATTERN).findall
        self.known, self.old = {}, {}
        self.line = self.encode("\n")

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one piece."""
        ids = [self.of_byte[b] for b in piece]
        n = len(ids)
        if n < 2:
            return ids
        find, width = self.merges.get, n.bit_length()
        free = PairTree.FREE
        if n <= PairTree.WIDTH:
            return self.merge_short(ids)
        keys = [(m >> 32 << width | i) if (m := find(pair)) is not None else free for i, pair in enumerate(zip(ids, ids[1:]))]
        tree = PairTree(keys)
        root, put = tree.root, tree.put
        after, before, mask = list(range(1, n + 1)), list(range(-1, n - 1)), (1 << width) - 1
        while (least := root()) < free:
            i = least & mask
            j = after[i]
            merged = ids[i] = find((ids[i], ids[j])) & 0xFFFFFFFF
            ids[j] = -1
            k = after[i] = after[j]
            if j < n - 1:
                put(j, free)
            if k < n:
                before[k] = i
                m = find((merged, ids[k]))
                put(i, free if m is None else m >> 32 << width | i)
            else:
                put(i, free)
            if (h := before[i]) >= 0:
                m = find((ids[h], merged))
                put(h, free if m is None else m >> 32 << width | h)
        return [i for i in ids if i >= 0]

    def merge_short(self, ids: list[int]) -> list[int]:
        """The same for a piece whose tree is its leaves alone: these close up after a merge."""
        find, none = self.merges.get, PairTree.FREE
        found = [find(pair, none) for pair in zip(ids, ids[1:])]
        while found and (least := min(found)) < none:
            i = found.index(least)
            merged = ids[i] = least & 0xFFFFFFFF
            del ids[i + 1], found[i]
            if i:
                found[i - 1] = find((ids[i - 1], merged), none)
            if i < len(found):
                found[i] = find((merged, ids[i + 1]), none)
        return ids

    def remember(self, part: str, ids: bytes) -> bytes:
        if len(part) <= LONGEST:
            if len(self.known) >= CACHED:
                self.old, self.known = self.known, {}
            self.known[part] = ids
        return ids

    def chunk(self, chunk: str) -> bytes:
        """Ids of a chunk that is not in the newer table."""
        ids = self.old.get(chunk)
        if ids is not None:
            return self.remember(chunk, ids)
        pieces = self.pieces(chunk)
        if len(pieces) == 1:
            return self.remember(chunk, self.fresh(chunk))
        return self.remember(chunk, b"".join(map(self.piece, pieces)))

    def piece(self, piece: str) -> bytes:
        ids = self.known.get(piece)
        if ids is None:
            ids = self.old.get(piece)
            ids = self.remember(piece, self.fresh(piece) if ids is None else ids)
        return ids

    def fresh(self, piece: str) -> bytes:
        return array("I", self.merge(piece.encode("utf-8", "surrogatepass"))).tobytes()

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        out = []
        for part in self.split.split(text or "") if self.split else [text or ""]:
            if part in self.special:
                out.append(self.special[part])
                continue
            chunks = CHUNK.findall(part)
            found = list(map(self.known.get, chunks))
            if None in found:
                found = [self.chunk(chunk) if ids is None else ids for chunk, ids in zip(chunks, found)]
            out += found
        return b"".join(out)

    def looked_up(self, parts: list[str]) -> list[bytes]:
        """Ids of distinct parts, as `ids_by_part` has them."""
        get = self.known.get
        out = list(map(get, chunks := [p[1:] if p[0] == "\n" else " " + p for p in parts]))
        for i, ids in enumerate(out):
            if ids is None:
                out[i] = ids = self.chunk(chunks[i]) if chunks[i] else b""
            if parts[i][0] == "\n":
                out[i] = self.line + ids
        return out

    def encode_all(self, texts: pa.Array) -> list[bytes]:
        """The same of many texts: a part that occurs again in them is looked up once."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if not len(texts):
            return []
        odd = pc.match_substring_regex(texts, RUNS)
        for token in self.special:
            odd = pc.or_(odd, pc.match_substring(texts, token))
        found = ids_by_part(pc.if_else(odd, "", texts), self.line, self.looked_up, lambda mark: self.piece(mark) if mark else b"")
        return [self.encode(texts[i].as_py()) if other else ids for i, (other, ids) in enumerate(zip(odd.to_pylist(), found))]

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


@lru_cache(4)
def codec(path: str) -> ByteBpe:
    """One per worker and file, kept between tasks."""
    return ByteBpe(path)


table_of("bpe", codec.cache_clear)


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("bpe")
        bpe = codec(path)
        for batch in released(batches):
            for part in released(slices(batch, SLICE)):
                found = [np.frombuffer(ids, "<u4").astype(np.int32) for ids in bpe.encode_all(part.column(1))]
                ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*found, np.zeros(0, np.int32)])))
                yield pa.RecordBatch.from_arrays([part.column(0), ids], ["doc_id", "ids"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, text_col).mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode(df: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text) of rows with ids; null ids are no ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("bpe")
        bpe = codec(path)
        for batch in batches:
            texts = [bpe.decode(np.array(ids or [], "<u4").tobytes()) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, ids_col).mapInArrow(run, f"doc_id {kind}, text string")


def round_trip(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encoded and decoded in one pass: doc_id, n_tokens, ids_sha256, decoded_sha256; ids never leave the task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("bpe")
        bpe = codec(path)
        sha = lambda b: hashlib.sha256(b).hexdigest()
        for batch in batches:
            for part in released(slices(batch, SLICE)):
                n, of_ids, of_text = [], [], []
                for ids in bpe.encode_all(part.column(1)):
                    n.append(len(ids) // 4)
                    of_ids.append(sha(ids))
                    of_text.append(sha(bpe.decode(ids).encode()))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(of_ids, pa.string()),
                                                  pa.array(of_text, pa.string())],
                                                 ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(F.col(id_col), F.col(text_col)).mapInArrow(
        run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
