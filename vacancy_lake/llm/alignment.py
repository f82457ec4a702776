"""Alignment of the tokens of two tokenizers over the same bytes, and how many documents link each pair of ids.

A byte-level tokenizer (A) encodes a text behind a blank, a piece tokenizer with byte fallback (B) the text, to which it
puts that blank itself. The ends of the tokens, counted in bytes, go into one dictionary per side (end to index). The
ends both sides have, sorted, slice both id lists into groups, and each group links all its A ids with all its B ids.

Both tokenizers break a text before a single blank or line break that stands between two characters that are no white
space: A's pattern does, and no piece of B holds a blank behind another character, or a line break at all (which is checked
when it is loaded), so no merge crosses. Such a place is an end on both sides, so it ends a group, and the text between two
of them (a chunk) has the same groups wherever it stands. Each worker aligns a chunk once and keeps the result, up to a
bound; a text is the sequence of its chunks.

Counts by pair of ids are taken over all documents, by task before the shuffle. They come back to the documents in two
ways, and both are exact: the at most HOT pairs that make up more than one HOT-th of all (document, pair) rows each are
sent to the tasks, all others meet their rows in a shuffle, where no pair then has more than a HOT-th of the rows.

Defined results: texts that are null or empty, or that one side cannot give back byte by byte, have no tokens, all their
figures are 0 and groups_sha256 is empty. Every row is a document of its own, also where ids are null or repeat. Strings
of special tokens are plain text. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, chain, compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .bpe import byte_letters
from .common import staged

#: Most pairs that are sent to tasks (17 bytes each); also the largest part of the rows, as 1 / HOT, one shuffled key has.
HOT = 1 << 19
#: Chunks and characters a worker remembers before it starts anew.
CACHED, CACHED_CHARACTERS = 350_000, 1 << 25
#: Links from which on the equal ids of a group are counted together.
LONG = 4096
#: Ids take 20 bits of a pair's number.
_BITS = 20
_MARK = "▁"

_CHUNK = re.compile(r"(?<=\S) (?=\S)")
_IRREGULAR = re.compile(r"\s\s|^\s|\s\Z").search

FIGURES = ("n_a", "n_b", "n_groups", "n_links")


class Aligner:
    """Chunk tables of two tokenizers. `numbers` names a chunk by its place in the lists."""

    def __init__(self, byte_path: str, piece_path: str):
        # Spark deals the cores out: threads of the library's own only spend time waiting for each other.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_path)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        with open(byte_path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        self.bytes_a = [b""] * max(len(spec["model"]["vocab"]), 1 + max([*spec["model"]["vocab"].values(), 0, *(
            t["id"] for t in spec["added_tokens"])]))
        for token, i in spec["model"]["vocab"].items():
            self.bytes_a[i] = bytes(letters[c] for c in token)
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        # Control pieces stand for no text; a text is without tokens where one occurs.
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else
                        b"" if self.b.is_control(i) or self.b.is_unknown(i) else p.replace(_MARK, " ").encode()
                        for i, p in enumerate(pieces)]
        self.widths_a, self.widths_b = list(map(len, self.bytes_a)), list(map(len, self.bytes_b))
        self.by_chunk = not any(_MARK in p.lstrip(_MARK) for p in pieces)
        self.blank = self.b.piece_to_id(_MARK)
        self.by_line = (not any("\n" in p for p in pieces) and self.b.id_to_piece(self.blank) == _MARK
                        and self.b.encode("\nx")[:1] == [self.blank])
        if max(len(self.bytes_a), len(self.bytes_b)) >> _BITS:
            raise ValueError(f"ids must have at most {_BITS} bits")
        self.clear()

    def clear(self) -> None:
        self.numbers, self.groups, self.characters = {}, [], 0
        self.figures = array("q")  # n_a, n_b, n_groups, n_links, aligned of each chunk
        self.starts, self.pairs, self.times = array("q", [0]), array("q"), array("q")

    def chunks(self, text: str) -> list[str]:
        """Parts of a text between the places where both sides always break; a part that begins with a word stands behind a
        blank, others are written with what they begin with."""
        if not self.by_chunk:
            return [" " + text]
        if _IRREGULAR(text):
            return [" " + p if p[0] in " \n" else p for p in _CHUNK.split(text)]
        return (text.replace("\n", " \n") if self.by_line else text).split(" ")

    def learn(self, chunks: list[str]) -> None:
        lines = [c for c in chunks if c[0] == "\n"]
        # Behind a line break B gives no blank of its own; the one it puts before the break is taken off.
        self._learn(lines, lines, [b[1:] for b in self.b.encode(lines, num_threads=1)])
        words = [c for c in chunks if c[0] != "\n"]
        raw = [c if c[0] == " " else " " + c for c in words]
        self._learn(words, raw, self.b.encode([r[1:] for r in raw], num_threads=1))

    def _learn(self, chunks: list[str], raw: list[str], ids_b: list[list[int]]) -> None:
        """Chunks that both sides give back are aligned in one go, one behind the other; the others have no tokens."""
        ids_a = [found.ids for found in self.a.encode_batch_fast(raw, add_special_tokens=False)]
        texts = [r.encode("utf-8", "surrogatepass") for r in raw]
        good = [b"".join(map(self.bytes_a.__getitem__, a)) == t == b"".join(map(self.bytes_b.__getitem__, b))
                for a, b, t in zip(ids_a, ids_b, texts)]
        chosen = list(compress(range(len(chunks)), good))
        flat_a = list(chain.from_iterable(ids_a[i] for i in chosen))
        flat_b = list(chain.from_iterable(ids_b[i] for i in chosen))
        to_a, to_b = common_ends(ends(self.widths_a, flat_a), ends(self.widths_b, flat_b))
        pairs, times, sizes = links(flat_a, flat_b, to_a, to_b)
        # The last token of a chunk ends its last group.
        count_a = np.array([len(ids_a[i]) for i in chosen], np.int64)
        stop = np.searchsorted(to_a, np.cumsum(count_a)) + 1
        linked, listed = (np.concatenate([[0], np.cumsum(x)])[np.concatenate([[0], stop])] for x in sizes)
        figures = np.zeros((len(chunks), 5), np.int64)
        figures[chosen, 0], figures[chosen, 1] = count_a, [len(ids_b[i]) for i in chosen]
        figures[chosen, 2], figures[chosen, 3] = np.diff(stop, prepend=0), np.diff(linked)
        figures[chosen, 4] = 1
        lengths = np.zeros(len(chunks), np.int64)
        lengths[chosen] = np.diff(listed)
        groups, place = texts_of(flat_a, flat_b, to_a, to_b), 0
        joined = [""] * len(chunks)
        for i, end in zip(chosen, stop.tolist()):
            joined[i] = ";".join(groups[place:end])
            place = end
        self.numbers.update(zip(chunks, range(len(self.groups), len(self.groups) + len(chunks))))
        self.characters += sum(map(len, chunks))
        self.groups += joined
        self.starts.frombytes((self.starts[-1] + np.cumsum(lengths)).tobytes())
        self.figures.frombytes(figures.tobytes())
        self.pairs.frombytes(pairs.tobytes())
        self.times.frombytes(times.tobytes())

    def rows(self, texts: list[str | None]) -> dict[str, list | pa.Array]:
        """Figures, digest of the groups and distinct pairs with how often they are linked, for each text."""
        parts = [self.chunks(t) if t else [] for t in texts]
        if len(self.groups) > CACHED or self.characters > CACHED_CHARACTERS:
            self.clear()
        known = self.numbers
        fresh = dict.fromkeys(c for p in parts for c in p if c not in known)
        fresh = list(fresh)
        for at in range(0, len(fresh), 4096):
            self.learn(fresh[at:at + 4096])
        numbers = [list(map(known.__getitem__, p)) for p in parts]
        flat = np.fromiter((i for n in numbers for i in n), np.int64)
        counts = np.array([len(n) for n in numbers], np.int64)
        doc = np.repeat(np.arange(len(texts)), counts)
        figures = np.frombuffer(self.figures, np.int64).reshape(-1, 5)[flat]
        bad = np.bincount(doc[figures[:, 4] == 0], minlength=len(texts)) > 0
        good = ~bad & (counts > 0)
        cum = np.concatenate([np.zeros((1, 4), np.int64), np.cumsum(figures[:, :4], axis=0)])
        stop = np.cumsum(counts)
        sums = (cum[stop] - cum[stop - counts]) * good[:, None]
        groups = self.groups
        digests = [hashlib.sha256(";".join(map(groups.__getitem__, n)).encode()).hexdigest() if ok else ""
                   for n, ok in zip(numbers, good.tolist())]
        # Pairs of all chunks, as runs of the chunk table, summed up by document.
        keep = good[doc]
        flat, doc = flat[keep], doc[keep]
        starts = np.frombuffer(self.starts, np.int64)
        first, size = starts[flat], starts[flat + 1] - starts[flat]
        before = np.cumsum(size) - size
        place = np.arange(int(size.sum())) + np.repeat(first - before, size)
        pair, times = np.frombuffer(self.pairs, np.int64)[place], np.frombuffer(self.times, np.int64)[place]
        own = np.repeat(doc, size)
        order = np.lexsort((pair, own)) if len(texts) >> (62 - 2 * _BITS) else np.argsort(own << (2 * _BITS) | pair)
        pair, own, times = pair[order], own[order], times[order]
        new = np.ones(len(pair), bool)
        new[1:] = (pair[1:] != pair[:-1]) | (own[1:] != own[:-1])
        at = np.flatnonzero(new)
        times = np.add.reduceat(times, at) if len(at) else times
        offsets = np.searchsorted(own[at], np.arange(len(texts) + 1)).astype(np.int32)
        return {**{name: pa.array(sums[:, i]) for i, name in enumerate(FIGURES)}, "groups_sha256": pa.array(digests, pa.string()),
                "pairs": pa.ListArray.from_arrays(pa.array(offsets), pa.array(pair[at])),
                "times": pa.ListArray.from_arrays(pa.array(offsets), pa.array(times))}


def ends(widths: list[int], ids: list[int]) -> dict[int, int]:
    """End in bytes to the number of tokens up to it; of tokens without bytes the last counts."""
    return dict(zip(accumulate(map(widths.__getitem__, ids)), range(1, len(ids) + 1)))


def common_ends(ends_a: dict[int, int], ends_b: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """For each end that both sides have, in order: how many tokens of either side lie before it."""
    both = sorted(ends_a.keys() & ends_b.keys())
    return tuple(np.fromiter(map(side.__getitem__, both), np.int64, len(both)) for side in (ends_a, ends_b))


def links(a: list[int], b: list[int], to_a: np.ndarray, to_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, tuple[np.ndarray, np.ndarray]]:
    """Linked pairs of ids and how often (a pair may be listed again); and for each group its links, and how many pairs it
    lists. All occurrences of a group are linked; in a long group equal ids are counted together."""
    from_a, from_b = np.concatenate([[0], to_a[:-1]]), np.concatenate([[0], to_b[:-1]])
    n_a, n_b = to_a - from_a, to_b - from_b
    linked = n_a * n_b
    long = np.flatnonzero(linked > LONG).tolist()
    listed, extra = linked.copy(), {}
    for g in long:
        left, right = (Counter(x[f:t]) for x, f, t in ((a, from_a[g], to_a[g]), (b, from_b[g], to_b[g])))
        extra[g] = [(x << _BITS | y, n * m) for x, n in left.items() for y, m in right.items()]
        listed[g] = len(extra[g])
    group = np.repeat(np.arange(len(listed)), listed)
    start = np.cumsum(listed) - listed
    nth = np.arange(len(group)) - start[group]
    width = np.maximum(n_b[group], 1)
    ids_a, ids_b = np.array(a, np.int64), np.array(b, np.int64)
    inside = np.isin(group, long, invert=True) if long else slice(None)
    pairs, times = np.zeros(len(group), np.int64), np.ones(len(group), np.int64)
    group, nth, width = group[inside], nth[inside], width[inside]
    pairs[inside] = ids_a[from_a[group] + nth // width] << _BITS | ids_b[from_b[group] + nth % width]
    for g in long:
        found = np.array(extra[g], np.int64).reshape(-1, 2)
        pairs[start[g]:start[g] + listed[g]], times[start[g]:start[g] + listed[g]] = found[:, 0], found[:, 1]
    return pairs, times, (linked, listed)


def texts_of(a: list[int], b: list[int], to_a: np.ndarray, to_b: np.ndarray) -> list[str]:
    """Each group as text: ids of A, a bar, ids of B."""
    out, from_a, from_b = [], 0, 0
    for i, j in zip(to_a.tolist(), to_b.tolist()):
        if i - from_a == 1 and j - from_b == 1:
            out.append(f"{a[from_a]}|{b[from_b]}")
        else:
            out.append(",".join(map(str, a[from_a:i])) + "|" + ",".join(map(str, b[from_b:j])))
        from_a, from_b = i, j
    return out


@lru_cache(2)
def aligner(byte_path: str, piece_path: str) -> Aligner:
    """One per worker and pair of files, kept between tasks."""
    return Aligner(byte_path, piece_path)


def _runs(batch: pa.RecordBatch, characters: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Runs of a batch of bounded length; a longer text makes a run of its own."""
    at, size = 0, 0
    for i, text in enumerate(batch.column(1)):
        size += len(text.as_py() or "") + 1
        if size >= characters:
            yield batch.slice(at, i + 1 - at)
            at, size = i + 1, 0
    if at < batch.num_rows:
        yield batch.slice(at)


def aligned_rows(df: DataFrame, byte_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, figures, groups_sha256, pairs (a << 20 | b) and times of every row."""
    kind = df.schema[id_col].dataType.simpleString()
    schema = (f"doc_id {kind}, " + ", ".join(f"{c} long" for c in FIGURES)
              + ", groups_sha256 string, pairs array<long>, times array<long>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(byte_path, piece_path)
        for batch in batches:
            for part in _runs(batch):
                found = both.rows(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), *found.values()], ["doc_id", *found])

    return df.select(id_col, text_col).mapInArrow(run, schema)


def pair_counts(rows: DataFrame) -> DataFrame:
    """pair, docs (rows that hold it) and best (whether no pair of its A id has more)."""
    counts = staged(rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("docs")), "pair-counts")
    a = F.shiftright("pair", _BITS)
    # One row per id of the vocabulary of A.
    most = counts.groupBy(a.alias("a")).agg(F.max("docs").alias("most"))
    return counts.withColumn("a", a).join(F.broadcast(most), "a").select("pair", "docs", (F.col("docs") == F.col("most")).alias("best"))


def alignment(df: DataFrame, byte_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text",
              hot: int = HOT) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row."""
    rows = aligned_rows(df, byte_path, piece_path, id_col, text_col)
    rows = staged(rows.withColumn("row", F.monotonically_increasing_id()), "aligned")
    counts = staged(pair_counts(rows), "pairs")
    total = counts.agg(F.sum("docs")).first()[0] or 0
    # Fewer than `hot` pairs have more than total / hot rows each.
    known = counts.where(F.col("docs") * hot > total).orderBy("pair").toPandas()
    table = df.sparkSession.sparkContext.broadcast(
        (known["pair"].to_numpy(np.int64), known["docs"].to_numpy(np.int64), known["best"].to_numpy(bool)))

    def look_up(batch: pa.RecordBatch):
        """Row of each (row, pair) of a batch, its pair, times, place in the table and whether it is there."""
        lists = batch.column("pairs")
        size = np.diff(lists.offsets.to_numpy())
        pair, times = lists.flatten().to_numpy(), batch.column("times").flatten().to_numpy()
        keys = table.value[0]
        place = np.minimum(np.searchsorted(keys, pair), max(0, len(keys) - 1))
        hit = keys[place] == pair if len(keys) else np.zeros(len(pair), bool)
        return np.repeat(np.arange(batch.num_rows), size), pair, times, place, hit

    def known_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, docs, best = table.value
        for batch in batches:
            doc, _, times, place, hit = look_up(batch)
            out = []
            for value in (best, docs):
                sums = np.zeros(batch.num_rows, np.int64)
                np.add.at(sums, doc[hit], times[hit] * value[place[hit]])
                out.append(pa.array(sums))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], *out], [*batch.schema.names[:-2], "n_best", "count_sum"])

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, pair, times, _, hit = look_up(batch)
            row = batch.column("row").to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(row[doc[~hit]]), pa.array(pair[~hit]), pa.array(times[~hit])],
                                             ["row", "pair", "times"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    figures = ", ".join(f"{c} long" for c in FIGURES)
    main = rows.select("doc_id", *FIGURES, "groups_sha256", "row", "pairs", "times").mapInArrow(
        known_sums, f"doc_id {kind}, {figures}, groups_sha256 string, row long, n_best long, count_sum long")
    rare = (rows.select("row", "pairs", "times").mapInArrow(others, "row long, pair long, times long")
            .join(counts.where(F.col("docs") * hot <= total), "pair")
            .groupBy("row").agg(F.sum(F.col("times") * F.col("best").cast("long")).alias("best_"),
                                F.sum(F.col("times") * F.col("docs")).alias("count_")))
    none = F.lit(0).cast("long")
    return main.join(rare, "row", "left").select(
        "doc_id", *FIGURES, (F.col("n_best") + F.coalesce("best_", none)).alias("n_best"),
        (F.col("count_sum") + F.coalesce("count_", none)).alias("count_sum"), "groups_sha256")
