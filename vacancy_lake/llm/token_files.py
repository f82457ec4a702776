"""Token ids on disk, compressed by Re-Pair grammars with random access to documents.

Documents are put in ascending order of id: quantiles of the ids cut them into shards, one task each, sorted within.
A shard is a row of blocks of about BLOCK ids. In a block the frequent pairs of adjacent ids are replaced by new
symbols, again and again, until no pair is left whose replacement makes the block smaller (Re-Pair; each turn replaces
many frequent pairs at once, the more frequent first where two overlap). Pairs never cross the end of a document, so each document is a slice of the block's symbols. A block stores
the rules, the expanded length of each rule, the symbols in byte planes, and where documents start among the symbols
and among the ids: one document is decoded from its own slice. Blocks are Parquet records, so a lost executor or a
half-written file is Spark's to repair, and any store that Spark reaches will do.

Ids come from the tokenizers library. It is called for distinct chunks only (the pieces between which its pattern
always breaks), and each worker keeps those it has seen.

Defined results: null is the empty text, which is just its end id; null ids come first; rows repeated under one id are
separate documents, in the order of a hash of their texts.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from .bpe import CHUNK, ids_by_part, slices
from .common import staged, tasks_for

END = 2
BLOCK = 1 << 20
ROWS_PER_SHARD = 4096
#: Shards up to which cuts are quantiles held in the plan; above, Spark's range exchange draws them.
MOST_CUTS = 512
CACHED = 1_400_000
#: Bytes of texts whose parts are looked up together.
SLICE = 8 << 20
#: Blocks up to this number have their starts broadcast (16 bytes each); more are joined by a shuffle.
BROADCAST_ROWS = 200_000
#: Places from which on a pair is worth a rule: a rule is two numbers long, and each place saves one.
LEAST_COUNT = 3
TABLE_BITS = 20


class LibraryIds:
    """Ids of texts from the tokenizers library, piece by piece.

    Texts are cut where the library's pattern always breaks. Where blanks and line breaks stand alone these are the
    `parts` between them, each looked up once for all texts of a call; texts with other runs of white space and with
    special tokens are cut by CHUNK. The table holds ids of parts less the punctuation behind a word, where the
    pattern breaks as well.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        byte_level = spec["normalizer"] is None and spec["pre_tokenizer"] == {
            "type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
        #: Bytes of each id, where the ids of a text stand for its bytes.
        self.bytes_of = None
        if byte_level:
            vocab = spec["model"]["vocab"]
            self.bytes_of = np.zeros(max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]) + 1, np.int64)
            self.bytes_of[list(vocab.values())] = list(map(len, vocab))
        self.special = {t["content"]: self.ids(t["content"]) for t in spec["added_tokens"]}
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")").split \
            if self.special else lambda text: [text]
        self.line = self.ids("\n")
        self.clear()

    def clear(self) -> None:
        self.table, self.marks = {"\n": self.line}, {"": b""}

    def ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def runs(self, parts: list[str]) -> list[bytes]:
        """Ids of parts, many in one call: a part ends where the bytes of the ids so far are those of the parts so far."""
        out = []
        for at in range(0, len(parts), 2000):
            some = [p if p[0] == "\n" else " " + p for p in parts[at:at + 2000]]
            text = "".join(some)
            if self.bytes_of is not None and len(self.split(text)) == 1:
                ids = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")
                ends = np.cumsum(self.bytes_of[ids])
                want = np.cumsum([len(p) if p.isascii() else len(p.encode()) for p in some])
                cuts = np.searchsorted(ends, want)
                if ends[-1] == want[-1] and (ends[cuts] == want).all():
                    raw, cuts = ids.tobytes(), (4 * cuts + 4).tolist()
                    out.extend(raw[a:b] for a, b in zip([0, *cuts], cuts))
                    continue
            out.extend(self.line + self.ids(p[1:]) if p[0] == "\n" else self.ids(p) for p in some)
        return out

    def looked_up(self, parts: list[str]) -> list[bytes | None]:
        """Ids of distinct parts, as `ids_by_part` has them; None marks a part that only CHUNK can cut."""
        found = list(map(self.table.get, parts))
        fresh = [i for i, ids in enumerate(found) if ids is None]
        fresh = [i for i in fresh if (p := parts[i].removeprefix("\n")) and not p[0].isspace() and not p[-1].isspace()]
        for i, ids in zip(fresh, self.runs([parts[i] for i in fresh])):
            found[i] = self.table[parts[i]] = ids
        return found

    def mark_ids(self, mark: str) -> bytes:
        if mark not in self.marks:
            self.marks[mark] = self.ids(mark)
        return self.marks[mark]

    def by_chunk(self, text: str) -> bytes:
        return b"".join(self.special[p] if p in self.special else b"".join(map(self.ids, CHUNK.findall(p)))
                        for p in self.split(text))

    def encode(self, texts: list[str | None] | pa.Array) -> list[bytes]:
        if len(self.table) > CACHED:
            self.clear()
        texts = pc.fill_null(pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string()), "")
        if not len(texts):
            return []
        odd = pc.match_substring(texts, "\n\n")
        for token in self.special:
            odd = pc.or_(odd, pc.match_substring(texts, token))
        found = ids_by_part(pc.if_else(odd, "", texts), self.line, self.looked_up, self.mark_ids)
        return [self.by_chunk(texts[i].as_py()) if other or ids is None else ids
                for i, (other, ids) in enumerate(zip(odd.to_pylist(), found))]


@lru_cache(2)
def library(path: str) -> LibraryIds:
    return LibraryIds(path)


def _replaceable(at: np.ndarray, own: np.ndarray, none: int) -> np.ndarray:
    """Which of the places `at`, in order, with their ranks, are replaced: no neighbour ranks before it; in a row of equal
    pairs every other one."""
    beside = at[1:] - at[:-1] == 1
    before, after = np.full(len(at), none, np.int32), np.full(len(at), none, np.int32)
    np.copyto(before[1:], own[:-1], where=beside)
    np.copyto(after[:-1], own[1:], where=beside)
    good = own <= before
    good &= own <= after
    same = np.flatnonzero(good & (own == before))
    if len(same):
        first = np.flatnonzero(own != before)
        odd = (same - first[np.searchsorted(first, same, "right") - 1]) & 1
        good[same[odd == 1]] = False
    return np.flatnonzero(good)


def _paired(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return left.astype(np.uint64) << np.uint64(32) | right


def compress(ids: np.ndarray, ends: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rules, symbols, start of each document among the symbols) of ids; `ends` are the last places of documents.

    A turn replaces all pairs that are left with LEAST_COUNT places, the more frequent first where two overlap. The first
    turns count pairs in a table of hashed pairs; of pairs that share an entry the one met last has its turn, the others
    another time, as each turn hashes otherwise. When that brings little, pairs are counted by sorting, and turns go on until
    no pair is left whose replacement makes the block smaller.

    A new rule makes pairs with its own symbol only, so a pair of older symbols never gains a place. One met with fewer
    than LEAST_COUNT is not counted again: a turn looks at the open places alone, those of other pairs.
    """
    symbols, shut, is_open = ids.astype(np.uint32), np.uint32(1 << 31), np.uint32(1 << 30)
    symbols |= is_open
    symbols[ends] ^= is_open | shut  # the last symbol of a document begins no pair
    plain = is_open - np.uint32(1)
    rules, none, sort, seed = [], np.int32(1 << 30), False, 1
    while len(symbols) > 1:
        at = np.flatnonzero(symbols.view(np.int32) >= np.int32(is_open))  # those shut are negative
        left, right = symbols.take(at) & plain, symbols.take(at + 1) & plain
        if sort:
            pairs, entry, counts = np.unique(_paired(left, right), return_inverse=True, return_counts=True)
        else:
            bits = min(TABLE_BITS, max(10, len(at).bit_length() + 1))
            entry = (left * np.uint32(0x9E3779B1 * seed & 0xFFFFFFFF | 1) ^ right * np.uint32(0x85EBCA77 * seed & 0xFFFFFFFF | 1))
            entry, seed = (entry >> np.uint32(32 - bits)).astype(np.intp), seed + 2
            counts = np.bincount(entry, minlength=1 << bits)
        top = np.flatnonzero(counts >= LEAST_COUNT)
        most = counts[top].max(initial=0)
        top = top[np.argsort((most - counts[top]).astype(np.uint16 if most < 1 << 16 else np.int64), kind="stable")]
        rank = np.full(len(counts), none, np.int32)
        rank[top] = np.arange(len(top))
        own = rank.take(entry)
        # An entry counts one pair at least, so pairs of rarer entries are out of question.
        rare = np.flatnonzero(own == none)
        symbols[at.take(rare)] = left.take(rare)
        known = np.flatnonzero(own < none)
        at, own, pair = at.take(known), own.take(known), _paired(left.take(known), right.take(known))
        named = np.zeros(len(top), np.uint64)
        named[own] = pair
        known = np.flatnonzero(named.take(own) == pair)
        at, own = at.take(known), own.take(known)
        found = _replaceable(at, own, none)
        at, own = at.take(found), own.take(found)
        # A pair that gave way to its neighbours nearly everywhere waits for another turn.
        hit = np.bincount(own, minlength=len(top)) >= LEAST_COUNT
        known = np.flatnonzero(hit.take(own))
        at, own = at.take(known), own.take(known)
        if len(at):
            number = (base - 1 + np.cumsum(hit)).astype(np.uint32)
            found = named[hit]
            rules.append(np.stack([found >> np.uint64(32), found & np.uint64(0xFFFFFFFF)], 1).astype(np.int64))
            # What ends a document stays shut, all else with a new neighbour is open.
            last = symbols.take(at + 1) & shut
            symbols[at] = number.take(own) | last | (~last >> np.uint32(1) & is_open)
            before = at[int(at[0] == 0):] - 1
            last = symbols.take(before)
            symbols[before] = last | (~last >> np.uint32(1) & is_open)
            base += int(hit.sum())
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            symbols = symbols[keep] if len(at) < len(symbols) // 16 else symbols.take(np.flatnonzero(keep))
        elif sort:
            break
        sort = sort or len(at) <= len(symbols) // 200
    starts = np.append(0, np.flatnonzero(symbols & shut) + 1)[:-1]
    return np.concatenate([*rules, np.zeros((0, 2), np.int64)]), symbols & plain, starts


def planes(values: np.ndarray) -> bytes:
    """Numbers below 2^24 as three planes of bytes, which compress better apart."""
    raw = values.astype("<u4").view(np.uint8).reshape(-1, 4)
    return np.ascontiguousarray(raw[:, :3].T).tobytes()


def from_planes(raw: bytes) -> np.ndarray:
    part = np.frombuffer(raw, np.uint8).reshape(3, -1)
    out = np.zeros((part.shape[1], 4), np.uint8)
    out[:, :3] = part.T
    return out.view("<u4")[:, 0]


def levels(rules: np.ndarray, base: int) -> Iterator[np.ndarray]:
    """Rules in order, as many at a time as are made of earlier ones alone."""
    newest, at = np.maximum.accumulate(rules.max(1).astype(np.int64)) - base, 0
    while at < len(rules):
        end = int(np.searchsorted(newest, at))
        yield rules[at:end]
        at = end


def expanded(rules: np.ndarray, base: int) -> pa.Array:
    """Ids of every symbol as bytes: of the ids themselves, then of the rules, each from two earlier symbols."""
    at, ids = np.arange(base + 1, dtype=np.int64) * 4, np.arange(base, dtype="<u4")
    table = pa.LargeBinaryArray.from_buffers(pa.large_binary(), base, [None, pa.py_buffer(at), pa.py_buffer(ids)])
    for some in levels(rules, base) if len(rules) else ():
        left, right = (table.take(pa.array(np.ascontiguousarray(some[:, k]))) for k in (0, 1))
        table = pa.concat_arrays([table, pc.binary_join_element_wise(left, right, pa.scalar(b"", pa.large_binary()))])
    return table


def expansions(rules: np.ndarray, base: int) -> list[bytes]:
    """The same as a list."""
    return expanded(rules, base).to_pylist()


BLOCKS = ("shard int, block int, base int, doc_ids array<{kind}>, rules binary, rule_lengths array<int>, symbols binary, "
          "symbol_starts array<int>, id_starts array<int>, n_ids long")


def write(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end: int = END) -> DataFrame:
    """Blocks of all documents, written to the shared folder and opened again."""
    kind = df.schema[id_col].dataType.simpleString()
    n = tasks_for(df.count(), ROWS_PER_SHARD)
    # The number of cuts below an id, from the ids alone; a range exchange would read all texts once more to sample ids.
    cuts = sorted(set(df.approxQuantile(id_col, [i / n for i in range(1, n)], 0.1 / n))) if 1 < n <= MOST_CUTS else []
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    if n > MOST_CUTS:
        rows = rows.repartitionByRange(n, "doc_id")
    elif cuts:
        at = F.array(*map(F.lit, cuts))
        below = F.aggregate(at, F.lit(0), lambda k, c: k + (c < F.col("doc_id")).cast("int"))
        rows = rows.repartitionById(len(cuts) + 1, F.coalesce(below, F.lit(0)))
    else:
        rows = rows.coalesce(1)
    rows = rows.sortWithinPartitions("doc_id", F.xxhash64("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        ids_of, shard, block = library(path), TaskContext.get().partitionId(), 0
        base = max(ids_of.tokenizer.get_vocab_size(True), end + 1)
        docs, coded, held = [], [], 0
        last = np.uint32(end).tobytes()

        def flush() -> pa.RecordBatch:
            n_ids = np.array([len(c) // 4 for c in coded])
            id_starts = np.cumsum(n_ids) - n_ids
            ids = np.frombuffer(b"".join(coded), "<u4")
            rules, symbols, starts = compress(ids, np.cumsum(n_ids) - 1, base)
            lengths = np.ones(base, np.int64)
            for some in levels(rules, base) if len(rules) else ():
                lengths = np.append(lengths, lengths[some].sum(1))
            one = lambda x, t: pa.array([x], t)
            i32 = pa.list_(pa.int32())
            return pa.RecordBatch.from_arrays(
                [one(shard, pa.int32()), one(block, pa.int32()), one(base, pa.int32()), one(docs, pa.list_(doc_type)),
                 one(planes(rules.reshape(-1)), pa.binary()), one(lengths[base:], i32), one(planes(symbols), pa.binary()),
                 one(starts, i32), one(id_starts, i32), one(int(n_ids.sum()), pa.int64())],
                ["shard", "block", "base", "doc_ids", "rules", "rule_lengths", "symbols", "symbol_starts", "id_starts", "n_ids"])

        doc_type = None
        for batch in batches:
            doc_type = batch.schema.field(0).type
            for part in slices(batch, SLICE):
                for doc, raw in zip(part.column(0).to_pylist(), ids_of.encode(part.column(1))):
                    docs.append(doc)
                    coded.append(raw + last)
                    held += len(raw) // 4 + 1
                    if held >= BLOCK:
                        yield flush()
                        docs, coded, held, block = [], [], 0, block + 1
        if docs:
            yield flush()

    return staged(rows.mapInArrow(run, BLOCKS.format(kind=kind)), "token-files")


def read(blocks: DataFrame) -> DataFrame:
    """(shard, block, doc_id, first id in the block, n_tokens, ids_crc32) of all documents, from the files."""
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc_type = None
        for batch in batches:
            doc_type = doc_type or batch.schema.field("doc_ids").type.value_type
            for i in range(batch.num_rows):
                r = batch.slice(i, 1).to_pylist()[0]
                found = list(documents_of(r))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["shard"]] * len(found), pa.int32()), pa.array([r["block"]] * len(found), pa.int32()),
                     pa.array([f[1] for f in found], doc_type), pa.array([f[3] for f in found], pa.int64()),
                     pa.array([len(f[2]) // 4 for f in found], pa.int64()),
                     pa.array([zlib.crc32(f[2]) for f in found], pa.int64())],
                    ["shard", "block", "doc_id", "first", "n_tokens", "ids_crc32"])

    # The lengths of rules serve those who look for a place within a document.
    return blocks.drop("rule_lengths", "n_ids").mapInArrow(rows, f"shard int, block int, doc_id {kind}, first long, n_tokens long, ids_crc32 long")


def documents_of(block: dict, places: list[int] | None = None) -> Iterator[tuple[int, object, bytes, int]]:
    """(place, doc_id, ids as bytes, first id in the block); of the wanted places only, from their slices alone."""
    table = expanded(from_planes(block["rules"]).reshape(-1, 2), block["base"])
    symbols, places = from_planes(block["symbols"]), range(len(block["doc_ids"])) if places is None else places
    cuts = [*block["symbol_starts"], len(symbols)]
    found = [symbols[cuts[i]:cuts[i + 1]] for i in places]
    ids = table.take(pa.array(np.concatenate([*found, symbols[:0]])))
    at = np.frombuffer(ids.buffers()[1], np.int64)[np.cumsum([0, *map(len, found)])].tolist()
    raw = memoryview(ids.buffers()[2] or b"")
    for i, a, b in zip(places, at, at[1:]):
        yield i, block["doc_ids"][i], raw[a:b].tobytes(), block["id_starts"][i]


def starts(blocks: DataFrame, group: int = 4096) -> DataFrame:
    """(shard, block, start): ids before each block, by running sums over groups of shards, shards, and blocks."""
    def running(df: DataFrame, by: list[str], order: str, n: str, out: str) -> DataFrame:
        w = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
        return df.withColumn(out, F.coalesce(F.sum(n).over(w.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))

    sizes = blocks.select("shard", "block", "n_ids", F.floor(F.col("shard") / group).alias("part"))
    shards = sizes.groupBy("part", "shard").agg(F.sum("n_ids").alias("n"))
    parts = running(shards.groupBy("part").agg(F.sum("n").alias("n")), [], "part", "n", "before_part")
    shards = running(shards, ["part"], "shard", "n", "before_shard")
    return (running(sizes, ["part", "shard"], "block", "n_ids", "before_block")
            .join(shards.select("shard", "before_shard"), "shard").join(parts.select("part", "before_part"), "part")
            .select("shard", "block", (F.col("before_part") + F.col("before_shard") + F.col("before_block")).alias("start")))


def listing(blocks: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files."""
    at = staged(starts(blocks), "starts")
    at = F.broadcast(at) if at.count() <= BROADCAST_ROWS else at
    return (read(blocks).join(at, ["shard", "block"])
            .select("doc_id", (F.col("start") + F.col("first")).alias("start"), "n_tokens", "ids_crc32"))
