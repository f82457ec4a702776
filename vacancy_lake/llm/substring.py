"""Removal of passages that an earlier document has, with a compressed FM-index per shard.

A window is `window` consecutive words. It goes when its word sequence also starts in a document with a smaller id.

1. Routing. Every window names an anchor: its leftmost k-gram of least hash. Equal windows name equal anchors at equal
   places, so only windows whose anchor occurs in two documents can go, and those with one anchor meet in one shard.
   Anchors are about one word in twenty; only they are shuffled to find the shared ones.
2. Pieces. The windows of one document that name one place form a piece, at most 2 * window - k words. Pieces with
   equal words collapse before the shuffle to the one with the smallest id; in later documents all its windows go. Windows
   of very common anchors are pieces of their own, which collapse the same way and need no search: a window goes where a
   smaller document has an equal piece. So no shard grows with the number of documents around a common passage.
3. FM-index. A shard's distinct pieces form one text of word numbers, whose Burrows-Wheeler transform lies in a wavelet
   matrix (bits with sampled counts) beside the order of documents and a table of range minima. Pieces are streamed
   against it by backward search; a match counts while its range holds a smaller document. A failed search at word p
   rules out all windows that hold the failed match, so the next one starts behind p; a success extends the search to
   longer and longer ends. The result is the matching windows of each piece, that is where the matching statistics reach
   the threshold.

Defined results: null texts have no words; texts shorter than a window lose nothing; a null id is in no order, so its
rows neither lose words nor take any from others; rows repeated under one id do not take from each other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import staged, words
from .minhash import _HASHES, mixed

WINDOW = 50
GRAM = 8
WORDS_PER_SHARD = 400_000
#: Places an anchor may have before its windows become pieces of their own.
COMMON = 5_000
BROADCAST_ROWS = 200_000


#: Whether a byte is white space in the sense of WORD, and the first 0 ... 8 bytes of a number.
BLANK = bytes(i in b" \t\n\v\f\r" for i in range(256))
LOWEST = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)
ODD = np.uint64(0x9E3779B97F4A7C15)


def word_hashes(text: str | None) -> np.ndarray:
    """Hashes of the words; up to 16 bytes are read as two numbers, all words at once, longer words go by the table."""
    raw = b"".join((b" ", (text or "").encode("utf-8", "surrogatepass"), b" " * 17))
    blank = np.frombuffer(raw.translate(BLANK), bool)
    edges = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    start, length = edges[::2], edges[1::2] - edges[::2]
    eight = np.ndarray(len(raw) - 7, "<u8", raw, strides=(1,))
    out = mixed((eight[start] & LOWEST[np.minimum(length, 8)]) + length.astype(np.uint64) * ODD)
    more = np.flatnonzero(length > 8)
    rest = length[more] - 8
    out[more] = mixed(out[more] * ODD + (eight[start[more] + 8] & LOWEST[np.minimum(rest, 8)]))
    for i in more[rest > 8].tolist():
        out[i] = _HASHES[raw[start[i]:start[i] + length[i]]]
    return out


def anchors(h: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(place of the anchor of each window, hash of the k-gram at each place); both from halves that may overlap."""
    grams, width = h, 1
    while width < gram:
        step = min(width, gram - width)
        grams, width = mixed(grams[:-step] * ODD + grams[step:]), width + step
    least, place, width = grams, np.arange(len(grams)), 1
    while width < window - gram + 1:
        step = min(width, window - gram + 1 - width)
        left = least[:-step] <= least[step:]
        place = np.where(left, place[:-step], place[step:])
        least, width = np.minimum(least[:-step], least[step:]), width + step
    return place, grams


def pieces_of(h: np.ndarray, shared: np.ndarray, common: np.ndarray, window: int, gram: int
              ) -> Iterator[tuple[int, int, int, bool]]:
    """(route, first window, number of windows, to be searched) of a text; `shared` sorted hashes, `common` the very common."""
    place, grams = anchors(h, window, gram)
    first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
    count = np.diff(np.append(first, len(place)))
    key = grams[place[first]]
    at = np.searchsorted(shared, key)
    hit = (at < len(shared)) & (shared[np.minimum(at, len(shared) - 1)] == key)
    if not hit.any():
        return
    loaded = np.isin(key, common)
    for i in np.flatnonzero(hit):
        if not loaded[i]:
            yield int(key[i]), int(first[i]), int(count[i]), True
            continue
        for j in range(int(first[i]), int(first[i]) + int(count[i])):
            yield int(key[i]), j, 1, False


class WaveletMatrix:
    """Ranks over numbers below 2^bits: one packed bit vector a level, with a count every 64 bits."""

    def __init__(self, values: np.ndarray, bits: int):
        self.bits, self.n = bits, len(values)
        self.levels = []
        for level in range(bits - 1, -1, -1):
            ones = (values >> level & 1).astype(bool)
            padded = np.zeros((len(ones) // 64 + 1) * 64, bool)
            padded[:len(ones)] = ones
            packed = np.packbits(padded, bitorder="little").view(np.uint64)
            before = np.append(0, np.cumsum(np.bitwise_count(packed), dtype=np.int64))[:-1].astype(np.int32)
            zeros = len(ones) - int(ones.sum())
            self.levels.append((packed, before, zeros, level))
            values = np.concatenate([values[~ones], values[ones]])

    def ranks(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the first `lo` and `hi` occurrences' ends of each symbol, within its own run."""
        start = np.zeros(len(symbol), np.int64)
        for packed, before, zeros, level in self.levels:
            one = (symbol >> level & 1).astype(bool)
            out = []
            for x in (start, lo, hi):
                ones = before[x >> 6] + np.bitwise_count(packed[x >> 6] & ((np.uint64(1) << (x & 63).astype(np.uint64)) - np.uint64(1)))
                out.append(np.where(one, zeros + ones, x - ones))
            start, lo, hi = out
        return lo - start, hi - start


class FmIndex:
    """Pieces of word numbers with their documents; suffixes are sorted to `depth` words, as far as searches go."""

    def __init__(self, text: np.ndarray, docs: np.ndarray, depth: int):
        n = len(text)
        rank, step = text.astype(np.int64), 1
        order = np.argsort(rank, kind="stable")
        while step < 2 * depth:
            ahead = np.zeros(n, np.int64)
            if step < n:
                ahead[:n - step] = rank[step:] + 1
            code = rank * (int(rank.max()) + 2) + ahead
            order = np.argsort(code, kind="stable")
            sorted_code = code[order]
            new = np.empty(n, np.int64)
            new[order] = np.cumsum(np.append(0, sorted_code[1:] != sorted_code[:-1]))
            rank, step = new, 2 * step
            if rank.max() == n - 1:
                break
        bwt = text[order - 1]
        self.n, top = n, int(text.max()) + 1
        self.first = np.searchsorted(text[order], np.arange(top + 1))
        self.wavelet = WaveletMatrix(bwt, max(1, top.bit_length()))
        self.minima = [docs[order]]
        while 2 << len(self.minima) - 1 <= n:
            last, half = self.minima[-1], 1 << len(self.minima) - 1
            self.minima.append(np.minimum(last[:-half], last[half:]))

    def extend(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.wavelet.ranks(symbol, lo, hi)
        return self.first[symbol] + a, self.first[symbol] + b

    def least_document(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Smallest document in non-empty ranges."""
        level = np.frexp((hi - lo).astype(np.float64))[1] - 1
        out = np.empty(len(lo), self.minima[0].dtype)
        for k in np.unique(level):
            at = level == k
            row = self.minima[k]
            out[at] = np.minimum(row[lo[at]], row[hi[at] - (1 << int(k))])
        return out


def matching_windows(index: FmIndex, text: np.ndarray, begin: np.ndarray, length: np.ndarray, doc: np.ndarray, window: int
                     ) -> list[np.ndarray]:
    """Per piece, a flag for each of its windows: does it occur in a smaller document? All pieces advance in step."""
    n = len(begin)
    flags = [np.zeros(m - window + 1, bool) for m in length.tolist()]
    s, gain = np.zeros(n, np.int64), np.zeros(n, np.int64)  # next window to decide; windows that the end lies further
    end = np.full(n, window, np.int64)
    at, lo, hi = end.copy(), np.zeros(n, np.int64), np.full(n, index.n, np.int64)
    live = np.arange(n)
    while len(live):
        x = at[live] - 1
        a, b = index.extend(text[begin[live] + x], lo[live], hi[live])
        good = b > a
        good[good] = index.least_document(a[good], b[good]) < doc[live[good]]
        ok = live[good]
        at[ok], lo[ok], hi[ok] = x[good], a[good], b[good]
        # Matched back to the window in question: all windows up to the end occur. Go on with a further end.
        done = ok[at[ok] == s[ok]]
        failed, where = live[~good], x[~good]
        for i in done.tolist():
            flags[i][s[i]:s[i] + gain[i] + 1] = True
        s[done] += gain[done] + 1
        gain[done] = 2 * gain[done] + 1
        # No match from `where` on. With the nearest end this rules out the windows up to there; else come nearer.
        near = failed[gain[failed] == 0]
        s[near] = where[gain[failed] == 0] + 1
        gain[failed] = 0
        turned = np.concatenate([done, failed])
        room = length[turned] - window - s[turned]
        gain[turned] = np.minimum(gain[turned], np.maximum(room, 0))
        end[turned] = s[turned] + window + gain[turned]
        at[turned], lo[turned], hi[turned] = end[turned], 0, index.n
        live = live[s[live] <= length[live] - window]
    return flags


def _search(pdf: pd.DataFrame, window: int) -> pd.DataFrame:
    """One shard: which windows of each distinct piece occur in a document before its first one."""
    pdf = pdf.sort_values(["doc", "route", "content"])
    parts = [np.frombuffer(w, np.uint64) for w in pdf["words"]]
    length = np.array([len(p) for p in parts])
    _, numbers = np.unique(np.concatenate(parts), return_inverse=True)
    # Each piece behind a separator, which is symbol 0 and never asked for.
    text = np.zeros(len(numbers) + len(parts), np.int64)
    begin = np.cumsum(length + 1) - length
    inside = np.ones(len(text), bool)
    inside[begin - 1] = False
    text[inside] = numbers + 1
    docs = pdf["doc"].to_numpy()
    index = FmIndex(text, np.repeat(docs, length + 1), window)
    flags = matching_windows(index, text, begin, length, docs, window)
    out = [(r, c, np.packbits(f).tobytes()) for r, c, f in zip(pdf["route"], pdf["content"], flags) if f.any()]
    return pd.DataFrame(out, columns=["route", "content", "flags"])


def _ranges(flags: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def repeated_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM
                   ) -> DataFrame:
    """(doc, text_hash, spans array<struct<a, b>>): ranges of words to remove, of documents that lose any."""
    docs = df.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text")).where("doc IS NOT NULL")

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                doc, found, times = [], [], []
                for d, text in zip(part.column(0).to_pylist(), part.column(1)):
                    h = word_hashes(text.as_py())
                    if len(h) >= window:
                        place, grams = anchors(h, window, gram)
                        keys, n = np.unique(grams[np.unique(place)], return_counts=True)
                        found.append(keys)
                        times.append(n)
                        doc.append(np.full(len(keys), d))
                if doc:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(doc)), pa.array(np.concatenate(found).view(np.int64)),
                                                      pa.array(np.concatenate(times))], ["doc", "anchor", "times"])

    marked = staged(docs.mapInArrow(marks, "doc long, anchor long, times long"), "anchors")
    shared = (marked.groupBy("anchor").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi"), F.sum("times").alias("n"))
              .where("lo <> hi").select("anchor", (F.col("n") > COMMON).alias("common")))
    wanted = staged(marked.join(shared, "anchor").groupBy("doc").agg(
        F.sort_array(F.collect_set("anchor")).alias("shared"),
        F.collect_set(F.when(F.col("common"), F.col("anchor"))).alias("common")), "wanted")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["route", "content", "doc", "text_hash", "first", "windows", "words"]
        types = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                rows, sent = [], {}
                for r in batch.slice(at, 200).to_pylist():
                    h = word_hashes(r["text"])
                    if len(h) < window:
                        continue
                    shared = np.sort(np.array(r["shared"], np.int64).view(np.uint64))
                    for route, first, n, search in pieces_of(h, shared, np.array(r["common"], np.int64).view(np.uint64), window, gram):
                        raw = h[first:first + n + window - 1].tobytes()
                        content = hashlib.blake2b(raw, digest_size=12).digest()
                        # Of equal pieces here, only the first document's carries the words.
                        key = (route, content)
                        if not search:
                            raw = None
                        if sent.get(key, 1 << 62) > r["doc"]:
                            sent[key] = r["doc"]
                        rows.append([route - (1 << 64) if route >> 63 else route, content, r["doc"], r["text_hash"], first, n,
                                     raw, key])
                for row in rows:
                    if sent[row[7]] != row[2]:
                        row[6] = None
                yield pa.RecordBatch.from_arrays([pa.array([row[i] for row in rows], t) for i, t in enumerate(types)], names)

    pieces = staged(docs.withColumn("text_hash", F.xxhash64("text")).join(wanted, "doc").select("doc", "text", "text_hash", "shared", "common").mapInArrow(
        cut, "route long, content binary, doc long, text_hash long, first int, windows int, words binary"), "pieces")
    distinct = pieces.groupBy("route", "content").agg(
        F.min("doc").alias("doc"), F.max("doc").alias("last"), F.first("words", ignorenulls=True).alias("words"))
    distinct = staged(distinct.where("words IS NOT NULL OR doc <> last"), "distinct")
    # A route with one document only cannot match anything.
    alive = distinct.where("words IS NOT NULL").groupBy("route").agg(F.min("doc").alias("lo"), F.max("last").alias("hi"),
                                          F.sum(F.length("words")).alias("bytes")).where("lo <> hi")
    alive = staged(alive.select("route", "bytes"), "routes")
    total = alive.agg(F.sum("bytes")).head()[0] or 0
    n_shards = max(1, -(-total // (8 * WORDS_PER_SHARD)))
    searched = (distinct.where("words IS NOT NULL").join(alive, "route").withColumn("shard", F.pmod(F.xxhash64("route"), F.lit(n_shards)))
                .select("shard", "route", "content", "doc", "words")
                .groupBy("shard").applyInPandas(lambda pdf: _search(pdf, window), "route long, content binary, flags binary"))
    first = distinct.select("route", "content", F.col("doc").alias("first_doc"))
    found = first.join(staged(searched, "flags"), ["route", "content"], "left")
    hits = (pieces.drop("words").join(found, ["route", "content"])
            .where((F.col("doc") > F.col("first_doc")) | F.col("flags").isNotNull()))

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, text, a, b = [], [], [], []
            for r in batch.to_pylist():
                flags = np.ones(r["windows"], bool) if r["doc"] > r["first_doc"] else \
                    np.unpackbits(np.frombuffer(r["flags"], np.uint8))[:r["windows"]].astype(bool)
                for lo, hi in _ranges(flags):
                    doc.append(r["doc"])
                    text.append(r["text_hash"])
                    a.append(r["first"] + lo)
                    b.append(r["first"] + hi - 1 + window)
            yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(text, pa.int64()), pa.array(a, pa.int32()),
                                              pa.array(b, pa.int32())], ["doc", "text_hash", "a", "b"])

    return (hits.select("doc", "text_hash", "first", "windows", "first_doc", "flags")
            .mapInArrow(spans, "doc long, text_hash long, a int, b int")
            .groupBy("doc", "text_hash").agg(F.collect_set(F.struct("a", "b")).alias("spans")))


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM
                   ) -> DataFrame:
    """Per row: id, n_words, n_removed, kept (the words that stay, joined by one blank)."""
    return _with_spans(df, id_col, text_col, window, gram, lambda kept: kept, "string", pa.string())


def _with_spans(df, id_col, text_col, window, gram, finish, out_kind, out_type) -> DataFrame:
    lost = staged(repeated_spans(df, id_col, text_col, window, gram), "spans")
    small = lost.count() <= BROADCAST_ROWS
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    same = (F.col("id").cast("long") == F.col("doc")) & (F.xxhash64("text") == F.col("text_hash"))
    rows = rows.join(F.broadcast(lost) if small else lost, same, "left").select("id", "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                n, removed, kept = [], [], []
                for text, spans in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                    found = words(text)
                    stays = np.ones(len(found), bool)
                    for s in spans or ():
                        stays[s["a"]:s["b"]] = False
                    n.append(len(found))
                    removed.append(len(found) - int(stays.sum()))
                    left = found if not spans else [w for w, s in zip(found, stays.tolist()) if s]
                    kept.append(finish(b" ".join(left).decode("utf-8", "surrogatepass")))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
                                                  pa.array(kept, out_type)], ["doc_id", "n_words", "n_removed", "kept"])

    kind = df.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_words long, n_removed long, kept {out_kind}")


def removal_digests(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM
                    ) -> DataFrame:
    """The same with the SHA-256 of what stays instead of the text."""
    sha = lambda kept: hashlib.sha256(kept.encode("utf-8", "surrogatepass")).hexdigest()
    return _with_spans(df, id_col, text_col, window, gram, sha, "string", pa.string()).withColumnRenamed("kept", "kept_sha256")
