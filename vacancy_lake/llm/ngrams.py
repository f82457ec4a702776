"""Language-model scores from an n-gram trie in Elias-Fano form.

The model is an interpolated bigram model over words with an end mark, which also stands before the first word:
p(w | h) = (1 - mu) * c(h, w) / c(h) + mu * (c(w) + 0.5) / (N + 0.5 * (V + 1)), with mu = 1 for an unknown h and else,
per class of contexts with about the same count, the share of their tokens that no other token would have predicted.
For every context that is a distribution over the known words and one unknown.

Counting and lookup are one exchange. Texts become blocks of local word numbers, written once. A block sends its
distinct words to word shards and its distinct bigrams to context shards, each with its counts among training texts. A
shard adds the counts of all blocks and sends back to each block what it asked for, in the order it was asked: exact
counts of words, one-byte codes of bigrams. No model is ever whole on one machine, and what travels grows with the
distinct words and bigrams of blocks only.

A context shard is a trie of two levels in a memory-mapped file: contexts (hashes, Elias-Fano), monotone pointers to
their successors (Elias-Fano), successors as 40-bit fingerprints sorted within the context, and the quantised
probabilities, one byte each. A query finds its context, then searches the successors between two pointers. Contexts
with more than a thousandth of all tokens (a thousand at most, so their list may be broadcast) are split over shards by
ranges of successors.

Defined results: null is the empty text, one end token; a null id counts as one to learn from; rows repeated under one
id are scored one by one; without any training text all words are unknown.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .common import lower_words, staged

BLOCK_TOKENS = 2_000_000
WORDS_PER_SHARD = 2_000_000
PAIRS_PER_SHARD = 3_000_000
HOT_SHARE = 1e-3
SPLIT_BITS = 6
PRINT_BITS = 40
#: Hash of the end mark; white space is never a word.
END = xxhash.xxh3_64_intdigest(b"\n")
FLOOR = -9.0  # log10 of the smallest quantised probability


class EliasFano:
    """A monotone sequence in two parts: low bytes as they are, high parts in unary with a count every 64 bits."""

    def __init__(self, arrays: list[np.ndarray], n: int, low_bytes: int):
        self.words, self.before, *self.low = arrays
        self.n, self.low_bytes = n, low_bytes

    @staticmethod
    def build(values: np.ndarray) -> "EliasFano":
        values = values.astype(np.uint64)
        n, top = len(values), int(values[-1]) if len(values) else 0
        b = min(range(9), key=lambda b: n * 8 * b + (top >> 8 * b if b < 8 else 0))
        high = (values >> np.uint64(8 * b) if b < 8 else np.zeros(n, np.uint64)).astype(np.int64)
        bits = np.zeros((int(high[-1]) + n if n else 0) // 64 * 64 + 64, bool)
        bits[high + np.arange(n)] = True
        words = np.packbits(bits, bitorder="little").view(np.uint64)
        before = np.append(0, np.cumsum(np.bitwise_count(words), dtype=np.int64))[:-1]
        low = [(values >> np.uint64(8 * i) & np.uint64(255)).astype(np.uint8) for i in range(b)]
        return EliasFano([words, before, *low], n, b)

    def arrays(self) -> list[np.ndarray]:
        return [self.words, self.before, *self.low]

    def get(self, i: np.ndarray) -> np.ndarray:
        word = np.searchsorted(self.before, i, "right") - 1
        bits, rest, place = self.words[word], i - self.before[word], np.zeros(len(i), np.int64)
        for step in (32, 16, 8, 4, 2, 1):
            ones = np.bitwise_count(bits & np.uint64((1 << step) - 1)).astype(np.int64)
            beyond = rest >= ones
            rest = rest - np.where(beyond, ones, 0)
            bits = np.where(beyond, bits >> np.uint64(step), bits)
            place += np.where(beyond, step, 0)
        out = (word * 64 + place - i).astype(np.uint64) << np.uint64(8 * self.low_bytes) if self.low_bytes < 8 \
            else np.zeros(len(i), np.uint64)
        for k, low in enumerate(self.low):
            out |= low[i].astype(np.uint64) << np.uint64(8 * k)
        return out

    def find(self, x: np.ndarray) -> np.ndarray:
        """Place of the first value that is x or more, by halving."""
        lo, hi = np.zeros(len(x), np.int64), np.full(len(x), self.n, np.int64)
        return bisect(lambda i: self.get(i), lo, hi, x)


def bisect(get, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Per entry the first place in lo .. hi whose value is x or more."""
    lo, hi = lo.copy(), hi.copy()
    live = np.flatnonzero(lo < hi)
    while len(live):
        mid = (lo[live] + hi[live]) >> 1
        less = get(mid) < x[live]
        lo[live[less]], hi[live[~less]] = mid[less] + 1, mid[~less]
        live = live[lo[live] < hi[live]]
    return lo


def quantise(log10_p: np.ndarray) -> np.ndarray:
    """1 .. 255, rounded down, so that probabilities never add up to more; 255 is certainty, 0 is left for unseen."""
    return (1 + np.clip(np.floor(254 * (1 - log10_p / FLOOR) + 1e-9), 0, 254)).astype(np.uint8)


def restore(codes: np.ndarray) -> np.ndarray:
    return np.where(codes > 0, 10.0 ** (FLOOR * (1 - (codes.astype(np.float64) - 1) / 254)), 0.0)


class Trie:
    """Contexts, pointers, successors and codes; opened from a memory-mapped file."""

    def __init__(self, contexts: EliasFano, pointers: EliasFano, successors: list[np.ndarray], codes: np.ndarray):
        self.contexts, self.pointers, self.successors, self.codes = contexts, pointers, successors, codes

    @staticmethod
    def build(contexts: np.ndarray, sizes: np.ndarray, prints: np.ndarray, codes: np.ndarray) -> "Trie":
        planes = [(prints & np.uint64(0xFFFFFFFF)).astype(np.uint32), (prints >> np.uint64(32)).astype(np.uint8)]
        return Trie(EliasFano.build(contexts), EliasFano.build(np.append(0, np.cumsum(sizes))), planes, codes)

    @contextmanager
    def mapped(self) -> Iterator["Trie"]:
        """The same trie read from a file of this task, which goes with the mapping."""
        parts = [self.contexts.arrays(), self.pointers.arrays(), self.successors, [self.codes]]
        with tempfile.NamedTemporaryFile(delete=False) as f:
            places = []
            for x in (x for part in parts for x in part):
                f.write(bytes(-f.tell() % 8))
                places.append((f.tell(), x.dtype, len(x)))
                f.write(np.ascontiguousarray(x).data)
        try:
            whole = np.memmap(f.name, np.uint8, "r")
            views = iter([whole[at:at + n * d.itemsize].view(d) for at, d, n in places])
            a, b, c, d = ([next(views) for _ in part] for part in parts)
            yield Trie(EliasFano(a, self.contexts.n, self.contexts.low_bytes),
                       EliasFano(b, self.pointers.n, self.pointers.low_bytes), c, d[0])
        finally:
            os.unlink(f.name)

    def lookup(self, contexts: np.ndarray, sizes: np.ndarray, prints: np.ndarray) -> np.ndarray:
        """Codes of bigrams given as contexts with their numbers of successors, and the successors; 0 where there is none."""
        out = np.zeros(len(prints), np.uint8)
        if not self.contexts.n:
            return out
        at = np.minimum(self.contexts.find(contexts), self.contexts.n - 1)
        begin, end = (self.pointers.get(at + i).astype(np.int64) for i in (0, 1))
        end = np.where(self.contexts.get(at) == contexts, end, begin)  # an unknown context has no successors
        begin, end = np.repeat(begin, sizes), np.repeat(end, sizes)
        low, high = self.successors
        value = lambda i: low[i].astype(np.uint64) | high[i].astype(np.uint64) << np.uint64(32)
        place = bisect(value, begin, end, prints)
        there = np.flatnonzero(place < end)
        there = there[value(place[there]) == prints[there]]
        out[there] = self.codes[place[there]]
        return out


class Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


BLOCKS = ("block long, doc_ids array<{kind}>, held array<boolean>, sizes array<int>, vocabulary binary, tokens binary, "
          "n_words long, n_tokens long")


def blocks_of(df: DataFrame, id_col: str, text_col: str, held: Column) -> DataFrame:
    """Texts as numbers into the block's own sorted word hashes; an end mark closes each text."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, seq, doc_type = TaskContext.get().partitionId(), 0, None
        docs, flags, tokens, numbers, total = [], [], [], Numbers({b"\n": 0}), 0

        def flush() -> pa.RecordBatch:
            hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, numbers), np.uint64, len(numbers))
            words, place = np.unique(hashes, return_inverse=True)
            flat = place[np.concatenate(tokens)].astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3]
            one = lambda x, t: pa.array([x], t)
            return pa.RecordBatch.from_arrays(
                [one(part << 32 | seq, pa.int64()), one(docs, pa.list_(doc_type)), one(flags, pa.list_(pa.bool_())),
                 one([len(t) for t in tokens], pa.list_(pa.int32())), one(words.tobytes(), pa.binary()),
                 one(np.ascontiguousarray(flat.T).tobytes(), pa.binary()), one(len(words), pa.int64()), one(total, pa.int64())],
                ["block", "doc_ids", "held", "sizes", "vocabulary", "tokens", "n_words", "n_tokens"])

        for batch in batches:
            doc_type = batch.schema.field(0).type
            for doc, flag, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(1)):
                found = lower_words(text.as_py())
                found.append(b"\n")
                docs.append(doc)
                flags.append(flag)
                tokens.append(np.fromiter(map(numbers.__getitem__, found), np.int32, len(found)))
                total += len(found)
                if total >= BLOCK_TOKENS:
                    yield flush()
                    docs, flags, tokens, numbers, total, seq = [], [], [], Numbers({b"\n": 0}), 0, seq + 1
        if docs:
            yield flush()

    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.coalesce(held, F.lit(False)).alias("held"))
    return rows.mapInArrow(run, BLOCKS.format(kind=kind))


class Block:
    """A block opened: hashes, tokens, and its distinct bigrams in the order of (context hash, word hash)."""

    def __init__(self, vocabulary: bytes, tokens: bytes, sizes, held):
        self.words = np.frombuffer(vocabulary, np.uint64)
        planes = np.frombuffer(tokens, np.uint8).reshape(3, -1).astype(np.int64)
        self.tokens = planes[0] | planes[1] << 8 | planes[2] << 16
        self.sizes = np.asarray(sizes, np.int64)
        self.learn = np.repeat(~np.asarray(held, bool), self.sizes)

    def bigrams(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(local context, local word, count among training texts) of distinct bigrams, and the bigram of each token."""
        before = np.append(0, self.tokens[:-1])
        before[np.cumsum(self.sizes) - self.sizes] = np.searchsorted(self.words, np.uint64(END))
        codes, place = np.unique(before << 24 | self.tokens, return_inverse=True)
        return codes >> 24, codes & 0xFFFFFF, np.bincount(place[self.learn], minlength=len(codes)), place


def prints_of(hashes: np.ndarray) -> np.ndarray:
    return hashes >> np.uint64(64 - PRINT_BITS)


def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Ranges of hashes, so that sorted hashes fall into shards one after the other."""
    return ((hashes >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def _runs(keys: np.ndarray) -> Iterator[tuple[int, int]]:
    cuts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return zip(cuts.tolist(), [*cuts[1:].tolist(), len(keys)])


def word_counts(blocks: DataFrame, shards: int) -> DataFrame:
    """kind 0: counts of a block's words from place `a` on; kind 1: N and V of a shard; kind 2: its commonest words."""
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                b = Block(r["vocabulary"], r["tokens"], r["sizes"], r["held"])
                counts = np.bincount(b.tokens[b.learn], minlength=len(b.words))
                to = shard_of(b.words, shards)
                rows = [(int(to[a]), r["block"], a, b.words[a:z].tobytes(), counts[a:z].astype("<u4").tobytes())
                        for a, z in _runs(to)]
                yield pa.RecordBatch.from_pylist([dict(zip(("shard", "block", "a", "words", "counts"), row)) for row in rows], sent)

    def answer(pdf: pd.DataFrame) -> pd.DataFrame:
        words = np.concatenate([np.frombuffer(w, np.uint64) for w in pdf["words"]])
        counts = np.concatenate([np.frombuffer(c, "<u4") for c in pdf["counts"]])
        known, place = np.unique(words, return_inverse=True)
        total = np.bincount(place, counts, len(known)).astype(np.int64)
        rows, at = [], 0
        for block, a, w in zip(pdf["block"], pdf["a"], pdf["words"]):
            n = len(w) // 8
            rows.append((0, block, a, total[place[at:at + n]].astype("<u8").tobytes(), 0, 0))
            at += n
        rows.append((1, 0, 0, None, int(total.sum()), int((total > 0).sum())))
        for i in np.argsort(-total, kind="stable")[:int(1 / HOT_SHARE)]:
            rows.append((2, 0, 0, None, int(known[i].view(np.int64)), int(total[i])))
        return pd.DataFrame(rows, columns=["kind", "block", "a", "counts", "x", "n"])

    sent = pa.schema([("shard", pa.int32()), ("block", pa.int64()), ("a", pa.int64()), ("words", pa.binary()), ("counts", pa.binary())])
    asked = blocks.select("block", "vocabulary", "tokens", "sizes", "held").mapInArrow(
        ask, "shard int, block long, a long, words binary, counts binary")
    return asked.groupBy("shard").applyInPandas(answer, "kind int, block long, a long, counts binary, x long, n long")


def destinations(b: Block, context: np.ndarray, word: np.ndarray, shards: int, hot: np.ndarray) -> np.ndarray:
    """Shard of each bigram: of its context, and for a hot context of the range of its successor as well."""
    hashes = b.words[context]
    to = shard_of(hashes, shards)
    split = np.isin(hashes, hot)
    ranges = prints_of(b.words[word[split]]) >> np.uint64(PRINT_BITS - SPLIT_BITS)
    to[split] = (to[split] + 1 + ranges.astype(np.int64)) % shards
    return to.astype(np.uint16) if shards < 1 << 16 else to  # short numbers sort faster


def bigram_codes(blocks: DataFrame, shards: int, hot: np.ndarray, hot_counts: np.ndarray) -> DataFrame:
    """kind 0: codes of a block's bigrams from place `a` on in the order of their shards; kind 1: per class of contexts, tokens seen once and all."""
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                b = Block(r["vocabulary"], r["tokens"], r["sizes"], r["held"])
                context, word, counts, _ = b.bigrams()
                to = destinations(b, context, word, shards, hot)
                order = np.argsort(to, kind="stable")
                to, context, word, counts, rows = to[order], context[order], word[order], counts[order], []
                for a, z in _runs(to):
                    first = np.flatnonzero(np.append(True, context[a + 1:z] != context[a:z - 1]))
                    low = prints_of(b.words[word[a:z]]).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]
                    rows.append({"shard": int(to[a]), "block": r["block"], "a": a,
                                 "contexts": b.words[context[a:z][first]].tobytes(),
                                 "sizes": np.diff(np.append(first, z - a)).astype("<u4").tobytes(),
                                 "prints": low.tobytes(), "counts": counts[a:z].astype("<u4").tobytes()})
                yield pa.RecordBatch.from_pylist(rows, sent)

    def answer(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = []
        for c, s, p, n in zip(pdf["contexts"], pdf["sizes"], pdf["prints"], pdf["counts"]):
            low = np.zeros((len(p) // 5, 8), np.uint8)
            low[:, :5] = np.frombuffer(p, np.uint8).reshape(-1, 5)
            parts.append((np.frombuffer(c, np.uint64), np.frombuffer(s, "<u4").astype(np.int64), low.view("<u8")[:, 0],
                          np.frombuffer(n, "<u4")))
        known = np.unique(np.concatenate([p[0] for p in parts]))
        keys = np.concatenate([np.repeat(np.searchsorted(known, c).astype(np.uint64), s) << np.uint64(PRINT_BITS) | p
                               for c, s, p, _ in parts])
        keys, place = np.unique(keys, return_inverse=True)
        counts = np.bincount(place, np.concatenate([p[3] for p in parts]), len(keys)).astype(np.int64)
        seen = counts > 0
        of = (keys >> np.uint64(PRINT_BITS)).astype(np.int64)
        total = np.bincount(of, counts, len(known)).astype(np.int64)
        at = np.searchsorted(hot, known)
        is_hot = (at < len(hot)) & (hot[np.minimum(at, max(0, len(hot) - 1))] == known) if len(hot) else np.zeros(len(known), bool)
        whole = total.copy()
        whole[is_hot] = hot_counts[at[is_hot]]
        classes = class_of(whole)[of]
        rows = [(1, 0, int(k), None, int((counts[(classes == k)] == 1).sum()), int(counts[classes == k].sum()))
                for k in np.unique(classes[seen])]
        # The trie holds what training texts have. Asked for is every distinct bigram, those of held-out texts alone included.
        codes = quantise(np.log10(counts[seen] / whole[of[seen]]))
        prints, trained = keys & np.uint64((1 << PRINT_BITS) - 1), total > 0
        held = np.bincount(of[seen], minlength=len(known))[trained]
        with Trie.build(known[trained], held, prints[seen], codes).mapped() as trie:
            found = trie.lookup(known, np.bincount(of, minlength=len(known)), prints)[place]
        ends = np.cumsum([len(p[2]) for p in parts])
        for block, a, (_, _, p, _), end in zip(pdf["block"], pdf["a"], parts, ends.tolist()):
            rows.append((0, block, a, found[end - len(p):end].tobytes(), 0, 0))
        return pd.DataFrame(rows, columns=["kind", "block", "a", "codes", "once", "n"])

    sent = pa.schema([("shard", pa.int32()), ("block", pa.int64()), ("a", pa.int64()), ("contexts", pa.binary()),
                      ("sizes", pa.binary()), ("prints", pa.binary()), ("counts", pa.binary())])
    asked = blocks.select("block", "vocabulary", "tokens", "sizes", "held").mapInArrow(
        ask, "shard int, block long, a long, contexts binary, sizes binary, prints binary, counts binary")
    return asked.groupBy("shard").applyInPandas(answer, "kind int, block long, a long, codes binary, once long, n long")


def class_of(counts: np.ndarray) -> np.ndarray:
    """Classes of contexts: the number of binary digits of their count."""
    return np.frexp(np.asarray(counts, np.float64))[1]


def scores(df: DataFrame, held: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row; `held` texts are not learnt."""
    kind = df.schema[id_col].dataType.simpleString()
    blocks = staged(blocks_of(df, id_col, text_col, held), "blocks")
    size = blocks.agg(F.sum("n_words").alias("words"), F.sum("n_tokens").alias("tokens")).head()
    shards = lambda n, each: max(1, -(-(n or 0) // each))
    of_words = staged(word_counts(blocks, shards(size["words"], WORDS_PER_SHARD)), "words")
    sums = of_words.where("kind = 1").agg(F.sum("x").alias("n"), F.sum("n").alias("v")).head()
    n_all, n_distinct = sums["n"] or 0, sums["v"] or 0
    common = of_words.where("kind = 2").where(F.col("n") > max(1, HOT_SHARE * n_all)).select("x", "n").collect()
    hot = np.array([r["x"] for r in common], np.int64).view(np.uint64)
    turn = np.argsort(hot)
    hot, hot_counts = hot[turn], np.array([r["n"] for r in common], np.int64)[turn]
    pair_shards = shards(size["tokens"], PAIRS_PER_SHARD)
    of_pairs = staged(bigram_codes(blocks, pair_shards, hot, hot_counts), "bigrams")
    mu = np.ones(80)
    for r in of_pairs.where("kind = 1").groupBy("a").agg(F.sum("once").alias("once"), F.sum("n").alias("n")).collect():
        mu[r["a"]] = (r["once"] + 1.0) / (r["n"] + 2.0)
    mu[0] = 1.0

    def score(asked: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        out = []
        for r in asked.itertuples(index=False):
            b = Block(r.vocabulary, r.tokens, r.sizes, r.held)
            context, word, _, place = b.bigrams()
            order = np.argsort(destinations(b, context, word, pair_shards, hot), kind="stable")
            counts, codes = np.zeros(len(b.words), np.int64), np.zeros(len(context), np.uint8)
            for a, raw in zip(replies["a"], replies["reply"]):
                found = np.frombuffer(raw, np.uint8 if a & 1 else "<u8")
                if a & 1:
                    codes[order[a >> 1:(a >> 1) + len(found)]] = found
                else:
                    counts[a >> 1:(a >> 1) + len(found)] = found
            unigram = (counts + 0.5) / (n_all + 0.5 * (n_distinct + 1))
            share = mu[class_of(counts)]
            p = np.log10((1 - share[context]) * restore(codes) + share[context] * unigram[word])
            starts = np.cumsum(b.sizes) - b.sizes
            out.append(pd.DataFrame({
                "doc_id": pd.Series(list(r.doc_ids), dtype=object), "held_out": r.held, "n_tokens": b.sizes,
                "n_known": np.add.reduceat((counts > 0)[b.tokens].astype(np.int64), starts), "train_tokens": n_all,
                "base_score": np.add.reduceat(np.log10(unigram)[b.tokens], starts), "score": np.add.reduceat(p[place], starts)}))
        return pd.concat(out) if out else pd.DataFrame(columns=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens",
                                                               "base_score", "score"])

    # Both kinds of replies in one table: the lowest bit of the place tells bigrams from words.
    replies = (of_words.where("kind = 0").select("block", (F.col("a") * 2).alias("a"), F.col("counts").alias("reply"))
               .unionByName(of_pairs.where("kind = 0").select("block", (F.col("a") * 2 + 1).alias("a"), F.col("codes").alias("reply"))))
    return (blocks.select("block", "doc_ids", "held", "sizes", "vocabulary", "tokens").groupBy("block")
            .cogroup(replies.groupBy("block")).applyInPandas(
                score, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"))
