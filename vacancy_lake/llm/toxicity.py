"""Toxicity by subword-bag embeddings averaged into a linear softmax.

A word is the mean of the vectors of its character n-grams and of itself, a text the mean of its distinct words, and a linear
softmax reads the text vector. Vectors and softmax are trained jointly with Adagrad in numpy. Misspellings never seen
share most n-grams with words that were. Since everything after the vectors is linear, a trained model is one number
per n-gram bucket: the score of a text is the logistic function of bias + mean over its distinct words of the mean of their
bucket numbers, so scoring a text costs one lookup per word.

Only text is an input of a score. The fit reads a bounded sample: of the labelled rows that `train_on` admits, those
with the smallest hash of text, at most `per_class` of each label; the bias is then corrected to the label shares of
all admitted rows. Scoring reads every row and the whole text.

Defined results: null or empty text scores by the bias alone; without a label of each kind everything scores 0.
Rows of `labels` with null ids or labels are not used; ids repeated there count once, labelled 1 if any row says so.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .common import begin, staged

PER_CLASS = 1000
BUCKETS = 1 << 18
DIM = 8
EPOCHS = 15
#: Small samples are passed over more often, up to this number of updates.
UPDATES = 600
BATCH = 64
DECAY = 1e-7
LEAST = 0.006
CACHED = 200_000
#: Words without weight added to every text, so that a single odd word does not decide a short one.
QUIET = 4
#: Bytes of words whose n-grams are made at once; longer runs without a break are gone over in parts.
BLOCK = 1 << 18

TOKENS = re.compile(r"[^\W_]+")


def blocks_of(words: list[str], n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(word index, bucket) of the words themselves and of their n-grams of 3 to 6 bytes, ends marked, in bounded blocks."""
    parts, size = [], 0
    for i, word in enumerate(words):
        marked = f"<{word}>".encode()
        for at in range(0, len(marked), BLOCK):
            part = marked[at:at + BLOCK + 6]  # n-grams that start in the block end in it
            if parts and size + len(part) > BLOCK:
                yield _block(parts, n)
                parts, size = [], 0
            parts.append((i, part, len(marked) - at, zlib.crc32(marked) if at == 0 else None))
            size += len(part)
    if parts:
        yield _block(parts, n)


def _block(parts: list[tuple[int, bytes, int, int | None]], n: int) -> tuple[np.ndarray, np.ndarray]:
    """The same of parts of words: (word index, bytes, bytes from there to the end of the word, hash of the word at its start)."""
    size = np.array([len(part) for _, part, _, _ in parts], np.int64)
    text = np.frombuffer(b"".join(part for _, part, _, _ in parts), np.uint8).astype(np.uint64)
    owner = np.repeat(np.array([i for i, _, _, _ in parts]), size)
    place = np.arange(len(text)) - np.repeat(np.cumsum(size) - size, size)
    left = np.repeat(np.array([rest for _, _, rest, _ in parts]), size) - place  # bytes from here to the end of the word
    left[place >= BLOCK] = 0
    rows, found, rolling = [], [], np.zeros(len(text), np.uint64)
    for k in range(1, 7):
        step = len(text) - k + 1
        if step <= 0:
            break
        rolling = (rolling[:step] * np.uint64(0x100000001B3)) ^ text[k - 1:]
        if k >= 3:
            inside = np.flatnonzero(left[:step] > k)
            rows.append(owner[inside])
            found.append(rolling[inside])
    starts = [(i, whole) for i, _, _, whole in parts if whole is not None]
    rows.append(np.array([i for i, _ in starts], np.int64))
    found.append(np.array([whole for _, whole in starts], np.uint64) ^ np.uint64(1 << 40))
    mixed = np.concatenate(found) * np.uint64(0x9E3779B97F4A7C15)
    return np.concatenate(rows), ((mixed >> np.uint64(32)) % np.uint64(n)).astype(np.int64)


def buckets_of(words: list[str], n: int) -> tuple[np.ndarray, np.ndarray]:
    """All blocks in one, in the order of the words, which is that of the blocks too."""
    rows, buckets = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
    for row, bucket in blocks_of(words, n):
        turn = np.argsort(row, kind="stable")
        rows.append(row[turn].astype(np.int32))
        buckets.append(bucket[turn].astype(np.int32))
    return np.concatenate(rows), np.concatenate(buckets)


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    known: dict = field(default_factory=dict)

    def learn(self, words: set[str]) -> None:
        """Add the words' numbers to the table."""
        if len(self.known) > CACHED:
            self.known.clear()
        new = [w for w in words if w not in self.known]
        if new:
            sums, n = np.zeros(len(new)), np.zeros(len(new))
            for row, bucket in blocks_of(new, len(self.weights)):
                sums += np.bincount(row, self.weights[bucket], len(new))
                n += np.bincount(row, minlength=len(new))
            self.known.update(zip(new, (sums / n).tolist()))

    def scores(self, texts: list[str | None]) -> np.ndarray:
        out = np.empty(len(texts))
        for i, text in enumerate(texts):
            tokens = set(TOKENS.findall((text or "").lower()))
            z = self.bias
            if tokens:
                try:
                    z += sum(map(self.known.__getitem__, tokens)) / (len(tokens) + QUIET)
                except KeyError:
                    self.learn({w for t in texts[i:i + 64] for w in TOKENS.findall((t or "").lower())})
                    z += sum(map(self.known.__getitem__, tokens)) / (len(tokens) + QUIET)
            out[i] = z
        return 1.0 / (1.0 + np.exp(-np.clip(out, -40.0, 40.0)))


def _grams(texts: list[str], buckets: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(buckets, weights) of each text: the mean over distinct words of the mean over their buckets."""
    number: dict[str, int] = {}
    bags, runs, out = [], [], []
    for t in texts:
        found = set(TOKENS.findall((t or "").lower()))
        runs.append(sorted(w for w in found if len(w) > BLOCK // 4))  # huge ones are summed by bucket
        bags.append(np.array(sorted(number.setdefault(w, len(number)) for w in found.difference(runs[-1])), np.int64))
    row, bucket = buckets_of(list(number), buckets)
    n = np.bincount(row, minlength=len(number))
    del row, number
    first = np.cumsum(n) - n
    for words, huge in zip(bags, runs):
        if not len(words) and not huge:
            out.append((np.zeros(0, np.int32), np.zeros(0, np.float32)))
            continue
        share = 1.0 / (len(words) + len(huge) + QUIET) / n[words]
        at = np.repeat(first[words] - np.cumsum(n[words]) + n[words], n[words]) + np.arange(n[words].sum())
        hit, inverse = np.unique(bucket[at], return_inverse=True)
        value = np.bincount(inverse, np.repeat(share, n[words]), len(hit))
        if huge:
            total = np.zeros(buckets)
            total[hit] = value
            for w in huge:
                counts = sum(np.bincount(found, minlength=buckets) for _, found in blocks_of([w], buckets))
                total += counts / counts.sum() / (len(words) + len(huge) + QUIET)
            hit = np.flatnonzero(total)
            value = total[hit]
        out.append((hit.astype(np.int32), value.astype(np.float32)))
    return out


def train(texts: list[str], labels: np.ndarray, prior: float, buckets: int = BUCKETS, dim: int = DIM,
          epochs: int = EPOCHS, batch: int = BATCH, rate: float = 0.5, decay: float = DECAY, least: float = LEAST,
          seed: int = 7) -> Model:
    """Joint training of bucket vectors and a two-class softmax; `prior` is the share of label 1 among all rows.

    Buckets that fewer than `least` of the texts hold keep a zero vector: they could only learn single texts by heart.
    """
    labels = np.asarray(labels, int)
    if len(set(labels.tolist())) < 2:
        return Model(np.zeros(buckets, np.float32), -40.0)
    rng = np.random.default_rng(seed)
    bags = _grams(texts, buckets)
    held = np.zeros(buckets, np.int64)
    for hit, _ in bags:
        held[hit] += 1
    common = held >= max(2, least * len(texts))
    vectors = rng.uniform(-0.5 / dim, 0.5 / dim, (buckets, dim)).astype(np.float32) * common[:, None]
    softmax, bias = rng.normal(0, 0.1, (dim, 2)).astype(np.float32), np.zeros(2, np.float32)
    seen_v, seen_s, seen_b = np.full(buckets, 1e-8, np.float32), np.full((dim, 2), 1e-8), np.full(2, 1e-8)
    turn = np.argsort(rng.permutation(len(texts)))  # batches are drawn once, their order each time
    y = labels[turn]
    parts = []
    for at in range(0, len(texts), batch):
        own = []
        for i in turn[at:at + batch]:
            hit, weight = bags[i]
            own.append((hit[common[hit]], weight[common[hit]]))
            bags[i] = None  # a text is held once, among the bags or in its batch
        hit, inverse = np.unique(np.concatenate([h for h, _ in own]), return_inverse=True)
        parts.append((hit, inverse.astype(np.int32), np.array([len(h) for h, _ in own]), np.concatenate([w for _, w in own])))
    for _ in range(max(epochs, -(-UPDATES // len(parts)))):
        for at in rng.permutation(len(parts)):
            hit, inverse, sizes, weight = parts[at]
            truth = y[at * batch:(at + 1) * batch]
            n = len(truth)
            doc = np.repeat(np.arange(n), sizes)
            own = vectors[hit]
            means = np.stack([np.bincount(doc, weight * own[inverse, k], n) for k in range(dim)], 1)
            z = means @ softmax + bias
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(n), truth] -= 1.0
            g_s, g_b, g_m = means.T @ p / n, p.mean(0), p @ softmax.T / n
            g_v = np.stack([np.bincount(inverse, weight * g_m[doc, k], len(hit)) for k in range(dim)], 1) + decay * own
            seen_v[hit] += (g_v ** 2).mean(1)
            vectors[hit] -= (rate * g_v / np.sqrt(seen_v[hit])[:, None]).astype(np.float32)
            seen_s += g_s ** 2
            softmax -= (rate * g_s / np.sqrt(seen_s)).astype(np.float32)
            seen_b += g_b ** 2
            bias -= (rate * g_b / np.sqrt(seen_b)).astype(np.float32)
    share = labels.mean()
    shift = np.log(prior / (1 - prior)) - np.log(share / (1 - share))
    return Model((vectors @ (softmax[:, 1] - softmax[:, 0])).astype(np.float32), float(bias[1] - bias[0] + shift))


def fit(docs: DataFrame, labels: DataFrame, train_on: Column, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", per_class: int = PER_CLASS) -> Model:
    """`train_on` is a condition on the ids, as column `doc_id`."""
    marks = (labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label"))
             .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & train_on)
             .groupBy("doc_id").agg(F.max("label").alias("label")))
    hashes = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("h"))  # no text in the shuffle
    rows = staged(hashes.join(marks, "doc_id"), "labelled")
    shares = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(shares) < 2:
        return Model(np.zeros(BUCKETS, np.float32), -40.0)
    chosen = [rows.where(F.col("label") == k).orderBy("h", "doc_id").limit(per_class) for k in (0, 1)]
    sample = staged(chosen[0].unionByName(chosen[1]).select("doc_id", "label", "h"), "sample")
    texts = (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
             .join(F.broadcast(sample), "doc_id").where(F.xxhash64("text") == F.col("h")).select("text", "label", "h", "doc_id"))
    prior = shares[1] / (shares[0] + shares[1])

    def fitted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        begin("toxicity")
        part = pd.concat(list(batches)).sort_values(["h", "doc_id"])
        if len(part):
            m = train(part["text"].tolist(), part["label"].to_numpy(), prior)
            yield pd.DataFrame({"weights": [m.weights.tobytes()], "bias": [m.bias]})

    # At most 2 * per_class texts, so one task trains; the driver sees the finished numbers only.
    row = texts.repartition(1).mapInPandas(fitted, "weights binary, bias double").first()
    return Model(np.frombuffer(row["weights"], np.float32), row["bias"])


def score(df: DataFrame, model: Model, text_col: str = "text", out: str = "score") -> DataFrame:
    """`df` with one column more. The model travels once per executor, BUCKETS numbers of four bytes."""
    shared = df.sparkSession.sparkContext.broadcast((model.weights, model.bias))
    local: dict[str, Model] = {}

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        begin("toxicity")
        m = local.setdefault("model", Model(*shared.value))
        for texts in batches:
            yield pd.Series(m.scores(texts.tolist()), dtype="float64")

    return df.withColumn(out, scored(F.col(text_col)))


def keep_clean(df: DataFrame, model: Model, limit: float = 0.5, text_col: str = "text") -> DataFrame:
    """Rows that score below `limit`, with their own columns."""
    rows = df.select(F.struct("*").alias("_doc"), F.col(text_col).alias("_text"))
    return score(rows, model, "_text", "_score").where(F.col("_score") < limit).select("_doc.*")
