"""Toxicity: held-out accuracy, misspellings never seen, inputs, edges."""

import random
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import words
from vacancy_lake.llm import queries, toxicity

BAD = ["stupid", "idiot", "moron", "scum"]


def corpus(n, seed):
    rng = random.Random(seed)
    texts, labels = [], []
    for i in range(n):
        w = words(rng.randint(20, 120), seed * 10_000 + i).split()
        if i % 4 == 0:
            for _ in range(max(1, len(w) // 12)):
                w[rng.randrange(len(w))] = rng.choice(BAD)
        texts.append(" ".join(w))
        labels.append(int(i % 4 == 0))
    return texts, labels


@pytest.fixture(scope="module")
def model():
    texts, labels = corpus(600, 1)
    return toxicity.train(texts, np.array(labels), 0.25)


def test_held_out_accuracy(model):
    texts, labels = corpus(400, 2)
    assert ((model.scores(texts) >= 0.5) == np.array(labels)).mean() > 0.9


def test_misspellings_share_ngrams(model):
    plain = words(30, 77)
    score = lambda w: model.scores([f"{plain} {w}"])[0]
    for odd in ("stupiid", "idiiot", "moronn", "stuppid"):
        assert score(odd) > score(words(1, 5))


def test_weights_of_words_are_the_mean_of_their_buckets(model):
    row, bucket = toxicity.buckets_of(["stupid", "é"], len(model.weights))
    model.learn({"stupid", "é"})
    for i, w in enumerate(["stupid", "é"]):
        assert model.known[w] == pytest.approx(model.weights[bucket[row == i]].mean(), rel=1e-4)


def test_long_runs_count_to_their_end(model, monkeypatch):
    """Words run together: what stands behind byte 200 decides as what stands before; parts and wholes agree."""
    clean = words(80, 50).replace(" ", "")
    bad = clean + "".join(BAD) * 20
    assert len(clean) > 200
    one, two = model.scores([clean, bad])
    assert two > one
    row, bucket = toxicity.buckets_of(["short", bad, "é" * 300], 1 << 16)
    grams = toxicity._grams(["short " + bad, bad], 1 << 16)
    monkeypatch.setattr(toxicity, "BLOCK", 64)
    parts = list(toxicity.blocks_of(["short", bad, "é" * 300], 1 << 16))
    assert max(len(b) for _, b in parts) <= 4 * 70 + 2
    assert sorted(zip(row, bucket)) == sorted(x for r, b in parts for x in zip(r, b))
    for whole, cut in zip(grams, toxicity._grams(["short " + bad, bad], 1 << 16)):
        assert np.allclose(whole, cut)


def test_training_holds_each_text_once(monkeypatch):
    """2.4 million weights of eight bytes: 55 MB at most, 118 MB with copies of all of them."""
    monkeypatch.setattr(toxicity, "UPDATES", 1)
    known = words(5000, 60).split()
    texts = [" ".join(random.Random(i).choices(known, k=1500)) for i in range(300)]
    n = sum(len(hit) for hit, _ in toxicity._grams(texts, toxicity.BUCKETS))
    tracemalloc.start()
    try:
        toxicity.train(texts, np.arange(300) % 2, 0.5, epochs=1)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 20 * n + 30e6


def test_fit_empties_the_tables_of_other_operators(spark, frame, monkeypatch):
    """The worker that trains may still hold the tables of the stage before."""
    def begin(owner):
        raise RuntimeError(f"{owner} begins")

    df = frame([(i, words(20, i), "a") for i in range(8)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(8)], "doc_id long, toxic int")
    monkeypatch.setattr(toxicity, "begin", begin)
    with pytest.raises(Exception, match="toxicity begins"):
        toxicity.fit(df, labels, F.lit(True))


def test_query_on_given_table(spark):
    out = queries.QUERIES["op5_toxicity"](spark, "/root/testdata/sf0.1").toPandas()
    assert len(out) == 10_000 and out.score.between(0, 1).all() and ((out.score >= 0.5) == (out.predicted == 1)).all()
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").toPandas()
    m = out[out.held_out].merge(labels, on="doc_id")
    assert (m.predicted == m.toxic).mean() > (m.toxic == 0).mean()


def test_fit_and_edges(spark, frame, edge_rows):
    df = frame(edge_rows)
    labels = spark.createDataFrame([(1, 1), (3, 0), (None, 1), (9, None), (2, 0), (2, 1), (12, 0), (99, 1)], "doc_id long, toxic int")
    model = toxicity.fit(df, labels, F.lit(True))
    scored = toxicity.score(df, model, out="tox")
    rows = scored.collect()
    assert len(rows) == len(edge_rows) and all(0 <= r["tox"] <= 1 for r in rows)
    empty = {r["tox"] for r in rows if not (r["text"] or "").strip()}
    assert len(empty) == 1
    none = toxicity.fit(df, labels.where("false"), F.lit(True))
    assert {r["tox"] < 1e-6 for r in toxicity.score(df, none, out="tox").collect()} == {True}
    assert toxicity.keep_clean(df, none).columns == df.columns and toxicity.keep_clean(df, none).count() == len(edge_rows)
    assert toxicity.score(frame([]).limit(0), model).count() == 0
