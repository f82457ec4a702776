"""The pipeline stage by stage: columns, what goes and what stays, edges."""

from collections import Counter

import corpus_pipeline as pipeline
from tests.llm.test_minhash import brute
from vacancy_lake.llm.common import documents

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = documents(spark, SF)
    names = [n for n, _ in pipeline.STAGES]
    assert names == ["toxicity", "exact_dedup", "near_dedup", "mixing", "bpe"]
    kept = {}
    for name, stage in pipeline.STAGES[:-1]:
        before = docs
        docs = stage(spark, before, SF).cache()
        assert docs.columns == before.columns
        kept[name] = (before.select("doc_id", "text").collect(), docs.select("doc_id", "text").collect())
    before, after = kept["exact_dedup"]
    largest = {}
    for r in before:
        largest[r["text"]] = max(largest.get(r["text"], 0), r["doc_id"])
    assert Counter(map(tuple, after)) == Counter((d, t) for t, d in largest.items())
    before, after = kept["near_dedup"]
    assert sorted(r["doc_id"] for r in after) == sorted(d for d, n, c in brute(before, 5) if d == c)
    before, after = kept["mixing"]
    assert {tuple(r) for r in after} <= {tuple(r) for r in before} and max(Counter(after).values()) <= 2
    out = pipeline.STAGES[-1][1](spark, docs, SF)
    assert out.count() == docs.count() and out.columns == ["doc_id", "ids"]


def test_run(spark):
    out = pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "ids"] and 0 < out.count()


def test_edges(spark, frame, edge_rows):
    for rows in (edge_rows, []):
        docs = frame(rows)
        for _, stage in pipeline.STAGES[:-1]:
            after = stage(spark, docs, SF)
            assert after.columns == docs.columns
            docs = after
        assert pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count()
