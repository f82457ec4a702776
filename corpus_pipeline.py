"""A training-data pipeline: toxicity filter, exact and near deduplication, mixing, and token ids.

Every stage is a function (spark, docs, sf_dir) -> DataFrame. `run` writes what a stage returns as Parquet into the
shared folder of the session and hands it, read back, to the next one. All stages but the last return the columns of
`documents`.

Defined results: a document whose toxicity score is 0.5 or more goes; of equal texts the largest id stays, of near
copies (five-word shingles, similarity 0.8 or more) the smallest; the mix returns a row as often as it takes the
document; the last stage returns every row with its ids. Null texts count as empty and stay, one of them at most past
exact deduplication. Other columns are carried along.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from vacancy_lake.llm import bpe, exact_dedup, minhash, mixing, toxicity
from vacancy_lake.llm.common import documents, staged
from vacancy_lake.llm.queries import fold

#: Scores from here on reject a document.
TOXIC = 0.5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxicity (5): learned from the labelled rows outside the held-out fifth, applied to all."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), fold() != 0)
    return toxicity.keep_clean(docs, model, TOXIC)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exact deduplication (8)."""
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-duplicates (1): one document of each group stays."""
    return minhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing to target weights (3): each document as often as the mix takes it."""
    return mixing.taken_rows(mixing.mix(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """BPE (7): doc_id and ids of every row."""
    return bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs


#: The first stage is a trained model, which SQL cannot express.
ORACLE_SQL = None

QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
