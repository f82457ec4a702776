"""Registered queries of the corpus operators, and the SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (alignment, bpe, exact_dedup, licenses, minhash, mixing, neighbours, ngrams, prefix_trie, substring,
               token_files, toxicity, url_filter)
from .common import documents

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


@query("op8_exact_dedup", """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept,
  sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY sha256(coalesce(text, '')))""")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_dedup.exact_groups(documents(spark, sf_dir))
    return groups.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


@query("op3_mixing", r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    length(coalesce(text, '')) AS chars,
    (CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) + 0.5::DOUBLE)
      / 4503599627370496.0::DOUBLE AS u FROM documents),
k AS (SELECT *, -ln(u) / (1.0::DOUBLE / (1.0::DOUBLE + abs(chars::DOUBLE / greatest(size, 1) - 6.0::DOUBLE) / 6.0::DOUBLE)) AS key
      FROM d),
s AS (SELECT source, CAST(sum(size) AS DOUBLE) AS total,
        [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w
      FROM d GROUP BY source),
f AS (SELECT *, row_number() OVER (ORDER BY 2 * total / w, source NULLS LAST) AS place, 2 * total / w AS fill,
        (1.5::DOUBLE * sum(total) OVER () - coalesce(sum(2 * total) OVER (ORDER BY 2 * total / w, source NULLS LAST
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(w) OVER (ORDER BY 2 * total / w, source NULLS LAST
          ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM s),
g AS (SELECT *, min(CASE WHEN fill >= level THEN place END) OVER () AS first FROM f),
h AS (SELECT *, max(CASE WHEN place = first THEN level END) OVER () AS final FROM g),
t AS (SELECT source, total, CASE WHEN place < first THEN 2 * total ELSE least(2 * total, final * w) END AS target FROM h),
e AS (SELECT *, CASE WHEN total > 0 THEN floor(target / total) ELSE 0 END AS full_epochs FROM t),
r AS (SELECT k.doc_id, k.size, e.total, e.target, e.full_epochs,
        2 * coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY key, doc_id
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + k.size
          <= 2 * (e.target - e.full_epochs * e.total) AS picked
      FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, CAST(total AS BIGINT) AS source_size, target,
  CAST(size * (full_epochs + CASE WHEN picked THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM r""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(documents(spark, sf_dir))
    return mixed.select("doc.doc_id", "size", "source_size", "target", "taken")


@query("op7_bpe")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def fold(doc_id: str = "doc_id"):
    """Remainder of crc32 of the id as text, the split into training and held-out rows."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5


@query("op5_toxicity")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(docs, labels, fold() != 0)
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", F.coalesce(fold() == 0, F.lit(True)).alias("held_out"), "score",
                         F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


@query("op1_minhash_near_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = minhash.near_groups(documents(spark, sf_dir), width=2, percent=80)
    return groups.select("doc_id", "n_shingles", "component_id", "kept")


@query("op6_license_scan")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir)).drop("matches")


@query("op2_nearest_neighbours")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("id") % 100 == 0, k=10)


@query("op9_token_files")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = token_files.write(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
    return token_files.listing(blocks)


@query("op10_substring_dedup")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.removal_digests(documents(spark, sf_dir))


@query("op4_ngram_scores")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngrams.scores(documents(spark, sf_dir), held=fold() == 1)


#: Rules of op12, longest host and path first to count.
URL_RULES = [url_filter.Rule("allow", "org/"), url_filter.Rule("block", "example.org/es/"),
             url_filter.Rule("block", "example.org/en/1"), url_filter.Rule("allow", "com/fr/"), url_filter.Rule("block", "com/de/")]


@query("op12_url_filter")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(spark.read.parquet(f"{sf_dir}/pages.parquet"), URL_RULES)


def conversation_trie(rows: DataFrame, turns_per_shard: int = prefix_trie.TURNS_PER_SHARD) -> DataFrame:
    """Trie of conversations whose first crc32(id) % 6 turns come from the conversation at the start of their hundred."""
    head = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6).cast("int")
    return prefix_trie.trie(prefix_trie.with_shared_heads(prefix_trie.conversations(rows), head, 5), turns_per_shard)


@query("op13_prefix_trie")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


@query("op11_token_alignment")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"),
                               public_tokenizers.path("piece_bpe_32k.model"))
