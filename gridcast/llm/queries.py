"""Registered queries of the training-data operators, with their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcast.llm import licenses, oracles
from gridcast.llm.common import table
from gridcast.llm.conversations import repair_report
from gridcast.llm.decontamination import contamination_report
from gridcast.llm.dedup import content_sort
from gridcast.llm.knn import top_inner_products
from gridcast.llm.manifest import manifest_report
from gridcast.llm.mixing import mix_sources
from gridcast.llm.packing import pack
from gridcast.llm.partenum import jaccard_join
from gridcast.llm.pii import find_personal_data
from gridcast.llm.quality import quality_scores
from gridcast.llm.sharding import shard_rows
from gridcast.llm.toxicity import toxicity_scores


def op1_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(table(spark, sf_dir, "documents"))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents"), words=5, p=80, q=100)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shard_rows(table(spark, sf_dir, "documents"), shards=40)
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op6_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_inner_products(table(spark, sf_dir, "embeddings"), k=20, every=20, scale=64)


def byte_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), byte_bpe_path(), size=1024)


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_sort(table(spark, sf_dir, "documents"), keep="largest")


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_report(table(spark, sf_dir, "conversations"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest_report(table(spark, sf_dir, "documents"))


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP5_SQL = """
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || coalesce(text, '')), 1, 15) AS BIGINT) AS h
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS n, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS i FROM d GROUP BY source
), w AS (
  SELECT *, CASE i % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w FROM s
), r AS (
  SELECT *, 2.0::DOUBLE * n / w AS ratio, sum(n) OVER () AS total,
         coalesce(sum(2 * n) OVER (ORDER BY 2.0::DOUBLE * n / w, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
         sum(w) OVER (ORDER BY 2.0::DOUBLE * n / w, i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS heavy
  FROM w
), l AS (
  SELECT *, (1.5::DOUBLE * total - capped) / heavy AS level FROM r
), f AS (
  SELECT first(level ORDER BY ratio, i) AS level, min(ratio) AS ratio FROM l WHERE level * w <= 2 * n
), t AS (
  SELECT source, n, CASE WHEN f.level * w > 2 * n THEN 2.0 * n ELSE f.level * w END::DOUBLE AS target FROM l, f
), b AS (
  SELECT source, n, target, CASE WHEN n > 0 THEN CAST(floor(target / n) AS BIGINT) ELSE 0 END AS base FROM t
), c AS (
  SELECT d.doc_id, d.size, b.n, b.target, b.base, b.target - b.base * b.n AS budget,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
         sum(d.size) OVER (PARTITION BY d.source, d.h) AS tie
  FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source
)
SELECT doc_id, size, n AS source_size, target,
       CAST(size * least(2, base + CASE WHEN upto <= budget OR (upto - tie <= budget AND abs(upto - budget) < abs(upto - tie - budget)) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM c
"""

OP8_SQL = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""

QUERIES = {
    "op1_personal_data": op1_personal_data,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_toxicity": op3_toxicity,
    "op4_sharding": op4_sharding,
    "op5_mixing": op5_mixing,
    "op6_exact_topk": op6_exact_topk,
    "op7_packing": op7_packing,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_licenses": op9_licenses,
    "op10_quality": op10_quality,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_decontamination": op13_decontamination,
}

ORACLE = {"op5_mixing": OP5_SQL, "op8_exact_dedup": OP8_SQL, "op9_licenses": licenses.oracle_sql(), "op11_conversation_repair": oracles.OP11, "op12_merkle_manifest": oracles.OP12, "op13_decontamination": oracles.OP13}
