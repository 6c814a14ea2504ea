"""Corpus pipeline: five stages, each one of the training-data operators.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``. All but the
last return the columns of ``documents``; the last returns the packed pieces.
Nulls, empty and very long texts, ties, repeated rows and empty tables are taken
as each stage's operator states them: an empty table gives no rows at any stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridcast.llm.common import staged, table
from gridcast.llm.dedup import content_sort
from gridcast.llm.mixing import mixed_rows
from gridcast.llm.packing import pack
from gridcast.llm.partenum import one_per_component
from gridcast.llm.queries import byte_bpe_path
from gridcast.llm.toxicity import toxicity_scores


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows the factorization machine does not predict to be toxic."""
    rest = [c for c in docs.columns if c != "doc_id"]
    scored = toxicity_scores(docs, table(spark, sf_dir, "labels"), carry=rest)
    return scored.where("predicted = 0").select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id."""
    rest = [c for c in docs.columns if c != "doc_id"]
    return content_sort(docs, keep="largest", carry=rest).where("kept").select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by 80 % Jaccard similarity, the smallest doc_id."""
    return one_per_component(docs, words=5, p=80, q=100).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as their source's target weight takes them."""
    return mixed_rows(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all rows, with their token ids, in sequences of 1024."""
    return pack(docs, byte_bpe_path(), size=1024, with_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("jaccard_join", drop_near_copies),
    ("mixing", mix),
    ("packing", pack_sequences),
]

# Model fits, similarity components, column generation: not SQL. The tests
# compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's result is stored before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
