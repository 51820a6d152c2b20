"""A training corpus from raw documents, in four stages.

1. Language ID: documents that lie too far from every language go.
2. Quality rules: documents that the risk-controlled rules reject go.
3. Near-duplicates: one document of each class stays.
4. Best-fit packing: the rest as token sequences.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept, which is written as Parquet and read again; all but the last return the
columns of ``documents``. Empty tables pass through every stage. Packing is
not expressible in SQL, so there is no SQL answer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from statmart.llm.common import table
from statmart.llm.language_id import keep_known
from statmart.llm.near_dedup import keep_first_of_class
from statmart.llm.packing import pack_documents
from statmart.llm.quality_rules import keep_good
from statmart.session import materialized


def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_known(docs)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs, table(spark, sf_dir, "labels"))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_first_of_class(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs)


STAGES = [
    ("language_id", known_languages),
    ("quality_rules", good_quality),
    ("near_dedup", without_near_copies),
    ("best_fit_packing", packed),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed sequences of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialized(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
