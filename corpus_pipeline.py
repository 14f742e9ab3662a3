"""From raw documents to encoded training text, stage by stage.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before
kept. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cohortline.llm import byte_pairs, mixing, near_duplicates, ordinal_quality, personal_data
from cohortline.llm.inputs import table


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the ordinal quality model, fitted on ``labels``, rejects."""
    return ordinal_quality.good_documents(docs, table(spark, sf_dir, "labels"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts alike to 0.8 or more in five-word shingles."""
    return near_duplicates.without_copies(docs, percent=80)


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind in brackets."""
    return personal_data.redacted(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes it, in the order of the output shards."""
    return mixing.mixed_rows(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, piece offsets and digests of every row."""
    return byte_pairs.round_trips(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), with_ids=True)


STAGES = [("quality classifier", good_documents), ("near duplicates", without_copies), ("personal data", redacted),
          ("mixing", mixed), ("byte pairs", encoded)]
#: No SQL: models, hashed sketches and seeded draws; the operators behind the stages have tests of their own.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
