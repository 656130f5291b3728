"""Corpus pipeline: quality filter, near-dedup, passage dedup, mixing, tokenising.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet to the shared folder and read again as the next stage's docs.  All but the last return the columns of
``documents``; each works on every row that the one before kept, and what it decides takes effect:

* quality: documents that the classifier rejects (score below 0.7) go.  It learns from the labels of the input rows.
* near_duplicates: of each class of SimHash near-duplicates the document with the smallest id stays.
* passages: passages that repeat an earlier document's are cut from the later one.
* mixing: rows are repeated, left out or cut so that the sources have their target weights.
* tokens: number of ids of each row's text, and the digests of ids and decoded bytes.

Rows with NULL text or id, repeated rows and empty tables pass through as the operators of ``runway.llm`` define.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runway.llm import bpe, mixing, quality, simhash, substrings
from runway.llm.queries import RANKS
from runway.llm.tables import crc32_mod, load, small_batches, stage


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.fit(docs, load(spark, sf_dir, "labels"), learn=crc32_mod(F.col("doc_id"), 4) != 2)
    return docs.where(quality.scorer(spark, model)(F.col("text")) >= 0.7)


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs, words=3, radius=3)


def passages_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substrings.deduplicated(docs, least=50, similarity=0.8)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return bpe.encode(docs, RANKS, public_tokenizers.PATTERN, digests=True)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicates_stage),
    ("passages", passages_stage),
    ("mixing", mixing_stage),
    ("tokens", tokens_stage),
]

#: SQL can express neither the classifier nor SimHash; tests/llm/test_pipeline.py holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's rows written to the shared folder and read again."""
    docs = load(spark, sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), f"corpus_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
