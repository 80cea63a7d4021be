"""The corpus pipeline: identify, filter, deduplicate twice, pack.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept. ``run`` writes every stage's rows as Parquet in the shared folder and reads
them as the next one's input, so a lost executor costs one stage's tasks at most.
Models are learned from the tables in ``sf_dir``, not from what a stage was given.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import bound_batches, table
from tidemark.llm.exact_dedup import drop_copies
from tidemark.llm.language_id import keep_identified, learn_languages
from tidemark.llm.language_id import training_rows as language_rows
from tidemark.llm.near_dedup import drop_near_copies
from tidemark.llm.packing import pack_documents
from tidemark.llm.quality_fm import keep_good, learn_quality
from tidemark.llm.quality_fm import training_rows as quality_rows
from tidemark.llm.token_ids import tokenizer_path
from tidemark.session import shared_dir

#: Texts that are sent to a worker at once.
BATCH_ROWS = 400
#: Pieces of text a packing worker remembers (30 MB). It shares an executor with a heap
#: that the stages before have grown, and has time to spare.
REMEMBERED = 150_000


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts of no determined language."""
    bound_batches(spark, BATCH_ROWS)
    model = learn_languages(language_rows(table(spark, sf_dir, "documents")))
    return keep_identified(docs, model, forgetful=True)


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts scored below the threshold."""
    bound_batches(spark, BATCH_ROWS)
    known = quality_rows(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return keep_good(docs, learn_quality(known), forgetful=True)


def remove_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the largest id of each group of equal texts."""
    return drop_copies(docs)


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the least id of each component of near copies."""
    bound_batches(spark, BATCH_ROWS)
    return drop_near_copies(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    bound_batches(spark, BATCH_ROWS)
    return pack_documents(docs, tokenizer_path(), remembered=REMEMBERED, forgetful=True)


STAGES = [
    ("language", identify_language),
    ("quality", classify_quality),
    ("exact_dedup", remove_exact_copies),
    ("near_dedup", remove_near_copies),
    ("packing", pack_sequences),
]

#: Learned filters and near-duplicate components have no SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of ``documents`` after all stages."""
    folder = f"{shared_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        kept = stage(spark, docs, sf_dir)
        kept.write.parquet(path)
        docs = spark.read.schema(kept.schema).parquet(path)
    return docs
