"""Corpus pipeline: from ``documents`` to packed training sequences in five stages.

Each stage is a function (spark, docs, sf_dir) -> DataFrame that works on all rows the stage before kept;
``run`` writes every stage but the last as Parquet in the shared folder and reads it back.  All
stages but the last return the columns of their input.

Nulls, empty and repeated rows: language ID rejects null texts and texts without a letter; a row is kept or
rejected by its text alone, so repeated rows go the same way; of rows with one doc_id the near-duplicate stage keeps
one (rows of null doc_id all stay); masking keeps every row; packing gives each row its own pieces.
An empty table stays empty through all stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyrec.llm import langid, minhash, packing, pii, quality
from tallyrec.llm.common import maybe_among, stored, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known (operator 3); those it rejects go."""
    return langid.keep_known(docs, langid.fit(docs))


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts (operator 7); the others go."""
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (operator 5): the one with the smallest id."""
    # ids that none or several rows are kept of are the few; the rows of all others stay where they are
    found = (minhash.near_duplicates(docs.select("doc_id", "text")).where("doc_id is not null")
             .groupBy("doc_id").agg(F.count_if("kept").alias("_kept")).where("_kept <> 1"))
    found = stored(found, "pipeline-found")
    marked = maybe_among(docs, found, "doc_id", "_maybe")
    maybe = marked.where("_maybe").drop("_maybe")
    again = maybe.join(found.where("_kept > 1").select("doc_id"), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return marked.where("not _maybe").drop("_maybe").unionByName(maybe.join(found, "doc_id", "left_anti")).unionByName(again)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data masked in their texts (operator 4)."""
    return pii.mask(docs, pii.fit(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens (operator 9)."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language ID", language_id),
    ("quality classifier", quality_filter),
    ("MinHash near-dedup", near_duplicates),
    ("PII", personal_data),
    ("packing", pack_sequences),
]

ORACLE_SQL = None  # learned models and token ids: no SQL; tests/llm compares the stages with plain Python


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)
