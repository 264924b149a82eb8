"""The corpus pipeline: documents -> piece ids in five stages.

Every stage works on all rows that the stage before kept; its result is
written as Parquet and read again. All but the last return the columns of
documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.frames import materialise, table
from tidemark.llm.language import held_out, language_filter, train
from tidemark.llm.minhash import keep_one
from tidemark.llm.mixing import mixed_rows
from tidemark.llm.pieces import digest
from tidemark.llm.quality import quality_filter

PIECES = public_tokenizers.path("piece_bpe_32k.model")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the compression bands and the base rules."""
    return quality_filter(docs)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a dominant known language."""
    return language_filter(docs, train(docs.where(~held_out(F.col("doc_id")))))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles,
    similarity 0.8 or more."""
    return keep_one(docs, width=5, percent=80)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, each as often as it is taken."""
    return mixed_rows(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, source, n_tokens, ids_crc32, round_trip, ids) of every row of the mix."""
    return docs.select("doc_id", "source", digest(F.col("text"), PIECES, with_ids=True).alias("d")).select("doc_id", "source", "d.*")


STAGES = [("quality", quality), ("language", language), ("near_duplicates", near_duplicates), ("mixing", mixing), ("pieces", pieces)]

#: Compression, mixtures and sketches are not SQL: tests/llm/test_pipeline.py holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
