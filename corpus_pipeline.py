"""The corpus pipeline: five stages from documents to token ids.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
stored as Parquet and read again as the next stage's ``docs``. All stages but
the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bag_minhash, chunked_bpe, line_frequency, line_index, mixing
from tidemark.llm.common import ship, table
from tidemark.sources.shared import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules accept, without the lines that are boilerplate of their source."""
    return line_frequency.accepted(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that ten or more different texts hold; copies are left to the next stage."""
    return line_index.drop_frequent_lines(docs, equal_once=True).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each class of near-duplicates; all texts without words are one class."""
    return bag_minhash.one_of_each(docs, wordless_alone=False)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled to the target weights of sources, languages and topics."""
    return mixing.sampled(docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, lang, the token ids (packed 32-bit integers) and their number."""
    codec = chunked_bpe.Codec(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    encoded = chunked_bpe.encode(docs.select("doc_id", "source", "lang", "text"), codec).drop("text")
    return encoded.withColumn("n_tokens", (F.octet_length("ids") / 4).cast("long"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("tokenise", tokenise),
]

# The sketches, the sampling and the token ids are beyond SQL; tests hold the rows against a plain version of all stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the table documents."""
    ship(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
