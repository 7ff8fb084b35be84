"""A corpus pipeline of five stages, each calling one operator of ``shelflife.llm``.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame.  The first four
return rows with the columns of ``documents``; the last returns the packed pieces.
:func:`run` writes each stage's rows as Parquet to the shared folder and rereads them
as the next one's input.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from shelflife.llm.common import stored
from shelflife.llm.dedup import drop_exact
from shelflife.llm.langid import keep_identified
from shelflife.llm.mixing import mix
from shelflife.llm.packing import pack
from shelflife.llm.simhash import drop_near

TOKENIZER = "word_bpe_49k.json"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; texts that are null, empty or without letters go."""
    return keep_identified(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return drop_exact(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near fingerprints: 3-word shingles, 2 bits."""
    return drop_near(docs, n_words=3, radius=2)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture of sources takes them."""
    return mix(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the packed sequences."""
    return pack(docs, public_tokenizers.path(TOKENIZER), end_id=0, capacity=2048)


STAGES = [("language_id", language_id), ("exact_dedup", exact_dedup),
          ("near_dedup", near_dedup), ("mixing", mixing), ("packing", packing)]

# Learned languages, fingerprints and token ids have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
