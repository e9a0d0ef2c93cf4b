"""The training-data operators as one pipeline over documents.

Each stage takes the documents its predecessor kept and returns documents; the
last one returns the pieces of the packed windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from alambique.llm import langid, mixing, neardup, packing, quality
from alambique.llm.queries import TOKENIZER, piece_digests
from alambique.storage import materialize

#: Shingles of five words; the library's query compares pairs of words.
NEAR = neardup.Settings(words=5, percent=80)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language the filters know; texts without one go."""
    return langid.identified_documents(docs, langid.fit(docs))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, without lines that their source repeats."""
    return quality.cleaned_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return neardup.deduplicated(docs, NEAR)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix, with each document as often as it is taken."""
    return mixing.mixed_documents(docs)


def window_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in windows."""
    return piece_digests(packing.pack(docs, TOKENIZER))


STAGES = [
    ("language_id", language_id),
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("source_mix", source_mix),
    ("window_packing", window_packing),
]

#: SQL cannot express the learned filters, the sketches or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
