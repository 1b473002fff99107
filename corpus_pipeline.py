"""The corpus pipeline: language ID, exact dedup, near-dedup, decontamination, BPE.

Each stage takes (spark, docs, sf_dir); its result is written as Parquet and read
again as the next one's docs.  All but the last return the columns of docs; the
last returns doc_id, n_tokens, ids_sha256, decoded_sha256.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from latewatch.llm import bpe, decontam, exactdedup, langid, simhash
from latewatch.llm.common import table, written


#: Languages to train on, and their least share in a document's words.
WANTED, LEAST = ["de", "en", "es", "fr"], 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents stay whose words are for the most part in a wanted language, by the inferred mixture; null texts and texts without a letter go."""
    return langid.keep_identified(docs, WANTED, LEAST)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z lower-cased) the one with the largest doc_id stays."""
    return exactdedup.deduplicate(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash component (4-word shingles, 4 bits) the smallest doc_id stays."""
    return simhash.keep_first(docs, shingle=4, distance=4)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more lies in benchmark windows go."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def bpe_codec(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts, ids and round trip of what stays."""
    return bpe.code(docs)


STAGES = [("language_id", language_id), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup),
          ("decontamination", decontamination), ("bpe_codec", bpe_codec)]

#: Language ID has no SQL form, so run() has none; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
