"""From raw documents to packed training sequences, a stage at a time.

Every stage takes (spark, docs, sf_dir) and gives a frame; it is written as Parquet and read again as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm import exact_dedup, language_id, mixing, near_copies, packing
from ledgerloom.llm.common import Scratch, read_table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in none of the learned languages go."""
    return language_id.keep_identified(docs)


def drop_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the largest id stays."""
    return exact_dedup.drop_exact_copies(docs, Scratch(spark, "pipeline-exact"))


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are alike in 0.8 of their five-word shingles, one after the other, the smallest id stays."""
    return near_copies.drop_near_copies(docs, Scratch(spark, "pipeline-near"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or dropped until each source has its target's words."""
    return mixing.repeat_documents(docs, Scratch(spark, "pipeline-mix"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences of at most 2048 ids."""
    return packing.pack(docs, Scratch(spark, "pipeline-pack"))


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact),
    ("simhash_near_dedup", drop_near),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Profiles, Newton steps and best fit have no SQL; the tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, scratch = read_table(spark, sf_dir, "documents"), Scratch(spark, "pipeline")
    for n, (_, stage) in enumerate(STAGES):
        after = scratch.write(stage(spark, docs, sf_dir))
        if n:
            scratch.drop(docs)
        docs = after
    return docs
