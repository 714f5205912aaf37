"""Corpus pipeline: quality rules, near-dedup, decontamination, mixing, sharding.

``run(spark, sf_dir)`` applies the stages to the whole table ``documents``.
Each stage's result is written as Parquet under the session's checkpoint
folder and read again as the next one's documents, so a lost executor costs
tasks of one stage only.

Of each stage: documents that fail the quality rules go; one document of each
class of near duplicates stays; contaminated documents go; the mix takes words
of the documents, up to three times; the last adds the columns ``shard`` and
``virtual_slot``.  Empty tables, null values and further columns pass through
every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakepipe.llm import fm_index, mix_blocks, near_dup, repetition, slots
from lakepipe.llm.frames import read, stage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return repetition.keep_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.keep_one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return fm_index.keep_clean(docs, read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix_blocks.mixed_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return slots.with_shards(docs)


STAGES = [("quality rules", quality_rules), ("near dedup", near_dedup), ("decontamination", decontaminate),
          ("mixing", mix_sources), ("sharding", shard)]

#: The signatures, the FM-index and the draws have no SQL form; tests compare every stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, apply in STAGES:
        docs = stage(spark, apply(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
