"""The registered queries: each applies one operator, with its production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakepipe.llm import (
    fm_index,
    k2_treap,
    license_diagonals,
    mix_blocks,
    near_dup,
    recompress,
    repetition,
    revisits,
    skip_chain,
    slots,
    spelling,
    subword,
    url_trees,
)
from lakepipe.llm.frames import read


def op1_url_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_trees.judge_urls(read(spark, sf_dir, "pages"))


def op2_prob_min_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(read(spark, sf_dir, "documents")).drop("text_hash")


def op3_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slots.shard_rows(read(spark, sf_dir, "documents"))


def op4_license_diagonals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_diagonals.license_scan(read(spark, sf_dir, "documents"))


def op5_revisit_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return revisits.resolved_pages(read(spark, sf_dir, "pages"))


def op6_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recompress.repeats_removed(read(spark, sf_dir, "documents"))


def op7_repetition_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.repetition_rules(read(spark, sf_dir, "documents"))


def op8_subword_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subword.quality_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op9_benchmark_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fm_index.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op10_block_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_blocks.mixture(read(spark, sf_dir, "documents"))


def op11_k2_treap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return k2_treap.ranked(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op12_skip_chain_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return skip_chain.personal_data(read(spark, sf_dir, "documents"))


def op13_trie_node_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_url_trees, op2_prob_min_hash, op3_virtual_slots, op4_license_diagonals, op5_revisit_resolution,
        op6_recompression, op7_repetition_rules, op8_subword_quality, op9_benchmark_fm_index, op10_block_mixture, op11_k2_treap, op12_skip_chain_crf, op13_trie_node_pairs)
}
