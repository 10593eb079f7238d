"""The operators as registered queries, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from siltlake.llm import bitpack, byte_bpe, chunks, fingerprints, mixing, neighbours, outliers, phrases, separators, sharding, simhash_dedup, spelling, url_filter
from siltlake.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

# Tokenizer files, their sizes, and the ids that end documents.
TOKENIZER, VOCABULARY, PACKED_END = "byte_bpe_50k.json", 50_257, 2
RANKS, FLAT_END = "byte_bpe_50k.tiktoken", 50_256


def op1_simhash_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.component_ids(table(spark, sf_dir, "documents"))


def op2_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(table(spark, sf_dir, "documents"))


def op3_simhash_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.with_found(table(spark, sf_dir, "documents"), "doc_id % 100 = 0")


def op4_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(table(spark, sf_dir, "documents"), grow=True)


def op5_bloom_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judged(table(spark, sf_dir, "pages"))


def op6_bit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(TOKENIZER)
    return bitpack.packed(table(spark, sf_dir, "documents"), path, VOCABULARY, PACKED_END)


def op7_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(RANKS)
    return separators.token_counts(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, FLAT_END)


def op8_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outliers.judged(table(spark, sf_dir, "documents"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(RANKS)
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op10_gear_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.shared_passages(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_phrase_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op13_multiprobe_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), "vec_id % 20 = 0")


REGISTRY: dict[str, Query] = {
    query.__name__: query
    for query in (
        op1_simhash_pivots, op2_pareto_mix, op3_simhash_fingerprints, op4_virtual_slots, op5_bloom_cascade,
        op6_bit_packing, op7_separator_scan, op8_robust_outliers, op9_byte_bpe, op10_gear_chunks,
        op11_spelling_variants, op12_phrase_automata, op13_multiprobe_neighbours,
    )
}
