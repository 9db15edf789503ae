"""Registered queries of the text operators: production parameters, whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import (block_max_search, byte_language, decontaminate, host_reputation, hyperminhash, licenses, line_rules,
               merge_dropout, passage_attention, sql, suffix_dedup, tag_paths, token_alignment, token_store)

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str, folder: str | None = None) -> str:
    """Place of a public vocabulary file, or of one in ``folder``."""
    return f"{folder}/{name}" if folder else public_tokenizers.path(name)


def op1_license_scan(spark, sf_dir):
    return licenses.license_scan(table(spark, sf_dir, "documents")).drop("spans")


def op2_token_store(spark, sf_dir):
    return token_store.store_and_read(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op3_merge_dropout(spark, sf_dir):
    return merge_dropout.round_trip(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model")).drop("ids")


def op4_hyperminhash(spark, sf_dir):
    return hyperminhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_passage_attention(spark, sf_dir):
    return passage_attention.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_line_rules(spark, sf_dir):
    return line_rules.line_rules(table(spark, sf_dir, "documents"))


def op7_suffix_dedup(spark, sf_dir):
    return suffix_dedup.substring_dedup(table(spark, sf_dir, "documents"))


def op8_byte_language(spark, sf_dir):
    return byte_language.language_id(table(spark, sf_dir, "documents"))


def op9_tag_paths(spark, sf_dir):
    return tag_paths.extract_pages(table(spark, sf_dir, "pages"))


def op10_decontaminate(spark, sf_dir):
    return decontaminate.find_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_block_max_search(spark, sf_dir):
    return block_max_search.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_token_alignment(spark, sf_dir):
    return token_alignment.token_links(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"),
                                       vocabulary("piece_bpe_32k.model"))


def op13_host_reputation(spark, sf_dir):
    return host_reputation.filter_pages(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_token_store": op2_token_store,
    "op3_merge_dropout": op3_merge_dropout,
    "op4_hyperminhash": op4_hyperminhash,
    "op5_passage_attention": op5_passage_attention,
    "op6_line_rules": op6_line_rules,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_byte_language": op8_byte_language,
    "op9_tag_paths": op9_tag_paths,
    "op10_decontaminate": op10_decontaminate,
    "op11_block_max_search": op11_block_max_search,
    "op12_token_alignment": op12_token_alignment,
    "op13_host_reputation": op13_host_reputation,
}

ORACLES = {
    "op1_license_scan": sql.LICENSE_SCAN,
    "op4_hyperminhash": sql.NEAR_DUPLICATES,
    "op6_line_rules": sql.LINE_RULES,
    "op7_suffix_dedup": sql.SUBSTRING_DEDUP,
    "op11_block_max_search": sql.RANKED_SEARCH,
    "op13_host_reputation": sql.HOST_REPUTATION,
}
