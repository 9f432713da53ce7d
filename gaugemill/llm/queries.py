"""Queries of the pipeline operators over the given tables, at production parameters."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from gaugemill.llm import (
    code_bounds, decontaminate, grouped_join, license_index, mixing_tree, page_template, phrase_trie, quality_vote,
    secret_grammar, shard_pack, simhash_tree, token_blocks, toxic_bags,
)
from gaugemill.llm.common import shipped, table

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    """A public tokenizer's file, named by the package installed with it."""
    import public_tokenizers

    return os.path.abspath(public_tokenizers.path(name))


def op1_secret_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_grammar.scan(table(spark, sf_dir, "documents")).drop("found")


def op2_page_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_template.main_texts(table(spark, sf_dir, "pages"))


def op3_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_blocks.token_files(table(spark, sf_dir, "documents"), tokenizer_path())


def op4_quality_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_vote.verdicts(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *quality_vote.STATS, "base_failed", "kept", "posterior")


def op5_toxic_bags(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (table(spark, sf_dir, name) for name in ("documents", "labels"))
    found = toxic_bags.toxicity(docs, labels)
    return found.select("doc_id", "held_out", "score", "predicted",
                        F.size("offending").alias("n_offending"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = (table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return decontaminate.contamination(docs, items)


def op7_simhash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_tree.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def op8_shard_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_pack.placed(table(spark, sf_dir, "documents"))


def op9_mixing_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing_tree.mix_plan(table(spark, sf_dir, "documents"))


def op10_license_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_index.scan(table(spark, sf_dir, "documents"))


def op11_code_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return code_bounds.vector_codes(table(spark, sf_dir, "embeddings"))


def op12_grouped_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouped_join.similar_documents(table(spark, sf_dir, "documents"))


def op13_phrase_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_trie.collocations(table(spark, sf_dir, "documents"))


OPERATORS = {
    "op1_secret_grammar": op1_secret_grammar,
    "op2_page_template": op2_page_template,
    "op3_token_blocks": op3_token_blocks,
    "op4_quality_votes": op4_quality_votes,
    "op5_toxic_bags": op5_toxic_bags,
    "op6_decontaminate": op6_decontaminate,
    "op7_simhash_tree": op7_simhash_tree,
    "op8_shard_pack": op8_shard_pack,
    "op9_mixing_tree": op9_mixing_tree,
    "op10_license_index": op10_license_index,
    "op11_code_bounds": op11_code_bounds,
    "op12_grouped_join": op12_grouped_join,
    "op13_phrase_trie": op13_phrase_trie,
}

QUERIES = {name: shipped(query) for name, query in OPERATORS.items()}
