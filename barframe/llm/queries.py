"""The operators' queries over the given tables, and their SQL twins where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from barframe.llm import (bpe_trie, conversation_repair, gam, html_diff, mixing, nn_descent, quality_rules, quotes,
                          simhash, spelling, suffix_dedup, token_files, toxicity)
from barframe.llm.common import read_table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op3_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.document_groups(read_table(spark, sf_dir, "documents"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_file_digests(read_table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_verdicts(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_diff.main_text(read_table(spark, sf_dir, "pages"))


def op7_embedding_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nn_descent.near_duplicates(read_table(spark, sf_dir, "embeddings"), with_audit=True)


def op8_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gam.quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op9_bpe_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_trie.digests(bpe_trie.encode_documents(read_table(spark, sf_dir, "documents")))


def op10_quote_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quotes.link_quotations(read_table(spark, sf_dir, "conversations"))
    return out.selectExpr("conv_id", "turn", "role", "reply", "parent_turn", "quoted_lines", "linked_lines", "chain",
                          "array_join(reply_path, ' ') as reply_path", "chat")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversation_repair.damaged(read_table(spark, sf_dir, "conversations"))
    return conversation_repair.repair_conversations(rows)


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents")))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(read_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_mix_sources": op2_mix_sources,
    "op3_simhash_groups": op3_simhash_groups,
    "op4_token_files": op4_token_files,
    "op5_quality_rules": op5_quality_rules,
    "op6_main_text": op6_main_text,
    "op7_embedding_groups": op7_embedding_groups,
    "op8_quality_gam": op8_quality_gam,
    "op9_bpe_trie": op9_bpe_trie,
    "op10_quote_links": op10_quote_links,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_suffix_dedup": op12_suffix_dedup,
    "op13_spelling_variants": op13_spelling_variants,
}

SQL = {
    "op2_mix_sources": mixing.ORACLE_SQL,
    "op5_quality_rules": quality_rules.oracle_sql(),
}
