"""A training corpus from raw documents: filter, deduplicate, mix, tokenize.

Every stage takes the documents that the stage before kept and calls one operator of ``barframe.llm``. ``run`` writes
each stage's result to the shared folder and reads it back, so that a lost executor never costs more than one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from barframe.llm import bpe_trie, common, gam, mixing, quality_rules, simhash


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep. A null or empty text has no words and fails the base rules; rows of one
    id, the null id too, stay together if any of them passes and go otherwise; without labels the base rules alone
    decide; an empty table stays empty. Other columns pass through, whatever their names."""
    return quality_rules.keep_good(docs, common.read_table(spark, sf_dir, "labels"))


def classifier_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts to be good. Null texts are scored as empty ones; equal texts have
    one score; rows of one id, the null id too, stay together if any of them is predicted good; a score at the bound
    is good; an empty table stays empty. Other columns pass through, whatever their names."""
    return gam.keep_good(docs, common.read_table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one of the smallest id. Texts without words are one group, null
    texts among them; of rows with one id in a group one stays; an empty table stays empty. Other columns pass through,
    whatever their names."""
    return simhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target shares; a row for each epoch that takes a document. A null source is one of its own, last in
    order; documents without words stay once; equal rows are taken each for itself; an empty table stays empty. Other
    columns pass through, whatever their names."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and what they decode to, as digests per row. A null text is an empty one (no ids, hash of nothing); equal
    rows give equal rows; null ids stay; an empty table gives an empty result. Other columns are not read."""
    return bpe_trie.digests(bpe_trie.encode_documents(docs))


STAGES = [
    ("quality rules", quality_filter),
    ("quality classifier", classifier_filter),
    ("SimHash near-dedup", near_dedup),
    ("mixing sources to target weights", mix_sources),
    ("BPE encoding and decoding", encode),
]

# Fingerprints, fitted models and rank-ordered merges are beyond SQL; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read_table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = common.materialise(docs, f"pipeline-{k}")
    return docs
