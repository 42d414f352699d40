"""A cleaning pipeline over ``documents``: quality rules, exact dedup, near-dedup, substring dedup, packing.

Each stage works on all its predecessor kept, and its decisions take effect. Stages that
decide by document join their decisions back on the row key, so null or repeated ids, extra
columns and equal rows are handled (``with_row_key``); null text counts as empty. Quality
rules reject texts of fewer than 20 words, hence null and empty ones too. An empty table gives
empty results of the same schema.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.exact_dedup import exact_dedup
from tessera.llm.near_dedup import near_dedup
from tessera.llm.packing import pack_documents
from tessera.llm.quality_rules import apply_policy, quality_ledger
from tessera.llm.rows import stage, with_row_key
from tessera.llm.substring_dedup import substring_dedup


def _keep(docs: DataFrame, key: str, decisions: DataFrame) -> DataFrame:
    """The documents that the decisions keep, without a row key that is not theirs."""
    kept = docs.join(decisions.where("kept").select(key), key, "left_semi")
    return kept if key == "doc_id" else kept.drop(key)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that policy v2 of the rule ledger accepts."""
    return apply_policy(quality_ledger(docs, carry=True), "v2").where("kept").select("row.*")


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    docs, key = with_row_key(docs, "doc_id", "text", "exact-rows")
    return _keep(docs, key, exact_dedup(docs, id_col=key))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component at similarity 0.8 on five-word shingles."""
    docs, key = with_row_key(docs, "doc_id", "text", "near-rows")
    return _keep(docs, key, near_dedup(docs, threshold=80, id_col=key))


def substring(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of windows that also start earlier; a changed text is its kept
    words joined by one space (empty if none is left), other texts stay as they are."""
    docs, key = with_row_key(docs, "doc_id", "text", "substring-rows")
    changed = substring_dedup(docs, id_col=key).where("n_removed > 0").select(key, F.col("kept_text").alias("_kept_text"))
    cut = F.col("_kept_text").isNotNull()
    kind = dict(docs.dtypes)
    joined = docs.join(changed, key, "left").withColumns({
        "n_chars": F.when(cut, F.char_length("_kept_text")).otherwise(F.col("n_chars")).cast(kind["n_chars"]),
        "text": F.when(cut, F.col("_kept_text")).otherwise(F.col("text"))})
    return joined.select(*[c for c in docs.columns if c != key or key == "doc_id"])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The cleaned documents in sequences of 4096 tokens."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality", quality), ("exact", exact), ("near", near), ("substring", substring), ("packing", packing)]

#: Tokenisation and sketching cannot be stated in SQL; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each result is written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stage(docs, f"pipeline-{name}")
    return docs
