"""Exact dedup: group by a 128-bit content hash, keep one stable row, compare bytes inside the groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.rows import WS, id_and_text, stage


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_bits: int = 128) -> DataFrame:
    """Mark the one row that stays of every group of equal texts.

    Texts are equal when they are the same bytes after deleting space and U+0009-U+000D. Of
    equal texts, the row with the most code points (original text), then the smallest id
    stays. Returns one row per input row: (``id_col``, keep_id, group_size, kept, text_sha256).

    Method: a slim table (id, 128-bit hash, length, SHA-256) is staged; no text is in it. A
    second pass collapses (hash, bytes) with map-side combine, so a group that holds a third
    of all rows sends one text per task, and lists the hashes under which bytes differ. Those
    groups are split by SHA-256, whose groups have passed the same byte comparison. The row
    to keep is a partially aggregated minimum; it joins back on the hash (AQE splits a hot one).

    Null text counts as empty; empty texts equal each other. Null ids sort last. Of rows that
    repeat id and text exactly one stays. An empty table gives no rows.
    """
    if not 4 <= hash_bits <= 128 or hash_bits % 4:
        raise ValueError("hash_bits: a multiple of 4 up to 128")
    norm = F.translate("text", WS, "")
    texts = id_and_text(df, id_col, text_col).select(
        "id", "text", norm.alias("norm"), F.substring(F.md5(norm), 1, hash_bits // 4).alias("h"),
        F.unhex(F.sha2(norm, 256)).alias("sha"))
    keys = stage(texts.select("id", "h", "sha", F.char_length("text").alias("n_chars"),
                              F.monotonically_increasing_id().alias("tag")), "exact-keys")

    distinct = texts.select("h", "sha", "norm").distinct()
    per_sha = distinct.groupBy("h", "sha").agg(F.count(F.lit(1)).alias("n"))
    differ = (per_sha.groupBy("h").agg(F.sum("n").alias("texts"), F.count(F.lit(1)).alias("shas"))
              .where("texts > 1"))
    differ = stage(differ, "exact-collisions")
    if not differ.where("texts <> shas").isEmpty():
        raise ValueError("two texts share both hash and SHA-256")
    if differ.isEmpty():
        keyed = keys.withColumn("g", F.col("h"))
    else:
        keyed = (keys.join(differ.select("h", "texts"), "h", "left")
                 .withColumn("g", F.when(F.col("texts").isNull(), F.col("h"))
                             .otherwise(F.concat("h", F.lit(":"), F.hex("sha")))))

    best = F.min(F.struct((-F.col("n_chars")).alias("c"), F.col("id").isNull().alias("no_id"), "id", "tag"))
    # staged, so that both sides of the join are plain exchanges, of which AQE can split a hot one
    groups = stage(keyed.groupBy("g").agg(F.count(F.lit(1)).alias("group_size"), best.alias("best")), "exact-groups")
    return keyed.join(groups, "g").select(
        F.col("id").alias(id_col), F.col("best.id").alias("keep_id"), "group_size",
        (F.col("tag") == F.col("best.tag")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))
