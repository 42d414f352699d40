"""Sharding by weighted rendezvous hashing of stable record keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.rows import hex_number, stage


def _score(key: Column, shard: int, weight: float) -> Column:
    """-ln(u)/weight for a uniform u in (0, 1) drawn from (key, shard); the smallest score wins,
    which gives each shard a share in proportion to its weight."""
    u = (hex_number(F.md5(F.concat(key, F.lit(f"|{shard}"))), 1, 13).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))
    return -F.log(u) / F.lit(float(weight))


def _winner(key: Column, weights: dict[int, float]) -> Column:
    return F.array_min(F.array(*[F.struct(_score(key, s, w).alias("score"), F.lit(s).alias("shard"))
                                 for s, w in sorted(weights.items())]))


def rendezvous_shards(df: DataFrame, weights: dict[int, float], grown: dict[int, float] | None = None,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Deal rows to weighted shards so that only their key decides, with gapless slots inside a shard.

    ``weights``: shard number to weight (> 0). ``grown``: shards to add; a row's ``grown_shard``
    is its old shard or one of these, never another old one, since the other scores do not
    change. Returns one row per input row: (``id_col``, size, text_crc32, law, shard, slot,
    grown_shard); size is the text's UTF-8 bytes plus 8.

    Slots follow the order of (key digest, text digest). They are counted in two levels:
    row numbers inside 4096 x 16 digest buckets of a shard, plus the rows of the buckets
    before, so that no task has to hold a whole shard, nor all rows of one repeated key.

    Null text counts as empty. A null id takes its text's digest as key. Rows that repeat a
    key go to the same shard, each with a slot of its own. An empty table gives no rows.
    """
    if not weights or min(weights.values()) <= 0 or set(weights) & set(grown or {}):
        raise ValueError("weights must be positive; grown shards must be new ones")
    text = F.coalesce(df[text_col], F.lit(""))
    key = F.when(df[id_col].isNull(), F.concat(F.lit("null|"), F.md5(text))).otherwise(df[id_col].cast("string"))
    rows = df.select(df[id_col].alias("id"), key.alias("k"), (F.octet_length(text).cast("long") + 8).alias("size"),
                     F.crc32(text).alias("crc"), F.md5(text).alias("td"))
    rows = rows.select("*", F.md5("k").alias("kd"), _winner(F.col("k"), weights).alias("old"))
    if grown:
        rows = rows.withColumn("new", _winner(F.col("k"), grown)).withColumn(
            "grown", F.when(F.col("new") < F.col("old"), F.col("new.shard")).otherwise(F.col("old.shard")))
    else:
        rows = rows.withColumn("grown", F.lit(None).cast("int"))
    rows = stage(rows.select("id", "size", "crc", "kd", "td", F.col("old.shard").alias("shard"), "grown",
                             hex_number(F.col("kd"), 1, 3).alias("b1"), hex_number(F.col("td"), 1, 1).alias("b2")), "shards")

    bucket = ["shard", "b1", "b2"]
    before = Window.partitionBy("shard").orderBy("b1", "b2").rowsBetween(Window.unboundedPreceding, -1)
    counts = (rows.groupBy(*bucket).agg(F.count(F.lit(1)).alias("n"))
              .select(*bucket, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")))
    inside = Window.partitionBy(*bucket).orderBy("kd", "td")
    numbered = rows.withColumn("rn", F.row_number().over(inside))
    return numbered.join(counts, bucket).select(
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.lit("key").alias("law"), "shard",
        (F.col("base") + F.col("rn") - 1).cast("long").alias("slot"), F.col("grown").alias("grown_shard"))
