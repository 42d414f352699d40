"""Quarantine split (Q12): tag each row with its first failing rule in one pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tag_reasons(df: DataFrame, rules: Sequence[tuple[str, Column]]) -> DataFrame:
    """Add ``reason`` (first failing rule, NULL when clean) and ``quarantined``."""
    reason = None
    for name, failed in rules:
        reason = F.when(failed, F.lit(name)) if reason is None else reason.when(failed, F.lit(name))
    return df.withColumn("reason", reason).withColumn("quarantined", F.col("reason").isNotNull())


def split(tagged: DataFrame, quarantined_at: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(clean rows, quarantine rows with reason and time). Persist ``tagged`` once
    (write it, or checkpoint) before writing both sides so the source is read once."""
    clean = tagged.filter(~F.col("quarantined")).drop("reason", "quarantined")
    bad = tagged.filter(F.col("quarantined")).drop("quarantined")
    if quarantined_at is not None:
        bad = bad.withColumn("quarantined_at", quarantined_at)
    return clean, bad
