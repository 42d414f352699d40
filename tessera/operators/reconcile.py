"""Set reconciliation and key-set comparisons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def symmetric_difference(a: DataFrame, b: DataFrame, keys: Sequence[str], a_label: str, b_label: str,
                         side_col: str = "side") -> DataFrame:
    """R2: keys only in ``a`` and keys only in ``b``, both listed with their side."""
    ka, kb = a.select(*keys).distinct(), b.select(*keys).distinct()
    return (ka.join(kb, list(keys), "left_anti").withColumn(side_col, F.lit(a_label))
            .unionByName(kb.join(ka, list(keys), "left_anti").withColumn(side_col, F.lit(b_label))))


def stale_keys(table: DataFrame, produced: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys present in the table but not produced by this run (an upsert never deletes them)."""
    return table.select(*keys).distinct().join(produced.select(*keys).distinct(), list(keys), "left_anti")


def declared_vs_actual(declared: DataFrame, actual: DataFrame, key: str, member: str) -> DataFrame:
    """Per declared key — members declared but absent (missing) and present but
    undeclared (extra). Keys that are not declared at all are ignored.

    Member sets are bounded by a vocabulary (privileges, segments), so each key's
    set is built with a map-side-merged collect_set; the report row lists them."""
    d = declared.groupBy(key).agg(F.collect_set(member).alias("__d"))
    a = actual.groupBy(key).agg(F.collect_set(member).alias("__a"))
    j = d.join(a, key, "left")
    a_set = F.coalesce(F.col("__a"), F.array().cast(d.schema["__d"].dataType))
    return j.select(key, F.array_join(F.array_sort(F.array_except("__d", a_set)), ">").alias("missing"),
                    F.array_join(F.array_sort(F.array_except(a_set, "__d")), ">").alias("extra"))


def count_parity(a: DataFrame, b: DataFrame, key: str, a_name: str = "n_a", b_name: str = "n_b") -> DataFrame:
    """Per-key row counts of two layers side by side (full outer)."""
    ca = a.groupBy(key).agg(F.count(F.lit(1)).alias(a_name))
    cb = b.groupBy(key).agg(F.count(F.lit(1)).alias(b_name))
    j = ca.join(cb, key, "full_outer")
    return j.select(key, F.coalesce(a_name, F.lit(0)).alias(a_name), F.coalesce(b_name, F.lit(0)).alias(b_name)) \
            .withColumn("diff", F.col(a_name) - F.col(b_name))
