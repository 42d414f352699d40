"""Weighted crosswalks.

Long form: (source_id, target_id, weight_kind, weight). Applying one is an
equi-join plus ``sum(value * weight)`` grouped by target; composing two is a join
on the shared middle level plus ``sum(w1 * w2)`` — both are partial-aggregated
hash aggregates, no pair enumeration beyond the crosswalk's own rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import aggregates as A


def unpivot_weights(wide: DataFrame, ids: Sequence[str], weight_cols: Sequence[str],
                    kind_col: str = "weight_kind", weight_col: str = "weight") -> DataFrame:
    """Weight columns -> rows per kind; absent columns, NULL, NaN and non-numeric
    values are skipped. Column names match case-insensitively (one rule everywhere)."""
    lower = {c.lower(): c for c in wide.columns}
    present = [lower[w.lower()] for w in weight_cols if w.lower() in lower]
    if not present:
        return wide.select(*ids, F.lit(None).cast("string").alias(kind_col),
                           F.lit(None).cast("double").alias(weight_col)).limit(0)
    cast = wide.select(*ids, *[F.col(c).cast("string").try_cast("double").alias(c.lower()) for c in present])
    long = cast.unpivot(list(ids), [c.lower() for c in present], kind_col, weight_col)
    return long.filter(F.col(weight_col).isNotNull() & ~F.isnan(weight_col))


def weight_sums(xw: DataFrame, source: str, kinds: Sequence[str], kind: str = "weight_kind",
                weight: str = "weight", tolerance: float = 1e-3, sample: int = 10) -> DataFrame:
    """A5/K3: per kind — sources checked, sources whose weights do not sum to 1
    within ``tolerance``, and an ordered sample of at most ``sample`` offenders.

    Sums are a partial-aggregated hash aggregate; the sample of each kind (a small
    closed vocabulary) is a bounded top-k, so no kind is ever gathered in one task."""
    per = xw.groupBy(source, kind).agg(F.sum(weight).alias("__total"))
    # materialised once: the counts and every per-kind sample read it
    per = per.withColumn("__bad", F.abs(F.col("__total") - 1) > tolerance).checkpoint()
    counts = per.groupBy(kind).agg(F.count(F.lit(1)).alias("n_sources"),
                                   F.sum(F.when(F.col("__bad"), 1).otherwise(0)).cast("bigint").alias("n_bad"))
    bad = per.filter("__bad")
    samples = None
    for k in kinds:
        s = A.ordered_sample(bad.filter(F.col(kind) == k), source, sample, "bad_sample") \
             .withColumn(kind, F.lit(k))
        samples = s if samples is None else samples.unionByName(s)
    return counts.join(samples, kind, "left")


def select_slice(xw: DataFrame, **eq) -> DataFrame:
    """K1: choose one crosswalk slice by equality on its descriptor columns."""
    cond = F.lit(True)
    for k, v in eq.items():
        cond = cond & (F.col(k) == F.lit(v))
    return xw.filter(cond)


def allocate(values: DataFrame, value_key: str, value_col: str, xw: DataFrame, source: str, target: str,
             weight: str = "weight", out_col: str = "allocated") -> DataFrame:
    """K2: spread each source's measure over its targets: ``sum(value * weight)`` per target."""
    j = values.select(F.col(value_key).alias(source), F.col(value_col).alias("__v")).join(xw, source)
    return j.groupBy(target).agg(F.sum(F.col("__v") * F.col(weight)).alias(out_col))


def compose(first: DataFrame, second: DataFrame, source: str, middle: str, target: str,
            weight: str = "weight") -> DataFrame:
    """K2: chain two crosswalks through their shared level; weights multiply and sum."""
    a = first.select(source, middle, F.col(weight).alias("__w1"))
    b = second.select(middle, target, F.col(weight).alias("__w2"))
    return a.join(b, middle).groupBy(source, target).agg(F.sum(F.col("__w1") * F.col("__w2")).alias(weight))
