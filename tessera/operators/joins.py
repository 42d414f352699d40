"""Joins between facts and dimensions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def enrich(child: DataFrame, parent: DataFrame, child_keys: Sequence[str],
           parent_keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Left-join parent attributes onto the child; the optimizer and AQE broadcast
    the parent if its measured bytes allow."""
    p = parent.select(*[F.col(k).alias(f"__pk{i}") for i, k in enumerate(parent_keys)], *columns)
    cond = [F.col(c) == F.col(f"__pk{i}") for i, c in enumerate(child_keys)]
    out = child.join(p, cond, "left")
    return out.drop(*[f"__pk{i}" for i in range(len(parent_keys))])


def level_switch_labels(fact: DataFrame, level_col: str, key_col: str,
                        dims: Mapping[str, tuple[DataFrame, str, str]],
                        label_col: str = "label") -> DataFrame:
    """Each row joins only the dimension of its own level (literal in the ON
    clause), the per-level labels are coalesced into one column."""
    out = fact
    labels: list[Column] = []
    for i, (level, (dim, dim_key, dim_label)) in enumerate(dims.items()):
        d = dim.select(F.col(dim_key).alias(f"__k{i}"), F.col(dim_label).alias(f"__l{i}"))
        out = out.join(d, (F.col(level_col) == F.lit(level)) & (F.col(key_col) == F.col(f"__k{i}")), "left")
        labels.append(F.col(f"__l{i}"))
        out = out.drop(f"__k{i}")
    out = out.withColumn(label_col, F.coalesce(*labels))
    return out.drop(*[f"__l{i}" for i in range(len(dims))])


def scope_to_universe(child: DataFrame, universe: DataFrame, child_keys: Sequence[str],
                      universe_keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(kept rows via left-semi, dropped rows via left-anti)."""
    u = universe.select(*[F.col(k).alias(f"__u{i}") for i, k in enumerate(universe_keys)])
    cond = [F.col(c) == F.col(f"__u{i}") for i, c in enumerate(child_keys)]
    return child.join(u, cond, "left_semi"), child.join(u, cond, "left_anti")


def scope_counts(child: DataFrame, universe: DataFrame, child_keys: Sequence[str],
                 universe_keys: Sequence[str]) -> DataFrame:
    """J6/Q10 in one pass: (n_kept, n_dropped) of scoping ``child`` to the universe,
    from a single left join against the distinct universe keys with a marker."""
    u = universe.select(*[F.col(k).alias(f"__u{i}") for i, k in enumerate(universe_keys)]).distinct() \
                .withColumn("__in", F.lit(True))
    cond = [F.col(c) == F.col(f"__u{i}") for i, c in enumerate(child_keys)]
    j = child.select(*child_keys).join(u, cond, "left")
    return j.agg(F.sum(F.when(F.col("__in"), 1).otherwise(0)).cast("bigint").alias("n_kept"),
                 F.sum(F.when(F.col("__in").isNull(), 1).otherwise(0)).cast("bigint").alias("n_dropped"))


def orphans(child: DataFrame, parent: DataFrame, child_keys: Sequence[str],
            parent_keys: Sequence[str], *, distinct_keys: bool = False) -> DataFrame:
    """Child rows (or distinct child keys) with no parent. A NULL child key
    never matches, so it counts as an orphan; filter NULLs first to exclude them."""
    c = child.select(*child_keys)
    if distinct_keys:
        c = c.distinct()
    p = parent.select(*[F.col(k).alias(f"__p{i}") for i, k in enumerate(parent_keys)])
    cond = [F.col(k) == F.col(f"__p{i}") for i, k in enumerate(child_keys)]
    return c.join(p, cond, "left_anti")


def range_lookup(df: DataFrame, value: Column, bands: DataFrame, low: str, high: str,
                 columns: Sequence[str]) -> DataFrame:
    """Left lookup of a value into [low, high] bands of any number.

    An equi-join on buckets of the value line, as wide as two mean bands: a band then
    meets two and a half buckets on average, so the bands grow by a bounded factor and a
    value meets the bands of one bucket only. The width takes one aggregate over the
    bands, which the caller reads from storage or states literally."""
    b = bands.select(F.col(low).alias("__lo"), F.col(high).alias("__hi"), *columns).where("__lo <= __hi")
    span = b.agg(F.avg(F.col("__hi").cast("double") - F.col("__lo").cast("double"))).first()[0]
    width = max(1.0, 2 * (span or 0.0))
    bucket = lambda c: F.floor(c.cast("double") / F.lit(width))
    b = b.withColumn("__bucket", F.explode(F.sequence(bucket(F.col("__lo")), bucket(F.col("__hi")))))
    out = df.join(b, (bucket(value) == F.col("__bucket")) & (value >= F.col("__lo")) & (value <= F.col("__hi")), "left")
    return out.drop("__lo", "__hi", "__bucket")
