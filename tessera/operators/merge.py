"""Upsert, overlay, revision and history semantics as DataFrame algebra.

Plain parquet tables have no MERGE; each operator computes the next version of
the table, which the caller writes to a new folder (never over the input).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


class MergeConflict(ValueError):
    """Two source rows match one target row (MERGE would fail the same way)."""


def assert_unique_source(source: DataFrame, keys: Sequence[str]) -> None:
    """TR3: a source key matching twice would make a MERGE fail; refuse it up front."""
    dup = (source.filter(F.coalesce(*[F.col(k).isNotNull() for k in keys]))
           .groupBy(*keys).count().filter(F.col("count") > 1).limit(1).count())
    if dup:
        raise MergeConflict(f"source holds duplicate keys on {list(keys)}")


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], *, check: bool = True) -> DataFrame:
    """U4: matched rows take the source row, unmatched source rows are inserted,
    target-only rows stay. A NULL key never matches (it is inserted)."""
    if check:
        assert_unique_source(source, keys)
    s_keys = source.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)])
    cond = [F.col(k) == F.col(f"__k{i}") for i, k in enumerate(keys)]  # NULL never equals -> never matched
    kept = target.join(s_keys, cond, "left_anti")
    return kept.unionByName(source.select(*target.columns))


def upsert_columns(target: DataFrame, source: DataFrame, keys: Sequence[str], columns: Sequence[str],
                   stamp_col: str | None = None, stamp: Column | None = None, *, check: bool = True) -> DataFrame:
    """Only the listed columns are taken from the source; every other column of
    a matched row survives; inserted rows get NULL there. The writer sets the stamp
    on every touched row."""
    if check:
        assert_unique_source(source, keys)
    s = source.select(*keys, *[F.col(c).alias(f"__s_{c}") for c in columns]).withColumn("__hit", F.lit(True))
    j = target.withColumn("__t", F.lit(True)).join(s, list(keys), "full_outer")
    out = []
    for c in target.columns:
        if c in keys:
            out.append(F.col(c))
        elif c in columns:
            out.append(F.when(F.col("__hit").isNotNull(), F.col(f"__s_{c}")).otherwise(F.col(c)).alias(c))
        elif stamp_col is not None and c == stamp_col:
            out.append(F.when(F.col("__hit").isNotNull(), stamp).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return j.select(*out)


def overlay(base: DataFrame, update: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Update wins per key, base-only rows kept, update-only rows appended;
    each row keeps the label of the side that won."""
    return base.join(update.select(*keys), list(keys), "left_anti").unionByName(update)


def _bucketed_neighbor(df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: Column,
                       value: Column, direction: str, out: str) -> DataFrame:
    """Previous (``lag``) or next (``lead``) ``value`` per key in ``order``, computed
    without ever sorting a whole key in one task.

    Rows are windowed per (key, bucket) — a hot key is spread over its buckets —
    and the first (last) row of each bucket takes its neighbour from the nearest
    non-empty earlier (later) bucket of the same key, found on a per-(key, bucket)
    aggregate that is pre-reduced map-side."""
    ordered = F.struct(*[F.col(o) for o in order])
    d = df.withColumn("__b", bucket)
    w = Window.partitionBy(*keys, "__b").orderBy(*order)
    if direction == "lag":
        d = d.withColumn("__in", F.lag(value).over(w)).withColumn("__edge", F.row_number().over(w) == 1)
        ends = d.groupBy(*keys, "__b").agg(F.max_by(value, ordered).alias("__end"))
        link = F.lag("__end").over(Window.partitionBy(*keys).orderBy("__b"))
    else:
        wd = Window.partitionBy(*keys, "__b").orderBy(*[F.col(o).desc() for o in order])
        d = d.withColumn("__in", F.lead(value).over(w)).withColumn("__edge", F.row_number().over(wd) == 1)
        ends = d.groupBy(*keys, "__b").agg(F.min_by(value, ordered).alias("__end"))
        link = F.lead("__end").over(Window.partitionBy(*keys).orderBy("__b"))
    # one row per (key, bucket): bounded by the number of buckets a key spans; keys may be null
    ends = ends.withColumn("__link", link).select("__link", *[F.col(k).alias(f"__k_{k}") for k in [*keys, "__b"]])
    same = [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in [*keys, "__b"]]
    d = d.join(ends, same, "left").drop(*[f"__k_{k}" for k in [*keys, "__b"]])
    return d.withColumn(out, F.when(F.col("__edge"), F.col("__link")).otherwise(F.col("__in"))) \
            .drop("__b", "__in", "__edge", "__link")


def overlay_added(base: DataFrame, update: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row with the number of update-only keys the overlay appends."""
    added = update.select(*keys).distinct().join(base.select(*keys).distinct(), list(keys), "left_anti")
    return added.agg(F.count(F.lit(1)).alias("added"))


def scd2(snapshots: DataFrame, keys: Sequence[str], order: Sequence[str], tracked: Sequence[str],
         from_col: str, bucket: Column | None = None) -> DataFrame:
    """History rows from ordered snapshots. A new version starts whenever the
    tracked values change; ``_effective_to`` is the next version's start.

    ``bucket`` (default: the day of ``from_col``) must be non-decreasing in ``order``; it
    only decides how a key's snapshots are split across tasks, never the result. The
    projected snapshots and the version starts are checkpointed once each, so the
    source is read a single time. Null keys are a key like others."""
    bucket = bucket if bucket is not None else F.datediff(F.col(from_col), F.lit("1970-01-01"))
    names = list(dict.fromkeys([*keys, *order, *tracked, from_col]))
    snapshots = snapshots.select(*names).checkpoint()
    state = F.struct(*[F.col(c) for c in tracked])  # compared exactly, no hash collisions
    s = _bucketed_neighbor(snapshots.withColumn("__h", state), keys, order, bucket, F.col("__h"), "lag", "__prev")
    v = s.filter(F.col("__prev").isNull() | ~F.col("__prev").eqNullSafe(F.col("__h")))
    v = v.withColumn("__first", F.col("__prev").isNull()).drop("__prev", "__h").checkpoint()
    v = _bucketed_neighbor(v, keys, order, bucket, F.col(from_col), "lead", "_effective_to")
    return v.select(*keys, *tracked, F.col(from_col).alias("_effective_from"), "_effective_to",
                    F.col("_effective_to").isNull().alias("_is_current"),
                    F.when(F.col("__first"), "insert").otherwise("update").alias("_change_type"))


def as_of(history: DataFrame, t: Column) -> DataFrame:
    """The version valid at ``t``: from <= t and (to > t or to is NULL)."""
    return history.filter((F.col("_effective_from") <= t) &
                          (F.col("_effective_to").isNull() | (F.col("_effective_to") > t)))


def version_key(c: Column) -> Column:
    """U12/TR8: a dotted version string as an int array, so '1.11' > '1.9'."""
    return F.transform(F.split(c, r"\."), lambda x: x.cast("int"))
