"""Ranking, keep-one and rolling operators.

Keep-one-per-key operators are written as ``min``/``max`` over a struct whose
leading fields are the ordering keys: an aggregate with map-side partial
aggregation, so a key holding a third of all rows is pre-reduced on every
partition instead of being sorted whole inside one task. (A struct buffer is not
a fixed-width hash-map slot, so Spark plans it as a partial + final sort-based
aggregate; both phases spill, and the partial phase still cuts every key to one
row per partition before the shuffle.)
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def sortable(c: Column, kind: str = "num") -> Column:
    """A numeric stand-in for a column so it can be negated for descending order."""
    if kind == "ts":
        from tessera.functions.dates import ntz_micros
        return ntz_micros(c)
    if kind == "date":
        return F.unix_date(c)
    return c


def desc_nulls_last(c: Column, kind: str = "num") -> list[Column]:
    """Ordering fields that make ascending ``min`` behave as ``DESC NULLS LAST``."""
    return [c.isNull(), -sortable(c, kind)]


def asc_nulls_first(c: Column) -> list[Column]:
    return [c.isNotNull(), c]


def asc_nulls_last(c: Column) -> list[Column]:
    return [c.isNull(), c]


def keep_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
             payload: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the row with the smallest ``order`` tuple (ties broken by
    the payload columns, so the result is deterministic)."""
    payload = [c for c in (payload or df.columns) if c not in keys]
    st = F.struct(*[o.alias(f"__o{i}") for i, o in enumerate(order)], *[F.col(p) for p in payload])
    picked = df.groupBy(*keys).agg(F.min(st).alias("__pick"))
    return picked.select(*keys, *[F.col(f"__pick.{p}").alias(p) for p in payload])


def keep_one_with_dropped(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                          payload: Sequence[str] | None = None) -> DataFrame:
    """Keep-one plus the number of rows dropped for each key (``n_dropped``)."""
    payload = [c for c in (payload or df.columns) if c not in keys]
    st = F.struct(*[o.alias(f"__o{i}") for i, o in enumerate(order)], *[F.col(p) for p in payload])
    picked = df.groupBy(*keys).agg(F.min(st).alias("__pick"), (F.count(F.lit(1)) - 1).alias("n_dropped"))
    return picked.select(*keys, *[F.col(f"__pick.{p}").alias(p) for p in payload], "n_dropped")


def flag_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column], id_cols: Sequence[str],
               flag: str = "is_primary") -> DataFrame:
    """Mark the first row per key on ALL candidate rows.

    The winner per key is found with the partial-aggregated ``keep_one`` and joined
    back on (key, id): a skewed key is split by AQE's skew-join handling rather than
    sorted inside one window partition."""
    win = keep_one(df.select(*keys, *id_cols, *[o.alias(f"__w{i}") for i, o in enumerate(order)]),
                   keys, [F.col(f"__w{i}") for i in range(len(order))], id_cols)
    win = win.select(*[F.col(k).alias(f"__k_{k}") for k in keys], *[F.col(c).alias(f"__i_{c}") for c in id_cols]) \
             .withColumn(flag, F.lit(True))
    cond = [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys] + \
           [F.col(c).eqNullSafe(F.col(f"__i_{c}")) for c in id_cols]
    out = df.join(win, cond, "left")
    return out.drop(*[f"__k_{k}" for k in keys], *[f"__i_{c}" for c in id_cols]) \
              .withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def trailing(df: DataFrame, part: Sequence[str], day_col: str, value_col: str, days: int,
             fn: str = "avg") -> Column:
    """Aggregate of ``value_col`` over the previous ``days`` days (excluding today).

    Intended for pre-aggregated daily series (one row per part and day), whose
    size is bounded by the calendar, never for raw rows."""
    w = (Window.partitionBy(*part).orderBy(F.unix_date(F.col(day_col)))
         .rangeBetween(-days, -1))
    v = F.col(value_col)
    if fn == "median":
        # median over a bounded frame: sort the frame's values (<= ``days`` of them)
        a = F.array_sort(F.collect_list(v).over(w))
        n = F.size(a)
        mid = F.element_at(a, ((n + 1) / 2).cast("int"))
        even = (F.element_at(a, (n / 2).cast("int")) + F.element_at(a, (n / 2).cast("int") + 1)) / 2
        return F.when(n == 0, None).when(n % 2 == 1, mid).otherwise(even)
    agg = {"avg": F.avg(v), "sum": F.sum(v), "count": F.count(v)}[fn]
    return agg.over(w)
