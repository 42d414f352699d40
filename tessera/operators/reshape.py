"""Reshape between long and wide."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.dates import days_in_month


def long_to_wide(df: DataFrame, keys: Sequence[str], name_col: str, value_col: str,
                 names: Sequence[str], extra_aggs: Sequence[Column] = ()) -> DataFrame:
    """One row per key, one column per known name (conditional max).

    The name set is fixed up front, so this is a single hash aggregate with map-side
    partial aggregation — no extra job to discover pivot values."""
    aggs = [F.max(F.when(F.col(name_col) == n, F.col(value_col))).alias(n) for n in names]
    return df.groupBy(*keys).agg(*aggs, *extra_aggs)


def any_flag(cond: Column, alias: str) -> Column:
    """``MAX(CASE WHEN cond THEN 1 ELSE 0 END) = 1``."""
    return (F.max(F.when(cond, 1).otherwise(0)) == 1).alias(alias)


def wide_to_long(df: DataFrame, ids: Sequence[str], value_cols: Sequence[str],
                 var_name: str = "variable", value_name: str = "value") -> DataFrame:
    """One row per (ids, column) — a narrow Expand, no shuffle."""
    return df.unpivot(list(ids), list(value_cols), var_name, value_name)


def explode_alternates(df: DataFrame, name_col: str, alt_col: str, sep: str = "|",
                       out_col: str = "name") -> DataFrame:
    """One row per primary or alternate name."""
    names = F.concat(F.array(F.col(name_col)),
                     F.coalesce(F.split(F.col(alt_col), "\\" + sep if sep in "|.^$*+?" else sep),
                                F.array().cast("array<string>")))
    return df.withColumn(out_col, F.explode(names))


def wide_days_to_long(wide: DataFrame, ids: Sequence[str], year_col: str, month_col: str,
                      day_cols: Sequence[str], is_sentinel, value_name: str = "value",
                      date_name: str = "obs_date") -> DataFrame:
    """31 day columns -> one row per real calendar day.

    Days past the month end are dropped; a sentinel value becomes a NULL row (the
    day exists, the observation is missing)."""
    y, m = F.col(year_col), F.col(month_col)
    exploded = wide.select(*ids, y.alias("__y"), m.alias("__m"),
                           F.posexplode(F.array(*[F.col(c) for c in day_cols])).alias("__pos", "__raw"))
    day = F.col("__pos") + 1
    first = F.make_date(F.col("__y"), F.col("__m"), F.lit(1))
    kept = exploded.filter(day <= days_in_month(first))
    return kept.select(*ids, F.make_date(F.col("__y"), F.col("__m"), day).alias(date_name),
                       F.when(~is_sentinel(F.col("__raw")), F.col("__raw")).alias(value_name))
