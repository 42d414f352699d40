"""Aggregation helpers."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def combine_scalars(*one_row_frames: DataFrame) -> DataFrame:
    """Merge several one-row aggregates (disjoint column names) into one row,
    without a cartesian join: union with missing columns, then ``max`` each."""
    u = one_row_frames[0]
    for f in one_row_frames[1:]:
        u = u.unionByName(f, allowMissingColumns=True)
    cols = []
    for f in one_row_frames:
        cols.extend(f.columns)
    return u.agg(*[F.max(c).alias(c) for c in cols])


def marked_summary(rows: DataFrame, key: str, mark: Column, n: int) -> DataFrame:
    """(n_rows, n_marked, sample) in one row from one pass; ``sample`` holds the ``n`` smallest keys that are marked.

    Each task reduces its rows to two counts and at most ``n`` keys, so the plan below is run once,
    and what is gathered at the end is bounded by ``n`` keys a task."""
    kind = rows.schema[key].dataType.simpleString()
    marked = rows.select(F.when(mark, F.col(key)).alias("key"), F.when(mark, 1).otherwise(0).cast("long").alias("mark"))

    def reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_rows = n_marked = 0
        best = None
        for b in batches:
            n_rows, n_marked = n_rows + b.num_rows, n_marked + (pc.sum(b.column(1)).as_py() or 0)
            found = b.column(0).drop_null()
            best = found if best is None else pa.concat_arrays([best, found])
            best = best.take(pc.sort_indices(best)[:n])
        if best is not None:
            ends = pa.array([0, len(best)], pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array([n_rows]), pa.array([n_marked]), pa.ListArray.from_arrays(ends, best)], ["n_rows", "n_marked", "best"])

    parts = marked.mapInArrow(reduced, f"n_rows long, n_marked long, best array<{kind}>")
    return parts.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).cast("long").alias("n_rows"), F.coalesce(F.sum("n_marked"), F.lit(0)).cast("long").alias("n_marked"),
                     F.slice(F.array_sort(F.flatten(F.collect_list("best"))), 1, n).alias("sample"))


def ordered_sample(df: DataFrame, col: str, n: int, alias: str, sep: str = ">") -> DataFrame:
    """O2: the ``n`` smallest values of ``col`` joined by ``sep`` (one row).

    ``orderBy().limit(n)`` plans as a per-partition top-k plus a bounded merge, so
    only ``n`` values per partition ever move."""
    top = df.select(col).orderBy(col).limit(n)
    vals = F.array_sort(F.collect_list(F.col(col)))
    return top.agg(F.when(F.size(vals) > 0, F.array_join(vals, sep)).alias(alias))


def distribution(df: DataFrame, value: Column, flag: Column | None = None, none_label: str = "<none>") -> DataFrame:
    """{value: count}, NULL bucketed as ``<none>``, share of all rows, and the
    share of flagged rows within each value."""
    aggs = [F.count(F.lit(1)).alias("n")]
    if flag is not None:
        aggs.append(F.round(F.avg(F.when(flag, 1.0).otherwise(0.0)), 6).alias("flag_share"))
    g = df.groupBy(F.coalesce(value, F.lit(none_label)).alias("value")).agg(*aggs)
    from pyspark.sql import Window
    # one row per distinct value (a small vocabulary), so a global window is cheap
    return g.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy()), 6))


def sorted_members(df: DataFrame, group: Sequence[str], member: str, alias: str, sep: str = ">") -> DataFrame:
    """Sorted distinct members per group, as text.

    The output row holds the whole member list, so this is meant for groupings
    whose member sets are bounded by a dimension (states per region, nations per
    region); the de-duplication itself is partial-aggregated (collect_set is
    merged map-side)."""
    return df.groupBy(*group).agg(F.array_join(F.array_sort(F.collect_set(F.col(member).cast("string"))), sep).alias(alias))
