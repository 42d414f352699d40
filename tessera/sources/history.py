"""A stored history (U7): loads of ordered snapshots are merged in one by one, as-of reads prune by interval."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators import merge as MG
from tessera.session import shared_path
from tessera.sources import lake
from tessera.sources.keyed import CommitConflict, KeyedFiles

#: What a history adds to the keys and tracked columns.
FROM, TO, CURRENT, CHANGE = "_effective_from", "_effective_to", "_is_current", "_change_type"


class HistoryTable:
    """Versions of keyed rows, open ones in ``current`` (led by the key), ended ones in ``closed`` (led by their end).

    ``load`` versions one load of snapshots by itself (``merge.scd2``) and joins only its keys to ``current``: an open
    version goes on where the load's first one equals it, and is ended where it differs. Files of
    ``current`` that hold none of the changed keys stay, and ``closed`` is only appended to. Both parts
    become visible at once through one numbered file that names their versions, so a load that
    dies leaves the history as it was, and is run again. Loads must follow each other in time.
    """

    def __init__(self, spark: SparkSession, base: str, schema: T.StructType | str, keys: Sequence[str], tracked: Sequence[str],
                 time_type: str = "date", rows_per_file: int = 5_000_000):
        self.spark, self.base, self.keys, self.tracked = spark, base.rstrip("/"), list(keys), list(tracked)
        given = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        when = T.StructType.fromDDL(f"{FROM} {time_type}, {TO} {time_type}, {CHANGE} string")
        self.schema = T.StructType([given[c] for c in [*keys, *tracked]] + when.fields)
        part = lambda name, lead: KeyedFiles(spark, f"{self.base}/{name}", self.schema, lead, rows_per_file)
        self.current, self.closed = part("current", self.keys), part("closed", [TO, *self.keys])

    def _state(self) -> tuple[int, int, int]:
        """(loads so far, version of current, version of closed)"""
        n = max(map(int, lake.names_in(self.spark, f"{self.base}/_loads")), default=0)
        return (n, *map(int, lake.read_text(self.spark, f"{self.base}/_loads/{n:012d}").split())) if n else (0, 0, 0)

    def load(self, snapshots: DataFrame, order: Sequence[str], from_col: str, bucket: Column | None = None) -> dict[str, int]:
        """Merge one load in; returns how many files of current it replaced and kept, and how many versions it ended."""
        n, v_current, v_closed = self._state()
        new = MG.scd2(snapshots, self.keys, order, self.tracked, from_col, bucket)
        now = self.current.read(v_current).select(*[F.col(c).alias(f"__{c}") for c in [*self.keys, *self.tracked, FROM, CHANGE]])
        known = new.join(now, [new[k].eqNullSafe(F.col(f"__{k}")) for k in self.keys], "left")
        known = known.withColumn("__met", F.col(f"__{CHANGE}").isNotNull())
        equal = F.lit(True)
        for c in self.tracked:
            equal = equal & F.col(c).eqNullSafe(F.col(f"__{c}"))
        first = F.col(CHANGE) == "insert"
        late = known.where(first & F.col("__met") & (F.col(FROM) < F.col(f"__{FROM}")))
        goes_on = first & F.col("__met") & equal
        folder = shared_path(self.spark, "history-load")
        rows = known.select(
            *self.keys, *self.tracked, F.when(goes_on, F.col(f"__{FROM}")).otherwise(F.col(FROM)).alias(FROM), TO,
            F.when(goes_on, F.col(f"__{CHANGE}")).when(first & F.col("__met"), "update").otherwise(F.col(CHANGE)).alias(CHANGE),
            (goes_on & F.col(TO).isNull()).alias("__same"), (first & F.col("__met") & ~equal).alias("__ends"),
            F.struct(*[F.col(f"__{c}").alias(c) for c in [*self.tracked, FROM, CHANGE]], F.col(FROM).alias(TO)).alias("__was"))
        if not late.isEmpty():
            raise ValueError("a load must not start before the versions that are open")
        rows.write.parquet(folder)
        rows = self.spark.read.parquet(folder)
        names = self.schema.fieldNames()
        ended = rows.where(F.col(TO).isNotNull()).select(*names).unionByName(
            rows.where("__ends").select(*self.keys, "__was.*").select(*names))
        closed = self.closed.append(ended, onto=v_closed)
        current = self.current.merge(rows.where(F.col(TO).isNull() & ~F.col("__same")).select(*names), onto=v_current)
        if not lake.create_once(self.spark, f"{self.base}/_loads/{n + 1:012d}", f"{current.version} {closed.version}"):
            raise CommitConflict(f"{self.base}: another load came first")
        return {"replaced": current.replaced, "kept": current.kept, "closed_files": closed.written}

    def read(self) -> DataFrame:
        """All versions."""
        _, v_current, v_closed = self._state()
        both = self.current.read(v_current).unionByName(self.closed.read(v_closed))
        return both.select(*self.keys, *self.tracked, FROM, TO, F.col(TO).isNull().alias(CURRENT), CHANGE)

    def as_of(self, t) -> DataFrame:
        """The versions valid at ``t`` (a value of the time type): from <= t, and to > t or open.

        Files of ended versions whose latest end is not after ``t`` are not opened; in all
        others both bounds are pushed to the scan."""
        _, v_current, v_closed = self._state()
        at = F.lit(t).cast(self.schema[FROM].dataType)
        files = self.closed.manifest(v_closed).where(F.col("hi") > at)
        closed = self.closed._rows([r.path for r in files.select("path").toLocalIterator()])
        both = self.current.read(v_current).where(F.col(FROM) <= at).unionByName(closed.where((F.col(FROM) <= at) & (F.col(TO) > at)))
        return both.select(*self.keys, *self.tracked, FROM, TO)
