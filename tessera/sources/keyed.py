"""A keyed table whose versions share files: merges rewrite only the files that hold matched keys."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators import merge as MG
from tessera.sources import lake


class CommitConflict(RuntimeError):
    """Other writers committed first, again and again."""


@dataclass(frozen=True)
class Merged:
    """What a merge did: the version it made, files it replaced, kept by reference and wrote."""

    version: int
    replaced: int
    kept: int
    written: int


class KeyedFiles:
    """A table of a declared schema, keyed by ``keys``, whose data files are never changed.

    A version is a manifest: one row for each data file with its number of rows and the range of the first
    key. Manifests are numbered by small files that are created atomically (``lake.create_once``), so of
    two writers that start from one version the second finds the number taken, and merges
    again into the version that the first has made. Readers see whole versions only, and old versions stay
    readable. ``rows_per_file`` bounds a file; each write is sorted by the keys, with disjoint ranges.
    """

    def __init__(self, spark: SparkSession, base: str, schema: T.StructType | str, keys: Sequence[str], rows_per_file: int = 5_000_000):
        self.spark, self.base, self.keys, self.rows_per_file = spark, base.rstrip("/"), list(keys), rows_per_file
        self.schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        lead = self.schema[self.keys[0]].dataType
        self.listing = T.StructType([T.StructField("path", T.StringType()), T.StructField("n", T.LongType()),
                                     T.StructField("lo", lead), T.StructField("hi", lead)])

    # ------------------------------------------------------------------ read

    def version(self) -> int:
        """The number of the last version; 0 before the first."""
        return max(map(int, lake.names_in(self.spark, f"{self.base}/_versions")), default=0)

    def _entry(self, version: int) -> tuple[str, int]:
        """The manifest's folder and the number of files of a version."""
        folder, n = lake.read_text(self.spark, f"{self.base}/_versions/{version:012d}").rsplit(" ", 1)
        return folder, int(n)

    def manifest(self, version: int | None = None) -> DataFrame:
        """(path, n, lo, hi) of the files of a version."""
        version = self.version() if version is None else version
        if not version:
            return self.spark.createDataFrame([], self.listing)
        return lake.read_table(self.spark, self._entry(version)[0], self.listing)

    def n_files(self, version: int | None = None) -> int:
        """How many files a version has."""
        version = self.version() if version is None else version
        return self._entry(version)[1] if version else 0

    def read(self, version: int | None = None, between: tuple | None = None) -> DataFrame:
        """A version of the table. ``between`` (smallest and largest first key) leaves out files by their ranges
        before any is opened; rows outside may remain in the others."""
        files = self.manifest(version)
        if between is not None:
            files = files.where((F.col("hi") >= F.lit(between[0])) & (F.col("lo") <= F.lit(between[1])))
        return self._rows([r.path for r in files.select("path").toLocalIterator()])

    def _rows(self, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    # ----------------------------------------------------------------- write

    def append(self, rows: DataFrame, onto: int | None = None) -> Merged:
        """Add rows; no file is read or replaced. ``onto``: see ``merge``."""
        for _ in range(20):
            version = self.version()
            made = self._commit(version, version if onto is None else onto, [], rows)
            if made is not None:
                return made
        raise CommitConflict(self.base)

    def merge(self, source: DataFrame, combine: Callable[[DataFrame, DataFrame], DataFrame] | None = None, tries: int = 20,
              onto: int | None = None, check: bool = True) -> Merged:
        """Merge ``source`` by ``combine(rows of the files that hold its keys, source)``; an upsert unless given.

        ``combine`` must return all rows of those files that go on, and the source's new rows. A key
        must be once in the source (else ``merge.MergeConflict``; ``check`` is for callers that see to it); null keys match nothing. ``onto`` names the version to go on from
        where that is not the last one (whose later versions a writer has given up).
        """
        combine = combine or (lambda now, new: MG.upsert(now, new, self.keys, check=False))
        folder = f"{self.base}/_sources/{uuid.uuid4().hex[:12]}"
        source.select(*[F.col(f.name).cast(f.dataType).alias(f.name) if f.name in source.columns else F.lit(None).cast(f.dataType).alias(f.name)
                        for f in self.schema]).write.parquet(folder)
        source = lake.read_table(self.spark, folder, self.schema)
        if check:
            MG.assert_unique_source(source, self.keys)
        try:
            for _ in range(tries):
                version = self.version()
                start = version if onto is None else onto
                touched = self._touched(self.manifest(start), source) if start else []
                made = self._commit(version, start, touched, combine(self._rows(touched), source))
                if made is not None:
                    return made
        finally:
            lake.remove(self.spark, folder)
        raise CommitConflict(f"{self.base}: {tries} tries")

    def _touched(self, files: DataFrame, source: DataFrame) -> list[str]:
        """Files that hold a key of the source: those whose range meets the source's, then, by their key columns alone, those that do."""
        lead = F.col(self.keys[0])
        lo, hi = source.agg(F.min(lead), F.max(lead)).first()
        if lo is None:
            return []
        near = [r.path for r in files.where((F.col("hi") >= F.lit(lo)) & (F.col("lo") <= F.lit(hi))).select("path").toLocalIterator()]
        if not near:
            return []
        keys = self._rows(near).select(*self.keys, F.col("_metadata.file_path").alias("__path"))
        hit = keys.join(source.select(*self.keys), self.keys, "left_semi").select("__path").distinct()
        return sorted(r[0] for r in hit.toLocalIterator())

    def _commit(self, version: int, start: int, touched: list[str], rows: DataFrame) -> Merged | None:
        """Write ``rows`` in place of the touched files of version ``start`` as the one after ``version``; None if another writer has made that one."""
        data = f"{self.base}/data/{uuid.uuid4().hex[:12]}"
        (rows.select(*self.schema.fieldNames()).repartitionByRange(*self.keys).sortWithinPartitions(*self.keys)
         .write.option("maxRecordsPerFile", self.rows_per_file).parquet(data))
        lead = F.col(self.keys[0])
        new = self._rows([data]).groupBy(F.col("_metadata.file_path").alias("path")).agg(
            F.count(F.lit(1)).alias("n"), F.min(lead).alias("lo"), F.max(lead).alias("hi")).collect()  # a row for each file
        files, manifest = self.manifest(start), f"{self.base}/manifests/{uuid.uuid4().hex[:12]}"
        if touched:
            files = files.join(self.spark.createDataFrame([(p,) for p in touched], "path string"), "path", "left_anti")
        n_kept = self.n_files(start) - len(touched)
        files.unionByName(self.spark.createDataFrame(new, self.listing)).coalesce(1 + n_kept // 100_000).write.parquet(manifest)
        if not lake.create_once(self.spark, f"{self.base}/_versions/{version + 1:012d}", f"{manifest} {n_kept + len(new)}"):
            lake.remove(self.spark, data)
            lake.remove(self.spark, manifest)
            return None
        return Merged(version + 1, len(touched), n_kept, len(new))

    def compact(self, most: int = 16) -> Merged | None:
        """Join the files of under a quarter of ``rows_per_file`` once there are more than ``most``; their rows stay as they are.

        Another writer's commit in between wins: compaction then leaves it to a later call."""
        version = self.version()
        if self.n_files(version) <= most:
            return None
        small = [r.path for r in self.manifest(version).where(F.col("n") < self.rows_per_file / 4).select("path").toLocalIterator()]
        return self._commit(version, version, small, self._rows(small)) if len(small) > most else None

    def forget(self, keep: int) -> int:
        """Delete all but the last ``keep`` versions, and the data files that only those refer to; returns how many files.

        For a time when no writer is at work and no reader holds an older version."""
        numbers = lake.names_in(self.spark, f"{self.base}/_versions")
        old, live = numbers[:-keep], numbers[-keep:]
        if not old:
            return 0
        listed = lambda names: self.spark.read.schema(self.listing).parquet(*[self._entry(int(n))[0] for n in names]).select("path").distinct()
        dead = [r.path for r in listed(old).join(listed(live), "path", "left_anti").toLocalIterator()]
        for n in old:
            folder = self._entry(int(n))[0]
            lake.remove(self.spark, f"{self.base}/_versions/{n}")
            lake.remove(self.spark, folder)
        for path in dead:
            lake.remove(self.spark, path)
        for folder in sorted({p.rsplit("/", 1)[0] for p in dead}):
            if not any(n.startswith("part-") for n in lake.names_in(self.spark, folder)):
                lake.remove(self.spark, folder)
        return len(dead)
