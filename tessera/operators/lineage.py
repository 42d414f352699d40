"""Builds that know what they were made from: an unchanged one is skipped, and so is all that only it feeds."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from graphlib import TopologicalSorter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources import lake


def row_print(cols: Sequence[Column]) -> Column:
    """A number of 60 bits for a row of text columns: the md5 of the values, each led by its length, NULL by a letter of
    its own, so that neither NULLs nor what a value holds can shift one column into another."""
    said = [F.coalesce(F.concat(F.char_length(c).cast("string"), F.lit(":"), c), F.lit("n")) for c in cols]
    return F.conv(F.substring(F.md5(F.concat(*said)), 1, 15), 16, 10).cast("bigint")


def content_print(df: DataFrame, cols: Sequence[Column] | None = None) -> list[Column]:
    """Aggregates that tell whether rows are the same whatever their order: how many, and the sum of their prints."""
    cols = [F.col(f"`{c}`").cast("string") for c in df.columns] if cols is None else cols
    return [F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum(row_print(cols).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")).cast("string").alias("print")]


@dataclass(frozen=True)
class Build:
    """A derived table: what it reads (names of sources or builds), how it is made, and the version of that recipe."""

    name: str
    reads: tuple[str, ...]
    make: Callable[..., DataFrame]
    recipe: str = "1"


@dataclass
class BuildGraph:
    """Builds over sources below one folder. ``refresh`` makes exactly those that a change reaches.

    A build's signature is the hash of its recipe and of the signatures of what it reads, so it covers everything
    upstream, and a skip needs one comparison and no read of derived data. Sources are signed by their content, with one aggregate each.
    The signature becomes visible with the version it belongs to, in one file; a build that dies is made again."""

    spark: SparkSession
    base: str
    builds: Sequence[Build]
    signatures: dict[str, str] = field(default_factory=dict)

    def _stored(self, name: str) -> tuple[str, str] | None:
        """(signature, folder) of the last version of a build."""
        folder = f"{self.base.rstrip('/')}/{name}/_pointers"
        last = max(lake.names_in(self.spark, folder), default=None)
        return tuple(lake.read_text(self.spark, f"{folder}/{last}").split(" ", 1)) if last else None

    def table(self, name: str) -> DataFrame:
        """The last version of a build."""
        return self.spark.read.parquet(self._stored(name)[1])

    def refresh(self, sources: Mapping[str, DataFrame]) -> dict[str, bool]:
        """Bring all builds up to date in the order of what they read; for each whether it was made anew."""
        made: dict[str, bool] = {}
        self.signatures = {n: "/".join(map(str, df.agg(*content_print(df)).first())) for n, df in sources.items()}
        known = {b.name: b for b in self.builds}
        for name in TopologicalSorter({b.name: b.reads for b in self.builds}).static_order():
            if name not in known:
                if name not in sources:
                    raise KeyError(f"neither a source nor a build: {name}")
                continue
            b = known[name]
            upstream = "|".join(f"{r}={self.signatures[r]}" for r in sorted(b.reads))
            mark = self.signatures[name] = hashlib.sha256(f"{b.name}|{b.recipe}|{upstream}".encode()).hexdigest()
            stored = self._stored(name)
            made[name] = stored is None or stored[0] != mark
            if made[name]:
                folder = lake.new_version_path(f"{self.base.rstrip('/')}/{name}")
                frames = [sources[r] if r in sources else self.table(r) for r in b.reads]
                lake.full_refresh(b.make(*frames), folder)
                lake.point_to(self.spark, f"{self.base.rstrip('/')}/{name}", f"{mark} {folder}")
        return made
