"""File-landing streams: AvailableNow triggers, checkpointed progress in the shared
folder, foreachBatch upserts that are safe to re-run (T1-T4)."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators import merge as MG
from tessera.operators import windows as W
from tessera.sources import lake
from tessera.sources.keyed import KeyedFiles, Merged
from tessera.sources.lake import is_missing_path


def land_files(df: DataFrame, path: str, n_files: int | None = None) -> str:
    """Stage a payload as files in a folder of its own below ``path`` and return that
    folder; its ``_SUCCESS`` marker says that this landing is complete. Files follow the
    frame's partitions unless ``n_files`` is given."""
    folder = f"{path.rstrip('/')}/load-{uuid.uuid4().hex[:12]}"
    (df.repartition(n_files) if n_files else df).write.parquet(folder)
    return folder


def landing_complete(spark: SparkSession, folder: str) -> bool:
    """The completion marker of one landing is present."""
    try:
        spark.read.text(f"{folder.rstrip('/')}/_SUCCESS")
        return True
    except AnalysisException as e:
        if is_missing_path(e):
            return False
        raise


def file_stream(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    """Files of all landings below ``path``; those still being written are not visible."""
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", str(max_files))
    return r.parquet(f"{path.rstrip('/')}/*")


def run_available_now(stream: DataFrame, checkpoint: str, *, sink_path: str | None = None,
                      foreach_batch: Callable[[DataFrame, int], None] | None = None,
                      output_mode: str = "append") -> int:
    """Drain everything available now, then stop. Progress lives in ``checkpoint``,
    so a re-run only picks up files that arrived since. Returns how many rows the
    stateful operators left out as later than the watermark (of the last batches that Spark reports)."""
    w = stream.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if foreach_batch is not None:
        q = w.foreachBatch(foreach_batch).start()
    else:
        q = w.format("parquet").option("path", sink_path).start()
    q.awaitTermination()
    if q.exception():
        raise RuntimeError(str(q.exception()))
    return sum(op["numRowsDroppedByWatermark"] for p in q.recentProgress for op in p["stateOperators"])


def on_clock(rows: DataFrame, time: str) -> DataFrame:
    """``rows`` with an event time that can carry a watermark: one without a zone becomes that instant of UTC, whatever the session's zone."""
    if not isinstance(rows.schema[time].dataType, T.TimestampNTZType):
        return rows
    c = F.col(time)
    return rows.withColumn(time, F.make_timestamp(F.year(c), F.month(c), F.day(c), F.hour(c), F.minute(c), F.extract(F.lit("SECOND"), c), F.lit("UTC")))


def wall_time(c: Column) -> Column:
    """An instant as the time without a zone that UTC's clocks show."""
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.unix_micros(c) / F.lit(1_000_000)).cast("decimal(18,6)"))


class PartitionedTable:
    """A keyed table of a declared schema, partitioned by ``partition_col`` and merged per
    micro-batch; a restarted job reads it as before.

    Each batch rewrites only the partitions it touches (``lake.merge_partitions``);
    the cost of a batch grows with the batch, not with the table. Staging folders
    are named by batch id, so a replayed batch rewrites the same content. The keys
    must hold the partition column: otherwise a row whose partition changes would
    leave its older self behind."""

    def __init__(self, spark: SparkSession, base: str, partition_col: str, schema: T.StructType | str, keys: Sequence[str]):
        if partition_col not in keys:
            raise ValueError(f"keys {list(keys)} lack the partition column {partition_col!r}")
        self.spark, self.base, self.path = spark, base.rstrip("/"), f"{base.rstrip('/')}/table"
        self.partition_col, self.keys = partition_col, list(keys)
        self.schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema

    def read(self) -> DataFrame:
        """The table; empty before the first batch."""
        now = lake.try_read(self.spark, self.path, self.schema)
        return self.spark.createDataFrame([], self.schema) if now is None else now

    def merge(self, source: DataFrame, batch_id: int, combine) -> None:
        typed = source.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields])
        lake.merge_partitions(self.spark, self.path, typed, self.partition_col, combine,
                              f"{self.base}/_staging/b-{batch_id:08d}")


def upsert_batches(table: PartitionedTable,
                   prepare: Callable[[DataFrame], DataFrame] = lambda b: b) -> Callable[[DataFrame, int], None]:
    """foreachBatch function that upserts the batch's rows on the table's keys. Rows, not
    totals: a total of one batch must not replace that of another (see ``PartialSums``)."""
    def fn(batch: DataFrame, batch_id: int) -> None:
        table.merge(prepare(batch), batch_id, lambda cur, src: MG.upsert(cur, src, table.keys))
    return fn


def latest_revision_batches(table: PartitionedTable, revision: str,
                            prepare: Callable[[DataFrame], DataFrame] = lambda b: b) -> Callable[[DataFrame, int], None]:
    """foreachBatch function — the highest revision per key wins, whichever
    batch it arrives in (a late revision replaces the earlier row, never duplicates)."""
    def combine(cur: DataFrame, src: DataFrame) -> DataFrame:
        return W.keep_one(cur.unionByName(src), table.keys, [-F.col(revision)])

    def fn(batch: DataFrame, batch_id: int) -> None:
        table.merge(W.keep_one(prepare(batch), table.keys, [-F.col(revision)]), batch_id, combine)
    return fn


class RevisionStream:
    """The highest revision per key of a stream, with state for its recent keys and no row lost to lateness.

    * ``on_time``: a watermark of ``delay`` behind the newest event time bounds the state in which
      ``dropDuplicatesWithinWatermark`` keeps recent (key, revision) pairs; what passes is merged into ``main``
      (``KeyedFiles``), a file being rewritten only if it holds one of the batch's keys.
    * ``set_late_aside``: rows later than that never pass. A second stream over the same files, with a checkpoint of
      its own, appends every row to ``late`` for which ``main`` has neither its revision nor a higher one.
    * ``absorb``: a job of its own merges what lies in ``late`` into ``main``, once.

    So main and late together hold every key's highest revision at any time after the two streams, and ``main``
    alone does after ``absorb``; a stream or job that dies is run again. Call the three in this order."""

    def __init__(self, spark: SparkSession, base: str, schema: T.StructType | str, keys: Sequence[str], revision: str,
                 event_time: str, delay: str, rows_per_file: int = 5_000_000):
        self.spark, self.base, self.keys = spark, base.rstrip("/"), list(keys)
        self.revision, self.event_time, self.delay = revision, event_time, delay
        self.main = KeyedFiles(spark, f"{self.base}/main", schema, keys, rows_per_file)
        self.late_path, self.schema = f"{self.base}/late", self.main.schema

    def _highest(self, rows: DataFrame) -> DataFrame:
        return W.keep_one(rows.select(*self.schema.fieldNames()), self.keys, [-F.col(self.revision)])

    def _merge(self, rows: DataFrame) -> Merged:
        return self.main.merge(self._highest(rows), lambda now, new: self._highest(now.unionByName(new)), check=False)

    def on_time(self, stream: DataFrame, keep: int = 20) -> int:
        """Merge the rows within the watermark; returns how many the watermark left out. The last ``keep`` versions stay readable."""
        recent = on_clock(stream, self.event_time).withWatermark(self.event_time, self.delay).dropDuplicatesWithinWatermark([*self.keys, self.revision])

        def merged(batch: DataFrame, batch_id: int) -> None:
            if self._merge(batch).version % keep == 0:
                self.main.forget(keep)
            self.main.compact()
        return run_available_now(recent, f"{self.base}/_state", foreach_batch=merged)

    def set_late_aside(self, stream: DataFrame) -> None:
        """Store the rows of the same files that ``main`` lacks."""
        def aside(batch: DataFrame, batch_id: int) -> None:
            rows = self._highest(batch)
            lo, hi = rows.agg(F.min(self.keys[0]), F.max(self.keys[0])).first()
            now = self.main.read(between=(lo, hi)) if lo is not None else self.main.read(0)
            have = now.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(self.keys)], F.col(self.revision).alias("__r"))
            same = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(self.keys)]
            rows.join(have, [*same, F.col("__r") >= F.col(self.revision)], "left_anti").write.mode("overwrite").parquet(f"{self.late_path}/batch-{batch_id:012d}")
        run_available_now(stream, f"{self.base}/_late_state", foreach_batch=aside)

    def late(self) -> DataFrame:
        """Rows that came too late and are not absorbed yet."""
        done = set(lake.names_in(self.spark, f"{self.base}/_absorbed"))
        open_ = [f"{self.late_path}/{n}" for n in lake.names_in(self.spark, self.late_path) if n not in done]
        return self.spark.read.schema(self.schema).parquet(*open_) if open_ else self.spark.createDataFrame([], self.schema)

    def absorb(self) -> int:
        """Merge the late rows into ``main``; returns how many there were."""
        done = set(lake.names_in(self.spark, f"{self.base}/_absorbed"))
        names = [n for n in lake.names_in(self.spark, self.late_path) if n not in done]
        n = self.late().count()
        if n:
            self._merge(self.late())
        for name in names:  # merged again if the job dies before this: no change
            lake.create_once(self.spark, f"{self.base}/_absorbed/{name}", "")
        return n


class WindowTotals:
    """T4: totals per tumbling window whose open windows live in the stream's state.

    A watermark of ``delay`` closes windows; each batch emits the windows that it changed (update mode), which
    replace their earlier selves in a ``KeyedFiles`` table led by the window, so a batch rewrites the files of
    recent windows and no others. Small files are joined and old versions forgotten as the stream goes on, so
    the number of files follows the number of windows and not that of batches. An event time without a zone
    is taken as UTC's, and so are its windows' starts (``wall_time`` gives them back without one). Rows behind the
    watermark change no window in the stream: ``repair`` finds the windows that lack rows and computes them anew."""

    def __init__(self, spark: SparkSession, base: str, keys: Sequence[str], sums: Sequence[str], schema: str, event_time: str,
                 width: str, delay: str, rows_per_file: int = 5_000_000):
        self.spark, self.base, self.keys, self.sums = spark, base.rstrip("/"), list(keys), list(sums)
        self.event_time, self.width, self.delay = event_time, width, delay
        self.table = KeyedFiles(spark, f"{self.base}/table", f"window_start timestamp, {schema}, n long", ["window_start", *keys], rows_per_file)

    def _totals(self, rows: DataFrame) -> DataFrame:
        """Totals of rows; ``n`` counts them."""
        return rows.groupBy(F.window(self.event_time, self.width).alias("w"), *self.keys).agg(
            *[F.sum(c).alias(c) for c in self.sums], F.count(F.lit(1)).alias("n")).select(
            F.col("w.start").alias("window_start"), *self.keys, *self.sums, "n")

    def run(self, stream: DataFrame, keep: int = 8) -> int:
        """Bring the table up to date; returns how many rows came behind the watermark."""
        def changed(batch: DataFrame, batch_id: int) -> None:
            if self.table.merge(batch, check=False).version % keep == 0:
                self.table.forget(keep)
            self.table.compact()
        totals = self._totals(on_clock(stream, self.event_time).withWatermark(self.event_time, self.delay))
        return run_available_now(totals, f"{self.base}/_state", foreach_batch=changed, output_mode="update")

    def repair(self, rows: DataFrame) -> int:
        """Compute anew the windows of ``rows`` (all that has landed) whose count differs from the table's; returns how many.

        For a time when the stream is not at work. The counts read the event time and the keys alone."""
        rows = on_clock(rows, self.event_time)
        want = self._totals(rows.select(self.event_time, *self.keys, *[F.lit(None).cast("double").alias(c) for c in self.sums]))
        have = self.table.read().select("window_start", *self.keys, "n")
        same = [want[k].eqNullSafe(have[k]) for k in ["window_start", *self.keys]]
        folder = f"{self.base}/_short/{uuid.uuid4().hex[:12]}"
        want.join(have, [*same, want["n"] == have["n"]], "left_anti").select("window_start", *self.keys).write.parquet(folder)
        short = self.spark.read.parquet(folder)
        n = short.count()
        if n:
            at = rows.withColumn("__w", F.window(self.event_time, self.width)["start"])
            hit = at.join(short.select(F.col("window_start").alias("__w")).distinct(), "__w", "left_semi").drop("__w")
            self.table.merge(self._totals(hit))
        return n


class PartialSums:
    """T4: totals that grow batch by batch without state. Each batch stores its partial sums under its
    own batch id (a replay overwrites just those), and reading adds them up, so a group may be
    spread over any number of batches and arrive however late. Once ``most`` batches lie there, all but the
    newest are added up into one folder, so their number stays bounded however long the stream goes on."""

    def __init__(self, spark: SparkSession, base: str, keys: Sequence[str], sums: Sequence[str], schema: str, most: int = 16):
        self.spark, self.base, self.keys, self.sums, self.most = spark, base.rstrip("/"), list(keys), list(sums), most
        self.path, self.schema = f"{self.base}/partials", schema

    def batches(self, prepare: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
        def fn(batch: DataFrame, batch_id: int) -> None:
            self._sum(prepare(batch)).write.mode("overwrite").parquet(f"{self.path}/batch-{batch_id:012d}")
            self._fold(batch_id)
        return fn

    def _sum(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*self.keys).agg(*[F.sum(c).alias(c) for c in self.sums])

    def _folded(self) -> tuple[int, str | None]:
        """Up to which batch sums are folded, and into which folder."""
        last = max(lake.names_in(self.spark, f"{self.base}/_folded"), default=None)
        return (int(last), lake.read_text(self.spark, f"{self.base}/_folded/{last}")) if last else (-1, None)

    def _folders(self, upto: int | None = None) -> tuple[list[str], list[str]]:
        """Folders that count (the folded one first), of batches up to ``upto``; and batch folders that are folded already."""
        done, folder = self._folded()
        names = lake.names_in(self.spark, self.path)
        number = lambda n: int(n.rsplit("-", 1)[1])
        new = [f"{self.path}/{n}" for n in names if number(n) > done and (upto is None or number(n) <= upto)]
        return ([folder] if folder else []) + new, [f"{self.path}/{n}" for n in names if number(n) <= done]

    def _fold(self, batch_id: int) -> None:
        """Add up all batches before ``batch_id``: those are committed and come no more."""
        folders, _ = self._folders(batch_id - 1)
        if len(folders) < self.most:
            return
        old = self._folded()[1]
        into = f"{self.base}/folded/{uuid.uuid4().hex[:12]}"
        self._sum(self.spark.read.schema(self.schema).parquet(*folders)).write.parquet(into)
        if lake.create_once(self.spark, f"{self.base}/_folded/{batch_id - 1:012d}", into):
            for path in [*self._folders()[1], *([old] if old else [])]:
                lake.remove(self.spark, path)
            for name in lake.names_in(self.spark, f"{self.base}/_folded")[:-1]:
                lake.remove(self.spark, f"{self.base}/_folded/{name}")

    def read(self) -> DataFrame:
        folders, _ = self._folders()
        now = self.spark.read.schema(self.schema).parquet(*folders) if folders else self.spark.createDataFrame([], self.schema)
        return self._sum(now)
