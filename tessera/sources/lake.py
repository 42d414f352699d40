"""Table storage semantics on plain parquet folders (U1-U3, U8, U9, TR1, TR2, TR4).

Every write goes to a folder under the cluster's shared checkpoint location (or a
caller-given shared path). A table that is being read is never overwritten in
place: rewrites land in a sibling version folder and the caller switches to it.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def append(df: DataFrame, path: str) -> None:
    """Append-only sink."""
    df.write.mode("append").parquet(path)


def full_refresh(df: DataFrame, path: str) -> None:
    """Whole-table overwrite (static tables)."""
    df.write.mode("overwrite").parquet(path)


def write_sorted(df: DataFrame, path: str, keys: list[str]) -> None:
    """O1: files hold disjoint key ranges, each sorted, so readers prune by the keys' statistics."""
    df.repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode("overwrite").parquet(path)


def write_snapshot_once(df: DataFrame, path: str, vintage_col: str, vintage) -> bool:
    """U8: write the snapshot of ``vintage`` unless it is there; True if it was written. A
    snapshot counts as there once its write has committed, so a broken one is written again."""
    folder = f"{path.rstrip('/')}/{vintage_col}={vintage}"
    try:
        df.sparkSession.read.text(f"{folder}/_SUCCESS")
        return False
    except AnalysisException as e:
        if not is_missing_path(e):
            raise
    df.drop(vintage_col).write.mode("overwrite").parquet(folder)
    return True


def write_if_changed(df: DataFrame, base: str, signature: list) -> bool:
    """Publish ``df`` unless the stored signature of the last publish equals its own (the
    aggregates ``signature``, order-free); True if it was published."""
    spark = df.sparkSession
    now = df.agg(*signature).withColumn("turn", F.lit(0))
    stored = try_read(spark, f"{base.rstrip('/')}/_signatures", now.schema)
    mark = tuple(now.first())[:-1]
    if stored is not None:
        last = stored.orderBy(F.desc("turn")).limit(1).first()
        if tuple(last)[:-1] == mark:
            return False
        now = now.withColumn("turn", F.lit(last.turn + 1))
    publish_version(spark, df, base)
    now.write.mode("append").parquet(f"{base.rstrip('/')}/_signatures")
    return True


def write_partitioned(df: DataFrame, path: str, partition_col: str) -> None:
    """One shuffle by the partition value keeps files few; AQE splits a value that is too large."""
    df.hint("rebalance", partition_col).write.mode("overwrite").partitionBy(partition_col).parquet(path)


def replace_vintage(df: DataFrame, path: str, vintage_col: str, vintage) -> None:
    """Replace exactly one vintage partition and keep every other one.

    A frame holding any other vintage is rejected (a dynamic overwrite would
    silently replace those partitions too). Re-running with the same frame is
    idempotent."""
    other = df.filter(~F.col(vintage_col).eqNullSafe(F.lit(vintage))).limit(1).count()
    if other:
        raise ValueError(f"frame holds rows outside vintage {vintage!r}")
    (df.hint("rebalance").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(vintage_col).parquet(path))


def read_table(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Read with the declared schema so partition values keep their declared type
    (no inference: ``"2.80"`` stays a string, ``"01"`` keeps its zero)."""
    return spark.read.schema(schema).parquet(path)


def new_version_path(base: str) -> str:
    """TR4: a sibling folder for a rewrite of a table that is being read."""
    return f"{base.rstrip('/')}/v-{uuid.uuid4().hex[:12]}"


def vintage_exists(df_table: DataFrame, vintage_col: str, vintage) -> bool:
    """U8: snapshot immutability probe — a present snapshot is never rewritten."""
    return df_table.filter(F.col(vintage_col) == F.lit(vintage)).limit(1).count() > 0


def is_missing_path(e: Exception) -> bool:
    """Whether a read failed because nothing is stored there; any other failure is a failure."""
    return isinstance(e, AnalysisException) and e.getCondition() == "PATH_NOT_FOUND"


def try_read(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame | None:
    """The table at ``path``, or None when nothing has been written there yet. A store that
    cannot be read raises: taking it for an empty table would lose what it holds."""
    try:
        return read_table(spark, path, schema)
    except AnalysisException as e:
        if is_missing_path(e):
            return None
        raise


def merge_partitions(spark: SparkSession, path: str, source: DataFrame, partition_col: str, combine,
                     staging: str) -> None:
    """Upsert-style merge that rewrites only the partitions ``source`` touches.

    ``source`` is staged first (one pass over it). The current table is read through a
    semi-join with the staged partition values, so untouched partitions are pruned at
    run time and their number never reaches the driver. ``combine(current, source)``
    computes the new content, which is staged (never overwrite what is being read) and
    swapped in with dynamic partition overwrite. Replaying the same source gives the
    same partitions. The keys that ``combine`` matches on must hold the partition
    column (see ``PartitionedTable``), or an old row could stay in another partition."""
    schema = source.schema
    full_refresh(source.select(*schema.fieldNames()), f"{staging}/source")
    source = read_table(spark, f"{staging}/source", schema)
    current = try_read(spark, path, schema)
    if current is None:
        new = source
    else:
        touched = source.select(F.col(partition_col).alias("__touched")).distinct()
        same = current[partition_col].eqNullSafe(touched["__touched"])
        new = combine(current.join(touched, same, "left_semi"), source)
    full_refresh(new.select(*schema.fieldNames()), f"{staging}/merged")
    (read_table(spark, f"{staging}/merged", schema).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition_col).parquet(path))


class SchemaDrift(ValueError):
    """A rewrite would change a published table's schema without opting in."""


def publish_version(spark: SparkSession, df: DataFrame, base: str, *, allow_schema_change: bool = False) -> str:
    """Write a complete new version folder, then add a pointer with the next number.

    Readers follow the highest pointer, and pointers are only ever added, so a job that
    dies at any moment (mid-write, or between the data and its pointer) leaves the
    previous version published and intact; re-running
    simply writes another version. A schema different from the published one
    fails loudly unless ``allow_schema_change`` is set."""
    path = write_version(spark, df, base, allow_schema_change=allow_schema_change)
    point_to(spark, base, path)
    return path


def write_version(spark: SparkSession, df: DataFrame, base: str, *, allow_schema_change: bool = False) -> str:
    """Write a version folder that no reader sees yet, and return it."""
    if not allow_schema_change:
        current = read_current(spark, base)
        if current is not None and current.schema.simpleString() != df.schema.simpleString():
            raise SchemaDrift(f"{base}: published {current.schema.simpleString()} != new {df.schema.simpleString()}")
    path = new_version_path(base)
    full_refresh(df, path)
    return path


def _file_system(spark: SparkSession, path: str):
    """Hadoop's file system of ``path``, and the path as its own kind of path."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Sorted names of what lies in ``folder``, hidden files aside; none if it is not there."""
    fs, where = _file_system(spark, folder)
    if not fs.exists(where):
        return []
    found = [f.getPath().getName() for f in fs.listStatus(where)]
    return sorted(n for n in found if not n.startswith((".", "_")))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder that nothing refers to any more."""
    fs, where = _file_system(spark, path)
    fs.delete(where, True)


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file with its content in one step; False, and nothing changed, if it is there.

    Of any number of writers one succeeds: the file is written under a hidden name, then
    renamed without overwriting (linked, on a local disk, where a rename would overwrite)."""
    fs, where = _file_system(spark, path)
    parent = where.getParent()
    fs.mkdirs(parent)
    jvm, hidden = spark._jvm, spark._jvm.org.apache.hadoop.fs.Path(parent, f".{uuid.uuid4().hex}")
    out = fs.create(hidden, False)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        if fs.getUri().getScheme() == "file":
            local = [jvm.java.io.File(p.toUri().getPath()).toPath() for p in (where, hidden)]
            jvm.java.nio.file.Files.createLink(*local)
        else:
            options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(hidden, where, options)
        return True
    except Py4JJavaError as e:
        if "FileAlreadyExistsException" not in e.java_exception.getClass().getName():
            raise
        return False
    finally:
        fs.delete(hidden, False)


def read_text(spark: SparkSession, path: str) -> str:
    """The content of a small file."""
    return "\n".join(r.value for r in spark.read.text(path).collect())


def point_to(spark: SparkSession, base: str, path: str) -> int:
    """Make ``path`` the published version by adding the next pointer; returns its number.

    A number is taken by an atomic create. A publisher that finds it taken goes on with the
    next one, so of several publishers at once each has a pointer of its own and the chain
    holds all their versions."""
    turn = last_turn(spark, base) + 1
    while not create_once(spark, f"{base.rstrip('/')}/_pointers/{turn:012d}", path):
        turn += 1
    return turn


def last_turn(spark: SparkSession, base: str) -> int:
    """The number of the last pointer; 0 before the first."""
    return max(map(int, names_in(spark, f"{base.rstrip('/')}/_pointers")), default=0)


def version_chain(spark: SparkSession, base: str) -> list[str]:
    """The folders of all versions published, oldest first."""
    return [read_text(spark, f"{base.rstrip('/')}/_pointers/{n}") for n in names_in(spark, f"{base.rstrip('/')}/_pointers")]


def current_version(spark: SparkSession, base: str) -> str | None:
    """The folder that the highest pointer names; None before the first publish."""
    turn = last_turn(spark, base)
    return read_text(spark, f"{base.rstrip('/')}/_pointers/{turn:012d}") if turn else None


def read_current(spark: SparkSession, base: str, schema: T.StructType | None = None) -> DataFrame | None:
    path = current_version(spark, base)
    if path is None:
        return None
    return read_table(spark, path, schema) if schema is not None else spark.read.parquet(path)
