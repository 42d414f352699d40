"""What the operators of this package share: projections, staged tables, row keys, shipping code to executors."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import tessera
from tessera.session import shared_path

#: The characters that part words: space and U+0009 to U+000D.
WS = " \t\n\x0b\x0c\r"
WORD_GAP = r"[\x20\x09-\x0D]+"

_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application, as ``--py-files`` would."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(tessera.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="tessera-zip-"), f"tessera_{uuid.uuid4().hex[:8]}.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.join("tessera", os.path.relpath(full, root)))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the cluster's shared folder and read it back: lineage is cut there,
    a lost executor costs no recomputation, and later readers prune columns."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_and_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only ``id`` and ``text`` (null counts as empty), so columns of other names can never clash."""
    return df.select(df[id_col].alias("id"), F.coalesce(df[text_col], F.lit("")).alias("text"))


def _unique(ids: DataFrame) -> bool:
    """Whether the one column ``id`` holds integers without nulls or repeats."""
    if dict(ids.dtypes)["id"] not in ("tinyint", "smallint", "int", "bigint"):
        return False
    return ids.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where(F.col("id").isNull() | (F.col("n") > 1)).isEmpty()


def with_row_key(df: DataFrame, id_col: str, text_col: str, name: str) -> tuple[DataFrame, str]:
    """``df`` and the name of a column with a unique, non-null long per row, in the order of the ids.

    Integer ids without repeats or nulls serve as they are. Otherwise the rows are sorted by
    (id, nulls last, text hash), numbered in that order and staged; rows that repeat an id are
    then separate documents, the later of two equal rows counting as the larger id.
    """
    if _unique(df.select(df[id_col].alias("id"))):
        return df, id_col
    key = f"row_{uuid.uuid4().hex[:8]}"
    ordered = df.orderBy(df[id_col].asc_nulls_last(), F.xxhash64(df[text_col]))
    return stage(ordered.withColumn(key, F.monotonically_increasing_id()), name), key


def unique_ids(rows: DataFrame, name: str) -> tuple[DataFrame, bool]:
    """``rows`` (id, text) with the row key as ``rid``, and whether ``rid`` is the id itself."""
    keyed, key = with_row_key(rows, "id", "text", name)
    return keyed.select(keyed[key].cast("long").alias("rid"), "id", "text"), key == "id"


def let(value: Column, body) -> Column:
    """Bind ``value`` to a lambda variable, so that it is computed once however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def hex_number(digest: Column, start: int, digits: int) -> Column:
    """``digits`` hex digits of a digest from position ``start`` (1-based) as a long."""
    return F.conv(F.substring(digest, start, digits), 16, 10).cast("long")
