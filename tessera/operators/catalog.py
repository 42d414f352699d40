"""Catalog helpers: names, guarded views, additive migration."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

_IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")

# Layers of a subject and what they add to its schema name.
LAYER_SUFFIX = {"raw": "_raw", "processed": "_processed", "analysis": ""}


def checked_name(value: str) -> str:
    """``value`` if it can stand unquoted as a schema or table name."""
    if not _IDENTIFIER.fullmatch(value or ""):
        raise ValueError(f"not a usable name: {value!r}")
    return value


def layer_schema(subject: str, layer: str) -> str:
    """The schema of a subject's layer; the analysis layer bears the bare subject."""
    if layer not in LAYER_SUFFIX:
        raise ValueError(f"layer {layer!r} is none of {sorted(LAYER_SUFFIX)}")
    return checked_name(subject) + LAYER_SUFFIX[layer]


def dotted_name(*parts: str) -> str:
    """Checked names joined by dots (catalog, schema, table)."""
    return ".".join(map(checked_name, parts))


def safe_view_name(prefix: str, full_name: str) -> str:
    """A temp-view name derived from a table name (non-identifier chars -> '_')."""
    return f"{prefix}_{re.sub(r'[^A-Za-z0-9_]', '_', full_name)}"


def save_table(df: DataFrame, name: str, path: str) -> None:
    """A table of the session catalog over files below ``path`` (a folder that all executors share)."""
    df.write.mode("overwrite").option("path", path).saveAsTable(name)


def create_join_view(spark: SparkSession, view: str, parents: tuple[str, ...], select_sql: str) -> bool:
    """A persistent view over ``parents``, made only when all of them exist; False otherwise.

    The view lives in the session catalog, where other sessions see it, so its parents must be tables or views there (a temp view is refused).
    It is left as it is while its statement and its columns stay the same, else dropped and made again:
    a view keeps the columns it was made with, so a parent whose schema has changed would break it."""
    if not all(spark.catalog.tableExists(p) for p in parents):
        return False
    columns = [(f.name, f.dataType) for f in spark.sql(select_sql).schema]
    if spark.catalog.tableExists(view):
        told = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {view}").collect()}
        shown = [(c.name, c.dataType) for c in spark.catalog.listColumns(view)]
        if told.get("View Text", "").strip() == select_sql.strip() and shown == [(n, t.simpleString()) for n, t in columns]:
            return True
        spark.sql(f"DROP VIEW {view}")
    spark.sql(f"CREATE VIEW {view} AS {select_sql}")
    return True


def add_missing_columns(df: DataFrame, declared: dict[str, str]) -> DataFrame:
    """Additive back-fill — declared columns missing from ``df`` are added as NULL."""
    from pyspark.sql import functions as F
    out = df
    for name, typ in declared.items():
        if name not in df.columns:
            out = out.withColumn(name, F.lit(None).cast(typ))
    return out


def override_record(base, overrides: dict, structural: frozenset[str] = frozenset()):
    """A base metadata record with per-table field overrides. Unknown fields
    are rejected; structural keys always keep the base value."""
    import dataclasses
    names = {f.name for f in dataclasses.fields(base)}
    unknown = sorted(set(overrides) - names)
    if unknown:
        raise ValueError(f"unknown override fields: {unknown}")
    return dataclasses.replace(base, **{k: v for k, v in overrides.items() if k not in structural})


def register_dataset(spark: SparkSession, path: str, entry: dict, columns: list[str], stamp,
                     key: str = "full_table_name") -> None:
    """Upsert one metadata row; only ``columns`` (plus the key) are written,
    every other column of an existing row survives; the writer stamps
    ``refreshed_at``. Vocabulary-bearing fields are validated first. Each
    registration publishes a new version of the (small) catalog table; readers
    follow ``lake.read_current``."""
    from pyspark.sql import functions as F

    from tessera import vocabularies as V
    from tessera.operators.merge import upsert_columns
    from tessera.sources import lake
    if "update_semantics" in entry:
        V.check(entry["update_semantics"], V.UPDATE_SEMANTICS, "update_semantics")
    if "materialization_type" in entry:
        V.check(entry["materialization_type"], V.MATERIALIZATION_TYPES, "materialization_type")
    for tag in entry.get("tags", []) or []:
        V.check(V.split_tag(tag)[0], V.TAG_NAMESPACES, "tag namespace")
    row = {key: entry[key], **{c: entry.get(c) for c in columns}}
    src = spark.createDataFrame([row])
    current = lake.read_current(spark, path)
    if current is None:
        new = src.withColumn("refreshed_at", F.lit(stamp))
    else:
        for c in src.columns:
            if c not in current.columns:
                current = current.withColumn(c, F.lit(None).cast(src.schema[c].dataType))
        src = add_missing_columns(src, {c: current.schema[c].dataType.simpleString()
                                        for c in current.columns if c != "refreshed_at"})
        new = upsert_columns(current, src.select(*[c for c in current.columns if c in src.columns]), [key],
                             columns, "refreshed_at", F.lit(stamp))
    lake.publish_version(spark, new, path, allow_schema_change=True)  # additive columns are expected
