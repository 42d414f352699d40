"""XML sources (S8, S9) on the built-in XML data source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import shared_path


def read_records(spark: SparkSession, path: str, row_tag: str, *, encoding: str = "ISO-8859-1") -> DataFrame:
    """Flat records; every value as trimmed text, an empty element as ''."""
    df = (spark.read.format("xml").option("rowTag", row_tag).option("encoding", encoding)
          .option("inferSchema", False).option("ignoreSurroundingSpaces", True).load(path))
    return df.select(*[F.coalesce(F.trim(F.col(f"`{c}`").cast("string")), F.lit("")).alias(c) for c in df.columns])


def _child_array_type(dt: T.DataType, child: str):
    if isinstance(dt, T.StructType) and child in dt.fieldNames():
        inner = dt[child].dataType
        return inner if isinstance(inner, T.ArrayType) else T.ArrayType(inner)
    return None


def _as_array(c: Column, dt: T.DataType) -> Column:
    """A single nested element is inferred as a struct, several as an array; a
    missing one is NULL and must yield no rows when exploded."""
    return c if isinstance(dt, T.ArrayType) else F.when(c.isNotNull(), F.array(c))


def tree_pairs(spark: SparkSession, path: str, *, root_tag: str, group_tag: str, node_tag: str,
               name_field: str = "name", group_attr: str = "_id", label_field: str | None = None) -> DataFrame:
    """Nested ``node_tag`` elements under ``group_tag`` under each ``root_tag`` row
    -> (code, parent, root, group) pairs. The nesting is unrolled level by level with
    ``explode`` (one narrow step per level) up to the depth the schema holds. With
    ``label_field`` the labels of root and group come along, their code ranges stripped."""
    df = (spark.read.format("xml").option("rowTag", root_tag).option("inferSchema", False).load(path))
    root_name = F.col(name_field).cast("string")
    from tessera.functions.codes import strip_range_suffix
    label = lambda c, name: [strip_range_suffix(c.cast("string")).alias(name)] if label_field else []
    kept = ["root", "group", "root_label", "group_label"] if label_field else ["root", "group"]
    groups = df.select(root_name.alias("root"), *label(F.col(label_field or name_field), "root_label"), F.explode(_as_array(F.col(group_tag), df.schema[group_tag].dataType)).alias("g"))
    gtype = groups.schema["g"].dataType
    folder = shared_path(spark, "xml-groups")  # the XML is parsed once; each level below reads what it needs of it
    groups.write.parquet(folder)
    groups = spark.read.schema(groups.schema).parquet(folder)
    level = groups.select("root", F.col(f"g.{group_attr}").cast("string").alias("group"), *kept[2:3],
                          *label(F.col(f"g.{label_field or name_field}"), "group_label"),
                          F.explode(_as_array(F.col(f"g.{node_tag}"), gtype[node_tag].dataType)).alias("n"),
                          F.lit(None).cast("string").alias("parent"))
    out = None
    while True:  # the schema that was read ends the walk
        ntype = level.schema["n"].dataType
        rows = level.select(F.trim(F.col(f"n.{name_field}").cast("string")).alias("code"), "parent", *kept).where("code <> ''")
        out = rows if out is None else out.unionByName(rows)
        if _child_array_type(ntype, node_tag) is None:
            break
        level = level.select(*kept, F.trim(F.col(f"n.{name_field}").cast("string")).alias("parent"),
                             F.explode(_as_array(F.col(f"n.{node_tag}"), ntype[node_tag].dataType)).alias("n"))
    return out
