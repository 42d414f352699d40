"""Tiered entity matching and first-writer maps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import codes as C

# Match methods in priority order.
METHODS = ("code", "name", "name_ambiguous", "fixup", "none")


def name_index(refs: DataFrame, scope: str, rid: str, names: Column) -> DataFrame:
    """(scope, key, rid, ambiguous): every normalised name (primary + alternates)
    within its scope; first writer (smallest rid) wins and a key claimed by more
    than one distinct rid is ambiguous. A two-phase aggregate — a hot scope is
    pre-reduced per partition."""
    ex = refs.select(scope, rid, F.explode(names).alias("__nm")).select(scope, rid, C.name_key("__nm").alias("key"))
    return ex.filter(F.col("key").isNotNull()).groupBy(scope, "key").agg(
        F.min(rid).alias(rid), (F.count_distinct(rid) > 1).alias("ambiguous"))


def tiered_match(targets: DataFrame, target_code: str, target_scope: str, target_name: str,
                 code_map: DataFrame, names: DataFrame, fixups: DataFrame, rid: str) -> DataFrame:
    """Exact code -> normalised name within scope -> manual fix-up -> none.

    ``code_map(code, rid)``, ``names(scope, key, rid, ambiguous)`` and
    ``fixups(code, rid)`` are joined left in priority order (three equi-joins, no
    pairing inside a scope); an ambiguous name is recorded but not linked."""
    t = targets.select(F.col(target_code).alias("__code"), F.col(target_scope).alias("__scope"),
                       C.name_key(F.col(target_name)).alias("__key"))
    one = lambda m, key, out: m.groupBy(F.col("code").alias(key)).agg(F.min(rid).alias(out))  # noqa: E731  a repeated code links once
    cm = one(code_map, "__cm_code", "__code_rid")
    nm = names.select(F.col(names.columns[0]).alias("__nm_scope"), F.col("key").alias("__nm_key"),
                      F.col(rid).alias("__name_rid"), F.col("ambiguous").alias("__amb"))
    fx = one(fixups, "__fx_code", "__fix_rid")
    j = (t.join(cm, F.col("__code") == F.col("__cm_code"), "left")
          .join(nm, (F.col("__scope") == F.col("__nm_scope")) & (F.col("__key") == F.col("__nm_key")), "left")
          .join(fx, F.col("__code") == F.col("__fx_code"), "left"))
    method = (F.when(F.col("__code_rid").isNotNull(), "code")
               .when(F.col("__name_rid").isNotNull() & F.col("__amb"), "name_ambiguous")
               .when(F.col("__name_rid").isNotNull(), "name")
               .when(F.col("__fix_rid").isNotNull(), "fixup").otherwise("none"))
    linked = (F.when(F.col("__code_rid").isNotNull(), F.col("__code_rid"))
               .when(F.col("__name_rid").isNotNull() & F.col("__amb"), F.lit(None))
               .when(F.col("__name_rid").isNotNull(), F.col("__name_rid"))
               .otherwise(F.col("__fix_rid")))
    return j.select(F.col("__code").alias(target_code), method.alias("method"), linked.alias("linked_" + rid))


def first_writer_map(df: DataFrame, key: str, value: str, order: Sequence[Column]) -> DataFrame:
    """Reverse map key -> value where the first writer (smallest ``order``) wins."""
    st = F.struct(*[o.alias(f"__o{i}") for i, o in enumerate(order)], F.col(value).alias("__v"))
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(st).alias("__s")) \
             .select(key, F.col("__s.__v").alias(value))


def code_claims(refs: DataFrame, dotted_col: str, dashed_col: str, rid: str) -> DataFrame:
    """(code, rid) by each reference's own code, the dotted spelling before the dashed one; a
    code that several claim goes to the smallest rid."""
    claims = refs.select(C.subdivision_code(dotted_col, dashed_col).alias("code"), rid)
    return claims.where("code IS NOT NULL").groupBy("code").agg(F.min(rid).alias(rid))


def unmatched_ids(refs: DataFrame, matched: DataFrame, rid: str) -> DataFrame:
    """Reference ids that no target was linked to (an ambiguous name claims none)."""
    claimed = matched.select(F.col("linked_" + rid).alias(rid)).where(F.col(rid).isNotNull())
    return refs.select(rid).where(F.col(rid).isNotNull()).distinct().join(claimed, rid, "left_anti")
