"""Code-hierarchy plans over codes derived from part keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import codes as C
from tessera.operators import hierarchy as H
from tessera.operators import joins as J
from tessera.plans.registry import query
from tessera.session import shared_path
from tessera.sources.tables import Tables

# Chapter bands over the numeric 3-character category (600-699 is
# deliberately left unmapped), and size bands for the range lookup.
CHAPTERS = (("CH1", "chapter one", 0, 99), ("CH2", "chapter two", 100, 299),
            ("CH3", "chapter three", 300, 599), ("CH4", "chapter four", 700, 999))
SIZE_BANDS = (("XS", "extra small", 1, 10), ("S", "small", 11, 20), ("M", "medium", 21, 30), ("L", "large", 31, 45))
SPECIAL_TYPE = "PROMO"
ROOT = "0"

_P_SQL = ("p AS (SELECT p_partkey, p_size, p_type, CASE WHEN regexp_full_match(CAST(p_partkey AS VARCHAR), '[0-9]{1,5}') "
          "THEN lpad(CAST(p_partkey AS VARCHAR), 5, '0') ELSE CAST(p_partkey AS VARCHAR) END AS c5 FROM part)")
_CODESET_SQL = ("code_set AS (SELECT DISTINCT code FROM (SELECT c5 AS code FROM p "
                "UNION ALL SELECT substr(c5, 1, 3) FROM p WHERE p_size > 25 "
                "UNION ALL SELECT substr(c5, 1, 4) FROM p WHERE p_type = 'ECONOMY' "
                "UNION ALL SELECT substr(c5, 1, 1) FROM p WHERE p_size <= 10))")
_TREE_SQL = ("tree AS (SELECT DISTINCT child, parent FROM ("
             "SELECT c5 AS child, substr(c5, 1, 3) AS parent FROM p WHERE p_size > 40 "
             "UNION ALL SELECT substr(c5, 1, 4), substr(c5, 1, 1) FROM p WHERE p_type = 'ECONOMY' AND p_size <= 10 "
             "UNION ALL SELECT substr(c5, 1, 3), substr(c5, 1, 2) FROM p WHERE p_size > 45 "
             "UNION ALL SELECT substr(c5, 1, 2), CAST(NULL AS VARCHAR) FROM p WHERE p_size > 45))")
_PREFIX_PATHS_SQL = ("pref AS (SELECT code, unnest(range(1, length(code))) AS i FROM code_set), "
                     "hits AS (SELECT code, i, substr(code, 1, CAST(i AS INTEGER)) AS pre FROM pref "
                     "WHERE substr(code, 1, CAST(i AS INTEGER)) IN (SELECT code FROM code_set)), "
                     "paths AS (SELECT code, list(pre ORDER BY i) AS anc FROM hits GROUP BY code)")


def _codes(t):
    p = t.part.select("p_partkey", "p_size", "p_type", C.pad_id("p_partkey", 5).alias("c5"))
    return p


def _code_set(p):
    """Codes plus the chosen prefix nodes, from ONE scan: each part row emits its
    candidate nodes as an array, exploded and de-duplicated."""
    s = F.col("p_size")
    cands = F.array(F.col("c5"), F.when(s > 25, F.substring("c5", 1, 3)),
                    F.when(F.col("p_type") == "ECONOMY", F.substring("c5", 1, 4)), F.when(s <= 10, F.substring("c5", 1, 1)))
    return p.select(F.explode(cands).alias("code")).filter(F.col("code").isNotNull()).distinct()


def _tree(p):
    """Explicit parent pairs (the 'tree'), also from one scan of the part rows."""
    s = F.col("p_size")
    null = F.lit(None).cast("string")

    def edge(cond, child, parent):
        return F.when(cond, F.struct(child.alias("child"), parent.alias("parent")))

    edges = F.array(edge(s > 40, F.col("c5"), F.substring("c5", 1, 3)),
                    edge((F.col("p_type") == "ECONOMY") & (s <= 10), F.substring("c5", 1, 4), F.substring("c5", 1, 1)),
                    edge(s > 45, F.substring("c5", 1, 3), F.substring("c5", 1, 2)),
                    edge(s > 45, F.substring("c5", 1, 2), null))
    return p.select(F.explode(edges).alias("e")).filter(F.col("e").isNotNull()).select("e.child", "e.parent").distinct()


def _shape(df):
    return df.select("code", F.array_join("ancestors", ">").alias("path"), "parent", F.col("depth").cast("int").alias("depth"))


@query("prefix_hierarchy", sql=f"""
WITH {_P_SQL}, {_CODESET_SQL}, {_PREFIX_PATHS_SQL}
SELECT c.code, COALESCE(array_to_string(paths.anc, '>'), '') AS path, paths.anc[-1] AS parent,
       CAST(COALESCE(len(paths.anc), 0) AS INTEGER) AS depth
FROM code_set c LEFT JOIN paths ON c.code = paths.code
""")
def prefix_hierarchy(spark, sf):
    """H1/H2: ancestors = proper prefixes present in the code set; parent = last
    ancestor; depth = path length."""
    cs = _code_set(_codes(Tables(spark, sf)))
    return _shape(H.prefix_ancestors(cs, "code"))


@query("hierarchy_tree_fallback", sql=f"""
WITH RECURSIVE {_P_SQL}, {_CODESET_SQL}, {_TREE_SQL},
existing AS (SELECT code FROM code_set UNION SELECT child FROM tree),
pref AS (SELECT code, unnest(range(1, length(code))) AS i FROM existing),
anc AS (SELECT code, arg_max(substr(code, 1, CAST(i AS INTEGER)), i) AS anchor FROM pref
        WHERE substr(code, 1, CAST(i AS INTEGER)) IN (SELECT code FROM existing) GROUP BY code),
tw(node, cur, chain) AS (
  SELECT child, parent, CASE WHEN parent IS NULL THEN []::VARCHAR[] ELSE [parent] END FROM tree
  UNION ALL
  SELECT tw.node, t.parent, list_append(tw.chain, t.parent) FROM tw JOIN tree t ON tw.cur = t.child WHERE t.parent IS NOT NULL),
tpath AS (SELECT node, list_reverse(arg_max(chain, len(chain))) AS tp FROM tw GROUP BY node),
nt AS (SELECT code, anchor FROM anc WHERE code NOT IN (SELECT child FROM tree)),
aw(node, cur, chain) AS (
  SELECT code, anchor, [anchor] FROM nt
  UNION ALL
  SELECT aw.node, nt.anchor, list_append(aw.chain, nt.anchor) FROM aw JOIN nt ON aw.cur = nt.code),
alast AS (SELECT node, arg_max(chain, len(chain)) AS chain FROM aw GROUP BY node),
apath AS (SELECT alast.node, list_concat(COALESCE(tpath.tp, []::VARCHAR[]), list_reverse(alast.chain)) AS ap
          FROM alast LEFT JOIN tpath ON alast.chain[-1] = tpath.node),
fin AS (SELECT c.code, COALESCE(tpath.tp, apath.ap, []::VARCHAR[]) AS a FROM code_set c
        LEFT JOIN tpath ON c.code = tpath.node LEFT JOIN apath ON c.code = apath.node)
SELECT code, array_to_string(a, '>') AS path, a[-1] AS parent, CAST(len(a) AS INTEGER) AS depth FROM fin
""")
def hierarchy_tree_fallback(spark, sf):
    """H3: tree-first ancestors; codes missing from the tree anchor on their nearest
    existing prefix. Tree walks are bounded join rounds (depth <= code length)."""
    p = _codes(Tables(spark, sf))
    cs = _code_set(p)
    tree = _tree(p)
    max_len = cs.agg(F.max(F.length("code"))).first()[0] or 1
    return _shape(H.tree_first_paths(cs, tree, int(max_len) + 1))


@query("hierarchy_crosscheck", sql=f"""
WITH {_P_SQL}, {_CODESET_SQL}, {_TREE_SQL}, {_PREFIX_PATHS_SQL}
SELECT t.child AS code, t.parent AS tree_parent, paths.anc[-1] AS prefix_parent
FROM tree t JOIN code_set c ON t.child = c.code LEFT JOIN paths ON c.code = paths.code
WHERE t.parent IS DISTINCT FROM paths.anc[-1]
""")
def hierarchy_crosscheck(spark, sf):
    """Parent from the tree vs parent from the prefix rule; mismatches listed."""
    p = _codes(Tables(spark, sf))
    cs = _code_set(p)
    pre = H.prefix_ancestors(cs, "code").select("code", F.col("parent").alias("prefix_parent"))
    tree = _tree(p).join(cs.withColumnRenamed("code", "child"), "child", "left_semi")
    j = tree.join(pre, F.col("child") == F.col("code"), "left")
    return j.filter(~F.col("parent").eqNullSafe(F.col("prefix_parent"))) \
            .select(F.col("child").alias("code"), F.col("parent").alias("tree_parent"), "prefix_parent")


@query("leaf_codes", sql=f"""
WITH {_P_SQL}, {_CODESET_SQL},
nl AS (SELECT DISTINCT substr(code, 1, CAST(i AS INTEGER)) AS code FROM (SELECT code, unnest(range(1, length(code))) AS i FROM code_set))
SELECT code, code NOT IN (SELECT code FROM nl) AS is_leaf FROM code_set
""")
def leaf_codes(spark, sf):
    """H4: a code is a leaf when no other code has it as a proper prefix."""
    cs = _code_set(_codes(Tables(spark, sf)))
    return H.leaf_flags(cs, "code")


def _chapter_sql(x: str) -> str:
    w = " ".join(f"WHEN TRY_CAST({x} AS INTEGER) BETWEEN {lo} AND {hi} THEN '{c}'" for c, _, lo, hi in CHAPTERS)
    return f"CASE {w} END"


def _chapters(spark):
    return spark.createDataFrame([(c, n, lo, hi) for c, n, lo, hi in CHAPTERS],
                                 "chapter string, chapter_name string, lo int, hi int")


@query("subtree_select", sql=f"""
WITH {_P_SQL}, {_CODESET_SQL}, {_PREFIX_PATHS_SQL},
sub AS (SELECT c.code, list_append(COALESCE(paths.anc, []::VARCHAR[]), c.code) AS self_path,
               {_chapter_sql("substr(c.code, 1, 3)")} AS chapter
        FROM code_set c LEFT JOIN paths ON c.code = paths.code
        WHERE list_contains(COALESCE(paths.anc, []::VARCHAR[]), '{ROOT}'))
SELECT code, array_to_string(self_path, '>') AS self_path, chapter, COUNT(*) OVER (PARTITION BY chapter) AS n_in_chapter FROM sub
""")
def subtree_select(spark, sf):
    """H5/H6: the subtree under one node is a range of the stored interval labels, which also hold each
    member's root-to-self path (array_append) and its chapter; the roll-up is joined back."""
    sub = H.subtree(_labels(spark, _code_set(_codes(Tables(spark, sf)))), ROOT, "code")
    roll = sub.groupBy(F.col("chapter").alias("ch")).agg(F.count(F.lit(1)).alias("n_in_chapter"))
    out = sub.join(roll, F.col("chapter").eqNullSafe(F.col("ch")), "left")
    return out.select("code", F.array_join("path", ">").alias("self_path"), "chapter", "n_in_chapter")


def _labels(spark, code_set):
    """The stored code set: path, interval and chapter of every code."""
    paths = H.prefix_ancestors(code_set, "code").select("code", "depth", F.array_append("ancestors", F.col("code")).alias("path"))
    paths = J.range_lookup(paths, F.substring("code", 1, 3).try_cast("int"), _chapters(spark), "lo", "hi", ["chapter"])
    return H.interval_labels(paths, shared_path(spark, "code_labels"), "code")


@query("hierarchy_dq", sql=f"""
WITH {_P_SQL}, {_CODESET_SQL}, {_TREE_SQL}, {_PREFIX_PATHS_SQL},
existing AS (SELECT code FROM code_set UNION SELECT child FROM tree)
SELECT 'orphan_codes' AS check_name, COUNT(*) AS n_failing FROM code_set c LEFT JOIN paths ON c.code = paths.code
  WHERE length(c.code) > 1 AND paths.anc IS NULL
UNION ALL
SELECT 'dangling_parents', COUNT(*) FROM tree WHERE parent IS NOT NULL AND parent NOT IN (SELECT code FROM existing)
UNION ALL
SELECT 'unmapped_categories', COUNT(*) FROM (SELECT DISTINCT substr(code, 1, 3) AS cat FROM code_set)
  WHERE {_chapter_sql("cat")} IS NULL
""")
def hierarchy_dq(spark, sf):
    """H7: orphans (no ancestor although not a root), dangling tree parents,
    categories that map to no chapter; the labels are read twice, the tree once."""
    p = _codes(Tables(spark, sf))
    labels = _labels(spark, _code_set(p))
    told = labels.agg(F.count_if((F.length("code") > 1) & (F.col("depth") == 0)).alias("orphan_codes"),
                      F.count_distinct(F.when(F.col("chapter").isNull(), F.substring("code", 1, 3))).alias("unmapped_categories"))
    told = told.select(F.explode(F.create_map(*[x for c in ("orphan_codes", "unmapped_categories") for x in (F.lit(c), F.col(c))])).alias("check_name", "n_failing"))
    there, asked = F.lit(True).alias("there"), F.lit(0).cast("long").alias("asked")
    ends = _tree(p).select(F.explode(F.array(F.struct(F.col("child").alias("code"), there, asked),
                                             F.struct(F.col("parent").alias("code"), F.lit(False).alias("there"), F.lit(1).cast("long").alias("asked")))).alias("e"))
    nodes = ends.select("e.*").where(F.col("code").isNotNull()).unionByName(labels.select("code", there, asked))
    dangling = nodes.groupBy("code").agg(F.bool_or("there").alias("there"), F.sum("asked").alias("asked")).where("NOT there").agg(
        F.lit("dangling_parents").alias("check_name"), F.coalesce(F.sum("asked"), F.lit(0)).cast("long").alias("n_failing"))
    return told.unionByName(dangling)


@query("range_lookup", sql="""
SELECT p_partkey, p_size,
       CASE WHEN p_type = 'PROMO' THEN 'P' ELSE b.band END AS band,
       CASE WHEN p_type = 'PROMO' THEN 'promotional' ELSE b.band_name END AS band_name
FROM part LEFT JOIN (VALUES ('XS', 'extra small', 1, 10), ('S', 'small', 11, 20), ('M', 'medium', 21, 30), ('L', 'large', 31, 45))
  b(band, band_name, lo, hi) ON p_size BETWEEN b.lo AND b.hi
""")
def range_lookup(spark, sf):
    """Value into [low, high] bands (broadcast non-equi join against the small
    band table); one class is special-cased ahead of the bands."""
    p = Tables(spark, sf).part.select("p_partkey", "p_size", "p_type")
    bands = spark.createDataFrame([(b, n, lo, hi) for b, n, lo, hi in SIZE_BANDS], "band string, band_name string, lo int, hi int")
    j = J.range_lookup(p, F.col("p_size"), bands, "lo", "hi", ["band", "band_name"])
    special = F.col("p_type") == SPECIAL_TYPE
    return j.select("p_partkey", "p_size", F.when(special, "P").otherwise(F.col("band")).alias("band"),
                    F.when(special, "promotional").otherwise(F.col("band_name")).alias("band_name"))
