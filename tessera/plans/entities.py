"""Entity matching and assembly plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import codes as C
from tessera.operators import matching as M
from tessera.operators import windows as W
from tessera.plans.registry import query
from tessera.sources.tables import Tables

_NORM = "NULLIF(trim(regexp_replace(strip_accents(lower({x})), '[^a-z0-9]+', ' ', 'g')), '')"

_TIERED_SQL = f"""
r AS (SELECT p_partkey AS rid, p_brand AS scope, p_name,
             split_part(p_name, ' ', 2) || ' ' || split_part(p_name, ' ', 1) || '|' || p_type AS varnames,
             CASE WHEN p_size % 4 = 0 THEN p_brand || '.' || CAST(p_partkey AS VARCHAR) END AS code FROM part),
names AS (SELECT rid, scope, p_name AS nm FROM r UNION ALL SELECT rid, scope, unnest(string_split(varnames, '|')) FROM r),
nk AS (SELECT rid, scope, {_NORM.format(x="nm")} AS k FROM names),
idx AS (SELECT scope, k, MIN(rid) AS rid, COUNT(DISTINCT rid) > 1 AS ambiguous FROM nk WHERE k IS NOT NULL GROUP BY 1, 2),
t AS (SELECT p_brand || '.' || CAST(p_partkey AS VARCHAR) AS target_code, p_brand AS scope,
             CASE WHEN p_size % 3 = 0 THEN p_name || ' x' ELSE upper(p_name) END AS name FROM part),
fx AS (SELECT p_brand || '.' || CAST(p_partkey AS VARCHAR) AS target_code, p_partkey + 1 AS rid FROM part WHERE p_size % 9 = 0),
j AS (SELECT t.target_code, c.rid AS code_rid, i.rid AS name_rid, i.ambiguous, fx.rid AS fix_rid
      FROM t LEFT JOIN r c ON t.target_code = c.code
      LEFT JOIN idx i ON t.scope = i.scope AND {_NORM.format(x="t.name")} = i.k
      LEFT JOIN fx ON t.target_code = fx.target_code),
tm AS (SELECT target_code,
         CASE WHEN code_rid IS NOT NULL THEN 'code' WHEN name_rid IS NOT NULL AND ambiguous THEN 'name_ambiguous'
              WHEN name_rid IS NOT NULL THEN 'name' WHEN fix_rid IS NOT NULL THEN 'fixup' ELSE 'none' END AS method,
         CASE WHEN code_rid IS NOT NULL THEN code_rid WHEN name_rid IS NOT NULL AND ambiguous THEN NULL
              WHEN name_rid IS NOT NULL THEN name_rid ELSE fix_rid END AS linked_rid
       FROM j)
"""


def _tiered(spark, sf):
    p = Tables(spark, sf).part
    refs = p.select(F.col("p_partkey").alias("rid"), F.col("p_brand").alias("scope"), "p_name", "p_type", "p_size")
    alternates = F.concat_ws("|", F.concat_ws(" ", F.split("p_name", " ").getItem(1), F.split("p_name", " ").getItem(0)),
                             F.col("p_type"))
    names = M.name_index(refs, "scope", "rid", F.concat(F.array("p_name"), F.split(alternates, r"\|")))
    code_map = refs.filter(F.col("p_size") % 4 == 0).select(
        F.concat_ws(".", "scope", F.col("rid").cast("string")).alias("code"), "rid")
    targets = p.select(F.concat_ws(".", "p_brand", F.col("p_partkey").cast("string")).alias("target_code"),
                       F.col("p_brand").alias("scope"),
                       F.when(F.col("p_size") % 3 == 0, F.concat(F.col("p_name"), F.lit(" x"))).otherwise(F.upper("p_name")).alias("name"))
    # the manual fix-up table (code -> rid); an id that does not exist links nothing
    fix = p.filter(F.col("p_size") % 9 == 0).select(
        F.concat_ws(".", "p_brand", F.col("p_partkey").cast("string")).alias("code"), (F.col("p_partkey") + 1).alias("rid"))
    fix = fix.join(refs.select(F.col("rid").alias("__r")), F.col("rid") == F.col("__r"), "left_semi")
    return M.tiered_match(targets, "target_code", "scope", "name", code_map, names, fix, "rid")


@query("tiered_match", sql=f"WITH {_TIERED_SQL} SELECT target_code, method, linked_rid FROM tm")
def tiered_match(spark, sf):
    """Code -> name within brand (primary + alternate names,
    first writer wins, collisions flagged and not linked) -> fix-up -> none."""
    return _tiered(spark, sf)


@query("reverse_map_lookup", sql=f"""
WITH {_TIERED_SQL},
rm AS (SELECT linked_rid, MIN(target_code) AS parent_code FROM tm WHERE linked_rid IS NOT NULL GROUP BY 1),
ch AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem)
SELECT CAST(ch.l_partkey AS VARCHAR) || '.' || CAST(ch.l_suppkey AS VARCHAR) || '_1' AS child_gid,
       CAST(1 AS INTEGER) AS level, ch.l_partkey AS parent_rid, rm.parent_code
FROM ch LEFT JOIN rm ON ch.l_partkey = rm.linked_rid
""")
def reverse_map_lookup(spark, sf):
    """First-writer-wins reverse map (linked id -> code), then a left lookup
    for child rows; level from the dotted child id; unmatched parent -> NULL."""
    tm = _tiered(spark, sf)
    rmap = M.first_writer_map(tm, "linked_rid", "target_code", [F.col("target_code")])
    ch = Tables(spark, sf).lineitem.select("l_partkey", "l_suppkey").distinct()
    gid = F.concat(F.col("l_partkey").cast("string"), F.lit("."), F.col("l_suppkey").cast("string"), F.lit("_1"))
    j = ch.join(rmap, F.col("l_partkey") == F.col("linked_rid"), "left")
    return j.select(gid.alias("child_gid"), C.dot_level(gid).alias("level"), F.col("l_partkey").alias("parent_rid"),
                    F.col("target_code").alias("parent_code"))


@query("assemble_entity", sql="""
WITH d AS (SELECT * FROM conversations WHERE length(trim(text)) > 0),
c AS (SELECT DISTINCT conv_id FROM conversations),
fsn AS (SELECT conv_id, MIN(turn) AS fsn_turn FROM d WHERE role = 'system' GROUP BY 1),
refset AS (SELECT conv_id, turn FROM conversations WHERE length(text) >= 200),
pref AS (SELECT d.conv_id, MIN(d.turn) AS pref_turn FROM d JOIN refset r ON d.conv_id = r.conv_id AND d.turn = r.turn
         WHERE d.role = 'user' GROUP BY 1)
SELECT c.conv_id, fsn.fsn_turn, md5(f.text) AS fsn_md5,
       trim(regexp_extract(f.text, '\\(([^()]+)\\)\\s*$', 1)) AS fsn_tag,
       pref.pref_turn, md5(p.text) AS pref_md5
FROM c LEFT JOIN fsn ON c.conv_id = fsn.conv_id LEFT JOIN d f ON f.conv_id = fsn.conv_id AND f.turn = fsn.fsn_turn
LEFT JOIN pref ON c.conv_id = pref.conv_id LEFT JOIN d p ON p.conv_id = pref.conv_id AND p.turn = pref.pref_turn
""")
def assemble_entity(spark, sf):
    """Concept + its first active defining description + its first
    active preferred synonym (preferred = member of the acceptability refset)."""
    conv = Tables(spark, sf).conversations
    d = conv.filter(F.length(F.trim("text")) > 0)
    concepts = conv.select("conv_id").distinct()
    fsn = W.keep_one(d.filter(F.col("role") == "system"), ["conv_id"], [F.col("turn")], ["turn", "text"]) \
           .select("conv_id", F.col("turn").alias("fsn_turn"), F.col("text").alias("__ft"))
    refset = conv.filter(F.length("text") >= 200).select("conv_id", "turn")
    syn = d.filter(F.col("role") == "user").join(refset, ["conv_id", "turn"], "left_semi")
    pref = W.keep_one(syn, ["conv_id"], [F.col("turn")], ["turn", "text"]) \
            .select("conv_id", F.col("turn").alias("pref_turn"), F.col("text").alias("__pt"))
    j = concepts.join(fsn, "conv_id", "left").join(pref, "conv_id", "left")
    return j.select("conv_id", "fsn_turn", F.md5("__ft").alias("fsn_md5"), C.trailing_tag(F.col("__ft")).alias("fsn_tag"),
                    "pref_turn", F.md5("__pt").alias("pref_md5"))


@query("authoritative_left_join", sql="""
WITH l AS (SELECT conv_id, text FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY turn) AS rn
                                     FROM conversations WHERE role = 'assistant') WHERE rn = 1),
s AS (SELECT conv_id, text FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY turn) AS rn
                                 FROM conversations WHERE role = 'user') WHERE rn = 1)
SELECT l.conv_id, md5(l.text) AS long_md5, CAST(length(l.text) AS INTEGER) AS long_chars,
       CASE WHEN s.text IS NULL THEN '' ELSE md5(s.text) END AS short_md5
FROM l LEFT JOIN s ON l.conv_id = s.conv_id
""")
def authoritative_left_join(spark, sf):
    """Two sources joined on the code, the left one authoritative; first title
    wins on each side; a missing right title becomes ''."""
    conv = Tables(spark, sf).conversations
    long = W.keep_one(conv.filter(F.col("role") == "assistant"), ["conv_id"], [F.col("turn")], ["text"])
    short = W.keep_one(conv.filter(F.col("role") == "user"), ["conv_id"], [F.col("turn")], ["text"]) \
             .withColumnRenamed("text", "__s")
    j = long.join(short, "conv_id", "left")
    return j.select("conv_id", F.md5("text").alias("long_md5"), F.length("text").alias("long_chars"),
                    F.when(F.col("__s").isNull(), "").otherwise(F.md5("__s")).alias("short_md5"))


@query("defining_row", sql="""
SELECT source, doc_id, lang, n_atoms FROM (
  SELECT source, doc_id, lang, COUNT(*) OVER (PARTITION BY source) AS n_atoms,
         ROW_NUMBER() OVER (PARTITION BY source ORDER BY lang <> 'en', length(CAST(doc_id AS VARCHAR)), CAST(doc_id AS VARCHAR)) AS rn
  FROM documents) WHERE rn = 1
""")
def defining_row(spark, sf):
    """One row per concept — non-synonym class first, then the
    numeric-aware id order (length, then text)."""
    d = Tables(spark, sf).documents.select("source", "doc_id", "lang")
    sid = F.col("doc_id").cast("string")
    picked = d.groupBy("source").agg(
        F.min(F.struct((F.col("lang") != "en").alias("a"), F.length(sid).alias("b"), sid.alias("c"),
                       F.col("doc_id"), F.col("lang"))).alias("__s"),
        F.count(F.lit(1)).alias("n_atoms"))
    return picked.select("source", "__s.doc_id", "__s.lang", "n_atoms")


_SUBDIVISION_SQL = """
r AS (SELECT s_suppkey AS rid, chr((65 + s_nationkey % 26)::INTEGER) || 'Q' AS scope, s_suppkey % 90 AS loc, s_suppkey % 4 AS kind FROM supplier),
own AS (SELECT rid, scope || '-' || loc AS code FROM r WHERE kind IN (0, 1) UNION ALL SELECT rid, scope || '-' || loc FROM r WHERE kind = 2),
c AS (SELECT code, MIN(rid) AS rid FROM own GROUP BY 1),
n AS (SELECT scope, 'place ' || loc AS k, MIN(rid) AS rid, COUNT(DISTINCT rid) > 1 AS amb FROM r GROUP BY 1, 2),
t AS (SELECT DISTINCT chr((65 + c_nationkey % 26)::INTEGER) || 'Q' AS scope, c_custkey % 100 AS loc FROM customer),
m AS (SELECT t.scope || '-' || loc AS code,
             CASE WHEN c.rid IS NOT NULL THEN 'code' WHEN n.rid IS NOT NULL AND amb THEN 'name_ambiguous' WHEN n.rid IS NOT NULL THEN 'name' ELSE 'none' END AS method,
             CASE WHEN c.rid IS NOT NULL THEN c.rid WHEN n.rid IS NOT NULL AND NOT amb THEN n.rid END AS linked_rid
      FROM t LEFT JOIN c ON c.code = t.scope || '-' || loc LEFT JOIN n ON n.scope = t.scope AND n.k = 'place ' || loc)
"""


def _subdivisions(spark, sf):
    """References whose code is dotted (kinds 0 and 1), dashed (2) or absent (3); targets by code and name."""
    t = Tables(spark, sf)
    letters = lambda c: F.concat(F.chr(F.col(c) % 26 + 65), F.lit("Q"))
    kind, loc = F.col("s_suppkey") % 4, (F.col("s_suppkey") % 90).cast("string")
    scope = letters("s_nationkey")
    refs = t.supplier.select(
        F.col("s_suppkey").alias("rid"), scope.alias("scope"), F.concat(F.lit("Pläce  "), loc).alias("name"),
        F.when(kind < 2, F.concat(F.lit(" "), F.lower(scope), F.lit("."), loc)).when(kind == 2, "broken.code.x").alias("hasc"),
        F.when(kind == 1, "ZZ-9").when(kind == 2, F.concat(F.lower(scope), F.lit("-"), loc, F.lit(" "))).otherwise("").alias("iso"))
    spot = (F.col("c_custkey") % 100).cast("string")
    targets = t.customer.select(letters("c_nationkey").alias("scope"), spot.alias("loc")).distinct().select(
        F.concat("scope", F.lit("-"), "loc").alias("code"), "scope", F.concat(F.lit("PLACE-"), "loc").alias("name"))
    names = M.name_index(refs, "scope", "rid", F.array("name"))
    none = spark.createDataFrame([], "code string, rid long")
    return refs, M.tiered_match(targets, "code", "scope", "name", M.code_claims(refs, "hasc", "iso", "rid"), names, none, "rid")


@query("subdivision_match", sql=f"WITH {_SUBDIVISION_SQL} SELECT code, method, linked_rid FROM m")
def subdivision_match(spark, sf):
    """Own codes first (dotted spelling, then dashed), names within the country next."""
    return _subdivisions(spark, sf)[1]


@query("unmatched_ids", sql=f"WITH {_SUBDIVISION_SQL} SELECT rid FROM r WHERE rid NOT IN (SELECT linked_rid FROM m WHERE linked_rid IS NOT NULL)")
def unmatched_ids(spark, sf):
    """References that no target claims."""
    refs, matched = _subdivisions(spark, sf)
    return M.unmatched_ids(refs, matched, "rid")
