"""Code rules, conformance and dimension plans."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import codes as C
from tessera.functions import dates as D

from tessera.operators import aggregates as A
from tessera.operators import conform as K
from tessera.operators import entitymap as EM
from tessera.operators import joins as J
from tessera.plans.registry import query
from tessera.sources.tables import Tables


def _full(pattern: str, x: str) -> str:
    return f"regexp_full_match({x}, '{pattern}')"


# ------------------------------------------------------------------ F1, S18

@query("id_normalize", sql="""
SELECT c_custkey,
       regexp_replace(c_name, '[^0-9]', '', 'g') AS digits,
       CASE WHEN regexp_full_match(CAST(c_custkey AS VARCHAR), '[0-9]{1,9}') THEN lpad(CAST(c_custkey AS VARCHAR), 9, '0') ELSE CAST(c_custkey AS VARCHAR) END AS id9,
       CASE WHEN regexp_full_match(CAST(c_custkey AS VARCHAR), '[0-9]{1,3}') THEN lpad(CAST(c_custkey AS VARCHAR), 3, '0') END AS id3_strict,
       CASE WHEN regexp_full_match(CAST(c_custkey AS VARCHAR), '[0-9]{1,3}') THEN lpad(CAST(c_custkey AS VARCHAR), 3, '0') ELSE CAST(c_custkey AS VARCHAR) END AS id3_lenient,
       regexp_replace(c_name, '[^0-9]', '', 'g') = (CASE WHEN regexp_full_match(CAST(c_custkey AS VARCHAR), '[0-9]{1,9}') THEN lpad(CAST(c_custkey AS VARCHAR), 9, '0') ELSE CAST(c_custkey AS VARCHAR) END) AS name_matches
FROM customer
""")
def id_normalize(spark, sf):
    """Zero-pad ids (lenient passes over-long through, strict nulls it);
    digits-only cleaning of a text id."""
    c = Tables(spark, sf).customer
    digits = C.digits_only("c_name")
    id9 = C.pad_id("c_custkey", 9)
    return c.select("c_custkey", digits.alias("digits"), id9.alias("id9"),
                    C.pad_id_strict("c_custkey", 3).alias("id3_strict"), C.pad_id("c_custkey", 3).alias("id3_lenient"),
                    (digits == id9).alias("name_matches"))


# ------------------------------------------------------------------ F2, F8

@query("prefix_parents", sql="""
SELECT p_partkey, code, substr(code, 1, 1) AS section, substr(code, 1, 2) AS parent2, substr(code, 1, 3) AS parent3,
       CASE WHEN length(code) > 4 THEN substr(code, 1, 4) END AS parent4
FROM (SELECT p_partkey, CASE WHEN regexp_full_match(CAST(p_partkey AS VARCHAR), '[0-9]{1,5}')
                             THEN lpad(CAST(p_partkey AS VARCHAR), 5, '0') ELSE CAST(p_partkey AS VARCHAR) END AS code
      FROM part)
""")
def prefix_parents(spark, sf):
    """F2/F8: parent ids by prefix of a zero-padded code (lenient pad: keys wider
    than the code never get truncated)."""
    p = Tables(spark, sf).part
    p = p.select("p_partkey", C.pad_id("p_partkey", 5).alias("code"))
    return p.select("p_partkey", "code", C.prefix("code", 1).alias("section"), C.prefix("code", 2).alias("parent2"),
                    C.prefix("code", 3).alias("parent3"),
                    F.when(F.length("code") > 4, C.prefix("code", 4)).alias("parent4"))


# ------------------------------------------------------------------ F3

_LEVELS = ("state", "county", "tract", "zcta", "bg", "block")


def _positional_sql() -> str:
    whens = []
    for lvl, (blen, spans) in C.POSITIONAL_LEVELS.items():
        val = " || ".join(f"substr(body, {s}, {n})" for s, n in spans)
        whens.append(f"WHEN lvl = '{lvl}' AND starts_with(g, 'G') AND length(body) = {blen} "
                     f"AND regexp_full_match(body, '[0-9]+') THEN {val}")
    lens = " ".join(f"WHEN {i} THEN {C.POSITIONAL_LEVELS[l][0]}" for i, l in enumerate(_LEVELS))
    names = " ".join(f"WHEN {i} THEN '{l}'" for i, l in enumerate(_LEVELS))
    return f"""
WITH k AS (
  SELECT s_suppkey, CASE s_suppkey % 6 {names} END AS lvl,
         'g' || CASE WHEN s_nationkey = 0 THEN 'X' ELSE '' END
             || lpad(CAST(s_suppkey AS VARCHAR), CASE s_suppkey % 6 {lens} END, '0') AS gisjoin
  FROM supplier
), b AS (SELECT *, upper(trim(gisjoin)) AS g, substr(upper(trim(gisjoin)), 2, 1000) AS body FROM k)
SELECT s_suppkey, lvl AS level, gisjoin, CASE {" ".join(whens)} END AS geoid FROM b
"""


@query("positional_key_decode", sql=_positional_sql())
def positional_key_decode(spark, sf):
    """decode G-prefixed positional keys per level (separators dropped,
    length and digits checked; malformed -> NULL)."""
    s = Tables(spark, sf).supplier
    idx = (F.col("s_suppkey") % 6).cast("int")
    lvl = F.element_at(F.array(*[F.lit(l) for l in _LEVELS]), idx + 1)
    blen = F.element_at(F.array(*[F.lit(C.POSITIONAL_LEVELS[l][0]) for l in _LEVELS]), idx + 1)
    key = F.concat(F.lit("g"), F.when(F.col("s_nationkey") == 0, "X").otherwise(""),
                   F.lpad(F.col("s_suppkey").cast("string"), blen, "0"))
    s = s.select("s_suppkey", lvl.alias("level"), key.alias("gisjoin"))
    return s.withColumn("geoid", C.positional_decode("gisjoin", "level"))


# ------------------------------------------------------------------ F5

@query("segment_pad_code", sql="""
WITH r AS (SELECT p_partkey,
                  CAST(p_partkey AS VARCHAR) || '-' || CAST(p_size AS VARCHAR) || '-' || CAST(p_partkey % 1000 AS VARCHAR) AS raw_package,
                  CAST(p_partkey AS VARCHAR) || '-' || CAST(p_size AS VARCHAR) AS raw_product FROM part),
s AS (SELECT *, string_split(trim(raw_package), '-') AS a, string_split(trim(raw_product), '-') AS b FROM r)
SELECT p_partkey, raw_package, raw_product,
  CASE WHEN len(a) = 3 AND regexp_full_match(a[1], '[0-9]{1,5}') AND regexp_full_match(a[2], '[0-9]{1,4}') AND regexp_full_match(a[3], '[0-9]{1,2}')
       THEN lpad(a[1], 5, '0') || lpad(a[2], 4, '0') || lpad(a[3], 2, '0') END AS package_code,
  CASE WHEN len(b) = 2 AND regexp_full_match(b[1], '[0-9]{1,5}') AND regexp_full_match(b[2], '[0-9]{1,4}')
       THEN lpad(b[1], 5, '0') || lpad(b[2], 4, '0') END AS product_code
FROM s
""")
def segment_pad_code(spark, sf):
    """per-segment zero padding (5-4-2 and 5-4), NULL when malformed."""
    p = Tables(spark, sf).part
    pkg = F.concat_ws("-", F.col("p_partkey").cast("string"), F.col("p_size").cast("string"),
                      (F.col("p_partkey") % 1000).cast("string"))
    prod = F.concat_ws("-", F.col("p_partkey").cast("string"), F.col("p_size").cast("string"))
    p = p.select("p_partkey", pkg.alias("raw_package"), prod.alias("raw_product"))
    return p.select("*", C.segment_pad("raw_package", (5, 4, 2)).alias("package_code"),
                    C.segment_pad("raw_product", (5, 4)).alias("product_code"))


# ------------------------------------------------------------------ F6, F7

def _dot_sql(x: str, n: str) -> str:
    return f"CASE WHEN length({x}) <= {n} THEN {x} ELSE substr({x}, 1, {n}) || '.' || substr({x}, {n} + 1) END"


_RAW_SQL = "lower(substr(p_type, 1, 1)) || CAST(p_partkey AS VARCHAR)"
_CLEAN_UP = f"replace(upper(trim({_RAW_SQL})), '.', '')"
_CLEAN_DIG = "replace(trim(CAST(p_partkey AS VARCHAR)), '.', '')"
_DOTTED_SQL = f"""
SELECT p_partkey, {_RAW_SQL} AS raw,
       {_dot_sql(_CLEAN_UP, '3')} AS icd10_style,
       {_dot_sql(_CLEAN_UP, "CASE WHEN starts_with(" + _CLEAN_UP + ", 'E') THEN 4 ELSE 3 END")} AS icd9_style,
       {_dot_sql(_CLEAN_DIG, '2')} AS procedure_style
FROM part
"""


@query("dotted_code", sql=_DOTTED_SQL)
def dotted_code(spark, sf):
    """strip, upper, drop the dot, re-dot after the category (3, 4 for E codes, 2 for procedures)."""
    p = Tables(spark, sf).part
    raw = F.concat(F.lower(F.substring("p_type", 1, 1)), F.col("p_partkey").cast("string"))
    p = p.select("p_partkey", raw.alias("raw"))
    return p.select("p_partkey", "raw", C.dotted("raw", 3).alias("icd10_style"),
                    C.dotted("raw", 3, e_category_len=4).alias("icd9_style"),
                    C.dotted(F.col("p_partkey").cast("string"), 2, upper=False).alias("procedure_style"))


@query("format_validate", sql=f"""
SELECT p_partkey, icd10_style, icd9_style, procedure_style,
       regexp_full_match(icd10_style, '{C.CODE_PATTERNS["icd10cm"]}') AS icd10_ok,
       regexp_full_match(icd9_style, '{C.CODE_PATTERNS["icd9cm"]}') AS icd9_ok,
       regexp_full_match(procedure_style, '{C.CODE_PATTERNS["icd9_procedure"]}') AS procedure_ok,
       regexp_full_match(upper(lpad(CAST(p_partkey AS VARCHAR), 7, 'A')), '{C.CODE_PATTERNS["icd10pcs"]}') AS pcs_ok
FROM ({_DOTTED_SQL})
""")
def format_validate(spark, sf):
    """Code-shape validation per code system."""
    d = dotted_code(spark, sf)
    return d.select("p_partkey", "icd10_style", "icd9_style", "procedure_style",
                    C.matches("icd10_style", "icd10cm").alias("icd10_ok"),
                    C.matches("icd9_style", "icd9cm").alias("icd9_ok"),
                    C.matches("procedure_style", "icd9_procedure").alias("procedure_ok"),
                    C.matches(F.upper(F.lpad(F.col("p_partkey").cast("string"), 7, "A")), "icd10pcs").alias("pcs_ok"))


# ------------------------------------------------------------------ F9

def _verhoeff_sql(x: str) -> str:
    d, p = C._verhoeff_tables()
    dl = "[" + ", ".join(map(str, d)) + "]"
    pl = "[" + ", ".join(map(str, p)) + "]"
    digits = f"list_transform(string_split(reverse({x}), ''), lambda ch: CAST(ch AS INTEGER))"
    red = f"list_reduce({digits}, lambda c, v, i: {dl}[c * 10 + {pl}[((i - 1) % 8) * 10 + v + 1] + 1], 0)"
    return f"CASE WHEN regexp_full_match({x}, '[1-9][0-9]{{5,17}}') THEN {red} = 0 ELSE FALSE END"


@query("check_digit", sql=f"""
SELECT o_orderkey, sctid, {_verhoeff_sql('sctid')} AS is_valid
FROM (SELECT o_orderkey, CAST(o_orderkey * 10 + o_custkey % 10 + 100000 AS VARCHAR) AS sctid FROM orders)
""")
def check_digit(spark, sf):
    """Verhoeff check digit over candidate identifiers (length 6-18, no leading zero)."""
    o = Tables(spark, sf).orders
    sctid = (F.col("o_orderkey") * 10 + F.col("o_custkey") % 10 + 100000).cast("string")
    return o.select("o_orderkey", sctid.alias("sctid")).withColumn("is_valid", C.verhoeff_valid("sctid"))


# ------------------------------------------------------------------ F11

@query("label_normalize", sql="""
SELECT o_orderkey, lower(regexp_replace(trim(o_orderpriority), '[\\s\\-]+', '_', 'g')) AS priority_label
FROM orders
""")
def label_normalize(spark, sf):
    """trim, collapse runs of spaces/hyphens to '_', lower-case."""
    o = Tables(spark, sf).orders
    return o.select("o_orderkey", C.snake_label("o_orderpriority").alias("priority_label"))


# ------------------------------------------------------------------ F12, Z1

_NAME_KEY_SQL = """
SELECT conv_id, turn,
       CASE WHEN trim(regexp_replace(strip_accents(lower(text)), '[^a-z0-9]+', ' ', 'g')) <> ''
            THEN trim(regexp_replace(strip_accents(lower(text)), '[^a-z0-9]+', ' ', 'g')) END AS name_key
FROM conversations
"""


@query("name_key", sql=_NAME_KEY_SQL)
def name_key(spark, sf):
    """accent-insensitive match key as a built-in expression (translate over the
    accented Latin letters, generated from the Unicode database)."""
    c = Tables(spark, sf).conversations
    return c.select("conv_id", "turn", C.name_key("text").alias("name_key"))


@query("vectorised_name_key", sql=_NAME_KEY_SQL)
def vectorised_name_key(spark, sf):
    """The exact NFKD key, computed per Arrow batch in Python (no built-in does
    NFKD). Only the one text column crosses into Python."""
    from pyspark.sql.functions import pandas_udf

    # defined here (not at module level) so it is shipped to the Python workers by
    # value: the workers need pandas, not this package
    def batch_key(names: pd.Series) -> pd.Series:
        marks = "[" + "".join(MARKS_IN_BATCH) + "]+"
        plain = names.str.normalize("NFKD").str.replace(marks, "", regex=True).str.lower()
        key = plain.str.replace("[^a-z0-9]+", " ", regex=True).str.strip()
        return key.where(key != "", None)

    MARKS_IN_BATCH = list(C.MARKS)
    key = pandas_udf(batch_key, T.StringType())
    c = Tables(spark, sf).conversations
    return c.select("conv_id", "turn", key("text").alias("name_key"))


@query("entity_map_rules", sql="""
WITH e AS (SELECT 'nation' AS level, n_nationkey::VARCHAR AS code, n_name AS name, 2 AS width, 1 AS parent_digits, '_' AS joiner FROM nation
           UNION ALL SELECT 'supplier', s_suppkey::VARCHAR, s_name, 4, 2, ' ' FROM supplier
           UNION ALL SELECT 'customer', c_custkey::VARCHAR, c_name, 4, 3, '-' FROM customer)
SELECT level, code, CASE WHEN length(code) <= width THEN lpad(code, width, '0') END AS id,
       CASE WHEN length(code) <= width THEN substr(lpad(code, width, '0'), 1, parent_digits) END AS parent_id,
       nullif(replace(trim(regexp_replace(strip_accents(lower(name)), '[^a-z0-9]+', ' ', 'g')), ' ', joiner), '') AS name_key FROM e
""")
def entity_map_rules(spark, sf):
    """Entities of three levels pass through one Arrow stage, in which two rules make their ids and
    name keys; width, parent digits and joiner of each level ride in as columns."""
    t = Tables(spark, sf)

    def level(name, df, key, label, width, parent_digits, joiner):
        return df.select(F.lit(name).alias("level"), F.col(key).cast("string").alias("code"), F.col(label).alias("name"), F.lit(width).alias("width"),
                         F.lit(parent_digits).alias("parent_digits"), F.lit(joiner).alias("joiner"))

    e = (level("nation", t.nation, "n_nationkey", "n_name", 2, 1, "_").unionAll(level("supplier", t.supplier, "s_suppkey", "s_name", 4, 2, " "))
         .unionAll(level("customer", t.customer, "c_custkey", "c_name", 4, 3, "-")))
    out = EM.map_entities(e, ["level", "code"], [EM.id_rule("key", "code", "width", "parent_digits"), EM.name_rule("name_key", "name", "joiner")])
    return out.select("level", "code", F.col("key.id").alias("id"), F.col("key.parent").alias("parent_id"), "name_key")


# ------------------------------------------------------------------ F13, F14

@query("iso_code_checks", sql="""
WITH r AS (SELECT c_custkey, upper(trim(substr(c_mktsegment, 1, 2))) AS a2, upper(trim(substr(c_name, 1, 3))) AS a3,
                  CAST(c_nationkey AS VARCHAR) AS num, upper(trim(substr(c_mktsegment, 1, 2) || '-' || CAST(c_custkey AS VARCHAR))) AS sub,
                  upper(substr(c_mktsegment, 1, 3)) AS gid0 FROM customer)
SELECT c_custkey,
       CASE WHEN regexp_full_match(a2, '[A-Z]{2}') THEN a2 END AS alpha2,
       CASE WHEN regexp_full_match(a3, '[A-Z]{3}') THEN a3 END AS alpha3,
       CASE WHEN regexp_full_match(trim(num), '[0-9]{1,3}') THEN lpad(trim(num), 3, '0') END AS numeric3,
       CASE WHEN regexp_full_match(sub, '[A-Z]{2}-[A-Z0-9]{1,3}') THEN split_part(sub, '-', 1) END AS sub_alpha2,
       CASE WHEN regexp_full_match(sub, '[A-Z]{2}-[A-Z0-9]{1,3}') THEN split_part(sub, '-', 2) END AS sub_local,
       COALESCE(regexp_full_match(gid0, '[A-Z]{3}'), FALSE) AND gid0 NOT IN ('XKO', 'XNC', 'XAD', 'XCA', 'XCL', 'XPI', 'XSP')
         AND NOT starts_with(gid0, 'X') AS is_iso_gid0
FROM r
""")
def iso_code_checks(spark, sf):
    """alpha-2/3 shape, numeric pad 3, AA-LLL split, not-a-real-code filter."""
    c = Tables(spark, sf).customer
    sub = F.concat(F.substring("c_mktsegment", 1, 2), F.lit("-"), F.col("c_custkey").cast("string"))
    a2, local = C.subdivision_parts(sub)
    return c.select("c_custkey", C.alpha_code(F.substring("c_mktsegment", 1, 2), 2).alias("alpha2"),
                    C.alpha_code(F.substring("c_name", 1, 3), 3).alias("alpha3"),
                    C.numeric3(F.col("c_nationkey")).alias("numeric3"), a2.alias("sub_alpha2"), local.alias("sub_local"),
                    C.is_iso_gid0(F.upper(F.substring("c_mktsegment", 1, 3))).alias("is_iso_gid0"))


# ------------------------------------------------------------------ F15

@query("level_from_path", sql="""
WITH g AS (SELECT c_custkey, c_custkey % 4 AS declared,
  CASE c_custkey % 3 WHEN 0 THEN 'NAT' || CAST(c_nationkey AS VARCHAR)
                     WHEN 1 THEN 'NAT' || CAST(c_nationkey AS VARCHAR) || '.' || CAST(c_custkey AS VARCHAR)
                     ELSE 'NAT' || CAST(c_nationkey AS VARCHAR) || '.' || CAST(c_custkey AS VARCHAR) || '.' || substr(c_mktsegment, 1, 1) END || '_1' AS gid
  FROM customer)
SELECT c_custkey, gid, CAST(length(trim(gid)) - length(replace(trim(gid), '.', '')) AS INTEGER) AS level,
       CAST(declared AS INTEGER) AS declared_level,
       CAST(length(trim(gid)) - length(replace(trim(gid), '.', '')) AS INTEGER) = declared AS level_agrees
FROM g
""")
def level_from_path(spark, sf):
    """admin level implied by the dot count must agree with the declared level."""
    c = Tables(spark, sf).customer
    nat = F.concat(F.lit("NAT"), F.col("c_nationkey").cast("string"))
    m = F.col("c_custkey") % 3
    gid = F.concat(F.when(m == 0, nat)
                    .when(m == 1, F.concat_ws(".", nat, F.col("c_custkey").cast("string")))
                    .otherwise(F.concat_ws(".", nat, F.col("c_custkey").cast("string"), F.substring("c_mktsegment", 1, 1))),
                   F.lit("_1"))
    g = c.select("c_custkey", gid.alias("gid"), (F.col("c_custkey") % 4).cast("int").alias("declared_level"))
    return g.withColumn("level", C.dot_level("gid")).withColumn("level_agrees", F.col("level") == F.col("declared_level"))


# ------------------------------------------------------------------ F16, S17

@query("combined_code_split", sql="""
WITH r AS (SELECT p_partkey, CASE WHEN p_size >= 48 THEN '99.0'
                                  WHEN p_size % 5 = 0 THEN CAST(p_size % 11 AS VARCHAR)
                                  ELSE CAST(p_size % 11 AS VARCHAR) || '.' || CAST(p_size % 4 AS VARCHAR) END AS combined FROM part)
SELECT p_partkey, combined,
       try_cast(split_part(trim(combined), '.', 1) AS INTEGER) AS primary_code,
       CASE WHEN trim(combined) = '' THEN NULL
            WHEN CAST(split_part(trim(combined), '.', 1) AS INTEGER) = 99 THEN '99'
            ELSE CAST(CAST(split_part(trim(combined), '.', 1) AS INTEGER) AS VARCHAR) || '.' ||
                 CASE WHEN strpos(trim(combined), '.') > 0 THEN substr(trim(combined), strpos(trim(combined), '.') + 1) ELSE '0' END
       END AS secondary_code
FROM r
""")
def combined_code_split(spark, sf):
    """One dotted column feeds both codes; string rules only (never a double):
    ``10`` -> ``10.0``, ``99.0`` -> ``99``."""
    p = Tables(spark, sf).part
    s = F.col("p_size")
    combined = (F.when(s >= 48, F.lit("99.0"))
                .when(s % 5 == 0, (s % 11).cast("string"))
                .otherwise(F.concat((s % 11).cast("string"), F.lit("."), (s % 4).cast("string"))))
    p = p.select("p_partkey", combined.alias("combined"))
    return p.select("p_partkey", "combined", C.primary_code("combined").alias("primary_code"),
                    C.secondary_code("combined").alias("secondary_code"))


# ------------------------------------------------------------------ F17

@query("flag_bool", sql="""
SELECT o_orderkey, raw_flag, COALESCE(upper(trim(raw_flag)) = 'Y', FALSE) AS flag
FROM (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN ' y' WHEN 'O' THEN 'N' ELSE '' END AS raw_flag FROM orders)
""")
def flag_bool(spark, sf):
    """Y/N flag to boolean; blank and anything else is False."""
    o = Tables(spark, sf).orders
    raw = F.when(F.col("o_orderstatus") == "F", " y").when(F.col("o_orderstatus") == "O", "N").otherwise("")
    return o.select("o_orderkey", raw.alias("raw_flag")).withColumn("flag", C.yn_bool("raw_flag"))


# ------------------------------------------------------------------ P6, M2

@query("nullish_clean", sql="""
WITH r AS (SELECT c_custkey,
             CASE WHEN c_acctbal < 0 THEN 'n/a' WHEN c_acctbal < 100 THEN ' ' WHEN c_acctbal < 200 THEN 'None'
                  ELSE format('{:,.2f}', c_acctbal) END AS raw_balance FROM customer)
SELECT c_custkey, raw_balance,
       CASE WHEN NOT COALESCE(lower(trim(raw_balance)) IN ('', 'na', 'n/a', 'null', 'none', '.'), TRUE)
            THEN try_cast(replace(trim(raw_balance), ',', '') AS DOUBLE) END AS balance,
       COALESCE(lower(trim(raw_balance)) IN ('', 'na', 'n/a', 'null', 'none', '.'), TRUE) AS is_nullish
FROM r
""")
def nullish_clean(spark, sf):
    """Nullish tokens -> NULL, thousands separators dropped before the numeric parse."""
    c = Tables(spark, sf).customer
    b = F.col("c_acctbal")
    raw = (F.when(b < 0, "n/a").when(b < 100, " ").when(b < 200, "None").otherwise(F.format_number(b, 2)))
    c = c.select("c_custkey", raw.alias("raw_balance"))
    return c.select("c_custkey", "raw_balance", C.lenient_double("raw_balance").alias("balance"),
                    C.is_nullish("raw_balance").alias("is_nullish"))


# ------------------------------------------------------------------ P7, P13

# The segment whitelist and the exception list of nations.
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "MACHINERY")
EXCEPTION_NATIONS = (1, 2)


@query("vocab_whitelist", sql="""
SELECT c_custkey, CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'MACHINERY') THEN c_mktsegment END AS segment,
       c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'MACHINERY') OR c_nationkey IN (1, 2) AS is_member
FROM customer
""")
def vocab_whitelist(spark, sf):
    """Out-of-vocabulary -> NULL; derived membership flag with an exception list."""
    c = Tables(spark, sf).customer
    return c.select("c_custkey", K.whitelist(F.col("c_mktsegment"), SEGMENTS).alias("segment"),
                    (F.col("c_mktsegment").isin(*SEGMENTS) | F.col("c_nationkey").isin(*EXCEPTION_NATIONS)).alias("is_member"))


# ------------------------------------------------------------------ J14

# Scheme version by vintage range, and the codes each version allows.
SCHEME_BY_VINTAGE = ((1900, 1997, "v1"), (1998, 1999, "v2"), (2000, 2100, "v3"))
ALLOWED_CODES = {"v1": (1, 2, 3), "v2": (1, 2, 3, 4), "v3": (1, 2, 3, 4, 5)}


@query("versioned_vocab", sql="""
WITH s AS (SELECT * FROM (VALUES (1900, 1997, 'v1'), (1998, 1999, 'v2'), (2000, 2100, 'v3')) t(lo, hi, scheme_version)),
a AS (SELECT * FROM (VALUES ('v1', 1), ('v1', 2), ('v1', 3), ('v2', 1), ('v2', 2), ('v2', 3), ('v2', 4),
                            ('v3', 1), ('v3', 2), ('v3', 3), ('v3', 4), ('v3', 5)) t(v, code)),
o AS (SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS vintage, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS code FROM orders)
SELECT o.o_orderkey, o.vintage, s.scheme_version, o.code, a.code IS NOT NULL AS is_allowed
FROM o LEFT JOIN s ON o.vintage BETWEEN s.lo AND s.hi
LEFT JOIN a ON s.scheme_version = a.v AND o.code = a.code
""")
def versioned_vocab(spark, sf):
    """Vintage -> scheme version -> allowed codes, two lookups against tiny
    literal tables."""
    o = Tables(spark, sf).orders
    versions = spark.createDataFrame(list(SCHEME_BY_VINTAGE), "lo int, hi int, scheme_version string")
    allowed = spark.createDataFrame([(v, c) for v, cs in ALLOWED_CODES.items() for c in cs], "v string, a_code int")
    o = o.select("o_orderkey", F.year("o_orderdate").alias("vintage"),
                 F.substring("o_orderpriority", 1, 1).cast("int").alias("code"))
    o = J.range_lookup(o, F.col("vintage"), versions, "lo", "hi", ["scheme_version"])
    allowed = allowed.withColumn("__ok", F.lit(True))
    o = o.join(allowed, (F.col("scheme_version") == F.col("v")) & (F.col("code") == F.col("a_code")), "left")
    return o.select("o_orderkey", "vintage", "scheme_version", "code",
                    F.coalesce(F.col("__ok"), F.lit(False)).alias("is_allowed"))


# ------------------------------------------------------------------ F10

PUBLISHED_TAGS = ("economy", "standard")


@query("tag_allowlist", sql="""
WITH r AS (SELECT p_partkey, p_retailprice > 1500 AS active,
                  trim(regexp_extract(p_name || ' (' || lower(p_type) || '-' || CAST(p_size % 3 AS VARCHAR) || ')', '\\(([^()]+)\\)\\s*$', 1)) AS tag
           FROM part),
carried AS (SELECT DISTINCT tag FROM r WHERE active)
SELECT p_partkey, tag,
       CASE WHEN tag IN ('economy', 'standard') OR tag IN (SELECT tag FROM carried) THEN tag ELSE '' END AS kept_tag
FROM r
""")
def tag_allowlist(spark, sf):
    """trailing (tag) kept only if published or carried by any active row
    (allow-list built with a distinct, joined back; AQE picks the join at runtime)."""
    p = Tables(spark, sf).part
    fsn = F.concat(F.col("p_name"), F.lit(" ("), F.lower("p_type"), F.lit("-"), (F.col("p_size") % 3).cast("string"), F.lit(")"))
    r = p.select("p_partkey", (F.col("p_retailprice") > 1500).alias("active"), C.trailing_tag(fsn).alias("tag"))
    carried = r.filter("active").select(F.col("tag").alias("__t")).distinct().withColumn("__carried", F.lit(True))
    r = r.join(carried, F.col("tag") == F.col("__t"), "left")  # AQE sizes the derived allow-list
    keep = F.col("tag").isin(*PUBLISHED_TAGS) | F.col("__carried").isNotNull()
    return r.select("p_partkey", "tag", F.when(keep, F.col("tag")).otherwise(F.lit("")).alias("kept_tag"))


# ------------------------------------------------------------------ G2

@query("tag_parse", sql="""
WITH r AS (SELECT event_id, CASE WHEN value > 100 THEN event_type || ':' || CAST(user_id AS VARCHAR)
                                 WHEN value > 50 THEN ':' || CAST(user_id AS VARCHAR)
                                 ELSE event_type END AS tag FROM events)
SELECT event_id, tag,
       CASE WHEN strpos(tag, ':') > 1 AND strpos(tag, ':') < length(tag) THEN split_part(tag, ':', 1) END AS namespace,
       CASE WHEN strpos(tag, ':') > 1 AND strpos(tag, ':') < length(tag) THEN substr(tag, strpos(tag, ':') + 1) END AS tag_value
FROM r
""")
def tag_parse(spark, sf):
    """``namespace:value`` split; malformed (no colon, empty side) -> NULLs."""
    e = Tables(spark, sf).events
    tag = (F.when(F.col("value") > 100, F.concat_ws(":", "event_type", F.col("user_id").cast("string")))
           .when(F.col("value") > 50, F.concat(F.lit(":"), F.col("user_id").cast("string")))
           .otherwise(F.col("event_type")))
    e = e.select("event_id", tag.alias("tag"))
    return e.select("event_id", "tag", C.tag_namespace("tag").alias("namespace"), C.tag_value("tag").alias("tag_value"))


# ------------------------------------------------------------------ G1

@query("details_json", sql="""
SELECT o_orderkey, CAST(json_object('o_custkey', o_custkey, 'o_orderstatus', o_orderstatus,
                                    'o_totalprice', o_totalprice, 'priority', substr(o_orderpriority, 1, 1)) AS VARCHAR) AS details
FROM orders
""")
def details_json(spark, sf):
    """G1: details dict -> JSON text with alphabetically sorted keys."""
    from tessera.operators.dq import details_json as dj
    o = Tables(spark, sf).orders
    return o.select("o_orderkey", dj({"priority": F.substring("o_orderpriority", 1, 1), "o_custkey": F.col("o_custkey"),
                                      "o_totalprice": F.col("o_totalprice"), "o_orderstatus": F.col("o_orderstatus")}).alias("details"))


# ------------------------------------------------------------------ D4

@query("safe_date_parse", sql="""
WITH r AS (SELECT o_orderkey,
             CASE o_orderkey % 10 WHEN 0 THEN '' WHEN 1 THEN 'bad' WHEN 2 THEN strftime(o_orderdate, '%Y') || '1340'
                  ELSE strftime(o_orderdate, '%Y%m%d') END AS raw_compact,
             CASE o_orderkey % 7 WHEN 0 THEN ' ' WHEN 1 THEN '13/1/2000' ELSE strftime(o_orderdate, '%-m/%-d/%Y') END AS raw_slash
           FROM orders)
SELECT o_orderkey, raw_compact, raw_slash,
       CASE WHEN trim(raw_compact) <> '' THEN CAST(try_strptime(trim(raw_compact), '%Y%m%d') AS DATE) END AS date_compact,
       CASE WHEN trim(raw_slash) <> '' THEN CAST(try_strptime(trim(raw_slash), '%m/%d/%Y') AS DATE) END AS date_slash
FROM r
""")
def safe_date_parse(spark, sf):
    """Strict parse (``yyyyMMdd`` and ``M/d/yyyy``); blank or invalid -> NULL."""
    o = Tables(spark, sf).orders
    k = F.col("o_orderkey")
    compact = (F.when(k % 10 == 0, "").when(k % 10 == 1, "bad")
               .when(k % 10 == 2, F.concat(F.date_format("o_orderdate", "yyyy"), F.lit("1340")))
               .otherwise(F.date_format("o_orderdate", "yyyyMMdd")))
    slash = (F.when(k % 7 == 0, " ").when(k % 7 == 1, "13/1/2000").otherwise(F.date_format("o_orderdate", "M/d/yyyy")))
    o = o.select("o_orderkey", compact.alias("raw_compact"), slash.alias("raw_slash"))
    return o.select("*", D.safe_date("raw_compact", "yyyyMMdd").alias("date_compact"),
                    D.safe_date("raw_slash", "M/d/yyyy").alias("date_slash"))


# ------------------------------------------------------------------ D1, D2, D3

@query("calendar_dim", sql="""
WITH b AS (SELECT CAST(MIN(o_orderdate) AS DATE) AS lo, CAST(MAX(o_orderdate) AS DATE) AS hi FROM orders),
d AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM b),
e AS (SELECT *, date - CAST(dayofweek(date) AS INTEGER) + 3 AS wed FROM d)
SELECT date, CAST(year(date) AS INTEGER) AS year, CAST(quarter(date) AS INTEGER) AS quarter, CAST(month(date) AS INTEGER) AS month,
       monthname(date) AS month_name, CAST(day(date) AS INTEGER) AS day_of_month, CAST(isodow(date) AS INTEGER) AS day_of_week_iso,
       dayname(date) AS day_name, CAST(dayofyear(date) AS INTEGER) AS day_of_year, CAST(isoyear(date) AS INTEGER) AS iso_year,
       CAST(weekofyear(date) AS INTEGER) AS iso_week, CAST(year(wed) AS INTEGER) AS epi_year,
       CAST((dayofyear(wed) - 1) // 7 + 1 AS INTEGER) AS epi_week,
       CAST(year(wed) AS VARCHAR) || 'W' || lpad(CAST((dayofyear(wed) - 1) // 7 + 1 AS VARCHAR), 2, '0') AS epi_week_id,
       dayofweek(date) IN (0, 6) AS is_weekend
FROM e
""")
def calendar_dim(spark, sf):
    """One calendar row per day across the span of the order dates."""
    o = Tables(spark, sf).orders
    span = o.agg(F.to_date(F.min("o_orderdate")).alias("lo"), F.to_date(F.max("o_orderdate")).alias("hi"))
    days = span.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("d"))
    return days.select(*D.calendar_columns(F.col("d")))


@query("epi_week_dim", sql="""
WITH b AS (SELECT CAST(MIN(o_orderdate) AS DATE) AS lo, CAST(MAX(o_orderdate) AS DATE) AS hi FROM orders),
y AS (SELECT year(lo - CAST(dayofweek(lo) AS INTEGER) + 3) AS y0, year(hi - CAST(dayofweek(hi) AS INTEGER) + 3) AS y1 FROM b),
d AS (SELECT CAST(unnest(generate_series(make_date(CAST(y0 AS INTEGER) - 1, 12, 1), make_date(CAST(y1 AS INTEGER) + 1, 1, 31), INTERVAL 1 DAY)) AS DATE) AS d, y0, y1 FROM y),
e AS (SELECT d, y0, y1, year(d - CAST(dayofweek(d) AS INTEGER) + 3) AS ey,
             (dayofyear(d - CAST(dayofweek(d) AS INTEGER) + 3) - 1) // 7 + 1 AS ew FROM d)
SELECT CAST(ey AS VARCHAR) || 'W' || lpad(CAST(ew AS VARCHAR), 2, '0') AS epi_week_id,
       CAST(ey AS INTEGER) AS epi_year, CAST(ew AS INTEGER) AS epi_week, MIN(d) AS start_date, MAX(d) AS end_date,
       CAST(ey AS VARCHAR) || '-W' || lpad(CAST(ew AS VARCHAR), 2, '0') AS label
FROM e WHERE ey BETWEEN y0 AND y1 GROUP BY ey, ew
""")
def epi_week_dim(spark, sf):
    """D3: one contiguous Sunday-Saturday row per epi week of the epi years spanned
    by the order dates (range padded so edge weeks are whole)."""
    o = Tables(spark, sf).orders
    span = o.agg(D.epi_year(F.to_date(F.min("o_orderdate"))).alias("y0"),
                 D.epi_year(F.to_date(F.max("o_orderdate"))).alias("y1"))
    days = span.select("y0", "y1", F.explode(F.sequence(F.make_date(F.col("y0") - 1, F.lit(12), F.lit(1)),
                                                        F.make_date(F.col("y1") + 1, F.lit(1), F.lit(31)),
                                                        F.expr("INTERVAL 1 DAY"))).alias("d"))
    days = days.select("d", "y0", "y1", D.epi_year("d").alias("ey"), D.epi_week("d").alias("ew"))
    weeks = days.filter(F.col("ey").between(F.col("y0"), F.col("y1"))).groupBy("ey", "ew").agg(
        F.min("d").alias("start_date"), F.max("d").alias("end_date"))
    return weeks.select(D.epi_week_id("ey", "ew").alias("epi_week_id"), F.col("ey").alias("epi_year"),
                        F.col("ew").alias("epi_week"), "start_date", "end_date",
                        F.format_string("%d-W%02d", "ey", "ew").alias("label"))


# ------------------------------------------------------------------ J1, J2, F4

# Manual override of one conformed code.
CODE_OVERRIDES = {"07": "NATION_SEVEN"}


@query("conform_dictionary", sql="""
WITH f AS (SELECT c_custkey, 'nation' AS region_type, lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS region_code FROM customer),
m AS (SELECT lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS code, n_name FROM nation)
SELECT f.c_custkey, f.region_type, f.region_code,
       CASE WHEN NOT regexp_full_match(f.region_code, '[0-9]{2}') THEN NULL
            WHEN f.region_code = '07' THEN 'NATION_SEVEN' ELSE m.n_name END AS conformed_name
FROM f LEFT JOIN m ON f.region_code = m.code
""")
def conform_dictionary(spark, sf):
    """Conform the distinct (type, code) pairs once — regex guard, lookup,
    override — and join the conformed map back to every fact row."""
    t = Tables(spark, sf)
    fact = t.customer.select("c_custkey", F.lit("nation").alias("region_type"),
                             F.lpad(F.col("c_nationkey").cast("string"), 2, "0").alias("region_code"))
    lookup = t.nation.select(F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("__code"), "n_name")
    overrides = F.create_map(*[F.lit(x) for kv in CODE_OVERRIDES.items() for x in kv])

    def conform(codes):
        j = codes.join(lookup, F.col("region_code") == F.col("__code"), "left")
        val = (F.when(~F.col("region_code").rlike(r"^[0-9]{2}$"), F.lit(None))
               .otherwise(F.coalesce(overrides[F.col("region_code")], F.col("n_name"))))
        return j.select("region_type", "region_code", val.alias("conformed_name"))

    return K.conform_distinct(fact, ["region_type", "region_code"], conform, "conformed_name")


# ------------------------------------------------------------------ F20, R7, J3, P11

@query("region_rollup", sql="""
SELECT r.r_name, COUNT(*) AS n_customers, ROUND(SUM(c.c_acctbal), 2) AS total_acctbal
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
GROUP BY r.r_name
""")
def region_rollup(spark, sf):
    """member -> region through a bounded lookup; roll-up per region. The
    aggregate is pushed below the lookup join (per nation first, then per region)."""
    t = Tables(spark, sf)
    per_nation = t.customer.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"), F.sum("c_acctbal").alias("s"))
    lookup = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name")
    j = per_nation.join(lookup, F.col("c_nationkey") == F.col("n_nationkey"))
    return j.groupBy("r_name").agg(F.sum("n").alias("n_customers"), F.round(F.sum("s"), 2).alias("total_acctbal"))


@query("group_members", sql="""
SELECT r.r_name, string_agg(DISTINCT n.n_name, '>' ORDER BY n.n_name) AS members, COUNT(*) AS n_customers
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
GROUP BY r.r_name
""")
def group_members(spark, sf):
    """Sorted members per group — the nations that have customers, per region —
    from the customer fact reduced per nation first (partial aggregate), then the
    bounded nation -> region lookup."""
    t = Tables(spark, sf)
    per_nation = t.customer.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))
    lookup = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_name")
    j = per_nation.join(lookup, F.col("c_nationkey") == F.col("n_nationkey"))
    members = A.sorted_members(j, ["r_name"], "n_name", "members")
    counts = j.groupBy("r_name").agg(F.sum("n").alias("n_customers"))
    return members.join(counts, "r_name")


def _enriched(t):
    out = J.enrich(t.customer.select("c_custkey", "c_name", "c_nationkey"), t.nation, ["c_nationkey"], ["n_nationkey"],
                   ["n_name", "n_regionkey"])
    out = J.enrich(out, t.region, ["n_regionkey"], ["r_regionkey"], ["r_name"])
    return out.select("c_custkey", "c_name", "n_name", "r_name")


_ENRICH_SQL = """
SELECT c.c_custkey, c.c_name, n.n_name, r.r_name
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
"""


@query("enrich_parents", sql=_ENRICH_SQL)
def enrich_parents(spark, sf):
    """Chained left joins child -> parent -> grandparent (bounded parents broadcast)."""
    return _enriched(Tables(spark, sf))


@query("hierarchical_filter", sql=f"SELECT * FROM ({_ENRICH_SQL}) WHERE r_name = 'ASIA' AND n_name = 'NATION_7'")
def hierarchical_filter(spark, sf):
    """Filter the enriched child by readable parent names."""
    e = _enriched(Tables(spark, sf))
    return e.filter((F.col("r_name") == "ASIA") & (F.col("n_name") == "NATION_7"))
