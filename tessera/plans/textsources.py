"""Text-source plans: pages, conversations and fact rows rendered to lines, staged
in the shared folder, read back with ``spark.read.text`` and parsed (S4-S7, S11, S12)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import codes as C
from tessera.plans.registry import query
from tessera.session import shared_path
from tessera.sources import text as TX
from tessera.sources.tables import Tables


def _stage(spark, lines, name):
    path = shared_path(spark, name)
    TX.write_lines(lines, path)
    return TX.read_lines(spark, path)


@query("csv_link_extract", sql="""
WITH e AS (SELECT page_id, page_id % 3 AS kind FROM pages)
SELECT page_id, CAST(0 AS INTEGER) AS pos, 'obs-' || page_id || '.csv' AS link FROM e WHERE kind < 2
UNION ALL SELECT page_id, 1, 'B' || page_id || '.CSV' FROM e WHERE kind = 0
""")
def csv_link_extract(spark, sf):
    """The ``.csv`` files that directory pages list, derived from the given pages: bare names
    in any case count once; links with a path or a query and other files do not."""
    link = lambda *x: F.concat(F.lit('<a HREF="'), *[F.lit(v) if isinstance(v, str) else v for v in x], F.lit('">x</a>'))
    pid = F.col("page_id").cast("string")
    kind = F.col("page_id") % 3
    pages = Tables(spark, sf).pages.select("page_id", F.concat(
        F.col("html"), link("../"), link("/up/", pid, ".csv"), link("c.csv?v=1"), link("notes.txt"),
        F.when(kind < 2, F.concat(link("obs-", pid, ".csv"), link("obs-", pid, ".csv"))).otherwise(""),
        F.when(kind == 0, link("B", pid, ".CSV")).otherwise("")).alias("html"))
    return pages.select("page_id", F.posexplode(TX.listed_files(F.col("html"), ".csv")).alias("pos", "link"))


@query("html_link_extract", sql="""
WITH raw AS (SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS link0,
                    generate_subscripts(regexp_extract_all(html, 'href="([^"]*)"', 1), 1) AS i FROM pages),
c AS (SELECT page_id, i, regexp_replace(link0, '[?#].*$', '') AS link FROM raw),
k AS (SELECT page_id, link, MIN(i) AS first_i FROM c WHERE link <> '' AND NOT starts_with(link, '..') GROUP BY 1, 2)
SELECT page_id, CAST(ROW_NUMBER() OVER (PARTITION BY page_id ORDER BY first_i) - 1 AS INTEGER) AS pos, link FROM k
""")
def html_link_extract(spark, sf):
    """Links of every page in document order, deduplicated keeping the first."""
    pages = Tables(spark, sf).pages
    return pages.select("page_id", F.posexplode(TX.extract_links(F.col("html"))).alias("pos", "link"))


_URL_RE = r"^(https?)://([^/]+)/([a-z]{2})/([0-9]+)(\.html)?/?([?#].*)?$"


@query("name_pattern_fields", sql=f"""
SELECT page_id, regexp_extract(url, '{_URL_RE}', 1) AS scheme, regexp_extract(url, '{_URL_RE}', 2) AS host,
       regexp_extract(url, '{_URL_RE}', 3) AS lang, CAST(regexp_extract(url, '{_URL_RE}', 4) AS BIGINT) AS item,
       regexp_extract(url, '{_URL_RE}', 5) = '.html' AS is_html
FROM pages WHERE regexp_matches(url, '{_URL_RE}')
""")
def name_pattern_fields(spark, sf):
    """Metadata fields from names by pattern; non-matching names are ignored."""
    pages = Tables(spark, sf).pages
    cols = TX.name_fields(F.col("url"), _URL_RE, {"scheme": 1, "host": 2, "lang": 3, "item": 4, "__ext": 5})
    out = pages.select("page_id", *cols).filter(F.col("scheme").isNotNull())
    return out.select("page_id", "scheme", "host", "lang", F.col("item").cast("bigint").alias("item"),
                      (F.col("__ext") == ".html").alias("is_html"))


# The positional layout of the pipe-delimited atom rows.
ATOM_POSITIONS = {"rxcui": 0, "ispref": 6, "rxaui": 7, "sab": 11, "tty": 12, "str": 14, "suppress": 16}


def _atom_fields():
    li = F.col
    f = [F.lit("")] * 18
    f[0] = li("l_orderkey").cast("string")
    f[6] = F.when(li("l_linenumber") == 1, "Y").otherwise("N")
    f[7] = (li("l_orderkey") * 10 + li("l_linenumber")).cast("string")
    f[11] = li("l_returnflag")
    f[12] = li("l_linestatus")
    f[14] = li("l_partkey").cast("string")
    f[16] = F.when(li("l_discount") > 0.05, "O").otherwise("N")
    return f


def _atom_sql():
    f = ["''"] * 18
    f[0] = "CAST(l_orderkey AS VARCHAR)"
    f[6] = "CASE WHEN l_linenumber = 1 THEN 'Y' ELSE 'N' END"
    f[7] = "CAST(l_orderkey * 10 + l_linenumber AS VARCHAR)"
    f[11] = "l_returnflag"
    f[12] = "l_linestatus"
    f[14] = "CAST(l_partkey AS VARCHAR)"
    f[16] = "CASE WHEN l_discount > 0.05 THEN 'O' ELSE 'N' END"
    return f


@query("positional_split_filter", sql=f"""
WITH r AS (SELECT CASE WHEN l_linenumber = 7 THEN concat_ws('|', {", ".join(_atom_sql()[:10])})
                       ELSE concat_ws('|', {", ".join(_atom_sql())}) || '|' END AS line FROM lineitem),
f AS (SELECT string_split(line, '|') AS a FROM r)
SELECT {", ".join(f"a[{i + 1}] AS {n}" for n, i in ATOM_POSITIONS.items())}
FROM f WHERE len(a) > 17 AND a[12] = 'R' AND a[17] = 'N'
""")
def positional_split_filter(spark, sf):
    """Headerless pipe-delimited rows (trailing pipe) read as text; rows with
    <= 17 fields skipped; predicate on two positional fields."""
    li = Tables(spark, sf).lineitem
    fields = _atom_fields()
    line = F.when(F.col("l_linenumber") == 7, F.concat_ws("|", *fields[:10])) \
            .otherwise(F.concat(F.concat_ws("|", *fields), F.lit("|")))
    staged = _stage(spark, li.select(line.alias("value")), "atoms")
    return TX.positional_split(staged, ATOM_POSITIONS, min_fields=17,
                               where=(F.col("sab") == "R") & (F.col("suppress") == "N"))


# Fixed-width layout (1-based start, length; None = rest of line).
FIXED_SPANS = {"order_no": (1, 10), "code": (12, 7), "flag": (20, 1), "short": (22, 60), "long": (83, None)}
MIN_LINE = 21


@query("fixed_width_parse", sql="""
WITH r AS (SELECT CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN 'HEADER'
             ELSE lpad(CAST(o_orderkey AS VARCHAR), 10, '0') || ' ' || upper(substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 7))
                  || ' ' || CASE o_orderstatus WHEN 'O' THEN '0' ELSE '1' END || ' ' || rpad(o_orderpriority, 60, ' ')
                  || ' ' || CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderpriority || ' / ' || o_orderstatus END END AS line
           FROM orders)
SELECT CAST(substr(line, 1, 10) AS BIGINT) AS order_no, trim(substr(line, 12, 7)) AS code,
       substr(line, 20, 1) = '1' AS is_billable, trim(substr(line, 22, 60)) AS short_description,
       COALESCE(NULLIF(trim(substr(line, 83)), ''), trim(substr(line, 22, 60))) AS description
FROM r WHERE length(line) >= 21
""")
def fixed_width_parse(spark, sf):
    """Fixed-width order lines; short lines skipped; the flag must be 0/1 (any
    other value fails the job); a blank long text falls back to the short one."""
    o = Tables(spark, sf).orders
    line = (F.when((F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "P"), F.lit("HEADER"))
            .otherwise(F.concat(F.lpad(F.col("o_orderkey").cast("string"), 10, "0"), F.lit(" "),
                                F.upper(F.substring(F.md5(F.col("o_orderkey").cast("string")), 1, 7)), F.lit(" "),
                                F.when(F.col("o_orderstatus") == "O", "0").otherwise("1"), F.lit(" "),
                                F.rpad("o_orderpriority", 60, " "), F.lit(" "),
                                F.when(F.col("o_orderstatus") == "P", "").otherwise(
                                    F.concat_ws(" / ", "o_orderpriority", "o_orderstatus")))))
    staged = _stage(spark, o.select(line.alias("value")), "fixed_width")
    rows = TX.fixed_width(staged, FIXED_SPANS, min_len=MIN_LINE)
    flag = TX.strict_flag(F.col("flag"), "billable flag")
    short = F.trim("short")
    return rows.select(F.col("order_no").cast("bigint").alias("order_no"), F.trim("code").alias("code"),
                       flag.alias("is_billable"), short.alias("short_description"),
                       F.coalesce(F.when(F.trim("long") != "", F.trim("long")), short).alias("description"))


_CODE_RE = r"\d{2}(?:\.\d{1,2})?"


@query("code_title_lines", sql=f"""
WITH r AS (SELECT CASE WHEN p_size = 1 THEN 'PROCEDURES ' || p_type WHEN p_size = 2 THEN 'Note: see ' || p_name
                       ELSE (CASE WHEN length(CAST(p_partkey AS VARCHAR)) <= 2 THEN CAST(p_partkey AS VARCHAR)
                                  ELSE substr(CAST(p_partkey AS VARCHAR), 1, 2) || '.' || substr(CAST(p_partkey AS VARCHAR), 3) END)
                            || ' ' || p_name END AS line FROM part)
SELECT regexp_extract(line, '^\\s*({_CODE_RE})\\s+(\\S.*?)\\s*$', 1) AS code,
       regexp_extract(line, '^\\s*({_CODE_RE})\\s+(\\S.*?)\\s*$', 2) AS title
FROM r WHERE regexp_matches(line, '^\\s*({_CODE_RE})\\s+(\\S.*?)\\s*$')
""")
def code_title_lines(spark, sf):
    """``<code> <title>`` lines; banners and notes fail the code pattern."""
    p = Tables(spark, sf).part
    code = C.dotted(F.col("p_partkey").cast("string"), 2, upper=False)
    line = (F.when(F.col("p_size") == 1, F.concat(F.lit("PROCEDURES "), F.col("p_type")))
            .when(F.col("p_size") == 2, F.concat(F.lit("Note: see "), F.col("p_name")))
            .otherwise(F.concat(code, F.lit(" "), F.col("p_name"))))
    staged = _stage(spark, p.select(line.alias("value")), "titles")
    return TX.code_title(staged, _CODE_RE)


@query("carry_forward_header", sql="""
WITH s AS (SELECT *, SUM(CASE WHEN role = 'system' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS seg FROM conversations),
h AS (SELECT *, last_value(CASE WHEN role = 'assistant' THEN turn END IGNORE NULLS) OVER (PARTITION BY conv_id, seg ORDER BY turn
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS block_turn FROM s)
SELECT conv_id, turn, block_turn FROM h WHERE role = 'user'
""")
def carry_forward_header(spark, sf):
    """Each conversation is one file; assistant turns are block headers carried
    onto the following user lines, a system turn resets the block."""
    conv = Tables(spark, sf).conversations.select("conv_id", "turn", "role")
    out = TX.carry_forward(conv, ["conv_id"], "turn", F.col("role") == "assistant", F.col("role") == "system",
                           "block_turn")
    return out.filter(F.col("role") == "user").select("conv_id", "turn", "block_turn")
