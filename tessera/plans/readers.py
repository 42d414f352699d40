"""Reader plans: table rows are written in a source format to the shared folder and read back by
the reader under test (S1-S3, S8-S10, S13-S15, F4, P9, Q16, C1); SQL states what must come out."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators import catalog as CAT
from tessera.operators import conform as K
from tessera.plans.registry import query
from tessera.session import shared_path
from tessera.sources import delimited as DL
from tessera.sources import lake
from tessera.sources import text as TX
from tessera.sources import xml as XML
from tessera.sources.tables import Tables


def _csv(df, name, **options):
    """Write ``df`` as delimited files with a header and return their folder."""
    path = shared_path(df.sparkSession, name)
    df.write.options(header=True, **options).csv(path)
    return path


@query("tab_header_read", sql="""
SELECT s_suppkey::VARCHAR AS supplier_id, s_name AS label, '' AS absent FROM supplier
""")
def tab_header_read(spark, sf):
    """Tab-delimited, headers in any case, first present alias, padded values trimmed, a
    missing column as '', blank rows dropped."""
    s = Tables(spark, sf).supplier
    blank = s.select(F.lit("  ").alias("S_SuppKey"), F.lit("").alias("S_NAME"), F.lit(" ").alias("Note"))
    rows = s.select(F.concat(F.lit(" "), F.col("s_suppkey").cast("string"), F.lit(" ")).alias("S_SuppKey"), F.col("s_name").alias("S_NAME"),
                    F.lit("x").alias("Note")).unionByName(blank)
    path = _csv(rows, "tab", sep="\t", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, emptyValue="")
    return DL.read_header_delimited(spark, path, {"supplier_id": ("SUPPLIER", "s_suppkey"), "label": ("s_name",), "absent": ("OTHER",)})


@query("quoted_csv_read", sql="""
SELECT p_partkey::VARCHAR AS part_id, p_name || ', "' || p_brand || '"' AS title, CASE WHEN p_size < 10 THEN '' ELSE p_type END AS kind FROM part
""")
def quoted_csv_read(spark, sf):
    """Quoted CSV with a byte-order mark, upper-case header, commas and doubled quotes in values."""
    p = Tables(spark, sf).part
    rows = p.select(F.col("p_partkey").cast("string").alias("﻿PART_ID"),
                    F.concat("p_name", F.lit(', "'), "p_brand", F.lit('"')).alias("TITLE"),
                    F.when(F.col("p_size") < 10, "").otherwise(F.col("p_type")).alias("KIND"))
    path = _csv(rows, "quoted", quoteAll=True, escape='"')
    return DL.read_header_delimited(spark, path, {"part_id": ("part_id",), "title": ("Title",), "kind": ("kind",)}, sep=",", quoted=True)


@query("release_files_read", sql="""
SELECT c_custkey::VARCHAR AS concept_id, c_name AS term, (c_acctbal >= 0)::INTEGER::VARCHAR AS active, c_mktsegment AS acceptability FROM customer
""")
def release_files_read(spark, sf):
    """S3: three tab-delimited release files (concept, description, language) read and joined on their ids."""
    c = Tables(spark, sf).customer
    key = F.col("c_custkey").cast("string")
    files = {
        "concept": c.select(key.alias("id"), (F.col("c_acctbal") >= 0).cast("int").cast("string").alias("active")),
        "description": c.select(F.concat(F.lit("d"), key).alias("id"), key.alias("conceptId"), F.col("c_name").alias("term")),
        "language": c.select(F.concat(F.lit("d"), key).alias("referencedComponentId"), F.col("c_mktsegment").alias("acceptabilityId"))}
    read = lambda name, **f: DL.read_header_delimited(spark, _csv(files[name], name, sep="\t"), {k: (v,) for k, v in f.items()})
    out = (read("concept", concept_id="ID", active="ACTIVE").join(read("description", did="id", concept_id="conceptid", term="term"), "concept_id")
           .join(read("language", did="referencedcomponentid", acceptability="acceptabilityid"), "did"))
    return out.select("concept_id", "term", "active", "acceptability")


@query("xml_records_read", sql="""
SELECT n_nationkey::VARCHAR AS code, 'Zoné ' || n_name AS title, CASE WHEN n_regionkey = 0 THEN '' ELSE n_regionkey::VARCHAR END AS region FROM nation
""")
def xml_records_read(spark, sf):
    """Flat ISO-8859-1 XML records, trimmed, an empty element as ''."""
    n = Tables(spark, sf).nation
    path = shared_path(spark, "xml_records")
    n.select(F.concat(F.lit(" "), F.col("n_nationkey").cast("string"), F.lit(" ")).alias("code"), F.concat(F.lit("Zoné "), "n_name").alias("title"),
             F.when(F.col("n_regionkey") == 0, "").otherwise(F.col("n_regionkey").cast("string")).alias("region")).write.format("xml").options(
        rootTag="records", rowTag="record", encoding="ISO-8859-1", declaration='version="1.0" encoding="ISO-8859-1"').save(path)
    return XML.read_records(spark, path, "record").select("code", "title", "region")


@query("xml_tree_read", sql="""
WITH s AS (SELECT 'S' || s_suppkey AS code, s_nationkey, s_suppkey % 12 AS depth FROM supplier),
d AS (SELECT code || repeat('.x', i) AS code, CASE WHEN i = 0 THEN NULL ELSE code || repeat('.x', i - 1) END AS parent, s_nationkey
      FROM (SELECT *, unnest(range(0, depth + 1)) AS i FROM s) WHERE i > 0 OR true)
SELECT code, parent, r_name AS root, n_name AS "group", 'Region ' || r_name AS root_label, 'Nation ' || n_name AS group_label
FROM d JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""")
def xml_tree_read(spark, sf):
    """Nested XML of any depth -> (code, parent) pairs with chapter and block labels, range
    suffixes stripped; a node without a code is left out."""
    t = Tables(spark, sf)
    depth = F.col("s_suppkey") % 12
    code = F.concat(F.lit("S"), F.col("s_suppkey").cast("string"))
    names = F.transform(F.sequence(F.lit(0), depth.cast("int")), lambda i: F.concat(F.lit("<diag><name>"), code, F.repeat(F.lit(".x"), i), F.lit("</name>")))
    node = F.concat(F.array_join(names, ""), F.array_join(F.transform(names, lambda _: F.lit("</diag>")), ""))
    # documents of at most a thousand suppliers: they grow in number with the table, not in size
    blocks = (t.supplier.withColumns({"node": node, "cut": F.floor(F.col("s_suppkey") / 1000)})
              .join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
              .groupBy("r_name", "n_name", "cut").agg(F.array_join(F.array_sort(F.collect_list("node")), "").alias("nodes")))
    section = F.concat(F.lit('<section id="'), "n_name", F.lit('"><desc>Nation '), "n_name", F.lit(" (A00-B99)</desc><diag><name> </name></diag>"),
                       "nodes", F.lit("</section>"))
    path = shared_path(spark, "xml_tree")
    # a document is a file of its own: a reader goes up to the end of the file's first root element
    blocks.select("r_name", "n_name", "cut", F.concat(F.lit("<tabular><chapter><name>"), "r_name", F.lit("</name><desc>Region "), "r_name", F.lit(" (C7A)</desc>"),
                           section, F.lit("</chapter></tabular>")).alias("value")).write.partitionBy("r_name", "n_name", "cut").text(path)
    return XML.tree_pairs(spark, path, root_tag="chapter", group_tag="section", node_tag="diag", label_field="desc")


@query("wide_line_read", sql="""
WITH v AS (SELECT user_id, CAST(ts AS DATE) AS d, ROUND(SUM(value), 2) AS value FROM events GROUP BY 1, 2),
m AS (SELECT DISTINCT user_id, make_date(year(d), month(d), 1) AS m0 FROM v),
days AS (SELECT user_id, CAST(unnest(generate_series(m0, last_day(m0), INTERVAL 1 DAY)) AS DATE) AS obs_date FROM m)
SELECT 'cty' AS region_type, days.user_id::VARCHAR AS region_code, 'User, ' || days.user_id AS region_name, 'tavg' AS variable, obs_date, value
FROM days LEFT JOIN v ON v.user_id = days.user_id AND v.d = obs_date
""")
def wide_line_read(spark, sf):
    """Headerless lines of six keys and 31 days, quoted names with commas, sentinel for a
    missing day, blank cells past the month's end."""
    ev = Tables(spark, sf).events.select("user_id", F.to_date("ts").alias("d"), "value")
    month = ev.groupBy("user_id", F.year("d").alias("y"), F.month("d").alias("m")).agg(*[
        F.round(F.sum(F.when(F.dayofmonth("d") == i, F.col("value"))), 2).alias(f"d{i}") for i in range(1, 32)])
    last = F.dayofmonth(F.last_day(F.make_date("y", "m", F.lit(1))))
    cell = lambda i: F.when(F.lit(i) > last, "").otherwise(F.coalesce(F.col(f"d{i}").cast("string"), F.lit("-999.99")))
    user = F.col("user_id").cast("string")
    line = F.concat_ws(",", F.lit("cty"), user, F.concat(F.lit('"User, '), user, F.lit('"')), F.col("y").cast("string"), F.col("m").cast("string"),
                       F.lit("TAVG"), *[cell(i) for i in range(1, 32)])
    path = shared_path(spark, "wide_lines")
    TX.write_lines(month.select(line.alias("value")), path)
    return TX.wide_day_lines(TX.read_lines(spark, path))


@query("code_map_read", sql="""
SELECT CASE WHEN n_nationkey % 7 = 3 THEN n_nationkey || '999' ELSE lpad(n_nationkey::VARCHAR, 3, '0') END AS src, lpad(n_regionkey::VARCHAR, 2, '0') AS dst FROM nation
""")
def code_map_read(spark, sf):
    """A code map padded on both sides, over-wide codes whole, names ignored, blank sides dropped."""
    n = Tables(spark, sf).nation
    key = F.col("n_nationkey").cast("string")
    rows = n.select(F.when(F.col("n_nationkey") % 7 == 3, F.concat(key, F.lit("999"))).otherwise(key).alias("From"), F.col("n_regionkey").cast("string").alias("To"),
                    F.col("n_name").alias("Name"))
    rows = rows.unionByName(n.select(F.lit("").alias("From"), F.lit("9").alias("To"), F.col("n_name").alias("Name")))
    return DL.read_code_map(spark, _csv(rows, "code_map"), src="from", dst="to", src_width=3, dst_width=2)


@query("relationship_read", sql="""
SELECT vintage, CASE WHEN length(c_custkey::VARCHAR) <= 5 THEN lpad(c_custkey::VARCHAR, 5, '0') END AS zone, lpad(c_nationkey::VARCHAR, 3, '0') AS area
FROM customer, (VALUES ('comma'), ('pipe')) AS v(vintage)
""")
def relationship_read(spark, sf):
    """The delimiter is sniffed (comma, pipe) and each vintage names its columns differently.
    Every customer gives a row a vintage; an id past the format's five digits reads as NULL."""
    c = Tables(spark, sf).customer
    zone, area = F.col("c_custkey").cast("string"), F.col("c_nationkey").cast("string")
    headers = {",": ("ZONE5", "Area GEOID"), "|": ("zone5_20", "geoid_area_20")}
    out = None
    for sep, (a, b) in headers.items():
        path = _csv(c.select(zone.alias(a), area.alias(b)), "relation", sep=sep)
        picked = DL.pick_header(headers[sep], token=("area",), without=("zone",))
        part = DL.read_relationship(spark, path, {"zone": ("ZONE5", "ZONE5_20"), "area": (picked,)}, ["zone", "area"], {"zone": 5, "area": 3})
        part = part.select(F.lit("comma" if sep == "," else "pipe").alias("vintage"), "zone", "area")
        out = part if out is None else out.unionByName(part)
    return out


@query("typed_payload_read", sql="SELECT o_orderkey, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderstatus FROM orders")
def typed_payload_read(spark, sf):
    """A payload stored as text, re-read and cast column by column to the declared schema."""
    o = Tables(spark, sf).orders
    path = shared_path(spark, "payload")
    o.select("o_orderkey", "o_totalprice", F.to_date("o_orderdate").alias("o_orderdate"), "o_orderstatus").select(
        *[F.col(c).cast("string") for c in ("o_orderstatus", "o_orderdate", "o_totalprice", "o_orderkey")]).write.parquet(path)
    declared = T.StructType.fromDDL("o_orderkey long, o_totalprice double, o_orderdate date, o_orderstatus string")
    out = DL.read_cast(spark, path, declared)
    if problems := DL.schema_problems(out, declared):
        raise ValueError(f"payload does not match its schema: {problems}")
    return out


# Fixed value of this plan: a region code that moved, with the id that replaced it.
MOVED = {"01005": "99005"}


@query("region_conform", sql="""
WITH f AS (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'ste' ELSE 'cty' END AS kind,
                  lpad(c_nationkey::VARCHAR, 2, '0') AS st, lpad((c_custkey % 20)::VARCHAR, 3, '0') AS co FROM customer),
g AS (SELECT c_custkey, kind, CASE WHEN kind = 'ste' THEN st ELSE st || co END AS code, st, co FROM f)
SELECT c_custkey, kind, code, CASE WHEN kind = 'cty' AND code = '01005' THEN '99005'
       WHEN st::INTEGER >= 20 THEN NULL WHEN kind = 'ste' THEN lpad((st::INTEGER + 30)::VARCHAR, 2, '0')
       ELSE lpad((st::INTEGER + 30)::VARCHAR, 2, '0') || co END AS geoid FROM g
""")
def region_conform(spark, sf):
    """region codes to ids by a state map (read twice over, each code once) with county overrides;
    an unmapped state gives NULL."""
    t = Tables(spark, sf)
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    kind = F.when(F.col("c_custkey") % 3 == 0, "ste").otherwise("cty")
    code = F.when(kind == "ste", two(F.col("c_nationkey"))).otherwise(
        F.concat(two(F.col("c_nationkey")), F.lpad((F.col("c_custkey") % 20).cast("string"), 3, "0")))
    fact = t.customer.select("c_custkey", kind.alias("kind"), code.alias("code"))
    states = t.nation.where("n_nationkey < 20").select(two(F.col("n_nationkey")).alias("src"), two(F.col("n_nationkey") + 30).alias("dst"))
    return K.conform_region(fact, "kind", "code", states.unionAll(states), MOVED)


@query("dataset_register", sql="""
SELECT 'tpch_raw.orders' AS full_table_name, 'second' AS description, 'merge_upsert' AS update_semantics, count(*) AS row_count,
       CAST(max(o_orderdate) AS DATE) AS newest, count(*) - count(o_orderpriority) AS null_count FROM orders
UNION ALL SELECT 'tpch_raw.events', 'first', 'append_only', count(*), CAST(max(ts) AS DATE), count(*) - count(props) FROM events
""")
def dataset_register(spark, sf):
    """One metadata row per given table with its own row count, newest date and nulls of a column, each
    from one aggregate; a second registration updates the columns it lists and leaves the others."""
    t = Tables(spark, sf)
    path = shared_path(spark, "catalog")
    schema = CAT.layer_schema("tpch", "raw")

    def entry(name, when, nullable, **given):
        r = getattr(t, name).agg(F.count(F.lit(1)).alias("n"), F.max(F.to_date(when)).cast("string").alias("newest"),
                                 F.count_if(F.col(nullable).isNull()).alias("nulls")).first()
        return {"full_table_name": CAT.dotted_name(schema, name), "row_count": str(r.n), "newest": r.newest, "null_count": str(r.nulls), **given}

    orders = entry("orders", "o_orderdate", "o_orderpriority", description="first", update_semantics="merge_upsert")
    events = entry("events", "ts", "props", description="first", update_semantics="append_only")
    for given, columns in ((orders, [c for c in orders if c != "full_table_name"]),
                           (events, [c for c in events if c != "full_table_name"]),
                           ({"full_table_name": orders["full_table_name"], "description": "second"}, ["description"])):
        CAT.register_dataset(spark, path, given, columns, "2026-01-01")
    return lake.read_current(spark, path).select("full_table_name", "description", "update_semantics", F.col("row_count").cast("long").alias("row_count"),
                                                 F.col("newest").cast("date").alias("newest"), F.col("null_count").cast("long").alias("null_count"))
