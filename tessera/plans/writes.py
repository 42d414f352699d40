"""Table-write plans: each stages real tables in the shared folder, applies the
write semantics, and returns the table read back (U1-U12, R1, W9, P1)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators import dq
from tessera.operators import lineage as LN
from tessera.operators import merge as MG
from tessera.plans.registry import query
from tessera.session import shared_path
from tessera.sources import lake
from tessera.sources.history import HistoryTable
from tessera.sources.keyed import KeyedFiles
from tessera.sources.tables import Tables

ORDERS_V = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
                         T.StructField("o_orderstatus", T.StringType()), T.StructField("o_totalprice", T.DoubleType()),
                         T.StructField("vintage", T.IntegerType())])


def _orders_v(t):
    return t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                           F.year("o_orderdate").alias("vintage"))


def _vintaged_table(spark, sf, name):
    path = shared_path(spark, name)
    lake.write_partitioned(_orders_v(Tables(spark, sf)), path, "vintage")
    return path


_REPLACED_SQL = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS vintage
FROM orders WHERE year(o_orderdate) <> 1998
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1.0, 1998 FROM orders
WHERE year(o_orderdate) = 1998 AND o_orderstatus <> 'P'
"""


@query("vintage_replace", sql=_REPLACED_SQL)
def vintage_replace(spark, sf):
    """Replace the 1998 vintage (twice: the rerun is idempotent), every other
    vintage untouched; read back with the declared (typed) schema."""
    path = _vintaged_table(spark, sf, "orders_by_vintage")
    cur = lake.read_table(spark, path, ORDERS_V)
    frame = (cur.filter(F.col("vintage") == 1998).filter(F.col("o_orderstatus") != "P")
             .withColumn("o_totalprice", F.col("o_totalprice") + 1.0))
    staged = shared_path(spark, "vintage_1998")
    lake.full_refresh(frame, staged)  # materialise: the frame must not read the folder it replaces
    for _ in range(2):
        lake.replace_vintage(lake.read_table(spark, staged, ORDERS_V), path, "vintage", 1998)
    return lake.read_table(spark, path, ORDERS_V)


@query("vintage_select", sql="""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS vintage
FROM orders WHERE year(o_orderdate) = 1999
""")
def vintage_select(spark, sf):
    """Explicit vintage read — the equality on the partition column prunes
    every other vintage folder at planning time."""
    path = _vintaged_table(spark, sf, "orders_by_vintage")
    return lake.read_table(spark, path, ORDERS_V).filter(F.col("vintage") == 1999)


RELEASE_SCHEMA = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("vintage", T.IntegerType()),
                               T.StructField("release", T.StringType())])


@query("latest_vintage", sql="""
WITH t AS (SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS vintage,
                  '1.' || CAST(year(o_orderdate) - 1990 AS VARCHAR) AS release FROM orders)
SELECT * FROM t WHERE CAST(string_split(release, '.') AS INTEGER[]) =
                      (SELECT MAX(CAST(string_split(release, '.') AS INTEGER[])) FROM t)
""")
def latest_vintage(spark, sf):
    """U12/TR2/TR8: string releases ('1.5' .. '1.11') stored as a string partition
    column and read with the declared schema (inference would turn '1.10' into 1.1);
    the latest release is chosen on the numeric version key, not on text."""
    o = Tables(spark, sf).orders
    df = o.select("o_orderkey", F.year("o_orderdate").alias("vintage"),
                  F.concat(F.lit("1."), (F.year("o_orderdate") - 1990).cast("string")).alias("release"))
    path = shared_path(spark, "orders_by_release")
    lake.write_partitioned(df, path, "release")
    tbl = lake.read_table(spark, path, RELEASE_SCHEMA)
    latest = tbl.select("release").distinct().agg(F.max_by("release", MG.version_key(F.col("release")))).first()[0]
    return tbl.filter(F.col("release") == latest).select("o_orderkey", "vintage", "release")


DIM_SCHEMA = T.StructType([T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
                           T.StructField("geo_vintage", T.IntegerType())])


@query("vintage_safe_join", sql="""
WITH dim AS (SELECT c_custkey, c_name, 2000 AS geo_vintage FROM customer
             UNION ALL SELECT c_custkey, c_name || '-v2001', 2001 FROM customer),
f AS (SELECT o_orderkey, o_custkey, CASE WHEN year(o_orderdate) < 1999 THEN 2000 ELSE 2001 END AS geo_vintage FROM orders)
SELECT f.o_orderkey, f.geo_vintage, dim.c_name FROM f JOIN dim ON f.o_custkey = dim.c_custkey AND f.geo_vintage = dim.geo_vintage
""")
def vintage_safe_join(spark, sf):
    """The fact carries the dimension vintage and joins on (key, vintage); a
    key-only join against a two-vintage dimension would double every row."""
    t = Tables(spark, sf)
    c = t.customer.select("c_custkey", "c_name")
    dim = c.withColumn("geo_vintage", F.lit(2000)).unionByName(
        c.select("c_custkey", F.concat("c_name", F.lit("-v2001")).alias("c_name")).withColumn("geo_vintage", F.lit(2001)))
    path = shared_path(spark, "customer_by_vintage")
    lake.write_partitioned(dim, path, "geo_vintage")
    dim = lake.read_table(spark, path, DIM_SCHEMA)
    f = t.orders.select("o_orderkey", F.col("o_custkey").alias("c_custkey"),
                        F.when(F.year("o_orderdate") < 1999, 2000).otherwise(2001).alias("geo_vintage"))
    return f.join(dim, ["c_custkey", "geo_vintage"]).select("o_orderkey", "geo_vintage", "c_name")


_UPSERT_SRC_SQL = """
s AS (SELECT o_orderkey, 'F' AS o_orderstatus, o_totalprice + 1.0 AS o_totalprice FROM orders WHERE o_orderstatus = 'O'
      UNION ALL SELECT o_orderkey + 1000000000, 'N', o_totalprice FROM orders
      WHERE o_orderstatus = 'P' AND o_orderpriority = '5-LOW')
"""


def _upsert_source(o):
    upd = o.filter(F.col("o_orderstatus") == "O").select(
        "o_orderkey", F.lit("F").alias("o_orderstatus"), (F.col("o_totalprice") + 1.0).alias("o_totalprice"))
    ins = o.filter((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW")).select(
        (F.col("o_orderkey") + 1_000_000_000).alias("o_orderkey"), F.lit("N").alias("o_orderstatus"), "o_totalprice")
    return upd.unionByName(ins)


@query("upsert_merge", sql=f"""
WITH {_UPSERT_SRC_SQL}
SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s)
UNION ALL SELECT o_orderkey, o_orderstatus, o_totalprice FROM s
""")
def upsert_merge(spark, sf):
    """U4: MERGE on files: those that hold matched keys are written anew, all others stay as they
    are in the next version."""
    o = Tables(spark, sf).orders.select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    table = KeyedFiles(spark, shared_path(spark, "orders_upsert"), "o_orderkey long, o_orderstatus string, o_totalprice double", ["o_orderkey"])
    table.merge(o.drop("o_orderpriority"))
    table.merge(_upsert_source(o))
    return table.read()


STAMP = "2002-01-01"


@query("upsert_partial_columns", sql=f"""
WITH t AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, CAST(o_orderdate AS DATE) AS updated_at FROM orders),
s AS (SELECT o_orderkey, 'X' AS o_orderstatus FROM orders WHERE o_orderpriority = '1-URGENT'
      UNION ALL SELECT o_orderkey + 1000000000, 'N' FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '5-LOW')
SELECT COALESCE(t.o_orderkey, s.o_orderkey) AS o_orderkey, t.o_custkey,
       CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus,
       t.o_orderpriority,
       CASE WHEN s.o_orderkey IS NOT NULL THEN DATE '{STAMP}' ELSE t.updated_at END AS updated_at
FROM t FULL OUTER JOIN s ON t.o_orderkey = s.o_orderkey
""")
def upsert_partial_columns(spark, sf):
    """Only the listed column is upserted, the other columns of matched rows
    survive, inserted rows leave them NULL, the writer stamps touched rows."""
    o = Tables(spark, sf).orders
    target = o.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority",
                      F.to_date("o_orderdate").alias("updated_at"))
    src = o.filter(F.col("o_orderpriority") == "1-URGENT").select("o_orderkey", F.lit("X").alias("o_orderstatus")) \
           .unionByName(o.filter((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW")).select(
               (F.col("o_orderkey") + 1_000_000_000).alias("o_orderkey"), F.lit("N").alias("o_orderstatus")))
    table = KeyedFiles(spark, shared_path(spark, "orders_partial"), target.schema, ["o_orderkey"])
    table.merge(target)
    table.merge(src, lambda now, new: MG.upsert_columns(now, new.select("o_orderkey", "o_orderstatus"), ["o_orderkey"], ["o_orderstatus"],
                                                        "updated_at", F.lit(STAMP).cast("date"), check=False))
    return table.read()


def _daily(ev, status):
    return ev.groupBy("user_id", F.to_date("ts").alias("obs_date")).agg(
        F.round(F.sum("value"), 2).alias("total"), F.count(F.lit(1)).alias("n")).withColumn("status", F.lit(status))


@query("revision_absorb", sql="""
WITH d1 AS (SELECT user_id, CAST(ts AS DATE) AS obs_date, ROUND(SUM(value), 2) AS total, COUNT(*) AS n, 'scaled' AS status
            FROM events WHERE CAST(ts AS DATE) < DATE '2024-01-20' GROUP BY 1, 2),
d2 AS (SELECT user_id, CAST(ts AS DATE) AS obs_date, ROUND(SUM(value), 2) AS total, COUNT(*) AS n, 'prelim' AS status
       FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-20' AND value < 100 GROUP BY 1, 2),
d3 AS (SELECT user_id, CAST(ts AS DATE) AS obs_date, ROUND(SUM(value), 2) AS total, COUNT(*) AS n, 'scaled' AS status
       FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-20' GROUP BY 1, 2),
m1 AS (SELECT * FROM d1 ANTI JOIN d2 USING (user_id, obs_date) UNION ALL SELECT * FROM d2)
SELECT * FROM m1 ANTI JOIN d3 USING (user_id, obs_date) UNION ALL SELECT * FROM d3
""")
def revision_absorb(spark, sf):
    """Preliminary rows are overwritten by later final rows on the natural key,
    never duplicated (three loads, each an upsert onto the previous version)."""
    ev = Tables(spark, sf).events
    day = F.to_date("ts")
    loads = [_daily(ev.filter(day < F.lit("2024-01-20").cast("date")), "scaled"),
             _daily(ev.filter((day >= F.lit("2024-01-20").cast("date")) & (F.col("value") < 100)), "prelim"),
             _daily(ev.filter(day >= F.lit("2024-01-20").cast("date")), "scaled")]  # the final load covers every preliminary day
    table = KeyedFiles(spark, shared_path(spark, "daily_revisions"), loads[0].schema, ["obs_date", "user_id"])
    for load in loads:  # each load rewrites only the files that hold its keys
        table.merge(load)
    return table.read()


@query("overlay_update", sql="""
WITH b AS (SELECT p_partkey, p_name AS title, 'base' AS source FROM part),
u AS (SELECT p_partkey, upper(p_name) AS title, 'update' AS source FROM part WHERE p_size > 40
      UNION ALL SELECT p_partkey + 10000000, p_type, 'update' FROM part WHERE p_size = 50)
SELECT * FROM b WHERE p_partkey NOT IN (SELECT p_partkey FROM u) UNION ALL SELECT * FROM u
""")
def overlay_update(spark, sf):
    """Update wins per key (its label follows), base-only kept, update-only added."""
    p = Tables(spark, sf).part
    base = p.select("p_partkey", F.col("p_name").alias("title"), F.lit("base").alias("source"))
    upd = p.filter(F.col("p_size") > 40).select("p_partkey", F.upper("p_name").alias("title"), F.lit("update").alias("source")) \
           .unionByName(p.filter(F.col("p_size") == 50).select((F.col("p_partkey") + 10_000_000).alias("p_partkey"),
                                                                F.col("p_type").alias("title"), F.lit("update").alias("source")))
    # duplicates are counted on each side before the overlay can hide them
    MG.assert_unique_source(upd, ["p_partkey"])
    return MG.overlay(base, upd, ["p_partkey"])


_SCD2_SQL = """
s AS (SELECT o_custkey, o_orderpriority, CAST(o_orderdate AS DATE) AS d, o_orderkey,
             LAG(o_orderpriority) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS prev,
             ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders),
v AS (SELECT * FROM s WHERE rn = 1 OR prev IS DISTINCT FROM o_orderpriority),
h AS (SELECT o_custkey, o_orderpriority, d AS _effective_from,
             LEAD(d) OVER (PARTITION BY o_custkey ORDER BY d, o_orderkey) AS _effective_to,
             LEAD(d) OVER (PARTITION BY o_custkey ORDER BY d, o_orderkey) IS NULL AS _is_current,
             CASE WHEN rn = 1 THEN 'insert' ELSE 'update' END AS _change_type FROM v)
"""


def _history(spark, sf):
    o = Tables(spark, sf).orders.select("o_custkey", "o_orderpriority", "o_orderkey",
                                       F.to_date("o_orderdate").alias("d"), "o_orderdate")
    return MG.scd2(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], ["o_orderpriority"], "d")


@query("scd2_history", sql=f"WITH {_SCD2_SQL} SELECT * FROM h")
def scd2_history(spark, sf):
    """SCD2 versions from ordered snapshots (a new version only on change)."""
    return _history(spark, sf)


@query("asof_read", sql=f"""
WITH {_SCD2_SQL}
SELECT o_custkey, o_orderpriority, _effective_from FROM h
WHERE _effective_from <= DATE '1998-01-01' AND (_effective_to IS NULL OR _effective_to > DATE '1998-01-01')
""")
def asof_read(spark, sf):
    """The version valid at an instant, read from a stored history that two loads made."""
    o = Tables(spark, sf).orders.select("o_custkey", "o_orderpriority", "o_orderkey", F.to_date("o_orderdate").alias("d"), "o_orderdate")
    h = HistoryTable(spark, shared_path(spark, "priority_history"), "o_custkey long, o_orderpriority string", ["o_custkey"], ["o_orderpriority"])
    split = F.col("d") < F.lit("1997-01-01").cast("date")
    for load in (o.where(split), o.where(~split)):
        h.load(load, ["o_orderdate", "o_orderkey"], "d")
    return h.as_of("1998-01-01").select("o_custkey", "o_orderpriority", "_effective_from")


@query("gated_publish", sql="""
WITH a AS (SELECT (SELECT COUNT(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING COUNT(*) > 1)) AS dup,
                  (SELECT COUNT(*) FROM orders WHERE NOT (o_totalprice BETWEEN 0 AND 10000000)) AS bad, COUNT(*) AS n FROM orders),
b AS (SELECT (SELECT COUNT(*) FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1)) AS dup,
             COUNT(*) AS n FROM lineitem),
r AS (SELECT 'orders' AS run, 'unique_key' AS check_name, dup = 0 AS passed, dup AS failing, n AS total FROM a
      UNION ALL SELECT 'orders', 'range_totalprice', bad = 0, bad, n FROM a
      UNION ALL SELECT 'lineitem', 'unique_key', dup = 0, dup, n FROM b),
g AS (SELECT run, BOOL_AND(passed) AS published FROM r GROUP BY run)
SELECT r.run, r.check_name, r.passed, CAST(r.failing AS BIGINT) AS failing, CAST(r.total AS BIGINT) AS total, g.published,
       CAST(CASE WHEN g.published THEN r.total ELSE 0 END AS BIGINT) AS n_published
FROM r JOIN g ON r.run = g.run
""")
def gated_publish(spark, sf):
    """Stage -> validate -> publish only without a blocking failure; the DQ
    rows are appended to the log either way; the log is what is returned."""
    from tessera.plans.publish import publish
    t = Tables(spark, sf)
    root = shared_path(spark, "publish")
    log = f"{root}/dq_log"
    runs = {
        "orders": (t.orders.select("o_orderkey", "o_custkey", "o_totalprice"),
                   lambda df: dq.union_results([
                       dq.unique(df, ["o_orderkey"], table_name="orders", check_name="unique_key"),
                       dq.row_checks(df, "orders", [dq.in_range("o_totalprice", 0, 10_000_000, "range_totalprice")])])),
        "lineitem": (t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity"),
                     lambda df: dq.unique(df, ["l_orderkey", "l_linenumber"], table_name="lineitem", check_name="unique_key")),
    }
    for run, (frame, checks) in runs.items():
        publish(spark, frame, checks, published=f"{root}/published/{run}",
                dq_log=log, run_id=run, raise_on_block=False)
    logged = spark.read.parquet(log)
    status = logged.groupBy("run_id").agg(F.min(F.col("passed").cast("int")).alias("__ok"))
    counts = []
    for run in runs:
        ok = status.filter(F.col("run_id") == run).first()["__ok"] == 1
        pub = lake.read_current(spark, f"{root}/published/{run}")
        n = pub.count() if (ok and pub is not None) else 0
        counts.append((run, ok, n))
    pub = spark.createDataFrame(counts, "run_id string, published boolean, n_published bigint")
    j = logged.join(pub, "run_id")
    return j.select(F.col("run_id").alias("run"), "check_name", "passed", "failing", "total", "published", "n_published")


def _print_sql(*cols: str) -> str:
    """The row print of text columns in SQL."""
    said = " || ".join(f"coalesce(length({c}) || ':' || {c}, 'n')" for c in cols)
    return f"CAST(SUM(CAST('0x' || substr(md5({said}), 1, 15) AS HUGEINT)) AS VARCHAR)"


_FP_COLS = ("CAST(o_orderkey AS VARCHAR)", "CAST(o_custkey AS VARCHAR)", "o_orderstatus", "CAST({cents} AS VARCHAR)",
            "strftime(o_orderdate, '%Y-%m-%d')", "o_orderpriority")


def _fp_sql(cents: str) -> str:
    return (f"SELECT CAST(year(o_orderdate) AS INTEGER) AS vintage, COUNT(*) AS n_rows, "
            f"{_print_sql(*[c.format(cents=cents) for c in _FP_COLS])} AS fp FROM orders GROUP BY 1")


@query("content_fingerprint", sql=f"""
WITH cur AS ({_fp_sql("CAST(ROUND(o_totalprice * 100) AS BIGINT)")}),
prev AS ({_fp_sql("CAST(ROUND(o_totalprice * 100) AS BIGINT) + CASE WHEN year(o_orderdate) = 1998 THEN 100 ELSE 0 END")})
SELECT cur.vintage, cur.n_rows, cur.fp AS fingerprint, cur.fp = prev.fp AS unchanged FROM cur JOIN prev ON cur.vintage = prev.vintage
""")
def content_fingerprint(spark, sf):
    """Order-free fingerprint per vintage (sum of null-safe row prints), stored by each build; the second
    build compares its own with what the first (whose prices differed in 1998) has stored."""
    o = Tables(spark, sf).orders
    yr = F.year("o_orderdate")

    def prints(cents):
        cols = [F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"), F.col("o_orderstatus"), cents.cast("string"),
                F.date_format("o_orderdate", "yyyy-MM-dd"), F.col("o_orderpriority")]
        return o.groupBy(yr.cast("int").alias("vintage")).agg(*LN.content_print(o, cols))

    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    path = shared_path(spark, "vintage_prints")
    lake.full_refresh(prints(cents + F.when(yr == 1998, 100).otherwise(0)), f"{path}/build-1")
    lake.full_refresh(prints(cents), f"{path}/build-2")
    last = spark.read.parquet(f"{path}/build-1").select("vintage", F.col("print").alias("last"))
    return spark.read.parquet(f"{path}/build-2").join(last, "vintage").select(
        "vintage", "n_rows", F.col("print").alias("fingerprint"), (F.col("print") == F.col("last")).alias("unchanged"))


@query("transitive_skip", sql="""
WITH b(name, n_rows) AS (
  SELECT 'customer_year', (SELECT COUNT(*) FROM (SELECT DISTINCT o_custkey, year(o_orderdate) FROM orders))
  UNION ALL SELECT 'year_total', (SELECT COUNT(DISTINCT year(o_orderdate)) FROM orders)
  UNION ALL SELECT 'part_lines', (SELECT COUNT(DISTINCT l_partkey) FROM lineitem)
  UNION ALL SELECT 'year_part', (SELECT COUNT(DISTINCT year(o_orderdate)) FROM orders) + (SELECT COUNT(DISTINCT l_partkey) FROM lineitem))
SELECT CAST(r.run AS INTEGER) AS run, b.name, r.run = 1 OR (r.run = 3 AND b.name <> 'part_lines') OR (r.run = 4 AND b.name = 'year_part') AS made, b.n_rows
FROM b, (VALUES (1), (2), (3), (4)) r(run)
""")
def transitive_skip(spark, sf):
    """Builds in a chain and beside it. All are made at first, none when nothing changes, what lies
    downstream of orders when a price there changes, and one when its own recipe changes."""
    t = Tables(spark, sf)
    orders = t.orders.select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("year"), "o_totalprice")
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    total = F.sum("o_totalprice").alias("o_totalprice")
    kinds = lambda y, p: y.select(F.col("year").alias("k")).unionAll(p.select("l_partkey"))

    def graph(recipe):
        return LN.BuildGraph(spark, base, [
            LN.Build("year_part", ("year_total", "part_lines"), kinds, recipe),
            LN.Build("year_total", ("customer_year",), lambda c: c.groupBy("year").agg(total)),
            LN.Build("customer_year", ("orders",), lambda o: o.groupBy("o_custkey", "year").agg(total)),
            LN.Build("part_lines", ("lineitem",), lambda x: x.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n")))])

    base, out = shared_path(spark, "builds_graph"), None
    changed = orders.withColumn("o_totalprice", F.col("o_totalprice") + 1)
    for run, (o, recipe) in enumerate(((orders, "1"), (orders.repartition(3), "1"), (changed, "1"), (changed, "2")), 1):
        g = graph(recipe)
        for name, made in g.refresh({"orders": o, "lineitem": lines}).items():
            row = g.table(name).agg(F.lit(run).alias("run"), F.lit(name).alias("name"), F.lit(made).alias("made"), F.count(F.lit(1)).alias("n_rows"))
            out = row if out is None else out.unionAll(row)
    return out


@query("sorted_write", sql="SELECT COUNT(*) AS n_rows, CAST(0 AS BIGINT) AS n_unsorted FROM orders")
def sorted_write(spark, sf):
    """O1: orders written sorted by date and key; read back, no row stands before its predecessor in
    its file."""
    path = shared_path(spark, "sorted_orders")
    lake.write_sorted(Tables(spark, sf).orders, path, ["o_orderdate", "o_orderkey"])
    back = spark.read.parquet(path).select("o_orderdate", "o_orderkey", "_metadata.file_path", "_metadata.row_index")
    at = Window.partitionBy("file_path").orderBy("row_index")
    key = F.struct("o_orderdate", "o_orderkey")
    back = back.withColumn("back", F.coalesce(F.lag(key).over(at) > key, F.lit(False)))
    return back.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("back").cast("long")).alias("n_unsorted"))


@query("snapshot_once", sql="SELECT p_partkey, p_retailprice AS price, '2026-01' AS snapshot FROM part")
def snapshot_once(spark, sf):
    """U8: a second write of a snapshot that exists changes nothing."""
    p = Tables(spark, sf).part.select("p_partkey", F.col("p_retailprice").alias("price"), F.lit("2026-01").alias("snapshot"))
    path = shared_path(spark, "snapshots")
    wrote = [lake.write_snapshot_once(df, path, "snapshot", "2026-01") for df in (p, p.withColumn("price", F.lit(0.0)))]
    if wrote != [True, False]:
        raise RuntimeError(f"snapshot writes: {wrote}")
    return lake.read_table(spark, path, p.schema)


@query("unchanged_skip", sql="""
SELECT CAST(u.build AS INTEGER) AS build, u.published, COUNT(*) AS n_rows FROM orders, (VALUES (1, true), (2, false), (3, true)) u(build, published)
GROUP BY 1, 2
""")
def unchanged_skip(spark, sf):
    """The signature of each publish is stored; an equal second build writes nothing, a changed
    third one does."""
    o = Tables(spark, sf).orders.select("o_orderkey", "o_totalprice")
    base = shared_path(spark, "builds")
    signature = [F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("o_orderkey", "o_totalprice").cast("decimal(38,0)")).alias("print")]
    out = []
    for build, df in ((1, o), (2, o.repartition(3)), (3, o.withColumn("o_totalprice", F.col("o_totalprice") + 1))):
        published = lake.write_if_changed(df, base, signature)
        out.append(lake.read_current(spark, base).agg(F.lit(build).alias("build"), F.lit(published).alias("published"), F.count(F.lit(1)).alias("n_rows")))
    return out[0].unionAll(out[1]).unionAll(out[2])
