"""Scoping, reconciliation, overlap primaries, crosswalks and dedupe plans."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tessera.operators import aggregates as A
from tessera.operators import catalog as CAT
from tessera.operators import crosswalk as XW
from tessera.operators import dq
from tessera.operators import joins as J
from tessera.operators import reconcile as R
from tessera.operators import windows as W
from tessera.plans.registry import query
from tessera.plans.sqlshapes import dq_row
from tessera.session import shared_path
from tessera.sources import lake
from tessera.sources.tables import Tables


# ------------------------------------------------------------------ J6, Q10

@query("universe_scope", sql="""
WITH u AS (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'),
k AS (SELECT COUNT(*) AS n FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM u)),
d AS (SELECT COUNT(*) AS n FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM u))
SELECT k.n + d.n AS n_raw, k.n AS n_kept, d.n AS n_dropped, ROUND(d.n / (k.n + d.n), 6) AS drop_rate,
       d.n / (k.n + d.n) <= 0.05 AS passed
FROM k, d
""")
def universe_scope(spark, sf):
    """Left-semi scoping to the parent universe, dropped rows counted by
    left-anti, drop rate against a threshold."""
    t = Tables(spark, sf)
    universe = t.orders.filter(F.col("o_orderstatus") == "F")
    # the counts need one pass: a marker join instead of a semi and an anti scan
    s = J.scope_counts(t.lineitem, universe, ["l_orderkey"], ["o_orderkey"])
    raw = F.col("n_kept") + F.col("n_dropped")
    return s.select(raw.alias("n_raw"), "n_kept", "n_dropped", F.round(F.col("n_dropped") / raw, 6).alias("drop_rate"),
                    (F.col("n_dropped") / raw <= 0.05).alias("passed"))


# ------------------------------------------------------------------ J11

@query("xwalk_scope", sql="""
WITH x AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem),
u AS (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0),
a AS (SELECT COUNT(*) AS t, SUM(CASE WHEN u.s_suppkey IS NULL THEN 1 ELSE 0 END) AS f FROM x LEFT JOIN u ON x.l_suppkey = u.s_suppkey)
""" + dq_row("xwalk_part_supplier", "xwalk_in_universe", "referential", "warn", failing="f", total="t", source="a",
             details="json_object('gap_rows', CAST(f AS BIGINT))"))
def xwalk_scope(spark, sf):
    """The inner join narrows the crosswalk to the known universe; the gap is
    recorded as a WARN result instead of failing the build."""
    t = Tables(spark, sf)
    x = t.lineitem.select("l_partkey", "l_suppkey").distinct()
    u = t.supplier.filter(F.col("s_acctbal") > 0).select(F.col("s_suppkey").alias("__u")).withColumn("__in", F.lit(True))
    j = x.join(u, F.col("l_suppkey") == F.col("__u"), "left")
    one = j.agg(F.count(F.lit(1)).alias("t"), F.sum(F.when(F.col("__in").isNull(), 1).otherwise(0)).alias("f"))
    return dq.result(one, table_name="xwalk_part_supplier", check_name="xwalk_in_universe", category="referential",
                     severity="warn", failing=F.coalesce(F.col("f"), F.lit(0)), total=F.col("t"),
                     details={"gap_rows": F.col("f").cast("bigint")})


# ------------------------------------------------------------------ J9

@query("match_rate", sql="""
SELECT COUNT(*) AS n_total,
       CAST(SUM(CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') THEN 1 ELSE 0 END) AS BIGINT) AS n_matched,
       ROUND(SUM(CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') THEN 1 ELSE 0 END) / COUNT(*), 6) AS match_rate
FROM customer
""")
def match_rate(spark, sf):
    """Semi-join match rate of customers against urgent orders."""
    t = Tables(spark, sf)
    urgent = t.orders.filter(F.col("o_orderpriority") == "1-URGENT").select(F.col("o_custkey").alias("c_custkey"))
    matched = t.customer.join(urgent, "c_custkey", "left_semi")
    s = A.combine_scalars(t.customer.agg(F.count(F.lit(1)).alias("n_total")),
                          matched.agg(F.count(F.lit(1)).alias("n_matched")))
    return s.select("n_total", "n_matched", F.round(F.col("n_matched") / F.col("n_total"), 6).alias("match_rate"))


# ------------------------------------------------------------------ R3

@query("stale_keys", sql="""
SELECT DISTINCT o_orderkey FROM orders
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_shipdate >= TIMESTAMP '1996-01-01')
""")
def stale_keys(spark, sf):
    """Order keys in the table that this run (lineitems shipped since 1996) did not produce."""
    t = Tables(spark, sf)
    produced = t.lineitem.filter(F.col("l_shipdate") >= F.lit("1996-01-01").cast("timestamp_ntz")) \
                         .select(F.col("l_orderkey").alias("o_orderkey"))
    return R.stale_keys(t.orders, produced, ["o_orderkey"])


# ------------------------------------------------------------------ R2

@query("set_reconcile", sql="""
WITH a AS (SELECT DISTINCT o_custkey AS c_custkey FROM orders),
b AS (SELECT DISTINCT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
SELECT c_custkey, 'only_ordering' AS side FROM a WHERE c_custkey NOT IN (SELECT c_custkey FROM b)
UNION ALL
SELECT c_custkey, 'only_building' FROM b WHERE c_custkey NOT IN (SELECT c_custkey FROM a)
""")
def set_reconcile(spark, sf):
    """R2: symmetric difference of two key sets, both sides listed."""
    t = Tables(spark, sf)
    a = t.orders.select(F.col("o_custkey").alias("c_custkey"))
    b = t.customer.filter(F.col("c_mktsegment") == "BUILDING").select("c_custkey")
    return R.symmetric_difference(a, b, ["c_custkey"], "only_ordering", "only_building")


# ------------------------------------------------------------------ R4

@query("declared_vs_actual", sql="""
WITH d AS (SELECT c_nationkey, list_sort(list_distinct(list(c_mktsegment))) AS dl FROM customer WHERE c_acctbal > 9000 GROUP BY 1),
a AS (SELECT c_nationkey, list_sort(list_distinct(list(c_mktsegment))) AS al FROM customer WHERE c_acctbal < 0 GROUP BY 1)
SELECT d.c_nationkey,
       array_to_string(list_sort(list_filter(d.dl, lambda x: NOT list_contains(COALESCE(a.al, []), x))), '>') AS missing,
       array_to_string(list_sort(list_filter(COALESCE(a.al, []), lambda x: NOT list_contains(d.dl, x))), '>') AS extra
FROM d LEFT JOIN a ON d.c_nationkey = a.c_nationkey
""")
def declared_vs_actual(spark, sf):
    """Per nation, the segments declared (rich customers) vs actually present
    (overdrawn customers): missing and extra, undeclared nations ignored."""
    c = Tables(spark, sf).customer
    declared = c.filter(F.col("c_acctbal") > 9000).select("c_nationkey", "c_mktsegment")
    actual = c.filter(F.col("c_acctbal") < 0).select("c_nationkey", "c_mktsegment")
    return R.declared_vs_actual(declared, actual, "c_nationkey", "c_mktsegment")


# ------------------------------------------------------------------ R8

@query("vintage_parity", sql="""
WITH a AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS vintage, COUNT(*) AS n_orders FROM orders GROUP BY 1),
b AS (SELECT CAST(year(o.o_orderdate) AS INTEGER) AS vintage, COUNT(*) AS n_line_orders
      FROM (SELECT DISTINCT l_orderkey FROM lineitem) l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1),
dup AS (SELECT vintage, COUNT(*) AS n_dup_keys FROM (
          SELECT CAST(year(o.o_orderdate) AS INTEGER) AS vintage, l.l_orderkey, l.l_linenumber
          FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
          GROUP BY 1, 2, 3 HAVING COUNT(*) > 1) GROUP BY vintage)
SELECT COALESCE(a.vintage, b.vintage) AS vintage, COALESCE(a.n_orders, 0) AS n_orders,
       COALESCE(b.n_line_orders, 0) AS n_line_orders, COALESCE(a.n_orders, 0) - COALESCE(b.n_line_orders, 0) AS diff,
       COALESCE(dup.n_dup_keys, 0) AS n_dup_keys
FROM a FULL OUTER JOIN b ON a.vintage = b.vintage LEFT JOIN dup ON COALESCE(a.vintage, b.vintage) = dup.vintage
""")
def vintage_parity(spark, sf):
    """Per-vintage row counts of two layers (orders vs orders seen in lineitem)
    plus the number of duplicated natural keys per vintage."""
    t = Tables(spark, sf)
    o = t.orders.select("o_orderkey", F.year("o_orderdate").alias("vintage"))
    lo = t.lineitem.select("l_orderkey").distinct().join(o, F.col("l_orderkey") == F.col("o_orderkey")).select("vintage")
    par = R.count_parity(o, lo, "vintage", "n_orders", "n_line_orders")
    # duplicated keys are found on the fact alone (partial-aggregated), only they meet orders
    dup_keys = t.lineitem.groupBy("l_orderkey", "l_linenumber").count().filter(F.col("count") > 1)
    dups = (dup_keys.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
            .groupBy("vintage").agg(F.count(F.lit(1)).alias("n_dup_keys")))
    out = par.join(dups, "vintage", "left")
    return out.select("vintage", "n_orders", "n_line_orders", "diff", F.coalesce("n_dup_keys", F.lit(0)).alias("n_dup_keys"))


# ------------------------------------------------------------------ W1, A6, M1, W2

_PAIRS_SQL = "SELECT l_partkey, l_suppkey, SUM(l_quantity) AS overlap FROM lineitem GROUP BY 1, 2"


def _pairs(t):
    """Part-supplier overlap, materialised once in the shared checkpoint folder: it
    feeds several branches (winner, totals, join-back), and re-deriving it would
    re-scan and re-aggregate the fact table per branch."""
    return t.lineitem.groupBy("l_partkey", "l_suppkey").agg(F.sum("l_quantity").alias("overlap")).checkpoint()


@query("primary_by_overlap", sql=f"""
WITH p AS ({_PAIRS_SQL}),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_partkey ORDER BY overlap DESC NULLS LAST, l_suppkey) AS rn,
             SUM(overlap) OVER (PARTITION BY l_partkey) AS total,
             COUNT(DISTINCT l_suppkey) OVER (PARTITION BY l_partkey) AS n_suppliers FROM p)
SELECT l_partkey, l_suppkey AS primary_suppkey, overlap,
       CASE WHEN total > 0 THEN ROUND(overlap / total, 6) END AS fraction, CAST(n_suppliers AS INTEGER) AS n_suppliers,
       n_suppliers > 1 AS spans
FROM r WHERE rn = 1
""")
def primary_by_overlap(spark, sf):
    """The largest-overlap partner per unit (overlap desc nulls last, id
    asc), its fraction of the unit's total (only when total > 0), partner count,
    and whether the unit spans more than one partner."""
    pairs = Tables(spark, sf).lineitem.groupBy("l_partkey", "l_suppkey").agg(F.sum("l_quantity").alias("overlap"))
    # one aggregate per unit: winner (min over the ordering struct), total, partner count
    order = W.desc_nulls_last(F.col("overlap")) + [F.col("l_suppkey")]
    st = F.struct(*[o.alias(f"__o{i}") for i, o in enumerate(order)], F.col("l_suppkey"), F.col("overlap"))
    g = pairs.groupBy("l_partkey").agg(F.min(st).alias("__w"), F.sum("overlap").alias("__total"),
                                       F.count_distinct("l_suppkey").cast("int").alias("n_suppliers"))
    return g.select("l_partkey", F.col("__w.l_suppkey").alias("primary_suppkey"), F.col("__w.overlap").alias("overlap"),
                    dq.safe_rate(F.col("__w.overlap"), F.col("__total")).alias("fraction"), "n_suppliers",
                    (F.col("n_suppliers") > 1).alias("spans"))


@query("primary_flag_bridge", sql=f"""
WITH p AS ({_PAIRS_SQL})
SELECT l_partkey, l_suppkey, overlap,
       ROW_NUMBER() OVER (PARTITION BY l_partkey ORDER BY overlap DESC NULLS LAST, l_suppkey) = 1 AS is_primary
FROM p
""")
def primary_flag_bridge(spark, sf):
    """Every candidate pair kept, the winner flagged (ranked after scoping)."""
    pairs = _pairs(Tables(spark, sf))
    return W.flag_first(pairs, ["l_partkey"], W.desc_nulls_last(F.col("overlap")) + [F.col("l_suppkey")],
                        ["l_suppkey"], "is_primary")


# ------------------------------------------------------------------ J10, S22

@query("bridge_view", sql=f"""
WITH p AS ({_PAIRS_SQL}),
b AS (SELECT l_partkey, l_suppkey FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_partkey ORDER BY overlap DESC NULLS LAST, l_suppkey) AS rn FROM p) WHERE rn = 1)
SELECT pt.p_partkey, pt.p_name, s.s_suppkey, s.s_name
FROM part pt JOIN b ON pt.p_partkey = b.l_partkey JOIN supplier s ON b.l_suppkey = s.s_suppkey
""")
def bridge_view(spark, sf):
    """A persistent join view over part -> primary bridge -> supplier, made when all three
    tables are in the catalog, and read from another session. The bridge reaches its table through a temp view of this run."""
    t = Tables(spark, sf)
    pairs = _pairs(t)
    bridge = W.keep_one(pairs, ["l_partkey"], W.desc_nulls_last(F.col("overlap")) + [F.col("l_suppkey")], ["l_suppkey"])
    run = f"v{uuid.uuid4().hex[:8]}"  # the catalog is shared by all runs
    staged = CAT.safe_view_name(run, "ref.bridge-of-this-run")
    bridge.createOrReplaceTempView(staged)
    tables = {"part": t.part, "supplier": t.supplier, "bridge": spark.table(staged)}
    names = {k: CAT.safe_view_name(run, f"ref.{k}") for k in tables}
    view = CAT.safe_view_name(run, "ref.part_primary_supplier")
    select = f"""SELECT pt.p_partkey, pt.p_name, s.s_suppkey, s.s_name
        FROM {names['part']} pt JOIN {names['bridge']} b ON pt.p_partkey = b.l_partkey
        JOIN {names['supplier']} s ON b.l_suppkey = s.s_suppkey"""
    for k, df in tables.items():
        if CAT.create_join_view(spark, view, tuple(names.values()), select):
            raise RuntimeError("the view was made before its parents")
        CAT.save_table(df, names[k], shared_path(spark, f"catalog-{k}"))
    spark.catalog.dropTempView(staged)
    if not CAT.create_join_view(spark, view, tuple(names.values()), select):
        raise RuntimeError("bridge view parents missing")
    return spark.newSession().table(view)


# ------------------------------------------------------------------ J12

@query("boundary_split", sql=f"""
WITH p AS ({_PAIRS_SQL}),
b AS (SELECT l_partkey, l_suppkey FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_partkey ORDER BY overlap DESC NULLS LAST, l_suppkey) AS rn FROM p) WHERE rn = 1),
e AS (SELECT pt.p_partkey, b.l_suppkey AS resolved_suppkey FROM part pt LEFT JOIN b ON pt.p_partkey = b.l_partkey)
SELECT e.p_partkey, e.resolved_suppkey, upper(hex(encode(s.s_name))) AS geom_hex, CAST(octet_length(encode(s.s_name)) AS INTEGER) AS geom_bytes
FROM e JOIN supplier s ON e.resolved_suppkey = s.s_suppkey
WHERE e.resolved_suppkey IS NOT NULL
""")
def boundary_split(spark, sf):
    """Boundary rows only for entities whose id resolved (NULLs excluded); the
    binary payload is carried, never computed on."""
    t = Tables(spark, sf)
    pairs = _pairs(t)
    bridge = W.keep_one(pairs, ["l_partkey"], W.desc_nulls_last(F.col("overlap")) + [F.col("l_suppkey")], ["l_suppkey"])
    entity = J.enrich(t.part.select("p_partkey"), bridge.withColumnRenamed("l_suppkey", "resolved_suppkey"),
                      ["p_partkey"], ["l_partkey"], ["resolved_suppkey"])
    geometry = t.supplier.select("s_suppkey", F.encode("s_name", "UTF-8").alias("geom"))
    b = entity.filter(F.col("resolved_suppkey").isNotNull()).join(
        geometry, F.col("resolved_suppkey") == F.col("s_suppkey"))
    return b.select("p_partkey", "resolved_suppkey", F.hex("geom").alias("geom_hex"),
                    F.octet_length("geom").cast("int").alias("geom_bytes"))


# ------------------------------------------------------------------ X3, A5, K1-K3

_WEIGHT_KINDS = ("wt_qty", "wt_price", "wt_disc")


def _wide_weights(t):
    li = t.lineitem
    pairs = li.groupBy("l_partkey", "l_suppkey").agg(
        F.sum("l_quantity").alias("q"), F.sum("l_extendedprice").alias("p"),
        F.sum(F.col("l_quantity") * F.col("l_discount")).alias("d")).checkpoint()  # two consumers below
    tot = pairs.groupBy(F.col("l_partkey").alias("__p")).agg(F.sum("q").alias("tq"), F.sum("p").alias("tp"),
                                                          F.sum("d").alias("td"))
    j = pairs.join(tot, F.col("l_partkey") == F.col("__p"))
    nan = F.lit(float("nan"))
    return j.select(F.col("l_partkey").alias("source_id"), F.col("l_suppkey").alias("target_id"),
                    F.when(F.col("tq") > 0, F.col("q") / F.col("tq")).alias("WT_QTY"),
                    F.when(F.col("tp") > 0, F.col("p") / F.col("tp")).otherwise(nan).alias("wt_price"),
                    F.when(F.col("td") > 0, F.col("d") / F.col("td")).otherwise(nan).alias("wt_disc"))


_WIDE_SQL = """
WITH pairs AS (SELECT l_partkey, l_suppkey, SUM(l_quantity) AS q, SUM(l_extendedprice) AS p, SUM(l_quantity * l_discount) AS d
               FROM lineitem GROUP BY 1, 2),
tot AS (SELECT l_partkey, SUM(q) AS tq, SUM(p) AS tp, SUM(d) AS td FROM pairs GROUP BY 1),
wide AS (SELECT pairs.l_partkey AS source_id, l_suppkey AS target_id,
                CASE WHEN tq > 0 THEN q / tq END AS wt_qty,
                CASE WHEN tp > 0 THEN p / tp ELSE 'NaN'::DOUBLE END AS wt_price,
                CASE WHEN td > 0 THEN d / td ELSE 'NaN'::DOUBLE END AS wt_disc
         FROM pairs JOIN tot ON pairs.l_partkey = tot.l_partkey),
xw AS (SELECT source_id, target_id, weight_kind, weight FROM wide
       UNPIVOT (weight FOR weight_kind IN (wt_qty, wt_price, wt_disc)) WHERE weight IS NOT NULL AND NOT isnan(weight))
"""


def _xw(t):
    return XW.unpivot_weights(_wide_weights(t), ["source_id", "target_id"], _WEIGHT_KINDS)


def _stored_slice(spark, t, kind):
    """K1: the crosswalk is stored by weight kind; a slice reads that kind's files only."""
    xw, path = _xw(t), shared_path(spark, "crosswalk")
    lake.write_partitioned(xw, path, "weight_kind")
    return XW.select_slice(lake.read_table(spark, path, xw.schema), weight_kind=kind)


@query("crosswalk_unpivot", sql=_WIDE_SQL + "SELECT source_id, target_id, weight_kind, ROUND(weight, 9) AS weight FROM xw")
def crosswalk_unpivot(spark, sf):
    """Weight columns (matched case-insensitively) -> one row per kind; NULL/NaN skipped."""
    xw = _xw(Tables(spark, sf))
    return xw.select("source_id", "target_id", "weight_kind", F.round("weight", 9).alias("weight"))


@query("crosswalk_weight_sum", sql=_WIDE_SQL + """,
per AS (SELECT source_id, weight_kind, ABS(SUM(weight) - 1) > 0.001 AS bad FROM xw GROUP BY 1, 2)
SELECT weight_kind, COUNT(*) AS n_sources, CAST(SUM(CASE WHEN bad THEN 1 ELSE 0 END) AS BIGINT) AS n_bad,
       (SELECT string_agg(CAST(s AS VARCHAR), '>' ORDER BY s) FROM (SELECT source_id AS s FROM per p2 WHERE p2.bad AND p2.weight_kind = per.weight_kind ORDER BY s LIMIT 10)) AS bad_sample
FROM per GROUP BY weight_kind
""")
def crosswalk_weight_sum(spark, sf):
    """A5/K3: weights of every source sum to 1 (tolerance 1e-3), per kind."""
    return XW.weight_sums(_xw(Tables(spark, sf)), "source_id", _WEIGHT_KINDS)


@query("crosswalk_apply", sql=_WIDE_SQL + """
SELECT xw.target_id, ROUND(SUM(p.p_retailprice * xw.weight), 4) AS allocated
FROM part p JOIN xw ON p.p_partkey = xw.source_id WHERE xw.weight_kind = 'wt_qty' GROUP BY xw.target_id
""")
def crosswalk_apply(spark, sf):
    """K1/K2: pick the quantity slice, allocate each part's price to its suppliers."""
    t = Tables(spark, sf)
    sl = _stored_slice(spark, t, "wt_qty")
    a = XW.allocate(t.part, "p_partkey", "p_retailprice", sl, "source_id", "target_id")
    return a.select("target_id", F.round("allocated", 4).alias("allocated"))


@query("crosswalk_compose", sql=_WIDE_SQL + """,
s2n AS (SELECT s_suppkey AS target_id, CAST(s_nationkey AS BIGINT) AS nation_id, 1.0 AS weight FROM supplier),
comp AS (SELECT xw.source_id, s2n.nation_id, SUM(xw.weight * s2n.weight) AS weight
         FROM xw JOIN s2n ON xw.target_id = s2n.target_id WHERE xw.weight_kind = 'wt_qty' GROUP BY 1, 2)
SELECT comp.nation_id, ROUND(SUM(p.p_retailprice * comp.weight), 4) AS allocated
FROM part p JOIN comp ON p.p_partkey = comp.source_id GROUP BY comp.nation_id
""")
def crosswalk_compose(spark, sf):
    """K2: compose part->supplier (quantity) with supplier->nation, then allocate."""
    t = Tables(spark, sf)
    first = _stored_slice(spark, t, "wt_qty")
    second = t.supplier.select(F.col("s_suppkey").alias("target_id"), F.col("s_nationkey").cast("bigint").alias("nation_id"),
                               F.lit(1.0).alias("weight"))
    comp = XW.compose(first, second, "source_id", "target_id", "nation_id")
    a = XW.allocate(t.part, "p_partkey", "p_retailprice", comp, "source_id", "nation_id")
    return a.select("nation_id", F.round("allocated", 4).alias("allocated"))


# ------------------------------------------------------------------ W4, W5

_LI_ORDER = ("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
             "l_linestatus", "l_shipdate")
_LI_OUT = ("l_orderkey", "l_linenumber") + _LI_ORDER


def _li_norm(t):
    li = t.lineitem
    # -0.0 and 0.0 compare equal; normalise the sign so the kept value is canonical
    return li.withColumn("l_discount", F.col("l_discount") + 0.0).withColumn("l_tax", F.col("l_tax") + 0.0)


_ORDER_SQL = ", ".join(_LI_ORDER)
_SEL_SQL = ", ".join(c if c not in ("l_discount", "l_tax") else f"{c} + 0.0 AS {c}" for c in _LI_OUT)


@query("dedupe_first", sql=f"""
SELECT {", ".join(_LI_OUT)}, n_dropped FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_ORDER_SQL}) AS rn,
         COUNT(*) OVER (PARTITION BY l_orderkey, l_linenumber) - 1 AS n_dropped
  FROM (SELECT {_SEL_SQL} FROM lineitem)) WHERE rn = 1
""")
def dedupe_first(spark, sf):
    """Keep the first row per natural key by an explicit order, with the count dropped."""
    li = _li_norm(Tables(spark, sf))
    return W.keep_one_with_dropped(li, ["l_orderkey", "l_linenumber"], [F.col(c) for c in _LI_ORDER], list(_LI_ORDER))


@query("dedupe_latest", sql=f"""
SELECT {", ".join(_LI_OUT)} FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC NULLS LAST, {_ORDER_SQL}) AS rn
  FROM (SELECT {_SEL_SQL} FROM lineitem)) WHERE rn = 1
""")
def dedupe_latest(spark, sf):
    """Keep the latest date per key (NULL dates sort last), ties keep the earlier row."""
    li = _li_norm(Tables(spark, sf))
    return W.keep_one(li, ["l_orderkey", "l_linenumber"],
                      W.desc_nulls_last(F.col("l_shipdate"), "ts") + [F.col(c) for c in _LI_ORDER], list(_LI_ORDER))
