"""Data-quality plans over the driver tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators import dq
from tessera.plans.facts import EVENT_TYPES
from tessera.plans.registry import query
from tessera.plans.sqlshapes import dq_row, row_check_sql
from tessera.sources.tables import Tables

_EV_VOCAB_SQL = ", ".join(f"'{t}'" for t in EVENT_TYPES)


@query("dq_unique", sql="WITH g AS (SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY 1, 2), "
       "a AS (SELECT SUM(CASE WHEN n > 1 THEN 1 ELSE 0 END) AS d, SUM(n) AS t FROM g) "
       + dq_row("lineitem", "unique_order_line", "uniqueness", "fail", failing="d", total="t", source="a",
                details="json_object('duplicate_key_groups', CAST(d AS BIGINT), 'keys', ['l_orderkey', 'l_linenumber'])"))
def dq_unique(spark, sf):
    """A2/Q2: natural-key uniqueness; failing = duplicated key groups."""
    li = Tables(spark, sf).lineitem
    return dq.unique(li, ["l_orderkey", "l_linenumber"], table_name="lineitem", check_name="unique_order_line")


_ORDER_COLS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")


@query("dq_not_null", sql=row_check_sql("orders", "orders", [
    ("not_null_all", "nullability", "fail", " OR ".join(f"{c} IS NULL" for c in _ORDER_COLS)),
    ("not_null_key", "nullability", "fail", "o_orderkey IS NULL")]))
def dq_not_null(spark, sf):
    """A3/Q2: null checks of one table fused into one aggregate pass."""
    o = Tables(spark, sf).orders
    return dq.row_checks(o, "orders", [dq.not_null(_ORDER_COLS, "not_null_all"), dq.not_null(["o_orderkey"], "not_null_key")])


@query("dq_range", sql=row_check_sql("lineitem", "lineitem", [
    ("range_l_quantity", "range", "fail", "l_quantity IS NOT NULL AND NOT (l_quantity BETWEEN 1 AND 50)"),
    ("range_l_discount", "range", "fail", "l_discount IS NOT NULL AND NOT (l_discount BETWEEN 0 AND 0.1)"),
    ("range_l_tax", "range", "warn", "l_tax IS NOT NULL AND NOT (l_tax BETWEEN 0 AND 0.05)"),
    ("range_l_extendedprice", "range", "fail", "l_extendedprice IS NOT NULL AND NOT (l_extendedprice BETWEEN 1 AND 100000)")]))
def dq_range(spark, sf):
    """One range predicate per variable, all in one pass."""
    li = Tables(spark, sf).lineitem
    return dq.row_checks(li, "lineitem", [
        dq.in_range("l_quantity", 1, 50), dq.in_range("l_discount", 0, 0.1),
        dq.in_range("l_tax", 0, 0.05, severity="warn"), dq.in_range("l_extendedprice", 1, 100000)])


@query("dq_vocab", sql="SELECT * FROM (" + row_check_sql("lineitem", "lineitem", [
    ("vocab_l_returnflag", "business_rule", "fail", "l_returnflag IS NULL OR l_returnflag NOT IN ('A', 'N', 'R')"),
    ("vocab_l_linestatus", "business_rule", "fail", "l_linestatus IS NULL OR l_linestatus NOT IN ('F')")])
    + ") UNION ALL SELECT * FROM (" + row_check_sql("events", "events", [
    ("vocab_event_type", "business_rule", "fail", f"event_type IS NULL OR event_type NOT IN ({_EV_VOCAB_SQL})")]) + ")")
def dq_vocab(spark, sf):
    """Q3: vocabulary membership (the line-status vocabulary here is deliberately
    narrower than the data, so that check reports failures)."""
    t = Tables(spark, sf)
    a = dq.row_checks(t.lineitem, "lineitem", [dq.in_vocab("l_returnflag", ["A", "N", "R"]),
                                               dq.in_vocab("l_linestatus", ["F"])])
    b = dq.row_checks(t.events, "events", [dq.in_vocab("event_type", EVENT_TYPES)])
    return a.unionByName(b)


@query("dq_fk", sql="WITH p AS (SELECT DISTINCT c_custkey AS pk FROM customer WHERE c_mktsegment = 'BUILDING'), "
       "j AS (SELECT o.o_custkey, p.pk FROM orders o LEFT JOIN p ON o.o_custkey = p.pk), "
       "a AS (SELECT SUM(CASE WHEN pk IS NULL THEN 1 ELSE 0 END) AS f, COUNT(*) AS t, "
       "COUNT(DISTINCT CASE WHEN pk IS NULL THEN o_custkey END) AS k FROM j) "
       + dq_row("orders", "fk_building_customer", "referential", "fail", failing="f", total="t", source="a",
                details="json_object('orphan_key_values', CAST(k AS BIGINT))"))
def dq_fk(spark, sf):
    """Orders whose customer is not in the (filtered) parent universe.
    Rate = orphan rows / rows."""
    t = Tables(spark, sf)
    parent = t.customer.filter(F.col("c_mktsegment") == "BUILDING")
    return dq.foreign_key(t.orders, "o_custkey", parent, "c_custkey", table_name="orders",
                          check_name="fk_building_customer")


@query("dq_fk_composite", sql="""
WITH c AS (SELECT l_orderkey AS k, CAST(year(l_shipdate) AS INTEGER) AS v FROM lineitem),
p AS (SELECT DISTINCT o_orderkey AS k, CAST(year(o_orderdate) AS INTEGER) AS v FROM orders),
cov AS (SELECT * FROM c WHERE v IN (SELECT DISTINCT v FROM p)),
a AS (SELECT SUM(CASE WHEN p.k IS NULL THEN 1 ELSE 0 END) AS f, COUNT(*) AS t FROM cov LEFT JOIN p ON cov.k = p.k AND cov.v = p.v)
""" + dq_row("lineitem", "fk_order_same_vintage", "referential", "warn", failing="f", total="t", source="a",
             details="json_object('orphan_rows', CAST(f AS BIGINT))"))
def dq_fk_composite(spark, sf):
    """Composite (key, vintage) anti-join, restricted to vintages the parent covers."""
    t = Tables(spark, sf)
    child = t.lineitem.select(F.col("l_orderkey").alias("k"), F.year("l_shipdate").alias("v"))
    parent = t.orders.select(F.col("o_orderkey").alias("pk"), F.year("o_orderdate").alias("pv")).distinct()
    covered = parent.select(F.col("pv").alias("cv")).distinct()
    scoped = child.join(covered, F.col("v") == F.col("cv"), "left_semi")
    j = scoped.join(parent.withColumn("__hit", F.lit(True)),
                    (F.col("k") == F.col("pk")) & (F.col("v") == F.col("pv")), "left")
    one = j.agg(F.sum(F.when(F.col("__hit").isNull(), 1).otherwise(0)).alias("f"), F.count(F.lit(1)).alias("t"))
    return dq.result(one, table_name="lineitem", check_name="fk_order_same_vintage", category="referential",
                     severity="warn", failing=F.coalesce(F.col("f"), F.lit(0)), total=F.col("t"),
                     details={"orphan_rows": F.col("f").cast("bigint")})


_CARD = (("orders", 1000, 10_000_000), ("lineitem", 5000, 100_000_000), ("customer", 100, 20_000))


@query("dq_cardinality", sql=" UNION ALL ".join(
    dq_row(tb, f"rowcount_{tb}", "cardinality", "warn",
           failing=f"CASE WHEN n BETWEEN {lo} AND {hi} THEN 0 ELSE n END", total="n",
           passed=f"(n BETWEEN {lo} AND {hi})", source=f"(SELECT COUNT(*) AS n FROM {tb})",
           details=f"json_object('actual', n, 'expected_max', CAST({hi} AS BIGINT), 'expected_min', CAST({lo} AS BIGINT))")
    for tb, lo, hi in _CARD))
def dq_cardinality(spark, sf):
    """Q2: row count inside a declared band, one result per table."""
    t = Tables(spark, sf)
    return dq.union_results([dq.cardinality(getattr(t, tb), table_name=tb, check_name=f"rowcount_{tb}",
                                            min_rows=lo, max_rows=hi) for tb, lo, hi in _CARD])


@query("dq_rowcount_parity", sql=dq_row(
    "orders", "parity_orders_vs_lineitem_orders", "referential", "fail",
    failing="abs(a - b)", total="a", passed="(a = b)",
    source="(SELECT (SELECT COUNT(*) FROM orders) AS a, (SELECT COUNT(DISTINCT l_orderkey) FROM lineitem) AS b)",
    details="json_object('actual', a, 'other', 'lineitem.l_orderkey', 'other_rows', b)"))
def dq_rowcount_parity(spark, sf):
    """Each side with its own filter/projection."""
    t = Tables(spark, sf)
    return dq.rowcount_equals(t.orders, t.lineitem.select("l_orderkey").distinct(), table_name="orders",
                              other_name="lineitem.l_orderkey", check_name="parity_orders_vs_lineitem_orders")


@query("dq_required_fields", sql="""
SELECT conv_id, turn, field FROM (
  SELECT conv_id, turn, 'role' AS field, role AS v FROM conversations
  UNION ALL SELECT conv_id, turn, 'text', text FROM conversations
  UNION ALL SELECT conv_id, turn, 'text_words', regexp_replace(text, '[^A-Za-z]', '', 'g') FROM conversations
  UNION ALL SELECT conv_id, turn, 'text_figures', regexp_replace(text, '[^0-9]', '', 'g') FROM conversations
) s WHERE v IS NULL OR trim(v) = ''
""")
def dq_required_fields(spark, sf):
    """Q6: one row per (key, field) whose required value is blank."""
    c = Tables(spark, sf).conversations
    long = c.select("conv_id", "turn", F.col("role"), F.col("text"),
                    F.regexp_replace("text", "[^A-Za-z]", "").alias("text_words"),
                    F.regexp_replace("text", "[^0-9]", "").alias("text_figures"))  # few texts hold a figure
    long = long.unpivot(["conv_id", "turn"], ["role", "text", "text_words", "text_figures"], "field", "v")
    return long.filter(F.col("v").isNull() | (F.trim("v") == "")).select("conv_id", "turn", "field")


@query("dq_exactly_one", sql="""
SELECT p.conv_id, CAST(COUNT(c.turn) AS BIGINT) AS n_system
FROM (SELECT DISTINCT conv_id FROM conversations) p
LEFT JOIN (SELECT conv_id, turn FROM conversations WHERE role = 'system') c ON p.conv_id = c.conv_id
GROUP BY p.conv_id HAVING COUNT(c.turn) <> 1
""")
def dq_exactly_one(spark, sf):
    """Q7: parents whose number of children of one kind is not exactly one."""
    c = Tables(spark, sf).conversations
    per = c.groupBy("conv_id").agg(F.sum(F.when(F.col("role") == "system", 1).otherwise(0)).cast("bigint").alias("n_system"))
    return per.filter(F.col("n_system") != 1)


_NULL_RATE_COLS = {"lineitem": ("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate"),
                   "events": ("event_id", "ts", "user_id", "event_type", "value", "props")}


@query("dq_null_rate", sql=" UNION ALL ".join(
    f"SELECT '{tb}' AS table_name, '{c}' AS column_name, ROUND(AVG(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END), 6) AS null_rate, COUNT(*) AS total FROM {tb}"
    for tb, cols in _NULL_RATE_COLS.items() for c in cols))
def dq_null_rate(spark, sf):
    """Q9: null rate of every listed column, one aggregate pass per table."""
    t = Tables(spark, sf)
    parts = []
    for tb, cols in _NULL_RATE_COLS.items():
        one = getattr(t, tb).agg(F.count(F.lit(1)).alias("total"), *[
            F.round(F.avg(F.when(F.col(c).isNull(), 1.0).otherwise(0.0)), 6).alias(c) for c in cols])
        parts.append(one.unpivot(["total"], list(cols), "column_name", "null_rate")
                     .select(F.lit(tb).alias("table_name"), "column_name", "null_rate", "total"))
    return parts[0].unionByName(parts[1])


@query("dq_date_order", sql="""
WITH j AS (SELECT l.l_shipdate, o.o_orderdate FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
mx AS (SELECT MAX(o_orderdate) AS as_of FROM orders),
a AS (SELECT COUNT(*) AS n,
             SUM(CASE WHEN l_shipdate < o_orderdate THEN 1 ELSE 0 END) AS f0,
             SUM(CASE WHEN l_shipdate > (SELECT as_of FROM mx) THEN 1 ELSE 0 END) AS f1 FROM j)
""" + dq_row("lineitem", "ship_before_order", "business_rule", "warn", failing="f0", total="n", source="a",
             details="json_object('failing_rows', CAST(f0 AS BIGINT))")
    + " UNION ALL " + dq_row("lineitem", "ship_after_as_of", "business_rule", "warn", failing="f1", total="n", source="a",
                             details="json_object('failing_rows', CAST(f1 AS BIGINT))"))
def dq_date_order(spark, sf):
    """End-before-start and future-date predicates (as-of = latest order date)."""
    t = Tables(spark, sf)
    as_of = t.orders.agg(F.max("o_orderdate")).first()[0]  # one scalar
    j = t.lineitem.select("l_orderkey", "l_shipdate").join(
        t.orders.select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
    return dq.row_checks(j, "lineitem", [
        dq.RowCheck("ship_before_order", "business_rule", F.col("l_shipdate") < F.col("o_orderdate"), "warn"),
        dq.RowCheck("ship_after_as_of", "business_rule", F.col("l_shipdate") > F.lit(as_of), "warn")])


@query("dq_cross_column", sql="""
WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, MIN(value) AS vmin, ROUND(AVG(value), 6) AS vavg, MAX(value) AS vmax
           FROM events GROUP BY 1, 2)
""" + row_check_sql("events_daily", "d", [
    ("min_le_avg_le_max", "business_rule", "fail", "NOT (vmin <= vavg AND vavg <= vmax)"),
    ("spread_le_500", "range", "warn", "vmax - vmin > 500")]).replace("WITH a AS", ", a AS", 1))
def dq_cross_column(spark, sf):
    """Q14: tmin <= tavg <= tmax on the daily wide fact."""
    ev = Tables(spark, sf).events
    d = ev.groupBy("user_id", F.to_date("ts").alias("day")).agg(
        F.min("value").alias("vmin"), F.round(F.avg("value"), 6).alias("vavg"), F.max("value").alias("vmax"))
    return dq.row_checks(d, "events_daily", [
        dq.RowCheck("min_le_avg_le_max", "business_rule",
                    ~((F.col("vmin") <= F.col("vavg")) & (F.col("vavg") <= F.col("vmax")))),
        dq.RowCheck("spread_le_500", "range", (F.col("vmax") - F.col("vmin")) > 500, "warn")])


@query("dq_map_consistency", sql="""
WITH m AS (SELECT o_orderkey AS src, o_orderstatus AS src_status, o_custkey AS tgt FROM orders),
a AS (SELECT COUNT(*) AS n,
             SUM(CASE WHEN src_status <> 'F' THEN 1 ELSE 0 END) AS f0,
             SUM(CASE WHEN c.c_custkey IS NULL THEN 1 ELSE 0 END) AS f1
      FROM m LEFT JOIN (SELECT DISTINCT c_custkey FROM customer WHERE c_mktsegment <> 'AUTOMOBILE') c ON m.tgt = c.c_custkey)
""" + dq_row("orders", "map_source_retired", "business_rule", "warn", failing="f0", total="n", source="a",
             details="json_object('failing_rows', CAST(f0 AS BIGINT))")
    + " UNION ALL " + dq_row("orders", "map_target_exists", "referential", "fail", failing="f1", total="n",
                             source="a", details="json_object('failing_rows', CAST(f1 AS BIGINT))"))
def dq_map_consistency(spark, sf):
    """Q8: a mapped source must be retired; its target must exist (in the active universe)."""
    t = Tables(spark, sf)
    m = t.orders.select(F.col("o_orderkey").alias("src"), F.col("o_orderstatus").alias("src_status"),
                        F.col("o_custkey").alias("tgt"))
    tg = (t.customer.filter(F.col("c_mktsegment") != "AUTOMOBILE").select(F.col("c_custkey").alias("__t"))
          .distinct().withColumn("__hit", F.lit(True)))
    j = m.join(tg, F.col("tgt") == F.col("__t"), "left")
    return dq.row_checks(j, "orders", [
        dq.RowCheck("map_source_retired", "business_rule", F.col("src_status") != "F", "warn"),
        dq.RowCheck("map_target_exists", "referential", F.col("__hit").isNull())])


@query("dq_freshness", sql="""
WITH l AS (SELECT event_type, MAX(ts) AS last_ts FROM events GROUP BY event_type),
m AS (SELECT MAX(ts) AS now_ts FROM events)
SELECT event_type, last_ts, ROUND(epoch_us(now_ts - last_ts) / 3600000000.0, 3) AS hours_since,
       epoch_us(now_ts - last_ts) > 24 * 3600000000 AS stale
FROM l, m
""")
def dq_freshness(spark, sf):
    """Q11: hours since the last row of each kind, relative to the newest row; SLA 24h."""
    ev = Tables(spark, sf).events
    last = ev.groupBy("event_type").agg(F.max("ts").alias("last_ts"))
    # one row per event type (a closed vocabulary): a global window is bounded
    last = last.withColumn("__now", F.max("last_ts").over(Window.partitionBy()))
    lag_us = F.timestamp_diff("MICROSECOND", F.col("last_ts"), F.col("__now"))
    return last.select("event_type", "last_ts", F.round(lag_us / 3600000000.0, 3).alias("hours_since"),
                       (lag_us > 24 * 3600000000).alias("stale"))


@query("quarantine_split", sql="""
SELECT event_id,
       CASE WHEN value > 400 THEN 'value_out_of_range'
            WHEN c.c_custkey IS NULL THEN 'unknown_user'
            WHEN try_cast(json_extract_string(props, '$.k') AS INTEGER) IS NULL THEN 'bad_props' END AS reason,
       (value > 400 OR c.c_custkey IS NULL OR try_cast(json_extract_string(props, '$.k') AS INTEGER) IS NULL) AS quarantined
FROM events e LEFT JOIN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'AUTOMOBILE') c ON e.user_id = c.c_custkey
""")
def quarantine_split(spark, sf):
    """Q12: one tagged pass; ``operators.quarantine`` turns it into the two
    writes (clean rows, quarantined rows with reason)."""
    from tessera.operators.quarantine import tag_reasons
    t = Tables(spark, sf)
    known = t.customer.filter(F.col("c_mktsegment") != "AUTOMOBILE").select(F.col("c_custkey").alias("__ck")).withColumn("__known", F.lit(True))
    ev = t.events.join(known, F.col("user_id") == F.col("__ck"), "left")
    tagged = tag_reasons(ev, [
        ("value_out_of_range", F.col("value") > 400),
        ("unknown_user", F.col("__known").isNull()),
        ("bad_props", F.get_json_object("props", "$.k").try_cast("int").isNull()),
    ])
    return tagged.select("event_id", "reason", "quarantined")
