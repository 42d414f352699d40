"""Fact-table plans: daily wide facts, reshapes, level labels, coverage (weather-like)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.functions import dates as D
from tessera.operators import joins as J
from tessera.operators import reshape as X
from tessera.plans.registry import query
from tessera.sources.tables import Tables

# The closed vocabulary of event types in the events fact.
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


def _type_cols_sql(expr: str = "value", agg: str = "MAX") -> str:
    return ", ".join(f"{agg}(CASE WHEN event_type = '{t}' THEN {expr} END) AS {t}" for t in EVENT_TYPES)


# ---------------------------------------------------------------- flagship

@query("weather_like_daily", sql=f"""
WITH daily AS (
  SELECT user_id, CAST(ts AS DATE) AS obs_date, {_type_cols_sql()},
         MAX(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) = 1 AS has_error,
         COUNT(*) AS n_events
  FROM events
  WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2025-01-01'
  GROUP BY user_id, CAST(ts AS DATE)
), lab AS (
  SELECT d.*, d.obs_date - CAST(dayofweek(d.obs_date) AS INTEGER) + 3 AS wed
  FROM daily d
)
SELECT l.user_id, l.obs_date, {", ".join("l." + t for t in EVENT_TYPES)}, l.has_error, l.n_events,
       CAST(year(l.wed) AS INTEGER) AS epi_year,
       CAST((dayofyear(l.wed) - 1) // 7 + 1 AS INTEGER) AS epi_week,
       c.c_name, n.n_name
FROM lab l
LEFT JOIN customer c ON l.user_id = c.c_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
""")
def weather_like_daily(spark, sf):
    """Long events -> wide daily fact per (user, day) within a year window, with
    epi-week labels and parent labels (customer -> nation)."""
    t = Tables(spark, sf)
    ev = t.events.filter(D.half_open_year_range("ts", 2024, 2024))
    daily = X.long_to_wide(
        ev.withColumn("obs_date", F.to_date("ts")), ["user_id", "obs_date"], "event_type", "value",
        EVENT_TYPES,
        extra_aggs=[X.any_flag(F.col("event_type") == "error", "has_error"),
                    F.count(F.lit(1)).alias("n_events")])
    daily = daily.withColumn("epi_year", D.epi_year("obs_date")).withColumn("epi_week", D.epi_week("obs_date"))
    out = J.enrich(daily, t.customer, ["user_id"], ["c_custkey"], ["c_name", "c_nationkey"])
    out = J.enrich(out, t.nation, ["c_nationkey"], ["n_nationkey"], ["n_name"])
    return out.drop("c_nationkey")


@query("long_to_wide_pivot", sql=f"""
WITH long AS (
  SELECT user_id, CAST(ts AS DATE) AS obs_date, event_type, ROUND(SUM(value), 2) AS value
  FROM events GROUP BY user_id, CAST(ts AS DATE), event_type
)
SELECT user_id, obs_date, {_type_cols_sql()},
       MAX(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) = 1 AS has_purchase
FROM long GROUP BY user_id, obs_date
""")
def long_to_wide_pivot(spark, sf):
    """Long (user, day, type) totals to one wide row per (user, day) with an any-flag."""
    ev = Tables(spark, sf).events
    long = (ev.groupBy("user_id", F.to_date("ts").alias("obs_date"), "event_type")
              .agg(F.round(F.sum("value"), 2).alias("value")))
    return X.long_to_wide(long, ["user_id", "obs_date"], "event_type", "value", EVENT_TYPES,
                          extra_aggs=[X.any_flag(F.col("event_type") == "purchase", "has_purchase")])


@query("level_switch_labels", sql="""
WITH f AS (
  SELECT 'customer' AS geo_level, o_custkey AS geo_key, ROUND(SUM(o_totalprice), 2) AS total_price
  FROM orders GROUP BY o_custkey
  UNION ALL
  SELECT 'nation', CAST(c.c_nationkey AS BIGINT), ROUND(SUM(o.o_totalprice), 2)
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY c.c_nationkey
)
SELECT f.geo_level, f.geo_key, f.total_price, COALESCE(c.c_name, n.n_name) AS label
FROM f
LEFT JOIN customer c ON f.geo_level = 'customer' AND f.geo_key = c.c_custkey
LEFT JOIN nation n ON f.geo_level = 'nation' AND f.geo_key = n.n_nationkey
""")
def level_switch_labels(spark, sf):
    """A two-level fact (customer, nation); each row joins only its own level's dimension."""
    t = Tables(spark, sf)
    # aggregate the fact per customer first; the nation level is rolled up from that
    # (one row per customer), so the big fact never meets the customer table
    per_cust = t.orders.groupBy(F.col("o_custkey").alias("geo_key")).agg(F.sum("o_totalprice").alias("__s"))
    by_cust = per_cust.select("geo_key", F.round("__s", 2).alias("total_price"), F.lit("customer").alias("geo_level"))
    by_nation = (per_cust.join(t.customer.select("c_custkey", "c_nationkey"), F.col("geo_key") == F.col("c_custkey"))
                 .groupBy(F.col("c_nationkey").cast("bigint").alias("geo_key"))
                 .agg(F.round(F.sum("__s"), 2).alias("total_price"))
                 .withColumn("geo_level", F.lit("nation")))
    fact = by_cust.unionByName(by_nation)
    return J.level_switch_labels(fact, "geo_level", "geo_key", {
        "customer": (t.customer, "c_custkey", "c_name"),
        "nation": (t.nation, "n_nationkey", "n_name"),
    }).select("geo_level", "geo_key", "total_price", "label")


@query("wide_to_long_sentinel", sql="""
WITH m AS (
  SELECT DISTINCT l_suppkey, make_date(year(l_shipdate), month(l_shipdate), 1) AS m0 FROM lineitem
), days AS (
  SELECT l_suppkey, CAST(unnest(generate_series(m0, last_day(m0), INTERVAL 1 DAY)) AS DATE) AS obs_date FROM m
), v AS (
  SELECT l_suppkey, CAST(l_shipdate AS DATE) AS obs_date, SUM(l_quantity) AS value
  FROM lineitem GROUP BY l_suppkey, CAST(l_shipdate AS DATE)
)
SELECT d.l_suppkey, d.obs_date, v.value
FROM days d LEFT JOIN v ON d.l_suppkey = v.l_suppkey AND d.obs_date = v.obs_date
""")
def wide_to_long_sentinel(spark, sf):
    """Build the 31-day wide monthly row per supplier (missing day = sentinel), then
    turn it back into long rows: days beyond month end dropped, sentinel -> NULL."""
    li = Tables(spark, sf).lineitem.select("l_suppkey", F.to_date("l_shipdate").alias("d"), "l_quantity")
    sentinel = -999.99
    wide = li.groupBy("l_suppkey", F.year("d").alias("yr"), F.month("d").alias("mo")).agg(*[
        F.coalesce(F.sum(F.when(F.dayofmonth("d") == i, F.col("l_quantity"))), F.lit(sentinel)).alias(f"d{i}")
        for i in range(1, 32)])
    return X.wide_days_to_long(wide, ["l_suppkey"], "yr", "mo", [f"d{i}" for i in range(1, 32)],
                               is_sentinel=lambda v: v <= -999)


# Order status code -> label.
STATUS_LABELS = {"F": "fulfilled", "O": "open", "P": "partial"}


@query("map_case_projection", sql="""
SELECT o_orderkey, o_orderstatus,
       CASE o_orderstatus WHEN 'F' THEN 'fulfilled' WHEN 'O' THEN 'open' WHEN 'P' THEN 'partial' END AS status_label,
       CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority_rank
FROM orders
""")
def map_case_projection(spark, sf):
    """A constant code -> label map applied as one map-literal lookup."""
    o = Tables(spark, sf).orders
    m = F.create_map(*[F.lit(x) for kv in STATUS_LABELS.items() for x in kv])
    return o.select("o_orderkey", "o_orderstatus", m[F.col("o_orderstatus")].alias("status_label"),
                    F.substring("o_orderpriority", 1, 1).cast("int").alias("priority_rank"))


@query("temporal_coverage", sql="""
SELECT 'orders' AS table_name, CAST(MIN(o_orderdate) AS DATE) AS min_date, CAST(MAX(o_orderdate) AS DATE) AS max_date, COUNT(*) AS n_rows FROM orders
UNION ALL SELECT 'lineitem', CAST(MIN(l_shipdate) AS DATE), CAST(MAX(l_shipdate) AS DATE), COUNT(*) FROM lineitem
UNION ALL SELECT 'events', CAST(MIN(ts) AS DATE), CAST(MAX(ts) AS DATE), COUNT(*) FROM events
""")
def temporal_coverage(spark, sf):
    """min/max of each fact's date column, one aggregate pass per table."""
    t = Tables(spark, sf)
    parts = []
    for name, df, col in (("orders", t.orders, "o_orderdate"), ("lineitem", t.lineitem, "l_shipdate"),
                          ("events", t.events, "ts")):
        parts.append(df.agg(F.lit(name).alias("table_name"), F.to_date(F.min(col)).alias("min_date"),
                            F.to_date(F.max(col)).alias("max_date"), F.count(F.lit(1)).alias("n_rows")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("density_completeness", sql="""
WITH cells AS (
  SELECT year(l_shipdate) AS yr, l_returnflag, CAST(l_shipdate AS DATE) AS d, l_suppkey, COUNT(*) AS n
  FROM lineitem GROUP BY ALL
), per AS (
  SELECT CAST(yr AS INTEGER) AS yr, l_returnflag, CAST(SUM(n) AS BIGINT) AS n_rows, COUNT(*) AS n_cells,
         COUNT(DISTINCT d) AS n_days, COUNT(DISTINCT l_suppkey) AS n_suppliers
  FROM cells GROUP BY yr, l_returnflag
), mx AS (SELECT MAX(yr) AS max_yr FROM per)
SELECT p.*, CAST(make_date(yr + 1, 1, 1) - make_date(yr, 1, 1) AS INTEGER) AS expected_days,
       p.yr = mx.max_yr AS exempt,
       (p.n_days < CAST(make_date(yr + 1, 1, 1) - make_date(yr, 1, 1) AS INTEGER)) AND p.yr <> mx.max_yr AS incomplete
FROM per p CROSS JOIN mx
""")
def density_completeness(spark, sf):
    """Per (year, flag) rows / cells / distinct days / distinct suppliers vs the
    days the year should have; the latest (current) year is exempt."""
    li = Tables(spark, sf).lineitem
    cells = (li.groupBy(F.year("l_shipdate").alias("yr"), "l_returnflag",
                        F.to_date("l_shipdate").alias("d"), "l_suppkey")
               .agg(F.count(F.lit(1)).alias("n")))
    per = cells.groupBy("yr", "l_returnflag").agg(
        F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_cells"),
        F.count_distinct("d").alias("n_days"), F.count_distinct("l_suppkey").alias("n_suppliers"))
    # ``per`` holds one row per (year, flag): bounded by the calendar, so a global
    # window over it is cheap and avoids joining a scalar back in.
    out = per.withColumn("max_yr", F.max("yr").over(Window.partitionBy()))
    expected = D.days_in_year(F.col("yr"))
    return out.select("yr", "l_returnflag", "n_rows", "n_cells", "n_days", "n_suppliers",
                      expected.alias("expected_days"), (F.col("yr") == F.col("max_yr")).alias("exempt"),
                      ((F.col("n_days") < expected) & (F.col("yr") != F.col("max_yr"))).alias("incomplete"))


@query("density_full_set", sql="""
WITH c AS (SELECT DISTINCT CAST(year(l_shipdate) AS INTEGER) AS yr, l_returnflag, CAST(l_shipdate AS DATE) AS d, l_suppkey FROM lineitem),
full_set AS (SELECT l_returnflag, COUNT(DISTINCT l_suppkey) AS expected_regions FROM lineitem GROUP BY 1),
per AS (SELECT yr, l_returnflag, COUNT(*) AS actual_rows, COUNT(DISTINCT d) AS distinct_days, COUNT(DISTINCT l_suppkey) AS distinct_regions FROM c GROUP BY 1, 2),
e AS (SELECT per.*, expected_regions, CAST(make_date(yr + 1, 1, 1) - make_date(yr, 1, 1) AS INTEGER) AS days FROM per JOIN full_set USING (l_returnflag))
SELECT yr, l_returnflag, actual_rows, distinct_days, days AS days_in_year, distinct_regions, expected_regions,
       distinct_days <> days OR distinct_regions <> expected_regions OR actual_rows <> days * expected_regions AS incomplete
FROM e WHERE yr < (SELECT MAX(yr) FROM per)
""")
def density_full_set(spark, sf):
    """Every (year, flag) cell should hold each day of the year for the full supplier set of the
    whole table; the running year is exempt. One distinct pass feeds all three comparisons."""
    li = Tables(spark, sf).lineitem
    cells = li.select(F.year("l_shipdate").alias("yr"), "l_returnflag", F.to_date("l_shipdate").alias("d"), "l_suppkey").distinct()
    full = li.groupBy("l_returnflag").agg(F.count_distinct("l_suppkey").alias("expected_regions"))
    last = li.agg(F.max(F.year("l_shipdate")).alias("last"))
    per = cells.groupBy("yr", "l_returnflag").agg(
        F.count(F.lit(1)).alias("actual_rows"), F.count_distinct("d").alias("distinct_days"), F.count_distinct("l_suppkey").alias("distinct_regions"))
    days = D.days_in_year(F.col("yr"))
    out = per.join(last, F.col("yr") < F.col("last")).join(full, "l_returnflag")
    return out.select("yr", "l_returnflag", "actual_rows", "distinct_days", days.alias("days_in_year"), "distinct_regions", "expected_regions",
                      ((F.col("distinct_days") != days) | (F.col("distinct_regions") != F.col("expected_regions"))
                       | (F.col("actual_rows") != days * F.col("expected_regions"))).alias("incomplete"))
