"""Operations plans: the events table read as a DQ/run log, catalog and discovery."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import aggregates as A
from tessera.operators import windows as W
from tessera.plans.registry import REGISTRY, query
from tessera.sources.tables import TABLES, Tables

# Severity per event type when events are read as check results.
SEVERITY_OF = {"error": "fail", "signup": "warn"}
PASS_BELOW = 250


def _log(t: Tables):
    ev = t.events
    sev = F.when(F.col("event_type") == "error", "fail").when(F.col("event_type") == "signup", "warn").otherwise("info")
    return ev.select(F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("table_name"),
                     F.col("event_type").alias("check_name"), sev.alias("severity"),
                     (F.col("value") < PASS_BELOW).alias("passed"), F.col("ts").alias("checked_at"), "event_id")


_LOG_SQL = (f"SELECT 'user_' || CAST(user_id AS VARCHAR) AS table_name, event_type AS check_name, "
            f"CASE event_type WHEN 'error' THEN 'fail' WHEN 'signup' THEN 'warn' ELSE 'info' END AS severity, "
            f"value < {PASS_BELOW} AS passed, ts AS checked_at, event_id FROM events")

_ROLLUP_SQL = """
CASE WHEN MAX(CASE WHEN NOT passed AND severity IN ('fail', 'quarantine') THEN 1 ELSE 0 END) = 1 THEN 'failing'
     WHEN MAX(CASE WHEN NOT passed AND severity = 'warn' THEN 1 ELSE 0 END) = 1 THEN 'warning'
     ELSE 'passing' END"""


def rollup_status(df):
    """One status per table from its (latest) check results."""
    blocking = F.max(F.when(~F.col("passed") & F.col("severity").isin("fail", "quarantine"), 1).otherwise(0))
    warn = F.max(F.when(~F.col("passed") & (F.col("severity") == "warn"), 1).otherwise(0))
    return F.when(blocking == 1, "failing").when(warn == 1, "warning").otherwise("passing")


@query("dq_status_rollup", sql=f"""
WITH log AS ({_LOG_SQL}),
latest AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY table_name, check_name
                                  ORDER BY checked_at DESC, event_id DESC) AS rn FROM log) WHERE rn = 1)
SELECT table_name, {_ROLLUP_SQL} AS status, COUNT(*) AS n_checks, MAX(checked_at) AS last_checked_at
FROM latest GROUP BY table_name
""")
def dq_status_rollup(spark, sf):
    """Latest result per (table, check), then one status per table."""
    log = _log(Tables(spark, sf))
    latest = W.keep_one(log, ["table_name", "check_name"],
                        W.desc_nulls_last(F.col("checked_at"), "ts") + [-F.col("event_id")],
                        ["severity", "passed", "checked_at"])
    return latest.groupBy("table_name").agg(rollup_status(latest).alias("status"),
                                             F.count(F.lit(1)).alias("n_checks"),
                                             F.max("checked_at").alias("last_checked_at"))


@query("dq_trend", sql=f"""
SELECT event_type AS check_name, CAST(ts AS DATE) AS obs_date, COUNT(*) AS n_checks,
       CAST(SUM(CASE WHEN value < {PASS_BELOW} THEN 0 ELSE 1 END) AS BIGINT) AS n_failed,
       ROUND(SUM(CASE WHEN value < {PASS_BELOW} THEN 0 ELSE 1 END) / COUNT(*), 6) AS failure_rate,
       MAX(CASE WHEN value < {PASS_BELOW} THEN ts END) AS last_success_at
FROM events GROUP BY 1, 2
""")
def dq_trend(spark, sf):
    """Per check and day — runs, failures, failure rate, last success."""
    log = _log(Tables(spark, sf))
    g = log.groupBy("check_name", F.to_date("checked_at").alias("obs_date")).agg(
        F.count(F.lit(1)).alias("n_checks"),
        F.sum(F.when(F.col("passed"), 0).otherwise(1)).cast("bigint").alias("n_failed"),
        F.max(F.when(F.col("passed"), F.col("checked_at"))).alias("last_success_at"))
    return g.withColumn("failure_rate", F.round(F.col("n_failed") / F.col("n_checks"), 6))


_DAILY_DAYNUM = "(obs_date - DATE '1970-01-01')"


@query("rowcount_anomaly", sql=f"""
WITH d AS (SELECT event_type, CAST(ts AS DATE) AS obs_date, COUNT(*) AS n_rows FROM events GROUP BY 1, 2),
w AS (SELECT *, AVG(n_rows) OVER (PARTITION BY event_type ORDER BY {_DAILY_DAYNUM}
                                  RANGE BETWEEN 30 PRECEDING AND 1 PRECEDING) AS tm FROM d)
SELECT event_type, obs_date, n_rows, ROUND(tm, 4) AS trailing_mean,
       COALESCE(ABS(n_rows - tm) > 0.5 * tm, FALSE) AS is_anomaly FROM w
""")
def rowcount_anomaly(spark, sf):
    """Daily row count vs the trailing 30-day mean (+-50%). The window runs on
    the pre-aggregated daily series, never on raw rows."""
    ev = Tables(spark, sf).events
    d = ev.groupBy("event_type", F.to_date("ts").alias("obs_date")).agg(F.count(F.lit(1)).alias("n_rows"))
    tm = W.trailing(d, ["event_type"], "obs_date", "n_rows", 30, "avg")
    d = d.withColumn("__tm", tm)
    return d.select("event_type", "obs_date", "n_rows", F.round("__tm", 4).alias("trailing_mean"),
                    F.coalesce(F.abs(F.col("n_rows") - F.col("__tm")) > 0.5 * F.col("__tm"), F.lit(False)).alias("is_anomaly"))


@query("rolling_anomaly", sql=f"""
WITH d AS (SELECT event_type, CAST(ts AS DATE) AS obs_date, ROUND(SUM(value), 2) AS total FROM events GROUP BY 1, 2),
w AS (SELECT *,
        MEDIAN(total) OVER (PARTITION BY event_type ORDER BY {_DAILY_DAYNUM} RANGE BETWEEN 30 PRECEDING AND 1 PRECEDING) AS med30,
        AVG(total) OVER (PARTITION BY event_type ORDER BY {_DAILY_DAYNUM} RANGE BETWEEN 7 PRECEDING AND 1 PRECEDING) AS mean7
      FROM d)
SELECT event_type, obs_date, total, ROUND(med30, 4) AS median_30d, ROUND(mean7, 4) AS mean_7d,
       COALESCE(total > 2 * med30 OR total > 2 * mean7, FALSE) AS is_anomaly FROM w
""")
def rolling_anomaly(spark, sf):
    """> 2x the rolling 30-day median or the 7-day mean of the prior days."""
    ev = Tables(spark, sf).events
    d = ev.groupBy("event_type", F.to_date("ts").alias("obs_date")).agg(F.round(F.sum("value"), 2).alias("total"))
    d = d.withColumn("__m30", W.trailing(d, ["event_type"], "obs_date", "total", 30, "median")) \
         .withColumn("__a7", W.trailing(d, ["event_type"], "obs_date", "total", 7, "avg"))
    anomaly = F.coalesce((F.col("total") > 2 * F.col("__m30")) | (F.col("total") > 2 * F.col("__a7")), F.lit(False))
    return d.select("event_type", "obs_date", "total", F.round("__m30", 4).alias("median_30d"),
                    F.round("__a7", 4).alias("mean_7d"), anomaly.alias("is_anomaly"))


@query("offender_sample", sql="""
WITH o AS (SELECT DISTINCT o_custkey AS k FROM orders
           WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'))
SELECT 'fk_building_customer' AS check_name, (SELECT COUNT(*) FROM o) AS n_offenders,
       (SELECT string_agg(CAST(k AS VARCHAR), '>' ORDER BY k) FROM (SELECT k FROM o ORDER BY k LIMIT 10)) AS sample
""")
def offender_sample(spark, sf):
    """O2: count of offending keys plus an ordered sample of at most 10 (the limit
    is the feature: a bounded sample for the DQ record)."""
    t = Tables(spark, sf)
    parent = t.customer.filter(F.col("c_mktsegment") == "BUILDING").select(F.col("c_custkey").alias("k"))
    keys = t.orders.groupBy(F.col("o_custkey").alias("k")).agg(F.count(F.lit(1)).alias("n")).join(
        parent.withColumn("hit", F.lit(True)), "k", "left")
    told = A.marked_summary(keys, "k", F.col("hit").isNull(), 10)
    sample = F.when(F.size("sample") > 0, F.array_join(F.transform("sample", lambda x: x.cast("string")), ">"))
    return told.select(F.lit("fk_building_customer").alias("check_name"), F.col("n_marked").alias("n_offenders"), sample.alias("sample"))


@query("labelled_counts", sql=" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, COUNT(*) AS n_rows FROM {t}" for t in TABLES))
def labelled_counts(spark, sf):
    """Union of labelled row counts."""
    t = Tables(spark, sf)
    parts = [getattr(t, n).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("table_name"), "n_rows")
             for n in TABLES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("distribution_share", sql="""
WITH g AS (SELECT COALESCE(lang, '<none>') AS value, COUNT(*) AS n,
                  ROUND(AVG(CASE WHEN n_chars >= 1000 THEN 1.0 ELSE 0.0 END), 6) AS flag_share
           FROM documents GROUP BY 1)
SELECT value, n, flag_share, ROUND(n / SUM(n) OVER (), 6) AS share FROM g
""")
def distribution_share(spark, sf):
    """Distribution of a label with a <none> bucket and the share of flagged rows."""
    d = Tables(spark, sf).documents
    return A.distribution(d, F.col("lang"), F.col("n_chars") >= 1000)


@query("coverage_ratio", sql="""
WITH d AS (SELECT doc_id, doc_id IN (SELECT doc_id FROM labels) AS covered FROM documents)
SELECT COUNT(*) AS n_docs, CAST(SUM(CASE WHEN covered THEN 1 ELSE 0 END) AS BIGINT) AS n_covered,
       ROUND(SUM(CASE WHEN covered THEN 1 ELSE 0 END) / COUNT(*), 6) AS ratio,
       SUM(CASE WHEN covered THEN 1 ELSE 0 END) / COUNT(*) >= 0.65 AS passed,
       (SELECT string_agg(CAST(doc_id AS VARCHAR), '>' ORDER BY doc_id)
          FROM (SELECT doc_id FROM d WHERE NOT covered ORDER BY doc_id LIMIT 10)) AS missing_sample
FROM d
""")
def coverage_ratio(spark, sf):
    """Coverage with a threshold and a sorted sample of at most 10 misses."""
    t = Tables(spark, sf)
    lab = t.labels.select(F.col("doc_id").alias("__l")).distinct().withColumn("__hit", F.lit(True))
    d = t.documents.select("doc_id").join(lab, F.col("doc_id") == F.col("__l"), "left")
    told = A.marked_summary(d, "doc_id", F.col("__hit").isNull(), 10)
    told = told.select(F.col("n_rows").alias("n_docs"), (F.col("n_rows") - F.col("n_marked")).alias("n_covered"), "sample")
    ratio = F.col("n_covered") / F.col("n_docs")
    sample = F.when(F.size("sample") > 0, F.array_join(F.transform("sample", lambda x: x.cast("string")), ">"))
    return told.select("n_docs", "n_covered", F.round(ratio, 6).alias("ratio"), (ratio >= 0.65).alias("passed"), sample.alias("missing_sample"))


_DQ_FEEDS = ("dq_unique", "dq_range", "dq_vocab", "dq_fk", "dq_not_null", "dq_cardinality", "dq_date_order")
_REFRESH_COLS = {"orders": "o_orderdate", "lineitem": "l_shipdate", "events": "ts"}


def _discovery_sql() -> str:
    dq_union = " UNION ALL ".join(f"SELECT * FROM ({REGISTRY[k][1]})" for k in _DQ_FEEDS)
    counts = " UNION ALL ".join(f"SELECT '{t}' AS table_name, COUNT(*) AS n_rows FROM {t}" for t in TABLES)
    eng = " UNION ALL ".join(f"SELECT '{t}' AS table_name, CAST(MAX({c}) AS DATE) AS last_refreshed FROM {t}"
                             for t, c in _REFRESH_COLS.items())
    return f"""
WITH cat AS ({counts}), eng AS ({eng}), dq AS ({dq_union}),
roll AS (SELECT table_name, {_ROLLUP_SQL} AS dq_status, COUNT(*) AS n_checks FROM dq GROUP BY table_name)
SELECT cat.table_name, cat.n_rows, eng.last_refreshed, COALESCE(roll.dq_status, 'unknown') AS dq_status,
       COALESCE(roll.n_checks, 0) AS n_checks
FROM cat LEFT JOIN eng ON cat.table_name = eng.table_name LEFT JOIN roll ON cat.table_name = roll.table_name
"""


def discovery_view(spark, sf):
    """The ops tables are written first — DQ results appended to the
    log in one buffered write, catalog and engineering rows published as table
    versions — and the view is built from the stored tables: catalog LEFT JOIN
    engineering LEFT JOIN the roll-up of the latest result per (table, check)."""
    from tessera.operators import dq
    from tessera.session import shared_path
    from tessera.sources import lake
    t = Tables(spark, sf)
    root = shared_path(spark, "ops")
    with dq.ResultLog(f"{root}/dq_results", "discovery", "discovery_view") as rec:
        for k in _DQ_FEEDS:
            rec.record(REGISTRY[k][0](spark, sf))
    # one aggregate a table gives its count and newest date
    told = None
    for n in TABLES:
        newest = F.to_date(F.max(_REFRESH_COLS[n])) if n in _REFRESH_COLS else F.lit(None).cast("date")
        one = getattr(t, n).agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("n_rows"), newest.alias("last_refreshed"))
        told = one if told is None else told.unionByName(one)
    told = told.checkpoint()
    lake.publish_version(spark, told.select("table_name", "n_rows"), f"{root}/dataset_catalog")
    lake.publish_version(spark, told.where("last_refreshed IS NOT NULL").select("table_name", "last_refreshed"), f"{root}/dataset_engineering")

    cat = lake.read_current(spark, f"{root}/dataset_catalog")
    eng = lake.read_current(spark, f"{root}/dataset_engineering")
    log = spark.read.parquet(f"{root}/dq_results")
    latest = W.keep_one(log, ["table_name", "check_name"], [-F.col("run_order")], ["severity", "passed"])
    roll = latest.groupBy("table_name").agg(rollup_status(latest).alias("dq_status"),
                                            F.count(F.lit(1)).alias("n_checks"))
    out = cat.join(eng, "table_name", "left").join(roll, "table_name", "left")
    return out.select("table_name", "n_rows", "last_refreshed",
                      F.coalesce("dq_status", F.lit("unknown")).alias("dq_status"),
                      F.coalesce("n_checks", F.lit(0)).cast("bigint").alias("n_checks"))


query("discovery_view", sql=_discovery_sql())(discovery_view)


@query("catalog_completeness", sql="""
SELECT DISTINCT 'user_' || CAST(user_id AS VARCHAR) AS table_name FROM events
WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'AUTOMOBILE')
""")
def catalog_completeness(spark, sf):
    """Produced tables with no catalog metadata row (left-anti)."""
    t = Tables(spark, sf)
    produced = t.events.select("user_id").distinct()
    catalog = t.customer.filter(F.col("c_mktsegment") != "AUTOMOBILE").select(F.col("c_custkey").alias("user_id"))
    missing = produced.join(catalog, "user_id", "left_anti")
    return missing.select(F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("table_name"))


@query("lineage_staleness", sql="""
WITH rec AS (SELECT l_partkey, CAST(MAX(l_shipdate) AS DATE) AS recorded_version FROM lineitem
             WHERE l_shipdate < TIMESTAMP '2000-01-01' GROUP BY l_partkey),
cur AS (SELECT l_partkey, CAST(MAX(l_shipdate) AS DATE) AS current_version FROM lineitem GROUP BY l_partkey)
SELECT cur.l_partkey, rec.recorded_version, cur.current_version,
       rec.recorded_version IS DISTINCT FROM cur.current_version AS is_stale
FROM cur LEFT JOIN rec ON cur.l_partkey = rec.l_partkey
""")
def lineage_staleness(spark, sf):
    """C4: the upstream version recorded at build time (state before a cut-off)
    versus the upstream's current version; stale when they differ."""
    li = Tables(spark, sf).lineitem.select("l_partkey", "l_shipdate")
    cutoff = F.lit("2000-01-01").cast("timestamp_ntz")
    both = li.groupBy("l_partkey").agg(
        F.to_date(F.max(F.when(F.col("l_shipdate") < cutoff, F.col("l_shipdate")))).alias("recorded_version"),
        F.to_date(F.max("l_shipdate")).alias("current_version"))
    return both.withColumn("is_stale", ~F.col("recorded_version").eqNullSafe(F.col("current_version")))
