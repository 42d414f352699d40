"""Rules that govern builds, each run on the given tables: windows of years, required columns, overrides, additive columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import functions as F

from tessera.functions import dates as D
from tessera.operators import catalog as CAT
from tessera.plans.registry import query
from tessera.session import shared_path
from tessera.sources import delimited as DL
from tessera.sources import lake
from tessera.sources.tables import Tables


@query("year_window", sql="""
WITH m AS (SELECT CAST(max(year(o_orderdate)) AS INTEGER) AS y FROM orders),
w AS (SELECT 'span' AS mode, 1994 AS first_year, 1996 AS last_year UNION ALL SELECT 'back', y - 1, y FROM m)
SELECT mode, first_year, last_year, (SELECT count(*) FROM orders WHERE year(o_orderdate) BETWEEN first_year AND last_year) AS n_orders FROM w
""")
def year_window(spark, sf):
    """A build's years by an explicit span, and as the newest year of the table with the one before;
    the window reaches the scan as a half-open range. Mixed, half, reversed and negative requests are refused."""
    o = Tables(spark, sf).orders
    newest = o.agg(F.max(F.year("o_orderdate"))).first()[0]
    for bad in ({}, {"first": 1994}, {"first": 1996, "last": 1994}, {"back": -1}, {"first": 1994, "last": 1996, "back": 1}):
        try:
            D.build_years(**bad, this_year=newest)
        except ValueError:
            continue
        raise RuntimeError(f"accepted: {bad}")
    out = None
    for mode, asked in (("span", {"first": 1994, "last": 1996}), ("back", {"back": 1})):
        first, last = D.build_years(**asked, this_year=newest)
        part = o.where(D.half_open_year_range("o_orderdate", first, last)).agg(
            F.lit(mode).alias("mode"), F.lit(first).alias("first_year"), F.lit(last).alias("last_year"), F.count(F.lit(1)).alias("n_orders"))
        out = part if out is None else out.unionAll(part)
    return out


@query("required_columns", sql="""
SELECT 'whole' AS file, CAST(NULL AS VARCHAR) AS missing, count(*) AS n_rows FROM nation
UNION ALL SELECT 'other_spelling', NULL, count(*) FROM nation WHERE n_regionkey > 0
UNION ALL SELECT 'short', '[''name'', ''region key'']', NULL
""")
def required_columns(spark, sf):
    """P10: files of the nation table are read if they hold the required columns (spelling of headers aside), and
    refused with all that is missing."""
    n = Tables(spark, sf).nation
    files = {"whole": n.select(F.col("n_nationkey").alias("Nation Key"), F.col("n_name").alias("Name"), F.col("n_regionkey").alias("Region Key")),
             "other_spelling": n.where("n_regionkey > 0").select(F.col("n_nationkey").alias("NATION_KEY"), F.col("n_name").alias("name"), F.col("n_regionkey").alias("region-key")),
             "short": n.select(F.col("n_nationkey").alias("Nation Key"), F.col("n_comment").alias("Remark") if "n_comment" in n.columns else F.lit("").alias("Remark"))}
    out = None
    for name, df in files.items():
        path = shared_path(spark, f"required-{name}")
        df.write.option("header", True).csv(path)
        read = spark.read.option("header", True).csv(path)
        try:
            DL.require_columns(read.columns, ["nation key", "name", "region key"], name)
            part = read.agg(F.lit(name).alias("file"), F.lit(None).cast("string").alias("missing"), F.count(F.lit(1)).alias("n_rows"))
        except ValueError as e:
            part = spark.createDataFrame([(name, str(e).split(": ", 1)[1], None)], "file string, missing string, n_rows long")
        out = part if out is None else out.unionAll(part)
    return out


@dataclass(frozen=True)
class Provenance:
    """Where a table comes from."""

    source: str = "generator"
    cadence: str = "yearly"
    layer: str = "raw"


@query("provenance_override", sql="""
SELECT 'orders' AS table_name, 'generator' AS source, 'daily' AS cadence, 'raw' AS layer, count(*) AS n_rows FROM orders
UNION ALL SELECT 'part', 'generator', 'yearly', 'raw', count(*) FROM part
UNION ALL SELECT 'events', 'stream', 'daily', 'raw', count(*) FROM events
""")
def provenance_override(spark, sf):
    """Each table's record is the base with its own overrides; structural fields keep the base's value."""
    t = Tables(spark, sf)
    overrides = {"orders": {"cadence": "daily"}, "part": {}, "events": {"source": "stream", "cadence": "daily", "layer": "analysis"}}
    out = None
    for name, own in overrides.items():
        p = CAT.override_record(Provenance(), own, frozenset({"layer"}))
        row = getattr(t, name).agg(F.lit(name).alias("table_name"), F.lit(p.source).alias("source"), F.lit(p.cadence).alias("cadence"),
                                   F.lit(p.layer).alias("layer"), F.count(F.lit(1)).alias("n_rows"))
        out = row if out is None else out.unionAll(row)
    return out


@query("additive_backfill", sql="""
SELECT o_orderkey, o_totalprice, CASE WHEN year(o_orderdate) >= 1996 THEN o_orderpriority END AS o_orderpriority FROM orders
""")
def additive_backfill(spark, sf):
    """A stored table lacks a column that a later load brings. The probe finds it missing, the table
    is published again with the column (NULL in old rows), and the load is appended; without the migration
    the other schema is refused."""
    o = Tables(spark, sf).orders
    new = F.year("o_orderdate") >= 1996
    base = shared_path(spark, "backfill")
    lake.publish_version(spark, o.where(~new).select("o_orderkey", "o_totalprice"), base)
    load = o.where(new).select("o_orderkey", "o_totalprice", "o_orderpriority")
    try:
        lake.publish_version(spark, load, base)
        raise RuntimeError("another schema was accepted")
    except lake.SchemaDrift:
        pass
    now = lake.read_current(spark, base)
    declared = {f.name: f.dataType.simpleString() for f in load.schema}
    if set(declared) - set(now.columns):
        now = CAT.add_missing_columns(now, declared)
    lake.publish_version(spark, now.unionByName(load), base, allow_schema_change=True)
    return lake.read_current(spark, base)
