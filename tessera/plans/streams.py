"""Streaming plans over events landed as files; oracles are the batch SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.plans.registry import query
from tessera.session import shared_path
from tessera.sources.tables import Tables
from tessera.streaming import ingest as S

#: Files of one micro-batch.
MAX_FILES = 3


def _land(spark, name, df):
    """Land a payload as about as many files as the cluster runs tasks at once."""
    path = shared_path(spark, name)
    folder = S.land_files(df, path, spark.sparkContext.defaultParallelism)
    if not S.landing_complete(spark, folder):
        raise RuntimeError(f"landing {folder} is incomplete")
    return path


@query("stream_file_ingest", sql="SELECT event_id, ts, user_id, event_type, value, props FROM events")
def stream_file_ingest(spark, sf):
    """Fetch-once landing with a completion marker, ingested by an AvailableNow
    file stream; the second run finds nothing new (checkpointed progress)."""
    ev = Tables(spark, sf).events
    landing = _land(spark, "landing_events", ev)
    sink, ckpt = shared_path(spark, "raw_events"), shared_path(spark, "ckpt_raw_events")
    for _ in range(2):
        S.run_available_now(S.file_stream(spark, landing, ev.schema, MAX_FILES), ckpt, sink_path=sink)
    return spark.read.schema(ev.schema).parquet(sink)


@query("stream_second_table", sql="""
SELECT CAST(ts AS DATE) AS obs_date, event_type, COUNT(*) AS n FROM events GROUP BY 1, 2
""")
def stream_second_table(spark, sf):
    """One landed payload feeds a second table, per-type daily counts, through a
    streaming query and checkpoint of its own; batches add up."""
    ev = Tables(spark, sf).events
    landing = _land(spark, "landing_counts", ev)
    counts = S.PartialSums(spark, shared_path(spark, "event_type_counts"), ["obs_date", "event_type"], ["n"],
                           "obs_date date, event_type string, n long")
    fn = counts.batches(lambda b: b.select(F.to_date("ts").alias("obs_date"), "event_type", F.lit(1).alias("n")))
    ckpt = shared_path(spark, "ckpt_event_type_counts")
    for _ in range(2):
        S.run_available_now(S.file_stream(spark, landing, ev.schema, MAX_FILES), ckpt, foreach_batch=fn)
    return counts.read()


@query("stream_upsert", sql="""
SELECT user_id, CAST(ts AS DATE) AS obs_date, event_type, ROUND(SUM(value), 2) AS total, COUNT(*) AS n
FROM events GROUP BY 1, 2, 3
""")
def stream_upsert(spark, sf):
    """Events upserted on their key by foreachBatch, in the partition of their day;
    daily totals are aggregated when read, so a day may span any number of batches."""
    ev = Tables(spark, sf).events
    landing = _land(spark, "landing_daily", ev)
    table = S.PartitionedTable(spark, shared_path(spark, "daily_events"), "obs_date",
                               "event_id long, user_id long, event_type string, value double, obs_date date", ["event_id", "obs_date"])
    fn = S.upsert_batches(table, lambda b: b.withColumn("obs_date", F.to_date("ts")))
    S.run_available_now(S.file_stream(spark, landing, ev.schema, MAX_FILES), shared_path(spark, "ckpt_daily"), foreach_batch=fn)
    return table.read().groupBy("user_id", "obs_date", "event_type").agg(
        F.round(F.sum("value"), 2).alias("total"), F.count(F.lit(1)).alias("n"))


@query("stream_late_revision", sql="""
SELECT event_id, CASE WHEN event_type = 'error' THEN value + 1000 ELSE value END AS value,
       CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS revision
FROM events
""")
def stream_late_revision(spark, sf):
    """Originals land first, revised rows (error events re-issued, moved by a day) land
    later in the same folder. The stream keeps the keys of the last two days in state; rows behind its
    watermark go to a side table, which a second job absorbs; the highest revision per key wins."""
    ev = Tables(spark, sf).events.select("event_id", "ts", "event_type", "value")
    orig = ev.withColumn("revision", F.lit(0))
    rev = (ev.filter(F.col("event_type") == "error").withColumn("value", F.col("value") + 1000)
           .withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 DAY")).withColumn("revision", F.lit(1)))
    landing = _land(spark, "landing_revisions", orig)
    table = S.RevisionStream(spark, shared_path(spark, "revised_events"), "event_id long, value double, revision int",
                             ["event_id"], "revision", "ts", "2 days")
    for late in (None, rev):
        if late is not None:
            S.land_files(late, landing)  # the late revisions arrive
        table.on_time(S.file_stream(spark, landing, orig.schema, MAX_FILES))
        table.set_late_aside(S.file_stream(spark, landing, orig.schema))
    table.absorb()
    return table.main.read()


@query("stream_tumbling", sql="""
SELECT event_type, date_trunc('day', ts) AS window_start, COUNT(*) AS n, ROUND(SUM(value), 2) AS total
FROM events GROUP BY 1, 2
""")
def stream_tumbling(spark, sf):
    """T4: one-day tumbling windows whose open windows live in the stream's state (two days of delay); files land
    in no order of time, so windows that lack rows behind the watermark are computed anew afterwards."""
    ev = Tables(spark, sf).events
    landing = _land(spark, "landing_windows", ev)
    table = S.WindowTotals(spark, shared_path(spark, "window_totals"), ["event_type"], ["total"],
                           "event_type string, total double", "ts", "1 day", "2 days")
    table.run(S.file_stream(spark, landing, ev.schema, MAX_FILES).withColumn("total", F.col("value")))
    table.repair(spark.read.schema(ev.schema).parquet(f"{landing}/*").withColumn("total", F.col("value")))
    return table.table.read().select("event_type", S.wall_time(F.col("window_start")).alias("window_start"), "n", F.round("total", 2).alias("total"))
