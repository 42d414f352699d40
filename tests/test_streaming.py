"""Streams drain with AvailableNow, lose no row however late it lands, and are safe to re-run."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tessera.operators import merge as MG
from tessera.session import ensure_checkpoint_dir, shared_path
from tessera.sources import lake
from tessera.streaming import ingest as S


def test_rerun_ingests_only_new_files(spark):
    df = spark.range(0, 100).select(F.col("id"), (F.col("id") % 5).alias("g"))
    landing = shared_path(spark, "t_landing")
    first = S.land_files(df, landing, 3)
    assert S.landing_complete(spark, first) and not S.landing_complete(spark, shared_path(spark, "t_missing"))
    sink, ckpt = shared_path(spark, "t_sink"), shared_path(spark, "t_ckpt")
    for _ in range(2):
        S.run_available_now(S.file_stream(spark, landing, df.schema, 1), ckpt, sink_path=sink)
    assert spark.read.parquet(sink).count() == 100
    second = S.land_files(spark.range(100, 110).select(F.col("id"), F.lit(9).cast("bigint").alias("g")), landing)
    assert second != first  # each landing has a marker of its own
    S.run_available_now(S.file_stream(spark, landing, df.schema, 1), ckpt, sink_path=sink)
    assert spark.read.parquet(sink).count() == 110


REV = "k int, rev int, v string, p int"


def test_latest_revision_wins_across_batches_and_restarts(spark):
    base = shared_path(spark, "t_rev")
    table = lambda: S.PartitionedTable(spark, base, "p", REV, ["k", "p"])  # noqa: E731  a restart each time
    assert table().read().count() == 0
    run = lambda rows, batch: S.latest_revision_batches(table(), "rev")(spark.createDataFrame(rows, REV), batch)
    run([(1, 0, "a", 1), (2, 0, "b", 2)], 0)
    run([(1, 1, "A", 1), (2, 0, "b", 2)], 1)
    run([(1, 0, "stale", 1)], 2)
    run([(1, 0, "stale", 1)], 2)  # replayed batch
    assert sorted(tuple(r) for r in table().read().select("k", "rev", "v", "p").collect()) == [(1, 1, "A", 1), (2, 0, "b", 2)]


def test_keys_must_hold_the_partition(spark):
    with pytest.raises(ValueError):
        S.PartitionedTable(spark, shared_path(spark, "t_bad"), "p", REV, ["k"])


def test_a_failing_read_fails_the_merge_and_keeps_the_table(spark, monkeypatch):
    path, st = shared_path(spark, "t_fail"), "k int, p int, v int"
    up = lambda cur, src: MG.upsert(cur, src, ["k", "p"])
    lake.merge_partitions(spark, path, spark.createDataFrame([(i, 1, 0) for i in range(5)], st), "p", up, shared_path(spark, "t_s0"))

    def broken(*a):
        raise OSError("store unavailable")

    whole = lake.read_table
    monkeypatch.setattr(lake, "read_table", lambda s, p, schema: broken() if p == path else whole(s, p, schema))
    with pytest.raises(OSError):
        lake.merge_partitions(spark, path, spark.createDataFrame([(9, 1, 9)], st), "p", up, shared_path(spark, "t_s1"))
    monkeypatch.undo()
    assert lake.read_table(spark, path, st).count() == 5
    lake.merge_partitions(spark, path, spark.createDataFrame([(9, 1, 9)], st), "p", up, shared_path(spark, "t_s2"))
    assert lake.read_table(spark, path, st).count() == 6


def _events(spark):
    """240 days, each day's rows spread over all files."""
    start = dt.date(2024, 1, 1)
    rows = [(i, start + dt.timedelta(days=i % 240), f"t{i % 3}", float(i % 7)) for i in range(1200)]
    return rows, spark.createDataFrame(rows, "event_id long, day date, kind string, value double")


def test_totals_add_up_over_many_batches_and_landings(spark):
    rows, df = _events(spark)
    landing, ckpt = shared_path(spark, "t_long"), shared_path(spark, "t_long_ckpt")
    S.land_files(df.where("event_id < 900"), landing, 13)
    sums = S.PartialSums(spark, shared_path(spark, "t_sums"), ["day", "kind"], ["n", "total"], "day date, kind string, n long, total double")
    assert sums.read().count() == 0
    fn = sums.batches(lambda b: b.select("day", "kind", F.lit(1).alias("n"), F.col("value").alias("total")))
    S.run_available_now(S.file_stream(spark, landing, df.schema, 1), ckpt, foreach_batch=fn)
    S.land_files(df.where("event_id >= 900"), landing, 2)  # old days again
    S.run_available_now(S.file_stream(spark, landing, df.schema, 1), ckpt, foreach_batch=fn)
    want = {}
    for _, day, kind, value in rows:
        n, t = want.get((day, kind), (0, 0.0))
        want[day, kind] = (n + 1, t + value)
    assert {(r.day, r.kind): (r.n, r.total) for r in sums.read().collect()} == want


def test_revisions_land_however_late_and_may_move_a_row(spark):
    rows, df = _events(spark)
    schema = "event_id long, day date, value double, rev int, bucket int"
    table = S.PartitionedTable(spark, shared_path(spark, "t_moved"), "bucket", schema, ["event_id", "bucket"])
    landing, ckpt = shared_path(spark, "t_moved_in"), shared_path(spark, "t_moved_ckpt")
    shaped = df.select("event_id", "day", "value", F.lit(0).alias("rev"))
    fn = S.latest_revision_batches(table, "rev", lambda b: b.withColumn("bucket", (F.col("event_id") % 4).cast("int")))
    S.land_files(shaped, landing, 6)
    S.run_available_now(S.file_stream(spark, landing, shaped.schema, 2), ckpt, foreach_batch=fn)
    late = shaped.where("event_id % 6 = 0").select("event_id", F.date_add("day", 9).alias("day"), (F.col("value") + 100).alias("value"), F.lit(1).alias("rev"))
    S.land_files(late, landing, 3)
    S.run_available_now(S.file_stream(spark, landing, shaped.schema, 2), ckpt, foreach_batch=fn)
    out = {r.event_id: (r.day, r.value) for r in table.read().collect()}
    assert len(out) == table.read().count() == 1200
    assert out == {i: (d + dt.timedelta(days=9), v + 100) if i % 6 == 0 else (d, v) for i, d, _, v in rows}


def _days(spark):
    """240 days in order of time, five rows a day."""
    return spark.range(1200).select(F.col("id").alias("event_id"), F.expr("timestamp '2024-01-01' + make_interval(0, 0, 0, cast(id div 5 as int))").alias("ts"),
                                    (F.col("id") % 7).cast("double").alias("value"), F.lit(0).alias("rev"))


def test_state_and_side_table_hold_every_revision(spark):
    df = _days(spark)
    landing = shared_path(spark, "t_state_in")
    table = S.RevisionStream(spark, shared_path(spark, "t_state"), "event_id long, value double, rev int", ["event_id"], "rev", "ts", "3 days", rows_per_file=100)
    run = lambda: table.on_time(S.file_stream(spark, landing, df.schema, 1))
    aside = lambda: table.set_late_aside(S.file_stream(spark, landing, df.schema))
    for lo in range(0, 1200, 300):  # files in order of time: nothing is late
        S.land_files(df.where(f"event_id >= {lo} AND event_id < {lo + 300}"), landing, 1)
    assert run() == 0
    aside()
    assert table.late().isEmpty() and table.main.read().count() == 1200
    files = table.main.manifest().count()

    recent = df.where("event_id >= 1195").withColumns({"value": F.col("value") + 100, "rev": F.lit(1)})
    old = df.where("event_id % 10 = 0 AND event_id < 1100").withColumns({"value": F.col("value") + 100, "rev": F.lit(1)})
    S.land_files(recent.unionAll(recent), landing, 1)  # on time, twice
    S.land_files(old, landing, 1)  # far behind the watermark
    before = {r.path for r in table.main.manifest().collect()}
    dropped = run()
    kept = {r.path for r in table.main.manifest().collect()} & before
    assert dropped == old.count() == 110 and len(kept) >= files - 2  # a late batch changes few files
    aside()
    assert table.late().count() == 110
    lost = df.join(table.main.read().unionByName(table.late()), "event_id", "left_anti")
    assert lost.isEmpty()
    assert table.absorb() == 110 and table.absorb() == 0 and table.late().isEmpty()
    out = {r.event_id: (r.value, r.rev) for r in table.main.read().collect()}
    new = lambda i: i >= 1195 or (i % 10 == 0 and i < 1100)
    assert table.main.read().count() == 1200
    assert out == {i: (i % 7 + 100.0, 1) if new(i) else (float(i % 7), 0) for i in range(1200)}


def test_window_totals_stay_bounded_and_equal(spark):
    df = _days(spark).withColumn("kind", F.concat(F.lit("k"), F.col("event_id") % 2))
    landing = shared_path(spark, "t_win_in")
    table = S.WindowTotals(spark, shared_path(spark, "t_win"), ["kind"], ["value"], "kind string, value double", "ts", "1 day", "3 days")
    for lo in range(0, 1200, 50):
        S.land_files(df.where(f"event_id >= {lo} AND event_id < {lo + 50}"), landing, 1)
    read = lambda: S.file_stream(spark, landing, df.schema, 1)
    table.run(read())
    total = lambda rows: {(str(r.ts), r.kind): (r.value, r.n) for r in rows.groupBy("ts", "kind").agg(
        F.sum("value").alias("value"), F.count(F.lit(1)).alias("n")).collect()}
    have = lambda: {(str(r.window_start), r.kind): (r.value, r.n) for r in table.table.read().collect()}
    assert have() == total(df) and table.repair(df) == 0
    assert table.table.n_files() <= 17 and len(lake.names_in(spark, f"{table.table.base}/_versions")) <= 2 * 8

    late = df.where("event_id < 20").withColumn("value", F.lit(1.0))
    S.land_files(late, landing, 1)
    table.run(read())
    assert have() == total(df)  # closed windows do not change in the stream
    assert table.repair(df.unionAll(late)) == len(total(late)) and have() == total(df.unionAll(late))


def test_partial_sums_fold_their_folders(spark):
    sums = S.PartialSums(spark, shared_path(spark, "t_fold"), ["g"], ["n"], "g long, n long", most=10)
    fn = sums.batches(lambda b: b.select((F.col("id") % 5).alias("g"), F.lit(1).cast("long").alias("n")))
    most = 0
    for i in range(200):
        fn(spark.range(5 * i, 5 * i + 5).coalesce(1), i)
        if i % 9 == 0:
            fn(spark.range(5 * i, 5 * i + 5).coalesce(1), i)  # a replay
        most = max(most, len(lake.names_in(spark, sums.path)) + len(lake.names_in(spark, f"{sums.base}/folded")))
    assert most <= 12 and {r.g: r.n for r in sums.read().collect()} == {g: 200 for g in range(5)}


def test_a_cluster_must_name_a_shared_folder(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)
        getConf = staticmethod(lambda: type("C", (), {"get": staticmethod(lambda k, d=None: d)}))

    class Session:
        sparkContext = Context
        conf = type("C", (), {"get": staticmethod(lambda k, d=None: d)})

    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(Session)
