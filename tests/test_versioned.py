"""Tables that share files between versions, pointers made once, stored histories, views that stay, interval labels."""

import threading

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tessera.functions import codes as C
from tessera.operators import aggregates as A
from tessera.operators import catalog as CAT
from tessera.operators import entitymap as EM
from tessera.operators import hierarchy as H
from tessera.operators import lineage as LN
from tessera.operators import merge as MG
from tessera.session import shared_path
from tessera.sources import lake
from tessera.sources.history import HistoryTable
from tessera.sources.keyed import KeyedFiles

KV = "k long, v string, w int"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


# ------------------------------------------------------------------ pointers

def test_create_once_has_one_winner(spark):
    path = f"{shared_path(spark, 't_once')}/000001"
    won = []
    threads = [threading.Thread(target=lambda i=i: won.append((lake.create_once(spark, path, f"w{i}"), i))) for i in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    winners = [i for ok, i in won if ok]
    assert len(winners) == 1 and lake.read_text(spark, path) == f"w{winners[0]}"
    assert lake.names_in(spark, path.rsplit("/", 1)[0]) == ["000001"]  # nothing else is left


def test_publishers_at_once_are_all_in_the_chain(spark):
    base = shared_path(spark, "t_race")
    lake.publish_version(spark, spark.range(1), base)
    paths, threads = [], []
    for i in range(6):
        threads.append(threading.Thread(target=lambda i=i: paths.append(lake.publish_version(spark, spark.range(i + 2), base))))
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    chain = lake.version_chain(spark, base)
    assert len(chain) == len(set(chain)) == 7 and set(paths) == set(chain[1:])
    assert lake.current_version(spark, base) == chain[-1] and lake.last_turn(spark, base) == 7


# ---------------------------------------------------------------- KeyedFiles

def keyed(spark, n=4000, per_file=40):
    table = KeyedFiles(spark, shared_path(spark, "t_keyed"), KV, ["k"], rows_per_file=per_file)
    table.merge(spark.range(n).select(F.col("id").alias("k"), F.lit("a").alias("v"), F.lit(0).alias("w")))
    return table


def test_a_small_merge_rewrites_few_files(spark):
    table = keyed(spark)
    before = table.manifest().count()
    assert before >= 100
    source = spark.range(2000, 2040).select(F.col("id").alias("k"), F.lit("b").alias("v"), F.lit(1).alias("w"))  # 1%
    done = table.merge(source)
    assert 1 <= done.replaced <= before * 0.05 and done.kept == before - done.replaced
    now = table.read()
    assert now.count() == 4000 and rows(now.where("v = 'b'").select("k")) == [(i,) for i in range(2000, 2040)]
    assert table.read(1).where("v = 'b'").isEmpty()  # the older version is as it was
    old, new = ({r.path for r in table.manifest(v).collect()} for v in (1, 2))
    assert len(old & new) == done.kept  # kept by reference


def test_scattered_keys_inserts_and_ranges(spark):
    table = keyed(spark)
    source = spark.createDataFrame([(5, "x", 1), (3999, "x", 1), (9000, "new", 1), (None, "null", 1)], KV)
    done = table.merge(source)
    assert done.replaced == 2
    now = table.read()
    assert now.count() == 4002 and rows(now.where("v <> 'a'")) == rows(source)
    near = table.read(between=(8000, 9999))
    assert near.count() <= 80 and near.where("k = 9000").count() == 1
    assert table.merge(spark.createDataFrame([], KV)).replaced == 0 and table.read().count() == 4002


def test_partial_columns_and_duplicate_sources(spark):
    table = keyed(spark, 100, 10)
    up = lambda now, new: MG.upsert_columns(now, new.select("k", "v"), ["k"], ["v"], check=False)
    table.merge(spark.createDataFrame([(3, "b"), (200, "c")], "k long, v string"), up)
    assert rows(table.read().where("v <> 'a'")) == [(200, "c", None), (3, "b", 0)]
    with pytest.raises(MG.MergeConflict):
        table.merge(spark.createDataFrame([(1, "x", 1), (1, "y", 1)], KV))


def test_writers_at_once_lose_nothing(spark):
    table = KeyedFiles(spark, shared_path(spark, "t_two"), KV, ["k"])
    table.merge(spark.createDataFrame([(0, "a", 0)], KV))
    errors = []

    def add(i):
        try:
            KeyedFiles(spark, table.base, KV, ["k"]).merge(spark.createDataFrame([(i, f"t{i}", i), (100 + i, "n", i)], KV))
        except Exception as e:  # noqa: BLE001
            errors.append(e)

    threads = [threading.Thread(target=add, args=(i,)) for i in range(1, 5)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors and table.version() == 5
    assert rows(table.read().select("k")) == sorted([(0,)] + [(i,) for i in range(1, 5)] + [(100 + i,) for i in range(1, 5)], key=str)


def test_compaction_and_forgetting_keep_the_rows(spark):
    table = KeyedFiles(spark, shared_path(spark, "t_small"), KV, ["k"], rows_per_file=1000)
    for i in range(6):
        table.merge(spark.createDataFrame([(i, f"v{i}", i)], KV))
    want = rows(table.read())
    assert table.manifest().count() == 6 and table.compact(6) is None
    assert table.compact(3).written == 1 and rows(table.read()) == want and table.manifest().count() == 1
    assert table.forget(1) == 6 and rows(table.read()) == want
    assert len(lake.names_in(spark, f"{table.base}/data")) == 1 and len(lake.names_in(spark, f"{table.base}/_versions")) == 1


# ------------------------------------------------------------------- history

SNAP = [("a", "x", "2024-01-01", 1), ("b", "x", "2024-01-01", 2), ("a", "y", "2024-02-01", 3), ("b", "x", "2024-02-01", 4),
        ("a", "y", "2024-03-01", 5), ("b", "z", "2024-03-01", 6), ("c", None, "2024-03-01", 7), ("a", "x", "2024-03-01", 8),
        ("a", "q", "2024-03-01", 9), ("c", None, "2024-04-01", 10), ("a", "q", "2024-04-02", 11), ("d", "n", "2024-04-02", 12)]


@pytest.mark.parametrize("cuts", [("2024-02-15",), ("2024-01-15", "2024-02-15", "2024-03-15")])
def test_loads_one_by_one_equal_one_history(spark, cuts):
    df = spark.createDataFrame(SNAP, "k string, v string, d string, n int").withColumn("d", F.to_date("d"))
    whole = MG.scd2(df, ["k"], ["d", "n"], ["v"], "d")
    table = HistoryTable(spark, shared_path(spark, "t_hist"), "k string, v string", ["k"], ["v"])
    for lo, hi in zip(("2000-01-01", *cuts), (*cuts, "2100-01-01"), strict=True):
        table.load(df.where((F.col("d") >= lo) & (F.col("d") < hi)), ["d", "n"], "d")
    assert rows(table.read().select(*whole.columns)) == rows(whole)
    for t in ("2023-01-01", "2024-01-01", "2024-02-20", "2024-03-01", "2024-05-01"):
        want = MG.as_of(whole, F.lit(t).cast("date")).select("k", "v", "_effective_from", "_effective_to")
        assert rows(table.as_of(t)) == rows(want)


def test_a_load_touches_changed_keys_and_reads_push_bounds(spark):
    first = spark.range(2000).select("id", F.lit("a").alias("v"), F.to_date(F.lit("2024-01-01")).alias("d"))
    table = HistoryTable(spark, shared_path(spark, "t_hist2"), "id long, v string", ["id"], ["v"], rows_per_file=50)
    table.load(first, ["d"], "d")
    second = first.withColumn("d", F.to_date(F.lit("2024-02-01"))).withColumn("v", F.when(F.col("id") < 20, "b").otherwise(F.col("v")))
    closed = {r.path for r in table.closed.manifest().collect()}
    done = table.load(second, ["d"], "d")
    assert 1 <= done["replaced"] <= 2 and done["kept"] >= 38
    assert closed <= {r.path for r in table.closed.manifest().collect()}  # ended versions are only appended
    again = table.load(second.withColumn("d", F.to_date(F.lit("2024-03-01"))), ["d"], "d")
    assert again["replaced"] == 0 and table.read().count() == 2020
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = table.as_of("2024-01-15")._jdf.queryExecution().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "PushedFilters: [IsNotNull(_effective_from), LessThanOrEqual(_effective_from,2024-01-15)" in plan
    assert "GreaterThan(_effective_to,2024-01-15)" in plan
    assert len(table.closed.manifest().where(F.col("hi") > F.lit("2025-01-01").cast("date")).collect()) == 0
    with pytest.raises(ValueError):
        table.load(first.withColumn("v", F.lit("zz")).withColumn("d", F.to_date(F.lit("2023-01-01"))), ["d"], "d")


def test_a_load_that_dies_is_run_again(spark, monkeypatch):
    df = spark.createDataFrame(SNAP, "k string, v string, d string, n int").withColumn("d", F.to_date("d"))
    table = HistoryTable(spark, shared_path(spark, "t_hist3"), "k string, v string", ["k"], ["v"])
    cut = F.col("d") < "2024-02-15"
    table.load(df.where(cut), ["d", "n"], "d")
    before, merge = rows(table.read()), KeyedFiles.merge
    monkeypatch.setattr(KeyedFiles, "merge", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        table.load(df.where(~cut), ["d", "n"], "d")  # ended versions are written, the load is not
    assert rows(table.read()) == before
    monkeypatch.setattr(KeyedFiles, "merge", merge)
    table.load(df.where(~cut), ["d", "n"], "d")
    whole = MG.scd2(df, ["k"], ["d", "n"], ["v"], "d")
    assert rows(table.read().select(*whole.columns)) == rows(whole)


# ---------------------------------------------------------------------- view

def test_a_join_view_outlives_the_session_and_follows_its_parents(spark):
    a, b, view = "t_view_a", "t_view_b", "t_view_ab"
    sql = f"SELECT x.id, y.v FROM {a} x JOIN {b} y ON x.id = y.id"
    CAT.save_table(spark.range(3), a, shared_path(spark, "va"))
    assert not CAT.create_join_view(spark, view, (a, b), sql) and not spark.catalog.tableExists(view)
    CAT.save_table(spark.range(2).withColumn("v", F.lit("s")), b, shared_path(spark, "vb"))
    assert CAT.create_join_view(spark, view, (a, b), sql) and CAT.create_join_view(spark, view, (a, b), sql)
    other = spark.newSession()
    assert other.table(view).count() == 2 and not other.catalog.getTable(view).isTemporary
    CAT.save_table(spark.range(2).withColumn("v", F.lit(1.5)), b, shared_path(spark, "vb2"))  # another schema
    assert CAT.create_join_view(spark, view, (a, b), sql)
    assert dict(spark.newSession().table(view).dtypes)["v"] in ("double", "decimal(2,1)")
    spark.range(1).createOrReplaceTempView("t_view_temp")
    with pytest.raises(AnalysisException):
        CAT.create_join_view(spark, "t_view_bad", ("t_view_temp",), "SELECT * FROM t_view_temp")


# ----------------------------------------------------------------- hierarchy

def test_doubling_and_intervals_on_a_deep_tree(spark):
    parent = {f"n{i}": f"n{(i - 1) // 2}" for i in range(1, 60)} | {"chain0": None} | {f"chain{i}": f"chain{i - 1}" for i in range(1, 40)}
    edges = spark.createDataFrame(list(parent.items()), "child string, parent string")
    paths = H.paths_by_doubling(edges)

    def path(n):
        return [*path(parent[n]), n] if parent.get(n) else [n]

    want = {n: path(n) for n in [*parent, "n0"]}
    assert {r.node: r.path for r in paths.collect()} == want
    labels = H.interval_labels(paths, shared_path(spark, "t_labels"))
    for root in ("n0", "n1", "n7", "n59", "chain0", "chain20", "chain39", "missing"):
        got = {r.node for r in H.subtree(labels, root).collect()}
        assert got == {n for n, p in want.items() if root in p[:-1]}
    plan = H.subtree(labels, "n1")._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(first), GreaterThan(first," in plan


def test_doubling_detects_a_cycle(spark):
    with pytest.raises(ValueError):
        H.paths_by_doubling(spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("x", None)], "child string, parent string"))


def test_name_key_computes_its_text_once(spark):
    df = spark.createDataFrame([("Œuvre ½ ﬁ Ⅷ Ångström",)], "s string").select(C.name_key("s").alias("k"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") == 1 and df.first().k == "uvre 1 2 fi viii angstrom"


# -------------------------------------------------------------------- builds

def test_a_change_two_steps_upstream_makes_only_its_descendants(spark):
    calls = []

    def make(name):
        def fn(*frames):
            calls.append(name)
            out = frames[0]
            for f in frames[1:]:
                out = out.unionByName(f)
            return out
        return fn

    def graph(recipe="1"):
        return LN.BuildGraph(spark, base, [LN.Build("d", ("c", "x"), make("d")), LN.Build("c", ("b",), make("c")),
                                           LN.Build("b", ("s1",), make("b"), recipe), LN.Build("x", ("s2",), make("x"))])

    base = shared_path(spark, "t_builds")
    s1, s2 = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string"), spark.createDataFrame([(3, "c")], "k int, v string")
    assert graph().refresh({"s1": s1, "s2": s2}) == {"b": True, "x": True, "c": True, "d": True}
    assert not any(graph().refresh({"s1": s1.orderBy("k", ascending=False), "s2": s2}).values())
    calls.clear()
    assert graph().refresh({"s1": s1.fillna("a"), "s2": s2}) == {"b": True, "x": False, "c": True, "d": True} and calls == ["b", "c", "d"]
    assert graph("2").refresh({"s1": s1.fillna("a"), "s2": s2}) == {"b": True, "x": False, "c": True, "d": True}
    g = graph("2")
    assert not any(g.refresh({"s1": s1.fillna("a"), "s2": s2}).values()) and rows(g.table("d")) == [(1, "a"), (2, "a"), (3, "c")]
    with pytest.raises(KeyError):
        graph().refresh({"s1": s1})


def test_row_prints_tell_nulls_and_borders(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None), ("a|", "", "b"), ("a", "|", "b"), ("", "a", "b"), ("n", None, "n")], "x string, y string, z string")
    prints = [r[0] for r in df.select(LN.row_print([F.col(c) for c in df.columns])).collect()]
    assert len(set(prints)) == 6 and all(0 <= p < 2**60 for p in prints)
    same = lambda d: tuple(d.agg(*LN.content_print(d)).first())
    assert same(df) == same(df.orderBy("x", "y")) != same(df.fillna("q")) and same(df.limit(0)) == (0, "0")


# ---------------------------------------------------------------- entity map

def test_entity_rules_share_one_stage_and_read_declared_columns(spark):
    df = spark.createDataFrame([("a", "7", "Côte d’Or", 3, 1, "_", b"x"), ("b", "1234", "  ", 3, 1, "_", b"x"), ("c", "x1", "ﬁ ½", 5, 2, "-", b"x"), ("d", None, None, 5, 2, "-", b"x")],
                               "k string, code string, name string, w int, p int, j string, blob binary")
    out = EM.map_entities(df, ["k"], [EM.id_rule("key", "code", "w", "p"), EM.name_rule("name_key", "name", "j")])
    assert [(r.k, r.key and tuple(r.key), r.name_key) for r in out.orderBy("k").collect()] == [
        ("a", ("007", "0"), "cote_d_or"), ("b", None, None), ("c", None, "fi-1-2"), ("d", None, None)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "blob" not in plan.split("Project")[-1].split("\n")[0]
    with pytest.raises(ValueError):
        EM.map_entities(df, ["k"], [EM.name_rule("n", "nowhere", "j")])


def test_marked_summary_is_one_pass(spark):
    df = spark.range(0, 1000, 1, 7).select(F.col("id").alias("k"), (F.col("id") % 3 == 1).alias("bad"))
    got = A.marked_summary(df, "k", F.col("bad"), 4).first()
    assert (got.n_rows, got.n_marked, got.sample) == (1000, 333, [1, 4, 7, 10])
    empty = A.marked_summary(df.limit(0), "k", F.col("bad"), 4).first()
    assert (empty.n_rows, empty.n_marked, empty.sample) == (0, 0, [])
