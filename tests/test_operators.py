"""Operators on hand-made rows: keep-one, merges, hierarchy walks, crosswalks, DQ."""

import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.operators import crosswalk as XW
from tessera.operators import dq
from tessera.operators import hierarchy as H
from tessera.operators import merge as MG
from tessera.operators import windows as W
from tessera.session import shared_path
from tessera.sources import lake
from tessera.sources import text as TX


def test_keep_latest_nulls_last_ties_keep_earlier(spark):
    import datetime as dt
    rows = [("a", dt.date(2024, 1, 1), 1), ("a", dt.date(2024, 2, 1), 2), ("a", dt.date(2024, 2, 1), 3),
            ("b", None, 1), ("b", dt.date(2023, 1, 1), 2), ("c", None, 5)]
    df = spark.createDataFrame(rows, "k string, d date, ord int")
    out = W.keep_one(df, ["k"], W.desc_nulls_last(F.col("d"), "date") + [F.col("ord")], ["d", "ord"])
    got = {r.k: r.ord for r in out.collect()}
    assert got == {"a": 2, "b": 2, "c": 5}


def test_keep_first_with_dropped(spark):
    df = spark.createDataFrame([("x", 3), ("x", 1), ("y", 2)], "k string, o int")
    got = {r.k: (r.o, r.n_dropped) for r in W.keep_one_with_dropped(df, ["k"], [F.col("o")], ["o"]).collect()}
    assert got == {"x": (1, 1), "y": (2, 0)}


def test_flag_first_one_primary_per_unit(spark):
    df = spark.createDataFrame([(1, 10, 5.0), (1, 11, 5.0), (1, 12, None), (2, 20, None)], "u int, c int, a double")
    out = W.flag_first(df, ["u"], W.desc_nulls_last(F.col("a")) + [F.col("c")], ["c"])
    prim = {(r.u, r.c) for r in out.filter("is_primary").collect()}
    assert prim == {(1, 10), (2, 20)} and out.count() == 4


def test_upsert_semantics(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    s = spark.createDataFrame([(2, "B"), (3, "C"), (None, "N")], "k int, v string")
    got = sorted((r.k if r.k is not None else -1, r.v) for r in MG.upsert(t, s, ["k"]).collect())
    assert got == [(-1, "N"), (-1, "n"), (1, "a"), (2, "B"), (3, "C")]


def test_upsert_rejects_duplicate_source_keys(spark):
    t = spark.createDataFrame([(1, "a")], "k int, v string")
    s = spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string")
    with pytest.raises(MG.MergeConflict):
        MG.upsert(t, s, ["k"])


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 9)), min_size=1, max_size=12, unique_by=lambda r: r[0]))
def test_upsert_idempotent(spark, src_rows):
    t = spark.createDataFrame([(i, 100 + i) for i in range(4)], "k int, v int")
    s = spark.createDataFrame(src_rows, "k int, v int")
    once = MG.upsert(t, s, ["k"])
    twice = MG.upsert(once, s, ["k"])
    assert sorted(once.collect()) == sorted(twice.collect())


def test_upsert_columns_keeps_unlisted(spark):
    t = spark.createDataFrame([(1, "a", "keep", None)], "k int, s string, other string, stamp string")
    s = spark.createDataFrame([(1, "A"), (2, "B")], "k int, s string")
    out = {r.k: r for r in MG.upsert_columns(t, s, ["k"], ["s"], "stamp", F.lit("run1")).collect()}
    assert (out[1].s, out[1].other, out[1].stamp) == ("A", "keep", "run1")
    assert (out[2].s, out[2].other, out[2].stamp) == ("B", None, "run1")


def test_scd2_and_as_of(spark):
    import datetime as dt
    snaps = [(1, dt.date(2020, 1, 1), "x"), (1, dt.date(2020, 2, 1), "x"), (1, dt.date(2020, 3, 1), "y"),
             (2, dt.date(2020, 1, 5), "z")]
    df = spark.createDataFrame(snaps, "k int, d date, v string")
    h = MG.scd2(df, ["k"], ["d"], ["v"], "d")
    rows = sorted((r.k, r.v, r._effective_from, r._effective_to, r._is_current, r._change_type) for r in h.collect())
    assert rows == [(1, "x", dt.date(2020, 1, 1), dt.date(2020, 3, 1), False, "insert"),
                    (1, "y", dt.date(2020, 3, 1), None, True, "update"),
                    (2, "z", dt.date(2020, 1, 5), None, True, "insert")]
    at = {r.k: r.v for r in MG.as_of(h, F.lit(dt.date(2020, 2, 15))).collect()}
    assert at == {1: "x", 2: "z"}


def test_version_key_orders_numerically(spark):
    df = spark.createDataFrame([("1.9",), ("1.11",), ("1.10",)], "r string")
    assert df.agg(F.max_by("r", MG.version_key(F.col("r")))).first()[0] == "1.11"


def test_prefix_ancestors_and_leaves(spark):
    codes = spark.createDataFrame([("A00",), ("A00.0",), ("A00.01",), ("B1",), ("A0",)], "code string")
    anc = {r.code: (r.ancestors, r.parent, r.depth) for r in H.prefix_ancestors(codes).collect()}
    assert anc["A00.01"] == (["A0", "A00", "A00.0"], "A00.0", 3)
    assert anc["B1"] == ([], None, 0)
    leaves = {r.code: r.is_leaf for r in H.leaf_flags(codes).collect()}
    assert leaves == {"A00": False, "A00.0": False, "A00.01": True, "B1": True, "A0": False}


def test_tree_first_with_fallback(spark):
    codes = spark.createDataFrame([("S72",), ("S72.0",), ("S72.001",), ("S72.001A",), ("T1",)], "code string")
    tree = spark.createDataFrame([("S72.001", "S72.0"), ("S72.0", "S72"), ("S72", None)], "child string, parent string")
    p = {r.code: r.ancestors for r in H.tree_first_paths(codes, tree, 10).collect()}
    assert p["S72.001"] == ["S72", "S72.0"]
    assert p["S72.001A"] == ["S72", "S72.0", "S72.001"]  # anchored on the nearest existing prefix
    assert p["T1"] == []


def test_tree_walk_detects_cycle(spark):
    codes = spark.createDataFrame([("a",), ("b",)], "code string")
    tree = spark.createDataFrame([("a", "b"), ("b", "a")], "child string, parent string")
    with pytest.raises(ValueError):
        H.tree_first_paths(codes, tree, 4).collect()


def test_crosswalk_unpivot_case_insensitive_and_nan(spark):
    wide = spark.createDataFrame([("s1", "t1", 0.5, float("nan"), "x"), ("s1", "t2", 0.5, 1.0, "0.3")],
                                 "src string, tgt string, WT_POP double, wt_hu double, wt_area string")
    long = XW.unpivot_weights(wide, ["src", "tgt"], ["wt_pop", "wt_hu", "wt_area", "wt_absent"])
    got = sorted((r.tgt, r.weight_kind, r.weight) for r in long.collect())
    assert got == [("t1", "wt_pop", 0.5), ("t2", "wt_area", 0.3), ("t2", "wt_hu", 1.0), ("t2", "wt_pop", 0.5)]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.floats(0.1, 100.0), min_size=1, max_size=6))
def test_allocation_conserves_total(spark, shares):
    total = sum(shares)
    xw = spark.createDataFrame([("s", f"t{i}", v / total) for i, v in enumerate(shares)],
                               "source string, target string, weight double")
    vals = spark.createDataFrame([("s", 1000.0)], "k string, v double")
    out = XW.allocate(vals, "k", "v", xw, "source", "target").agg(F.sum("allocated")).first()[0]
    assert math.isclose(out, 1000.0, rel_tol=1e-9)
    sums = XW.weight_sums(xw.withColumn("weight_kind", F.lit("k")), "source", ["k"]).first()
    assert sums.n_bad == 0 and sums.bad_sample is None


def test_dq_results_shape(spark):
    df = spark.createDataFrame([(1, None), (1, 2), (2, 3)], "k int, v int")
    u = dq.unique(df, ["k"], table_name="t", check_name="u").first()
    assert (u.passed, u.failing, u.total, u.rate) == (False, 1, 3, round(1 / 3, 6))
    assert u.details == '{"duplicate_key_groups":1,"keys":["k"]}'
    rc = {r.check_name: r for r in dq.row_checks(df, "t", [dq.not_null(["v"]), dq.in_range("v", 0, 2)]).collect()}
    assert rc["not_null_v"].failing == 1 and rc["range_v"].failing == 1 and rc["range_v"].passed is False
    empty = dq.row_checks(df.limit(0), "t", [dq.not_null(["v"])]).first()
    assert empty.rate is None and empty.passed and empty.details is None
    with pytest.raises(dq.DQFailure):
        dq.raise_if_blocking(dq.union_results([dq.unique(df, ["k"], table_name="t", check_name="u")]))
    with pytest.raises(ValueError):
        dq.RowCheck("x", "nope", F.lit(True)) and dq.row_checks(df, "t", [dq.RowCheck("x", "nope", F.lit(True))])


def test_replace_vintage_rejects_and_is_idempotent(spark):
    from pyspark.sql import types as T
    path = shared_path(spark, "test_vintage")
    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("vintage", T.StringType())])
    df = spark.createDataFrame([(1, "2.80"), (2, "2.9"), (3, "01")], schema)
    lake.write_partitioned(df, path, "vintage")
    with pytest.raises(ValueError):
        lake.replace_vintage(df, path, "vintage", "2.9")
    new = spark.createDataFrame([(20, "2.9")], schema)
    for _ in range(2):
        lake.replace_vintage(new, path, "vintage", "2.9")
    back = sorted(tuple(r) for r in lake.read_table(spark, path, schema).collect())
    assert back == [(1, "2.80"), (3, "01"), (20, "2.9")]  # typed read keeps "2.80" and "01"


def test_text_parsers(spark):
    lines = spark.createDataFrame([("a|b|c|",), ("x|y",)], "value string")
    got = TX.positional_split(lines, {"f0": 0, "f2": 2}, min_fields=3).collect()
    assert [(r.f0, r.f2) for r in got] == [("a", "c")]
    titles = spark.createDataFrame([("00.01 First title ",), ("PROCEDURES",), ("Note: x",), ("47 Other",)], "value string")
    assert sorted(tuple(r) for r in TX.code_title(titles, r"\d{2}(?:\.\d{1,2})?").collect()) == [
        ("00.01", "First title"), ("47", "Other")]
    html = spark.createDataFrame([('<a href="a.csv?x=1">a</a><a href="../">up</a><a href="b.csv">b</a><a href="a.csv">',)],
                                 "html string")
    assert html.select(TX.extract_links(F.col("html"))).first()[0] == ["a.csv", "b.csv"]
    assert html.select(TX.listed_files(F.col("html"), ".csv")).first()[0] == ["b.csv", "a.csv"]


def test_carry_forward_resets(spark):
    rows = [(1, 1, "chapter"), (1, 2, "block"), (1, 3, "line"), (1, 4, "chapter"), (1, 5, "line"), (1, 6, "block"),
            (1, 7, "line")]
    df = spark.createDataFrame(rows, "f int, n int, kind string")
    for bucket in (100_000, 2, 1):  # buckets only split the work, never change the result
        out = TX.carry_forward(df, ["f"], "n", F.col("kind") == "block", F.col("kind") == "chapter", "hdr", bucket)
        got = {r.n: r.hdr for r in out.filter("kind = 'line'").collect()}
        assert got == {3: 2, 5: None, 7: 6}


def test_dq_recorder_flushes_on_failure_and_success(spark):
    log = shared_path(spark, "t_dqlog")
    df = spark.createDataFrame([(1,), (1,)], "k int")
    with pytest.raises(RuntimeError):
        with dq.ResultLog(log, "run1", "p") as rec:
            rec.record(dq.unique(df, ["k"], table_name="t", check_name="u"))
            raise RuntimeError("job failed after checks")
    with dq.ResultLog(log, "run2", "p") as rec:
        rec.record(dq.row_checks(df, "t", [dq.not_null(["k"])]))
        assert rec.waiting == 1
    got = sorted((r.run_id, r.check_name, r.passed) for r in spark.read.parquet(log).collect())
    assert got == [("run1", "u", False), ("run2", "not_null_k", True)]
    with pytest.raises(ValueError):
        dq.ResultLog(log, "r", "p").record(df)


def test_register_dataset_partial_columns(spark):
    from tessera.operators import catalog as CAT
    path = shared_path(spark, "t_catalog")
    CAT.register_dataset(spark, path, {"full_table_name": "geo.state", "update_semantics": "vintage_snapshot",
                                       "owner": "team", "description": "d1"}, ["update_semantics", "owner", "description"],
                         "2026-01-01")
    CAT.register_dataset(spark, path, {"full_table_name": "geo.state", "description": "d2"}, ["description"], "2026-02-01")
    r = lake.read_current(spark, path).first()
    assert (r.description, r.owner, r.update_semantics, r.refreshed_at) == ("d2", "team", "vintage_snapshot", "2026-02-01")
    with pytest.raises(ValueError):
        CAT.register_dataset(spark, path, {"full_table_name": "x", "update_semantics": "merge"}, ["update_semantics"], "s")
    with pytest.raises(ValueError):
        CAT.register_dataset(spark, path, {"full_table_name": "x", "tags": ["nope:v"]}, [], "s")


def test_guarded_view_and_snapshot_immutability(spark):
    from tessera.operators import catalog as CAT
    CAT.save_table(spark.range(3), "t_parent_a", shared_path(spark, "t_parent_a"))
    assert not CAT.create_join_view(spark, "t_join_v", ("t_parent_a", "t_parent_missing"), "SELECT 1")
    assert CAT.create_join_view(spark, "t_join_v", ("t_parent_a",), "SELECT id FROM t_parent_a")
    assert spark.table("t_join_v").count() == 3 and not spark.catalog.tableExists("t_parent_missing")
    df = spark.createDataFrame([(1, "2024-01-01")], "k int, snap string")
    assert lake.vintage_exists(df, "snap", "2024-01-01") and not lake.vintage_exists(df, "snap", "2024-02-01")
    assert CAT.add_missing_columns(df, {"extra": "string", "k": "int"}).columns == ["k", "snap", "extra"]


def test_upsert_self_derived_source(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    s = t.filter("k = 2").withColumn("v", F.lit("B"))  # same lineage as the target
    assert sorted(tuple(r) for r in MG.upsert(t, s, ["k"]).collect()) == [(1, "a"), (2, "B")]


def test_explode_alternates(spark):
    from tessera.operators import reshape as X
    df = spark.createDataFrame([("Georgia", "GA|Ga."), ("Ohio", None)], "name string, alt string")
    got = sorted(r.n for r in X.explode_alternates(df, "name", "alt", "|", "n").collect())
    assert got == ["GA", "Ga.", "Georgia", "Ohio"]


def test_tiered_match_admin_units(spark):
    from tessera.operators import matching as M
    refs = spark.createDataFrame([
        ("USA", "USA.1_1", "Georgia", "US.GA", "GA|Peach State"), ("USA", "USA.2_1", "Ohio", None, None),
        ("USA", "USA.3_1", "Springfield", None, None), ("USA", "USA.4_1", "Springfield ", None, None),
        ("FRA", "FRA.1_1", "Côte-d'Or", None, None), ("USA", "USA.5_1", "Texas", None, None)],
        "scope string, rid string, name string, hasc string, varnames string")
    names = M.name_index(refs, "scope", "rid",
                         F.concat(F.array("name"), F.coalesce(F.split("varnames", r"\|"), F.array().cast("array<string>"))))
    code_map = refs.filter(F.col("hasc").isNotNull()).select(F.regexp_replace("hasc", r"\.", "-").alias("code"), "rid")
    fix = spark.createDataFrame([("US-TX", "USA.5_1")], "code string, rid string")
    targets = spark.createDataFrame([("US-GA", "USA", "Georgia"), ("US-OH", "USA", "ohio"), ("US-SP", "USA", "Springfield"),
                                     ("FR-21", "FRA", "Cote d Or"), ("US-TX", "USA", "Tejas"), ("US-XX", "USA", "Nowhere"),
                                     ("FR-GA", "FRA", "Georgia")], "code string, scope string, name string")
    got = {r.code: (r.method, r.linked_rid) for r in M.tiered_match(targets, "code", "scope", "name", code_map, names,
                                                                    fix, "rid").collect()}
    assert got == {"US-GA": ("code", "USA.1_1"), "US-OH": ("name", "USA.2_1"), "US-SP": ("name_ambiguous", None),
                   "FR-21": ("name", "FRA.1_1"), "US-TX": ("fixup", "USA.5_1"), "US-XX": ("none", None),
                   "FR-GA": ("none", None)}  # names never match across countries


def test_publish_version_pointer(spark):
    base = shared_path(spark, "t_pub")
    assert lake.read_current(spark, base) is None
    p1 = lake.publish_version(spark, spark.range(3), base)
    p2 = lake.publish_version(spark, spark.range(5), base)
    assert p1 != p2 and lake.current_version(spark, base) == p2
    assert lake.read_current(spark, base).count() == 5 and spark.read.parquet(p1).count() == 3


def test_overlay_labels_and_added_count(spark):
    base = spark.createDataFrame([(1, "a", "base"), (2, "b", "base")], "k int, t string, src string")
    upd = spark.createDataFrame([(2, "B", "update"), (3, "C", "update")], "k int, t string, src string")
    assert sorted(tuple(r) for r in MG.overlay(base, upd, ["k"]).collect()) == [
        (1, "a", "base"), (2, "B", "update"), (3, "C", "update")]
    assert MG.overlay_added(base, upd, ["k"]).first().added == 1


def test_conform_distinct_returns_unconformed(spark):
    from tessera.operators import conform as K
    fact = spark.createDataFrame([(1, "01"), (2, "01"), (3, "7"), (4, "99")], "id int, code string")
    lookup = spark.createDataFrame([("01", "one"), ("99", "ninety-nine")], "c string, name string")

    def conform(codes):
        j = codes.join(lookup, codes["code"] == lookup["c"], "left")
        return j.select("code", F.when(F.col("code").rlike("^[0-9]{2}$"), F.col("name")).alias("name"))

    out = K.conform_distinct(fact, ["code"], conform, "name")
    assert sorted((r.id, r.name) for r in out.collect()) == [(1, "one"), (2, "one"), (3, None), (4, "ninety-nine")]
    assert [r.code for r in K.unconformed(out, ["code"], "name").collect()] == ["7"]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 9), st.one_of(st.none(), st.floats(0, 100))),
                min_size=1, max_size=25, unique_by=lambda r: (r[0], r[1])))
def test_exactly_one_primary_per_unit(spark, rows):
    df = spark.createDataFrame(rows, "u int, c int, a double")
    out = W.flag_first(df, ["u"], W.desc_nulls_last(F.col("a")) + [F.col("c")], ["c"]).collect()
    per_unit = {}
    for r in out:
        per_unit.setdefault(r.u, []).append(r)
    assert len(out) == len(rows)
    for u, rs in per_unit.items():
        prim = [r for r in rs if r.is_primary]
        assert len(prim) == 1
        best = min(rs, key=lambda r: (r.a is None, -(r.a or 0.0), r.c))
        assert prim[0].c == best.c


def test_publish_lifecycle(spark):
    from tessera.plans.publish import publish
    root = shared_path(spark, "t_lifecycle")
    events = []
    good = spark.createDataFrame([(1,), (2,)], "k int")
    bad = spark.createDataFrame([(1,), (1,)], "k int")

    def checks(df):
        return dq.unique(df, ["k"], table_name="t", check_name="u")

    assert publish(spark, good, checks, published=f"{root}/pub", dq_log=f"{root}/log",
                   run_id="r1", on_published=lambda p: events.append(("registered", p)))
    with pytest.raises(dq.DQFailure):
        publish(spark, bad, checks, published=f"{root}/pub", dq_log=f"{root}/log", run_id="r2",
                on_published=lambda p: events.append(("registered", p)))
    assert len(events) == 1  # the failed run never registered
    assert lake.read_current(spark, f"{root}/pub").count() == 2  # and never replaced the published version
    logged = sorted((r.run_id, r.passed) for r in spark.read.parquet(f"{root}/log").collect())
    assert logged == [("r1", True), ("r2", False)]  # DQ rows persisted on success and on failure
    assert publish(spark, good, checks, published=f"{root}/pub", dq_log=f"{root}/log", run_id="r2")  # a second try stands alone


def test_a_crash_between_data_and_pointer_keeps_the_published_version(spark):
    base = shared_path(spark, "t_crash")
    lake.publish_version(spark, spark.range(3), base)
    lake.write_version(spark, spark.range(9), base)  # and then the job dies
    assert lake.read_current(spark, base).count() == 3
    lake.publish_version(spark, spark.range(5), base)
    assert lake.read_current(spark, base).count() == 5


def test_subdivision_codes(spark):
    from tessera.functions import codes as C
    from tessera.operators import matching as M
    rows = [(1, "US.GA", "US-XX"), (2, None, " us-fl "), (3, " jp.01 ", ""), (4, "US.GAAA", None), (5, "U.GA", "USGA"), (6, "us.ga", None)]
    refs = spark.createDataFrame(rows, "rid int, hasc string, iso string")
    assert [r[0] for r in refs.orderBy("rid").select(C.subdivision_code("hasc", "iso")).collect()] == ["US-GA", "US-FL", "JP-01", None, None, "US-GA"]
    assert sorted(map(tuple, M.code_claims(refs, "hasc", "iso", "rid").collect())) == [("JP-01", 3), ("US-FL", 2), ("US-GA", 1)]
    linked = spark.createDataFrame([(1,), (None,)], "linked_rid int")
    assert sorted(r.rid for r in M.unmatched_ids(refs, linked, "rid").collect()) == [2, 3, 4, 5, 6]


def test_merge_partitions_touches_only_source_partitions(spark):
    import glob
    base = shared_path(spark, "t_merge_parts")
    path, local = f"{base}/table", f"{base}/table".replace("file:", "")
    upsert = lambda cur, src: MG.upsert(cur, src, ["k"])
    first = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (3, "c", 2)], "k int, v string, p int")
    lake.merge_partitions(spark, path, first, "p", upsert, f"{base}/_s0")
    before = sorted(glob.glob(f"{local}/p=1/*.parquet"))
    src = spark.createDataFrame([(2, "B", 2), (4, "d", 2)], "k int, v string, p int")
    for i in range(2):  # the replay of the same batch changes nothing
        lake.merge_partitions(spark, path, src, "p", upsert, f"{base}/_s1")
        got = sorted(tuple(r) for r in lake.read_table(spark, path, first.schema).collect())
        assert got == [(1, "a", 1), (2, "B", 2), (3, "c", 2), (4, "d", 2)]
    assert sorted(glob.glob(f"{local}/p=1/*.parquet")) == before  # untouched partition kept its files


def test_quarantine_tag_and_split(spark):
    from tessera.operators import quarantine as QX
    df = spark.createDataFrame([(1, 5.0, "a"), (2, 500.0, "b"), (3, 7.0, None), (4, 900.0, None)], "k int, v double, s string")
    tagged = QX.tag_reasons(df, [("too_big", F.col("v") > 400), ("no_label", F.col("s").isNull())])
    clean, bad = QX.split(tagged, F.lit("2026-01-01"))
    assert sorted(r.k for r in clean.collect()) == [1]
    assert sorted((r.k, r.reason, r.quarantined_at) for r in bad.collect()) == [
        (2, "too_big", "2026-01-01"), (3, "no_label", "2026-01-01"), (4, "too_big", "2026-01-01")]  # first rule wins
    assert clean.columns == ["k", "v", "s"]


def test_publish_refuses_schema_drift(spark):
    base = shared_path(spark, "t_drift")
    lake.publish_version(spark, spark.createDataFrame([(1, "a")], "k int, v string"), base)
    with pytest.raises(lake.SchemaDrift):
        lake.publish_version(spark, spark.createDataFrame([(1, 2)], "k int, v int"), base)
    lake.publish_version(spark, spark.createDataFrame([(1, 2)], "k int, v int"), base, allow_schema_change=True)
    assert lake.read_current(spark, base).schema.simpleString() == "struct<k:int,v:int>"
