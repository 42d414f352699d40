"""Hot keys: one key holds a third of all rows. Results are checked against a
brute-force computation, and plans are checked for map-side pre-aggregation."""

import contextlib
import datetime as dt
import io
import random

from pyspark.sql import functions as F

from tessera.operators import dq
from tessera.operators import merge as MG
from tessera.operators import windows as W


def _rows(n=3000, seed=7):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        key = 0 if i % 3 == 0 else rnd.randint(1, 200)
        day = dt.date(2020, 1, 1) + dt.timedelta(days=rnd.randint(0, 700))
        out.append((key, day, i, rnd.choice("abc")))
    return out


def test_keep_one_hot_key_matches_brute_force(spark):
    rows = _rows()
    df = spark.createDataFrame(rows, "k int, d date, i int, s string")
    got = {r.k: (r.d, r.i) for r in W.keep_one(df, ["k"], W.desc_nulls_last(F.col("d"), "date") + [F.col("i")],
                                                ["d", "i"]).collect()}
    best = {}
    for k, d, i, _ in rows:
        cand = (-d.toordinal(), i)
        if k not in best or cand < best[k][0]:
            best[k] = (cand, (d, i))
    assert got == {k: v[1] for k, v in best.items()}


def test_keep_one_plans_partial_aggregation(spark):
    df = spark.createDataFrame(_rows(50), "k int, d date, i int, s string")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        W.keep_one(df, ["k"], [F.col("i")], ["i"]).explain()
    plan = buf.getvalue()
    assert "partial_min" in plan and plan.index("partial_min") > plan.index("Exchange")  # partial below the shuffle


def test_scd2_null_keys_are_one_key(spark):
    rows = [(None, dt.date(2020, m, 1), "x") for m in (1, 2, 3)]
    h = MG.scd2(spark.createDataFrame(rows, "k int, d date, v string"), ["k"], ["d"], ["v"], "d").collect()
    assert [(r.k, r.v, r._effective_from, r._is_current) for r in h] == [(None, "x", dt.date(2020, 1, 1), True)]


def test_range_lookup_with_many_bands(spark):
    from tessera.operators import joins as J
    bands = spark.range(30000).selectExpr("id * 10 AS lo", "id * 10 + 6 AS hi", "id AS band").unionByName(
        spark.createDataFrame([(5, 900, -1)], "lo long, hi long, band long"))
    out = J.range_lookup(spark.createDataFrame([(3,), (8,), (299995,), (299999,), (None,)], "x long"), F.col("x"), bands, "lo", "hi", ["band"])
    assert sorted(((r.x or -9, r.band) for r in out.collect()), key=str) == sorted([(-9, None), (299995, 29999), (299999, None), (3, 0), (8, -1)], key=str)


def test_scd2_hot_key_matches_brute_force(spark):
    rows = _rows()
    df = spark.createDataFrame(rows, "k int, d date, i int, s string")
    _check_scd2(MG.scd2(df, ["k"], ["d", "i"], ["s"], "d"), rows)
    _check_scd2(MG.scd2(df, ["k"], ["d", "i"], ["s"], "d", bucket=F.year("d")), rows)


def _check_scd2(h, rows):
    def key(t):
        return (t[0], t[1], t[2] or dt.date.max, t[3], t[4])

    got = sorted(((r.k, r._effective_from, r._effective_to, r.s, r._change_type) for r in h.collect()), key=key)
    expect = []
    by_key = {}
    for k, d, i, s in rows:
        by_key.setdefault(k, []).append((d, i, s))
    for k, snaps in by_key.items():
        snaps.sort()
        versions = []
        for d, i, s in snaps:
            if not versions or versions[-1][2] != s:
                versions.append((d, i, s))
        for j, (d, i, s) in enumerate(versions):
            nxt = versions[j + 1][0] if j + 1 < len(versions) else None
            expect.append((k, d, nxt, s, "insert" if j == 0 else "update"))
    assert got == sorted(expect, key=key)


def test_foreign_key_hot_orphan(spark):
    child = spark.createDataFrame([(0,)] * 1000 + [(k,) for k in range(1, 2001)], "k int")
    parent = spark.createDataFrame([(k,) for k in range(1, 1001)], "k int")
    r = dq.foreign_key(child, "k", parent, "k", table_name="c", check_name="fk").first()
    assert (r.failing, r.total) == (2000, 3000)
    assert r.details == '{"orphan_key_values":1001}'
