"""Every registered query against its independent SQL statement (DuckDB) on the
smallest driver tables: row count, column names and the order-free multiset of rows."""

import contextlib
import io
import math

import duckdb
import pytest

import __spark_entry__ as entry_mod
from tessera.plans.registry import load_all
from tessera.sources.tables import TABLES

SF = "/root/testdata/sf0.001"
QUERIES = {k: f for k, f in entry_mod.queries().items() if k in load_all()}
ORACLES = entry_mod.oracle_sql()


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    if isinstance(v, float):
        return f"{round(v, 6):.6f}"
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return str(v)


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    yield con
    con.close()


def test_every_query_has_an_oracle():
    missing = sorted(set(QUERIES) - set(ORACLES))
    assert not missing, missing


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, key):
    df = QUERIES[key](spark, SF)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    plan = buf.getvalue()
    assert "CartesianProduct" not in plan  # no cross joins
    assert "BatchEvalPython" not in plan  # no row-at-a-time Python UDFs
    srows = df.collect()
    cur = duck.execute(ORACLES[key])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert _canon(df.columns, [tuple(r) for r in srows]) == _canon(dcols, drows)


@pytest.mark.parametrize("key", ["weather_like_daily", "dq_freshness", "stream_tumbling", "dedupe_latest",
                                 "calendar_dim", "safe_date_parse", "temporal_coverage"])
def test_results_do_not_depend_on_session_time_zone(spark, duck, key):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = QUERIES[key](spark, SF)
        srows = [tuple(r) for r in df.collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    cur = duck.execute(ORACLES[key])
    dcols = [d[0] for d in cur.description]
    assert _canon(df.columns, srows) == _canon(dcols, cur.fetchall())
