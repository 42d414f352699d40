"""Ranked search against a brute force in whole numbers, and how much the bounds leave to rescore."""

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from tessera.llm import lexical_search as ls
from tessera.llm import queries

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=20):
    tf = [(d, Counter(split(t))) for d, t in docs]
    n = [sum(c.values()) for _, c in tf]
    n_docs, n_terms = sum(x > 0 for x in n), sum(n)
    df = Counter(t for _, c in tf for t in c)
    w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for t, x in df.items()}
    out = []
    for item, text in items:
        scores = []
        for (d, c), m in zip(tf, n, strict=True):
            m = 75 + 25 * m * n_docs // max(1, n_terms)
            s = sum(w[t] * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t in split(text) if t in c)
            if s > 0:
                scores.append((-s, d))
        out += [(item, r, d, -s) for r, (s, d) in enumerate(sorted(scores)[:k], 1)]
    return out


def words(rnd, n, size=400):
    return " ".join(f"w{min(int(rnd.expovariate(0.02)), size)}" for _ in range(n))


def run(spark, docs, items, k=20):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame(items, "item_id long, text string")
    return sorted(map(tuple, ls.ranked_search(d, i, k).collect()), key=lambda r: (r[0], r[1]))


def test_terms_cover_whole_texts_in_chunks():
    text = "Ab1-cD é\x85ß_x" * 50 + " " + "z" * 300
    assert [t.decode() for part in ls.terms(text.encode(), 64) for t in part] == split(text)
    assert list(ls.terms(b"")) == []


@pytest.mark.parametrize("bucket", [16, 4096])
def test_equals_brute_force(spark, monkeypatch, bucket):
    monkeypatch.setattr(ls, "BUCKET", bucket)
    monkeypatch.setattr(ls, "SEED", 40)
    rnd = random.Random(bucket)
    docs = [(i, words(rnd, rnd.choice([0, 1, 5, 40, 300]))) for i in range(400)]
    docs += [(1000 + i, docs[7][1]) for i in range(60)]  # ties beyond k
    docs += [(2000, None), (2001, ""), (2002, "É é ÉÀ ß 中文 W1"), (2003, words(rnd, 30_000)), (-3, "w1 w2 W3")]
    items = [(i, words(rnd, rnd.choice([1, 4, 30]))) for i in range(25)]
    items += [(100, None), (101, ""), (102, "nothing here"), (103, "w1 w1 W1 é"), (104, docs[7][1])]
    assert run(spark, docs, items) == brute(docs, items)


def test_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(ls, "ITEM_CHARS", 40)
    rnd = random.Random(3)
    docs = [(i, words(rnd, 20)) for i in range(50)]
    items = [(i, words(rnd, 5)) for i in range(12)]
    assert run(spark, docs, items, 3) == brute(docs, items, 3)


def test_null_and_repeated_ids_and_empty_tables(spark):
    from pyspark.sql import functions as F
    docs = [(None, "alpha beta"), (5, "alpha"), (5, "alpha alpha"), (6, "gamma")]
    items = [(1, "alpha"), (1, "alpha"), (None, "gamma")]
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    clash = [F.lit(1).alias(c) for c in ("id", "rid", "rank", "score", "n", "term", "item")]
    got = ls.ranked_search(d.select("*", *clash), i.select("*", *clash)).collect()
    assert sorted((r["item_id"] or 0, r["rank"], r["doc_id"] or 0) for r in got) == sorted(
        [(0, 1, 6)] + 2 * [(1, 1, 5), (1, 2, 5), (1, 3, 0)])
    assert run(spark, [], items) == [] and run(spark, docs, []) == []


def test_buckets_are_pruned():
    """Buckets and documents that cannot reach the threshold are not scored."""
    rnd = np.random.default_rng(5)
    n, v = 2000, 300
    term = np.concatenate([np.sort(rnd.choice(v, 20, replace=False)) for _ in range(n)])
    impact = rnd.integers(1, 1000, len(term)) * np.repeat(np.where(np.arange(n) < 100, 1000, 10), 20)
    ends, weight = np.arange(n + 1) * 20, rnd.integers(1, 5000, v)
    items = [(np.sort(rnd.choice(v, 8, replace=False)), np.ones(8, np.int64)) for _ in range(30)]
    norm = np.sqrt(np.add.reduceat((weight[term] * impact).astype(float) ** 2, ends[:-1]))
    order = np.argsort(-norm)
    best, left = ls.Best(5, [0] * 30), Counter()
    for rows in np.array_split(order, 20):
        cells = (ends[rows][:, None] + np.arange(20)).ravel()
        left += ls.search_bucket(items, weight, best, rows, norm[rows], np.arange(len(rows) + 1) * 20, term[cells], impact[cells])
    for i, (ids, _) in enumerate(items):
        w = np.zeros(v, np.int64)
        w[ids] = weight[ids]
        score = np.add.reduceat(w[term] * impact, ends[:-1])
        assert best.score[i].tolist() == sorted(score.tolist())[::-1][:5]
    assert left["buckets"] < 30 * 20 / 2 and left["documents"] < 30 * n / 10


def test_query_equals_sql_on_odd_rows(spark, tmp_path):
    rnd = random.Random(9)
    docs = [(i, words(rnd, 25) + rnd.choice([" É", " x_y", ""])) for i in range(80)] + [(99, None), (98, "...")]
    items = [(1, "w1 É w2"), (2, "x Y"), (3, None)]
    for name, key, rows in (("documents", "doc_id", docs), ("benchmark", "item_id", items)):
        spark.createDataFrame(rows, f"{key} long, text string").write.parquet(str(tmp_path / f"{name}.parquet"))
        duckdb.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    want = duckdb.sql(queries.ORACLES["op11_ranked_search"])
    got = queries.QUERIES["op11_ranked_search"](spark, str(tmp_path)).select(*want.columns).collect()
    assert sorted(map(tuple, got)) == sorted(want.fetchall())
