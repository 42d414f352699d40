"""The network's gradient against differences, its windows against a loop over words, and held-out accuracy."""

import math
import random
import zlib

import duckdb
import numpy as np
import pytest

from tessera.llm import queries, toxicity as tox

SF = "/root/testdata/sf0.01"


def model(words, dtype=np.float32):
    table = tox.read_words(words)
    net = tox.Network(np.unique(table.key)[::2])
    for k in net.p:
        net.p[k] = net.p[k].astype(dtype)
    return net


def slow_logit(net, words):
    """One window, word by word."""
    p, sig = net.p, lambda x: 1 / (1 + np.exp(-x))
    if not words:
        return float(p["c"][0])
    xs = []
    for w in words:
        t = tox.read_words([w])
        at = np.searchsorted(net.known, t.key[0])
        known = at < len(net.known) and net.known[at] == t.key[0]
        xs.append(np.concatenate([p["word"][at + 1 if known else 0], p["char"][t.bucket].mean(0)]))
    states = []
    for k, seq in ((0, xs), (1, xs[::-1])):
        h, out, n = np.zeros(tox.HIDDEN), [], tox.HIDDEN
        for x in seq:
            g, u = x @ p["wx"][k] + p["b"][k], h @ p["u"][k]
            z, r = sig(g[:n] + u[:n]), sig(g[n:2 * n] + u[n:2 * n])
            new = np.tanh(g[2 * n:] + r * u[2 * n:])
            h = (1 - z) * new + z * h
            out.append(h)
        states.append(out if k == 0 else out[::-1])
    both = np.concatenate([np.array(states[0]), np.array(states[1])], 1)
    e = np.exp(np.tanh(both @ p["wa"] + p["ba"]) @ p["v"])
    return float((e / e.sum()) @ both @ p["w"] + p["c"][0])


def test_windows_cover_every_word():
    for n in (0, 1, 31, 32, 33, 56, 57, 1000):
        text, first, size = tox.windows(np.array([5, 5 + n]))
        assert set(range(5, 5 + n)) == {i for f, s in zip(first, size) for i in range(f, f + s)}
        assert all(f == 5 + tox.STRIDE * i for i, f in enumerate(first)) and max(size) <= tox.WINDOW and len(first) >= 1


def test_scores_equal_a_loop_over_windows():
    rnd = random.Random(1)
    texts = [" ".join(rnd.choice(["Idiot!", "the", "cat", "É", "x1", "zu###"]) for _ in range(n)).encode() for n in (0, 1, 5, 32, 33, 200)]
    net = model([w for t in texts for w in tox.split_words(t)], np.float64)
    got = net.scores(texts, tox.Memory())
    for t, p in zip(texts, got, strict=True):
        words = tox.split_words(t)
        _, first, size = tox.windows(np.array([0, len(words)]))
        best = max(slow_logit(net, words[f:f + s]) for f, s in zip(first, size, strict=True))
        assert p == pytest.approx(1 / (1 + math.exp(-best)), abs=1e-5)


def test_long_texts_in_parts_and_forgetful_memory(monkeypatch):
    rnd = random.Random(2)
    words = [f"w{rnd.randrange(500)}".encode() for _ in range(3000)]
    text = b" ".join(words)
    net = model(words)
    monkeypatch.setattr(tox, "PART", 2000)
    parts = [p.split() for p in tox._parts(text)]
    assert len(parts) > 3 and b" ".join(parts[0] + [w for p in parts[1:] for w in p[tox.WINDOW:]]) == text
    assert all(a[-tox.WINDOW:] == b[:tox.WINDOW] for a, b in zip(parts, parts[1:], strict=False))
    whole = net.scores([text, b"", words[0]], tox.Memory())
    monkeypatch.setattr(tox, "REMEMBERED", 3)
    memory = tox.Memory()
    assert np.allclose([net.scores([t], memory)[0] for t in (text, b"", words[0])], whole)


def test_gradient_equals_differences():
    rnd = np.random.default_rng(0)
    split = [[b"you", b"are", b"an", b"idiot"], [b"cat"], [], [b"one", b"two", b"three", b"four"] * 12]
    table = list(dict.fromkeys(w for ws in split for w in ws))
    rows = np.array([table.index(w) for ws in split for w in ws])
    words, net = tox.read_words(table), model(table, np.float64)
    _, first, size = tox.windows(np.cumsum([0, *map(len, split)]))
    weight = rnd.standard_normal(len(first))
    grad = net.gradient(words, rows, first, size, lambda logit: weight)
    value = lambda: float(weight @ net.logits(net.gates(net.inputs(words)), rows, first, size))
    for name, p in net.p.items():
        flat, g = p.reshape(-1), grad[name].reshape(-1)
        for i in np.argsort(-np.abs(g))[:4]:
            old, e = flat[i], 1e-4
            flat[i] = old + e
            up = value()
            flat[i] = old - e
            down = value()
            flat[i] = old
            assert (up - down) / (2 * e) == pytest.approx(g[i], rel=1e-3, abs=1e-5)


def test_held_out_accuracy_and_contract(spark):
    got = queries.QUERIES["op12_toxicity"](spark, SF).collect()
    docs = dict(duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{SF}/documents.parquet'").fetchall())
    label = dict(duckdb.sql(f"SELECT doc_id, toxic FROM '{SF}/labels.parquet'").fetchall())
    assert sorted(r["doc_id"] for r in got) == sorted(docs)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    held = [(r["score"], label[r["doc_id"]]) for r in got if r["held_out"] and r["doc_id"] in label]
    assert sum((s >= 0.5) == y for s, y in held) >= 0.88 * len(held)
    yes, no = [s for s, y in held if y], [s for s, y in held if not y]
    assert sum(a > b for a in yes for b in no) >= 0.75 * len(yes) * len(no)


def test_edges(spark):
    from pyspark.sql import functions as F
    rnd = random.Random(4)
    plain = lambda: " ".join(rnd.choice("la le lo lu li da de do".split()) for _ in range(40))
    rows = [(i, plain() + (" vile scum " if i % 3 == 0 else " ") + plain()) for i in range(300)]
    rows += [(1000, None), (1001, ""), (1002, "x" * 300_000), (None, "vile scum"), (1003, plain() * 400 + " vile scum"), (7, "vile"), (7, "vile")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(300)] + [(None, 1), (5, None), (7, 0)], "doc_id long, toxic int")
    clash = docs.select("*", *[F.lit("x").alias(c) for c in ("id", "score", "key", "y", "toxic")])
    got = tox.toxicity_scores(clash, marks.withColumn("text", F.lit("no"))).collect()
    assert len(got) == len(rows) and all(r["held_out"] is not None and 0 <= r["score"] <= 1 for r in got)
    score = {r["doc_id"]: r["score"] for r in got}
    held = [i for i in range(300) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all((score[i] >= 0.5) == (i % 3 == 0) for i in held) and score[1003] >= 0.5 and score[1000] == score[1001]
    none = marks.where("toxic = 0")
    base = pytest.approx(0.5 / (2 + tox_rows(docs, none)))
    assert all(r["score"] == base for r in tox.toxicity_scores(docs, none).collect())
    assert tox.toxicity_scores(docs.limit(0), marks).collect() == []
    assert {r["score"] for r in tox.toxicity_scores(docs, marks.limit(0)).collect()} == {0.25}


def tox_rows(docs, marks):
    held = [r["doc_id"] for r in marks.collect()]
    ids = [r["doc_id"] for r in docs.collect()]
    return sum(ids.count(i) for i in held if i is not None and zlib.crc32(str(i).encode()) % 5)
