"""Conversation repair against a brute force that tries every edit, with blocks and groups of a few messages."""

import hashlib
import random
from collections import defaultdict
from functools import lru_cache

import duckdb
import pytest

from tessera.llm import conversation_repair as cr
from tessera.llm import queries

WS = " \t\n\x0b\x0c\r"


def brute(rows):
    """rows: (conv, turn, role, text) -> {conv: (gaps, blank, duplicate, truncated, illegal, cost, audit, sha)}"""
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        groups[conv].append((turn is not None, turn or 0, " " if role is None else role, " " if text is None else text))
    out = {}
    for conv, msgs in groups.items():
        msgs.sort(key=lambda m: (m[0], m[1], m[2].encode(), m[3].encode()))
        seen, faults = set(), []
        for _, _, role, text in msgs:
            rest = text.strip(WS)
            faults.append("blank" if not rest else "duplicate" if (role, text) in seen else "" if rest[-1] in ".!?" else "truncated")
            seen.add((role, text))
        step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}

        @lru_cache(None)
        def best(i, s, inserts, msgs=msgs, faults=faults):
            found = []
            if i == len(msgs):
                if s in (0, 3):
                    found.append((0, "", ()))
            else:
                role, text = msgs[i][2:]
                c, a, r = best(i + 1, s, 0)
                found.append((4 + c, "D" + a, r))
                more = 3 * (faults[i] == "truncated")
                if faults[i] in ("", "truncated"):
                    for name, x, y, base in ((role, role[:1], "K", 0), ("user", "u", "R", 3), ("assistant", "a", "R", 3)):
                        if (s, x) in step:
                            c, a, r = best(i + 1, step[s, x], 0)
                            found.append((base + more + c, y + a, (f"{name}:{text}", *r)))
            if inserts < 3:
                for name in ("user", "assistant"):
                    if (s, name[0]) in step:
                        c, a, r = best(i, step[s, name[0]], inserts + 1)
                        found.append((3 + c, "I" + a, (f"{name}:", *r)))
            return min(found) if found else (10**9, "", ())

        cost, audit, lines = best(0, 0, 0)
        turns = [m[1] for m in msgs if m[0]]
        initials = [m[2][:1] for m in msgs]
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("blank"), faults.count("duplicate"),
                     faults.count("truncated"), sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
                     cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def report(df, **kw):
    rows = cr.repair_report(cr.repair_conversations(df, **kw)).collect()
    got = {r[0]: tuple(r[1:]) for r in rows}
    assert len(got) == len(rows)
    return got


SCHEMA = "conv_id long, turn long, role string, text string"
WORDS = ["Yes.", "no", "Why?", "", " \n", "go on", "Stop! ", "ok.\t"]


@pytest.mark.parametrize("block,fan", [(512, 512), (3, 4)])
def test_repair_equals_brute_force(spark, block, fan):
    rnd = random.Random(block)
    rows = []
    for conv in [None, *range(40)]:
        for _ in range(rnd.choice([1, 2, 3, 5, 8, 30])):
            turn = rnd.choice([None, 0, *range(12)])
            rows.append((conv, turn, rnd.choice(["user", "assistant", "system", "user", "assistant", None, "tool", "", "speaker"]),
                         rnd.choice([*WORDS, None, f"m{rnd.random()}."])))
    for i in range(300):  # a dialogue that holds most rows, with many equal messages of one turn
        rows.append((99, i % 40 or None, ["user", "assistant"][i % 2], ["again.", f"t{i}.", f"t{i}"][i % 3]))
    rows += [(99, 7, "user", "again.")] * 60
    rnd.shuffle(rows)
    assert report(spark.createDataFrame(rows, SCHEMA), block=block, fan=fan) == brute(rows)


def test_blocks_return_whole_texts(spark):
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", f"text {i}.") for i in range(41)]
    blocks = cr.repair_conversations(spark.createDataFrame(rows, SCHEMA), block=4, fan=3).orderBy("part").collect()
    assert len(blocks) >= 11 and all(b["n"] <= 4 for b in blocks)
    text = "\n".join(b["repaired"] for b in blocks if b["repaired"])
    assert text.split("\n") == [f"{r}:{t}" for _, _, r, t in rows] + ["assistant:"]
    assert "".join(b["audit"] for b in blocks) == "K" * 41 + "I" and sum(b["cost"] for b in blocks) == 3


def test_empty_table_and_clashing_columns(spark):
    from pyspark.sql import functions as F
    empty = spark.createDataFrame([], SCHEMA)
    assert report(empty) == {}
    rows = [(1, 0, "user", "Hi."), (1, 1, "assistant", "x" * 3_000_000), (1, 2, "user", "Hi.")]
    odd = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit(1).alias(c) for c in ("conv", "key", "n", "first", "blk", "cost", "part", "kids")])
    assert report(odd) == brute(rows)
    named = spark.createDataFrame([("a", 1, "user", "Hi.")], "c string, t int, r string, x string")
    got = cr.repair_report(cr.repair_conversations(named, "c", "t", "r", "x"), "c").collect()
    assert [(r["c"], r["audit"], r["cost"]) for r in got] == [("a", "KI", 3)]


def test_damage_and_query_equal_sql(spark, tmp_path):
    rows = [(c, t, r, x) for c in (*range(60), None) for t, r, x in [(0, "system", "Be. Good!"), (1, "user", "Hi."), (2, None, "So?"), (None, "user", None), (4, "assistant", "Yes.")]]
    rows += [(1000, 0, "user", "Hi."), (1000, 0, "user", "Hi.")]
    path = str(tmp_path / "conversations.parquet")
    spark.createDataFrame(rows, SCHEMA).write.parquet(path)
    duckdb.sql(f"CREATE OR REPLACE VIEW conversations AS SELECT * FROM '{path}/*.parquet'")
    want = duckdb.sql(queries.ORACLES["op13_conversation_repair"])
    got = queries.QUERIES["op13_conversation_repair"](spark, str(tmp_path)).select(*want.columns).collect()
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(map(tuple, got), key=key) == sorted(want.fetchall(), key=key)
    damaged = brute([tuple(r) for r in cr.damage(spark.createDataFrame(rows, SCHEMA)).collect()])
    assert {r[0]: tuple(r[1:]) for r in got if r["audit"]} == {k: v for k, v in damaged.items() if v[6]}
