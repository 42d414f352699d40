"""Every operator of the training-data package against brute force, the tokenizers library or SQL."""

import contextlib
import io
import os
import random

os.environ["TOKENIZERS_PARALLELISM"] = "false"

import brute
import duckdb
import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tessera.llm import (bpe, byte_bpe, chat_formatting, exact_dedup, lm_scoring, near_dedup, packing, quality_rules, queries, sharding,
                         substring_dedup, token_counts, word_bpe)
from tessera.llm.components import connected_components


SF = "/root/testdata/sf0.001"
WORD_BPE, BYTE_BPE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
LONG = " ".join(f"w{i % 97}x{i % 13}" for i in range(6000))
PASSAGE = " ".join(f"p{i}" for i in range(30))
COMMON = [f"c{i}" for i in range(40)]
#: Nulls, empty and blank texts, one very long text, copies, ties, odd characters; ids are unique.
EDGE = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "one two  three"), (6, "one two three"), (7, "onetwothree "),
        (8, LONG), (9, LONG), (10, PASSAGE), (11, "head " + PASSAGE + " tail"), (12, PASSAGE + " " + PASSAGE),
        (13, "x<|endoftext|>y <|startoftext|> ß É ÄÖ İΣς 中文字 é\x85\x1c　🎉" * 3), (14, "a" * 3000), (15, "THE Cat " * 30),
        (16, "line\nline\n\nline\n"), (17, "É" * 100 + " " + "é" * 100), (18, PASSAGE.upper()), (-5, PASSAGE)]
#: Names that the operators use inside.
CLASH = ["id", "rid", "h", "g", "sha", "rn", "n", "key", "block", "shard", "c", "w", "kept", "row", "m", "part", "Text2", "sketch"]


@pytest.fixture(scope="module")
def edge(spark):
    from pyspark.sql import functions as F
    return spark.createDataFrame(EDGE, "doc_id long, text string").select("doc_id", "text", *[F.lit(i).alias(c) for i, c in enumerate(CLASH)])


@pytest.fixture(scope="module")
def odd(spark):
    """Null and repeated ids, equal rows."""
    rows = [(None, PASSAGE), (None, None), (None, PASSAGE), (7, PASSAGE), (7, PASSAGE), (7, "other"), (1, "one two three four five six")]
    return spark.createDataFrame(rows, "doc_id long, text string")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, id string")


@pytest.fixture(scope="module")
def documents():
    return duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()


def got(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


OPERATORS = {
    "exact": exact_dedup.exact_dedup,
    "substring": substring_dedup.substring_dedup,
    "shards": lambda d: sharding.rendezvous_shards(d, queries.SHARDS, queries.GROWN),
    "lm": lm_scoring.score_documents,
    "counts": lambda d: token_counts.token_counts(d, WORD_BPE),
    "quality": lambda d: quality_rules.apply_policy(quality_rules.quality_ledger(d), "v2"),
    "bpe": lambda d: byte_bpe.round_trip(d, BYTE_BPE),
    "ids": lambda d: byte_bpe.encode_texts(d, BYTE_BPE),
    "packing": lambda d: packing.pack_documents(d, WORD_BPE),
    "near": near_dedup.near_dedup,
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty_and_odd_tables(spark, empty, odd, edge, name):
    run = OPERATORS[name]
    none = run(empty)
    assert none.collect() == [] and none.columns[0] == "doc_id"
    rows = run(odd).collect()
    assert len(rows) == 7 and sorted((r.doc_id is None, r.doc_id or 0) for r in rows) == [(False, 1)] + [(False, 7)] * 3 + [(True, 0)] * 3
    out = run(edge).collect()
    assert {r.doc_id for r in out} == {i for i, _ in EDGE}
    assert len(out) == len(EDGE) + (name == "packing") * sum(r.piece > 0 for r in out if name == "packing")


@pytest.mark.parametrize("key", sorted(queries.ORACLES))
def test_query_matches_sql(spark, key):
    con = duckdb.connect()
    for t in ("documents", "conversations", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = queries.QUERIES[key](spark, SF)
    cur = con.execute(queries.ORACLES[key])
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(df.columns)
    assert brute.canon(df.columns, [tuple(r) for r in df.collect()]) == brute.canon(cols, cur.fetchall())


@pytest.mark.parametrize("bits", [4, 128])
def test_exact_dedup(spark, edge, documents, bits):
    """4 bits put different texts into every group: the byte comparison has to part them."""
    assert got(exact_dedup.exact_dedup(edge, hash_bits=bits)) == brute.exact(EDGE)
    docs = spark.createDataFrame(documents, "doc_id long, text string")
    assert got(exact_dedup.exact_dedup(docs, hash_bits=bits)) == brute.exact(documents)


def test_exact_dedup_keeps_one_of_equal_rows(odd):
    rows = exact_dedup.exact_dedup(odd).collect()
    same = [r for r in rows if r.text_sha256 == brute.sha(PASSAGE.replace(" ", ""))]
    assert len(same) == 4 and sum(r.kept for r in same) == 1 and {(r.keep_id, r.group_size) for r in same} == {(7, 4)}


def test_chat_rotation(spark):
    rows = [(1, 0, "ann", "hi"), (1, 1, "bob", None), (1, 2, "ann", "é"), (1, None, None, "late"), (1, 0, "system", "S"),
            (2, 0, "system", "only"), (None, 3, "ann", "x"), (1, 2, "ann", "é")]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    out = {(r.conv_id, r.speaker): r for r in chat_formatting.rotate_perspectives(df).collect() if r.part == 0}
    assert set(out) == {(1, "ann"), (1, "bob"), (1, "unknown"), (None, "ann")}
    a = out[1, "ann"]
    assert a.rendered == "<|assistant|>\nhi\n<|system|>\nS\n<|user name=bob|>\n\n<|assistant|>\né\n<|assistant|>\né\n"
    assert (a.n_messages, a.n_masked) == (5, 3)
    spans = [tuple(map(int, x.split(":"))) for x in a.mask.split(",")]
    assert [a.rendered[s:s + n] for s, n in spans] == ["hi", "é", "é"]


def test_chat_rotation_splits_long_dialogues(spark):
    """One dialogue of 500 turns, with two messages a turn: bounded parts, offsets that run on."""
    rows = [(9, i // 2, f"r{i % 3}", f"t{i}") for i in range(1000)]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    out = sorted((r for r in chat_formatting.rotate_perspectives(df, block=16).collect() if r.speaker == "r1"), key=lambda r: r.part)
    assert max(r.n_messages for r in out) == 16 and sum(r.n_messages for r in out) == 1000
    whole = "".join(r.rendered for r in out)
    assert [r.start for r in out] == [sum(len(x.rendered) for x in out[:k]) for k in range(len(out))]
    spans = [tuple(map(int, x.split(":"))) for r in out if r.mask for x in r.mask.split(",")]
    assert [whole[s:s + n] for s, n in spans] == [t for _, i, r, t in sorted(rows, key=lambda r: (r[1], r[2], r[3])) if r == "r1"]


@pytest.mark.parametrize("n", [1, 3, 20])
def test_substring_dedup(spark, edge, documents, n):
    sub = min(n, substring_dedup.SUB)
    out = {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in substring_dedup.substring_dedup(edge, n=n, sub=sub).collect()}
    assert out == brute.substring(EDGE, n)
    docs = spark.createDataFrame(documents, "doc_id long, text string").repartition(5)
    rows = substring_dedup.substring_dedup(docs, n=n, sub=sub).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in rows} == brute.substring(documents, n)
    for r in rows:
        assert sum(x.end - x.start for x in r.removed) == r.n_removed
        assert all(a.end < b.start for a, b in zip(r.removed, r.removed[1:], strict=False))


def test_substring_dedup_hot_passage(spark):
    """A passage that a third of the rows hold, over many partitions: only the first row keeps it."""
    rng = random.Random(4)
    rows = [(i, " ".join([*(f"{rng.random()}" for _ in range(25)), *([PASSAGE] if i % 3 == 0 else [])])) for i in range(900)]
    out = got(substring_dedup.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(30)))
    assert {i for i, v in out.items() if v[1]} == {i for i in range(3, 900, 3)} and {v[1] for v in out.values()} == {0, 30}


def test_sharding(spark, edge, documents):
    docs = spark.createDataFrame(documents, "doc_id long, text string")
    rows = sharding.rendezvous_shards(docs, queries.SHARDS, queries.GROWN).collect()
    for r in rows:
        assert r["shard"] == brute.shard(str(r.doc_id), 24) and r.grown_shard == brute.shard(str(r.doc_id), 25)
        assert r.grown_shard in (r["shard"], 24)
    for s in range(24):
        slots = sorted(r.slot for r in rows if r["shard"] == s)
        assert slots == list(range(len(slots)))
    import zlib
    for r in sharding.rendezvous_shards(edge, {0: 1.0}).collect():
        t = (dict(EDGE)[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r["shard"], r.grown_shard) == (len(t) + 8, zlib.crc32(t), "key", 0, None)


def test_sharding_weights(spark):
    docs = spark.range(20000).selectExpr("id AS doc_id", "'' AS text")
    n = {r["shard"]: r["count"] for r in sharding.rendezvous_shards(docs, {0: 1.0, 1: 2.0, 2: 5.0}).groupBy("shard").count().collect()}
    assert abs(n[1] / n[0] - 2) < 0.2 and abs(n[2] / n[0] - 5) < 0.4
    with pytest.raises(ValueError):
        sharding.rendezvous_shards(docs, {0: 0.0})


def test_lm_scoring(spark, edge, documents):
    for data, df in ((EDGE, edge), (documents, spark.createDataFrame(documents, "doc_id long, text string"))):
        model = brute.LM(data)
        for r in lm_scoring.score_documents(df).collect():
            want = model.row(r.doc_id, dict(data)[r.doc_id])
            assert tuple(r)[1:5] == want[:4]
            assert np.allclose(tuple(r)[5:], want[4:], rtol=1e-9)


def test_lm_keeps_rare_words_and_arcs_of_a_larger_corpus(spark, monkeypatch):
    """Past 100,000 tokens a word seen twice still makes states and arcs; several blocks agree."""
    rng = random.Random(5)
    data = [(i, " ".join([*rng.choices(COMMON, k=60), f"ra{i % 1500} rb{i % 1500} rc{i % 1500}", *rng.choices(COMMON, k=60)])) for i in range(3000)]
    monkeypatch.setattr(lm_scoring, "BLOCK_BYTES", 300_000, raising=False)
    model = brute.LM(data, word_share=0, arc_share=0)
    assert model.n > 300_000
    rows = got(lm_scoring.score_documents(spark.createDataFrame(data, "doc_id long, text string")))
    assert len(rows) == len(data)
    for i in [0, 1, 7, 1500, 2999, *[i for i, _ in data if model.held(i)][:20]]:
        want = model.row(*data[i])
        assert rows[i][:4] == want[:4]
        assert np.allclose(rows[i][4:], want[4:], rtol=1e-9)


def test_lm_distributions_sum_to_one(documents):
    """The brute model agrees with the operator above; here its states are shown to be proper."""
    model = brute.LM(documents)
    states = [(), *random.Random(1).sample(sorted(model.left), 8)]
    for h in states:
        assert abs(sum(model.p(h, w) for w in +model.c) + model.p(h, "never seen") - 1) < 1e-9


def test_lm_beats_unigrams_on_held_out(spark):
    rows = [r for r in queries.QUERIES["op5_lm_scoring"](spark, "/root/testdata/sf0.01").collect() if r.held_out]
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_lm_without_training_documents(spark):
    rows = lm_scoring.score_documents(spark.createDataFrame([(None, "a b")], "doc_id long, text string")).collect()
    assert [tuple(r) for r in rows] == [(None, True, 3, 0, 0, 0.0, 0.0)]


def test_token_counts(spark, edge, documents):
    lib = Tokenizer.from_file(WORD_BPE)
    for data, df in ((EDGE, edge), (documents, spark.createDataFrame(documents, "doc_id long, text string"))):
        want = {i: len(lib.encode(t or "", add_special_tokens=False).ids) for i, t in data}
        for kw in ({}, {"chunk": 200, "overlap": 8}):
            out = got(token_counts.token_counts(df, WORD_BPE, **kw))
            assert out == {i: (len((t or "").encode()), want[i], want[i] > 2048) for i, t in data}


@pytest.mark.parametrize("chunk,overlap", [(16, 2), (64, 4), (300, 16)])
def test_overlaps_widen_until_chunks_agree(chunk, overlap):
    lib = Tokenizer.from_file(WORD_BPE)
    rng = random.Random(chunk)
    alphabet = "ab \t\n\x0b\x1c\x85 　'sdl0²éẞİς中🎉́<|endoftext|>!?—\x00Ä_"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 900))) for _ in range(60)]
    texts += ["a" * 900, "b" * 400 + " " + "c" * 500, ("d" * 120 + " ") * 9, "<|endoftext|>" * 40, " " * 500]
    counter = token_counts.ChunkCounter(WORD_BPE, chunk, overlap)
    assert counter.count(texts) == [len(lib.encode(t, add_special_tokens=False).ids) for t in texts]


def test_quality_ledger(spark, edge, documents):
    docs = spark.createDataFrame(documents, "doc_id long, text string")
    for data, df in ((EDGE, edge), (documents, docs)):
        out = quality_rules.apply_policy(quality_rules.quality_ledger(df), "v2").collect()
        for r in out:
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute.quality(dict(data)[r.doc_id])
            assert not (r.base_failed and r.kept) and r.kept == (r.fail_bits == 0)


def test_quality_policies_and_ablations(spark, documents):
    ledger = quality_rules.quality_ledger(spark.createDataFrame(documents, "doc_id long, text string"))
    bits = [r.fail_bits for r in ledger.collect()]
    for version, mask in quality_rules.POLICIES.items():
        kept = [r.kept for r in quality_rules.apply_policy(ledger, version).collect()]
        assert sum(kept) == sum(not b & mask for b in bits)
        for r in quality_rules.ablations(ledger, version).collect():
            b = quality_rules.BIT[r.rule]
            assert (r.n_docs, r.failed, r.only) == (len(bits), sum(bool(x & b) for x in bits), sum(x & mask == b for x in bits))
    none = quality_rules.ablations(ledger.where("1 = 0"), "v2").collect()
    assert len(none) == 6 and {(r.failed, r.only, r.with_bits) for r in none} == {(0, 0, 0)}


def test_rules_run_once_and_without_python(spark, documents):
    ledger = quality_rules.quality_ledger(spark.createDataFrame(documents, "doc_id long, text string"), carry=True)
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        quality_rules.apply_policy(ledger, "v2").where("kept").select("row.*").explain()
    assert out.getvalue().count("xxhash64(") == 1 and "Exchange" not in out.getvalue() and "Python" not in out.getvalue()


def test_byte_bpe_matches_the_library(spark, edge, documents):
    lib = Tokenizer.from_file(BYTE_BPE)
    for data, df in ((EDGE, edge), (documents, spark.createDataFrame(documents, "doc_id long, text string"))):
        ids = {i: lib.encode(t or "", add_special_tokens=False).ids for i, t in data}
        assert got(byte_bpe.round_trip(df, BYTE_BPE)) == {
            i: (len(x), brute.sha(",".join(map(str, x))), brute.sha(lib.decode(x, skip_special_tokens=False))) for i, x in ids.items()}
        assert {r.doc_id: r.ids for r in byte_bpe.encode_texts(df, BYTE_BPE).collect()} == ids


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from("ab '<|>endoftxt\n　\x1cé0")), max_size=200))
def test_byte_and_word_ids_of_any_text(text):
    lib, codec = _libraries()
    assert codec.encode([text])[0].tolist() == lib[0].encode(text, add_special_tokens=False).ids
    assert codec.decode(codec.encode([text])[0]) == text
    ids = np.frombuffer(word_bpe.WordIds(WORD_BPE).encode([text.encode()])[0], "<u4").tolist()
    assert ids == lib[1].encode(text, add_special_tokens=False).ids


def _fresh_word_ids(monkeypatch, limit=word_bpe.MEMO_BYTES):
    """An encoder with memos of its own, and the words that reach the merge table."""
    words, merged = word_bpe.WordIds(WORD_BPE), []
    words.units, words.words = word_bpe.IdMemo(limit), word_bpe.IdMemo(limit)
    encode = words.table.encode
    monkeypatch.setattr(words.table, "encode", lambda some: merged.extend(some) or encode(some))
    return words, merged


def test_word_ids_merge_each_word_once(monkeypatch):
    words, merged = _fresh_word_ids(monkeypatch)
    words.encode([b"Lamp lamp, (lamp) LAMP. lamps", b"lamp's \"lamp\" lamp; lamps."])
    words.encode([b"lamp! Lamps, lamps!"])
    assert merged.count(b"lamp") == merged.count(b"lamps") == 1 and len(merged) == len(set(merged))


@pytest.mark.parametrize("limit", [0, 2000, word_bpe.MEMO_BYTES])
def test_word_ids_of_many_texts_with_full_memos(monkeypatch, limit):
    words, _ = _fresh_word_ids(monkeypatch, limit)
    lib = _libraries()[0][1]
    parts = ["lamp", "Lamp,", "l'eau", "漢字", "<|endoftext|>", "İx", "x1²", "\x1c", "a\x85b", "\xa0", "w" * 70, "", "\t", "\x0b\r\n"]
    assert words.encode([]) == [] and words.encode([b"", b" "]) == [b"", b""]
    for k in range(1, 30):
        texts = [" ".join(parts[(i * k + j * j) % len(parts)] + str(i * k) for j in range(i % 9)) for i in range(20)] + parts
        ids = [np.frombuffer(x, "<u4").tolist() for x in words.encode([t.encode() for t in texts])]
        assert ids == [lib.encode(t, add_special_tokens=False).ids for t in texts]
        assert all(m.keys.nbytes + m.ids.nbytes <= limit + 64 for m in (words.units, words.words))


_LIBS = []


def _libraries():
    if not _LIBS:
        _LIBS.append(((Tokenizer.from_file(BYTE_BPE), Tokenizer.from_file(WORD_BPE)), byte_bpe.TextCodec(BYTE_BPE)))
    return _LIBS[0]


def test_rank_array_and_heap_agree():
    table, rng = bpe.rank_table(BYTE_BPE), random.Random(2)
    some = [bytes(rng.choice(b"abcdefgthein \xc3\xa9") for _ in range(rng.randint(1, bpe.SHORT))) for _ in range(800)]
    assert table.encode(some) == [table._heap(w) for w in some]


def test_memo_is_bounded_and_makes_what_it_has_lost():
    m, made = bpe.Memo(4), []

    def make(keys):
        made.extend(keys)
        return [k.upper() for k in keys]

    for k in "abcdefabc":
        assert m.resolve([[k, k], []], make) == {k: k.upper()}
        assert len(m.new) + len(m.old) <= 8
    assert made[:6] == list("abcdef") and m.resolve([], make) == {}


def test_packing(spark, edge, documents):
    lib = Tokenizer.from_file(WORD_BPE)
    for data, df in ((EDGE, edge), (documents, spark.createDataFrame(documents, "doc_id long, text string"))):
        ids = {i: [*lib.encode(t or "", add_special_tokens=False).ids, 1] for i, t in data}
        rows = [tuple(r) for r in packing.pack_documents(df, WORD_BPE).collect()]
        bins, have = brute.check_packing(rows, ids)
        assert have == {i: len(x) for i, x in ids.items()}
        assert len(bins) <= -(-sum(map(len, ids.values())) // 4096) * 1.05 + 1


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 60), min_size=33, max_size=33), st.sampled_from([2, 6, 32]))
def test_packing_plans(counts, groups):
    counts = np.array([0, *counts[1:]])
    plan = packing.plan_packing(counts, 32, groups)
    items = [(length, seq + i, offset) for length, _, n, seq, offset in plan.runs for i in range(n)]
    assert sorted(x for x, _, _ in items) == np.repeat(np.arange(33), counts).tolist()
    bins = {}
    for length, seq, offset in items:
        bins.setdefault(seq, []).append((offset, length))
    for v in bins.values():
        assert sum(n for _, n in v) <= 32 and [o for o, _ in sorted(v)] == np.cumsum([0, *(n for _, n in sorted(v))])[:-1].tolist()


def test_packing_is_near_the_bound_on_many_items():
    rng = np.random.default_rng(7)
    counts = np.bincount(np.clip(np.exp(rng.normal(6.4, 1.2, 30000)).astype(int), 1, 4096), minlength=4097)
    plan = packing.plan_packing(counts, 4096)
    assert plan.n_seq <= 1.002 * (counts @ np.arange(4097)) / 4096 + 1


@pytest.mark.parametrize("percent", [80, 85])
def test_near_dedup(spark, edge, documents, percent):
    for data, df in ((EDGE, edge), (documents, spark.createDataFrame(documents, "doc_id long, text string"))):
        out = got(near_dedup.near_dedup(df, threshold=percent))
        assert out == {i: (n, c, i == c) for i, (n, c) in brute.near(data, percent).items()}


def test_near_dedup_large_group_of_near_copies(spark):
    """300 distinct near copies whose links form chains and islands: no link may be lost."""
    rng = random.Random(5)
    base = [f"b{i}" for i in range(150)]
    rows = []
    for i in range(300):
        w = list(base)
        for _ in range(rng.choice([1, 1, 2, 3, 4, 6])):
            w[rng.randrange(150)] = f"e{rng.randrange(400)}"
        rows.append((i, " ".join(w)))
    rows += [(300 + i, " ".join(f"u{i}_{j}" for j in range(40))) for i in range(50)]
    out = got(near_dedup.near_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(9), threshold=85))
    assert {i: v[:2] for i, v in out.items()} == brute.near(rows, 85)


def test_fast_sketch_estimates_similarity():
    rng = np.random.default_rng(3)
    for n in (1, 5, 60, 4000):
        a = rng.integers(1, 2**63, n).astype(np.uint64)
        b = np.concatenate([a[: n - n // 5], rng.integers(1, 2**63, n // 5).astype(np.uint64)])
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        x, y = near_dedup.fast_sketch(a, 800), near_dedup.fast_sketch(b, 800)
        assert len(x) == 800 and abs((x == y).mean() - true) < 0.08
        assert (x == near_dedup.fast_sketch(a[::-1].copy(), 800)).all()


def test_components(spark):
    rng = random.Random(8)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 50)] + [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(120)]
    out = dict(tuple(r) for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect())
    parent = {}
    for a, b in edges:
        if a != b:
            pa, pb = parent.setdefault(a, a), parent.setdefault(b, b)
            for k, v in list(parent.items()):
                if v in (pa, pb):
                    parent[k] = min(pa, pb)
    assert out == parent
    assert connected_components(spark.createDataFrame([], "u long, v long")).collect() == []
