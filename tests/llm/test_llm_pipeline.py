"""The pipeline, stage by stage, against brute force."""

import brute
import duckdb
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from tessera.llm import quality_rules

SF = "/root/testdata/sf0.001"
PASSAGE = " ".join(f"p{i}" for i in range(40))


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    have = dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())
    for name, step in corpus_pipeline.STAGES[:-1]:
        docs = step(spark, docs, SF)
        assert docs.columns == columns
        out = texts(docs)
        if name == "quality":
            bits = {r.doc_id: r.fail_bits for r in quality_rules.quality_ledger(spark.read.parquet(f"{SF}/documents.parquet")).collect()}
            have = {i: t for i, t in have.items() if not bits[i]}
            assert not any(brute.quality(t)[-1] for t in have.values())
        elif name == "exact":
            have = {i: have[i] for i, v in brute.exact(have.items()).items() if v[2]}
        elif name == "near":
            have = {i: have[i] for i, v in brute.near(have.items(), 80).items() if i == v[1]}
        else:
            done = brute.substring(have.items())
            have = {i: done[i][2] if done[i][1] else t for i, t in have.items()}
            assert {r.doc_id: r.n_chars for r in docs.collect() if done[r.doc_id][1]} == {i: len(t) for i, t in have.items() if done[i][1]}
        assert out == have
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {i: [*lib.encode(t, add_special_tokens=False).ids, 1] for i, t in have.items()}
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    _, count = brute.check_packing([tuple(r) for r in packed.collect()], ids)
    assert count == {i: len(x) for i, x in ids.items()}
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).select("doc_id", "piece", "ids_crc32").collect())) == sorted(
        map(tuple, packed.select("doc_id", "piece", "ids_crc32").collect()))


def test_odd_rows_and_columns(spark):
    kind = "doc_id long, text string, lang string, source string, n_chars int, kept string, row string"
    good = " ".join(f"g{i}" for i in range(60))
    rows = [(None, good, "en", None, None, "k", "r"), (None, good, "en", None, 3, "k", "r"), (5, PASSAGE, None, "s", 1, None, None),
            (5, PASSAGE, None, "s", 1, None, None), (6, None, None, None, None, None, None), (7, "", "", "", 0, "", ""),
            (8, good + " " + PASSAGE + " " + " ".join(f"z{i}" for i in range(90)), "en", "s", 9, "k", "r")]
    docs = spark.createDataFrame(rows, kind)
    for name, step in corpus_pipeline.STAGES[:-1]:
        docs = step(spark, docs, "")
        assert docs.dtypes == spark.createDataFrame([], kind).dtypes
        if name == "exact":
            assert sorted((r.doc_id or 0) for r in docs.collect()) == [0, 5, 8]
    out = {r.doc_id: r.text for r in docs.collect()}
    # the null id sorts last, so its text counts as the later one
    assert out == {5: PASSAGE, 8: good + " " + " ".join(f"z{i}" for i in range(90)), None: ""}
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() == 3


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, step in corpus_pipeline.STAGES:
        docs = step(spark, docs, "")
    assert docs.collect() == []
