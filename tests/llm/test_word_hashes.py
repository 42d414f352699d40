"""Long words over two letters, on which polynomials modulo 2^64 collide whatever their base, stay apart."""

import numpy as np
import pytest

import corpus_pipeline
from tessera.llm import near_dedup, rolling, substring_dedup

SWAP = str.maketrans("ab", "ba")


def thue_morse(n):
    word = "a"
    while len(word) < n:
        word += word.translate(SWAP)
    return word, word.translate(SWAP)


PAIRS = [thue_morse(n) for n in (1024, 2048, 4096)]
COMMON = [f"w{i}" for i in range(19)]


def documents(spark, words):
    rows = [(i, " ".join([*COMMON, w])) for i, w in enumerate(words)]
    return spark.createDataFrame(rows, "doc_id long, text string"), dict(rows)


def test_hashes_of_words_differ_and_ignore_their_place():
    text = " ".join(w for p in PAIRS for w in p)
    one, two, first = rolling.word_hashes([text.encode(), b"", ("x \t" + text).encode()])
    assert first.tolist() == [0, 6, 6, 13]
    assert len(set(one[:6])) == len(set(two[:6])) == 6 and not set(one) & set(two)
    assert (one[:6] == one[7:]).all() and (two[:6] == two[7:]).all()


def test_chunks_cut_no_word():
    text = b"  alpha beta\tgamma\n" * 200
    for got, want in zip(rolling.word_hashes([text, text], 50), rolling.word_hashes([text, text]), strict=True):
        assert np.array_equal(got, want)


@pytest.mark.parametrize("words", PAIRS)
def test_substring_dedup_removes_no_window_that_differs(spark, words):
    docs, texts = documents(spark, words)
    got = substring_dedup.substring_dedup(docs).collect()
    assert {r["doc_id"]: (r["n_removed"], r["kept_text"]) for r in got} == {i: (0, t) for i, t in texts.items()}


def strangers(spark, words):
    """Documents of 40 words, every five of which hold the long word; no shingle is shared."""
    rows = [(i, " ".join(w if k % 5 == 0 else f"c{k}" for k in range(40))) for i, w in enumerate(words)]
    return spark.createDataFrame(rows, "doc_id long, text string"), dict(rows)


@pytest.mark.parametrize("words", PAIRS)
def test_near_dedup_links_only_what_shares_shingles(spark, words):
    docs, _ = strangers(spark, words)
    assert all(r["kept"] for r in near_dedup.near_dedup(docs, threshold=85).collect())


def test_pipeline_stages_keep_both(spark):
    docs, texts = strangers(spark, PAIRS[0])
    docs = docs.selectExpr("doc_id", "text", "'en' AS lang", "'s' AS source", "cast(length(text) AS int) AS n_chars")
    stages = dict(corpus_pipeline.STAGES)
    for name in [k for k in stages if "near" in k or "substring" in k]:
        assert {r["doc_id"]: r["text"] for r in stages[name](spark, docs, "").collect()} == texts
