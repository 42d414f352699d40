"""Quality rules: a ledger of failure bits and measurements, then versioned policies over it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.rows import WORD_GAP, let

WINDOW = 8
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letters", "n_upper")
SYMBOLS = "#*$%&|<>"

#: Every rule once, as (name, failing condition over the measurements m); the position is its bit.
RULES: tuple[tuple[str, Callable[[Column], Column]], ...] = (
    ("few_words", lambda m: m["n_words"] < 20),
    ("repeated_windows", lambda m: 100 * m["n_repeat_words"] > 30 * m["n_words"]),
    ("symbols", lambda m: 10 * m["n_symbols"] > m["n_words"]),
    ("duplicate_lines", lambda m: 2 * m["n_dup_lines"] > m["n_lines"]),
    ("word_length", lambda m: (m["word_chars"] < 2 * m["n_words"]) | (m["word_chars"] > 15 * m["n_words"])),
    ("shouting", lambda m: 2 * m["n_upper"] > m["n_letters"]),
)

BIT = {name: 1 << i for i, (name, _) in enumerate(RULES)}
BASE_MASK = BIT["few_words"] | BIT["repeated_windows"]

#: Versioned policies: the bits that reject a document. A version never changes once published.
POLICIES: dict[str, int] = {
    "v1": BASE_MASK | BIT["symbols"],
    "v2": BASE_MASK | BIT["symbols"] | BIT["duplicate_lines"] | BIT["word_length"] | BIT["shouting"],
}


def _covered(h: Column) -> Column:
    """Words covered by windows whose hash occurs twice or more in ``h`` (one hash per window start)."""
    def starts(s: Column) -> Column:  # s: (hash, start) in order of hash
        def repeated(x: Column, j: Column) -> Column:
            same = (x["h"] == F.get(s, j - 1)["h"]) | (x["h"] == F.get(s, j + 1)["h"])
            return F.when(F.coalesce(same, F.lit(False)), x["i"])
        return F.sort_array(F.filter(F.transform(s, repeated), lambda p: p.isNotNull()))

    def length(p: Column) -> Column:
        gap = lambda x, j: F.least(F.lit(WINDOW), F.coalesce(F.get(p, j + 1) - x, F.lit(WINDOW)))
        return F.aggregate(F.transform(p, gap), F.lit(0), lambda a, b: a + b)

    pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    return let(let(pairs, starts), length)


def _repeat_words(words: Column) -> Column:
    def count(w: Column) -> Column:
        window = lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)])
        hashes = F.transform(F.sequence(F.lit(0), F.size(w) - WINDOW), window)
        some = lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), _covered(h)).otherwise(F.lit(0))
        return F.when(F.size(w) >= WINDOW, let(hashes, some)).otherwise(F.lit(0))
    return let(words, count)


def quality_ledger(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """Measurements and failure bits of every document, each rule evaluated once.

    Returns one row per input row: (``id_col``, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, n_lines, n_letters, n_upper, fail_bits). Bit i of ``fail_bits`` is set if
    rule i of ``RULES`` fails. One narrow pass: no shuffle, no Python; windows are compared
    by a 64-bit hash inside their document. With ``carry`` the input row comes along as the
    struct ``row``, so that documents can be filtered without a join.

    Null text counts as empty and has no words. Null ids and repeated rows pass through. An
    empty table gives no rows.
    """
    text = F.coalesce(df[text_col], F.lit(""))
    words = F.array_remove(F.split(text, WORD_GAP), "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    long = lambda c, name: c.cast("long").alias(name)
    counts = let(words, lambda w: F.struct(
        long(F.size(w), "n_words"), long(F.char_length(F.array_join(w, "")), "word_chars"),
        long(_repeat_words(w), "n_repeat_words")))
    by_line = let(lines, lambda x: F.struct(
        long(F.size(x), "n_lines"), long(F.size(x) - F.size(F.array_distinct(x)), "n_dup_lines")))
    measured = let(F.struct(counts.alias("c"), by_line.alias("l")), lambda x: F.struct(
        *[x["c"][n].alias(n) for n in ("n_words", "word_chars", "n_repeat_words")],
        *[x["l"][n].alias(n) for n in ("n_lines", "n_dup_lines")],
        long(F.char_length(text) - F.char_length(F.translate(text, SYMBOLS, "")), "n_symbols"),
        long(F.regexp_count(text, F.lit(r"\p{L}")), "n_letters"),
        long(F.regexp_count(text, F.lit(r"\p{Lu}")), "n_upper")))

    def ledger(m: Column) -> Column:
        bits = sum((F.when(fails(m), F.lit(1 << i)).otherwise(F.lit(0)) for i, (_, fails) in enumerate(RULES)), F.lit(0))
        return F.struct(*[m[n].alias(n) for n in MEASURES], bits.alias("fail_bits"))

    # one expression yields the whole ledger: a filter on it that is pushed down costs it once
    own = [F.struct(*[df[c] for c in df.columns]).alias("row")] if carry else []
    rows = df.select(df[id_col].alias("id"), *own, let(measured, ledger).alias("m"))
    return rows.select(F.col("id").alias(id_col), *(["row"] if carry else []), "m.*")


def apply_policy(ledger: DataFrame, version: str) -> DataFrame:
    """The ledger with base_failed, policy and kept under one policy version; nothing is measured again."""
    mask = POLICIES[version]
    return ledger.withColumns({
        "base_failed": F.col("fail_bits").bitwiseAND(F.lit(BASE_MASK)) != 0,
        "policy": F.lit(version),
        "kept": F.col("fail_bits").bitwiseAND(F.lit(BASE_MASK | mask)) == 0})


def ablations(ledger: DataFrame, version: str) -> DataFrame:
    """Per rule of a policy: documents that fail it, that it alone rejects (they would stay without
    it), and the other rules that ever fail beside it (a bitwise OR). One aggregate over the ledger."""
    mask = POLICIES[version]
    names = [n for n, _ in RULES if BIT[n] & mask]
    under = F.col("fail_bits").bitwiseAND(F.lit(mask))
    aggs = [F.count(F.lit(1)).alias("n")]
    for n in names:
        hit = under.bitwiseAND(F.lit(BIT[n])) != 0
        aggs += [F.count_if(hit).alias(f"{n}_failed"), F.count_if(under == BIT[n]).alias(f"{n}_only"),
                 F.coalesce(F.bit_or(F.when(hit, under.bitwiseAND(F.lit(mask & ~BIT[n])))), F.lit(0)).alias(f"{n}_with")]
    one = ledger.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(f"{n}_failed").alias("failed"),
                              F.col(f"{n}_only").alias("only"), F.col(f"{n}_with").cast("int").alias("with_bits")) for n in names])
    return one.select(F.lit(version).alias("policy"), F.col("n").alias("n_docs"), F.inline(rows))
