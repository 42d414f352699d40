"""The queries of this package, opN_<name>, with their SQL statements where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import byte_bpe, chat_formatting, conversation_repair, exact_dedup, lexical_search, lm_scoring, near_dedup, packing, quality_rules, sharding, substring_dedup, token_counts, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``key`` with its SQL statement, if it has one."""
    def deco(fn):
        QUERIES[key] = fn
        if sql:
            ORACLES[key] = sql.strip()
        return fn
    return deco


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query("op1_exact_dedup", r"""
WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS n,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = first_value(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM t WINDOW w AS (PARTITION BY norm ORDER BY n DESC, doc_id)
""")
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact dedup of all documents."""
    return exact_dedup.exact_dedup(_documents(spark, sf_dir))


@query("op2_chat_formatting", r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations),
s AS (SELECT DISTINCT conv_id, role AS speaker FROM c WHERE role <> 'system'),
r AS (SELECT *, floor(turn / 64.0) AS span,
             row_number() OVER (PARTITION BY conv_id, floor(turn / 64.0) ORDER BY turn, role, text) AS rk FROM c),
m AS (SELECT r.conv_id, s.speaker, span, (rk - 1) // 64 AS cut, rk, r.role = s.speaker AS own, text,
             CASE WHEN r.role = s.speaker THEN '<|assistant|>' WHEN r.role = 'system' THEN '<|system|>'
                  ELSE '<|user name=' || r.role || '|>' END || chr(10) AS head
      FROM r JOIN s ON r.conv_id IS NOT DISTINCT FROM s.conv_id),
o AS (SELECT *, coalesce(sum(length(head) + length(text) + 1) OVER (
             PARTITION BY conv_id, speaker ORDER BY span NULLS LAST, cut, rk
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos FROM m)
SELECT conv_id, speaker, CAST(row_number() OVER (PARTITION BY conv_id, speaker ORDER BY span NULLS LAST, cut) - 1 AS INTEGER) AS part,
       CAST(count(*) AS INTEGER) AS n_messages, CAST(count(*) FILTER (own) AS INTEGER) AS n_masked,
       CAST(min(pos) AS BIGINT) AS start, string_agg(head || text || chr(10), '' ORDER BY rk) AS rendered,
       coalesce(string_agg((pos + length(head))::BIGINT || ':' || length(text), ',' ORDER BY rk) FILTER (own), '') AS mask
FROM o GROUP BY conv_id, speaker, span, cut
""")
def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation from the perspective of each participant."""
    return chat_formatting.rotate_perspectives(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


@query("op3_substring_dedup", r"""
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 19], ' ') AS s FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM w)),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS k FROM win) WHERE k > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS pos FROM again),
word AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS pos FROM w),
left_over AS (SELECT word.doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY pos) AS kept FROM word ANTI JOIN gone USING (doc_id, pos) GROUP BY word.doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN left_over USING (doc_id)
""")
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of 20 words that also start earlier, removed from all documents."""
    done = substring_dedup.substring_dedup(_documents(spark, sf_dir))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


#: Production shards: 24 of equal weight; one more when the set grows.
SHARDS = {s: 1.0 for s in range(24)}
GROWN = {24: 1.0}


@query("op4_sharding")
def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents over 24 shards by rendezvous hashing of doc_id."""
    return sharding.rendezvous_shards(_documents(spark, sf_dir), SHARDS, GROWN)


@query("op5_lm_scoring")
def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents under a trigram automaton of the training documents."""
    return lm_scoring.score_documents(_documents(spark, sf_dir))


@query("op6_token_counts")
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word BPE tokens of all documents."""
    return token_counts.token_counts(_documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


@query("op7_quality_rules", r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM t),
g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, h) AS n
      FROM (SELECT doc_id, i, md5(array_to_string(words[i:i + 7], chr(32))) AS h
            FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM w))),
p AS (SELECT doc_id, least(8, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, 8)) AS cover FROM g WHERE n > 1),
c AS (SELECT doc_id, sum(cover) AS n_repeat FROM p GROUP BY doc_id),
m AS (SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
             CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(n_repeat, 0) AS BIGINT) AS n_repeat_words, CAST(len(lines) AS BIGINT) AS n_lines,
             CAST(length(text) - length(regexp_replace(text, '\pL', '', 'g')) AS BIGINT) AS n_letters,
             CAST(length(text) - length(regexp_replace(text, '\p{Lu}', '', 'g')) AS BIGINT) AS n_upper
      FROM w LEFT JOIN c USING (doc_id)),
f AS (SELECT *, CAST((n_words < 20)::INT + 2 * (100 * n_repeat_words > 30 * n_words)::INT
                + 4 * (10 * n_symbols > n_words)::INT + 8 * (2 * n_dup_lines > n_lines)::INT
                + 16 * (word_chars < 2 * n_words OR word_chars > 15 * n_words)::INT
                + 32 * (2 * n_upper > n_letters)::INT AS INTEGER) AS fail_bits FROM m)
SELECT *, fail_bits % 4 <> 0 AS base_failed, 'v2' AS policy, fail_bits = 0 AS kept FROM f
""")
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule ledger of all documents under policy v2."""
    return quality_rules.apply_policy(quality_rules.quality_ledger(_documents(spark, sf_dir)), "v2")


@query("op8_bpe_round_trip")
def op8_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte BPE ids of all documents, and the texts decoded from them."""
    return byte_bpe.round_trip(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


@query("op9_best_fit_packing")
def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 4096 word BPE tokens."""
    return packing.pack_documents(_documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


@query("op10_minhash_near_dedup", r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
sh AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
                                           WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS k FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT u, v FROM pairs JOIN n x ON u = x.doc_id JOIN n y ON v = y.doc_id WHERE 100 * k >= 85 * (x.n + y.n - k)),
edges AS (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
reach(doc_id, other) AS (SELECT u, v FROM edges UNION SELECT reach.doc_id, edges.v FROM reach JOIN edges ON reach.other = edges.u),
low AS (SELECT doc_id, min(other) AS other FROM reach GROUP BY doc_id)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, least(w.doc_id, coalesce(other, w.doc_id)) AS component_id, w.doc_id <= coalesce(other, w.doc_id) AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN low USING (doc_id)
""")
def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents, five-word shingles, similarity 0.85."""
    return near_dedup.near_dedup(_documents(spark, sf_dir), threshold=85)


@query("op11_ranked_search", r"""
WITH tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(regexp_extract_all(
              translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM documents) GROUP BY doc_id, term),
nd AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY doc_id),
s AS (SELECT count(*) AS nn, CAST(sum(n) AS BIGINT) AS ll FROM nd),
w AS (SELECT term, CAST(floor(1000 * ln((2 * nn + 2) / (2 * df + 1))) AS BIGINT) AS w
      FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), s),
q AS (SELECT item_id, term, count(*) AS qtf FROM (SELECT item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
      FROM benchmark) GROUP BY item_id, term),
sc AS (SELECT item_id, doc_id, CAST(sum(qtf * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * nn) // ll)))) AS BIGINT) AS score
       FROM q JOIN w USING (term) JOIN tf USING (term) JOIN nd USING (doc_id), s GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM sc WHERE score > 0 QUALIFY rank <= 20
""")
def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best of all documents for every benchmark item."""
    return lexical_search.ranked_search(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), 20)


@query("op12_toxicity")
def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learnt from the labelled ones outside the held-out fold."""
    return toxicity.toxicity_scores(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


@query("op13_conversation_repair", r"""
WITH RECURSIVE d AS (
  SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
         CASE f WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE WHEN f = 3 THEN 2 ELSE 1 END)) AS copy
  FROM (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, CAST(xor(4294967295::UBIGINT, list_reduce(
               list_prepend(4294967295::UBIGINT, list_transform(string_split(k, ''), lambda b: ascii(b)::UBIGINT)),
               lambda acc, b: xor(acc >> 8, list_reduce(list_prepend(xor(acc & 255, b), list_transform(range(8), lambda j: 0::UBIGINT)),
                                                        lambda v, j: xor(v >> 1, (v & 1) * 3988292384))))) % 20 AS INTEGER) AS f
        FROM (SELECT *, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations)) WHERE f <> 0),
o AS (SELECT *, row_number() OVER w AS i,
             row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth,
             regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS core, left(role, 1) AS x, lag(left(role, 1)) OVER w AS y
      FROM d WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)),
r AS (SELECT *, CASE WHEN core = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate'
                     WHEN right(core, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM o),
c AS (SELECT conv_id, count(*) AS n, CAST(coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS BIGINT) AS gaps,
             count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
             count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (y || x NOT IN ('su', 'ua', 'au')) AS illegal
      FROM r GROUP BY conv_id),
ins(s, k, z, pre, lines) AS (VALUES (0, 0, 0, '', ''), (1, 0, 1, '', ''), (2, 0, 2, '', ''), (3, 0, 3, '', ''),
             (0, 3, 2, 'I', 'user:' || chr(10)), (1, 3, 2, 'I', 'user:' || chr(10)), (2, 3, 3, 'I', 'assistant:' || chr(10)), (3, 3, 2, 'I', 'user:' || chr(10)),
             (0, 6, 3, 'II', 'user:' || chr(10) || 'assistant:' || chr(10)), (1, 6, 3, 'II', 'user:' || chr(10) || 'assistant:' || chr(10)),
             (3, 6, 3, 'II', 'user:' || chr(10) || 'assistant:' || chr(10)), (2, 6, 2, 'II', 'assistant:' || chr(10) || 'user:' || chr(10))),
step(z, x, t) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
turnto(z, who, t) AS (VALUES (0, 'user', 2), (1, 'user', 2), (2, 'assistant', 3), (3, 'user', 2)),
edit AS (SELECT conv_id, i, z, z AS t, 4 AS cost, 'D' AS e, '' AS line FROM r, (SELECT unnest(range(4)) AS z)
         UNION ALL SELECT conv_id, i, z, t, 3 * (fault = 'truncated')::INT, 'K', role || ':' || text || chr(10) FROM r JOIN step USING (x)
                   WHERE fault IN ('', 'truncated')
         UNION ALL SELECT conv_id, i, z, t, 3 + 3 * (fault = 'truncated')::INT, 'R', who || ':' || text || chr(10) FROM r, turnto
                   WHERE fault IN ('', 'truncated')),
hop AS (SELECT conv_id, i, s, t, k + cost AS cost, pre || e AS audit, lines || line AS line FROM edit JOIN ins USING (z)),
path AS (SELECT conv_id, 0::BIGINT AS i, 0 AS s, {'cost': 0, 'audit': '', 'out': ''} AS best FROM c
         UNION ALL
         SELECT p.conv_id, p.i + 1, h.t, min({'cost': p.best.cost + h.cost, 'audit': p.best.audit || h.audit, 'out': p.best.out || h.line})
         FROM path p JOIN hop h ON h.conv_id IS NOT DISTINCT FROM p.conv_id AND h.i = p.i + 1 AND h.s = p.s GROUP BY p.conv_id, p.i + 1, h.t),
done AS (SELECT c.conv_id, min({'cost': best.cost + length(tail) * 3, 'audit': best.audit || tail, 'out': best.out || lines}) AS best
         FROM path JOIN c ON path.conv_id IS NOT DISTINCT FROM c.conv_id AND i = n
         JOIN (VALUES (0, '', ''), (1, 'II', 'user:' || chr(10) || 'assistant:' || chr(10)), (2, 'I', 'assistant:' || chr(10)), (3, '', '')) AS e(s, tail, lines) USING (s)
         GROUP BY c.conv_id)
SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, CAST(coalesce(best.cost, 0) AS BIGINT) AS cost, coalesce(best.audit, '') AS audit,
       sha256(coalesce(left(best.out, -1), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN c ON a.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN done ON a.conv_id IS NOT DISTINCT FROM done.conv_id
""")
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged by the fixed rule and repaired."""
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    report = conversation_repair.repair_report(conversation_repair.repair_conversations(conversation_repair.damage(given)))
    ids = given.select(F.col("conv_id").alias("c")).distinct()
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return ids.join(report, F.col("c").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("c").alias("conv_id"), *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
