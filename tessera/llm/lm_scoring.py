"""LM scoring with a weighted backoff automaton learnt from the corpus."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F

from tessera.llm.rows import id_and_text, ship_package, stage

#: The marks around a document; no word holds a line feed.
BEGIN, END = b"\n<", b"\n>"
#: Bytes of text that are counted and scored together.
BLOCK_BYTES = 8_000_000
#: Tokens of a document that are stepped through together with as many of others.
STRETCH = 64
#: Bytes that a task deals to blocks at once.
DEAL_BYTES = 32_000_000
#: Spark drops shuffle files at the end of a query that ran with this.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits in which every bit of the input reaches every bit of the output."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _longer(head: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Keys of the n-grams that a word makes of a context; even, while those of words are odd."""
    return _mix(head * np.uint64(0x9E3779B97F4A7C15) + word) & ~np.uint64(1)


def _word_keys(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), "<u8") | np.uint64(1)


_hash = xxhash.xxh3_64_digest
BEGIN_HASH, END_HASH = _hash(BEGIN), _hash(END)
BEGIN_KEY, END_KEY = _word_keys([BEGIN_HASH, END_HASH])


def _ranked(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order, and each key's place among them.

    Keys are sorted by their high bits with their own place in the low ones, since sorting plain numbers is several times
    faster than sorting places by them; the few that differ in low bits alone are put right after."""
    low = np.uint64((1 << max(1, (len(keys) - 1).bit_length())) - 1)
    packed = (keys & ~low) | np.arange(len(keys), dtype=np.uint64)
    packed.sort()
    order = (packed & low).astype(np.int64)
    high, there = packed & ~low, keys[order]
    for p in np.unique(high[1:][there[1:] < there[:-1]]):
        lo, hi = np.searchsorted(high, p, "left"), np.searchsorted(high, p, "right")
        order[lo:hi] = order[lo:hi][np.argsort(there[lo:hi], kind="stable")]
    there = keys[order]
    new = np.concatenate([[True], there[1:] != there[:-1]])[:len(keys)]
    place = np.empty(len(keys), dtype=np.int32)
    place[order] = np.cumsum(new, dtype=np.int32) - 1
    return there[new], place


def _pack(a: np.ndarray) -> bytes:
    """Numbers of eight bytes by significance of their bytes, without those that are zero in all, compressed."""
    width = (int(a.max()).bit_length() + 7) // 8 if len(a) and a.min() >= 0 else 8
    planes = a.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()
    return len(a).to_bytes(8, "little") + bytes([width]) + (pa.compress(planes, codec="zstd", asbytes=True) if planes else b"")


def _unpack(packed: bytes, kind: type = np.int64) -> np.ndarray:
    n, width = int.from_bytes(packed[:8], "little"), packed[8]
    out = np.zeros((n, 8), np.uint8)
    if n * width:
        planes = pa.decompress(packed[9:], decompressed_size=width * n, codec="zstd", asbytes=True)
        out[:, :width] = np.frombuffer(planes, np.uint8).reshape(width, -1).T
    return out.view(kind).ravel()


def _pack_keys(keys: np.ndarray) -> bytes:
    return _pack(np.diff(keys, prepend=np.uint64(0)))


def _unpack_keys(packed: bytes) -> np.ndarray:
    return np.cumsum(_unpack(packed, np.uint64), dtype=np.uint64)


class Block:
    """The tokens of some documents as rows of ``keys``, their distinct words and n-grams in order.

    ``word``, ``before``: rows of the token and of the word before it; ``two``: of the bigram
    they make; ``late``: which tokens have two before them; for those, ``pair`` and ``three``
    are rows of the bigram before and of the trigram. ``start``: first token of each document.
    """

    def __init__(self, texts: list[bytes], order: int) -> None:
        digests: list[bytes] = []
        for t in texts:
            digests += (BEGIN_HASH, b"".join(map(_hash, t.lower().split())), END_HASH)  # bytes: A-Z only, white space as agreed
        words = _word_keys(digests)
        del digests
        marks = words == BEGIN_KEY
        at = np.flatnonzero(~marks)
        self.late = np.flatnonzero(~marks[at - 1])
        grams = [words, _longer(words[at - 1], words[at])]
        if order == 3:
            grams.append(_longer(grams[1][self.late - 1], words[at[self.late]]))
        self.keys, row = _ranked(np.concatenate(grams))
        self.word, self.before = row[at], row[at - 1]
        self.two = row[len(words):len(words) + len(at)]
        self.pair, self.three = self.two[self.late - 1], row[len(words) + len(at):]
        self.order, self.begin = order, row[0]
        self.start = np.flatnonzero(marks[at - 1])

    def counts(self, train: np.ndarray) -> np.ndarray:
        """How often each row occurs in the documents that train."""
        size = len(self.keys)
        own = np.repeat(train, np.diff(self.start, append=len(self.word)))
        n = np.bincount(self.word[own], minlength=size) + np.bincount(self.two[own], minlength=size)
        n[self.begin] = train.sum()
        return n + np.bincount(self.three[own[self.late]], minlength=size) if self.order == 3 else n

    def contexts(self, c: np.ndarray) -> np.ndarray:
        """The rows that stand before a word and occur in training documents: every state is one."""
        seen = np.zeros(len(c), dtype=bool)
        seen[self.before] = True
        if self.order == 3:
            seen[self.pair] = True
        return np.flatnonzero(seen & (c > 0))

    def arcs(self, c: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each row the summed counts and the number of the arcs out of it that ``own`` marks."""
        head = np.full(len(c), -1, dtype=np.int32)
        head[self.two] = self.before
        if self.order == 3:
            head[self.three] = self.pair
        out = np.flatnonzero((own > 0) & (c > 0) & (head >= 0))
        total = np.bincount(head[out], weights=c[out], minlength=len(c)).astype(np.int64)  # exact below 2**53
        return total, np.bincount(head[out], minlength=len(c)).astype(np.int64)

    def walk(self, c: np.ndarray, unigram: np.ndarray, back: np.ndarray, arcs_out: np.ndarray, discount: float) -> np.ndarray:
        """P of each token, by one left-to-right traversal that carries the state.

        A state is the longest context with arcs (``arcs_out`` > 0): a bigram's row, a word's row or the root. Where the
        state has no arc for the token, its failure arc leads to the state of the shorter
        context and costs the back-off weight. All documents step together, in stretches of
        ``STRETCH`` tokens: the state at a later stretch's start is that of the two words before it.
        """
        root, n = len(c), len(self.word)
        states = arcs_out > 0
        own = np.where(states[self.word], self.word, root).astype(np.int32)  # the state of the token alone
        weight, after, level = np.append(back, 1.0), own, np.zeros(root + 1, np.int8)
        fail = np.full(root + 1, root, np.int32)
        fail[self.two] = own
        level[self.before], level[self.two] = 1, 2
        share = lambda gram, context: (c[gram] - discount) / np.maximum(c[context], 1)
        plain = unigram[self.word]
        lower = back[self.before] * plain
        has_two = c[self.two] > 0
        arc_two = share(self.two, self.before) + lower
        has_three, arc_three = np.zeros(n, bool), np.zeros(n)
        if self.order == 3:
            after = np.where(states[self.two], self.two, own).astype(np.int32)
            has_three[self.late] = c[self.three] > 0
            shorter = np.where(has_two, arc_two, lower)[self.late]
            arc_three[self.late] = share(self.three, self.pair) + back[self.pair] * shorter

        ends = np.append(self.start[1:], n)
        pieces = -(-(ends - self.start) // STRETCH)
        first = np.repeat(self.start, pieces)
        begin = first + STRETCH * (np.arange(len(first)) - np.repeat(np.cumsum(pieces) - pieces, pieces))
        size = np.minimum(np.repeat(ends, pieces) - begin, STRETCH)
        by_size = np.argsort(-size, kind="stable")
        begin, size, first = begin[by_size], size[by_size], first[by_size]
        state = np.where(begin == first, self.begin if states[self.begin] else root, after[begin - 1])
        p = np.empty(n)
        for t in range(int(size[0]) if len(size) else 0):
            at = begin[:np.searchsorted(-size, -t, "left")] + t
            s = state[:len(at)]
            high = level[s] == 2
            hit = high & has_three[at]
            fell = high & ~hit
            out = np.where(hit, arc_three[at], np.where(fell, weight[s], 1.0))
            s = np.where(fell, fail[s], s)
            mid = ~hit & (level[s] == 1)
            found = mid & has_two[at]
            out *= np.where(found, arc_two[at], np.where(mid, weight[s], 1.0))
            p[at] = np.where(hit | found, out, out * plain[at])
            state = after[at]
        return p

    def messages(self, block: int, parts: int, rows: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.Table:
        """Keys and two numbers of ``rows``, a message for each range of the keys."""
        keys = self.keys[rows]
        bounds = np.array([2**64 * i // parts for i in range(1, parts)], dtype=np.uint64)
        cut = [0, *np.searchsorted(keys, bounds).tolist(), len(keys)]
        some = [(i, lo, hi) for i, (lo, hi) in enumerate(zip(cut, cut[1:], strict=False)) if lo < hi]
        return pa.table({
            "part": pa.array([i for i, _, _ in some], pa.int32()), "block": pa.array([block] * len(some), pa.int32()),
            "keys": pa.array([_pack_keys(keys[lo:hi]) for _, lo, hi in some], pa.binary()),
            "a": pa.array([_pack(a[lo:hi]) for _, lo, hi in some], pa.binary()),
            "b": pa.array([_pack(b[lo:hi]) for _, lo, hi in some], pa.binary())})


def _deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents (block, id, held, text) packed by block: texts compress several times better than as rows."""
    def packed(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(rows)
        order = np.argsort(t.column("block").to_numpy(), kind="stable")
        t = t.take(pa.array(order))
        block = t.column("block").to_numpy()
        cut = [*np.flatnonzero(np.diff(block, prepend=-1)).tolist(), len(block)]
        docs = []
        for lo, hi in zip(cut, cut[1:], strict=False):
            sink = pa.BufferOutputStream()
            part = t.slice(lo, hi - lo).drop_columns("block").combine_chunks()
            with pa.ipc.new_stream(sink, part.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
                w.write_table(part)
            docs.append(sink.getvalue().to_pybytes())
        return pa.RecordBatch.from_arrays([pa.array(block[cut[:-1]], pa.int32()), pa.array(docs, pa.binary())], ["block", "docs"])

    rows, size = [], 0
    for b in batches:
        if len(b):
            rows.append(b)
            size += b.nbytes
        if size > DEAL_BYTES:
            yield packed(rows)
            rows, size = [], 0
    if rows:
        yield packed(rows)


def _dealt(left: pa.Table) -> pa.Table:
    return pa.concat_tables(pa.ipc.open_stream(x).read_all() for x in left.column("docs").to_pylist())


MESSAGE = "part int, block int, keys binary, a binary, b binary"
REPLY = "block int, part int, step int, a binary, b binary"


def _gathered(messages: pa.Table) -> tuple[list[int], np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lengths of the messages of one range of keys; the order by key; in that order, key, a, b and the first of each key."""
    keys = [_unpack_keys(k) for k in messages.column("keys").to_pylist()]
    a, b = (np.concatenate([_unpack(x) for x in messages.column(n).to_pylist()]) for n in "ab")
    sizes, keys = [len(k) for k in keys], np.concatenate(keys)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    return sizes, order, keys, a[order], b[order], np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))


def _replies(messages: pa.Table, step: int, sizes: list[int], order: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.Table:
    """``a`` and ``b`` (by key) back to each block in the order of its message."""
    cut = np.cumsum(sizes)[:-1]
    back = np.empty_like(order)
    back[order] = np.arange(len(order))
    a, b = ([_pack(np.ascontiguousarray(x)) for x in np.split(v[back], cut)] for v in (a, b))
    return pa.table({"block": messages.column("block"), "part": messages.column("part"), "step": pa.array([step] * len(sizes), pa.int32()),
                     "a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})


def _answer(replies: pa.Table, step: int) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of a block's messages of that step, in the order of its keys."""
    got = sorted((p, i) for i, (p, s) in enumerate(zip(replies.column("part").to_pylist(), replies.column("step").to_pylist(), strict=True)) if s == step)
    if not got:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate([_unpack(replies.column(n)[i].as_py()) for _, i in got]) for n in "ab")


def score_documents(df: DataFrame, order: int = 3, min_count: int = 2, discount: float = 0.75,
                    held_out_mod: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Score every whole text with an n-gram model of all training documents.

    A document trains unless crc32 of its id as text, modulo ``held_out_mod``, is 0. A-Z is
    lower-cased; tokens are words without space and U+0009-U+000D, then one end token. Returns
    per row (``id_col``, held_out, n_tokens, n_known, train_tokens, base_score, score): the
    add-0.1 unigram score and the automaton's log10 probability.

    States of the automaton are contexts with stored continuations; the arcs are all n-grams (2
    to ``order`` <= 3) that occur ``min_count`` times or more in the training texts, whatever
    their words and the size of the corpus. P(w | h) = (c(hw) - D) / c(h) + b(h) P(w | h') on a
    stored arc, else b(h) P(w | h') by the failure arc to the shorter context h', where b(h) is
    what the stored arcs leave, so every state's distribution sums to one. At the root, P(w) =
    (c(w) - D1) / N, and the D1 V / N taken off is the mass of unknown words.

    Nothing of the model is collected or broadcast but five totals. Documents are dealt to
    hashed blocks of bounded bytes. A block sends the 64-bit keys of its distinct words and
    n-grams, with their counts, to ranges of keys; a range adds up and answers each block
    with the totals of its own keys, and names one block to stand for each arc. Those blocks
    send what arcs leave their contexts the same way, and so each block holds the part of the automaton
    that its documents can reach. A key is sent once a block, however frequent it is.

    Null text counts as empty (its one token is the end). A null id counts as empty text for
    the hold-out. Repeated rows are separate documents. An empty table gives no rows; without
    any training document every word is unknown.
    """
    if order not in (2, 3):
        raise ValueError("order: 2 or 3")
    spark = df.sparkSession
    ship_package(spark)
    docs = id_and_text(df, id_col, text_col).withColumn(
        "held", F.crc32(F.coalesce(F.col("id").cast("string"), F.lit(""))) % held_out_mod == 0)
    parts = max(1, math.ceil((docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) / BLOCK_BYTES))
    rows = docs.withColumn("block", F.pmod(F.xxhash64("id", F.crc32("text")), F.lit(parts)).cast("int")).select("block", "id", "held", "text")

    def blocks() -> GroupedData:
        return rows.mapInArrow(_deal, "block int, docs binary").repartition(parts, "block").groupBy("block")

    def tokens(docs: pa.Table) -> Block:
        return Block([t for x in docs.column("text").chunks for t in x.cast(pa.binary()).to_pylist()], order)

    def staged(build: Callable[[], DataFrame], name: str) -> DataFrame:
        """Staged, and the shuffle files of it are dropped at once."""
        before = spark.conf.get(DROP_SHUFFLES, "false")
        spark.conf.set(DROP_SHUFFLES, "true")
        try:
            return stage(build(), name)
        finally:
            spark.conf.set(DROP_SHUFFLES, before)

    def send_counts(left: pa.Table) -> pa.Table:
        docs = _dealt(left)
        x = tokens(docs)
        c = x.counts(~docs.column("held").to_numpy())
        return x.messages(left.column("block")[0].as_py(), parts, np.arange(len(c)), c, np.zeros_like(c))

    def add_counts(messages: pa.Table) -> pa.Table:
        sizes, by, keys, c, _, first = _gathered(messages)
        each = np.diff(first, append=len(keys))
        total = np.add.reduceat(c, first)
        key = keys[first]
        word = (key & np.uint64(1)) > 0
        kept = np.where(word | (total >= min_count), total, 0)
        gram = np.repeat(np.arange(len(first)), each)
        train = np.flatnonzero(c > 0)
        one = np.zeros(len(c), dtype=np.int64)  # the first block that trains on it stands for an arc
        one[train[np.concatenate([[True], gram[train[1:]] != gram[train[:-1]]])[:len(train)]]] = 1
        token = total[word & (key != BEGIN_KEY)]
        plain = total[word & (key != BEGIN_KEY) & (key != END_KEY)]
        out = _replies(messages, 1, sizes, by, np.repeat(kept, each), one)
        for name, n in (("n", token.sum()), ("v", (token > 0).sum()), ("once", (plain == 1).sum()), ("twice", (plain == 2).sum())):
            out = out.append_column(name, pa.array([int(n)] + [0] * (len(sizes) - 1), pa.int64()))
        return out

    counted = staged(lambda: blocks().applyInArrow(send_counts, MESSAGE).groupBy("part").applyInArrow(
        add_counts, f"{REPLY}, n long, v long, once long, twice long"), "lm-counts")
    sums = counted.agg(*[F.coalesce(F.sum(x), F.lit(0)).alias(x) for x in ("n", "v", "once", "twice")]).first()
    n, v = sums.n, sums.v
    d1 = min(max(sums.once / max(sums.once + 2 * sums.twice, 1), 0.1), 0.9)
    counts = counted.select("block", "part", "step", "a", "b")

    def send_arcs(left: pa.Table, right: pa.Table) -> pa.Table:
        x = tokens(_dealt(left))
        c, own = _answer(right, 1)
        total, number = x.arcs(c, own)
        rows = x.contexts(c)
        return x.messages(left.column("block")[0].as_py(), parts, rows, total[rows], number[rows])

    def add_arcs(messages: pa.Table) -> pa.Table:
        sizes, by, keys, a, b, first = _gathered(messages)
        each = np.diff(first, append=len(keys))
        return _replies(messages, 2, sizes, by, *(np.repeat(np.add.reduceat(x, first), each) for x in (a, b)))

    arcs = staged(lambda: blocks().cogroup(counts.groupBy("block")).applyInArrow(send_arcs, MESSAGE).groupBy("part").applyInArrow(add_arcs, REPLY), "lm-arcs")
    kind = dict(docs.dtypes)["id"]

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        docs = _dealt(left)
        x = tokens(docs)
        c, _ = _answer(right, 1)
        rows = x.contexts(c)
        total, number = _answer(right, 2)
        back, arcs_out = np.ones(len(c)), np.zeros(len(c), np.int64)
        arcs_out[rows] = number
        back[rows] = (c[rows] - total + discount * number) / c[rows]
        unigram = np.where(c > 0, (c - d1) / max(n, 1), d1 * v / n if n else 1.0)
        base = np.log10((c + 0.1) / (n + 0.1 * (v + 1)))
        add = lambda a: np.add.reduceat(a, x.start)
        return pa.table({id_col: docs.column("id"), "held_out": docs.column("held"),
                         "n_tokens": pa.array(np.diff(x.start, append=len(x.word)), pa.int64()),
                         "n_known": pa.array(add((c[x.word] > 0).astype(np.int64)), pa.int64()),
                         "train_tokens": pa.array([n] * len(x.start), pa.int64()), "base_score": pa.array(add(base[x.word]), pa.float64()),
                         "score": pa.array(add(np.log10(x.walk(c, unigram, back, arcs_out, discount))), pa.float64())})

    return blocks().cogroup(counts.unionByName(arcs).groupBy("block")).applyInArrow(
        score, f"`{id_col}` {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
