"""Substring dedup: rolling hashes of every fixed-length word window, repeated ones removed as intervals."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.bpe import pieces
from tessera.llm.rolling import BASE_A, BASE_B, BASE_K, mix, sliding, windows, word_hashes
from tessera.llm.rows import WORD_GAP, id_and_text, ship_package, stage, unique_ids

#: Words in a sub-window by whose smallest hash windows are paired before they are counted.
SUB = 8
#: What a task gathers before it combines and sends (occurrences or windows).
FLUSH = 1_500_000
#: Stands for all windows of a document.
WHOLE = -1


class _Group:
    """Word windows of some texts, as arrays over all their words in a row."""

    def __init__(self, texts: list[bytes], n: int, sub: int) -> None:
        words, self.other, first = word_hashes(texts)
        self.words, self.first = words, first
        doc = np.repeat(np.arange(len(texts)), np.diff(first))
        size = max(len(words) - n + 1, 0)
        self.doc = doc[:size]
        self.whole = doc[n - 1:] == self.doc if size else np.zeros(0, bool)  # windows inside one text
        self.sub = windows(words, sub, BASE_K)
        self.low = sliding(self.sub, n - sub + 1, np.minimum) if size else self.sub[:0]

    def anchors(self, n: int, sub: int) -> tuple[np.ndarray, np.ndarray]:
        """Texts and sub-window hashes of the places where a sub-window is its window's smallest."""
        low = np.where(self.whole, self.low, np.uint64(0))
        if not len(low):
            return np.zeros(0, np.int64), low
        pad = np.zeros(n - sub, dtype=np.uint64)
        top = sliding(np.concatenate([pad, low, pad]), n - sub + 1, np.maximum)
        at = np.flatnonzero(top == self.sub)
        ends = np.searchsorted(self.first, at, side="right") - 1
        return ends, self.sub[at]


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _runs(doc: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of consecutive starts: (doc, first, last + 1); input sorted by both."""
    if not len(doc):
        return doc, start, start
    new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (start[1:] != start[:-1] + 1)])
    last = np.concatenate([new[1:], [True]])
    return doc[new], start[new], start[last] + 1


def substring_dedup(df: DataFrame, n: int = 20, sub: int = SUB, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Remove every word covered by a window of ``n`` words that also starts earlier.

    Words are maximal runs without space and U+0009-U+000D, taken unchanged. Earlier means a
    smaller id, or the same document and an earlier start; windows are judged on the input.
    Returns one row per input row: (``id_col``, n_words, n_removed, removed, kept_text);
    ``removed`` holds maximal intervals [start, end) of word numbers, ``kept_text`` the kept
    words joined by one space.

    Of documents with equal word sequences only the smallest id goes on; the others lose all
    their windows. Every window gets two Rabin-Karp hashes of its words (64 and 32 bits, from two independent
    hashes of each word). Before windows are counted,
    they are paired by the smallest hash of their ``sub``-word sub-windows: equal windows have
    equal smallest sub-windows, so a window whose smallest sub-window stands at one place of
    the corpus is provably single and need not be sent. This changes no result and cuts the
    shuffle by an order. Tasks combine before they send: of one window (or sub-window) a flush
    sends its first occurrence only, the rest being known as repeated, so a passage that a
    third of all documents share costs one row a flush. Repeated windows merge into intervals.

    Null text counts as empty, without words. Texts shorter than ``n`` words lose nothing.
    Repeated or null ids: see ``unique_ids``; the later of two equal rows loses its words. An
    empty table gives no rows.
    """
    ship_package(df.sparkSession)
    docs, plain = unique_ids(id_and_text(df, id_col, text_col), "substring-rows")
    # the filter drops nothing; with it, one exchange of the texts serves the three joins below
    text = docs.select("rid", "text").where("rid IS NOT NULL")

    digest = F.unhex(F.md5(F.trim(F.regexp_replace("text", WORD_GAP, " "))))
    digests = stage(text.select("rid", digest.alias("d")), "substring-digests")
    first = stage(digests.groupBy("d").agg(F.min("rid").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1"), "substring-first")
    copies = stage(digests.join(first, "d").where("rid <> first").select("rid"), "substring-copies")
    originals = text.join(copies, "rid", "left_anti")

    def find_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def combined(rids: list[np.ndarray], values: list[np.ndarray]) -> pa.RecordBatch:
            rid, v = np.concatenate(rids), np.concatenate(values)
            order = np.lexsort((rid, v))
            rid, v = rid[order], v[order]
            first = np.concatenate([[True], v[1:] != v[:-1]])
            single = first & np.concatenate([first[1:], [True]])
            keep = first | np.concatenate([[True], rid[1:] != rid[:-1]])  # one row for each value and document
            rid, v, first, single = rid[keep], v[keep], first[keep], single[keep]
            key = np.where(first, v, mix(v ^ mix(rid.view(np.uint64))))
            return pa.RecordBatch.from_arrays(
                [_signed(key), pa.array(v.view(np.int64), mask=first), pa.array(rid), pa.array(~single)],
                ["key", "v", "rid", "twice"])

        rids, values, held = [], [], 0
        for b in batches:
            ids, texts = b.column(0).to_numpy(), b.column(1).cast(pa.binary()).to_pylist()
            for lo, hi in pieces(texts):
                at, v = _Group(texts[lo:hi], n, sub).anchors(n, sub)
                rids.append(ids[lo:hi][at])
                values.append(v)
                held += len(v)
                if held > FLUSH:
                    yield combined(rids, values)
                    rids, values, held = [], [], 0
        if held:
            yield combined(rids, values)

    found = originals.mapInArrow(find_anchors, "key long, v long, rid long, twice boolean")
    by_key = Window.partitionBy("key").orderBy("rid")
    again = F.col("twice") | F.lag("rid").over(by_key).isNotNull() | F.lead("rid").over(by_key).isNotNull()
    shared = (found.select(F.coalesce("v", "key").alias("v"), "rid", again.alias("again")).where("again")
              .groupBy("rid").agg(F.collect_list("v").alias("anchors")))

    def count_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def combined(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
            a, b, rid, start = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.lexsort((start, rid, b, a))
            a, b, rid, start = a[order], b[order], rid[order], start[order]
            first = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
            later, lead = np.flatnonzero(~first), np.flatnonzero(first)
            later = later[np.lexsort((start[later], rid[later]))]
            lead = lead[np.lexsort((start[lead], rid[lead]))]  # neighbours share bytes, which shuffles compress
            doc, lo, hi = _runs(rid[later], start[later])
            spread = mix(mix(doc.view(np.uint64)) ^ lo.astype(np.uint64))
            gone = np.concatenate([np.zeros(len(lead), bool), np.ones(len(doc), bool)])
            low = np.concatenate([b[lead], spread]).astype(np.uint32).view(np.int32)
            return pa.RecordBatch.from_arrays(
                [_signed(np.concatenate([a[lead], spread])), pa.array(low), pa.array(np.concatenate([rid[lead], doc])),
                 pa.array((np.concatenate([start[lead], lo]) << 32) + np.concatenate([start[lead] + 1, hi])), pa.array(gone)],
                ["a", "b", "rid", "se", "gone"])

        held, size = [], 0
        for b in batches:
            ids, texts = b.column(0).to_numpy(), b.column(1).cast(pa.binary()).to_pylist()
            lists = b.column(2)
            for lo, hi in pieces(texts):
                g = _Group(texts[lo:hi], n, sub)
                part = lists.slice(lo, hi - lo)
                owner = np.repeat(np.arange(hi - lo), part.value_lengths().to_numpy())
                salt = mix(np.arange(hi - lo, dtype=np.uint64))
                known = part.flatten().to_numpy().view(np.uint64) ^ salt[owner]
                pick = np.flatnonzero(g.whole & np.isin(g.low ^ salt[g.doc], known)) if len(g.doc) else g.doc
                start = pick - g.first[g.doc[pick]]
                held.append((windows(g.words, n, BASE_A)[pick], windows(g.other, n, BASE_B)[pick] & np.uint64(0xFFFFFFFF), ids[lo:hi][g.doc[pick]], start))
                size += len(pick)
                if size > FLUSH:
                    yield combined(held)
                    held, size = [], 0
        if size:
            yield combined(held)

    counted = text.join(shared, "rid").select("rid", "text", "anchors").mapInArrow(
        count_windows, "a long, b int, rid long, se long, gone boolean")
    earlier = F.row_number().over(Window.partitionBy("a", "b", "gone").orderBy("rid", "se")) > 1
    spans = (counted.select("rid", "se", (F.col("gone") | earlier).alias("out")).where("out").select("rid", "se")
             .unionAll(copies.select("rid", F.lit(WHOLE).alias("se")))
             .groupBy("rid").agg(F.collect_list("se").alias("spans")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, spans = b.column(1).cast(pa.binary()).to_pylist(), b.column(2)
            n_words, n_removed, removed, kept = [], [], [], []
            for i, t in enumerate(texts):
                words = t.split()
                gaps: list[dict] = []
                if spans[i].is_valid:
                    se = spans[i].values.to_numpy()
                    if se[0] == WHOLE:  # an equal document stands earlier: all windows, if it has any
                        se = np.array([max(len(words) - n + 1, 0)])
                    change = np.zeros(len(words) + 1, dtype=np.int64)
                    lo, hi = se >> 32, se & 0xFFFFFFFF
                    np.add.at(change, lo[hi > lo], 1)
                    np.add.at(change, hi[hi > lo] + n - 1, -1)
                    out = np.cumsum(change)[:-1] > 0
                    edge = np.diff(out.view(np.int8), prepend=0, append=0)
                    gaps = [{"start": x, "end": y} for x, y in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True)]
                    n_words.append(len(words))
                    words = [w for w, o in zip(words, out.tolist(), strict=True) if not o]
                else:
                    n_words.append(len(words))
                n_removed.append(n_words[-1] - len(words))
                removed.append(gaps)
                kept.append(b" ".join(words).decode())
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(removed, kind),
                 pa.array(kept, pa.string())], [id_col, "n_words", "n_removed", "removed", "kept_text"])

    kind = dict(docs.dtypes)["id"]
    joined = text.join(spans, "rid", "left")
    if plain:
        joined = joined.select(F.col("rid").cast(kind).alias("id"), "text", "spans")
    else:
        joined = joined.join(docs.select("rid", "id"), "rid").select("id", "text", "spans")
    return joined.mapInArrow(cut, f"`{id_col}` {kind}, n_words long, n_removed long, "
                                  "removed array<struct<start:int,end:int>>, kept_text string")
