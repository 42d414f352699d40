"""Token counts by the library's own encoder, huge documents by overlapping chunks that are spliced."""

from __future__ import annotations

import os

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism

from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from tessera.llm.bpe import memo, pieces
from tessera.llm.rows import id_and_text, ship_package

CHUNK, OVERLAP = 32_768, 512
GAP = regex.compile(r"[\x20\x09-\x0D]")


@lru_cache(maxsize=4)
def _library(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


class ChunkCounter:
    """Counts tokens of texts of any length while the library sees bounded chunks.

    A boundary is stable where ASCII white space stands between two tokens: this tokenizer
    family drops white space, normalises no further than to it, and no special string holds
    any, so what lies on either side is encoded alike whatever lies on the other.
    """

    def __init__(self, path: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> None:
        self.library, self.chunk, self.overlap = _library(path), chunk, overlap
        self.memo = memo(f"counts:{path}", 300_000)

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of each text: one chunk at most by its units between stable boundaries (their
        counts are remembered), longer ones chunk by chunk."""
        split = [t.encode().split() if len(t) <= self.chunk else [] for t in texts]
        known = self.memo.resolve(split, self._new)
        return [sum(map(known.__getitem__, u)) if len(t) <= self.chunk else self.spliced(t) for t, u in zip(texts, split, strict=True)]

    def _new(self, units: list[bytes]) -> list[int]:
        return [len(e.ids) for e in self.library.encode_batch([u.decode() for u in units], add_special_tokens=False)]

    def _chunk(self, text: str, lo: int, hi: int) -> tuple[list[int], list[int]]:
        """Ids and first characters of the tokens of text[lo:hi], as places in the whole text."""
        e = self.library.encode(text[lo:hi], add_special_tokens=False)
        return e.ids, [lo + a for a, _ in e.offsets]

    def spliced(self, text: str) -> int:
        """Overlapping chunks with offsets, spliced at a stable boundary on which both agree. The
        overlap is widened where they show none, and past a whole chunk the chunk itself is."""
        total, lo, hi = 0, 0, min(self.chunk, len(text))
        ids, starts = self._chunk(text, lo, hi)
        begin = 0  # tokens of the chunk before this one are already counted
        while hi < len(text):
            overlap, cut = self.overlap, None
            while cut is None and overlap < hi - lo:
                nxt = hi - overlap
                to = min(nxt + max(self.chunk, 2 * overlap), len(text))
                ids2, starts2 = self._chunk(text, nxt, to)
                cut = self._agree(text, nxt, hi, ids, starts, ids2, starts2)
                overlap *= 2
            if cut is None:  # no stable boundary in all of the chunk
                hi = min(len(text), lo + 2 * (hi - lo))
                at = starts[begin] if begin < len(starts) else hi
                ids, starts = self._chunk(text, lo, hi)
                begin = bisect_left(starts, at) if begin else 0
                continue
            total += bisect_left(starts, cut) - begin
            lo, hi, ids, starts = nxt, to, ids2, starts2
            begin = bisect_left(starts, cut)
        return total + len(ids) - begin

    @staticmethod
    def _agree(text, nxt, hi, ids, starts, ids2, starts2) -> int | None:
        """The first white space in the overlap from which both chunks have the same tokens, up to
        the overlap's last white space; None if there are not two of them or the tokens differ."""
        first = GAP.search(text, nxt, hi)
        last = GAP.search(text[nxt:hi][::-1])
        if first is None or last is None or (end := hi - 1 - last.start()) <= first.start():
            return None
        a, b = bisect_left(starts, first.start()), bisect_left(starts, end)
        c, d = bisect_left(starts2, first.start()), bisect_left(starts2, end)
        same = ids[a:b] == ids2[c:d] and starts[a:b] == starts2[c:d]
        return first.start() if same and b > a else None


def token_counts(df: DataFrame, vocabulary: str, limit: int = 2048, chunk: int = CHUNK, overlap: int = OVERLAP,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokens of every whole text as the library counts them, without added special tokens.

    Returns one row per input row: (``id_col``, n_bytes, n_tokens, over_limit). A map without a
    shuffle. ``vocabulary`` is the path of a word BPE file (white space dropped) that every
    executor can read. Texts past ``chunk`` characters are encoded in chunks that overlap by
    ``overlap`` and spliced, so memory is bounded by the chunk, unless white space is absent.

    Null text counts as empty (0 bytes, 0 tokens). Null ids and repeated rows pass through. An
    empty table gives no rows.
    """
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = ChunkCounter(vocabulary, chunk, overlap)
        for b in batches:
            texts = b.column(1).to_pylist()
            n = [x for lo, hi in pieces(texts) for x in counter.count(texts[lo:hi])]
            size = [len(t.encode()) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(size, pa.int64()), pa.array(n, pa.int64()),
                 pa.array([x > limit for x in n], pa.bool_())], [id_col, "n_bytes", "n_tokens", "over_limit"])

    rows = id_and_text(df, id_col, text_col)
    return rows.mapInArrow(run, f"`{id_col}` {dict(rows.dtypes)['id']}, n_bytes long, n_tokens long, over_limit boolean")
