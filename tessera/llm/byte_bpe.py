"""BPE encoding and decoding of whole texts with a byte-level vocabulary."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tessera.llm.bpe import memo, pieces, rank_table
from tessera.llm.rows import id_and_text, ship_package

#: How byte-level vocabularies of this kind part a text before merging; white
#: space is Unicode's White_Space property.
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
           r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")


class TextCodec:
    """Encode and decode texts with the vocabulary file at ``path``, special strings included."""

    def __init__(self, path: str) -> None:
        self.table = rank_table(path)
        self.find = regex.compile(PATTERN).findall
        names = sorted(self.table.special, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self.memo = memo(f"byte-bpe:{path}")

    def parts(self, text: str) -> list[str]:
        """The text in pieces that are encoded independently; special strings stand alone."""
        if self.special is None or "<" not in text or not self.special.search(text):
            return self.find(text)
        out = []
        for k, x in enumerate(self.special.split(text)):
            out += [x] if k % 2 else self.find(x)
        return out

    def _new(self, words: list[str]) -> list[bytes]:
        special = self.table.special
        ids = self.table.encode([b"" if w in special else w.encode() for w in words])
        return [np.array([special[w]], dtype="<u4").tobytes() if w in special else x for w, x in zip(words, ids, strict=True)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        split = [self.parts(t) for t in texts]
        known = self.memo.resolve(split, self._new)
        return [np.frombuffer(b"".join(map(known.__getitem__, p)), dtype="<u4") for p in split]

    def decode(self, ids: np.ndarray) -> str:
        return self.table.decode(ids).decode("utf-8", errors="replace")


def encode_texts(df: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token ids of every whole text: (``id_col``, ids array<int>). See ``round_trip`` for the cases."""
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = TextCodec(vocabulary)
        for b in batches:
            texts = b.column(1).to_pylist()
            for lo, hi in pieces(texts):
                ids = [x.astype(np.int32) for x in codec.encode(texts[lo:hi])]
                ends = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), pa.ListArray.from_arrays(ends, flat)],
                                                 [id_col, "ids"])

    rows = id_and_text(df, id_col, text_col)
    return rows.mapInArrow(run, f"`{id_col}` {dict(rows.dtypes)['id']}, ids array<int>")


def round_trip(df: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every whole text, decode the ids again, and return digests of both.

    Returns one row per input row: (``id_col``, n_tokens, ids_sha256, decoded_sha256): SHA-256
    of the decimal ids joined by commas, and of the decoded text in UTF-8. A map without any
    shuffle; a task holds a few million characters at once, and a bounded memo of words.

    ``vocabulary`` is the path of a byte-level BPE file that every executor can read. Null text
    counts as empty, which has no tokens. Very long texts are encoded whole (words past 64
    bytes with a heap). Null ids and repeated rows pass through. An empty table gives no rows.
    """
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = TextCodec(vocabulary)
        name = [str(i) for i in range(len(codec.table.blob_len))]
        sha = lambda x: hashlib.sha256(x).hexdigest()
        for b in batches:
            texts = b.column(1).to_pylist()
            n, ids_sha, text_sha = [], [], []
            for lo, hi in pieces(texts):
                for ids in codec.encode(texts[lo:hi]):
                    n.append(len(ids))
                    ids_sha.append(sha(",".join([name[i] for i in ids.tolist()]).encode()))
                    text_sha.append(sha(codec.decode(ids).encode()))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
                [id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = id_and_text(df, id_col, text_col)
    return rows.mapInArrow(run, f"`{id_col}` {dict(rows.dtypes)['id']}, n_tokens long, ids_sha256 string, decoded_sha256 string")
