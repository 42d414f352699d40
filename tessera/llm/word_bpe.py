"""Token ids of whole texts under a lower-casing word BPE (``</w>`` vocabularies)."""

from __future__ import annotations

import os

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism

from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from tessera.llm.bpe import rank_table

#: How this kind of vocabulary parts a lower-cased unit without white space.
PATTERN = r"('s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{L}\p{N}]+)"
#: Units of characters that normalisation only lower-cases, one by one; others go through the library.
PLAIN = r"^[\x21-\x7E¡-¬®-įı-ſ‐-…€]*$"
#: Bytes a memo may hold, about a million short words.
MEMO_BYTES = 32 << 20


class IdMemo:
    """A memo from strings to ids as two Arrow arrays of ``limit`` bytes at most. When full it
    keeps the strings asked for last, if these fit."""

    def __init__(self, limit: int) -> None:
        self.limit = limit
        self.keys, self.ids = pa.array([], pa.large_string()), pa.array([], pa.large_binary())

    def resolve(self, keys: pa.Array, make: Callable[[pa.Array], pa.Array]) -> pa.Array:
        """Ids of distinct strings, in their order; unknown ones are made together."""
        at = pc.index_in(keys, value_set=self.keys)
        fresh = keys.filter(at.is_null())
        known = pa.concat_arrays([self.ids, make(fresh)])
        at = at.fill_null(-1).to_numpy().astype(np.int64)
        at[at < 0] = np.arange(len(self.ids), len(known))
        out = known.take(pa.array(at))
        if self.keys.nbytes + fresh.nbytes + known.nbytes <= self.limit:
            self.keys, self.ids = pa.concat_arrays([self.keys, fresh]), known
        elif keys.nbytes + out.nbytes <= self.limit:
            self.keys, self.ids = keys, out
        return out


@lru_cache(maxsize=8)
def id_memo(name: str) -> IdMemo:
    """One memo per process and name; workers are reused, so it lasts over tasks."""
    return IdMemo(MEMO_BYTES)


@lru_cache(maxsize=4)
def _library(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


class WordIds:
    """Ids as the library gives them (no special tokens added), by units between ASCII white space.

    White space parts tokens, normalisation never reaches across it, and special strings
    hold none; so the ids of a text are those of its units, one after another. Arrow parts
    the texts and puts the ids together; only words not met before become Python objects.
    """

    def __init__(self, path: str) -> None:
        self.path, self.table = path, rank_table(path)
        self.units, self.words = id_memo(f"units:{path}"), id_memo(f"words:{path}")

    def _new(self, units: pa.Array) -> pa.Array:
        """Ids of units; plain ones are parted and merged together, the library sees the others."""
        plain = pc.and_not(pc.match_substring_regex(units, PLAIN), pc.match_substring(units, "<|"))
        parted = pc.replace_substring_regex(pc.utf8_lower(units.filter(plain)), PATTERN, r"\1 ")
        ids = self._joined(parted, self.words, self._merge)
        odd = units.filter(pc.invert(plain)).to_pylist()
        if not odd:
            return ids
        encoded = _library(self.path).encode_batch(odd, add_special_tokens=False)
        rest = pa.array([np.array(e.ids, dtype="<u4").tobytes() for e in encoded], pa.large_binary())
        plain = plain.to_numpy(zero_copy_only=False)
        at = np.where(plain, np.cumsum(plain) - 1, len(ids) + np.cumsum(~plain) - 1)
        return pa.concat_arrays([ids, rest]).take(pa.array(at))

    def _merge(self, words: pa.Array) -> pa.Array:
        found = words.cast(pa.large_binary()).to_numpy(zero_copy_only=False).tolist()
        return pa.array(self.table.encode(found), pa.large_binary())

    @staticmethod
    def _joined(texts: pa.Array, memo: IdMemo, make: Callable[[pa.Array], pa.Array]) -> pa.Array:
        """The ids of each text's parts between white space, one after another."""
        split = pc.ascii_split_whitespace(texts)
        parts = split.flatten().dictionary_encode()
        ids = memo.resolve(parts.dictionary, make).take(parts.indices)
        _, ends, data = ids.buffers()
        begin = np.frombuffer(ends, dtype=np.int64)[ids.offset:][split.offsets.to_numpy() - split.offsets[0].as_py()]
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(texts), [None, pa.py_buffer(begin), data])

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each UTF-8 text as little-endian unsigned 32-bit bytes."""
        return self._joined(pa.array(texts, pa.large_binary()).cast(pa.large_string()), self.units, self._new).to_pylist()
