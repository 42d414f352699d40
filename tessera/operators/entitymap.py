"""Entity rules that no built-in expresses, several in one Arrow stage over partitions."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


@dataclass(frozen=True)
class Rule:
    """What one output column (a DDL field) is made from: the columns it reads, parameters among them, and a function of their lists of values."""

    output: str
    reads: tuple[str, ...]
    make: Callable[..., list]


def map_entities(df: DataFrame, keep: Sequence[str], rules: Sequence[Rule]) -> DataFrame:
    """``keep`` and one column a rule, from a single ``mapInArrow`` stage.

    Only the columns that are kept or read cross into Python, under a declared schema; parameters are columns
    like others, so rows of different kinds pass through one stage. A column that is missing raises before anything runs."""
    reads = list(dict.fromkeys([*keep, *(c for r in rules for c in r.reads)]))
    missing = sorted(set(reads) - set(df.columns))
    if missing:
        raise ValueError(f"columns missing: {missing}")
    given = df.select(*reads)
    out = T.StructType([given.schema[c] for c in keep] + [f for r in rules for f in T.StructType.fromDDL(r.output)])
    shape = to_arrow_schema(out)
    place = {c: i for i, c in enumerate(reads)}
    work = [([place[c] for c in r.reads], r.make) for r in rules]
    kept = [place[c] for c in keep]

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values: dict[int, list] = {}
            for cols, _ in work:
                for i in cols:
                    if i not in values:
                        values[i] = b.column(i).to_pylist()
            made = [fn(*[values[i] for i in cols]) for cols, fn in work]
            arrays = [b.column(i) for i in kept] + [pa.array(m, f.type) for m, f in zip(made, list(shape)[len(kept):], strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, schema=shape)

    return given.mapInArrow(mapped, out)


def name_rule(output: str, name: str, joiner: str) -> Rule:
    """The key of a name: NFKD without marks, lower case, runs of a-z and 0-9 joined by the row's ``joiner``; NULL if nothing is left."""
    word = re.compile(r"[a-z0-9]+")
    normal, combining = unicodedata.normalize, unicodedata.combining  # by value: workers need no package of ours

    def make(names: list, joiners: list) -> list:
        def key(x, j):
            plain = x if x.isascii() else "".join(c for c in normal("NFKD", x) if not combining(c))
            return j.join(word.findall(plain.lower())) or None
        return [None if x is None or j is None else key(x, j) for x, j in zip(names, joiners, strict=True)]

    return Rule(f"{output} string", (name, joiner), make)


def id_rule(output: str, code: str, width: str, parent_digits: str) -> Rule:
    """``struct<id, parent>`` of a code of digits: padded with zeros to the row's ``width``, and its first
    ``parent_digits``; NULL for other codes and longer ones."""
    def make(codes: list, widths: list, parents: list) -> list:
        def one(c, w, p):
            if c is None or w is None or p is None or not (c.isascii() and c.isdigit()) or len(c) > w:
                return None
            full = c.rjust(w, "0")
            return {"id": full, "parent": full[:p]}
        return [one(c, w, p) for c, w, p in zip(codes, widths, parents, strict=True)]

    return Rule(f"{output} struct<id: string, parent: string>", (code, width, parent_digits), make)
