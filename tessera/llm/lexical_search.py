"""Ranked lexical search: impact vectors in norm buckets, pruned by Cauchy-Schwarz and coordinate bounds, rescored in integers."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.rows import id_and_text, ship_package, stage, unique_ids

#: Characters of item texts that are searched for at once (one item may be longer); the bound of what is broadcast.
ITEM_CHARS = 4_000_000
#: Documents in a bucket, and documents of the greatest norms that are scored first, for thresholds to start from.
BUCKET, SEED = 4096, 2048
#: Room for rounding in the bounds, which are doubles; scores are integers.
SLACK = 1e-9

#: Maps a byte to itself in a term (A-Z to a-z), to a space elsewhere.
_TERM = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def terms(text: bytes, chunk: int = 1 << 22) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text: maximal runs of ASCII letters and digits and of all characters
    beyond ASCII, with A-Z in lower case, in lists of bounded size."""
    clean, lo = text.translate(_TERM), 0
    while lo < len(clean):
        hi = lo + chunk
        if hi < len(clean):
            hi = clean.find(b" ", hi)
            hi = len(clean) if hi < 0 else hi
        yield clean[lo:hi].split()
        lo = hi


def weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    """floor(1000 ln((2 N + 2) / (2 df + 1))) of each document frequency."""
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], dtype=np.int64)


Vectors = list[tuple[np.ndarray, np.ndarray]]


def item_vectors(texts: list[str]) -> tuple[dict[bytes, int], Vectors]:
    """The vocabulary of a block of items (numbers from 1), and each item's (term numbers from 0, counts)."""
    vocabulary: dict[bytes, int] = {}
    vectors = []
    for t in texts:
        found = Counter(x for part in terms(t.encode()) for x in part)
        ids = [vocabulary.setdefault(x, len(vocabulary) + 1) - 1 for x in found]
        vectors.append((np.array(ids, dtype=np.int64), np.array(list(found.values()), dtype=np.int64)))
    return vocabulary, vectors


class Best:
    """The ``k`` best (score, row id) so far of each item, with the thresholds that follow."""

    def __init__(self, k: int, floor: list[int]):
        self.k, self.floor = k, list(floor)
        self.rid = [np.empty(0, np.int64) for _ in floor]
        self.score = [np.empty(0, np.int64) for _ in floor]

    def add(self, i: int, rid: np.ndarray, score: np.ndarray) -> None:
        rid, score = np.concatenate([self.rid[i], rid]), np.concatenate([self.score[i], score])
        keep = np.lexsort((rid, -score))[:self.k]
        self.rid[i], self.score[i] = rid[keep], score[keep]
        if len(keep) == self.k:
            self.floor[i] = max(self.floor[i], int(self.score[i][-1]))


def search_bucket(items: Vectors, weight: np.ndarray, best: Best, rid: np.ndarray, norm: np.ndarray,
                  ends: np.ndarray, term: np.ndarray, impact: np.ndarray) -> Counter:
    """Bring a bucket's documents of greatest score into ``best``; returns how many documents each filter left.

    The bucket is a sparse matrix: ``ends`` (one more than rows) delimits each row's ``term`` and ``impact``.
    """
    seen = Counter()
    by_term = np.argsort(term, kind="stable")
    row = np.repeat(np.arange(len(rid)), np.diff(ends))[by_term]
    value = (weight[term] * impact)[by_term].astype(np.float64)
    known, first = np.unique(term[by_term], return_index=True)
    top = np.maximum.reduceat(value, first) if len(known) else value
    last = np.append(first[1:], len(value))
    length, square = float(norm.max()), norm * norm
    full = np.zeros(len(weight), np.int64)
    for i, (ids, count) in enumerate(items):
        floor = best.floor[i]
        if not len(ids) or math.sqrt(float((count * count).sum())) * length * (1 + SLACK) < floor:
            continue  # Cauchy-Schwarz: nothing in the bucket reaches the threshold
        seen["buckets"] += 1
        at = np.searchsorted(known, ids)
        here = known[np.minimum(at, len(known) - 1)] == ids
        at, q = at[here], count[here].astype(np.float64)
        if not len(at):
            continue
        # coordinates of greatest possible share come first; those behind cannot lift a document over the threshold alone
        share = q * top[at]
        order = np.argsort(-share, kind="stable")
        at, q, share = at[order], q[order], share[order]
        left = np.append(np.cumsum(share[::-1])[::-1], 0.0)
        if left[0] * (1 + SLACK) < floor:
            continue
        focus = min(int(np.count_nonzero(left * (1 + SLACK) >= max(floor, 1))), len(at))
        known_part, known_square = np.zeros(len(rid)), np.zeros(len(rid))
        for a, w in zip(at[:focus].tolist(), q[:focus].tolist(), strict=True):
            rows, x = row[first[a]:last[a]], value[first[a]:last[a]]
            known_part[rows] += w * x
            known_square[rows] += x * x
        rest = math.sqrt(float((q[focus:] ** 2).sum()))
        bound = known_part + np.minimum(rest * np.sqrt(np.maximum(square * (1 + SLACK) - known_square, 0)), left[focus])
        chosen = np.flatnonzero((bound * (1 + SLACK) >= floor) & (bound > 0))
        seen["documents"] += len(chosen)
        if not len(chosen):
            continue
        # survivors, exactly: their whole rows against the item
        full[ids] = count * weight[ids]
        size = ends[chosen + 1] - ends[chosen]
        begin = np.cumsum(size) - size
        cells = np.repeat(ends[chosen] - begin, size) + np.arange(int(size.sum()))
        score = np.add.reduceat(full[term[cells]] * impact[cells], begin)
        full[ids] = 0
        good = score >= max(floor, 1)
        best.add(i, rid[chosen][good], score[good])
    return seen


def _lists(values: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    flat = np.concatenate(values) if values else np.empty(0)
    ends = np.cumsum([0, *map(len, values)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, kind))


def _search_block(docs: DataFrame, texts: list[str], k: int) -> DataFrame:
    """(item, rid, score, rank) of the ``k`` best rows of ``docs`` (rid, text) for each item of a block."""
    spark = docs.sparkSession
    known_terms, items = item_vectors(texts)
    vocabulary = spark.sparkContext.broadcast(known_terms)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = vocabulary.value.get
        for b in batches:
            n, ids, tfs = [], [], []
            for text in b.column(1).cast(pa.binary()).to_pylist():
                total, found = 0, []
                for part in terms(text):
                    total += len(part)
                    known = np.fromiter(filter(None, map(find, part)), np.int64)
                    found.append(np.unique(known, return_counts=True))
                if len(found) == 1:
                    (x, c), = found
                else:
                    x, back = np.unique(np.concatenate([f[0] for f in found] or [np.empty(0, np.int64)]), return_inverse=True)
                    c = np.bincount(back, np.concatenate([f[1] for f in found] or [np.empty(0)]), len(x)).astype(np.int64)
                n.append(total)
                ids.append(x - 1)
                tfs.append(c)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), _lists(ids, pa.int32()), _lists(tfs, pa.int64())],
                                             ["rid", "n", "term", "tf"])

    counted = stage(docs.select("rid", "text").mapInArrow(count, "rid long, n long, term array<int>, tf array<long>"), "search-terms")
    n_docs, n_terms = counted.where("n > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(known_terms), np.int64)
    for t, c in counted.select(F.explode("term").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("c")).toLocalIterator():
        df[t] = c
    weight = weights(n_docs, df)
    shared = spark.sparkContext.broadcast((items, weight))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value[1]
        for b in batches:
            if not b.num_rows:
                continue
            ends = b.column(2).offsets.to_numpy().astype(np.int64)
            term, tf = b.column(2).flatten().to_numpy(), b.column(3).flatten().to_numpy()
            ends -= ends[0]
            m = np.array([75 + 25 * n * n_docs // n_terms for n in b.column(1).to_pylist()], dtype=np.int64)
            impact = 1_000_000_000 * tf // (1000 * tf + 12 * np.repeat(m, np.diff(ends)))
            norm = np.sqrt(np.add.reduceat((w[term] * impact).astype(np.float64) ** 2, ends[:-1]))  # no row is empty
            sizes = pa.array(ends.astype(np.int32))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(norm), pa.ListArray.from_arrays(sizes, pa.array(term, pa.int32())),
                                              pa.ListArray.from_arrays(sizes, pa.array(impact))], ["rid", "norm", "term", "impact"])

    vectors = counted.where("size(term) > 0").mapInArrow(weigh, "rid long, norm double, term array<int>, impact array<long>")
    order = [F.col("norm").desc(), F.col("rid")]
    vectors = stage(vectors.repartitionByRange(*order).sortWithinPartitions(*order), "search-buckets")

    def searcher(floor: list[int]):
        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            asked, w = shared.value
            best = Best(k, floor)
            for batch in batches:
                for lo in range(0, batch.num_rows, BUCKET):
                    b = batch.slice(lo, BUCKET)
                    ends = b.column(2).offsets.to_numpy().astype(np.int64)
                    search_bucket(asked, w, best, b.column(0).to_numpy(), b.column(1).to_numpy(), ends - ends[0],
                                  b.column(2).flatten().to_numpy(), b.column(3).flatten().to_numpy())
            if not best.rid:
                return
            item = np.repeat(np.arange(len(best.rid), dtype=np.int32), [len(r) for r in best.rid])
            yield pa.RecordBatch.from_arrays([pa.array(item), pa.array(np.concatenate(best.rid)), pa.array(np.concatenate(best.score))],
                                             ["item", "rid", "score"])
        return search

    place = Window.partitionBy("item").orderBy(F.col("score").desc(), "rid")

    def top(rows: DataFrame, floor: list[int]) -> DataFrame:
        found = rows.mapInArrow(searcher(floor), "item int, rid long, score long")
        return found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)

    floor = [0] * len(items)
    for item, score in top(vectors.orderBy(*order).limit(SEED), floor).where(F.col("rank") == k).select("item", "score").toLocalIterator():
        floor[item] = score
    return stage(top(vectors, floor), "search-top")


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The ``k`` documents of highest score for each row of ``items``: (``item_col``, rank, ``id_col``, score).

    Terms, weights, impacts and scores are whole numbers (see ``terms``, ``weights``): a
    document's impact of a term is (10^9 tf) div (1000 tf + 12 m) with m = 75 + (25 n N) div L, and its
    score the sum of weight times impact over the item's terms, repeats included. Scores above 0
    count; of equal scores the smaller id comes first.

    1. Items go in blocks of ``ITEM_CHARS`` characters, whose vocabulary and vectors are broadcast. All
       documents are counted against that vocabulary; corpus figures cover every document.
    2. Each document is a vector of weight times impact. Vectors are range-partitioned by length, greatest
       first, and read in buckets of ``BUCKET``. An item's threshold, its ``k``-th best score so far, starts
       from the ``SEED`` longest vectors and grows in each task.
    3. A bucket is skipped for an item when |item| times the bucket's greatest length is below the threshold.
       Else coordinates are taken by their greatest share in the bucket until the others cannot reach
       the threshold; a document stays if its sum there, with the least of two bounds on the rest
       (Cauchy-Schwarz on the remaining length, greatest shares), may reach it.
    4. Survivors are rescored from their whole vectors in 64-bit integers. Tasks return at most ``k`` rows an item.

    Null texts have no terms; an item without terms, like one whose terms no document has, gives no rows; null
    or repeated ids: see ``unique_ids`` (repeated items are answered one by one). Empty tables give no rows; further
    columns are ignored, whatever their names.
    """
    ship_package(docs.sparkSession)
    rows, plain = unique_ids(id_and_text(docs, id_col, text_col), "search-rows")
    asked, _ = unique_ids(id_and_text(items, item_col, item_text_col), "search-items")
    names = rows.select("rid", F.col("id").alias("doc"))
    kinds = dict(rows.dtypes)["id"], dict(asked.dtypes)["id"]
    found, keys, texts, held = [], [], [], 0

    def answer() -> None:
        block = _search_block(rows, texts, k)
        at = docs.sparkSession.createDataFrame([(i, r) for i, r in enumerate(keys)], "item int, item_rid long")
        found.append(block.join(F.broadcast(at), "item").select("item_rid", "rank", "rid", "score"))

    for rid, text in asked.select("rid", "text").toLocalIterator():
        keys.append(rid)
        texts.append(text)
        held += len(text)
        if held >= ITEM_CHARS:
            answer()
            keys, texts, held = [], [], 0
    if texts or not found:
        answer()
    out = found[0]
    for more in found[1:]:
        out = out.unionAll(more)
    out = out.join(asked.select(F.col("rid").alias("item_rid"), F.col("id").alias("item")), "item_rid")
    out = out.withColumn("doc", F.col("rid").cast(kinds[0])) if plain else out.join(names, "rid")
    return out.select(F.col("item").cast(kinds[1]).alias(item_col), F.col("rank").cast("int").alias("rank"), F.col("doc").alias(id_col), "score")
