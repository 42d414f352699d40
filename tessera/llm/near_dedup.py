"""Near-dedup on word shingles: fast similarity sketching, banding, exact verification, components."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.bpe import pieces
from tessera.llm.components import connected_components
from tessera.llm.rolling import BASE_A, mix, windows, word_hashes
from tessera.llm.rows import id_and_text, ship_package, stage, unique_ids

#: Coordinates of a band; one byte each, so a band is one long.
ROWS = 8
#: A pair at the threshold shares no band with at most this probability.
MISS = 1e-6
#: Times the coordinates that a second sketch has, for members that have to be compared in earnest.
WIDE = 4
#: Members of a bucket that are compared in one piece.
BLOCK = 2048


def n_bands(threshold: float) -> int:
    """Bands of ``ROWS`` coordinates that keep the miss of a pair at the threshold under ``MISS``."""
    return math.ceil(math.log(MISS) / math.log1p(-threshold ** ROWS))


def shingle_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each lower-cased text; fewer than ``size`` words
    make one shingle, no word makes none."""
    one, two, first = word_hashes([t.lower() for t in texts])
    words = one ^ mix(two)
    rolled = windows(words, size, BASE_A)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= size:
            out.append(np.unique(rolled[a:b - size + 1]))
        elif b > a:
            out.append(windows(words[a:b], b - a, BASE_A) + np.uint64(b - a))
        else:
            out.append(words[:0])
    return out


def fast_sketch(items: np.ndarray, t: int) -> np.ndarray:
    """Fast similarity sketch of a non-empty set: ``t`` one-byte coordinates.

    Round i puts every item into one bin: for i < t a hashed bin, for i >= t bin i - t, with the
    value (round, hash); a bin keeps its smallest value. Rounds go on until every bin is filled,
    which the rounds from t on guarantee. Two sets agree in a coordinate with probability equal
    to their Jaccard similarity, and the number of agreements is concentrated about it.
    """
    best = np.full(t, np.iinfo(np.uint64).max, dtype=np.uint64)
    i, step = 0, int(1.3 * t * math.log(t) / len(items)) + 2
    while i < 2 * t:
        rounds = np.arange(i, min(i + step, 2 * t), dtype=np.uint64)
        x = mix(items[None, :] ^ mix(rounds + np.uint64(0x51ED))[:, None])
        bins = ((x >> np.uint64(32)) * np.uint64(t)) >> np.uint64(32)
        late = rounds >= t
        if late.any():
            bins[late] = (rounds[late] - np.uint64(t))[:, None]
        value = (rounds << np.uint64(32))[:, None] | (x & np.uint64(0xFFFFFFFF))
        np.minimum.at(best, bins.ravel().astype(np.int64), value.ravel())
        if best.max() != np.iinfo(np.uint64).max:
            break
        i += step
    return (mix(best) & np.uint64(0xFF)).astype(np.uint8)


def _longs(rows: list[bytes], width: int) -> pa.Array:
    """Byte rows of ``width`` longs as array<long>."""
    flat = pa.array(np.frombuffer(b"".join(rows), dtype=np.int64))
    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * width), flat)


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    return np.ascontiguousarray(column.flatten().to_numpy()).view(np.uint8).reshape(-1, 8 * width)


def near_dedup(df: DataFrame, threshold: int = 80, shingle: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Components of documents linked by 100 * intersection >= ``threshold`` * union of their
    shingle sets (distinct runs of ``shingle`` words after lower-casing A-Z).

    Returns one row per input row: (``id_col``, n_shingles, component_id, kept); component_id is
    the smallest id reachable over links, and the row that bears it is kept.

    1. Every text is sketched (``fast_sketch``). Texts of one set form a class (128-bit set
       key); only class representatives go on, so copies are never expanded into pairs.
    2. Representatives that agree in all ``ROWS`` coordinates of a band share a bucket. Each
       member is paired with its bucket's smallest member (a star: as many pairs as members),
       sketches drop pairs that are 5 standard deviations below the threshold, and the rest is
       confirmed on full sets. Components follow by star contraction.
    3. In a bucket whose members are then all in one component there is nothing left to find.
       Elsewhere, every member outside the component of the bucket's star is compared by sketch
       (then by one of ``WIDE`` times the coordinates) with all other members, in blocks of ``BLOCK`` x ``BLOCK``; pairs of different components
       that pass are confirmed on full sets. So each pair that shares a bucket is either
       connected already or tested, while only pairs that matter are made into rows.

    Null text counts as empty; a text without words has no shingle, links with nothing and is
    kept. Null or repeated ids: see ``unique_ids``. An empty table gives no rows.
    """
    ship_package(df.sparkSession)
    bands = n_bands(threshold / 100)
    t = bands * ROWS
    spread_of = lambda coordinates: 5 * math.sqrt(threshold / 100 * (1 - threshold / 100) / coordinates)
    cut, wide_cut = threshold / 100 - spread_of(t), threshold / 100 - spread_of(WIDE * t)
    docs, plain = unique_ids(id_and_text(df, id_col, text_col), "near-rows")
    text = docs.select("rid", "text")

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).cast(pa.binary()).to_pylist()
            n, k1, k2, rows = [], [], [], []
            done: dict[tuple[int, int], bytes] = {}
            for lo, hi in pieces(texts):
                for s in shingle_sets(texts[lo:hi], shingle):
                    n.append(len(s))
                    key = (int(mix(s).sum(dtype=np.uint64)), int(mix(s ^ np.uint64(0xABCDEF)).sum(dtype=np.uint64)))
                    k1.append(key[0])
                    k2.append(key[1])
                    if key not in done:
                        done[key] = fast_sketch(s, t).tobytes() if len(s) else bytes(t)
                    rows.append(done[key])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(np.array(k1, np.uint64).view(np.int64)),
                 pa.array(np.array(k2, np.uint64).view(np.int64)), _longs(rows, bands)], ["rid", "n", "k1", "k2", "sketch"])

    sketched = stage(text.mapInArrow(sketch, "rid long, n long, k1 long, k2 long, sketch array<long>"), "near-sketches")
    classes = stage(sketched.where("n > 0").groupBy("k1", "k2").agg(F.min("rid").alias("rep")), "near-classes")
    members = sketched.select("rid", "n", "k1", "k2").join(classes, ["k1", "k2"], "left").select(
        "rid", "n", F.coalesce("rep", "rid").alias("rep"))
    reps = sketched.join(classes.select(F.col("rep").alias("rid")), "rid", "left_semi").select("rid", "sketch")

    rows = reps.select("rid", F.posexplode("sketch").alias("band", "key"))
    crowded = stage(rows.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n"), F.min("rid").alias("center"))
                    .where("n > 1"), "near-buckets")
    placed = stage(rows.join(crowded, ["band", "key"]).select("band", "key", "rid", "center", "n"), "near-places")
    sketches = stage(reps.join(placed.select("rid"), "rid", "left_semi"), "near-candidates")

    def full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).cast(pa.binary()).to_pylist()
            for lo, hi in pieces(texts):
                rows = [s.tobytes() for s in shingle_sets(texts[lo:hi], shingle)]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), pa.array(rows, pa.binary())], ["rid", "items"])

    sets = stage(text.join(sketches.select("rid"), "rid").mapInArrow(full_sets, "rid long, items binary"), "near-sets")

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            near = (_matrix(b.column(2), bands) == _matrix(b.column(3), bands)).mean(1) >= cut if b.num_rows else []
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["u", "v"]).filter(pa.array(near, pa.bool_()))

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            good = []
            for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(p, q, assume_unique=True))
                good.append(100 * both >= threshold * (len(p) + len(q) - both))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["u", "v"]).filter(pa.array(good, pa.bool_()))

    def with_both(pairs: DataFrame, table: DataFrame, column: str) -> DataFrame:
        one = table.select(F.col("rid").alias("u"), F.col(column).alias("x"))
        two = table.select(F.col("rid").alias("v"), F.col(column).alias("y"))
        return pairs.join(two, "v").join(one, "u").select("u", "v", "x", "y")

    def linked(pairs: DataFrame, links: DataFrame | None) -> tuple[DataFrame, DataFrame]:
        """All links so far, and the component of every node that has one."""
        new = stage(with_both(pairs, sets, "items").mapInArrow(confirm, "u long, v long"), "near-links")
        links = new if links is None else links.unionAll(new)
        return links, stage(connected_components(links), "near-components")

    star = placed.where("rid <> center").select(F.col("rid").alias("u"), F.col("center").alias("v")).distinct()
    star = stage(with_both(star, sketches, "sketch").mapInArrow(alike, "u long, v long"), "near-star")
    links, parts = linked(star, None)

    def labelled(frame: DataFrame, node: str, name: str) -> DataFrame:
        return frame.join(parts.select(F.col("node").alias(node), F.col("component").alias("_c")), node, "left").withColumn(
            name, F.coalesce("_c", node)).drop("_c")

    # step 3: buckets that still hold several components
    marked = labelled(labelled(placed, "rid", "part"), "center", "middle").withColumn("alone", F.col("part") != F.col("middle"))
    several = marked.where("alone").groupBy("band", "key").agg(F.count(F.lit(1)).alias("n_alone"))
    mixed = stage(marked.join(several, ["band", "key"]).select("band", "key", "rid", "part", "alone", "n", "n_alone"), "near-mixed")


    def widen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [fast_sketch(np.frombuffer(x, np.uint64), WIDE * t).tobytes() for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), _longs(rows, WIDE * bands)], ["rid", "sketch", "wide"])

    members_left = sets.join(mixed.select("rid"), "rid", "left_semi").join(sketches, "rid").select("rid", "items", "sketch")
    wide = stage(members_left.mapInArrow(widen, "rid long, sketch array<long>, wide array<long>"), "near-wide")
    both = mixed.join(wide.select("rid", F.concat("sketch", "wide").alias("sketch")), "rid")
    spread = lambda n: F.pmod(F.xxhash64("rid"), F.ceil(n / F.lit(BLOCK)))
    every = lambda n: F.sequence(F.lit(0).cast("long"), F.ceil(n / F.lit(BLOCK)) - 1)
    side = ["band", "key", "rid", "part", "sketch"]
    asked = both.where("alone").select(*side, F.lit(True).alias("ask"), spread(F.col("n_alone")).alias("i"), F.explode(every(F.col("n"))).alias("j"))
    held = both.select(*side, F.lit(False).alias("ask"), F.explode(every(F.col("n_alone"))).alias("i"), spread(F.col("n")).alias("j"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted runs of one block pair: the members asked about against those held."""
        def run(rid, part, ask, sk, band) -> tuple[np.ndarray, np.ndarray]:
            us, vs = [], []
            q, d = np.flatnonzero(ask), np.flatnonzero(~ask)
            long = sk.view(np.uint64)
            for k in q:
                near = d[(part[d] != part[k])]
                if band:  # an earlier band has shown this pair
                    near = near[~(long[near, :band] == long[k, :band]).any(1)]
                near = near[(sk[near, :t] == sk[k, :t]).mean(1) >= cut]
                near = near[(sk[near, t:] == sk[k, t:]).mean(1) >= wide_cut]
                us.append(np.maximum(rid[near], rid[k]))
                vs.append(np.minimum(rid[near], rid[k]))
            return np.concatenate(us) if us else rid[:0], np.concatenate(vs) if vs else rid[:0]

        last, waiting = None, []

        def flush() -> pa.RecordBatch | None:
            if not waiting:
                return None
            rid, part, ask, sk = (np.concatenate(x) for x in zip(*waiting, strict=True))
            u, v = run(rid, part, ask, sk, last[0])
            return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

        for b in batches:
            keys = np.stack([b.column(i).to_numpy().astype(np.int64) for i in range(4)], 1)
            rid, part = b.column(4).to_numpy(), b.column(5).to_numpy()
            ask, sk = b.column(6).to_numpy(zero_copy_only=False), _matrix(b.column(7), (1 + WIDE) * bands)
            edges = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), len(keys)]
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                if hi == lo:
                    continue
                key = tuple(keys[lo].tolist())
                if key != last:
                    if (out := flush()) is not None and out.num_rows:
                        yield out
                    last, waiting = key, []
                waiting.append((rid[lo:hi], part[lo:hi], ask[lo:hi], sk[lo:hi]))
        if (out := flush()) is not None and out.num_rows:
            yield out

    block = ["band", "key", "i", "j"]
    pairs = (asked.unionByName(held).select(*block, "rid", "part", "ask", "sketch")
             .repartition(*block).sortWithinPartitions(*block).mapInArrow(compare, "u long, v long").distinct())
    pairs = stage(pairs.join(star, ["u", "v"], "left_anti"), "near-rest")
    if not pairs.isEmpty():
        # first one partner each, then whatever still stands between two components
        one = pairs.groupBy("u").agg(F.min("v").alias("v"))
        links, parts = linked(one, links)
        rest = labelled(labelled(pairs, "u", "a"), "v", "b").where("a <> b").select("u", "v").join(one, ["u", "v"], "left_anti")
        links, parts = linked(rest, links)

    out = labelled(members, "rep", "part")
    kind = dict(docs.dtypes)["id"]
    if plain:
        out = out.select(F.col("rid").cast(kind).alias(id_col), F.col("n").alias("n_shingles"),
                         F.col("part").cast(kind).alias("component_id"), (F.col("rid") == F.col("part")).alias("kept"))
    else:
        names = docs.select(F.col("rid").alias("part"), F.col("id").alias("component_id"))
        out = out.join(docs.select("rid", "id"), "rid").join(names, "part").select(
            F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", (F.col("rid") == F.col("part")).alias("kept"))
    return out
