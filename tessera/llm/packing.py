"""Best-fit packing by linear grouping: plan on a histogram of lengths, then substitute the documents."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.bpe import pieces
from tessera.llm.rows import id_and_text, ship_package, stage
from tessera.llm.word_bpe import WordIds

#: Lengths over this share of a sequence are large, and so grouped; the rest is best-fitted.
LARGE_SHARE = 1 / 3
#: Groups of equal cardinality into which the large lengths are rounded up.
GROUPS = 32


class Plan:
    """Runs of equal items: (length, first rank, count, first sequence, offset). Item number r
    of a length, in any fixed order, goes to sequence first + (r - first rank)."""

    def __init__(self, capacity: int, counts: np.ndarray) -> None:
        self.capacity, self.counts = capacity, counts.astype(np.int64)
        self.used = np.zeros(capacity + 1, dtype=np.int64)  # ranks already placed, by length
        self.runs: list[tuple[int, int, int, int, int]] = []
        self.open: dict[int, list[tuple[int, int]]] = {}  # free space -> runs of sequences
        self.n_seq = 0

    def take(self, length: int, n: int, seq: int, offset: int) -> None:
        self.runs.append((length, int(self.used[length]), n, seq, offset))
        self.used[length] += n

    def left(self, length: int) -> int:
        return int(self.counts[length] - self.used[length])

    def substitute(self, pattern: list[list[int]], uses: int) -> None:
        """Open ``uses`` sequences; each slot of the pattern takes as many actual items, longest
        first, from its group (a list of lengths, longest first)."""
        segments = [(self.n_seq, uses, 0)]  # first sequence, count, filled
        self.n_seq += uses
        for group in pattern:
            after = []
            for seq, n, filled in segments:
                while n:
                    length = next((x for x in group if self.left(x)), None)
                    if length is None:  # the group has run out: the slot stays empty
                        after.append((seq, n, filled))
                        break
                    m = min(n, self.left(length))
                    self.take(length, m, seq, filled)
                    after.append((seq, m, filled + length))
                    seq, n = seq + m, n - m
            segments = after
        for seq, n, filled in segments:
            self.open.setdefault(self.capacity - filled, []).append((seq, n))

    def best_fit(self) -> None:
        """All that is left, longest first, each into the fullest sequence that holds it. Equal
        items are placed in bulk: a sequence takes as many as fit before the next is tried."""
        free = np.zeros(self.capacity + 1, dtype=bool)
        free[[k for k, v in self.open.items() if v]] = True
        for length in range(self.capacity, 0, -1):
            while (c := self.left(length)) > 0:
                fits = np.flatnonzero(free[length:])
                if len(fits):
                    room = length + int(fits[0])
                    seq, n = self.open[room].pop()
                    if not self.open[room]:
                        free[room] = False
                else:
                    room, n = self.capacity, -(-c // (self.capacity // length))
                    seq = self.n_seq
                    self.n_seq += n
                each = room // length
                m = min(n, c // each)
                if m:
                    for j in range(each):
                        self.take(length, m, seq, self.capacity - room + j * length)
                    self._put(free, room - each * length, seq, m)
                if m < n:  # what is left of this length fills one sequence in part, or none
                    rest = self.left(length) if m == c // each else 0
                    if rest and rest < each:
                        for j in range(rest):
                            self.take(length, 1, seq + m, self.capacity - room + j * length)
                        self._put(free, room - rest * length, seq + m, 1)
                        m += 1
                    if m < n:
                        self._put(free, room, seq + m, n - m)

    def _put(self, free: np.ndarray, room: int, seq: int, n: int) -> None:
        if room:
            self.open.setdefault(room, []).append((seq, n))
            free[room] = True


def _few_size_patterns(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Whole uses of configurations for few sizes: column generation over the configuration
    program (simplex basis, priced by an unbounded knapsack), rounded down."""
    k = len(sizes)
    basis = np.diag(capacity // sizes).astype(float)
    for _ in range(40 * k + 200):
        value = np.linalg.solve(basis.T, np.ones(k))
        best = np.zeros(capacity + 1)
        pick = np.full(capacity + 1, -1)
        for c in range(int(sizes.min()), capacity + 1):
            fit = np.flatnonzero(sizes <= c)
            gain = best[c - sizes[fit]] + value[fit]
            j = int(gain.argmax())
            if gain[j] > best[c - 1] + 1e-12:
                best[c], pick[c] = gain[j], fit[j]
            else:
                best[c] = best[c - 1]
        if best[capacity] <= 1 + 1e-7:
            break
        column, c = np.zeros(k), capacity
        while c > 0:
            if pick[c] < 0:
                c -= 1
            else:
                column[pick[c]] += 1
                c -= sizes[pick[c]]
        x = np.linalg.solve(basis, demand)
        d = np.linalg.solve(basis, column)
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.where(d > 1e-9, np.maximum(x, 0) / d, np.inf)
        out = int(ratio.argmin())
        if not np.isfinite(ratio[out]):
            break
        basis[:, out] = column
    x = np.linalg.solve(basis, demand)
    return [(basis[:, p].round().astype(int), int(np.floor(x[p] + 1e-9))) for p in range(k) if x[p] >= 1]


def plan_packing(counts: np.ndarray, capacity: int, groups: int = GROUPS) -> Plan:
    """Pack ``counts[l]`` items of each length l up to ``capacity``. The work depends on the
    number of lengths, at most ``capacity``, and not on the number of items.

    Linear grouping: large items, longest first, are cut into ``groups`` groups of equal
    cardinality; each counts with its group's longest; few-size configurations are optimised;
    actual items (never longer) are substituted; what rounding left over and all small items
    are then best-fitted by their true lengths.
    """
    plan = Plan(capacity, counts)
    large = [x for x in range(capacity, int(capacity * LARGE_SHARE), -1) if counts[x]]
    total = int(sum(counts[x] for x in large))
    if total > groups:
        members: list[list[int]] = [[]]
        demand, size = [0], -(-total // groups)
        for x in large:
            # a length stays whole: a group closes once it has its share
            if demand[-1] >= size:
                members.append([])
                demand.append(0)
            members[-1].append(x)
            demand[-1] += int(counts[x])
        sizes = np.array([m[0] for m in members])
        found = _few_size_patterns(sizes, np.array(demand, dtype=float), capacity)
        # patterns that hold the longest items first, so that slack is left to the small ones
        for column, uses in sorted(found, key=lambda f: -int((f[0] > 0).argmax() if f[0].any() else 0), reverse=True):
            if uses:
                plan.substitute([members[g] for g in range(len(sizes)) for _ in range(column[g])], uses)
    plan.best_fit()
    return plan


def tokenized_pieces(df: DataFrame, vocabulary: str, capacity: int = 4096, end_id: int = 1,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of every whole document: (id, piece, start, length, crc). Ids are the library's for
    the text, then ``end_id``; longer documents are cut every ``capacity`` ids."""
    ship_package(df.sparkSession)
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordIds(vocabulary)
        for b in batches:
            texts = b.column(1).cast(pa.binary()).to_pylist()
            at, piece, start, length, crc = [], [], [], [], []
            for lo, hi in pieces(texts, 8_000_000):
                for i, ids in enumerate(words.encode(texts[lo:hi]), lo):
                    ids += end
                    for p, s in enumerate(range(0, len(ids) // 4, capacity)):
                        part = ids[4 * s:4 * (s + capacity)]
                        at.append(i)
                        piece.append(p)
                        start.append(s)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64())], ["id", "piece", "start", "length", "crc"])

    rows = id_and_text(df, id_col, text_col)
    return rows.mapInArrow(run, f"id {dict(rows.dtypes)['id']}, piece int, start long, length long, crc long")


def pack_documents(df: DataFrame, vocabulary: str, capacity: int = 4096, end_id: int = 1, groups: int = GROUPS,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` tokens.

    Returns per piece (``id_col``, piece, start, length, ids_crc32, sequence_id, offset).
    Tokenised pieces are staged without their ids; only the histogram of their lengths, at
    most ``capacity`` rows, reaches the driver, which plans on it. Items of one length are
    ranked in two levels (1024 hash buckets a length, whose counts are summed), so a length
    that a third of all rows share is spread; a lookup of (length, rank) in the plan's runs,
    whose number the capacity bounds, gives sequence and offset.

    Null text counts as empty: one piece that holds the end id. Null ids and repeated rows
    are packed like others. An empty table gives no rows.
    """
    items = stage(tokenized_pieces(df, vocabulary, capacity, end_id, id_col, text_col)
                  .withColumn("b", F.pmod(F.xxhash64("id", "piece", "crc"), F.lit(1024)).cast("int")), "pieces")
    per = items.groupBy("length", "b").agg(F.count(F.lit(1)).alias("n"))
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for r in per.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most `capacity` rows
        counts[r.length] = r.n
    plan = plan_packing(counts, capacity, groups)
    runs = np.array(sorted(plan.runs), dtype=np.int64).reshape(-1, 5)
    keys, first, seq, offset = (runs[:, 0] << 44) + runs[:, 1], runs[:, 1], runs[:, 3], runs[:, 4]

    before = Window.partitionBy("length").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    base = per.select("length", "b", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("length", "b").orderBy("id", "piece", "crc")
    ranked = (items.withColumn("rn", F.row_number().over(inside)).join(base, ["length", "b"])
              .select("id", "piece", "start", "length", "crc", (F.col("base") + F.col("rn") - 1).alias("rank")))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, rank = b.column(3).to_numpy(), b.column(5).to_numpy()
            at = np.searchsorted(keys, (length << 44) + rank, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:5], pa.array(seq[at] + rank - first[at]), pa.array(offset[at])],
                [id_col, "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    kind = dict(items.dtypes)["id"]
    return ranked.mapInArrow(place, f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long, "
                                    "sequence_id long, offset long")
