"""Toxicity: a bidirectional gated recurrent network with attention pooling over characters and words, on all overlapping windows."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.bpe import pieces
from tessera.llm.rolling import mix
from tessera.llm.rows import id_and_text, ship_package, stage

#: Words of a window, and words from one window's start to the next.
WINDOW, STRIDE = 32, 24
#: State of a direction, attention, word and character inputs.
HIDDEN, ATTENTION, WORD_DIM, CHAR_DIM = 8, 8, 8, 8
#: Character trigrams share this many vectors (a power of two); known words are those of the sample in MIN_DOCS documents or more, at most MAX_WORDS.
TRIGRAMS, MIN_DOCS, MAX_WORDS = 4096, 3, 16384
#: The sample that is fitted to: so many labelled rows at most, of at most so many characters each.
SAMPLE_ROWS, SAMPLE_CHARS = 3000, 20_000
#: Bytes of a text that are scored at once; the next part repeats the last WINDOW words.
PART = 1 << 20
ROUNDS, STEPS, WARM, PICK, BATCH, RATE, DECAY = 12, 24, 4, 10, 128, 0.01, 1e-4
#: Different words whose gate inputs a task remembers, before it starts afresh.
REMEMBERED = 1 << 17

#: Letters, digits and bytes beyond ASCII make words, A-Z in lower case; everything else parts them.
_WORD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


@dataclass
class Words:
    """Words as 64-bit hashes and character trigrams."""

    key: np.ndarray     # a word's hash: the sum of its mixed trigrams
    bucket: np.ndarray  # trigram vectors, all words in a row
    first: np.ndarray   # a word's first trigram; one more at the end


def split_words(text: bytes) -> list[bytes]:
    return text.translate(_WORD).split()


def read_words(words: list[bytes]) -> Words:
    raw = np.frombuffer(b" " + b" ".join(words) + b" ", dtype=np.uint8)
    at = np.flatnonzero(raw != 32)
    code = (raw[at - 1].astype(np.uint64) << np.uint64(16)) | (raw[at].astype(np.uint64) << np.uint64(8)) | raw[at + 1]
    code = mix(code + np.uint64(1))
    first = np.flatnonzero(raw[at - 1] == 32)
    key = np.add.reduceat(code, first) if len(first) else code
    return Words(key, (code >> np.uint64(64 - TRIGRAMS.bit_length() + 1)).astype(np.int32), np.append(first, len(at)))


def windows(begin: np.ndarray, window: int = WINDOW, stride: int = STRIDE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word, words) of all overlapping windows: one every ``stride`` words until the end
    is covered; a text of no words has one empty window."""
    size = np.diff(begin)
    n = np.maximum(1, -(-(size - window) // stride) + 1)
    text = np.repeat(np.arange(len(size)), n)
    place = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
    first = begin[text] + place * stride
    return text, first, np.minimum(window, begin[text + 1] - first)


class Network:
    """x = [word vector, mean of character trigram vectors]; a gated recurrent unit reads each window
    forwards and one backwards; attention pools both states; one logit."""

    def __init__(self, known: np.ndarray, seed: int = 12):
        rnd = np.random.default_rng(seed)
        normal = lambda *shape, scale: (rnd.standard_normal(shape) * scale).astype(np.float32)
        self.known = known  # sorted word hashes; row 0 of the table stands for all others
        d = WORD_DIM + CHAR_DIM
        self.p = {
            "word": normal(len(known) + 1, WORD_DIM, scale=0.1), "char": normal(TRIGRAMS, CHAR_DIM, scale=0.3),
            "wx": normal(2, d, 3 * HIDDEN, scale=1 / math.sqrt(d)), "b": np.zeros((2, 3 * HIDDEN), np.float32),
            "u": normal(2, HIDDEN, 3 * HIDDEN, scale=1 / math.sqrt(HIDDEN)),
            "wa": normal(2 * HIDDEN, ATTENTION, scale=0.3), "ba": np.zeros(ATTENTION, np.float32), "v": normal(ATTENTION, scale=0.3),
            "w": normal(2 * HIDDEN, scale=0.3), "c": np.full(1, -1.0, np.float32)}
        self.scale, self.shift = 1.0, 0.0  # from a text's greatest logit to its log-odds

    def word_ids(self, key: np.ndarray) -> np.ndarray:
        if not len(self.known):
            return np.zeros(len(key), np.int32)
        at = np.minimum(np.searchsorted(self.known, key), len(self.known) - 1)
        return np.where(self.known[at] == key, at + 1, 0).astype(np.int32)

    def char_means(self, words: Words) -> np.ndarray:
        size = np.diff(words.first)
        if not len(size):
            return np.zeros((0, CHAR_DIM), np.float32)
        return np.add.reduceat(self.p["char"][words.bucket], words.first[:-1], axis=0) / size[:, None].astype(np.float32)

    def gates(self, x: np.ndarray) -> np.ndarray:
        """Both directions' gate inputs of word inputs ``x``, with a last row of zeros for places without a word.

        A row of zeros keeps a state of zeros, so a window that is shorter than others needs no other care.
        """
        out = np.zeros((2, len(x) + 1, 3 * HIDDEN), x.dtype)
        for k in (0, 1):
            out[k, :-1] = x @ self.p["wx"][k] + self.p["b"][k]
        return out

    def logits(self, gates: np.ndarray, rows: np.ndarray, first: np.ndarray, size: np.ndarray, chunk: int = 768, trace: list | None = None) -> np.ndarray:
        """Logits of windows; word ``i`` has row ``rows[i]`` of ``gates``. ``trace`` receives what the gradient needs."""
        p = self.p
        rows = np.append(rows, gates.shape[1] - 1)
        out = np.empty(len(first), gates.dtype)
        for lo in range(0, len(first), chunk):
            f, n = first[lo:lo + chunk], size[lo:lo + chunk]
            b = len(f)
            span = max(1, int(n.max()))
            place = np.arange(span)[:, None]
            here = rows[np.where(place < n, f + place, len(rows) - 1)]
            states = np.empty((span, b, 2 * HIDDEN), gates.dtype)
            h = np.zeros((2, b, HIDDEN), gates.dtype)
            g, hu = np.empty((2, b, 3 * HIDDEN), gates.dtype), np.empty((2, b, 3 * HIDDEN), gates.dtype)
            steps = []
            for t in range(span):
                np.take(gates[0], here[t], axis=0, out=g[0], mode="clip")
                np.take(gates[1], here[span - 1 - t], axis=0, out=g[1], mode="clip")  # reads from the end
                np.matmul(h, p["u"], out=hu)
                zr = g[..., :2 * HIDDEN] + hu[..., :2 * HIDDEN]
                zr *= 0.5
                np.tanh(zr, out=zr)
                zr *= 0.5
                zr += 0.5
                z = zr[..., :HIDDEN]
                new = zr[..., HIDDEN:] * hu[..., 2 * HIDDEN:]
                new += g[..., 2 * HIDDEN:]
                np.tanh(new, out=new)
                if trace is not None:
                    steps.append((h, hu[..., 2 * HIDDEN:].copy(), z, zr[..., HIDDEN:], new))
                h = h - new
                h *= z
                h += new
                states[t, :, :HIDDEN] = h[0]
                states[span - 1 - t, :, HIDDEN:] = h[1]
            a = np.tanh(states @ p["wa"] + p["ba"])
            e = a @ p["v"]
            e = np.exp(e - e.max(0)) * (place < n)
            share = (e / (e.sum(0) + 1e-9)).astype(gates.dtype)
            pooled = np.matmul(share.T[:, None, :], states.transpose(1, 0, 2))[:, 0]
            out[lo:lo + b] = pooled @ p["w"] + p["c"][0]
            if trace is not None:
                trace.append((here, states, steps, a, share, pooled))
        return out

    def inputs(self, words: Words) -> np.ndarray:
        return np.concatenate([self.p["word"][self.word_ids(words.key)], self.char_means(words)], 1)

    def gradient(self, words: Words, rows: np.ndarray, first: np.ndarray, size: np.ndarray, weigh) -> dict[str, np.ndarray]:
        """Gradient over one batch of windows (see ``logits``; ``words`` are the rows' words), by
        back-propagation through time; ``weigh`` maps logits to the loss's slopes."""
        p = self.p
        x = self.inputs(words)
        trace: list = []
        logit = self.logits(self.gates(x), rows, first, size, len(first), trace)
        here, states, steps, a, share, pooled = trace[0]
        weight = weigh(logit)
        span = len(steps)
        out = {"w": weight @ pooled, "c": np.array([weight.sum()], np.float32)}
        dpooled = weight[:, None] * p["w"]
        dstates = share[..., None] * dpooled
        dshare = np.einsum("bh,tbh->tb", dpooled, states)
        de = share * (dshare - (share * dshare).sum(0))
        out["v"] = np.einsum("tb,tba->a", de, a)
        da = de[..., None] * p["v"] * (1 - a * a)
        out["wa"] = np.einsum("tbh,tba->ha", states, da)
        out["ba"] = da.sum((0, 1))
        dstates = dstates + da @ p["wa"].T
        dgates = np.zeros((2, len(x) + 1, 3 * HIDDEN), np.float32)
        out["u"] = np.zeros_like(p["u"])
        dh = np.zeros((2, len(first), HIDDEN), np.float32)
        for t in range(span - 1, -1, -1):
            h, hu, z, r, new = steps[t]
            dh = dh + np.stack([dstates[t, :, :HIDDEN], dstates[span - 1 - t, :, HIDDEN:]])
            dnew = dh * (1 - z) * (1 - new * new)
            dz = dh * (h - new) * z * (1 - z)
            dr = dnew * hu * r * (1 - r)
            dhu = np.concatenate([dz, dr, dnew * r], -1)
            out["u"] += h.transpose(0, 2, 1) @ dhu
            dg = np.concatenate([dz, dr, dnew], -1)
            np.add.at(dgates[0], here[t], dg[0])
            np.add.at(dgates[1], here[span - 1 - t], dg[1])
            dh = dh * z + dhu @ p["u"].transpose(0, 2, 1)
        dgates = dgates[:, :-1]
        out["b"] = dgates.sum(1)
        out["wx"] = x.T @ dgates
        dx = dgates[0] @ p["wx"][0].T + dgates[1] @ p["wx"][1].T
        out["word"], out["char"] = np.zeros_like(p["word"]), np.zeros_like(p["char"])
        np.add.at(out["word"], self.word_ids(words.key), dx[:, :WORD_DIM])
        letters = np.diff(words.first)
        np.add.at(out["char"], words.bucket, np.repeat(dx[:, WORD_DIM:] / np.maximum(letters, 1)[:, None].astype(np.float32), letters, axis=0))
        return out

    def text_logits(self, texts: list[bytes], memory: Memory) -> np.ndarray:
        """The greatest logit of each text's windows."""
        words = [split_words(t) for t in texts]
        rows = memory.rows(self, [w for ws in words for w in ws])
        text, first, size = windows(np.cumsum([0, *map(len, words)]))
        return np.maximum.reduceat(self.logits(memory.gates, rows, first, size), np.searchsorted(text, np.arange(len(texts))))

    def scores(self, texts: list[bytes], memory: Memory) -> np.ndarray:
        """Probabilities of texts of any length, each read whole."""
        best = np.full(len(texts), -np.inf)
        parts = [(i, part) for i, t in enumerate(texts) for part in _parts(t)]
        for lo, hi in pieces([p for _, p in parts], 500_000):
            owner = np.array([i for i, _ in parts[lo:hi]])
            np.maximum.at(best, owner, self.text_logits([p for _, p in parts[lo:hi]], memory).astype(np.float64))
        return 1 / (1 + np.exp(-np.clip(self.scale * best + self.shift, -30, 30)))


class Memory:
    """Gate inputs of the words that a task has met, for one network."""

    def __init__(self):
        self.place: dict[bytes, int] = {}
        self.gates = np.zeros((2, 1, 3 * HIDDEN), np.float32)

    def rows(self, net: Network, words: list[bytes]) -> np.ndarray:
        """Rows of ``gates`` for words; its last row is that of no word."""
        if len(self.place) > REMEMBERED:
            self.__init__()
        found = np.fromiter(map(self.place.get, words, repeat(-1)), np.int64, len(words))
        unmet = np.flatnonzero(found < 0)
        if len(unmet):
            new = list(dict.fromkeys(words[i] for i in unmet.tolist()))
            more = net.gates(net.inputs(read_words(new)))
            self.place.update(zip(new, range(len(self.place), len(self.place) + len(new)), strict=True))
            self.gates = np.concatenate([self.gates[:, :-1], more], 1)
            found[unmet] = np.fromiter(map(self.place.get, [words[i] for i in unmet.tolist()]), np.int64, len(unmet))
        return found


def _parts(text: bytes) -> Iterator[bytes]:
    """A text, or parts of about PART bytes that end between words and repeat the last WINDOW words."""
    if len(text) <= PART:
        yield text
        return
    text = text.translate(_WORD)
    lo, tail = 0, b""
    while lo < len(text):
        hi = text.find(b" ", lo + PART)
        hi = len(text) if hi < 0 else hi
        part = tail + text[lo:hi]
        yield part
        tail, lo = b" ".join(part.split()[-WINDOW:]) + b" ", hi


def known_words(words: Words, rows: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Hashes of the words in MIN_DOCS texts or more, the most frequent MAX_WORDS of them, sorted."""
    text = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
    pair = np.unique(rows * len(begin) + text)
    n = np.bincount(pair // len(begin), minlength=len(words.key))
    key, n = words.key[n >= MIN_DOCS], n[n >= MIN_DOCS]
    return np.unique(key[np.lexsort((key, -n))[:MAX_WORDS]])


def _ranges(first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of runs, all in a row, and where each run begins there."""
    begin = np.cumsum(size) - size
    return np.repeat(first - begin, size) + np.arange(int(size.sum())), begin


def _pick(words: Words, rows: np.ndarray) -> Words:
    cells, begin = _ranges(words.first[rows], words.first[rows + 1] - words.first[rows])
    return Words(words.key[rows], words.bucket[cells], np.append(begin, len(cells)))


def train(texts: list[bytes], labels: np.ndarray, seed: int = 12) -> Network | float:
    """Fit a network to labelled texts; the base rate (0.5 added to the ones, 2 to all) if a class is missing.

    ROUNDS rounds of STEPS batches of texts drawn with replacement; a text counts by its greatest window of
    PICK drawn anew (in the first WARM rounds by any one), with Adam on the log-loss. Every fifth text is
    kept aside: the round with the least loss there wins (every second of the later half is tried), and
    there the log-odds are calibrated.
    """
    aside = np.arange(len(texts)) % 5 == 4
    if min((labels[~aside] == 1).sum(), (labels[~aside] == 0).sum()) < 1:
        return float((labels.sum() + 0.5) / (len(labels) + 2))
    split = [split_words(t) for t in texts]
    begin = np.cumsum([0, *map(len, split)])
    place = {w: i for i, w in enumerate(dict.fromkeys(w for ws in split for w in ws))}
    rows = np.fromiter((place[w] for ws in split for w in ws), np.int64, int(begin[-1]))
    words = read_words(list(place))
    net = Network(known_words(words, rows, begin), seed)
    rnd = np.random.default_rng(seed)
    text, first, size = windows(begin)
    start = np.searchsorted(text, np.arange(len(texts) + 1))
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    best, step = (np.inf, {}, 1.0, 0.0), 0
    fit = np.flatnonzero(~aside)

    def drawn(chosen: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        """Up to ``most`` windows of each chosen text, spread over it: (place in ``chosen``, window)."""
        count = start[chosen + 1] - start[chosen]
        n = np.minimum(count, most)
        place = np.repeat(np.arange(len(chosen)), n)
        spread = np.arange(len(place)) - np.repeat(np.cumsum(n) - n, n)
        return place, start[chosen][place] + ((spread + rnd.random(len(place))) * (count / n)[place]).astype(np.int64)

    for turn in range(ROUNDS):
        row = rnd.choice(fit, STEPS * BATCH)
        place, win = drawn(row, PICK if turn >= WARM else 1)
        if turn >= WARM:
            value = net.logits(net.gates(net.inputs(words)), rows, first[win], size[win])
            order = np.lexsort((-value, place))
            win = win[order[np.unique(place[order], return_index=True)[1]]]
        for lo in range(0, len(row), BATCH):
            pick = win[lo:lo + BATCH]
            at, begin_at = _ranges(first[pick], size[pick])
            used, local = np.unique(rows[at], return_inverse=True)
            truth = labels[row[lo:lo + BATCH]].astype(np.float32)
            slope = lambda logit: ((1 / (1 + np.exp(-logit)) - truth) / len(truth)).astype(np.float32)  # noqa: B023, E731
            step += 1
            rate = RATE * (1 - 0.9 * turn / ROUNDS) * math.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for k, g in net.gradient(_pick(words, used), local, begin_at, size[pick], slope).items():
                m, v = moment[k]
                g = g + DECAY * net.p[k]
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                net.p[k] -= (rate * m / (np.sqrt(v) + 1e-7)).astype(np.float32)
        if turn >= ROUNDS // 2 and turn % 2:
            apart = np.flatnonzero(aside)
            top = net.text_logits([texts[i] for i in apart], Memory())
            scale, shift, loss = calibrate(top, labels[apart])
            if loss < best[0] - 1e-4:
                best = (loss, {k: v.copy() for k, v in net.p.items()}, scale, shift)
    if best[1]:
        _, net.p, net.scale, net.shift = best
    return net


def calibrate(value: np.ndarray, truth: np.ndarray) -> tuple[float, float, float]:
    """(scale, shift, mean log-loss) of the logistic fit of ``truth`` to ``value``, drawn a little to scale 1, shift 0."""
    a, b, ridge = 1.0, 0.0, 0.5
    x, y = np.clip(value.astype(np.float64), -20, 20), truth.astype(np.float64)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        s = p * (1 - p)
        grad = np.array([((p - y) * x).sum() + ridge * (a - 1), (p - y).sum() + ridge * b])
        hess = np.array([[(s * x * x).sum() + ridge, (s * x).sum()], [(s * x).sum(), s.sum() + ridge]])
        move = np.linalg.solve(hess, grad)
        move *= min(1.0, 1.0 / max(1e-9, float(np.abs(move).max())))
        a, b = max(0.05, a - float(move[0])), b - float(move[1])
    p = np.clip(1 / (1 + np.exp(-np.clip(a * x + b, -30, 30))), 1e-6, 1 - 1e-6)
    return a, b, float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()) if len(y) else 0.0


def toxicity_scores(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
                    folds: int = 5, held: int = 0, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> DataFrame:
    """Score every text for toxicity, as ``label_col`` of ``labels`` (``id_col``, ``label_col``) marks it:
    (``id_col``, held_out, score, predicted).

    1. A sample of at most ``rows`` labelled rows outside the held-out fold (crc32 of the id as text mod
       ``folds`` = ``held``), each of at most ``chars`` characters, in the order of a hash of the id, is fitted to in numpy
       (``train``). Only texts and labels enter. The sample's bound is ``rows`` x ``chars`` characters.
    2. The network (known words and fixed tables, under 2 MB) goes to all tasks, which score all overlapping
       windows of ``WINDOW`` words, every ``STRIDE`` words, of each whole text. A text's score is the
       calibrated probability of its greatest window. Texts over 1 MiB are read in parts that overlap by a window.

    Null text counts as empty and has one empty window. Null ids are scored and not held out (nor fitted to). A
    repeated id is scored row by row, and labelled rows that repeat an id are each a row of the
    sample; null labels are left out. Without labels of both classes all scores are the
    smoothed base rate. An empty table gives no rows; further columns are ignored, whatever their names.
    """
    spark = df.sparkSession
    ship_package(spark)
    docs = id_and_text(df, id_col, text_col)
    fold = lambda c: F.crc32(c.cast("string")) % folds == held
    marked = labels.select(labels[id_col].alias("key"), labels[label_col].cast("int").alias("y")).where(
        F.col("key").isNotNull() & F.col("y").isNotNull() & ~fold(F.col("key")))
    order = [F.xxhash64(F.col("key").cast("string")), F.col("key"), F.col("y")]
    # twice the rows, since those whose text is missing or too long drop out
    wanted = stage(marked.orderBy(*order).limit(2 * rows), "toxic-sample")
    sample = (docs.join(F.broadcast(wanted), F.col("id") == F.col("key")).where(F.char_length("text") <= chars)
              .orderBy(*order, F.xxhash64("text")).limit(rows).select("y", "text").collect())
    model = train([r["text"].encode() for r in sample], np.array([int(r["y"] != 0) for r in sample], dtype=np.int64))
    shared = spark.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, memory = shared.value, Memory()
        for b in batches:
            n = b.num_rows
            p = np.full(n, net) if isinstance(net, float) else net.scores(b.column(1).cast(pa.binary()).to_pylist(), memory)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(p, pa.float64())], ["id", "score"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(score, f"id {kind}, score double").select(
        F.col("id").alias(id_col), F.coalesce(fold(F.col("id")), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
