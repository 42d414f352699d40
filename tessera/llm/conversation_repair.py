"""Conversation structure repair: the cheapest edits to well-formed turns, by divide and conquer in linear space."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.rows import WS, ship_package, stage

#: What an edit costs; an undeleted truncated message costs TRUNCATED more.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: Messages (and characters) of a block, and blocks or groups of blocks that are joined in one step.
BLOCK, BLOCK_CHARS, FAN = 512, 4_000_000, 512

# States of (s?(ua)+)?: 0 nothing yet, 1 after s, 2 after u, 3 after a. An automaton step is certain, so an
# audit says which states it passes.
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
SPEAKS = {0: "u", 1: "u", 2: "a", 3: "u"}
ROLE = {"u": "user", "a": "assistant"}
TAIL = {0: "", 1: "II", 2: "I", 3: ""}
NO = 1 << 60


def _option(state: int, kind: str) -> dict[int, tuple[int, str]]:
    """For each state after one message: the cheapest edits that end with this message's, ASCII-least first.

    ``kind`` is the role's initial (or ``-``) and ``x`` for a message that has to go, ``t`` for a
    truncated one, ``.`` for any other. Inserts may come before; more than two lead nowhere new.
    """
    out: dict[int, tuple[int, str]] = {}
    extra, s = TRUNCATED * (kind[1] == "t"), state
    for k in range(3):
        edits = [(s, DELETE, "D")]
        if kind[1] != "x":
            edits.append((STEP[s, SPEAKS[s]], REROLE + extra, "R"))
            if (s, kind[0]) in STEP:
                edits.append((STEP[s, kind[0]], KEEP + extra, "K"))
        for t, cost, letter in edits:
            found = (INSERT * k + cost, "I" * k + letter)
            out[t] = min(out.get(t, found), found)
        s = STEP[s, SPEAKS[s]]
    return out


@lru_cache(maxsize=None)
def options(kind: str) -> tuple[dict[int, tuple[int, str]], ...]:
    return tuple(_option(s, kind) for s in range(4))


@lru_cache(maxsize=4096)
def step_matrix(kind: str, n: int) -> tuple[tuple[int, ...], tuple[int, ...]]:
    """(costs, ranks) from state to state, 4 x 4, of ``n`` like messages (n > 1 only for kind x).

    Ranks order the audits that leave one state. All audits over the same messages end with a
    message's letter, so none is the beginning of another, and what follows never changes their order.
    """
    cost, rank = [NO] * 16, [9] * 16
    for s in range(4):
        found = options(kind)[s]
        for place, t in enumerate(sorted(found, key=lambda t: found[t][1])):
            cost[4 * s + t], rank[4 * s + t] = found[t][0] + DELETE * (n - 1), place
    return tuple(cost), tuple(rank)


Matrix = tuple[tuple[int, ...], tuple[int, ...]]


def _forward(items: list[Matrix], lo: int, hi: int, state: int) -> tuple[list[int], list[int]]:
    """Cost and order of the least audit from ``state`` before item ``lo`` to each state behind item ``hi`` - 1."""
    cost, rank = [NO] * 4, [9] * 4
    cost[state], rank[state] = 0, 0
    for cs, rs in items[lo:hi]:
        best = [min((cost[s] + cs[4 * s + t], rank[s], rs[4 * s + t]) for s in range(4)) for t in range(4)]
        order = sorted(range(4), key=lambda t: best[t][1:] if best[t][0] < NO else (99, t))
        cost = [min(b[0], NO) for b in best]
        rank = [9] * 4
        for place, t in enumerate(order):
            if cost[t] < NO:
                rank[t] = place
    return cost, rank


def _backward(items: list[Matrix], lo: int, hi: int, state: int) -> list[int]:
    """Cost from each state before item ``lo`` to ``state`` behind item ``hi`` - 1."""
    cost = [NO] * 4
    cost[state] = 0
    for cs, _ in reversed(items[lo:hi]):
        cost = [min(NO, *(cs[4 * s + t] + cost[t] for t in range(4))) for s in range(4)]
    return cost


def compose(items: list[Matrix]) -> Matrix:
    """The matrix of a run of items."""
    rows = [_forward(items, 0, len(items), s) for s in range(4)]
    return tuple(c for r in rows for c in r[0]), tuple(k for r in rows for k in r[1])


def crossings(items: list[Matrix], first: int, last: int) -> list[int]:
    """States before, between and behind the items on the cheapest path, of several that with the least audit.

    Divide and conquer: the forward vector of the left half and the backward vector of the right
    half meet in the middle; of the cheapest crossings that with the least audit is taken, and both halves
    go on by themselves. Space is linear in the items.
    """
    out = [first] + [0] * (len(items) - 1) + [last]
    todo = [(0, len(items))]
    while todo:
        lo, hi = todo.pop()
        if hi - lo < 2:
            continue
        mid = (lo + hi) // 2
        cost, rank = _forward(items, lo, mid, out[lo])
        rest = _backward(items, mid, hi, out[hi])
        out[mid] = min(range(4), key=lambda s: (min(NO, cost[s] + rest[s]), rank[s]))
        todo += [(lo, mid), (mid, hi)]
    return out


def final_state(matrix: Matrix) -> int:
    """The state behind the last message on the cheapest path from the start to the end."""
    return min(range(4), key=lambda t: (matrix[0][t] + INSERT * len(TAIL[t]), matrix[1][t]))


Runs = tuple[tuple[str, int], ...]


@lru_cache(maxsize=65536)
def block_matrix(runs: Runs) -> Matrix:
    return compose([step_matrix(*x) for x in runs])


@lru_cache(maxsize=65536)
def block_audits(runs: Runs, first: int, last: int) -> tuple[str, ...]:
    """The edits of each run of a block that is entered in state ``first`` and left in ``last``."""
    at = crossings([step_matrix(*x) for x in runs], first, last)
    return tuple("D" * (n - 1) + options(kind)[s][t][1] for (kind, n), s, t in zip(runs, at[:-1], at[1:], strict=True))


def _runs(roles: list[str], faults: list[str], counts: list[int]) -> tuple[Runs, list[int]]:
    """Messages as runs (kind, how often), and the message of each run: a repeated message is
    one that may stay and others that have to go."""
    out, owners = [], []
    for i, (role, fault, n) in enumerate(zip(roles, faults, counts, strict=True)):
        initial = role[:1] if role[:1] in ("s", "u", "a") else "-"
        if fault in ("blank", "duplicate"):
            parts = [(initial + "x", n)]
        else:
            parts = [(initial + ("t" if fault else "."), 1)] + [(initial + "x", n - 1)] * (n > 1)
        out += parts
        owners += [i] * len(parts)
    return tuple(out), owners


def _fault(text: str, first: bool) -> str:
    rest = text.rstrip(WS)
    return "blank" if not rest else "duplicate" if not first else "" if rest[-1] in ".!?" else "truncated"


def _render(roles: list[str], texts: list[str], owners: list[int], edits: tuple[str, ...], first: int) -> tuple[str, list[str]]:
    """Audit and repaired lines of a block that is entered in state ``first``."""
    s, lines = first, []
    for i, letters in zip(owners, edits, strict=True):
        for e in letters.replace("D", ""):
            if e == "K":
                lines.append(f"{roles[i]}:{texts[i]}")
                s = STEP[s, roles[i][0]]
            else:
                lines.append(f"{ROLE[SPEAKS[s]]}:{texts[i] if e == 'R' else ''}")
                s = STEP[s, SPEAKS[s]]
    return "".join(edits), lines


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns), strict=True)


def _batches(rows: Iterable[tuple], schema: pa.Schema, chars: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Record batches of rows (tuple, weight), at most about ``chars`` of weight or 1000 rows each."""
    held, weight = [], 0
    for row, w in rows:
        held.append(row)
        weight += w
        if weight >= chars or len(held) >= 1000:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema, strict=True)], schema=schema)
            held, weight = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema, strict=True)], schema=schema)


def _number() -> Iterator[int]:
    """Growing numbers of this task's rows, above those of earlier partitions."""
    n = TaskContext.get().partitionId() << 33
    while True:
        yield n
        n += 1


def same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def repair_conversations(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text", block: int = BLOCK, fan: int = FAN) -> DataFrame:
    """Repair every conversation by the cheapest edits that make its roles ``(system? (user assistant)+)?``.

    Messages sort by turn (null first), role, text. A message's first fault counts: blank, duplicate
    (role and text seen earlier in the conversation), truncated (its last character but white
    space is none of ``.!?``). Edits: Keep costs 0, Rerole to user or assistant 3, Delete 4 (required
    for blank and duplicate), Insert of an empty message of user or assistant 3; a truncated
    message that stays costs 3 more. Roles count by their first letter. Of equally cheap
    repairs the one whose audit (initials of the edits in order) is ASCII-least is made.

    Returns one row for each block of at most ``block`` different messages of a conversation, in order of
    ``part`` (any growing numbers): (``conv_col``, part, audit, repaired, cost, n, blank, duplicate, truncated, illegal,
    head, last, turn_min, turn_max, turns, turn_first, turn_last); ``repaired`` holds ``role:text`` lines joined by
    newlines, empty if none is left; ``repair_report`` sums the blocks up.

    A block's choice from each of four states to each is one 4 x 4 matrix of costs and ranks, and matrices of
    neighbours compose. So a conversation of any length is split over tasks: blocks are
    composed ``fan`` at a time until one matrix a conversation is left; then, downwards, each group's
    forward and backward vectors settle the states between its parts (``crossings``), and each
    block recovers its own edits in the same way. Equal messages of one turn are counted before anything
    is shuffled by conversation, first sightings come from a partial aggregate and a join, and the
    order comes from a range partitioning; no task holds a conversation.

    Null role and text count as one space (blank); null ids form one conversation; a role other
    than s..., u..., a... has to be reroled or deleted. An empty table gives no rows; further
    columns are ignored, whatever their names.
    """
    spark = df.sparkSession
    ship_package(spark)
    lone = df.select(df[conv_col].alias("conv"), df[turn_col].cast("long").alias("turn"),
                     F.coalesce(df[role_col].cast("string"), F.lit(" ")).alias("role"),
                     F.coalesce(df[text_col], F.lit(" ")).alias("text"))
    # one key for the conversation, role and text, so that a null id needs no care below
    key = F.sha2(F.concat(F.coalesce(F.concat(F.octet_length(F.col("conv").cast("string")).cast("string"), F.lit(":"), F.col("conv").cast("string")), F.lit("null")),
                          F.lit("/"), F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    each = stage(lone.groupBy("conv", "turn", "role", "text").agg(F.count(F.lit(1)).alias("n")).withColumn("key", key), "repair-rows")
    seen = each.groupBy("key").agg(F.min(F.struct(F.col("turn").isNotNull().alias("dated"), "turn")).alias("first"))
    marked = each.join(seen, "key").select(
        "conv", "turn", "role", "text", "n", same(F.col("first.turn"), F.col("turn")).alias("first"))
    order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role")]
    line = marked.repartitionByRange(*order, F.substring("text", 1, 64)).sortWithinPartitions(*order, "text")

    kind = each.schema["conv"].dataType.simpleString()
    strings, longs = "array<string>", "array<bigint>"
    shape = (f"conv {kind}, blk long, roles {strings}, texts {strings}, faults {strings}, counts {longs}, cost {longs}, rank {longs}, "
             "head string, last string, illegal long, blank long, duplicate long, truncated long, "
             "turn_min long, turn_max long, turns long, turn_first long, turn_last long")
    block_schema = _arrow(spark, shape)

    def blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = _number()

        def closed(conv, held) -> tuple[tuple, int]:
            turns, roles, texts, counts, faults = (list(x) for x in zip(*held, strict=True))
            matrix = block_matrix(_runs(roles, faults, counts)[0])
            total = {f: sum(n for n, x in zip(counts, faults, strict=True) if x == f) for f in ("blank", "duplicate", "truncated")}
            total["duplicate"] += sum(n - 1 for n, x in zip(counts, faults, strict=True) if x in ("", "truncated"))
            initials = [r[:1] for r in roles]
            bad = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials[:-1], initials[1:], strict=True)) + sum(n - 1 for n in counts)
            dated = [t for t in turns if t is not None]
            row = (conv, next(ids), roles, texts, faults, counts, *matrix, initials[0], initials[-1], bad, *total.values(),
                   min(dated, default=None), max(dated, default=None), len(set(dated)), turns[0], turns[-1])
            return row, sum(map(len, texts)) + 64 * len(texts)

        def rows() -> Iterator[tuple[tuple, int]]:
            held, now, chars = [], None, 0
            for conv, turn, role, text, n, first in _rows(batches):
                if held and (conv != now or len(held) >= block or chars >= BLOCK_CHARS):
                    yield closed(now, held)
                    held, chars = [], 0
                now = conv
                chars += len(text)
                held.append((turn, role, text, n, _fault(text, first)))
            if held:
                yield closed(now, held)

        yield from _batches(rows(), block_schema)

    blocks = stage(line.mapInArrow(blocks_of, shape), "repair-blocks")

    # upwards: groups of at most `fan` matrices, until every conversation has one
    node_shape = f"conv {kind}, blk long, cost {longs}, rank {longs}, kids {longs}, kid_costs {longs}, kid_ranks {longs}"
    node_schema = _arrow(spark, node_shape)

    def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def closed(conv, held) -> tuple[tuple, int]:
            matrix = compose([(c, r) for _, c, r in held])
            return (conv, held[0][0], *matrix, [x[0] for x in held], [y for x in held for y in x[1]], [y for x in held for y in x[2]]), 300 * len(held)

        def rows() -> Iterator[tuple[tuple, int]]:
            held, now = [], None
            for conv, group, blk, cost, rank in _rows(batches):
                if held and (conv, group) != now:
                    yield closed(now[0], held)
                    held = []
                now = (conv, group)
                held.append((blk, tuple(cost), tuple(rank)))
            if held:
                yield closed(now[0], held)

        yield from _batches(rows(), node_schema)

    def rooted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            last = [final_state((tuple(c), tuple(r))) for c, r in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([0] * len(last), pa.int64()), pa.array(last, pa.int64()),
                                              pa.array([True] * len(last))], names=["blk", "enter", "leave", "ends"])

    placed = "blk long, enter long, leave long, ends boolean"
    levels, nodes, bits = [], blocks.select("conv", "blk", "cost", "rank"), max(1, fan.bit_length() - 1)
    while True:
        long = nodes.groupBy(F.col("conv").alias("c")).agg(F.count(F.lit(1)).alias("m")).where("m > 1")
        n, most = long.agg(F.coalesce(F.sum("m"), F.lit(0)), F.max("m")).first()
        if not n:
            levels.append((nodes.select("blk", "cost", "rank").mapInArrow(rooted, placed), None))
            break
        on = same(F.col("conv"), F.col("c"))
        roots = nodes.join(long, on, "left_anti").select("blk", "cost", "rank").mapInArrow(rooted, placed)
        # numbers that agree but in their low bits are neighbours: at most `fan` at a level, as each drops `bits` more
        group = F.lit(0).cast("long") if most <= fan else F.shiftright("blk", min(63, bits * (len(levels) + 1)))
        up = nodes.join(long, on, "left_semi").select("conv", group.alias("group"), "blk", "cost", "rank")
        up = up.repartition(1) if n <= 64 * fan else up.repartition("conv", "group")
        parents = stage(up.sortWithinPartitions("conv", "group", "blk").mapInArrow(grouped, node_shape), "repair-groups")
        levels.append((roots, parents))
        nodes = parents.select("conv", "blk", "cost", "rank")

    # downwards: the states at which each part of a group is entered and left
    place_schema = _arrow(spark, placed)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple[tuple, int]]:
            for kids, costs, ranks, enter, leave, ends in _rows(batches):
                items = [(tuple(costs[i:i + 16]), tuple(ranks[i:i + 16])) for i in range(0, len(costs), 16)]
                at = crossings(items, enter, leave)
                for i, kid in enumerate(kids):
                    yield (kid, at[i], at[i + 1], ends and i == len(kids) - 1), 1

        yield from _batches(rows(), place_schema)

    places = levels[-1][0]
    for roots, parents in reversed(levels[:-1]):
        down = parents.select("blk", "kids", "kid_costs", "kid_ranks").join(places, "blk").select(
            "kids", "kid_costs", "kid_ranks", "enter", "leave", "ends").mapInArrow(split, placed)
        places = roots.unionAll(down)

    count = ["illegal", "blank", "duplicate", "truncated", "turn_min", "turn_max", "turns", "turn_first", "turn_last"]
    out_shape = (f"conv {kind}, part long, audit string, repaired string, cost long, n long, head string, last string, "
                 + ", ".join(f"{c} long" for c in count))
    out_schema = _arrow(spark, out_shape)

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple[tuple, int]]:
            for conv, blk, roles, texts, faults, counts, cost, enter, leave, ends, head, last, *rest in _rows(batches):
                runs, owners = _runs(roles, faults, counts)
                audit, lines = _render(roles, texts, owners, block_audits(runs, enter, leave), enter)
                total = cost[4 * enter + leave]
                if ends:
                    audit, total, s = audit + TAIL[leave], total + INSERT * len(TAIL[leave]), leave
                    for _ in TAIL[leave]:
                        lines.append(f"{ROLE[SPEAKS[s]]}:")
                        s = STEP[s, SPEAKS[s]]
                repaired = "\n".join(lines)
                yield (conv, blk, audit, repaired, total, sum(counts), head, last, *rest), len(repaired) + len(audit)

        yield from _batches(rows(), out_schema)

    done = blocks.join(places, "blk").select(
        "conv", "blk", "roles", "texts", "faults", "counts", "cost", "enter", "leave", "ends", "head", "last", *count).mapInArrow(render, out_shape)
    return done.withColumnRenamed("conv", conv_col)


def repair_report(blocks: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """One row for each repaired conversation: (``conv_col``, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256).

    ``gaps`` counts the turn numbers that are missing between the smallest and the largest; ``illegal``
    the neighbours (before the repair) whose roles start with none of su, ua, au. A conversation's blocks pass in
    order through one task, which holds one block, the running hash and the audit (SHA-256 of one text
    cannot be parted).
    """
    kind = blocks.schema[conv_col].dataType.simpleString()
    shape = f"conv {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    schema = _arrow(blocks.sparkSession, shape)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple[tuple, int]]:
            now, sha = None, None
            for conv, _, audit, repaired, cost, head, last, illegal, blank, duplicate, truncated, lo, hi, turns, first, final in _rows(batches):
                if sha is None or conv != now:
                    if sha is not None:
                        yield closed()
                    now, sha, audits, written, before, turn = conv, hashlib.sha256(), [], False, None, None
                    total, span = [0] * 5, [None, None, 0]
                if repaired:
                    sha.update((("\n" if written else "") + repaired).encode("utf-8", "surrogatepass"))
                    written = True
                audits.append(audit)
                if before is not None:
                    illegal += before + head not in ("su", "ua", "au")
                    turns -= turn is not None and turn == first  # the turn goes on in this block
                before, turn = last, final
                total = [a + b for a, b in zip(total, (blank, duplicate, truncated, illegal, cost), strict=True)]
                if lo is not None:
                    span = [min(lo, span[0] if span[0] is not None else lo), max(hi, span[1] if span[1] is not None else hi), span[2] + turns]

                def closed() -> tuple[tuple, int]:
                    gaps = 0 if span[0] is None else span[1] - span[0] + 1 - span[2]
                    text = "".join(audits)
                    return (now, gaps, *total, text, sha.hexdigest()), len(text)

            if sha is not None:
                yield closed()

        yield from _batches(rows(), schema)

    slim = blocks.select(F.col(conv_col).alias("conv"), "part", "audit", "repaired", "cost", "head", "last", "illegal", "blank", "duplicate",
                         "truncated", "turn_min", "turn_max", "turns", "turn_first", "turn_last")
    return (slim.repartition("conv").sortWithinPartitions("conv", "part").mapInArrow(summed, shape)
            .withColumnRenamed("conv", conv_col))


def _arrow(spark, shape: str) -> pa.Schema:
    """The Arrow form of a schema string."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    return to_arrow_schema(StructType.fromDDL(shape))


def damage(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Faults by a fixed rule, to test the repair: crc32(``conv:turn``) mod 20 says 0 drop, 1 empty the text,
    2 remove its ``.!?``, 3 repeat the message, 4 make it the user's. Nulls (in the key, too) become one space."""
    blank = F.lit(" ")
    rows = df.select(df[conv_col].alias("conv"), df[turn_col].alias("turn"), F.coalesce(df[role_col].cast("string"), blank).alias("role"),
                     F.coalesce(df[text_col], blank).alias("text"),
                     (F.crc32(F.concat(F.coalesce(df[conv_col].cast("string"), blank), F.lit(":"), F.coalesce(df[turn_col].cast("string"), blank))) % 20).alias("f"))
    return rows.where("f <> 0").select(
        F.col("conv").alias(conv_col), F.col("turn").alias(turn_col),
        F.when(F.col("f") == 4, "user").otherwise(F.col("role")).alias(role_col),
        F.when(F.col("f") == 1, "").when(F.col("f") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias(text_col),
        F.explode(F.when(F.col("f") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy")).drop("_copy")
