"""Repair of conversations by a checkpointed shortest-edit path.

The turns of a conversation become the cheapest sequence of Keep, Rerole,
Delete and Insert whose roles read (system)? (user assistant)+, or nothing. Four
states (nothing yet, after system, after user, after assistant) and one pass
backward give each row the least cost from each state to the end. These vectors
are kept at every sqrt(n)-th row only; walking forward, a block's vectors are
computed again from the checkpoint behind it, and at each step the ASCII-least
letter among those that stay on a cheapest path is written.

At scale: rows are range-partitioned by conversation and turn, so a long
conversation lies in many tasks and each task streams through its rows. A
conversation that lies whole in one task and has at most ``ROWS`` rows is
repaired there. Any other is cut into pieces of at most ``ROWS`` rows, and the
same method runs over them: each piece gives its four-by-four matrix of least
costs, the matrices give the vector at each piece's end (a row per piece), all
pieces are walked at once from each of the four entry states, and a pass over
the exits picks the walk that holds. A SHA-256 can only run from a text's first
byte to its last, so one task streams through a conversation's pieces, one at a
time; nothing else sees a conversation whole.

Defined results: null roles and texts are one space, so such texts are blank and
such roles must be changed; null turns come first; rows of one turn are ordered
by role, then by text (its first 64 characters, then a hash); null conv_ids are
one conversation; repeated rows are duplicates of the first; texts of any length
are taken whole; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from math import isqrt

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.taskcontext import TaskContext

from tradewh.llm.common import pick
from tradewh.operators.materialize import materialize

#: A piece has at most so many rows (a power of two) and, if it has more than
#: one row, so many characters.
ROWS, CHARS = 4096, 1 << 18
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state behind an inserted or changed turn, by the state before it.
NEXT = (USER, USER, ASSISTANT, USER)
#: Least cost of inserts behind the last row, by state.
END = (0, 4, 2, 0)
FAR = 1 << 60
_KEPT = {"s": ((START, SYSTEM),), "u": ((START, USER), (SYSTEM, USER), (ASSISTANT, USER)), "a": ((USER, ASSISTANT),)}
_LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}
_WHITE = " \t\n\v\f\r"
COUNTS = ["blank", "duplicate", "truncated", "illegal", "cost"]
SCHEMA = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


# -- the path ------------------------------------------------------------------
# A row is one letter: s, u, a or o (other) by its role's initial, a capital one
# if it is truncated, and x if it has to go.

def back(row: str, after: tuple) -> tuple:
    """Least costs before a row, given those behind it, by state."""
    best = [3 + c for c in after]
    if row != "x":
        cut = row.isupper()
        for q in range(4):
            best[q] = min(best[q], 2 + cut + after[NEXT[q]])
        for q, to in _KEPT.get(row.lower(), ()):
            best[q] = min(best[q], cut + after[to])
    u, a = min(best[USER], 2 + best[ASSISTANT]), min(best[ASSISTANT], 2 + best[USER])
    return min(best[START], 2 + u), min(best[SYSTEM], 2 + u), u, a


def matrix(rows: str) -> list[int]:
    """Least cost over the rows from each state to each state, row by row."""
    columns = []
    for to in range(4):
        costs = tuple(0 if q == to else FAR for q in range(4))
        for row in reversed(rows):
            costs = back(row, costs)
        columns.append(costs)
    return [min(columns[to][q], FAR) for q in range(4) for to in range(4)]


def walk(rows: str, end: tuple, state: int) -> tuple[str, int]:
    """(edits, state behind them) of the ASCII-least cheapest way from ``state``."""
    step, marks, costs = isqrt(len(rows)) + 1, {}, end
    for i in range(len(rows) - 1, -1, -1):
        costs = back(rows[i], costs)
        if i % step == 0:
            marks[i] = costs
    edits = []
    for low in range(0, len(rows), step):
        high = min(low + step, len(rows))
        block = [marks.get(high, end)]
        for i in range(high - 1, low - 1, -1):
            block.append(back(rows[i], block[-1]))
        for i in range(low, high):
            here, after, row = block[high - i], block[high - i - 1], rows[i]
            while here[state] != 3 + after[state]:  # D, the least letter, isn't on a cheapest way
                if here[state] == 2 + here[NEXT[state]]:
                    edits.append("I")
                    state = NEXT[state]
                    continue
                cut, to = row.isupper(), dict(_KEPT.get(row.lower(), ())).get(state)
                if to is not None and here[state] == cut + after[to]:
                    edits.append("K")
                    state = to
                else:
                    edits.append("R")
                    state = NEXT[state]
                break
            else:
                edits.append("D")
    return "".join(edits), state


def closing(state: int) -> tuple[str, int]:
    """The inserts behind a conversation's last row."""
    edits = ""
    while END[state]:
        edits, state = edits + "I", NEXT[state]
    return edits, state


def repaired(edits: str, state: int, roles: list[str], texts: list[str]) -> Iterator[tuple[str, str]]:
    """(role, text) of the turns that the edits leave."""
    rows = zip(roles, texts)
    for e in edits:
        role, text = next(rows) if e != "I" else ("", "")
        if e == "D":
            continue
        if e == "K":
            state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[role[0]]
        else:
            state = NEXT[state]
            role = "user" if state == USER else "assistant"
        yield role, text


def letters(roles: list[str], texts: list[str], seen: Callable[[int], bool]) -> tuple[str, dict[str, int]]:
    """The rows as letters, with the counts of faults; ``seen(i)``: row i repeats an earlier one."""
    out, count = [], dict.fromkeys(COUNTS, 0)
    for i, (role, text) in enumerate(zip(roles, texts)):
        body, kind = text.rstrip(_WHITE), role[:1] if role[:1] in ("s", "u", "a") else "o"
        if not body:
            fault = "blank"
        elif seen(i):
            fault = "duplicate"
        else:
            fault = "" if body[-1] in ".!?" else "truncated"
        if fault:
            count[fault] += 1
        out.append("x" if fault in ("blank", "duplicate") else kind.upper() if fault else kind)
    count["illegal"] = sum((a[:1], b[:1]) not in _LEGAL for a, b in zip(roles, roles[1:]))
    return "".join(out), count


def _gaps(turns: list) -> int:
    known = {t for t in turns if t is not None}
    return max(known) - min(known) + 1 - len(known) if known else 0


def _text(turns: Iterator[tuple[str, str]]) -> bytes | None:
    lines = [f"{role}:{text}" for role, text in turns]
    return "\n".join(lines).encode() if lines else None


def mend(turns: list, roles: list[str], texts: list[str]) -> dict:
    """One whole conversation's result and the repaired turns."""
    seen: set = set()

    def again(i: int) -> bool:
        key = (roles[i], texts[i])
        return key in seen or seen.add(key) is not None

    rows, count = letters(roles, texts, again)
    cost, state = END, START
    for row in reversed(rows):
        cost = back(row, cost)
    edits, state = walk(rows, END, START)
    edits += closing(state)[0]
    kept = list(repaired(edits, START, roles, texts))
    return count | {"gaps": _gaps(turns), "cost": cost[START], "audit": edits, "turns": kept,
                    "repaired_sha256": hashlib.sha256(_text(iter(kept)) or b"").hexdigest()}


# -- whole conversations and pieces ---------------------------------------------

_RESULT = [("conv_id", pa.int64()), ("gaps", pa.int64()), *[(c, pa.int64()) for c in COUNTS], ("audit", pa.string()),
           ("repaired_sha256", pa.string())]
_LISTS = [("turns", pa.list_(pa.int64())), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string()))]
_MIXED = pa.schema([*_RESULT, ("piece", pa.int64()), *_LISTS])
_MIXED_DDL = f"{SCHEMA}, piece long, turns array<long>, roles array<string>, texts array<string>"


class _Out:
    """Rows gathered to record batches of a bounded size."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows, self.size = schema, [], 0

    def put(self, row: dict, size: int = 1) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.size += size
        if len(self.rows) >= 2000 or self.size >= 8 << 20:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            yield pa.RecordBatch.from_pylist(self.rows, self.schema)
        self.rows, self.size = [], 0


def _sorted_rows(rows: DataFrame) -> DataFrame:
    has_gone = "gone" in rows.columns
    gone = F.coalesce(F.col("gone").cast("boolean"), F.lit(False)) if has_gone else F.lit(False)
    df = rows.withColumn("_gone", gone).withColumnRenamed("conv_id", "_conv")
    df = df.select(F.col("_conv").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                   F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
                   F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"), F.col("_gone").alias("gone"))
    # Like rows are told apart by where they were read, so that any number of them spreads.
    df = df.select("*", F.substring("role", 1, 64).alias("_r"), F.substring("text", 1, 64).alias("_t"),
                   F.xxhash64("role", "text").alias("_h"), F.monotonically_increasing_id().alias("_at"))
    order = ["conv_id", "turn", "_r", "_t", "_h", "_at"]
    return df.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "turn", "role", "text", "gone")


def _cut(with_turns: bool, most: int) -> Callable:
    """Streams through a task's sorted rows: results of whole conversations, pieces of the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, count = TaskContext.get().partitionId() << 40, 0
        out, lists, size, conv, cut, begun = _Out(_MIXED), ([], [], []), 0, None, True, False

        def piece() -> dict:
            nonlocal lists, size, count
            row = {"conv_id": conv, "piece": base + count * most, "turns": lists[0], "roles": lists[1], "texts": lists[2]}
            lists, size, count = ([], [], []), 0, count + 1
            return row

        def whole() -> dict:
            nonlocal lists, size
            turns, row = lists[0], {"conv_id": conv} | mend(*lists)
            kept = row.pop("turns")
            if with_turns:
                row |= {"turns": turns, "roles": [r for r, _ in kept], "texts": [t for _, t in kept]}
            lists, size = ([], [], []), 0
            return row

        for batch in batches:
            for key, turn, role, text, gone in zip(*(c.to_pylist() for c in batch.columns)):
                if begun and key != conv:
                    yield from out.put(piece() if cut else whole(), size)
                    cut = False
                begun, conv = True, key
                if gone:
                    continue
                if lists[0] and (len(lists[0]) == most or size + len(text) > CHARS):
                    cut = True
                    yield from out.put(piece(), size)
                for values, x in zip(lists, (turn, role, text)):
                    values.append(x)
                size += len(text) + len(role)
        if begun:  # the next task may go on with this conversation
            yield from out.put(piece(), size)
        yield from out.flush()

    return run


# -- pieces of long and cut conversations -----------------------------------------

_SKETCH = pa.schema([("conv_id", pa.int64()), ("piece", pa.int64()), ("rows", pa.string()), ("costs", pa.list_(pa.int64())),
                     *[(c, pa.int64()) for c in ("blank", "duplicate", "truncated", "illegal", "distinct", "low", "high")],
                     ("first_role", pa.string()), ("last_role", pa.string())])
_SKETCH_DDL = ("conv_id long, piece long, rows string, costs array<long>, blank long, duplicate long, truncated long, illegal long, "
               "distinct long, low long, high long, first_role string, last_role string")


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out = _Out(_SKETCH)
    for batch in batches:
        for row in batch.to_pylist():
            firsts, roles = set(row["firsts"] or ()), row["roles"]
            rows, count = letters(roles, row["texts"], lambda i: row["piece"] + i not in firsts)
            turns = {t for t in row["turns"] if t is not None}
            count.pop("cost")
            yield from out.put(count | {
                "conv_id": row["conv_id"], "piece": row["piece"], "rows": rows, "costs": matrix(rows), "distinct": len(turns),
                "low": min(turns, default=None), "high": max(turns, default=None),
                "first_role": roles[0][:1] if roles else None, "last_role": roles[-1][:1] if roles else None}, len(rows) + 200)
    yield from out.flush()


def _ends(pieces: pd.DataFrame) -> pd.DataFrame:
    """A conversation's pieces (a row each): the vector at each piece's end, and
    what neighbours share: a turn on both sides of the cut, an illegal pair over it."""
    pieces = pieces.sort_values("piece").reset_index(drop=True)
    ends, vector = [], END
    for costs in reversed(pieces["costs"].tolist()):
        ends.append(list(vector))
        vector = tuple(min(costs[4 * q + to] + vector[to] for to in range(4)) for q in range(4))
    pairs, shared, role, high = [], [], None, None
    for r in pieces.itertuples():
        pairs.append(int(role is not None and r.first_role is not None and (role, r.first_role) not in _LEGAL))
        shared.append(int(high is not None and not pd.isna(r.low) and high == r.low))
        role, high = r.last_role if r.last_role is not None else role, r.high if not pd.isna(r.high) else high
    n = len(pieces)
    return pd.DataFrame({"piece": pieces["piece"], "end": ends[::-1], "last": [i == n - 1 for i in range(n)], "pair": pairs,
                         "shared": shared, "cost": [vector[START]] + [0] * (n - 1)})


_WALKED = pa.schema([("conv_id", pa.int64()), ("piece", pa.int64()), ("edits", pa.list_(pa.string())), ("exits", pa.list_(pa.int64()))])


def _walks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out = _Out(_WALKED)
    for batch in batches:
        for row in batch.to_pylist():
            ways = []
            for state in range(4):
                edits, to = walk(row["rows"], tuple(row["end"]), state)
                more, to = closing(to) if row["last"] else ("", to)
                ways.append((edits + more, to))
            yield from out.put({"conv_id": row["conv_id"], "piece": row["piece"], "edits": [w for w, _ in ways],
                                "exits": [s for _, s in ways]}, 5 * len(row["rows"]) + 100)
    yield from out.flush()


def _entries(pieces: pd.DataFrame) -> pd.DataFrame:
    pieces, state, entries = pieces.sort_values("piece"), START, []
    for exits in pieces["exits"]:
        entries.append(state)
        state = int(exits[state])
    return pd.DataFrame({"piece": pieces["piece"].to_numpy(), "entry": entries})


def _block(row: dict) -> list[tuple[str, str]]:
    return list(repaired(row["edits"], row["entry"], row["roles"], row["texts"]))


_BLOCK_NUMBERS = ["blank", "duplicate", "truncated", "illegal", "cost", "distinct", "low", "high"]
_BLOCKS = pa.schema([("conv_id", pa.int64()), ("piece", pa.int64()), *[(c, pa.int64()) for c in _BLOCK_NUMBERS],
                     ("audit", pa.string()), ("body", pa.binary())])
_BLOCKS_DDL = "conv_id long, piece long, " + ", ".join(f"{c} long" for c in _BLOCK_NUMBERS) + ", audit string, body binary"


def _bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out = _Out(_BLOCKS)
    for batch in batches:
        for row in batch.to_pylist():
            body = _text(iter(_block(row)))
            yield from out.put({c: row[c] for c in ("conv_id", "piece", *_BLOCK_NUMBERS)} | {"audit": row["edits"], "body": body},
                               len(body or b"") + 200)
    yield from out.flush()


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Streams through the sorted pieces of a task's conversations."""
    out, conv, state = _Out(pa.schema(_RESULT)), None, None

    def result() -> dict:
        count, low, high, audit, digest, _ = state
        gaps = high - low + 1 - count["distinct"] if low is not None else 0
        return {c: count[c] for c in COUNTS} | {"conv_id": conv, "gaps": gaps, "audit": "".join(audit), "repaired_sha256": digest.hexdigest()}

    for batch in batches:
        for row in batch.to_pylist():
            if state is None or row["conv_id"] != conv:
                if state is not None:
                    yield from out.put(result())
                conv, state = row["conv_id"], [dict.fromkeys([*COUNTS, "distinct"], 0), None, None, [], hashlib.sha256(), False]
            for c in state[0]:
                state[0][c] += row[c]
            if row["low"] is not None:
                state[1] = row["low"] if state[1] is None else min(state[1], row["low"])
                state[2] = row["high"] if state[2] is None else max(state[2], row["high"])
            state[3].append(row["audit"])
            if row["body"] is not None:
                state[4].update((b"\n" if state[5] else b"") + row["body"])
                state[5] = True
    if state is not None:
        yield from out.put(result())
    yield from out.flush()


def _solved(pieces: DataFrame, most: int) -> DataFrame:
    """The pieces with their edits, entry states and counts."""
    rows = pieces.select("conv_id", "piece", F.posexplode(F.arrays_zip("roles", "texts")).alias("pos", "r"))
    digest = F.sha2(F.concat(F.length("r.roles").cast("string"), F.lit(":"), F.col("r.roles"), F.col("r.texts")), 256)
    firsts = rows.groupBy("conv_id", digest.alias("_d")).agg(F.min(F.col("piece") + F.col("pos")).alias("at"))
    firsts = firsts.groupBy((F.col("at") - F.pmod("at", F.lit(most))).alias("_p")).agg(F.collect_list("at").alias("firsts"))
    known = pieces.join(firsts, F.col("piece") == F.col("_p"), "left").drop("_p")
    sketch = materialize(known.mapInArrow(_sketch, _SKETCH_DDL), "turn-sketches")
    as_text = {c: F.col(c).cast("string") for c in ("low", "high")}  # pandas would make long integers doubles where some are null
    ends = sketch.withColumns(as_text).groupBy("conv_id").applyInPandas(_ends, "piece long, end array<long>, last boolean, pair long, shared long, cost long")
    ends = materialize(ends, "turn-ends")
    walked = sketch.select("conv_id", "piece", "rows").join(ends.select("piece", "end", "last"), "piece").select(
        "conv_id", "piece", "rows", "end", "last").mapInArrow(_walks, "conv_id long, piece long, edits array<string>, exits array<long>")
    walked = materialize(walked, "turn-walks")
    entries = walked.groupBy("conv_id").applyInPandas(_entries, "piece long, entry long")
    edits = walked.join(entries, "piece").select("piece", "entry", F.element_at("edits", (F.col("entry") + 1).cast("int")).alias("edits"))
    counts = sketch.join(ends.drop("end", "last"), "piece").select(
        "piece", "blank", "duplicate", "truncated", (F.col("illegal") + F.col("pair")).alias("illegal"), "cost",
        (F.col("distinct") - F.col("shared")).alias("distinct"), "low", "high")
    return pieces.select("conv_id", "piece", "roles", "texts").join(edits, "piece").join(counts, "piece")


def _prepared(rows: DataFrame, with_turns: bool, most: int) -> tuple[DataFrame, DataFrame]:
    mixed = materialize(_sorted_rows(rows).mapInArrow(_cut(with_turns, most), _MIXED_DDL), "conversations")
    return mixed.where("piece IS NULL"), mixed.where("piece IS NOT NULL").select("conv_id", "piece", "turns", "roles", "texts")


def repair(rows: DataFrame, most: int = ROWS) -> DataFrame:
    """One row per conversation of ``rows`` (conv_id, turn, role, text; rows with
    a true ``gone`` count for nothing but their conv_id): gaps, faults, cost, the
    edits and the SHA-256 of the repaired ``role:text`` lines."""
    names = [n for n, _ in _RESULT]
    whole, pieces = _prepared(rows, False, most)
    bodies = _solved(pieces, most).mapInArrow(_bodies, _BLOCKS_DDL)
    # Few rows, a piece each: AQE would read them all in one task by their bytes.
    joined = bodies.repartition("conv_id").sortWithinPartitions("conv_id", "piece").mapInArrow(
        _joined, ", ".join(f"{n} {'string' if t == pa.string() else 'long'}" for n, t in _RESULT))
    return whole.select(*names).unionByName(joined.select(*names))


def repaired_turns(rows: DataFrame, most: int = ROWS) -> DataFrame:
    """The repaired conversations: conv_id, block and pos (the order of a
    conversation's turns), role, text."""
    whole, pieces = _prepared(rows, True, most)

    def turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("conv_id", pa.int64()), ("block", pa.int64()), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string()))])
        out = _Out(schema)
        for batch in batches:
            for row in batch.to_pylist():
                kept = _block(row)
                yield from out.put({"conv_id": row["conv_id"], "block": row["piece"], "roles": [r for r, _ in kept],
                                    "texts": [t for _, t in kept]}, sum(len(t) for _, t in kept))
        yield from out.flush()

    blocks = whole.select("conv_id", F.lit(0).cast("long").alias("block"), "roles", "texts").unionByName(
        _solved(pieces, most).mapInArrow(turns, "conv_id long, block long, roles array<string>, texts array<string>"))
    return blocks.select("conv_id", "block", F.posexplode(F.arrays_zip("roles", "texts")).alias("pos", "t")).select(
        "conv_id", "block", "pos", F.col("t.roles").alias("role"), F.col("t.texts").alias("text"))


def damage(rows: DataFrame) -> DataFrame:
    """Conversations with planted faults, chosen by crc32 of ``conv_id:turn`` modulo
    20: 0 the row goes (``gone``), 1 no text, 2 no ``.!?``, 3 twice, 4 role user."""
    space = F.lit(" ")
    df = pick(rows, conv_id="long", turn="long", role="string", text="string")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind: Column = F.pmod(F.crc32(key.cast("binary")), F.lit(20))
    text, role = F.coalesce("text", space), F.coalesce("role", space)
    df = df.select(
        "conv_id", "turn", kind.alias("kind"), F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind <= 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"))
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return df.select("conv_id", "turn", "role", "text", (F.col("kind") == 0).alias("gone"), copies.alias("_copy")).drop("_copy")
