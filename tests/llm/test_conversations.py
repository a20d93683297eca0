"""Conversation repair against a forward search that keeps whole edit strings."""

import hashlib
import itertools
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import SF
from tradewh.llm import conversations as conv, queries

SCHEMA = "conv_id long, turn long, role string, text string"


def best_edits(rows):
    """(cost, audit) over all edits, forwards: the least pair per state; rows are
    (initial, has to go, truncated)."""
    def closed(best):
        for _ in range(3):
            for q in list(best):
                cost, audit = best[q]
                to = {"": "u", "s": "u", "u": "a", "a": "u"}[q]
                best[to] = min(best.get(to, (10**9, "")), (cost + 2, audit + "I"))
        return best

    best = closed({"": (0, "")})
    for initial, goes, cut in rows:
        after = {}
        for q, (cost, audit) in best.items():
            ways = [(q, cost + 3, "D")]
            if not goes:
                to = {"": "u", "s": "u", "u": "a", "a": "u"}[q]
                ways.append((to, cost + 2 + cut, "R"))
                if initial == to or (q == "" and initial == "s"):
                    ways.append((initial, cost + cut, "K"))
            for to, c, e in ways:
                after[to] = min(after.get(to, (10**9, "")), (c, audit + e))
        best = closed(after)
    return min(best[q] for q in ("", "a") if q in best)


def brute(rows):
    """Results by conversation of damaged rows (conv_id, turn, role, text)."""
    out = {}
    for key in {r[0] for r in rows}:
        turns = sorted((r[1:] for r in rows if r[0] == key), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, letters, faults = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in turns:
            body = text.strip(" \t\n\v\f\r")
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated"
            seen.add((role, text))
            if fault:
                faults[fault] += 1
            letters.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
        cost, audit = best_edits(letters)
        state, lines, at = "", [], iter(turns)
        for e in audit:
            role, text = ("", "") if e == "I" else next(at)[1:]
            if e == "D":
                continue
            state = role[:1] if e == "K" else {"": "u", "s": "u", "u": "a", "a": "u"}[state]
            lines.append(f"{role if e == 'K' else {'u': 'user', 'a': 'assistant'}[state]}:{text}")
        known = {t for t, _, _ in turns if t is not None}
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        out[key] = (max(known) - min(known) + 1 - len(known) if known else 0, *faults.values(), illegal, cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def damaged(rows):
    out = []
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = "user" if kind == 4 else " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else "".join(x for x in text if x not in ".!?") if kind == 2 else text
        out += [(c, t, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def by_conversation(df):
    rows = df.collect()
    assert len(rows) == len({r["conv_id"] for r in rows})
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return {r["conv_id"]: tuple(r[n] for n in names) for r in rows}


NOTHING = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_path_equals_enumeration():
    rng = random.Random(4)
    for n in range(7):
        for rows in itertools.product("suaoUx", repeat=n) if n < 4 else (rng.choices("suaoSUAOx", k=n) for _ in range(300)):
            want = best_edits([(r.lower(), r == "x", r.isupper()) for r in rows])
            cost = conv.END
            for r in reversed(rows):
                cost = conv.back(r, cost)
            edits, state = conv.walk("".join(rows), conv.END, conv.START)
            assert (cost[conv.START], edits + conv.closing(state)[0]) == want, rows


def test_matrices_carry_the_costs_over_pieces():
    rng = random.Random(5)
    for _ in range(200):
        rows = "".join(rng.choices("suaoSUAOx", k=rng.randint(0, 12)))
        costs, whole = conv.matrix(rows), conv.END
        for r in reversed(rows):
            whole = conv.back(r, whole)
        assert tuple(min(costs[4 * q + to] + conv.END[to] for to in range(4)) for q in range(4)) == whole


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = brute(damaged(rows)) | {}
    got = by_conversation(queries.op13_conversation_repair(spark, SF))
    assert got == {c: want.get(c, NOTHING) for c in {r[0] for r in rows}}


@pytest.mark.parametrize("most", [1, 2, 16, 4096])
def test_long_hot_and_odd_conversations(spark, most):
    """A conversation with most of the rows lies in many pieces and tasks."""
    rng = random.Random(6)
    rows = []
    for i in range(600):
        text = rng.choice(["Yes.", "No!", "cut", "", " ", None, "Ünï?", "a\nb. ", f"{i}" + "x" * 30_000, "Yes. ", f"{i % 50}."])
        rows.append((rng.choice([7, 7, 7, 7, 1, 2, None, 3]), rng.choice([None, i, i, i, i // 2, 2**60 + i]),
                     rng.choice(["user", "assistant", "system", "tool", "", None, "user", "assistant"]), text))
    rows += [rows[5]] * 40 + [(9, 1, "user", "only."), (2**62, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("audit", F.lit("own")).withColumn("piece", F.lit(1)).repartition(5)
    want = brute(damaged(rows))
    got = by_conversation(conv.repair(conv.damage(df), most=most))
    assert got == {c: want.get(c, NOTHING) for c in {r[0] for r in rows}}


def test_repaired_turns_have_the_hash_and_the_roles(spark):
    rows = conv.damage(spark.read.parquet(f"{SF}/conversations.parquet"))
    turns = conv.repaired_turns(rows, most=2).collect()
    lines = {}
    for r in sorted(turns, key=lambda r: (r["conv_id"], r["block"], r["pos"])):
        lines.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    for c, result in by_conversation(conv.repair(rows)).items():
        mine = lines.get(c, [])
        assert hashlib.sha256("\n".join(f"{r}:{t}" for r, t in mine).encode()).hexdigest() == result[-1]
        kinds = "".join(r[0] for r, _ in mine)
        assert kinds.lstrip("s") == "ua" * (len(kinds.lstrip("s")) // 2) and len(kinds) - len(kinds.lstrip("s")) <= 1


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert conv.repair(conv.damage(none)).collect() == [] and conv.repaired_turns(conv.damage(none)).collect() == []
