import hashlib
import itertools
import random
import re
import zlib

import pytest

from quire.llm import repair

SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
SCHEMA = "conv_id long, turn long, role string, text string, chunk string, symbols string, mark string"


def damaged(rows):
    out = []
    for conv, turn, role, text, *_ in rows:
        key = ":".join(" " if v is None else str(v) for v in (conv, turn))
        role, text, hit = " " if role is None else role, " " if text is None else text, zlib.crc32(key.encode()) % 20
        if hit:
            text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
            out += [(conv, turn, "user" if hit == 4 else role, text)] * (2 if hit == 3 else 1)
    return out


def ordered(rows):
    def key(r):
        mark = hashlib.sha256(f"{len(r[2])}:{r[2]}{r[3]}".encode()).digest()
        return r[1] is not None, r[1] or 0, mark

    return sorted(rows, key=key)


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        bare = text.rstrip(SPACE)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def scripts(rows, marks):
    """(cost, audit, turns) of every script with up to three insertions in a place."""
    def go(i, state):
        for inserted in range(4):
            cost, turns, q = 2 * inserted, [], state
            for _ in range(inserted):
                q = repair.NEXT[q]
                turns.append(repair.ROLE[q] + ":")
            if i == len(rows):
                if q in (0, 3):
                    yield cost, "I" * inserted, turns
                continue
            role, text = rows[i][2], rows[i][3]
            more = marks[i] == "truncated"
            for c, a, t in go(i + 1, q):
                yield cost + 3 + c, "I" * inserted + "D" + a, turns + t
            if marks[i] in ("blank", "duplicate"):
                continue
            kept = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}.get((role[:1], q))
            if kept:
                for c, a, t in go(i + 1, kept):
                    yield cost + more + c, "I" * inserted + "K" + a, [*turns, f"{role}:{text}", *t]
            for c, a, t in go(i + 1, repair.NEXT[q]):
                yield cost + 2 + more + c, "I" * inserted + "R" + a, [*turns, f"{repair.ROLE[repair.NEXT[q]]}:{text}", *t]

    return go(0, 0)


def brute(conv, rows):
    rows = ordered(rows)
    marks = faults(rows)
    turns = {r[1] for r in rows} - {None}
    initials = [r[2][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    cost, audit, said = min(scripts(rows, marks), key=lambda x: x[:2])
    return (conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *[marks.count(m) for m in ("blank", "duplicate", "truncated")],
            illegal, cost, audit, hashlib.sha256("\n".join(said).encode()).hexdigest())


def expected(rows):
    after = {r[0]: [] for r in rows}
    for r in damaged(rows):
        after[r[0]].append(r)
    return [brute(c, rs) for c, rs in after.items()]


def test_every_script(spark):
    """All edits are compared by brute force, ties included, in chunks of any size."""
    r = random.Random(11)
    texts = ["Yes.", "No!", "cut", "cut off ", "", " \t", "Why?\n", "é", None]
    rows = []
    for conv in range(120):
        for turn in range(r.randrange(1, 6)):
            rows.append((conv, r.choice([None, turn, turn, turn + 2]), r.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None]),
                         r.choice(texts)))
    rows += [(None, i, "user", "Same.") for i in range(4)]
    df = spark.createDataFrame([(*x, "c", "s", "m") for x in rows], SCHEMA).repartition(3)
    key = lambda x: (x[0] is not None, x[0] or 0)
    want = sorted(expected(rows), key=key)
    for chunk in (repair.CHUNK, 3):
        got = sorted((tuple(x)[:9] for x in repair.repair_damaged(spark, df, chunk).collect()), key=key)
        assert got == want
    assert len({x[7] for x in want}) > 40


def test_edges(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert not repair.repair_damaged(spark, empty).collect() and not repair.repaired_turns(spark, empty).collect()
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    row = repair.repair_damaged(spark, spark.createDataFrame([(gone, 0, "user", "Hi.", "c", "s", "m")], SCHEMA)).first()
    assert tuple(row) == (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_blocks_agree_with_single_symbols():
    t = repair.tables()
    r = random.Random(4)
    for _ in range(200):
        symbols = bytes(r.choices(range(repair.SYMBOLS), k=r.randrange(40)))
        at, cost = 0, 0
        for s in symbols[::-1]:
            at, cost = int(t.turn[at, s]), cost + int(t.cost[at, s])
        turned, costs = t.over(symbols)
        assert (turned[0], costs[0]) == (at, cost)
        assert t.script(symbols, 0, 0) == t.expand(symbols, 0, 0)
    assert len(t.vectors) < 100 and t.block_turn.shape == (len(t.vectors), repair.SYMBOLS ** repair.SPAN)


@pytest.mark.parametrize("n", [1, 2, 3])
def test_costs_of_all_short_conversations(n):
    t = repair.tables()
    for symbols in itertools.product(range(repair.SYMBOLS), repeat=n):
        rows = [(0, i, ("system", "user", "assistant", "tool")[s % 4], f"t{i}") for i, s in enumerate(symbols)]
        marks = ["blank" if s >= 8 else "truncated" if s >= 4 else "" for s in symbols]
        cost, audit, _ = min(scripts(rows, marks), key=lambda x: x[:2])
        plan, state = t.script(bytes(symbols), 0, 0)
        got = "".join("I" * k + letter for k, letter in plan) + "I" * t.ending(state)
        assert (int(t.over(bytes(symbols))[1][0] + t.vectors[t.over(bytes(symbols))[0][0]][0]), got) == (cost, audit)


def test_long_conversation_over_many_chunks(spark):
    r = random.Random(6)
    rows = [(5, i // 2, r.choice(["user", "assistant", "system"]), r.choice(["Yes.", f"a {i}", f"b {i}!", ""])) for i in range(3000)]
    rows += [(6, 0, "user", "Hi."), (6, 1, "assistant", "Ho.")]
    df = spark.createDataFrame([(*x, "c", "s", "m") for x in rows], SCHEMA).repartition(4)
    small = {x.conv_id: tuple(x) for x in repair.repair(spark, df, 64).collect()}
    whole = {x.conv_id: tuple(x) for x in repair.repair(spark, df).collect()}
    assert small == whole and small[6][6:8] == (0, "KK") and len(small[5][7]) >= 3000
    turns = [x for x in repair.repaired_turns(spark, df, 64).collect() if x.conv_id == 5]
    turns.sort(key=lambda x: x.place)
    assert hashlib.sha256("\n".join(f"{x.role}:{x.text}" for x in turns).encode()).hexdigest() == small[5][8]
    assert re.fullmatch("(s?(ua)+)?", "".join(x.role[0] for x in turns))
    assert "".join(x.edit for x in turns) == small[5][7].replace("D", "")
