"""Repair of conversations against all edits by recursion, and the query against SQL of another method."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import duckdb
import pytest

from factloom.llm import chat_repair
from factloom.llm.queries import QUERIES, SQL

SPACE = " \t\n\x0b\x0c\r"


def brute(rows):
    """The cheapest (cost, audit, repaired) of rows (role, text, must go, truncated), by trying all edits with up to two inserts at a place."""

    @lru_cache(None)
    def best(i, end):  # end: initials so far, of which the last one and being empty matter
        out = []
        if i == len(rows) and end in ("", "a"):
            out.append((0, "", ()))
        moves = []
        if i < len(rows):
            role, text, gone, cut_off = rows[i]
            moves.append((4, "D", i + 1, end, ()))
            if not gone:
                moves.append((3 * cut_off, "K", i + 1, role[:1] or "?", (f"{role}:{text}",)))
                moves += [(3 + 3 * cut_off, "R", i + 1, r[0], (f"{r}:{text}",)) for r in ("user", "assistant")]
        for cost, edit, j, to, line in moves:
            if edit != "D" and end + to not in ("s", "u", "su", "ua", "au"):
                continue
            out += [(cost + c, edit + d, line + t) for c, d, t in [best(j, to)] if c < 10**9]
        for r in ("user", "assistant"):
            if end + r[0] in ("u", "su", "ua", "au") and tries[i] < 3:
                tries[i] += 1
                out += [(3 + c, "I" + d, (f"{r}:", *t)) for c, d, t in [inserted(i, r[0])] if c < 10**9]
                tries[i] -= 1
        return min(out, key=lambda x: x[:2], default=(10**9, "", ()))

    def inserted(i, end):
        return best.__wrapped__(i, end)

    tries = [0] * (len(rows) + 1)
    return best(0, "")


def expected(rows):
    """The digest columns of damaged rows (turn, role, text) in order."""
    seen, faults = set(), []
    for _, role, text in rows:
        body = text.rstrip(SPACE)
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    cost, audit, lines = brute(tuple((r, t, f in ("blank", "duplicate"), f == "truncated") for (_, r, t), f in zip(rows, faults, strict=True)))
    turns = [t for t, *_ in rows if t is not None]
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return sorted(out, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))


def chats():
    r = random.Random(11)
    rows = []
    for conv in [None, -(1 << 63), (1 << 60) + 1, 1 << 60, *range(150)]:
        for k in range(r.randrange(1, 9)):
            turn = r.choice([k, k, k, k + 3, k * 2, None])
            rows.append((conv, turn, r.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "ünk", "a"]), r.choice(["Hi.", "Yes!", "no end", "  ", "", None, "Ok? \n", "a.b", "A long one. " * 3])))
    rows += rows[:40]
    return rows


@pytest.mark.parametrize("block", [1, 3, 256])
def test_against_all_edits(spark, monkeypatch, block):
    monkeypatch.setattr(chat_repair, "BLOCK_ROWS", block)
    rows = chats()
    table = spark.createDataFrame([(*x, "clash", 7, 8) for x in rows], "conv_id long, turn long, role string, text string, kind string, copies int, cost int").repartition(5)
    got = {x[0]: tuple(x[1:]) for x in chat_repair.repair(chat_repair.damaged(table)).collect()}
    after = damaged(rows)
    assert got == {c: expected([x[1:] for x in after if x[0] == c]) for c in {x[0] for x in rows}}
    assert chat_repair.repair(chat_repair.damaged(table.where("false"))).collect() == []


@pytest.mark.parametrize("size", [1, 2, 5, 10**9])
def test_blocks_give_what_the_whole_gives(monkeypatch, size):
    """A long conversation in blocks of rows and of bytes."""
    r = random.Random(3)
    rows = [(i, r.choice(["user", "assistant", "system", "x"]), r.choice(["One.", f"No {i}", f"Yes {i}!", " "])) for i in range(700)]

    def run():
        seen, c = set(), chat_repair.Conversation()
        for turn, role, text in rows:
            body = text.rstrip(SPACE)
            c.add(turn, role, text, not body, (role, text) in seen, not body.endswith((".", "!", "?")))
            seen.add((role, text))
        return c.result()

    whole = run()
    monkeypatch.setattr(chat_repair, "BLOCK_ROWS", size)
    monkeypatch.setattr(chat_repair, "BLOCK_BYTES", 10 * size)
    assert run() == whole and re.fullmatch("[KRDI]+", whole[6])


def test_ties_take_the_first_audit():
    c = chat_repair.Conversation()
    for i, (role, text) in enumerate([("user", "a."), ("user", "b."), ("assistant", "c.")]):
        c.add(i, role, text, False, False, False)
    assert c.result()[5:7] == (3, "KIKK")
    c = chat_repair.Conversation()
    c.add(0, "assistant", "c.", False, False, False)
    assert c.result()[5:7] == (3, "IK")


def test_query_against_sql(spark):
    sf = "/root/testdata/sf0.01"
    duck = duckdb.connect()
    duck.execute(f"create view conversations as select * from '{sf}/conversations.parquet'")
    names = ["conv_id", *(x.split()[0] for x in chat_repair.RESULT.split(", "))]
    theirs = duck.sql(f"select {', '.join(names)} from ({SQL['op11_chat_repair']})").fetchall()
    assert sorted(map(tuple, QUERIES["op11_chat_repair"](spark, sf).select(*names).collect())) == sorted(theirs)


def test_sql_on_awkward_rows(spark):
    import pandas as pd

    rows = chats()
    duck = duckdb.connect()
    frame = pd.DataFrame({k: pd.array([x[i] for x in rows], "Int64" if i < 2 else "string") for i, k in enumerate(["conv_id", "turn", "role", "text"])})
    duck.register("conversations", frame)
    names = ["conv_id", *(x.split()[0] for x in chat_repair.RESULT.split(", "))]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    ours = chat_repair.repair(chat_repair.damaged(table)).select(*names).collect()
    assert sorted(map(tuple, ours), key=repr) == sorted(duck.sql(f"select {', '.join(names)} from ({SQL['op11_chat_repair']})").fetchall(), key=repr)
