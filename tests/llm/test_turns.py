"""Conversation repair against a plain search, and its tables against single steps."""

import hashlib
import random
import zlib
from functools import cache

import pytest

from tallyrec.llm import turns

SMALL = "/root/testdata/sf0.001"
SPACE = " \t\n\x0b\x0c\r"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def plain(rows):
    """(blank, duplicate, truncated, illegal, cost, audit, repaired lines) of the rows (role, text) of a conversation."""
    seen, faults = set(), []
    for role, text in rows:
        end = text.rstrip(SPACE)
        faults.append(1 if not end else 2 if (role, text) in seen else 3 if end[-1] not in ".!?" else 0)
        seen.add((role, text))
    initials = [r[:1] for r, _ in rows]
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    wanted = {"": "user", "s": "user", "u": "assistant", "a": "user"}

    @cache
    def best(i, q, room):
        found = [(0, "")] if i == len(rows) and q in ("", "a") else []
        add = lambda cost, c, to: found.append((cost + to[0], c + to[1])) if to else None
        if room:
            add(5, "I", best(i, wanted[q][0], room - 1))
        if i < len(rows):
            add(2, "D", best(i + 1, q, 3))
            if faults[i] not in (1, 2):
                more = 5 * (faults[i] == 3)
                if (q, initials[i]) in step:
                    add(more, "K", best(i + 1, initials[i], 3))
                add(more + 1, "R", best(i + 1, wanted[q][0], 3))
        return min(found) if found else None

    for i in range(len(rows), -1, -1):  # from the end on: no deep recursion
        for q in wanted:
            best(i, q, 3)
    cost, audit = best(0, "", 3)
    lines, i, q = [], 0, ""
    for c in audit:
        if c in "KR":
            lines.append((rows[i][0] if c == "K" else wanted[q], rows[i][1]))
        elif c == "I":
            lines.append((wanted[q], ""))
        i += c != "I"
        q = q if c == "D" else lines[-1][0][:1]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
    return faults.count(1), faults.count(2), faults.count(3), illegal, cost, audit, lines


def expected(original):
    out = {}
    rows = damage(original)
    for conv in {r[0] for r in original}:
        mine = sorted((r for r in rows if r[0] == conv),
                      key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).digest()))
        known = [r[1] for r in mine if r[1] is not None]
        *counts, cost, audit, lines = plain([r[2:] for r in mine])
        text = "\n".join(f"{r}:{t}" for r, t in lines)
        out[conv] = (max(known) - min(known) + 1 - len(set(known)) if known else 0, *counts, cost, audit,
                     hashlib.sha256(text.encode()).hexdigest())
    return out


def random_rows(seed, conversations, most):
    rng = random.Random(seed)
    rows = []
    for conv in range(conversations):
        for turn in range(rng.randint(1, most)):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", None, "usher"])
            text = rng.choice([None, "", " \t", "Hello.", "Hi", "What? \n", "so it is" + str(rng.randint(0, 30)) + ".", "No\x85", "é!"])
            rows.append((conv if conv else None, rng.choice([turn, turn, turn + 3, None, turn // 2]), role, text))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, 7, "x") for r in rows], "conv_id long, turn long, role string, text string, row int, digest string")


def got(df):
    return {r["conv_id"]: (r["gaps"], r["blank"], r["duplicate"], r["truncated"], r["illegal"], r["cost"], r["audit"], r["repaired_sha256"])
            for r in df.collect()}


@pytest.mark.parametrize("bounds", [(4096, 4_000_000), (3, 4_000_000), (4096, 12)])
def test_report_by_plain_search(spark, bounds, monkeypatch):
    rows = random_rows(5, 60, 14)
    want = expected(rows)
    monkeypatch.setattr(turns, "ROWS", bounds[0])
    monkeypatch.setattr(turns, "CHARS", bounds[1])
    assert got(turns.report(turns.damaged(frame(spark, rows)))) == want


def test_one_conversation_over_many_tasks(spark, monkeypatch):
    rows = [(c, t, r, x) for c, t, r, x in random_rows(9, 6, 30) if c] + [(99, *r[1:]) for r in random_rows(3, 60, 8)]
    monkeypatch.setattr(turns, "ROWS", 5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert got(turns.report(turns.damaged(frame(spark, rows)))) == expected(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_query_over_the_table(spark):
    from tallyrec.llm.queries import QUERIES

    df = QUERIES["op12_four_russians_repair"](spark, SMALL)
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(df) == expected(rows)
    assert df.columns[:9] == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def test_repaired_rows_and_empty_table(spark):
    rows = [(1, 0, "user", "a."), (1, 1, "assistant", "b"), (1, 2, "user", "")]
    out = turns.repair(frame(spark, rows).selectExpr("*", "true as present")).orderBy("place", "line").collect()
    assert [(r["role"], r["text"]) for r in out] == plain([r[2:] for r in rows])[-1]
    assert turns.report(turns.damaged(frame(spark, rows).limit(0))).count() == 0


def test_block_tables_equal_single_steps():
    t, one = turns.tables(), turns.Tables(block=1)
    assert len(t.vectors) == len(one.vectors) < 100
    rng = random.Random(1)
    for n in (0, 1, 3, 4, 5, 8, 29, 64):
        symbols = bytes(rng.randrange(turns.SYMBOLS) for _ in range(n))
        for v in range(len(t.vectors)):
            a, b = t.backward(symbols, v), one.backward(symbols, v)
            assert t.vectors[a[0]] == one.vectors[b[0]] and a[1] == b[1]
            for q in range(turns.STATES):
                assert t.forward(symbols, a[2], q) == one.forward(symbols, b[2], q)
        to, add, ends = t.function(symbols)
        for v in range(len(t.vectors)):
            left, cost, rights = t.backward(symbols, v)
            assert (to[v], add[v]) == (left, cost)
            assert ends[4 * v:4 * v + 4] == [t.forward(symbols, rights, q)[1] for q in range(4)]
