"""Conversation repair against a plain search of all edits."""

import hashlib
import random
import re
import sys
import zlib
from functools import cache

import pytest

from tillroll.llm import conversation_repair as cr

SCHEMA = "conv_id long, turn long, role string, text string, _conv string, _pos string, place int"
NEXT = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}


def plain_edits(rows):
    """Least (cost, edits) over rows of (initial, must go, truncated): every edit, by memory of suffixes."""
    sys.setrecursionlimit(20_000)
    @cache
    def best(i, state, inserted):
        out = [(0, "")] if i == len(rows) and state in ("", "a") else []
        if inserted < 3:
            for r in "ua":
                if r in NEXT[state]:
                    out.append((2, "I", i, r, inserted + 1))
        if i < len(rows):
            first, must, cut = rows[i]
            out.append((3, "D", i + 1, state, 0))
            if not must:
                if first in NEXT[state]:
                    out.append((cut, "K", i + 1, first, 0))
                out += [(2 + cut, "R", i + 1, r, 0) for r in "ua" if r in NEXT[state]]
        done = []
        for o in out:
            if len(o) == 2:
                done.append(o)
            else:
                c, e = best(*o[2:])
                done.append((o[0] + c, o[1] + e))
        return min(done, default=(10 ** 9, ""))
    return best(0, "", 0)


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        show = lambda x: " " if x is None else str(x)
        k = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        role, text = show(role), show(text)
        if k:
            text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
            out += [(conv, turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    return out


def plain_report(rows, original):
    out = {}
    for conv in {r[0] for r in original}:
        mine = sorted((r[1:] for r in rows if r[0] == conv), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, codes, faults = set(), [], [0, 0, 0]
        for _, role, text in mine:
            body = text.strip(" \t\n\x0b\x0c\r")
            blank, again, cut = not body, (role, text) in seen, body[-1:] not in ".!?"
            seen.add((role, text))
            fault = 0 if blank else 1 if again else 2 if cut else None
            if fault is not None:
                faults[fault] += 1
            codes.append((role[:1], fault in (0, 1), int(fault == 2)))
        first = [c[0] for c in codes]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:]))
        turns = {r[0] for r in mine if r[0] is not None}
        cost, edits = plain_edits(tuple(codes)) if mine else (0, "")
        state, lines, at = "", [], 0
        for e in edits:
            if e == "I":
                state = "a" if state == "u" else "u"
                lines.append(("user:" if state == "u" else "assistant:"))
                continue
            _, role, text = mine[at]
            at += 1
            if e == "K":
                state = role[0]
                lines.append(f"{role}:{text}")
            elif e == "R":
                state = "a" if state == "u" else "u"
                lines.append(f"{'user' if state == 'u' else 'assistant'}:{text}")
        assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in lines))
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *faults, illegal, cost, edits,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def talk(rng, conv, n):
    rows = []
    for t in range(n):
        role = rng.choice(["user", "assistant"] * 4 + ["system", "tool", "", None]) if rng.random() < 0.4 else ["user", "assistant"][t % 2]
        text = rng.choice(["Yes.", "No!", "and so", "What?", "  ", None, "Fine. \n", "é", "ok.\u00a0", f"{t}.", f"{t}!"])
        rows.append((conv, rng.choice([t, t, t, t + 1, None]) if rng.random() < 0.3 else t, role, text))
    return rows


def run(spark, rows, build):
    df = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], SCHEMA).repartition(3)
    got = build(df).collect()
    out = {r.conv_id: tuple(r)[1:] for r in got}
    assert len(out) == len(got)
    return out


def test_damage_and_repair_equal_a_plain_search(spark):
    rng = random.Random(2)
    rows = [r for conv in range(150) for r in talk(rng, conv, rng.randint(1, 12))]
    rows += talk(rng, None, 9) + talk(rng, -5, 200) + talk(rng, 900, 75) + [(901, None, None, None)] * 3 + [(902, k, "user", "a.") for k in range(5)]
    rows += [(903, 7, "user", "x" * 200_000), (903, 8, "assistant", "y" * 100_000 + ".")] + rows[:4]
    assert run(spark, rows, cr.damage_report) == plain_report(damaged(rows), rows)
    dropped = [c for c in range(2000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0][:3]
    got = run(spark, [(c, 0, "user", "Hi.") for c in dropped], cr.damage_report)
    assert got == {c: (0,) * 6 + ("", hashlib.sha256(b"").hexdigest()) for c in dropped}
    assert run(spark, [], cr.damage_report) == {}


def test_several_levels_of_pieces(spark, monkeypatch):
    monkeypatch.setattr(cr, "FAN_BITS", 1)
    rng = random.Random(9)
    rows = talk(rng, 1, 600) + talk(rng, 2, 40) + talk(rng, 3, 2)
    show = lambda x: " " if x is None else x
    given = [(c, t, show(role), show(text)) for c, t, role, text in rows]
    assert run(spark, rows, cr.report) == plain_report(given, rows)


def test_repaired_rows(spark):
    rows = [(1, 0, "assistant", "Hello."), (1, 1, "user", "a."), (1, 2, "user", "b."), (2, 5, "user", "c.")]
    df = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], SCHEMA)
    got = [tuple(r) for r in cr.repair(df).orderBy("conv_id", "place").collect()]
    edits = {c: "".join(r[2] for r in got if r[0] == c) for c in (1, 2)}
    assert all(re.fullmatch("(s?(ua)+)?", "".join(r[4][0] for r in got if r[0] == c)) for c in (1, 2))
    assert edits == {c: v[6].replace("D", "") for c, v in run(spark, rows, cr.report).items()}


@pytest.mark.parametrize("seed", range(4))
def test_search_equals_all_edits(seed):
    rng = random.Random(seed)
    for _ in range(150):
        codes = bytes(rng.randrange(4) | rng.choice([0, 0, 0, cr.BLANK, cr.TRUNCATED, cr.DUPLICATE]) for _ in range(rng.randint(0, 14)))
        edits, cost, end = cr.cheapest(codes, 0, cr.TO_END)
        tail = {1: "II", 2: "I"}.get(end, "")
        want = plain_edits(tuple(("suax"[c & 3], bool(c & (cr.BLANK | cr.DUPLICATE)), int(bool(c & cr.TRUNCATED))) for c in codes))
        assert (cost + cr.TO_END[end], edits + tail) == want
