"""Conversation repair against a plain version."""

from __future__ import annotations

import hashlib
import random
import re
import sys
import zlib
from functools import cache

import pytest

from masterlint.llm import conversations

SCHEMA = "conv_id bigint, turn bigint, role string, text string, cost string, copy boolean, head int"
VISIBLE = re.compile(r"[^\x20\x09-\x0D]")
GRAMMAR = re.compile(r"(s?(ua)+)?")


sys.setrecursionlimit(20_000)


def shown(x):
    return " " if x is None else str(x)


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = shown(role), shown(text)
        h = zlib.crc32(f"{shown(conv)}:{shown(turn)}".encode()) % 20
        if h == 1:
            text = ""
        elif h == 2:
            text = re.sub("[.!?]", "", text)
        elif h == 4:
            role = "user"
        out += [(turn, role, text)] * (0 if h == 0 else 2 if h == 3 else 1)
    return out


def in_order(row):
    turn, role, text = row
    return (turn is not None, turn or 0, role.encode(), hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest())


def cheapest(rows, faults):
    """The least (cost, audit) over all edits, and the lines it leaves."""

    @cache
    def best(i, behind, inserts):
        # behind: '', 's', 'u' or 'a'
        options = []
        if i == len(rows) and behind in ("", "a"):
            options.append((0, "", ()))

        def go(cost, edit, role, text, j, n):
            allowed = {"": "su", "s": "u", "u": "a", "a": "u"}[behind]
            if role[:1] and role[:1] in allowed:
                c, a, lines = best(j, role[:1], n)
                options.append((cost + c, edit + a, ((role, text), *lines)))

        if inserts:
            for role in ("user", "assistant"):
                go(2, "I", role, "", i, inserts - 1)
        if i < len(rows):
            _, role, text = rows[i]
            c, a, lines = best(i + 1, behind, 3)
            options.append((3 + c, "D" + a, lines))
            if faults[i] not in ("blank", "duplicate"):
                cut = int(faults[i] == "truncated")
                go(cut, "K", role, text, i + 1, 3)
                for to in ("user", "assistant"):
                    go(2 + cut, "R", to, text, i + 1, 3)
        return min(options, default=(10**9, "~", ()), key=lambda x: x[:2])

    return best(0, "", 3)


def plain(rows):
    found = {}
    for conv in {r[0] for r in rows}:
        kept = sorted(damage([r for r in rows if r[0] == conv]), key=in_order)
        faults, seen = [], set()
        for _, role, text in kept:
            visible = VISIBLE.findall(text)
            faults.append("blank" if not visible else "duplicate" if (role, text) in seen else "truncated" if visible[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = [t for t, *_ in kept if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(kept, kept[1:], strict=False))
        cost, audit, lines = cheapest(tuple(kept), tuple(faults))
        assert GRAMMAR.fullmatch("".join(r[:1] for r, _ in lines))
        text = "\n".join(f"{r}:{t}" for r, t in lines)
        found[conv] = (gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return found


def found(df):
    rows = [tuple(r) for r in df.select("conv_id", *conversations.COUNTS, "cost", "audit", "repaired_sha256").collect()]
    assert len(rows) == len({r[0] for r in rows})
    return {r[0]: r[1:] for r in rows}


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", True, 1) for r in rows], SCHEMA)


@pytest.mark.parametrize("seed", [1, 2])
def test_random_conversations(spark, seed):
    source = random.Random(seed)
    rows = []
    for conv in range(400):
        for turn in range(source.randrange(1, 9)):
            role = source.choices(["system", "user", "assistant", None, "tool", "", "User"], [1, 5, 5, 0.3, 0.3, 0.3, 0.2])[0]
            text = source.choice(["One.", "Two!  \n", "Three", None, "", " \t\x0b", "Four? no", "Fünf ", "Six." + str(turn), "Éh?"])
            at = source.choice([turn, turn, turn, turn * 2, None])
            rows.append((conv if conv % 50 else None, at, role, text))
    rows += rows[:20]
    source.shuffle(rows)
    assert found(conversations.repaired(frame(spark, rows))) == plain(rows)


def test_given_conversations(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text")
    assert found(conversations.repaired(df)) == plain([tuple(r) for r in df.collect()])


def test_dropped_long_and_missing_conversations(spark):
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows = [(dropped, 0, "user", "Gone."), (None, None, None, None), (-1, 5, "user", "x" * 200_000 + ".")]
    long = [(2000, t, ["user", "assistant"][t % 2], f"Turn {t}.") for t in range(300)]
    got = found(conversations.repaired(frame(spark, rows + long)))
    assert got[dropped] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert {k: v for k, v in got.items() if k != 2000} == plain(rows)
    assert found(conversations.repaired(frame(spark, long))) == plain(long) == {2000: got[2000]}
    assert found(conversations.repaired(frame(spark, rows).where("false"))) == {}


def test_equal_ends_are_computed_once(spark, monkeypatch):
    path = conversations.Path()
    pushed = []
    monkeypatch.setattr(conversations.Path, "push", lambda self, *a, push=conversations.Path.push: (pushed.append(a), push(self, *a))[1])
    before = ""
    for signature in sorted(["u-a-u-a-", "s-u-a-u-a-", "utatu-a-"], key=lambda s: s[::-1]):
        ends = signature[::-1]
        shared = 0
        while before[shared : shared + 2] == ends[shared : shared + 2] != "":
            shared += 2
        path.back_to(shared // 2)
        for at in range(shared, len(ends), 2):
            path.push(ends[at + 1], ends[at])
        before = ends
        rows = tuple((None, {"s": "system", "u": "user", "a": "assistant"}[r], "x") for r in signature[::2])
        faults = tuple("truncated" if f == "t" else "" for f in signature[1::2])
        assert path.best() == cheapest(rows, faults)[:2]
    assert len(pushed) == 2 + 2 + 3
