"""Conversation repair against a brute-force search over all edits."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from marketlane.llm import dialogue, queries

SPACE = " \t\n\x0b\x0c\r"


def plain(rows):
    """Counts, cost, audit and digest of one conversation of (turn, role, text), by trying all ways over the pattern."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, faults = set(), []
    for _, role, text in rows:
        body = text.strip(SPACE)
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else None if body[-1] in ".!?" else "truncated")
        seen.add((role, text))
    first = [r[1][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(first))
    turns = {r[0] for r in rows if r[0] is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    # ways[letters so far, state] = least (cost, audit, repaired): whole strings are kept and compared
    follow = {"": "su", "s": "u", "u": "a", "a": "u"}
    ways = {"": (0, "", ())}

    def with_inserts(ways):
        for _ in range(3):
            more = dict(ways)
            for state, (cost, audit, kept) in ways.items():
                for x in follow[state].replace("s", ""):
                    name = {"u": "user", "a": "assistant"}[x]
                    found = (cost + 3, audit + "I", (*kept, f"{name}:"))
                    more.setdefault(x, found)
                    more[x] = min(more[x], found)
            yield ways
            ways = more

    every = [[("", 0, "", ())]]
    for (_, role, text), fault in zip(rows, faults):
        found = {}
        for state, cost, audit, kept in every[-1]:
            for n in range(3):
                options = [(state, cost + 4, audit + "D", kept)]
                if fault not in ("blank", "duplicate"):
                    stays = 3 * (fault == "truncated")
                    if role[:1] and role[:1] in follow[state]:
                        options.append((role[:1], cost + stays, audit + "K", (*kept, f"{role}:{text}")))
                    options += [(x, cost + 3 + stays, audit + "R", (*kept, f"{'user' if x == 'u' else 'assistant'}:{text}")) for x in follow[state] if x != "s"]
                for option in options:
                    s, c, a, k = option
                    if s not in found or (c, a) < found[s][:2]:
                        found[s] = (c, a, k)
                x = follow[state].replace("s", "")
                state, cost, audit, kept = x, cost + 3, audit + "I", (*kept, f"{'user' if x == 'u' else 'assistant'}:")
        every.append([(s, *f) for s, f in found.items()])
    ends = []
    for state, cost, audit, kept in every[-1]:
        for n in range(3):
            if state in ("", "a"):
                ends.append((cost, audit, kept))
            x = follow[state].replace("s", "")
            state, cost, audit, kept = x, cost + 3, audit + "I", (*kept, f"{'user' if x == 'u' else 'assistant'}:")
    cost, audit, kept = min(ends)
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(kept).encode()).hexdigest())


def exhaustive(rows):
    """Least cost and audit over all strings of edits up to a length, each checked against the pattern itself."""
    best = None
    n = len(rows)
    for letters in itertools.chain.from_iterable(itertools.product("DIKR", repeat=k) for k in range(n, n + 3)):
        if sum(x != "I" for x in letters) != n:
            continue
        for choice in itertools.product("ua", repeat=sum(x in "IR" for x in letters)):
            at, picked, out, cost = iter(rows), iter(choice), "", 0
            for x in letters:
                if x == "I":
                    out, cost = out + next(picked), cost + 3
                    continue
                letter, fault = next(at)
                if x == "D":
                    cost += 4
                    continue
                if fault in ("blank", "duplicate"):
                    break
                out += letter if x == "K" else next(picked)
                cost += 3 * (x == "R") + 3 * (fault == "truncated")
            else:
                if re.fullmatch(r"(s?(ua)+)?", out) and (best is None or (cost, "".join(letters)) < best):
                    best = (cost, "".join(letters))
    return best


@pytest.mark.parametrize("n", range(5))
def test_edits_are_cheapest_and_first(n):
    rng = random.Random(n)
    for _ in range(25):
        rows = [(rng.choice("suax"), rng.choice([None, None, "blank", "duplicate", "truncated"])) for _ in range(n)]
        held = dialogue._Open()
        for k, (letter, fault) in enumerate(rows):
            held.take((k, letter, str(k), letter, fault, False))
        out = list(held.repaired())
        assert (sum(e[-1] for e in out), "".join(e[0] for e in out)) == exhaustive(rows), rows


def audited(frame):
    return {r.conv_id: tuple(r)[1:] for r in dialogue.audit(frame).collect()}


def test_long_conversations_spill(monkeypatch):
    """Held in memory or written in parts, the edits are the same."""
    rng = random.Random(3)
    rows = [(k, "x", f"{k}.", rng.choice("suaaux"), rng.choice([None, None, None, "blank", "truncated"]), False) for k in range(5000)]

    def edits():
        held = dialogue._Open()
        for r in rows:
            held.take(r)
        return list(held.repaired())

    whole = edits()
    for limit in (1, 7, 1000, 5000):
        monkeypatch.setattr(dialogue, "HELD_ROWS", limit)
        assert edits() == whole


def test_odd_rows(spark):
    convs = {
        1: [(0, "user", "Hi."), (0, "user", "Hi."), (None, "assistant", "Yes!"), (7, " ", "?")],
        None: [(None, "system", "Be good."), (2**62, "user", "so"), (2**62 + 1, "assistant", "x" * 100_000 + ".")],
        2**60 + 1: [(5, "", ""), (6, "User", "Ok."), (8, "assistant", " \t\n"), (9, "assistant", " ")],
        4: [(k, "user" if k % 2 == 0 else "assistant", f"Text {k}.") for k in range(300)],
    }
    rows = [(c, t, r, x, "a", "b") for c, held in convs.items() for t, r, x in held]
    random.Random(1).shuffle(rows)
    rows = [(c, t, None if r == " " else r, x, a, b) for c, t, r, x, a, b in rows]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, letter string, SEQ string")
    assert audited(dialogue.repair(frame)) == {c: plain(held) for c, held in convs.items()}
    assert dialogue.repair(frame.limit(0)).count() == 0 and dialogue.audit(dialogue.repair(frame.limit(0))).count() == 0
    gone = audited(dialogue.repair(frame, F.lit(False)))
    assert gone == {c: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for c in convs}


def test_query(spark, folder):
    convs = {}
    for r in spark.read.parquet(f"{folder}/conversations.parquet").collect():
        held = convs.setdefault(r.conv_id, [])
        damage = zlib.crc32(f"{r.conv_id}:{r.turn}".encode()) % 20
        text = "" if damage == 1 else re.sub("[.!?]", "", r.text) if damage == 2 else r.text
        held += [(r.turn, "user" if damage == 4 else r.role, text)] * ((damage != 0) + (damage == 3))
    out = queries.QUERIES["op12_dialogue_repair"](spark, folder)
    assert out.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert {r.conv_id: tuple(r)[1:] for r in out.collect()} == {c: plain(held) for c, held in convs.items()}


def test_one_exchange(spark, folder, capsys):
    queries.QUERIES["op12_dialogue_repair"](spark, folder).explain("formatted")
    assert len(re.findall(r"\(\d+\) Exchange", capsys.readouterr().out)) == 1
