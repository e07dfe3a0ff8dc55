"""Conversation structure repair: the cheapest edits that make the roles ``(s?(ua)+)?``.

Secondary-sorted streaming: rows are dealt out by conversation and sorted by
turn, and ``mapInPandas`` walks them with a dynamic program over the state of
the pattern (nothing yet, after s, after u, after a). The program's state is
carried from one Arrow batch to the next. Each row leaves one number that
says how every state was reached; these and the rows of an open conversation
are written to the task's temporary file beyond ``HELD_ROWS`` rows, so memory
does not grow with a conversation. Its end is traced back through them and the
edited rows are read back in order.

Edits: K keeps a row (cost 0; its role must begin with the pattern's letter),
R gives it the role user or assistant (3), D deletes it (4; a must for blank
and duplicate rows), I puts in a user or assistant row of empty text (3); a
truncated row that stays costs 3 more. Of the cheapest edits those whose
letters sort first in ASCII are taken. A row's first fault counts: blank (no
character but white space), duplicate (role and text of an earlier row of its
conversation), truncated (its last such character is not ``.``, ``!`` or ``?``).

Rows are taken by turn, nulls first, rows of one turn by role and text. Null
roles and texts count as one space; rows of null id are one conversation. An
empty table gives no rows. Texts are read whole. Only the four named columns
are read, so other columns never clash.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rows of one conversation that a task holds in memory.
HELD_ROWS = 100_000
# Rows in a frame of results.
OUT_ROWS = 10_000
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
ROLES = ("user", "assistant")
EDGE = r"[^\x20\x09-\x0D]"

# States: nothing yet, after s, after u, after a. NEXT[state][letter] is where a role leads.
NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
_INSERTED = ("u", "u", "a", "u")
_NONE = 1 << 40
_EDITS = "DKR"
START = ((0, _NONE, _NONE, _NONE), (0, 0, 0, 0))


def _inserts(state: int, most: int = 2) -> Iterator[tuple[int, int]]:
    """How many rows are put in and the state after them."""
    for n in range(most + 1):
        yield n, state
        state = NEXT[state][_INSERTED[state]]


@lru_cache(maxsize=None)
def _moves(letter: str, must_go: bool, truncated: bool) -> tuple:
    """All ways over one row: (state before, state after, cost, edits, code of edits)."""
    out = []
    stays = TRUNCATED * truncated
    for state in range(4):
        for n, at in _inserts(state):
            edits = [("D", at, DELETE)]
            if not must_go:
                if letter in NEXT[at]:
                    edits.append(("K", NEXT[at][letter], stays))
                edits += [("R", NEXT[at][x], REROLE + stays) for x in "ua" if x in NEXT[at]]
            for edit, after, cost in edits:
                out.append((state, after, cost + INSERT * n, "I" * n + edit, state << 4 | n << 2 | _EDITS.index(edit)))
    return tuple(out)


@lru_cache(maxsize=1 << 16)
def _step(state: tuple, letter: str, must_go: bool, truncated: bool) -> tuple[tuple, int]:
    """The program's state after one row, and how each pattern state was reached, one byte each.

    A state is the least cost of each pattern state, less the smallest of all,
    and the order of their edits. The edits of two states never begin with one
    another, as both end at the same row's edit. A state that a later one beats
    whatever follows is let go; so there are only few different states.
    """
    costs, order = state
    best: list = [None] * 4
    for before, after, cost, edits, code in _moves(letter, must_go, truncated):
        if costs[before] < _NONE:
            found = (costs[before] + cost, order[before], edits, code)
            if best[after] is None or found < best[after]:
                best[after] = found
    # From "after a" all goes on as from "after s", and as from "nothing yet" but for one row s, which it deletes.
    last = best[3][0]
    if best[0] and best[0][0] > last + DELETE:
        best[0] = None
    if best[1] and best[1][0] > last:
        best[1] = None
    least = min(b[0] for b in best if b)
    ranks = {e: k for k, e in enumerate(sorted(b[1:3] for b in best if b))}
    after = (
        tuple(b[0] - least if b else _NONE for b in best),
        tuple(ranks[b[1:3]] if b else 0 for b in best),
    )
    return after, sum(b[3] << 8 * k for k, b in enumerate(best) if b)


def _end(state: tuple) -> tuple[int, int]:
    """The pattern state from which the cheapest edits end, and how many rows are put in after it."""
    costs, order = state
    ways = [(costs[s] + INSERT * n, order[s], n, s) for s in range(4) for n, at in _inserts(s) if at in (0, 3) and costs[s] < _NONE]
    _, _, n, s = min(ways)
    return s, n


class _Open:
    """The rows so far of the conversation that is being read: (turn, role, text, letter, fault, illegal)."""

    def __init__(self) -> None:
        self.state = START
        self.back: list[int] = []
        self.rows: list[tuple] = []
        self.spilled: list[tuple[int, int]] = []  # place of each part in the file, and its rows
        self.file = None

    def take(self, row: tuple) -> None:
        _, _, _, letter, fault, _ = row
        self.state, code = _step(self.state, letter, fault in ("blank", "duplicate"), fault == "truncated")
        self.back.append(code)
        self.rows.append(row)
        if len(self.rows) >= HELD_ROWS:
            self.file = self.file or tempfile.TemporaryFile()
            self.spilled.append((self.file.seek(0, 2), len(self.rows)))
            self.file.write(np.array(self.back, "<u4").tobytes())
            pickle.dump(self.rows, self.file, pickle.HIGHEST_PROTOCOL)
            self.back, self.rows = [], []

    def _codes(self) -> tuple[list[bytes], int]:
        """For each part its rows' codes (state before, rows put in before, edit), and the rows put in at the end."""
        state, last = _end(self.state)
        out = []
        for place, n in [(None, 0), *self.spilled[::-1]]:
            back = self.back
            if place is not None:
                self.file.seek(place)
                back = np.frombuffer(self.file.read(4 * n), "<u4").tolist()
            codes = bytearray(len(back))
            for i in range(len(back) - 1, -1, -1):
                codes[i] = code = back[i] >> 8 * state & 255
                state = code >> 4
            out.append(bytes(codes))
        return out[::-1], last

    def _parts(self) -> Iterator[list[tuple]]:
        for place, n in self.spilled:
            self.file.seek(place + 4 * n)
            yield pickle.load(self.file)
        yield self.rows

    def repaired(self) -> Iterator[tuple]:
        """The edits in order: (edit, turn, role, text, fault, illegal, cost)."""
        codes, last = self._codes()
        state = 0
        for rows, edits in zip(self._parts(), codes):
            for (turn, role, text, letter, fault, illegal), code in zip(rows, edits):
                for _ in range(code >> 2 & 3):
                    state, put_in = _put_in(state)
                    yield put_in
                edit, cost = _EDITS[code & 3], DELETE
                if edit != "D":
                    if edit == "R":
                        letter = "a" if "a" in NEXT[state] else "u"
                        role = ROLES[letter == "a"]
                    state = NEXT[state][letter]
                    cost = REROLE * (edit == "R") + TRUNCATED * (fault == "truncated")
                yield edit, turn, role, text, fault, illegal, cost
        for _ in range(last):
            state, put_in = _put_in(state)
            yield put_in
        if self.file:
            self.file.close()


_EMPTY = (None, None, None, None, None, False, 0)


def _put_in(state: int) -> tuple[int, tuple]:
    letter = _INSERTED[state]
    return NEXT[state][letter], ("I", None, ROLES[letter == "a"], "", None, False, INSERT)


def faults(rows: DataFrame, present: Column | None = None) -> DataFrame:
    """conv_id, present, turn, role, text, letter, fault and illegal, each conversation in one partition, in order.

    One exchange: the window that finds repeated rows and the final order both
    live on the partitions by conversation, and both sort and spill in Spark.
    """
    here = F.lit(True) if present is None else present
    text, role = (F.when(here, F.coalesce(c, F.lit(" "))) for c in ("text", "role"))
    dealt = rows.select("conv_id", here.alias("present"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text")).repartition("conv_id")
    order = ["present", F.col("turn").asc_nulls_first()]
    same = Window.partitionBy("conv_id", "role", "text").orderBy(*order)
    first = dealt.withColumn("again", F.row_number().over(same) > 1)
    line = Window.partitionBy("conv_id").orderBy(*order, "role", "text")
    letter = F.substring("role", 1, 1)
    before = F.lag("letter").over(line)
    return (
        first.withColumns({"letter": letter, "fault": fault(F.col("text"), F.col("again"))})
        .withColumn("illegal", F.coalesce(F.col("present") & ~F.concat(before, "letter").isin("su", "ua", "au"), F.lit(False)))
        .select("conv_id", "present", "turn", "role", "text", "letter", "fault", "illegal")
        .sortWithinPartitions("conv_id", *order, "role", "text")
    )


def fault(text: Column, again: Column) -> Column:
    """The first of blank, duplicate and truncated that holds; null where none does."""
    return (
        F.when(~text.rlike(EDGE), F.lit("blank"))
        .when(again, F.lit("duplicate"))
        .when(~text.rlike(r"[.!?][\x20\x09-\x0D]*\z"), F.lit("truncated"))
    )


_IN = ["name", "present", "place", "role", "text", "letter", "fault", "illegal"]
_OUT = ["name", "seq", "edit", "place", "role", "text", "fault", "illegal", "cost"]


def repair(rows: DataFrame, present: Column | None = None) -> DataFrame:
    """One row for each edit of each conversation, in order, each conversation in one partition.

    ``rows`` has conv_id, turn, role and text. Rows for which ``present`` is
    false only name their conversation; one that has no other rows gives a
    single row of null ``edit``. role and text are those after the edit (of a
    deleted row those it had); fault and illegal (the row's role does not
    follow that of the row before it) are those before; cost is the edit's.
    """
    kind = rows.schema["conv_id"].dataType

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, held, out = None, None, []

        def edits() -> Iterator[tuple]:
            none = not held.rows and not held.spilled
            for seq, edit in enumerate([_EMPTY] if none else held.repaired()):
                yield name, seq, *edit

        def full() -> Iterator[pd.DataFrame]:
            nonlocal out
            for edit in edits():
                out.append(edit)
                if len(out) >= OUT_ROWS:
                    yield pd.DataFrame(out, columns=_OUT)
                    out = []

        for batch in batches:
            for mine, here, *row in zip(*(batch[c].tolist() for c in _IN)):
                if held is None or mine != name:
                    if held is not None:
                        yield from full()
                    name, held = mine, _Open()
                if here:
                    held.take(tuple(row))
        if held is not None:
            yield from full()
            yield pd.DataFrame(out, columns=_OUT)

    # Ids and turns travel as text: pandas turns whole numbers with nulls into doubles.
    lined = faults(rows, present).withColumns({"name": F.col("conv_id").cast("string"), "place": F.col("turn").cast("string")})
    fields = "name string, seq long, edit string, place string, role string, text string, fault string, illegal boolean, cost long"
    return lined.select(*_IN).mapInPandas(run, fields).select(
        F.col("name").cast(kind).alias("conv_id"),
        "seq",
        "edit",
        F.col("place").cast("long").alias("turn"),
        *_OUT[4:],
    )


def audit(edits: DataFrame) -> DataFrame:
    """One row for each conversation of ``repair``'s result, read in its order, without a further exchange.

    gaps is the number of turns missing between the first and the last.
    """
    kind = edits.schema["conv_id"].dataType

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, out = None, []
        for batch in batches:
            for name, edit, place, role, text, fault, illegal, cost in zip(*(batch[c].tolist() for c in _READ)):
                if held is None or held.name != name:
                    if held is not None:
                        out.append(held.row())
                        if len(out) >= OUT_ROWS:
                            yield pd.DataFrame(out, columns=_ROW)
                            out = []
                    held = _Audit(name)
                if edit is not None:
                    held.take(edit, place, role, text, fault, illegal, cost)
        if held is not None:
            out.append(held.row())
        yield pd.DataFrame(out, columns=_ROW)

    read = edits.select(F.col("conv_id").cast("string").alias("name"), "edit", F.col("turn").cast("string").alias("place"), *_OUT[4:])
    counts = ", ".join(f"{c} long" for c in _COUNTS)
    out = read.mapInPandas(run, f"name string, {counts}, audit string, repaired_sha256 string")
    return out.select(F.col("name").cast(kind).alias("conv_id"), *_COUNTS, "audit", "repaired_sha256")


_READ = ["name", "edit", "place", "role", "text", "fault", "illegal", "cost"]
_COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
_ROW = ["name", *_COUNTS, "audit", "repaired_sha256"]
_MOST = (1 << 63) - 1


class _Audit:
    def __init__(self, name: str | None) -> None:
        self.name = name
        self.faults = dict.fromkeys(_COUNTS[1:4], 0)
        self.illegal = self.cost = self.kept = self.turns = 0
        self.first = self.last = None
        self.letters: list[str] = []
        self.digest = hashlib.sha256()

    def take(self, edit, place, role, text, fault, illegal, cost) -> None:
        self.letters.append(edit)
        self.cost += cost
        self.illegal += illegal
        if fault:
            self.faults[fault] += 1
        if place is not None and place != self.last:  # turns come in order
            self.first, self.last = self.first or place, place
            self.turns += 1
        if edit != "D":
            self.digest.update(("\n" * bool(self.kept) + f"{role}:{text}").encode())
            self.kept += 1

    def row(self) -> tuple:
        gaps = min(int(self.last) - int(self.first) + 1 - self.turns, _MOST) if self.turns else 0
        return self.name, gaps, *self.faults.values(), self.illegal, self.cost, "".join(self.letters), self.digest.hexdigest()
