"""Repair of conversations whose turns break the role grammar, by generalised LR parsing with edits.

Grammar of the initials of roles, in `GRAMMAR`: nothing, or turns, or a system row and turns; turns are
pairs of a user's and an assistant's row. Its LR(0) automaton with follow sets is built from the rules.
A parse reads the rows of a conversation in order. Each row is kept, given another role, or deleted, and
rows without a text may be inserted before it; each edit has a cost. Stacks of all these readings form a
graph that shares what lies below. After each row, stacks with equal tops are merged: the one with the
least (cost, audit) stays, where the audit is the string of edits so far. That loses nothing, as equal
tops of this grammar accept the same rows to come, and as of two audits of one cost neither is the
beginning of the other: every row ends in one letter that is no insertion, and the letters of a row have
fixed costs. So the order of two audits is settled where they part, and a stack need only know its rank.

Of each live top the parse holds a stack, a cost, a rank and a running digest of the text that its
reading gives, and two bytes for each row to trace the audit back. Texts are dropped as they are read. The
digest of a repaired conversation is sequential, so one task reads all rows of a conversation, as a
stream that Spark has sorted (and spills); what it keeps are some bytes a row. Copies of a row within a
conversation are found before that, by conversation, role and digest of the text, so a conversation with
a third of all rows is spread there.

Rows that must go: blank ones, and those whose role and text stood before. Kept truncated rows cost more.

Defined results: a NULL conversation, turn, role or text reads as one space in what is damaged and in
roles and texts, rows without a conversation are one conversation, and NULL turns come first; rows of one
turn go by role and text, in order of bytes; a role of other initials can be changed or deleted but not
kept; gaps beyond a long count as the largest long; a conversation none of whose rows is left has zeros, an empty audit and the digest of the empty
text; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from patronlake.llm.shared import prepare, required

# The grammar of role initials and the costs of edits.
GRAMMAR = (
    ("Talk", ()),
    ("Talk", ("Turns",)),
    ("Talk", ("System", "Turns")),
    ("System", ("s",)),
    ("Turns", ("Pair",)),
    ("Turns", ("Turns", "Pair")),
    ("Pair", ("u", "a")),
)
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
ROLES = {"u": "user", "a": "assistant"}
_LEGAL = {"su", "ua", "au"}
_END = "$"
LONG_MAX = (1 << 63) - 1

_FULL = re.compile(r"[^\x20\x09-\x0D]")
_STOPS = ".!?"

Stack = tuple[int, ...]


class Automaton:
    """LR automaton of a grammar whose first rule's left side is the start."""

    def __init__(self, rules=GRAMMAR):
        self.rules = [("Start", (rules[0][0],)), *rules]
        self.names = {left for left, _ in self.rules}
        self._follow = self._follow_sets()
        self.states: list[frozenset] = [self._closure({(0, 0)})]
        self.goto: dict[tuple[int, str], int] = {}
        for i, state in enumerate(self.states):  # grows as it is read
            for symbol in sorted({self.rules[r][1][at] for r, at in state if at < len(self.rules[r][1])}):
                moved = self._closure({(r, at + 1) for r, at in state if self.rules[r][1][at : at + 1] == (symbol,)})
                if moved not in self.states:
                    self.states.append(moved)
                self.goto[i, symbol] = self.states.index(moved)

    def _closure(self, items: set) -> frozenset:
        items, todo = set(items), list(items)
        while todo:
            rule, at = todo.pop()
            for name in self.rules[rule][1][at : at + 1]:
                fresh = {(r, 0) for r, (left, _) in enumerate(self.rules) if left == name} - items
                items |= fresh
                todo += fresh
        return frozenset(items)

    def _follow_sets(self) -> dict[str, set]:
        """Terminals that may stand after each name. No rule but the start's is empty in this use."""
        first = {name: set() for name in self.names}
        follow = {name: set() for name in self.names}
        follow["Start"] = {_END}
        changed = True
        while changed:
            before = sum(map(len, [*first.values(), *follow.values()]))
            for left, right in self.rules:
                if right:
                    first[left] |= first.get(right[0], {right[0]})
                for symbol, after in zip(right, [*right[1:], None]):
                    if symbol in self.names:
                        follow[symbol] |= follow[left] if after is None else first.get(after, {after})
            changed = before != sum(map(len, [*first.values(), *follow.values()]))
        return follow

    def _reduced(self, stack: Stack, ahead: str) -> list[Stack]:
        """The stack and all it reduces to with this terminal ahead."""
        found, todo = [], [stack]
        while todo:
            stack = todo.pop()
            found.append(stack)
            for rule, at in self.states[stack[-1]]:
                left, right = self.rules[rule]
                if rule and at == len(right) and ahead in self._follow[left]:
                    below = stack[: len(stack) - len(right)]
                    todo.append((*below, self.goto[below[-1], left]))
        return found

    @lru_cache(maxsize=None)  # noqa: B019  stacks of this grammar are few and short
    def shift(self, stack: Stack, terminal: str) -> Stack | None:
        for reduced in self._reduced(stack, terminal):
            to = self.goto.get((reduced[-1], terminal))
            if to is not None:
                return (*reduced, to)
        return None

    @lru_cache(maxsize=None)  # noqa: B019
    def accepts(self, stack: Stack) -> bool:
        return any((0, 1) in self.states[reduced[-1]] for reduced in self._reduced(stack, _END))


AUTOMATON = Automaton()


@dataclass(frozen=True)
class Reading:
    """One way to read a row from a stack: insertions, then an edit."""

    token: str
    cost: int
    inserted: str  # initials of inserted rows
    initial: str  # of the row as it stays, empty if deleted
    stack: Stack


@lru_cache(maxsize=None)
def _insertions(stack: Stack) -> tuple[tuple[str, Stack], ...]:
    """Up to two insertions: with more a pair would be whole, and the stack's top where it was."""
    found = [("", stack)]
    for inserted, at in found:
        if len(inserted) < 2:
            found += [(inserted + x, to) for x in ROLES if (to := AUTOMATON.shift(at, x))]
    return tuple(found)


@lru_cache(maxsize=None)
def readings(stack: Stack, initial: str, truncated: bool, must_go: bool) -> tuple[Reading, ...]:
    found = [Reading("D", DELETE, "", "", stack)]
    extra = TRUNCATED if truncated else 0
    for inserted, at in () if must_go else _insertions(stack):
        mark, cost = "I" * len(inserted), INSERT * len(inserted) + extra
        if initial and (to := AUTOMATON.shift(at, initial)):
            found.append(Reading(f"{mark}K", cost + KEEP, inserted, initial, to))
        found += [
            Reading(f"{mark}R", cost + REROLE, inserted, x, to) for x in ROLES if (to := AUTOMATON.shift(at, x))
        ]
    return tuple(found)


_TOKENS = [mark + x for mark in ("", "I", "II") for x in "DKR"]
_TOKEN_CODE = {token: i for i, token in enumerate(_TOKENS)}
_TOPS = len(AUTOMATON.states)


class Repair:
    """The parse of one conversation, row by row."""

    def __init__(self):
        start: Stack = (0,)
        # by top: cost, rank among the live audits, stack, digest of the text so far
        self.live = {0: (0, 0, start, hashlib.sha256())}
        self.trace: list[bytearray] = [bytearray() for _ in range(2 * _TOPS)]  # parents and tokens by top
        self.rows = 0

    def read(self, role: str, text: str, truncated: bool, must_go: bool) -> None:
        best: dict[int, tuple] = {}
        for top, (cost, rank, stack, digest) in self.live.items():
            for way in readings(stack, role[:1], truncated, must_go):
                to, value = way.stack[-1], (cost + way.cost, rank, way.token)
                if to not in best or value < best[to][0]:
                    best[to] = (value, top, way)
        order = {to: i for i, to in enumerate(sorted(best, key=lambda to: best[to][0][1:]))}
        live = {}
        for to, (value, top, way) in best.items():
            digest = self.live[top][3]
            if way.initial:
                kept = role if way.token[-1] == "K" else ROLES[way.initial]
                lines = [f"{ROLES[x]}:" for x in way.inserted] + [f"{kept}:{text}"]
                digest = _longer(digest, lines, self.live[top][2])
            live[to] = (value[0], order[to], way.stack, digest)
        for to in range(_TOPS):
            _, top, way = best.get(to, (None, 0, None))
            self.trace[2 * to].append(top)
            self.trace[2 * to + 1].append(_TOKEN_CODE[way.token] if way else 0)
        self.live, self.rows = live, self.rows + 1

    def result(self) -> tuple[int, str, str]:
        """Cost, audit and digest of the cheapest reading."""
        ends = []
        for top, (cost, rank, stack, digest) in self.live.items():
            for inserted, at in _insertions(stack):
                if AUTOMATON.accepts(at):
                    ends.append((cost + INSERT * len(inserted), rank, "I" * len(inserted), inserted, top))
        cost, _, mark, inserted, top = min(ends)
        _, _, stack, digest = self.live[top]
        if inserted:
            digest = _longer(digest, [f"{ROLES[x]}:" for x in inserted], stack)
        tokens = bytearray(self.rows)
        for i in range(self.rows - 1, -1, -1):
            tokens[i] = self.trace[2 * top + 1][i]
            top = self.trace[2 * top][i]
        return cost, "".join([_TOKENS[x] for x in tokens]) + mark, digest.hexdigest()


def _longer(digest, lines: list[str], stack: Stack):
    """A copy of the running digest with more lines; a stack that is not the first has lines already."""
    digest = digest.copy()
    digest.update((("\n" if len(stack) > 1 else "") + "\n".join(lines)).encode("utf-8", "surrogatepass"))
    return digest


class Conversation:
    """Counts of faults, and the repair, of one conversation."""

    def __init__(self):
        self.turns, self.low, self.high, self.last_turn = 0, None, None, None
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.initial: str | None = None
        self.repair = Repair()

    def add(self, turn: int | None, role: str, text: str, repeated: bool) -> None:
        if turn is not None and turn != self.last_turn:
            self.turns, self.last_turn, self.high = self.turns + 1, turn, turn
            self.low = turn if self.low is None else self.low
        full = _FULL.search(text) is not None
        blank, duplicate = not full, full and repeated
        truncated = full and not repeated and text.rstrip(" \t\n\x0b\x0c\r")[-1] not in _STOPS
        self.blank += blank
        self.duplicate += duplicate
        self.truncated += truncated
        if self.initial is not None and self.initial + role[:1] not in _LEGAL:
            self.illegal += 1
        self.initial = role[:1]
        self.repair.read(role, text, truncated, blank or duplicate)

    def row(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return min(gaps, LONG_MAX), self.blank, self.duplicate, self.truncated, self.illegal, *self.repair.result()


_RESULT = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "repaired_sha256 string"
)


def _repaired(batches):
    """Rows (conv_id, turn, role, text, repeated, present) sorted by conversation and place."""
    names = [x.split()[0] for x in _RESULT.split(", ")]
    kinds = [pa.int64()] * 7 + [pa.string()] * 2
    talk, key = None, None
    for batch in batches:
        done = []
        for conv, turn, role, text, repeated, present in zip(*(c.to_pylist() for c in batch.columns)):
            if talk is None or conv != key:
                if talk is not None:
                    done.append((key, *talk.row()))
                talk, key = Conversation(), conv
            if present:
                talk.add(turn, role, text, repeated)
        yield _batch(done, kinds, names)
    if talk is not None:
        yield _batch([(key, *talk.row())], kinds, names)


def _batch(rows, kinds, names) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds)], names=names)


def damage(rows: DataFrame, marks: int = 20) -> DataFrame:
    """Rows (conv_id, turn, role, text, present): the damage that the checksum of `conv_id:turn` picks.

    Dropped rows stay with `present` false, so that their conversation is known.
    """
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    mark = F.crc32(key.cast("binary")) % marks
    text = F.when(mark == 1, F.lit("")).when(mark == 2, F.translate("text", _STOPS, "")).otherwise(F.col("text"))
    return rows.select(
        "conv_id", "turn", F.when(mark == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), text.alias("text"),
        (mark != 0).alias("present"), F.explode(F.when(mark == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))),
    ).drop("col")


def conversations(rows: DataFrame, conv_column="conv_id", turn_column="turn", role_column="role", text_column="text") -> DataFrame:
    """(conv_id long, turn long, role, text) with roles and texts that are NULL read as one space."""
    narrow = required(rows, conv_column, turn_column, role_column, text_column)
    space = F.lit(" ")
    return narrow.select(
        F.col(f"`{conv_column}`").cast("long").alias("conv_id"), F.col(f"`{turn_column}`").cast("long").alias("turn"),
        F.coalesce(F.col(f"`{role_column}`").cast("string"), space).alias("role"),
        F.coalesce(F.col(f"`{text_column}`").cast("string"), space).alias("text"),
    )


def repair(rows: DataFrame) -> DataFrame:
    """Faults and repair of each conversation of rows (conv_id, turn, role, text, present)."""
    prepare(rows.sparkSession)
    same = W.partitionBy("conv_id", "role", F.sha2("text", 256), "present").orderBy(F.asc_nulls_first("turn"))
    flagged = rows.withColumn("repeated", F.row_number().over(same) > 1)
    place = ["conv_id", "turn", "role", "text", "repeated"]
    return (
        flagged.select(*place, "present").repartition("conv_id")
        .sortWithinPartitions(*[F.asc_nulls_first(c) for c in place]).mapInArrow(_repaired, _RESULT)
    )
