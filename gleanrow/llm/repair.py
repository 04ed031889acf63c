"""Conversation structure repair as a composition of weighted finite-state machines.

Three machines are composed: an acceptor that reads a conversation's rows in order, a transducer
that edits them (Keep, Rerole, Delete, Insert, each with a cost and its initial as label), and an
acceptor of role initials, ``(s?(ua)+)?``. A state of the composition is (row, inserts since the last
row, grammar state); states are made only as the search reaches them. The search is a shortest path
in reverse topological order (rows from the last, inserts from the most) over weights (cost, label
string), compared in that order. Three inserts between rows would come back to a grammar state at
a cost, so two are enough, and the composition has no cycle.

Rests of paths are settled before the arcs that lead to them, and the arcs of one state have
different labels, so a tie in cost is decided by the first label alone: strings are read off the
settled arcs in the end, and no string is kept while searching. What a row adds to the costs depends
only on its kind (role initial, fault) and on the differences of the costs behind it; there are few
of either, so each such step is composed once and looked up after that.

One conversation is one stream of its sorted rows: its hash is one sequential digest. A task holds
some tens of bytes a row; texts of a long conversation wait in a temporary file of the task.

Edge cases: null roles and texts are one space; rows are ordered by turn, nulls first, ties by role,
then text; rows with a null conv_id are one conversation; an empty role has no initial, so such a row
is reroled or deleted; roles are kept as they are if their initial fits; repeated rows are duplicates
of the first; an empty table gives an empty result; columns of other names are ignored.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from array import array
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WHITE = " \t\n\x0b\x0c\r"
STOPS = ".!?"
#: Costs of the edits, by the label they leave, and of a truncated row that stays.
COSTS = {"K": 0, "R": 2, "D": 3, "I": 2}
TRUNCATED = 1
#: The grammar: (state, role initial) to state, the states it may end in, and the roles behind initials that edits write.
GRAMMAR = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
STATES, ACCEPTING = ("", "s", "u", "a"), ("", "a")
WRITTEN = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}
MOST_INSERTS = 2
#: Faults of a row.
SOUND, CUT, BLANK, DUPLICATE = range(4)
#: Bytes of texts of a conversation beyond which they wait in a file.
HELD = 32 << 20

REPORT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
TURNS = "conv_id long, place long, edit string, role string, text string"


def edit_arcs(kind: tuple[str, int] | None, inserts: int) -> Iterator[tuple[str, str, int, int]]:
    """Arcs of the edit transducer: label, role initial written ('' for none), cost, inserts after it.

    kind: (initial, fault) of the row that is read; None: the arcs that read nothing.
    """
    if kind is None:
        if inserts < MOST_INSERTS:
            for out in WRITTEN:
                yield "I", out, COSTS["I"], inserts + 1
        return
    initial, fault = kind
    yield "D", "", COSTS["D"], 0
    if fault < BLANK:
        more = TRUNCATED if fault == CUT else 0
        if initial:
            yield "K", initial, COSTS["K"] + more, 0
        for out in WRITTEN:
            yield "R", out, COSTS["R"] + more, 0


class Composition:
    """The lazily composed machine; steps over a row are kept by (kind of row, cost differences behind it)."""

    def __init__(self):
        self.steps: dict[tuple, int] = {}
        self.made: list[tuple[tuple[int, ...], int, dict[str, list[tuple[str, str]]]]] = []

    def step(self, kind: tuple[str, int] | None, behind: tuple[int, ...] | None) -> int:
        """Number of the step over a row of a kind (None: the end) with the costs behind it, by STATES.

        made[number]: costs before the row less their least, that least, and by state the arcs of its best way
        over the row, as (label, initial written).
        """
        number = self.steps.get((kind, behind))
        if number is None:
            number = self.steps[kind, behind] = len(self.made)
            self.made.append(self._compose(kind, behind))
        return number

    def _compose(self, kind, behind):
        after = dict(zip(STATES, behind, strict=True)) if behind is not None else {}
        best: dict[tuple[int, str], tuple[int, str]] = {}
        ways: dict[tuple[int, str], list[tuple[str, str]]] = {}
        for inserts in range(MOST_INSERTS, -1, -1):
            for state in STATES:
                found = []
                if kind is None and state in ACCEPTING:
                    found.append(((0, ""), []))
                for label, out, cost, _ in edit_arcs(kind, inserts) if kind is not None else ():
                    to = GRAMMAR.get((state, out)) if out else state
                    if to is not None:
                        found.append(((cost + after[to], label), [(label, out)]))
                for label, out, cost, more in edit_arcs(None, inserts):
                    to = GRAMMAR.get((state, out))
                    if to is not None and (more, to) in best:
                        found.append(((cost + best[more, to][0], label), [(label, out), *ways[more, to]]))
                if found:
                    best[inserts, state], ways[inserts, state] = min(found, key=lambda x: x[0])
        costs = [best[0, s][0] for s in STATES]
        least = min(costs)
        return tuple(c - least for c in costs), least, {s: ways[0, s] for s in STATES}

    def repair(self, kinds: list[tuple[str, int]]) -> tuple[int, Iterator[list[tuple[str, str]]]]:
        """Cost, and the arcs over each row in order (with the inserts before it), those at the end last."""
        number = self.step(None, None)
        steps, cost = array("i", [number]), 0
        for kind in reversed(kinds):
            cost += self.made[number][1]
            number = self.step(kind, self.made[number][0])
            steps.append(number)
        costs, least, _ = self.made[number]
        return cost + least + costs[STATES.index("")], self._read(steps)

    def _read(self, steps: array) -> Iterator[list[tuple[str, str]]]:
        state = ""
        for number in reversed(steps):
            arcs = self.made[number][2][state]
            for _, out in arcs:
                state = GRAMMAR[state, out] if out else state
            yield arcs


class _Texts:
    """(role, text) of a conversation's rows, in order; beyond HELD bytes in a temporary file."""

    def __init__(self, held: int = HELD):
        self.rows, self.size, self.held, self.file = [], 0, held, None

    def add(self, role: str, text: str) -> None:
        self.rows.append((role, text))
        self.size += len(role) + len(text) + 100
        if self.size > self.held:
            self.file = self.file or tempfile.TemporaryFile()
            for row in self.rows:
                pickle.dump(row, self.file)
            self.rows, self.size = [], 0

    def __iter__(self) -> Iterator[tuple[str, str]]:
        if self.file:
            self.file.seek(0)
            for _ in range(self.filed):
                yield pickle.load(self.file)
        yield from self.rows

    def end(self, n: int) -> None:
        self.filed = n - len(self.rows)


def _seen_before(digests: bytearray) -> np.ndarray:
    """Which of the 16-byte digests have stood before."""
    pairs = np.frombuffer(digests, "<u8").reshape(-1, 2)
    order = np.lexsort((pairs[:, 1], pairs[:, 0]))  # stable: the first of equals stays first
    ranked = pairs[order]
    again = np.zeros(len(pairs), bool)
    again[order[1:]] = (ranked[1:] == ranked[:-1]).all(axis=1)
    return again


class _Conversation:
    """One conversation read row by row, then repaired."""

    def __init__(self, held: int = HELD):
        self.texts, self.digests, self.faults, self.initials = _Texts(held), bytearray(), bytearray(), []
        self.n = self.illegal = self.turns = 0
        self.first = self.last = None

    def add(self, turn: int | None, role: str, text: str) -> None:
        shown = text.rstrip(WHITE)
        self.faults.append(BLANK if not shown else SOUND if shown[-1] in STOPS else CUT)
        self.digests += hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest()
        initial = role[:1]
        self.illegal += bool(self.n) and self.initials[-1] + initial not in LEGAL
        self.initials.append(initial)
        if turn is not None and turn != self.last:
            self.turns, self.last = self.turns + 1, turn
            self.first = turn if self.first is None else self.first
        self.texts.add(role, text)
        self.n += 1

    def solve(self, machine: Composition) -> None:
        self.texts.end(self.n)
        faults = np.frombuffer(self.faults, np.uint8).copy()
        faults[_seen_before(self.digests) & (faults != BLANK)] = DUPLICATE
        self.count = np.bincount(faults, minlength=4)
        self.cost, self.arcs = machine.repair(list(zip(self.initials, faults.tolist(), strict=True)))

    def rows(self) -> Iterator[tuple[str, str | None, str | None]]:
        """label, role, text of every edit; a deleted row has neither role nor text."""
        texts = iter(self.texts)
        for arcs in self.arcs:
            for label, out in arcs:
                role, text = ("", "") if label == "I" else next(texts)
                yield (label, None, None) if label == "D" else (label, role if label == "K" else WRITTEN[out], text)

    def report(self) -> tuple:
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        digest, labels, first = hashlib.sha256(), [], True
        for label, role, text in self.rows():
            labels.append(label)
            if label != "D":
                digest.update(f"{'' if first else chr(10)}{role}:{text}".encode())
                first = False
        blank, duplicate, cut = (int(self.count[k]) for k in (BLANK, DUPLICATE, CUT))
        return gaps, blank, duplicate, cut, self.illegal, self.cost, "".join(labels), digest.hexdigest()


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies: each row as it is after the contract's damage, and how often it stands there (0 to 2)."""
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    told = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    kind = F.crc32(told) % 20
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )


def whole(conversations: DataFrame) -> DataFrame:
    """The same columns of conversations as they are: every row stands once."""
    spaced: list[Column] = [F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")]
    return conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), *spaced,
        F.lit(1).alias("copies"))


def _solved(batches: Iterator[pa.RecordBatch], held: int) -> Iterator[tuple[int | None, _Conversation]]:
    machine = Composition()
    rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
    for conv_id, own in groupby(rows, key=lambda r: r[0]):
        c = _Conversation(held)
        for _, turn, role, text, copies in own:
            for _ in range(copies):
                c.add(turn, role, text)
        c.solve(machine)
        yield conv_id, c


def _batched(rows: Iterator[tuple], names: list[str], types: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    out, size = [], 0
    for row in rows:
        out.append(row)
        size += 100 + sum(len(x) for x in row if isinstance(x, str))
        if len(out) == 10_000 or size > HELD:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)
            out, size = [], 0
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)


def _mapped(rows: DataFrame, made, schema: str, held: int) -> DataFrame:
    names = [c.split()[0] for c in schema.split(", ")]
    types = [pa.int64() if c.endswith(" long") else pa.string() for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batched((row for conv_id, c in _solved(batches, held) for row in made(conv_id, c)), names, types)

    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(run, schema)


def report(rows: DataFrame, held: int = HELD) -> DataFrame:
    """REPORT of every conversation of damage() or whole(), those of which no row stands included."""
    return _mapped(rows, lambda conv_id, c: [(conv_id, *c.report())], REPORT, held)


def repair(rows: DataFrame, held: int = HELD) -> DataFrame:
    """TURNS: the rows of the repaired conversations, in place order; edit is K, R or I."""

    def made(conv_id, c):
        staying = (r for r in c.rows() if r[0] != "D")
        return ((conv_id, i, *r) for i, r in enumerate(staying))

    return _mapped(rows, made, TURNS, held)
