"""Repair of conversations whose turns are lost, blank, repeated, cut off or given to the wrong speaker.

A repaired conversation has the role initials `(s?(ua)+)?`: four states, by what came last (nothing, a
system turn, a user's, an assistant's). Edits lead from one to the next: keep a row (0), give it the role that the
state asks for (3), delete it (4; blank and repeated rows must be), insert an empty turn (3); a cut-off row
that stays costs 3 more. Of the cheapest edits those are meant whose initials, in order, are least in ASCII.

The edits are found by Hirschberg's divide and conquer. For the middle of a conversation a forward vector has the
least cost of coming to each state there, a backward vector the least cost of going on from it to the end; the
crossing is a state where their sum is least, and both halves are solved in turn with it, so that what is held
besides the conversation is a vector at each level. Where several states are optimal, the one on
the audit-least path is: backward vectors carry, beside each cost, the place of a state's least initials
among the four states', which is all that comparing them takes, since initials up to a row end with that row's and are never
the beginning of one another. As few different vectors occur, steps from vector to vector are kept and looked up.

Texts are never gathered. What a conversation's edits depend on is a byte a row, which is what its list of edits
takes anyway: these bytes are read in order of turns by the task that has the conversation. Then the
edits are put before the rows, and the rows pass by them in the same order. So a task holds a batch of
rows, and one conversation's bytes; a conversation of a third of all rows is one task's stream.

Defined cases: null roles and texts are one space; null turns come first, and gaps leave them out; rows of one
turn go by role, then hash of the text; repeated rows are repeated turns; a role that begins with neither s, u nor
a can't stay; very long texts are read like others; null ids are one conversation; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ROWS_AT_ONCE, own_name, sliced
from .spelling import CRC_SQL, crc_sql

SPACE = " \t\n\x0b\x0c\r"
DELETE, INSERT, REROLE, CUT_OFF = 4, 3, 3, 3
START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = {SYSTEM: "system", USER: "user", ASSISTANT: "assistant"}
#: The state after a turn that is asked for, from each state, and those in which a conversation may end.
ASKED = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ENDS = (START, ASSISTANT)
NEVER = float("inf")
#: A row as a byte: what its role begins with (o: something else), a capital if it is cut off; x: it must be deleted.
MUST_GO = ord("x")
#: Conversations of so many rows or less are looked up by their bytes.
SHORT = 64

Vector = tuple[tuple[float, int], ...]


@lru_cache(maxsize=None)
def moves(state: int, row: int) -> tuple[tuple[int, str, int], ...]:
    """Cost, initials and next state of all ways over one row: up to two inserted turns, then the row's own edit."""
    out = []
    for inserted in range(3):
        at, initial, late = state, chr(row).lower(), CUT_OFF if chr(row).isupper() else 0
        for _ in range(inserted):
            at = ASKED[at]
        own = [(DELETE, "D", at)]
        if row != MUST_GO:
            own.append((REROLE + late, "R", ASKED[at]))
            if initial == "s" and at == START:
                own.append((late, "K", SYSTEM))
            elif initial in "ua" and ROLES[ASKED[at]][0] == initial:
                own.append((late, "K", ASKED[at]))
        out += [(cost + INSERT * inserted, "I" * inserted + letter, to) for cost, letter, to in own]
    return tuple(out)


def best_move(state: int, row: int, after: Vector) -> tuple[float, str, int, int]:
    """Of the ways over a row the cheapest to the end, of these the one of least initials: cost, initials, place of what follows, next state."""
    return min((cost + after[to][0], letters, after[to][1], to) for cost, letters, to in moves(state, row))


@lru_cache(maxsize=None)
def step_back(row: int, after: Vector) -> tuple[Vector, float, tuple[int, ...]]:
    """The vector before a row, as costs over the least of them, that least cost, and the state after the row by the state before it."""
    best = [best_move(state, row, after) for state in range(4)]
    least = min(b[0] for b in best)
    places = {p: i for i, p in enumerate(sorted({b[1:3] for b in best}))}
    return tuple((b[0] - least, places[b[1:3]]) for b in best), least, tuple(b[3] for b in best)


@lru_cache(maxsize=None)
def step_forward(row: int, before: tuple[float, ...]) -> tuple[tuple[float, ...], float]:
    """Costs of coming to each state after a row, over the least of them, and that least cost."""
    costs = [NEVER] * 4
    for state in range(4):
        for cost, _, to in moves(state, row):
            costs[to] = min(costs[to], before[state] + cost)
    least = min(costs)
    return tuple(c - least for c in costs), least


#: What is left to do at the end: nothing, or to insert what is asked for until the conversation may end.
CLOSING = {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
AT_END: Vector = tuple((float(INSERT * len(CLOSING[s])), len(CLOSING[s])) for s in range(4))


def backward(rows: bytes, low: int, high: int, end: Vector) -> Vector:
    """The vector before row `low`, less a constant."""
    for i in range(high - 1, low - 1, -1):
        end = step_back(rows[i], end)[0]
    return end


def forward(rows: bytes, low: int, high: int, state: int) -> tuple[float, ...]:
    costs = tuple(0.0 if s == state else NEVER for s in range(4))
    for i in range(low, high):
        costs = step_forward(rows[i], costs)[0]
    return costs


def least_crossing(rows: bytes, low: int, middle: int, state: int, after: Vector) -> int:
    """The state in the middle on the audit-least of the cheapest paths from a state: where each state's best path leads."""
    leads = (0, 1, 2, 3)
    for i in range(middle - 1, low - 1, -1):
        after, _, to = step_back(rows[i], after)
        leads = tuple(leads[t] for t in to)
    return leads[state]


def edits_of(rows: bytes, low: int, high: int, state: int, end: Vector) -> list[str]:
    """The initials by row of the rows from low to high (not included), from a state to an end."""
    if high - low == 1:
        return [best_move(state, rows[low], end)[1]]
    middle = (low + high) // 2
    after, before = backward(rows, middle, high, end), forward(rows, low, middle, state)
    sums = [b + a[0] for b, a in zip(before, after, strict=True)]
    crossing = [s for s in range(4) if sums[s] == min(sums)]
    met = crossing[0] if len(crossing) == 1 else least_crossing(rows, low, middle, state, after)
    here: Vector = tuple((0.0 if s == met else NEVER, 0) for s in range(4))
    return edits_of(rows, low, middle, state, here) + edits_of(rows, middle, high, met, end)


def solve(rows: bytes) -> tuple[int, str]:
    """Cost and initials of the edits of a conversation."""
    pieces, state, cost = edits_of(rows, 0, len(rows), START, AT_END) if rows else [], START, 0
    for row, letters in zip(rows, pieces, strict=True):
        price, _, state = next(m for m in moves(state, row) if m[1] == letters)
        cost += price
    return cost + INSERT * len(CLOSING[state]), "".join(pieces) + CLOSING[state]


solve_short = lru_cache(maxsize=50_000)(solve)


# --- rows in order of turns --------------------------------------------------------------------------


def with_faults(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, the text's hash, whether it is blank or cut off."""
    rows = conversations.select("conv_id", "turn", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")))
    trimmed = F.rtrim("text", F.lit(SPACE))
    return rows.select("*", F.sha2("text", 256).alias("key"), (trimmed == "").alias("blank"), (~F.right(trimmed, F.lit(1)).isin(".", "!", "?")).alias("cut_off"))


ORDER = [F.asc_nulls_first, F.asc, F.asc]


def in_order(rows: DataFrame, *first: str) -> DataFrame:
    """Each conversation in one partition, its rows in order."""
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", *first, F.asc_nulls_first("turn"), "role", "key")


def first_seen(rows: DataFrame) -> DataFrame:
    """rows (without texts) with the turn at which their role and text are first seen in their conversation, as a list of one."""
    seen = rows.groupBy("conv_id", "role", "key").agg(F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn")).alias("first"))
    seen = seen.select(F.col("conv_id").alias("_conv"), F.col("role").alias("_role"), F.col("key").alias("_key"), F.col("first.turn").alias("first_turn"))
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role")) & (F.col("key") == F.col("_key"))
    return rows.join(seen, same).drop("_conv", "_role", "_key")


def structure(conversations: DataFrame) -> DataFrame:
    """By conversation: gaps, blank, duplicate, truncated, illegal, cost, audit."""
    rows = with_faults(conversations).drop("text")
    kind = rows.schema["conv_id"].dataType.simpleString()
    lines = in_order(first_seen(rows)).select("conv_id", "turn", F.left("role", F.lit(1)).alias("initial"), "role", "key", "blank", "cut_off", "first_turn")
    return lines.mapInArrow(_structures, f"conv_id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string")


LEGAL = {"su", "ua", "au"}


def _structures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: list[tuple] = []
    now: _Reading | None = None
    kind = None
    for batch in batches:
        kind = batch.schema.field("conv_id").type
        for part in _parts(batch):
            for conv_id, *row in zip(*part, strict=True):
                if now is None or conv_id != now.conv_id:
                    if now is not None:
                        found.append(now.result())
                    now = _Reading(conv_id)
                now.take(*row)
            if len(found) >= ROWS_AT_ONCE:
                yield _structure_batch(found, kind)
                found = []
    if now is not None:
        yield _structure_batch([*found, now.result()], kind)


def _parts(batch: pa.RecordBatch) -> Iterable[list[list]]:
    return zip(*(sliced(column) for column in batch.columns), strict=True)


def _structure_batch(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    ids, *numbers, audits = zip(*rows, strict=True)
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    return pa.RecordBatch.from_arrays([pa.array(ids, kind), *(pa.array(n, pa.int64()) for n in numbers), pa.array(audits, pa.string())], names)


class _Reading:
    """A conversation as its rows come by."""

    def __init__(self, conv_id):
        self.conv_id, self.rows, self.last = conv_id, bytearray(), None
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first_turn = self.last_turn = None

    def take(self, turn, initial: str, role: str, key: str, blank: bool, cut_off: bool, first_turn) -> None:
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.last_turn = turn
            self.first_turn = turn if self.first_turn is None else self.first_turn
        if self.last is not None:
            self.illegal += self.last[0][:1] + initial not in LEGAL
        repeated = turn != first_turn or self.last == (role, key, turn)
        self.last = (role, key, turn)
        if blank or repeated:
            self.blank += blank
            self.duplicate += not blank
            self.rows.append(MUST_GO)
            return
        self.truncated += cut_off
        code = initial if initial and initial in "sua" else "o"
        self.rows.append(ord(code.upper() if cut_off else code))

    def result(self) -> tuple:
        gaps = 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.turns
        rows = bytes(self.rows)
        cost, audit = solve_short(rows) if len(rows) <= SHORT else solve(rows)
        return (self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit)


# --- repaired rows -----------------------------------------------------------------------------------

_NUMBERS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _after_audits(conversations: DataFrame) -> DataFrame:
    """The rows of each conversation in order, after a row with its numbers, and its audit for a text."""
    found = structure(conversations).select("conv_id", F.lit(0).alias("part"), F.lit(None).cast(conversations.schema["turn"].dataType).alias("turn"), F.lit("").alias("role"), F.col("audit").alias("text"), F.lit("").alias("key"), F.array(*_NUMBERS).alias("numbers"))
    rows = with_faults(conversations).select("conv_id", F.lit(1).alias("part"), "turn", "role", "text", "key", F.lit(None).cast("array<long>").alias("numbers"))
    return in_order(found.unionByName(rows), "part").select("conv_id", "part", "role", "text", "numbers")


class _Repair:
    """A conversation's edits, as its rows pass by them."""

    def __init__(self, conv_id, audit: str, numbers: list[int]):
        self.conv_id, self.audit, self.numbers, self.at, self.state = conv_id, audit, numbers, 0, START

    def _asked(self) -> str:
        self.state = ASKED[self.state]
        return ROLES[self.state]

    def inserted(self) -> Iterator[tuple[str, str, str]]:
        """edit, role and text of the turns that are inserted before the next row, or at the end."""
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            yield "I", self._asked(), ""

    def passed(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        """edit, role and text of what a row becomes, after what is inserted before it."""
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "R":
            yield edit, self._asked(), text
        elif edit == "K":
            self.state = SYSTEM if role[0] == "s" else ASKED[self.state]
            yield edit, role, text


def _turns(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[_Repair, Iterator[tuple[str, str, str]], bool]]:
    """For each row that passes by: the conversation, what the row becomes, and whether that is its end."""
    now: _Repair | None = None
    for batch in batches:
        for part in _parts(batch):
            for conv_id, kind, role, text, numbers in zip(*part, strict=True):
                if kind == 0:
                    if now is not None:
                        yield now, now.inserted(), True
                    now = _Repair(conv_id, text, numbers)
                else:
                    yield now, now.passed(role, text), False
    if now is not None:
        yield now, now.inserted(), True


def repaired(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 1), edit, role, text: the turns of each conversation after its repair."""
    kind = conversations.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, place, first = [], 0, next(batches, None)
        if first is None:
            return
        schema = pa.schema([("conv_id", first.schema.field("conv_id").type), ("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])
        size = 0
        for now, made, end in _turns(_chain(first, batches)):
            for edit, role, text in made:
                place += 1
                rows.append((now.conv_id, place, edit, role, text))
                size += len(text)
            place = 0 if end else place
            if len(rows) >= ROWS_AT_ONCE or size > 1 << 24:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return _after_audits(conversations).mapInArrow(run, f"conv_id {kind}, place long, edit string, role string, text string")


def _chain(first: pa.RecordBatch, rest: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield first
    yield from rest


def digests(conversations: DataFrame) -> DataFrame:
    """`structure` with repaired_sha256: of the repaired turns as role:text, a line each. Hashed as they pass by."""
    kind = conversations.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, hashed, empty, first = [], hashlib.sha256(), True, next(batches, None)
        if first is None:
            return
        types = [first.schema.field("conv_id").type, *[pa.int64()] * len(_NUMBERS), pa.string(), pa.string()]
        names = ["conv_id", *_NUMBERS, "audit", "repaired_sha256"]
        for now, made, end in _turns(_chain(first, batches)):
            for _, role, text in made:
                hashed.update(f"{'' if empty else chr(10)}{role}:{text}".encode())
                empty = False
            if end:
                found.append((now.conv_id, *now.numbers, now.audit, hashed.hexdigest()))
                hashed, empty = hashlib.sha256(), True
            if len(found) >= ROWS_AT_ONCE:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), types, strict=True)], names)
                found = []
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), types, strict=True)], names)

    numbers = ", ".join(f"{n} long" for n in _NUMBERS)
    return _after_audits(conversations).mapInArrow(run, f"conv_id {kind}, {numbers}, audit string, repaired_sha256 string")


# --- the query's damage ------------------------------------------------------------------------------


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows lost, emptied, without their marks, repeated or given to the user, by the checksum of id and turn."""
    name = own_name(conversations, "_h")
    or_space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    h = F.crc32(F.concat(or_space("conv_id"), F.lit(":"), or_space("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", or_space("role").alias("role"), or_space("text").alias("text"), h.alias(name)).filter(F.col(name) != 0)
    role = F.when(F.col(name) == 4, "user").otherwise(F.col("role"))
    text = F.when(F.col(name) == 1, "").when(F.col(name) == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times = F.explode(F.array_repeat(F.lit(0), F.when(F.col(name) == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("_copy")).drop("_copy")


def repair_digests(conversations: DataFrame) -> DataFrame:
    """Digests of damaged conversations, all of them: one that has lost all its rows has zeros, no edits, and the hash of no text."""
    found = digests(damaged(conversations))
    every = conversations.select(F.col("conv_id").alias("_every")).distinct()
    joined = every.join(found, F.col("_every").eqNullSafe(F.col("conv_id")), "left")
    none = hashlib.sha256(b"").hexdigest()
    return joined.select(
        F.col("_every").alias("conv_id"), *(F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in _NUMBERS),
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(none)).alias("repaired_sha256"),
    )


_SPACE_SQL = " || ".join(f"chr({ord(c)})" for c in SPACE)

SQL = f"""WITH RECURSIVE {CRC_SQL},
src AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {crc_sql("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS h FROM conversations, crc_table),
hurt AS (SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role, CASE h WHEN 1 THEN '' WHEN 2 THEN replace(replace(replace(text, '.', ''), '!', ''), '?', '') ELSE text END AS text, unnest(range(CASE h WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM src WHERE h <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i, rtrim(text, {_SPACE_SQL}) AS trimmed FROM hurt),
seen AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS nth, right(trimmed, 1) NOT IN ('.', '!', '?') AS cut_off FROM placed),
faults AS MATERIALIZED (SELECT conv_id, i, turn, role, text, left(role, 1) AS initial, CASE WHEN trimmed = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN cut_off THEN 'truncated' ELSE '' END AS fault,
           lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS two FROM seen),
counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
           count(*) FILTER (two NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n FROM faults GROUP BY conv_id),
inserts(a, b, letters, turns, price) AS (VALUES (0, 0, '', [], 0), (1, 1, '', [], 0), (2, 2, '', [], 0), (3, 3, '', [], 0), (0, 2, 'I', ['user:'], 3), (1, 2, 'I', ['user:'], 3), (2, 3, 'I', ['assistant:'], 3), (3, 2, 'I', ['user:'], 3),
           (0, 3, 'II', ['user:', 'assistant:'], 6), (1, 3, 'II', ['user:', 'assistant:'], 6), (2, 2, 'II', ['assistant:', 'user:'], 6), (3, 3, 'II', ['user:', 'assistant:'], 6)),
kept(b, initial, c) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (3, 'u', 2), (2, 'a', 3)),
rerole(b, role, c) AS (VALUES (0, 'user', 2), (1, 'user', 2), (3, 'user', 2), (2, 'assistant', 3)),
edits AS (SELECT f.conv_id, f.i, d.b, d.b AS c, 'D' AS letter, CAST([] AS VARCHAR[]) AS turn, 4 AS price FROM faults f, (VALUES (0), (1), (2), (3)) d(b)
          UNION ALL SELECT f.conv_id, f.i, b, c, 'K', [f.role || ':' || text], CASE fault WHEN 'truncated' THEN 3 ELSE 0 END FROM faults f JOIN kept k ON k.initial = f.initial WHERE fault NOT IN ('blank', 'duplicate')
          UNION ALL SELECT f.conv_id, f.i, b, c, 'R', [r.role || ':' || text], CASE fault WHEN 'truncated' THEN 6 ELSE 3 END FROM faults f, rerole r WHERE fault NOT IN ('blank', 'duplicate')),
ways AS MATERIALIZED (SELECT e.conv_id, e.i, n.a, e.c, n.letters || e.letter AS letters, list_concat(CAST(n.turns AS VARCHAR[]), e.turn) AS turns, n.price + e.price AS price FROM edits e JOIN inserts n ON n.b = e.b),
path AS (SELECT conv_id, CAST(0 AS BIGINT) AS i, 0 AS at, {{'cost': 0, 'audit': '', 'turns': CAST([] AS VARCHAR[])}} AS best FROM counts
         UNION ALL SELECT p.conv_id, w.i, w.c, min({{'cost': p.best.cost + w.price, 'audit': p.best.audit || w.letters, 'turns': list_concat(p.best.turns, w.turns)}})
         FROM path p JOIN ways w ON w.conv_id IS NOT DISTINCT FROM p.conv_id AND w.i = p.i + 1 AND w.a = p.at GROUP BY p.conv_id, w.i, w.c),
closed AS (SELECT p.conv_id, min({{'cost': p.best.cost + n.price, 'audit': p.best.audit || n.letters, 'turns': list_concat(p.best.turns, CAST(n.turns AS VARCHAR[]))}}) AS best
           FROM path p JOIN counts k ON k.conv_id IS NOT DISTINCT FROM p.conv_id AND k.n = p.i JOIN inserts n ON n.a = p.at AND n.b IN (0, 3) GROUP BY p.conv_id)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(c.best.cost, 0) AS BIGINT) AS cost, coalesce(c.best.audit, '') AS audit,
       sha256(coalesce(array_to_string(c.best.turns, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) e LEFT JOIN counts k ON k.conv_id IS NOT DISTINCT FROM e.conv_id LEFT JOIN closed c ON c.conv_id IS NOT DISTINCT FROM e.conv_id"""
