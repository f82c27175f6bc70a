"""Conversation structure repair with Four-Russians block tables.

Roles of a repaired conversation follow (s?(ua)+)?: nothing, or user and assistant in turn, behind at most one system turn.
What remains to be paid from each place on, by state, is a cost vector. Less its least entry there are a few dozen of them,
so that tables say for every vector and every block of symbols which vector comes before the block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 4
NOTHING, SYSTEM, USER, ANSWER = range(4)
KEEP, REROLE, DELETE, INSERT = 0, 2, 3, 2
#: States after a kept turn, by its role's initial; after an inserted or reroled one, whose role follows from the state.
KEPT = {"s": {NOTHING: SYSTEM}, "u": {NOTHING: USER, SYSTEM: USER, ANSWER: USER}, "a": {USER: ANSWER}}
GIVEN = {NOTHING: USER, SYSTEM: USER, USER: ANSWER, ANSWER: USER}
ROLE = {USER: "user", ANSWER: "assistant"}
#: Symbols: a turn that must go, or a role's initial (o: any other) with or without a truncated text.
SYMBOLS = [("", 0), *((r, t) for t in (0, 1) for r in "suao")]
END = (0, 4, 2, 0)
WORD = r"[^\x20\x09-\x0D]"


def symbol(fault: str, role: str) -> int:
    return 0 if fault in ("blank", "duplicate") else 1 + "suao".index(role[:1] if role[:1] in ("s", "u", "a") else "o") + 4 * (fault == "truncated")


def moves(s: int, state: int) -> list[tuple[str, int, int]]:
    """(edit, cost, state after it) for a turn of symbol s, edits in ASCII order; insertions aside."""
    role, truncated = SYMBOLS[s]
    out = [("D", DELETE, state)]
    if role:
        out += [("K", KEEP + truncated, KEPT[role][state])] if state in KEPT.get(role, ()) else []
        out += [("R", REROLE + truncated, GIVEN[state])]
    return out


def before(after: tuple[int, ...], s: int) -> tuple[int, ...]:
    """The cost vector in front of a turn of symbol s, insertions in front of it included."""
    h = [min(cost + after[q] for _, cost, q in moves(s, state)) for state in range(4)]
    u, a = min(h[USER], INSERT + h[ANSWER]), min(h[ANSWER], INSERT + h[USER])
    return min(h[NOTHING], INSERT + u), min(h[SYSTEM], INSERT + u), u, a


@lru_cache(maxsize=1)
def tables() -> tuple[list[tuple[int, ...]], np.ndarray, np.ndarray]:
    """(vectors, step, block): the cost vectors less their least entry; step[v, s], the one in front of symbol s when v is behind it; block[v, code], that for BLOCK symbols, code with the last of them as its highest digit."""
    vectors, place, rows = [END], {END: 0}, []
    for v in vectors:
        row = []
        for s in range(len(SYMBOLS)):
            x = before(v, s)
            x = tuple(k - min(x) for k in x)
            if x not in place:
                place[x] = len(vectors)
                vectors.append(x)
            row.append(place[x])
        rows.append(row)
    step = np.array(rows, np.int16)
    block = step
    for _ in range(BLOCK - 1):
        block = step[block].reshape(len(vectors), -1)
    return vectors, step, block


def damaged(turns: DataFrame) -> DataFrame:
    """turns(conv_id, turn, role, text) damaged by crc32("conv_id:turn") % 20, with present (false for the turns that are dropped).

    0 drops the turn, 1 empties its text, 2 takes .!? out of it, 3 repeats it, 4 makes it the user's. A null role or text is
    one space, and so is a null id or turn in what is hashed.
    """
    text = lambda c: F.coalesce(turns[c].cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20
    said = F.when(kind == 1, "").when(kind == 2, F.translate(text("text"), ".!?", "")).otherwise(text("text"))
    d = turns.select(turns["conv_id"].alias("conv_id"), turns["turn"].cast("long").alias("turn"), F.when(kind == 4, "user").otherwise(text("role")).alias("role"), said.alias("text"), (kind != 0).alias("present"), F.when(kind == 3, 2).otherwise(1).alias("times"))
    return d.withColumn("times", F.explode(F.sequence(F.lit(1), F.col("times")))).drop("times")


def faults(turns: DataFrame) -> DataFrame:
    """turns(conv_id, turn, role, text, present) with fault, its first: blank, duplicate (role and text of an earlier turn), truncated (the last character that isn't white space is none of .!?) or empty.

    One shuffle brings the rows of a conversation together; they are sorted there, on disk where they are many.
    """
    d = turns.repartition("conv_id")
    same = Window.partitionBy("conv_id", "present", "role", "text").orderBy("turn")
    d = d.withColumn("nth", F.row_number().over(same))
    fault = F.when(~F.col("text").rlike(WORD), "blank").when(F.col("nth") > 1, "duplicate").when(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), "truncated").otherwise("")
    return d.withColumn("fault", F.when(F.col("present"), fault).otherwise(""))


def _behind(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of conversations from the last to the first, with block, numbered from the end, and behind, the number of the vector behind the block."""
    _, _, block = tables()
    conv, n, v, code = object(), 0, 0, 0
    for b in batches:
        number, behind = [], []
        for c, there, role, fault in zip(*(b.column(k).to_pylist() for k in ("conv_id", "present", "role", "fault"))):
            if c != conv:
                conv, n, v, code = c, 0, 0, 0
            number.append(n // BLOCK)
            behind.append(v)
            if there:
                code = code * len(SYMBOLS) + symbol(fault, role)
                n += 1
                if n % BLOCK == 0:
                    v, code = int(block[v, code]), 0
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(number, pa.int64()), pa.array(behind, pa.int16())], [*b.schema.names, "block", "behind"])


@lru_cache(maxsize=None)
def chosen(behind: int, s: int, state: int) -> tuple[tuple[str, int, int], ...]:
    """The edits (letter, cost, state after it) up to and with that of a turn of symbol s, in `state`, with vector `behind` behind it: at each step the ASCII-least that leads to the least cost."""
    then = tables()[0][behind]
    here, out = before(then, s), []
    while not out or out[-1][0] == "I":
        options = [(e, cost, to, cost + then[to]) for e, cost, to in moves(s, state)] + [("I", INSERT, GIVEN[state], INSERT + here[GIVEN[state]])]
        out.append(next(x[:3] for x in sorted(options) if x[3] == here[state]))
        state = out[-1][2]
    return tuple(out)


class _Trace:
    """The edits of conversations in turn; texts, turns and faults are taken from the rows by place when a batch is full."""

    def __init__(self) -> None:
        self.conv, self.state, self.step, self.out = object(), NOTHING, 0, []

    def add(self, source: int | None, edit: str | None, role: str | None, cost: int) -> None:
        self.out.append((self.conv, self.step, edit, source, role, cost))
        self.step += edit is not None

    def begin(self, conv) -> None:
        """Ends the conversation so far with what has to be inserted, and begins another."""
        while self.state in (SYSTEM, USER):
            self.state = GIVEN[self.state]
            self.add(None, "I", ROLE[self.state], INSERT)
        self.conv, self.state, self.step = conv, NOTHING, 0

    def block(self, rows: list[tuple[int, int, str]], behind: int) -> None:
        """rows: (place, symbol, role) of one block. Its vectors are found from the end to the beginning, its edits the other way."""
        step, v = tables()[1], [behind]
        for _, s, _ in reversed(rows[1:]):
            v.append(int(step[v[-1], s]))
        for (at, s, role), b in zip(rows, reversed(v)):
            for edit, cost, self.state in chosen(b, s, self.state):
                given = ROLE[self.state] if edit in "IR" else role if edit == "K" else None
                self.add(None if edit == "I" else at, edit, given, cost)

    def batch(self, b: pa.RecordBatch) -> pa.RecordBatch:
        conv, step, edit, source, role, cost = zip(*self.out) if self.out else ((),) * 6
        self.out = []
        at, edit = pa.array(source, pa.int64()), pa.array(edit, pa.string())
        text = pc.if_else(pc.is_in(edit, pa.array(["K", "R", "I"])), pc.fill_null(b.column("text").take(at), ""), pa.scalar(None, pa.string()))
        columns = {"conv_id": pa.array(conv, b.schema.field("conv_id").type), "step": pa.array(step, pa.int64()), "edit": edit, "turn": b.column("turn").take(at), "was": b.column("role").take(at), "role": pa.array(role, pa.string()), "text": text, "fault": b.column("fault").take(at), "cost": pa.array(cost, pa.int32())}
        return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edits of conversations whose rows come from the first to the last, with block and behind. A block that ends a batch is held back, since it may go on in the next."""
    trace, held = _Trace(), None
    for b in batches:
        if not b.num_rows:
            continue
        held = b = b if held is None else pa.Table.from_batches([held, b]).combine_chunks().to_batches()[0]
        cells = list(zip(*(b.column(k).to_pylist() for k in ("conv_id", "block", "present", "fault", "role", "behind"))))
        stop = len(cells)
        while stop and cells[stop - 1][:2] == cells[-1][:2]:
            stop -= 1
        _traced(trace, cells[:stop])
        yield trace.batch(b)
        held = b.slice(stop)
    if held is not None:
        _traced(trace, list(zip(*(held.column(k).to_pylist() for k in ("conv_id", "block", "present", "fault", "role", "behind")))))
        trace.begin(None)
        yield trace.batch(held)


def _traced(trace: _Trace, cells: list[tuple]) -> None:
    for (conv, _), rows in groupby(enumerate(cells), lambda x: x[1][:2]):
        if conv != trace.conv:
            trace.begin(conv)
        rows = list(rows)
        for at, x in rows:
            if not x[2]:
                trace.add(at, None, None, 0)
        if kept := [(at, symbol(x[3], x[4]), x[4]) for at, x in rows if x[2]]:
            trace.block(kept, next(x[5] for _, x in rows if x[2]))


def repaired_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, step, edit, turn, was, role, text, fault, cost): the cheapest edits that give a conversation roles of (s?(ua)+)?, in order.

    turns(conv_id, turn, role, text, present). A turn is kept (K, cost 0), given the role user or assistant (R, 2) or
    deleted (D, 3: blank and duplicate turns must be); an empty turn of the user or assistant is inserted (I, 2) anywhere;
    truncated turns that stay cost 1 more. Of scripts with equal costs the ASCII-least is taken. step counts from 0; was,
    turn and fault are null for inserted turns, role and text for deleted ones. A row that isn't present is no turn: it has
    no edit, and tells that its conversation exists. present may be missing (all are).

    Turns go by turn (null first), then role, text. A null role or text counts as one space, rows without a conv_id are one
    conversation, repeated rows are duplicates, other columns are ignored; no rows: no rows. An empty role, or one with
    another initial, can't be kept. Rows of a conversation come out in one partition, in order. One shuffle by conversation;
    from then on rows stream through sorts that spill, once from the end (block by block through the tables, in constant
    memory) and once from the beginning, whatever the length of a conversation or of a text.
    """
    text = lambda c: F.coalesce(turns[c].cast("string"), F.lit(" ")).alias(c)
    there = F.coalesce(turns["present"], F.lit(True)) if "present" in turns.columns else F.lit(True)
    d = faults(turns.select(turns["conv_id"].alias("conv_id"), turns["turn"].cast("long").alias("turn"), text("role"), text("text"), there.alias("present")))
    order = ["turn", "role", "text", "nth", "present"]
    back = d.sortWithinPartitions("conv_id", *(F.col(c).desc_nulls_last() for c in order))
    kind = d.schema["conv_id"].dataType.simpleString()
    back = back.mapInArrow(_behind, f"conv_id {kind}, turn long, role string, text string, present boolean, nth int, fault string, block long, behind short")
    forth = back.sortWithinPartitions("conv_id", *(F.col(c).asc_nulls_first() for c in order))
    return forth.mapInArrow(_edits, f"conv_id {kind}, step long, edit string, turn long, was string, role string, text string, fault string, cost int")


COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, n, audit, first, last, distinct, was, digest = object(), {}, [], None, None, 0, None, None
    names, out = ["conv_id", *COUNTS, "audit", "repaired_sha256"], []

    def close() -> None:
        if n:
            gaps = 0 if first is None else last - first + 1 - distinct
            out.append((conv, gaps, *(n[c] for c in COUNTS[1:]), "".join(audit), digest.hexdigest()))

    schema = None
    for b in batches:
        schema = pa.schema([("conv_id", b.schema.field("conv_id").type), *((c, pa.int64()) for c in COUNTS), ("audit", pa.string()), ("repaired_sha256", pa.string())])
        for c, edit, turn, before_, role, text, fault, cost in zip(*(b.column(k).to_pylist() for k in ("conv_id", "edit", "turn", "was", "role", "text", "fault", "cost"))):
            if c != conv or not n:
                close()
                conv, n, audit, first, last, distinct, was, digest = c, dict.fromkeys(COUNTS, 0), [], None, None, 0, None, hashlib.sha256()
                started = False
            if edit is None:
                continue
            audit.append(edit)
            n["cost"] += cost
            if edit != "I":
                if fault:
                    n[fault] += 1
                n["illegal"] += was is not None and was + before_[:1] not in ("su", "ua", "au")
                was = before_[:1]
                if turn is not None and turn != last:
                    first, last, distinct = turn if first is None else first, turn, distinct + 1
            if edit != "D":
                digest.update(("\n" * started + f"{role}:{text}").encode())
                started = True
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out) if out else ((),) * len(names), schema.types)], schema=schema)
        out = []
    close()
    if schema is not None:
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out) if out else ((),) * len(names), schema.types)], schema=schema)


def conversation_summaries(edits: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of what repaired_turns gives, taken as it comes: rows of a conversation in one partition and in order.

    gaps: turn numbers between the first and the last that no turn has. illegal: neighbouring turns, before the repair,
    whose initials aren't su, ua or au. audit: the edits' initials. repaired_sha256: of the repaired turns as role:text,
    joined by newlines. Texts are hashed as they stream by; of a conversation only its audit is held.
    """
    kind = edits.schema["conv_id"].dataType.simpleString()
    return edits.mapInArrow(_summaries, f"conv_id {kind}, {', '.join(f'{c} long' for c in COUNTS)}, audit string, repaired_sha256 string")
