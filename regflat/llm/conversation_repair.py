"""Conversation structure repair by block tables over normalised cost vectors (Four Russians).

A conversation is put in order with the cheapest edits so that the initials of its roles read ``(s?(ua)+)?``.
Edits of a row: Keep 0, Rerole to user or assistant 3, Delete 4 (the only edit of a blank or repeated row); a row with an
empty text may be Inserted anywhere, as user or assistant, for 3; a truncated row that stays adds 3.

Method.  A row is one of nine symbols (initial s, u, a or another, whole or truncated; must go).  What the rest of a
conversation costs is a vector over the four states of the grammar; less its minimum, only a few dozen vectors exist.
For each vector and each block of ``BLOCK`` symbols a table holds the vector before the block, what the block adds, and
the state that each state ends in, so blocks are looked up from the end to the start.  To trace the edits, blocks are
expanded backward into the vectors between their rows, and from the start on the first initial in ASCII order that stays
cheapest is taken: the audit is the least of all cheapest ones.

Scale.  Rows are range-partitioned by conversation and turn, so a conversation may span partitions.  Conversations that
lie inside one and fit the buffer are finished there.  Others leave segments of at most ``SEGMENT`` rows or ``BYTES``
bytes, each with its transfer table (every end vector to the start vector, every start state to the end state).  These
tables, some hundred bytes for thousands of rows, are chained per conversation; then the segments are traced in parallel
and their pieces run through the digest in order, as a stream.

Defined results: a null role or text is one space (so such a text is blank), a null turn or id prints as one space in the
damage key; null turns come first, null ids are one conversation; rows of one turn go by role and text; repeated rows
are duplicates; an empty table gives no rows; a conversation without rows has zeros, an empty audit, the empty digest.
Other columns take no part, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import product
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import work_dir

RENAME, DELETE, INSERT, UNFINISHED = 3, 4, 3, 3
BLOCK = 4
SEGMENT = 4096
BYTES = 4 << 20

START, SYSTEM, USER, ASSISTANT = range(4)  # what was put out last
ACCEPTED = (START, ASSISTANT)
AFTER = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
NEXT = [USER, USER, ASSISTANT, USER]  # the state after a user or assistant row that is put in there
NAMES = {USER: "user", ASSISTANT: "assistant"}
INITIALS = "sua"
SYMBOLS = 9
GONE = 8  # the symbol of a row that must go
LEGAL = {"su", "ua", "au"}
_SPACE = "[\\x20\\x09-\\x0D]"


class Tables(NamedTuple):
    vector: np.ndarray  # (vectors, states): cost to the end, less the least
    terminal: int
    step: np.ndarray  # (vectors, symbols): the vector before the symbol
    add: np.ndarray  # (vectors, symbols)
    edits: list  # [vector after][symbol][state] -> (initials, states put in, state after)
    block: np.ndarray  # (vectors, blocks): the vector before the block
    block_add: np.ndarray
    block_state: np.ndarray  # (vectors, blocks, states): the state after the block


def _before(symbol: int, after: tuple) -> tuple:
    """Costs to the end before a row, from those after it."""
    best = [DELETE + c for c in after]
    if symbol != GONE:
        extra = UNFINISHED if symbol >= 4 else 0
        initial = INITIALS[symbol % 4] if symbol % 4 < 3 else ""
        for s in range(4):
            best[s] = min(best[s], RENAME + extra + after[NEXT[s]])
            kept = AFTER.get(initial, {}).get(s)
            if kept is not None:
                best[s] = min(best[s], extra + after[kept])
    return _with_inserts(best)


def _with_inserts(best: list) -> tuple:
    for _ in range(3):
        best = [min(c, INSERT + best[NEXT[s]]) for s, c in enumerate(best)]
    return tuple(best)


def _edits(symbol: int, state: int, before: tuple, after: tuple) -> tuple[str, tuple, int]:
    """Least cheapest initials up to and with the edit of the row, the states put in, the state after."""
    said, put = "", []
    extra = UNFINISHED if symbol >= 4 else 0
    initial = INITIALS[symbol % 4] if symbol % 4 < 3 else ""
    while True:
        left = before[state]
        if left == DELETE + after[state]:
            return said + "D", tuple(put), state
        if left == INSERT + before[NEXT[state]]:
            state = NEXT[state]
            said += "I"
            put.append(state)
            continue
        kept = AFTER.get(initial, {}).get(state) if symbol != GONE else None
        if kept is not None and left == extra + after[kept]:
            return said + "K", tuple(put), kept
        return said + "R", tuple(put), NEXT[state]


@lru_cache(maxsize=1)
def tables() -> Tables:
    """All tables, from the costs and the grammar alone."""
    end = _with_inserts([0 if s in ACCEPTED else 10**6 for s in range(4)])
    terminal = tuple(c - min(end) for c in end)
    found, order = {terminal: 0}, [terminal]
    step, add, edits = [], [], []
    for v in order:  # grows while new vectors turn up
        row = [_before(x, v) for x in range(SYMBOLS)]
        for b in row:
            less = tuple(c - min(b) for c in b)
            if less not in found:
                found[less] = len(order)
                order.append(less)
        step.append([found[tuple(c - min(b) for c in b)] for b in row])
        add.append([min(b) for b in row])
        edits.append([[_edits(x, s, b, v) for s in range(4)] for x, b in enumerate(row)])
    step, add = np.array(step, np.int64), np.array(add, np.int64)
    goes = np.array([[[e[2] for e in row] for row in of] for of in edits], np.int64)
    blocks = np.array(list(product(range(SYMBOLS), repeat=BLOCK)), np.int64)
    at = np.repeat(np.arange(len(order))[:, None], len(blocks), 1)
    total = np.zeros_like(at)
    after = []
    for k in reversed(range(BLOCK)):
        after.append(at)
        total = total + add[at, blocks[:, k]]
        at = step[at, blocks[:, k]]
    state = np.repeat(np.repeat(np.arange(4)[None, None], len(order), 0), len(blocks), 1)
    for k in range(BLOCK):
        state = goes[after[BLOCK - 1 - k][:, :, None], blocks[None, :, k, None], state]
    return Tables(np.array(order, np.int64), 0, step, add, edits, at, total, state)


def _codes(symbols: bytes) -> tuple[np.ndarray, int]:
    """Block numbers, and how many symbols stand before the first whole block."""
    lead = len(symbols) % BLOCK
    cut = np.frombuffer(symbols, np.uint8)[lead:].reshape(-1, BLOCK).astype(np.int64)
    return cut @ (SYMBOLS ** np.arange(BLOCK - 1, -1, -1)), lead


def transfer(symbols: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every vector after the rows: the vector before them, what they add, and the state after by state before."""
    t = tables()
    codes, lead = _codes(symbols)
    at = np.arange(len(t.vector))
    total = np.zeros_like(at)
    after = []
    for b in codes[::-1].tolist():
        after.append(at)
        total = total + t.block_add[at, b]
        at = t.block[at, b]
    state = np.repeat(np.arange(4)[None], len(at), 0)
    singles = []
    for x in reversed(symbols[:lead]):
        singles.append(at)
        total = total + t.add[at, x]
        at = t.step[at, x]
    goes = _goes()
    for x, v in zip(symbols[:lead], reversed(singles)):
        state = goes[v[:, None], x, state]
    for b, v in zip(codes.tolist(), reversed(after)):
        state = t.block_state[v[:, None], b, state]
    return at, total, state


@lru_cache(maxsize=1)
def _goes() -> np.ndarray:
    return np.array([[[e[2] for e in row] for row in of] for of in tables().edits], np.int64)


def vectors_between(symbols: bytes, last: int) -> tuple[list[int], int]:
    """The vector after each row, and the cost of the rows for the least state: blocks by lookup, then expanded backward."""
    t = tables()
    codes, lead = _codes(symbols)
    at, cost, ends = last, 0, []
    for b in codes[::-1].tolist():
        ends.append(at)
        cost += int(t.block_add[at, b])
        at = int(t.block[at, b])
    out: list[int] = []
    for k, v in enumerate(ends):  # from the last block on
        hi = len(symbols) - k * BLOCK
        for x in reversed(symbols[hi - BLOCK:hi]):
            out.append(v)
            v = int(t.step[v, x])
    for x in reversed(symbols[:lead]):
        out.append(at)
        cost += int(t.add[at, x])
        at = int(t.step[at, x])
    out.reverse()
    return out + [at], cost  # the vector before all rows comes last


def trace(symbols: bytes, roles: list, texts: list, last: int, state: int, final: bool) -> tuple[str, list[str]]:
    """Initials and repaired lines of some rows, from the state before them and the vector after them."""
    edits = tables().edits
    after, _ = vectors_between(symbols, last)
    said, lines = [], []
    for x, v, role, text in zip(symbols, after, roles, texts):
        initials, put, nxt = edits[v][x][state]
        said.append(initials)
        lines += [f"{NAMES[s]}:" for s in put]
        if initials[-1] == "K":
            lines.append(f"{role}:{text}")
        elif initials[-1] == "R":
            lines.append(f"{NAMES[nxt]}:{text}")
        state = nxt
    while final and state not in ACCEPTED:
        state = NEXT[state]
        said.append("I")
        lines.append(f"{NAMES[state]}:")
    return "".join(said), lines


def damage(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows (conv, turn, role, text, gone) after the damage that a row's id and turn pick; dropped rows stay as marks."""
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.pmod(F.crc32(F.concat(shown(conv), F.lit(":"), shown(turn)).cast("binary")), F.lit(20))
    hit = rows.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), shown(role).alias("role"),
                      shown(text).alias("text"), kind.alias("kind"))
    gone = F.col("kind") == 0
    changed = F.when(gone | (F.col("kind") == 1), "").when(
        F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    out = hit.select("conv", F.when(~gone, F.col("turn")).alias("turn"),
                     F.when(gone, "").when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                     changed.alias("text"), gone.alias("gone"), "kind")
    return out.withColumn("copy", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))) \
        .drop("copy", "kind")


_STATS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
_COUNTS = ["blank", "duplicate", "truncated", "illegal"]


def _schema(conv: str) -> str:
    return (f"done boolean, conv {conv}, pid int, seg int, {_STATS}, audit string, sha string, "
            "first_turn long, last_turn long, turns long, first_initial string, last_initial string, "
            "before binary, adds binary, states binary, symbols binary, roles array<string>, texts array<string>")


class _Run:
    """Rows of one conversation in order, as far as they are held."""

    def __init__(self, conv, whole: bool):
        self.conv, self.whole = conv, whole  # whole: its first row is here
        self.sent = 0
        self.last = None  # (turn, role, text) of the row before, also across segments
        self.clear()

    def clear(self):
        self.symbols, self.roles, self.texts, self.bytes = bytearray(), [], [], 0
        self.count = dict.fromkeys(_COUNTS, 0)
        self.first_turn = self.last_turn = None
        self.turns, self.first_initial, self.last_initial = 0, None, None

    def push(self, turn, role, text, later, bare):
        initial = role[:1]
        if self.last_initial is not None:
            self.count["illegal"] += self.last_initial + initial not in LEGAL
        else:
            self.first_initial = initial
        self.last_initial = initial
        if turn is not None:
            self.turns += turn != self.last_turn
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        if not bare:
            symbol = GONE
            self.count["blank"] += 1
        elif later or (turn, role, text) == self.last:
            symbol = GONE
            self.count["duplicate"] += 1
        else:
            cut = bare not in ".!?"
            self.count["truncated"] += cut
            symbol = (INITIALS.index(initial) if initial and initial in INITIALS else 3) + 4 * cut
        self.last = (turn, role, text)
        self.symbols.append(symbol)
        # a row that must go is never read again
        self.roles.append(role if symbol != GONE else "")
        self.texts.append(text if symbol != GONE else "")
        self.bytes += len(self.roles[-1]) + len(self.texts[-1])

    def full(self, rows: int, size: int) -> bool:
        return len(self.symbols) >= rows or self.bytes >= size

    def result(self) -> dict:
        symbols = bytes(self.symbols)
        t = tables()
        after, cost = vectors_between(symbols, t.terminal)
        audit, lines = trace(symbols, self.roles, self.texts, t.terminal, START, True)
        gaps = self.last_turn - self.first_turn + 1 - self.turns if self.turns else 0
        return {"done": True, "conv": self.conv, "gaps": gaps, **self.count, "cost": cost + int(t.vector[after[-1], START]),
                "audit": audit, "sha": hashlib.sha256("\n".join(lines).encode()).hexdigest()}

    def segment(self, pid: int, seg: int) -> dict:
        symbols = bytes(self.symbols)
        before, adds, states = transfer(symbols)
        out = {"done": False, "conv": self.conv, "pid": pid, "seg": seg, **self.count, "first_turn": self.first_turn,
               "last_turn": self.last_turn, "turns": self.turns, "first_initial": self.first_initial,
               "last_initial": self.last_initial, "before": before.astype(np.int32).tobytes(),
               "adds": adds.astype(np.int64).tobytes(), "states": states.astype(np.int8).tobytes(), "symbols": symbols,
               "roles": self.roles, "texts": self.texts}
        self.sent += 1
        self.clear()
        return out


def _parts(schema: pa.Schema, rows: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid, seg, now, out, held = TaskContext.get().partitionId(), 0, None, [], 0

        def ready():
            return pa.RecordBatch.from_pylist(out, schema)

        for batch in batches:
            for conv, turn, role, text, gone, later, bare in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or conv != now.conv:
                    if now is not None:
                        if now.whole and not now.sent:
                            out.append(now.result())
                            held += 200 + len(out[-1]["audit"])
                        else:
                            out.append(now.segment(pid, seg))
                            seg += 1
                    # the first conversation of a partition may have begun in the one before
                    now = _Run(conv, now is not None)
                if not gone:
                    now.push(turn, role, text, later, bare)
                    if now.full(rows, size):
                        out.append(now.segment(pid, seg))
                        seg += 1
                        held += size
                if len(out) >= 2000 or held > 2 * size:
                    yield ready()
                    out, held = [], 0
        if now is not None:  # the last one may go on in the next partition
            out.append(now.segment(pid, seg))
        if out:
            yield ready()
    return run


def _chain(schema: pa.Schema):
    """Vector after and state before every segment of a conversation, and on its last one the counts and the cost."""
    def run(table: pa.Table) -> pa.Table:
        t = tables()
        rows = table.sort_by([("pid", "ascending"), ("seg", "ascending")]).to_pylist()
        at, cost, ends = t.terminal, 0, []
        for r in reversed(rows):
            ends.append(at)
            cost += int(np.frombuffer(r["adds"], np.int64)[at])
            at = int(np.frombuffer(r["before"], np.int32)[at])
        cost += int(t.vector[at, START])
        state, out = START, []
        first = last = initial = None
        total, turns = dict.fromkeys(_COUNTS, 0), 0
        for r, v in zip(rows, reversed(ends)):
            out.append({"pid": r["pid"], "seg": r["seg"], "last": v, "state": state, "final": False})
            state = int(np.frombuffer(r["states"], np.int8).reshape(-1, 4)[v, state])
            for c in _COUNTS:
                total[c] += r[c]
            if r["first_initial"] is not None:
                total["illegal"] += initial is not None and initial + r["first_initial"] not in LEGAL
                initial = r["last_initial"]
            if r["first_turn"] is not None:
                turns += r["turns"] - (last == r["first_turn"])
                first, last = r["first_turn"] if first is None else first, r["last_turn"]
        out[-1] |= {"final": True, "gaps": last - first + 1 - turns if turns else 0, "cost": cost, **total}
        return pa.Table.from_pylist(out, schema)
    return run


def _traced(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                r = batch.slice(k, 1).to_pylist()[0]
                audit, lines = trace(r["symbols"], r["roles"], r["texts"], r["last"], r["state"], r["final"])
                yield pa.RecordBatch.from_pylist(
                    [{n: r[n] for n in schema.names if n in r} | {"audit": audit, "body": "\n".join(lines)}], schema)
    return run


def _digested(schema: pa.Schema):
    """Pieces of a conversation, in order, to its row; the digest runs along."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sha, audit, empty = hashlib.sha256(), [], True
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                audit.append(r["audit"])
                if r["body"]:
                    sha.update(("" if empty else "\n").encode() + r["body"].encode())
                    empty = False
                if r["final"]:
                    out.append({n: r[n] for n in schema.names if n in r} | {"audit": "".join(audit), "sha": sha.hexdigest()})
                    sha, audit, empty = hashlib.sha256(), [], True
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
    return run


def repair(rows: DataFrame, segment: int = SEGMENT, size: int = BYTES) -> DataFrame:
    """One row per conversation of ``rows`` (conv, turn, role, text, gone; a gone row only names its conversation).

    Columns: conv, gaps, blank, duplicate, truncated, illegal, cost, audit, sha (of the repaired ``role:text`` lines).
    ``segment`` and ``size`` (rows, bytes) bound what a task holds of one conversation; the result does not depend on them.
    """
    spark = rows.sparkSession
    base = work_dir(spark, "conversation-repair")
    kind = rows.schema["conv"].dataType.simpleString()
    said = rows.where(~F.col("gone")).select("conv", "turn", F.xxhash64("role", "text").alias("h"),
                                             F.xxhash64(F.lit(7), "text", "role").alias("g"))
    # role and text at more than one turn: all but the first are duplicates
    first = said.groupBy("conv", "h", "g").agg(
        F.min("turn").alias("least"), F.max("turn").alias("most"), F.bool_or(F.col("turn").isNull()).alias("bare")) \
        .where((F.col("least") < F.col("most")) | (F.col("bare") & F.col("least").isNotNull()))
    a = rows.withColumn("h", F.xxhash64("role", "text")).withColumn("g", F.xxhash64(F.lit(7), "text", "role"))
    b = first.select(F.col("conv").alias("c2"), F.col("h").alias("h2"), F.col("g").alias("g2"), "least", "bare")
    marked = a.join(b, a.conv.eqNullSafe(b.c2) & (a.h == b.h2) & (a.g == b.g2) & ~a.gone, "left")
    later = F.coalesce(F.col("turn").isNotNull() & (F.col("bare") | (F.col("turn") > F.col("least"))), F.lit(False))
    end = F.regexp_extract("text", f"(?s)([^\\x20\\x09-\\x0D]){_SPACE}*\\z", 1)
    ordered = marked.select("conv", "turn", "role", "text", "gone", later.alias("later"), end.alias("bare")) \
        .repartitionByRange("conv", "turn", "role", "text").sortWithinPartitions("conv", "turn", "role", "text")
    spark_schema = _schema(kind)
    arrow = _arrow(spark, spark_schema)
    ordered.mapInArrow(_parts(arrow, segment, size), spark_schema).write.parquet(f"{base}/parts")
    parts = spark.read.parquet(f"{base}/parts")
    names = ["conv", "gaps", *_COUNTS, "cost", "audit", "sha"]
    done = parts.where("done").select(*names)
    open_ = parts.where("not done")
    chained_schema = f"pid int, seg int, last int, state int, final boolean, {_STATS}"
    chained = open_.select("conv", "pid", "seg", *_COUNTS, "first_turn", "last_turn", "turns", "first_initial", "last_initial",
                           "before", "adds", "states") \
        .groupBy("conv").applyInArrow(_chain(_arrow(spark, chained_schema)), chained_schema)
    pieces_schema = f"conv {kind}, pid int, seg int, final boolean, {_STATS}, audit string, body string"
    pieces = open_.select("conv", "pid", "seg", "symbols", "roles", "texts").join(chained, ["pid", "seg"]) \
        .mapInArrow(_traced(_arrow(spark, pieces_schema)), pieces_schema)
    rest_schema = f"conv {kind}, {_STATS}, audit string, sha string"
    rest = pieces.repartition("conv").sortWithinPartitions("conv", "pid", "seg") \
        .mapInArrow(_digested(_arrow(spark, rest_schema)), rest_schema)
    return done.unionByName(rest.select(*names))


def _arrow(spark, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(spark.createDataFrame([], ddl).schema)
