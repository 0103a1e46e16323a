"""Conversation structure repair by run-length dynamic programming (operator 13).

Every row of a conversation becomes a symbol of its role's initial and its
fault. Equal consecutive symbols are collapsed to runs. A symbol is a min-plus
matrix over four states (nothing yet, after system, after user, after
assistant), with the insertions before the row folded in; a run advances the
vector of costs through cached binary powers of its matrix. Choices are
unrolled from the front, by halves of a power, and are cached too: few
vectors occur once a constant is taken off, so a long run costs its logarithm.

Spark does the rest. Equal rows of a conversation are one row with a count, a
text's first turn is a minimum by group, and rows are dealt out by ranges of
(conversation, turn), so that a conversation with a third of all rows is
spread; what is gathered for it are runs, never more than its audit, which is
one value of the result. Texts meet the audit in order of turn and are read
once as a stream, a batch at a time; a digest over a whole conversation has to
be made in one pass by its nature.

Defined results: a null role or text is one space; turns are taken in
ascending order with nulls first, equal turns by role and then by the text's
SHA-256, so equal rows are adjacent; rows with a null conv_id are a
conversation; a conversation whose rows are all gone has zeros, an empty audit
and the hash of an empty string; an empty table gives no rows; texts of any
length are read whole; columns other than the four are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import kept_by_worker, materialise

#: Symbols are 4 * initial + fault.
INITIALS, FAULTS = ("", "s", "u", "a"), ("", "truncated", "duplicate", "blank")
OTHER, SYSTEM, USER, ASSISTANT = range(4)
SOUND, TRUNCATED, DUPLICATE, BLANK = range(4)
#: States: nothing yet, after system, after user, after assistant.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
#: The state after an inserted or new role, and that role.
FILLED, ROLE = (AFTER_U, AFTER_U, AFTER_A, AFTER_U), ("user", "user", "assistant", "user")
#: The state after a kept role of each initial, where there is one.
KEPT = {(START, SYSTEM): AFTER_S, (START, USER): AFTER_U, (AFTER_S, USER): AFTER_U, (AFTER_A, USER): AFTER_U, (AFTER_U, ASSISTANT): AFTER_A}
REROLE, DELETE, INSERT, UNMENDED = 2, 3, 2, 1
NEVER = 1 << 60
#: Halves of runs up to 2**CACHED rows have their choices kept.
CACHED = 10

Vector = tuple[int, int, int, int]


class Repairer:
    """Costs and choices of runs of symbols; keeps powers, vectors and choices from conversation to conversation."""

    END: Vector = (0, 2 * INSERT, INSERT, 0)

    def __init__(self) -> None:
        self.powers: dict[tuple[int, int], list[list[int]]] = {}
        self.backs: dict[tuple[int, int, Vector], tuple[Vector, int]] = {}
        self.walks: dict[tuple[int, int, Vector, int], tuple[str, int]] = {}

    @staticmethod
    def options(symbol: int, state: int) -> list[tuple[str, int, int]]:
        """Edits of a row itself in ASCII order: letter, cost, next state."""
        initial, fault = divmod(symbol, 4)
        out = [("D", DELETE, state)]
        if fault not in (BLANK, DUPLICATE):
            more = UNMENDED if fault == TRUNCATED else 0
            if (state, initial) in KEPT:
                out.append(("K", more, KEPT[state, initial]))
            out.append(("R", REROLE + more, FILLED[state]))
        return out

    def power(self, symbol: int, j: int) -> list[list[int]]:
        """Least cost of 2**j rows from state to state, insertions before each row included."""
        if (symbol, j) not in self.powers:
            m = [[NEVER] * 4 for _ in range(4)]
            if j == 0:
                for state in range(4):
                    at, paid = state, 0
                    for _ in range(3):
                        for _, cost, to in self.options(symbol, at):
                            m[state][to] = min(m[state][to], paid + cost)
                        at, paid = FILLED[at], paid + INSERT
            else:
                half = self.power(symbol, j - 1)
                m = [[min(min(half[a][b] + half[b][c] for b in range(4)), NEVER) for c in range(4)] for a in range(4)]
            self.powers[symbol, j] = m
        return self.powers[symbol, j]

    def back(self, symbol: int, j: int, after: Vector) -> tuple[Vector, int]:
        """Costs to go before 2**j rows, from those after them; the least of both is 0, and what was taken off is second."""
        key = symbol, j, after
        if key not in self.backs:
            m = self.power(symbol, j)
            costs = [min(m[a][b] + after[b] for b in range(4)) for a in range(4)]
            least = min(costs)
            self.backs[key] = tuple(c - least for c in costs), least
        return self.backs[key]

    def walk(self, symbol: int, j: int, after: Vector, state: int) -> tuple[str, int]:
        """The ASCII-least of the cheapest edits of 2**j rows, and the state after them."""
        key = symbol, j, after, state
        if key in self.walks:
            return self.walks[key]
        if j == 0:
            made, (costs, least) = "", self.back(symbol, 0, after)
            while True:
                letter, to = min((x, to) for x, cost, to in [*self.options(symbol, state), ("I", INSERT, FILLED[state])] if cost + (costs[to] + least if x == "I" else after[to]) == costs[state] + least)
                made, state = made + letter, to
                if letter != "I":
                    break
        else:
            left, state = self.walk(symbol, j - 1, self.back(symbol, j - 1, after)[0], state)
            right, state = self.walk(symbol, j - 1, after, state)
            made = left + right
        if j <= CACHED:
            self.walks[key] = made, state
        return made, state

    def repair(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[int, str]:
        """Least cost and audit of a conversation's runs."""
        seen: list[Vector] = [self.END]
        ids, after = {self.END: 0}, np.zeros(len(symbols), np.int32)
        now, cost = self.END, 0
        for k in range(len(symbols) - 1, -1, -1):
            after[k] = ids[now]
            rows, j = int(lengths[k]), 0
            while rows:
                if rows & 1:
                    now, paid = self.back(int(symbols[k]), j, now)
                    cost += paid
                rows, j = rows >> 1, j + 1
            if now not in ids:
                ids[now] = len(seen)
                seen.append(now)
        cost += now[START]
        parts, state = [], START
        for k in range(len(symbols)):
            symbol, rows, then = int(symbols[k]), int(lengths[k]), seen[after[k]]
            # the binary parts of a run commute: the largest first, each seen from the cost after what is left
            bits = [j for j in range(rows.bit_length()) if rows >> j & 1]
            ends = [then]
            for j in bits[:-1]:
                ends.append(self.back(symbol, j, ends[-1])[0])
            for j, end in zip(reversed(bits), reversed(ends)):
                made, state = self.walk(symbol, j, end, state)
                parts.append(made)
        while state in (AFTER_S, AFTER_U):
            parts.append("I")
            state = FILLED[state]
        return cost, "".join(parts)


def runs(symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal consecutive symbols collapsed."""
    if not len(symbols):
        return symbols, lengths
    first = np.flatnonzero(np.diff(symbols, prepend=-1) != 0)
    return symbols[first], np.add.reduceat(lengths, first)


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies: hashed faults put into the rows (nulls of role and text are one space)."""
    name = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), (F.crc32(name.cast("binary")) % 20).alias("kind")).where("kind != 0")
    return rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("kind") == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def _rows(turns: DataFrame, copies: Column | None) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    return turns.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("h"), text.alias("text"), (F.lit(1) if copies is None else copies).cast("long").alias("copies"))


_ORDER = ["conv_id", "turn", "role", "h"]
_RUNS = "conv_id {id}, place long, symbols binary, lengths binary, n_turns long, first_turn long, last_turn long"


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _columns(rows: list[tuple], schema: str) -> list[pa.Array]:
    """Arrays of all columns of the schema but the first."""
    kinds = [{"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[c.split()[1]] for c in schema.split(", ")[1:]]
    return [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]


def _symbols(rows: DataFrame) -> DataFrame:
    """One row for each run of a conversation's rows in one range: its runs of symbols and its turns."""
    inked = F.rtrim("text", F.lit(" \t\n\x0b\f\r"))
    fault = F.when(inked == "", BLANK).when(F.substring(inked, -1, 1).isin(".", "!", "?"), SOUND).otherwise(TRUNCATED)
    initial = F.substring("role", 1, 1)
    marked = rows.select(*_ORDER, "copies", fault.alias("fault"), F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT).otherwise(OTHER).alias("initial"))
    counted = materialise(marked.groupBy(*_ORDER).agg(F.sum("copies").alias("copies"), F.max("fault").alias("fault"), F.max("initial").alias("initial")), "turns")
    # a text's first turn: the least struct, in which a null turn comes first
    first = counted.groupBy("conv_id", "role", "h").agg(F.min(F.struct("turn")).alias("t")).select("conv_id", F.col("t.turn").alias("turn"), "role", "h", F.lit(0).cast("long").alias("copies"), F.lit(0).alias("fault"), F.lit(0).alias("initial"), F.lit(1).alias("new"))
    both = counted.withColumn("new", F.lit(0)).unionByName(first).groupBy(*_ORDER).agg(*(F.sum(c).cast("long").alias(c) for c in ("copies", "fault", "initial", "new")))
    ordered = both.repartitionByRange(*_ORDER).sortWithinPartitions(*_ORDER).select("conv_id", "turn", "copies", "fault", "initial", "new")
    kind = rows.schema["conv_id"].dataType.simpleString()

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = TaskContext.get().partitionId() << 32  # ranges are in order, and so are a range's rows
        for batch in batches:
            conv, turns = batch.column(0), batch.column(1).to_pylist()
            copies, fault, initial, new = (np.asarray(batch.column(k)) for k in range(2, 6))
            # a row gives a first symbol, and a second one for the copies that follow it
            lead = np.where((fault != BLANK) & (new == 0), DUPLICATE, fault)
            symbols = np.stack([4 * initial + lead, 4 * initial + np.where(fault == BLANK, BLANK, DUPLICATE)], 1).ravel()
            lengths = np.stack([np.ones_like(copies), copies - 1], 1).ravel()
            names = conv.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(np.diff(names, prepend=-2) != 0)
            made = []
            for i, j in zip(starts.tolist(), [*starts[1:].tolist(), len(names)]):
                some = np.flatnonzero(lengths[2 * i : 2 * j]) + 2 * i
                one, many = runs(symbols[some], lengths[some])
                known = [t for k, t in enumerate(turns[i:j], i) if t is not None and (k == i or t != turns[k - 1])]
                made.append((place, one.astype(np.uint8).tobytes(), many.astype(np.int64).tobytes(), len(known), known[0] if known else None, known[-1] if known else None))
                place += 1
            yield pa.RecordBatch.from_arrays([conv.take(pa.array(starts)), *_columns(made, _RUNS)], names=_names(_RUNS))

    return ordered.mapInArrow(chunks, _RUNS.format(id=kind))


_AUDIT = "conv_id {id}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _audits(rows: DataFrame, every: DataFrame | None) -> DataFrame:
    """The audit of every conversation of ``rows`` and, with nothing to repair, of those that only ``every`` (conv_id) has."""
    found = _symbols(rows)
    kind = rows.schema["conv_id"].dataType.simpleString()
    piece = F.struct(*_names(_RUNS)[1:])
    if every is not None:
        none = every.select("conv_id").distinct().select("conv_id", F.lit(-1).cast("long").alias("place"), *(F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in _RUNS.split(", ")[2:]))
        found = found.unionByName(none)
    # runs only, at most as long as the audit, which is one value
    gathered = found.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.when(F.col("place") >= 0, piece))).alias("pieces"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repairer = kept_by_worker(("turn_repair",), Repairer)
        legal = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}
        allowed = np.array([[(a, b) in legal for b in range(4)] for a in range(4)])
        for batch in batches:
            made = []
            for pieces in batch.column(1):
                pieces = pieces.as_py()
                symbols, lengths = runs(
                    np.concatenate([np.zeros(0, np.uint8), *(np.frombuffer(p["symbols"], np.uint8) for p in pieces)]).astype(np.int64),
                    np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(p["lengths"], np.int64) for p in pieces)]),
                )
                initial, fault = symbols // 4, symbols % 4
                of = [int(lengths[fault == f].sum()) for f in (BLANK, DUPLICATE, TRUNCATED)]
                illegal = int((lengths - 1).sum()) + int((~allowed[initial[:-1], initial[1:]]).sum())
                turns = [p for p in pieces if p["n_turns"]]
                distinct = sum(p["n_turns"] for p in turns) - sum(a["last_turn"] == b["first_turn"] for a, b in zip(turns, turns[1:]))
                gaps = turns[-1]["last_turn"] - turns[0]["first_turn"] + 1 - distinct if turns else 0
                made.append((gaps, *of, illegal, *repairer.repair(symbols, lengths)))
            yield pa.RecordBatch.from_arrays([batch.column(0), *_columns(made, _AUDIT)], names=_names(_AUDIT))

    return gathered.mapInArrow(run, _AUDIT.format(id=kind))


def audits(turns: DataFrame, copies: Column | None = None, every: DataFrame | None = None) -> DataFrame:
    """conv_id, gaps, counts of first faults, illegal neighbours, least cost and audit of every conversation.

    A job runs while this is built: the rows without their texts are written."""
    return _audits(_rows(turns, copies), every)


def _met(turns: DataFrame, copies: Column | None, every: DataFrame | None) -> DataFrame:
    """Each conversation's audit, followed by its rows in order, in one partition's stream."""
    rows = _rows(turns, copies)
    heads = _audits(rows, every)
    report = F.struct(*_names(_AUDIT)[1:]).alias("report")
    heads = heads.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit(b"").alias("h"), F.lit("").alias("text"), F.lit(0).cast("long").alias("copies"), report)
    kind = heads.schema["report"].dataType.simpleString()
    both = heads.unionByName(rows.withColumns({"kind": F.lit(1), "report": F.lit(None).cast(kind)}))
    return both.repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "role", "h").select("conv_id", "kind", "role", "text", "copies", "report")


def _repairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(0, conv_id, report, "", "") for each conversation, then (1, conv_id, None, role, text) for each of its repaired rows."""
    audit, at, state, conv = "", 0, START, None

    def inserted() -> Iterator[tuple]:
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            yield 1, conv, None, ROLE[state], ""
            at, state = at + 1, FILLED[state]

    for batch in batches:
        kinds, copies = batch.column(1).to_pylist(), batch.column(4).to_pylist()
        for k, head in enumerate(kinds):
            if head == 0:
                yield from inserted()
                report = batch.column(5)[k].as_py()
                audit, at, state, conv = report["audit"], 0, START, batch.column(0)[k].as_py()
                yield 0, conv, report, "", ""
                continue
            for _ in range(copies[k]):
                yield from inserted()
                if audit[at] != "D":
                    role, text = batch.column(2)[k].as_py(), batch.column(3)[k].as_py()
                    if audit[at] == "R":
                        role, state = ROLE[state], FILLED[state]
                    else:
                        state = KEPT[state, INITIALS.index(role[:1])]
                    yield 1, conv, None, role, text
                at += 1
    yield from inserted()


def _batched(rows: Iterator[tuple], kind: pa.DataType, schema: str) -> Iterator[pa.RecordBatch]:
    """Batches of rows whose first value is a conv_id; a batch ends after a million characters."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 100 + len(row[-1])
        if size > 1_000_000:
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in held], kind), *_columns([r[1:] for r in held], schema)], names=_names(schema))
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in held], kind), *_columns([r[1:] for r in held], schema)], names=_names(schema))


def repaired(turns: DataFrame, copies: Column | None = None) -> DataFrame:
    """conv_id, place, role, text: the rows of every conversation after its cheapest repair."""
    met = _met(turns, copies, None)
    kind, schema = to_arrow_type(met.schema["conv_id"].dataType), "conv_id {id}, place long, role string, text string"

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        place = 0
        for what, conv, _, role, text in _repairs(batches):
            if what:
                yield conv, place, role, text
            place = place + 1 if what else 0

    return met.mapInArrow(lambda batches: _batched(placed(batches), kind, schema), schema.format(id=met.schema["conv_id"].dataType.simpleString()))


def digests(conversations: DataFrame) -> DataFrame:
    """The columns of the contract, over the damaged rows of every conversation."""
    met = _met(damage(conversations), F.col("copies"), conversations)
    kind, schema = to_arrow_type(met.schema["conv_id"].dataType), f"{_AUDIT}, repaired_sha256 string"

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        held, digest, begun = None, None, False
        for what, conv, report, role, text in _repairs(batches):
            if what:
                digest.update(f"{chr(10) if begun else ''}{role}:{text}".encode())
                begun = True
                continue
            if held:
                yield *held, digest.hexdigest()
            held, digest, begun = (conv, *report.values()), hashlib.sha256(), False
        if held:
            yield *held, digest.hexdigest()

    return met.mapInArrow(lambda batches: _batched(hashed(batches), kind, schema), schema.format(id=met.schema["conv_id"].dataType.simpleString()))
