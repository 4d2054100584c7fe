"""Conversation structure repair by Hirschberg's divide and conquer over four role states.

A repaired conversation is empty or an optional system turn followed by user-assistant pairs.
Edits: Keep costs 0, Rerole (to user or assistant) 3, Delete 4, Insert (an empty turn) 3; a turn
that is cut off and not deleted costs 3 more; blank turns and repeats must go. The cheapest edits
are found by ``crossing``: forward and backward cost vectors over the states (start, after system,
after user, after assistant) meet in the middle, and the crossing whose audit is least in ASCII
order is taken. Which turn an edit yields follows from the state, so the audit says everything.

A conversation may hold a third of all rows. Its turns are range-partitioned without their texts;
every range turns its part into one byte a turn and a summary step (best cost from each state to
each state). The summaries of a conversation, one per range, are crossed in the same way, and
then every range reads its own edits between the states it was given. Only writing out a repaired
conversation follows its turns in one task, as a stream in constant memory.

Defined cases: null role and null text are one space, null turns come first, a null conv_id is one
conversation. Rows of equal turn follow by role, first characters and digest of the text (see
``turns``). Rows that are equal throughout are repeats. An empty table gives no rows. Columns
other than conv_id, turn, role, text and ``_copies`` are not read; names starting with ``_`` are
reserved.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from . import crossing, turns
from ..scratch import settle

START, SYSTEM, USER, ASSISTANT = range(4)
REROLE, DELETE, INSERT, CUT_OFF = 3, 4, 3, 3
_GONE = "x"                                        # a turn that must be deleted
_INITIALS = ("s", "u", "a")
_KEPT = {("s", START): SYSTEM, ("u", START): USER, ("u", SYSTEM): USER, ("u", ASSISTANT): USER,
         ("a", USER): ASSISTANT}
_TAIL = {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
_MEMO, _SHORT = 20_000, 12                         # remembered kinds, and their greatest length


def _next(state: int) -> int:
    """The state after an inserted or reroled turn."""
    return ASSISTANT if state == USER else USER


def _arcs(kind: str) -> list[crossing.Arc]:
    """All ways past one turn: inserts first, then one edit that takes the turn."""
    late = CUT_OFF if kind.isupper() else 0
    best: dict[tuple[int, int], tuple[int, str]] = {}
    for start in range(crossing.STATES):
        state = start
        for inserted in range(3):
            price, letters = INSERT * inserted, "I" * inserted
            ways = [(state, price + DELETE, letters + "D")]
            if kind != _GONE:
                ways.append((_next(state), price + REROLE + late, letters + "R"))
                if (kind.lower(), state) in _KEPT:
                    ways.append((_KEPT[kind.lower(), state], price + late, letters + "K"))
            for end, cost, order in ways:
                if (start, end) not in best or (cost, order) < best[start, end]:
                    best[start, end] = (cost, order)
            state = _next(state)
    return [(start, end, cost, order) for (start, end), (cost, order) in best.items()]


STEPS = {kind: _arcs(kind) for kind in "suaoSUAO" + _GONE}
_LETTERS = {kind: {(a, b): order for a, b, _, order in arcs} for kind, arcs in STEPS.items()}


def edits(kinds: str, start: int, end: int) -> str:
    """The edits past the turns of these kinds between two states."""
    way = crossing.states([STEPS[k] for k in kinds], start, end)
    return "".join(_LETTERS[kind][way[i], way[i + 1]] for i, kind in enumerate(kinds))


def _whole(kinds: str) -> list[crossing.Arc]:
    return crossing.summary([STEPS[k] for k in kinds])


@lru_cache(_MEMO)
def _short_edits(kinds: str, start: int, end: int) -> str:
    return edits(kinds, start, end)


@lru_cache(_MEMO)
def _short_whole(kinds: str) -> list[crossing.Arc]:
    return _whole(kinds)


def _piece(kinds: bytes, start: int, end: int, extra: str) -> str:
    find = _short_edits if len(kinds) <= _SHORT else edits
    return find(bytes(kinds).decode(), start, end) + extra


def best_end(steps: list[list[crossing.Arc]]) -> tuple[int, int]:
    """The state after the last turn on the best way, and the cost with the turns added there."""
    costs, ranks = crossing.forward(steps, 0, len(steps), START)
    total, _, end = min((costs[s] + INSERT * len(_TAIL[s]), ranks[s], s)
                        for s in range(crossing.STATES))
    return end, total


def audit(kinds: str) -> tuple[int, str]:
    """Cost and edits of one whole conversation."""
    end, cost = best_end([STEPS[k] for k in kinds])
    return cost, edits(kinds, START, end) + _TAIL[end]


def damage(rows: DataFrame) -> DataFrame:
    """``rows`` with role and text as damaged and ``_copies``, the number of times a row is there.

    The crc32 of ``conv_id:turn`` modulo 20 says which damage a row takes: 0 drops it, 1 empties
    its text, 2 removes full stops, exclamation and question marks, 3 repeats it, 4 makes its role
    user. A null is one space everywhere.
    """
    space = F.lit(" ")
    parts = [F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")]
    hit = F.pmod(F.crc32(F.encode(F.concat_ws(":", *parts), "utf-8")), F.lit(20))
    text = F.coalesce("text", space)
    return (rows.select("conv_id", "turn", "role", "text").withColumn("_hit", hit).select(
        "conv_id", "turn",
        F.when(F.col("_hit") == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
        F.when(F.col("_hit") == 1, "").when(F.col("_hit") == 2, F.translate(text, ".!?", ""))
        .otherwise(text).alias("text"),
        F.when(F.col("_hit") == 0, 0).when(F.col("_hit") == 3, 2).otherwise(1).alias("_copies")))


def _filled(rows: DataFrame) -> DataFrame:
    copies = F.col("_copies") if "_copies" in rows.columns else F.lit(1)
    space = F.lit(" ")
    return turns.keyed(rows.select(
        "conv_id", "turn", F.coalesce("role", space).alias("role"),
        F.coalesce("text", space).alias("text"), copies.cast("long").alias("_copies")))


def _narrow(rows: DataFrame) -> DataFrame:
    """One row per distinct turn: no text, its number of copies, and whether it comes first.

    Equal rows collapse in each task, so the group of an often repeated turn stays small. What is
    seen earlier is the least turn of a (conversation, role, text), joined on a key that also
    holds the turn and is unique on both sides.
    """
    keys = ["_conv", *turns.ORDER]
    text = F.col("text")
    distinct = _filled(rows).groupBy(*keys).agg(
        F.sum("_copies").alias("copies"),
        F.first(turns.is_blank(text)).alias("blank"),
        F.first(~turns.last_character(text).isin(".", "!", "?")).alias("cut"))
    said = ["_conv", "role", "_head", "_digest"]
    seen = (distinct.where("copies > 0").groupBy(*said).agg(F.min("_turn").alias("_turn"))
            .withColumn("_seen", F.lit(True)))
    initial = F.substring("role", 1, 1)
    return distinct.join(seen, [*said, "_turn"], "left").select(
        *keys, "copies", "blank", "cut", F.col("_seen").isNotNull().alias("first"),
        F.col("_turn.turn").alias("turn"),
        F.when(initial.isin(*_INITIALS), initial).otherwise("o").alias("initial"))


_SEGMENT = ("part int, kinds binary, blank long, duplicate long, truncated long, illegal long, "
            "head string, tail string, low long, high long, turns long, "
            "arcs array<struct<a:int,b:int,cost:long,rank:long>>")
_LEGAL = {"su", "ua", "au"}


class _Segment:
    """The turns of one conversation within one range."""

    def __init__(self, conv):
        self.conv, self.kinds = conv, []
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.head = self.tail = self.low = self.high = None

    def add(self, turn, initial: str, copies: int, blank: bool, cut: bool, first: bool) -> None:
        if not copies:
            return
        taken = first and not blank
        if blank:
            self.blank += copies
        else:
            self.duplicate += copies - taken
            self.truncated += taken and cut
        self.kinds.append((initial.upper() if cut else initial) + _GONE * (copies - 1)
                          if taken else _GONE * copies)
        self.illegal += copies - 1
        if self.tail is None:
            self.head = initial
        else:
            self.illegal += self.tail + initial not in _LEGAL
        self.tail = initial
        if turn is not None:
            self.turns += turn != self.high
            self.low = turn if self.low is None else self.low
            self.high = turn

    def row(self, part: int) -> tuple:
        kinds = "".join(self.kinds)
        arcs = (_short_whole if len(kinds) <= _SHORT else _whole)(kinds)
        return (self.conv, part, kinds.encode(), self.blank, self.duplicate, self.truncated,
                self.illegal, self.head, self.tail, self.low, self.high, self.turns, arcs)


def _batched(rows: Iterator[tuple], schema: pa.Schema, most: int = 4096,
             weight=lambda row: 1) -> Iterator[pa.RecordBatch]:
    """Rows as record batches of about ``most`` in weight."""
    held, load = [], 0
    for row in rows:
        held.append(row)
        load += weight(row)
        if load >= most:
            yield _batch(held, schema)
            held, load = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(values, field.type) for values, field in zip(zip(*rows), schema)], schema=schema)


def _schema(conv: T.DataType, rest: str) -> tuple[T.StructType, pa.Schema]:
    from pyspark.sql.pandas.types import to_arrow_schema
    kind = T.StructType([T.StructField("conv_id", conv), *T.StructType.fromDDL(rest).fields])
    return kind, to_arrow_schema(kind)


def _segments(rows: DataFrame) -> DataFrame:
    """One row per conversation and range, written once: the crossings and the edits read it."""
    placed = (_narrow(rows).repartitionByRange("_conv", *turns.ORDER)
              .sortWithinPartitions("_conv", *turns.ORDER)
              .select(F.col("_conv.conv_id").alias("conv_id"), "turn", "initial", "copies",
                      "blank", "cut", "first"))
    kind, arrow = _schema(rows.schema["conv_id"].dataType, _SEGMENT)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()

        def found():
            open_one = None
            for batch in batches:
                for conv, *turn in zip(*(column.to_pylist() for column in batch.columns)):
                    if open_one is None or open_one.conv != conv:
                        if open_one is not None:
                            yield open_one.row(part)
                        open_one = _Segment(conv)
                    open_one.add(*turn)
            if open_one is not None:
                yield open_one.row(part)

        yield from _batched(found(), arrow)

    return settle(placed.mapInArrow(summed, kind))


_PLAN = ("gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
         "ways array<struct<part:int,start:int,end:int,extra:string>>")


def _crossed(segments: DataFrame) -> DataFrame:
    """Per conversation its counts, its cost and the states between its ranges.

    The list of a conversation holds one summary per range, so its size is bounded by the number
    of ranges.
    """
    fields = [f.name for f in T.StructType.fromDDL(_SEGMENT).fields if f.name != "kinds"]
    listed = segments.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct(*fields))).alias("parts"))
    kind, arrow = _schema(segments.schema["conv_id"].dataType, _PLAN)

    def plan(conv, parts: list[dict]) -> tuple:
        steps = [[(a["a"], a["b"], a["cost"], a["rank"]) for a in p["arcs"]] for p in parts]
        end, cost = best_end(steps)
        way = crossing.states(steps, START, end)
        illegal, tail, count, low, high = 0, None, 0, None, None
        for part in parts:
            if part["head"] is not None:
                illegal += tail is not None and tail + part["head"] not in _LEGAL
                tail = part["tail"]
            illegal += part["illegal"]
            if part["low"] is not None:
                count += part["turns"] - (part["low"] == high)
                low, high = part["low"] if low is None else low, part["high"]
        ways = [(p["part"], way[i], way[i + 1], _TAIL[end] if i == len(parts) - 1 else "")
                for i, p in enumerate(parts)]
        return (conv, high - low + 1 - count if count else 0,
                *(sum(p[c] for p in parts) for c in ("blank", "duplicate", "truncated")),
                illegal, cost, ways)

    def plans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batched((plan(*row) for batch in batches
                             for row in zip(*(c.to_pylist() for c in batch.columns))), arrow)

    return listed.mapInArrow(plans, kind)


def plans(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows`` (conv_id, turn, role, text and, if it is there,
    ``_copies``: 0 only names its conversation): conv_id, gaps, blank, duplicate, truncated,
    illegal, cost and audit. The result is a written table."""
    segments = _segments(rows)
    crossed = settle(_crossed(segments))
    whole = F.udf(_piece, "string", useArrow=True)
    conv = F.struct("conv_id").alias("_conv")
    way = crossed.select(conv, F.inline("ways"))
    pieces = (segments.select(conv, "part", "kinds").join(way, ["_conv", "part"])
              .select("_conv", "part", whole("kinds", "start", "end", "extra").alias("audit"))
              .groupBy("_conv").agg(F.array_join(F.sort_array(F.collect_list(
                  F.struct("part", "audit")))["audit"], "").alias("audit")))
    return settle(crossed.select(conv, *crossed.columns).drop("ways").join(pieces, "_conv")
                  .drop("_conv"))


def repaired(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """The repaired turns: conv_id, position (from 1), role, text, edit (K, R or I).

    Turns of one conversation come out next to each other and in order, in one task each; they are
    read as a stream behind the conversation's audit.
    """
    turns_in = _filled(rows).where("_copies > 0").withColumn(
        "_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    behind = [F.lit(1).alias("_kind"), "_turn", "role", "_head", "_digest", "text",
              F.lit(None).cast("string").alias("audit")]
    front = [F.lit(0).alias("_kind"), *[F.lit(None).cast(turns_in.schema[c].dataType).alias(c)
                                        for c in ("_turn", "role", "_head", "_digest", "text")],
             "audit"]
    stream = (plan.select(F.struct("conv_id").alias("_conv"), *front)
              .unionByName(turns_in.select("_conv", *behind))
              .repartition("_conv").sortWithinPartitions("_conv", "_kind", *turns.ORDER)
              .select(F.col("_conv.conv_id").alias("conv_id"), "_kind", "role", "text", "audit"))
    kind, arrow = _schema(rows.schema["conv_id"].dataType,
                          "position long, role string, text string, edit string")
    names = {USER: "user", ASSISTANT: "assistant"}

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found():
            conv, letters, at, state, position = None, "", 0, START, 0
            for batch in batches:
                for key, follows, role, text, edits_of in zip(
                        *(c.to_pylist() for c in batch.columns)):
                    if not follows:
                        conv, letters, at, state, position = key, edits_of, 0, START, 0
                    else:
                        edit, at = letters[at], at + 1
                        if edit != "D":
                            state = _next(state) if edit == "R" else _KEPT[role[0], state]
                            position += 1
                            role = names[state] if edit == "R" else role
                            yield conv, position, role, text, edit
                    while at < len(letters) and letters[at] == "I":
                        state, position, at = _next(state), position + 1, at + 1
                        yield conv, position, names[state], "", "I"

        yield from _batched(found(), arrow, 1 << 22, lambda row: len(row[3]) + 64)

    return stream.mapInArrow(written, kind)


def digests(turns_out: DataFrame) -> DataFrame:
    """conv_id and repaired_sha256 of ``repaired``'s rows: ``role:text`` joined by newlines."""
    kind, arrow = _schema(turns_out.schema["conv_id"].dataType, "repaired_sha256 string")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found():
            conv, state = None, None
            for batch in batches:
                for key, position, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                    if position == 1:
                        if state is not None:
                            yield conv, state.hexdigest()
                        conv, state = key, hashlib.sha256()
                    else:
                        state.update(b"\n")
                    state.update(f"{role}:{text}".encode())
            if state is not None:
                yield conv, state.hexdigest()

        yield from _batched(found(), arrow)

    return turns_out.select("conv_id", "position", "role", "text").mapInArrow(hashed, kind)
