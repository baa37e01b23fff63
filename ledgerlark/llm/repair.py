"""Conversation structure repair: the cheapest edits that give a proper sequence of roles.

Every row is a symbol, its role's initial and its fault. Equal consecutive symbols are collapsed to runs. A
symbol's cost of moving between the four states of ``(s?(ua)+)?`` is a min-plus matrix, and a run advances by
its matrix's power, put together from cached binary powers. The costs known, the choices are
unrolled row by row for the audit, the ASCII-least first wherever several are cheapest.

Rows are sorted once over the whole table, so a long conversation spans several partitions. A
partition's share of a conversation is a section. Matrices of sections compose, which gives the
cost of what follows each section; every section is then unrolled from each state that it may be
entered in, and the sections' exits are chained. So no conversation has to fit into one task; what
is gathered per conversation is a few numbers a section.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from ledgerlark.llm.common import written

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: States: nothing said, after the system turn, after a user, after an assistant. The last is where one may stop, as the first.
START, SYSTEM, USER, ASSISTANT = range(4)
ACCEPTING = (START, ASSISTANT)
#: The state that the next user or assistant turn leads to, by state.
NEXT = (USER, USER, ASSISTANT, USER)
#: Symbols are 4 * role + fault.
ROLES, FAULTS = "sua", ("", "truncated", "duplicate", "blank")
NEVER = 1 << 60
#: White space, as in [\x20\x09-\x0D].
_SPACE = r"[\x20\x09-\x0D]"


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.minimum((a[:, :, None] + b[None, :, :]).min(axis=1), NEVER)


def _closure() -> np.ndarray:
    """The cost of getting from state to state by insertions alone."""
    m = np.full((4, 4), NEVER, np.int64)
    for s in range(4):
        m[s, s] = 0
        m[s, NEXT[s]] = INSERT
    for _ in range(3):
        m = _times(m, m)
    return m


INSERTIONS = _closure()


def kept_to(symbol: int, state: int) -> int | None:
    """The state after keeping a row as it is; None where its role may not stand there."""
    role = symbol >> 2
    if role == 0:
        return SYSTEM if state == START else None
    if role == 3:
        return None
    wanted = USER if role == 1 else ASSISTANT
    return wanted if NEXT[state] == wanted else None


@lru_cache(None)
def transition(symbol: int) -> np.ndarray:
    """Cheapest cost from state to state by insertions and one row of this symbol."""
    step = np.full((4, 4), NEVER, np.int64)
    more = TRUNCATED if symbol & 3 == 1 else 0
    for s in range(4):
        step[s, s] = DELETE
        if symbol & 3 < 2:
            step[s, NEXT[s]] = min(step[s, NEXT[s]], REROLE + more)
            to = kept_to(symbol, s)
            if to is not None:
                step[s, to] = min(step[s, to], more)
    return _times(INSERTIONS, step)


@lru_cache(None)
def power(symbol: int, exponent: int) -> np.ndarray:
    """The transition of 2^exponent equal symbols."""
    if not exponent:
        return transition(symbol)
    half = power(symbol, exponent - 1)
    return _times(half, half)


def _advanced(m: np.ndarray, symbol: int, length: int) -> np.ndarray:
    for e in range(length.bit_length()):
        if length >> e & 1:
            m = _times(m, power(symbol, e))
    return m


@lru_cache(1 << 16)
def run_matrix(runs: tuple[tuple[int, int], ...]) -> np.ndarray:
    """The transition of runs (symbol, length) one after the other."""
    m = np.where(np.eye(4, dtype=bool), 0, NEVER).astype(np.int64)
    for symbol, length in runs:
        m = _advanced(m, symbol, length)
    return m


#: Cost of the cheapest end from each state once no row is left.
ENDS = tuple(int(x) for x in INSERTIONS[:, ACCEPTING].min(axis=1))


def _applied(matrix: np.ndarray, after: tuple[int, ...]) -> tuple[int, ...]:
    return tuple(int(x) for x in np.minimum((matrix + np.array(after)).min(axis=1), NEVER))


@lru_cache(1 << 16)
def _choices(symbol: int, after: tuple[int, ...]) -> tuple[tuple[int, ...], tuple[tuple[str, str, int], ...]]:
    """For a row with the costs ``after`` it: the costs before it, the least as 0, and per state edits, roles, next state.

    Edits are taken one by one, each the ASCII-least that can begin a cheapest way; roles are the
    initials that inserted and reroled turns get, "-" where the row's own is kept or nothing is left.
    """
    before = _applied(transition(symbol), after)
    more = TRUNCATED if symbol & 3 == 1 else 0
    ways = []
    for state in range(4):
        edits = roles = ""
        while True:
            cost, to = before[state], kept_to(symbol, state)
            if DELETE + after[state] == cost:
                ways.append((edits + "D", roles + "-", state))
            elif INSERT + before[NEXT[state]] == cost:
                state = NEXT[state]
                edits, roles = edits + "I", roles + _initial(state)
                continue
            elif symbol & 3 < 2 and to is not None and more + after[to] == cost:
                ways.append((edits + "K", roles + "-", to))
            else:
                ways.append((edits + "R", roles + _initial(NEXT[state]), NEXT[state]))
            break
    return tuple(c - min(before) for c in before), tuple(ways)


def _initial(state: int) -> str:
    return "u" if state == USER else "a"


@lru_cache(None)
def _last_inserts(state: int) -> str:
    """Roles inserted after the last row."""
    made = ""
    while ENDS[state]:
        state = NEXT[state]
        made += _initial(state)
    return made


def unrolled(runs: list[tuple[int, int]], after: tuple[int, ...], last: bool, states: list[int]) -> list[tuple]:
    """Per state that the runs are entered in: state, state after them, edits and roles of each row.

    ``after`` holds the costs of what follows. Behind the last row, ``last`` adds what is inserted there.
    """
    steps = []
    costs = tuple(c - min(after) for c in after)
    for symbol, length in reversed(runs):
        for _ in range(length):
            costs, ways = _choices(symbol, costs)
            steps.append(ways)
    steps.reverse()
    out = []
    for begin in states:
        state, edits, roles = begin, [], []
        for ways in steps:
            e, r, state = ways[state]
            edits.append(e)
            roles.append(r)
        if last and steps:
            made = _last_inserts(state)
            edits[-1] += "I" * len(made)
            roles[-1] += made
        out.append((begin, state, edits, roles))
    return out


def damage(rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id``, ``turn``, ``role``, ``text`` with planted faults, by crc32 of ``key:turn`` modulo 20.

    0 drops the row, 1 empties the text, 2 removes its full stops, exclamation and question marks, 3 repeats the
    row, 4 makes the role user. A NULL is one space, in the hashed text, in role and in text; key and
    turn themselves stay NULL. Equal rows share their fate. Other columns, whatever their names,
    are left out; empty tables stay empty, and long texts are treated whole.
    """
    def filled(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    drawn = F.crc32(F.concat(filled(key), F.lit(":"), filled(turn)).cast("binary")) % 20
    rows = rows.select(
        F.col(key).cast("bigint").alias("conv_id"), F.col(turn).cast("bigint").alias("turn"), filled(role).alias("role"), filled(text).alias("text"), drawn.alias("d")
    ).where("d <> 0")
    said = F.when(F.col("d") == 1, "").when(F.col("d") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    rows = rows.select("conv_id", "turn", F.when(F.col("d") == 4, "user").otherwise(F.col("role")).alias("role"), said.alias("text"), "d")
    times = F.explode(F.array_repeat(F.lit(1), F.when(F.col("d") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", "role", "text", times.alias("once")).drop("once")


def in_order(rows: DataFrame) -> DataFrame:
    """The rows sorted over the whole table and stored, with ``spot``: partition and place, counting on by one.

    Order is by conversation and turn, NULLs first; rows of one turn go by role and text (32 characters each, then a
    digest). Equal rows may be told apart by nothing but their number, so even they can be dealt out.
    """
    digest = F.unhex(F.md5(F.concat_ws(":", F.length("role"), "role", "text")))
    last = F.regexp_extract("text", rf"([^\x20\x09-\x0D]){_SPACE}*\z", 1)
    rows = rows.select(
        "conv_id",
        "turn",
        "role",
        "text",
        digest.alias("digest"),
        F.substring("role", 1, 1).alias("initial"),
        (last == "").alias("blank"),
        (~last.isin(".", "!", "?")).alias("truncated"),
        F.monotonically_increasing_id().alias("nr"),
    )
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.substring("role", 1, 32), F.substring("text", 1, 32), F.col("digest"), F.col("nr")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("nr")
    return written(rows.withColumn("spot", F.monotonically_increasing_id()), "repair-rows")


def _schema(**columns: pa.DataType) -> pa.Schema:
    return pa.schema(list(columns.items()))


_LONG, _LONGS, _STRINGS = pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string())
_SECTION = _schema(
    conv_id=_LONG,
    section=_LONG,
    first_spot=_LONG,
    symbols=_LONGS,
    lengths=_LONGS,
    matrix=_LONGS,
    **dict.fromkeys(["blank", "duplicate", "truncated", "illegal"], _LONG),
    **dict.fromkeys(["first_initial", "last_initial"], pa.string()),
    **dict.fromkeys(["low", "high", "turns", "first_turn", "last_turn"], _LONG),
)


def _legal(a: str, b: str) -> bool:
    return a + b in ("su", "ua", "au")


class _Section:
    """What one partition holds of one conversation."""

    def __init__(self, conv_id: int | None, section: int, spot: int):
        self.head = conv_id, section, spot
        self.runs: list[list[int]] = []
        self.faults = [0, 0, 0, 0]
        self.illegal = self.turns = 0
        self.first = self.last = None  # initials
        self.low = self.first_turn = self.last_turn = None
        self.high = None

    def add(self, turn: int | None, initial: str, fault: int) -> None:
        self.faults[fault] += 1
        if self.first is None:
            self.first, self.first_turn = initial, turn
        else:
            self.illegal += not _legal(self.last, initial)
        if turn is not None:
            self.turns += turn != self.last_turn
            self.low = turn if self.low is None else self.low
            self.high = turn
        self.last, self.last_turn = initial, turn
        role = ROLES.find(initial) if initial else -1
        symbol = 4 * (role if role >= 0 else 3) + fault
        if self.runs and self.runs[-1][0] == symbol:
            self.runs[-1][1] += 1
        else:
            self.runs.append([symbol, 1])

    def row(self) -> tuple:
        runs = tuple(map(tuple, self.runs))
        # Short lists of runs recur; long ones are not worth keeping.
        matrix = (run_matrix if len(runs) < 32 else run_matrix.__wrapped__)(runs)
        return (
            *self.head, [r[0] for r in runs], [r[1] for r in runs], matrix.ravel().tolist(), self.faults[3], self.faults[2], self.faults[1],
            self.illegal, self.first, self.last, self.low, self.high, self.turns, self.first_turn, self.last_turn,
        )


def _batches_of(rows: Iterator[tuple], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Tuples as batches, of about ``size`` values of their lists and rows."""

    def batch(held: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)

    held: list[tuple] = []
    weight = 0
    for row in rows:
        held.append(row)
        weight += 1 + sum(len(x) for x in row if isinstance(x, list))
        if weight >= size:
            yield batch(held)
            held, weight = [], 0
    if held:
        yield batch(held)


def _sections(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        now = None
        for batch in batches:
            for conv_id, spot, turn, initial, fault in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                section = spot >> 33
                if now is None or now.head[0] != conv_id or now.head[1] != section:
                    if now is not None:
                        yield now.row()
                    now = _Section(conv_id, section, spot)
                now.add(turn, initial, fault)
        if now is not None:
            yield now.row()

    return _batches_of(rows(), _SECTION)


_PLACE = pa.struct([("section", _LONG), ("after", _LONGS), ("first", pa.bool_()), ("last", pa.bool_())])
_REPORT = _schema(
    conv_id=_LONG,
    **dict.fromkeys(["gaps", "blank", "duplicate", "truncated", "illegal", "cost"], _LONG),
    sections=pa.list_(_PLACE),
)


def _reports(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per conversation its counts, its cost, and for every section the costs of what follows it."""

    def rows() -> Iterator[tuple]:
        for batch in batches:
            for conv_id, parts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                lows = [p["low"] for p in parts if p["low"] is not None]
                highs = [p["high"] for p in parts if p["high"] is not None]
                turns, illegal = sum(p["turns"] for p in parts), sum(p["illegal"] for p in parts)
                for a, b in zip(parts, parts[1:], strict=False):
                    turns -= a["last_turn"] is not None and a["last_turn"] == b["first_turn"]
                    illegal += not _legal(a["last_initial"], b["first_initial"])
                after, places = ENDS, []
                for n, p in reversed(list(enumerate(parts))):
                    places.append({"section": p["section"], "after": list(after), "first": n == 0, "last": n == len(parts) - 1})
                    after = _applied(np.array(p["matrix"], np.int64).reshape(4, 4), after)
                gaps = min(max(highs) - min(lows) + 1 - turns, 2**63 - 1) if lows else 0
                faults = [sum(p[f] for p in parts) for f in ("blank", "duplicate", "truncated")]
                yield (conv_id, gaps, *faults, illegal, after[START], places)

    return _batches_of(rows(), _REPORT)


_UNROLLED = _schema(conv_id=_LONG, section=_LONG, first_spot=_LONG, entered=_LONG, left=_LONG, edits=_STRINGS, roles=_STRINGS)


def _unrolled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for batch in batches:
            for conv_id, section, spot, symbols, lengths, after, first, last in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                states = [START] if first else [START, SYSTEM, USER, ASSISTANT]
                runs = list(zip(symbols, lengths, strict=True))
                for entered, left, edits, roles in unrolled(runs, tuple(after), last, states):
                    yield conv_id, section, spot, entered, left, edits, roles

    return _batches_of(rows(), _UNROLLED)


_ENTERED = _schema(conv_id=_LONG, section=_LONG, entered=_LONG)


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state in which each section is entered, following the exits from the first section on."""

    def rows() -> Iterator[tuple]:
        for batch in batches:
            for conv_id, exits in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                state = START
                for section, ways in groupby(exits, key=lambda e: e["section"]):
                    yield conv_id, section, state
                    state = {w["entered"]: w["left"] for w in ways}[state]

    return _batches_of(rows(), _ENTERED)


_DIGEST = _schema(conv_id=_LONG, repaired_sha256=pa.string())


def digests(turns: DataFrame) -> DataFrame:
    """``conv_id``, ``repaired_sha256``: SHA-256 of each conversation's ``role:text``, joined by line breaks, in lowercase hex.

    The digest has to see a conversation's turns one after the other, so one task does; they stream through it, sorted
    on disk if need be, and are never held together. Conversations without a turn are not there.
    """

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            now, digest = None, None
            for batch in batches:
                for conv_id, said in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                    if digest is None or conv_id != now:
                        if digest is not None:
                            yield now, digest.hexdigest()
                        now, digest = conv_id, sha256(said)
                    else:
                        digest.update(b"\n")
                        digest.update(said)
            if digest is not None:
                yield now, digest.hexdigest()

        return _batches_of(rows(), _DIGEST)

    lines = turns.select("conv_id", F.concat("role", F.lit(":"), "text").alias("said"), "spot", "step")
    lines = lines.repartition("conv_id").sortWithinPartitions("conv_id", "spot", "step").select("conv_id", "said")
    return lines.mapInArrow(hashed, from_arrow_schema(_DIGEST))


class Repair:
    """The repair of all conversations of ``rows`` (``conv_id``, ``turn``, ``role``, ``text``).

    ``conversations`` has a row per conversation: ``gaps`` (turn numbers missing between the least and the greatest),
    ``blank``, ``duplicate`` and ``truncated`` rows (first fault of each), ``illegal`` neighbours,
    ``cost`` and ``audit``, the initials of the edits: Keep, Rerole, Delete, Insert. ``turns`` has the repaired turns in order of
    ``spot`` and ``step``, with their edit. Keeping is free, reroling costs 3, deleting 4, inserting 3, and a truncated row that stays 3
    more; blank and duplicate rows must go. Of equally cheap edits the audit that is least in ASCII is taken.

    Rows go by turn, NULL turns first, then by role and text. NULL roles and texts are empty, and an empty role has no
    initial, so it can't be kept. All rows with a NULL conv_id are one conversation. Repeated rows are duplicates. Very long texts are
    shuffled, never gathered; a conversation of any length is spread over partitions. Other columns are not read; an empty table has
    no conversations.
    """

    def __init__(self, rows: DataFrame):
        rows = rows.select(
            F.col("conv_id").cast("bigint").alias("conv_id"),
            F.col("turn").cast("bigint").alias("turn"),
            *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")],
        )
        self.rows = in_order(rows)
        narrow = self.rows.select("conv_id", "spot", "turn", "initial", "blank", "truncated", "digest")
        # A row is a duplicate if it isn't the first of its digest; looked up by place, so no digest is hot.
        firsts = narrow.where("NOT blank").groupBy("conv_id", "digest").agg(F.min("spot").alias("spot"))
        firsts = firsts.select("spot", F.lit(True).alias("first"))
        marked = narrow.drop("digest").join(firsts, "spot", "left")
        fault = F.when(F.col("blank"), 3).when(F.col("first").isNull(), 2).when(F.col("truncated"), 1).otherwise(0)
        marked = marked.select("conv_id", "spot", "turn", "initial", fault.alias("fault"), F.shiftright("spot", 33).alias("section"))
        sorted_ = marked.repartition("section").sortWithinPartitions("spot").drop("section")
        sections = written(sorted_.mapInArrow(_sections, from_arrow_schema(_SECTION)), "repair-sections")

        parts = F.array_sort(
            F.collect_list(
                F.struct(
                    "section", "matrix", "blank", "duplicate", "truncated", "illegal", "first_initial", "last_initial",
                    "low", "high", "turns", "first_turn", "last_turn",
                )
            )
        )
        gathered = sections.groupBy("conv_id").agg(parts.alias("parts"))
        self.reports = written(gathered.mapInArrow(_reports, from_arrow_schema(_REPORT)), "repair-reports")

        after = self.reports.select("conv_id", F.inline("sections")).withColumnRenamed("conv_id", "c").withColumnRenamed("section", "s")
        runs = sections.select("conv_id", "section", "first_spot", "symbols", "lengths")
        runs = runs.join(after, (F.col("section") == F.col("s")) & F.col("conv_id").eqNullSafe(F.col("c"))).drop("c", "s")
        ways = written(runs.mapInArrow(_unrolled, from_arrow_schema(_UNROLLED)), "repair-ways")
        exits = ways.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("section", "entered", "left"))).alias("exits"))
        chosen = exits.mapInArrow(_chained, from_arrow_schema(_ENTERED)).toDF("c", "s", "e")
        same = (F.col("section") == F.col("s")) & (F.col("entered") == F.col("e")) & F.col("conv_id").eqNullSafe(F.col("c"))
        self.edits = written(ways.join(chosen, same).select("conv_id", "section", "first_spot", "edits", "roles"), "repair-edits")

    @property
    def conversations(self) -> DataFrame:
        made = self.edits.select("conv_id", F.struct("section", F.array_join("edits", "").alias("e")).alias("x"))
        audits = made.groupBy("conv_id").agg(F.array_sort(F.collect_list("x")).alias("x"))
        audits = audits.select(F.col("conv_id").alias("c"), F.array_join(F.transform("x", lambda x: x["e"]), "").alias("audit"))
        return self.reports.drop("sections").join(audits, F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")

    @property
    def turns(self) -> DataFrame:
        """``conv_id``, ``spot``, ``step``, ``edit``, ``role``, ``text``: what is left and what was inserted."""
        per_row = self.edits.select("first_spot", F.posexplode(F.arrays_zip("edits", "roles")).alias("at", "x"))
        per_row = per_row.select((F.col("first_spot") + F.col("at")).alias("spot"), "x.edits", "x.roles")
        steps = per_row.select("spot", "edits", "roles", F.explode(F.sequence(F.lit(1), F.length("edits"))).alias("step"))
        steps = steps.select(
            "spot", "step", F.expr("substring(edits, step, 1)").alias("edit"), F.expr("substring(roles, step, 1)").alias("made")
        ).where("edit <> 'D'")
        made = F.when(F.col("made") == "u", "user").when(F.col("made") == "a", "assistant").otherwise(F.col("role"))
        text = F.when(F.col("edit") == "I", "").otherwise(F.col("text"))
        said = self.rows.select("spot", "conv_id", "role", "text")
        return steps.join(said, "spot").select("conv_id", "spot", "step", "edit", made.alias("role"), text.alias("text"))
