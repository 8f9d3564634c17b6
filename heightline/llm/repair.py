"""Repair of the turn structure of conversations by the cheapest edits."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .rows import HAS_WORD, SPACE

# What has come out so far: nothing, the system turn, a user turn that wants its reply, a whole exchange.
START, SYSTEM, ASKED, ANSWERED = range(4)
# Where an inserted turn leads from each state, and the cost of ending there; a state that cannot end inserts what is due.
_INSERTED = (ASKED, ASKED, ANSWERED, ASKED)
_END = (0, 4, 2, 0)
# Edits in the order that decides ties, and their costs.
EDITS = "DIKR"
DELETE, INSERT, KEEP, REROLE = range(4)
COSTS = {"D": 3, "I": 2, "K": 0, "R": 2}
LEFT_TRUNCATED = 1

_ROLES = {ASKED: "user", ANSWERED: "assistant"}


def _kept(state: int, initial: str) -> int | None:
    """The state after a turn of a role with this initial, where the structure allows it."""
    if initial == "s" and state == START:
        return SYSTEM
    if initial == "u" and state != ASKED:
        return ASKED
    if initial == "a" and state == ASKED:
        return ANSWERED
    return None


def _step(later: tuple[int, ...], initial: str, doomed: bool, truncated: bool) -> tuple[tuple[int, ...], int, int]:
    """One row of the DP, from the last row to the first: (costs, added, pointer).

    ``later`` has the least cost from each state after the row, less the least of
    them; ``costs`` has it before the row in the same form, ``added`` what was
    taken off. The pointer is the first edit in each state, two bits each; after
    an insertion the edit follows from the state it leads to.
    """
    extra = LEFT_TRUNCATED if truncated else 0
    options: list[dict[int, int]] = []
    for state in range(4):
        found = {DELETE: COSTS["D"] + later[state]}
        if not doomed:
            then = _kept(state, initial)
            if then is not None:
                found[KEEP] = COSTS["K"] + extra + later[then]
            found[REROLE] = COSTS["R"] + extra + later[_INSERTED[state]]
        options.append(found)
    costs = [min(found.values()) for found in options]
    for _ in range(2):  # two insertions in a row at most
        costs = [min(c, COSTS["I"] + costs[_INSERTED[s]]) for s, c in enumerate(costs)]
    pointer = 0
    for state, found in enumerate(options):
        found[INSERT] = COSTS["I"] + costs[_INSERTED[state]]
        first = min(edit for edit, cost in found.items() if cost == costs[state])
        pointer |= first << (2 * state)
    least = min(costs)
    return tuple(c - least for c in costs), least, pointer


def _planned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows from the last of a conversation to the first, with ``pointer``, and ``cost`` of the best repair from the row on."""
    name, costs, base = (), _END, 0
    # Costs less their least take few forms, so most rows find their step worked out.
    steps: dict[tuple, tuple] = {}
    for batch in batches:
        get = {n: batch.column(i).to_pylist() for i, n in enumerate(batch.schema.names) if n != "text"}
        pointers, totals = [], []
        for conv, role, fault, gone in zip(get["conv"], get["role"], get["fault"], get["gone"]):
            if (conv,) != name:
                name, costs, base = (conv,), _END, 0
            pointer = 0
            if not gone:
                case = (costs, role[:1], fault in ("blank", "duplicate"), fault == "truncated")
                if case not in steps:
                    steps[case] = _step(*case)
                costs, added, pointer = steps[case]
                base += added
            pointers.append(pointer)
            totals.append(base + costs[START])
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(pointers, pa.int16()), pa.array(totals, pa.int64())],
            names=[*batch.schema.names, "pointer", "cost"],
        )


def _replayed(schema: pa.Schema):
    """Rows from the first to the last, each with its edit, and the turns put in between."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, state, step, row = None, START, 0, None
        out: list[tuple] = []

        def put(edit, conv, turn, role, text, fault, gone, new_role, cost):
            nonlocal step
            out.append((conv, step, edit, turn, role, text, fault, gone, new_role, cost))
            step += 1

        def insert() -> None:
            nonlocal state
            state = _INSERTED[state]
            put("I", row["conv"], None, None, "", None, False, _ROLES[state], None)

        def end() -> None:
            while state in (SYSTEM, ASKED):
                insert()

        def made() -> pa.RecordBatch:
            columns = zip(*out) if out else [[] for _ in schema]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

        for batch in batches:
            for row_now in batch.to_pylist():
                if (row_now["conv"],) != name:
                    if name is not None:
                        end()
                    name, state, step = (row_now["conv"],), START, 0
                row = row_now
                shown = [row[k] for k in ("conv", "turn", "role", "text", "fault", "gone")]
                if row["gone"]:
                    put(None, *shown, None, row["cost"])
                    continue
                edit = row["pointer"] >> (2 * state) & 3
                while edit == INSERT:
                    insert()
                    edit = row["pointer"] >> (2 * state) & 3
                new_role = None
                if edit == KEEP:
                    state, new_role = _kept(state, row["role"][:1]), row["role"]
                elif edit == REROLE:
                    state = _INSERTED[state]
                    new_role = _ROLES[state]
                put(EDITS[edit], *shown, new_role, row["cost"])
            if out:
                yield made()
                out.clear()
        if name is not None:
            end()
        if out:
            yield made()

    return run


def edits(
    rows: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    gone: str | None = None,
) -> DataFrame:
    """The cheapest repair as rows: conv, step, edit, turn, role, text, fault, gone, new_role, cost.

    A conversation's rows go by turn, NULL first, then by role and text. A row's
    fault is ``blank`` (no character but white space), else ``duplicate`` (role
    and text stand in an earlier row), else ``truncated`` (its last character
    that is not white space is none of ``.!?``).

    Edits: (K)eep, (R)erole to user or assistant, (D)elete, which blank and
    duplicate rows need, and (I)nsert an empty user or assistant turn; undeleted
    truncated rows cost one more. What is left starts with a system turn or
    none, and goes on with user and assistant by turns, ending with the latter;
    it may be empty. Of equally cheap repairs the one whose initials sort first
    is taken. Every row has its edit, inserted turns have rows of their own;
    ``new_role`` is the role after the edit, NULL for deleted rows.

    Rows are dealt by conversation and stream through their task twice, sorted
    from the last turn to the first for the costs, then from the first to the
    last for the edits. Between batches a task holds four costs or one state.
    The way back is a pointer of one byte in each row, which Spark's sort spills
    like the rest of the row, so a conversation may have any length.

    * ``gone`` names a boolean column of rows that are not there: they take no
      edit, but a conversation of such rows only still shows.
    * NULL roles and texts count as one space. NULL conversations are one.
    * Rows alike in all four are duplicates of the first. Texts are carried
      whole. An empty table gives an empty table; other columns are not read.

    The result is partitioned by conversation and in the order of steps, which
    summary() relies on.
    """
    space = F.lit(" ")
    plain = rows.select(
        F.col(conv).alias("conv"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), space).alias("role"),
        F.coalesce(F.col(text), space).alias("text"),
        (F.lit(False) if gone is None else F.coalesce(F.col(gone), F.lit(False))).alias("gone"),
    )
    # The window asks for rows clustered by more than the conversation, so it takes them as they are dealt.
    seen = F.row_number().over(Window.partitionBy("conv", "role", "text", "gone").orderBy("turn"))
    last = F.substring(F.rtrim(F.col("text"), F.lit(SPACE)), -1, 1)
    judged = (
        plain.repartition("conv")
        .withColumn("seen", seen)
        .withColumn(
            "fault",
            F.when(~F.col("text").rlike(HAS_WORD), "blank")
            .when(F.col("seen") > 1, "duplicate")
            .when(~last.isin(".", "!", "?"), "truncated"),
        )
    )
    kind = {f.name: f.dataType.simpleString() for f in plain.schema}
    keys = ["turn", "role", "text", "seen"]
    planned = judged.sortWithinPartitions("conv", *(F.col(k).desc() for k in keys)).mapInArrow(
        _planned,
        f"conv {kind['conv']}, turn {kind['turn']}, role string, text string, gone boolean, seen int, fault string, pointer short, cost long",
    )
    ddl = (
        f"conv {kind['conv']}, step long, edit string, turn {kind['turn']}, role string, text string, fault string, "
        "gone boolean, new_role string, cost long"
    )
    shape = rows.sparkSession.createDataFrame([], ddl).schema
    return planned.sortWithinPartitions("conv", *keys).mapInArrow(_replayed(_arrow(shape)), shape)


def _arrow(schema) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


class _Summary:
    """Running figures of one conversation."""

    def __init__(self, conv):
        self.conv, self.faults = conv, {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal = self.cost = self.turns = 0
        self.low = self.high = self.before = None
        self.audit, self.text, self.empty = [], hashlib.sha256(), True

    def add(self, edit, turn, role, text, fault, new_role, cost) -> None:
        if edit != "I":
            if self.before is None:
                self.cost = cost
            elif self.before + role[:1] not in ("su", "ua", "au"):
                self.illegal += 1
            self.before = role[:1]
            if fault:
                self.faults[fault] += 1
            if turn is not None and turn != self.high:
                self.low = turn if self.low is None else self.low
                self.high = turn
                self.turns += 1
        self.audit.append(edit)
        if new_role is not None:
            self.text.update(f"{'' if self.empty else chr(10)}{new_role}:{text}".encode("utf-8", "surrogatepass"))
            self.empty = False

    def row(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        # Insertions before the first row come before its cost is known, but take no part in it.
        return (self.conv, gaps, *self.faults.values(), self.illegal, self.cost, "".join(self.audit), self.text.hexdigest())


def _summed(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None

        def made(done: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)

        for batch in batches:
            done = []
            for r in batch.to_pylist():
                if held is None or r["conv"] != held.conv:
                    if held is not None:
                        done.append(held.row())
                    held = _Summary(r["conv"])
                if not r["gone"]:
                    held.add(r["edit"], r["turn"], r["role"], r["text"], r["fault"], r["new_role"], r["cost"])
            if done:
                yield made(done)
        if held is not None:
            yield made([held.row()])

    return run


def summary(repaired: DataFrame) -> DataFrame:
    """One row per conversation of edits(): faults, cost, the edits' initials, and a hash of the repaired turns.

    ``gaps`` are the turn numbers missing between the first and the last;
    ``illegal`` counts neighbours whose roles' initials are not su, ua or au;
    ``repaired_sha256`` is of ``role:text``, a line each. Apply it to the result
    of edits() as it stands: it takes the rows in the order they are in, and
    holds the figures of one conversation and its initials.
    """
    kind = repaired.schema["conv"].dataType.simpleString()
    ddl = (
        f"conv {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
        "repaired_sha256 string"
    )
    shape = repaired.sparkSession.createDataFrame([], ddl).schema
    return repaired.mapInArrow(_summed(_arrow(shape)), shape)
