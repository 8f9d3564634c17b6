"""Chat formatting at the level of tokens."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import BYTE_BPE, ByteBpe

# Reserved ids above the vocabulary, and the control strings they stand for.
VOCABULARY = 50_257
OPEN, BREAK, CLOSE = VOCABULARY, VOCABULARY + 1, VOCABULARY + 2
CONTROL = {OPEN: "### ", BREAK: ": ", CLOSE: "</turn>\n"}
LEARNED_ROLE = "assistant"

_ESCAPED = re.compile(r"\\|###|</turn>")
_ROLE_ESCAPED = re.compile(r"\\|###|</turn>|:")
_UNESCAPED = re.compile(r"\\(\\|###|</turn>|:)")


def escape(text: str) -> str:
    """A text with a backslash before each control string and each backslash in it."""
    return _ESCAPED.sub(lambda m: "\\" + m.group(), text)


def escape_role(role: str) -> str:
    return _ROLE_ESCAPED.sub(lambda m: "\\" + m.group(), role)


def unescape(text: str) -> str:
    return _UNESCAPED.sub(r"\1", text)


def assemble(role: str, text: str, coder: ByteBpe) -> tuple[np.ndarray, np.ndarray]:
    """(ids, mask) of a turn: reserved ids around the tokens of role and text, each encoded by itself.

    The mask is the running sum of +1 where learned tokens begin and -1 where they end.
    """
    name = coder.encode_ordinary(escape_role(role))
    body = coder.encode_ordinary(escape(text))
    ids = np.concatenate([[OPEN], name, [BREAK], body, [CLOSE]]).astype("<u4")
    steps = np.zeros(len(ids) + 1, dtype=np.int8)
    if role == LEARNED_ROLE:
        begin = 2 + len(name)
        steps[begin] += 1
        steps[begin + len(body)] -= 1
    return ids, np.cumsum(steps[:-1], dtype=np.int8)


def formatted(ids: np.ndarray, coder: ByteBpe) -> str:
    """The text that ids stand for, control strings included."""
    out, at = [], 0
    for place in np.flatnonzero(ids >= VOCABULARY):
        out += [coder.decode(ids[at:place]), CONTROL[int(ids[place])]]
        at = place + 1
    return "".join(out) + coder.decode(ids[at:])


def parse(ids: np.ndarray, coder: ByteBpe) -> list[tuple[str, str]]:
    """(role, text) of the turns that ids hold."""
    turns = []
    opens, breaks, closes = (np.flatnonzero(ids == mark) for mark in (OPEN, BREAK, CLOSE))
    for a, b, c in zip(opens, breaks, closes, strict=True):
        turns.append((unescape(coder.decode(ids[a + 1 : b])), unescape(coder.decode(ids[b + 1 : c]))))
    return turns


_FIELDS = "id {kind}, turn {turn}, start long, ids binary, mask binary"


def format_turns(
    conversations: DataFrame,
    id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    tokenizer: str = BYTE_BPE,
) -> DataFrame:
    """One row per turn: id, turn, start, ids (BINARY, little-endian 32 bits) and mask (BINARY, a byte per id).

    A conversation is the ids of its rows one after the other, by turn (then
    role and text); ``start`` is the number of ids before the row. Rows stay
    rows, so a conversation of any length passes through its task one turn at a
    time. Control strings inside roles and texts are escaped, and segments are
    encoded apart, so that no token crosses their borders.

    * NULL roles and texts count as empty. NULL turns come first. Rows alike in
      all columns are turns of their own; rows of a NULL id are one conversation.
    * The result keeps the rows of a conversation together and in order.
    """
    rows = conversations.select(
        F.col(id).alias("id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    kinds = dict(rows.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = ByteBpe(tokenizer)
        current, start = object(), 0
        for batch in batches:
            starts, ids, masks = [], [], []
            for conv, who, said in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                if conv != current:
                    current, start = conv, 0
                turn_ids, mask = assemble(who, said, coder)
                starts.append(start)
                ids.append(turn_ids.tobytes())
                masks.append(mask.tobytes())
                start += len(turn_ids)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(starts, pa.int64()), pa.array(ids, pa.binary()), pa.array(masks, pa.binary())],
                names=["id", "turn", "start", "ids", "mask"],
            )

    together = rows.repartition("id").sortWithinPartitions("id", "turn", "role", "text")
    return together.mapInArrow(run, _FIELDS.format(kind=kinds["id"], turn=kinds["turn"]))


def digest(turns: DataFrame, tokenizer: str = BYTE_BPE) -> DataFrame:
    """What can be read back from format_turns(), one row per conversation.

    id, n_turns, turns_sha256 (of role, newline, text, newline per turn),
    loss_chars and loss_sha256 (of the unescaped text under the mask),
    formatted_chars. Rows are read in their order, hashes run on.
    """
    kind = dict(turns.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = ByteBpe(tokenizer)
        state = None
        for batch in batches:
            done = []
            for conv, start, ids, mask in zip(batch.column(0).to_pylist(), *(batch.column(i).to_pylist() for i in (2, 3, 4))):
                if start == 0:
                    if state:
                        done.append(state)
                    state = _State(conv)
                state.add(np.frombuffer(ids, "<u4"), np.frombuffer(mask, np.int8), coder)
            yield _finished(done, batch.schema.field(0).type)
        if state:
            yield _finished([state], batch.schema.field(0).type)

    return turns.mapInArrow(
        run,
        f"id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )


class _State:
    def __init__(self, conv):
        self.conv = conv
        self.turns = self.loss_chars = self.chars = 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, ids: np.ndarray, mask: np.ndarray, coder: ByteBpe) -> None:
        for role, text in parse(ids, coder):
            self.turns += 1
            self.all.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
        learned = unescape(coder.decode(ids[mask == 1]))
        self.loss_chars += len(learned)
        self.loss.update(learned.encode("utf-8", "surrogatepass"))
        self.chars += len(formatted(ids, coder))


def _finished(states: list[_State], kind: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array([s.conv for s in states], kind),
            pa.array([s.turns for s in states], pa.int64()),
            pa.array([s.all.hexdigest() for s in states], pa.string()),
            pa.array([s.loss_chars for s in states], pa.int64()),
            pa.array([s.loss.hexdigest() for s in states], pa.string()),
            pa.array([s.chars for s in states], pa.int64()),
        ],
        names=["id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
    )
