"""Harmonic packing of tokenised documents into sequences."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tokens import BYTE_BPE, ByteBpe

CAPACITY = 1024
END = 0
# Pieces of at least this size have a length that divides the capacity.
SMALLEST_CUT = 64

# A piece: its document (id and number of tokens), first token, ids.
Piece = tuple[tuple, int, np.ndarray]


def cut(ids: np.ndarray, capacity: int = CAPACITY, smallest: int = SMALLEST_CUT) -> Iterator[tuple[int, int]]:
    """(start, length) of a document's pieces: full sequences, then halves, quarters ... then the rest."""
    at, left = 0, len(ids)
    size = capacity
    while left and size >= smallest:
        while left >= size:
            yield at, size
            at, left = at + size, left - size
        size //= 2
    if left:
        yield at, left


class Harmonic:
    """Bins of one worker.

    A piece longer than capacity / (k + 1) and no longer than capacity / k is of
    class k. Each class fills bins of its own with exactly k pieces, whatever
    they are; a bin that has them leaves. So at most k - 1 pieces of a class
    wait, and the bins of two workers never meet.
    """

    def __init__(self, capacity: int = CAPACITY):
        self.capacity = capacity
        self.waiting: dict[int, list[Piece]] = defaultdict(list)

    def add(self, piece: Piece) -> list[Piece] | None:
        """The bin that ``piece`` fills, if it does."""
        k = self.capacity // len(piece[2])
        bin_ = self.waiting[k]
        bin_.append(piece)
        if len(bin_) < k:
            return None
        del self.waiting[k]
        return bin_

    def rest(self) -> Iterator[list[Piece]]:
        """What waits at the end, as one run of tokens cut at the capacity; its tail is cut to powers of two."""
        run = [p for k in sorted(self.waiting) for p in self.waiting[k]]
        self.waiting.clear()
        left = sum(len(p[2]) for p in run)
        room = size = self._room(left)
        bin_: list[Piece] = []
        while run:
            doc, start, ids = run.pop(0)
            bin_.append((doc, start, ids[:room]))
            if len(ids) > room:
                run.insert(0, (doc, start + room, ids[room:]))
            room -= len(bin_[-1][2])
            if not room:
                yield bin_
                left -= size
                bin_, room = [], self._room(left)
                size = room

    def _room(self, left: int) -> int:
        return self.capacity if left >= self.capacity else 1 << max(left.bit_length() - 1, 0)


def _pack(batches: Iterable[pa.RecordBatch], kind: pa.DataType, tokenizer: str, capacity: int) -> Iterator[pa.RecordBatch]:
    coder = ByteBpe(tokenizer)
    harmonic = Harmonic(capacity)
    # Unique over the table: the worker's partition, then its own count.
    sequence = TaskContext.get().partitionId() << 36
    names = ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    rows: list[tuple] = []
    held = 0

    def place(bin_: list) -> None:
        nonlocal sequence, held
        offset = 0
        for (doc, total), start, ids in bin_:
            rows.append((doc, start, len(ids), ids.tobytes(), total, sequence, offset))
            offset += len(ids)
        sequence += 1
        held += offset

    def flush() -> pa.RecordBatch:
        nonlocal held
        columns = list(zip(*rows)) if rows else [[]] * 7
        kinds = [kind, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        rows.clear()
        held = 0
        return pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(columns, kinds)], names=names)

    for batch in batches:
        for doc, text in zip(batch.column(0), batch.column(1)):
            ids = np.append(coder.encode(text.as_py() or ""), np.uint32(END)).astype("<u4")
            label = (doc.as_py(), len(ids))
            for start, length in cut(ids, capacity):
                full = harmonic.add((label, start, ids[start : start + length]))
                if full:
                    place(full)
            if held >= 1 << 20:
                yield flush()
    for bin_ in harmonic.rest():
        place(bin_)
    yield flush()


def pack(
    docs: DataFrame, id: str = "doc_id", text: str = "text", tokenizer: str = BYTE_BPE, capacity: int = CAPACITY
) -> DataFrame:
    """One row per piece: id, start, length, ids (BINARY, little-endian 32 bits), doc_tokens, sequence_id, offset.

    A document is its tokens and an end token (id 0). Cut to lengths that divide
    the capacity, its pieces but the last (under 64 tokens) fill bins of their
    harmonic class without a gap; a bin of last pieces, k of class k, leaves
    under 1 / (k + 1) of itself free, k being 16 or more. What a worker has left
    over at its end is one run of tokens, at most a bin per class, whose tail is
    cut to powers of two. Workers share nothing, and there is no shuffle.

    A sequence is padded to the capacity, but not if its length is a power of two.

    * NULL and empty texts are the end token alone. NULL ids are kept.
    * Rows that share an id are documents of their own: so are their pieces.
    * Other columns are not read. An empty table gives an empty table.
    * ``tokenizer`` is a path that executors can read.
    """
    source = docs.select(F.col(id).alias("id"), F.col(text).cast("string").alias("text"))
    schema = T.StructType(
        [
            T.StructField("id", source.schema["id"].dataType),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids", T.BinaryType()),
            T.StructField("doc_tokens", T.LongType()),
            T.StructField("sequence_id", T.LongType()),
            T.StructField("offset", T.LongType()),
        ]
    )

    def run(batches):
        first = next(batches, None)
        if first is not None:
            yield from _pack(chain([first], batches), first.schema.field(0).type, tokenizer, capacity)

    return source.mapInArrow(run, schema).withColumnRenamed("id", id)

