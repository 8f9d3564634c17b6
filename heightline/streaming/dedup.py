"""Deduplication of a stream under a strict time-to-live.

``dedup_ttl_batches`` is for large micro-batches and hot keys: the accepted rows
are the state, and each batch uses the batch operator, which splits large keys.
``dedup_ttl_state`` keeps a value per key in the state store instead, for small
and frequent micro-batches.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import StorageLevel, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators.dedup import dedup_ttl
from ..operators.ordered import SMALL_KEY_ROWS, with_known
from ..sources.epochs import EpochTable
from ..sources.ledger import Ledger
from .publish import SLOTS_PER_TTL


def accept_batch(
    batch: DataFrame,
    accepted: EpochTable,
    epoch: int,
    key: str,
    at: str,
    ttl: int,
    tie: Sequence[str],
    floor: int = SMALL_KEY_ROWS,
) -> None:
    """Append the rows of a batch that no live accepted row of their key precedes.

    The accepted rows of a batch are one write, which replaces its epoch; the
    last one of each key then goes to a ledger beside them, of which the next
    batch reads the live slots in its own keys' buckets. A batch that fails
    before the ledger is run again, and finds the state it found before. NULL is
    a key like any other.
    """
    spark = batch.sparkSession
    kind = batch.schema[key].dataType
    marks = T.StructType([T.StructField("key", kind), T.StructField("last", T.LongType())])
    state = Ledger(spark, f"{accepted.path}/_state", marks, "key", "last", slot=max(1, ttl // SLOTS_PER_TTL))
    batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        first = batch.agg(F.min(at).alias("first")).first()["first"]
        if first is None:
            accepted.write(batch, epoch)
        else:
            asked = batch.select(F.col(key).alias("key")).distinct()
            live = state.rows(before=epoch, since=first - ttl, keys=asked)
            # A struct equals another where both hold NULL, which bare keys do not.
            last = live.groupBy(F.struct("key").alias("_of")).agg(F.max("last").alias("_last"))
            named = batch.withColumn("_of", F.struct(F.col(key).alias("key")))
            # All rows before the carried time runs out are repeats; what is left
            # starts afresh.
            free = with_known(named, last, "_of", "left", floor).filter(
                F.col("_last").isNull() | (F.col(at) >= F.col("_last") + ttl)
            )
            kept = dedup_ttl(free.select(*batch.columns), key, at, ttl, tie, floor)
            accepted.write(kept, epoch)
    finally:
        batch.unpersist()
    written = accepted.epoch(epoch).groupBy(F.col(key).alias("key")).agg(F.max(at).alias("last"))
    # What has expired for this batch may be live for a late one: two lives are kept.
    state.write(written, epoch, None if first is None else first - 2 * ttl)


def dedup_ttl_batches(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    key: str,
    at: str,
    ttl: int,
    tie: Sequence[str],
    floor: int = SMALL_KEY_ROWS,
    **trigger,
) -> StreamingQuery:
    """Write the accepted rows of a stream to an ``EpochTable`` at ``path``.

    ``at`` is a BIGINT time in the unit of ``ttl``. A row that comes late counts
    as a repeat unless it is past the key's last accepted row by ``ttl``.
    """
    accepted = EpochTable(stream.sparkSession, path, stream.schema)

    def step(batch: DataFrame, epoch: int) -> None:
        accept_batch(batch, accepted, epoch, key, at, ttl, tie, floor)

    return (
        stream.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


# As in the batch operator: workers need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _acceptor(at: str, ttl: int, tie: Sequence[str], keep_ms: int | None, columns: list[str]):
    class Acceptor(StatefulProcessor):
        """Keeps the time of a key's last accepted row."""

        def init(self, handle: StatefulProcessorHandle) -> None:
            self.last = handle.getValueState("last", "accepted long", keep_ms)

        def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
            frame = pd.concat(list(rows), ignore_index=True).sort_values([at, *tie], kind="stable", ignore_index=True)
            times = frame[at].to_numpy()
            accepted = self.last.get()[0] if self.last.exists() else None
            keep: list[int] = []
            i = 0 if accepted is None else int(np.searchsorted(times, accepted + ttl))
            while i < len(times):
                keep.append(i)
                accepted = int(times[i])
                i = int(np.searchsorted(times, accepted + ttl))
            if keep:
                self.last.update((accepted,))
                yield frame.iloc[keep][columns]

        def close(self) -> None:
            pass

    return Acceptor()


def dedup_ttl_state(
    stream: DataFrame, key: str, at: str, ttl: int, tie: Sequence[str], keep_ms: int | None = None
) -> DataFrame:
    """State store form of ``operators.dedup.dedup_ttl``.

    ``at`` is a BIGINT time in the unit of ``ttl``, and no column but it and
    ``tie`` is looked at. The state of a key is one number, the time of its last
    accepted row. There is no watermark, so no row is lost for being late: like
    in ``dedup_ttl_batches`` it is a repeat unless it is past the key's last
    accepted row by ``ttl``. ``keep_ms`` lets go of the state of keys that have
    accepted no row for so long on the clock of the cluster; it has to cover the
    TTL and any standstill of the stream. By default state stays.

    NULL is a key like any other. The rows of one key and micro-batch are put in
    order in one task, so the source's batch limit has to be one that a task can
    hold; ``dedup_ttl_batches`` has no such bound. Needs the RocksDB state store.
    """
    # The state store does not group by NULL itself.
    grouped = stream.withColumn("_of", F.struct(F.col(key).alias("k"))).groupBy("_of")
    return grouped.transformWithStateInPandas(
        _acceptor(at, ttl, tie, keep_ms, stream.columns), stream.schema, "append", "none" if keep_ms is None else "processingTime"
    )
