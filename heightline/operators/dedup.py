"""Keeping one row per key, for good or for a time."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ordered import CHUNK, SMALL_KEY_ROWS, large_keys, ordered_chunks, running_max

_CARRY = "_carry"

# Functions of this module travel to the workers whole, so that workers need
# not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _top_row(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    # A rank filter of 1 is also applied before the shuffle, so a hot key sends
    # one row per map task.
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") == 1).drop("_rank")


def first_arrival(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key in ``order``."""
    return _top_row(df, keys, [F.col(c).asc() for c in order])


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest row of each key, as a compacted topic would keep it."""
    return _top_row(df, keys, [F.col(c).desc() for c in order])


# --- dedup with a strict time-to-live -------------------------------------


def _runs(*columns: pa.Array) -> list[tuple[int, int]]:
    """Start and end of each run of rows equal in all columns; NULL equals NULL."""
    n = len(columns[0])
    if n == 0:
        return []
    changed = np.zeros(n - 1, dtype=bool)
    for column in columns:
        step = pc.fill_null(pc.not_equal(column.slice(1), column.slice(0, n - 1)), False)
        changed |= step.to_numpy(zero_copy_only=False)
        null = column.is_null().to_numpy(zero_copy_only=False)
        changed |= null[1:] != null[:-1]
    edges = [0, *(np.flatnonzero(changed) + 1).tolist(), n]
    return list(zip(edges[:-1], edges[1:]))


def _column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def _accept_rows(key: str, at: str, ttl: int, columns: list[str], carried: bool):
    """Filter sorted batches to accepted rows, holding one key's last accepted time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, accepted = None, None
        for batch in batches:
            keys, times = _column(batch, key), _column(batch, at).to_numpy(zero_copy_only=False)
            carries = _column(batch, _CARRY) if carried else None
            parts = [keys, _column(batch, CHUNK)] if carried else [keys]
            keep: list[int] = []
            for start, end in _runs(*parts):
                name = [p[start].as_py() for p in parts]
                if name != current:
                    current = name
                    accepted = carries[start].as_py() if carried else None
                at_run = times[start:end]
                i = 0 if accepted is None else int(np.searchsorted(at_run, accepted + ttl))
                # Where each row would hand over, worked out for the run at once.
                hop = np.searchsorted(at_run, at_run + ttl).tolist()
                while i < len(hop):
                    keep.append(start + i)
                    accepted = int(at_run[i])
                    i = hop[i]
            if keep:
                yield batch.take(pa.array(keep, pa.int64())).select(columns)

    return run


def _last_reached(times: np.ndarray, ttl: int) -> np.ndarray:
    """For each row, the last row accepted in this run if that row is accepted."""
    n = len(times)
    hop = np.append(np.searchsorted(times, times + ttl), n)
    last = np.arange(n + 1)
    # Double the hop length until every chain has left the run.
    while True:
        moving = hop[:n] < n
        if not moving.any():
            return last[:n]
        rows = np.flatnonzero(moving)
        new_last, new_hop = last.copy(), hop.copy()
        new_last[rows] = last[hop[rows]]
        new_hop[rows] = hop[hop[rows]]
        last, hop = new_last, new_hop


def _summarise_run(times: np.ndarray, ttl: int) -> tuple[np.ndarray, np.ndarray]:
    """How a run turns the time carried in into the time carried out.

    Returns (upto, leaves), ``upto`` rising: a carried time leaves the run as the
    ``leaves`` of the first ``upto`` that its expiry does not exceed. Only rows in
    the first ttl can be where a carried time lands, and neighbours with one
    outcome are merged.
    """
    reach = min(int(np.searchsorted(times, times[0] + ttl)) + 1, len(times))
    leaves = times[_last_reached(times, ttl)][:reach]
    ends = np.append(np.flatnonzero(leaves[1:] != leaves[:-1]), reach - 1)
    return times[:reach][ends], leaves[ends]


def _summaries(key: str, at: str, ttl: int, schema: pa.Schema):
    """One task's rows (bounded by the chunk) reduced to outcome steps per key."""

    def emit(name, chunk: int, parts: list[np.ndarray]) -> pa.RecordBatch:
        upto, leaves = _summarise_run(np.concatenate(parts), ttl)
        n = len(upto)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([name] * n, schema.field(0).type),
                pa.array(np.full(n, chunk, dtype=np.int32)),
                pa.array(upto),
                pa.array(leaves),
            ],
            schema=schema,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, parts = None, []
        for batch in batches:
            keys, times = _column(batch, key), _column(batch, at).to_numpy(zero_copy_only=False)
            chunks = _column(batch, CHUNK)
            for start, end in _runs(keys):
                name = (keys[start].as_py(), chunks[start].as_py())
                if held is not None and name != held:
                    yield emit(*held, parts)
                    parts = []
                held = name
                parts.append(times[start:end])
        if held is not None:
            yield emit(*held, parts)

    return run


def _arrow_schema(fields: list[T.StructField]) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(T.StructType(fields))


def _same(key: str, *names: tuple[str, str]) -> Column:
    """Join condition: the key, where NULL equals NULL, and pairs of columns that are never NULL."""
    same = F.col(key).eqNullSafe(F.col("_key"))
    for left, right in names:
        same = same & (F.col(left) == F.col(right))
    return same


def _next_steps(steps: DataFrame, key: str, ttl: int, floor: int) -> DataFrame:
    """(key, chunk, leaf, to_chunk, to_leaf): where a time carried out of a chunk leads next.

    The step that a time meets is the first one, in all later chunks of its key,
    that its expiry does not exceed. Steps and expiries are put in one order from
    the latest to the earliest; the last step seen is a running maximum, which
    cuts large keys itself. Times that meet no step have no row.
    """
    # Chunks of the steps have a name of their own: the running maximum cuts chunks too.
    met = steps.select(
        key,
        (-F.col("upto")).alias("back"),
        F.lit(0).alias("asks"),
        F.col(CHUNK).alias("chunk"),
        F.struct((-F.col("upto")).alias("back"), (-F.col(CHUNK)).alias("chunk"), F.col("leaves").alias("leaf")).alias("step"),
        F.lit(None).cast("bigint").alias("leaf"),
    )
    asked = steps.select(key, F.col(CHUNK).alias("chunk"), F.col("leaves").alias("leaf")).distinct()
    none = F.lit(None).cast(met.schema["step"].dataType)
    asked = asked.select(
        key, (-(F.col("leaf") + ttl)).alias("back"), F.lit(1).alias("asks"), "chunk", none.alias("step"), "leaf"
    )
    seen = running_max(
        met.unionByName(asked), [key], ["back", "asks", "chunk", "leaf"], F.col("step"), "next", include_current=True, floor=floor
    )
    return seen.filter((F.col("asks") == 1) & F.col("next").isNotNull()).select(
        key, "chunk", "leaf", (-F.col("next.chunk")).alias("to_chunk"), F.col("next.leaf").alias("to_leaf")
    )


def _carried_times(steps: DataFrame, key: str, ttl: int, floor: int) -> DataFrame:
    """(_key, _in, _carry): the accepted time that each chunk of a key begins with, NULL for none.

    Steps are links from a time carried out of a chunk to the one carried out of
    the next chunk where a row is accepted. Links are doubled until none is left
    (up), and the chain of the key's first row is then filled in from the longest
    links to the shortest (down): rounds grow with the logarithm of the chunks,
    and each is a join on single links, however dense the key.
    """
    starts = (
        steps.groupBy(key)
        .agg(F.min(F.struct(CHUNK, "upto", "leaves")).alias("first"))
        .select(key, F.col(f"first.{CHUNK}").alias("chunk"), F.col("first.leaves").alias("leaf"))
        .checkpoint(eager=True)
    )
    links = _next_steps(steps, key, ttl, floor).checkpoint(eager=True)
    # Only what something leads to can be on the chain.
    targets = links.select(key, F.col("to_chunk").alias("chunk"), F.col("to_leaf").alias("leaf")).unionByName(starts).distinct()
    ends = targets.select(F.col(key).alias("_key"), F.col("chunk").alias("_in_chunk"), F.col("leaf").alias("_leaf"))
    links = links.join(ends, _same(key, ("chunk", "_in_chunk"), ("leaf", "_leaf")), "left_semi").checkpoint(eager=True)
    doubled = []
    while not links.isEmpty():
        doubled.append(links)
        onward = links.select(
            F.col(key).alias("_key"),
            F.col("chunk").alias("_in_chunk"),
            F.col("leaf").alias("_leaf"),
            F.col("to_chunk").alias("_to_in_chunk"),
            F.col("to_leaf").alias("_to_leaf"),
        )
        links = (
            links.join(onward, _same(key, ("to_chunk", "_in_chunk"), ("to_leaf", "_leaf")))
            .select(key, "chunk", "leaf", F.col("_to_in_chunk").alias("to_chunk"), F.col("_to_leaf").alias("to_leaf"))
            .checkpoint(eager=True)
        )
    chain = starts
    for links in reversed(doubled):
        at = chain.select(F.col(key).alias("_key"), F.col("chunk").alias("_in_chunk"), F.col("leaf").alias("_leaf"))
        further = links.join(at, _same(key, ("chunk", "_in_chunk"), ("leaf", "_leaf")), "left_semi")
        chain = chain.unionByName(
            further.select(key, F.col("to_chunk").alias("chunk"), F.col("to_leaf").alias("leaf"))
        ).checkpoint(eager=True)
    # One row per key and chunk from here on; a chunk that accepts no row hands on what it got.
    found = chain.select(F.col(key).alias("_key"), F.col("chunk").alias("_in_chunk"), "leaf")
    earlier = Window.partitionBy(key).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    return (
        steps.select(key, CHUNK)
        .distinct()
        .join(found, _same(key, (CHUNK, "_in_chunk")), "left")
        .select(F.col(key).alias("_key"), F.col(CHUNK).alias("_in"), F.max("leaf").over(earlier).alias(_CARRY))
    )


def _split_key_dedup(df: DataFrame, key: str, at: str, ttl: int, tie: Sequence[str], floor: int) -> DataFrame:
    """Exact dedup of keys that are cut over several tasks."""
    columns = df.columns
    chunks = ordered_chunks(df, [key], [at, *tie])
    step_type = T.StructType(
        [
            T.StructField(key, df.schema[key].dataType),
            T.StructField(CHUNK, T.IntegerType()),
            T.StructField("upto", T.LongType()),
            T.StructField("leaves", T.LongType()),
        ]
    )
    steps = (
        chunks.select(key, at, CHUNK)
        .mapInArrow(_summaries(key, at, ttl, _arrow_schema(step_type.fields)), step_type)
        .checkpoint(eager=True)
    )
    carried = _carried_times(steps, key, ttl, floor)
    # One row per key and chunk. The sort makes the result right whichever join
    # is picked; a broadcast join keeps the layout and the sort is a no-op.
    return (
        chunks.join(carried, _same(key, (CHUNK, "_in")), "left")
        .sortWithinPartitions(key, CHUNK, at, *tie)
        .select(*columns, CHUNK, _CARRY)
        .mapInArrow(_accept_rows(key, at, ttl, columns, carried=True), df.schema)
    )


def dedup_ttl(
    df: DataFrame,
    key: str,
    at: str,
    ttl: int,
    tie: Sequence[str],
    floor: int = SMALL_KEY_ROWS,
) -> DataFrame:
    """Accept a row when no accepted row of its key is younger than ``ttl``.

    The time counts from the last *accepted* row, so a rejected repeat does not
    extend it, and a row exactly ``ttl`` later is accepted. ``at`` is a BIGINT
    time in the unit of ``ttl``; ``tie`` orders rows of equal time and should
    end in a unique column. NULL is a key like any other.

    Rows stream through each task with one carried time per key. Keys of more
    than ``floor`` rows are cut into chunks (see ``ordered``); what a chunk does to
    any time carried in is worked out in its task, and the times really carried
    follow from joins of such steps.
    """
    accept = _accept_rows(key, at, ttl, df.columns, carried=False)
    large = large_keys(df, key, floor, with_null=True)
    if large is not None:
        large = large.withColumnRenamed(key, "_large")
        is_large = F.col(key).eqNullSafe(F.col("_large"))
    small = df if large is None else df.join(large, is_large, "left_anti")
    result = (
        small.select(*df.columns)
        .repartition(key)
        .sortWithinPartitions(key, at, *tie)
        .mapInArrow(accept, df.schema)
    )
    if large is None:
        return result
    hot = df.join(large, is_large, "left_semi").select(*df.columns)
    return result.unionByName(_split_key_dedup(hot, key, at, ttl, tie, floor))
