"""Following new heads: the heights each micro-batch brings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.heights import explode_heights, finalized_head
from ..operators.ordered import by_value
from ..sources.epochs import EpochTable


def _tables(spark, path: str, chain_type: T.DataType) -> tuple[EpochTable, EpochTable]:
    heights = T.StructType(
        [T.StructField("chain", chain_type), T.StructField("height", T.LongType())]
    )
    marks = T.StructType([T.StructField("chain", chain_type), T.StructField("last", T.LongType())])
    return (
        EpochTable(spark, f"{path}/heights", heights),
        EpochTable(spark, f"{path}/marks", marks),
    )


def new_heights(batch: DataFrame, marks: DataFrame, number: Column, first: Column) -> DataFrame:
    """Low and high due height of each chain in a batch of heads.

    Only a chain's highest head, and its first one if the chain is new, decide
    what is due, so a batch shrinks to one row per chain before any join.
    Result: chain, last (NULL when new), low, high.
    """
    tops = batch.groupBy("chain").agg(
        F.max(number).alias("high"), F.min_by(number, first).alias("first")
    )
    known = marks.select(F.col("chain").alias("_chain"), "last")
    return (
        # NULL is a chain like any other.
        tops.join(known, F.col("chain").eqNullSafe(F.col("_chain")), "left")
        .drop("_chain")
        .withColumn("low", F.coalesce(F.col("last") + 1, F.col("first")))
    )


def _advance(
    path: str, number: Column, order: Column, on_heights: Callable[[DataFrame, int], None] | None
) -> Callable[[DataFrame, int], None]:
    def step(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        heights, marks = _tables(spark, path, batch.schema["chain"].dataType)
        known = marks.epoch(epoch - 1)
        due = by_value(new_heights(batch.filter(number.isNotNull()), known, number, order))
        heights.write(explode_heights(due, F.col("low"), F.col("high"), "height"), epoch)
        if on_heights is not None:
            on_heights(heights.epoch(epoch), epoch)
        # The marks move only after the heights are written and handled. Each
        # epoch holds all chains, so the next one reads one small folder.
        moved = (
            known.unionByName(due.select("chain", F.col("high").alias("last")))
            .groupBy("chain")
            .agg(F.max("last").alias("last"))
        )
        marks.write(moved, epoch)

    return step


def follow_heads(
    heads: DataFrame,
    path: str,
    checkpoint: str,
    order: Column,
    on_heights: Callable[[DataFrame, int], None] | None = None,
    **trigger,
) -> StreamingQuery:
    """Write the heights due after each batch of heads (chain, number).

    Unlike a follower that keeps its place in memory, a restart goes on from the
    last mark and leaves no gap.
    """
    return (
        heads.writeStream.foreachBatch(_advance(path, F.col("number"), order, on_heights))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def follow_finalized(
    polls: DataFrame,
    path: str,
    checkpoint: str,
    order: Column,
    confirmations: int,
    on_heights: Callable[[DataFrame, int], None] | None = None,
    **trigger,
) -> StreamingQuery:
    """Write newly finalized heights after each batch of polls (chain, tag, latest).

    ``availableNow`` drains what is there and stops; ``processingTime`` polls
    with a delay.
    """
    finalized = finalized_head(F.col("tag"), F.col("latest"), confirmations)
    return (
        polls.withColumn("number", finalized)
        .writeStream.foreachBatch(_advance(path, F.col("number"), order, on_heights))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def written_heights(spark, path: str, chain_type: T.DataType = T.StringType()) -> DataFrame:
    return _tables(spark, path, chain_type)[0].rows()


def written_marks(spark, path: str, epoch: int, chain_type: T.DataType = T.StringType()) -> DataFrame:
    return _tables(spark, path, chain_type)[1].epoch(epoch)
