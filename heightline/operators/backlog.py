"""Work that waits: pending, stale, oldest first, and how much of it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import stream_id_millis, stream_id_seq


def pending(delivered: DataFrame, acked: DataFrame, id_col: str = "id") -> DataFrame:
    """Delivered entries that were not acknowledged."""
    return delivered.join(acked.select(id_col).distinct(), id_col, "left_anti")


def reclaim_stale(
    waiting: DataFrame, delivered_at: str, now_ms: int, min_idle_ms: int, consumer: str
) -> DataFrame:
    """Pending entries idle for at least ``min_idle_ms``, given to ``consumer``."""
    idle = F.lit(now_ms) - F.col(delivered_at)
    return (
        waiting.filter(F.col(delivered_at) <= F.lit(now_ms - min_idle_ms))
        .withColumn("idle_ms", idle)
        .withColumn("claimed_by", F.lit(consumer))
    )


def with_id_parts(df: DataFrame, id_col: str = "id") -> DataFrame:
    return df.withColumn("id_ms", stream_id_millis(F.col(id_col))).withColumn(
        "id_seq", stream_id_seq(F.col(id_col))
    )


def oldest(df: DataFrame, n: int, id_col: str = "id") -> DataFrame:
    """The first ``n`` entries by id; ids that cannot be read come last."""
    ordered = [F.col(c).asc_nulls_last() for c in ("id_ms", "id_seq")]
    return with_id_parts(df, id_col).orderBy(*ordered).limit(n)


def page_after(df: DataFrame, cursor: str, n: int, id_col: str = "id") -> DataFrame:
    """The next ``n`` entries after the id ``cursor``."""
    ms, _, seq = cursor.partition("-")
    after = (F.col("id_ms") > F.lit(int(ms))) | (
        (F.col("id_ms") == F.lit(int(ms))) & (F.col("id_seq") > F.lit(int(seq or 0)))
    )
    return with_id_parts(df, id_col).filter(after).orderBy("id_ms", "id_seq").limit(n)


def work_list(phases: list[tuple[str, DataFrame]], id_col: str = "id") -> DataFrame:
    """Entries of all phases, each kept once in the earliest phase that has it."""
    parts = [
        df.select(id_col).withColumn("_turn", F.lit(turn))
        for turn, (_, df) in enumerate(phases)
    ]
    merged = reduce(DataFrame.unionByName, parts)
    names = F.array(*[F.lit(name) for name, _ in phases])
    return (
        merged.groupBy(id_col)
        .agg(F.min("_turn").alias("_turn"))
        .select(id_col, F.element_at(names, F.col("_turn") + 1).alias("phase"))
    )


# What is known of an entry, a bit each.
DELIVERED, ACKED, OWN, STALE, NEW = (1 << i for i in range(5))


def entry_states(events: DataFrame, flags: dict[int, Column], id_col: str = "id") -> DataFrame:
    """(id, state): the bits that any row of an entry sets.

    Deliveries, acknowledgements and arrivals are rows of one table, or a union
    of several; one aggregation that combines before the shuffle takes the place
    of joins between them. A NULL flag is not set.
    """
    bits = [F.when(flag, F.lit(bit)).otherwise(0) for bit, flag in flags.items()]
    return (
        events.select(id_col, reduce(lambda a, b: a.bitwiseOR(b), bits).alias("_bits"))
        .groupBy(id_col)
        .agg(F.bit_or("_bits").alias("state"))
    )


def phases(states: DataFrame, id_col: str = "id") -> DataFrame:
    """Entries with work left: own pending ones, then stale ones of anybody, then new ones."""
    state = F.col("state")

    def has(bit: int) -> Column:
        return state.bitwiseAND(F.lit(bit)) != 0

    waits = has(DELIVERED) & ~has(ACKED)
    phase = (
        F.when(waits & has(OWN), "pending").when(waits & has(STALE), "reclaimed").when(has(NEW) & ~has(ACKED), "new")
    )
    return states.select(id_col, phase.alias("phase")).filter(F.col("phase").isNotNull())


def backlog_summary(
    entries: DataFrame, delivered: Column, acked: Column, now_ms: int, by: list[str] | None = None,
    id_col: str = "id",
) -> DataFrame:
    """Length, pending count, age of the oldest pending entry and lag, in one pass."""
    waits = delivered & ~acked
    oldest_ms = F.min(F.when(waits, stream_id_millis(F.col(id_col))))
    age = F.greatest(F.lit(0).cast("bigint"), F.lit(now_ms) - oldest_ms)
    return entries.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("stream_length"),
        F.count_if(waits).alias("pending"),
        F.coalesce(age, F.lit(0).cast("bigint")).alias("oldest_pending_age_ms"),
        F.count_if(~delivered).alias("lag"),
    )
