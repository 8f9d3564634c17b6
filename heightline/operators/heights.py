"""Which block heights are due: gaps, finality and progress."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import SMALL_KEY_ROWS, running_max

# Long ranges are first cut into blocks of this many heights.
RANGE_BLOCK = 100_000


def explode_heights(df: DataFrame, low: Column, high: Column, out: str) -> DataFrame:
    """One row per height from ``low`` to ``high``; none where high < low.

    Ranges are cut into blocks that are dealt out evenly over the cluster, so
    that one long gap does not become the work of one task.
    """
    block = F.lit(RANGE_BLOCK).cast("bigint")
    ranges = (
        df.withColumn("_low", low.cast("bigint"))
        .withColumn("_high", high.cast("bigint"))
        .filter(F.col("_low") <= F.col("_high"))
    )
    return (
        ranges.withColumn("_from", F.explode(F.sequence(F.col("_low"), F.col("_high"), block)))
        .hint("rebalance")
        .withColumn("_to", F.least(F.col("_high"), F.col("_from") + block - 1))
        .withColumn(out, F.explode(F.sequence("_from", "_to")))
        .drop("_low", "_high", "_from", "_to")
    )


def finalized_head(tag: Column, latest: Column, confirmations: int) -> Column:
    """The finalized height: the node's tag, else latest less the confirmations.

    NULL where neither is available yet.
    """
    depth = F.lit(confirmations).cast("bigint")
    return F.coalesce(tag, F.when(latest >= depth, latest - depth))


def finalized_only(df: DataFrame, number: str, head: Column) -> DataFrame:
    return df.filter(F.col(number) <= head)


def head_gap_fill(
    heads: DataFrame,
    chain: str,
    number: str,
    order: Sequence[str],
    floor: int = SMALL_KEY_ROWS,
) -> DataFrame:
    """Heights each new head brings: from one past the highest seen up to itself.

    The first head of a chain brings only itself; a head that is not higher than
    one seen before brings nothing. Result: chain, head, height.
    """
    seen = running_max(
        heads.select(chain, number, *[c for c in order if c not in (chain, number)]),
        [chain],
        order,
        F.col(number),
        "_seen",
        include_current=False,
        floor=floor,
    )
    low = F.coalesce(F.col("_seen") + 1, F.col(number))
    return explode_heights(
        seen.select(chain, F.col(number).alias("head"), low.alias("_next")),
        F.col("_next"),
        F.col("head"),
        "height",
    ).select(chain, "head", "height")


def high_water_mark(
    blocks: DataFrame,
    chain: str,
    number: str,
    ok: Column,
    order: Sequence[str],
    floor: int = SMALL_KEY_ROWS,
) -> DataFrame:
    """Add ``mark``, the highest height handled without error so far."""
    return running_max(
        blocks, [chain], order, F.when(ok, F.col(number)), "mark", include_current=True, floor=floor
    )


def finalized_backlog(
    polls: DataFrame,
    chain: str,
    finalized: str,
    order: Sequence[str],
    floor: int = SMALL_KEY_ROWS,
) -> DataFrame:
    """Heights each poll adds: one past the highest finalized before, up to now.

    Polls without a finalized height add nothing. Result: chain, order columns,
    height.
    """
    known = polls.filter(F.col(finalized).isNotNull())
    seen = running_max(
        known, [chain], order, F.col(finalized), "_seen", include_current=False, floor=floor
    )
    low = F.coalesce(F.col("_seen") + 1, F.col(finalized))
    return explode_heights(seen, low, F.col(finalized), "height").select(chain, *order, "height")


# Heights of one word of a bitmap.
WORD = 64


def _word(height: str) -> Column:
    # An arithmetic shift, which rounds down below zero too.
    return F.shiftright(F.col(height).cast("bigint"), 6)


def height_words(done: DataFrame, chain: str, number: str) -> DataFrame:
    """(chain, word, bits): the heights that are there as one bit each, 64 to a row.

    A hash aggregation that combines before the shuffle, so repeats of a height
    cost nothing and neighbours share a row.
    """
    at = F.col(number).cast("bigint")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(at, F.lit(WORD)).cast("int"))
    return (
        done.filter(at.isNotNull())
        .select(F.col(chain).alias("chain"), _word(number).alias("word"), bit.alias("bit"))
        .groupBy("chain", "word")
        .agg(F.bit_or("bit").alias("bits"))
    )


def missing_heights(wanted: DataFrame, done: DataFrame, chain: str, low: str, high: str, number: str) -> DataFrame:
    """Wanted heights (one low..high range per chain) that are not done.

    Both sides meet as bitmaps: done heights as the bits of words, wanted ranges
    as the words they touch. Heights become rows after the join only, from the
    bits that are not set; NULL is a chain like any other.
    """
    ranges = wanted.select(F.col(chain).alias("chain"), F.col(low).alias("_first"), F.col(high).alias("_last"))
    words = explode_heights(
        ranges.filter(F.col("_first") <= F.col("_last")),
        _word("_first"),
        _word("_last"),
        "word",
    )
    have = height_words(done, chain, number).select(F.col("chain").alias("_chain"), F.col("word").alias("_word"), "bits")
    met = words.join(have, F.col("chain").eqNullSafe(F.col("_chain")) & (F.col("word") == F.col("_word")), "left")
    start = F.col("word") * WORD
    bits = F.coalesce("bits", F.lit(0).cast("bigint"))
    from_bit = F.greatest(F.col("_first") - start, F.lit(0)).cast("int")
    to_bit = F.least(F.col("_last") - start, F.lit(WORD - 1)).cast("int")
    return (
        # A word with all bits set has nothing to list.
        met.filter(bits != -1)
        .select("chain", start.alias("_start"), bits.alias("_bits"), F.explode(F.sequence(from_bit, to_bit)).alias("_bit"))
        .filter(F.call_function("getbit", F.col("_bits"), F.col("_bit")) == 0)
        .select(F.col("chain").alias(chain), (F.col("_start") + F.col("_bit")).alias("height"))
    )
