"""Exact duplicates by progressive refinement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rows import SMALL_ROWS, SPACE, settled, unveiled, veiled

# Code points of the normalised text that the prefix hash covers.
PREFIX = 64


def normalised(text: Column) -> Column:
    """A text without its white space; NULL counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), SPACE, "")


def _length(text: Column) -> Column:
    whole = F.coalesce(text, F.lit(""))
    return F.char_length(whole) - F.regexp_count(whole, F.lit("[\\x20\\x09-\\x0D]"))


def _prefix_hash(text: Column) -> Column:
    """Hash of the first code points of the normalised text, reading the start of the text where that is enough."""
    whole = F.coalesce(text, F.lit(""))
    start = F.translate(F.substring(whole, 1, 4 * PREFIX), SPACE, "")
    enough = (F.char_length(start) >= PREFIX) | (F.char_length(whole) <= 4 * PREFIX)
    return F.xxhash64(F.substring(F.when(enough, start).otherwise(normalised(text)), 1, PREFIX))


def exact_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", most: int = SMALL_ROWS) -> DataFrame:
    """The rows of ``docs`` without ``text``, with ``keep_id``, ``group_size`` and ``kept``.

    Texts are equal when their normalised forms are. Of equal texts the row with
    the most code points in its text stays, then the one with the smallest id.

    Refinement: normalised lengths that occur once are settled; of the others,
    (length, prefix hash) pairs that occur once are; the full hash (SHA-256) is
    taken of the rest only. The pairs of the rest are broadcast if there are at
    most ``most``; beyond that every row takes the full hash, which gives the
    same result and still moves no text.

    * Groups are counted before the shuffle, so a text that a third of the rows
      share costs one row per task.
    * NULL texts equal empty ones. NULL ids come last. Rows alike in id and
      length are told apart by their place in the table: one of them stays.
    * Other columns pass through, but for those named like the three new ones.
      An empty table gives an empty table.
    """
    carried = [c for c in docs.columns if c not in (text, "keep_id", "group_size", "kept")]
    body = F.col(text)
    shape = docs.select(_length(body).alias("length"), _prefix_hash(body).alias("prefix"))
    counts = shape.groupBy("length", "prefix").agg(F.count(F.lit(1)).alias("n"))
    lengths = counts.groupBy("length").agg(F.sum("n").alias("of_length")).where("of_length > 1")
    open_pairs = settled(
        counts.join(lengths, "length", "left_semi").where("n > 1").select("length", "prefix", F.lit(True).alias("open"))
    )
    old = [f"_{i}" for i in range(len(carried))]
    staged = veiled(docs.select(*carried, F.col(text))).select(
        *old,
        F.col(f"_{carried.index(id)}").alias("id"),
        F.col(f"_{len(carried)}").alias("body"),
    )
    staged = staged.select(
        *old,
        "id",
        F.char_length(F.coalesce("body", F.lit(""))).alias("points"),
        _length(F.col("body")).alias("length"),
        _prefix_hash(F.col("body")).alias("prefix"),
        "body",
    )
    if open_pairs.count() <= most:
        staged = staged.join(F.broadcast(open_pairs), ["length", "prefix"], "left")
    else:
        staged = staged.withColumn("open", F.lit(True))
    slim = settled(
        staged.select(
            *old,
            "id",
            "points",
            F.when(F.col("open"), F.sha2(normalised(F.col("body")), 256)).alias("full"),
            F.monotonically_increasing_id().alias("place"),
        )
    )
    order = F.struct((-F.col("points")).alias("a"), F.col("id").isNull().alias("b"), F.col("id").alias("id"), F.col("place").alias("place"))
    groups = (
        slim.where(F.col("full").isNotNull())
        .groupBy("full")
        .agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("best"))
        .where("n > 1")
    )
    # Rows that were settled early have no hash; joined, they would all go to one task.
    paired = slim.where(F.col("full").isNotNull()).join(groups, "full", "left")
    paired = paired.unionByName(slim.where(F.col("full").isNull()), allowMissingColumns=True)
    alone = F.col("n").isNull()
    return paired.select(
        *unveiled(carried),
        F.when(alone, F.col("id")).otherwise(F.col("best.id")).alias("keep_id"),
        F.coalesce("n", F.lit(1).cast("long")).alias("group_size"),
        (alone | (F.col("place") == F.col("best.place"))).alias("kept"),
    )
