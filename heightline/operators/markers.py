"""The ledger of published hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hexes import strip
from .dedup import first_arrival
from .ordered import SMALL_KEY_ROWS, with_known


def live_markers(ledger: DataFrame, published_at: str, ttl: int, now: Column | int) -> DataFrame:
    """Markers that have not expired at ``now``; with ttl 0 they never do.

    The test is on the bare column, so it reaches the parquet scan.
    """
    if ttl <= 0:
        return ledger
    at = now if isinstance(now, Column) else F.lit(now)
    return ledger.filter(F.col(published_at) > at - F.lit(ttl))


def _known(markers: DataFrame, hash_col: str) -> DataFrame:
    # Distinct before the join: a hash marked many times is one row per map task.
    return markers.select(hash_col).distinct()


def first_unmarked(
    df: DataFrame, markers: DataFrame, hash_col: str, order: list[str]
) -> DataFrame:
    """The first row of each hash that has no marker.

    Whether a hash is marked does not depend on the row, so the first rows are
    taken before the join: hashes are unique by then, a hot one is a single row,
    and the join goes on with the partitioning of the first step.
    """
    return first_arrival(df, [hash_col], order).join(
        _known(markers, hash_col), hash_col, "left_anti"
    )


def without_marked(df: DataFrame, markers: DataFrame, hash_col: str) -> DataFrame:
    """Rows whose hash has no live marker, by a plain anti-join; for rows that are costly to work out twice."""
    return df.join(_known(markers, hash_col), hash_col, "left_anti")


def insert_markers(
    candidates: DataFrame, ledger: DataFrame, hash_col: str, order: list[str]
) -> DataFrame:
    """Rows to append to the ledger: non-blank hashes not marked yet, first one wins."""
    named = candidates.filter(F.expr(f"{strip(hash_col)} <> ''"))
    return first_unmarked(named, ledger, hash_col, order)


def look_up_markers(
    df: DataFrame, markers: DataFrame, hash_col: str, floor: int = SMALL_KEY_ROWS
) -> DataFrame:
    """Add ``published``: whether each hash has a marker; NULL for a blank hash, which has no answer."""
    known = _known(markers, hash_col).withColumn("_hit", F.lit(True))
    return (
        with_known(df, known, hash_col, "left", floor)
        .withColumn("published", F.when(F.expr(f"{strip(hash_col)} <> ''"), F.coalesce(F.col("_hit"), F.lit(False))))
        .drop("_hit")
    )


def skip_published(
    df: DataFrame, markers: DataFrame, hash_col: str, floor: int = SMALL_KEY_ROWS
) -> DataFrame:
    """Rows whose hash has no live marker."""
    return with_known(df, _known(markers, hash_col), hash_col, "left_anti", floor)
