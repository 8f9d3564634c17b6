"""Ordered work on keys that may be too large for one task.

A window over a key puts the whole key in one task. When a measured key is too
large for that, rows are cut instead into balanced, contiguous chunks of the
(key, order) sort, whatever the skew: each chunk is worked on alone, and a
table with one row per key and chunk carries state from chunk to chunk.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_dir, shuffle_width

CHUNK = "_chunk"

# Below this many rows a key is left to one task.
SMALL_KEY_ROWS = 2_000_000
# Rows of a chunk, about; fewer where the shuffle is wide enough for that.
CHUNK_ROWS = 1_000_000


# The sketch that tells whether there is any key of more than ``floor`` rows.
_TRACKED = 8192
# Large keys up to this number are broadcast.
_MOST_BROADCAST = 10_000
_SKETCH_GROUPS = 64


def has_large_key(df: DataFrame, keys: Sequence[str], floor: int = SMALL_KEY_ROWS) -> bool:
    """Whether some key holds more than ``floor`` rows, too many for one task.

    This runs a job: one scan of the key columns in which no rows are shuffled,
    only one small sketch of heavy hitters per task, merged in two steps. The
    bound is a number of rows, whatever the size of the table, and the answer
    steers the plan only, never the result.
    """
    sketched = (
        # A hash stands for keys of any type, NULL among them.
        df.select(F.xxhash64(*keys).alias("_key"))
        .groupBy(F.pmod(F.spark_partition_id(), F.lit(_SKETCH_GROUPS)).alias("_group"))
        .agg(
            F.count(F.lit(1)).alias("_rows"),
            F.expr(f"approx_top_k_accumulate(_key, {_TRACKED})").alias("_sketch"),
        )
        # Grouped by a constant, so that no rows give no result.
        .groupBy(F.lit(0).alias("_all"))
        .agg(
            F.sum("_rows").alias("rows"),
            F.expr(f"approx_top_k_combine(_sketch, {_TRACKED})").alias("_sketch"),
        )
        .selectExpr("rows", "approx_top_k_estimate(_sketch, 1) AS top")
    )
    row = sketched.first()
    # Counts of the sketch are never too low.
    return bool(row and row["rows"] and row["top"] and row["top"][0]["count"] > floor)


def large_keys(df: DataFrame, key: str, floor: int = SMALL_KEY_ROWS, with_null: bool = False) -> DataFrame | None:
    """The keys of more than ``floor`` rows as a table, or None if there are none.

    Only where the sketch finds one are keys counted. NULL is among them only
    with ``with_null``, as no plain join matches it. Their number is at most the
    rows over ``floor``.
    """
    keyed = df if with_null else df.filter(F.col(key).isNotNull())
    if not has_large_key(keyed, [key], floor):
        return None
    shared_dir(df.sparkSession)
    found = (
        keyed.groupBy(key)
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > floor)
        .select(key)
        .checkpoint(eager=True)
    )
    count = found.count()
    if not count:
        return None
    return F.broadcast(found) if count <= _MOST_BROADCAST else found


def with_known(df: DataFrame, known: DataFrame, key: str, how: str, floor: int = SMALL_KEY_ROWS) -> DataFrame:
    """Join ``df`` to ``known`` (distinct by ``key``) where few keys may hold most of ``df``.

    Rows of large keys are not shuffled where those are few enough to broadcast,
    and with them the rows of ``known`` for them. The other rows join as usual.
    """
    hot = large_keys(df, key, floor)
    if hot is None:
        return df.join(known, key, how)
    rest = df.join(hot, key, "left_anti").join(known, key, how)
    few = known.join(hot, key, "left_semi").checkpoint(eager=True)
    if few.count() <= _MOST_BROADCAST:
        few = F.broadcast(few)
    return rest.unionByName(df.join(hot, key, "left_semi").join(few, key, how))


def by_value(df: DataFrame, most_rows: int = 10_000) -> DataFrame:
    """A result of at most ``most_rows`` rows worked out once and held as values.

    Joins then see its true size and broadcast it. A larger one stays as it is.
    """
    rows = df.take(most_rows + 1)
    if len(rows) > most_rows:
        return df
    return df.sparkSession.createDataFrame(rows, df.schema)


def ordered_chunks(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows in balanced contiguous chunks of the (keys, order) sort.

    Range partitioning samples its bounds, so the layout is fixed by a
    checkpoint in the shared folder before anything depends on it. ``order``
    should end in a unique column, so that rows with equal times can be split.
    The rows are counted, so that chunks stay small however narrow the shuffle.
    """
    spark = df.sparkSession
    shared_dir(spark)
    by = [*keys, *order]
    parts = max(shuffle_width(spark), -(-df.count() // CHUNK_ROWS))
    return (
        df.repartitionByRange(parts, *by)
        .sortWithinPartitions(*by)
        .withColumn(CHUNK, F.spark_partition_id())
        .checkpoint(eager=True)
    )


def running_max(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: Column,
    out: str,
    include_current: bool,
    floor: int = SMALL_KEY_ROWS,
) -> DataFrame:
    """Largest ``value`` so far within each key, in ``order``.

    ``include_current`` decides whether a row sees its own value. Rows before
    the first non-NULL value get NULL.
    """
    last = Window.currentRow if include_current else -1
    if not has_large_key(df, keys, floor):
        w = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumn(out, F.max(value).over(w.rowsBetween(Window.unboundedPreceding, last)))

    chunks = ordered_chunks(df, keys, order).withColumn("_value", value)
    # One row per key and chunk: at most (chunks + keys) rows in all.
    carried = (
        chunks.groupBy(*keys, CHUNK)
        .agg(F.max("_value").alias("_top"))
        .withColumn(
            "_carry",
            F.max("_top").over(
                Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
            ),
        )
        .select(*keys, CHUNK, "_carry")
    )
    w = Window.partitionBy(*keys, CHUNK).orderBy(*order)
    local = chunks.withColumn(
        "_local", F.max("_value").over(w.rowsBetween(Window.unboundedPreceding, last))
    )
    # greatest() skips NULLs.
    same = F.col(CHUNK) == F.col("_chunk_of")
    renamed = [F.col(CHUNK).alias("_chunk_of"), "_carry"]
    for i, k in enumerate(keys):
        renamed.append(F.col(k).alias(f"_key_{i}"))
        # NULL is a key like any other.
        same = same & F.col(k).eqNullSafe(F.col(f"_key_{i}"))
    return (
        local.join(carried.select(*renamed), same)
        .withColumn(out, F.greatest("_carry", "_local"))
        .select(*df.columns, out)
    )
