"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .rows import join_checked, unveiled, veiled

# Sources up to this number are broadcast with their tables of the distribution.
MOST_SOURCES = 10_000


def draw(*parts: Column | str) -> Column:
    """52 bits of MD5 over the parts as BIGINT, the same in any engine."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13), 16, 10).cast("long")


def rates(
    docs: DataFrame,
    source: str = "source",
    weights: Mapping[str | None, float] | None = None,
    exponent: float = 0.5,
    epochs: float = 1.0,
) -> DataFrame:
    """(source, n, rate): documents of each source, and their mean number of repetitions.

    The mix has ``epochs`` times as many documents as the table. A source gets
    its share of the weights: those given by name (sources without one get
    none), or by default its number of documents to the power ``exponent``,
    which lifts small sources. NULL is a source like any other.
    """
    sizes = docs.groupBy(F.col(source).alias("source")).agg(F.count(F.lit(1)).alias("n"))
    if weights is None:
        weighed = sizes.withColumn("weight", F.pow(F.col("n").cast("double"), F.lit(float(exponent))))
    else:
        named = docs.sparkSession.createDataFrame(
            [(k, float(v)) for k, v in weights.items()], "name string, weight double"
        )
        weighed = sizes.join(named, F.col("source").eqNullSafe(F.col("name")), "left").select(
            "source", "n", F.coalesce("weight", F.lit(0.0)).alias("weight")
        )
    weighed = weighed.withColumn("all", F.lit(1))
    totals = weighed.groupBy("all").agg(F.sum("n").alias("docs"), F.sum("weight").alias("weights"))
    return weighed.join(F.broadcast(totals), "all").select(  # one row
        "source",
        "n",
        F.coalesce(
            F.col("weight") / F.nullif(F.col("weights"), F.lit(0.0)) * (float(epochs) * F.col("docs")) / F.col("n"),
            F.lit(0.0),
        ).alias("rate"),
    )


def distributions(rated: DataFrame) -> DataFrame:
    """(source, steps): the Poisson distribution function of each source at 0, 1, 2, ...

    Built from logarithms, so no rate is too large; it ends where what is left
    is below the 52 bits of a draw.
    """
    last = F.ceil(F.col("rate") + 12 * F.sqrt("rate") + 24).cast("long")
    ks = rated.where("rate > 0").select("source", "rate", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("k"))
    to_here = Window.partitionBy("source").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    return (
        ks.withColumn("log_p", F.sum(F.when(F.col("k") == 0, -F.col("rate")).otherwise(F.log(F.col("rate") / F.col("k")))).over(to_here))
        .withColumn("below", F.sum(F.exp("log_p")).over(to_here))
        .groupBy("source")
        .agg(F.transform(F.sort_array(F.collect_list(F.struct("k", "below"))), lambda s: s["below"]).alias("steps"))
    )


def mix(
    docs: DataFrame,
    id: str = "doc_id",
    source: str = "source",
    weights: Mapping[str | None, float] | None = None,
    exponent: float = 0.5,
    epochs: float = 1.0,
    seed: str = "mix",
) -> DataFrame:
    """Documents repeated to the target weights, in random order, with ``copy`` and ``mix_key``.

    Each document draws from its id a number between 0 and 1 and inverts the
    Poisson distribution whose mean is the rate of its source, so it needs no
    other row. Copies (from 1) are dealt out by a hash of id and copy and sorted
    by it: the order is random, and no source is a hot key of the shuffle.

    * Documents of a rate of zero do not occur. NULL ids draw like an empty id;
      rows that share an id draw the same number.
    * Columns of the input named ``copy`` or ``mix_key`` are replaced. An empty
      table gives an empty table.
    """
    table = distributions(rates(docs, source, weights, exponent, epochs)).select(
        F.col("source").alias("_source"), F.col("steps").alias("_steps")
    )
    columns = [c for c in docs.columns if c not in ("copy", "mix_key")]
    old = [f"_{i}" for i in range(len(columns))]
    whole = veiled(docs.select(*columns)).select(
        *old,
        F.coalesce(F.col(f"_{columns.index(id)}").cast("string"), F.lit("")).alias("_id"),
        F.col(f"_{columns.index(source)}").alias("_from"),
    )
    drawn = join_checked(whole, table, F.col("_from").eqNullSafe(F.col("_source")), "inner", MOST_SOURCES)
    at = draw(F.lit(seed), F.col("_id")) / F.lit(float(1 << 52))
    counted = drawn.select(*old, "_id", F.size(F.filter("_steps", lambda s: s <= at)).alias("_times")).where("_times > 0")
    copies = counted.select(
        *old, "_id", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_times").cast("long"))).alias("copy")
    )
    key = draw(F.lit(f"{seed}-order"), F.col("_id"), F.col("copy").cast("string"))
    keyed = copies.select(*old, "copy", key.alias("mix_key"))
    return keyed.repartition("mix_key").sortWithinPartitions("mix_key").select(*unveiled(columns), "copy", "mix_key")
