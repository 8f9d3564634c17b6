"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .rows import stored


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b); equal roots mean one component.

    Contraction: in each round every node moves to the node of its closed
    neighbourhood that a hash, new in each round, puts first. Links between
    nodes that moved apart remain, so their number falls by a constant factor
    per round, whatever the shape of the graph. All steps are joins and minima
    that combine before the shuffle; the tables of each round are stored.
    Nodes may be of any one type; links with a NULL end are left out.
    """
    spark = links.sparkSession
    edges = stored(_tidy(links.select(F.col("a"), F.col("b"))))
    layers: list[DataFrame] = []
    while not edges.isEmpty():
        mark = F.lit(len(layers))
        ends = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        heads = stored(
            ends.groupBy(F.col("a").alias("node"))
            .agg(F.min(F.struct(F.xxhash64("b", mark).alias("by"), F.col("b").alias("to"))).alias("near"))
            .select(
                "node",
                F.when(F.col("near.by") < F.xxhash64("node", mark), F.col("near.to"))
                .otherwise(F.col("node"))
                .alias("head"),
            )
        )
        layers.append(heads)
        moved = edges.join(heads.select(F.col("node").alias("a"), F.col("head").alias("ha")), "a").join(
            heads.select(F.col("node").alias("b"), F.col("head").alias("hb")), "b"
        )
        edges = stored(_tidy(moved.select(F.col("ha").alias("a"), F.col("hb").alias("b"))))
    if not layers:
        kind = links.schema["a"].dataType.simpleString()
        return spark.createDataFrame([], f"node {kind}, root {kind}")
    roots = layers[-1].select("node", F.col("head").alias("root"))
    for heads in reversed(layers[:-1]):
        onward = roots.select(F.col("node").alias("head"), F.col("root").alias("onward"))
        roots = heads.join(onward, "head", "left").select(
            "node", F.coalesce("onward", "head").alias("root")
        )
    return roots


def _tidy(edges: DataFrame) -> DataFrame:
    return (
        edges.where(F.col("a") != F.col("b"))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )
