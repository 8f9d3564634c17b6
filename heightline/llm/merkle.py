"""Merkle manifest of a table: a tree for each source, a tree over the sources, and a proof for each row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordered import CHUNK, ordered_chunks
from .rows import join_checked, let, settled

FANOUT = 3
# A task works out the lowest levels of a block of FANOUT ** LEVELS leaves by itself.
LEVELS = 7
# Trees are joined by broadcast up to this number; a row has a root and a short proof.
FEW_TREES = 10_000

_PATH = "array<struct<before:string,after:string>>"


def digest(*parts: Column) -> Column:
    """SHA-256 of the joined parts as lowercase hex; NULL parts are left out."""
    return F.sha2(F.concat_ws("", *parts), 256)


def leaf_digest(*values: Column) -> Column:
    """Digest of a row: each value as its number of UTF-8 bytes, a colon and its text, or ``-`` for NULL."""
    texts = [v.cast("string") for v in values]
    return digest(*(F.coalesce(F.concat(F.octet_length(t), F.lit(":"), t), F.lit("-")) for t in texts))


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(proof, leaf, lambda node, step: digest(step["before"], node, step["after"]))


def proof_digest(proof: Column) -> Column:
    """Digest of all siblings in a proof, level by level, left to right."""
    return digest(F.array_join(F.transform(proof, lambda step: F.concat(step["before"], step["after"])), ""))


def _quotient(a: Column, b: int) -> Column:
    return F.call_function("div", a, F.lit(b).cast("long"))


def _parents(nodes: Column, fanout: int) -> Column:
    """The digests of runs of ``fanout`` nodes."""
    return F.transform(
        F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / fanout).cast("int")),
        lambda i: digest(*(F.get(nodes, i * fanout + j) for j in range(fanout))),
    )


def _siblings(nodes: Column, at: Column, fanout: int) -> Column:
    """What stands before and after place ``at`` in its run; get() finds nothing beyond the last node."""
    start = at - at % fanout
    others = [(j, F.get(nodes, start + j)) for j in range(fanout)]
    return F.struct(
        F.concat_ws("", *(F.when(F.lit(j) < at % fanout, node) for j, node in others)).alias("before"),
        F.concat_ws("", *(F.when(F.lit(j) > at % fanout, node) for j, node in others)).alias("after"),
    )


def _placed(leaves: DataFrame, order: Sequence[str]) -> DataFrame:
    """``leaves`` with ``position``, their rank in their tree from 0, and ``total``, the tree's leaves.

    Rows are sorted over the cluster by tree and order, so a large tree is the
    work of many tasks. The ranks follow from a count for each tree and task.
    """
    chunks = ordered_chunks(leaves, ["tree"], [*order, "node"]).withColumn("row", F.monotonically_increasing_id())
    counts = chunks.groupBy("tree", CHUNK).agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("first"))
    tree = Window.partitionBy("tree")
    earlier = tree.orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.col("tree").alias("_tree"),
        F.col(CHUNK).alias("_in"),
        (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("n").over(tree).alias("total"),
    )
    same = F.col("tree").eqNullSafe(F.col("_tree")) & (F.col(CHUNK) == F.col("_in"))
    return (
        join_checked(chunks, offsets, same, "inner")
        .withColumn("position", F.col("row") + F.col("shift"))
        .drop(CHUNK, "row", "shift", "_tree", "_in", *order)
    )


def _blocks(placed: DataFrame, carry: Sequence[str], fanout: int, levels: int) -> DataFrame:
    """One row per tree and block of ``fanout ** levels`` leaves: its leaves, and the nodes of each level above them."""
    size = fanout**levels
    blocks = (
        placed.withColumn("block", _quotient(F.col("position"), size))
        .groupBy("tree", "block", _quotient(F.col("total") + (size - 1), size).alias("blocks"))
        .agg(F.sort_array(F.collect_list(F.struct("position", "node", *carry))).alias("leaves"))
    )
    blocks = let(blocks, "level_0", F.transform("leaves", lambda leaf: leaf["node"]))
    for level in range(levels):
        nodes = F.col(f"level_{level}")
        # A tree of several blocks has all these levels; one of a single block ends where one node is left.
        ends = (F.col("blocks") == 1) & (F.size(nodes) == 1)
        blocks = let(blocks, f"level_{level + 1}", F.when(~ends, _parents(nodes, fanout)).otherwise(nodes))
    return blocks


def _exchanged(tops: DataFrame, fanout: int) -> DataFrame:
    """(tree, block, node, path) with ``node`` the root of the tree and ``path`` the siblings above the block.

    Butterfly exchange. In round r every block holds the root of the aligned
    subtree of ``fanout ** r`` blocks it is in. It asks, in each of the aligned
    subtrees that share a parent with its own, for the block at its own place
    there, and hashes the parent itself. So all blocks of a subtree work out the
    same nodes, each learns all siblings above it on the way, and nothing has to
    be handed down from the root. Where the last subtree is short, places beyond
    it are dealt over the blocks it has.
    """
    state = settled(tops)
    most = state.agg(F.max("blocks").alias("n")).first()["n"] or 0
    reach = 1
    while reach < most:
        up = reach * fanout
        rising = F.col("blocks") > reach
        asks = state.where(rising).select(
            "tree", "block", "blocks", "path", F.explode(F.sequence(F.lit(0), F.lit(fanout - 1))).alias("digit")
        )
        start = F.col("block") - F.col("block") % up + F.col("digit") * reach
        asks = asks.withColumn("start", start).where(F.col("start") < F.col("blocks"))
        short = F.least(F.lit(reach), F.col("blocks") - F.col("start"))
        asks = asks.withColumn("partner", F.col("start") + F.col("block") % reach % short)
        held = state.where(rising).select(F.col("tree").alias("_tree"), F.col("block").alias("_block"), "node")
        met = (
            asks.join(held, F.col("tree").eqNullSafe(F.col("_tree")) & (F.col("partner") == F.col("_block")))
            .groupBy("tree", "block", "blocks")
            .agg(F.sort_array(F.collect_list(F.struct("digit", "node"))).alias("run"), F.first("path").alias("path"))
        )
        met = let(met, "nodes", F.transform("run", lambda r: r["node"]))
        place = F.floor(F.col("block") % up / reach).cast("int")
        risen = met.select(
            "tree",
            "block",
            "blocks",
            digest(F.array_join("nodes", "")).alias("node"),
            F.concat("path", F.array(_siblings(F.col("nodes"), place, fanout))).alias("path"),
        )
        state = settled(risen.unionByName(state.where(~rising)))
        reach = up
    return state.drop("blocks")


def _forest(leaves: DataFrame, order: Sequence[str], carry: Sequence[str], fanout: int, levels: int) -> tuple[DataFrame, DataFrame]:
    """Blocks of every tree with their leaves and levels, and their state after the exchange."""
    blocks = settled(_blocks(_placed(leaves, order), carry, fanout, levels))
    tops = blocks.select("tree", "block", "blocks", F.get(f"level_{levels}", F.lit(0)).alias("node"), F.array().cast(_PATH).alias("path"))
    return blocks, _exchanged(tops, fanout)


def _with_proofs(blocks: DataFrame, state: DataFrame, carry: Sequence[str], fanout: int, levels: int) -> DataFrame:
    """One row per leaf: tree, position, node, ``carry``, and the columns of ``state``, its path put behind the leaf's own."""
    kept = [c for c in state.columns if c not in ("tree", "block", "path")]
    above = state.select(F.col("tree").alias("_tree"), F.col("block").alias("_block"), "path", *kept)
    joined = blocks.join(above, F.col("tree").eqNullSafe(F.col("_tree")) & (F.col("block") == F.col("_block")))

    def leaf(item: Column, i: Column) -> Column:
        place, steps = i, []
        for level in range(levels):
            nodes = F.col(f"level_{level}")
            real = (F.col("blocks") > 1) | (F.size(nodes) > 1)
            steps.append(F.when(real, _siblings(nodes, place, fanout)))
            place = F.floor(place / fanout).cast("int")
        lower = F.filter(F.array(*steps), lambda s: s.isNotNull()) if steps else F.array().cast(_PATH)
        return F.struct(item.alias("leaf"), F.concat(lower, F.col("path")).alias("proof"))

    return joined.select("tree", *kept, F.explode(F.transform("leaves", leaf)).alias("e")).select(
        "tree",
        F.col("e.leaf.position").alias("position"),
        F.col("e.leaf.node").alias("leaf"),
        *(F.col("e.leaf")[c].alias(c) for c in carry),
        *kept,
        F.col("e.proof").alias("proof"),
    )


def manifest(
    docs: DataFrame,
    columns: Sequence[str],
    source: str = "source",
    order: str = "doc_id",
    carry: Sequence[str] = (),
    fanout: int = FANOUT,
    levels: int = LEVELS,
) -> DataFrame:
    """One row per row of ``docs``: ``order``, ``source``, ``carry``, position, leaf, subroot, root, proof.

    A leaf is the digest of ``columns``. The leaves of a source, by ``order``,
    are the lowest level of its tree; runs of ``fanout`` nodes become a parent
    until one is left, the subroot. The subroots by source, NULL first and by
    their bytes, are the leaves of a tree above them. ``proof`` has the siblings
    before and after the row's node on each level with several nodes; ``fold``
    leads from the leaf and its proof to the root.

    Texts are read once, by the leaf; what is sorted and sent is a digest with
    its keys. A large source is cut into blocks of ``fanout ** levels`` leaves;
    the levels above them are worked out by the exchange.

    * NULL sources are one tree; NULL ids come first. Rows of equal id go by
      their leaf; equal rows are equal leaves, each with a place of its own.
    * Very long texts are hashed where they are read and never sent.
    * An empty table gives an empty table. ``carry`` should be narrow; columns
      may have any names.
    """
    ids = [f"c{i}" for i in range(len(carry) + 1)]
    leaves = settled(
        docs.select(
            F.col(source).alias("tree"),
            F.col(order).alias("by"),
            leaf_digest(*(F.col(c) for c in columns)).alias("node"),
            *(F.col(c).alias(name) for c, name in zip((order, *carry), ids)),
        )
    )
    blocks, state = _forest(leaves, ["by"], ids, fanout, levels)
    subroots = state.where("block = 0").select(F.lit(0).alias("tree"), F.col("tree").alias("by"), F.col("tree").alias("c0"), "node")
    upper = _with_proofs(*_forest(settled(subroots), ["by"], ["c0"], fanout, levels), ["c0"], fanout, levels)
    above = upper.select(F.col("c0").alias("_of"), F.col("node").alias("root"), F.col("proof").alias("_upper"))
    rooted = join_checked(state, above, F.col("tree").eqNullSafe(F.col("_of")), "inner", FEW_TREES).select(
        "tree", "block", F.col("node").alias("subroot"), "root", F.concat("path", "_upper").alias("path")
    )
    found = _with_proofs(blocks, rooted, ids, fanout, levels)
    return found.select(
        *(F.col(name).alias(c) for c, name in zip((order, *carry), ids)),
        *([] if source in (order, *carry) else [F.col("tree").alias(source)]),
        "position",
        "leaf",
        "subroot",
        "root",
        "proof",
    )
