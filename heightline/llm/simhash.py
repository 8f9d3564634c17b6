"""SimHash near-duplicates with multi-index hashing."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .rows import blocks, settled, unveiled, veiled

# Links reach over at most this many bits: see links().
FARTHEST = 2


def fingerprint_of(text: str | None, words: int = 3) -> int:
    """SimHash of one text: bit i is set if more than half of the shingle hashes have it."""
    ones = np.zeros(64, dtype=np.int64)
    total = 0
    tail: list[bytes] = []
    for block in blocks(text or ""):
        # bytes.lower() and bytes.split() know A-Z and the six ASCII spaces only.
        tokens = tail + block.encode("utf-8", "surrogatepass").lower().split()
        n = len(tokens) - words + 1
        if n <= 0:
            tail = tokens
            continue
        total += n
        ones += _bit_counts([b" ".join(tokens[i : i + words]) for i in range(n)])
        tail = tokens[n:]
    if not total and tail:
        total = 1
        ones += _bit_counts([b" ".join(tail)])
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big")


def _bit_counts(shingles: list[bytes]) -> np.ndarray:
    counts = np.zeros(64, dtype=np.int64)
    step = 1 << 16
    for at in range(0, len(shingles), step):
        part = shingles[at : at + step]
        hashes = np.fromiter((xxhash.xxh64_intdigest(s, 42) for s in part), dtype=">u8", count=len(part))
        counts += np.unpackbits(hashes.view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return counts


def fingerprint(text: Column, words: int = 3) -> Column:
    """SimHash of a text column as BIGINT; its bits are the 64 bits of the fingerprint.

    Words are runs without ASCII white space, A-Z in lower case; shingles are
    ``words`` words, repeats included; a shorter text is one shingle; a text
    without words, or NULL, has fingerprint zero.
    """

    @F.arrow_udf("long")
    def marks(texts: pa.Array) -> pa.Array:
        values = [fingerprint_of(t.as_py(), words) for t in texts]
        return pa.array(np.array(values, dtype=np.uint64).view(np.int64))

    return marks(text)


def fingerprint_hex(mark: Column) -> Column:
    return F.lpad(F.lower(F.hex(mark)), 16, "0")


def links(marks: DataFrame, distance: int = FARTHEST) -> DataFrame:
    """(a, b) with a < b: distinct fingerprints (column ``mark``) at ``distance`` or fewer differing bits.

    Multi-index hashing over four overlapping segments, each the fingerprint
    without one quarter. Two fingerprints at two bits or fewer agree outside the
    quarter that holds most of their difference, but for one bit at most. So the
    table of a segment is probed with the segment itself and with its Hamming
    ball of one bit; matches are verified over all 64 bits.

    * A difference in two quarters is found by leaving out the lower one, so
      bits are flipped above the quarter left out only.
    * One flip changes the parity, so only fingerprints of even parity probe.
    * Segments of 48 bits keep buckets small where disjoint ones would not: of
      thousands of near copies, few share three quarters of their bits.
    """
    if not 0 <= distance <= FARTHEST:
        raise ValueError(f"distance must be between 0 and {FARTHEST}")
    one = F.lit(1).cast("long")
    entries = marks.select(
        "mark",
        F.explode(
            F.array(
                *(
                    F.struct(
                        F.lit(q).alias("quarter"),
                        # The quarter left out holds its own number, so one column names table and key.
                        F.col("mark").bitwiseAND(_signed(~(0xFFFF << 16 * q))).bitwiseOR(_signed(q << 16 * q)).alias("key"),
                        (F.bit_count(F.col("mark").bitwiseAND(_signed(~(0xFFFF << 16 * q)))) % 2 == 0).alias("even"),
                    )
                    for q in range(4)
                )
            )
        ).alias("e"),
    ).select("mark", "e.*")
    ball = (
        entries.where(F.col("even") & (F.col("quarter") < 3))
        .select("mark", "key", F.explode(F.sequence((F.col("quarter") + 1) * 16, F.lit(63))).alias("bit"))
        .select("mark", F.col("key").bitwiseXOR(F.call_function("shiftleft", one, F.col("bit"))).alias("key"), F.lit(True).alias("flipped"))
    )
    probes = ball.unionByName(entries.select("mark", "key", F.lit(False).alias("flipped")))
    table = entries.select("key", F.col("mark").alias("other"))
    near = F.bit_count(F.col("mark").bitwiseXOR(F.col("other"))) <= distance
    return (
        probes.join(table, "key")
        .where(near & (F.col("flipped") | (F.col("mark") < F.col("other"))))
        .select(F.least("mark", "other").alias("a"), F.greatest("mark", "other").alias("b"))
        .distinct()
    )


def _signed(bits: int) -> int:
    bits &= (1 << 64) - 1
    return bits - (1 << 64) if bits >> 63 else bits


def near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = 3, distance: int = FARTHEST
) -> DataFrame:
    """One row per row of ``docs``: its id, ``text_hash``, ``mark``, ``component_id`` and ``kept``.

    Documents are linked where their fingerprints differ in ``distance`` bits or
    fewer; ``component_id`` is the smallest id that links reach. Equal
    fingerprints are one node, so copies cost one node and no pairs.

    * NULL and empty texts, and texts without words, share fingerprint zero.
    * NULL ids come last: they name a component only where all its ids are NULL.
    * ``kept`` marks one (id, text) of each component: the smallest id, then the
      smallest hash of the text. Rows alike in both are all marked.
    * An empty table gives an empty table; other columns are not read.
    """
    rows = settled(
        docs.select(
            F.col(id).alias(id),
            F.xxhash64(F.col(text)).alias("text_hash"),
            fingerprint(F.col(text), words).alias("mark"),
        )
    )
    nodes = settled(rows.groupBy("mark").agg(_first(id).alias("first")))
    roots = components(links(nodes.select("mark"), distance))
    return grouped(rows, roots, id, nodes)


def _first(id: str) -> Column:
    return F.min(F.struct(F.col(id).isNull().alias("none"), F.col(id).alias("id"), F.col("text_hash").alias("hash")))


def grouped(rows: DataFrame, roots: DataFrame, id: str, nodes: DataFrame | None = None) -> DataFrame:
    """Rows (id, text_hash, mark) with ``component_id`` and ``kept``, by the (node, root) of their marks."""
    if nodes is None:
        nodes = settled(rows.groupBy("mark").agg(_first(id).alias("first")))
    rooted = nodes.join(roots.withColumnRenamed("node", "mark"), "mark", "left").withColumn("root", F.coalesce("root", "mark"))
    firsts = rooted.groupBy("root").agg(F.min("first").alias("least"))
    named = rooted.select("mark", "root").join(firsts, "root").select("mark", "least")
    return rows.join(named, "mark").select(
        id,
        "text_hash",
        "mark",
        F.col("least.id").alias("component_id"),
        (F.col(id).eqNullSafe(F.col("least.id")) & (F.col("text_hash") == F.col("least.hash"))).alias("kept"),
    )


def drop_near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = 3, distance: int = FARTHEST
) -> DataFrame:
    """``docs`` with one row of each component of near_duplicates(), all columns as they were.

    Rows alike in id and text are one document: one of them stays.
    """
    return one_of_each(docs, near_duplicates(docs, id, text, words, distance), id, text)


def one_of_each(docs: DataFrame, judged: DataFrame, id: str, text: str) -> DataFrame:
    """The rows of ``docs`` that ``judged`` (id, text_hash, kept) keeps; one of those alike in id and text."""
    kept = judged.where("kept").select(F.col(id).alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    own = f"_{docs.columns.index(id)}"
    whole = veiled(docs).withColumn("_text", F.xxhash64(F.col(f"_{docs.columns.index(text)}")))
    return (
        whole.join(kept, F.col(own).eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_hash")), "left_semi")
        .dropDuplicates([own, "_text"])
        .select(*unveiled(docs.columns))
    )
