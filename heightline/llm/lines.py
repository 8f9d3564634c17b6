"""Near-duplicate lines by a segment-partition edit join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rows import HAS_WORD, SMALL_ROWS, join_checked, let, settled, unveiled, veiled

EDITS = 2
# Shorter lines stay as they are: at two edits they are too alike by chance.
LEAST_POINTS = 20


def segments(edits: int) -> int:
    """Segments of a line: one more than the edits, so that one of them is free of edits."""
    return edits + 1


def _bounds(length: Column, i: int, edits: int) -> tuple[Column, Column]:
    """(start, size) of segment i (from 0) of a line of that length; the last ones take the remainder."""
    count = segments(edits)
    base = F.floor(length / count).cast("int")
    longer = (length % count).cast("int")
    start = base * i + F.greatest(F.lit(0), F.lit(i - count) + longer)
    size = base + F.when(F.lit(i) >= F.lit(count) - longer, 1).otherwise(0)
    return start, size


def shifts(edits: int, shorter_by: int, i: int) -> range:
    """Places, relative to its own, where segment i of a line that is shorter by so much can sit in the longer line.

    From the left, i edits can come before it; from the right, edits - i after it.
    """
    return range(max(-i, shorter_by - (edits - i)), min(i, shorter_by + (edits - i)) + 1)


def _key(line: Column, of: Column, i: int, shift: int, edits: int) -> Column:
    start, size = _bounds(of, i, edits)
    return F.xxhash64(F.lit(i), of, F.substring(line, start + 1 + shift, size))


def _probes(line: Column, length: Column, edits: int) -> Column:
    """Array of (key, own): a line's index entries, and its probes for lines of its length and shorter.

    Its own entries are the segments of its own length at their own places.
    """
    entries = []
    for shorter_by in range(edits + 1):
        for i in range(segments(edits)):
            for shift in shifts(edits, shorter_by, i):
                own = F.lit(shorter_by == 0 and shift == 0)
                entries.append(F.struct(_key(line, length - shorter_by, i, shift, edits).alias("key"), own.alias("own")))
    return F.array(*entries)


# Letters that are counted to tell unlike lines apart before their text is read; four bits each.
LETTERS = "eaionrtshldc"


def letter_counts(line: Column) -> Column:
    """Counts of some letters, modulo 16, in one number."""
    packed = F.lit(0)
    for i, letter in enumerate(LETTERS):
        n = F.octet_length(line) - F.octet_length(F.replace(line, F.lit(letter), F.lit("")))
        packed = packed.bitwiseOR(F.shiftleft((n % 16).cast("long"), 4 * i))
    return packed


def may_be_near(a: Column, b: Column, edits: int) -> Column:
    """Whether letter counts allow for so many edits: an edit changes two of them by one at most."""
    apart = F.lit(0)
    for i in range(len(LETTERS)):
        step = (F.shiftright(a, 4 * i) - F.shiftright(b, 4 * i)).bitwiseAND(15)
        apart = apart + F.least(step, 16 - step)
    return apart <= 2 * edits


def occurrences(docs: DataFrame, id: str, text: str, least: int) -> DataFrame:
    """(id, doc, at, line) for the lines that are compared: with a word, and at least ``least`` code points.

    ``doc`` is a hash of the text, which with the id tells documents apart.
    """
    split = docs.select(
        F.col(id).alias("id"), F.xxhash64(F.col(text)).alias("doc"), F.split(F.col(text), "\n").alias("lines")
    )
    lines = split.select("id", "doc", F.posexplode("lines").alias("at", "line"))
    return lines.where((F.char_length("line") >= least) & F.col("line").rlike(HAS_WORD))


def _place() -> Column:
    return F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("doc").alias("doc"), F.col("at").alias("at"))


def repeated_lines(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    edits: int = EDITS,
    least: int = LEAST_POINTS,
    most: int = SMALL_ROWS,
) -> DataFrame:
    """(id, doc, at) of every line that goes: equal to an earlier line, or within ``edits`` of an earlier one.

    A line's place is the least (id, text hash, line number) at which it stands.
    Of equal lines the one at that place stays, unless a line with an earlier
    place is within ``edits`` (Levenshtein); then they all go.

    Lines are cut into edits + 1 segments, one of which two lines within the
    edits must share, at nearly the same place. Segments are stored under
    (number, length of the line, text); lines probe them for their own and each
    smaller length. Equal lines are one line here, so a line that is very common
    meets no copies of itself. Matches whose letter counts differ too much for
    the edits are left out in the join; the others are verified with Spark's
    banded edit distance. All keys are 64-bit hashes.
    """
    if least < 2 * edits + 1:
        raise ValueError("a compared line needs a code point for each segment, also when it is shorter by the edits")
    found = occurrences(docs, id, text, least)
    keyed = found.withColumn("hash", F.xxhash64("line"))
    slim = settled(keyed.select("id", "doc", "at", "hash"))
    repeats = settled(
        slim.groupBy("hash")
        .agg(F.count(F.lit(1)).alias("n"), F.min(_place()).alias("first"))
        .where("n > 1")
        .select("hash", "first")
    )
    first = repeats.select(F.col("hash").alias("_hash"), F.col("first").alias("_first"))
    single = join_checked(keyed, first, F.col("hash") == F.col("_hash"), "left", most).where(
        F.col("_hash").isNull() | (_place() == F.col("_first"))
    )
    # Beside a generator an expression is worked out for each row it makes, below it once.
    measured = single.withColumn("length", F.char_length("line")).withColumn("letters", letter_counts(F.col("line")))
    entries = (
        measured.select("hash", "letters", F.explode(_probes(F.col("line"), F.col("length"), edits)).alias("e"))
        .select("hash", "letters", "e.*")
        .repartition("key")
    )
    # Both sides of the join are one shuffle, read twice: a condition on the partition keeps
    # the filter of the index from being pushed below it, which would make them two.
    stored = entries.where(F.when(F.spark_partition_id() >= 0, F.col("own"))).select(
        "key", F.col("hash").alias("other"), F.col("letters").alias("other_letters")
    )
    pairs = settled(
        entries.join(stored, "key")
        .where((F.col("hash") < F.col("other")) | (~F.col("own") & (F.col("hash") > F.col("other"))))
        .where(may_be_near(F.col("letters"), F.col("other_letters"), edits))
        .select(F.least("hash", "other").alias("a"), F.greatest("hash", "other").alias("b"))
        .distinct()
    )
    ends = pairs.select(F.col("a").alias("_end")).union(pairs.select("b")).distinct()
    texts = settled(
        join_checked(keyed, ends, F.col("hash") == F.col("_end"), "left_semi", most)
        .groupBy("hash")
        .agg(F.min(_place()).alias("place"), F.min("line").alias("line"))
    )
    left = texts.select(F.col("hash").alias("a"), F.col("place").alias("place_a"), F.col("line").alias("line_a"))
    right = texts.select(F.col("hash").alias("b"), F.col("place").alias("place_b"), F.col("line").alias("line_b"))
    near = (
        pairs.join(left, "a")
        .join(right, "b")
        .where(F.levenshtein("line_a", "line_b", edits) >= 0)
        .select(F.when(F.col("place_a") < F.col("place_b"), F.col("b")).otherwise(F.col("a")).alias("hash"))
        .distinct()
    )
    judged = repeats.join(near.withColumn("near", F.lit(True)), "hash", "full").select(
        F.col("hash").alias("_hash"), F.col("first").alias("_first"), F.col("near").alias("_near")
    )
    return (
        join_checked(slim, judged, F.col("hash") == F.col("_hash"), "inner", most)
        .where(F.col("_near").isNotNull() | (_place() != F.col("_first")))
        .select("id", "doc", "at")
    )


def drop_repeated_lines(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    edits: int = EDITS,
    least: int = LEAST_POINTS,
    most: int = SMALL_ROWS,
) -> DataFrame:
    """``docs`` with the lines of repeated_lines() taken out of ``text``, and ``lines_removed`` (INT).

    * A NULL text stays NULL, an empty one empty; lines without a word, or
      shorter than ``least`` code points, stay.
    * NULL ids come last. Rows alike in id and text are one document and keep
      the same lines.
    * Other columns stay as they are; one named ``lines_removed`` is replaced.
      An empty table gives an empty table.
    """
    gone = (
        repeated_lines(docs, id, text, edits, least, most)
        .groupBy(F.col("id").alias("_id"), F.col("doc").alias("_doc"))
        .agg(F.collect_set("at").alias("_gone"))
    )
    columns = [c for c in docs.columns if c != "lines_removed"]
    old = [f"_{i}" for i in range(len(columns))]
    own, body = (F.col(f"_{columns.index(c)}") for c in (id, text))
    joined = (
        veiled(docs.select(*columns))
        .withColumn("_hash", F.xxhash64(body))
        .join(gone, own.eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_doc")), "left")
        .select(*old, "_gone")
    )
    lines = let(joined, "_lines", F.when(F.col("_gone").isNotNull(), F.split(body, "\n")))
    left = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_gone"))
    cleaned = F.when(F.col("_gone").isNull(), body).otherwise(
        F.array_join(F.transform(left, lambda i: F.get(F.col("_lines"), i)), "\n")
    )
    return lines.withColumn(f"_{columns.index(text)}", cleaned).select(
        *unveiled(columns),
        F.coalesce(F.when(F.col("_gone").isNotNull(), F.size("_gone")), F.lit(0)).alias("lines_removed"),
    )
