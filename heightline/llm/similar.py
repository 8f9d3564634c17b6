"""Near copies by the exact Jaccard similarity of word shingles, among the candidates of MinHash bands."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .rows import SMALL_ROWS, join_checked, join_settled, settled, stored
from .simhash import grouped, one_of_each

SHINGLE = 5
SIMILARITY = 0.8
# Pairs at the least similarity share no band of 16 times 3 values in one of 100,000 cases.
BANDS = 16
VALUES = 3
_PART = 4096
# A pair costs about as much as a shingle, and a text has some 50.
FEW = 32

_RNG = np.random.default_rng(20)
_FLIPS = _RNG.integers(0, 1 << 64, BANDS * VALUES, dtype=np.uint64)
_ODDS = _RNG.integers(0, 1 << 64, BANDS * VALUES, dtype=np.uint64) | np.uint64(1)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * _MIX
    return x ^ (x >> np.uint64(32))


def words_in(text: str | None) -> list[bytes]:
    """Words as bytes, A-Z in lower case; both methods of bytes know ASCII only."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingles_of(words: list[bytes]) -> set[bytes]:
    """The distinct shingles of a text; fewer words than a shingle are one."""
    count = max(len(words) - SHINGLE + 1, 1)
    return {b" ".join(words[i : i + SHINGLE]) for i in range(count)}


def jaccard(a: list[bytes], b: list[bytes]) -> float:
    left, right = shingles_of(a), shingles_of(b)
    both = len(left & right)
    return both / (len(left) + len(right) - both)


def _shingle_hashes(hashes: np.ndarray, firsts: np.ndarray | slice) -> np.ndarray:
    """Hashes of the shingles that begin at ``firsts`` in words with these hashes."""
    width = len(hashes) - SHINGLE + 1
    shingles = hashes[:width][firsts]
    for i in range(1, SHINGLE):
        shingles = shingles * _MIX + hashes[i : width + i][firsts]
    return _mixed(shingles)


def _shingle_set(words: list[bytes]) -> np.ndarray:
    """Hashes of shingles_of(), in order."""
    if len(words) < SHINGLE:
        words = [b" ".join(words)]
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    return hashes if len(words) < SHINGLE else np.unique(_shingle_hashes(hashes, slice(None)))


def band_keys(words: list[bytes], bands: int = BANDS, values: int = VALUES) -> tuple[np.ndarray, int]:
    """(a key per band, number of distinct shingles); no key without a whole shingle."""
    if len(words) < SHINGLE:
        return np.empty(0, np.uint64), 1
    shingles = _shingle_set(words)
    count = bands * values
    least = np.full(count, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(shingles), _PART):
        part = (shingles[at : at + _PART, None] ^ _FLIPS[:count]) * _ODDS[:count]
        least = np.minimum(least, part.min(axis=0))
    rows = _mixed(least).reshape(bands, values)
    keys = np.arange(1, bands + 1, dtype=np.uint64)
    for v in range(values):
        keys = _mixed(keys * _MIX + rows[:, v])
    return keys, len(shingles)


def bands_of(hashes: np.ndarray, counts: np.ndarray, bands: int, values: int) -> tuple[np.ndarray, np.ndarray]:
    """band_keys() of many texts at once: (a row of keys, the number of distinct shingles) of each.

    ``hashes`` are those of the words, one text after the other, and ``counts``
    the words of each text: a whole shingle at least.
    """
    if not len(counts):
        return np.empty((0, bands), np.uint64), np.empty(0, np.int64)
    spans = counts - SHINGLE + 1
    firsts = np.cumsum(spans) - spans
    owner = np.repeat(np.arange(len(counts)), spans)
    shingles = _shingle_hashes(hashes, np.arange(len(owner)) + (np.cumsum(counts) - counts - firsts)[owner])
    least = np.empty((len(counts), bands * values), np.uint64)
    for v in range(bands * values):
        least[:, v] = np.minimum.reduceat((shingles ^ _FLIPS[v]) * _ODDS[v], firsts)
    rows = _mixed(least).reshape(-1, bands, values)
    keys = np.arange(1, bands + 1, dtype=np.uint64)
    for v in range(values):
        keys = _mixed(keys * _MIX + rows[:, :, v])
    return keys, spans - _repeated(shingles, owner, len(counts))


def _repeated(values: np.ndarray, owner: np.ndarray, owners: int) -> np.ndarray:
    """How many of the values of each owner stand there a second time, or a further one."""
    marks = values ^ (owner.astype(np.uint64) * _MIX)
    ordered = np.sort(marks)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return np.zeros(owners, np.int64)
    # Equal marks nearly always are equal values; these few are told exactly.
    at = np.flatnonzero(twice[np.minimum(np.searchsorted(twice, marks), len(twice) - 1)] == marks)
    at = at[np.lexsort((values[at], owner[at]))]
    again = (owner[at][1:] == owner[at][:-1]) & (values[at][1:] == values[at][:-1])
    return np.bincount(owner[at][1:][again], minlength=owners)


def _filed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text_hash, mark, size, keys); the mark is a hash of the words."""
    for batch in batches:
        marks, sizes, keys = [], [], []
        for t in batch.column(2):
            words = words_in(t.as_py())
            found, size = band_keys(words)
            marks.append(xxhash.xxh64_intdigest(b" ".join(words)))
            sizes.append(size)
            keys.append(found.view(np.int64))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.array(np.array(marks, dtype=np.uint64).view(np.int64)),
                pa.array(sizes, pa.int64()),
                pa.array(keys, pa.list_(pa.int64())),
            ],
            names=["id", "text_hash", "mark", "size", "keys"],
        )


def _bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, words): the words joined with spaces."""
    for batch in batches:
        texts = [b" ".join(words_in(t.as_py())) for t in batch.column(0)]
        marks = np.array([xxhash.xxh64_intdigest(t) for t in texts], dtype=np.uint64)
        yield pa.RecordBatch.from_arrays([pa.array(marks.view(np.int64)), pa.array(texts, pa.binary())], names=["node", "words"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, shingles) of (node, words): the hashes of the distinct shingles."""
    for batch in batches:
        found = [_shingle_set(t.as_py().split()).view(np.int64) for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], names=["node", "shingles"])


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose sets are similar, by their exact Jaccard similarity."""
    both = F.size(F.array_intersect("a_set", "b_set"))
    return (
        pairs.join(sets.toDF("b", "b_set"), "b")
        .join(sets.toDF("a", "a_set"), "a")
        .where(both / (F.size("a_set") + F.size("b_set") - both) >= similarity)
        .select("a", "b")
    )


def _candidates(rest: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) of nodes in different components that share a key; all pairs that are similar are among them.

    ``rest`` has (key, node, size, root). The shingles of a node are put in one
    order for all, rare ones first. Two similar sets share one of the few first
    shingles of each, as long as fewer stand behind than the sets must have in
    common; and from the first they share on, enough of both must be left.
    So nodes that share but a frequent passage never meet.
    """
    opened = stored(rest.groupBy("node", "size", "root").agg(F.collect_set("key").alias("keys")))
    shingles = sets.join(opened.select("node", "size"), "node").select("node", "size", F.explode("shingles").alias("shingle"))
    shared = shingles.groupBy("shingle").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # Shingles that one node has alone come first in its order; they meet none.
    size, alone = F.col("size"), F.col("size") - F.size("ordered")
    first = size - F.ceil(similarity * size - 1e-9) + 1
    front = stored(
        shingles.join(shared, "shingle")
        .groupBy("node", "size")
        .agg(F.array_sort(F.collect_list(F.struct("n", "shingle"))).alias("ordered"))
        .select("node", alone.alias("alone"), F.slice("ordered.shingle", 1, F.greatest(first - alone, F.lit(0)).cast("int")).alias("front"))
        .join(opened, "node")
        .select("node", "size", "root", "keys", "front", "alone", F.posexplode("front").alias("at", "shingle"))
        .select("node", "size", "root", "keys", "front", "shingle", (size - F.col("alone") - F.col("at")).alias("left"))
    )
    other = front.toDF("other", "other_size", "other_root", "other_keys", "other_front", "shingle", "other_left")
    sizes = F.col("size") + F.col("other_size")
    return (
        front.join(other, "shingle")
        .where(
            _apart()
            & (F.least("left", "other_left") >= similarity / (1 + similarity) * sizes - 1e-9)
            & _fits(similarity)
            & F.arrays_overlap("keys", "other_keys")
            # A pair is told once, by the first shingle that its fronts share.
            & (F.array_intersect("front", "other_front")[0] == F.col("shingle"))
        )
        .select(F.col("node").alias("a"), F.col("other").alias("b"))
    )


def _apart() -> Column:
    return (F.col("node") < F.col("other")) & (F.col("root") != F.col("other_root"))


def _fits(similarity: float) -> Column:
    return F.least("size", "other_size") >= similarity * F.greatest("size", "other_size") - 1e-9


def linked(
    members: DataFrame,
    bodies: DataFrame | Callable[[DataFrame], DataFrame],
    similarity: float = SIMILARITY,
    most: int = SMALL_ROWS,
) -> DataFrame:
    """(node, root) of the nodes similar to another that shares a key with them; equal roots mean one component.

    ``members`` has (key, node, size), with the number of distinct shingles;
    ``bodies`` has (node, words), or gives it for a table of nodes. Both may
    repeat rows; the result is stored. Shingles are told by 64-bit hashes.
    The components are those of all similar pairs that share a key, though not
    all pairs are compared. First every node meets
    the smallest of its key: as many pairs as nodes, however many copies a key
    holds. Then, in keys that still hold several components, the pairs of
    different components are compared; the others are joined already. Of keys
    with more than FEW such nodes these are the pairs that can be similar by
    their rarest shingles.
    """
    shared = members.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi"), F.min_by("size", "node").alias("other_size"))
    met = stored(join_checked(members, shared.where("lo <> hi").drop("hi"), "key", "inner", most).distinct())
    wanted = met.select("node").distinct()
    whole = bodies(wanted) if callable(bodies) else join_checked(bodies, wanted, "node", "left_semi", most)
    sets = stored(whole.groupBy("node").agg(F.min("words").alias("words")).mapInArrow(_sets, "node long, shingles array<long>"))
    low = met.where((F.col("node") != F.col("lo")) & _fits(similarity)).select(F.col("lo").alias("a"), F.col("node").alias("b")).distinct()
    roots = stored(components(_verified(low, sets, similarity)))
    rooted = stored(join_settled(met.drop("other_size"), roots, "node", "left", most).withColumn("root", F.coalesce("root", "node")))
    split = stored(rooted.groupBy("key").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 <> r1").select("key"))
    # Pairs with the smallest node of the key have been compared.
    rest = join_settled(rooted, split, "key", "left_semi", most).where("node <> lo").drop("lo")
    rest = stored(rest.join(rest.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "key"))
    few, many = rest.where(F.col("n") <= FEW).drop("n"), rest.where(F.col("n") > FEW).drop("n")
    others = few.toDF("key", "other", "other_size", "other_root")
    pairs = few.join(others, "key").where(_apart() & _fits(similarity)).select(F.col("node").alias("a"), F.col("other").alias("b"))
    if not many.isEmpty():
        pairs = pairs.union(_candidates(many, sets, similarity))
    second = stored(_verified(pairs.distinct(), sets, similarity))
    return roots if second.isEmpty() else stored(components(roots.toDF("a", "b").union(second)))


def near_copies(docs: DataFrame, id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY, most: int = SMALL_ROWS) -> DataFrame:
    """One row per row of ``docs``, as simhash.near_duplicates() has them; ``mark`` is a hash of the words.

    Documents are linked where the Jaccard similarity of their distinct 5-word
    shingles is ``similarity`` or more; words are those of the fingerprint.
    Documents with the same words are one node. Texts without words, NULL
    among them, are alike.
    """
    rows = docs.select(F.col(id).alias("id"), F.xxhash64(F.col(text)).alias("text_hash"), F.col(text).alias("text"))
    kind = dict(rows.dtypes)["id"]
    filed = settled(rows.mapInArrow(_filed, f"id {kind}, text_hash long, mark long, size long, keys array<long>"))
    members = filed.select(F.explode("keys").alias("key"), F.col("mark").alias("node"), "size")
    bodies = rows.select("text").mapInArrow(_bodies, "node long, words binary")
    roots = linked(members, bodies, similarity, most)
    return grouped(filed.select(F.col("id").alias(id), "text_hash", "mark"), roots, id)


def drop_near_copies(docs: DataFrame, id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with one row of each component of near_copies(), all columns as they were."""
    return one_of_each(docs, near_copies(docs, id, text, similarity), id, text)
