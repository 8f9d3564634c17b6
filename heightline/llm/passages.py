"""Passages that repeat across documents: near copies of lines, and equal runs of words anywhere in them."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .rows import SMALL_ROWS, hashed_side, join_checked, join_settled, settled, stored
from .similar import SHINGLE, SIMILARITY, bands_of, jaccard, linked, words_in  # noqa: F401
from .words import hashed, lowered, words_at

# A border is the smallest word pair among this many before and after it.
REACH = 4
# Two lines at the least similarity share no band in 3 of 10,000 cases.
BANDS = 8
VALUES = 2
# Texts are split together up to this many bytes.
PORTION = 1 << 20
# Shorter runs of repeated words are not passages, and shorter lines no near copies.
LEAST_WORDS = 16

_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], dtype=np.uint64)
_TOP = np.iinfo(np.uint64).max


def _mixed(values: np.ndarray, round_: int) -> np.ndarray:
    x = (values ^ (values >> np.uint64(29))) * _ODD[round_ % 4]
    x = (x ^ (x >> np.uint64(32))) * _ODD[(round_ + 1) % 4]
    return x ^ (x >> np.uint64(31))


class Paragraphs:
    """The paragraphs of texts: borders, and a hash of all words of each; one text after the other.

    A text is given by its words, or texts by the hashes of theirs and the
    ``counts`` of each. The first word and the end of a text are borders. A
    paragraph begins where the hash of two words is smaller than those of the
    REACH pairs before, and no larger than those of as many after. So the
    words around decide, not the place: a passage has the same borders wherever
    it stands, but for its ends. Paragraphs have more than REACH words, and
    about twice that. A text without words has one border and no paragraph.
    """

    def __init__(self, words: list[bytes] | np.ndarray, counts: np.ndarray | None = None):
        hashes = words if isinstance(words, np.ndarray) else np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
        counts = np.array([len(hashes)]) if counts is None else counts
        n = len(hashes)
        self.hashes = hashes
        # The first word of each text, and the text of each word.
        self.firsts = np.cumsum(counts) - counts
        owner = np.repeat(np.arange(len(counts)), counts)
        held = counts > 0
        begins = np.zeros(n, bool)
        if n:
            pairs = np.empty(n, np.uint64)
            pairs[:-1] = _mixed(hashes[:-1] * np.uint64(3) + hashes[1:], 0)
            pairs[(self.firsts + counts - 1)[held]] = _TOP
            # REACH places between the pairs of two texts, and at both ends.
            at = np.arange(n) + REACH * owner
            padded = np.full(at[-1] + 1 + 2 * REACH, _TOP, np.uint64)
            padded[at + REACH] = pairs
            size = len(padded) - 2 * REACH
            lowest = np.ones(size, bool)
            middle = padded[REACH : REACH + size]
            for step in range(1, REACH + 1):
                lowest &= middle < padded[REACH - step : REACH - step + size]
                lowest &= middle <= padded[REACH + step : REACH + step + size]
            begins = lowest[at] & (counts > REACH + 1)[owner]
            begins[self.firsts[held]] = True
        starts = np.flatnonzero(begins)
        sizes = np.diff(np.append(starts, n))
        self.counts = np.bincount(owner[starts], minlength=len(counts))
        # The borders of each text, from its first word on; where its first stands, and its last.
        self.last = np.cumsum(self.counts + 1) - 1
        self.first = self.last - self.counts
        self.borders = np.empty(len(starts) + len(counts), np.int64)
        inner = np.ones(len(self.borders), bool)
        inner[self.last] = False
        self.borders[inner] = starts - self.firsts[owner[starts]]
        self.borders[self.last] = counts
        self.whole = np.empty(0, np.uint64)
        if n:
            # Word hashes weighed by their place in the paragraph.
            place = np.arange(n) - np.repeat(starts, sizes)
            weighed = _mixed(hashes + place.astype(np.uint64) * _ODD[2], 2)
            self.whole = _mixed(np.add.reduceat(weighed, starts) + sizes.astype(np.uint64) * _ODD[0], 0)


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.uint64, copy=False).view(np.int64))


def _listed(values: pa.Array, counts: np.ndarray) -> pa.Array:
    """Lists of as many values each as ``counts`` says."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), values)


def _portions(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows (id, doc, text, ...) in turn until their texts have PORTION bytes."""
    begin, held = 0, 0
    for i, size in enumerate(pc.fill_null(pc.binary_length(batch.column(2)), 0).to_pylist()):
        held += size
        if held >= PORTION or i + 1 == batch.num_rows:
            yield batch.slice(begin, i + 1 - begin)
            begin, held = i + 1, 0


SPLIT = "nodes array<long>, starts array<int>, words array<int>, sizes array<int>, keys array<long>, paragraphs array<long>, borders array<int>"


def _split(least: int):
    """Texts to lines and paragraphs, in one pass.

    Of the lines of at least ``least`` words: a hash of the words, the number of
    words before and in them, of their distinct shingles, and BANDS keys each,
    one line after the other. Of the paragraphs: a hash, and the borders.
    """

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _portions(batch):
                lines = pc.split_pattern(lowered(part.column(2)), "\n")
                owner = pc.list_parent_indices(lines).to_numpy(zero_copy_only=False)
                words, count = words_at(lines.flatten())
                hashes = hashed(words)
                # By line, with the text it stands in.
                begin = np.cumsum(count) - count
                inside = np.bincount(owner, weights=count, minlength=part.num_rows).astype(np.int64)
                found = Paragraphs(hashes, inside)
                long = count >= max(least, SHINGLE)
                keys, sizes = bands_of(hashes[np.repeat(long, count)], count[long], BANDS, VALUES)
                held = np.bincount(owner[long], minlength=part.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        _listed(_signed(hashed(pc.binary_join(_listed(words, count).filter(pa.array(long)), " "))), held),
                        _listed(pa.array((begin - found.firsts[owner])[long].astype(np.int32)), held),
                        _listed(pa.array(count[long].astype(np.int32)), held),
                        _listed(pa.array(sizes.astype(np.int32)), held),
                        _listed(_signed(keys.ravel()), held * BANDS),
                        _listed(_signed(found.whole), found.counts),
                        _listed(pa.array(found.borders.astype(np.int32)), found.counts + 1),
                    ],
                    names=["id", "doc", "nodes", "starts", "words", "sizes", "keys", "paragraphs", "borders"],
                )

    return split


def split_texts(rows: DataFrame, least: int) -> DataFrame:
    """(id, doc, SPLIT, row) of rows (id, doc, text), read once and stored; what follows takes lines and paragraphs from here.

    ``row`` is a number of the row, to stand for id and doc.
    """
    kind = dict(rows.dtypes)["id"]
    return stored(rows.mapInArrow(_split(least), f"id {kind}, doc long, {SPLIT}").withColumn("row", F.monotonically_increasing_id()))


def _alike(split: DataFrame) -> bool:
    """Whether some rows are alike in id and text."""
    return not split.groupBy("id", "doc").count().where("count > 1").isEmpty()


def _texts_at(rows: DataFrame, places: DataFrame, most: int) -> DataFrame:
    """(id, doc, text, places) of the texts that ``places`` (id, doc, places) asks for."""
    return join_checked(
        rows, places.toDF("_id", "_doc", "places"), F.col("id").eqNullSafe(F.col("_id")) & (F.col("doc") == F.col("_doc")), "inner", most
    ).select("id", "doc", "text", "places")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, words) of the lines at the places (node, start, words) of texts."""
    for batch in batches:
        node, lines = [], []
        for t, places in zip(batch.column(0), batch.column(1)):
            words = words_in(t.as_py())
            for p in places.as_py():
                node.append(p["node"])
                lines.append(b" ".join(words[p["start"] : p["start"] + p["words"]]))
        yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(lines, pa.binary())], names=["node", "words"])


def _bodies(rows: DataFrame, split: DataFrame, most: int):
    """(node, words) of a table of nodes, each cut from one of the texts it stands in."""

    def bodies(nodes: DataFrame) -> DataFrame:
        placed = split.select("id", "doc", "starts", "words", F.posexplode("nodes").alias("k", "node")).select(
            "id", "doc", "node", F.expr("starts[k]").alias("start"), F.expr("words[k]").alias("words")
        )
        one = join_checked(placed, nodes, "node", "left_semi", most).groupBy("node").agg(*(F.first(c).alias(c) for c in ("id", "doc", "start", "words")))
        places = one.groupBy("id", "doc").agg(F.collect_list(F.struct("node", "start", "words")).alias("places"))
        return _texts_at(rows, places, most).select("text", "places").mapInArrow(_cut, "node long, words binary")

    return bodies


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, doc, start, end, pid, pdoc, delta, root, before, after) of rows (id, doc, text, places).

    A place is (start, end, pid, pdoc, delta, root), from border to border. The
    words before it from the last on, and those after it, are given as hashes.
    Where two texts are equal, their borders are too. So words that go on
    equal end within the next paragraph or the few words that decide its border.
    """
    more = REACH + 2
    for batch in batches:
        for part in _portions(batch):
            words, counts = words_at(lowered(part.column(2)))
            p = Paragraphs(hashed(words), counts)
            signed = p.hashes.view(np.int64)
            row = pc.list_parent_indices(part.column(3)).to_numpy(zero_copy_only=False)
            places = part.column(3).flatten()
            columns = dict(zip((f.name for f in places.type), places.flatten()))
            first, count = p.firsts[row], counts[row]
            # Borders of all texts in one order: between two texts, one place is free.
            texts = np.repeat(np.arange(len(counts)), p.counts + 1)
            line = p.borders + p.firsts[texts] + texts
            start, end = (columns[c].to_numpy(zero_copy_only=False) for c in ("start", "end"))
            k = np.maximum(np.searchsorted(line, start + first + row) - 1, p.first[row])
            low = np.maximum(p.borders[k] - more, 0)
            k = np.minimum(np.searchsorted(line, end + first + row) + 1, p.last[row])
            high = np.minimum(p.borders[k] + more, count)
            sizes = start - low
            at = np.repeat(first + start - 1, sizes) - _counted(sizes)
            before = _listed(pa.array(signed[at]), sizes)
            sizes = high - end
            at = np.repeat(first + end, sizes) + _counted(sizes)
            after = _listed(pa.array(signed[at]), sizes)
            row = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(row), part.column(1).take(row), *columns.values(), before, after],
                names=["id", "doc", *columns, "before", "after"],
            )


def _counted(sizes: np.ndarray) -> np.ndarray:
    """0, 1, 2 ... for each size, one after the other."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _common(a: str, b: str) -> Column:
    """How many values two arrays have in common from their first on."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    return F.array_position(F.concat(same, F.array(F.lit(False))), F.lit(False)) - 1


def _merged(least_words: int):
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(id, start, n_words, component_id, removed) from the ranges of a document; what one range removes goes."""
        for batch in batches:
            row, out = [], []
            owner = pc.list_parent_indices(batch.column(1)).to_pylist()
            parts = batch.column(1).flatten().flatten()
            for i, held in groupby(zip(owner, zip(*(c.to_pylist() for c in parts))), itemgetter(0)):
                for part in _parts([r for _, r in held], least_words):
                    row.append(i)
                    out.append(part)
            start, words, root, removed = zip(*out) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(row, pa.int64())),
                    pa.array(start, pa.int64()),
                    pa.array(words, pa.int64()),
                    pa.array(root, pa.int64()),
                    pa.array(removed, pa.bool_()),
                ],
                names=["id", "start", "n_words", "component_id", "removed"],
            )

    return merge


def _parts(ranges: list[tuple[int, int, bool, int]], least_words: int) -> list[tuple[int, int, int, bool]]:
    ranges = sorted(ranges)
    runs: list[list] = []
    for r in ranges:
        if runs and r[0] <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], r[1])
            runs[-1][2].append(r)
        else:
            runs.append([r[0], r[1], [r]])
    out = []
    for begin, end, held in runs:
        if end - begin < least_words:
            continue
        gone = np.zeros(end - begin, dtype=bool)
        names = np.zeros((2, end - begin), dtype=np.int64)
        for s, e, removed, root in reversed(held):
            gone[s - begin : e - begin] |= removed
            names[int(removed), s - begin : e - begin] = root
        cuts = [0, *(np.flatnonzero(gone[1:] != gone[:-1]) + 1).tolist(), end - begin]
        for a, b in zip(cuts, cuts[1:]):
            out.append((begin + a, b - a, int(names[int(gone[a]), a]), bool(gone[a])))
    return out


def line_hits(rows: DataFrame, similarity: float, least: int, most: int, split: DataFrame | None = None) -> DataFrame:
    """(id, doc, root, start, words, removed) of the lines with near copies: all but the first place of a component go.

    ``split`` is split_texts() of the rows, where it is at hand.
    """
    split = split_texts(rows, least) if split is None else split
    members = split.select("nodes", "sizes", F.posexplode("keys").alias("k", "key")).select(
        "key", F.expr(f"nodes[k DIV {BANDS}]").alias("node"), F.expr(f"sizes[k DIV {BANDS}]").cast("long").alias("size")
    )
    roots = linked(members, _bodies(rows, split, most), similarity, most).withColumnRenamed("node", "_node")
    placed = split.select("id", "doc", "starts", "words", F.posexplode("nodes").alias("k", "node")).select(
        "id", "doc", "node", F.expr("starts[k]").cast("long").alias("start"), F.expr("words[k]").cast("long").alias("words")
    )
    hits = stored(
        join_settled(placed, roots, F.col("node") == F.col("_node"), "inner", most).select("id", "doc", "root", "start", "words").distinct()
    )
    firsts = hits.groupBy("root").agg(F.min(_place()).alias("first"))
    return stored(hits.join(firsts, "root").withColumn("removed", _place() != F.col("first")).drop("first"))


def _place() -> Column:
    return F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("doc").alias("doc"), F.col("start").alias("start"))


def equal_runs(rows: DataFrame, gone: DataFrame, most: int, split: DataFrame, alike: bool) -> DataFrame:
    """(id, doc, start, end, root, removed): equal words at two places, at the later and at the first.

    A paragraph that repeats is held against its first place outside the lines
    ``gone`` (id, doc, start, words). Neighbours with the same partner are a
    run, which is extended word by word at both ends. ``split`` is
    split_texts() of the rows, without those alike in id and text; ``alike``
    tells that there are some.
    """
    kind = dict(rows.dtypes)["id"]
    known = (
        split.select(F.explode("paragraphs").alias("paragraph")).groupBy("paragraph").agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1").select(F.col("paragraph").alias("_paragraph"))
    )
    # All paragraphs may be shuffled here: places come from the row's borders after the join.
    placed = split.select("row", F.posexplode("paragraphs").alias("at", "paragraph"))
    known = settled(known)
    side = F.broadcast(known) if known.count() <= most else hashed_side(known)
    hits = placed.join(side, F.col("paragraph") == F.col("_paragraph")).drop("_paragraph")
    lines = gone.join(
        split.select("row", F.col("id").alias("_id"), F.col("doc").alias("_doc")), F.col("id").eqNullSafe(F.col("_id")) & (F.col("doc") == F.col("_doc"))
    ).select("row", "start", "words")
    hits = (
        hits.unionByName(lines, allowMissingColumns=True)
        .join(hashed_side(split.select("row", "id", "doc", "borders")), "row")
        .withColumn("start", F.coalesce("start", F.expr("borders[at]").cast("long")))
        .withColumn("words", F.coalesce("words", F.expr("borders[at + 1] - borders[at]").cast("long")))
        .drop("at", "borders")
    )
    in_doc = Window.partitionBy("row").orderBy("start")
    line = F.col("paragraph").isNull()
    hits = stored(
        hits.withColumn("before", F.max(F.when(line, F.col("start") + F.col("words"))).over(in_doc))
        .withColumn("after", F.min(F.when(line, F.col("start"))).over(in_doc.rowsBetween(0, Window.unboundedFollowing)))
        .where(~line)
        .withColumn("in_gone", F.coalesce(F.col("before") > F.col("start"), F.lit(False)) | F.coalesce(F.col("after") < F.col("start") + F.col("words"), F.lit(False)))
        .drop("row", "before", "after")
    )
    firsts = hits.where("NOT in_gone").groupBy("paragraph").agg(F.min(_place()).alias("first"))
    pairs = hits.join(hashed_side(firsts), "paragraph").where(_place() != F.col("first")).select(
        "id", "doc", "paragraph", "start", "words",
        F.col("first.id").alias("pid"), F.col("first.doc").alias("pdoc"), (F.col("start") - F.col("first.start")).alias("delta"),
    )
    same = ("id", "doc", "pid", "pdoc", "delta")
    in_turn = Window.partitionBy(*same).orderBy("start")
    end = F.col("start") + F.col("words")
    runs = stored(
        pairs.withColumn("opens", F.when(F.lag(end).over(in_turn) == F.col("start"), 0).otherwise(1))
        .withColumn("run", F.sum("opens").over(in_turn))
        .groupBy(*same, "run")
        .agg(F.min("start").alias("start"), F.max(end).alias("end"), F.min_by("paragraph", "start").alias("root"))
    )
    delta = F.col("delta")
    asked = runs.select("id", "doc", F.struct("start", "end", "pid", "pdoc", "delta", "root").alias("place"))
    none = F.lit(None)
    across = runs.select(F.col("pid").alias("id"), F.col("pdoc").alias("doc"), (F.col("start") - delta).alias("start"), (F.col("end") - delta).alias("end"))
    across = across.distinct().select(
        "id", "doc",
        F.struct(
            "start", "end", none.cast(kind).alias("pid"), none.cast("long").alias("pdoc"), none.cast("long").alias("delta"), none.cast("long").alias("root")
        ).alias("place"),
    )
    texts = _texts_at(rows, asked.union(across).groupBy("id", "doc").agg(F.collect_list("place").alias("places")), most)
    # Texts are shuffled to tell rows alike only where there are any.
    if alike:
        texts = texts.dropDuplicates(["id", "doc"])
    around = stored(
        texts.mapInArrow(
            _contexts,
            f"id {kind}, doc long, start long, end long, pid {kind}, pdoc long, delta long, root long, before array<long>, after array<long>",
        )
    )
    other = around.where("pdoc IS NULL").select(*(F.col(c).alias(f"_{c}") for c in ("id", "doc", "start", "end", "before", "after")))
    on = F.col("pid").eqNullSafe(F.col("_id")) & (F.col("pdoc") == F.col("_doc"))
    on &= (F.col("start") - delta == F.col("_start")) & (F.col("end") - delta == F.col("_end"))
    wide = around.where("pdoc IS NOT NULL").join(hashed_side(other), on).select(
        "id", "doc", "pid", "pdoc", "delta", "root",
        (F.col("start") - _common("before", "_before")).alias("start"), (F.col("end") + _common("after", "_after")).alias("end"),
    )
    later = F.struct("id", "doc", "start", "end", "root", F.lit(True).alias("removed"))
    first = F.struct(
        F.col("pid").alias("id"), F.col("pdoc").alias("doc"), (F.col("start") - F.col("delta")).alias("start"), (F.col("end") - F.col("delta")).alias("end"),
        "root", F.lit(False).alias("removed"),
    )
    return wide.select(F.explode(F.array(later, first)).alias("r")).select("r.*")


def repeated_passages(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    similarity: float = SIMILARITY,
    least_words: int = LEAST_WORDS,
    most: int = SMALL_ROWS,
) -> DataFrame:
    """One row per repeated passage: id, start, n_words, component_id, removed.

    A passage is a run of words that repeat, in other documents or in its own,
    of at least ``least_words`` words. Words repeat in a line with a near copy
    (line_hits) and in a run equal to one at another place (equal_runs). A
    passage is given in parts that stay or go together: the first place by id,
    hash of the text and order in it stays (``removed`` false), the others go.
    ``start`` is the number of words before it; ``component_id`` names the
    component of the part's first range.

    * Texts that are NULL or have no word give no row, as do texts without a
      repeated passage. NULL ids come last. Rows alike in id and text are copies
      of one place: their passages are told once.
    * Other columns are not read. An empty table gives an empty table.
    """
    rows = docs.select(F.col(id).alias("id"), F.xxhash64(F.col(text)).alias("doc"), F.col(text).alias("text"))
    kind = dict(rows.dtypes)["id"]
    split = split_texts(rows, least_words)
    alike = _alike(split)
    if alike:
        split = stored(split.dropDuplicates(["id", "doc"]))
    lines = line_hits(rows, similarity, least_words, most, split)
    runs = equal_runs(rows, lines.where("removed"), most, split, alike)
    ranges = lines.select("id", "doc", "start", (F.col("start") + F.col("words")).alias("end"), "root", "removed").union(runs).distinct()
    return (
        ranges.groupBy("id", "doc")
        .agg(F.collect_list(F.struct("start", "end", "removed", "root")).alias("ranges"))
        .select("id", "ranges")
        .mapInArrow(_merged(least_words), f"id {kind}, start long, n_words long, component_id long, removed boolean")
        .withColumnRenamed("id", id)
    )
