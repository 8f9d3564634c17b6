"""Quality of documents from a linear-chain conditional random field over their lines."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rows import settled

# Labelled documents that a model is fitted on, at most, of either label.
SAMPLE = 4_000
# The sample's lines are dealt over this many tasks; every step of the fit is one small job over them.
PARTS = 16
STEPS = 30
FIRST_STEPS = 12
PENALTY = 0.2

# Texts are measured in pieces of about this many code points, cut at line ends.
PIECE = 1 << 20

# Kinds of characters; ``_KIND`` has the kind of each code point of the first plane.
OTHER, UPPER, DIGIT, STOP, MARK, SYMBOL, BLANK, BREAK = range(8)
_KINDS = {STOP: ".!?", MARK: ",;:'\"()-", SYMBOL: "#*$%&|<>", BLANK: " \t\x0b\x0c\r", BREAK: "\n", DIGIT: "0123456789"}

FEATURES = (
    "upper", "symbols", "stops", "marks", "digits", "word_length", "words", "distinct",
    "same_as_before", "times_in_document", "short_words", "last_kind", "words_ended",
)
BINS = 8
# A neighbour beyond the first or last line has a bin of its own.
_WIDTH = BINS + 1
_COUNT = len(FEATURES)
_NODE = 3 * _COUNT * _WIDTH
_SIZE = _NODE + 4 + 2

_SHARES = np.array([1e-9, 0.02, 0.05, 0.1, 0.25, 0.5, 0.8])
_LENGTHS = np.array([1e-9, 2, 3, 4, 5.5, 7, 10])
_WORDS = np.array([1, 3, 6, 11, 21, 51, 151])
_TIMES = np.array([1, 2, 3, 5, 9, 17, 33])
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _kinds() -> np.ndarray:
    table = np.zeros(1 << 16, dtype=np.uint8)
    table[[i for i in range(1 << 16) if chr(i).isupper()]] = UPPER
    for kind, signs in _KINDS.items():
        table[[ord(c) for c in signs]] = kind
    return table


_KIND = _kinds()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * _ODD
    return x ^ (x >> np.uint64(32))


def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.full(max(n, 1), _ODD | np.uint64(1), dtype=np.uint64))


def _measure(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bins, line hash, code points) of the lines of a text; the bin of ``times_in_document`` is left at 0."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    kind = _KIND[np.minimum(codes, 0xFFFF)]
    breaks = kind == BREAK
    line = np.cumsum(breaks) - breaks
    n = int(breaks.sum()) + 1

    def count(mask: np.ndarray, of: np.ndarray = line) -> np.ndarray:
        return np.bincount(of[mask], minlength=n).astype(np.float64)

    solid = kind < BLANK
    chars = count(solid)
    by_kind = {k: count(kind == k) for k in (UPPER, SYMBOL, STOP, MARK, DIGIT)}
    points = np.bincount(line, minlength=n) - np.append(np.ones(n - 1), 0)
    bins = np.zeros((n, _COUNT), dtype=np.int8)
    hashes = np.zeros(n, dtype=np.uint64)
    some = np.maximum(chars, 1)
    for i, k in enumerate((UPPER, SYMBOL, STOP, MARK, DIGIT)):
        bins[:, i] = np.digitize(by_kind[k] / some, _SHARES)
    at = np.flatnonzero(solid)
    if len(at):
        first = np.append(True, np.diff(at) > 1)
        start = np.flatnonzero(first)
        size = np.diff(np.append(start, len(at)))
        offset = np.arange(len(at)) - np.repeat(start, size)
        # A word's hash is a sum over its characters, a line's over its words, each weighed by its place.
        word = _mixed(np.add.reduceat(_mixed(codes[at].astype(np.uint64) + np.uint64(1)) * _powers(int(offset.max()) + 1)[offset], start))
        of = line[at[start]]
        every = np.ones(len(of), dtype=bool)
        words = count(every, of)
        some_words = np.maximum(words, 1)
        same = np.append(False, (word[1:] == word[:-1]) & (of[1:] == of[:-1]))
        order = np.lexsort((word, of))
        new = np.append(True, (word[order][1:] != word[order][:-1]) | (of[order][1:] != of[order][:-1]))
        ends = kind[at[start + size - 1]]
        opening = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
        place = np.arange(len(of)) - np.repeat(opening, np.diff(np.append(opening, len(of))))
        hashes[of[opening]] = np.add.reduceat(word * _powers(int(place.max()) + 1)[place], opening)
        bins[:, 5] = np.digitize(chars / some_words, _LENGTHS)
        bins[:, 6] = np.digitize(words, _WORDS)
        bins[:, 7] = np.digitize(count(new, of[order]) / some_words, _SHARES)
        bins[:, 8] = np.digitize(count(same, of) / some_words, _SHARES)
        bins[:, 10] = np.digitize(count(size <= 3, of) / some_words, _SHARES)
        bins[of, 11] = ends  # of words of one line the last is written last
        bins[:, 12] = np.digitize(count((ends == STOP) | (ends == SYMBOL), of) / some_words, _SHARES)
    return bins, hashes, points


def _pieces(text: str) -> Iterator[str]:
    at = 0
    while len(text) - at > PIECE:
        end = text.find("\n", at + PIECE)
        if end < 0:
            break
        yield text[at:end]
        at = end + 1
    yield text[at:]


@dataclass
class Lines:
    """Lines of a few documents: their bins, their weights, and where each document starts (the end included)."""

    bins: np.ndarray
    weight: np.ndarray
    starts: np.ndarray

    @property
    def first(self) -> np.ndarray:
        mark = np.zeros(len(self.bins), dtype=bool)
        mark[self.starts[:-1]] = True
        return mark

    @property
    def last(self) -> np.ndarray:
        return np.append(self.first[1:], True)


def lines_of(texts: Sequence[str]) -> Lines:
    """The lines of texts; a text without a line end is one line, an empty one too.

    Short texts are measured together, a long one in pieces, so memory beyond
    the text itself grows with its lines and not with its characters.
    """
    parts, held, size = [], [], 0
    for text in texts:
        for piece in _pieces(text):
            held.append(piece)
            size += len(piece)
            if size > PIECE:
                parts.append(_measure("\n".join(held)))
                held, size = [], 0
    if held:
        parts.append(_measure("\n".join(held)))
    bins, hashes, points = (np.concatenate(p) for p in zip(*parts))
    counts = np.array([t.count("\n") + 1 for t in texts])
    doc = np.repeat(np.arange(len(texts)), counts)
    order = np.lexsort((hashes, doc))
    new = np.append(True, (hashes[order][1:] != hashes[order][:-1]) | (doc[order][1:] != doc[order][:-1]))
    group = np.cumsum(new) - 1
    times = np.empty(len(doc), dtype=np.int64)
    times[order] = np.bincount(group)[group]
    bins[:, 9] = np.digitize(np.where(hashes == 0, 0, times), _TIMES)
    return Lines(bins, points + 1.0, np.append(0, np.cumsum(counts)))


def _index(lines: Lines) -> np.ndarray:
    """For each line the places of its weights: its own features, those of the line before, and of the line after."""
    n = len(lines.bins)
    before = np.full((n, _COUNT), BINS, dtype=np.int64)
    after = before.copy()
    before[1:] = lines.bins[:-1]
    before[lines.first] = BINS
    after[:-1] = lines.bins[1:]
    after[lines.last] = BINS
    shift = np.arange(_COUNT) * _WIDTH
    side = _COUNT * _WIDTH
    return np.hstack([lines.bins + shift, before + shift + side, after + shift + 2 * side])


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.einsum("nij,njk->nik", a, b)
    return out / out.sum(axis=(1, 2), keepdims=True)


def decode(weights: np.ndarray, lines: Lines, index: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(marginal, pair): the chance that each line is good, and that it and the next one have given labels.

    Forward and backward messages are products of 2 x 2 matrices, worked out for
    all lines at once in log2 (lines of the longest document) rounds. The matrix
    of a document's first line has equal rows, so it lets nothing through.
    """
    index = _index(lines) if index is None else index
    own = 1.0 / (1.0 + np.exp(-np.clip(weights[:_NODE][index].sum(axis=1), -30, 30)))
    node = np.stack([1 - own, own], axis=1)
    step = np.exp(weights[_NODE : _NODE + 4].reshape(2, 2))
    chain = node[:, None, :] * step[None]
    first, last = lines.first, lines.last
    chain[first] = (node[first] * np.exp(weights[_NODE + 4 :]))[:, None, :]
    longest = int(np.diff(lines.starts).max())
    forward = chain / chain.sum(axis=(1, 2), keepdims=True)
    backward = np.ones_like(chain)
    backward[:-1] = chain[1:]
    backward[last] = 1.0
    backward /= backward.sum(axis=(1, 2), keepdims=True)
    d = 1
    while d < longest:
        forward[d:] = _product(forward[:-d], forward[d:])
        backward[:-d] = _product(backward[:-d], backward[d:])
        d *= 2
    alpha, beta = forward.sum(axis=1), backward.sum(axis=2)
    marginal = alpha * beta
    marginal /= marginal.sum(axis=1, keepdims=True)
    pair = np.zeros_like(chain)
    pair[:-1] = alpha[:-1, :, None] * chain[1:] * beta[1:, None, :]
    pair[last] = 0.0
    total = pair.sum(axis=(1, 2), keepdims=True)
    return marginal, pair / np.where(total > 0, total, 1.0)


def likelihood(weights: np.ndarray, lines: Lines, good: np.ndarray) -> tuple[float, np.ndarray]:
    """Log likelihood of the labels of the lines, and its gradient."""
    index = _index(lines)
    marginal, pair = decode(weights, lines, index)
    first, last = lines.first, lines.last
    label = good.astype(np.int64)
    value = np.log(np.maximum(marginal[first, label[first]], 1e-300)).sum()
    here = np.flatnonzero(~last)
    joint = pair[here, label[here], label[here + 1]]
    value += np.log(np.maximum(joint / np.maximum(pair[here, label[here]].sum(axis=1), 1e-300), 1e-300)).sum()
    slope = np.zeros(_SIZE)
    slope[:_NODE] = np.bincount(index.ravel(), np.repeat(label - marginal[:, 1], index.shape[1]), minlength=_NODE)
    seen = np.bincount(2 * label[here] + label[here + 1], minlength=4).astype(np.float64)
    slope[_NODE : _NODE + 4] = seen - pair.sum(axis=0).ravel()
    slope[_NODE + 4 :] = np.bincount(label[first], minlength=2) - marginal[first].sum(axis=0)
    return float(value), slope


def _relabel(weights: np.ndarray, lines: Lines, good: np.ndarray) -> np.ndarray:
    """Line labels of documents: lines of a good one are good; of a bad one those that look bad by themselves, one at least."""
    alone = weights.copy()
    alone[_NODE:] = 0.0
    chance = decode(alone, lines)[0][:, 1]
    worst = np.minimum.reduceat(chance, lines.starts[:-1])
    size = np.diff(lines.starts)
    return np.repeat(good, size) | ((chance >= 0.5) & (chance > np.repeat(worst, size)))


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lines = [lines_of([t or ""]) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array([x.bins.tobytes() for x in lines], pa.binary()),
                pa.array([x.weight.tobytes() for x in lines], pa.binary()),
            ],
            names=["good", "bins", "weight"],
        )


def _unpacked(batch: pa.RecordBatch) -> tuple[Lines, np.ndarray]:
    bins = [np.frombuffer(b, dtype=np.int8).reshape(-1, _COUNT) for b in batch.column(1).to_pylist()]
    weight = [np.frombuffer(w, dtype=np.float64) for w in batch.column(2).to_pylist()]
    starts = np.append(0, np.cumsum([len(b) for b in bins]))
    return Lines(np.concatenate(bins), np.concatenate(weight), starts), np.array(batch.column(0).to_pylist(), dtype=bool)


def _evaluate(weights: np.ndarray, first: np.ndarray | None):
    """Likelihood and gradient over a task's documents; line labels follow from the first model, if there is one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        value, slope = 0.0, np.zeros(_SIZE)
        for batch in batches:
            if not batch.num_rows:
                continue
            lines, good = _unpacked(batch)
            label = np.repeat(good, np.diff(lines.starts)) if first is None else _relabel(first, lines, good)
            v, s = likelihood(weights, lines, label)
            value, slope = value + v, slope + s
        yield pa.RecordBatch.from_arrays([pa.array([value]), pa.array([slope.tolist()])], names=["value", "slope"])

    return run


def _fit(rows: DataFrame, steps: int, chained: bool, first: np.ndarray | None) -> np.ndarray:
    """Weights of least penalised loss by L-BFGS; value and gradient come from one job a step."""

    def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
        found = rows.mapInArrow(_evaluate(x, first), "value double, slope array<double>").collect()
        value, slope = math.fsum(r["value"] for r in found), np.sum([r["slope"] for r in found], axis=0)
        if not chained:
            # A line by itself: no neighbours, no transitions.
            slope[_COUNT * _WIDTH :] = 0.0
        return 0.5 * PENALTY * float(x @ x) - value, PENALTY * x - slope

    x = np.zeros(_SIZE)
    value, slope = loss(x)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        way, kept = -slope, []
        for s, y in reversed(past):
            a = (s @ way) / (s @ y)
            kept.append(a)
            way = way - a * y
        if past:
            s, y = past[-1]
            way = way * ((s @ y) / (y @ y))
        for (s, y), a in zip(past, reversed(kept)):
            way = way + s * (a - (y @ way) / (s @ y))
        size = 1.0 if past else 1.0 / max(float(np.abs(slope).sum()), 1e-9)
        for _ in range(8):
            value_new, slope_new = loss(x + size * way)
            if value_new <= value + 1e-4 * size * float(slope @ way):
                break
            size *= 0.4
        else:
            return x
        s, y = size * way, slope_new - slope
        if s @ y > 1e-12:
            past = [*past, (s, y)][-8:]
        done = value - value_new <= 1e-5 * abs(value)
        x, value, slope = x + s, value_new, slope_new
        if done:
            break
    return x


@dataclass(frozen=True)
class Model:
    """Weights of the chain, and the power that lifts the share of good text to the score."""

    weights: np.ndarray
    power: float = 1.0


def _shares(weights: np.ndarray, lines: Lines) -> np.ndarray:
    """Mean of the chance of good lines, weighted by their lengths, for each document."""
    chance = decode(weights, lines)[0][:, 1] * lines.weight
    at = lines.starts[:-1]
    return np.add.reduceat(chance, at) / np.add.reduceat(lines.weight, at)


def _judged(weights: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                lines, good = _unpacked(batch)
                yield pa.RecordBatch.from_arrays([pa.array(good), pa.array(_shares(weights, lines))], names=["good", "share"])

    return run


def _power(good: np.ndarray, bad: np.ndarray, at: float) -> float:
    """The power that puts the cut of fewest errors, in the middle of its widest range, at the score ``at``."""
    cuts = np.unique(np.concatenate([good, bad, [0.0, 1.0]]))
    errors = np.searchsorted(np.sort(good), cuts[1:]) + len(bad) - np.searchsorted(np.sort(bad), cuts[1:])
    least = np.flatnonzero(errors == errors.min())
    best = least[np.argmax(cuts[1:][least] - cuts[:-1][least])]
    middle = min(max((cuts[best] + cuts[best + 1]) / 2, 0.1), 0.9)
    return math.log(at) / math.log(middle)


def learn(
    docs: DataFrame,
    labels: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    sample: int = SAMPLE,
    at: float = 0.3,
) -> Model:
    """A model fitted on at most ``sample`` documents of either label, those whose ids hash lowest.

    Labels are those of documents. A first model without neighbours takes every
    line of a document for what the document is. By its judgement, lines of bad
    documents that look good are good lines (but never all of a document); the
    chain is then fitted to the lines so labelled.

    Each step is a job over the settled features of the sample, which adds up
    likelihood and gradient in the tasks; the driver gets the sums, and at last a
    number for each document of the sample, by which the scores are lifted to
    part the two labels at ``at``. An id that is labelled more than once takes
    the larger label; rows with a NULL id or label do not count. Without
    documents of both labels all weights are zero: every score is one half.
    """
    marked = labels.where(F.col(label).isNotNull() & F.col(id).isNotNull()).groupBy(F.col(id).alias("_id")).agg(
        F.max(F.col(label).cast("int")).alias("_label")
    )
    chosen = [marked.where(F.col("_label") == v).orderBy(F.xxhash64("_id"), "_id").limit(sample) for v in (0, 1)]
    few = F.broadcast(chosen[0].union(chosen[1]))  # at most 2 * sample rows
    own = docs.select(F.col(id).alias("_id"), F.col(text).alias("_text"))
    rows = own.join(few, "_id").select((F.col("_label") == 1).alias("good"), "_text")
    rows = rows.mapInArrow(_sampled, "good boolean, bins binary, weight binary")
    # Few tasks, as the sample is bounded; settled, so that every step reads the same rows in the same order.
    rows = settled(rows.repartition(PARTS))
    if rows.select("good").distinct().count() < 2:
        return Model(np.zeros(_SIZE))
    weights = _fit(rows, STEPS, True, _fit(rows, FIRST_STEPS, False, None))
    found = rows.mapInArrow(_judged(weights), "good boolean, share double").collect()
    good, bad = (np.array([r["share"] for r in found if r["good"] is v]) for v in (True, False))
    return Model(weights, _power(good, bad, at))


def scores_of(model: Model, texts: Sequence[str | None]) -> np.ndarray:
    """Scores of texts, a few at a time."""
    found, held, size = [np.empty(0)], [], 0
    for text in texts:
        held.append(text or "")
        size += len(held[-1]) + 64
        if size > PIECE:
            found.append(_shares(model.weights, lines_of(held)))
            held, size = [], 0
    if held:
        found.append(_shares(model.weights, lines_of(held)))
    return np.clip(np.concatenate(found), 0.0, 1.0) ** model.power


def score(text: Column, model: Model) -> Column:
    """Quality of a text column from 0 to 1: the share of it, by length, in lines the chain takes for good, lifted.

    Every line of the whole text counts with its code points and one more for
    its end. NULL counts as the empty text, which is one empty line. Equal texts
    have equal scores but for rounding; no other column is read.
    """

    @F.arrow_udf("double")
    def scores(texts: pa.Array) -> pa.Array:
        return pa.array(scores_of(model, texts.to_pylist()), pa.float64())

    return scores(text)
