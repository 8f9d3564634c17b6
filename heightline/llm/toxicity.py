"""Toxicity scores from a weighted lexicon."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rows import settled

# Labelled rows that a model is fitted on, at most, of either label.
SAMPLE = 8_000
# Terms of a lexicon, at most: the heaviest.
TERMS = 3_000
# A term is in this many toxic texts of the sample at least, and its log odds are this high.
LEAST_TEXTS = 3
LEAST_WEIGHT = 3.0
# Words also count by their first characters, so a family of words can be one term.
STEMS = range(4, 8)
EXCEPTIONS = 2_000

# Characters that stand for a Latin letter, and digits used as letters.
HOMOGLYPHS = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s",
    "к": "k", "м": "m", "т": "t", "в": "b", "н": "h", "ԁ": "d", "ո": "n", "ս": "u",
    "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "ı": "i", "ɡ": "g", "ʟ": "l", "ⅼ": "l", "ｏ": "o",
}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i"}
# Invisible characters that split words.
HIDDEN = "\u200b\u200c\u200d\u2060\ufeff\u00ad"

_FOLD = str.maketrans({**HOMOGLYPHS, **{c: None for c in HIDDEN}})
_LEET = str.maketrans(DIGITS)
# A word with a digit or sign between or before letters is written in substitutes.
_MASKED = re.compile(r"(?<![^\s])[^\W\d_]*[013457 8@$!][\w@$!]*[^\W\d_][\w@$!]*".replace(" ", ""))
_WORD = re.compile(r"[^\W_]+")


def fold(text: str) -> str:
    """A text in lower case with homoglyphs and, inside words, digit substitutes as the letters they stand for."""
    plain = text.lower().translate(_FOLD)
    return _MASKED.sub(lambda m: m.group().translate(_LEET), plain)


def words(folded: str) -> list[str]:
    return _WORD.findall(folded)


def features(found: Sequence[str]) -> set[str]:
    """What a text can be known by: its words, and stems of them, marked with an asterisk."""
    own = set(found)
    return own | {w[:n] + "*" for w in own for n in STEMS if len(w) > n}


@dataclass(frozen=True)
class Lexicon:
    """Terms with weights, phrases in which they do not count, and the calibration of the score."""

    terms: dict[str, float]
    exceptions: frozenset[str]
    slope: float = 4.0
    threshold: float = 1.0

    def matcher(self) -> Matcher:
        return Matcher(self)

    def scaled(self, weight: float, length: int) -> float:
        """Weight found in a text, normalised by its length: each tenfold length halves the surplus of a match."""
        return weight / (1.0 + 0.25 * math.log10(1 + length))

    def score(self, weight: float, length: int) -> float:
        lift = self.slope * (self.scaled(weight, length) - self.threshold)
        return 1.0 / (1.0 + math.exp(-max(-60.0, min(60.0, lift))))


class Matcher:
    """Aho-Corasick automaton over the terms and the exception phrases of a lexicon."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon
        self.tree = ahocorasick.Automaton()
        for term, weight in lexicon.terms.items():
            stem = term.endswith("*")
            text = " " + term.rstrip("*") + ("" if stem else " ")
            self.tree.add_word(text, (len(text), weight, stem))
        for phrase in lexicon.exceptions:
            text = f" {phrase} "
            self.tree.add_word(text, (len(text), 0.0, False))
        if len(self.tree):
            self.tree.make_automaton()

    def weigh(self, found: Sequence[str]) -> float:
        """Sum of the weights of the words that match, each word by its heaviest term, but in no exception phrase."""
        if not len(self.tree) or not found:
            return 0.0
        line = " " + " ".join(found) + " "
        hits: dict[int, float] = {}
        spared: list[tuple[int, int]] = []
        for end, (size, weight, _) in self.tree.iter(line):
            start = end - size + 1
            if weight:
                hits[start] = max(hits.get(start, 0.0), weight)
            else:
                spared.append((start, end))
        if spared:
            hits = {at: w for at, w in hits.items() if not any(a <= at < b for a, b in spared)}
        return sum(hits.values())

    def measure(self, text: str | None) -> tuple[float, int]:
        found = words(fold(text or ""))
        return self.weigh(found), len(found)


def _count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: dict[int, Counter] = {0: Counter(), 1: Counter()}
    for batch in batches:
        for toxic, text in zip(batch.column(0), batch.column(1)):
            seen[toxic.as_py()].update(features(words(fold(text.as_py() or ""))))
    names = list(seen[0].keys() | seen[1].keys())
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(names, pa.string()),
            pa.array([seen[1][n] for n in names], pa.int64()),
            pa.array([seen[0][n] for n in names], pa.int64()),
        ],
        names=["feature", "toxic", "clean"],
    )


def _phrases(terms: Iterable[str]):
    """Phrases of two words with a term in them, counted by label."""
    lexicon = Matcher(Lexicon({t: 1.0 for t in terms}, frozenset()))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, Counter] = {0: Counter(), 1: Counter()}
        for batch in batches:
            for toxic, text in zip(batch.column(0), batch.column(1)):
                found = words(fold(text.as_py() or ""))
                pairs = {f"{a} {b}" for a, b in zip(found, found[1:]) if lexicon.weigh([a]) or lexicon.weigh([b])}
                seen[toxic.as_py()].update(pairs)
        names = list(seen[0].keys())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(names, pa.string()),
                pa.array([seen[1][n] for n in names], pa.int64()),
                pa.array([seen[0][n] for n in names], pa.int64()),
            ],
            names=["phrase", "toxic", "clean"],
        )

    return count


def learn(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = SAMPLE) -> Lexicon:
    """A lexicon fitted on at most ``sample`` texts of either label, those whose ids hash lowest.

    A term's weight is the log odds of its being in a toxic text. A phrase of
    two words is an exception if it occurs in three clean texts of the sample
    and in no toxic one. The threshold lies between the two labels. An id that
    is labelled more than once takes the larger label; NULL labels do not count.
    The driver gets the lexicon and two numbers for each text of the sample.
    """
    marked = labels.where(F.col(label).isNotNull() & F.col(id).isNotNull()).groupBy(F.col(id).alias("_id")).agg(
        F.max(F.col(label).cast("int")).alias("_label")
    )
    order = F.xxhash64("_id")
    chosen = [marked.where(F.col("_label") == v).orderBy(order, "_id").limit(sample) for v in (0, 1)]
    few = F.broadcast(chosen[0].union(chosen[1]))  # at most 2 * sample rows
    texts = settled(docs.join(few, F.col(id) == F.col("_id")).select(F.col("_label").alias("label"), F.col(text).alias("text")))
    sizes = {r["label"]: r["n"] for r in texts.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    odds = F.log((F.col("toxic") + 0.5) / F.lit(toxic + 1.0)) - F.log((F.col("clean") + 0.5) / F.lit(clean + 1.0))
    counted = (
        texts.mapInArrow(_count_features, "feature string, toxic long, clean long")
        .groupBy("feature")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    )
    top = (
        counted.where(F.col("toxic") >= LEAST_TEXTS)
        .withColumn("weight", odds)
        .where(F.col("weight") >= LEAST_WEIGHT)
        .orderBy(F.desc("weight"), "feature")
        .limit(TERMS)
        .collect()
    )
    terms = {r["feature"]: float(r["weight"]) for r in top}
    phrases = (
        texts.mapInArrow(_phrases(terms), "phrase string, toxic long, clean long")
        .groupBy("phrase")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .where((F.col("clean") >= 3) & (F.col("toxic") == 0))
        .orderBy(F.desc("clean"), "phrase")
        .limit(EXCEPTIONS)
        .collect()
    )
    raw = Lexicon(terms, frozenset(r["phrase"] for r in phrases))
    scaled = texts.select("label", measured(F.col("text"), raw).alias("m")).select("label", "m.*").collect()
    values = {v: np.array([raw.scaled(r["weight"], r["length"]) for r in scaled if r["label"] == v]) for v in (0, 1)}
    return _calibrated(raw, values[1], values[0])


def _calibrated(raw: Lexicon, toxic: np.ndarray, clean: np.ndarray) -> Lexicon:
    """Score 0.7 where the sum of both error rates is least, in the middle of the best range."""
    if not len(toxic) or not len(clean):
        return Lexicon({}, frozenset())
    cuts = np.unique(np.concatenate([toxic, clean, [0.0]]))
    middles = (cuts[1:] + cuts[:-1]) / 2 if len(cuts) > 1 else cuts + 1.0
    errors = np.array([(toxic < c).mean() + (clean >= c).mean() for c in middles])
    best = middles[np.flatnonzero(errors == errors.min())]
    slope = 4.0 / max(float(np.median(toxic)), 1e-3)
    at = float(np.median(best))
    return Lexicon(raw.terms, raw.exceptions, slope, at - math.log(0.7 / 0.3) / slope)


def measured(text: Column, lexicon: Lexicon) -> Column:
    """Struct (weight, length) of a text column: the weight of its matches, and its number of words."""

    @F.arrow_udf("struct<weight:double,length:long>")
    def weigh(texts: pa.Array) -> pa.Array:
        matcher = lexicon.matcher()
        found = [matcher.measure(t.as_py()) for t in texts]
        return pa.StructArray.from_arrays(
            [pa.array([f[0] for f in found], pa.float64()), pa.array([f[1] for f in found], pa.int64())],
            names=["weight", "length"],
        )

    return weigh(text)


def score(text: Column, lexicon: Lexicon) -> Column:
    """Score of a text column between 0 and 1, 0.7 or more for texts like the toxic ones.

    NULL and empty texts weigh nothing. Texts are read whole.
    """

    @F.arrow_udf("double")
    def scores(texts: pa.Array) -> pa.Array:
        matcher = lexicon.matcher()
        return pa.array([lexicon.score(*matcher.measure(t.as_py())) for t in texts], pa.float64())

    return scores(text)
