"""Language identification with rank-order n-gram profiles."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .rows import blocks, settled

UNKNOWN = "und"
# n-grams of 1 to 3 characters; a profile is the most frequent ones, in order.
LONGEST = 3
RANKS = 300
# Languages above this number are left out of the model, the rarest first.
MOST_LANGUAGES = 500
# A worker hands on its counts when it holds this many.
_HELD = 500_000


_known_letters: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Which code points are letters; made once per worker."""
    if not _known_letters:
        _known_letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000))
    return _known_letters[0]


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(n-grams, counts) of a text: lower-case letters, all else one space between words.

    An n-gram is a number of 21 bits per character, so n-grams have an order and
    need no text; those of spaces only do not count.
    """
    parts = [_block_grams(part) for part in blocks(text)]
    if len(parts) == 1:
        return parts[0]
    keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(at, weights=np.concatenate([n for _, n in parts])).astype(np.int64)


def _block_grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), dtype="<u4")
    codes = np.where(_letters()[codes], codes, 32).astype(np.uint64)
    space = codes == 32
    codes = codes[~(space & np.append(False, space[:-1]))]
    found = [codes[codes != 32]]
    key = codes
    for n in range(2, LONGEST + 1):
        key = (key[:-1] << np.uint64(21)) | codes[n - 1 :]
        found.append(key)
    every = np.concatenate(found)
    keys, counts = np.unique(every, return_counts=True)
    return keys, counts


def ranked(keys: np.ndarray, counts: np.ndarray, most: int = RANKS) -> np.ndarray:
    """The most frequent n-grams in order; equally frequent ones by their number."""
    return keys[np.lexsort((keys, -counts))][:most]


def has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


@dataclass(frozen=True)
class Profiles:
    """Ranked n-grams of each language, looked up together."""

    languages: list[str]
    keys: np.ndarray
    ranks: np.ndarray

    @staticmethod
    def of(ordered: dict[str, np.ndarray]) -> Profiles:
        languages = sorted(ordered)
        keys = np.unique(np.concatenate([np.empty(0, np.uint64), *ordered.values()]))
        ranks = np.full((len(languages), len(keys)), RANKS, dtype=np.int64)
        for row, language in enumerate(languages):
            ranks[row, np.searchsorted(keys, ordered[language])] = np.arange(len(ordered[language]))
        return Profiles(languages, keys, ranks)

    def nearest(self, text: str | None) -> tuple[str, float]:
        """(language, score): the least out-of-place distance, and how far it is below the greatest possible.

        The distance adds up, over the n-grams of the text's own profile, the
        difference of the two ranks, or the length of a profile where the
        language has no such n-gram. Languages at one distance go by their name.
        """
        if not text or not self.languages or not has_letter(text):
            return UNKNOWN, 0.0
        own = ranked(*grams(text))
        at = np.minimum(np.searchsorted(self.keys, own), len(self.keys) - 1)
        known = self.keys[at] == own
        theirs = np.where(known, self.ranks[:, at], RANKS)
        apart = np.where(theirs == RANKS, RANKS, np.abs(theirs - np.arange(len(own))))
        distances = apart.sum(axis=1)
        best = int(distances.argmin())
        return self.languages[best], float(1 - distances[best] / (RANKS * len(own)))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, list] = defaultdict(list)
    size = 0
    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1)):
            keys, counts = grams(text.as_py())
            held[lang.as_py()].append((keys, counts))
            size += len(keys)
            if size >= _HELD:
                merged = {k: [_merge(v)] for k, v in held.items()}
                size = sum(len(v[0][0]) for v in merged.values())
                if size >= _HELD // 2:
                    yield _counted(merged)
                    merged, size = {}, 0
                held = defaultdict(list, merged)
    yield _counted({k: [_merge(v)] for k, v in held.items()})


def _merge(parts: list) -> tuple[np.ndarray, np.ndarray]:
    keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(at, weights=np.concatenate([n for _, n in parts])).astype(np.int64)


def _counted(merged: dict[str, list]) -> pa.RecordBatch:
    langs = [k for k, v in merged.items() for _ in range(len(v[0][0]))]
    keys = np.concatenate([np.empty(0, np.uint64), *(v[0][0] for v in merged.values())])
    counts = np.concatenate([np.empty(0, np.int64), *(v[0][1] for v in merged.values())])
    return pa.RecordBatch.from_arrays(
        [pa.array(langs, pa.string()), pa.array(keys.view(np.int64)), pa.array(counts.astype(np.int64))],
        names=["lang", "gram", "n"],
    )


def learn(docs: DataFrame, text: str = "text", lang: str = "lang") -> Profiles:
    """Profiles of the languages of all rows with a text and a language.

    Tasks count per language and hand on counts of n-grams, not texts; the
    driver gets RANKS rows for each of at most MOST_LANGUAGES languages.
    """
    rows = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")
    )
    counts = rows.mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    of_language = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    # Read twice below: worked out once, RANKS rows a language.
    top = settled(counts.select("*", F.row_number().over(of_language).alias("rank")).where(F.col("rank") <= RANKS))
    sizes = top.groupBy("lang").agg(F.max("n").alias("size"))
    frequent = sizes.orderBy(F.desc("size"), "lang").limit(MOST_LANGUAGES)
    ordered: dict[str, list] = defaultdict(list)
    for row in top.join(frequent, "lang", "left_semi").select("lang", "gram", "rank").collect():
        ordered[row["lang"]].append((row["rank"], row["gram"]))
    return Profiles.of({k: np.array([g for _, g in sorted(v)], dtype=np.uint64) for k, v in ordered.items()})


def identify(text: Column, profiles: Profiles) -> Column:
    """Struct (lang, score) of a text column.

    ``und`` and 0 for NULL, for a text without a letter, and without profiles;
    a text is read whole, in blocks if it is long.
    """

    @F.arrow_udf("struct<lang:string,score:double>")
    def nearest(texts: pa.Array) -> pa.Array:
        found = [profiles.nearest(t.as_py()) for t in texts]
        return pa.StructArray.from_arrays(
            [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
            names=["lang", "score"],
        )

    return nearest(text)
