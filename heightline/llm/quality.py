"""Quality rules: base statistics, and divergence from the languages of the corpus."""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .rows import HAS_WORD, SPACE_RUN, let, settled, unveiled, veiled, words_of

# Character classes of the histogram; what fits none is a letter or another sign.
CLASSES = {
    # Latin, Greek and Cyrillic ranges: a property looked up per character takes ten times as long.
    "upper": "[A-ZÀ-ÖØ-ÞΑ-ΩА-Я]",
    "digit": "[0-9]",
    "mark": "[.,;:!?'\"()-]",
    "symbol": "[#*$%&|<>]",
    "space": SPACE_RUN[:-1],
}
# Words of up to this many code points can be common words of a language.
LONGEST_COMMON = 4
COMMON_WORDS = 24
# A language is a reference if it has at least this share of the documents, or this many words whatever its share.
LEAST_SHARE = 0.01
LEAST_REFERENCE_WORDS = 2_000


@dataclass(frozen=True)
class Rules:
    """Limits of the verdict.

    Distances are Jensen-Shannon distances to the nearest reference (0: alike,
    1: nothing in common). The guards leave out what is too short to have a
    histogram.
    """

    farthest_characters: float = 0.28
    farthest_words: float = 0.37
    least_characters: int = 100
    least_words: int = 50


@dataclass(frozen=True)
class Reference:
    """Shares of the character classes (the last is the rest), and of the common words, in one language."""

    language: str
    classes: tuple[float, ...]
    words: dict[str, float] = field(hash=False)


def _class_counts(text: Column) -> list[Column]:
    return [F.regexp_count(text, F.lit(pattern)).cast("long") for pattern in CLASSES.values()]


def references(docs: DataFrame, text: str = "text", lang: str = "lang") -> list[Reference]:
    """References of the languages in ``docs``, counted over all texts with a language.

    One aggregation over one reading of the texts, to a row per language and
    short word and one with the language's totals; it combines before the
    shuffle. The driver gets COMMON_WORDS words of each language; equally
    frequent words go by their text. Languages with few words and documents have
    no reference: see ``lang`` of assess().
    """
    names = ("docs", "words", "chars", *CLASSES)
    body = F.coalesce(F.col(text), F.lit(""))
    known = let(docs.select(F.col(lang).alias("lang"), body.alias("text")), "words", words_of(F.col("text")))
    sums = F.array(
        F.lit(1).cast("long"), F.size("words").cast("long"), F.char_length("text").cast("long"), *_class_counts(F.col("text"))
    )
    none = F.lit(None)
    total = F.array(F.struct(none.cast("string").alias("word"), sums.alias("sums")))
    short = F.transform(
        F.filter("words", lambda w: F.char_length(w) <= LONGEST_COMMON),
        lambda w: F.struct(w.alias("word"), none.cast("array<long>").alias("sums")),
    )
    counted = settled(
        known.select("lang", F.explode(F.concat(total, short)).alias("e"))
        .groupBy("lang", "e.word")
        .agg(F.count(F.lit(1)).alias("n"), *(F.sum(F.get("e.sums", F.lit(i))).alias(name) for i, name in enumerate(names)))
    )
    totals = counted.where(F.col("word").isNull())
    totals = totals.select("*", F.try_divide("docs", F.sum("docs").over(Window.partitionBy(F.lit(0)))).alias("share"))
    enough = (F.col("words") >= LEAST_REFERENCE_WORDS) | ((F.col("share") >= LEAST_SHARE) & (F.col("words") > 0))
    large = totals.where(F.col("lang").isNotNull() & enough).collect()
    if not large:
        return []
    top = (
        counted.where(F.col("word").isNotNull() & F.col("lang").isin([r["lang"] for r in large]))
        .select("lang", "word", "n", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word")).alias("rank"))
        .where(F.col("rank") <= COMMON_WORDS)
        .collect()
    )
    found = []
    for r in sorted(large, key=lambda r: r["lang"]):
        shares = [r[name] / r["chars"] for name in CLASSES]
        common = {w["word"]: w["n"] / r["words"] for w in top if w["lang"] == r["lang"]}
        found.append(Reference(r["lang"], (*shares, max(0.0, 1 - sum(shares))), dict(sorted(common.items()))))
    return found


def _share(p: Column, q: Column | float) -> Column:
    """Twice the part of one bin in the Jensen-Shannon divergence."""
    q = F.lit(q) if isinstance(q, float) else q
    mean = (p + q) / 2
    return F.when(p > 0, p * F.log(p / mean)).otherwise(0.0) + F.when(q > 0, q * F.log(q / mean)).otherwise(0.0)


def _distance(twice: Column) -> Column:
    return F.sqrt(F.greatest(twice, F.lit(0.0)) / F.lit(2 * math.log(2)))


def assess(
    docs: DataFrame,
    known: list[Reference],
    text: str = "text",
    rules: Rules = Rules(),
    lang: str | None = None,
) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    character_distance, word_distance and kept.

    Words are runs without ASCII white space. ``base_failed``: fewer than 50
    words, or over half of them in 3-word windows that occur again in the text.
    ``kept`` is false then. Otherwise a text goes if its histogram of character
    classes, or of the common words of a language and all others, is farther
    than the rules allow from every reference. The distances are NULL for texts
    under the guards, and without references; such texts stay.

    Everything is worked out within the row, from arrays as long as the text.

    * NULL counts as an empty text: no words, so ``base_failed``. Lines are
      compared as they stand; lines without a word do not count.
    * Columns of those names are replaced; all others stay as they are.
    """
    new = {
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "character_distance", "word_distance", "kept",
    }
    columns = [c for c in docs.columns if c not in new]
    rows = veiled(docs.select(*columns)).withColumn("text", F.coalesce(F.col(f"_{columns.index(text)}"), F.lit("")))
    old = [f"_{i}" for i in range(len(columns))]
    # Long columns go as soon as they are counted: every step copies what it carries on.
    rows = let(rows, "counts", F.array(F.char_length("text").cast("long"), *_class_counts(F.col("text"))))
    rows = let(rows, "lines", F.filter(F.split("text", "\n"), lambda line: line.rlike(HAS_WORD)))
    rows = rows.select(
        *old, "counts", "text", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines")
    )
    rows = let(rows, "words", words_of(F.col("text"))).drop("text")
    rows = let(rows, "runs", _common_counts(known))
    n = F.size("words")
    hashes = F.transform(
        F.when(n >= 3, F.sequence(F.lit(0), n - 3)),
        lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)),
    )
    rows = let(rows.withColumn("n_words", n.cast("long")), "hashes", hashes).drop("words")
    # In the order of their hashes, equal windows are neighbours. Most texts need no sorting: all their windows differ.
    differ = F.size(F.array_distinct("hashes")) == F.size("hashes")
    placed = F.arrays_zip(F.col("hashes").alias("hash"), F.sequence(F.lit(0), F.size("hashes") - 1).alias("at"))
    rows = let(rows, "windows", F.when(~differ, F.sort_array(placed))).drop("hashes")
    again = F.filter(
        F.sequence(F.lit(0), F.size("windows") - 2),
        lambda i: F.get("windows", i)["hash"] == F.get("windows", i + 1)["hash"],
    )
    rows = let(rows, "again", F.when(F.col("windows").isNotNull(), again))

    def covered(i: Column) -> Column:
        first, second = F.get("windows", i)["at"], F.get("windows", i + 1)["at"]
        return F.array(first, first + 1, first + 2, second, second + 1, second + 2)

    repeated = F.array_distinct(F.flatten(F.transform("again", covered)))
    measured = rows.select(
        *old,
        "runs",
        "counts",
        "n_words",
        (F.get("counts", F.lit(0)) - F.get("counts", F.lit(1 + list(CLASSES).index("space")))).alias("word_chars"),
        F.get("counts", F.lit(1 + list(CLASSES).index("symbol"))).alias("n_symbols"),
        "n_dup_lines",
        F.coalesce(F.size(repeated), F.lit(0)).cast("long").alias("n_repeat_words"),
    )
    measured = measured.withColumn(
        "base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    )
    characters = [_character_distance(r) for r in known]
    words = [_word_distance(r, i) for i, r in enumerate(known)]
    own = F.lit(True)
    if lang is not None and known:
        own = F.coalesce(F.col(f"_{columns.index(lang)}").isin([r.language for r in known]), F.lit(True))
    far = let(
        measured,
        "far",
        F.array(
            _nearest(characters, own & (F.get("counts", F.lit(0)) >= rules.least_characters)),
            _nearest(words, own & (F.col("n_words") >= rules.least_words)),
        ),
    )
    by_characters, by_words = F.get("far", F.lit(0)), F.get("far", F.lit(1))
    verdict = (F.coalesce(by_characters, F.lit(0.0)) <= rules.farthest_characters) & (
        F.coalesce(by_words, F.lit(0.0)) <= rules.farthest_words
    )
    return far.select(
        *unveiled(columns),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        by_characters.alias("character_distance"),
        by_words.alias("word_distance"),
        (~F.col("base_failed") & verdict).alias("kept"),
    )


def _nearest(distances: list[Column], long_enough: Column) -> Column:
    if not distances:
        return F.lit(None).cast("double")
    return F.when(long_enough, F.array_min(F.array(*distances)))


_LISTS = 64


def _union(known: list[Reference]) -> list[str]:
    return sorted({w for r in known for w in r.words})


_RUNS = "array<struct<word:string,n:int>>"
_SHARED = "array<struct<n:int,q:array<double>>>"


def _listed(words: list[str], item, kind: str) -> Column:
    """Items of words in lists by a checksum of the word, so that a word is compared with a few of them, not with all."""
    lists = [[item(w) for w in words if zlib.crc32(w.encode()) % _LISTS == i] for i in range(_LISTS)]
    return F.array(*(F.array(*of).cast(f"array<{kind}>") for of in lists))


def _list_of(listed: Column, word: Column) -> Column:
    return F.get(listed, (F.crc32(word) % _LISTS).cast("int"))


def _common_counts(known: list[Reference]) -> Column:
    """Array of (n, q) for the common words of any language that a row has: its count, and its share in each language."""
    union = _union(known)
    if not union:
        return F.lit(None).cast(_SHARED)
    longest = max(len(w.encode()) for w in union)
    words = _listed(union, F.lit, "string")
    hits = F.filter("words", lambda w: (F.octet_length(w) <= longest) & F.array_contains(_list_of(words, w), w))
    start = F.struct(F.array().cast(_RUNS).alias("runs"), F.lit("").alias("word"), F.lit(0).alias("n"))

    def closed(acc: Column) -> Column:
        run = F.array(F.struct(acc["word"].alias("word"), acc["n"].alias("n")))
        return F.when(acc["n"] > 0, F.concat(acc["runs"], run)).otherwise(acc["runs"])

    runs = F.aggregate(
        F.sort_array(hits),
        start,
        lambda acc, w: F.struct(
            F.when(acc["word"] == w, acc["runs"]).otherwise(closed(acc)).alias("runs"),
            w.alias("word"),
            F.when(acc["word"] == w, acc["n"] + 1).otherwise(F.lit(1)).alias("n"),
        ),
        closed,
    )
    shares = _listed(
        union,
        lambda w: F.struct(F.lit(w).alias("w"), F.array(*(F.lit(float(r.words.get(w, 0.0))) for r in known)).alias("q")),
        "struct<w:string,q:array<double>>",
    )
    return F.transform(
        runs,
        lambda run: F.struct(
            run["n"].alias("n"),
            F.get(F.filter(_list_of(shares, run["word"]), lambda x: x["w"] == run["word"]), F.lit(0))["q"].alias("q"),
        ),
    )


def _character_distance(r: Reference) -> Column:
    chars = F.get("counts", F.lit(0)).cast("double")
    shares = [F.get("counts", F.lit(1 + i)) / chars for i in range(len(CLASSES))]
    rest = F.greatest(F.lit(1.0) - sum(shares[1:], shares[0]), F.lit(0.0))
    parts = [_share(p, q) for p, q in zip([*shares, rest], r.classes)]
    return _distance(sum(parts[1:], parts[0]))


def _word_distance(r: Reference, at: int) -> Column:
    """Absent common words add their share times ln 2; present ones are summed over the row's runs."""
    words = F.col("n_words").cast("double")
    common = sum(r.words.values())
    start = F.struct(F.lit(0.0).alias("twice"), F.lit(0.0).alias("p"), F.lit(0.0).alias("q"))

    def add(acc: Column, run: Column) -> Column:
        q = F.get(run["q"], F.lit(at))
        p = run["n"] / words
        return F.when(
            q > 0, F.struct((acc["twice"] + _share(p, q)).alias("twice"), (acc["p"] + p).alias("p"), (acc["q"] + q).alias("q"))
        ).otherwise(acc)

    def finish(acc: Column) -> Column:
        others = _share(F.greatest(F.lit(1.0) - acc["p"], F.lit(0.0)), float(max(0.0, 1 - common)))
        return acc["twice"] + others + (F.lit(float(common)) - acc["q"]) * F.lit(math.log(2))

    return _distance(F.aggregate(F.coalesce("runs", F.array().cast(_SHARED)), start, add, finish))


def drop_low_quality(docs: DataFrame, text: str = "text", lang: str = "lang", rules: Rules = Rules()) -> DataFrame:
    """The rows of ``docs`` that assess() keeps, against references from the same table; columns as they were."""
    numbered = [f"_{docs.columns.index(c)}" for c in (text, lang)]
    judged = assess(veiled(docs), references(docs, text, lang), numbered[0], rules, numbered[1])
    return judged.where("kept").select(*unveiled(docs.columns))
