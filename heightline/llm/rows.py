"""Helpers the operators of this package share."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import shared_dir, work_path

# White space of the text contracts: space, and tab to carriage return.
SPACE = " \t\n\x0b\x0c\r"
SPACE_RUN = "[\\x20\\x09-\\x0D]+"
HAS_WORD = "[^\\x20\\x09-\\x0D]"

# A side with at most this many rows of two or three numbers is broadcast.
SMALL_ROWS = 300_000

_GAP = re.compile(r"(?<=\S) (?=\S)")


def veiled(df: DataFrame) -> DataFrame:
    """``df`` with numbered column names, which no column an operator adds can clash with."""
    return df.toDF(*(f"_{i}" for i in range(len(df.columns))))


def unveiled(names: Sequence[str]) -> list[Column]:
    """The columns of a veiled table under the names they had."""
    return [F.col(f"_{i}").alias(name) for i, name in enumerate(names)]


def settled(df: DataFrame) -> DataFrame:
    """``df`` worked out once into the shared checkpoint folder; later steps read it from there."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read from there, for tables made from themselves in rounds.

    A checkpoint keeps the size that was estimated for its plan, and a join is
    estimated at the product of its sides. From round to round such a number
    gains digits by a factor, until the driver works on nothing else. A stored
    table has the size of its files.
    """
    path = work_path(df.sparkSession, "stored")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column worked out once per row.

    It sits above a generator, so that expressions using it several times, or
    inside a lambda, read the value and do not work it out again.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def join_checked(df: DataFrame, side: DataFrame, on, how: str, most: int = SMALL_ROWS) -> DataFrame:
    """Join to a side that is broadcast if it has at most ``most`` rows, and shuffled like any other if not.

    ``side`` is settled first, so counting it costs no second run.
    """
    return join_settled(df, settled(side), on, how, most)


def join_settled(df: DataFrame, side: DataFrame, on, how: str, most: int = SMALL_ROWS) -> DataFrame:
    """join_checked() to a side that is settled already."""
    return df.join(F.broadcast(side) if side.count() <= most else side, on, how)


def hashed_side(side: DataFrame) -> DataFrame:
    """``side`` for a join to a far larger table, which then is not sorted.

    Its keys must be distinct: a task holds the rows of its partition of ``side``.
    """
    return side.hint("shuffle_hash")


def words_of(text: Column) -> Column:
    """The words of a text as an array; NULL has none."""
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, SPACE_RUN))


def blocks(text: str, size: int = 1 << 20) -> Iterator[str]:
    """A text in pieces of about ``size``, cut before single spaces between words.

    A cut of that kind splits no word, and no token of the byte-level tokenizers.
    """
    at = 0
    while len(text) - at > size:
        cut = _GAP.search(text, at + size)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:] if at else text
