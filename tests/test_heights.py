import random

import pytest
from pyspark.sql import functions as F

from heightline.operators import heights, ordered


def heads(spark, rows):
    return spark.createDataFrame(rows, "chain string, number long, at long")


def filled(df, **kw):
    got = heights.head_gap_fill(df, "chain", "number", ["at", "number"], **kw).collect()
    return sorted((r.chain, r["head"], r.height) for r in got)


def test_catch_up(spark):
    # Last seen 3, then head 5: heights 4 and 5 are due.
    got = filled(heads(spark, [("a", 3, 1), ("a", 5, 2), ("a", 5, 3), ("a", 4, 4)]))
    assert got == [("a", 3, 3), ("a", 5, 4), ("a", 5, 5)]


def test_height_zero_is_a_height(spark):
    got = filled(heads(spark, [("a", 0, 1), ("a", 2, 2)]))
    assert got == [("a", 0, 0), ("a", 2, 1), ("a", 2, 2)]


def brute_fill(rows):
    out, last = [], {}
    for chain, number, _ in sorted(rows, key=lambda r: (r[2], r[1])):
        low = last[chain] + 1 if chain in last else number
        out += [(chain, number, h) for h in range(low, number + 1)]
        last[chain] = max(number, last.get(chain, number))
    return sorted(out)


@pytest.mark.parametrize("floor", [0, ordered.SMALL_KEY_ROWS])
def test_gap_fill_with_a_hot_chain(spark, floor):
    rng = random.Random(3)
    numbers = rng.sample(range(5000), 900)
    rows = [("hot" if rng.random() < 0.7 else f"c{rng.randrange(9)}", n, rng.randrange(60))
            for n in numbers]
    df = heads(spark, rows)
    assert ordered.has_large_key(df, ["chain"], 0)
    assert filled(df, floor=floor) == brute_fill(rows)


def test_chunks_are_contiguous_and_split_a_hot_key(spark):
    df = spark.range(4000).select(F.lit("k").alias("k"), (F.col("id") % 7).alias("t"), "id")
    rows = ordered.ordered_chunks(df, ["k"], ["t", "id"]).collect()
    seen = sorted((r.t, r.id, r[ordered.CHUNK]) for r in rows)
    assert [c for *_, c in seen] == sorted(c for *_, c in seen)
    sizes = [sum(1 for r in rows if r[ordered.CHUNK] == c) for c in {r[ordered.CHUNK] for r in rows}]
    assert len(sizes) == 4 and max(sizes) < 2 * min(sizes)


@pytest.mark.parametrize("floor", [0, ordered.SMALL_KEY_ROWS])
def test_high_water_mark(spark, floor):
    df = spark.createDataFrame(
        [("a", 10, True, 1), ("a", 15, True, 2), ("b", 20, True, 1), ("b", 30, False, 2),
         ("b", 5, True, 3), ("c", 9, False, 1)],
        "chain string, number long, ok boolean, at long")
    got = heights.high_water_mark(df, "chain", "number", F.col("ok"), ["at", "number"], floor=floor)
    assert sorted((r.chain, r.number, r.mark) for r in got.collect()) == [
        ("a", 10, 10), ("a", 15, 15), ("b", 5, 20), ("b", 20, 20), ("b", 30, 20), ("c", 9, None)]


def test_finalized_head(spark):
    df = spark.createDataFrame(
        [(77, None, 0), (None, 100, 10), (None, 5, 10), (None, None, 0), (77, 100, 10)],
        "tag long, latest long, c int")
    got = [df.filter(f"c = {c}").select(
        heights.finalized_head(F.col("tag"), F.col("latest"), c).alias("h")).collect()
        for c in (0, 10)]
    assert [r.h for r in got[0]] == [77, None] and [r.h for r in got[1]] == [90, None, 77]


@pytest.mark.parametrize("floor", [0, ordered.SMALL_KEY_ROWS])
def test_finalized_backlog(spark, floor):
    polls = spark.createDataFrame(
        [("a", 1, None), ("a", 2, 10), ("a", 3, 10), ("a", 4, 13), ("a", 5, None), ("a", 6, 12),
         ("a", 7, 14)], "chain string, poll long, f long")
    got = heights.finalized_backlog(polls, "chain", "f", ["poll"], floor=floor).collect()
    assert sorted((r.poll, r.height) for r in got) == [(2, 10), (4, 11), (4, 12), (4, 13), (7, 14)]


def test_long_ranges_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(heights, "RANGE_BLOCK", 10)
    df = spark.createDataFrame([(0, 99), (5, 4), (7, 7), (3, 12), (0, 9), (0, 10)], "lo long, hi long")
    got = heights.explode_heights(df, F.col("lo"), F.col("hi"), "h").collect()
    assert sorted((r.lo, r.h) for r in got) == sorted(
        [(0, h) for h in range(100)] + [(7, 7)] + [(3, h) for h in range(3, 13)]
        + [(0, h) for h in range(10)] + [(0, h) for h in range(11)])


def test_missing_heights(spark):
    done = spark.createDataFrame([("a", 1)] * 50 + [("a", 4), ("b", 2)], "chain string, number long")
    wanted = spark.createDataFrame([("a", 1, 5), ("b", 2, 3)], "chain string, lo long, hi long")
    got = heights.missing_heights(wanted, done, "chain", "lo", "hi", "number").collect()
    assert sorted((r.chain, r.height) for r in got) == [("a", 2), ("a", 3), ("a", 5), ("b", 3)]
