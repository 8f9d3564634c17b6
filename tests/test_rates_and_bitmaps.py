"""Sliding rates against a loop over ranges, height bitmaps against sets, work states against a table."""

import random

import pytest
from pyspark.sql import functions as F

from heightline.operators import backlog, heights, metrics


def growth(values):
    return sum(b if b < a else b - a for a, b in zip(values, values[1:])), sum(b < a for a, b in zip(values, values[1:]))


def brute_rates(rows, width, step):
    out = {}
    for name in {r[0] for r in rows}:
        mine = sorted((at, i, v) for n, at, i, v in rows if n == name and v is not None)
        for start in range((mine[0][0] // step - width) * step, mine[-1][0] + step, step) if mine else ():
            inside = [v for at, _, v in mine if start <= at < start + width]
            if inside:
                grown, resets = growth(inside)
                out[name, start] = (len(inside), resets, round(grown, 6))
    return out


def rates(spark, rows, width, step, floor):
    df = spark.createDataFrame(rows, "name string, at long, i long, v double").withColumn("ts", F.timestamp_seconds("at"))
    got = metrics.sliding_rate(df, ["name"], "ts", ["i"], "v", width, step, floor).collect()
    assert all(r.rate == pytest.approx(r.increase / width) for r in got)
    return {(r.name if hasattr(r, "name") else r[1], int(r.range_start.timestamp())): (r.samples, r.resets, round(r.increase, 6)) for r in got}


@pytest.mark.parametrize("floor", [0, 10**6])
def test_sliding_rate(spark, floor):
    rng = random.Random(floor + 1)
    rows = []
    for name, gap in (("dense", 7), ("sparse", 900), (None, 200)):
        at, value = 10_000, 0.0
        for i in range(120):
            at += rng.randrange(gap)
            value = 0.5 if rng.random() < 0.15 else value + rng.randrange(9)
            rows.append((name, at, i, None if rng.random() < 0.05 else value))
    rows += [("one", 33, 0, 4.0), ("before 1970", -77, 0, 1.0), ("before 1970", -15, 1, 3.0), ("none", 5, 0, None)]
    for width, step in ((240, 60), (60, 60), (600, 50)):
        assert rates(spark, rows, width, step, floor) == brute_rates(rows, width, step)


def test_a_reset_across_a_pane_border(spark):
    # 8 falls to 2 between the panes; the second pane grows on by 5.
    rows = [("c", 50, 0, 5.0), ("c", 59, 1, 8.0), ("c", 61, 2, 2.0), ("c", 90, 3, 7.0)]
    got = rates(spark, rows, 120, 60, 10**6)
    assert got["c", 0] == (4, 1, 10.0) and got["c", -60] == (2, 0, 3.0) and got["c", 60] == (2, 0, 5.0)


def test_states_of_chunks_merge(spark):
    rng = random.Random(2)
    rows = [("a" if i % 3 else "b", i, float(rng.randrange(50))) for i in range(500)]
    df = spark.createDataFrame(rows, "name string, i long, v double")
    whole, cut = (
        sorted(map(tuple, metrics.counter_states(df, ["name"], ["i"], "v", floor).collect())) for floor in (10**6, 0)
    )
    assert whole == cut
    for name, first, last, increase, resets, n in whole:
        mine = [v for k, _, v in rows if k == name]
        assert (first, last, (increase, resets), n) == (mine[0], mine[-1], growth(mine), len(mine))


def test_the_range_is_whole_steps(spark):
    with pytest.raises(ValueError):
        metrics.sliding_rate(spark.range(1), [], "id", [], "id", 100, 60)


def test_missing_heights_around_word_borders(spark):
    rng = random.Random(4)
    ranges = {"a": (0, 300), "b": (63, 64), "c": (-70, 130), "d": (5, 4), None: (100, 400), "full": (0, 127), "none": (1, 130)}
    done = [(c, n) for c, (lo, hi) in ranges.items() if c not in ("none", "full") for n in range(lo - 3, hi + 3) if rng.random() < 0.7]
    done += [("full", n) for n in range(128)] + done[:50] + [("a", None), ("unknown", 7)]
    wanted = spark.createDataFrame([(c, *r) for c, r in ranges.items()], "chain string, lo long, hi long")
    have = spark.createDataFrame(done, "chain string, n long")
    got = [tuple(r) for r in heights.missing_heights(wanted, have, "chain", "lo", "hi", "n").collect()]
    known = set(done)
    want = [(c, n) for c, (lo, hi) in ranges.items() for n in range(lo, hi + 1) if (c, n) not in known]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_wanted_heights_are_not_shuffled(spark):
    wanted = spark.createDataFrame([("a", 0, 6_400_000 - 1)], "chain string, lo long, hi long")
    have = spark.range(0, 6_400_000, 2).select(F.lit("a").alias("chain"), F.col("id").alias("n"))
    df = heights.missing_heights(wanted, have, "chain", "lo", "hi", "n")
    assert df.count() == 3_200_000
    plan = df._jdf.queryExecution().executedPlan().toString()
    # The list of single heights stands above every exchange.
    assert plan.index("getbit") < plan.index("Exchange")


def test_work_states(spark):
    rows = [
        ("1", True, False, True, False, False), ("2", True, False, False, True, False), ("3", True, True, True, True, False),
        ("4", False, False, False, False, True), ("5", True, False, False, False, False), ("6", None, None, None, None, None),
        ("7", True, False, True, True, False), ("7", False, True, False, False, False), ("8", True, False, False, False, False),
        ("8", False, False, False, True, False), (None, False, False, False, False, True),
    ]
    df = spark.createDataFrame(rows, "id string, d boolean, a boolean, o boolean, s boolean, n boolean")
    flags = dict(zip((backlog.DELIVERED, backlog.ACKED, backlog.OWN, backlog.STALE, backlog.NEW), map(F.col, "daosn")))
    got = {r.id: r.phase for r in backlog.phases(backlog.entry_states(df, flags)).collect()}
    assert got == {"1": "pending", "2": "reclaimed", "4": "new", "8": "reclaimed", None: "new"}
