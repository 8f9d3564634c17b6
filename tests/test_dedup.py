import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import numpy as np

from heightline.operators import dedup, markers, ordered


def brute(rows, ttl):
    live, kept = {}, []
    for key, at, i in sorted(rows, key=lambda r: (r[1], r[2])):
        if key not in live or at >= live[key] + ttl:
            live[key] = at
            kept.append(i)
    return sorted(kept)


def kept(spark, rows, ttl, floor):
    df = spark.createDataFrame(rows, "k string, at long, i long")
    return sorted(r.i for r in dedup.dedup_ttl(df, "k", "at", ttl, ["i"], floor=floor).collect())


@pytest.mark.parametrize("floor", [0, ordered.SMALL_KEY_ROWS])
def test_repeats_do_not_extend_and_expiry_is_exclusive(spark, floor):
    rows = [("a", t, i) for i, t in enumerate([0, 60, 99, 100, 150, 199, 200, 450, 450])]
    assert kept(spark, rows, 100, floor) == [0, 3, 6, 7]


SHAPES = {
    "sparse": (3000, 3_000_000),
    "dense": (3000, 3_000),
    "one instant": (3000, 3),
    "long chunks": (3000, 300_000),
}


@pytest.mark.parametrize("shape", SHAPES)
def test_hot_key_is_split_and_exact(spark, shape):
    n, span = SHAPES[shape]
    rng = random.Random(11)
    rows = [("hot" if rng.random() < 0.6 else f"k{rng.randrange(40)}", rng.randrange(span), i)
            for i in range(n)]
    for ttl in (1, 97, 1000, span):
        assert kept(spark, rows, ttl, 0) == brute(rows, ttl), ttl


def test_all_keys_large(spark):
    rng = random.Random(5)
    rows = [(rng.choice("ab"), rng.randrange(5000), i) for i in range(2000)]
    assert kept(spark, rows, 50, 0) == brute(rows, 50)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 60), min_size=1, max_size=40), st.integers(1, 20), st.integers(-20, 60))
def test_run_summary_equals_a_walk(times, ttl, carry):
    times = np.array(sorted(times))
    carry = min(carry, int(times[0]))
    upto, leaves = dedup._summarise_run(times, ttl)
    last = carry
    for t in times:
        if t >= last + ttl:
            last = int(t)
    steps = [int(v) for u, v in zip(upto, leaves) if carry + ttl <= u]
    assert (steps[0] if steps else carry) == last
    assert all(a != b for a, b in zip(leaves, leaves[1:]))


def test_large_keys_are_found(spark):
    rows = [("a",)] * 600 + [("b",)] * 90 + [(f"c{i}",) for i in range(900)]
    df = spark.createDataFrame(rows, "k string").repartition(7)
    assert [r.k for r in ordered.large_keys(df, "k", 100).collect()] == ["a"]
    assert ordered.large_keys(df, "k") is None
    assert ordered.large_keys(df.limit(0), "k", 0) is None
    assert ordered.has_large_key(df, ["k"], 500) and not ordered.has_large_key(df, ["k"], 600)


def test_joins_keep_all_rows_of_a_large_key(spark):
    df = spark.createDataFrame([("hot" if i % 2 else f"k{i}", i) for i in range(400)], "hash string, i long")
    for marked in (["hot", "k0"], ["k2"]):
        known = spark.createDataFrame([(h, 1) for h in marked * 3], "hash string, published_at long")
        want = sorted(i for h, i in df.collect() if h not in marked)
        assert sorted(r.i for r in markers.skip_published(df, known, "hash", 0).collect()) == want
        looked = markers.look_up_markers(df, known, "hash", 0).collect()
        assert sorted(r.i for r in looked if not r.published) == want and len(looked) == 400


def test_first_and_latest(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 5, "z"), ("a", 3, "w")],
                               "k string, o long, v string")
    assert sorted(r.v for r in dedup.first_arrival(df, ["k"], ["o"]).collect()) == ["y", "z"]
    assert sorted(r.v for r in dedup.latest_per_key(df, ["k"], ["o"]).collect()) == ["w", "z"]


def test_rank_filter_runs_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", 1)], "k string, o long")
    plan = dedup.first_arrival(df, ["k"], ["o"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_markers(spark):
    ledger = spark.createDataFrame([("h1", 100), ("h2", 50), ("h1", 90)], "hash string, published_at long")
    live = markers.live_markers(ledger, "published_at", 50, 100)
    assert sorted(r["hash"] for r in live.collect()) == ["h1", "h1"]
    assert markers.live_markers(ledger, "published_at", 0, 10**9).count() == 3
    asked = spark.createDataFrame([("h1", 1), ("h2", 2), ("h3", 3), ("h3", 4), (" ", 5), ("\t", 6)],
                                  "hash string, o long")
    new = markers.insert_markers(asked, live, "hash", ["o"])
    assert sorted((r["hash"], r.o) for r in new.collect()) == [("h2", 2), ("h3", 3)]
    again = markers.insert_markers(asked, live.unionByName(
        new.selectExpr("hash", "o AS published_at")), "hash", ["o"])
    assert again.count() == 0
    found = markers.look_up_markers(asked, live, "hash").collect()
    assert sorted((r.o, r.published) for r in found)[:3] == [(1, True), (2, False), (3, False)]
    assert sorted(r.o for r in markers.skip_published(asked, live, "hash").collect()) == [2, 3, 4, 5, 6]


def test_null_key_is_split_too(spark):
    rng = random.Random(3)
    rows = [(None if rng.random() < 0.7 else rng.choice("ab"), rng.randrange(900), i) for i in range(1500)]
    for ttl in (1, 40, 900, 5000):
        assert kept(spark, rows, ttl, 0) == brute(rows, ttl), ttl


def test_chunks_follow_the_rows(spark, monkeypatch):
    monkeypatch.setattr(ordered, "CHUNK_ROWS", 50)
    rows = [("a", i * 3, i) for i in range(1000)]
    df = spark.createDataFrame(rows, "k string, at long, i long")
    sizes = [r["count"] for r in ordered.ordered_chunks(df, ["k"], ["at", "i"]).groupBy(ordered.CHUNK).count().collect()]
    assert len(sizes) >= 18 and max(sizes) <= 150
    for ttl in (7, 1000):
        assert kept(spark, rows, ttl, 0) == brute(rows, ttl), ttl


def walked(steps, ttl):
    """The carried times of one key's steps, chunk by chunk."""
    carry, out = None, {}
    for chunk in sorted({c for c, _, _ in steps}):
        out[chunk] = carry
        for _, upto, leaves in sorted(s for s in steps if s[0] == chunk):
            if carry is None or carry + ttl <= upto:
                carry = leaves
                break
    return out


def test_carried_times_equal_a_walk(spark):
    rng = random.Random(8)
    for ttl, gap in ((30, 1), (30, 9), (200, 3), (10_000, 2)):
        times, at = [], 0
        for _ in range(400):
            at += rng.randrange(gap + 1)
            times.append(at)
        cuts = sorted(rng.sample(range(1, 400), 25))
        steps = []
        for chunk, (a, b) in enumerate(zip([0, *cuts], [*cuts, 400])):
            upto, leaves = dedup._summarise_run(np.array(times[a:b]), ttl)
            steps += [(chunk, int(u), int(v)) for u, v in zip(upto, leaves)]
        df = spark.createDataFrame([("k", *s) for s in steps], f"k string, {ordered.CHUNK} int, upto long, leaves long")
        for floor in (0, ordered.SMALL_KEY_ROWS):
            got = dedup._carried_times(df, "k", ttl, floor).collect()
            assert {r["_in"]: r["_carry"] for r in got} == walked(steps, ttl)


def test_a_key_within_one_ttl_has_no_links(spark):
    # Every row is a step of its chunk, and none of them leads anywhere: no join, no walk.
    steps = [("k", c, 10 * c + i, 10 * c + i) for c in range(8) for i in range(10)]
    df = spark.createDataFrame(steps, f"k string, {ordered.CHUNK} int, upto long, leaves long")
    assert dedup._next_steps(df, "k", 1000, 0).count() == 0
