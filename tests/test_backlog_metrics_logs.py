import random

import pytest
from pyspark.sql import functions as F

from heightline.operators import backlog, logs, metrics, ordered


def entries(spark, rows):
    return spark.createDataFrame(rows, "id string, delivered boolean, acked boolean")


def test_backlog_of_one_unacked_entry(spark):
    df = entries(spark, [("1000-0", True, False)])
    (r,) = backlog.backlog_summary(df, F.col("delivered"), F.col("acked"), 1500).collect()
    assert (r.stream_length, r.pending, r.oldest_pending_age_ms, r.lag) == (1, 1, 500, 0)
    (r,) = backlog.backlog_summary(df, F.col("delivered"), F.col("acked"), 900).collect()
    assert r.oldest_pending_age_ms == 0


def test_backlog_without_pending(spark):
    df = entries(spark, [("1-0", True, True), ("2-0", False, False)])
    (r,) = backlog.backlog_summary(df, F.col("delivered"), F.col("acked"), 9).collect()
    assert (r.stream_length, r.pending, r.oldest_pending_age_ms, r.lag) == (2, 0, 0, 1)


def test_pending_and_stale(spark):
    delivered = spark.createDataFrame(
        [("1-0", "other", 100), ("2-0", "me", 150), ("3-0", "other", 10)],
        "id string, consumer string, delivered_ms long")
    acked = spark.createDataFrame([("3-0",), ("3-0",)], "id string")
    waiting = backlog.pending(delivered, acked)
    assert sorted(r.id for r in waiting.collect()) == ["1-0", "2-0"]
    stale = backlog.reclaim_stale(waiting, "delivered_ms", 150, 50, "me").collect()
    assert [(r.id, r.idle_ms, r.claimed_by) for r in stale] == [("1-0", 50, "me")]
    assert backlog.reclaim_stale(waiting, "delivered_ms", 150, 0, "me").count() == 2


def test_oldest_and_pages_cover_everything_once(spark):
    ids = [f"{ms}-{seq}" for ms in (9, 10, 100) for seq in (0, 2, 10)]
    df = spark.createDataFrame([(i,) for i in random.Random(1).sample(ids, len(ids))], "id string")
    assert [r.id for r in backlog.oldest(df, 4).collect()] == ids[:4]
    seen, cursor = [], "0-0"
    while page := [r.id for r in backlog.page_after(df, cursor, 4).collect()]:
        seen += page
        cursor = page[-1]
    assert seen == ids


def test_work_list_keeps_the_first_phase(spark):
    make = lambda *x: spark.createDataFrame([(i,) for i in x], "id string")
    got = backlog.work_list([("pending", make("a")), ("reclaimed", make("a", "b")), ("new", make("c"))])
    assert sorted((r.id, r.phase) for r in got.collect()) == [
        ("a", "pending"), ("b", "reclaimed"), ("c", "new")]


def brute_increase(rows):
    out = {}
    for s, _, _, v in sorted(rows, key=lambda r: r[:3]):
        total, last = out.get(s, (0.0, None))
        if last is not None:
            total += v if v < last else v - last
        out[s] = (total, v)
    return {s: round(t, 6) for s, (t, _) in out.items()}


@pytest.mark.parametrize("floor", [0, ordered.SMALL_KEY_ROWS])
def test_counter_increase_with_resets(spark, floor):
    rng = random.Random(9)
    rows = [("hot" if rng.random() < 0.7 else f"s{rng.randrange(6)}", rng.randrange(40), i,
             float(rng.randrange(1000))) for i in range(800)]
    df = spark.createDataFrame(rows, "s string, t long, i long, v double")
    got = metrics.counter_increase(df, ["s"], ["t", "i"], "v", floor=floor).collect()
    assert {r.s: round(r.increase, 6) for r in got} == brute_increase(rows)
    assert sum(r.samples for r in got) == 800


def test_single_sample_grows_by_nothing(spark):
    df = spark.createDataFrame([("a", 1, 5.0)], "s string, t long, v double")
    (r,) = metrics.counter_increase(df, ["s"], ["t"], "v").collect()
    assert (r.increase, r.samples) == (0.0, 1)


def test_histogram_bounds_are_inclusive_and_cumulative(spark):
    df = spark.createDataFrame([("a", 5.0), ("a", 5.1), ("a", 9999.0), ("b", 1.0)], "m string, v double")
    got = metrics.histogram(df, F.col("v"), metrics.LATENCY_BOUNDS, ["m"]).collect()
    a = {r.le: r.bucket_count for r in got if r.m == "a"}
    assert (a["5"], a["10"], a["2000"], a["+Inf"]) == (1, 2, 2, 3) and len(a) == 10


def test_percent_never_divides_by_zero(spark):
    df = spark.createDataFrame([(0, 0), (1, 2)], "a long, b long")
    got = [r[0] for r in df.select(metrics.percent(F.col("a"), F.col("b"))).collect()]
    assert got == [0.0, 50.0]


def test_average_of_the_newest_samples(spark):
    df = spark.createDataFrame([("c", "s1", 1, 10.0), ("c", "s1", 2, 20.0), ("c", "s2", 1, 40.0)],
                               "c string, s string, t long, v double")
    (r,) = metrics.average_by(df, ["c"], ["s"], "t", "v").collect()
    assert r.average == 30.0


def test_selectors_match_in_full(spark):
    df = spark.createDataFrame([("scanner-replica1",), ("x-scanner-replica1",), ("scanner",), (None,)],
                               "n string")
    got = metrics.select_labels(df, {"n": "scanner-replica.*"}).collect()
    assert [r.n for r in got] == ["scanner-replica1"]
    assert metrics.select_labels(df, {"n": ".*|zz"}).count() == 4


def test_sliding_windows_hold_each_row_as_often_as_they_overlap(spark):
    df = spark.createDataFrame([(0,), (4,), (61,)], "s long").select(F.timestamp_seconds("s").alias("ts"))
    got = {int(r.w): r.total for r in metrics.sliding_count(df, "ts", 60, 5)
           .select(F.unix_seconds("window_start").alias("w"), "total").collect()}
    assert got[0] == 2 and got[-55] == 2 and got[5] == 1 and got[60] == 1 and 65 not in got
    assert sum(got.values()) == 3 * 12


@pytest.mark.parametrize("line,want", [
    ('level=INFO msg="a level=none b" service=s', ("INFO", "s", None)),
    ('msg="x level=bad" level="WARN" instance=i1', ("WARN", None, "i1")),
    ('sublevel=x service="two words"', (None, "two words", None)),
    (r'level="say \"hi\" level=no" service=', ('say "hi" level=no', "", None)),
    ('level=a level=b', ("b", None, None)),
    ('msg="' + "word " * 50_000 + r'\" level=no" level=ERROR', ("ERROR", None, None)),
])
def test_logfmt(spark, line, want):
    df = spark.createDataFrame([(line,)], "l string")
    tokens = logs.logfmt_tokens(F.col("l"))
    (r,) = df.select(
        *[logs.logfmt_field(tokens, f).alias(f) for f in ("level", "service", "instance")]
    ).collect()
    assert tuple(r) == want


def test_log_rules(spark):
    df = spark.createDataFrame([("/promtail", "kafka", "level=INFO"), ("/web", "scanner-replica12", "level=INFO"),
                                ("web2", "scanner-replica", "level=INFO")], "m string, service string, l string")
    named = logs.relabel(df, "m", logs.CONTAINER_PATTERN, "container")
    assert [r.container for r in named.collect()] == ["promtail", "web", None]
    kept = logs.drop_matching(named, "container", logs.DROPPED_CONTAINER)
    got = logs.extract_logfmt(kept, "l", "service", "scanner(-replica[0-9]+)?").collect()
    assert [(r.m, r.log_level) for r in got] == [("/web", "INFO"), ("web2", None)]
