"""Repairs against a search over all edits."""

import hashlib
import heapq
import random
import re

import pytest
from pyspark.sql import functions as F

from heightline.llm import queries, repair

SCHEMA = "conv_id long, turn long, role string, text string"
WANTED = re.compile(r"(s?(ua)+)?\Z")
SPACES = " \t\n\x0b\x0c\r"


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.strip(SPACES)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def brute_repair(rows, kinds):
    """Least (cost, initials) by best-first search over edit sequences, with the repaired turns."""
    heap = [(0, "", 0, "", ())]
    closed = set()
    while heap:
        cost, audit, i, roles, kept = heapq.heappop(heap)
        if i == len(rows) and WANTED.match(roles):
            return cost, audit, kept
        # What can still follow depends on the last roles only.
        key = (i, roles[-1:], len(roles) > 0)
        if (key, cost, audit) in closed:
            continue
        closed.add((key, cost, audit))
        if not re.match(r"s?(ua)*u?\Z", roles) or cost > 3 * len(rows) + 8:
            continue
        for c, name in (("u", "user"), ("a", "assistant")):
            if audit[-2:] != "II":
                heapq.heappush(heap, (cost + 2, audit + "I", i, roles + c, (*kept, f"{name}:")))
        if i < len(rows):
            _, role, text = rows[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, roles, kept))
            if kinds[i] not in ("blank", "duplicate"):
                late = kinds[i] == "truncated"
                heapq.heappush(heap, (cost + late, audit + "K", i + 1, roles + (role[:1] or "?"), (*kept, f"{role}:{text}")))
                for c, name in (("u", "user"), ("a", "assistant")):
                    heapq.heappush(heap, (cost + 2 + late, audit + "R", i + 1, roles + c, (*kept, f"{name}:{text}")))


def expected(rows):
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    out = {}
    for conv, mine in by.items():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        kinds = faults(mine)
        turns = [t for t, _, _ in mine if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        cost, audit, kept = brute_repair(mine, kinds)
        digest = hashlib.sha256("\n".join(kept).encode()).hexdigest()
        out[conv] = (gaps, *(kinds.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)
    return out


def found(df):
    return {r[0]: tuple(r)[1:] for r in repair.summary(df).collect()}


def random_rows(seed, convs=60, longest=6):
    rng = random.Random(seed)
    rows = []
    for conv in range(convs):
        for turn in range(rng.randrange(1, longest + 1)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = rng.choice(["yes.", "no!", "why?", "cut", " \t\n", "", None, f"turn {turn}.", "ends in space. \n"])
            rows.append((conv, rng.choice([turn, turn, turn + 3, None]), role, text))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", range(4))
def test_equals_search(spark, seed):
    rows = random_rows(seed)
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(repair.edits(df)) == expected(rows)


def test_state_goes_on_over_batches(spark):
    rng = random.Random(9)
    rows = [(77, t, rng.choice(["user", "assistant"]), f"{t}.") for t in range(3000)]
    rows += [(c, t, ("user", "assistant")[t % 2], f"{t}.") for c in range(20) for t in range(4)]
    df = spark.createDataFrame(rows, SCHEMA)
    whole = found(repair.edits(df))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert found(repair.edits(df)) == whole
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    # The same sum forward, over the last role that came out.
    roles = [r[2][0] for r in sorted(rows[:3000], key=lambda r: r[1])]
    least = {"": 0, "u": 10**9, "a": 10**9}
    for role in roles:
        step = {}
        for state, cost in least.items():
            for word, price in (("", 3), *((w, 0 if w == role else 2) for w in "ua")):
                for put in ("", "u", "a", "ua", "au"):
                    text = state + put + word
                    if re.fullmatch(r"(ua)*u?|(au)*a?", text) and (state or not text or text[0] == "u"):
                        new = text[-1:] or state
                        step[new] = min(step.get(new, 10**9), cost + price + 2 * len(put))
        least = step
    assert whole[77][5] == min(least[""], least["a"], least["u"] + 2)


def test_rows_of_the_repair(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "assistant", "Hi."), (1, 2, "assistant", "Hi."), (1, 3, "user", "Bye.")]
    got = repair.edits(spark.createDataFrame(rows, SCHEMA)).orderBy("step").collect()
    assert [r.edit for r in got] == ["K", "I", "K", "D", "K", "I"]
    assert [r.new_role for r in got] == ["system", "user", "assistant", None, "user", "assistant"]
    assert got[3].fault == "duplicate" and got[1].turn is None and {r.cost for r in got if r.edit != "I"} == {7, 5, 2}


def test_gone_rows_empty_tables_and_odd_columns(spark):
    rows = [(1, 0, "user", "a.", True), (2, 0, "user", "a.", True), (2, 1, "user", "b.", False), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, f"{SCHEMA}, gone boolean")
    odd = df.select("*", *(F.lit(1).alias(c) for c in ("conv", "step", "fault", "pointer", "cost", "seen")))
    got = found(repair.edits(odd, gone="gone"))
    empty = hashlib.sha256(b"").hexdigest()
    assert got[1] == (0, 0, 0, 0, 0, 0, "", empty)
    assert got[2][5:7] == (2, "KI") and got[None] == (0, 1, 0, 0, 0, 3, "D", empty)
    assert found(repair.edits(odd.limit(0), gone="gone")) == {}


def test_very_long_texts_and_repeated_rows(spark):
    long = "word " * 400_000 + "."
    rows = [(1, 0, "user", long)] * 4 + [(1, 1, "assistant", long)] * 3
    got = found(repair.edits(spark.createDataFrame(rows, SCHEMA)))
    assert got == expected(rows) and got[1][2] == 5


def test_damage(spark):
    rows = [(c, t, "assistant", "Well. Fine!") for c in range(60) for t in (*range(4), None)] + [(None, 1, None, None)]
    got = queries.damaged(spark.createDataFrame(rows, SCHEMA)).collect()
    import zlib

    want = []
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = role or " ", text or " "
        row = (c, t, "user" if kind == 4 else role, "" if kind == 1 else "Well Fine" if kind == 2 and c is not None else text, kind == 0)
        want += [row] * (2 if kind == 3 else 1)
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
