"""Cases that once gave a wrong answer or stopped a job."""

import pytest
from pyspark.sql import functions as F

from heightline.operators import backlog, canonical, contract, dedup, heights, markers, metrics, ordered


@pytest.mark.parametrize("floor", [0, ordered.SMALL_KEY_ROWS])
def test_null_keys_keep_their_rows(spark, floor):
    rows = [(None if i % 5 == 0 else f"c{i % 2}", i * 7 % 50, i) for i in range(200)]
    df = spark.createDataFrame(rows, "chain string, number long, at int").repartition(3)
    marked = heights.high_water_mark(df, "chain", "number", F.col("number") % 3 > 0, ["at"], floor)
    got = sorted((r.chain or "", r.at, r.mark) for r in marked.collect())
    best, want = {}, []
    for chain, number, at in rows:
        if number % 3 > 0:
            best[chain] = max(best.get(chain, number), number)
        want.append((chain or "", at, best.get(chain)))
    assert got == sorted(want)
    filled = heights.head_gap_fill(df, "chain", "number", ["at"], floor)
    assert filled.where("chain IS NULL").count() > 0


def test_large_keys_have_a_bound_in_rows(spark):
    df = spark.range(3000).select(F.when(F.col("id") < 2000, F.col("id") % 2).otherwise(F.col("id")).alias("k"))
    assert sorted(r.k for r in ordered.large_keys(df, "k", 500).collect()) == [0, 1]
    assert ordered.large_keys(df, "k", 1000) is None


def test_binary_hashes(spark):
    df = spark.createDataFrame([(bytearray([i % 3]),) for i in range(30)], "hash binary")
    known = spark.createDataFrame([(bytearray([1]),)], "hash binary")
    for floor in (0, ordered.SMALL_KEY_ROWS):
        assert markers.skip_published(df, known, "hash", floor).count() == 20


def test_blank_hashes_have_no_answer(spark):
    df = spark.createDataFrame([("a",), ("b",), (" ",), (None,)], "hash string")
    known = spark.createDataFrame([("a",), (" ",)], "hash string")
    found = {r.hash: r.published for r in markers.look_up_markers(df, known, "hash").collect()}
    assert found == {"a": True, "b": False, " ": None, None: None}


def test_ids_that_cannot_be_read_come_last(spark):
    df = spark.createDataFrame([("bad",), ("4-0",), ("3-1",)], "id string")
    assert [r.id for r in backlog.oldest(df, 2).collect()] == ["3-1", "4-0"]


def test_equal_times_are_decided(spark):
    df = spark.createDataFrame([("s", 1, 2.0), ("s", 1, 5.0), ("s", 1, 3.0)], "s string, ts int, value double")
    assert metrics.gauge_last(df, ["s"], "ts", "value").first()["value"] == 5.0


def test_patterns_match_whole_labels(spark):
    df = spark.createDataFrame([("promtail",), ("promtail\n",)], "c string")
    assert df.filter(metrics.matches(F.col("c"), "promtail")).count() == 1


def test_heights_of_64_bits_are_sound(spark):
    rows = [(str(n), "0x1", str(n), '{"header":{"number":0}}') for n in (7, 2**63 - 1, 2**63, 2**64 - 1, 2**64)]
    df = spark.createDataFrame(rows, "id string, hash string, number string, payload string")
    found = {int(r.id): (r.reason, r.reason or int(r.block.header.number)) for r in contract.check_messages(df).collect()}
    assert found == {n: (None, n) for n in (7, 2**63 - 1, 2**63, 2**64 - 1)} | {2**64: ("number_invalid",) * 2}


@pytest.mark.parametrize("floor", [0, ordered.SMALL_KEY_ROWS])
def test_null_keys_have_a_time_to_live(spark, floor):
    rows = [(None if i % 3 == 0 else f"k{i % 2}", i * 5 % 97, i) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, at long, i int").repartition(4)
    got = sorted(r.i for r in dedup.dedup_ttl(df, "k", "at", 10, ["i"], floor).collect())
    accepted, want = {}, []
    for k, at, i in sorted(rows, key=lambda r: (r[1], r[2])):
        if k not in accepted or at >= accepted[k] + 10:
            accepted[k] = at
            want.append(i)
    assert got == sorted(want)


UNSOUND = [
    '{"header":{"number":7}}garbage', '{"header":{"number":7}}{}', '{},{}', '{},"p":{}', '{}],"q":[{}',
    '{},"end":1} x', '{}}', '[{}]', '{"hash":5}', '{"hash":{"a":1}}', '{"hash":true}', "{'hash':'0x1'}",
    '{"header":{"nonce":1}}', '{"header":{"number":7.5}}', '{"header":{"gasLimit":"5"}}',
    '{"header":{"gasLimit":-5}}', '{"header":{"gasLimit":5.7}}',
    '{"header":{"gasLimit":36893488147419103232}}', '{"header":{"gasLimit":1%s}}' % ("0" * 40),
    '{"header":{"blobGasUsed":-1}}', '{"uncles":[{"gasUsed":-1}]}', '{"uncles":[{"extra":7}]}',
    '{"transactions":[{"gas":-1}]}', '{"transactions":[{"type":300}]}', '{"transactions":[{"type":-1}]}',
    '{"transactions":[{"nonce":"1"}]}', '{"transactions":[{"to":1}]}', '{"transactions":[{"hash":"0x1"},{"hash":2}]}',
    '{"transactions":[{"accessList":[{"address":1}]}]}',
    '{"transactions":[{"accessList":[{"storageKeys":[1]}]}]}', '{"withdrawals":[{"amount":-1}]}',
    '{"withdrawals":[{"address":0}]}',
]
SOUND = [
    "{}", " null ", ' {"hash":"0x1"}\n', '{"other":{"x":[1,"a"]},"header":{"number":9}}',
    '{"header":{"gasLimit":18446744073709551615,"nonce":"0x1"}}', '{"hash":null,"header":null,"uncles":[null]}',
    '{"transactions":[{"type":255,"nonce":1,"accessList":[{"address":"0x1","storageKeys":["0x2"]}]},{"nonce":null}]}',
    '{"withdrawals":[null,{"index":1,"address":"0x3"}],"transactions":[]}',
]


def test_payloads_are_read_strictly(spark):
    df = spark.createDataFrame(list(enumerate(UNSOUND + SOUND)), "i int, payload string")
    blocks = [r.block for r in canonical.decode_payload(df).orderBy("i").collect()]
    assert [p for p, b in zip(UNSOUND, blocks) if b is not None] == []
    assert [p for p, b in zip(SOUND, blocks[len(UNSOUND) :]) if b is None] == []


def test_long_ranges_are_whole(spark):
    df = spark.createDataFrame([(5, 4), (1, 1), (10, 250_011)], "lo long, hi long")
    got = heights.explode_heights(df, F.col("lo"), F.col("hi"), "h").agg(F.count("h"), F.min("h"), F.max("h")).first()
    assert tuple(got) == (1 + 250_002, 1, 250_011)
