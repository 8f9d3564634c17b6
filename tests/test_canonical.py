import json

from pyspark.sql import functions as F

from heightline.functions.hexes import ZERO_ADDRESS, ZERO_BLOOM, ZERO_HASH, ZERO_NONCE
from heightline.operators import canonical, contract, records
from heightline.schemas import BLOCK, OUTBOX


def decoded(spark, *payloads):
    df = spark.createDataFrame(list(enumerate(payloads)), "i int, payload string")
    return [r.block for r in canonical.decode_payload(df).orderBy("i").collect()]


def encoded(spark, *blocks):
    texts = [(i, json.dumps(b, default=int)) for i, b in enumerate(blocks)]
    df = spark.createDataFrame(texts, "i int, t string").select("i", F.from_json("t", BLOCK).alias("raw"))
    made = canonical.with_block(df).select("i", F.expr(canonical.encode_payload("block")).alias("p"))
    return [json.loads(r.p) for r in made.orderBy("i").collect()]


def raw_header(**fields):
    return {f.name: fields.get(f.name) for f in BLOCK["header"].dataType.fields}


def test_zero_block_writes_what_is_always_written(spark):
    (got,) = encoded(spark, {"hash": None, "header": None, "uncles": [], "transactions": None,
                             "withdrawals": []})
    assert got == {
        "hash": ZERO_HASH,
        "header": {
            "parentHash": ZERO_HASH, "uncleHash": ZERO_HASH, "coinbase": ZERO_ADDRESS,
            "root": ZERO_HASH, "txHash": ZERO_HASH, "receiptHash": ZERO_HASH, "bloom": ZERO_BLOOM,
            "number": 0, "mixDigest": ZERO_HASH, "nonce": ZERO_NONCE,
        },
    }


def test_zero_blob_gas_is_kept_and_zero_gas_dropped(spark):
    (got,) = encoded(spark, {
        "hash": "0x1", "header": raw_header(blobGasUsed=0, excessBlobGas=2**64 - 1, gasLimit=0,
                                            gasUsed=2**64 - 1, time=0, number=3),
        "uncles": None, "transactions": None, "withdrawals": None})
    h = got["header"]
    assert (h["blobGasUsed"], h["excessBlobGas"], h["gasUsed"], h["number"]) == (
        0, 2**64 - 1, 2**64 - 1, 3)
    assert "gasLimit" not in h and "time" not in h


def test_nested_lists(spark):
    tx = {"hash": "0x2", "type": 2, "to": None, "value": str(2**256 - 1), "gas": 0,
          "gasPrice": "0x10", "maxFeePerGas": None, "maxPriorityFeePerGas": "", "nonce": 0,
          "data": "0xABcd", "accessList": [{"address": "0x9", "storageKeys": []},
                                           {"address": "0x8", "storageKeys": ["0x7"]}],
          "chainId": "1"}
    (got,) = encoded(spark, {
        "hash": "0x1", "header": None, "uncles": [None, raw_header(number=7)],
        "transactions": [tx], "withdrawals": [None, {"index": 1, "validator": 2, "address": "0x3",
                                                     "amount": 4}]})
    made = got["transactions"][0]
    assert made == {
        "hash": "0x" + "2".rjust(64, "0"), "type": 2, "value": str(2**256 - 1), "gas": 0,
        "gasPrice": "16", "nonce": 0, "data": "0xabcd", "chainId": "1",
        "accessList": [{"address": "0x" + "9".rjust(40, "0")},
                       {"address": "0x" + "8".rjust(40, "0"),
                        "storageKeys": ["0x" + "7".rjust(64, "0")]}]}
    assert [u["number"] for u in got["uncles"]] == [0, 7]
    assert got["withdrawals"] == [
        {"index": 0, "validator": 0, "address": ZERO_ADDRESS, "amount": 0},
        {"index": 1, "validator": 2, "address": "0x" + "3".rjust(40, "0"), "amount": 4}]


def test_round_trip(spark):
    block = {"hash": "0x1", "header": raw_header(number=5, difficulty="0x0f", extra="0x0102",
                                                 withdrawalsHash="0x4", nonce="0x01"),
             "uncles": None, "transactions": None, "withdrawals": None}
    (once,) = encoded(spark, block)
    (back,) = decoded(spark, json.dumps(once))
    (twice,) = encoded(spark, back.asDict(recursive=True))
    assert twice == once
    assert once["header"]["difficulty"] == "15"


def test_unreadable_payloads(spark):
    bad = ["{", "nonsense", '{"header":{"number":"7"}}', '{"header":{"number":-1}}', "", None,
           '{"header":{"number":true}}']
    assert decoded(spark, *bad) == [None] * len(bad)
    good = decoded(spark, "{}", "null", '{"other":1,"header":{"number":9}}')
    assert [b.header.number for b in good] == [0, 0, 9]


PAYLOAD = '{"header":{"number":0}}'


def test_contract_reasons_in_order(spark):
    rows = [
        ("1-0", None, "1", "{}"), ("2-0", "", "1", "{}"), ("3-0", "0x1", None, "{}"),
        ("4-0", "0x1", "", "{}"), ("5-0", "0x1", "x", "{}"), ("6-0", "0x1", str(2**64), "{}"),
        ("7-0", "0x1", "1", None), ("8-0", "0x1", "1", ""), ("9-0", "0x1", "1", "{"),
        ("42-0", "0xabc", "7", PAYLOAD),
    ]
    df = spark.createDataFrame([(*r, "0") for r in rows], OUTBOX)
    got = {r.id: r for r in contract.check_messages(df).collect()}
    assert [got[r[0]].reason for r in rows] == [
        "hash_missing", "hash_empty", "number_missing", "number_empty", "number_invalid",
        "number_invalid", "payload_missing", "payload_empty", "payload_undecodable", None]
    assert got["42-0"].block.hash == "0x" + "abc".rjust(64, "0")
    assert got["42-0"].block.header.number == 7


def test_payload_values_win_over_the_message(spark):
    df = spark.createDataFrame(
        [("1-0", "0xabc", "7", '{"hash":"0xdef","header":{"number":5}}', "0")], OUTBOX)
    (row,) = contract.check_messages(df).collect()
    assert row.block.hash.endswith("def") and row.block.header.number == 5


def test_record_shape(spark):
    df = spark.createDataFrame([("0xbeef", 9)], "h string, n long").withColumn(
        "raw", F.expr(f"from_json(concat('{{\"hash\":\"', h, '\",\"header\":{{\"number\":', n, '}}}}'), "
                      f"'{BLOCK.simpleString()}')"))
    extras = F.array(records.header("x", F.lit("y")), records.header("", F.lit("z")))
    (row,) = records.block_records(canonical.with_block(df), "blocks", extras=extras).collect()
    assert bytes(row.key) == bytes.fromhex("beef".rjust(64, "0"))
    assert [(h.key, bytes(h.value).decode()) for h in row.headers] == [
        ("block-number", "9"), ("block-hash", "0x" + "beef".rjust(64, "0")), ("x", "y")]
    assert json.loads(bytes(row.value))["header"]["number"] == 9 and row.topic == "blocks"


def test_size_guard_counts_bytes(spark):
    df = spark.createDataFrame([("é" * 5,), ("e" * 10,), ("e" * 11,)], "v string")
    assert [r.rejected for r in contract.size_guard(df, "v", 10).collect()] == [False, False, True]
    assert [r.rejected for r in contract.size_guard(df, "v", 0).collect()] == [False] * 3


def test_zero_hash_is_rejected(spark):
    df = spark.createDataFrame([("0x1",), ("0x0",), (None,), (ZERO_HASH,)], "hash string")
    assert [r.hash for r in canonical.valid_blocks(df).collect()] == ["0x1"]
