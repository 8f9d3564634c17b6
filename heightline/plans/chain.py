"""Block and height queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.hexes import ZERO_ADDRESS, ZERO_BLOOM, ZERO_HASH, ZERO_NONCE
from ..operators import canonical, contract, heights
from ..operators.ordered import by_value
from ..sources.tables import in_height_range
from . import inputs
from .registry import query

_BLOCKS = inputs.ORDER_BLOCKS_SQL
_HEADS = inputs.HEADS_SQL
_LINES = inputs.LINES_SQL

# The height range of the scan query.
SCAN_LOW, SCAN_HIGH = 1_000, 500_000


def mapped(df):
    return canonical.with_block(df)


@query(
    "block_scan",
    f"""SELECT chain, number, hash, time FROM (
        SELECT *, arrived AS time FROM ({_BLOCKS})) WHERE number >= {SCAN_LOW} AND number <= {SCAN_HIGH}""",
)
def block_scan(spark, sf):
    blocks = inputs.heads(spark, sf)
    return in_height_range(blocks, "number", SCAN_LOW, SCAN_HIGH).select(
        "chain",
        "number",
        F.concat(F.lit("0x"), F.sha2(F.col("number").cast("string"), 256)).alias("hash"),
        F.col("arrived").alias("time"),
    )


_HEADER_COLUMNS = {
    "parent_hash": "parentHash",
    "uncle_hash": "uncleHash",
    "coinbase": "coinbase",
    "bloom": "bloom",
    "difficulty": "difficulty",
    "number": "number",
    "gas_limit": "gasLimit",
    "gas_used": "gasUsed",
    "time": "time",
    "extra": "extra",
    "nonce": "nonce",
    "base_fee": "baseFee",
    "withdrawals_hash": "withdrawalsHash",
    "beacon_root": "parentBeaconRoot",
    "blob_gas_used": "blobGasUsed",
    "excess_blob_gas": "excessBlobGas",
}
_COUNTS = {"number", "time", "gasLimit", "gasUsed", "blobGasUsed", "excessBlobGas"}


def _flat_header(header):
    return [
        (header[f].cast("bigint") if f in _COUNTS else header[f]).alias(c)
        for c, f in _HEADER_COLUMNS.items()
    ]


_HEADER_SQL = f"""SELECT hash, parent_hash, '{ZERO_HASH}' AS uncle_hash, coinbase, bloom, difficulty,
    number, CAST(gas_limit AS BIGINT) AS gas_limit, gas_used, arrived AS time, extra, nonce, base_fee,
    CAST(NULL AS VARCHAR) AS withdrawals_hash, beacon_root,
    CAST(blob_gas_used AS BIGINT) AS blob_gas_used, CAST(NULL AS BIGINT) AS excess_blob_gas
    FROM ({_BLOCKS})"""


@query("header_project", _HEADER_SQL)
def header_project(spark, sf):
    df = inputs.order_blocks(spark, sf).withColumn(
        "h", F.expr(canonical.map_header("raw.header"))
    )
    return df.select(F.col("raw.hash").alias("hash"), *_flat_header(F.col("h")))


@query(
    "block_map",
    f"""WITH l AS ({_LINES}), c AS (
            SELECT doc_id, count(*) AS n,
                   sum(octet_length(encode(line))) AS bytes
            FROM l GROUP BY doc_id)
        SELECT '0x' || sha256(CAST(d.doc_id AS VARCHAR)) AS hash, d.doc_id AS number,
               d.n_chars AS gas_used,
               CAST(n AS INTEGER) AS uncles,
               CAST(n AS INTEGER) AS transactions, CAST(n AS INTEGER) AS withdrawals,
               CAST(bytes AS BIGINT) AS data_bytes
        FROM documents d JOIN c USING (doc_id)""",
)
def block_map(spark, sf):
    b = F.col("block")
    sizes = F.transform(
        b["transactions"],
        lambda t: F.coalesce(
            F.call_function("div", F.length(t["data"]) - 2, F.lit(2)), F.lit(0)
        ).cast("bigint"),
    )
    return mapped(inputs.document_blocks(spark, sf)).select(
        b["hash"].alias("hash"),
        b["header"]["number"].cast("bigint").alias("number"),
        b["header"]["gasUsed"].cast("bigint").alias("gas_used"),
        F.when(b["uncles"].isNotNull(), F.size(b["uncles"])).alias("uncles"),
        F.size(b["transactions"]).alias("transactions"),
        F.size(b["withdrawals"]).alias("withdrawals"),
        F.aggregate(sizes, F.lit(0).cast("bigint"), lambda a, x: a + x).alias("data_bytes"),
    )


_UNCLES_SQL = f"""SELECT doc_id, pos,
            '0x' || sha256(line) AS parent_hash, '{ZERO_ADDRESS}' AS coinbase,
            '{ZERO_BLOOM}' AS bloom, '{ZERO_NONCE}' AS nonce, CAST(n AS BIGINT) AS number,
            CAST(n * 21 AS BIGINT) AS gas_used, CAST(0 AS BIGINT) AS time,
            CASE WHEN n > 0 THEN '0x' || lower(hex(encode(line))) END AS extra, CAST(NULL AS VARCHAR) AS base_fee
        FROM (SELECT *, octet_length(encode(line)) AS n FROM ({_LINES}))"""


def _elements(df, items, name):
    """The elements of a list and their places.

    The plain generator would have a filter on the list's size put below it, which
    works the whole list out a second time.
    """
    return df.select("doc_id", F.posexplode_outer(items).alias("pos", name)).filter("pos IS NOT NULL")


def _uncle_rows(df, items):
    u = F.col("u")
    return _elements(df, items, "u").select(
        "doc_id",
        F.col("pos").cast("bigint").alias("pos"),
        u["parentHash"].alias("parent_hash"),
        u["coinbase"].alias("coinbase"),
        u["bloom"].alias("bloom"),
        u["nonce"].alias("nonce"),
        u["number"].cast("bigint").alias("number"),
        u["gasUsed"].cast("bigint").alias("gas_used"),
        u["time"].cast("bigint").alias("time"),
        u["extra"].alias("extra"),
        u["baseFee"].alias("base_fee"),
    )


@query("uncles_map", _UNCLES_SQL)
def uncles_map(spark, sf):
    return _uncle_rows(inputs.document_blocks(spark, sf), F.expr(canonical.map_headers("raw.uncles")))


# Each tuple as address|key,key; tuples of a transaction are joined by semicolons.
_TUPLES = (
    "'0x' || substr(sha256(line), 1, 40) || '|0x' || repeat('0', 61) || 'abc,0x' || sha256(line)",
    "';0x' || substr(sha256(line), 21, 40) || '|'",
    f"';{ZERO_ADDRESS}|0x' || sha256(line)",
)
_ACCESS_SQL = " || ".join(f"CASE WHEN n >= {120 * (i + 1)} THEN {t} ELSE '' END" for i, t in enumerate(_TUPLES))
_TX_SQL = f"""SELECT doc_id, pos, '0x' || sha256(line) AS hash,
            CASE WHEN n > 160 THEN 2 WHEN n > 80 THEN 1 ELSE 0 END AS type,
            CASE WHEN n > 80 THEN '0x' || substr(sha256(line), 25, 40) END AS "to",
            CAST(n * 1000000007 AS VARCHAR) AS value, CAST(n * 16 + 21000 AS BIGINT) AS gas,
            CAST(n AS VARCHAR) AS gas_price, CAST(NULL AS VARCHAR) AS max_fee, pos AS nonce,
            CASE WHEN n > 0 THEN '0x' || lower(hex(encode(line))) END AS data,
            CAST(least(3, n // 120) AS INTEGER) AS access_tuples, nullif({_ACCESS_SQL}, '') AS access_list,
            '1' AS chain_id
        FROM (SELECT *, octet_length(encode(line)) AS n FROM ({_LINES}))"""


def _tx_rows(df, items):
    t = F.col("t")
    shown = F.transform(
        t["accessList"],
        lambda a: F.concat(
            a["address"], F.lit("|"), F.array_join(F.coalesce(a["storageKeys"], F.array().cast("array<string>")), ",")
        ),
    )
    return _elements(df, items, "t").select(
        "doc_id",
        F.col("pos").cast("bigint").alias("pos"),
        t["hash"].alias("hash"),
        t["type"].alias("type"),
        t["to"].alias("to"),
        t["value"].alias("value"),
        t["gas"].cast("bigint").alias("gas"),
        t["gasPrice"].alias("gas_price"),
        t["maxFeePerGas"].alias("max_fee"),
        t["nonce"].cast("bigint").alias("nonce"),
        t["data"].alias("data"),
        F.coalesce(F.when(t["accessList"].isNotNull(), F.size(t["accessList"])), F.lit(0)).alias("access_tuples"),
        F.array_join(shown, ";").alias("access_list"),
        t["chainId"].alias("chain_id"),
    )


@query("tx_map", _TX_SQL)
def tx_map(spark, sf):
    return _tx_rows(inputs.document_blocks(spark, sf), F.expr(canonical.map_transactions("raw.transactions")))


_WITHDRAWALS_SQL = f"""SELECT doc_id, pos, CASE WHEN line = '' THEN 0 ELSE pos END AS idx,
            CAST(octet_length(encode(line)) AS BIGINT) AS validator,
            CASE WHEN line = '' THEN '{ZERO_ADDRESS}'
                 ELSE '0x' || substr(sha256(line), 25, 40) END AS address,
            CAST(octet_length(encode(line)) * 32 AS BIGINT) AS amount
        FROM ({_LINES})"""


def _withdrawal_rows(df, items):
    w = F.col("w")
    return _elements(df, items, "w").select(
        "doc_id",
        F.col("pos").cast("bigint").alias("pos"),
        w["index"].cast("bigint").alias("idx"),
        w["validator"].cast("bigint").alias("validator"),
        w["address"].alias("address"),
        w["amount"].cast("bigint").alias("amount"),
    )


@query("withdrawal_map", _WITHDRAWALS_SQL)
def withdrawal_map(spark, sf):
    return _withdrawal_rows(inputs.document_blocks(spark, sf), F.expr(canonical.map_withdrawals("raw.withdrawals")))


def payload_sql(fields: list[tuple[str, str]]) -> str:
    """SQL text of a JSON object: literal names, each with its SQL value text."""
    parts = [f"""coalesce('"{name}":' || ({value}) || ',', '')""" for name, value in fields]
    return "'{' || rtrim(" + " || ".join(parts) + ", ',') || '}'"


def _quoted(value: str) -> str:
    return f"""'"' || {value} || '"'"""


_ENCODED_HEADER = payload_sql(
    [
        ("parentHash", _quoted("parent_hash")),
        ("uncleHash", _quoted(f"'{ZERO_HASH}'")),
        ("coinbase", _quoted("coinbase")),
        ("root", _quoted(f"'{ZERO_HASH}'")),
        ("txHash", _quoted(f"'{ZERO_HASH}'")),
        ("receiptHash", _quoted(f"'{ZERO_HASH}'")),
        ("bloom", _quoted("bloom")),
        ("difficulty", _quoted("difficulty")),
        ("number", "CAST(number AS VARCHAR)"),
        ("gasLimit", "CASE WHEN gas_limit <> 0 THEN CAST(gas_limit AS VARCHAR) END"),
        ("gasUsed", "CASE WHEN gas_used <> 0 THEN CAST(gas_used AS VARCHAR) END"),
        ("time", "CASE WHEN arrived <> 0 THEN CAST(arrived AS VARCHAR) END"),
        ("extra", _quoted("extra")),
        ("mixDigest", _quoted(f"'{ZERO_HASH}'")),
        ("nonce", _quoted("nonce")),
        ("baseFee", _quoted("base_fee")),
        ("parentBeaconRoot", _quoted("beacon_root")),
        ("blobGasUsed", "CAST(blob_gas_used AS VARCHAR)"),
    ]
)
PAYLOAD_SQL = (
    f"""SELECT *, '{{"hash":"' || hash || '","header":' || {_ENCODED_HEADER} || '}}' AS payload
    FROM ({_BLOCKS})"""
)


@query("payload_encode", f"SELECT number, payload FROM ({PAYLOAD_SQL})")
def payload_encode(spark, sf):
    return mapped(inputs.order_blocks(spark, sf)).select(
        "number", F.expr(canonical.encode_payload("block")).alias("payload")
    )


@query("payload_decode", _HEADER_SQL)
def payload_decode(spark, sf):
    encoded = mapped(inputs.order_blocks(spark, sf)).select(
        F.expr(canonical.encode_payload("block")).alias("payload")
    )
    block = F.col("block")
    return canonical.decode_payload(encoded).select(
        block["hash"].alias("hash"), *_flat_header(block["header"])
    )


# --- nested payloads: blocks with uncles, transactions, access lists and withdrawals ---------


def _list_sql(rows: str, order: str = "pos") -> str:
    return f"'[' || string_agg({rows}, ',' ORDER BY {order}) || ']'"


_ZEROS = {name: _quoted(f"'{zero}'") for name, zero in (("hash", ZERO_HASH), ("address", ZERO_ADDRESS), ("bloom", ZERO_BLOOM), ("nonce", ZERO_NONCE))}


def _sparse_header(parent: str, number: str, gas_used: str, extra: str) -> str:
    """A header with only these fields set, as JSON text."""
    return payload_sql(
        [
            ("parentHash", parent),
            ("uncleHash", _ZEROS["hash"]),
            ("coinbase", _ZEROS["address"]),
            ("root", _ZEROS["hash"]),
            ("txHash", _ZEROS["hash"]),
            ("receiptHash", _ZEROS["hash"]),
            ("bloom", _ZEROS["bloom"]),
            ("number", f"CAST({number} AS VARCHAR)"),
            ("gasUsed", f"CASE WHEN {gas_used} <> 0 THEN CAST({gas_used} AS VARCHAR) END"),
            ("extra", extra),
            ("mixDigest", _ZEROS["hash"]),
            ("nonce", _ZEROS["nonce"]),
        ]
    )


_HASH_SQL, _DATA_SQL = _quoted("'0x' || sha256(line)"), f"CASE WHEN n > 0 THEN {_quoted("'0x' || lower(hex(encode(line)))")} END"
_KEY_SQL = f"'\"0x' || sha256(line) || '\"'"
_ACCESS_JSON = [
    payload_sql([("address", _quoted("'0x' || substr(sha256(line), 1, 40)")), ("storageKeys", f"'[\"0x{'0' * 61}abc\",' || {_KEY_SQL} || ']'")]),
    payload_sql([("address", _quoted("'0x' || substr(sha256(line), 21, 40)"))]),
    payload_sql([("address", _ZEROS["address"]), ("storageKeys", f"'[' || {_KEY_SQL} || ']'")]),
]
_ACCESS_JSON_SQL = " || ".join(
    f"CASE WHEN n >= {120 * (i + 1)} THEN {"','" if i else "''"} || {t} ELSE '' END" for i, t in enumerate(_ACCESS_JSON)
)
_TX_JSON = payload_sql(
    [
        ("hash", _HASH_SQL),
        ("type", "CASE WHEN n > 160 THEN '2' WHEN n > 80 THEN '1' ELSE '0' END"),
        ("to", f"CASE WHEN n > 80 THEN {_quoted("'0x' || substr(sha256(line), 25, 40)")} END"),
        ("value", _quoted("CAST(n * 1000000007 AS VARCHAR)")),
        ("gas", "CAST(n * 16 + 21000 AS VARCHAR)"),
        ("gasPrice", _quoted("CAST(n AS VARCHAR)")),
        ("nonce", "CAST(pos AS VARCHAR)"),
        ("data", _DATA_SQL),
        ("accessList", f"CASE WHEN n >= 120 THEN '[' || {_ACCESS_JSON_SQL} || ']' END"),
        ("chainId", _quoted("'1'")),
    ]
)
_WITHDRAWAL_JSON = payload_sql(
    [
        ("index", "CASE WHEN line = '' THEN '0' ELSE CAST(pos AS VARCHAR) END"),
        ("validator", "CAST(n AS VARCHAR)"),
        ("address", f"CASE WHEN line = '' THEN {_ZEROS['address']} ELSE {_quoted("'0x' || substr(sha256(line), 25, 40)")} END"),
        ("amount", "CAST(n * 32 AS VARCHAR)"),
    ]
)
NESTED_SQL = f"""
    SELECT d.doc_id, '{{"hash":"0x' || sha256(CAST(d.doc_id AS VARCHAR)) || '","header":'
           || {_sparse_header(_ZEROS["hash"], "d.doc_id", "d.n_chars", "NULL")}
           || ',"uncles":' || uncles || ',"transactions":' || txs || ',"withdrawals":' || withdrawals || '}}' AS payload
    FROM documents d JOIN (
        SELECT doc_id, {_list_sql(_sparse_header(_HASH_SQL, "n", "n * 21", _DATA_SQL))} AS uncles,
               {_list_sql(_TX_JSON)} AS txs, {_list_sql(_WITHDRAWAL_JSON)} AS withdrawals
        FROM (SELECT *, octet_length(encode(line)) AS n FROM ({_LINES})) GROUP BY doc_id) USING (doc_id)"""


def _nested(spark, sf):
    return mapped(inputs.document_blocks(spark, sf)).select("doc_id", F.expr(canonical.encode_payload("block")).alias("payload"))


def _nested_block(spark, sf):
    return canonical.decode_payload(_nested(spark, sf)).select("doc_id", "block.*")


@query("payload_nested", f"SELECT doc_id, octet_length(encode(payload)) AS bytes, sha256(payload) AS payload_sha256 FROM ({NESTED_SQL})")
def payload_nested(spark, sf):
    return _nested(spark, sf).select(
        "doc_id", F.octet_length("payload").cast("bigint").alias("bytes"), F.sha2("payload", 256).alias("payload_sha256")
    )


@query("nested_uncles", _UNCLES_SQL)
def nested_uncles(spark, sf):
    return _uncle_rows(_nested_block(spark, sf), F.col("uncles"))


@query("nested_transactions", _TX_SQL)
def nested_transactions(spark, sf):
    return _tx_rows(_nested_block(spark, sf), F.col("transactions"))


@query("nested_withdrawals", _WITHDRAWALS_SQL)
def nested_withdrawals(spark, sf):
    return _withdrawal_rows(_nested_block(spark, sf), F.col("withdrawals"))


@query(
    "payload_repair",
    f"""SELECT id, CASE WHEN k < 60 THEN '0x' || sha256(sent_hash) ELSE sent_hash END AS hash,
            {inputs.REPAIRED_NUMBER_SQL} AS number
        FROM ({inputs.MESSAGES_SQL}) WHERE k >= 40""",
)
def payload_repair(spark, sf):
    # The message hash differs from the payload's, so that the two can be told apart.
    sent = inputs.messages(spark, sf).withColumn(
        "hash", F.when(F.col("hash") != "", F.concat(F.lit("0x"), F.sha2("hash", 256)))
    )
    checked = contract.check_messages(sent)
    return checked.filter(F.col("reason").isNull()).select(
        "id",
        F.col("block.hash").alias("hash"),
        F.col("block.header.number").cast("string").alias("number"),
    )


@query(
    "block_valid",
    f"""SELECT number, hash FROM ({_BLOCKS}) WHERE base_fee IS NOT NULL""",
)
def block_valid(spark, sf):
    # Blocks of one chain lose their hash, and must be rejected.
    blocks = inputs.order_blocks(spark, sf).select(
        "number", F.when(F.col("chain") != "P", F.col("raw.hash")).alias("hash")
    )
    return canonical.valid_blocks(blocks)


# --- heights -----------------------------------------------------------------

_HEAD_TAGS = f"""
    SELECT chain, max(number) AS latest,
           max(CASE WHEN ok = FALSE AND chain = 'F' THEN number END) AS tag
    FROM ({_HEADS}) GROUP BY chain"""
_FINAL = f"""
    SELECT chain, tag, latest, coalesce(tag, CASE WHEN latest >= {inputs.CONFIRMATIONS}
           THEN latest - {inputs.CONFIRMATIONS} END) AS finalized
    FROM ({_HEAD_TAGS})"""


def head_tags(spark, sf):
    """Latest head of each chain; one chain's node also knows the finalized tag."""
    return (
        inputs.heads(spark, sf)
        .groupBy("chain")
        .agg(
            F.max("number").alias("latest"),
            F.max(F.when(~F.col("ok") & (F.col("chain") == "F"), F.col("number"))).alias("tag"),
        )
    )


def finalized(spark, sf):
    return head_tags(spark, sf).select(
        "chain",
        "tag",
        "latest",
        heights.finalized_head(F.col("tag"), F.col("latest"), inputs.CONFIRMATIONS).alias(
            "finalized"
        ),
    )


@query("finalized_head", _FINAL)
def finalized_head(spark, sf):
    return finalized(spark, sf)


@query(
    "finalized_heights",
    f"""SELECT h.chain, number FROM ({_HEADS}) h JOIN ({_FINAL}) f ON h.chain = f.chain
        WHERE number <= finalized""",
)
def finalized_heights(spark, sf):
    head = by_value(finalized(spark, sf).select("chain", "finalized"))
    blocks = inputs.heads(spark, sf).join(head, "chain")
    return heights.finalized_only(blocks, "number", F.col("finalized")).select("chain", "number")


@query(
    "head_gap_fill",
    f"""SELECT chain, head, unnest(range(low, head + 1)) AS height FROM (
            SELECT chain, number AS head, coalesce(max(number) OVER (
                PARTITION BY chain ORDER BY arrived, number
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1, number) AS low
            FROM ({_HEADS})) WHERE low <= head""",
)
def head_gap_fill(spark, sf):
    return heights.head_gap_fill(
        inputs.heads(spark, sf), "chain", "number", ["arrived", "number"]
    )


@query(
    "high_water_mark",
    f"""SELECT chain, number, arrived, ok, max(CASE WHEN ok THEN number END) OVER (
            PARTITION BY chain ORDER BY arrived, number
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS mark
        FROM ({_HEADS})""",
)
def high_water_mark(spark, sf):
    return heights.high_water_mark(
        inputs.heads(spark, sf), "chain", "number", F.col("ok"), ["arrived", "number"]
    )


_POLLS = f"""
    SELECT chain, arrived, max(number) AS latest,
           max(CASE WHEN NOT ok THEN number END) AS tag
    FROM ({_HEADS}) GROUP BY chain, arrived"""


def polls(spark, sf):
    """One poll per chain and day: the heads of that day, sometimes with a tag."""
    return (
        inputs.heads(spark, sf)
        .groupBy("chain", "arrived")
        .agg(
            F.max("number").alias("latest"),
            F.max(F.when(~F.col("ok"), F.col("number"))).alias("tag"),
        )
    )


@query(
    "finalized_backlog",
    f"""WITH p AS (
            SELECT chain, arrived, coalesce(tag, CASE WHEN latest >= {inputs.CONFIRMATIONS}
                   THEN latest - {inputs.CONFIRMATIONS} END) AS f
            FROM ({_POLLS})),
        s AS (
            SELECT chain, arrived, f, coalesce(max(f) OVER (
                PARTITION BY chain ORDER BY arrived
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1, f) AS low
            FROM p WHERE f IS NOT NULL)
        SELECT chain, arrived, unnest(range(low, f + 1)) AS height FROM s WHERE low <= f""",
)
def finalized_backlog(spark, sf):
    head = heights.finalized_head(F.col("tag"), F.col("latest"), inputs.CONFIRMATIONS)
    known = polls(spark, sf).select("chain", "arrived", head.alias("finalized"))
    return heights.finalized_backlog(known, "chain", "finalized", ["arrived"])


@query(
    "missing_heights",
    f"""WITH h AS ({_HEADS}),
        w AS (SELECT chain, unnest(range(lo, hi + 1)) AS height FROM (
            SELECT chain, min(number) AS lo, max(number) AS hi FROM h GROUP BY chain))
        SELECT chain, height FROM w WHERE NOT EXISTS (
            SELECT 1 FROM h WHERE h.chain = w.chain AND h.number = w.height)""",
)
def missing_heights(spark, sf):
    done = inputs.heads(spark, sf).select("chain", "number")
    wanted = done.groupBy("chain").agg(
        F.min("number").alias("low"), F.max("number").alias("high")
    )
    return heights.missing_heights(wanted, done, "chain", "low", "high", "number")
