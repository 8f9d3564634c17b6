"""The typed block and its JSON payload.

The maps take and return SQL text (see ``functions.hexes``); the functions on
DataFrames below wrap them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.bigints import parse_big
from ..functions.hexes import address20, bloom256, clean_hex, hash32, is_zero_hash, nonce8
from ..functions.ids import UINT64_MAX
from ..schemas import BLOCK, HEADER, INT, STRING, TRANSACTION, UINT64, WITHDRAWAL

# Wire shape: numbers of any width are read in full, and checked against their bits afterwards.
WIRE_DDL = ", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in BLOCK.fields).replace(":int", ":decimal(20,0)")


def _struct(fields: dict[str, str]) -> str:
    return "named_struct(" + ", ".join(f"'{name}', {value}" for name, value in fields.items()) + ")"


def _each(items: str, name: str, value: Callable[[str], str]) -> str:
    """Map every element; an empty list counts as missing."""
    return f"CASE WHEN size({items}) > 0 THEN transform({items}, {name} -> {value(name)}) END"


def _number(value: str) -> str:
    return f"coalesce(cast({value} AS DECIMAL(20,0)), cast(0 AS DECIMAL(20,0)))"


def _optional(s: str, normal: Callable[[str], str]) -> str:
    return f"CASE WHEN {s} <> '' THEN {normal(s)} END"


def map_header(h: str, number: str | None = None) -> str:
    """A header with every required field set; a missing header is all zero."""
    return _struct(
        {
            "parentHash": hash32(f"{h}.parentHash"),
            "uncleHash": hash32(f"{h}.uncleHash"),
            "coinbase": address20(f"{h}.coinbase"),
            "root": hash32(f"{h}.root"),
            "txHash": hash32(f"{h}.txHash"),
            "receiptHash": hash32(f"{h}.receiptHash"),
            "bloom": bloom256(f"{h}.bloom"),
            "difficulty": parse_big(f"{h}.difficulty"),
            "number": _number(number or f"{h}.number"),
            "gasLimit": _number(f"{h}.gasLimit"),
            "gasUsed": _number(f"{h}.gasUsed"),
            "time": _number(f"{h}.time"),
            "extra": clean_hex(f"{h}.extra"),
            "mixDigest": hash32(f"{h}.mixDigest"),
            "nonce": nonce8(f"{h}.nonce"),
            "baseFee": parse_big(f"{h}.baseFee"),
            "withdrawalsHash": _optional(f"{h}.withdrawalsHash", hash32),
            "parentBeaconRoot": _optional(f"{h}.parentBeaconRoot", hash32),
            "blobGasUsed": f"cast({h}.blobGasUsed AS DECIMAL(20,0))",
            "excessBlobGas": f"cast({h}.excessBlobGas AS DECIMAL(20,0))",
        }
    )


def map_headers(items: str) -> str:
    return _each(items, "h", map_header)


def map_access_list(items: str) -> str:
    return _each(
        items,
        "a",
        lambda a: _struct(
            {
                "address": address20(f"{a}.address"),
                "storageKeys": _each(f"{a}.storageKeys", "k", hash32),
            }
        ),
    )


def map_transactions(items: str) -> str:
    return _each(
        items,
        "t",
        lambda t: _struct(
            {
                "hash": hash32(f"{t}.hash"),
                "type": f"coalesce(cast({t}.type AS INT), 0)",
                "to": _optional(f"{t}.to", address20),
                "value": parse_big(f"{t}.value"),
                "gas": _number(f"{t}.gas"),
                "gasPrice": parse_big(f"{t}.gasPrice"),
                "maxFeePerGas": parse_big(f"{t}.maxFeePerGas"),
                "maxPriorityFeePerGas": parse_big(f"{t}.maxPriorityFeePerGas"),
                "nonce": _number(f"{t}.nonce"),
                "data": clean_hex(f"{t}.data"),
                "accessList": map_access_list(f"{t}.accessList"),
                "chainId": parse_big(f"{t}.chainId"),
            }
        ),
    )


def map_withdrawals(items: str) -> str:
    """A missing withdrawal keeps its place as an all-zero entry."""
    return _each(
        items,
        "w",
        lambda w: _struct(
            {
                "index": _number(f"{w}.index"),
                "validator": _number(f"{w}.validator"),
                "address": address20(f"{w}.address"),
                "amount": _number(f"{w}.amount"),
            }
        ),
    )


def map_block(block: str, hash_: str | None = None, number: str | None = None) -> str:
    """The canonical block of a raw block struct.

    ``hash_`` and ``number`` stand in for the block's own where given.
    """
    return _struct(
        {
            "hash": hash32(hash_ or f"{block}.hash"),
            "header": map_header(f"{block}.header", number),
            "uncles": map_headers(f"{block}.uncles"),
            "transactions": map_transactions(f"{block}.transactions"),
            "withdrawals": map_withdrawals(f"{block}.withdrawals"),
        }
    )


def _wire_header(h: str) -> str:
    sparse = {"gasLimit", "gasUsed", "time"}
    return _struct(
        {
            f.name: f"nullif({h}.{f.name}, cast(0 AS {f.dataType.simpleString()}))"
            if f.name in sparse
            else f"{h}.{f.name}"
            for f in HEADER.fields
        }
    )


def encode_payload(block: str) -> str:
    """JSON text of a canonical block.

    Missing values, empty lists and zero gasLimit, gasUsed and time are left
    out; number, gas, nonce and type are always written.
    """
    return "to_json({})".format(
        _struct(
            {
                "hash": f"{block}.hash",
                "header": _wire_header(f"{block}.header"),
                "uncles": _each(f"{block}.uncles", "h", _wire_header),
                "transactions": f"{block}.transactions",
                "withdrawals": f"{block}.withdrawals",
            }
        )
    )


def read_payload(payload: str) -> str:
    """The one reading of a JSON text: a VARIANT object with the payload as ``p`` and a field ``end`` behind it.

    The reader stops where the object ends. Text after the payload breaks the
    object, adds a field to it, or hides its true end, which a text cannot hold
    itself: it is a hash of the text. An object that names a field twice is no
    VARIANT.
    """
    text = f"CASE WHEN trim({payload}) = 'null' THEN '{{}}' ELSE {payload} END"
    return f"try_parse_json(concat('{{\"p\":', {text}, ',\"end\":', cast(xxhash64({payload}) AS STRING), '}}'))"


# Kinds of values as schema_of_variant() describes them. Whole numbers of up to 20 digits; more are out of range.
_TEXT = "(?:STRING|VOID)"
_WHOLE = r"(?:BIGINT|VOID|DECIMAL\((?:1?\d|20),0\))"


def _object(fields: dict[str, str]) -> str:
    """Pattern of an object, or nothing, with some of these fields."""
    return "(?:VOID|OBJECT<(?:(?:" + "|".join(f"{name}: {kind}" for name, kind in fields.items()) + ")(?:, |(?=>)))*+>)"


def _list(kind: str) -> str:
    return f"(?:VOID|ARRAY<{kind}>)"


def _plain_fields(shape: T.StructType) -> dict[str, str]:
    return {
        f.name: _TEXT if f.dataType == STRING else _WHOLE
        for f in shape
        if f.dataType == STRING or isinstance(f.dataType, T.NumericType)
    }


_HEADER_KINDS = _object(_plain_fields(HEADER))
_ACCESS_KINDS = _list(_object({"address": _TEXT, "storageKeys": _list(_TEXT)}))
_PARTS = {
    "hash": _TEXT,
    "header": _HEADER_KINDS,
    "uncles": _list(_HEADER_KINDS),
    "transactions": _list(_object({**_plain_fields(TRANSACTION), "accessList": _ACCESS_KINDS})),
    "withdrawals": _list(_object(_plain_fields(WITHDRAWAL))),
}
# A payload that has no fields but known ones is judged by one description of the whole text.
_SOUND = f"^OBJECT<end: BIGINT, p: {_object(_PARTS)}>$"


def _kinds(wire: str, path: str) -> str:
    return f"coalesce(schema_of_variant(try_variant_get({wire}, '$.p{path}', 'variant')), 'VOID')"


def _known_kinds(wire: str) -> str:
    """The test of a payload with unknown fields: those of each place that is read are taken out by name."""
    tests = [
        f"size(try_variant_get({wire}, '$', 'map<string,variant>')) = 2",
        f"{_kinds(wire, '')} rlike '^(?:OBJECT<|VOID)'",
        f"{_kinds(wire, '.hash')} rlike '^{_TEXT}$'",
    ]

    def variants(fields: list[str]) -> str:
        return "struct<" + ",".join(f"{name}:variant" for name in fields) + ">"

    def flat(item: str, shape: T.StructType, nested: str | None = None) -> str:
        """Whether an object, or nothing, has fields of the right kinds."""
        found = []
        for name, kind in _plain_fields(shape).items():
            found.append(f"coalesce(schema_of_variant({item}.{name}), 'VOID') rlike r'^{kind}$'")
        if nested:
            found.append(nested)
        return " AND ".join(found)

    def each(path: str, shape: T.StructType, name: str, extra: list[str] = [], nested: str | None = None) -> str:
        kind = variants([*_plain_fields(shape), *extra])
        items = f"try_variant_get({wire}, '$.p{path}', 'array<variant>')"
        objects = f"forall({items}, i -> coalesce(schema_of_variant(i), 'VOID') rlike '^(?:OBJECT<|VOID)')"
        parts = f"try_variant_get({wire}, '$.p{path}', 'array<{kind}>')"
        sound = f"forall({parts}, {name} -> {name} IS NULL OR ({flat(name, shape, nested)}))"
        return f"({_kinds(wire, path)} = 'VOID' OR ({_kinds(wire, path)} rlike '^ARRAY<' AND {objects} AND {sound}))"

    header = f"try_variant_get({wire}, '$.p.header', '{variants(list(_plain_fields(HEADER)))}')"
    tests.append(
        f"({_kinds(wire, '.header')} = 'VOID' OR ({_kinds(wire, '.header')} rlike '^OBJECT<' AND "
        f"forall(array({header}), h -> {flat('h', HEADER)})))"
    )
    tests.append(each(".uncles", HEADER, "u"))
    access = "try_variant_get(t.accessList, '$', 'array<struct<address:variant,storageKeys:variant>>')"
    nested = (
        "(coalesce(schema_of_variant(t.accessList), 'VOID') = 'VOID' OR "
        "(schema_of_variant(t.accessList) rlike '^ARRAY<' "
        "AND forall(try_variant_get(t.accessList, '$', 'array<variant>'), "
        "i -> coalesce(schema_of_variant(i), 'VOID') rlike '^(?:OBJECT<|VOID)') "
        f"AND forall({access}, a -> a IS NULL OR (coalesce(schema_of_variant(a.address), 'VOID') rlike '^{_TEXT}$' "
        f"AND coalesce(schema_of_variant(a.storageKeys), 'VOID') rlike '^{_list(_TEXT)}$'))))"
    )
    tests.append(each(".transactions", TRANSACTION, "t", ["accessList"], nested))
    tests.append(each(".withdrawals", WITHDRAWAL, "w"))
    return " AND ".join(tests)


def _in_range(fields: T.StructType, of: str) -> str:
    """Whether all numbers of a struct are unsigned and within their bits."""
    limits = {UINT64: f"cast('{UINT64_MAX}' AS DECIMAL(20,0))", INT: "255"}
    return " AND ".join(
        f"coalesce({of}.{f.name} BETWEEN 0 AND {limits[f.dataType]}, TRUE)"
        for f in fields
        if f.dataType in limits
    )


def _all_in_range(fields: T.StructType, items: str) -> str:
    return f"coalesce(forall({items}, x -> {_in_range(fields, 'x')}), TRUE)"


def _ended(wire: str, payload: str) -> str:
    return f"coalesce(try_variant_get({wire}, '$.end', 'bigint') = xxhash64({payload}), FALSE)"


def plainly_sound(wire: str, kinds: str, payload: str) -> str:
    """Whether a reading is sound as its description ``kinds`` tells, without a look at its numbers.

    Whole numbers that are no DECIMAL and have no sign are within 63 bits; only
    the type of a transaction has fewer. FALSE is no verdict.
    """
    types = f"try_variant_get({wire}, '$.p.transactions', 'array<struct<type:decimal(20,0)>>')"
    return (
        f"coalesce({kinds} rlike r'{_SOUND}' AND NOT contains({kinds}, 'DECIMAL') AND NOT contains({payload}, '-') "
        f"AND CASE WHEN contains({kinds}, 'type: ') THEN coalesce(forall({types}, t -> coalesce(t.type <= 255, TRUE)), TRUE) "
        f"ELSE TRUE END AND {_ended(wire, payload)}, FALSE)"
    )


def own_hash(wire: str) -> str:
    """The hash a sound reading names."""
    return f"try_variant_get({wire}, '$.p.hash', 'string')"


def raw_block(wire: str, payload: str) -> str:
    """The raw wire struct of a reading; NULL if the text is no payload or has a value of a wrong kind."""
    ended = _ended(wire, payload)
    kinds = f"coalesce(schema_of_variant({wire}) rlike r'{_SOUND}', FALSE) OR coalesce({_known_kinds(wire)}, FALSE)"
    empty = f"from_json('{{}}', 'STRUCT<{WIRE_DDL}>')"
    return f"CASE WHEN {ended} AND ({kinds}) THEN coalesce(try_variant_get({wire}, '$.p', 'STRUCT<{WIRE_DDL}>'), {empty}) END"


def numbers_ok(block: str) -> str:
    """Whether a raw block was read, and each number of it is in its range."""
    return (
        f"coalesce({block} IS NOT NULL AND {_in_range(HEADER, f'{block}.header')} "
        f"AND {_all_in_range(HEADER, f'{block}.uncles')} "
        f"AND {_all_in_range(TRANSACTION, f'{block}.transactions')} "
        f"AND {_all_in_range(WITHDRAWAL, f'{block}.withdrawals')}, FALSE)"
    )


def repaired_hash(own: str, message: str) -> str:
    """A payload's hash, or that of the message which carried it where it is zero."""
    return f"CASE WHEN {is_zero_hash(own)} AND {message} <> '' THEN {message} ELSE {own} END"


def repaired_number(own: str, message: str) -> str:
    """A payload's number, or that of the message where it is zero."""
    return f"CASE WHEN coalesce({own}, 0) = 0 THEN {message} ELSE {own} END"


# --- on DataFrames -----------------------------------------------------------


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column that is computed once per row.

    A plain projection would be copied into every filter that is pushed below
    it, and run there again; nothing is pushed below a generator.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def with_block(df: DataFrame, raw: str = "raw", into: str = "block") -> DataFrame:
    """Replace a raw block struct by its canonical block."""
    return df.withColumn(into, F.expr(map_block(raw))).drop(raw)


def read_block(df: DataFrame, payload: str, into: str) -> DataFrame:
    """Add the raw block of a JSON payload; NULL where the text, a value or its range is not sound."""
    read = once(df, "_wire", F.expr(read_payload(payload)))
    raw = once(read, "_raw", F.expr(raw_block("_wire", payload))).drop("_wire")
    return once(raw, into, F.expr(f"CASE WHEN {numbers_ok('_raw')} THEN _raw END")).drop("_raw")


def decode_payload(df: DataFrame, payload: str = "payload", into: str = "block") -> DataFrame:
    """Add the canonical block of a JSON payload; NULL where it cannot be read."""
    return (
        read_block(df, payload, "_sound")
        .withColumn(into, F.expr(f"CASE WHEN _sound IS NOT NULL THEN {map_block('_sound')} END"))
        .drop("_sound")
    )


def valid_blocks(df: DataFrame, hash_col: str = "hash") -> DataFrame:
    """Blocks whose hash is set."""
    return df.filter(F.expr(f"NOT {is_zero_hash(hash_col)}"))
