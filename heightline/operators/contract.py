"""What a message must hold before it is published, and where it fails."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hexes import hash32, let
from ..functions.ids import parse_uint64
from . import canonical

# Reasons in the order they are tested.
REASONS = (
    "hash_missing",
    "hash_empty",
    "number_missing",
    "number_empty",
    "number_invalid",
    "payload_missing",
    "payload_empty",
    "payload_undecodable",
)


def failure_reason(hash_: Column, number: Column, payload: Column, decoded_ok: Column) -> Column:
    """The first broken rule, or NULL for a sound message."""
    tests = (
        hash_.isNull(),
        hash_ == "",
        number.isNull(),
        number == "",
        parse_uint64(number).isNull(),
        payload.isNull(),
        payload == "",
        ~decoded_ok,
    )
    reason = F.lit(None).cast("string")
    for test, name in reversed(list(zip(tests, REASONS))):
        reason = F.when(test, F.lit(name)).otherwise(reason)
    return reason


_RAW, _NUMBER = "_raw_block", "_sent_number"
_HASH = canonical.repaired_hash(f"{_RAW}.hash", "hash")
_BLOCK = canonical.map_block(_RAW, _HASH, canonical.repaired_number(f"{_RAW}.header.number", _NUMBER))

# What a header, a transaction, a withdrawal, an access tuple or a storage key is as JSON at most,
# with all fields at their full width but the texts of free length.
_ELEMENT_BYTES = 1500


def check_messages(df: DataFrame) -> DataFrame:
    """Add ``reason`` and the repaired canonical ``block`` (of use where reason is NULL).

    The payload is parsed once; nothing is dropped, so callers can split the
    result into good rows (``reason IS NULL``) and a quarantine table.
    """
    parsed = canonical.read_block(df, "payload", _RAW).withColumn(_NUMBER, parse_uint64(F.col("number")))
    return parsed.withColumns(
        {
            "reason": failure_reason(
                F.col("hash"),
                F.col("number"),
                F.col("payload"),
                F.col(_RAW).isNotNull(),
            ),
            "block": F.expr(_BLOCK),
        }
    ).drop(_RAW, _NUMBER)


def judge_messages(df: DataFrame, max_record_bytes: int = 0) -> DataFrame:
    """Add ``reason`` and, of use where it is NULL, the ``block_hash`` and whether the record is too ``large``.

    For messages of which few are published: a block is read in full only where
    the kinds of its values do not tell that it is sound, and mapped only where
    its record may exceed the limit (see may_exceed).
    """
    doubt = may_exceed(F.col("payload"), max_record_bytes) if max_record_bytes > 0 else F.lit(False)
    wire = canonical.once(df, "_wire", F.expr(canonical.read_payload("payload")))
    kinds = canonical.once(wire, "_kinds", F.expr("schema_of_variant(_wire)"))
    plain = F.expr(canonical.plainly_sound("_wire", "_kinds", "payload")) & ~F.coalesce(doubt, F.lit(False))
    told = canonical.once(kinds, "_plain", plain)
    read = canonical.once(told, _RAW, F.when(~F.col("_plain"), F.expr(canonical.raw_block("_wire", "payload"))))
    known = read.withColumn(_NUMBER, parse_uint64(F.col("number"))).withColumn(
        "_own", F.when(F.col("_plain"), F.expr(canonical.own_hash("_wire"))).otherwise(F.col(f"{_RAW}.hash"))
    )
    sound = F.col("_plain") | F.expr(canonical.numbers_ok(_RAW))
    reason = canonical.once(
        known, "reason", failure_reason(F.col("hash"), F.col("number"), F.col("payload"), sound)
    )
    large = F.lit(False)
    if max_record_bytes > 0:
        size = let(_BLOCK, "b", lambda b: f"octet_length({canonical.encode_payload(b)})")
        asked = F.col("reason").isNull() & doubt
        large = F.when(asked, F.expr(size) > F.lit(max_record_bytes)).otherwise(F.lit(False))
    own = canonical.repaired_hash("_own", "hash")
    return (
        reason.withColumn("block_hash", F.expr(hash32(own))).withColumn("large", large)
        .select(*df.columns, "reason", "block_hash", "large")
    )


def may_exceed(payload: Column, limit: int) -> Column:
    """False where the record of a payload cannot take more than ``limit`` bytes, however it is written.

    Texts of free length are at most twice as long in the record as in the
    payload. What is filled in has a fixed width, and stands in the block, its
    header or an element of a list; a list has one element more than commas.
    """
    size = F.octet_length(payload).cast("bigint")

    def count(mark: str) -> Column:
        return size - F.octet_length(F.replace(payload, F.lit(mark), F.lit("")))

    def bound(elements: Column) -> Column:
        return size * 2 + (elements + 2) * _ELEMENT_BYTES

    # No payload has more elements than bytes: most need not be looked through.
    return (bound(size) > limit) & (bound(count(",") + count("[")) > limit)


def too_large(value: Column, limit: int) -> Column:
    """Whether a value takes more than ``limit`` bytes; no limit at 0 or below."""
    if limit <= 0:
        return F.lit(False)
    return F.octet_length(value) > F.lit(limit)


def size_guard(df: DataFrame, value: str, limit: int) -> DataFrame:
    """Mark records over the size limit with their size in bytes."""
    return df.withColumn("value_bytes", F.octet_length(F.col(value))).withColumn(
        "rejected", too_large(F.col(value), limit)
    )
