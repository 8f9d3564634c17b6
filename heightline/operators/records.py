"""Shape of a published record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hexes import HASH_DIGITS
from . import canonical

# Header names.
NUMBER_HEADER = "block-number"
HASH_HEADER = "block-hash"
SOURCE_HEADER = "source-message-id"


def header(key: Column | str, value: Column) -> Column:
    name = key if isinstance(key, Column) else F.lit(key)
    return F.struct(name.alias("key"), F.encode(value, "UTF-8").alias("value"))


def block_records(
    df: DataFrame,
    topic: str,
    block: str = "block",
    extras: Column | None = None,
) -> DataFrame:
    """Add topic, binary key, JSON value and headers of each canonical block.

    ``extras`` is an array of header structs; those without a name are left out.
    """
    b = F.col(block)
    headers = F.array(
        header(NUMBER_HEADER, b["header"]["number"].cast("string")),
        header(HASH_HEADER, b["hash"]),
    )
    if extras is not None:
        headers = F.concat(headers, F.filter(extras, lambda h: h["key"] != ""))
    record = F.struct(
        F.lit(topic).alias("topic"),
        F.unhex(F.substring(b["hash"], 3, HASH_DIGITS)).alias("key"),
        F.encode(F.expr(canonical.encode_payload(block)), "UTF-8").alias("value"),
        headers.alias("headers"),
    )
    return canonical.once(df, "_record", record).select(
        *[F.col(c) for c in df.columns], "_record.*"
    )


def source_header(message_id: Column) -> Column:
    """Provenance: which outbox message a record came from."""
    return F.array(header(SOURCE_HEADER, message_id))
