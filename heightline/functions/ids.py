"""Stream ids, timestamps in milliseconds, keys and unsigned numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the largest unsigned 64-bit number.
UINT64_MAX = "18446744073709551615"


def parse_uint64(s: Column) -> Column:
    """Plain digits within 64 bits as DECIMAL(20,0), else NULL."""
    value = F.when(
        s.rlike("^[0-9]+$"), F.regexp_replace(s, "^0+(?=.)", "").try_cast("decimal(20,0)")
    )
    return F.when(value <= F.lit(UINT64_MAX).cast("decimal(20,0)"), value)


def parse_int64(s: Column) -> Column:
    """Digits with an optional sign as BIGINT, else NULL."""
    return F.when(s.rlike("^[+-]?[0-9]+$"), s.try_cast("bigint"))


def stream_id_millis(stream_id: Column) -> Column:
    """The millisecond part of ``<ms>-<seq>``; NULL without a dash."""
    return F.when(
        F.contains(stream_id, F.lit("-")), parse_int64(F.substring_index(stream_id, "-", 1))
    )


def stream_id_seq(stream_id: Column) -> Column:
    return parse_int64(F.substring_index(stream_id, "-", -1))


def scanned_at_millis(field: Column) -> Column:
    return parse_int64(field)


def millis_timestamp(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def latency_millis(scanned_at: Column, now_ms: Column | int) -> Column:
    """Milliseconds since ``scanned_at``, never below zero; NULL stays NULL."""
    now = now_ms if isinstance(now_ms, Column) else F.lit(now_ms)
    return F.when(scanned_at.isNotNull(), F.greatest(F.lit(0).cast("bigint"), now - scanned_at))


def hash_tag(key: Column) -> Column:
    """The text in the first ``{...}``; the whole key where that is missing or empty."""
    inner = F.regexp_extract(key, r"^[^{]*\{([^}]*)\}", 1)
    return F.when(inner != "", inner).otherwise(key)


def scoped_key(stream_key: Column, prefix: str | Column, item: Column) -> Column:
    """``{tag}:prefix:item``, so that keys of one stream share their tag."""
    lead = prefix if isinstance(prefix, Column) else F.lit(prefix)
    return F.concat(F.lit("{"), hash_tag(stream_key), F.lit("}:"), lead, F.lit(":"), item)
