"""Hex text: lenient parsing, printing, and fixed-width values.

Functions take and return Spark SQL text, for ``F.expr`` and ``selectExpr``: whole
blocks are mapped with hundreds of these, and one parsed text is much quicker to
build than as many Column objects.
"""

from __future__ import annotations

from collections.abc import Callable

# Fixed values.
HASH_DIGITS = 64
ADDRESS_DIGITS = 40
BLOOM_DIGITS = 512
NONCE_DIGITS = 16
ZERO_HASH = "0x" + "0" * HASH_DIGITS
ZERO_ADDRESS = "0x" + "0" * ADDRESS_DIGITS
ZERO_BLOOM = "0x" + "0" * BLOOM_DIGITS
ZERO_NONCE = "0x" + "0" * NONCE_DIGITS
_CANONICAL = r"^0x[0-9a-f]+\z"
BLANKS = " \t\n\r\u000b\f\u0085 "

# Values go through binary rather than regular expressions: ``unhex`` is many
# times faster on long text and tells malformed digits by NULL.


def strip(s: str) -> str:
    """Remove white space (not only spaces, as ``trim`` would) at both ends."""
    return f"btrim({s}, '{BLANKS}')"


def _bare(s: str) -> str:
    return f"substr({s}, CASE WHEN substr({s}, 1, 2) IN ('0x', '0X') THEN 3 ELSE 1 END)"


def trim_0x(s: str) -> str:
    """Lower-case text without blanks around it and without one leading ``0x``."""
    return _bare(strip(f"lower({s})"))


def hex_text(b: str) -> str:
    return f"concat('0x', lower(hex({b})))"


def _whole_bytes(s: str) -> str:
    # ``unhex`` would take odd text as if a zero stood in front.
    return f"CASE WHEN length({s}) % 2 = 0 THEN unhex({_bare(s)}) END"


def _bytes(s: str) -> str:
    # Blanks make ``unhex`` fail; only then are they looked for.
    return f"coalesce({_whole_bytes(s)}, {let(strip(s), 'bare', _whole_bytes)})"


def let(value: str, name: str, body: Callable[[str], str]) -> str:
    """``body`` over a value that is worked out once; for branches rarely taken."""
    return f"element_at(transform(array({value}), {name} -> {body(name)}), 1)"


def _as_is(s: str, digits: int, other: str, zero: str) -> str:
    """Canonical text is taken as it stands, without a way through binary and back; missing is zero."""
    return (
        f"CASE WHEN {s} IS NULL OR {s} = '{zero}' THEN '{zero}' "
        f"WHEN octet_length({s}) = {2 + digits} AND {s} rlike r'{_CANONICAL}' THEN {s} ELSE {other} END"
    )


def hex_bytes(s: str) -> str:
    """Bytes of hex text. Empty, odd-length or malformed text is NULL."""
    return f"nullif({_bytes(s)}, X'')"


def clean_hex(s: str) -> str:
    """Canonical ``0x`` text of a byte value; empty or malformed is NULL."""
    bare = _bare(s)
    return (
        f"CASE WHEN {s} IS NULL THEN NULL "
        f"WHEN octet_length({s}) > 2 AND octet_length({s}) % 2 = 0 AND {s} rlike r'{_CANONICAL}' THEN {s} "
        f"WHEN length({s}) % 2 = 0 AND octet_length(unhex({bare})) > 0 THEN concat('0x', lower({bare})) "
        f"ELSE {hex_text(hex_bytes(s))} END"
    )


def bytes_hex(b: str) -> str:
    """``0x`` text of a binary value; empty is NULL."""
    return f"CASE WHEN octet_length({b}) > 0 THEN {hex_text(b)} END"


# Malformed text is read up to its first bad byte; odd text counts as if one
# zero stood in front. Values are short, so the pattern's depth is bounded.
_LEADING_BYTES = r"(?s)^((?:[0-9a-f](?=(?:..)*$))?(?:[0-9a-f]{2})*)"


def _fixed(s: str, width: int) -> str:
    """A value of ``width`` bytes: long ones keep their tail, short ones are padded in front."""

    def fit(digits: str) -> str:
        return hex_text(f"lpad(substr(unhex({digits}), -{width}, {width}), {width}, X'00')")

    bare = _bare(s)
    partial = f"regexp_extract(lower({bare}), r'{_LEADING_BYTES}', 1)"
    zero = "0x" + "00" * width
    return _as_is(s, 2 * width, f"coalesce({fit(bare)}, {fit(partial)}, '{zero}')", zero)


def hash32(s: str) -> str:
    """A 32-byte value as canonical text; missing is the zero hash."""
    return _fixed(s, HASH_DIGITS // 2)


def address20(s: str) -> str:
    """A 20-byte address as canonical lower-case text; missing is zero."""
    return _fixed(s, ADDRESS_DIGITS // 2)


def bloom256(s: str) -> str:
    """A bloom value: exactly 256 bytes, anything else reads as zero."""
    value = _bytes(s)
    other = f"CASE WHEN octet_length({value}) = {BLOOM_DIGITS // 2} THEN {hex_text(value)} ELSE '{ZERO_BLOOM}' END"
    return _as_is(s, BLOOM_DIGITS, other, ZERO_BLOOM)


def nonce8(s: str) -> str:
    """An 8-byte nonce: left-aligned, cut or zero-filled on the right."""
    other = hex_text(f"rpad(coalesce({_bytes(s)}, X''), {NONCE_DIGITS // 2}, X'00')")
    return _as_is(s, NONCE_DIGITS, other, ZERO_NONCE)


def is_zero_hash(s: str) -> str:
    return f"({hash32(s)} = '{ZERO_HASH}')"
