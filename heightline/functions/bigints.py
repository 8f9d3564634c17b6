"""Unbounded integers kept as decimal text. Functions take and return SQL text."""

from __future__ import annotations

from .hexes import hex_bytes, let, strip

# Wide hex turns into decimal in base 10^9 limbs (low limb first), 28 bits at a
# time; each product stays below 2^58, so BIGINT arithmetic is exact at any length.
_LIMB = 1_000_000_000
_STEP_DIGITS = 7
_STEP = 1 << (4 * _STEP_DIGITS)


def _wide_hex(digits: str) -> str:
    # Groups of seven counted from the end; the zeros complete the first one.
    groups = (
        f"regexp_extract_all(concat('{'0' * (_STEP_DIGITS - 1)}', {digits}), "
        f"r'.{{{_STEP_DIGITS}}}(?=(?:.{{{_STEP_DIGITS}}})*$)', 0)"
    )
    chunks = f"transform({groups}, g -> cast(conv(g, 16, 10) AS BIGINT))"
    value = f"(limb * {_STEP}L + s.carry)"
    take_in = f"""aggregate(limbs,
        named_struct('out', cast(array() AS ARRAY<BIGINT>), 'carry', chunk),
        (s, limb) -> named_struct('out', concat(s.out, array({value} % {_LIMB}L)),
                                  'carry', {value} div {_LIMB}L),
        s -> CASE WHEN s.carry > 0 THEN concat(s.out, array(s.carry)) ELSE s.out END)"""
    limbs = f"aggregate({chunks}, cast(array() AS ARRAY<BIGINT>), (limbs, chunk) -> {take_in})"
    return f"""array_join(transform(reverse({limbs}), (limb, i) -> CASE WHEN i = 0
        THEN cast(limb AS STRING) ELSE lpad(cast(limb AS STRING), 9, '0') END), '')"""


def _mid_hex(digits: str) -> str:
    """Up to 31 digits: the last 15 and what is before them, as exact decimals."""
    high = f"cast(conv(substr(lpad({digits}, 31, '0'), 1, 16), 16, 10) AS DECIMAL(20,0))"
    low = f"cast(conv(right({digits}, 15), 16, 10) AS DECIMAL(20,0))"
    return (
        f"cast(cast({high} * cast({1 << 60}L AS DECIMAL(19,0)) + {low} AS DECIMAL(38,0)) AS STRING)"
    )


_BLANK = r"[\s\x{85}\x{a0}]"
_PLAIN = "^[1-9][0-9]*$"
_DECIMAL = f"^{_BLANK}*[+-]?[0-9]+{_BLANK}*$"
_DECIMAL_NOISE = rf"{_BLANK}|\+|(?<![0-9])0+(?=[0-9])"


def _from_hex(value: str) -> str:
    def by_width(digits: str) -> str:
        return f"""CASE WHEN length({digits}) <= 16 THEN conv(concat('0', {digits}), 16, 10)
            WHEN length({digits}) <= 31 THEN {_mid_hex(digits)}
            ELSE {_wide_hex(digits)} END"""

    return f"CASE WHEN {value} IS NOT NULL THEN {let(f'ltrim(\'0\', hex({value}))', 'd', by_width)} END"


def parse_big(s: str) -> str:
    """Decimal text of an integer written in base 10, or else in hex.

    Blank, odd-length hex and anything malformed are NULL; a bare ``0x`` is 0.
    """
    decimal = f"regexp_replace(regexp_replace({s}, r'{_DECIMAL_NOISE}', ''), '^-0$', '0')"
    bare_mark = f"CASE WHEN lower({strip(s)}) = '0x' THEN '0' END"
    return f"""CASE WHEN {s} IS NULL OR {s} rlike '{_PLAIN}' THEN {s}
        WHEN {s} rlike r'{_DECIMAL}' THEN {decimal}
        ELSE coalesce({let(hex_bytes(s), 'v', _from_hex)}, {bare_mark}) END"""


def big_decimal(s: str) -> str:
    """A numeric view of decimal text; NULL where 38 digits do not hold it."""
    return f"try_cast({s} AS DECIMAL(38,0))"
